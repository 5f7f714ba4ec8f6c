"""DuckDB SQL for the governance and workload queries."""

from oracle.basics import sql

sql("m1_masked_table", "select c_mktsegment, count(*) as n, 0e0 as balance, '' as name from customer group by 1")
sql("m2_m3_masking_flags", """select count(*) as n, true as direct_by_name, true as direct_exact, false as renamed_by_name, true as renamed_exact,
  false as plain_by_name, false as plain_exact from customer""")
sql("m4_role_members", """select distinct 'roles/' || lower(c_mktsegment) as role, unnest(['user:' || c_name, 'group:' || c_nationkey]) as member from customer
  union select 'roles/owner', 'user:root'""")
_Q = "from orders, (select unnest([1, 2, 3]) as i)"
sql("m7_benchmark_rows", f"""select 'iteration_' || (o_orderkey % 4) as iteration, 'q' || i as name, count(*) as n,
  cast(sum(o_orderkey % 100 * 5 + i) as double) as execution {_Q} group by all""")
sql("m8_total_runtime", f"select i::varchar as name, round(sum((o_orderkey % 100 * 15 + 5 * i) / 1000), 6) as runtime {_Q} group by 1")
_FACTS = """select cast(o_orderkey % 10 as varchar) as run_id, if(o_orderkey % 3 = 0, '14b', cast(o_orderkey % 99 as varchar)) as sn,
  cast(o_orderkey % 7 as integer) as run_sn, 'job-' || o_orderkey as job_id, cast(250 as bigint) as client_duration,
  o_orderkey % 5000 + 1 as job_duration, o_orderkey * 1024 as total_bytes_processed,
  (o_custkey * 100 + 1) / (o_orderkey % 5000 + 1) as avg_slots"""
sql("m9_m10_j20_job_facts", f"{_FACTS} from orders")
sql("m11_run_summary", f"""with f as ({_FACTS}, o_custkey * 100 + 1 as slot_ms from orders),
  p as (select floor(sum(job_duration) / 60000 * 100 + 0.5e0) / 100 as minutes, sum(slot_ms) as slot_ms, avg(avg_slots) as slots from f group by run_id, run_sn)
  select round(geomean(minutes), 4) as minutes, round(geomean(slot_ms), 2) as slot_ms, round(avg(slots), 6) as slots from p""")
sql("m5_partition_use", """select o_orderkey as query_id, 'main.ds.t' || (o_orderkey % 5) as table,
    case o_orderkey % 3 when 0 then 'day' when 1 then 'bucket' end as partition_field,
    coalesce(case o_orderkey % 3 when 0 then o_orderkey % 2 = 0 when 1 then o_orderkey % 2 = 1 end, false) as is_used from orders
  union all select o_orderkey, 'main.ds.dim', null, false from orders""")
sql("m6_checks", """select *, actual = expected as passed from (
  select 'orders have a customer' as name, cast(0 as bigint) as expected, count(*) as actual from orders where o_custkey is null
  union all select 'no free lines', 0, count(*) from lineitem where l_extendedprice <= 0
  union all select 'five regions', 5, count(*) from region
  union all select 'no errors', 0, count(*) from events where event_type = 'error'
  union all select 'parts are there', 1, 1 union all select 'a missing table is there', 1, 0)""")
sql("m12_integer_tokens", """select count(*) as n, max(cast(w as bigint)) as largest
  from (select unnest(regexp_split_to_array(text, '\\s+')) as w from documents) where regexp_full_match(w, '[0-9]+')""")
sql("g15_token_percentiles", " union all ".join(
    f"select cast({p} as double) as share, round(quantile_cont(v, {p}), 4) as value from (select unnest([l_orderkey, l_partkey]) as v from lineitem)"
    for p in (0.99, 0.999, 0.9999)))
sql("f13_log_metrics", """select s_suppkey as log, s_suppkey * 37 as throughput, cast(round_even((s_suppkey * 537 + 250) / 1000, 0) as bigint) as p99,
  cast(round_even((s_suppkey * 1037 + 500) / 1000, 0) as bigint) as p999, cast(round_even((s_suppkey * 1537 + 750) / 1000, 0) as bigint) as p9999 from supplier""")
