"""DuckDB SQL for the export, snapshot and write queries."""

from oracle.basics import sql

sql("k1_export_partitions", """select cast(date_trunc('month', o_orderdate) as date) as dt, count(*) as n, round(sum(o_totalprice), 2) as worth
  from orders where date_trunc('month', o_orderdate) <= date '2001-08-31' - 730 group by 1""")
sql("k2_export_select", "select date '2001-08-31' as dt, count(*) as n from orders where o_totalprice > 200000")
sql("k3_export_shards", """select year(o_orderdate) || '-01-01' as suffix, count(*) as n from orders where year(o_orderdate) in (1995, 1997) group by 1
  union all select 'partial', count(*) from orders where o_orderstatus = 'P'""")
sql("k4_export_daily_shards", """select cast(date_trunc('year', o_orderdate) as date) as suffix, count(*) as n from orders
  where year(o_orderdate) <= 1999 group by 1""")
sql("k5_p15_guarded_read", "select count(*) as n, true as refused from orders where year(o_orderdate) = 1998")
_PLAN = """with c as (
    select n_nationkey as k, if(n_nationkey % 10 = 9, '*', 'ds' || (n_nationkey % 10)) as ds,
      case n_nationkey % 4 when 0 then '*' when 1 then 't' || n_nationkey when 2 then 'log{YYYYMMDD}' else 'log*' end as tb,
      n_nationkey % 3 * 30 as days, n_nationkey % 2 = 0 as sel, n_nationkey % 5 = 0 as names from nation),
  m as (
    select 'ds' || (p_partkey % 10) as ds, 't' || p_partkey as tb,
      case when p_partkey % 7 = 0 then 'view' when p_partkey % 5 = 1 then 'int_partition'
           when p_partkey % 3 = 0 then 'time_partition' else 'no_partition' end as kind from part),
  x as (
    select c.k, days, sel, names, m.ds, m.tb, kind from c join m on (c.ds = '*' or (c.ds = m.ds and c.tb in ('*', m.tb)))
      where contains(c.tb, 'YYYY') is false and not (c.tb = 'log*' and c.ds <> '*')
    union all select k, days, sel, names, ds, tb, if(contains(tb, 'YYYY'), 'shard_table_day', 'shard_table') from c
      where contains(tb, 'YYYY') or (tb = 'log*' and ds <> '*')),
  p as (from x where kind <> 'view')"""
sql("k6_export_routes", f"""{_PLAN}, r as (select kind, case
    when kind in ('int_partition', 'no_partition') then if(sel, 'select', 'none')
    when kind = 'time_partition' then case when days > 0 then 'partitions' when sel then 'select' else 'none' end
    when kind = 'shard_table_day' then case when days > 0 then 'shards' when sel then 'select' when names then 'list' else 'none' end
    else case when names then 'list' when sel then 'select' else 'none' end end as route from p)
  select kind, route, count(*) as n from r group by all""")
sql("k7_duplicate_tables", f"""{_PLAN} select 'main' as input_project, ds as input_dataset, tb as input_table, count(*) as n from p
  group by all having count(*) > 1""")
sql("k7_refused_snapshots", f"""{_PLAN} select count(*) as repeated, true as refused, cast(3 as integer) as taken
  from (select ds, tb from p group by all having count(*) > 1)""")
sql("k8_table_kinds", f"{_PLAN} select kind, count(*) as n from m group by 1")
sql("k9_k10_snapshots", "select 'customer_20240106' as name, count(*) as n, cast(1 as integer) as expired, true as skipped from customer")
sql("k11_dispositions", "select r_name, cast(2 as bigint) as n, true as refused from region")
sql("k12_replace_day", """select year(o_orderdate) || '-01-01' as dt, count(*) as n from orders where year(o_orderdate) in (1997, 1998) group by 1""")
sql("k13_replace_table", "select o_orderstatus, count(*) as n from orders where o_orderstatus = 'O' group by 1")
sql("k14_status_update", """select if(c_custkey in (select o_custkey from orders where o_orderstatus = 'F'), 'complete', 'new') as status, count(*) as n
  from customer group by 1""")
sql("k14_newest_row", """select user_id, event_id, event_type, value from events qualify row_number() over (partition by user_id order by event_id desc) = 1""")
sql("k16_csv_export", "select c_mktsegment, count(*) as n from customer group by 1")
sql("k17_word_lines", "select event_type || ': ' || count(*) as value from events group by event_type")
sql("k18_layouts", """select l as layout, cast(year(o_orderdate) as integer) as year, count(*) as n, round(sum(o_totalprice), 2) as worth, l = 'zstd' as zstd,
  cast(l = 'partitioned' as bigint) as folders from orders, (select unnest(['plain', 'partitioned', 'zstd', 'sorted']) as l) group by 1, 2""")
sql("k19_clean_partitions", "select cast(year(o_orderdate) as integer) as year, count(*) as n from orders where o_orderkey % 10 <> 0 group by 1")
sql("k21_dated_run", """select '1997-05-05 06:00' as run, count(*) as n from orders where cast(o_orderdate as date) = date '1997-05-05' having n > 0""")
sql("k22_schema_ddl", """select 't' || n_regionkey as "table", '(' || string_agg(lower(n_name) || ' ' || if(n_nationkey % 2 = 0, 'INTEGER', 'STRING'), ','
  order by n_nationkey) || ')' as ddl from nation group by n_regionkey""")
sql("k23_retention", """select count(*) as n, cast(min(date_trunc('month', o_orderdate)) as date) as first,
  (select cast(count(distinct date_trunc('month', o_orderdate)) as integer) from orders where date_trunc('month', o_orderdate) < date '2001-08-31' - 365) as removed
  from orders where date_trunc('month', o_orderdate) >= date '2001-08-31' - 365""")
