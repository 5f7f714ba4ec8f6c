"""DuckDB SQL for the event, JSON and scalar queries."""

from oracle.basics import sql

_KEYS = ("nation", "ver", "is_new_user", "appkey")
_LEVELS = ", ".join(f"unnest(['{k}', 'all']) as u_{k}" for k in _KEYS)
sql("m13_test_funnel", f"""
  with e as (
    select user_id as uid, cast(props->>'$.k' as integer) as k, event_type = 'view' as shown from events where user_id > 0),
  s as (
    select uid, count(*) as show_post_num, cast(sum(c) as bigint) as show_cnt
    from (select uid, k, k % 5, k % 3, count(*) as c from e where shown group by all) group by uid),
  c as (select uid, count(*) filter (k % 2 = 0) as click_cost_pv, count(*) as click_pv from e where not shown group by uid),
  u as (
    select s.*, coalesce(click_cost_pv, 0) as click_cost_pv, coalesce(click_pv, 0) as click_pv,
      'test' || (c_custkey % 2) as abtest, 'group' || (c_custkey % 3) as abgroup,
      if(c_custkey % 11 <> 0, 'n' || (c_nationkey % 4), null) as nation, 'v' || (c_custkey % 2) as ver,
      cast(c_custkey % 2 as varchar) as is_new_user, c_mktsegment as appkey
    from s left join c using (uid) join customer on c_custkey = uid),
  x as (
    select u.*, coalesce(n, 'all') as n, v, w, a from u, (select unnest([0, 1]) as i) p, (select unnest([0, 1]) as j) q,
      (select unnest([0, 1]) as g) r, (select unnest([0, 1]) as h) z,
      lateral (select if(i = 0, nation, 'all') as n, if(j = 0, ver, 'all') as v, if(g = 0, is_new_user, 'all') as w,
               if(h = 0, appkey, 'all') as a))
  select abtest, abgroup, coalesce(n, 'all') as nation, v as ver, w as is_new_user, a as appkey, count(*) as users,
    count(*) as is_post_show, cast(sum(show_post_num) as bigint) as show_post_num, cast(sum(show_cnt) as bigint) as show_cnt,
    cast(sum(click_cost_pv) as bigint) as click_cost_pv, cast(sum(click_pv) as bigint) as click_pv
  from x group by abtest, abgroup, coalesce(n, 'all'), v, w, a""".replace("coalesce(n, 'all') as n, v, w, a", "n, v, w, a"))
sql("f11_json_fields", "select cast(props->>'$.k' as integer) as k, count(*) as n from events group by 1")
_VISITS = """with v as (
    select 'county ' || (user_id % 10) as county, event_id as sid, i, if(i % 2 = 0, 'F', 'M') as sex,
      cast(20 + (event_id * 7 + i * 13) % 60 as integer) as age
    from events, range(1, 5) r(i) where i <= cast(props->>'$.k' as integer) % 4 + 1)"""
sql("f14_f15_visits", f"{_VISITS} select county, sex as visitor_sex, count(*) as n, cast(sum(age) as bigint) as ages from v group by all")
sql("g11_visitors_per_birth", f"""{_VISITS} select county, avg(n) as by_mean, sum(n) / count(*) as by_ratio
  from (select county, sid, count(*) as n from v group by all) group by 1""", "-by_mean county", 1)
sql("g11_mean_visitor_age", f"""{_VISITS} select round(avg(a), 8) as mean_age
  from (select sid, avg(age) as a from v where county = 'county 3' group by 1)""")
sql("g13_common_age", f"{_VISITS} select age as visitor_age, count(*) as n from v where county = 'county 3' group by 1", "-n visitor_age", 1)
sql("m14_seat_allocation", """
  with r as (
    select l_partkey as seat_no, l_suppkey % 50 as person_id, min(l_orderkey * 10 + l_linenumber) as request_id,
      max(1 + l_linenumber % 2) as request from lineitem group by all),
  f as (from r qualify row_number() over (partition by seat_no order by request_id, request, person_id) = 1),
  s as (select p_partkey as seat_no, cast(p_partkey % 3 as integer) as status, if(p_partkey % 3 > 0, p_partkey % 50, null) as person_id from part),
  x as (select s.*, f.request, f.person_id as p, s.status = 0 and f.request in (1, 2) as free,
          s.status = 1 and f.request = 2 and s.person_id = f.person_id as up from s left join f using (seat_no))
  select seat_no, cast(case when free then request when up then 2 else status end as integer) as status,
    case when free or up then p else person_id end as person_id from x""")
_FOLD = """with recursive d as (
    select event_type, cast(props->>'$.k' as integer) as k, event_id, if(event_id % 3 = 0, -1, 1) as step,
      row_number() over (partition by event_type, cast(props->>'$.k' as integer) order by event_id) as i from events),
  f as (
    select event_type, k, i, greatest(step, 0) as n from d where i = 1
    union all select d.event_type, d.k, d.i, greatest(f.n + step, 0) from f join d on d.event_type = f.event_type and d.k = f.k and d.i = f.i + 1),
  m as (select event_type, k, cast(n as bigint) as n from f qualify i = max(i) over (partition by event_type, k))"""
sql("g20_multiset", f"{_FOLD} select * from m where n > 0")
sql("g20_multiset_median", f"""{_FOLD}, x as (select event_type, k from m, range(0, 1000) r(j) where j < n)
  select event_type, cast(list_sort(list(k))[(count(*) + 1) // 2] as double) as median from x group by 1""")
sql("f1_to_f4_text_and_casts", """select c_custkey, left(c_name, 8) as prefix, if(c_custkey % 5 <> 0, c_mktsegment, '') || '/' || c_custkey as label,
  upper(left(c_mktsegment, 3)) as seg, c_acctbal as bal, date '1999-04-01' as day from customer""")
sql("f5_f6_dates", """select o_orderkey, cast(o_orderdate as date) + 14 as later, cast(o_orderdate as date) - 30 as earlier,
  cast(date '1999-01-01' - cast(o_orderdate as date) as integer) as days from orders""")
sql("f7_f8_times", """select event_id, strftime(timestamp '2024-07-26 06:34:04' + to_seconds(event_id), '%Y-%m-%d %H:%M:%S') as started, true as ordered,
  case when value > 0 then floor(event_id * 10 / value * 10000 + 0.5) / 10000 end as slots from events""")
sql("f9_f10_numbers", """select c_custkey, if(c_custkey % 3 <> 0, c_acctbal, 0) as bal, abs(c_acctbal) as size, round(c_acctbal) as whole from customer""")
sql("f12_words", """select conv_id, turn, cast(len(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{Nd}\\p{Pc}]+')) as integer) as words,
  cast(len(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{Nd}\\p{Pc}'']+')) as integer) as with_apostrophes from conversations""")
sql("f16_arrays", "select vec_id, embedding[1] as first, cast(len(embedding) as integer) as dims, unnest(['a', 'all']) as side from embeddings")
sql("f17_empty_for_null", "select c_custkey, if(c_custkey % 2 = 1, c_name, '') as name, cast(c_custkey % 2 as integer) as n from customer")
sql("f18_nested_message", """select o_orderkey, '{"asset":{"ancestors":["' || o_orderstatus || '","' || o_orderpriority || '"],"assetType":"order"},"priorAssetState":"PRESENT","window":{"startTime":"'
  || strftime(o_orderdate, '%Y-%m-%d') || '"}}' as message from orders""")
sql("f19_run_time", "select o_orderkey, date '1995-12-31' as day_before from orders where o_orderdate < date '1996-01-01'")
sql("f20_word_lines", "select event_type || ': ' || count(*) as line from events group by event_type")
sql("f21_rounded_integers", """select l_orderkey, l_partkey, cast(floor(l_quantity / 2 + 0.5) as bigint) as half_up,
  -cast(floor(l_quantity / 2 + 0.5) as bigint) as half_down from lineitem""")
sql("u1_scalar_function", """select doc_id, not regexp_matches(text, '\\n[ \\t]*\\|') as same, cast(length(text) as integer) as n from documents""")
sql("u2_rows_from_row", """select doc_id, count(*) as lines, cast(max(length(l)) as integer) as longest
  from (select doc_id, unnest(string_split(text, chr(10))) as l from documents) group by 1""")
sql("u3_filter_not_null_rows", """select user_id, '{"event_id":' || event_id || ',"event_type":"error"}' as data from events where event_type = 'error'""")
sql("u4_sum_of_ones", "select event_type as word, count(*) as n from events group by 1")
