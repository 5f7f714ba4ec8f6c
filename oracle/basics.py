"""DuckDB SQL for the operator queries on the raw tables: name -> (SQL, order, limit)."""

from __future__ import annotations

from oracle.reports import avg2, half_up

SQL: dict[str, tuple[str, object, int | None]] = {}


def sql(name: str, text: str, order=None, limit: int | None = None) -> None:
    SQL[name] = (text, order, limit)


REV = half_up("l_extendedprice * (1 - l_discount)")

sql("p1_projection", f"select l_orderkey, l_linenumber as line, {REV} as revenue, l_quantity * 2 as double_qty from lineitem")
sql("p2_conjunction", """select l_orderkey, l_partkey, l_quantity from lineitem
  where l_quantity < 24 and l_discount >= 0.05 and l_shipdate >= timestamp '1997-01-01'""")
sql("p3_or_of_ands", f"""select p_type, round(sum({REV}), 2) as revenue, count(*) as n from lineitem, part
  where (p_partkey = l_partkey and p_type = 'SMALL' and p_size <= 15 and l_quantity <= 11)
    or (p_partkey = l_partkey and p_type = 'LARGE' and p_size <= 40 and l_quantity between 10 and 30) group by 1""")
sql("p4_between", """select o_orderkey, o_totalprice, cast(o_orderdate as date) as o_day from orders
  where o_totalprice between 50000 and 70000 and year(o_orderdate) in (1997, 1998)""")
sql("p5_in_list", "select c_custkey, c_mktsegment from customer where c_mktsegment in ('BUILDING', 'HOUSEHOLD')")
sql("p6_null_tests", """select count(*) filter (not big) as without, count(*) filter (big) as with_large
  from (select c_custkey in (select o_custkey from orders where o_totalprice > 300000) as big from customer)""")
sql("p7_like", "select p_partkey, p_name from part where starts_with(p_name, 'small') or contains(p_name, 'ring')")
sql("p8_case", """select if(o_totalprice < 50000, 'low', if(o_totalprice < 150000, 'mid', 'high')) as band,
  if(o_orderstatus = 'F', 'final', if(o_orderstatus = 'O', 'open', 'partial')) as status, count(*) as n from orders group by all""")
sql("p9_guarded_ratio", """with s as (select l_suppkey, count(*) filter (l_returnflag = 'R') as returned,
    count(*) filter (l_returnflag = 'N') as kept from lineitem group by 1)
  select *, returned / kept as share from s where kept > 0 and returned / kept > 0.6""")
sql("p10_distinct", "select p_brand, p_type from part group by all")
sql("p11_flag", "select o_orderkey, cast(o_totalprice > 100000 as integer) as is_large from orders")
sql("p12_scalar_subquery", f"select o_orderkey, o_totalprice from orders where o_totalprice > 1.5e0 * (select {avg2('o_totalprice')} from orders)")
sql("p13_scalar_in_case", "select " + ", ".join(
    f"case when (select count(*) from lineitem where l_quantity between {a} and {b}) > 15000 "
    f"then (select {avg2('l_extendedprice')} from lineitem where l_quantity between {a} and {b}) "
    f"else (select round(sum(l_tax), 2) from lineitem where l_quantity between {a} and {b}) end as band{i}"
    for i, (a, b) in enumerate(((1, 10), (11, 30), (31, 50)))))
sql("p14_correlated_mean", """select l_partkey, count(*) as n from lineitem a
  where l_quantity < 0.2e0 * (select avg(l_quantity) from lineitem b where b.l_partkey = a.l_partkey) group by 1""")

sql("j1_star_join", f"""select n_name, round(sum({REV}), 2) as revenue
  from lineitem, orders, customer, nation, region where o_orderkey = l_orderkey and c_custkey = o_custkey
    and n_nationkey = c_nationkey and r_regionkey = n_regionkey and r_name = 'ASIA' group by 1""")
sql("j2_inner_chain", """select s_suppkey, n_name, r_name from region
  join nation on n_regionkey = r_regionkey join supplier on s_nationkey = n_nationkey""")
sql("j3_left_composite", """with r as (select l_orderkey, l_partkey, sum(l_quantity) as rq from lineitem where l_returnflag = 'R' group by all)
  select l_linenumber, sum(l_quantity) as sold, sum(coalesce(rq, 0)) as returned from lineitem left join r using (l_orderkey, l_partkey) group by 1""")
sql("j4_anti_by_null", """select distinct o_orderkey, o_custkey from orders
  left join (select l_orderkey from lineitem where l_returnflag = 'R') r on l_orderkey = o_orderkey where l_orderkey is null""")
sql("j5_full_outer", """select custkey, final, large from
  (select o_custkey as custkey, count(*) as final from orders where o_orderstatus = 'F' group by 1) a full join
  (select o_custkey as custkey, count(*) as large from orders where o_totalprice > 150000 group by 1) b using (custkey)""")
sql("j6_exists", """select o_orderpriority, count(*) as n from orders
  where exists (from lineitem where l_orderkey = o_orderkey and l_quantity >= 49) group by 1""")
sql("j7_exists_other_value", """select l_suppkey, count(*) as n from lineitem a
  where exists (from lineitem b where b.l_orderkey = a.l_orderkey and b.l_suppkey <> a.l_suppkey) group by 1""")
sql("j8_not_exists", """select count(*) as n, round(sum(o_totalprice), 2) as worth from orders
  where not exists (from lineitem where l_orderkey = o_orderkey and l_linestatus = 'F')""")
sql("j9_exists_or_exists", """select c_custkey from customer where exists (from orders where o_custkey = c_custkey and o_totalprice > 400000)
  or exists (from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')""")
sql("j10_in_subquery", """select l_orderkey, l_partkey, l_linenumber from lineitem
  where l_partkey in (select p_partkey from part where p_brand = 'Brand#3')""")
sql("j11_list_or_subquery", """select l_orderkey, l_partkey, l_suppkey from lineitem
  where l_suppkey in (1, 2, 3) or l_partkey in (select p_partkey from part where p_size > 48)""")
sql("j12_residual", """select o_orderstatus, count(*) as n from lineitem join orders on o_orderkey = l_orderkey
  and cast(l_shipdate as date) > cast(o_orderdate as date) + 5 and l_extendedprice < o_totalprice group by 1""")
_MONTHLY = "select cast(year(o_orderdate) * 12 + month(o_orderdate) as integer) as m, round(sum(o_totalprice), 2) as v from orders group by 1"
sql("j13_shifted_self_join", f"with s as ({_MONTHLY}) select a.m as month, a.v, b.v as v0 from s a join s b on b.m = a.m - 1")
sql("j14_one_row_aggregates", """select * from (select count(*) as am from events where hour(ts) < 12),
  (select count(*) as pm from events where hour(ts) >= 12), (select count(*) as bought from events where event_type = 'purchase')""")
sql("j15_expression_keys", """select upper(split_part(p_name, ' ', 1)) as word, count(*) as parts, count(*) filter (p_size > 25) as tall
  from part group by 1 having tall > 0""")
sql("j16_two_roles", """select b.n_name as buyer, s.n_name as seller, count(*) as n
  from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join supplier on s_suppkey = l_suppkey
    join nation b on b.n_nationkey = c_nationkey join nation s on s.n_nationkey = s_nationkey
  where b.n_nationkey <> s.n_nationkey group by all""")
sql("j17_enrich_left", """select event_id, user_id, (select c_mktsegment from customer where c_custkey = user_id and c_custkey % 3 <> 0) as segment from events""")
sql("j18_enrich_many", """with e as (select user_id, strftime(ts, '%Y-%m') as part, '[' || string_agg('{"at":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","value":' || value || '}',
    ',' order by strftime(ts, '%Y-%m-%d %H:%M:%S'), value) || ']' as errors from events where event_type = 'error' group by all)
  select c_custkey, part, errors from customer left join e on user_id = c_custkey""")
sql("j20_result_with_stats", """select o_orderkey, o_totalprice, count(*) as lines, sum(l_quantity) as units
  from orders join lineitem on l_orderkey = o_orderkey group by all""")
sql("j21_left_and_inner", """select user_id, n_name, count(*) filter (event_type = 'view') as views, count(*) filter (event_type = 'click') as clicks
  from events join customer on c_custkey = user_id join nation on n_nationkey = c_nationkey group by all having views > 0""")

sql("g1_grouped", f"""select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, round(sum(l_extendedprice), 2) as sum_price,
  round(sum({REV}), 2) as sum_revenue, avg(l_quantity) as avg_qty, min(l_shipdate) as first_ship, max(l_discount) as max_disc, count(*) as n
  from lineitem group by all""")
sql("g2_global_on_empty", "select count(*) as n, sum(o_totalprice) as worth from orders where o_totalprice < 0")
sql("g3_distinct_counts", """select l_returnflag, count(distinct l_orderkey) as orders, count(distinct (l_partkey, l_suppkey)) as pairs,
  count(distinct l_suppkey) as suppliers from lineitem group by 1""")
sql("g4_spread", """select l_suppkey, round(stddev_samp(l_quantity), 6) as sd, round(stddev_samp(l_quantity) / avg(l_quantity), 6) as cov
  from lineitem group by 1""")
sql("g5_rollup", """select p_type, p_brand, p_size, count(*) as n, round(sum(p_retailprice), 2) as worth,
  cast(grouping(p_type, p_brand, p_size) as bigint) as level from part group by rollup (p_type, p_brand, p_size)""")
sql("g6_levels_by_null", """select kind, p_brand, n, cast(kind is null as integer) + cast(p_brand is null as integer) as by_null, by_flag
  from (select kind, p_brand, count(*) as n, cast(grouping(kind) + grouping(p_brand) as integer) as by_flag
        from (select *, case when p_partkey % 41 <> 0 then p_type end as kind from part) group by rollup (kind, p_brand))""")
sql("g7_cube_with_all", """select t as event_type, coalesce(g, 'all') as grp, count(*) as n, round(sum(value), 2) as value
  from (select value, unnest([event_type, 'all']) as t, k from
         (select *, case when user_id % 7 <> 0 then cast(user_id % 7 as varchar) end as k from events)) a, unnest([k, 'all']) u(g)
  group by all""")
sql("g8_having", f"""with s as (select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as worth from orders group by 1)
  select * from s where n >= 5 and worth > (select {avg2('worth')} from s)""")
sql("g9_pivot", "select event_type, count(*) filter (hour(ts) < 12) as am, count(*) filter (hour(ts) >= 12) as pm from events group by 1")
sql("g10_conditional_count", """select user_id, count(if(event_type = 'click', event_id, null)) as clicks, count(*) as n from events group by 1""")
sql("g11_mean_of_means", """select l_suppkey, avg(lines) as avg_lines, round(avg(q), 6) as avg_of_avg from
  (select l_suppkey, l_orderkey, count(*) as lines, avg(l_quantity) as q from lineitem group by all) group by 1""")
sql("g12_ratio_of_totals", "select l_suppkey, count(*) / count(distinct l_orderkey) as avg_lines from lineitem group by 1")
sql("g13_mode", "select l_quantity, count(*) as n from lineitem group by 1", "-n l_quantity", 1)
sql("g14_geomean", "select o_orderpriority, round(geomean(o_totalprice), 4) as geomean from orders group by 1")
sql("g15_percentiles", " union all ".join(
    f"select cast({p} as double) as share, round(quantile_cont(l_extendedprice, {p}), 4) as value from lineitem" for p in (0.99, 0.999, 0.9999)))
sql("g16_lower_median", """select l_returnflag, list_sort(list(l_extendedprice))[(count(*) + 1) // 2] as median from lineitem group by 1""")
_WORDS = "regexp_extract_all(text, '[\\p{L}\\p{M}\\p{Nd}\\p{Pc}'']+')"
sql("g17_word_count", f"select w as word, count(*) as n from (select unnest({_WORDS}) as w from documents) group by 1")
sql("g18_text_metrics", f"""with l as (select unnest(string_split(text || chr(10) || chr(10) || '  ', chr(10))) as text from documents),
  w as (select unnest({_WORDS}) as w from l)
  select count(*) as words, cast(sum(length(w)) as bigint) as word_lengths, cast(min(length(w)) as integer) as min_len,
    cast(max(length(w)) as integer) as max_len, (select count(*) from l where not regexp_matches(text, '\\S')) as empty_lines,
    cast(sum(length(w)) as bigint) / count(*) as mean_len from w""")

sql("w1_first_per_group", """from (select cast(year(o_orderdate) as integer) as year, p_brand, sum(l_quantity) as q from lineitem join orders on o_orderkey = l_orderkey
  join part on p_partkey = l_partkey group by all) qualify row_number() over (partition by year order by q desc, p_brand) = 1""")
sql("w2_rank_per_group", """select o_orderpriority, o_custkey, round(sum(o_totalprice), 2) as v,
  rank() over (partition by o_orderpriority order by round(sum(o_totalprice), 2) desc) as rk from orders group by 1, 2 qualify rk <= 5""")
sql("w3_both_ends", """with s as (select o_custkey, round(sum(o_totalprice), 2) as worth from orders group by 1),
  r as (select o_custkey, rank() over (order by worth) as up, rank() over (order by worth desc) as down from s)
  select a.up as rk, a.o_custkey as least, b.o_custkey as most from r a join r b on b.down = a.up where a.up <= 10""")
sql("w4_either_rank", """select p_partkey, p_size, p_retailprice, rank() over (order by p_size) as by_size,
  rank() over (order by p_retailprice desc) as by_price from part qualify by_size <= 10 or by_price <= 10""")
sql("w5_rank_in_parent", """select *, rank() over (partition by lvl, if(lvl = 0, p_type, null) order by v desc) as rk from
  (select p_type, p_brand, round(sum(p_retailprice), 2) as v, cast(grouping(p_type, p_brand) as integer) as lvl from part group by rollup (p_type, p_brand))""")
sql("w6_share", """with s as (select l_returnflag, l_suppkey, round(sum(l_extendedprice), 2) as v from lineitem group by all)
  select *, v * 100 / round(sum(v) over (partition by l_returnflag), 2) as share from s""")
sql("w7_deviation", """with s as (select o_orderpriority, cast(year(o_orderdate) as integer) as y, round(sum(o_totalprice), 2) as v from orders group by all),
  d as (select *, round(sum(v) over w, 2) / count(*) over w as m from s window w as (partition by o_orderpriority))
  select * from d where abs(v - m) / m > 0.02""")
sql("w8_running", """with d as (select event_type, cast(ts as date) as day, round(sum(value), 2) as v from events group by all)
  select *, round(sum(v) over w, 2) as running, max(v) over w as peak from d
  window w as (partition by event_type order by day rows unbounded preceding)""")
sql("w9_neighbours", """with s as (select o_orderpriority, cast(year(o_orderdate) * 12 + month(o_orderdate) as integer) as m, round(sum(o_totalprice), 2) as v from orders group by all),
  r as (select *, rank() over (partition by o_orderpriority order by m) as k from s)
  select a.o_orderpriority, a.m, a.v, b.v as prev, c.v as next from r a
    join r b on b.o_orderpriority = a.o_orderpriority and b.k = a.k - 1
    join r c on c.o_orderpriority = a.o_orderpriority and c.k = a.k + 1""")

sql("o1_sort", "select * from nation order by n_regionkey desc, length(n_name), n_name")
sql("o2_leading_rows", "select o_orderkey, o_totalprice from orders", "-o_totalprice", 100)
sql("o3_union_all", """select 'c' as kind, c_nationkey as nation, count(*) as n from customer group by 2
  union all select 's', s_nationkey, count(*) from supplier group by 2""")
sql("o4_union_distinct", "select c_nationkey as k from customer union select s_nationkey from supplier")
sql("o5_intersect", """select o_custkey from orders group by 1 having count(distinct o_orderstatus) filter (o_orderstatus in ('F', 'O', 'P')) = 3""")
sql("o6_except", "select c_custkey as o_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus in ('F', 'O'))")
sql("o7_shared_subplan", """with s as (select o_custkey, round(sum(o_totalprice) filter (year(o_orderdate) = 1997), 2) as v,
    round(sum(o_totalprice) filter (year(o_orderdate) = 1998), 2) as v2 from orders group by 1) select * from s where v2 > v""")
sql("o8_chained_steps", """select count(*) as users, round(sum(spent), 2) as spent from (
  select user_id, count(*) filter (event_type = 'view') as shown, sum(value) filter (event_type = 'purchase') as spent
  from events group by 1) where shown > 2 and spent is not null""")
sql("o9_flatten_failures", """select 'price' as step_name, user_id from events where value < 1
  union all select 'event', user_id from events where event_type = 'error'""")
sql("o10_key_split", """select o_orderkey, case when s < 60 then 'train' when s < 80 then 'validate' else 'test' end as side
  from (select o_orderkey, (o_orderkey * 7919 + 11) % 100 as s from orders)""")
sql("o10_random_split", "select count(*) as n, count(*) as keys, true as near, cast(3 as bigint) as parts from orders")
sql("o11_alias_in_group", "select left(p_name, 3) as word, count(*) as n from part group by word")
