"""DuckDB SQL for the feature queries, and what it can say of the model queries: rows, grid points and stated floors."""

from oracle.basics import sql

sql("l1_string_index", """select o_orderpriority, cast(row_number() over (order by count(*) desc, o_orderpriority) - 1 as double) as idx, count(*) as n
  from orders group by 1""")
sql("l2_l3_l5_features", """select l_returnflag, count(*) as n,
  (select cast(count(distinct l_returnflag) + count(distinct l_linestatus) + 3 as integer) from lineitem) as size,
  cast(2 * count(*) as double) as ones from lineitem group by 1""")
sql("l4_vector_index", "select p_partkey, cast(p_size as double) as size_feature, p_retailprice as price_feature from part")
sql("l13_standardised", """with s as (select avg(o_totalprice) as m, stddev_samp(o_totalprice) as d, avg(o_custkey) as cm, stddev_samp(o_custkey) as cd
    from orders where o_totalprice > 100000)
  select o_orderkey, round((o_totalprice - m) / d, 6) as price, round((o_custkey - cm) / cd, 6) as customer from orders, s""")

_HELD = "(%s * 7919 + 11) %% 100 >= %d"
sql("l6_l11_logistic", f"""select case when l_extendedprice / l_quantity > 1500 then 'dear' else 'cheap' end as cost, count(*) as n, true as above_chance
  from lineitem where {_HELD % ('l_orderkey', 70)} group by 1""")
sql("l7_t13_boosted_stream", """select cast(label % 2 as double) as label, count(*) as n, count(distinct vec_id) as vectors, true as beats_constant
  from embeddings group by 1""")
sql("l8_boosted_regression", f"""select count(*) as n, true as better_than_mean, true as near_plain_rate from orders
  where {_HELD % ('o_orderkey', 70)} and o_orderkey in (select l_orderkey from lineitem)""")
sql("l9_forest_regression", f"select count(*) as n, true as better_than_mean, true as near_plain_rate from orders where {_HELD % ('o_orderkey', 80)} and o_orderkey in (select l_orderkey from lineitem)")
sql("l10_grid_search", """select 'elasticNetParam=' || n || '; maxIter=' || i || '; regParam=' || r as params, true as no_worse_than_chance
  from (select unnest(['0.0', '0.5', '1.0']) as n), (select unnest(['1', '5', '10']) as i), (select unnest(['0.01', '0.5', '2.0']) as r)""")
sql("l10_search_in_pipeline", f"""select count(*) as n, true as better_than_mean, true as near_plain_rate from orders
  where {_HELD % ('o_orderkey', 70)} and o_orderkey in (select l_orderkey from lineitem)""")
sql("l12_random_search", "select cast(4 as bigint) as trials, cast(4 as bigint) as above_chance, true as held_out")
