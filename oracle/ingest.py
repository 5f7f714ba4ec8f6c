"""DuckDB SQL for the ingest queries."""

from oracle.basics import sql

sql("s1_positional_json", """select cast(year(o_orderdate) as integer) as year, o_orderstatus as first_name,
  if(o_custkey % 2 = 0, 'F', 'M') as sex, count(*) as n, cast(sum(o_custkey) as bigint) as total from orders group by all""")
sql("s2_json_lines", "select event_type, count(*) as n, round(sum(value), 2) as value from events group by 1")
sql("s3_schema_append", "select event_type, count(*) as n, max(event_id) as last from events group by 1")
sql("s4_csv_header", """select p_type, count(*) as n, cast(sum(p_size) as bigint) as size, round(sum(p_retailprice), 2) as worth
  from part group by 1""")
sql("s5_csv_schema", "select * from supplier")
sql("s6_pipe_delimited", "select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as worth from orders group by 1")
sql("s7_stacked_csv", """select cast(p_type = 'LARGE' as integer) as is_large, count(*) as n, round(sum(p_retailprice), 2) as worth
  from part where p_type is not null group by 1""")
sql("s8_text_lines", """with l as (select unnest(string_split(text || chr(10) || chr(10) || '  ', chr(10))) as s from documents)
  select count(*) as lines, count(*) filter (not regexp_matches(s, '\\S')) as empty,
    cast(sum(len(regexp_extract_all(s, '[\\p{L}\\p{M}\\p{Nd}\\p{Pc}'']+'))) as bigint) as words from l""")
sql("s9_table_folders", """select c_mktsegment, count(*) as n from orders join customer on c_custkey = o_custkey
  where year(o_orderdate) = 1998 group by 1""")
sql("s10_daily_logs", "select strftime(ts, '%Y%m%d') as dt, count(*) as n from events group by 1")
for _name in ("n1_grant_blocks", "n2_sso_access", "n3_tunnel_blocks"):
    sql(_name, """select cast(user_id as varchar) as userkey, count(*) as n, cast(sum(event_id % 3 + 1) as bigint) as items,
      max('10.0.0.' || (event_id % 3 + 1)) as last_ip from events group by 1""")
sql("n4_app_access", """select cast(user_id as varchar) as user_name, count(*) as n, cast(sum(event_id % 2) as bigint) as targets,
  cast(sum(2 * (1 - event_id % 2)) as bigint) as flags, cast(sum(event_id % 5 + 7) as bigint) as levels,
  count(*) filter (event_id % 2 = 0) as without_level from events group by 1""")
sql("s11_projected_read", "select count(distinct event_type) as types, count(distinct user_id) as users from events where value > 5")
sql("s14_numbered_rows", """select o_orderstatus, count(*) as n, max(length('string_value_' || o_orderkey)) as longest
  from orders group by 1""")
sql("s15_table_format", "select c_mktsegment, count(*) as n from customer group by 1")
sql("s16_job_config", """select cast(s_suppkey as varchar) as key, s_name as name,
  case when s_suppkey % 3 = 0 then '' else 'nation ' || s_nationkey end as nation, case when s_suppkey % 3 = 0 then '' else 'yes' end as active from supplier""")
sql("s17_struct_parameter", """select o_orderstatus as status, count(*) as n, round(sum(o_totalprice), 2) as worth from orders
  where (o_orderstatus = 'F' and o_totalprice >= 100000) or (o_orderstatus = 'O' and o_totalprice >= 200000) group by 1""")
