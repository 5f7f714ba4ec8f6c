"""DuckDB SQL for the results of the streaming queries."""

from oracle.basics import sql

_W = """with e as (select epoch(ts) as s, unnest([event_type, props->>'$.k']) as word from events),
  w as (select word, cast(floor(s / 15) as bigint) * 15 as b from e)"""
sql("t1_t2_s12_window_words", f"""{_W} select word, count(*) as count, make_timestamp(b * 1000000) as window_start,
    make_timestamp((b + 15) * 1000000) as window_end, true as unfilled from w group by word, b
  having make_timestamp((b + 15) * 1000000) <= (select date_trunc('millisecond', max(ts)) from events)""")
sql("t1_window_words_batch", f"{_W} select word, count(*) as count, make_timestamp(b * 1000000) as window_start from w group by word, b")
_U = """u as (select cast(user_id as varchar) as user_id, make_timestamp(cast(floor(epoch(ts) / 5) as bigint) * 5000000) as window_start, count(*) as n
    from events where event_type = 'error' and event_id % 50 <> 0 group by all
    having window_start + interval 5 second <= (select date_trunc('millisecond', max(ts)) from events where event_type = 'error' and event_id % 50 <> 0))"""
sql("t3_users_in_windows", f"with {_U} select user_id, window_start, n as events_in_window from u")
sql("t4_j19_enriched_events", f"""with {_U}, h as (select cast(user_id as varchar) as user_id, count(*) as h from events where event_type = 'purchase' group by 1)
  select u.user_id, window_start, 'country ' || c_nationkey as country, h as history
  from u left join customer on cast(c_custkey as varchar) = u.user_id and c_custkey % 3 <> 0 left join h on h.user_id = u.user_id""")
sql("t5_step_failures", "select 'extractElement' as step_name, count(*) as n from events where event_id % 50 = 0")
_R = """with m as (
    select event_id, ts, case when event_id % 40 = 1 then 'x' || user_id else cast(user_id as varchar) end as uid, user_id, value
    from events where event_id % 25 <> 0),
  f as (select *, row_number() over (partition by uid order by ts, event_id) as i from m),
  k as (select cast(c_custkey as varchar) as uid, c_custkey % 5 as s from customer where c_custkey % 5 < 2),
  r as (select f.*, case when i > 1 then 'complete' when k.uid is null then 'new' when s = 1 then 'inComplete' else 'complete' end as route
        from f left join k using (uid))"""
sql("t6_t7_t8_status_log", f"{_R} select uid, 'complete' as status, event_id from r where route <> 'complete'")
sql("t8_duplicates", f"{_R} select uid, count(*) as n from r where route = 'complete' and try_cast(uid as bigint) is not null group by 1")
sql("t9_two_phase_status", f"""{_R} select 'log' as kind, 'complete' as status, count(*) as n from r where route <> 'complete'
  union all select 'log', 'new', count(*) from r where route = 'new'
  union all select 'final', 'complete', (select count(*) from r where route = 'new') + (select count(*) from k where s = 0)
    + (select count(*) from r where route = 'inComplete')
  union all select * from (select 'final', 'pending', (select count(*) from k where s = 1) - (select count(*) from r where route = 'inComplete') as n) where n > 0""")
sql("t10_k20_dead_letters", f"""{_R} select 'write' as step_name, count(*) as n from r where route = 'complete' and try_cast(uid as bigint) is null
  having n > 0 union all select 'extractElement', count(*) from events where event_id % 25 = 0""")
sql("t12_micro_appends", "select event_type, count(*) as n from events group by 1")
sql("k15_offset_batches", "select count(*) as n, count(*) as offsets, cast(0 as bigint) as first, count(*) - 1 as last from events")
sql("t14_deduplicated", "select distinct user_id || '-' || event_type as key from events")
sql("j19_cogrouped_streams", """with d as (
    select date_trunc('day', ts) as day, user_id, count(*) filter (event_type = 'view') as views, count(*) filter (event_type = 'click') as clicks
    from events group by all),
  m as (select least(max(ts) filter (event_type = 'view'), max(ts) filter (event_type = 'click')) as mark from events)
  select cast(day as timestamp) as day, user_id, views, clicks from d, m where views > 0 and clicks > 0 and day + interval 1 day <= date_trunc('millisecond', mark)""")
