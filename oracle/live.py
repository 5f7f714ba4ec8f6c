"""DuckDB SQL for the streaming jobs that get their table in several batches."""

from oracle.basics import SQL, sql

#: seconds that a message is under way at most (fixed value)
_LATE = 3600
_SEEN = f"(select date_trunc('millisecond', max(ts)) - interval {_LATE} second from %s)"

sql("t1_disordered_words", f"""with e as (select epoch(ts) as s, unnest([event_type, props->>'$.k']) as word from events),
  w as (select word, cast(floor(s / 15) as bigint) * 15 as b from e)
  select word, count(*) as count, make_timestamp(b * 1000000) as window_start from w group by word, b
  having make_timestamp((b + 15) * 1000000) <= {_SEEN % 'events'}""")
_U = f"""u as (select cast(user_id as varchar) as user_id, make_timestamp(cast(floor(epoch(ts) / 5) as bigint) * 5000000) as window_start, count(*) as n
    from events where event_type = 'error' and event_id % 50 <> 0 group by all
    having window_start + interval 5 second <= {_SEEN % "events where event_type = 'error' and event_id % 50 <> 0"})"""
sql("t3_disordered_users", f"with {_U} select user_id, window_start, n as events_in_window from u")
sql("t4_enriched_batches", f"""with {_U}, h as (select cast(user_id as varchar) as user_id, count(*) as h from events where event_type = 'purchase' group by 1)
  select u.user_id, window_start, 'country ' || c_nationkey as country, h as history
  from u left join customer on cast(c_custkey as varchar) = u.user_id and c_custkey % 3 <> 0 left join h on h.user_id = u.user_id""")
sql("j19_disordered_streams", f"""with d as (
    select date_trunc('day', ts) as day, user_id, count(*) filter (event_type = 'view') as views, count(*) filter (event_type = 'click') as clicks
    from events group by all),
  m as (select least(max(ts) filter (event_type = 'view'), max(ts) filter (event_type = 'click')) as mark from events)
  select cast(day as timestamp) as day, user_id, views, clicks from d, m
  where views > 0 and clicks > 0 and day + interval 1 day <= date_trunc('millisecond', mark) - interval {_LATE} second""")

for _copy, _of in (("g20_stream_multiset", "g20_multiset"), ("g20_stream_median", "g20_multiset_median"), ("g18_stream_metrics", "g18_text_metrics"),
                   ("s14_numbered_stream", "s14_numbered_rows")):
    sql(_copy, *SQL[_of])
sql("g18_observed_metrics", f"select *, words as written from ({SQL['g18_text_metrics'][0]})")
sql("k15_ledger_batches", "select count(*) as rows, cast(4 as bigint) as batches, count(*) as next, true as contiguous from events")

_M = """with m as (select event_id as e, case when event_id % 25 = 0 then 'invalid' when event_id % 40 = 1 then 'bad key'
      when event_id % 97 = 0 then 'unavailable' end as dead, case when event_id % 13 = 0 then 3 when event_id % 11 = 0 then 2 else 1 end as tries from events)"""
sql("t11_deliveries", f"""{_M} select 'first' as round, tries as attempt, count(*) as n, count(*) as events from m where dead is null group by tries
  union all select 'again', tries, count(*), count(*) from m where dead in ('bad key', 'unavailable') group by tries""")
sql("t10_sent_again", f"""{_M} select 'first' as round, dead as reason, case dead when 'invalid' then 0 when 'bad key' then 1 else 3 end as attempts, count(*) as n
  from m where dead is not null group by dead
  union all select 'again', dead, 0, count(*) from m where dead = 'invalid' group by dead""")
sql("u2_event_runs", """with recursive e as (
    select user_id, cast(ts as date) as day, event_type, event_id, epoch_us(ts) / 1e6 as sec, row_number() over (partition by user_id, cast(ts as date) order by ts, event_id) as i from events),
  r as (
    select *, 1 as run, 1 as n, sec as began from e where i = 1
    union all
    select e.*, if(goes, run, run + 1), if(goes, n + 1, 1), if(goes, began, e.sec) from (
      select e as e, r.run, r.n, r.began, e.event_type = r.event_type and (r.n = 1 or e.sec - r.sec <= 3 * (r.sec - r.began) / (r.n - 1)) as goes
      from r join e on e.user_id = r.user_id and e.day = r.day and e.i = r.i + 1))
  select user_id, min(event_type) as event_type, min_by(event_id, i) as first_event, max_by(event_id, i) as last_event, count(*) as events,
    case when count(*) > 1 then (max(sec) - min(sec)) / (count(*) - 1) end as gap_seconds from r group by user_id, day, run""")

sql("k18_clustered", "select unnest(['l_shipdate', 'l_partkey']) as column_name, cast(64 as bigint) as files, true as quarter, true as same_rows")
sql("g15_sketched_percentiles", "select unnest([0.5, 0.99, 0.999, 0.9999])::double as share, true as within, (select count(*) from lineitem) as rows")
sql("l12_sequential_search", """select count(*) as held_out, 40 as trials, true as above_chance, true as no_worse_than_random
  from lineitem where (l_orderkey * 7919 + 11) % 100 >= 70""")
sql("m3_column_lineage", """select *, (select count(*) from customer) as customers from (values ('renamed', 'b', ''), ('dropped', '', ''), ('filtered', '', 'c_acctbal'),
  ('grouped', 'top', ''), ('joined', '', ''), ('united', 'x', ''), ('viewed', 'who', ''), ('ranked', 'r', 'c_acctbal'), ('subquery', '', 'c_acctbal'),
  ('other_table', '', '')) as q(query, shown, used)""")
