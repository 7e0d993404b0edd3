"""DuckDB oracle SQL for every registered query (same column names, same types where DuckDB allows)."""

from __future__ import annotations

_PURCH = "select user_id, event_id, ts, value from events where event_type = 'purchase'"
_BUILD = (f"select user_id, event_id, ts, value, lead(ts) over w is null as is_current, ts as start_date, "
          f"lead(ts) over w as end_date from ({_PURCH}) p window w as (partition by user_id order by ts, event_id)")
_DAILY = ("select user_id, round(cast(total_positive as double) * 100.0 / total_reviews, 2) as review_score, "
          "total_reviews, extracted_at, cast(extracted_at as date) as extracted_at_Date from ("
          "select user_id, count(*) filter (where event_type = 'purchase') as total_positive, "
          "count(*) as total_reviews, max(ts) as extracted_at from events group by user_id, cast(ts as date)) g "
          "where total_reviews > 0")
_RAW = ("select case when value < 20 then 'activity' when value < 60 then 'details' else 'reviews' end as feed, "
        "case when value >= 300 then null when event_type = 'purchase' then 200 when event_type = 'view' then 429 "
        "when event_type = 'click' then 403 when event_type = 'signup' then 420 else 500 end as status, "
        "props as payload from events")
# Attempts with the body each feed needs, or without: what the body holds is stated by the hour, not parsed.
_FULL = ("select *, case when status is null then (case when feed = 'activity' then 'retry' else 'error' end) "
         "when status = 429 then 'retry' when status = 403 then (case when feed = 'activity' then 'drop' else 'retry' end) "
         "when h < 6 then (case when feed = 'activity' then 'drop' else 'error' end) "      # cut short, or an error object
         "when h < 9 then (case when feed = 'details' then 'absent' else 'ok' end) "        # empty answer, success false
         "when h < 12 then (case when feed = 'activity' then 'drop' else 'error' end) "     # wrong type, no data, null
         "else 'ok' end as outcome from (select *, "
         "case when value < 20 then 'activity' when value < 60 then 'details' else 'reviews' end as feed, "
         "case when value >= 300 then null when event_type = 'view' then 429 when event_type = 'signup' then 403 "
         "else 200 end as status, hour(ts) as h, cast(round(value * 100) as bigint) as cents from events) e")
_SNAP_ALL = "select user_id, max(ts) as lm from events group by user_id"
_SNAP_BEFORE = "select user_id, max(ts) as lm from events where ts < timestamp '{t}' group by user_id"
_TOKENS = "select p_partkey, trim(t) as label from (select p_partkey, unnest(string_split(p_name, ' ')) as t from part) s"

_BATCHES = (
    f"with p as (select *, case when ts < timestamp '2024-01-10' then 0 when ts < timestamp '2024-01-20' then 1 "
    f"  else 2 end as bt from ({_PURCH}) q), "
    "v as (select * from (select *, row_number() over (partition by user_id, bt order by ts desc, event_id desc) "
    "  as rn from p) z where rn = 1) "
    "select user_id, event_id, ts, value, lead(ts) over w is null as is_current, ts as start_date, "
    "lead(ts) over w as end_date from v window w as (partition by user_id order by ts, event_id)")


def _incremental(purchases: str) -> str:
    return (
            f"with base as ({purchases}), "
            "b1 as (select * from base where ts < timestamp '2024-01-10'), "
            "s as (select user_id, event_id, ts, value, lead(ts) over w is null as is_current, ts as start_date, "
            "      lead(ts) over w as end_date from b1 window w as (partition by user_id order by ts, event_id)), "
            "latest as (select * exclude (rn) from (select *, row_number() over (partition by user_id "
            "      order by ts desc, event_id desc) as rn from base) z where rn = 1), "
            "cur as (select * from s where is_current) "
            "select s.user_id, s.event_id, s.ts, s.value, "
            "  case when s.is_current and l.ts > s.ts then false else s.is_current end as is_current, s.start_date, "
            "  case when s.is_current and l.ts > s.ts then l.ts else s.end_date end as end_date "
            "from s left join latest l on s.user_id = l.user_id "
            "union all "
            "select l.user_id, l.event_id, l.ts, l.value, true, l.ts, null from latest l "
            "left join cur c on c.user_id = l.user_id where c.user_id is null or l.ts > c.ts")


def _neighbours(key: str, order: str) -> str:
    """Neighbours by key; a null key has none."""
    return (f"select coalesce(k, -1) as k, event_id, value, case when k is not null then lag(value) over w end as prev_value, "
            f"case when k is not null then lead(value) over w end as next_value "
            f"from (select *, {key} as k from events) e window w as (partition by k order by {order})")


_HOT = "cast(case when event_type = 'view' then 0 else user_id end as bigint)"

ORACLES: dict[str, str] = {
    "logical_day":
        "select cast(ts - interval 16 hours as date) as logical_day, count(*) as n from events group by 1",
    "snapshot_fact":
        "select event_id, user_id, value, date_trunc('hour', ts) as snapshot_hour, cast(ts as date) as snapshot_date "
        "from events",
    "snapshot_hour":
        "select date_trunc('hour', ts) as snapshot_hour, cast(ts as date) as snapshot_date, count(*) as n "
        "from events group by 1, 2",
    "batch_gate":
        "select event_type, max(ts) as last_ts, cast(max(ts) - interval 16 hours as date) as last_day, "
        "cast(timestamp '2024-01-31 12:00:00' - interval 16 hours as date) as run_day, "
        "(max(ts) is null or cast(max(ts) - interval 16 hours as date) "
        "  != cast(timestamp '2024-01-31 12:00:00' - interval 16 hours as date)) as due "
        "from events group by event_type",
    "rating": _DAILY,
    "star_except": "select * exclude (props) from events",
    "price_view":
        "select o_orderkey, cast(o_orderdate as date) as extracted_date, o_orderstatus, "
        "cast(round(o_totalprice * 100) as bigint) / 100 as final_price from orders",
    "catalog_clean":
        "select event_id, event_type as name, make_timestamp((1700000000 + event_id) * 1000000) as last_modified "
        "from events where event_type is not null and event_type != ''",
    "date_dim":
        "with b as (select min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi from orders), "
        "s as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as v from b) "
        "select cast(strftime(v, '%Y%m%d') as integer) as date_key, v as full_date, cast(year(v) as integer) as year, "
        "cast(month(v) as integer) as month_num, cast(weekofyear(v) as integer) as week_num, "
        "cast(day(v) as integer) as day_of_month, strftime(v, '%Y-%m') as year_month, "
        "concat(year(v), '-', lpad(cast(weekofyear(v) as varchar), 2, '0')) as year_week, "
        "concat(isoyear(v), '-', lpad(cast(weekofyear(v) as varchar), 2, '0')) as iso_year_week, "
        "dayname(v) as day_name, dayofweek(v) in (0, 6) as is_weekend from s",
    "iso_year_week":
        "select concat(isoyear(d), '-', lpad(cast(weekofyear(d) as varchar), 2, '0')) as iso_year_week, "
        "count(*) as n from (select cast(l_shipdate as date) as d from lineitem) x group by 1",
    "flatten_json":
        "select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events",
    "concat_labels":
        "select p_partkey, array_to_string(list_sort(string_split(p_name, ' ')), ', ') as labels from part",
    "bridge_delimited": f"select distinct p_partkey, label from ({_TOKENS}) x where label != ''",
    "bridge_array":
        "select distinct p_brand, label from (select p_brand, unnest(string_split(p_name, ' ')) as label from part) x "
        "where label is not null",
    "bridge_filter":
        f"select p_partkey, p_brand from part where p_partkey in (select p_partkey from ({_TOKENS}) x "
        f"where label = 'ring')",
    "scd2_build": _BUILD,
    "scd2_incremental":
        _incremental(_PURCH),
    "scd2_null_version":
        _incremental(_PURCH + " and value >= 50"),
    "scd2_batches": _BATCHES,
    # the first batch is a history: all its versions are published
    "scd2_published": _BATCHES.replace("where rn = 1)", "where rn = 1 or bt = 0)"),
    "scd2_published_full": _BUILD,
    "scd2_one_key":
        f"select (select count(*) from ({_PURCH}) p) + count(*) as versions, cast(1 as bigint) as buckets_changed from ({_PURCH}) p "
        f"where user_id = (select user_id from ({_PURCH}) d order by value desc, event_id desc, user_id desc limit 1)",
    "price_islands":
        "with p as (select cast(case when value < 40 then 0 else user_id end as bigint) as user_id, event_id, ts, cast(floor(value / 10) as bigint) as price "
        "from events where event_type = 'purchase'), "
        "c as (select *, lag(price) over w is distinct from price or lag(event_id) over w is null as change from p "
        "  window w as (partition by user_id order by ts, event_id)), "
        "n as (select *, cast(sum(change::int) over (partition by user_id order by ts, event_id) as bigint) as island from c), "
        "i as (select user_id, island, min(price) as price, min(ts) as first_ts, max(ts) as last_ts, count(*) as versions from n group by 1, 2) "
        "select *, lead(first_ts) over (partition by user_id order by island) as until from i",
    "activity_rollup":
        "select user_id, cast(date_trunc('week', ts) as date) as week, max(cast(round(value * 100) as bigint)) as peak, "
        "cast(sum(cast(round(value * 100) as bigint)) as bigint) as total, count(*) as n from events group by 1, 2",
    "bridge_multi":
        f"with b as ({_TOKENS}) select p_partkey, p_brand from part where p_partkey in (select p_partkey from b where label = 'small') "
        "and p_partkey in (select p_partkey from b where label in ('ring', 'gear', 'bolt')) "
        "and p_partkey not in (select p_partkey from b where label = 'bolt')",
    "page_chain":
        "with g as (select c_mktsegment as chain, c_custkey // 500 as page, min(c_custkey) as first_appid, max(c_custkey) as last_appid, "
        "  cast(count(*) as integer) as n_apps from customer group by 1, 2), "
        "p as (select chain, first_appid, last_appid, n_apps, page * 500 - 1 as start, page < (select max(c_custkey) // 500 from customer) as more from g), "
        "n as (select *, lag(last_appid) over w as p_last, lag(more) over w as p_more, lead(last_appid) over w as n_last from p "
        "  window w as (partition by chain order by last_appid)) "
        "select chain, first_appid, last_appid, n_apps, start, case when least(first_appid, start + 1) <= p_last then 'overlap' "
        "when p_last is not null and start <> p_last then 'gap' when p_last is not null and not p_more then 'after_end' "
        "when n_last is null and more then 'unended' else 'ok' end as status from n",
    "rescued_nested":
        "select event_id, cast(1 as integer) as a, event_type as extra, '[' || event_id || ']' as b from events",
    "table_swap": "select event_id, user_id from events where ts < timestamp '2024-01-10'",
    "table_stream":
        "select event_id, user_id, value, date_trunc('hour', ts) as snapshot_hour, cast(ts as date) as snapshot_date from events",
    "flatten_nested":
        "select cast(event_id as integer) as appid, case when value >= 50 then 'EUR' end as currency, "
        "case when value >= 50 then cast(round(value * 100) as bigint) + 1 else -1 end as initial_price, "
        "case when value >= 50 then cast(round(value * 100) as bigint) else -1 end as final_price, event_type || ', Indie, too' as genres, "
        "'' as categories, value < 20 as coming_soon, strftime(ts, '%Y') as release_date, cast(1 as integer) as n_developers from events",
    "daily_run":
        "select cast(user_id as integer) as appid, cast(ts as date) as extracted_date, cast(round(value * 100) as bigint) / 100 as final_price, "
        "lead(ts) over (partition by user_id order by ts, value, event_id) is null as is_current, event_id / 100 as initial_price, "
        f"user_id in (select c_custkey from customer) as listed from ({_PURCH}) p",
    "latest_per_key":
        "select * exclude (rn) from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) "
        "as rn from events) z where rn = 1",
    "price_as_of":
        f"select user_id, value, ts from ({_BUILD}) h where ts <= timestamp '2024-01-15 00:00:00' "
        "and (end_date is null or end_date > timestamp '2024-01-15 00:00:00')",
    "price_as_of_join":
        f"select v.event_id, v.user_id, v.ts, b.value from events v left join ({_BUILD}) b "
        "on v.user_id = b.user_id and b.start_date <= v.ts and (b.end_date is null or v.ts < b.end_date) "
        "where v.event_type = 'view'",
    "price_moves":
        f"select user_id, ts, round(value - prev, 2) as delta from (select user_id, ts, value, "
        f"lag(value) over (partition by user_id order by ts, event_id) as prev from ({_PURCH}) p) z "
        "where prev is not null and value < prev",
    "neighbours_hot": _neighbours(_HOT, "ts, event_id"),
    "neighbours_null_keys":
        _neighbours("cast(case when event_type <> 'view' then user_id end as bigint)", "ts, event_id"),
    "neighbours_text_version": _neighbours(_HOT, "strftime(ts, '%Y-%m-%d'), event_id"),
    "neighbours_tied": _neighbours("cast(0 as bigint)", "cast(ts as date), event_id"),
    "scd2_quarantine":
        "select user_id, event_id, ts as at, value from events where event_type = 'purchase' and value < 50",
    "scd2_mode_all": _BUILD,
    "scd2_stage":
        f"with l as (select * exclude (rn) from (select *, row_number() over (partition by user_id "
        f"order by ts desc, event_id desc) as rn from ({_PURCH}) p) z where rn = 1), "
        f"c as (select user_id as k, max(ts) as cur from ({_PURCH}) p where ts < timestamp '2024-01-10' group by 1) "
        "select l.*, user_id as merge_key from l left join c on k = user_id where k is null or ts > cur "
        "union all select l.*, -1 from l join c on k = user_id where ts > cur",
    "score_shift":
        f"select user_id, day, review_score, round(review_score - prev, 2) as shift, "
        f"abs(round(review_score - prev, 2)) >= 50.0 as alert from (select user_id, extracted_at_Date as day, "
        f"review_score, lag(review_score) over (partition by user_id order by extracted_at_Date) as prev "
        f"from ({_DAILY}) d) z where prev is not null",
    "peak_activity":
        "select user_id, date_trunc('hour', ts) as hour, max(value) as peak from events group by 1, 2",
    "activity_by_day":
        "select user_id, cast(ts as date) as day, max(cast(round(value * 100) as bigint)) as peak, avg(cast(round(value * 100) as bigint)) as mean, "
        "year(day) || '-' || lpad(cast(weekofyear(day) as varchar), 2, '0') as year_week, "
        "dayofweek(day) in (0, 6) as is_weekend from events group by user_id, cast(ts as date)",
    "activity_by_week":
        "select *, year(week) || '-' || lpad(cast(weekofyear(week) as varchar), 2, '0') as year_week, false as is_weekend "
        "from (select user_id, cast(date_trunc('week', ts) as date) as week, max(cast(round(value * 100) as bigint)) as peak, "
        "avg(cast(round(value * 100) as bigint)) as mean from events group by 1, 2) g",
    "activity_churn":
        "select user_id, day, n, coalesce(n <= 0.5 * prev, false) as fell, coalesce(nxt - day - 1, -1) as silent_days, "
        "coalesce(nxt - day - 1 >= 3, false) as lapsed from (select *, lag(n) over w as prev, lead(day) over w as nxt "
        "from (select user_id, cast(ts as date) as day, count(*) as n from events group by 1, 2) d "
        "window w as (partition by user_id order by day)) z",
    "as_of_text_tie":
        "select v.event_id, v.user_id, cast(cast(v.ts as date) as timestamp) as day, coalesce((select arg_max(p.value, "
        "cast(p.ts as date)::varchar || lpad(p.event_id::varchar, 12, '0')) from events p where p.event_type = 'purchase' "
        "and p.user_id = v.user_id and cast(p.ts as date) <= cast(v.ts as date)), -1) as value "
        "from events v where v.event_type = 'view'",
    "anti_single":
        "select c_custkey from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey "
        "and o.o_orderdate >= timestamp '2001-01-01')",
    "anti_composite":
        "select e.user_id, e.event_id from events e where not exists (select 1 from events o "
        "where o.ts < timestamp '2024-01-03' and o.user_id = e.user_id and o.event_type = e.event_type)",
    "changed_keys":
        f"with n as ({_SNAP_ALL}), o as ({_SNAP_BEFORE.format(t='2024-01-30')}) "
        "select n.user_id, n.lm from n join o on n.user_id = o.user_id where n.lm != o.lm",
    "pending_worklist":
        f"with n as ({_SNAP_ALL}), o as ({_SNAP_BEFORE.format(t='2024-01-29')}), "
        "chg as (select n.user_id, n.lm from n join o on n.user_id = o.user_id where n.lm != o.lm), "
        "det as (select user_id, ts as lm from events where event_type = 'purchase' and value >= 100.0), "
        "pend as (select c.user_id, c.lm, 'changed' as why, 1 as prio from chg c where not exists "
        "  (select 1 from det d where d.user_id = c.user_id and d.lm = c.lm) "
        "  union all "
        "  select n.user_id, n.lm, 'new' as why, 0 as prio from n where not exists "
        "  (select 1 from det d where d.user_id = n.user_id)) "
        "select user_id, lm, why from (select *, row_number() over (partition by user_id order by lm desc, prio desc) "
        "as rn from pend) z where rn = 1",
    "outcome_counts": f"select feed, outcome, count(*) as n from ({_FULL}) r group by 1, 2",
    "outcome_statuses":
        f"select feed, case when status is null then (case when feed = 'activity' then 'retry' else 'error' end) "
        "when status = 200 then (case when feed = 'activity' then 'drop' else 'error' end) "
        "when status in (420, 429) then 'retry' when status = 403 and feed != 'activity' then 'retry' "
        f"else 'drop' end as outcome, count(*) as n from ({_RAW}) r group by 1, 2",
    "normalize_activity":
        "select cast(user_id as integer) as appid, case when h < 9 then 0 else event_id + 3000000000 end as player_count, "
        f"ts as extracted_at from ({_FULL}) r where feed = 'activity' and outcome = 'ok'",
    "normalize_details":
        "select cast(user_id as integer) as appid, cast(cast(ts as date) as timestamp) as extracted_at, false as is_free, "
        "cents as final_price, event_type as genre, ts as extracted_at_game "
        f"from ({_FULL}) r where feed = 'details' and outcome = 'ok'",
    "normalize_reviews":
        "select cast(user_id as integer) as appid, case when h >= 12 then 8 else -1 end as review_score, "
        "case when h >= 12 then event_type end as review_score_desc, case when h >= 12 then cents else -1 end as total_positive, "
        "cast(case when h >= 12 then 1 else -1 end as bigint) as total_negative, case when h >= 12 then cents + 1 else -1 end as total_reviews, "
        f"ts as extracted_at from ({_FULL}) r where feed = 'reviews' and outcome = 'ok'",
    "retry_by_feed":
        "select key, day, feed, outcome, n from (select user_id as key, cast(ts as date) as day, feed, count(*) as n, "
        "case when max(case when outcome = 'ok' then 1 else 0 end) = 1 then 'ok' else arg_max(outcome, event_id) end as outcome "
        f"from ({_FULL}) r group by 1, 2, 3) g where outcome = 'retry' and "
        "ceil(n / case feed when 'activity' then 5.0 when 'reviews' then 3.0 else 1.0 end) <= 3",
    "retry_worklist":
        "with a as (select user_id, cast(ts as date) as day, event_id, case event_type when 'purchase' then 'ok' "
        "  when 'error' then 'drop' else 'retry' end as outcome from events), "
        "g as (select user_id, day, count(*) as n, max(case when outcome = 'ok' then 1 else 0 end) as any_ok, "
        "  arg_max(outcome, event_id) as last_outcome from a group by user_id, day) "
        "select user_id, day, last_outcome as outcome, n from g where any_ok = 0 and last_outcome = 'retry' and n <= 3",
    "page_flatten":
        "select cast(c_custkey as integer) as appid, c_name as name, cast(round(c_acctbal * 100) as bigint) "
        "as last_modified, cast(c_nationkey as bigint) as price_change_number from customer",
    "rescued_rows":
        "select event_id, user_id, event_type, value, ts, props as rescued_props from events",
    "iso_timestamps":
        "select event_id, case when value < 50 then date_trunc('second', ts) else ts end as extracted_at, true as clean from events",
    "rescued_types":
        "select event_id, case when event_type not in ('view', 'click') then cast(user_id as integer) else -1 end as amount, "
        "cast(user_id as integer) as k, case event_type when 'view' then 'n/a' when 'click' then '3000000000' end as rescued_amount, "
        "event_type as rescued_extra from events",
    "rescued_malformed":
        "select case when event_type <> 'error' then event_id else -1 end as event_id, "
        "case when event_type not in ('view', 'click', 'error') then cast(user_id as integer) else -1 end as amount, "
        "case when event_type = 'error' then rtrim(substr('{\"event_id\": ' || event_id || ', \"amount\": ' || user_id || "
        "', \"inner\": {\"k\": ' || user_id || ', \"extra\": \"error\"}}', 1, 40)) end as malformed, "
        "event_type = 'error' as has_file from events",
    "stream_snapshot":
        "select event_id, user_id, value, date_trunc('hour', ts) as snapshot_hour, cast(ts as date) as snapshot_date "
        "from events",
}
ORACLES["pending_bucketed"] = ORACLES["pending_worklist"]
