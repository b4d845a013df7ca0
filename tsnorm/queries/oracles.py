"""DuckDB SQL that gives the rows of each query."""

from __future__ import annotations

_HOUR = "interval '1 hour'"
_LINE_ORDER = "l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc"
_TYPES = ["click", "error", "purchase", "signup", "view"]
# milliseconds, ties to even
_MS = """make_timestamp((epoch_us(ts) // 1000 + case
    when epoch_us(ts) % 1000 > 500 or (epoch_us(ts) % 1000 = 500 and (epoch_us(ts) // 1000) % 2 = 1)
    then 1 else 0 end) * 1000)"""
# last line item of each return flag and day
_LAST_LINE = f"""(select l_returnflag as instrument, l_shipdate as ts, l_quantity as value from lineitem
    qualify row_number() over (partition by l_returnflag, l_shipdate order by {_LINE_ORDER}) = 1)"""


def _buckets(period: str, aggregates: str, source: str = "events", value: str = "value") -> str:
    return f"""select event_type as instrument, time_bucket({period}, ts) as bucket, {aggregates}
        from (select event_type, ts, {value} as value from {source}) group by all"""


def _grid(period: str, source: str = "events") -> str:
    return f"""select unnest(generate_series(
        (select time_bucket({period}, min(ts)) from {source}), (select max(ts) from {source}), {period})) as t"""


def _pivot(columns: list[tuple[str, str, str]], name: str = "instrument") -> str:
    return ", ".join(f"coalesce(max(case when {name} = '{i}' then {v} end), 0.0) as {out}" for out, i, v in columns)


_SPINE = f"""select t, instrument from ({_grid(_HOUR)}) cross join (select distinct event_type as instrument from events)"""
_CELLS = f"""select s.instrument, s.t as "timestamp", b.m as mean from ({_SPINE}) s
    left join ({_buckets(_HOUR, "avg(value) as m")}) b on b.instrument = s.instrument and b.bucket = s.t"""
_STATS = {
    "mean": "round(avg(value), 8) as mean",
    "min": "round(min(value), 8) as min",
    "max": "round(max(value), 8) as max",
    "std": "round(stddev_samp(value), 8) as std",
    "val": "round(arg_min(value, ts), 8) as val",
}
_FILTERED = """(select event_type, ts, value from events where value >= 5 and value <= 60
    and ts >= timestamp '2024-01-03 07:45:00' and ts <= timestamp '2024-01-20 23:59:59.999999')"""
_SUMMARY_GAPS = """select instrument, min(gap) as gap from (
    select event_type as instrument,
           epoch_us(ts) - lag(epoch_us(ts)) over (partition by event_type order by ts) as gap
    from events) where gap > 0 group by instrument"""
_LAST_ORDER = """select * from orders qualify row_number() over (partition by o_orderdate order by o_orderkey desc) = 1"""

_FILE_ROWS = """(select event_type, date_trunc('millisecond', ts) as ts, max(value) as value from events group by all)"""
_FILE_READINGS = f"""(select event_type, ts, value from {_FILE_ROWS} where second(ts) not in (7, 9) and value is not null)"""

ORACLES = {
    "normalize_wide": f"""
with b as ({_buckets(_HOUR, "avg(value) as v")}),
a as (select s.t, s.instrument, coalesce(b.v, 0.0) as v from ({_SPINE}) s
      asof left join b on s.instrument = b.instrument and s.t >= b.bucket)
select t as "timestamp", {_pivot([(f"value_{n}", n, "round(v, 8)") for n in _TYPES])} from a group by t""",
    "normalize_multi": f"""
with b as ({_buckets("interval '12 hours'", "arg_min(value, ts) as val, min(value) as mi, max(value) as ma, avg(value) as me, stddev_samp(value) as st")}),
s as (select t, instrument from ({_grid("interval '12 hours'")})
      cross join (select distinct event_type as instrument from events)),
a as (select s.t, s.instrument, b.val, b.mi, b.ma, b.me, b.st from s
      asof left join b on s.instrument = b.instrument and s.t >= b.bucket)
select t as "timestamp", {_pivot([(f"value_{n}_{o}", n, f"round({c}, 8)") for n in _TYPES
    for o, c in (("val", "val"), ("min", "mi"), ("max", "ma"), ("mean", "me"), ("std", "st"))])} from a group by t""",
    "normalize_gap_zero": f"""
with b as ({_buckets("interval '15 minutes'", "avg(value) as v")})
select s.instrument, s.t as "timestamp", round(coalesce(b.v, 0.0), 8) as mean
from (select t, instrument from ({_grid("interval '15 minutes'")})
      cross join (select distinct event_type as instrument from events)) s
left join b on s.instrument = b.instrument and s.t = b.bucket""",
    "normalize_filtered": f"""
with b as ({_buckets("interval '30 minutes'", "max(value) as v", _FILTERED)})
select s.instrument, s.t as "timestamp", coalesce(b.v, 0.0) as max
from (select t, instrument from ({_grid("interval '30 minutes'", _FILTERED)})
      cross join (select distinct event_type as instrument from {_FILTERED})) s
asof left join b on s.instrument = b.instrument and s.t >= b.bucket""",
    "normalize_default_period": f"""
with r as (select * from {_LAST_LINE}),
g as (select unnest(generate_series((select min(ts) from r), (select max(ts) from r), interval '1 day')) as t),
a as (select s.t, s.instrument, coalesce(r.value, 0.0) as v
      from (select t, instrument from g cross join (select distinct instrument from r)) s
      asof left join r on s.instrument = r.instrument and s.t >= r.ts)
select t as "timestamp", {_pivot([(f"value_{n}", n, "v") for n in "ANR"])} from a group by t""",
    "upsample_ffill": f"""
with d as (select event_type as instrument, time_bucket(interval '1 day', ts) + interval '90 minutes' as ts,
           avg(value) as v from events group by all),
s as (select t, instrument from ({_grid(_HOUR, "d")}) cross join (select distinct instrument from d))
select s.instrument, s.t as "timestamp", round(coalesce(d.v, 0.0), 8) as mean
from s asof left join d on s.instrument = d.instrument and s.t >= d.ts""",
    "batch_resample": """
with r as (select o_orderpriority as source_file, o_orderstatus as instrument, o_orderdate as ts, o_totalprice as value
    from orders qualify row_number() over (
        partition by o_orderpriority, o_orderstatus, o_orderdate order by o_orderkey desc) = 1),
b as (select source_file, instrument, make_timestamp(epoch_us(ts) - epoch_us(ts) % 604800000000) as bucket, avg(value) as v
      from r group by all),
e as (select source_file, min(ts) as lo, max(ts) as hi from r group by all),
g as (select source_file, unnest(generate_series(
        make_timestamp(epoch_us(lo) - epoch_us(lo) % 604800000000), hi, interval '7 days')) as t from e),
s as (select g.source_file, g.t, i.instrument from g
      join (select distinct source_file, instrument from r) i on i.source_file = g.source_file)
select s.source_file, s.instrument, s.t as "timestamp", round(coalesce(b.v, 0.0), 8) as mean
from s asof left join b on s.source_file = b.source_file and s.instrument = b.instrument and s.t >= b.bucket""",
    "archive_to_readings": f"""
select 'user_' || user_id || '_pv' as instrument, ts, arg_max(value, event_id) as value
from (select user_id, event_id, value, {_MS} as ts from events) group by user_id, ts""",
    "lenient_cast": """
select p_partkey, try_cast(cast(p_size as varchar) as double) as size_number,
    try_cast(substr(p_brand, 7, 9) as bigint) as brand_number, try_cast(p_name as double) as name_number,
    try_cast(p_size || 'f' as double) as suffixed_number from part""",
    "null_tokens": """
select p_partkey, case when p_type in ('PROMO', 'SMALL', 'LARGE') then null else p_name end as cell from part""",
    "parse_ts": "select event_id, ts, ts as ts_iso from events where event_type <> 'error'",
    "format_ts": """
select event_id, strftime(ts, '%m/%d/%Y %I:%M:%S %p') as am_pm, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as iso from events""",
    "round_ms": f"select event_id, {_MS} as ts from events",
    "floor_period": """
select event_id, time_bucket(interval '5 minutes', ts) as five_minutes,
    make_timestamp(epoch_us(ts) - epoch_us(ts) % 7000000) as seven_seconds from events""",
    "sanitize_name": "select o_orderkey, translate(o_orderpriority, ' -.', '___') as name from orders",
    "trend_name": """
select p_partkey, case when p_type = 'SMALL' then p_brand else p_name end as name from part""",
    "value_name": """
select p_partkey, 'value_' || case when p_type = 'SMALL' then p_brand else p_name end as name from part""",
    "unit_label": """
select p_partkey, p_name || case when p_type = 'SMALL' then ' (uStrain)' when p_type in ('LARGE', 'PROMO') then ''
    else ' (' || lower(p_type) || ')' end as label from part""",
    "elapsed_to_ts": """
select event_id, make_timestamp(epoch_us(ts) + cast(round(value * case event_type when 'click' then 1000
    when 'view' then 1000000 when 'error' then 60000000 when 'signup' then 3600000000 end) as bigint)) as ts
from events""",
    "wide_unpivot": """
select l_orderkey, l_shipdate, 'quantity' as instrument, l_quantity as value from lineitem
union all select l_orderkey, l_shipdate, 'price', l_extendedprice from lineitem
union all select l_orderkey, l_shipdate, 'tax', l_tax from lineitem""",
    "trend_unpivot": """
select o_orderkey, 0 as series, 'price' as instrument, o_orderdate as ts, o_totalprice as value from orders
union all select o_orderkey, 1, 'customer', o_orderdate, cast(o_custkey as double) from orders""",
    "value_query": """
select event_type as instrument, ts, value from events where value >= 10 and value <= 40 or not value < 80""",
    "time_range": """
select event_type as instrument, ts, value from events
where ts between timestamp '2024-01-05 06:30:00' and timestamp '2024-01-20 23:59:59.999999'""",
    "end_of_day": """
select o_orderkey, case when o_orderstatus = 'P' then o_orderdate + interval '1 hour'
    else o_orderdate + interval '1 day' - interval '1 microsecond' end as end_ts from orders""",
    "dedupe_last": f"select instrument, ts, value from {_LAST_LINE}",
    "dedupe_row_last": f"""
select l_returnflag, l_shipdate, l_quantity, l_extendedprice, l_discount from lineitem
qualify row_number() over (partition by l_returnflag, l_shipdate order by {_LINE_ORDER}, l_discount desc) = 1""",
    "tag_dimension": """
select cast(user_id as varchar) as tag_id,
    translate(arg_min(event_type || '-no.' || user_id, event_id), ' -.', '___') as instrument
from events where event_type <> 'error' group by user_id""",
    "tag_join": """
select translate(s_name, ' -.', '___') as instrument, l_shipdate as ts, l_quantity as value
from lineitem join supplier on s_suppkey = l_suppkey""",
    "append_series": f"""
with last as (select l_linenumber, l_shipdate, l_linestatus, l_quantity from lineitem
    qualify row_number() over (partition by l_linenumber, l_shipdate, l_linestatus order by {_LINE_ORDER}) = 1)
select 'line_' || l_linenumber as instrument, l_shipdate as ts, l_quantity as value from last where l_quantity > 10
qualify row_number() over (partition by l_linenumber, l_shipdate order by l_linestatus desc) = 1""",
    "replace_series": """
select o_orderpriority as instrument, o_orderdate as ts, o_totalprice as value from orders
where o_orderpriority not in ('1-URGENT', '2-HIGH')
union all
select case l_returnflag when 'A' then '1-URGENT' when 'N' then '2-HIGH' else 'returned' end, l_shipdate, l_quantity
from lineitem""",
    "archive_merge": f"""
with r as (select user_id, event_id, value, {_MS} as ts,
    case when event_type in ('view', 'click') then 0 when event_type = 'error' then 1 else 2 end as entry from events)
select 'user_' || user_id || '_pv' as instrument, ts, value from r
where user_id in (select user_id from events where event_type <> 'error')
qualify row_number() over (partition by user_id, ts order by entry desc, event_id desc) = 1""",
    "normalized_merge": f"""
with l as (select * from lineitem qualify row_number() over (partition by l_shipdate order by {_LINE_ORDER}) = 1),
o as ({_LAST_ORDER}),
r as (select 'quantity' as instrument, l_shipdate as ts, l_quantity as value, 0 as entry from l
    union all select 'price', l_shipdate, l_extendedprice, 0 from l
    union all select 'price', o_orderdate, o_totalprice, 1 from o
    union all select 'customer', o_orderdate, cast(o_custkey as double), 1 from o)
select instrument, ts, value from r qualify row_number() over (partition by instrument, ts order by entry desc) = 1""",
    "trend_merge": f"""
with l as (select * from lineitem qualify row_number() over (partition by l_shipdate order by {_LINE_ORDER}) = 1),
o as ({_LAST_ORDER}),
r as (select 'quantity' as instrument, l_shipdate as ts, l_quantity as value, 0 as entry from l
    union all select 'price', l_shipdate, l_extendedprice, 0 from l
    union all select 'price', o_orderdate, o_totalprice, 1 from o)
select instrument, ts, value from r qualify row_number() over (partition by instrument, ts order by entry desc) = 1""",
    "duplicate_names": """
select p_brand as source_file, p_name as name, count(*) as n from part group by all having count(*) > 1""",
    "shared_names": """
select p_name as name, count(distinct p_brand) as n_files from part group by all having count(distinct p_brand) > 1""",
    "quality_report": """
with r as (select event_type as source_file, user_id, value,
    case when value >= 5 then date_trunc('hour', ts) end as ts from events),
t as (select source_file, user_id, ts, count(*) as n from r group by all)
select r.source_file, count(*) as n_rows, count_if(ts is null) as bad_times, count_if(value > 90) as bad_values,
    any_value(d.duplicates) as duplicates
from r join (select source_file, sum(case when ts is null then 0 else n - 1 end)::bigint as duplicates from t group by all) d
    on d.source_file = r.source_file group by r.source_file""",
    "global_bounds": "select min(ts) as start_ts, max(ts) as end_ts from events",
    "sample_period": f"select instrument, gap as gap_us from ({_SUMMARY_GAPS})",
    "common_period": f"select min(gap) as period_us from ({_SUMMARY_GAPS})",
    "instrument_summary": f"""
select e.instrument, e.start_ts, e.end_ts, e.n, g.gap as period_us, e.n = 0 as is_empty from (
    select event_type as instrument, min(case when event_type <> 'error' then ts end) as start_ts,
        max(case when event_type <> 'error' then ts end) as end_ts, count_if(event_type <> 'error') as n
    from events group by 1) e
left join ({_SUMMARY_GAPS}) g on g.instrument = e.instrument and g.instrument <> 'error'""",
    "resample_mean": _buckets(_HOUR, _STATS["mean"]),
    "resample_min": _buckets(_HOUR, _STATS["min"]),
    "resample_max": _buckets(_HOUR, _STATS["max"]),
    "resample_std": _buckets(_HOUR, _STATS["std"]),
    "resample_first": _buckets(_HOUR, _STATS["val"]),
    "resample_multi": _buckets(_HOUR, ", ".join(_STATS.values())),
    "time_grid": f'select t as "timestamp" from ({_grid(_HOUR)})',
    "spine": f'select instrument, t as "timestamp" from ({_SPINE})',
    "asof_backward": """
select l.event_id, l.user_id, l.ts, l.value, r.ts as seen_ts, r.event_type as seen, r.value as seen_value
from (select * from events where event_type = 'purchase') l
asof left join (select * from events where event_type <> 'purchase') r on l.user_id = r.user_id and l.ts >= r.ts""",
    "locf": f"""
select instrument, "timestamp", round(last_value(mean ignore nulls) over (partition by instrument order by "timestamp"), 8) as mean
from ({_CELLS})""",
    "fill_zero": f"""select instrument, "timestamp", round(coalesce(mean, 0.0), 8) as mean from ({_CELLS})""",
    "wide_pivot": f"""
select bucket, {_pivot([(f"value_{n}", n, "round(v, 8)") for n in _TYPES])}
from ({_buckets(_HOUR, "avg(value) as v")}) group by bucket""",
    "sorted_wide": f"""
select bucket, {_pivot([(f"value_{n}_{s}", n, c) for n in _TYPES for s, c in (("min", "mi"), ("max", "ma"))])}
from ({_buckets("interval '1 day'", "min(value) as mi, max(value) as ma")}) group by bucket order by bucket""",
}

_STORED = """(select event_type as instrument, ts, value from events where value is not null and (event_type <> 'click' or value > 50)
    qualify row_number() over (partition by event_type, ts
        order by case when event_type = 'click' then 0 else event_id % 2 end desc, event_id desc) = 1)"""

ORACLES |= {
    "stored_series": f"select * from {_STORED}",
    "stored_summary": f"""
select instrument, min(ts) as start_ts, max(ts) as end_ts, count(*) as n, min(case when gap > 0 then gap end) as period_us
from (select *, epoch_us(ts) - lag(epoch_us(ts)) over (partition by instrument order by ts) as gap from {_STORED}) group by instrument""",
    "csv_records": "select doc_id, length(nullif(text, '')) as n_chars, md5(nullif(text, '')) as digest from documents",
    "archive_run": f"""
with b as ({_buckets(_HOUR, "max(value) as v", _FILE_READINGS)})
select 'tag_' || s.instrument as instrument, s.t as "timestamp", coalesce(b.v, 0.0) as max
from (select t, instrument from ({_grid(_HOUR, _FILE_READINGS)})
      cross join (select distinct event_type as instrument from {_FILE_READINGS})) s
asof left join b on s.instrument = b.instrument and s.t >= b.bucket""",
    "archive_report": f"""
select count(*) as n_rows, count(*) filter (second(ts) = 7) as bad_times, count(*) filter (second(ts) = 9) as bad_values,
    count(*) filter (second(ts) not in (7, 9) and value is not null) as kept, 1 as missing
from {_FILE_ROWS} where event_type in ('click', 'view', 'error')""",
    "batch_wide": "select source_file, \"timestamp\", 'value_' || instrument as name, mean from ("
    + ORACLES["batch_resample"].replace("from orders qualify", "from orders where o_orderpriority <> '5-LOW' or o_orderstatus <> 'P' qualify") + ")",
}
