"""The registered queries once more, as SQL for a second engine to check against."""

from __future__ import annotations

from .stations import WINDOW

# Fixed values, written out here so that the check does not share them with what it checks:
# score curves (metric, kind, level, spread) and metrics (id, name, parent, compute type, scale).
_CURVES = [
    ("AvailabilityMetric", "percent", None, None),
    ("GapCountMetric", "above", 0.00274, 0.992),
    ("MassPositionMetric", "above", 3.52, 10.79),
    ("TimingQualityMetric", "percent", None, None),
    ("DeadChannelMetric:4-8", "fraction", None, None),
    ("CoherencePBM:4-8", "below", 1.0, 0.0377),
    ("CoherencePBM:18-22", "below", 0.99, 0.12),
    ("CoherencePBM:90-110", "below", 0.93, 0.0337),
    ("CoherencePBM:200-500", "below", 0.83, 0.346),
    ("DifferencePBM:4-8", "away", 0.01, 0.348),
    ("DifferencePBM:18-22", "away", 0.01, 1.17),
    ("DifferencePBM:90-110", "away", 0.04, 4.66),
    ("DifferencePBM:200-500", "away", 0.03, 5.97),
    ("StationDeviationMetric:4-8", "away", 0.11, 3.32),
    ("StationDeviationMetric:18-22", "away", 0.17, 2.57),
    ("StationDeviationMetric:90-110", "away", 0.02, 2.88),
    ("StationDeviationMetric:200-500", "away", 0.07, 2.9),
    ("NLNMDeviationMetric:4-8", "above", 3.33, 12.53),
    ("NLNMDeviationMetric:18-22", "above", 13.41, 12.64),
    ("NLNMDeviationMetric:90-110", "above", 13.57, 14.79),
    ("NLNMDeviationMetric:200-500", "above", 20.74, 15.09),
    ("CalibrationMetric", "age", None, None),
    ("MeanError", "error", None, None),
]
_METRICS = [
    (1, "AvailabilityMetric", None, 1, 90.0),
    (2, "GapCountMetric", None, 3, 1.0),
    (3, "MassPositionMetric", None, 1, 30.0),
    (4, "TimingQualityMetric", None, 1, 95.0),
    (5, "DeadChannelMetric:4-8", 25, 1, 1.0),
    (6, "CoherencePBM:4-8", 25, 1, 1.0),
    (7, "CoherencePBM:18-22", 6, 1, 1.0),
    (8, "CoherencePBM:90-110", 7, 1, 1.0),
    (9, "CoherencePBM:200-500", 8, 1, 1.0),
    (10, "DifferencePBM:4-8", 25, 1, 1.0),
    (11, "DifferencePBM:18-22", 10, 1, -1.0),
    (12, "DifferencePBM:90-110", 11, 1, 10.0),
    (13, "DifferencePBM:200-500", 12, 1, -10.0),
    (14, "StationDeviationMetric:4-8", 25, 1, 5.0),
    (15, "StationDeviationMetric:18-22", 14, 1, -5.0),
    (16, "StationDeviationMetric:90-110", 15, 1, 5.0),
    (17, "StationDeviationMetric:200-500", 16, 1, 5.0),
    (18, "NLNMDeviationMetric:4-8", 25, 1, 60.0),
    (19, "NLNMDeviationMetric:18-22", 18, 1, 60.0),
    (20, "NLNMDeviationMetric:90-110", 19, 1, 60.0),
    (21, "NLNMDeviationMetric:200-500", 20, 1, 60.0),
    (22, "CalibrationMetric", None, 5, 1.0),
    (23, "MeanError", None, 3, 0.05),
    (24, "DayMeanMetric", None, 2, 1.0),
    (25, "ParentMetric", None, 4, 1.0),
    (26, "CalMeanMetric", None, 6, 1.0),
    (27, "NoneMetric", None, 7, 1.0),
    (28, "UnscoredMetric", None, 1, 1.0),
]


def _num(value: str, digits: int) -> str:
    wide = f"cast(printf('%.14e', cast({value} as double)) as decimal(38,22))"
    return f"cast(round({wide}, {digits}) as double)"


def _jd(day: str) -> str:
    return f"cast(date_diff('day', date '1970-01-01', {day}) + 2440588 as integer)"


def _day(julian: str) -> str:
    return f"cast(date '1970-01-01' + cast({julian} - 2440588 as integer) as date)"


def _score(value: str, name: str) -> str:
    formulas = {
        "percent": "x",
        "fraction": "x*100",
        "above": "100e0 - (15*(x - {a}e0))/{b}e0",
        "below": "100e0 - (15*({a}e0 - x))/{b}e0",
        "away": "100e0 - (15*(abs(x) - {a}e0))/{b}e0",
        "age": "100e0 - 10*power(x/365, 2)",
        "error": "100e0 - 500*x",
    }
    branches = []
    for metric, curve, level, spread in _CURVES:
        formula = formulas[curve].format(a=level, b=spread).replace("x", f"({value})")
        branches.append(f"when '{metric}' then {formula}")
    raw = f"case {name} {' '.join(branches)} end"
    return f"(case when {raw} >= 100 then 100e0 when {raw} <= 0 then 0e0 else {raw} end)"


def _metric_rows() -> str:
    rows = []
    for place, name, parent, kind, scale in _METRICS:
        up = "null" if parent is None else parent
        rows.append(f"({place}, '{name}', cast({up} as integer), {kind}, {scale}e0)")
    return ", ".join(rows)


_ORDER = "l_orderkey desc, l_linenumber desc, l_extendedprice desc, hash desc"

_BASE = f"""
with recursive metric(id, name, parent, kind, scale) as (values {_metric_rows()}),
grp as (
  select n_nationkey + 1 as id, n_name as name, 1 as kind from nation
  union all select 1001 + r_regionkey, r_name, 4 from region),
station as (
  select cast(s_suppkey + 1 as integer) as id, s_nationkey + 1 as network,
         'S' || s_suppkey as name, n_name as network_name, n_regionkey + 1001 as region
  from supplier join nation on s_nationkey = n_nationkey),
tie as (
  select network as gid, id as sid from station where id % 10 <> 0
  union all select region, id from station where id % 10 <> 0),
sensor as (
  select (s.id - 1)*2 + i + 1 as id, s.id as sid, case i when 0 then '' else '10' end as location
  from station s, range(2) t(i)),
channel as (
  select cast((s.id - 1)*3 + i + 1 as integer) as id, s.id as sensor, sid, location,
         case i when 0 then 'BHZ' when 1 then 'BH1' else 'BH2' end as name,
         ((s.id - 1)*3 + i + 1) % 10 = 0 as ignored
  from sensor s, range(3) t(i)),
path as (
  select c.id as ch, st.network_name as network, st.name as station, c.location,
         c.name as channel, c.sid, c.ignored
  from channel c join station st on st.id = c.sid),
raw as (
  select cast((l_suppkey*2 + l_linenumber % 2)*3 + l_partkey % 3 + 1 as integer) as ch,
         cast(l_shipdate as date) as day, {_jd("cast(l_shipdate as date)")} as date,
         m.id as metric_id, m.name as metric, m.kind,
         (l_discount*10 + l_tax) * m.scale as value,
         md5(l_orderkey || '|' || l_linenumber || '|' || cast(l_extendedprice as decimal(12,2)))
           as hash,
         l_orderkey, l_linenumber, l_extendedprice, l_returnflag, l_linestatus
  from lineitem join metric m on m.id = l_partkey % 28 + 1),
named as (select raw.*, network, station, location, channel, sid from raw join path using (ch)),
latest as (
  select * from named
  qualify row_number() over (partition by metric_id, date, ch order by {_ORDER}) = 1),
fact as (select * from latest where kind <> 5),
sfact as (select * from latest where kind = 5),
half as (
  select * from named
  qualify row_number() over (
    partition by metric_id, date, ch order by l_linestatus = 'O' desc, {_ORDER}) = 1),
listing as (
  select cast(day as varchar) as date, network, station, location, channel, metric,
         printf('%.15g', value) as value, hash
  from fact),
other as (
  select * exclude (hash), case when jd % 7 = 0 then md5('x') else hash end as hash
  from (select *, {_jd("cast(date as date)")} as jd from listing)
  where jd % 11 <> 0),
missing as (
  select s.* from listing s where not exists (
    select 1 from other d
    where s.date = d.date and s.network = d.network and s.station = d.station
      and s.location = d.location and s.channel = d.channel and s.metric = d.metric
      and s.value = d.value and s.hash = d.hash)),
used as (
  select m.id, count(l.metric_id) as n_facts
  from metric m left join latest l on l.metric_id = m.id group by 1)
"""

_IN_WINDOW = f"day between date '{WINDOW[0]}' and date '{WINDOW[1]}'"


def _card(level: str, kind: int) -> str:
    owner = "sid" if level == "station" else "ch"
    digits = {("station", 1): 4, ("channel", 1): 2}.get((level, kind), 0)
    if kind == 5:
        value = f"cast({_jd(f'''date '{WINDOW[1]}' ''')} - max(date) as double)"
        source, window = "sfact", f"day <= date '{WINDOW[1]}'"
    else:
        value = _num("sum(value)/count(*)" if kind == 1 else "sum(value)", digits)
        source, window = "fact", _IN_WINDOW
    keep = "and not ignored" if level == "station" else ""
    return f"""{_BASE}
select id, metric, value, {_num(_score("value", "metric"), 6)} as score from (
  select f.{owner} as id, metric, {value} as value
  from {source} f join path p on p.ch = f.ch where {window} and kind = {kind} {keep}
  group by all)"""


_RECORDS = f"""
select cast(id as varchar) || ',' || text || ',' ||
  coalesce(case when score is not null then printf('%.15g', score) end, 'n') as record
from (
  select *, {_score("value", "metric")} as score from (
    select f.sid as id, metric, {_num("sum(value)/count(*)", 4)} as value,
           cast(round(cast(printf('%.14e', sum(value)/count(*)) as decimal(38,22)), 4) as varchar)
             as text
    from fact f join path p on p.ch = f.ch where {_IN_WINDOW} and kind = 1 and not ignored
    group by all
    union all
    select f.sid, metric, {_num("sum(value)", 0)},
           cast(round(cast(printf('%.14e', sum(value)) as decimal(38,22)), 0) as varchar)
    from fact f join path p on p.ch = f.ch where {_IN_WINDOW} and kind = 3 and not ignored
    group by all
    union all
    select f.sid, metric, cast({_jd(f"date '{WINDOW[1]}'")} - max(date) as double),
           ({_jd(f"date '{WINDOW[1]}'")} - max(date)) || '.0000'
    from sfact f join path p on p.ch = f.ch
    where day <= date '{WINDOW[1]}' and not ignored group by all))
"""

_STATION_DAYS = f"""
  select f.sid as id, metric_id, kind, day,
         case kind when 1 then sum(value)/count(*) else sum(value) end as v
  from fact f join path p on p.ch = f.ch
  where {_IN_WINDOW} and kind in (1, 3) and not ignored group by f.sid, metric_id, kind, day
"""

_REQUESTS = """
  select distinct day + cast(i as integer) as date, network, station, location, channel, metric
  from named, range(2) t(i)
"""

_SOILED = """
  select case metric when 'ParentMetric' then cast(day as varchar)[1:5] || '02-30'
              else cast(day as varchar) end as date,
         network,
         case metric when 'DayMeanMetric' then network || '.' || station || '.' || metric
              else station end as station,
         location, channel, metric,
         case when value = 0 and l_returnflag = 'A' then 'NaN'
              when value = 0 and l_returnflag = 'N' then '1d'
              when value = 0 and l_returnflag = 'R' then ''
              else cast(value as varchar) end as value,
         case metric when 'NoneMetric' then hash || 'z' else hash end as hash
  from named
"""

_REJECTED = f"""
  select *, case when metric = 'ParentMetric' then 'bad day'
                 when value in ('NaN', '1d', '') then 'non numeric value'
                 when metric = 'NoneMetric' then 'bad hash'
                 when length(station) > 16 then 'name too long' end as problem
  from ({_SOILED})
"""


def _named_facts(where: str) -> str:
    return f"""{_BASE}
select day, network, station, location, channel, metric, {_num("value", 6)} as value, hash
from half where {where}"""


def _sizes(**tables: str) -> str:
    parts = [f"select '{name}' as table_name, count(*) as n from {sql}" for name, sql in tables.items()]
    return f"{_BASE}\n" + "\nunion all ".join(parts)


# Open measurements of channels or metrics that are not there.
_FAULTY = """
  select case metric_id when 2 then metric_id + 1000000 else metric_id end as metric_id, date,
         ch + case metric_id when 1 then 2000000 when 3 then 1000000 else 0 end as ch
  from raw where l_linestatus = 'O' and kind <> 5
"""
_KEPT_NETWORK = "network_name not like 'NATION_1%'"
_KEPT_PATH = "network not like 'NATION_1%'"
_COHERENCE_BELOW = "('CoherencePBM:18-22', 'CoherencePBM:90-110', 'CoherencePBM:200-500')"

ORACLE_SQL: dict[str, str] = {
    "station_scorecard_avg": _card("station", 1),
    "station_scorecard_sum": _card("station", 3),
    "station_scorecard_caldays": _card("station", 5),
    "channel_scorecard_avg": _card("channel", 1),
    "channel_scorecard_sum": _card("channel", 3),
    "channel_scorecard_caldays": _card("channel", 5),
    "station_plot_daily": f"""{_BASE}
select id, metric_id as fkmetricid, day, {_num("v", 4)} as value from ({_STATION_DAYS})""",
    "channel_plot_daily": f"""{_BASE}
select ch as id, metric_id as fkmetricid, day, {_num("value", 4)} as value
from fact where {_IN_WINDOW} and kind in (1, 3)""",
    "compute_type_status": f"""{_BASE}
select name as metric,
  case when kind in (1, 3, 5) then 'data' when kind = 2 then '2' when kind = 6 then '6'
       else 'Error' end as channel_data,
  case when kind in (1, 3, 5) then 'data' when kind = 2 then '2' when kind = 6 then null
       else 'Error' end as station_data,
  case when kind in (1, 3) then 'data' when kind = 2 then '2' when kind = 5 then '5'
       when kind = 6 then '6' else 'Error' end as channel_plot,
  case when kind in (1, 3) then 'data' when kind = 2 then '2' when kind = 5 then '5'
       when kind = 6 then '6' else 'Error' end as station_plot,
  n_facts
from metric join used using (id)""",
    "list_channels": f"""{_BASE}
select id, 'C,' || id || ',' || name || ',' || location || ',' || sid as record
from channel where not ignored""",
    "list_stations": f"""{_BASE}
select st.id, 'S,' || st.id || ',' || network || ',' || st.name || ',' ||
  string_agg(cast(gid as varchar), ',' order by gid) as record
from station st join tie on tie.sid = st.id group by st.id, network, st.name""",
    "list_groups": f"""{_BASE}
select id, 'G,' || id || ',' || name || ',' || kind as record from grp""",
    "list_group_types": f"""{_BASE}
select kind as id, 'T,' || kind || ',' || case kind when 1 then 'Network Code' else 'Regions' end
  || ',' || string_agg(cast(id as varchar), ',' order by name, id) as record
from grp group by kind""",
    "list_metrics": f"""{_BASE}
select id, 'M,' || id || ',' || name as record from metric join used using (id)""",
    "date_bounds": f"""{_BASE}
select 'DS' as bound, 'DS,' || min(day) as record from raw
union all select 'DE', 'DE,' || max(day) from raw""",
    "metric_value_lookup": f"""{_BASE}
select r.date, r.network, r.station, r.location, r.channel, r.metric, {_num("f.value", 6)} as value
from ({_REQUESTS}) r left join fact f on f.day = r.date and f.network = r.network
  and f.station = r.station and f.location = r.location and f.channel = r.channel
  and f.metric = r.metric""",
    "digest_lookup": f"""{_BASE}
select r.date, r.network, r.station, r.location, r.channel, r.metric, f.hash
from ({_REQUESTS}) r left join fact f on f.day = r.date and f.network = r.network
  and f.station = r.station and f.location = r.location and f.channel = r.channel
  and f.metric = r.metric""",
    "has_any_hash": f"""{_BASE}
select r.*, exists (
  select 1 from fact f where f.network = r.network and f.station = r.station
    and f.location = r.location and f.channel = r.channel and f.metric = r.metric) as has_hash
from (select distinct network, station, case i when 0 then location
             when 1 then case location when '' then '10' else '' end end as location,
             channel, metric
      from named, range(2) t(i)) r""",
    "score_all_metrics": f"""{_BASE}
select ch as fkchannelid, date, metric, v as value, {_num(_score("v", "metric"), 6)} as score
from (select *, {_num("value", 4)} as v from fact)""",
    "numeric_text_check": r"""
select text, regexp_full_match(text,
    '\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*') as "numeric", count(*) as n
from (
  select case l_linenumber
    when 1 then cast(l_partkey as varchar) when 2 then ' ' || l_partkey || '. '
    when 3 then l_partkey || 'e-' || l_linenumber when 4 then '-.' || l_partkey
    when 5 then l_partkey || 'd' when 6 then '0x' || l_partkey
    else case l_returnflag when 'A' then 'NaN' when 'N' then 'Infinity' else '' end end as text
  from lineitem)
group by text""",
    "julian_roundtrip": f"""
select day, n, {_jd("day")} as julian, day as back from (
  select day, count(*) as n from (
    select cast(l_shipdate as date) as day from lineitem
    union all select cast(o_orderdate as date) from orders)
  group by day)""",
    "parse_day": """
select text, case when i < 2 then min(day) end as day, count(*) as n from (
  select i, cast(l_shipdate as date) as day, case i
    when 0 then strftime(l_shipdate, '%Y-%m-%d') when 1 then strftime(l_shipdate, '%Y-%j')
    when 2 then strftime(l_shipdate, '%Y%m%d') when 3 then strftime(l_shipdate, '%Y-02-30')
    else strftime(l_shipdate, '%Y-367') end as text
  from lineitem, range(5) t(i))
group by i, text""",
    "day_spine": f"""
select cast(d.day as date) as day, coalesce(n, 0) as n
from generate_series(date '{WINDOW[0]}', date '{WINDOW[1]}', interval 1 day) d(day)
left join (select cast(l_shipdate as date) as day, count(*) as n from lineitem group by 1) s
  on s.day = cast(d.day as date)""",
    "ingest_upsert_numeric": _named_facts("kind <> 5"),
    "ingest_upsert_string": _named_facts("kind = 5"),
    "ingest_new_dimensions": f"""{_BASE}
select distinct level, name from (
  select 'group' as level, r_name || '.4' as name from region
  union all select 'group', network || '.1' from named
  union all select 'station', network || '.' || station from named
  union all select 'sensor', station || '.' || location from named
  union all select 'channel', network || '.' || station || '.' || location || '.' || channel
    from named
  union all select 'metric', metric || '.1' from named
  union all select 'date', date || '.' || day from named)""",
    "ingest_ids": f"""{_BASE}
select table_name, n, n as ids, cast(1 as bigint) as lowest, n as highest from (
  select 'station' as table_name, count(distinct station) as n from named
  union all select 'sensor', count(distinct (station, location)) from named
  union all select 'channel', count(distinct ch) from named
  union all select 'metric', count(distinct metric) from named
  union all select 'hash', count(distinct hash) from named)""",
    "ingest_ties": f"""{_BASE}
select distinct group_name, station from (
  select g.name as group_name, st.name as station
  from tie join grp g on g.id = gid join station st on st.id = sid
  union all select network, station from named where l_linestatus = 'O')""",
    "ingest_dates": f"""{_BASE}
select distinct date as pkdateid, day as date from raw""",
    "ingest_quarantine": f"""{_BASE}
select * from ({_REJECTED}) where problem is not null""",
    "ingest_error_log": f"""{_BASE}
select 'Non Numeric value: Nothing Inserted ' || date || ' ' || location || ' ' || channel || ' '
  || station || ' ' || metric || ' ' || value as errormessage, count(*) as n
from ({_REJECTED}) where problem = 'non numeric value' group by 1""",
    "hash_listing_wildcard": f"""{_BASE}
select * from listing
where channel like 'BH_' and metric like 'Coherence%' and network like 'NATION_1%'""",
    "sync_diff": f"{_BASE}\nselect * from missing",
    "sync_diff_stored": f"""{_BASE},
held as (
  select * from named where l_linestatus = 'F' or hash[1:1] < '5'
  qualify row_number() over (
    partition by metric_id, date, ch order by l_linestatus = 'O' desc, {_ORDER}) = 1),
held_listing as (
  select cast(day as varchar) as date, network, station, location, channel, metric,
         printf('%.15g', value) as value, hash
  from held where kind <> 5)
select s.* from listing s where not exists (
  select 1 from held_listing d
  where s.date = d.date and s.network = d.network and s.station = d.station
    and s.location = d.location and s.channel = d.channel and s.metric = d.metric
    and s.value = d.value and s.hash = d.hash)""",
    "sync_days": f"""{_BASE}
select cast(d.day as date) as day, coalesce(n, 0) as differences
from generate_series(date '{WINDOW[0]}', date '{WINDOW[1]}', interval 1 day) d(day)
left join (select cast(date as date) as day, count(*) as n from missing group by 1) m
  on m.day = cast(d.day as date)""",
    "sync_closure": f"""{_BASE}
select 'before' as moment, count(*) as n from missing
union all select 'after', cast(0 as bigint)""",
    "check_unique": f"""{_BASE}
select 'metricdata' as table_name, 'fkmetricid,date,fkchannelid' as columns,
  metric_id || ',' || date || ',' || ch as key, count(*) as copies
from raw where kind <> 5 group by metric_id, date, ch having count(*) > 1
union all
select 'metricstringdata', 'fkmetricid,date,fkchannelid', metric_id || ',' || date || ',' || ch,
  count(*)
from raw where kind = 5 group by metric_id, date, ch having count(*) > 1
union all
select 'date', 'date', cast(cast(date_trunc('month', day) as date) as varchar), count(*)
from (select distinct day from raw) group by date_trunc('month', day) having count(*) > 1""",
    "check_foreign_keys": f"""{_BASE}
select 'metricdata' as child, 'fkchannelid' as column_name, 'channel' as parent, f.ch as key,
  count(*) as n
from fact f join channel c on c.id = f.ch where c.ignored group by f.ch
union all
select 'metricstringdata', 'fkchannelid', 'channel', f.ch, count(*)
from sfact f join channel c on c.id = f.ch where c.ignored group by f.ch
union all
select 'metricdata', 'fkmetricid', 'metric', metric_id, count(*)
from fact where metric like 'CoherencePBM%' group by metric_id
union all
select 'stationgrouptie', 'fkgroupid', 'group', gid, count(*)
from tie where gid > 1000 group by gid""",
    "check_batch_unique": f"""{_BASE},
batch as ({_FAULTY})
select 'metricdata' as table_name, 'fkmetricid,date,fkchannelid' as columns,
  metric_id || ',' || date || ',' || ch as key, count(*) as copies
from batch group by metric_id, date, ch having count(*) > 1
union all
select 'station', 'fknetworkid,name', network || ',' || name, cast(2 as bigint)
from station where id % 2 = 0""",
    "check_batch_references": f"""{_BASE},
batch as ({_FAULTY})
select 'channel' as child, 'fksensorid' as column_name, 'sensor' as parent,
  cast(sensor + 1000000 as integer) as key, count(*) as n
from channel where ignored group by sensor
union all
select 'metricdata', 'fkmetricid', 'metric', cast(metric_id as integer), count(*)
from batch where metric_id > 1000000 group by metric_id
union all
select 'metricdata', 'fkchannelid', 'channel', cast(ch as integer), count(*)
from batch where ch > 1000000
  and not exists (select 1 from channel c where c.ignored and c.id + 1000000 = batch.ch)
group by ch""",
    "check_not_null": f"""{_BASE}
select * from (
  select 'metricdata' as table_name, 'value' as column_name, count(*) as n
  from fact where value = 0
  union all select 'sensor', 'location', count(*) from sensor where location = '')
where n > 0""",
    "check_lengths": f"""{_BASE}
select * from (
  select 'channel' as table_name, 'name' as column_name, count(*) as n from path
  where length(network || '.' || station || '.' || location || '.' || channel) > 16)
where n > 0""",
    "cascade_delete_network": _sizes(
        group="grp where kind <> 4 and name not like 'NATION_1%'",
        stationgrouptie=f"tie join station st on st.id = sid where gid < 1000 and {_KEPT_NETWORK}",
        station=f"station where {_KEPT_NETWORK}",
        sensor=f"sensor join station st on st.id = sid where {_KEPT_NETWORK}",
        channel=f"path where {_KEPT_PATH}",
        metric="metric",
        metricdata=f"fact where {_KEPT_PATH}",
        metricstringdata=f"sfact where {_KEPT_PATH}",
    ),
    "cascade_delete_metric": _sizes(
        group="grp",
        stationgrouptie="tie",
        station="station",
        sensor="sensor",
        channel="channel",
        metric=f"metric where name not in {_COHERENCE_BELOW}",
        metricdata=f"fact where metric not in {_COHERENCE_BELOW}",
        metricstringdata="sfact",
    ),
    "store_delete": _sizes(
        group="grp where kind <> 4 and name not like 'NATION_1%'",
        stationgrouptie=f"tie join station st on st.id = sid where gid < 1000 and {_KEPT_NETWORK}",
        station=f"station where {_KEPT_NETWORK}",
        sensor=f"sensor join station st on st.id = sid where {_KEPT_NETWORK}",
        channel=f"path where {_KEPT_PATH}",
        metric=f"metric where name not in {_COHERENCE_BELOW}",
        metricdata=f"fact where {_KEPT_PATH} and metric not in {_COHERENCE_BELOW}",
        metricstringdata=f"sfact where {_KEPT_PATH}",
    ),
    "cascade_blockers": f"""{_BASE}
select 'stationgrouptie' as child, 'fkstationid' as column_name, 'station' as parent, sid as key,
  count(*) as n
from tie where gid > 1000 group by sid""",
    "metric_descendants": f"""{_BASE},
below(ancestor, id, depth) as (
  select id, id, 0 from metric
  union all select b.ancestor, m.id, b.depth + 1 from below b join metric m on m.parent = b.id)
select ancestor, count(*) as metrics, max(depth) as depth,
  cast(sum(n_facts) as bigint) as n_facts
from below join used using (id) group by ancestor""",
    "window_rollup": f"""{_BASE}
select f.sid as id, metric_id as fkmetricid, {_num("sum(value)", 4)} as total,
  count(*) as readings
from fact f join path p on p.ch = f.ch where {_IN_WINDOW} and not ignored
group by f.sid, metric_id""",
    "stored_rollup": f"""{_BASE},
arrived as (
  select *, case l_linestatus when 'O' then 1 else 0 end as batch from named where kind <> 5
  union all
  select * replace (value * 2 as value), 2 from named
  where kind <> 5 and l_linestatus = 'O' and hash[1:1] < '5'),
held as (
  select * from arrived
  qualify row_number() over (partition by metric_id, date, ch order by batch desc, {_ORDER}) = 1)
select f.sid as id, metric_id as fkmetricid, {_num("sum(value)", 4)} as total,
  count(*) as readings
from held f join path p on p.ch = f.ch
where day between date '1995-03-05' and date '2001-09-17' and not ignored
group by f.sid, metric_id""",
    "csv_roundtrip": f"{_BASE}\nselect * from listing",
    "text_records": f"{_BASE}\n{_RECORDS}",
    "station_plot_records": f"""{_BASE}
select day || ',' || cast(round(cast(printf('%.14e', v) as decimal(38,22)), 4) as varchar)
  as record, count(*) as n
from ({_STATION_DAYS}) group by 1""",
}

# The store ends up with what one ingest in memory gives; quoted fields come back as they went;
# of repeated keys the last row counts.
ORACLE_SQL["store_ingest"] = f"""{_BASE}
select day, network, station, location, channel, metric, {_num("value", 6)} as value, hash,
  case kind when 5 then 'metricstringdata' else 'metricdata' end as fact_table
from half"""
ORACLE_SQL["csv_roundtrip_quoted"] = f"""{_BASE}
select date, network, station || ',"x", ' as station, ' ' || location as location, channel, metric,
  value, hash from listing"""
ORACLE_SQL["csv_roundtrip_lines"] = f"""{_BASE}
select date, network, station || chr(10) || '"x",' || chr(10) || chr(10) as station,
  chr(13) || chr(10) || location as location, channel, metric, value, hash from listing"""
ORACLE_SQL["sync_diff_duplicates"] = ORACLE_SQL["sync_diff"]
