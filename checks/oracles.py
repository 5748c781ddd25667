"""DuckDB SQL for the registered queries, stated from the rules and not from the Spark code."""

from __future__ import annotations

PINGS = """ev as (select * from events union all select * from events where event_id % 50 = 0),
pings as (
  select user_id as uid, event_id as request_id,
    1704092400000 + (epoch_us(ts) - 1704067200000000) // 120000 as r_timestamp,
    4e1 + ((event_id*7919) % 7)/1e2 + (cast(floor(value) as bigint)*2)/1e5 + (event_id % 400)/1e8 as latitude,
    -7.4e1 - ((event_id*104729) % 5)/1e2 - ((event_id % 499)*2)/1e5 - (event_id % 400)/1e8 as longitude,
    case when event_id % 97 = 0 then null when event_id % 11 = 0 then true else false end as too_freq_uid,
    case when event_id % 13 = 0 then 's' end as r_s_info,
    case when event_id % 5 < 3 then 94 when event_id % 5 = 3 then 95 else 90 end as sl_adjusted_confidence,
    case when user_id % 10 = 9 then 'gb' else 'us' end as country,
    case event_id % 4 when 0 then 'display' when 1 then 'display_dr' when 2 then 'euwest1' else 'exchange' end as "logType",
    2024 as y, 1 as m, 1 as d,
    cast(7 + ((epoch_us(ts) - 1704067200000000) // 120000) // 3600000 as int) as h,
    cast(user_id % 4 as int) as stage,
    case when event_id % 2 = 0 then 'fill' else 'nf' end as "isFilled",
    case event_id % 3 when 0 then 'pos' when 1 then 'rest' else 'tll' end as "confScore",
    cast(event_id % 6 as int) as proximity_mode, 'brand' || cast(event_id % 17 as varchar) as fp_brand,
    cast(event_id % 2 as int) as is_poly
  from ev)"""

RUN = "country, stage, y, m, d, h"
KEYS = '"logType", y, m, d, h, stage, "isFilled", "confScore"'
SEC = "round(r_timestamp / 5000.0, 0) * 5.0"
ELIGIBLE = f"""elig as (
  select *, {SEC} as sec from pings
  where too_freq_uid = false and r_s_info is null and sl_adjusted_confidence in (94, 95))"""
SENTINEL = "(too_freq_uid != false or r_s_info is not null) and sl_adjusted_confidence in (94, 95)"
PADDED = ", ".join(f"lpad(cast({c} as varchar), 2, '0') as {c}" for c in ("m", "d", "h"))
PADDED_KEYS = f'"logType", y, {PADDED}, stage, "isFilled", "confScore"'


def _miles(a: str, b: str) -> str:
    lat_a, long_a, lat_b, long_b = (
        f"radians(round({p}.{c}, 5))" for p in (a, b) for c in ("lat", "long")
    )
    chord = (
        f"(pow(sin(({lat_b} - {lat_a}) / 2), 2)"
        f" + cos({lat_a}) * cos({lat_b}) * pow(sin(({long_b} - {long_a}) / 2), 2))"
    )
    return f"(6373.0 * 2 * atan2(sqrt({chord}), sqrt(1 - {chord})) * 0.621371)"


def _motion(source: str, run: str) -> str:
    """Buckets of ``source``, numbered along the trajectory; neighbours by self-join on the
    number; then segments, speeds and angles."""
    k = [c.strip() for c in run.split(",")] + ["uid"]
    run_uid = ", ".join(k)

    def same(a: str, b: str) -> str:
        return " and ".join(f"{a}.{c} = {b}.{c}" for c in k)

    def norm(x: str, y: str) -> str:
        return f"sqrt({x} * {x} + {y} * {y})"

    return f"""bk as (
  select {run_uid}, sec, avg(round(latitude, 5)) as lat, avg(round(longitude, 5)) as long, count(*) as n_pings
  from {source} group by {run_uid}, sec),
num as (
  select *, row_number() over (partition by {run_uid} order by sec) as i,
    count(*) over (partition by {run_uid}) as n from bk),
pair as (
  select {", ".join("c." + c for c in k)}, c.sec, c.i, c.n, c.lat, c.long,
    (c.sec - p.sec) / 60.0 as in_min, (x.sec - c.sec) / 60.0 as out_min,
    {_miles("p", "c")} as in_miles, {_miles("c", "x")} as out_miles,
    p.lat - c.lat as a1, p.long - c.long as a2, x.lat - c.lat as b1, x.long - c.long as b2
  from num c left join num p on {same("c", "p")} and p.i = c.i - 1
  left join num x on {same("c", "x")} and x.i = c.i + 1),
seg as (
  select *, in_miles / in_min * 60 as in_raw, out_miles / out_min * 60 as out_raw,
    {norm("a1", "a2")} as len_a,
    {norm("b1", "b2")} as len_b from pair),
clip as (
  select *,
    case when in_min is null then null when in_min < 20 and in_raw < 100 then in_raw else -1.0 end as in_clip,
    case when out_min is null then null when out_min < 20 and out_raw < 100 then out_raw else -1.0 end as out_clip
  from seg),
blend as (
  select *, case when in_clip = -1 then out_raw else (in_clip + out_raw) / 2 end as both_raw from clip),
motion as (
  select *,
    case when n < 4 then -1.0
      when i = 1 then out_clip
      when i = n then in_clip
      when out_min < 20 then case when both_raw < 100 then both_raw else -1.0 end
      else in_clip end as dspd,
    case when n < 4 or i = 1 or i = n then -1.0
      when in_min * 60 > 300.001 or out_min * 60 > 300.001 then -1.0
      when len_a = 0 or len_b = 0 or (len_a < 0.00001 and len_b < 0.00001) then -1.0
      else acos(greatest(-1.0, least(1.0, (a1 * b1 + a2 * b2) / len_a / len_b))) end as angle
  from blend)"""


MOTION = f"{PINGS},\n{ELIGIBLE},\n{_motion('elig', RUN)}"
BUCKET = f"{RUN}, uid, sec"
MEMBERS = f"""mem as (select distinct country, uid, sec, request_id, {KEYS} from elig)"""


def _join_on(run: str) -> str:
    return " and ".join(f"a.{c.strip()} = b.{c.strip()}" for c in (run + ", uid, sec").split(","))


PLAIN_REQ = f"""req as (
  select a.country, a.request_id, a."logType", a.y, a.m, a.d, a.h, a.stage, a."isFilled", a."confScore",
    round(b.dspd, 4) as dspd, round(b.angle, 4) as angle
  from mem a join motion b on {_join_on(RUN)})"""
RESULT = f"""res as (
  select country, request_id, {KEYS}, -1.0::double as dspd, -1.0::double as angle from pings where {SENTINEL}
  union all select country, request_id, {KEYS}, dspd, angle from req)"""
ALL_RESULTS = f"with {MOTION},\n{MEMBERS},\n{PLAIN_REQ},\n{RESULT}\n"
AS_STORED = f"select country, request_id, {PADDED_KEYS}, dspd, angle from res"

STATUS = """e as (
  select event_id, ts, concat('us/', cast(user_id % 4 as varchar), '/') as ks, cast(user_id % 4 as int) as s,
    cast(year(ts) as int) as year, cast(month(ts) as int) as month, cast(day(ts) as int) as day,
    cast(hour(ts) as int) as hour from events),
log as (
  select event_id as id, ts as timestamp, concat('ard/', ks) as key, year, month, day,
    case when event_id % 50 = 0 then null else hour end as hour, 1 as status, cast(null as varchar) as metadata from e
  union all
  select -event_id, ts, concat('derived_speed/', ks), year, month, day, hour,
    case when event_id % 9 = 0 then 0 else 1 end, concat('run-', cast(event_id as varchar))
  from e where event_id % 3 = 0 and day <= 27 + s % 4)"""

TIMES = """times as (
  select event_id,
    concat(case event_id % 2 when 0 then 'ard/us/' else 'derived_speed/us/' end, cast(user_id % 4 as varchar), '/') as key,
    case event_id % 6 when 0 then strftime(ts, '%Y/%m/%d/%H') when 1 then strftime(ts, '%Y-%m-%d')
      when 2 then strftime(ts, '%Y %m') when 3 then strftime(ts, '%Y-%m-%d %H')
      when 4 then strftime(ts, '%Y:%m:%d:%H') else '' end as time from events),
asked as (
  select event_id, key, time,
    try_cast(nullif(split_part(t, '/', 1), '') as int) as year, try_cast(nullif(split_part(t, '/', 2), '') as int) as month,
    try_cast(nullif(split_part(t, '/', 3), '') as int) as day, try_cast(nullif(split_part(t, '/', 4), '') as int) as hour
  from (select *, translate(time, '- :', '///') as t from times))"""

PARTIAL_TIMES = """partial as (
  select event_id,
    case when event_id % 5 = 0 then null else concat(case event_id % 2 when 0 then 'ard/us/' else 'derived_speed/us/' end,
      cast(user_id % 4 as varchar), '/') end as key,
    case event_id % 8 when 0 then strftime(ts, '%Y-%m-%d-%H') when 1 then concat(year(ts), '-xx-', day(ts))
      when 2 then concat('--', day(ts), '-', hour(ts)) when 3 then concat('?/', month(ts), '/?/', hour(ts))
      when 4 then concat(year(ts), '///', hour(ts)) when 5 then cast(year(ts) as varchar)
      when 6 then concat('x:x:', day(ts)) else '' end as time from events),
asked as (
  select event_id, key, time,
    try_cast(nullif(split_part(t, '/', 1), '') as int) as year, try_cast(nullif(split_part(t, '/', 2), '') as int) as month,
    try_cast(nullif(split_part(t, '/', 3), '') as int) as day, try_cast(nullif(split_part(t, '/', 4), '') as int) as hour
  from (select *, translate(time, '- :', '///') as t from partial))"""

LATEST = "strftime(max(make_timestamp(year, month, day, hour, 0, 0.0)), '%Y-%m-%d-%H')"

FOOT = f"""fp as (select *, '2024-01-01' as dt, lpad(cast(h as varchar), 2, '0') as hr, {SEC} as sec from pings),
{_motion("fp", "dt, hr")},
fmem as (select distinct dt, hr, uid, sec, proximity_mode, fp_brand, is_poly from fp)
select a.dt, a.hr, cast(a.uid as varchar) as uid, a.proximity_mode, a.fp_brand, a.is_poly,
  round(b.dspd, 4) as dspd, round(b.angle, 4) as angle
from fmem a join motion b on {_join_on("dt, hr")}"""



def _context(offset: int) -> str:
    return f"""with {PINGS},
{ELIGIBLE},
ctx as (select e.*, e.h + o.k as t from elig e, range(-{offset}, {offset} + 1) o(k)),
{_motion("ctx", "country, stage, t")},
mem as (select distinct country, uid, sec, request_id, {KEYS}, h as t from elig)
select a.country, a.request_id, a."logType", a.y, a.m, a.d, a.h, a.stage, a."isFilled", a."confScore",
  round(b.dspd, 4) as dspd, round(b.angle, 4) as angle
from mem a join motion b on {_join_on("country, stage, t")}"""


CONTEXT = _context(1)
CONTEXT_WIDE = _context(6)

MEAN = f"""with {MOTION},
reach as (
  select {RUN}, uid, i, angle, sec, n,
    min(i) over w as p1, max(i) over w as p3
  from motion
  window w as (partition by {RUN}, uid order by sec range between 300 preceding and 300 following))
select {BUCKET.replace(", ", ", c.").replace("country", "c.country", 1)},
  coalesce(round(case when c.n >= 4 and c.i > 1 and c.i < c.n and c.p1 <> c.i and c.p3 <> c.i then
    (select avg(o.angle) from motion o where {" and ".join(f"o.{k} = c.{k}" for k in RUN.split(", ") + ["uid"])}
      and o.i >= c.p1 and o.i < c.p3 and o.angle >= 0) end, 4), -1.0::double) as mean_angle
from reach c"""

ORACLES: dict[str, str] = {
    "orc_roundtrip": f"""with {PINGS}
select request_id, uid, r_timestamp, latitude, longitude, too_freq_uid, r_s_info, sl_adjusted_confidence,
  country, {KEYS} from pings""",
    "hour_slice": f"""with {PINGS}
select request_id, uid, r_timestamp, {RUN} from pings
where y = 2024 and m = 1 and d = 1 and h = 9 and stage = 1 and country = 'us'""",
    "path_partitions": f"""with {PINGS}
select request_id, uid, stage, country, "logType", y, m, d, h, "isFilled", "confScore", '2024-01-01' as dt from pings""",
    "context_hours": CONTEXT,
    "confidence_gate": f"""with {PINGS}
select request_id, uid, sl_adjusted_confidence, {RUN} from pings where sl_adjusted_confidence in (94, 95)""",
    "eligible_pings": f"""with {PINGS}, {ELIGIBLE}
select request_id, uid, r_timestamp, latitude, longitude, {RUN} from elig""",
    "sentinel_pings": f"""with {PINGS}
select country, request_id, {PADDED_KEYS}, -1.0::double as dspd, -1.0::double as angle from pings where {SENTINEL}""",
    "sentinel_pings_wide": f"""with {PINGS}
select country, request_id, {KEYS} from pings
where too_freq_uid != false or r_s_info is not null or sl_adjusted_confidence not in (94, 95)""",
    "gate_census": f"""with {PINGS},
g as (
  select *, sl_adjusted_confidence in (94, 95) as c,
    coalesce(too_freq_uid != false or r_s_info is not null, false) as s,
    coalesce(too_freq_uid = false and r_s_info is null, false) as e from pings)
select {RUN}, count(*) as n_rows, count(*) filter (where c and e) as n_eligible,
  count(*) filter (where c and s) as n_sentinel, count(*) filter (where c and not s and not e) as n_null_gate,
  count(*) filter (where not c) as n_low_confidence, count(*) filter (where uid is null) as n_no_uid
from g group by {RUN}""",
    "zero_padded_keys": f"""with {PINGS}
select request_id, y, {PADDED}, stage from pings where {SENTINEL}""",
    "time_buckets": f"""with {PINGS}
select request_id, uid, r_timestamp, {SEC} as sec, round(latitude, 5) as lat5, round(longitude, 5) as long5 from pings""",
    "bucket_positions": f"""with {MOTION}
select {BUCKET}, round(lat, 7) as lat, round(long, 7) as long, n_pings from bk""",
    "bucket_members": f"""with {PINGS}, {ELIGIBLE}, {MEMBERS}
select country, uid, sec, request_id, {KEYS} from mem""",
    "trajectory_summary": f"""with {MOTION}
select {RUN}, uid, count(*) as n_buckets, min(sec) as first_sec, max(sec) as last_sec from bk group by {RUN}, uid""",
    "short_trajectories": f"""with {MOTION}
select {BUCKET}, n as n_buckets from num where n < 4""",
    "segments": f"""with {MOTION}
select {BUCKET}, round(in_min, 4) as in_min, round(in_miles, 6) as in_miles, round(in_raw, 4) as in_raw,
  round(in_clip, 4) as in_clip from motion""",
    "point_speed": f"with {MOTION}\nselect {BUCKET}, round(dspd, 4) as dspd from motion",
    "turn_angle": f"with {MOTION}\nselect {BUCKET}, round(angle, 4) as angle from motion",
    "mean_turn_angle": MEAN,
    "request_speed": f"with {MOTION},\n{MEMBERS},\n{PLAIN_REQ}\nselect * from req",
    "derived_speed_hourly": ALL_RESULTS + AS_STORED,
    "derived_speed_backfill": ALL_RESULTS + AS_STORED + " where country = 'us'",
    "footprint_speed": f"with {PINGS},\n{FOOT}",
    "table_insert": f"with {PINGS},\n{FOOT}",
    "status_parse_time": f"with {TIMES}\nselect event_id, time, year, month, day, hour from asked",
    "status_latest": f"""with {STATUS}, {PINGS},
task as (
  select distinct country, stage, concat(p.prefix, country, '/', cast(stage as varchar), '/') as key
  from pings, (values ('ard/'), ('derived_speed/')) p(prefix))
select country, stage, t.key, (select {LATEST} from log l where l.key = t.key) as latest from task t""",
    "status_lookup": f"""with {STATUS}, {TIMES},
want as (select distinct key, time, year, month, day, hour from asked),
hit as (
  select w.key, w.time, l.status, l.metadata,
    row_number() over (partition by w.key, w.time order by l.timestamp desc, l.id desc) as rn
  from want w join log l on l.key = w.key and (w.year is null or l.year = w.year) and (w.month is null or l.month = w.month)
    and (w.day is null or l.day = w.day) and (w.hour is null or l.hour = w.hour))
select a.event_id, a.key, a.time, h.status, h.metadata
from asked a left join (select * from hit where rn = 1) h on h.key = a.key and h.time = a.time""",
    "pending_hours": f"""with {STATUS},
last as (
  select split_part(key, '/', 1) as kind, split_part(key, '/', 2) as country, cast(split_part(key, '/', 3) as int) as stage,
    max(make_timestamp(year, month, day, hour, 0, 0.0)) as t from log group by all),
span as (
  select a.country, a.stage, unnest(generate_series(r.t + interval 1 hour, a.t, interval 1 hour)) as t
  from last a join last r on a.country = r.country and a.stage = r.stage
  where a.kind = 'ard' and r.kind = 'derived_speed')
select country, stage, cast(year(t) as int) as y, cast(month(t) as int) as m, cast(day(t) as int) as d,
  cast(hour(t) as int) as h, strftime(t, '%Y-%m-%d-%H') as time from span""",
    "status_head": f"""with {STATUS}
select key, year, month, day, hour, status from log
order by key nulls first, year nulls first, month nulls first, day nulls first, hour nulls first, id limit 50""",
    "status_append": f"""with {STATUS}, {TIMES}
select key, year, month, day, hour, status, metadata from log
union all select key, year, month, day, hour, 1, null from asked""",
    "catch_up": ALL_RESULTS
    + f"""select country, request_id, {PADDED_KEYS}, dspd, angle from res
where exists (
  select 1 from (select country as c, stage as s, max(h) as last from pings group by all) x
  where x.c = res.country and x.s = res.stage and res.h > 8 + res.stage % 3 and res.h <= x.last)""",
    "context_hours_target": f"select * from ({CONTEXT}) where h = 9",
    "positional_slices": f"""with {PINGS}
select request_id, uid, stage, country, "isFilled", "confScore" from pings""",
    "pending_first_runs": f"""with {PINGS},
place as (
  select country, stage, min(h) as lo, max(h) as hi, 8 + stage % 3 as last from pings group by all),
hour as (
  select country, stage, unnest(range(
    case when country = 'gb' or stage = 2 then lo
      else greatest(least(last, (select max(h) from pings p where p.country = place.country
        and p.stage = place.stage and p.h <= last)) + 1, lo) end, hi + 1)) as h from place)
select country, stage, 2024 as y, 1 as m, 1 as d, cast(h as int) as h,
  '2024-01-01-' || lpad(cast(h as varchar), 2, '0') as time from hour""",
    "replay_hour": ALL_RESULTS
    + f"""select * replace (case when h = '09' and request_id % 7 = 0 then 'moved' else "confScore" end as "confScore")
from ({AS_STORED})""",
    "publish_killed": ALL_RESULTS
    + f"""select * replace (case when h = '10' then 'moved' else "confScore" end as "confScore")
from ({AS_STORED})""",
    "backfill_batches": ALL_RESULTS + AS_STORED + " where country = 'us'",
    "status_lookup_any": f"""with {STATUS}, {PARTIAL_TIMES},
want as (select distinct key, year, month, day, hour from asked),
hit as (
  select w.*, l.status, l.metadata,
    row_number() over (partition by w.key, w.year, w.month, w.day, w.hour order by l.timestamp desc, l.id desc) as rn
  from want w join log l on (w.key is null or l.key = w.key) and (w.year is null or l.year = w.year)
    and (w.month is null or l.month = w.month) and (w.day is null or l.day = w.day) and (w.hour is null or l.hour = w.hour))
select a.event_id, a.key, a.time, h.status, h.metadata
from asked a left join (select * from hit where rn = 1) h on h.key is not distinct from a.key
  and h.year is not distinct from a.year and h.month is not distinct from a.month
  and h.day is not distinct from a.day and h.hour is not distinct from a.hour""",
    "context_hours_wide": CONTEXT_WIDE,
    "context_hours_wide_target": f"select * from ({CONTEXT_WIDE}) where h = 9",
    "positional_slices_filtered": f"""with {PINGS}
select request_id, uid, stage, country, "isFilled", "confScore" from pings
where "isFilled" = 'fill' and "confScore" <> 'rest'""",
}
# pings without uid are one group, for which -1 stands here
ORACLES["derived_speed_days"] = f"""with {PINGS.replace("pings as (", "base as (", 1)},
pings as (
  select * replace (case when uid % 20 = 0 then -1 else uid end as uid, cast(1 + (request_id // 7) % 2 as int) as d,
    r_timestamp + 86400000 * ((request_id // 7) % 2) as r_timestamp) from base),
{ELIGIBLE},
{_motion("elig", RUN)},
{MEMBERS},
{PLAIN_REQ},
{RESULT}
{AS_STORED}"""


def _match(i: int) -> str:
    n = f"(request_id + {i})"
    return (
        f"{{'proximity_mode': cast({n} % 6 as int), 'fp_brand': 'brand' || ({n} % 17), 'fp_sic': 'sic' || ({n} % 5),"
        f" 'weight': cast(({n} % 8) / 8.0 as float), 'hash_key': 'h' || ({n} % 101), 'is_poly': cast({n} % 2 as int),"
        f" 'block_id': cast({n} % 1000 as int), 'is_employee': {n} % 3 = 0,"
        f" 'open_status': case when {n} % 4 = 0 then null else 'open' end, 'ha_match': {n} % 7 = 0}}"
    )


ORACLES["footprint_matches"] = f"""with {PINGS},
fp as (
  select * replace (case when uid % 20 = 0 then -1 else uid end as uid), '2024-01-01' as dt,
    lpad(cast(h as varchar), 2, '0') as hr, {SEC} as sec,
    [{_match(1)}, {_match(2)}, {_match(3)}][1 : request_id % 4] as matches from pings),
{_motion("fp", "dt, hr")},
fmem as (select distinct dt, hr, uid, sec, matches from fp),
answered as (
  select a.dt, a.hr, a.uid, a.matches, round(b.dspd, 4) as dspd, round(b.angle, 4) as angle
  from fmem a join motion b on {_join_on("dt, hr")}),
flat as (
  select *, unnest(case when len(matches) = 0 then [0] else range(1, len(matches) + 1) end) as place from answered)
select dt, hr, case when uid = -1 then null else cast(uid as varchar) end as uid, cast(place as int) as place,
  matches[place].proximity_mode as proximity_mode, matches[place].fp_brand as fp_brand, matches[place].fp_sic as fp_sic,
  matches[place].weight as weight, matches[place].hash_key as hash_key, matches[place].is_poly as is_poly,
  matches[place].block_id as block_id, matches[place].is_employee as is_employee,
  matches[place].open_status as open_status, matches[place].ha_match as ha_match, dspd, angle from flat"""
ORACLES["pending_hours_compacted"] = ORACLES["pending_hours"]
