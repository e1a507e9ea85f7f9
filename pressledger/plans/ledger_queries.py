"""Ledger family: event state, operation ledgers, deliveries, claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import cycle_id, display_date, in_daily_window
from ..operators import ledger as ops
from ..operators.windows import prior
from ..tables import event_log, load, text_of
from .registry import query
from .views import EVENT_LOG

KEYS = ["source", "event_key"]


@query("latest_state", f"""with {EVENT_LOG}
select source, event_key, max(seq) as seq, arg_max(status, seq) as status, arg_max(ts, seq) as ts from event_log group by source, event_key""")
def latest_state(spark, folder):
    return ops.latest(event_log(spark, folder), KEYS, "seq", ["status", "ts"])


@query("first_write_wins", f"""with {EVENT_LOG},
f as (select *, first_value(user_id) over (partition by source, event_key order by seq) as owner, row_number() over (partition by source, event_key order by seq) as rn
  from event_log)
select seq, source, event_key, case when rn = 1 then 'created' when user_id = owner then 'replay' else 'conflict' end as outcome from f""")
def first_write_wins(spark, folder):
    rows = event_log(spark, folder).select("seq", *KEYS, "user_id")
    return ops.first_write_wins(rows, KEYS, "seq", F.col("user_id")).drop("user_id")


@query("illegal_transitions", f"""with {EVENT_LOG},
f as (select *, min(case when status = 'emitted' then seq end) over (partition by source, event_key order by seq rows between unbounded preceding and 1 preceding) as terminal_seq
  from event_log)
select seq, source, event_key, status, terminal_seq from f where terminal_seq is not null and status <> 'emitted'""")
def illegal_transitions(spark, folder):
    rows = event_log(spark, folder).select("seq", *KEYS, "status")
    return ops.illegal_transitions(rows, KEYS, "seq", F.col("status") == "emitted", F.col("status") == "emitted")


@query("overlap_claims", """with f as (select event_id as seq, user_id, cast(ts + interval 8 hour as date) as day, epoch_us(ts) as start_us,
  epoch_us(ts) + cast(floor(value * 3600000000) as bigint) as end_us from events),
c as (select day, concat('daily-', strftime(day, '%Y-%m-%d')) as cycle_id from (select distinct day from f))
select seq, user_id, cycle_id, start_us, end_us,
  coalesce(start_us < max(end_us) over (partition by user_id order by seq rows between unbounded preceding and 1 preceding), false) as overlaps
from f join c on f.day = c.day""")
def overlap_claims(spark, folder):
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    claims = load(spark, folder, "events").select(
        F.col("event_id").alias("seq"), "user_id", display_date(F.col("ts")).alias("day"), start.alias("start_us"),
        (start + F.floor(F.col("value") * 3_600_000_000).cast("bigint")).alias("end_us"))
    cycles = claims.select("day").distinct().withColumn("cycle_id", cycle_id(F.col("day")))
    flagged = ops.overlapping_claims(claims, ["user_id"], "seq", "start_us", "end_us")
    return flagged.join(cycles, "day").select("seq", "user_id", "cycle_id", "start_us", "end_us", "overlaps")


@query("event_upsert", f"""with {EVENT_LOG},
e as (select seq, source, event_key, status, seq % 3 <> 0 as has_type, event_type, seq % 5 <> 1 as has_version,
  case when seq % 5 = 0 then null else cast(seq as varchar) end as version, concat('c', cast(user_id % 2 as varchar)) as cycle_id from event_log),
f as (select *, first_value(case when status = 'emitted' then {{'c': cycle_id}} end ignore nulls) over (partition by source, event_key order by seq
  rows between unbounded preceding and 1 preceding) as fixed from e),
j as (select *, fixed is not null and (status <> 'emitted' or cycle_id <> fixed.c) as rejected from f)
select source, event_key, arg_max(status, seq) filter (where not rejected) as status,
  arg_max(event_type, seq) filter (where not rejected and has_type) as announce_type,
  (arg_max({{'v': version}}, seq) filter (where not rejected and has_version)).v as version,
  arg_max(cycle_id, seq) filter (where not rejected) as cycle_id,
  count(*) filter (where not rejected) as accepted, count(*) filter (where rejected) as rejected
from j group by source, event_key""")
def event_upsert(spark, folder):
    seq = F.col("seq")
    payload = F.concat(
        F.lit('{"status":"'), F.col("status"), F.lit('","cycle_id":"c'), text_of(F.col("user_id") % 2), F.lit('"'),
        F.when(seq % 3 != 0, F.concat(F.lit(',"announce_type":"'), F.col("event_type"), F.lit('"'))).otherwise(""),
        F.when(seq % 5 == 1, "").when(seq % 5 == 0, ',"version":null')
        .otherwise(F.concat(F.lit(',"version":"'), text_of("seq"), F.lit('"'))), F.lit("}"))
    rows = event_log(spark, folder).select("seq", *KEYS, payload.alias("payload"))
    state, _ = ops.upsert_events(rows, KEYS, "seq", "payload", ["status", "announce_type", "version", "cycle_id"])
    return state


@query("batch_upsert", f"""with recursive {EVENT_LOG},
e as (select source, seq // 60 as batch, event_key, case when seq % 6 < 4 then 'seen' else 'emitted' end as status, seq % 5 <> 1 as named, concat('c', cast(user_id % 3 as varchar)) as cycle from event_log),
b as (select source, row_number() over (partition by source order by batch) as n, batch, count(*) as events, count(*) = count(distinct event_key) as single,
  list({{'k': event_key, 's': status, 'c': case when named then cycle end, 'named': named}} order by event_key) as evs from e group by source, batch),
st(source, n, batch, events, accepted, emitted, carried) as (
  select distinct source, cast(0 as bigint), cast(null as bigint), cast(0 as bigint), false, map([]::varchar[], []::varchar[]), map([]::varchar[], []::varchar[]) from e
  union all
  select source, n, batch, events, ok,
    case when ok then map_concat(emitted, map_from_entries(list_transform(list_filter(evs, lambda x: x.s = 'emitted'), lambda x: {{'k': x.k, 'v': case when x.named then x.c else carried[x.k] end}}))) else emitted end,
    case when ok then map_concat(carried, map_from_entries(list_transform(list_filter(evs, lambda x: x.named), lambda x: {{'k': x.k, 'v': x.c}}))) else carried end
  from (select b.source, b.n, b.batch, b.events, b.evs, st.emitted, st.carried,
      b.single and len(list_filter(b.evs, lambda x: map_contains(st.emitted, x.k) and (x.s <> 'emitted' or x.c is distinct from st.emitted[x.k]))) = 0 as ok
    from st join b on b.source = st.source and b.n = st.n + 1))
select source, batch, events, accepted from st where n > 0""")
def batch_upsert(spark, folder):
    """Batches of a source's events, of which each is accepted or falls as a whole."""
    seq = F.col("seq")
    payload = F.concat(F.when(seq % 6 < 4, '{"status":"seen"').otherwise('{"status":"emitted"'),
                       F.when(seq % 5 != 1, F.concat(F.lit(',"cycle_id":"c'), text_of(F.col("user_id") % 3), F.lit('"'))).otherwise(""), F.lit("}"))
    rows = event_log(spark, folder).select("source", "event_key", F.floor(seq / 60).cast("bigint").alias("batch"), payload.alias("payload"))
    _, verdicts = ops.upsert_batches(rows, "source", "event_key", "batch", "payload", ["status", "cycle_id"])
    return verdicts


@query("emit_once", f"""with {EVENT_LOG}
select source, event_key, min(seq) as seq from event_log e where status = 'emitted'
  and not exists (select 1 from event_log h where h.source = e.source and h.event_key = e.event_key and h.status = 'emitted' and h.ts < timestamp '2024-01-08 16:00:00')
group by source, event_key""")
def emit_once(spark, folder):
    """Emissions after the first week, given that the first week was already emitted."""
    rows = event_log(spark, folder).select("seq", "ts", *KEYS, "status")
    boundary = F.lit("2024-01-08 16:00:00").cast("timestamp_ntz")
    emitted = F.col("status") == "emitted"
    history = ops.emit_once(rows.where(F.col("ts") < boundary), KEYS, "seq", emitted)
    return ops.emit_once(rows.where(F.col("ts") >= boundary), KEYS, "seq", emitted, history)


@query("daily_counts", f"""with {EVENT_LOG}
select source, cast(ts + interval 8 hour as date) as day, count(*) as events from event_log group by all""")
def daily_counts(spark, folder):
    rows = event_log(spark, folder).select("source", F.col("ts").cast("timestamp").alias("ts"))
    return ops.daily_counts(rows, "source", "ts")


@query("pending_recovery", f"""with {EVENT_LOG},
r as (select source, event_key from event_log where ts < timestamp '2024-01-13 16:00:00' group by source, event_key having arg_max(status, seq) = 'pending'),
c as (select source, event_key, count(*) as n from event_log where ts >= timestamp '2024-01-13 16:00:00' and ts < timestamp '2024-01-14 16:00:00' group by source, event_key)
select coalesce(r.source, c.source) as source, coalesce(r.event_key, c.event_key) as event_key, r.source is not null as recovered,
  coalesce(c.n, 0) as current_events
from r full join c on r.source = c.source and r.event_key = c.event_key""")
def pending_recovery(spark, folder):
    rows = event_log(spark, folder).select("seq", "ts", *KEYS, "status")
    return ops.pending_recovery(rows, KEYS, "seq", "status", F.col("ts") < F.lit("2024-01-13 16:00:00").cast("timestamp_ntz"),
                                in_daily_window(F.col("ts"), "2024-01-15"))


@query("attempt_history", f"""with {EVENT_LOG}
select source, arg_max(case event_type when 'error' then 'failed' when 'purchase' then 'complete' else 'running' end, seq) as latest_status,
  max(seq) as latest_attempt, count(*) as attempts, count(*) filter (where event_type = 'error') as failures from event_log group by source""")
def attempt_history(spark, folder):
    kind = F.col("event_type")
    runs = event_log(spark, folder).select("source", "seq", F.when(kind == "error", "failed").when(
        kind == "purchase", "complete").otherwise("running").alias("status"))
    return ops.attempt_history(runs, "source", "seq", "status")


DELIVERY_LOG = f"""{EVENT_LOG},
delivery_log as (select seq, concat(source, '-', cast(cast(ts as date) as varchar)) as cycle_id,
  case when user_id % 40 < 20 then 'deployment' else 'notification' end as channel,
  case event_type when 'view' then 'start' when 'signup' then 'start' when 'click' then 'unknown' when 'error' then 'failed' else 'confirmed' end as action,
  value >= 10 as evidence_ok from event_log),
n as (select *, row_number() over (partition by cycle_id, channel order by seq) as rn from delivery_log),
st as (select cycle_id, channel, cast(0 as bigint) as rn, cast(-1 as bigint) as seq, 'none' as state, cast(0 as bigint) as attempt, '' as outcome
    from (select distinct cycle_id, channel from delivery_log)
  union all
  select s.cycle_id, s.channel, o.rn, o.seq,
    case when o.action = 'start' and s.state in ('none', 'failed') then 'pending' when s.state in ('none', 'failed', 'confirmed') or o.action = 'start' then s.state
      when o.action = 'unknown' or o.evidence_ok then o.action else s.state end,
    s.attempt + case when o.action = 'start' and s.state in ('none', 'failed') then 1 else 0 end,
    case when o.action = 'start' then case when s.state in ('none', 'failed') then 'started' else 'blocked' end
      when s.state = 'none' then 'no_intent' when s.state in ('failed', 'confirmed') then 'terminal' when o.action = 'unknown' then 'unknown'
      when not o.evidence_ok then 'refused' else o.action end
  from st s join n o on o.cycle_id = s.cycle_id and o.channel = s.channel and o.rn = s.rn + 1)"""
DELIVERY_KEYS = ["cycle_id", "channel"]


def delivery_log(spark, folder):
    kind = F.col("event_type")
    return event_log(spark, folder).select(
        "seq", F.concat("source", F.lit("-"), text_of(F.col("ts").cast("date"))).alias("cycle_id"),
        F.when(F.col("user_id") % 40 < 20, "deployment").otherwise("notification").alias("channel"),
        F.when(kind.isin("view", "signup"), "start").when(kind == "click", "unknown").when(kind == "error", "failed")
        .otherwise("confirmed").alias("action"), (F.col("value") >= 10).alias("evidence_ok"))


def delivery_outcomes(spark, folder):
    return ops.delivery_outcomes(delivery_log(spark, folder), DELIVERY_KEYS, "seq", "action", "evidence_ok")


@query("delivery_machine", f"with recursive {DELIVERY_LOG} select seq, cycle_id, channel, outcome from st where rn > 0")
def delivery_machine(spark, folder):
    return delivery_outcomes(spark, folder).select("seq", *DELIVERY_KEYS, "outcome")


HISTORY_SQL = f"""{DELIVERY_LOG},
h as (select cycle_id, channel, attempt, row_number() over (partition by cycle_id, channel, attempt order by seq) as position,
  case outcome when 'started' then 'pending' else outcome end as state, seq from st where outcome in ('started', 'unknown', 'failed', 'confirmed'))"""


@query("delivery_history", f"with recursive {HISTORY_SQL} select * from h")
def delivery_history(spark, folder):
    return ops.delivery_history(delivery_outcomes(spark, folder), DELIVERY_KEYS, "seq")


@query("delivery_attempts", f"""with recursive {HISTORY_SQL}
select cycle_id, channel, attempt, arg_max(state, seq) as latest_state, count(*) as events from h group by all""")
def delivery_attempts(spark, folder):
    history = ops.delivery_history(delivery_outcomes(spark, folder), DELIVERY_KEYS, "seq")
    return ops.delivery_attempts(history, DELIVERY_KEYS, "seq")


@query("delivery_ledger", f"""with recursive {EVENT_LOG},
d as (select seq, concat(source, '-', cast(cast(ts as date) as varchar)) as cycle_id, case when seq % 13 = 5 then 'notification' else 'deployment' end as channel,
  concat('a', cast((seq // 900) % 4 as varchar)) as attempt, case when seq % 17 = 0 then 'release' when seq % 5 in (0, 1) then 'start' when seq % 5 = 2 then 'unknown'
    when seq % 5 = 3 and seq % 4 < 3 then 'failed' else 'confirmed' end as action,
  concat('p', cast(case when seq % 11 = 0 then seq % 3 else 0 end as varchar)) as payload, seq % 7 <> 3 as ok from event_log),
l as (select cycle_id, row_number() over (partition by cycle_id order by seq) as n, list({{'seq': seq, 'ch': channel, 'k': concat(channel, '|', attempt), 'a': action, 'p': payload, 'ok': ok}} order by seq)[1] as r, seq
  from d group by cycle_id, seq),
st(cycle_id, n, seq, outcome, released, request, state) as (
  select distinct cycle_id, cast(0 as bigint), cast(null as bigint), cast(null as varchar), false, map([]::varchar[], []::varchar[]), map([]::varchar[], []::varchar[]) from d
  union all
  select cycle_id, n, seq, outcome, released or (r.a = 'release' and outcome = 'recorded'),
    case when outcome = 'started' then map_concat(request, map([r.k], [r.p])) else request end,
    case when outcome = 'started' then map_concat(state, map([r.k], ['pending|'])) when r.a <> 'release' and outcome = 'recorded' then map_concat(state, map([r.k], [concat(r.a, '|', r.p)])) else state end
  from (select l.cycle_id, l.n, l.seq, l.r, st.released, st.request, st.state,
      case when l.r.a = 'release' then case when st.released then 'repeat' when len(list_filter(map_entries(st.state), lambda e: e.key like 'deployment|%' and e.value like 'confirmed|%')) = 0 then 'unconfirmed' else 'recorded' end
        when l.r.a = 'start' then case when l.r.ch = 'notification' and not st.released then 'not_released' when not l.r.ok then 'refused'
          when map_contains(st.request, l.r.k) then case when st.request[l.r.k] = l.r.p then 'replay' else 'conflict' end
          when st.released and l.r.ch = 'deployment' then 'released'
          when len(list_filter(map_entries(st.state), lambda e: e.key like l.r.ch || '|%' and e.value not like 'failed|%')) > 0 then 'blocked' else 'started' end
        else case when not map_contains(st.request, l.r.k) then 'no_intent' when st.state[l.r.k] = concat(l.r.a, '|', l.r.p) then 'repeat'
          when st.state[l.r.k] like 'failed|%' or st.state[l.r.k] like 'confirmed|%' then 'terminal' when not l.r.ok then 'refused' else 'recorded' end end as outcome
    from st join l on l.cycle_id = st.cycle_id and l.n = st.n + 1))
select seq, cycle_id, outcome from st where n > 0""")
def delivery_ledger(spark, folder):
    """Deliveries with attempts, replays, conflicts and the release gate."""
    seq = F.col("seq")
    action = (F.when(seq % 17 == 0, "release").when((seq % 5).isin(0, 1), "start").when(seq % 5 == 2, "unknown").when((seq % 5 == 3) & (seq % 4 < 3), "failed").otherwise("confirmed"))
    rows = event_log(spark, folder).select(
        "seq", F.concat("source", F.lit("-"), text_of(F.col("ts").cast("date"))).alias("cycle_id"), F.when(seq % 13 == 5, "notification").otherwise("deployment").alias("channel"),
        F.concat(F.lit("a"), text_of(F.floor(seq / 900).cast("bigint") % 4)).alias("attempt"), action.alias("action"),
        F.concat(F.lit("p"), text_of(F.when(seq % 11 == 0, seq % 3).otherwise(F.lit(0)))).alias("payload"), (seq % 7 != 3).alias("ok"))
    return ops.delivery_ledger(rows, "cycle_id", "channel", "attempt", "seq", "action", "payload", "ok").select("seq", "cycle_id", "outcome")
