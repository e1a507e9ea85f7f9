"""The ledger machines as streams: the stored log is read by a file stream to its end, and the sink is read back.

Each has the oracle of its batch twin, so batch and stream are held to the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.ledger import daily_counts
from ..session import pinned_folder
from ..streaming import jobs, processors
from ..tables import prepare, text_of
from .ledger_queries import DELIVERY_LOG
from .registry import REGISTRY, query
from .views import EVENT_LOG


def folders(spark, name):
    """Output and checkpoint folders of one run, in the shared checkpoint folder."""
    root = f"{pinned_folder(spark)}/streams/{name}-{uuid.uuid4().hex}"
    return f"{root}/output", f"{root}/checkpoint"


def event_stream(spark, folder):
    prepare(spark)
    kind = F.col("event_type")
    return jobs.read_log(spark, folder, "events.parquet").select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("s"), text_of(F.col("user_id") % 20)).alias("source"),
        F.concat(F.lit("k"), text_of((F.col("user_id") * 13 + F.col("event_id")) % 97)).alias("event_key"),
        F.when(kind.isin("view", "signup"), "seen").when(kind.isin("click", "error"), "pending").otherwise("emitted").alias("status"),
        kind, "user_id", "value")


@query("stream_daily_counts", REGISTRY["daily_counts"].sql)
def stream_daily_counts(spark, folder):
    output, checkpoint = folders(spark, "daily-counts")
    jobs.run_batches_to_end(event_stream(spark, folder), lambda rows: daily_counts(rows, "source", "ts"), output, checkpoint)
    return jobs.summed_rows(spark, output, ["source", "day"], ["events"])


@query("stream_emit_once", f"""with {EVENT_LOG}
select source, event_key, min(seq) as seq from event_log where status = 'emitted' group by source, event_key""")
def stream_emit_once(spark, folder):
    output, checkpoint = folders(spark, "emit-once")
    emitted = event_stream(spark, folder).where(F.col("status") == "emitted").select("source", "event_key", "seq")
    jobs.run_to_end(jobs.stateful(emitted, ["source", "event_key"], processors.emissions()), output, checkpoint)
    return spark.read.parquet(output)


@query("stream_event_upsert", f"""with {EVENT_LOG},
f as (select *, concat('c', cast(user_id % 2 as varchar)) as cycle_id, first_value(case when status = 'emitted' then {{'c': concat('c', cast(user_id % 2 as varchar))}} end ignore nulls)
  over (partition by source, event_key order by seq rows between unbounded preceding and 1 preceding) as fixed from event_log)
select seq, source, event_key, case when fixed is not null and (status <> 'emitted' or cycle_id <> fixed.c) then 'rejected' else 'accepted' end as outcome from f""")
def stream_event_upsert(spark, folder):
    output, checkpoint = folders(spark, "event-upsert")
    payload = F.concat(F.lit('{"status":"'), F.col("status"), F.lit('","cycle_id":"c'), text_of(F.col("user_id") % 2), F.lit('"}'))
    log = event_stream(spark, folder).select("source", "event_key", "seq", payload.alias("payload"))
    jobs.run_to_end(jobs.stateful(log, ["source", "event_key"], processors.event_state()), output, checkpoint)
    return spark.read.parquet(output).drop("event")


@query("stream_delivery_machine", f"with recursive {DELIVERY_LOG} select seq, cycle_id, channel, outcome, attempt from st where rn > 0")
def stream_delivery_machine(spark, folder):
    output, checkpoint = folders(spark, "deliveries")
    kind = F.col("event_type")
    log = event_stream(spark, folder).select(
        "seq", F.concat("source", F.lit("-"), text_of(F.col("ts").cast("date"))).alias("cycle_id"),
        F.when(F.col("user_id") % 40 < 20, "deployment").otherwise("notification").alias("channel"),
        F.when(kind.isin("view", "signup"), "start").when(kind == "click", "unknown").when(kind == "error", "failed")
        .otherwise("confirmed").alias("action"), (F.col("value") >= 10).alias("evidence_ok"))
    jobs.run_to_end(jobs.stateful(log, ["cycle_id", "channel"], processors.deliveries()), output, checkpoint)
    return spark.read.parquet(output)
