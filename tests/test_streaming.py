"""Streams over several micro-batches give what the batch operators give."""

import pytest
from pyspark.sql import functions as F

from pressledger.operators import ledger
from pressledger.plans.ledger_queries import DELIVERY_KEYS, delivery_log
from pressledger.sources.publication import ledger_sink
from pressledger.streaming import jobs, processors
from pressledger.tables import event_log

FOLDER = "/root/testdata/sf0.001"


def in_files(df, folder, parts):
    """The log in ``parts`` files whose order is the order of ``seq``."""
    import os
    total = df.agg(F.max("seq")).first()[0] + 1
    for i in range(parts):
        path = f"{folder}/part{i}"
        df.where((F.col("seq") >= total * i // parts) & (F.col("seq") < total * (i + 1) // parts)).coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            if name.endswith(".parquet"):
                os.makedirs(f"{folder}/log", exist_ok=True)
                os.link(f"{path}/{name}", f"{folder}/log/{i:03d}.parquet")
                os.utime(f"{folder}/log/{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return f"{folder}/log"


def run(spark, tmp_path, df, keys, machine, parts):
    log = in_files(df, str(tmp_path), parts)
    stream = jobs.stateful(jobs.read_log(spark, log, "*.parquet", 1), keys, machine)
    jobs.run_to_end(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    return spark.read.parquet(str(tmp_path / "out"))


def test_deliveries(spark, tmp_path):
    log = delivery_log(spark, FOLDER)
    got = run(spark, tmp_path, log, DELIVERY_KEYS, processors.deliveries(), 3)
    want = ledger.delivery_outcomes(log, DELIVERY_KEYS, "seq", "action", "evidence_ok")
    columns = ["seq", *DELIVERY_KEYS, "outcome"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_event_state_and_emissions(spark, tmp_path):
    keys = ["source", "event_key"]
    payload = F.concat(F.lit('{"status":"'), F.col("status"), F.lit('","cycle_id":"c'), (F.col("user_id") % 2).cast("string"), F.lit('"}'))
    log = event_log(spark, FOLDER).select(*keys, "seq", payload.alias("payload"), "status")
    got = run(spark, tmp_path, log, keys, processors.event_state(), 3)
    state, rejected = ledger.upsert_events(log, keys, "seq", "payload", ["status", "cycle_id"])
    assert {r.seq for r in got.where("outcome = 'rejected'").collect()} == {r.seq for r in rejected.collect()}
    last = ledger.latest(got, keys, "seq", ["event"]).select(*keys, F.get_json_object("event", "$.status").alias("status"))
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, state.select(*keys, "status").collect()))


def test_emissions_once(spark, tmp_path):
    keys = ["source", "event_key"]
    log = event_log(spark, FOLDER).where("status = 'emitted'").select(*keys, "seq")
    got = run(spark, tmp_path, log, keys, processors.emissions(), 4).collect()
    assert len({(r.source, r.event_key) for r in got}) == len(got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, ledger.emit_once(log, keys, "seq", F.lit(True)).collect()))


@pytest.mark.parametrize("order", ["seq", "hash"])
def test_daily_counts_lose_no_late_row(spark, tmp_path, order):
    log = event_log(spark, FOLDER).select("seq", F.col("ts").cast("timestamp").alias("ts"), "source")
    dealt = log if order == "seq" else log.withColumn("seq", F.pmod(F.xxhash64("seq"), F.lit(1000)))
    stream = jobs.read_log(spark, in_files(dealt, str(tmp_path), 5), "*.parquet", 1)
    jobs.run_batches_to_end(stream, lambda rows: ledger.daily_counts(rows, "source", "ts"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = jobs.summed_rows(spark, str(tmp_path / "out"), ["source", "day"], ["events"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ledger.daily_counts(log, "source", "ts").collect()))


@pytest.mark.parametrize("machine", ["deliveries", "emissions"])
def test_input_out_of_order_is_refused(spark, tmp_path, machine):
    log = delivery_log(spark, FOLDER).withColumn("seq", 10**6 - F.col("seq"))
    files = in_files(log.withColumn("seq", 10**6 - F.col("seq")), str(tmp_path), 3)
    keys = DELIVERY_KEYS if machine == "deliveries" else ["source", "event_key"]
    stream = jobs.read_log(spark, files, "*.parquet", 1).withColumn("seq", 10**6 - F.col("seq"))
    if machine == "emissions":
        stream = stream.select(F.lit("s").alias("source"), F.lit("k").alias("event_key"), "seq")
    with pytest.raises(Exception, match="in the order of seq"):
        jobs.run_to_end(jobs.stateful(stream, keys, getattr(processors, machine)()), str(tmp_path / "out"), str(tmp_path / "checkpoint"))


def test_idempotent_sink(spark, tmp_path):
    log = event_log(spark, FOLDER).select("seq", "source", F.concat(F.lit("op"), F.floor(F.col("seq") / 2).cast("string")).alias("operation_id"))
    stream = jobs.read_log(spark, in_files(log, str(tmp_path), 3), "*.parquet", 1)
    sink = ledger_sink(str(tmp_path / "ledger"), ["source", "operation_id"], "seq")
    (stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    got = spark.read.parquet(str(tmp_path / "ledger"))
    assert sorted(map(tuple, got.select("source", "operation_id", "seq").collect())) == sorted(
        map(tuple, log.groupBy("source", "operation_id").agg(F.min("seq").alias("seq")).collect()))
