"""The append-only history: batches commit once, only the parts that a batch names are read."""

import re

import pytest
from pyspark.sql import functions as F

from pressledger.session import pinned
from pressledger.sources import history as H

KIND = "source string, op long, seq long, value string"


def build(spark, tmp_path):
    return H.History(spark, str(tmp_path / "history"), spark.createDataFrame([], KIND).schema, ["source", "op"], "seq")


def test_batches_replays_and_conflicts(spark, tmp_path):
    own, frame = build(spark, tmp_path), lambda rows: spark.createDataFrame(rows, KIND)
    first = frame([("a", 1, 5, "x"), ("a", 1, 3, "first"), ("a", 2, 1, None), (None, 1, 1, "null key"), ("b", 1, 2, "y"), ("b", 1, 2, "y")])
    assert tuple(own.append(first, 0)) == (0, 4, 4, 0, 0)
    assert tuple(own.append(frame([("z", 9, 9, "other rows under the same number")]), 0)) == (0, 4, 4, 0, 0)
    second = frame([("a", 1, 99, "first"), ("a", 2, 7, "changed"), (None, 1, 1, "null key"), ("c", 1, 1, "new")])
    assert tuple(own.append(second, 1)) == (1, 4, 1, 2, 1)
    assert tuple(own.append(first.where("false"), 2)) == (2, 0, 0, 0, 0)
    assert {tuple(r) for r in own.rows().collect()} == {("a", 1, 3, "first", 0), ("a", 2, 1, None, 0), (None, 1, 1, "null key", 0), ("b", 1, 2, "y", 0), ("c", 1, 1, "new", 1)}
    assert sorted(r.batch for r in own.commits().collect()) == [0, 1, 2]


def test_a_batch_that_lost_its_receipt_is_completed(spark, tmp_path, monkeypatch):
    own = build(spark, tmp_path)
    rows = spark.range(300).select(F.lit("s").alias("source"), F.col("id").alias("op"), F.col("id").alias("seq"), F.lit("v").alias("value"))
    real = H.RECEIPT
    monkeypatch.setattr(H, "RECEIPT", "no type")
    with pytest.raises(Exception):
        own.append(rows, 4)
    monkeypatch.setattr(H, "RECEIPT", real)
    again = H.History(spark, str(tmp_path / "history"), rows.schema, ["source", "op"], "seq")
    assert tuple(again.append(rows, 4)) == (4, 300, 300, 0, 0) and again.rows().count() == 300


def test_only_the_batch_s_parts_of_the_history_are_read(spark, tmp_path):
    own = build(spark, tmp_path)
    many = spark.range(3000).select(F.concat(F.lit("s"), F.col("id") % 7).alias("source"), F.col("id").alias("op"), F.col("id").alias("seq"), F.lit("v").alias("value"))
    own.append(many, 0)
    small = many.where("op in (5, 6, 3000)")
    judged = own.judged(small)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*?)\], Pushed", plan)
    assert any("_part" in f for f in filters)
    # files of the named parts only: their rows are read, no others
    parts = [r[0] for r in pinned(judged).select("_part").distinct().collect()]
    read = own.known(parts)
    assert len(parts) == 2 and 0 < read.count() < 3000 * len(parts) / 256 * 3
    assert "_digest" in plan and "value" in plan


def test_stream_replays_append_nothing(spark, tmp_path):
    own, source = build(spark, tmp_path), tmp_path / "in"
    rows = spark.createDataFrame([("a", i % 5, i, f"v{i % 5}") for i in range(20)], KIND)
    rows.coalesce(1).write.parquet(str(source))
    for name in ("one", "two"):  # a second stream offers the files again under the same numbers
        (spark.readStream.schema(KIND).parquet(str(source)).writeStream.foreachBatch(own.sink())
         .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination())
    assert sorted((r.op, r.seq) for r in own.rows().collect()) == [(i, i) for i in range(5)] and own.commits().count() == 1
