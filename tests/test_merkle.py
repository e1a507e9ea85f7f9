"""Snapshot comparison by descent against a comparison of all rows."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pressledger.operators import merkle as M

KIND = "parent long, position int, value long, note string"


def build(spark, folder, rows):
    return M.Snapshot.write(spark.createDataFrame(rows, KIND), str(folder), ["parent", "position"])


def brute(old, new):
    old, new = Counter(old), Counter(new)
    out = {}
    for key in {r[:2] for r in old | new}:
        lost = {r: old[r] - new[r] for r in old if r[:2] == key and old[r] > new[r]}
        come = {r: new[r] - old[r] for r in new if r[:2] == key and new[r] > old[r]}
        if not lost and not come:
            continue
        both = all(old[r] and new[r] for r in (*lost, *come))
        gone, more = sum(lost.values()), sum(come.values())
        status = ("repeats" if both else "changed" if gone == more == 1 and not any(old[r] and new[r] for r in (*lost, *come)) else "missing" if not more else "extra" if not gone else "mixed")
        fields = ",".join(n for n, a, b in zip(("value", "note"), next(iter(lost))[2:], next(iter(come))[2:], strict=True) if a != b) if status == "changed" else ""
        out[key] = (status, fields, gone, more)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_differences_equal_comparing_all_rows(spark, tmp_path, seed):
    rng = random.Random(seed)
    old = [(i // 4, i % 4, rng.randrange(50), rng.choice(["a", None])) for i in range(800)] + [(None, 1, 5, "null parent"), (7, None, None, None)]
    new = [r for r in old if rng.random() > 0.02]
    new = [(*r[:2], r[2] + 1 if r[2] is not None else 0, r[3]) if rng.random() < 0.02 else r for r in new] + [(9000 + i, 0, i, "x") for i in range(5)]
    new += rng.sample(new, 6) + [(3, 0, 999, "second row of a key")]
    before, after = build(spark, tmp_path / "a", old), build(spark, tmp_path / "b", new)
    got = {(r.parent, r.position): (r.status, r.fields, r.gone, r.come) for r in M.differences(before, after).collect()}
    assert got == brute(old, new)
    assert before.root() != after.root() and before.root()[1] == len(old)


def test_equal_snapshots_in_any_order_have_equal_roots_and_read_nothing(spark, tmp_path):
    rows = [(i, i % 3, i, "n") for i in range(300)] + [(1, 1, 1, "n")] * 3
    before, after = build(spark, tmp_path / "a", rows), build(spark, tmp_path / "b", rows[::-1])
    assert before.root() == after.root()
    assert M.differing_leaves(before, after)[1] == [] and M.differences(before, after).collect() == []
    assert build(spark, tmp_path / "c", rows[:-1]).root() != before.root()


def test_a_position_that_moves_is_found(spark, tmp_path):
    before, after = build(spark, tmp_path / "a", [(1, 0, 10, None), (1, 1, 20, None)]), build(spark, tmp_path / "b", [(1, 0, 20, None), (1, 1, 10, None)])
    assert sorted((r.position, r.status, r.fields) for r in M.differences(before, after).collect()) == [(0, "changed", "value"), (1, "changed", "value")]


def test_rows_of_differing_leaves_only_are_read(spark, tmp_path):
    rows = [(i, 0, i, "n") for i in range(4000)]
    before, after = build(spark, tmp_path / "a", rows), build(spark, tmp_path / "b", [*rows[:-1], (3999, 0, -1, "n")])
    leaves, parts = M.differing_leaves(before, after)
    assert leaves.count() == 1 and len(parts) == 1
    plan = M.differences(before, after)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*_part[^\]]*" + parts[0], plan)) == 2
    assert before.rows().where(F.col("_part") == parts[0]).count() < 60


def test_empty_tables(spark, tmp_path):
    rows = [(1, 0, 1, "x")]
    empty, one = build(spark, tmp_path / "a", []), build(spark, tmp_path / "b", rows)
    assert empty.root() == (None, 0)
    assert [(r.status, r.come) for r in M.differences(empty, one).collect()] == [("extra", 1)]


def test_rows_that_differ_by_a_microsecond_or_where_the_null_stands_differ(spark, tmp_path):
    kind = "parent long, position int, at timestamp, first long, second long, several array<long>, nested struct<at:timestamp,note:string>"
    line = "timestamp'2026-01-02 03:04:05.000001' at, cast({0} as bigint) first, cast({1} as bigint) second, cast({2} as array<bigint>) several, named_struct('at', {3}, 'note', {4}) nested"
    base = ("null", "5", "array(null)", "timestamp'2026-01-02 03:04:05.000001'", "cast(null as string)")
    others = [("5", "null", *base[2:]), (*base[:2], "array()", *base[3:]), (*base[:2], "null", *base[3:]), (*base[:3], "timestamp'2026-01-02 03:04:05.000002'", base[4]), (*base[:4], "''")]
    others = [line.format(*o) for o in others] + [line.format(*base).replace("05.000001' at", "05.000003' at")]

    def snapshot(name, lines):
        rows = [spark.sql(f"select cast({i} as bigint) parent, 0 position, {each}") for i, each in enumerate(lines)]
        frame = rows[0]
        for more in rows[1:]:
            frame = frame.union(more)
        return M.Snapshot.write(spark.createDataFrame(frame.rdd, kind), str(tmp_path / name), ["parent", "position"])

    before, after = snapshot("a", [line.format(*base)] * len(others)), snapshot("b", others)
    assert sorted((r.parent, r.status, r.fields) for r in M.differences(before, after).collect()) == [
        (0, "changed", "first,second"), (1, "changed", "several"), (2, "changed", "several"), (3, "changed", "nested"), (4, "changed", "nested"), (5, "changed", "at")]


def test_leaves_are_added_up_before_they_are_shuffled(spark, tmp_path):
    def shuffled():
        stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(s.shuffleWriteBytes() for s in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(stages))

    rows = spark.range(20000).selectExpr("id % 2 parent", "0 position", "id value", "'n' note")
    start = shuffled()
    snapshot = M.Snapshot.write(rows, str(tmp_path / "a"), ["parent", "position"])
    # rows go once to be counted and once to their folders; 32 bytes of each row's digest no more
    assert shuffled() - start < 20000 * 32
    assert snapshot.level("leaves").count() == 2 and snapshot.root()[1] == 20000


def test_rows_are_not_shuffled_to_find_those_of_differing_leaves(spark, tmp_path):
    rows = [(i, 0, i, "n") for i in range(4000)]
    before, after = build(spark, tmp_path / "a", rows), build(spark, tmp_path / "b", [(*r[:2], -1, "n") if r[0] % 3 == 0 else r for r in rows])
    found = M.differences(before, after)
    assert "hashpartitioning(_leaf" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("status = 'changed'").count() == found.count() == 1334


def test_keys_of_another_width_name_the_same_leaves(spark, tmp_path):
    rows = spark.range(500).selectExpr("id parent", "cast(id % 7 as int) position", "id value")
    before, after = (M.Snapshot.write(each, str(tmp_path / name), ["parent", "position"]) for name, each in (("a", rows), ("b", rows.withColumn("position", F.col("position").cast("long")))))
    assert before.root() == after.root()
