import random

import pytest

from pressledger.llm.mixing import BLOCK_ROWS, PERIOD, Mixture, quotas, schedule
from pressledger.llm.queries import QUERIES
from pressledger.llm.tables import ready


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 36, "b": 3.4, "c": 0.01}, {f"s{i}": i + 1 for i in range(200)},
                                     {f"s{i}": random.Random(i).random() ** 4 + 1e-6 for i in range(37)}])
def test_schedule_deviates_by_less_than_one_block(weights):
    parts = quotas(weights)
    period = sum(parts.values())
    assert period >= PERIOD or len(weights) * 16 > PERIOD
    held = dict.fromkeys(parts, 0)
    plan = schedule(parts)
    assert [slot for _, _, slot in plan] == list(range(period))
    for s, i, slot in plan:
        assert i == held[s] and i * period // parts[s] <= slot < -(-(i + 1) * period // parts[s])
        held[s] += 1
        assert all(abs(held[k] * period - parts[k] * (slot + 1)) < period for k in parts)
    assert held == parts


def sourced(spark, sizes, partitions=4):
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame([(i, s, f"text {i}", "clash") for i, s in rows], "doc_id long, source string, text string, slot string").repartition(partitions)


def test_every_row_has_its_own_place(spark):
    ready(spark)
    sizes = {"hot": 3000, "b": 500, "c": 400, "d": 7}
    mix = Mixture(sourced(spark, sizes), {"hot": 2, "b": 1, "c": 1, "d": 0.01, "absent": 5})
    rows = mix.placed().collect()
    assert len(rows) == sum(sizes.values()) and len({r.position for r in rows}) == len(rows)
    first = {s: i for i, s in enumerate(dict.fromkeys(s for s, _, _ in schedule(mix.quotas)))}
    slots = {(r.source, r.block): r.slot for r in rows}
    assert set(first) == set(sizes) and len(set(slots.values())) == len(slots)
    table = {(s, i): slot for s, i, slot in schedule(mix.quotas)}
    for (s, block), slot in slots.items():
        q = mix.quotas[s]
        assert slot == block // q * mix.period + table[s, block % q]
    for s, n in sizes.items():
        assert sorted(r.block for r in rows if r.source == s) == [i // BLOCK_ROWS for i in range(n)]


def test_blocks_follow_the_exact_weights_over_many_periods(spark):
    ready(spark)
    docs = spark.range(120_000).selectExpr("id as doc_id", "case when id < 100000 then 'a' when id < 119000 then 'b' else 'c' end as source")
    weights = {"a": 1, "b": 0.14159, "c": 0.0004}
    mix, total = Mixture(docs, weights), sum(weights.values())
    plan = sorted((r.slot, r.source) for r in mix.placed().select("slot", "source").distinct().collect())
    end = mix.slots()
    assert end > 5 * PERIOD
    held = dict.fromkeys(weights, 0)
    for slot, s in plan:
        if slot < end:
            held[s] += 1
            assert all(abs(held[k] - w / total * (slot + 1)) < 1 + 1 / 64 for k, w in weights.items())


def test_kept_rows_have_the_target_weights(spark):
    ready(spark)
    docs = sourced(spark, {"hot": 3000, "b": 800, "c": 900})
    mix = Mixture(docs, {"hot": 1, "b": 1, "c": 1})
    kept = mix.kept()
    assert kept.columns == docs.columns
    rows = kept.collect()
    counts = {s: sum(r.source == s for r in rows) for s in ("hot", "b", "c")}
    assert counts["b"] == 800 and all(abs(n - 800) <= 2 * BLOCK_ROWS for n in counts.values())
    before = {(r.doc_id) for r in mix.placed().where(f"slot < {mix.slots()}").collect()}
    assert {r.doc_id for r in rows} == before


def test_mixture_of_own_weights_keeps_and_orders_every_row(spark):
    ready(spark)
    # one source has a single row, and null is a source
    docs = sourced(spark, {"hot": 30000, "b": 2500, "one": 1, None: 300})
    docs = docs.unionByName(docs.where("doc_id in (3, 4)"))
    mix = Mixture(docs, temperature=0.9, nulls=True)
    rows = mix.ordered().collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect()) and mix.ordered().columns == docs.columns
    place = {r.doc_id: r.position for r in mix.placed().orderBy("position", ascending=False).collect()}
    assert [place[r.doc_id] for r in rows] == sorted(place[r.doc_id] for r in rows)
    early = [r.source for r in rows[:8000]]
    assert abs(early.count("b") / 8000 - mix.quotas["b"] / mix.period) < 0.01
    assert Mixture(docs, temperature=0.9).kept().where("source is null").count() == 0


def test_nulls_repeats_and_empty_tables(spark):
    ready(spark)
    docs = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (None, "a", "y"), (2, None, "z"), (3, "b", None)], "doc_id long, source string, text string")
    mix = Mixture(docs)
    assert sorted((r.doc_id or 0, r.source) for r in mix.placed().collect()) == [(0, "a"), (1, "a"), (1, "a"), (3, "b")]
    assert {r.source for r in mix.kept().collect()} <= {"a", "b"}
    empty = Mixture(docs.where("false"))
    assert empty.placed().count() == 0 and empty.kept().count() == 0 and empty.kept().columns == docs.columns
    with pytest.raises(ValueError):
        Mixture(docs, {"a": 0.0, "b": 1})


def test_query(spark):
    rows = QUERIES["op3_source_mixing"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and len({r.position for r in rows}) == 200
