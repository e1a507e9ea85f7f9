import json
import random

import pytest
from pyspark.sql import functions as F

from pressledger.operators import ledger, selection
from pressledger.operators.ingest import exclude_prior, merge_announcements, prior_cycles, source_inventory

KEYS = ["source", "event_key"]


def delivery_rows(seed, n=400):
    rng = random.Random(seed)
    return [(i, f"c{min(rng.randrange(6), 2)}", rng.choice(["deployment", "notification"]),
             rng.choices(["start", "unknown", "failed", "confirmed"], [4, 2, 3, 1])[0], rng.random() < 0.6) for i in range(n)]


def deliveries(rows):
    state, attempt, out = {}, {}, {}
    for seq, cycle, channel, action, ok in rows:
        key = cycle, channel
        now = state.get(key, "none")
        if action == "start":
            outcome = "started" if now in ("none", "failed") else "blocked"
            if outcome == "started":
                state[key], attempt[key] = "pending", attempt.get(key, 0) + 1
        elif now == "none":
            outcome = "no_intent"
        elif now in ("failed", "confirmed"):
            outcome = "terminal"
        elif action != "unknown" and not ok:
            outcome = "refused"
        else:
            outcome = state[key] = action
        out[seq] = outcome, attempt.get(key, 0)
    return out


@pytest.mark.parametrize("seed,block", [(1, 9), (2, 1000), (3, 50)])
def test_delivery_machine(spark, seed, block):
    rows = delivery_rows(seed)
    expected = deliveries(rows)
    df = spark.createDataFrame(rows, "seq bigint, cycle_id string, channel string, action string, evidence_ok boolean").repartition(5)
    keys = ["cycle_id", "channel"]
    outcomes = ledger.delivery_outcomes(df, keys, "seq", "action", "evidence_ok", block)
    assert {r.seq: r.outcome for r in outcomes.collect()} == {s: o for s, (o, _) in expected.items()}
    history = ledger.delivery_history(outcomes, keys, "seq", block).collect()
    assert {r.seq: r.attempt for r in history} == {s: a for s, (o, a) in expected.items() if o in ledger.TRANSITIONS}
    per_attempt = {}
    for r in sorted(history, key=lambda r: r.seq):
        per_attempt.setdefault((r.cycle_id, r.channel, r.attempt), []).append((r.position, r.state))
    for steps in per_attempt.values():
        assert [p for p, _ in steps] == list(range(1, len(steps) + 1))
        assert steps[0][1] == "pending" and all(s == "unknown" for _, s in steps[1:-1])


def test_unknown_then_unknown_then_confirmed(spark):
    rows = [(0, "c", "deployment", a, ok) for a, ok in (("start", True), ("unknown", False), ("unknown", False), ("confirmed", True), ("start", True))]
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "seq bigint, cycle_id string, channel string, action string, evidence_ok boolean")
    got = ledger.delivery_outcomes(df, ["cycle_id", "channel"], "seq", "action", "evidence_ok").orderBy("seq").collect()
    assert [r.outcome for r in got] == ["started", "unknown", "unknown", "confirmed", "blocked"]


@pytest.mark.parametrize("seed,block", [(5, 11), (6, 10_000)])
def test_event_upsert(spark, seed, block):
    rng = random.Random(seed)
    rows, state, counts = [], {}, {}
    for seq in range(300):
        event = {"status": rng.choice(["seen", "pending", "emitted"]), "cycle_id": rng.choice(["a", "b", None])}
        if rng.random() < 0.5:
            event["version"] = rng.choice(["1", "2", None])
        if rng.random() < 0.2:
            del event["cycle_id"]
        key = ("s", f"k{rng.randrange(8)}")
        rows.append((*key, seq, json.dumps(event)))
        old = state.get(key, {})
        legal = old.get("status") != "emitted" or (event["status"] == "emitted" and event.get("cycle_id") == old.get("cycle_id"))
        # a cycle kept from an earlier row counts once the identity is emitted
        counts.setdefault(key, [0, 0])[0 if legal else 1] += 1
        if legal:
            state[key] = {**old, **event}
    df = spark.createDataFrame(rows, "source string, event_key string, seq bigint, payload string").repartition(4)
    got, rejected = ledger.upsert_events(df, KEYS, "seq", "payload", ["status", "version", "cycle_id"], block)
    for r in got.collect():
        want = state[r.source, r.event_key]
        assert (r.status, r.version, r.cycle_id) == (want.get("status"), want.get("version"), want.get("cycle_id"))
        assert [r.accepted, r.rejected] == counts[r.source, r.event_key]
    assert rejected.count() == sum(c[1] for c in counts.values())


def test_first_write_and_overlaps(spark):
    df = spark.createDataFrame([(0, "k", "a"), (1, "k", "a"), (2, "k", "b"), (3, "j", None), (4, "j", None)], "seq bigint, k string, v string")
    got = ledger.first_write_wins(df, ["k"], "seq", F.col("v"), slices=2).orderBy("seq").collect()
    assert [r.outcome for r in got] == ["created", "replay", "conflict", "created", "replay"]
    claims = spark.createDataFrame([(0, "w", 0, 10), (1, "w", 10, 12), (2, "w", 11, 20), (3, "v", 11, 20), (4, "w", 19, 21)],
                                   "seq bigint, w string, a bigint, b bigint")
    assert [r.overlaps for r in ledger.overlapping_claims(claims, ["w"], "seq", "a", "b", slices=2).orderBy("seq").collect()] == [
        False, False, True, False, True]


def test_prior_cycles(spark):
    rows = [("c1", 1, "Migrated"), ("c2", 2, "PHASE_release"), ("c3", 3, "Released"), ("c4", 4, "PHASE_release"), ("c5", 5, "Released")]
    cycles = spark.createDataFrame(rows, "cycle_id string, cycle_no int, phase string")
    assert {r.cycle_id: r.prior_cycle_id for r in prior_cycles(cycles).collect()} == {
        "c1": None, "c2": "c1", "c3": "c1", "c4": "c3", "c5": "c3"}
    assert {r.cycle_id: r.prior_cycle_id for r in prior_cycles(cycles, {"c5": "c1"}).collect()}["c5"] == "c1"
    for wrong in ("c2", "c5", "c9"):
        with pytest.raises(Exception, match="not eligible"):
            prior_cycles(cycles, {"c5": wrong}).collect()


def test_prior_exclusion_by_any_identity(spark):
    rows = [("c1", "a", "u1", "p1"), ("c1", "b", "u2", None), ("c2", "x", "u1", None), ("c2", "y", "u9", "p1"), ("c2", "b", "u8", None),
            ("c2", "z", None, None), ("c3", "w", "u1", None)]
    df = spark.createDataFrame(rows, "cycle_id string, candidate_id string, url string, paper string")
    prior = spark.createDataFrame([("c1", None), ("c2", "c1"), ("c3", "c1")], "cycle_id string, prior_cycle_id string")
    kept = exclude_prior(df, prior, {"id": [F.col("candidate_id")], "url": [F.col("url")], "paper": [F.col("paper")]})
    assert sorted(r.candidate_id for r in kept.collect()) == ["a", "b", "z"]


def test_backfill_reports_shortage(spark):
    rows = [("c1", "Paper", f"p{i}", 58 + i) for i in range(4)] + [("c2", "News", "n", 90)]
    df = spark.createDataFrame(rows, "cycle_id string, category string, candidate_id string, score bigint")
    got = selection.backfill_papers(df, F.col("score") >= 59).collect()
    assert sorted((r.cycle_id, r.candidate_id, r.backfilled, r.shortage) for r in got if r.candidate_id) == [
        ("c1", "p1", True, 7), ("c1", "p2", False, 7), ("c1", "p3", False, 7)]
    assert [(r.cycle_id, r.shortage) for r in got if not r.candidate_id] == [("c2", 10)]


def test_inventory_statuses(spark):
    feed = spark.createDataFrame([("a", 1, 5), ("a", 2, 0), ("b", 3, 1), ("c", 4, 1)], "source string, record_id bigint, body_chars int")
    receipts = spark.createDataFrame([("f", "a", 0, None), ("f", "b", 0, "partial"), ("f", "d", 1, None)],
                                     "feed string, source string, return_code int, manifest_status string")
    got = {r.source: (r.status, r.records, r.valid_records) for r in source_inventory({"f": feed}, receipts).collect()}
    assert got == {"a": ("complete", 2, 1), "b": ("partial", 1, 1), "c": ("missing", 1, 1), "d": ("failed", 0, 0)}


def test_announcements_merge(spark):
    df = spark.createDataFrame([("s", "k", 3, "new"), ("s", "k", 1, "cross"), ("s", "k", 2, "new")], "source string, k string, t bigint, kind string")
    r = merge_announcements(df, "source", "k", "t", "kind").first()
    assert (r.first_seen, r.last_seen, r.events, r.types) == (1, 3, 3, ["cross", "new"])
