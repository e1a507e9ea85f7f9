import hashlib
from collections import Counter

import numpy as np

from pressledger.llm import weighted_sampling as W
from pressledger.llm.queries import QUERIES
from pressledger.llm.tables import ready


def bag(text):
    words = text.split()
    return Counter(tuple(words[i:i + 3]) for i in range(max(len(words) - 2, 1))) if words else Counter()


def similarity(a, b):
    a, b = bag(a), bag(b)
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys)


def test_likeness_estimates_generalised_jaccard():
    rng = np.random.default_rng(4)
    of, errors = W.Fingerprinter(), []
    for vocabulary, share in ((9, 1.0), (2000, 0.5), (2000, 0.9), (40, 0.7)):
        base = [rng.choice(vocabulary, 300) for _ in range(60)]
        other = [np.where(rng.random(300) < share**0.33, b, rng.choice(vocabulary, 300)) for b in base]
        a, b = ([" ".join(f"w{x}" for x in row) for row in rows] for rows in (base, other))
        errors.append(W.likeness(of(a), of(b)) - np.array([similarity(x, y) for x, y in zip(a, b, strict=True)]))
    assert all(abs(e.mean()) < 0.08 and np.sqrt((e**2).mean()) < 0.12 for e in errors)


def test_weights_count_in_long_texts():
    of = W.Fingerprinter()
    for terms in (1000, 50_000, 150_000):
        once = " ".join(f"w{i}" for i in range(terms))
        whole = of([once, f"{once} {once}", f"{once} {once} {once}"])
        for times in (2, 3):
            assert abs(W.likeness(whole[:1], whole[times - 1:times])[0] - 1 / times) < 0.15


def test_real_and_unequal_weights():
    rng = np.random.default_rng(7)
    errors = []
    for terms in (60, 5000, 50_000):
        for _ in range(4):
            names = rng.integers(0, 2**63, terms).astype(np.uint64)
            a, b = rng.exponential(1, terms) * rng.choice([0.1, 1, 25], terms), rng.exponential(1, terms) * rng.choice([0.1, 1, 25], terms)
            prints = [W.samples(names, w, np.array([0])) for w in (a, b)]
            errors.append(W.likeness(*prints)[0] - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.04 and max(map(abs, errors)) < 0.16


def test_samples_equal_drawing_every_term():
    rng = np.random.default_rng(3)
    sizes = np.array([1, 2, 3, 40, 700, 5000])
    first, terms = np.cumsum(sizes) - sizes, rng.integers(0, 2**63, sizes.sum()).astype(np.uint64)
    weights = rng.choice([0.2, 1.0, 1.0, 3.0, 900.0], sizes.sum())
    got = W.samples(terms, weights, first)
    for k in range(W.SAMPLES):
        bits = W.scrambled(terms, k)
        value, t = W.drawn(bits, np.log(weights))
        name = W.named(terms, t)
        assert (np.exp(value) * weights * 2.0**48 >= W.bounded(bits)).all()
        for i, (lo, n) in enumerate(zip(first, sizes, strict=True)):
            assert got[i, k] == name[lo + np.argmin(value[lo:lo + n])] & W.BYTE


def test_draws_follow_their_distributions():
    bits = W.scrambled(np.arange(1, 200_001, dtype=np.uint64), 5)
    value, _ = W.drawn(bits, np.zeros(200_000))
    # for weight 1, a is exponential with rate 1
    a = np.sort(np.exp(value))
    assert np.abs(1 - np.exp(-a) - (np.arange(200_000) + 0.5) / 200_000).max() < 0.005


def test_equal_texts_have_equal_fingerprints_in_any_company():
    of = W.Fingerprinter()
    texts = ["", "one", "one two", "a b c d e f " * 50, "x " * 20000, "é 日本 " * 10]
    whole = of(texts)
    for i, t in enumerate(texts):
        assert np.array_equal(of([t])[0], whole[i]) and np.array_equal(W.Fingerprinter()([t, "other words"])[0], whole[i])
    assert not whole[0].any() and (whole[1:] != 0).any(1).all()
    assert W.likeness(whole[:1], whole[:1]) == 1 and W.likeness(whole[:1], whole[1:2]) == 0


def wanted(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return {k: (len(t or ""), hashlib.sha256(W.edited(t or "", rows[(i + 1) % len(rows)][1] or "").encode()).hexdigest()) for i, (k, t) in enumerate(rows)}


def test_edits_follow_the_order_of_ids(spark, docs_of):
    ready(spark)
    words = "the quick brown fox jumps over a lazy dog again and again é日🙂".split()
    rng = np.random.default_rng(1)
    rows = [(int(i), " ".join(rng.choice(words, rng.integers(0, 40)))) for i in rng.choice(10**12, 400, replace=False)] + [(None, "no id at all"), (5, None)]
    of = W.Fingerprinter()
    for own in (rows, rows[:2], rows[:1]):
        got = W.compared(docs_of(own)).collect()
        texts = {k: t or "" for k, t in own}
        assert len(got) == len(own) and {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == wanted(own)
        for r in got[:20]:
            assert r.fingerprint == W.hexed(of([texts[r.doc_id]]))[0] and 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1


def test_repeated_ids_and_empty_table(spark, docs_of):
    ready(spark)
    rows = [(1, "a b"), (1, "a c"), (2, ""), (2, ""), (3, "x y z w")]
    assert sorted((r.doc_id, r.n_chars) for r in W.compared(docs_of(rows)).collect()) == [(1, 3), (1, 3), (2, 0), (2, 0), (3, 7)]
    assert W.compared(docs_of(rows).where("false")).count() == 0
    assert W.fingerprints(docs_of(rows)).count() == 5


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op5_document_fingerprints"](spark, folder).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == wanted(rows)
    assert np.mean([r.near_edited for r in got]) > np.mean([r.near_next for r in got]) + 0.3
