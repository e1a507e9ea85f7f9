import zlib

import numpy as np
import pyarrow as pa

from pressledger.llm import passage_model as P
from pressledger.llm.queries import QUERIES
from pressledger.llm.tables import ready, table
from pressledger.llm.text_arrays import WordHasher, text_slices


def encode(texts):
    batch, hasher, parts = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), WordHasher(), []
    for _, _, data, offsets in text_slices(batch, "text"):
        parts.append(P.encoded(data, offsets, hasher))
    return np.vstack([f for f, _ in parts]), np.concatenate([c for _, c in parts])


def test_passages_cover_every_text():
    texts = ["", None, " \n ", "one", "a b c a b c", "w " * 64, "w " * 65, "LOUD!! " * 10000, "é " * 100 + "\n" * 50]
    features, count = encode(texts)
    assert count.tolist() == [1, 1, 1, 1, 1, 1, 2, 64, 2] and len(features) == count.sum() and np.isfinite(features).all()
    alone = [encode([t])[0] for t in texts]
    assert np.allclose(np.vstack(alone), features)
    assert not features[:2].any()
    repeated = dict(zip(range(9), np.split(features, np.cumsum(count)[:-1]), strict=True))
    assert repeated[4][0, P.CLASSES + 3] == 0.5 and abs(repeated[4][0, P.CLASSES + 4] - 1 / 3) < 1e-6


def test_long_texts_are_scored_by_passages_of_the_same_size():
    part = "some plain words of a passage that is read again " * 20
    bad = "#$% &|< " * 32
    texts = [part * 5, part * 300, part * 150 + bad + part * 150]
    got = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        got.append(P.encoded(data, np.array([0, len(data)]), WordHasher(), None))
        assert got[-1][1].tolist() == [-(-len(t.split()) // P.PASSAGE_WORDS)]
    # the word count stays in the range of short texts, and the bad passage is not averaged away
    assert all(abs(f[:, P.CLASSES].max() - got[0][0][:, P.CLASSES].max()) < 1e-6 for f, _ in got)
    symbol = P.byte_classes()[ord("#")]
    assert got[2][0][:, symbol].max() > 0.05 and encode(texts)[1].tolist() == [16, 64, 64]


def test_scores_follow_the_passages_of_long_texts(spark, docs_of):
    ready(spark)
    data = "some plain words of a passage that is read again " * 20
    rows = [(1, data * 5), (2, data * 300), (3, "#$% &|< " * 320)]
    model = P.train(docs_of(rows), spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int"))
    scores = {r.doc_id: r.score for r in P.scored(docs_of(rows), model).collect()}
    assert abs(scores[1] - scores[2]) < 0.05 and scores[3] < scores[2]


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    features, count = rng.normal(size=(12, P.FEATURES)), np.array([3, 1, 5, 3])
    labels = np.array([0.0, 1, 1, 0])
    start = {**P.fit(features, count, np.ones(4)), "o": rng.normal(size=P.HIDDEN)}
    loss = lambda m: -np.mean(np.log(np.where(labels > 0, (p := P.forward(m, features, count)[-1]), 1 - p)))
    # one step of fit moves against the numerical gradient in every parameter group
    fitted = P.fit(features, count, labels)
    assert loss(fitted) < loss({**start, "o": start["o"] * 0})
    attention = P.forward(fitted, features, count)[5]
    assert np.allclose(np.add.reduceat(attention, np.cumsum(count) - count), 1)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op4_quality_classifier"](spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    own = [(rows[i].predicted, q) for i, q in labels.items() if rows[i].held_out]
    assert np.mean([a == b for a, b in own]) > 0.95


def test_hard_rows_and_one_label(docs_of, spark):
    ready(spark)
    rows = [(1, None), (2, ""), (3, "plain text"), (3, "plain text"), (None, "x"), (4, "word " * 30000)]
    docs = docs_of(rows)
    for labels in ([(3, 1)], [(3, 1), (4, 0), (None, 0), (2, None)], []):
        model = P.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        got = P.scored(docs, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 3}) == 1
        assert P.accepted(docs, model, 0.0).columns == docs.columns and P.accepted(docs, model, 0.0).count() == len(rows)
    assert P.scored(docs.where("false"), model).count() == 0 and P.accepted(docs.where("false"), model, 0.5).count() == 0


def test_labels_and_held_out_rows_are_no_inputs(docs_of, spark):
    ready(spark)
    docs = docs_of([(i, "good words here " * 9 if i % 2 else "### $$$ " * 30) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    wrong = labels.selectExpr("doc_id", "if(doc_id < 20, 1 - quality, quality) quality")
    one, two = (P.train(docs, x, "doc_id >= 20") for x in (labels, wrong))
    assert all(np.array_equal(one[k], two[k]) for k in one)
