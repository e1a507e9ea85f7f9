"""Alignment of two tokenizers against a byte-by-byte brute force with both libraries on whole texts."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pressledger.llm import token_alignment
from pressledger.llm.queries import QUERIES
from pressledger.llm.token_alignment import Alignment, Csr, Pair, bounds, files, overlaps, product, shared_groups, transposed
from pressledger.llm.token_counts import byte_characters

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(BYTE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE)
VALUE = {c: i for i, c in enumerate(byte_characters())}
HARD = ["", " ", "a", "  two  spaces ", "tab\t x\n\n y \n", "日本語 テキスト 🙂🙂", "a" * 5000, "<|endoftext|> <s> </s> <unk> <0x41>", "mark▁er", "▁", "it's we'll 12345 !!!",
        "é́    x", "\x00 \x1c y", "x \n z\n", "foo　bar 　 baz", "word " * 3000]


def spell_a(i):
    name = A.id_to_token(i)
    return bytes(VALUE[c] for c in name) if all(c in VALUE for c in name) else name.encode()


def spell_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()


def tokens(text):
    """(ids, ends) of both, or None where the bytes differ."""
    if not text:
        return None
    out = []
    for ids, spell in ((A.encode(" " + text, add_special_tokens=False).ids, spell_a), (B.encode(text), spell_b)):
        parts = [spell(i) for i in ids]
        if b"".join(parts) != (" " + text).encode():
            return None
        out.append((ids, np.cumsum([len(p) for p in parts]).tolist()))
    return out


def brute(texts):
    """The contract's row of each text."""
    found, counts = [], Counter()
    for text in texts:
        both = tokens(text)
        if both is None:
            found.append(None)
            continue
        (a, ae), (b, be) = both
        common = sorted(set(ae) & set(be))
        by_end = [dict(zip(e, i, strict=True)) for i, e in both]
        links = [(by_end[0][e], by_end[1][e]) for e in common]
        groups, before = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends, strict=True) if before < e <= end) for ids, ends in both) if len(a) < 2000 else None)
            before = end
        found.append((len(a), len(b), links, groups))
        counts.update(links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = f
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if None not in groups else None
        rows.append((n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(got, texts, keys):
    wanted = sorted(zip(keys, brute(texts), strict=True), key=str)
    rows = sorted(((r.doc_id, tuple(r[c] for c in COLUMNS)) for r in got), key=str)
    assert len(rows) == len(wanted)
    for (i, own), (j, other) in zip(rows, wanted, strict=True):
        assert i == j and own[:6] == other[:6] and other[6] in (None, own[6])


def test_hard_texts_nulls_and_repeats(docs_of, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", 3000)  # several chunks a task
    rows = [(i, t) for i, t in enumerate(HARD)] + [(3, HARD[3]), (None, "no id"), (90, None), (91, "word word the the the")]
    same(Alignment(docs_of(rows), BYTE, PIECE).documents().collect(), [t for _, t in rows], [i for i, _ in rows])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n\t .▁日' \x1c"), max_size=40), min_size=1, max_size=4))
def test_stretches_align_like_whole_texts(texts):
    aligned = token_alignment.Aligned(PAIR)
    at, counts = aligned.of(texts)
    edges = bounds(counts)
    for k, text in enumerate(texts):
        own, both = at[edges[k]:edges[k + 1]], tokens(text)
        fits = bool(len(own)) and bool(aligned.numbers[own, 3].all())
        assert fits == (both is not None)
        if fits:
            assert aligned.numbers[own, :2].sum(axis=0).tolist() == [len(ids) for ids, _ in both]


PAIR = Pair(*files(BYTE, PIECE))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 6), st.integers(1, 6), st.integers(1, 6), st.randoms(use_true_random=False))
def test_product_equals_dense(rows, inner, columns, rng):
    dense = [np.array([[rng.choice([0, 0, 1, 2]) for _ in range(m)] for _ in range(n)]) for n, m in ((rows, inner), (inner, columns))]

    def sparse(matrix):
        at = [np.flatnonzero(r) for r in matrix]
        return Csr(bounds(np.array([len(x) for x in at])), np.concatenate(at), np.concatenate([r[x] for r, x in zip(matrix, at, strict=True)]))

    def full(matrix, shape):
        out = np.zeros(shape, int)
        out[matrix.owners(), matrix.columns] = matrix.values
        return out

    assert np.array_equal(full(product(*map(sparse, dense)), (rows, columns)), dense[0] @ dense[1])
    assert np.array_equal(full(transposed(sparse(dense[0]), inner), (inner, rows)), dense[0].T)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=12), st.randoms(use_true_random=False), st.integers(1, 9))
def test_overlaps_and_groups(sizes, rng, block):
    total = sum(sizes)
    cuts = sorted({total, *(rng.randrange(1, total + 1) for _ in range(4))})
    a, b = np.array(sizes), np.diff([0, *cuts])
    before, token_alignment.PRODUCT_BYTES = token_alignment.PRODUCT_BYTES, block
    try:
        got = Counter()
        for rows, columns, shared in overlaps(a, b):
            got.update(dict(zip(zip(rows.tolist(), columns.tolist(), strict=True), shared.tolist(), strict=True)))
    finally:
        token_alignment.PRODUCT_BYTES = before
    owner = [np.repeat(np.arange(len(x)), x) for x in (a, b)]
    assert got == Counter(zip(owner[0].tolist(), owner[1].tolist(), strict=True))
    common = sorted(set(np.cumsum(a)) & set(np.cumsum(b)))
    group = [np.searchsorted(common, np.cumsum(x)) for x in (a, b)]
    rows, columns, places = shared_groups(a, b)
    assert sorted(zip(rows, columns, places, strict=True)) == sorted((i, j, g) for i, g in enumerate(group[0]) for j, h in enumerate(group[1]) if g == h)


def test_links_and_counts(docs_of):
    texts = ["unbelievably tokenised words", "words", None, "▁"]
    own = Alignment(docs_of(list(enumerate(texts))), BYTE, PIECE)
    links = [r for r in own.links().collect() if r.doc_id == 0]
    (a, ae), (b, be) = tokens(texts[0])
    spans = [list(zip([0, *e[:-1]], e, strict=True)) for e in (ae, be)]
    wanted = {(i, j, a[i], b[j], min(x[1], y[1]) - max(x[0], y[0])) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if min(x[1], y[1]) > max(x[0], y[0])}
    assert {(r.a_at, r.b_at, r.a, r.b, r.weight) for r in links if r.kind == "overlap"} == wanted
    assert {r.doc_id for r in own.links().collect()} == {0, 1}
    ends = [dict(zip(e, i, strict=True)) for text in texts[:2] for i, e in tokens(text)]
    counts = Counter((ends[k][e], ends[k + 1][e]) for k in (0, 2) for e in ends[k].keys() & ends[k + 1].keys())
    assert {(r.a, r.b): r["count"] for r in own.counts().collect()} == counts
    assert own.counts().where("best").select("b").distinct().count() == own.counts().select("b").distinct().count()


def test_empty_table_and_clashing_columns(docs_of):
    docs = docs_of([(1, "a b")]).withColumn("chunk", F.lit(1)).withColumn("count", F.lit(2)).withColumn("a", F.lit("a"))
    assert Alignment(docs, BYTE, PIECE).documents().count() == 1
    assert Alignment(docs.where("false"), BYTE, PIECE).documents().collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises((ValueError, KeyError)):
        files(public_tokenizers.path("word_bpe_49k.json"), PIECE)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    same(QUERIES["op13_token_alignment"](spark, folder).collect(), [t for _, t in rows], [i for i, _ in rows])
