import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pressledger.llm.queries import QUERIES
from pressledger.llm.tables import ready
from pressledger.llm.token_counts import counter, merge_tables, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNT = counter(merge_tables(PATH))
HARD = ["", " ", "aaaaaaaa aaa", "a" * 30011, "<|endoftext|>a<|endoftext|><|endoftext|>", "it's we'll  \n\n x\t", "日本語 🙂🙂 x", "1234 56,7!!", "\x00\u00a0é" * 50]


def counted(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_hard_texts():
    assert COUNT(HARD) == counted(HARD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_counts_equal_the_library(texts):
    assert COUNT(texts) == counted(texts)


def test_rows(docs_of, spark):
    ready(spark)
    rows = [(1, None), (2, "hello world"), (2, "hello world"), (None, "é"), *[(10 + i, t) for i, t in enumerate(HARD)]]
    got = sorted(((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts(docs_of(rows), PATH).collect()))
    assert got == sorted((i or -1, len((t or "").encode()), n) for (i, t), n in zip(rows, counted([t or "" for _, t in rows]), strict=True))
    assert token_counts(docs_of(rows).where("false"), PATH).count() == 0


def test_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    wanted = dict(zip(texts, counted(list(texts.values())), strict=True))
    for r in QUERIES["op8_token_counts"](spark, folder).collect():
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (wanted[r.doc_id], len(texts[r.doc_id].encode()), wanted[r.doc_id] > 1024)


def test_other_models_are_refused():
    with pytest.raises((ValueError, KeyError)):
        merge_tables(public_tokenizers.path("word_bpe_49k.json"))
