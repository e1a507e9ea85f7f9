import struct

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from pressledger.llm import sentence_pieces as S
from pressledger.llm.queries import QUERIES
from pressledger.llm.tables import ready

PATH = public_tokenizers.path("piece_bpe_32k.model")
with open(PATH, "rb") as file:
    MODEL = file.read()
LIBRARY, CODEC = sentencepiece.SentencePieceProcessor(model_proto=MODEL), S.Codec(S.parsed(MODEL))
HARD = ["", " ", "  a  b ", "\n\n", "▁", "▁▁x", "日本語🙂", "\x00é", "a" * 4000, "x  y   z ", "Ünï " * 50]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_ids_and_text_equal_the_library(texts):
    ids = CODEC.encode(texts)
    assert ids == LIBRARY.encode(texts)
    assert CODEC.decode(ids) == [LIBRARY.decode(i) for i in ids]


def message(*parts):
    """A protobuf message of (number, bytes | int | float) fields."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])
    out = b""
    for number, value in parts:
        if isinstance(value, int):
            out += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def unigram(prefix=1, squeeze=1):
    pieces = [("<unk>", 0.0, 2), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256)], ("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.5, 1), ("ab", -4.0, 1),
              ("▁a", -3.2, 1), ("▁ab", -5.0, 1), ("ba", -4.1, 1), ("é", -6.0, 1)]
    return message(*[(1, message((1, p.encode()), (2, s), (3, k))) for p, s, k in pieces], (2, message((3, 1), (35, 1))),
                   (3, message((1, b"identity"), (3, prefix), (4, squeeze), (5, 1))))


@pytest.mark.parametrize("prefix,squeeze", [(1, 1), (0, 0), (1, 0)])
def test_a_unigram_model_equals_the_library(prefix, squeeze):
    model = unigram(prefix, squeeze)
    library, codec = sentencepiece.SentencePieceProcessor(model_proto=model), S.Codec(S.parsed(model))
    texts = ["ab", "abba ab  a", " b", "aé日", "a b ", ""]
    assert codec.encode(texts) == library.encode(texts)


def test_unknown_features_are_refused():
    with pytest.raises(ValueError):
        S.parsed(message((1, message((1, b"x"), (2, 0.0), (3, 4))), (2, message((3, 1)))))


def test_rows_round_trip(docs_of, spark):
    ready(spark)
    rows = [(1, None), (2, "hello  world"), (2, "hello  world"), (None, "é"), *[(10 + i, t) for i, t in enumerate(HARD)]]
    got = S.encoded(docs_of(rows), PATH)
    seen = got.collect()
    assert len(seen) == len(rows) and all(r.parity for r in seen)
    assert {r.doc_id for r in seen if not r.round_trip} == {10 + HARD.index("▁"), 10 + HARD.index("▁▁x")}
    texts = {r.doc_id: r.text for r in S.decoded(got, PATH).collect()}
    assert all(texts[i] == (t or "").replace("▁", " ") for i, t in rows)
    assert S.encoded(docs_of(rows).where("false"), PATH).count() == 0
    assert all(r.parity is None for r in S.encoded(docs_of(rows), PATH, verify=False).collect())


def test_query(spark):
    rows = QUERIES["op2_sentence_pieces"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.parity and r.round_trip for r in rows)
