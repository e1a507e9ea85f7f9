"""Counts the tokens of a byte-level BPE by merging whole arrays of pre-tokens in step.

The distinct pre-tokens of a batch lie in one flat array of symbols. In every round each pre-token finds its lowest-ranked pair and
all pre-tokens merge theirs at once; those without a pair are done, and their surviving symbols are their tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import released

#: pre-tokens whose counts a task remembers; the memory is emptied when full, which costs time and changes no count
REMEMBERED = 400_000
#: bytes of pre-tokens merged at a time
MERGED_BYTES = 4 << 20
#: fixed value: the pattern that splits a text before byte-level BPE
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.int32(2**31 - 1)


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary: printable Latin-1 ones stand for themselves, the rest
    follow from U+0100 in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


def merge_tables(path: str) -> dict:
    """What the merges need of a tokenizer file: symbols of bytes, sorted pairs with rank and product, special strings."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, vocabulary = content["model"], content["model"]["vocab"]
    pre = content["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or content["normalizer"]:
        raise ValueError(f"{path} is no plain byte-level BPE")
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left, right = (np.array([vocabulary[p[side]] for p in pairs], np.int64) for side in (0, 1))
    made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
    keys = left << 32 | right
    order = np.argsort(keys, kind="stable")
    return {"bytes": np.array([vocabulary[c] for c in byte_characters()], np.int32), "keys": keys[order],
            "ranks": np.arange(len(pairs), dtype=np.int32)[order], "made": made,
            "special": sorted((t["content"] for t in content["added_tokens"]), key=len, reverse=True)}


def symbols_left(words: list[bytes], tables: dict) -> np.ndarray:
    """How many symbols each of the given non-empty byte strings has when no merge applies any more."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    symbols = tables["bytes"][np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    counts = sizes.copy()
    keys, ranks, made = tables["keys"], tables["ranks"], tables["made"]
    while len(symbols):
        wanted = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        rank = np.full(len(symbols), NONE, np.int32)
        rank[:-1] = np.where((keys[at] == wanted) & (owner[1:] == owner[:-1]), ranks[at], NONE)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        size = np.diff(np.r_[first, len(symbols)])
        lowest = np.minimum.reduceat(rank, first)
        chosen = (rank == np.repeat(lowest, size)) & (rank != NONE)
        # in a run of equal symbols every second pair overlaps the one before: merge from the left
        marked = np.flatnonzero(chosen)
        starts = np.flatnonzero(np.r_[True, np.diff(marked) != 1]) if len(marked) else marked
        odd = (np.arange(len(marked)) - np.repeat(starts, np.diff(np.r_[starts, len(marked)]))) % 2 == 1
        marked = marked[~odd]
        symbols = symbols.copy()
        symbols[marked] = made[rank[marked]]
        gone = np.zeros(len(symbols), bool)
        gone[marked + 1] = True
        counts -= np.bincount(owner[marked + 1], minlength=len(counts))
        # finished pre-tokens leave the arrays, so later rounds touch only what still merges
        gone |= np.repeat(lowest == NONE, size)
        symbols, owner = symbols[~gone], owner[~gone]
    return counts


def counter(tables: dict):
    """A function from texts to token counts that remembers pre-tokens."""
    import regex

    find = regex.compile(PATTERN).findall
    cut = regex.compile("|".join(regex.escape(s) for s in tables["special"])) if tables["special"] else None
    known: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        pieces = [find(text) if cut is None or not cut.search(text) else None for text in texts]
        specials = [0] * len(texts)
        for i, piece in enumerate(pieces):
            if piece is None:
                parts = cut.split(texts[i])
                specials[i], pieces[i] = len(parts) - 1, [token for part in parts for token in find(part)]
        fresh = set().union(*pieces)
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
        fresh = sorted(fresh - known.keys(), key=len)
        encoded = [token.encode() for token in fresh]
        first = size = 0
        for i, word in enumerate(encoded):
            size += len(word)
            if size >= MERGED_BYTES or i == len(encoded) - 1:
                known.update(zip(fresh[first:i + 1], symbols_left(encoded[first:i + 1], tables).tolist(), strict=True))
                first, size = i + 1, 0
        return [sum(map(known.__getitem__, piece)) + extra for piece, extra in zip(pieces, specials, strict=True)]

    return count


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) of every row, as the tokenizer file at ``path`` counts whole texts without added tokens.

    The file is read once, by the driver; its tables (about 1 MB, fixed by the vocabulary) travel with the function. Special strings
    inside a text count one each. Null texts are empty: 0 bytes and 0 tokens. Repeated rows stay, other columns are not read. Rows
    never leave their task, so skewed sources or copies cannot meet in one.
    """
    tables = merge_tables(path)
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tables)
        for batch in batches:
            texts, counts = [t or "" for t in batch.column(1).to_pylist()], []
            first = size = 0
            for i, text in enumerate(texts):
                size += len(text)
                if size > 1 << 20 or i == len(texts) - 1:
                    counts += count(texts[first:i + 1])
                    first, size = i + 1, 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], [key, "n_bytes", "n_tokens"])

    own = docs.select(F.col(key), F.col(text).alias("_text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("_bytes"))
    return own.mapInArrow(released(run), schema)
