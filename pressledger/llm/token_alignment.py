"""Alignment of the tokens of two tokenizers over the same bytes.

Tokens and the bytes that they cover are sparse matrices in compressed rows (CSR). The product of one tokenizer's token-byte matrix with the
other's transposed, row by row after Gustavson (1978), holds for each two tokens the bytes that they share: the overlap links. Where
tokens of both end at one byte the text is cut into groups; the product of the token-group matrices holds the links inside groups.

Both tokenizers end a token before every space that follows another than white space, so texts are cut there and each different stretch
is aligned once. Counts of linked ids over the corpus come back to the documents by chunks of documents, each of which names an id pair once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sentence_pieces import MARKER, parsed
from .tables import pinned, released
from .token_counts import byte_characters

#: bytes of texts in a chunk of documents; one longer text is a chunk of its own
CHUNK_BYTES = 4 << 20
#: characters of texts that are aligned at a time
SLICE_BYTES = 1 << 18
#: bytes that a task's remembered stretches take, about; they are forgotten between chunks when so many are reached, which changes no result
REMEMBERED_BYTES, STRETCH_BYTES = 64 << 20, 320
#: bytes of stretches that are encoded as one text
PART = 1 << 13
#: bytes of tokens whose products are taken at a time
PRODUCT_BYTES = 1 << 20
#: a space after another character than white space begins a stretch
CUT = re.compile(r"(?<=\S)(?= )")
MIXED = re.compile(r"\s ")


@dataclass
class Csr:
    """Compressed rows: the columns of row i are ``columns[starts[i]:starts[i + 1]]``, with their ``values``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def rows(self, first: int, last: int) -> Csr:
        lo, hi = self.starts[first], self.starts[last]
        return Csr(self.starts[first:last + 1] - lo, self.columns[lo:hi], self.values[lo:hi])


def bounds(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def counting(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), then the same for each further start."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def token_bytes(sizes: np.ndarray) -> Csr:
    """Token-byte incidence of tokens that cover the given numbers of bytes one after the other."""
    total = int(sizes.sum())
    return Csr(bounds(sizes), np.arange(total), np.ones(total, np.int64))


def transposed(matrix: Csr, columns: int) -> Csr:
    order = np.argsort(matrix.columns, kind="stable")
    return Csr(bounds(np.bincount(matrix.columns, minlength=columns)), matrix.owners()[order], matrix.values[order])


def product(left: Csr, right: Csr) -> Csr:
    """left x right by Gustavson's rows: every entry (i, k) brings row k of ``right`` into row i, and equal columns of a row are added."""
    sizes = np.diff(right.starts)[left.columns]
    at = counting(right.starts[left.columns], sizes)
    rows, columns, values = np.repeat(left.owners(), sizes), right.columns[at], np.repeat(left.values, sizes) * right.values[at]
    order = np.lexsort((columns, rows))
    rows, columns, values = rows[order], columns[order], values[order]
    first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])]) if len(rows) else np.zeros(0, np.int64)
    added = np.add.reduceat(values, first) if len(first) else values
    return Csr(bounds(np.bincount(rows[first], minlength=len(left.starts) - 1)), columns[first], added)


def row_blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last) of runs of tokens that cover about PRODUCT_BYTES."""
    edges = np.unique(np.r_[0, np.flatnonzero(np.diff(np.cumsum(sizes) // PRODUCT_BYTES)) + 1, len(sizes)])
    yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def overlaps(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a token, b token, bytes shared) of all tokens that overlap, for tokens over the same bytes; some rows of the product at a time."""
    ends, a_starts, b_starts = np.cumsum(a_sizes), bounds(a_sizes), bounds(b_sizes)
    for first, last in row_blocks(a_sizes):
        lo, hi = int(a_starts[first]), int(ends[last - 1])
        one = int(np.searchsorted(b_starts, lo, side="right")) - 1
        many = int(np.searchsorted(b_starts, hi, side="left"))
        inside = np.diff(np.clip(b_starts[one:many + 1], lo, hi))  # bytes of each b token between lo and hi
        shared = product(token_bytes(a_sizes[first:last]), transposed(token_bytes(inside), hi - lo))
        yield shared.owners() + first, shared.columns + one, shared.values


def group_incidence(ends: np.ndarray, common: np.ndarray) -> Csr:
    """Token-group incidence: the group of a token is the first common end at or behind its own."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(common, ends), np.ones(len(ends), np.int64))


def shared_groups(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a token, b token, group) of all tokens that lie in one group."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    common = np.intersect1d(a_ends, b_ends)
    groups = group_incidence(a_ends, common)
    links = product(groups, transposed(group_incidence(b_ends, common), len(common)))
    return links.owners(), links.columns, groups.columns[links.owners()]


class Pair:
    """The two tokenizers, encoding stretches that begin with a space."""

    def __init__(self, byte_file: str, piece_model: bytes, tables: tuple[list[bytes], list[bytes], bool]) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.a_bytes, self.b_bytes, self.cuts = tables
        self.space = self.b.piece_to_id(MARKER)
        self.sizes = [np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes)]
        # how an id is written before another of its side, and as the last of its side in a group
        self.written = [f"{i}{end}" for table, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for end in ends for i in range(len(table))]

    def stretches(self, text: str) -> list[str]:
        """The stretches of space + text, without the space that each begins with."""
        if not self.cuts:
            return [text]
        whole = " " + text
        return text.split(" ") if not MIXED.search(whole) else [s[1:] for s in CUT.split(whole)]

    def encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and B, how many each stretch has, and whether the bytes of both are the stretch's; stretches where they are not have none."""
        own = [b" " + s.encode() for s in stretches]
        lengths = np.fromiter(map(len, own), np.int64, len(own))
        # no token crosses from one stretch to the next, so many are encoded as one text, unless white space at an end could join another stretch
        parts = np.unique(np.r_[0, np.flatnonzero(np.diff(np.cumsum(lengths) // PART)) + 1, len(own)]).tolist()
        if self.cuts and not any(not s or s[-1].isspace() for s in stretches):
            texts = [" ".join(stretches[i:j]) for i, j in zip(parts[:-1], parts[1:], strict=True)]
            found = self._together(texts, b"".join(own), lengths)
            if found is not None:
                return *found, np.ones(len(own), bool)
        sides = self._sides(stretches)
        counts = [np.fromiter(map(len, ids), np.int64, len(ids)) for ids in sides]
        flat = [np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in zip(sides, counts, strict=True)]
        tables = (self.a_bytes, self.b_bytes)
        fits = np.array([all(b"".join(map(table.__getitem__, ids[k])) == own[k] for ids, table in zip(sides, tables, strict=True)) for k in range(len(own))], bool)
        return *(ids[np.repeat(fits, n)] for ids, n in zip(flat, counts, strict=True)), *(n * fits for n in counts), fits

    def _sides(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B for texts without the space that both begin with; the library of B adds none to an empty text."""
        spelled = [ids or [self.space] for ids in self.b.encode(texts, num_threads=1)]
        return [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], spelled

    def _together(self, texts: list[str], whole: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and counts by stretch of joined texts, if the tokens' bytes are the texts' and a token ends with every stretch."""
        out, wanted = [], np.cumsum(lengths)
        for lists, table, sizes in zip(self._sides(texts), (self.a_bytes, self.b_bytes), self.sizes, strict=True):
            ids = np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))
            ends = np.cumsum(sizes[ids])
            at = np.searchsorted(ends, wanted)
            if not len(ends) or ends[-1] != wanted[-1] or (ends[at] != wanted).any() or b"".join(map(table.__getitem__, ids.tolist())) != whole:
                return None
            out.append((ids, np.diff(np.r_[0, at + 1])))
        return out[0][0], out[1][0], out[0][1], out[1][1]


class Aligned:
    """Stretches that a task has aligned, by number, and the id pairs that their tokens link, by number."""

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.strings: list[str] = []
        self.numbers = np.zeros((0, 4), np.int64)  # a tokens, b tokens, groups, whether the bytes fit
        self.starts = np.zeros(1, np.int64)  # where each stretch's pairs begin
        self.pairs = np.zeros(0, np.int64)
        self.keys: dict[int, int] = {}

    def learn(self, fresh: list[str]) -> None:
        """Aligns stretches that are not known yet. Those whose bytes differ have no tokens."""
        a_ids, b_ids, a_counts, b_counts, fits = self.pair.encode(fresh)
        a_sizes, b_sizes = self.pair.sizes[0][a_ids], self.pair.sizes[1][b_ids]
        a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        linked = [np.zeros((2, 0), np.int64)]
        for rows, columns, _ in overlaps(a_sizes, b_sizes):
            together = a_ends[rows] == b_ends[columns]
            linked.append(np.stack([rows[together], columns[together]]))
        rows, columns = np.concatenate(linked, axis=1)
        a_last = bounds(a_counts)
        links = np.searchsorted(rows, a_last)
        common = np.intersect1d(a_ends, b_ends)
        groups = np.searchsorted(common, np.r_[0, a_ends][a_last], side="right")  # groups up to the end of each stretch
        written, last = self.written(a_ids, b_ids, group_incidence(a_ends, common), group_incidence(b_ends, common), len(common))
        edges = last[groups].tolist()
        pairs, place = np.unique(a_ids[rows] << 32 | b_ids[columns], return_inverse=True)
        numbers = np.array([self.keys.setdefault(k, len(self.keys)) for k in pairs.tolist()], np.int64)
        before = len(self.known)
        self.known.update(zip(fresh, range(before, before + len(fresh)), strict=True))
        self.strings += ["".join(written[i:j]) for i, j in zip(edges[:-1], edges[1:], strict=True)]
        self.numbers = np.concatenate([self.numbers, np.stack([a_counts, b_counts, np.diff(groups), fits], axis=1)])
        self.starts = np.r_[self.starts, self.starts[-1] + links[1:]]
        self.pairs = np.r_[self.pairs, numbers[place]]
        self.held += sum(map(len, self.strings[before:])) + STRETCH_BYTES * len(fresh)

    def written(self, a_ids: np.ndarray, b_ids: np.ndarray, a_groups: Csr, b_groups: Csr, many: int) -> tuple[list[str], np.ndarray]:
        """The groups as pieces of text (``a1,`` ``a2|`` ``b1;`` and so on), read off the token-group incidences by columns, and where each group begins."""
        a, b = transposed(a_groups, many), transposed(b_groups, many)
        sizes = np.stack([np.diff(a.starts), np.diff(b.starts)], axis=1)
        begin = bounds(sizes.ravel())
        names = np.empty(begin[-1], np.int64)
        tables = np.cumsum([0, *(len(t) for t in (self.pair.a_bytes, self.pair.a_bytes, self.pair.b_bytes))])
        for side, ids in enumerate((a_ids, b_ids)):
            names[counting(begin[side:-1:2], sizes[:, side])] = ids + tables[2 * side]
            names[begin[side + 1::2] - 1] += tables[2 * side + 1] - tables[2 * side]
        return list(map(self.pair.written.__getitem__, names.tolist())), begin[::2]

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the stretches of all texts, one text after the other, and how many each has. Empty texts have none."""
        parts = [self.pair.stretches(t) if t else [] for t in texts]
        known = self.known
        fresh = [s for s in set().union(*parts) if s not in known]
        single = [s for s in fresh if not s or s[-1].isspace()]  # the few that are encoded one by one
        for group in ([s for s in fresh if s and not s[-1].isspace()] if single else fresh, single):
            first = size = 0
            for i, stretch in enumerate(group):
                size += len(stretch)
                if size >= SLICE_BYTES or i == len(group) - 1:
                    self.learn(group[first:i + 1])
                    first, size = i + 1, 0
        counts = np.array([len(p) for p in parts], np.int64)
        return np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum())), counts


FIRST_SCHEMA = ("chunk long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, stretches binary, "
                "linked binary, a int, b int, pair int, n long")


def _first(byte_file: str, piece_model: bytes, tables: tuple, key: str, key_type: pa.DataType):
    """Rows of three kinds, by chunk: documents (``stretches`` holds the numbers of theirs, compressed), one row with the pairs of every stretch used
    (``linked``, compressed: steps between the numbers of stretches, how many pairs each has, pairs), and one row for each id pair with its links (``a``, ``b``, ``n``)."""
    names = [key, *(field.split()[0] for field in FIRST_SCHEMA.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        press = zstandard.ZstdCompressor(level=3).compress
        aligned = Aligned(Pair(byte_file, piece_model, tables))
        number, size = (TaskContext.get().partitionId() << 32), 0
        used: list[np.ndarray] = []

        def rows(count: int, **columns) -> pa.RecordBatch:
            types = {"groups_sha256": pa.string(), "stretches": pa.binary(), "linked": pa.binary(), "a": pa.int32(), "b": pa.int32(), "pair": pa.int32(), key: key_type}
            columns["chunk"] = np.full(count, number)
            return pa.RecordBatch.from_arrays([
                (columns[c] if isinstance(columns[c], pa.Array) else pa.array(columns[c], types.get(c, pa.int64()))) if c in columns
                else pa.nulls(count, types.get(c, pa.int64())) for c in names], names)

        def closed() -> Iterator[pa.RecordBatch]:
            """The chunk's dictionary; afterwards a new chunk begins."""
            nonlocal number, size
            if not used:
                return
            counts = np.bincount(np.concatenate(used), minlength=len(aligned.known))
            stretches = np.flatnonzero(counts)
            sizes = np.diff(aligned.starts)[stretches]
            pairs = aligned.pairs[counting(aligned.starts[stretches], sizes)]
            # steps and sizes are small numbers, which compress well
            dictionary = np.r_[len(stretches), np.diff(stretches, prepend=0), sizes, pairs].astype(np.int32)
            yield rows(1, linked=[press(dictionary.tobytes())])
            times = np.bincount(pairs, weights=np.repeat(counts[stretches], sizes), minlength=len(aligned.keys)).astype(np.int64)
            ids = np.fromiter(aligned.keys, np.int64, len(aligned.keys))
            there = np.flatnonzero(times)
            for part in np.array_split(there, len(there) // 20_000 + 1):
                yield rows(len(part), a=(ids[part] >> 32).astype(np.int32), b=(ids[part] & 0xFFFFFFFF).astype(np.int32), pair=part.astype(np.int32), n=times[part])
            used.clear()
            number, size = number + 1, 0
            if aligned.held > REMEMBERED_BYTES:
                aligned.forget()

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            edges = np.unique([0, *np.flatnonzero(np.diff(np.cumsum([len(t) for t in texts]) // SLICE_BYTES)) + 1, len(texts)])
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                length = sum(map(len, texts[lo:hi]))
                if size and size + length > CHUNK_BYTES:
                    yield from closed()
                at, counts = aligned.of(texts[lo:hi])
                begin = bounds(counts)
                sums = np.zeros((len(at) + 1, 5), np.int64)
                own = aligned.numbers[at]
                np.cumsum(np.c_[own, np.diff(aligned.starts)[at]], axis=0, out=sums[1:])
                total = sums[begin[1:]] - sums[begin[:-1]]
                whole = (total[:, 3] == counts) & (counts > 0)
                total[~whole] = 0
                places, strings = begin.tolist(), aligned.strings
                digests = [hashlib.sha256("".join(map(strings.__getitem__, at[places[k]:places[k + 1]].tolist()))[:-1].encode()).hexdigest() if whole[k] else "" for k in range(hi - lo)]
                at = at.astype(np.int32)
                kept = [at[places[k]:places[k + 1]] if whole[k] else at[:0] for k in range(hi - lo)]
                yield rows(int(hi - lo), **{key: batch.column(0).slice(lo, hi - lo)}, n_a=total[:, 0], n_b=total[:, 1], n_groups=total[:, 2], n_links=total[:, 4],
                           groups_sha256=digests, stretches=[press(k.tobytes()) if len(k) else b"" for k in kept])
                used += [k for k in kept if len(k)]
                size += length
        yield from closed()

    return run


def _counted(key: str):
    """Sums of a chunk's documents over the links of their stretches, from the chunk's rows and the counts of its id pairs."""
    def run(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        is_document = pc.is_valid(rows["stretches"])
        documents, dictionary = rows.filter(is_document), rows.filter(pc.invert(is_document))
        sums = np.zeros((0, 2), np.int64)
        if dictionary.num_rows:
            held = np.frombuffer(unpack(dictionary["linked"][0].as_py()), np.int32).astype(np.int64)
            many = int(held[0])
            stretches, starts, linked = np.cumsum(held[1:many + 1]), bounds(held[many + 1:2 * many + 1]), held[2 * many + 1:]
            own = np.zeros((int(linked.max(initial=-1)) + 1, 2), np.int64)
            own[pairs["pair"].to_numpy()] = np.stack([pairs["best"].to_numpy(), pairs["count"].to_numpy()], axis=1)
            total = np.zeros((len(linked) + 1, 2), np.int64)
            np.cumsum(own[linked], axis=0, out=total[1:])
            sums = np.zeros((int(stretches.max(initial=-1)) + 1, 2), np.int64)
            sums[stretches] = total[starts[1:]] - total[starts[:-1]]
        best, counted = [], []
        for one in documents["stretches"]:
            held = one.as_py()
            found = sums[np.frombuffer(unpack(held), np.int32)].sum(axis=0) if held else (0, 0)
            best.append(int(found[0]))
            counted.append(int(found[1]))
        plain = [key, "n_a", "n_b", "n_groups", "n_links"]
        return pa.table([*(documents[c] for c in plain), pa.array(best, pa.int64()), pa.array(counted, pa.int64()), documents["groups_sha256"]],
                        names=[*plain, "n_best", "count_sum", "groups_sha256"])

    return run


def files(byte_path: str, piece_path: str) -> tuple[str, bytes, tuple[list[bytes], list[bytes], bool]]:
    """The tokenizers' files and the bytes of their tokens, read by the driver (some 6 MB, fixed by the vocabularies); they travel with the functions. The flag
    tells whether tokens of the second end before every space: no piece has the marker behind another character."""
    with open(byte_path, encoding="utf-8") as a, open(piece_path, "rb") as b:
        content, model = a.read(), b.read()
    found = json.loads(content)
    pre = found["pre_tokenizer"]
    if found["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or not pre.get("use_regex", True) or pre["add_prefix_space"] or found["normalizer"]:
        raise ValueError(f"{byte_path} is no plain byte-level BPE")
    value = {c: i for i, c in enumerate(byte_characters())}
    names = {i: p for p, i in found["model"]["vocab"].items()} | {t["id"]: t["content"] for t in found["added_tokens"]}
    # an entry with a character outside the byte alphabet stands for its own text
    a_bytes = [bytes(value[c] for c in p) if all(c in value for c in p) else p.encode() for p in (names.get(i, "") for i in range(max(names) + 1))]
    spec = parsed(model)
    hexed = re.compile(r"<0x([0-9A-F]{2})>").fullmatch
    b_bytes = [bytes([int(hexed(p)[1], 16)]) if hexed(p) else p.replace(MARKER, " ").encode() for p, _, _ in spec["pieces"]]
    pieces = {p for p, _, _ in spec["pieces"]}
    cuts = spec["prefix"] and not spec["squeeze"] and MARKER in pieces and not any(MARKER in p.lstrip(MARKER) for p in pieces)
    return content, model, (a_bytes, b_bytes, cuts)


class Alignment:
    """Alignment of every text of ``docs`` by the tokenizer file at ``byte_path`` (A, over a space and the text) and the SentencePiece model at ``piece_path``
    (B, over the text, to which it adds the space).

    * ``documents``: (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row. Links are pairs of tokens that end at one byte; an id
      pair's count is the number of links with its ids over the corpus; ``n_best`` are links whose count is the highest of their B id.
    * ``counts``: (a, b, count, best) per linked id pair of the corpus.
    * ``links``: (key, kind, a_at, b_at, a, b, weight) of every overlap (``overlap``, weight: bytes shared) and every two tokens of one group
      (``group``, weight: the group's place), for each row; made a text at a time.

    Null and empty texts, and texts whose tokens' bytes differ from theirs, have zeros, an empty digest and no links. Repeated rows stay and count as
    often as they occur; an empty table gives an empty one; other columns are not read. Memory follows one chunk of documents (4 MB of text, or one longer
    text) and the longest stretch without a space. Texts are read once; shuffled are numbers of stretches and, once a chunk, its id pairs.
    """

    def __init__(self, docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> None:
        self.docs, self.key, self.files = docs.select(F.col(key), F.col(text).alias("_text")), key, files(byte_path, piece_path)
        self.kind = docs.schema[key].dataType.simpleString()
        self._rows: DataFrame | None = None
        self._counts: DataFrame | None = None

    def rows(self) -> DataFrame:
        if self._rows is None:
            from pyspark.sql.pandas.types import to_arrow_type

            kind = to_arrow_type(self.docs.schema[self.key].dataType)
            # written before it is grouped, so that a chunk is the same whichever task is repeated
            self._rows = pinned(self.docs.mapInArrow(released(_first(*self.files, self.key, kind)), f"{self.key} {self.kind}, {FIRST_SCHEMA}"))
        return self._rows

    def counts(self) -> DataFrame:
        if self._counts is None:
            sums = pinned(self.rows().where("n is not null").groupBy("a", "b").agg(F.sum("n").alias("count")))
            highest = sums.groupBy(F.col("b").alias("_b")).agg(F.max("count").alias("_most"))
            self._counts = pinned(sums.join(highest, F.col("b") == F.col("_b")).select("a", "b", "count", (F.col("count") == F.col("_most")).alias("best")))
        return self._counts

    def documents(self) -> DataFrame:
        rows = self.rows()
        pairs = rows.where("n is not null").select("chunk", "pair", "a", "b")
        counted = pairs.join(self.counts(), ["a", "b"]).select(F.col("chunk").alias("_chunk"), "pair", "count", F.col("best").cast("long").alias("best"))
        own = rows.where("n is null").select("chunk", self.key, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "stretches", "linked")
        schema = f"{self.key} {self.kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
        return own.groupBy("chunk").cogroup(counted.groupBy("_chunk")).applyInArrow(_counted(self.key), schema)

    def links(self) -> DataFrame:
        given = self.files
        names = [self.key, "kind", "a_at", "b_at", "a", "b", "weight"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pair = Pair(*given)
            for batch in batches:
                for row, text in enumerate(batch.column(1).to_pylist()):
                    a, b, _, _, fits = pair.encode([text]) if text else (*[np.zeros(0, np.int64)] * 4, [False])
                    if not fits[0]:
                        continue
                    ids = [a, b]
                    sizes = [table[x] for table, x in zip(pair.sizes, ids, strict=True)]
                    found = [("overlap", *part) for part in overlaps(*sizes)] + [("group", *shared_groups(*sizes))]
                    for kind, at, by, weight in found:
                        for part in np.array_split(np.arange(len(at)), len(at) // 20_000 + 1):
                            i, j, size = at[part], by[part], len(part)
                            yield pa.RecordBatch.from_arrays([
                                pa.repeat(batch.column(0)[row], size), pa.array([kind] * size, pa.string()), pa.array(i, pa.int64()), pa.array(j, pa.int64()),
                                pa.array(ids[0][i], pa.int32()), pa.array(ids[1][j], pa.int32()), pa.array(weight[part], pa.int64())], names)

        return self.docs.mapInArrow(released(run), f"{self.key} {self.kind}, kind string, a_at long, b_at long, a int, b int, weight long")
