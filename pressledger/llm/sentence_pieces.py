"""SentencePiece models run by the tokenizers library.

The model file is parsed field by field; its normaliser, white-space marker, scores or merges and byte fallback are rebuilt. Every
task encodes its batches with the library's threads, and can hold each result against the SentencePiece library.

Where no piece has the marker behind another character, tokens never cross into a new word. Then a text's ids are those of its words in turn: each
different word is encoded, decoded and held against the SentencePiece library once, and for a text the normalised forms are compared.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import released

MARKER = "▁"
#: fixed values of the model format: kinds of pieces and of models
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: bytes that a task's remembered words take, about; they are forgotten when so many are reached, which changes no result
REMEMBERED_BYTES, WORD_BYTES = 80 << 20, 180
#: characters of texts that are encoded at a time; a longer text is taken alone, its new words a part at a time
SLICE = 1 << 17
#: bytes of words that are encoded as one text
PART = 1 << 13
#: threads that the tokenizers library may use in each worker
THREADS = "2"


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: varints as numbers, everything else as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at:at + size]
        at += size


def parsed(model: bytes) -> dict:
    """Pieces with score and kind, the model's kind, the unknown piece and the normaliser's settings."""
    out = {"pieces": [], "kind": UNIGRAM, "bytes": False, "charsmap": b"", "prefix": True, "squeeze": True, "escape": True, "suffix": False}
    for number, value in fields(model):
        if number == 1:
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(fields(value))
            out["pieces"].append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            spec = dict(fields(value))
            out |= {"kind": spec.get(3, UNIGRAM), "bytes": bool(spec.get(35, 0)), "suffix": bool(spec.get(24, 0))}
        elif number == 3:
            spec = dict(fields(value))
            out |= {"charsmap": spec.get(2, b""), "prefix": bool(spec.get(3, 1)), "squeeze": bool(spec.get(4, 1)), "escape": bool(spec.get(5, 1))}
    out["unknown"] = next((i for i, p in enumerate(out["pieces"]) if p[2] == UNKNOWN), 0)
    if out["kind"] not in (UNIGRAM, BPE) or out["suffix"] or not out["escape"] or any(p[2] == USER_DEFINED for p in out["pieces"]):
        raise ValueError("only unigram and BPE models without user-defined pieces, with escaped prefix white space, are rebuilt")
    out["merges"] = merges(out) if out["kind"] == BPE else []
    return out


def merges(spec: dict) -> list[tuple[str, str]]:
    """Every way to make a piece of two others, best score first; scores of a BPE model are its ranks."""
    normal = {p: s for p, s, kind in spec["pieces"] if kind == NORMAL}
    pairs = [(-score, p[:k], p[k:]) for p, score in normal.items() for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal]
    place = {p: i for i, (p, _, _) in enumerate(spec["pieces"])}
    pairs.sort(key=lambda m: (m[0], place[m[1]], place[m[2]]))
    return [(a, b) for _, a, b in pairs]


def rebuilt(spec: dict):
    """(normaliser, tokenizer) of what ``parsed`` gives; the tokenizer takes normalised text and decodes."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    names = [p for p, _, _ in spec["pieces"]]
    if spec["kind"] == BPE:
        model = models.BPE(vocab={p: i for i, p in enumerate(names)}, merges=spec["merges"], unk_token=names[spec["unknown"]], fuse_unk=True, byte_fallback=spec["bytes"])
    else:
        model = models.Unigram([(p, s) for p, s, _ in spec["pieces"]], spec["unknown"], spec["bytes"])
    tokenizer = Tokenizer(model)
    steps = [normalizers.Precompiled(spec["charsmap"])] if spec["charsmap"] else []
    if spec["squeeze"]:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec["prefix"]:
        steps.append(normalizers.Prepend(MARKER))
    normaliser = normalizers.Sequence([*steps, normalizers.Replace(" ", MARKER)])
    ends = [decoders.Strip(" ", 1, 0)] if spec["prefix"] else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(), *ends])
    return normaliser, tokenizer


def counting(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), then the same for each further start."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class Grown:
    """An array that grows at its end; room is doubled when it is full."""

    def __init__(self, start: np.ndarray) -> None:
        self.room, self.size = start.copy(), len(start)

    def add(self, more: np.ndarray) -> None:
        if self.size + len(more) > len(self.room):
            room = np.empty(max(2 * len(self.room), self.size + len(more)), self.room.dtype)
            room[:self.size] = self.room[:self.size]
            self.room = room
        self.room[self.size:self.size + len(more)] = more
        self.size += len(more)

    @property
    def held(self) -> np.ndarray:
        return self.room[:self.size]


class Codec:
    """Encodes and decodes whole texts with one model; given the model file's bytes, it holds words or texts against the SentencePiece library."""

    def __init__(self, spec: dict, model: bytes | None = None) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", THREADS)  # read by the library when it first encodes
        self.normaliser, self.tokenizer = rebuilt(spec)
        self.prefix = spec["prefix"]
        self.plain = spec["prefix"] and not spec["charsmap"] and not spec["squeeze"]
        self.lengths = np.array([1 if kind == BYTE else len(p.encode()) for p, _, kind in spec["pieces"]], np.int64)  # bytes that a token stands for
        inner = any(MARKER in p.lstrip(MARKER) for p, _, kind in spec["pieces"] if kind == NORMAL)
        self.chunks = None if inner else re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+").findall
        self.library = None
        if model is not None:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.odd: dict[int, str] = {}  # words that do not decode to themselves, with what they do decode to
        self.held = 0
        self.starts, self.ids, self.proven = Grown(np.zeros(1, np.int64)), Grown(np.zeros(0, np.int32)), Grown(np.zeros(0, bool))

    def learn(self, words: list[str]) -> None:
        """Encodes and decodes words that are not known yet, and notes which of them the SentencePiece library treats alike.

        Words stand one after the other in longer texts, as tokens do not cross them anyway; the bytes that tokens stand for tell where words end.
        """
        fresh = [MARKER + w for w in words] if self.prefix else words
        lengths = np.fromiter((len(w.encode()) for w in fresh), np.int64, len(fresh))
        parts = np.unique(np.r_[0, np.flatnonzero(np.diff(np.cumsum(lengths) // PART)) + 1, len(fresh)]).tolist()
        joined = ["".join(fresh[i:j]) for i, j in zip(parts[:-1], parts[1:], strict=True)]
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(lists), np.int32, sum(map(len, lists)))
        ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum(lengths)
        at = np.searchsorted(ends, wanted)
        if len(ends) and ends[-1] == wanted[-1] and (ends[np.minimum(at, len(ends) - 1)] == wanted).all():
            sizes = np.diff(np.r_[0, at + 1])
        else:  # unknown characters stand for other bytes than their own
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
            joined = fresh
        before = len(self.known)
        row, proven = ids.tolist(), np.zeros(len(fresh), bool)
        if self.library is not None:
            # the library puts the marker before a text itself
            theirs = self.library.encode([w.removeprefix(MARKER) if self.prefix else w for w in joined], num_threads=1)
            if lists == theirs:
                proven[:] = True
            elif joined is fresh:
                proven[:] = [own == other for own, other in zip(lists, theirs, strict=True)]
        # words decode one by one, as each token stands for its own text: all in one piece first, singly only where that is not the words again
        plain = self.text("".join(fresh))
        if self.decode([row])[0] != plain or (self.library is not None and self.library.decode(row) != plain):
            edges = np.r_[0, np.cumsum(sizes)].tolist()
            for i, word in enumerate(fresh):
                own = row[edges[i]:edges[i + 1]]
                back = self.decode([own])[0]
                if back != self.text(word):
                    self.odd[before + i] = " " + back if self.prefix else back
                proven[i] &= self.library is None or self.library.decode(own) == back
        self.known.update(zip(words, range(before, before + len(fresh)), strict=True))
        self.starts.add(self.starts.held[-1] + np.cumsum(sizes))
        self.ids.add(ids)
        self.proven.add(proven)
        self.held += sum(map(len, fresh)) + WORD_BYTES * len(fresh)

    def cut(self, flat: str) -> list[str]:
        """The words of a normalised text; with the prefix every word begins with the marker, which is left off."""
        if not self.prefix:
            return self.chunks(flat)
        if MARKER * 2 not in flat and not flat.endswith(MARKER):
            return flat[1:].split(MARKER) if flat else []
        return [w[1:] for w in self.chunks(flat)]

    def text(self, flat: str) -> str:
        """What a normalised text says."""
        return flat.replace(MARKER, " ")[int(self.prefix):]

    def words(self, flat: list[str]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """Words of normalised texts, their numbers, one text after the other, and how many each has."""
        if self.held > REMEMBERED_BYTES:
            self.forget()
        parts = [self.cut(t) for t in flat]
        known = self.known
        fresh = [w for w in set().union(*parts) if w not in known]
        first = size = 0
        for i, word in enumerate(fresh):
            size += len(word)
            if size >= SLICE or i == len(fresh) - 1:
                self.learn(fresh[first:i + 1])
                first, size = i + 1, 0
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        return parts, np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum())), counts

    def normalised(self, texts: list[str]) -> list[str]:
        if self.plain:  # all that is left of the normaliser; the library would do the same character by character
            return [MARKER + t.replace(" ", MARKER) if t else "" for t in texts]
        return [self.normaliser.normalize_str(t) if t else "" for t in texts]

    def coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str], list[bool] | None]:
        """Ids of all texts, one after the other, how many each has, the texts that decoding gives, and whether the SentencePiece library agrees in ids and text
        (None without it)."""
        flat = self.normalised(texts)
        if self.chunks is None:
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(flat, add_special_tokens=False)]
            back = self.decode(lists)
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
            return ids, sizes, back, None if self.library is None else [self.agrees(*x) for x in zip(texts, lists, back, strict=True)]
        parts, at, counts = self.words(flat)
        starts = self.starts.held
        sizes = starts[at + 1] - starts[at]
        ids = self.ids.held[counting(starts[at], sizes)]
        edges = np.r_[0, np.cumsum(counts)]
        lengths = np.diff(np.r_[0, np.cumsum(sizes)][edges])
        back = [self.text(t) for t in flat]
        if self.odd:
            odd = np.r_[0, np.cumsum(np.isin(at, list(self.odd)))]
            for i in np.flatnonzero(np.diff(odd[edges])).tolist():
                front = " " if self.prefix else ""
                spelled = "".join(self.odd[k] if k in self.odd else front + w.replace(MARKER, " ") for k, w in zip(at[edges[i]:edges[i + 1]].tolist(), parts[i], strict=True))
                back[i] = spelled[int(self.prefix):]
        same = None
        if self.library is not None:
            unlike = np.r_[0, np.cumsum(~self.proven.held[at])]
            same = [k == 0 for k in np.diff(unlike[edges]).tolist()]
            normal = self.library.normalize(texts)
            begin = np.r_[0, np.cumsum(lengths)].tolist()
            for i, (own, other) in enumerate(zip(flat, normal, strict=True)):
                # the proof by words is enough, not needed: what it does not cover is held against the library as a whole
                if not (same[i] and own == other):
                    same[i] = self.agrees(texts[i], ids[begin[i]:begin[i + 1]].tolist(), back[i])
        return ids, lengths, back, same

    def agrees(self, text: str, ids: list[int], back: str) -> bool:
        return ids == self.library.encode(text, num_threads=1) and back == self.library.decode(ids)

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids, sizes, _, _ = self.coded(texts)
        edges = np.r_[0, np.cumsum(sizes)].tolist()
        return [ids[i:j].tolist() for i, j in zip(edges[:-1], edges[1:], strict=True)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """(first, last) of runs of texts of about SLICE characters."""
    edges = np.unique([0, *np.flatnonzero(np.diff(np.cumsum([len(t) for t in texts]) // SLICE)) + 1, len(texts)]).tolist()
    yield from zip(edges[:-1], edges[1:], strict=True)


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", verify: bool = True) -> DataFrame:
    """(key, ids, n_tokens, round_trip, parity) of every row, for the model file at ``path``.

    ``round_trip``: decoding gives the text again. ``parity``: the SentencePiece library gives the same ids, and decodes them to the same text (null without
    ``verify``). For models whose tokens end before every space this follows from every word of the text, and from the normalised text, which the
    library's must equal; texts where that does not settle it, and those of other models, are encoded and decoded whole by both.

    Null texts are empty and have no ids. Repeated rows stay and an empty table gives an empty one; other columns are not read. The driver reads the file, whose
    bytes travel with the function. Rows never leave their task; texts are encoded whole, and a task remembers about 80 MB of words.
    """
    with open(path, "rb") as file:
        model = file.read()
    spec = parsed(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec, model if verify else None)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts):
                own = texts[lo:hi]
                ids, sizes, back, same = codec.coded(own)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), lists, pa.array(sizes, pa.int64()), pa.array([a == b for a, b in zip(back, own, strict=True)], pa.bool_()),
                    pa.array(same, pa.bool_()) if same is not None else pa.nulls(hi - lo, pa.bool_())], [key, "ids", "n_tokens", "round_trip", "parity"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(released(run), f"{key} {kind}, ids array<int>, n_tokens long, round_trip boolean, parity boolean")


def decoded(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of every row of ids; null ids give an empty text."""
    with open(path, "rb") as file:
        spec = parsed(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codec.decode([i or [] for i in batch.column(1).to_pylist()]), pa.string())], [key, "text"])

    return rows.select(key, ids).mapInArrow(released(run), f"{key} {rows.schema[key].dataType.simpleString()}, text string")
