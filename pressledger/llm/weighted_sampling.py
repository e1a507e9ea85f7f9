"""Document fingerprints by improved consistent weighted sampling (Ioffe, 2010).

For every term x of weight w and every sample, r and c are drawn from Gamma(2, 1) and beta evenly from 0 to 1, all three from hashes of x and the sample. With
t = floor(ln w / r + beta), the sample is the (x, t) with the smallest a = c exp(-r (t - beta + 1)). Two documents agree in a sample with the probability of
their generalised Jaccard similarity, sum of minima over sum of maxima of weights, which may be any positive numbers.

A Gamma(2, 1) number is -ln of the product of two even ones. So a is at least c exp(-r) / w, which multiplications alone bound from below; logarithms are
taken only of the few terms whose bound is under a limit that the smallest a hardly ever exceeds. Where it does, all terms are drawn in full.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import released
from .text_arrays import WordHasher, mix, shingles, text_slices, word_bounds

SAMPLES, WORDS = 128, 3
#: a fingerprint keeps eight bits of each sample: two hex digits
KEPT = 256
EMPTY = "00" * SAMPLES
#: the smallest a of a text exceeds this number over its total weight with probability exp(-LIMIT)
LIMIT = 5.0
SALTS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
SPREAD, FIELD, BYTE = np.uint64(0x9FB21C651E98DF25), np.uint64(0xFFFF), np.uint64(KEPT - 1)
#: effort of the compression under which texts are shuffled
LEVEL = 6


def weighted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of every text, their counts, and their text's index, text by text."""
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order].astype(np.uint16), kind="stable")]
    hashes, owner = hashes[order], owner[order]
    at = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]) if len(hashes) else np.zeros(0, np.int64)
    return hashes[at], np.diff(np.r_[at, len(hashes)]), owner[at]


def scrambled(terms: np.ndarray, k: int) -> np.ndarray:
    """64 bits for each term in sample ``k``."""
    out = terms * SALTS[k]
    out ^= out >> np.uint64(32)
    out *= SPREAD
    out ^= out >> np.uint64(29)
    return out


def bounded(bits: np.ndarray) -> np.ndarray:
    """A lower bound of c exp(-r) in units of 2**-48, of the four fields of 16 bits that c and r begin with."""
    low = bits & FIELD
    low *= (bits >> np.uint64(16)) & FIELD
    rest = (bits >> np.uint64(32)) & FIELD
    rest += bits >> np.uint64(48)
    low *= rest
    return low


def drawn(bits: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln a and t, for the bits of terms in one sample and the logarithms of their weights."""
    u = bits.view("<u2").reshape(-1, 4).astype(np.float64)
    u += 0.5
    u *= 2.0**-16
    r = -np.log(u[:, 0] * u[:, 1])
    c = -np.log((1 - u[:, 2]) * (1 - u[:, 3]))
    more = bits * SPREAD
    more ^= more >> np.uint64(32)
    more *= SPREAD
    beta = (more >> np.uint64(11)).astype(np.float64) * 2.0**-53
    t = np.floor(logs / r + beta)
    return np.log(c) - r * (t - beta + 1), t


def named(terms: np.ndarray, t: np.ndarray) -> np.ndarray:
    """(x, t) as one number."""
    return mix(terms + t.astype(np.int64).view(np.uint64) * SPREAD)


def samples(terms: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of SAMPLES bytes for each text; ``first`` is where each text's terms begin, none may be without a term. Weights are positive."""
    out = np.empty((len(first), SAMPLES), np.uint8)
    many = len(first)
    sizes = np.diff(np.r_[first, len(terms)])
    owner = np.repeat(np.arange(many), sizes)
    total = np.add.reduceat(weights.astype(np.float64), first)
    # the smallest a is exponential with the total weight as its rate
    limit = LIMIT / total
    reach = np.minimum(limit[owner] * weights * 2.0**48, 2.0**62).astype(np.uint64) + np.uint64(1)
    logs, most, edges = np.log(weights), np.log(limit), np.append(first, len(terms))
    for k in range(SAMPLES):
        bits = scrambled(terms, k)
        at = np.flatnonzero(bounded(bits) <= reach)
        value, t = drawn(bits[at], logs[at])
        begin = np.searchsorted(at, edges)
        left = begin[1:] - begin[:-1]
        filled = left > 0
        low = np.full(many, np.inf)
        if len(at):
            low[filled] = np.minimum.reduceat(value, begin[:-1][filled])
        won = np.flatnonzero(value == np.repeat(low, left))
        out[owner[at[won]], k] = named(terms[at[won]], t[won]) & BYTE
        open_ = np.flatnonzero(low > most)
        for i in open_.tolist():
            own = slice(first[i], first[i] + sizes[i])
            value, t = drawn(bits[own], logs[own])
            won = np.argmin(value)
            out[i, k] = named(terms[own][won:won + 1], t[won:won + 1])[0] & BYTE
    return out


class Fingerprinter:
    """Fingerprints of texts: hex digits of their samples. Terms are runs of three words with their counts; a text of fewer words is one
    term, one without words has the fingerprint EMPTY. A text is always sampled whole."""

    def __init__(self) -> None:
        self.hasher = WordHasher()

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), SAMPLES), np.uint8)
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
        for start, _, data, offsets in text_slices(batch, "text"):
            begins, ends = word_bounds(data, offsets)
            counts = np.diff(np.searchsorted(begins, offsets))
            terms, weights, owner = weighted(*shingles(self.hasher(data, begins, ends), counts, WORDS))
            filled, first = np.unique(owner, return_index=True)
            # a few texts at a time stay in the processor's cache
            edges = np.r_[0, np.flatnonzero(np.diff(first // 60_000)) + 1, len(first)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo < hi:
                    a, b = first[lo], first[hi] if hi < len(first) else len(terms)
                    out[start + filled[lo:hi]] = samples(terms[a:b], weights[a:b], first[lo:hi] - a)
        return out


def hexed(prints: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in prints]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated generalised Jaccard similarity: the share of equal samples without what chance makes equal. An empty text is like
    another empty one only."""
    same = (a == b).mean(1)
    chance = 1 / KEPT
    value = np.clip((same - chance) / (1 - chance), 0, 1)
    empty = (a == 0).all(1), (b == 0).all(1)
    return np.where(empty[0] | empty[1], (empty[0] & empty[1]).astype(float), value)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every row; equal texts have equal fingerprints. Null texts are empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Fingerprinter()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hexed(of([t or "" for t in batch.column(1).to_pylist()])))], [key, "fingerprint"])

    return docs.select(key, text).mapInArrow(released(run), f"{key} {docs.schema[key].dataType.simpleString()}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many (or all) first ones of the following text."""
    size = len(text) // 4
    return text[:len(text) - size] + following[:size]


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, body): texts as they are shuffled, compressed; null stays null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            bodies = [press((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary())], ["doc_id", "body"])

    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, body binary")


def with_successors(docs: DataFrame) -> DataFrame:
    """(range, extra, doc_id, body): ``docs`` dealt so that each row and the one after it by doc_id stand in one partition, in order.

    Rows go to ranges of doc_id, and the first row of a range goes to the range before as well (``extra``), so the text is
    shuffled once. Ranges are cut at quantiles, eight for each shuffle partition; the range of a row is found by binary search. Rows without
    doc_id come first; rows that repeat one are ordered by a hash of their text. The row after the last is the first.
    """
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 8 * partitions
    ids = docs.select(F.col("doc_id").cast("double").alias("_place"))
    cuts = sorted(set(ids.approxQuantile("_place", [i / ranges for i in range(1, ranges)], 0.2 / ranges)))
    buckets = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="_place", outputCol="range") if cuts else None

    def ranged(rows: DataFrame) -> DataFrame:
        if buckets is None:
            return rows.withColumn("range", F.lit(0.0))
        return buckets.transform(rows.withColumn("_place", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))).drop("_place")

    # where no doc_id repeats, which is usual, the text need not tell rows apart and is not read for it
    mark = F.xxhash64(F.coalesce("text", F.lit(""))) if _repeats(docs) else F.lit(0).cast("long")
    marked = ranged(docs.select("doc_id", mark.alias("mark")))
    # one row for each range, of which there are at most eight for each shuffle partition
    firsts = marked.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "mark")).alias("f")).orderBy("range").collect()
    before = [(firsts[i - 1]["range"], r["f"]["doc_id"], r["f"]["mark"]) for i, r in enumerate(firsts)]
    wanted = spark.createDataFrame(before, f"target double, first {docs.schema['doc_id'].dataType.simpleString()}, first_mark long")
    extra = (docs.select("doc_id", "text", mark.alias("mark")).join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("mark") == F.col("first_mark")))
             .dropDuplicates(["target"]))
    bodies = packed(extra.select(F.struct("doc_id", "target", "mark").alias("doc_id"), "text"))
    dealt = ranged(packed(docs.select(F.struct("doc_id", mark.alias("mark")).alias("doc_id"), "text"))
                   .select("doc_id.doc_id", "doc_id.mark", "body")).select("range", F.lit(False).alias("extra"), "doc_id", "mark", "body")
    dealt = dealt.unionByName(bodies.select(F.col("doc_id.target").alias("range"), F.lit(True).alias("extra"), "doc_id.doc_id", "doc_id.mark", "body"))
    return dealt.repartition(partitions, "range").sortWithinPartitions("range", "extra", F.asc_nulls_first("doc_id"), "mark").drop("mark")


def _repeats(docs: DataFrame) -> bool:
    """Whether any doc_id occurs twice, in which case the text has to tell rows apart."""
    return not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def compared(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row of ``docs``.

    Null texts are empty. Rows are judged in the order of ``with_successors``; a table of one row is its own successor. Other columns are
    not read. No group is gathered: partitions are streamed, with one row carried over.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        of, carried, carried_print = Fingerprinter(), [], np.zeros((0, SAMPLES), np.uint8)
        for batch in batches:
            rows = carried + list(zip(*(batch.column(c).to_pylist() for c in ("range", "extra", "doc_id", "body")), strict=True))
            texts = [unpack(r[3]).decode() for r in rows]
            prints = np.vstack([carried_print, of(texts[len(carried):])])
            # the last row of a range is the extra one, which has no result of its own
            at = [i for i in range(len(rows) - 1) if not rows[i][1]]
            changed = [edited(texts[i], texts[i + 1]) for i in at]
            own, after, new = prints[at], prints[[i + 1 for i in at]], of(changed)
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[i][2] for i in at], batch.schema.field("doc_id").type), pa.array([len(texts[i]) for i in at], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()), pa.array(hexed(own), pa.string()),
                pa.array(hexed(new), pa.string()), pa.array(likeness(own, new), pa.float64()), pa.array(likeness(own, after), pa.float64())], names)
            carried, carried_print = rows[-1:], prints[-1:]

    return with_successors(docs.select("doc_id", "text")).mapInArrow(
        released(run), f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
