"""N-gram Jaccard self-join with adaptive multi-match prefixes (after Wang, Li and Feng, 2012).

Two sets that overlap in at least ``o`` tokens share at least ``l`` of the first ``n - o + l`` tokens of each, in any
common order of tokens, for every ``l``. Rare tokens come first. A document whose short prefix would meet many candidates takes a longer
one and then demands correspondingly more shared tokens before its pair is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import pinned, released
from .text_arrays import WordHasher, distinct, mix, ragged, shingles, sums, text_slices, text_words

#: counters of the frequency sketch (2 MB, whatever the corpus): a token's counter is named by its top bits
COUNTER_BITS = 18
#: bits of the smallest parity map; a set of n tokens has the next power of two over n / 2 bits
PARITY_BITS = 256
#: longest prefix, in tokens that must be shared
MOST_MATCHES = 8
#: cost of verifying a candidate against that of looking at one more entry of the index
VERIFY_COST = 4.0
#: flags of the bounded filter that picks the documents whose sets are built for verification
FLAG_BITS = 20


def _words(batch: pa.RecordBatch, hasher: WordHasher) -> Iterator[tuple]:
    """(ids, hashes of words, words by text) of pieces of a batch of (doc_id, text), A-Z in lower case."""
    ids, lower = batch.column(0), np.arange(256, dtype=np.uint8)
    lower[ord("A"):ord("Z") + 1] += 32
    for first, last, data, offsets in text_slices(batch, "text"):
        yield ids.slice(first, last - first), *text_words(lower[data], offsets, hasher)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _frequencies(width: int):
    """One row per document with its set's size and 128-bit fingerprint, and one row per counter that a task has used."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counters = WordHasher(), np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            for ids, hashes, counts in _words(batch, hasher):
                values, sizes = distinct(*shingles(hashes, counts, width), len(counts))
                counters += np.bincount(_slot(values), minlength=len(counters))
                bounds = np.r_[0, np.cumsum(sizes)]
                # sums of two independent scramblings: equal sets have equal fingerprints, in any order
                prints = [sums(mix(values ^ np.uint64(salt)).view(np.int64), bounds) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                empty = pa.nulls(len(sizes), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), *map(pa.array, prints), empty, empty],
                                                 ["doc_id", "n", "fa", "fb", "slot", "uses"])
        used = np.flatnonzero(counters)
        for part in np.array_split(used, len(used) // 10_000 + 1):
            empty = pa.nulls(len(part), pa.int64())
            yield pa.RecordBatch.from_arrays([empty, empty, empty, empty, pa.array(part, pa.int64()), pa.array(counters[part], pa.int64())],
                                             ["doc_id", "n", "fa", "fb", "slot", "uses"])
    return run


def excess(uses: np.ndarray) -> np.ndarray:
    """Estimated texts with one token of each counter beyond what chance puts there: 0 for all but frequent tokens.

    The usual load of a counter is the median; counters within six standard deviations hold rare tokens only.
    """
    usual = float(np.median(uses))
    return np.where(uses > usual + 6 * np.sqrt(usual) + 1, uses - usual, 0).astype(np.float64)


def prefix_matches(frequent: np.ndarray, shortest: np.ndarray, longest: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Tokens that each document's prefix demands. ``frequent`` holds estimated frequencies in token order, ``first`` where each
    document's begin, ``shortest`` the lengths of one-match prefixes, ``longest`` the most matches each may demand.

    With l matches the index entries met are F(l), the candidates at most F(l) / l, as each uses up l entries; the
    cheapest F(l) + VERIFY_COST * F(l) / l wins, ties go to the shorter prefix.
    """
    total = np.r_[0.0, np.cumsum(frequent)]
    best, cost = np.ones(len(first), np.int64), np.full(len(first), np.inf)
    for matches in range(1, MOST_MATCHES + 1):
        able = matches <= longest
        met = total[np.where(able, first + shortest + matches - 1, first)] - total[first]
        own = np.where(able, met * (1 + VERIFY_COST / matches), np.inf)
        best, cost = np.where(own < cost - 1e-9, matches, best), np.minimum(cost, own)
    return best


def parity_maps(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """One bit map per text; a bit is the parity of the tokens hashed to it. The bits in which two maps differ are at most the
    tokens in which the sets differ. Half of a map added to the other half is the map of half the size."""
    width = np.maximum(PARITY_BITS, 1 << np.ceil(np.log2(np.maximum(sizes // 2, 1))).astype(np.int64))
    begin = np.r_[0, np.cumsum(width)]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = begin[owner] + (mix(values) & (width[owner] - 1).astype(np.uint64)).astype(np.int64)
    bits = np.packbits((np.bincount(at, minlength=begin[-1]) & 1).astype(np.uint8))
    return [bits[begin[i] // 8:begin[i + 1] // 8].tobytes() for i in range(len(sizes))]


def parity_distance(a: bytes, b: bytes) -> int:
    """Bits in which two maps differ, the larger one folded to the size of the smaller."""
    small, large = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(large) > len(small):
        large = large[:len(large) // 2] ^ large[len(large) // 2:]
    return int(np.bitwise_count(small ^ large).sum())


def _prefixes(width: int, num: int, den: int, frequency: np.ndarray):
    """(doc_id, n, matches, short, tokens, parity) of every document that another set can resemble without equalling it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for ids, hashes, counts in _words(batch, hasher):
                values, sizes = distinct(*shingles(hashes, counts, width), len(counts))
                owner, uses = np.repeat(np.arange(len(sizes)), sizes), frequency[_slot(values)]
                parity = parity_maps(values, sizes)
                # frequent tokens last; values are sorted within a text, and their lower bits decide among equals
                rank = np.argsort(owner * 64 + np.where(uses > 0, np.log2(np.maximum(uses, 1)).astype(np.int64) + 1, 0), kind="stable")
                values, uses = values[rank], uses[rank]
                least = -(-sizes * num // den)  # the overlap that any partner must reach
                # a set of n tokens resembles another than itself only if n - 1 of n, or n of n + 1, are enough
                able = (sizes > 0) & ((sizes - 1) * den >= num * sizes) | (sizes * den >= num * (sizes + 1)) & (sizes > 0)
                short = np.where(able, sizes - least + 1, 0)
                first = np.cumsum(sizes) - sizes
                matches = prefix_matches(uses, short, np.where(able, least, 1), first)
                length = np.where(able, short + matches - 1, 0)
                within = np.arange(len(values)) - np.repeat(first, sizes)
                tokens = values[within < np.repeat(length, sizes)]
                keep = pa.array(able)
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(sizes, pa.int64()), pa.array(matches, pa.int32()), pa.array(short, pa.int32()),
                    ragged(tokens, length, pa.int64()), pa.array(parity, pa.binary())],
                    ["doc_id", "n", "matches", "short", "tokens", "parity"]).filter(keep)
    return run


def _flagged_sets(width: int, flags: np.ndarray):
    """(doc_id, shingles) of the documents whose flag is set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            slots = batch.column(2).to_numpy(zero_copy_only=False)
            chosen = batch.filter(pa.array(flags[slots]))
            if not chosen.num_rows:
                continue
            for ids, hashes, counts in _words(chosen, hasher):
                values, sizes = distinct(*shingles(hashes, counts, width), len(counts))
                bounds = np.r_[0, np.cumsum(sizes)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(
                    [values[bounds[i]:bounds[i + 1]].tobytes() for i in range(len(sizes))], pa.binary())], ["doc_id", "shingles"])
    return run


def _parity_allows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps pairs whose parity maps differ in no more bits than their sets may in tokens (``most``)."""
    for batch in batches:
        most, left, right = (batch.column(c).to_pylist() for c in ("most", "parity_a", "parity_b"))
        keep = [parity_distance(a, b) <= m for m, a, b in zip(most, left, right, strict=True)]
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b", "n", "m"])


def _multi_match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps pairs that share as many prefix tokens as the less demanding of the two asks for, where both prefixes are that long."""
    for batch in batches:
        rows = {name: batch.column(name).to_pylist() for name in ("matches_a", "matches_b", "short_a", "short_b")}
        tokens = [batch.column(f"tokens_{side}") for side in "ab"]
        keep = []
        for i in range(batch.num_rows):
            need = min(rows["matches_a"][i], rows["matches_b"][i])
            a, b = (t[i].values.to_numpy()[:rows[short][i] + need - 1] for t, short in zip(tokens, ("short_a", "short_b"), strict=True))
            keep.append(len(np.intersect1d(a, b, assume_unique=True)) >= need)
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b", "n", "m"])


def _verify(num: int, den: int):
    """Keeps the pairs whose whole sets are similar enough and adds the size of their intersection. A document of several texts brings
    several sets: only those of the sizes that made the pair a candidate are compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            shared, sizes = [], []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                shared.append(len(np.intersect1d(a, b, assume_unique=True)))
                sizes.append((len(a), len(b)))
            out = batch.select(["a", "b", "n", "m"]).append_column("shared", pa.array(shared, pa.int64()))
            n, m, s = (out.column(c).to_numpy() for c in ("n", "m", "shared"))
            meant = (np.array(sizes, np.int64).reshape(-1, 2) == np.stack([n, m], axis=1)).all(axis=1)
            yield out.filter(pa.array(meant & (den * s >= num * (n + m - s))))
    return run


class ShingleJoin:
    """Classes, links and components of documents by the Jaccard similarity of their sets of word shingles.

    ``docs`` needs ``doc_id`` (a number) and ``text``; other columns are not read. Sets are those of whole texts in which A-Z are lower-cased. Null, empty and blank
    texts have empty sets and are linked with nothing; texts of fewer than ``width`` words are one shingle. Rows without
    doc_id get no component. Rows that repeat a doc_id count as one document, linked by any of their texts, also where one of them is empty.

    * ``members``: (doc_id, n_shingles, rep) per row; the class of equal sets is named by its smallest doc_id.
    * ``links``: (a, b, n, m, shared) between class representatives. Enough of them to connect what is connected: inside
      a group that is already one component no further links are sought, so thousands of near copies do not become all their pairs.
    * ``components``: (doc_id, n_shingles, component_id) per row.

    Work: two scans that cut words (sketch and fingerprints; prefixes), then one per verification of the few flagged documents. No
    text is shuffled. Verification compares 64-bit hashes of shingles.
    """

    def __init__(self, docs: DataFrame, width: int = 5, num: int = 8, den: int = 10) -> None:
        self.width, self.num, self.den = width, num, den
        kind = docs.schema["doc_id"].dataType.simpleString()
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.kind = kind
        first = pinned(self.docs.mapInArrow(released(_frequencies(width)), "doc_id long, n long, fa long, fb long, slot long, uses long"))
        self.rows = first.where(F.col("slot").isNull()).select("doc_id", "n", "fa", "fb")
        self.classes = (self.rows.where("n > 0 and doc_id is not null").groupBy("n", "fa", "fb")
                        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
        uses = np.zeros(1 << COUNTER_BITS, np.int64)
        # at most 2**COUNTER_BITS rows, whatever the corpus
        sketch = first.where(F.col("slot").isNotNull()).groupBy("slot").agg(F.sum("uses").alias("uses")).toPandas()
        uses[sketch["slot"].to_numpy()] = sketch["uses"].to_numpy()
        prefixes = self.docs.where("doc_id is not null").mapInArrow(
            released(_prefixes(width, num, den, excess(uses))), "doc_id long, n long, matches int, short int, tokens array<long>, parity binary")
        self.prefixes = pinned(prefixes.join(self.classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"))
        self._links: DataFrame | None = None

    def members(self) -> DataFrame:
        # most sets occur once: only rows of repeated ones look their class up
        repeated = self.classes.where("copies > 1").select("n", "fa", "fb", "rep")
        return (self.rows.join(repeated, ["n", "fa", "fb"], "left")
                .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.coalesce("rep", "doc_id"))
                        .otherwise(F.col("doc_id")).alias("rep")))

    def _bin(self, size: Column) -> Column:
        """Sizes in bins of which about four cover the sizes that a set can pair with."""
        return F.floor(F.log(size.cast("double")) / F.lit(float(np.log(self.den / self.num) / 4))).cast("int")

    def _entries(self) -> DataFrame:
        """The index: (token, doc_id, n, at, top) for the tokens of one-match prefixes.

        A pair's first common token lies in both. If it is the token at place ``at`` of a set of n, the overlap is at most n - at, so a partner
        has at most ``top`` tokens.
        """
        num, den = self.num, self.den
        return (self.prefixes.select("doc_id", "n", F.posexplode(F.slice("tokens", F.lit(1), F.col("short"))).alias("at", "token"))
                .withColumn("top", F.floor((F.col("n") - F.col("at")) * (num + den) / F.lit(num)).cast("long") - F.col("n")))

    def _fits(self, left: str, right: str) -> Column:
        """Both sizes allow the similarity, and so do the places of the shared token."""
        n, m, at, by = F.col(f"{left}.n"), F.col(f"{right}.n"), F.col(f"{left}.at"), F.col(f"{right}.at")
        overlap = 1 + F.least(n - at, m - by) - 1
        return (self.den * F.least(n, m) >= self.num * F.greatest(n, m)) & ((self.num + self.den) * overlap >= self.num * (n + m))

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Distinct (a, b) pairs that are links, with both sizes and the overlap."""
        num, den = self.num, self.den
        map_of = lambda s, size: self.prefixes.select(
            F.col("doc_id").alias(s), F.col("n").alias(size), F.col("parity").alias(f"parity_{s}"))
        prefix_of = lambda s: self.prefixes.select(
            F.col("doc_id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("matches", "short", "tokens")])
        columns = "a long, b long, n long, m long"
        # the small maps go first, so that prefixes travel for few pairs
        close = pinned(pairs.join(map_of("a", "n"), "a").join(map_of("b", "m"), "b")
                       .withColumn("most", F.floor((F.col("n") + F.col("m")) * (den - num) / F.lit(den + num)).cast("long"))
                       .mapInArrow(released(_parity_allows), columns))
        likely = pinned(close.join(prefix_of("a"), "a").join(prefix_of("b"), "b").mapInArrow(released(_multi_match), columns))
        wanted = likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FLAG_BITS)).cast("int")
        flags = np.zeros(1 << FLAG_BITS, bool)
        flags[wanted.select(slot.alias("slot")).distinct().toPandas()["slot"].to_numpy(dtype=np.int64)] = True
        sets = pinned(self.docs.where("doc_id is not null").select("doc_id", "text", slot.alias("slot"))
                      .mapInArrow(released(_flagged_sets(self.width, flags)), "doc_id long, shingles binary")
                      .join(wanted, "doc_id", "left_semi").distinct())
        return (likely.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left")), "a")
                .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right")), "b")
                .mapInArrow(released(_verify(num, den)), "a long, b long, n long, m long, shared long"))

    def links(self) -> DataFrame:
        """First every token's entries meet the smallest document among them, which joins a group of near copies through few
        pairs; then tokens that still hold several components meet across components only, which is exhaustive."""
        if self._links is not None:
            return self._links
        entries = self._entries()
        hubs = (entries.groupBy("token").agg(F.min(F.struct("doc_id", "n", "at")).alias("hub"), F.count(F.lit(1)).alias("entries"))
                .where("entries > 1").select("token", "hub"))
        shared = pinned(entries.join(hubs, "token"))
        near = (shared.alias("l").select("l.*", F.col("l.hub.doc_id").alias("other"), F.struct("l.hub.n", "l.hub.at").alias("r"))
                .where("doc_id <> other"))
        overlap = F.least(F.col("n") - F.col("at"), F.col("r.n") - F.col("r.at"))
        fits = ((self.den * F.least(F.col("n"), F.col("r.n")) >= self.num * F.greatest(F.col("n"), F.col("r.n")))
                & ((self.num + self.den) * overlap >= self.num * (F.col("n") + F.col("r.n"))))
        stars = pinned(self._verified(near.where(fits).select(F.col("other").alias("a"), F.col("doc_id").alias("b")).distinct()))
        joined = components(stars.select("a", "b"))
        labelled = (shared.drop("hub").join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                    .withColumn("component", F.coalesce("component", "doc_id")))
        open_tokens = (labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                       .where("lo < hi").select("token"))
        rest = pinned(labelled.join(open_tokens, "token", "left_semi"))
        # each entry asks for partners of no more tokens than its own set has, bin by bin
        asks = (rest.withColumn("low", F.ceil(F.col("n") * self.num / F.lit(self.den)).cast("long"))
                .withColumn("high", F.least("n", "top")).where("low <= high and high >= 1")
                .withColumn("bin", F.explode(F.sequence(self._bin(F.greatest(F.col("low"), F.lit(1))), self._bin(F.col("high"))))))
        offers = rest.withColumn("bin", self._bin(F.col("n")))
        # of a component whose members are many only the pairs with other components are met
        own = lambda side: side.select("token", "bin", "component").distinct()
        meets = (own(asks).alias("x").join(own(offers).alias("y"), ["token", "bin"]).where("x.component <> y.component")
                 .select("token", "bin", F.col("x.component").alias("asking"), F.col("y.component").alias("offering")))
        pairs = (meets.join(asks.select("token", "bin", F.col("component").alias("asking"), F.struct("doc_id", "n", "at").alias("l")),
                            ["token", "bin", "asking"])
                 .join(offers.select("token", "bin", F.col("component").alias("offering"), F.struct("doc_id", "n", "at").alias("r")),
                       ["token", "bin", "offering"])
                 .where(self._fits("l", "r"))
                 .select(F.least("l.doc_id", "r.doc_id").alias("a"), F.greatest("l.doc_id", "r.doc_id").alias("b")).distinct())
        self._links = pinned(stars.union(self._verified(pairs)))
        return self._links

    def _ties(self, members: DataFrame) -> DataFrame:
        """(a, b): links between the classes of the rows that share a doc_id, as they are one document."""
        spread = (members.where("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("doc_id", "a"))
        return members.join(spread, "doc_id").select("a", F.col("rep").alias("b")).where("a <> b").distinct()

    def components(self) -> DataFrame:
        members = pinned(self.members())
        found = components(self.links().select("a", "b").union(self._ties(members))).withColumnRenamed("node", "rep")
        return (members.join(found, "rep", "left")
                .select(F.col("doc_id").cast(self.kind).alias("doc_id"), "n_shingles",
                        F.coalesce("component", "rep").cast(self.kind).alias("component_id")))
