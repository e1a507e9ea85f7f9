"""Sources mixed to target weights by Pfair scheduling.

A source of weight w owns blocks of rows. Its i-th block (from 0) is released at floor(i / w) and due at ceil((i + 1) / w); slots go to the
released block with the earliest deadline. Every source then holds, after any number of slots t, more than w t - 1 and less than
w t + 1 blocks.

Weights are whole numbers over a common period of FINE times the slots that the rows need, so the period is never repeated and a source
holds, after any number of slots that rows need, more than w t - 1 - 1 / FINE and less than w t + 1 + 1 / FINE blocks for its exact weight w. One task
makes the schedule, a slot at a time with one entry for each source, and writes it as a table; a block's slot follows by an equi-join. Rows never
pass through that task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import pinned, released

#: slots of a period at least
PERIOD = 1000
#: a period has so many times the slots that the rows need, so that rounding its quotas moves no source by more than 1 / FINE of a block
FINE = 64
#: slots of a period at most, so that positions are 64-bit numbers
LONGEST = 1 << 58
#: blocks of the schedule that are handed on at a time
TABLE_ROWS = 50_000
#: rows of a block
BLOCK_ROWS = 16
#: rows that a task numbers at a time on average, however large a source is
SLICE_ROWS = 4000


def quotas(weights: Mapping[str, float], least: int = PERIOD) -> dict[str, int]:
    """Slots of each source in a period of ``least`` slots or more: the largest remainders of the exact shares, at least one each. The sum is
    the period."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    whole = {s: Fraction(w) for s, w in weights.items()}
    total, period = sum(whole.values()), max(PERIOD, 16 * len(weights), least)
    exact = {s: w / total * period for s, w in whole.items()}
    parts = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s is not None, s))[:max(0, period - sum(parts.values()))]:
        parts[s] += 1
    return parts


def needed(weights: Mapping[str, float], blocks: Mapping[str, int]) -> int:
    """Slots by which every source has all its blocks and one more."""
    total = sum(Fraction(w) for w in weights.values())
    return max(int((blocks[s] + 1) * total / Fraction(w)) + 2 for s, w in weights.items())


def planned(sizes: list[int], blocks: list[int], horizon: int) -> Iterator[tuple[int, int, int]]:
    """(number of a source, block, slot) by earliest deadline among released blocks, of equal deadlines the source first in order.

    ``sizes`` are the slots of each source in a period of their sum, ``blocks`` the blocks wanted of each. Before slot ``horizon`` a source that has
    all its blocks leaves its further slots empty; from there on it releases no more, and slots without a released block are passed over.
    With whole weights summing to one every deadline is met (Baruah and others, 1996), also where blocks are left out.
    """
    period, left = sum(sizes), sum(blocks)
    coming = [(0, s, 0) for s in range(len(sizes))]
    due: list[tuple[int, int, int]] = []
    slot = 0
    while left:
        while coming and coming[0][0] <= slot:
            _, s, i = heapq.heappop(coming)
            if i < blocks[s] or slot < horizon:
                heapq.heappush(due, (-(-(i + 1) * period // sizes[s]), s, i))
        if not due:
            slot = coming[0][0]
            continue
        deadline, s, i = heapq.heappop(due)
        if slot >= deadline:
            raise RuntimeError(f"block {i} of source {s} misses its deadline")
        if i < blocks[s]:
            left -= 1
            yield s, i, slot
        if i + 1 < sizes[s]:
            heapq.heappush(coming, ((i + 1) * period // sizes[s], s, i + 1))
        slot += 1


def in_order(names: Iterable) -> list:
    """Sources by name; null, where it is one, comes first."""
    return sorted(names, key=lambda s: (s is not None, s))


def schedule(parts: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, slot) of one whole period."""
    names = in_order(parts)
    sizes = [parts[s] for s in names]
    return [(names[s], i, slot) for s, i, slot in planned(sizes, sizes, sum(sizes))]


def schedule_table(spark: SparkSession, sizes: list[int], blocks: list[int], horizon: int) -> DataFrame:
    """``planned`` as a table (_number, _index, _slot), made by one task that holds an entry for each source."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plan = planned(sizes, blocks, horizon) if batch.num_rows else iter(())
            while part := list(islice(plan, TABLE_ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part, strict=True)], ["_number", "_index", "_slot"])

    return pinned(spark.range(1, numPartitions=1).mapInArrow(released(run), "_number long, _index long, _slot long"))


def numbered(rows: DataFrame, key: str, source: str) -> DataFrame:
    """(key, source, mark, rank): the rank of every row in its source, from 0, in an order fixed by the hash of its key.

    A source is cut into slices by the hash, so that one with a third of all rows is numbered by many tasks; a slice's offset is the
    number of rows in the slices before. Rows that repeat a key follow each other.
    """
    slim = rows.select(F.col(key).alias("_key"), F.col(source).alias("_source"))
    slices = max(1, -(-slim.count() // SLICE_ROWS))
    marked = slim.select("*", F.xxhash64("_key").alias("_mark")).withColumn("_slice", F.pmod(F.shiftrightunsigned("_mark", 16), F.lit(slices)))
    sizes = marked.groupBy("_source", "_slice").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_source", "_slice", F.expr(
        "coalesce(sum(_size) over (partition by _source order by _slice rows between unbounded preceding and 1 preceding), 0)").alias("_before"))
    within = marked.select("*", F.expr("row_number() over (partition by _source, _slice order by _mark, _key) - 1").alias("_at"))
    joined = within.alias("r").join(offsets.alias("o"), F.col("r._source").eqNullSafe(F.col("o._source")) & (F.col("r._slice") == F.col("o._slice")))
    return joined.select(F.col("_key"), F.col("r._source").alias("_source"), F.col("r._slice").alias("_slice"), "_mark",
                         (F.col("_at") + F.col("_before")).alias("_rank"))


class Mixture:
    """``rows`` mixed to ``weights`` (source -> weight; sources that are not named, and null, are not part of the mixture and get no slot).

    ``temperature`` gives the weights where ``weights`` is None: a source's share is its number of rows to that power. The
    sources then reach the driver, as any table of weights does. With ``nulls``, null is a source of its own there.

    * ``placed``: (key, source, block, slot, position) of every row of a named source. The blocks of a source are its rows in hashed order,
      BLOCK_ROWS at a time; ``position`` orders the whole mixture. A source that has run out leaves its slots empty.
    * ``kept``: the rows of ``rows``, all columns, that belong to the mixture. Weights that follow from the rows themselves ask for no row to be
      dropped: all stay. Given ``weights`` are targets: rows stay that lie before the slot at which the first source runs out.
    * ``ordered``: the rows of ``kept``, sorted by position.

    Rows that repeat a key are neighbours and the cut keeps or leaves them together. An empty table gives an empty mixture.
    """

    def __init__(self, rows: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = 1.0, key: str = "doc_id", source: str = "source",
                 nulls: bool = False) -> None:
        self.rows, self.key, self.source, self.targets, self.nulls = rows, key, source, weights is not None, nulls and weights is None
        slim = rows.select(key, source)
        # one row for each source
        self.counts = {r[0]: r[1] for r in (slim if self.nulls else slim.where(F.col(source).isNotNull())).groupBy(source).agg(F.count(F.lit(1))).collect()}
        weights = {s: n**temperature for s, n in self.counts.items()} if weights is None else {s: w for s, w in weights.items() if s in self.counts}
        blocks = {s: -(-self.counts[s] // BLOCK_ROWS) for s in weights}
        # checked before it is a divisor
        least = FINE * needed(weights, blocks) if weights and all(w > 0 for w in weights.values()) else PERIOD
        if least > LONGEST:
            raise ValueError("a weight is so small that its source's rows have no 64-bit positions")
        self.quotas = quotas(weights, least) if weights else {}
        self.period = sum(self.quotas.values())
        self.names = in_order(self.quotas)
        self._blocks = [blocks[s] for s in self.names]
        self._placed: DataFrame | None = None
        self._table: DataFrame | None = None

    def table(self) -> DataFrame:
        """(_number, _index, _slot): every block and, for the cut, the first that a source no longer has; a source is its number in ``names``."""
        if self._table is None:
            more = [n + 1 for n in self._blocks]
            horizon = max(PERIOD, 16 * len(more), sum(more))
            self._table = schedule_table(self.rows.sparkSession, [self.quotas[s] for s in self.names], more, horizon)
        return self._table

    def placed(self) -> DataFrame:
        if self._placed is None:
            kind = self.rows.schema[self.source].dataType.simpleString()
            # one row for each source
            named = self.rows.sparkSession.createDataFrame(list(enumerate(self.names)), f"_of long, _name {kind}")
            ranked = numbered(self.rows, self.key, self.source)
            blocks = ranked.join(named, F.col("_source").eqNullSafe(F.col("_name"))).withColumn("_block", F.floor(F.col("_rank") / BLOCK_ROWS))
            slots = blocks.join(self.table(), (F.col("_of") == F.col("_number")) & (F.col("_block") == F.col("_index")))
            self._placed = pinned(slots.select(
                F.col("_key").alias(self.key), F.col("_source").alias(self.source), "_slice", "_mark", F.col("_block").alias("block"),
                F.col("_slot").alias("slot"), (F.col("_rank") % BLOCK_ROWS).cast("int").alias("_in_block")))
        return self._placed.select(self.key, self.source, "block", "slot", (F.col("slot") * BLOCK_ROWS + F.col("_in_block")).alias("position"))

    def slots(self) -> int:
        """Slots that ``kept`` keeps: up to the first whose source has no row left for it where weights are targets (a source's last block may
        be short), otherwise all."""
        if not self.quotas:
            return 0
        if not self.targets:
            return self.placed().agg(F.max("slot")).first()[0] + 1
        ends = self.rows.sparkSession.createDataFrame(list(enumerate(self._blocks)), "_number long, _index long")
        return self.table().join(ends, ["_number", "_index"]).agg(F.min("_slot")).first()[0]

    def kept(self) -> DataFrame:
        """The cut falls at one place of each source's order, so rows are kept by comparison with it and no text is shuffled."""
        if not self.targets:
            return self.rows if self.nulls else self.rows.where(F.col(self.source).isNotNull())
        held, self_key, self_source = self._held()
        self.placed()
        place = F.struct("_slice", "_mark")
        cuts = (self._placed.where(F.col("slot") < self.slots()).groupBy(F.col(self.source).alias("_cut_source")).agg(F.max(place).alias("_cut")))
        slices = max(1, -(-self.rows.count() // SLICE_ROWS))
        mark = F.xxhash64(self_key)
        own = F.struct(F.pmod(F.shiftrightunsigned(mark, 16), F.lit(slices)).alias("_slice"), mark.alias("_mark"))
        # one row for each source: Spark broadcasts it if its size allows
        return held.join(cuts, (self_source == F.col("_cut_source")) & (own <= F.col("_cut"))).select("_row.*")

    def _held(self) -> tuple[DataFrame, Column, Column]:
        """Rows as one column, so that none of theirs can clash with what they are joined to, and their key and source."""
        rows = self.rows.select(F.struct(*[F.col(f"`{c}`") for c in self.rows.columns]).alias("_row"))
        return rows, F.col("_row")[self.key], F.col("_row")[self.source]

    def ordered(self) -> DataFrame:
        """Rows meet their positions by key and source; those that repeat a key all take the first of theirs, so none is multiplied."""
        firsts = self.placed().groupBy(F.col(self.key).alias("_place_key"), F.col(self.source).alias("_place_source")).agg(F.min("position").alias("_place"))
        kept = self.kept()
        held = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("_row"))
        meet = F.col("_row")[self.key].eqNullSafe(F.col("_place_key")) & F.col("_row")[self.source].eqNullSafe(F.col("_place_source"))
        return held.join(firsts, meet).orderBy("_place").select("_row.*")
