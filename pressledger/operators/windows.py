"""Running computations that survive a key holding a third of all rows.

Two cases:

* logs with a unique order (``seq``), dense or not: rows are cut into range slices of (key, seq), so a hot key is spread over
  many slices and there are at most as many (key, slice) pairs as keys and slices;
* groups with an arbitrary order: groups above ``HOT_ROWS`` are found by a pre-aggregated count and cut into range
  slices, all other groups take the plain window.

Both combine a window inside the cut with a prefix over one summary row per cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import pinned

HOT_ROWS = 5_000_000
#: rows of a slice on average where loops cut what is left
SLICE_ROWS = 20_000

_AGGREGATE = {"max": F.max, "min": F.min, "sum": F.sum}


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys, NULL keys included; the key columns of the left side remain."""
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    joined = left.join(renamed, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys], how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def _combine(how: str, before: Column, inside: Column) -> Column:
    if how == "sum":
        return F.coalesce(before, F.lit(0)) + F.coalesce(inside, F.lit(0))
    if how == "max":
        return F.greatest(before, inside)
    return F.least(before, inside)


def prior(df: DataFrame, keys: Sequence[str], seq: str,
          values: Mapping[str, tuple[str, Column]] | Sequence[Mapping[str, tuple[str, Column]]],
          slices: int | None = None) -> DataFrame:
    """Add exclusive running aggregates: for each row, over the earlier rows (by ``seq``) of its key.

    ``values`` maps a new column to ``("max" | "min" | "sum", expression)``. The last value before a row is the
    maximum of ``struct(seq, value)``. A list of mappings is applied in order, later expressions may use earlier results.
    ``seq`` must be unique; it may be sparse, hashed or negative.

    Rows are range-partitioned by (key, seq) into ``slices`` (one for each shuffle partition by default) and written to the shared
    folder, as slices are only stable once written; running values inside a slice meet a prefix over one row per (key, slice). Between
    steps the rows are written again rather than computed twice.
    """
    keys = list(keys)
    steps = [values] if isinstance(values, Mapping) else list(values)
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = pinned(df.repartitionByRange(slices, *[F.col(k) for k in keys], F.col(seq)).withColumn("_block", F.spark_partition_id()))
    for i, step in enumerate(steps):
        cut = _prior_step(pinned(cut) if i else cut, keys, seq, step)
    return cut.drop("_block")


def _prior_step(cut: DataFrame, keys: list[str], seq: str, values: Mapping[str, tuple[str, Column]]) -> DataFrame:
    columns = cut.columns
    cut = cut.select("*", *[expr.alias(f"_{name}_value") for name, (_, expr) in values.items()])
    totals = cut.groupBy(*keys, "_block").agg(
        *[_AGGREGATE[how](f"_{name}_value").alias(f"_{name}_total") for name, (how, _) in values.items()])
    earlier_blocks = (Window.partitionBy(*keys).orderBy("_block")
                      .rowsBetween(Window.unboundedPreceding, -1))
    carried = totals.select(*keys, "_block", *[
        _AGGREGATE[how](f"_{name}_total").over(earlier_blocks).alias(f"_{name}_before")
        for name, (how, _) in values.items()])
    earlier_rows = (Window.partitionBy(*keys, "_block").orderBy(seq)
                    .rowsBetween(Window.unboundedPreceding, -1))
    joined = same_keys(cut, carried, [*keys, "_block"], "inner")
    return joined.select(*columns, *[
        _combine(how, F.col(f"_{name}_before"), _AGGREGATE[how](f"_{name}_value").over(earlier_rows)).alias(name)
        for name, (how, _) in values.items()])


def few_slices(spark: SparkSession, rows: int) -> int:
    """Slices for ``prior`` where a loop cuts fewer and fewer rows: as many as rows need, at most the default."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // SLICE_ROWS)))


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: Mapping[str, Column],
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add inclusive running sums per group; ``F.lit(1)`` gives the row number. ``order`` must be total.

    One count per group, pre-aggregated before its shuffle, decides how each group is handled.
    """
    keys = list(keys)
    hot = pinned(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows))
    total = hot.agg(F.sum("_rows")).first()[0]
    if total is None:
        return _plain_sums(df, keys, order, sums)
    # fewer than rows / hot_rows keys are hot, so this side stays small; AQE picks the join from its real size
    cold = same_keys(df, hot.select(*keys), keys, "left_anti")
    slices = max(2, 2 * -(-total // hot_rows))
    return _plain_sums(cold, keys, order, sums).unionByName(
        _sliced_sums(same_keys(df, hot.select(*keys), keys, "left_semi"), keys, order, sums, slices))


def _plain_sums(df: DataFrame, keys: list[str], order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select("*", *[F.sum(expr.cast("bigint")).over(window).alias(name) for name, expr in sums.items()])


def _sliced_sums(df: DataFrame, keys: list[str], order: Sequence[Column], sums: Mapping[str, Column],
                 slices: int) -> DataFrame:
    # the slice number is only stable once written down, hence the pin
    cut = pinned(df.repartitionByRange(slices, *[F.col(k) for k in keys], *order)
                 .withColumn("_slice", F.spark_partition_id()))
    totals = cut.groupBy(*keys, "_slice").agg(
        *[F.sum(expr.cast("bigint")).alias(f"_{name}_total") for name, expr in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_slice", *[
        F.coalesce(F.sum(f"_{name}_total").over(earlier), F.lit(0)).alias(f"_{name}_before") for name in sums])
    inside = (Window.partitionBy(*keys, "_slice").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = same_keys(cut, carried, [*keys, "_slice"], "inner")
    return joined.select(*df.columns, *[
        (F.col(f"_{name}_before") + F.sum(expr.cast("bigint")).over(inside)).alias(name)
        for name, expr in sums.items()])
