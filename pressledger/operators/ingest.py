"""From source feeds to identities: inventory, merges, prior cycles, recall."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .. import rules
from ..session import pinned


def source_inventory(feeds: Mapping[str, DataFrame], receipts: DataFrame) -> DataFrame:
    """Union of differently shaped feeds with counts and a status per source.

    A source is complete when it returned 0 and its manifest is absent or 'success'; a partial source keeps its valid
    records. Feeds have ``source``, ``record_id`` and any of the optional columns ``body``, ``body_chars``.
    """
    tagged = [df.withColumn("feed", F.lit(name)) for name, df in feeds.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    counted = union.groupBy("feed", "source").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("record_id").isNotNull() & (F.col("body_chars") > 0)).alias("valid_records"),
        F.sum("body_chars").cast("bigint").alias("chars"))
    status = (F.when(F.col("return_code").isNull(), "missing")
              .when((F.col("return_code") == 0)
                    & (F.col("manifest_status").isNull() | (F.col("manifest_status") == "success")), "complete")
              .when(F.col("manifest_status") == "partial", "partial").otherwise("failed"))
    return (counted.join(receipts, ["feed", "source"], "full_outer")
            .select("feed", "source", F.coalesce("records", F.lit(0)).alias("records"),
                    F.coalesce("valid_records", F.lit(0)).alias("valid_records"),
                    F.coalesce("chars", F.lit(0)).alias("chars"), status.alias("status")))


def merge_announcements(events: DataFrame, source: str, key: str, ts: str, kind: str) -> DataFrame:
    """One row per announcement key: first and last seen, and the union of its types.

    Types are reduced to one row per (source, key, type) first, so no list ever grows with the events.
    """
    per_type = events.groupBy(source, key, kind).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n"))
    return per_type.groupBy(source, key).agg(
        F.min("_first").alias("first_seen"), F.max("_last").alias("last_seen"), F.sum("_n").alias("events"),
        F.array_sort(F.collect_list(kind)).alias("types"))


def duplicate_keys(df: DataFrame, keys: Mapping[str, Column], record: str) -> DataFrame:
    return (df.select(record, *[expr.alias(name) for name, expr in keys.items()])
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.min(record).alias("first_record"))
            .where(F.col("copies") > 1))


def prior_cycles(cycles: DataFrame, explicit: Mapping[str, str] | None = None) -> DataFrame:
    """Latest earlier cycle in an eligible phase for each cycle; none means the first cycle.

    ``cycles`` is the cycle dimension (cycle_id, cycle_no, phase): one row per calendar day or week, which is why
    its window needs no partition. ``explicit`` overrides single cycles and is checked for eligibility.
    """
    eligible = F.col("phase").isin(*rules.ELIGIBLE_PHASES)
    window = Window.orderBy("cycle_no").rowsBetween(Window.unboundedPreceding, -1)
    found = cycles.withColumn("prior_cycle_id", F.last(F.when(eligible, F.col("cycle_id")), ignorenulls=True).over(window))
    if explicit:
        wanted = cycles.sparkSession.createDataFrame(list(explicit.items()), "_cycle string, _prior string").select(
            F.col("_cycle").cast(cycles.schema["cycle_id"].dataType), F.col("_prior").cast(cycles.schema["cycle_id"].dataType))
        earlier = cycles.where(eligible).select(F.col("cycle_id").alias("_prior"), F.col("cycle_no").alias("_prior_no"))
        allowed = wanted.join(earlier, "_prior", "left")
        found = (found.join(allowed, found["cycle_id"] == allowed["_cycle"], "left")
                 .withColumn("prior_cycle_id", F.when(F.col("_cycle").isNull(), F.col("prior_cycle_id")).when(
                     F.coalesce(F.col("_prior_no") < F.col("cycle_no"), F.lit(False)), F.col("_prior"))
                     .otherwise(F.raise_error(F.lit("explicit previous cycle is not eligible history"))))
                 .drop("_cycle", "_prior", "_prior_no"))
    return found.withColumn("first_cycle", F.col("prior_cycle_id").isNull())


def exclude_prior(candidates: DataFrame, prior: DataFrame, identities: Mapping[str, Sequence[Column]]) -> DataFrame:
    """Drop candidates sharing any identity with the cycle before them.

    ``identities`` maps a kind to the columns that hold identities of it; an array column holds any number. All of one kind are one
    set: an id in one column meets the same id in another. ``candidates`` has cycle_id and candidate_id; ``prior`` maps cycle_id to
    prior_cycle_id (cycle dimension). Both sides are exploded to (cycle, kind, key), which is computed once; history is reduced to distinct
    keys before it is shuffled, so a hot key costs one row there and AQE can split it on the candidate side.
    """
    def keyed(kind: str, column: Column) -> Column:
        listed = isinstance(candidates.select(column.alias("_c")).schema["_c"].dataType, ArrayType)
        keys = F.coalesce(column if listed else F.array(column), F.array()).cast("array<string>")
        return F.transform(keys, lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))

    pairs = F.concat(*[keyed(kind, c) for kind, columns in identities.items() for c in columns])
    exploded = pinned(candidates.select("cycle_id", "candidate_id", F.explode(pairs).alias("_id"))
                      .select("cycle_id", "candidate_id", "_id.kind", "_id.key").where(F.col("key").isNotNull()))
    history = exploded.select(F.col("cycle_id").alias("prior_cycle_id"), "kind", "key").distinct()
    hits = (exploded.join(prior.select("cycle_id", "prior_cycle_id"), "cycle_id")
            .join(history, ["prior_cycle_id", "kind", "key"], "left_semi")
            .select("cycle_id", "candidate_id").distinct())
    return candidates.join(hits, ["cycle_id", "candidate_id"], "left_anti")


def recall_monitor(df: DataFrame, keys: list[str], before: Column, after: Column, relevant: Column) -> DataFrame:
    """Candidates, misses and irrelevant share under two versions of a recall rule, per window or source."""
    labelled = relevant.isNotNull()

    def version(name: str, hit: Column) -> list[Column]:
        return [F.count_if(hit).alias(f"{name}_candidates"),
                F.count_if(labelled & relevant & ~hit).alias(f"{name}_misses"),
                F.count_if(labelled & ~relevant & hit).alias(f"{name}_irrelevant"),
                F.count_if(labelled & hit).alias(f"{name}_labelled")]

    counted = df.groupBy(*keys).agg(*version("before", before), *version("after", after))
    for name in ("before", "after"):
        counted = counted.withColumn(
            f"{name}_irrelevant_share",
            F.round(F.try_divide(F.col(f"{name}_irrelevant"), F.col(f"{name}_labelled")), 6)).drop(f"{name}_labelled")
    return counted
