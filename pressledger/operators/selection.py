"""Quota selection and everything that follows from ranks inside (cycle, category)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions.scoring import category_ordinal, emphasis
from .windows import HOT_ROWS, running_sums


def best_first() -> list[Column]:
    return [F.col("score").desc(), F.col("candidate_id")]


def select_by_quota(qualified: DataFrame, reserve_only_if_policy_short: bool = False) -> DataFrame:
    """Paper <= 10, Policy <= 3, News up to 10 minus the Policy count, per cycle.

    The literal ``<= 10`` lets the window keep ten rows per group on the map side, so a hot (cycle, category) never
    meets in one task; what is left per cycle is at most 30 rows.
    """
    ranks = Window.partitionBy("cycle_id", "category").orderBy(*best_first())
    survivors = (qualified.withColumn("group_rank", F.row_number().over(ranks).cast("bigint"))
                 .where(F.col("group_rank") <= rules.PAPER_CAPACITY))
    policy = F.sum(((F.col("category") == "Policy") & (F.col("group_rank") <= rules.POLICY_CAPACITY)).cast("int")).over(
        Window.partitionBy("cycle_id"))
    news = rules.NEWS_POLICY_CAPACITY - policy
    if reserve_only_if_policy_short:
        news = F.when(policy >= rules.POLICY_CAPACITY, rules.NEWS_TARGET).otherwise(news)
    capacity = (F.when(F.col("category") == "Paper", rules.PAPER_CAPACITY)
                .when(F.col("category") == "Policy", rules.POLICY_CAPACITY).otherwise(news))
    return (survivors.withColumn("_capacity", capacity).where(F.col("group_rank") <= F.col("_capacity"))
            .withColumn("emphasis", emphasis(F.col("category"), F.col("group_rank"))).drop("_capacity"))


def backfill_papers(df: DataFrame, admitted: Column) -> DataFrame:
    """Up to ten Papers per cycle: those over the cutoff, then admitted ones below it; the shortage is reported
    for every cycle, also those with no Paper at all."""
    over = F.col("score") >= rules.CUTOFF
    ranks = Window.partitionBy("cycle_id").orderBy(over.desc(), *best_first())
    chosen = (df.where((F.col("category") == "Paper") & (over | admitted))
              .withColumn("group_rank", F.row_number().over(ranks).cast("bigint"))
              .where(F.col("group_rank") <= rules.PAPER_CAPACITY)
              .withColumn("backfilled", ~over)
              .withColumn("_count", F.count(F.lit(1)).over(Window.partitionBy("cycle_id"))))
    return (df.select("cycle_id").distinct().join(chosen, "cycle_id", "left")
            .select("cycle_id", "candidate_id", "score", "group_rank", "backfilled",
                    (rules.PAPER_CAPACITY - F.coalesce("_count", F.lit(0))).cast("bigint").alias("shortage")))


def group_rank(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    return running_sums(df, ["cycle_id", "category"], best_first(), {"group_rank": F.lit(1)}, hot_rows)


def compress_ranks(df: DataFrame, dropped: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Ranks after drops: the old rank less the drops at or before the row, so survivors keep their order."""
    ranked = running_sums(df, ["cycle_id", "category"], best_first(),
                          {"old_rank": F.lit(1), "_drops": dropped.cast("int")}, hot_rows)
    return (ranked.where(~dropped)
            .withColumn("new_rank", F.col("old_rank") - F.col("_drops")).drop("_drops"))


def rerank_legacy(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One global order per cycle turned into dense ranks per category, in a single pass."""
    counts = {f"_{c}": (F.col("category") == c).cast("int") for c in rules.CATEGORIES}
    ranked = running_sums(df, ["cycle_id"], best_first(), {"legacy_rank": F.lit(1), **counts}, hot_rows)
    rank = F.coalesce(*[F.when(F.col("category") == c, F.col(f"_{c}")) for c in rules.CATEGORIES])
    return ranked.withColumn("group_rank", rank).drop(*counts)


def rank_density(df: DataFrame, group: str, rank: str) -> DataFrame:
    """Are the ranks of each group exactly 1..n? Distinct (group, rank) pairs are reduced before the group meets."""
    pairs = df.groupBy(group, rank).agg(F.count(F.lit(1)).alias("_n"))
    return (pairs.groupBy(group)
            .agg(F.sum("_n").alias("rank_count"), F.count(F.lit(1)).alias("distinct_ranks"),
                 F.min(rank).cast("bigint").alias("min_rank"), F.max(rank).cast("bigint").alias("max_rank"))
            .withColumn("dense", (F.col("min_rank") == 1) & (F.col("max_rank") == F.col("rank_count"))
                        & (F.col("distinct_ranks") == F.col("rank_count"))))


def latest_report(df: DataFrame) -> DataFrame:
    """Rows of the newest cycle. The maximum is a single row, so its broadcast is bounded by construction."""
    newest = df.agg(F.max("cycle_id").alias("cycle_id"))
    return df.join(F.broadcast(newest), "cycle_id", "left_semi")


def report_order(selection: DataFrame) -> DataFrame:
    """Position inside the report: Paper, News, Policy, then rank. At most 20 selected rows per cycle."""
    ordinal = category_ordinal(F.col("category"))
    window = Window.partitionBy("cycle_id").orderBy(ordinal, "group_rank")
    return (selection.withColumn("category_order", ordinal)
            .withColumn("position", F.row_number().over(window).cast("bigint")))


def quota_violations(df: DataFrame, cycles: DataFrame) -> DataFrame:
    """Counts and the broken quota rules per cycle of ``cycles`` (cycle_id), those without any record included. News + Policy share one
    capacity, so 10/7/3 is legal."""
    n = {c: F.count_if(F.col("category") == c).alias(f"{c.lower()}_count") for c in rules.CATEGORIES}
    other = F.count_if(~F.col("category").isin(*rules.CATEGORIES) | F.col("category").isNull())
    found = df.groupBy("cycle_id").agg(F.count(F.lit(1)).alias("total"), *n.values(), other.alias("other_count"))
    counted = cycles.select("cycle_id").distinct().join(found, "cycle_id", "left").na.fill(0)
    checks = F.array(
        F.when(F.col("total") == 0, "empty"),
        F.when(F.col("total") > rules.SELECTION_LIMIT, "total"),
        F.when(F.col("paper_count") > rules.PAPER_CAPACITY, "paper"),
        F.when(F.col("policy_count") > rules.POLICY_CAPACITY, "policy"),
        F.when(F.col("news_count") + F.col("policy_count") > rules.NEWS_POLICY_CAPACITY, "news_policy"),
        F.when(F.col("other_count") > 0, "category"))
    return counted.withColumn("violations", F.array_join(F.array_compact(checks), ",")).drop("other_count")


def quota_proof(published: DataFrame, revisions: DataFrame) -> DataFrame:
    """The ten derived fields per cycle under its revision, and whether the quotas hold.

    ``revisions`` has one row per cycle: cycle_id, revision ('policy3', NULL, or a named archive revision).
    """
    count = {c: F.count_if(F.col("category") == c) for c in rules.CATEGORIES}
    counted = published.groupBy("cycle_id").agg(*[count[c].alias(f"{c.lower()}_count") for c in rules.CATEGORIES])
    revision = F.col("revision")
    current = F.coalesce(revision == "policy3", F.lit(False))
    extended = F.coalesce(~current & revision.rlike(rules.LEGACY_REVISION), F.lit(False))
    paper, news, policy = F.col("paper_count"), F.col("news_count"), F.col("policy_count")
    total = paper + news + policy
    legacy_shape = ((paper == rules.LEGACY_COUNTS["Paper"]) & (news == rules.LEGACY_COUNTS["News"])
                    & (policy == rules.LEGACY_COUNTS["Policy"]))
    news_capacity = F.when(extended, rules.LEGACY_COUNTS["News"]).otherwise(rules.NEWS_POLICY_CAPACITY - policy)
    policy_capacity = F.when(current, rules.POLICY_CAPACITY).otherwise(rules.UNREVISED_POLICY_CAPACITY)
    return (revisions.join(counted, "cycle_id", "left").na.fill(0, ["paper_count", "news_count", "policy_count"])
            .select(
                "cycle_id", "revision", F.lit(rules.SELECTION_LIMIT).cast("bigint").alias("selection_limit"),
                "paper_count", "news_count", "policy_count", total.alias("selected_total"),
                (news + policy).alias("news_policy_total"),
                F.lit(rules.PAPER_CAPACITY).cast("bigint").alias("paper_capacity"),
                policy_capacity.cast("bigint").alias("policy_capacity"),
                news_capacity.cast("bigint").alias("news_final_capacity"),
                F.greatest(F.lit(0), F.least(news, news_capacity) - rules.NEWS_TARGET).cast("bigint")
                .alias("news_fallback_used"),
                ((revision.isNull() | current | extended) & (~extended | legacy_shape)
                 & (total <= rules.SELECTION_LIMIT + extended.cast("int")) & (paper <= rules.PAPER_CAPACITY)
                 & (policy <= policy_capacity) & (news <= news_capacity)).alias("quotas_hold")))


def digest_messages(df: DataFrame, title: Column) -> DataFrame:
    """One text per cycle of a publication: count, first three titles and 'n more' per category, also for a category without records.

    Counting is a partial aggregate and only three titles per (cycle, category) leave the map side.
    """
    counts = df.groupBy("cycle_id", "category").agg(F.count(F.lit(1)).alias("n"))
    window = Window.partitionBy("cycle_id", "category").orderBy(*best_first())
    titles = (df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= 3)
              .groupBy("cycle_id", "category")
              .agg(F.array_sort(F.collect_list(F.struct("_rank", title.alias("title")))).alias("_titles")))
    every = counts.select("cycle_id").distinct().select("cycle_id", F.explode(F.array(*[F.lit(c) for c in rules.CATEGORIES])).alias("category"))
    filled = (every.join(counts, ["cycle_id", "category"], "left").join(titles, ["cycle_id", "category"], "left")
              .withColumn("n", F.coalesce("n", F.lit(0))))
    empty = F.array().cast("array<string>")
    lines = F.concat(
        F.array(F.concat(F.col("category"), F.lit(": "), F.col("n").cast("string"))),
        F.coalesce(F.transform("_titles", lambda t: F.concat(F.lit("- "), t["title"])), empty),
        F.when(F.col("n") > 3, F.array(F.concat(F.lit("- 另有 "), (F.col("n") - 3).cast("string"), F.lit(" 条")))).otherwise(empty))
    blocks = filled.select("cycle_id", category_ordinal(F.col("category")).alias("_order"), F.array_join(lines, "\n").alias("_block"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_order", "_block"))),
                                    lambda b: b["_block"]), "\n")
    return (blocks.groupBy("cycle_id").agg(text.alias("message"))
            .withColumn("within_limit", F.length("message") <= rules.MESSAGE_CHARS))
