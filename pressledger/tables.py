"""The driver tables and the views the queries are phrased over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import prepare


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """For work that is heavy per row: use every core although the input has fewer splits than the cluster has cores.

    An input with enough splits, so any large one, is left alone and costs no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def text_of(column: Column | str) -> Column:
    return F.col(column).cast("string") if isinstance(column, str) else column.cast("string")


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """One rated candidate per order; the cycle is the Monday of its week."""
    key, cust, priority = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    return load(spark, folder, "orders").select(
        F.concat(F.lit("order-"), text_of(key)).alias("candidate_id"),
        F.date_trunc("week", "o_orderdate").cast("date").alias("cycle_id"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "Paper")
        .when((priority == "5-LOW") & (key % 3 == 0), "Policy").otherwise("News").alias("category"),
        (40 + (key * 7919 + cust * 31) % 61).alias("score"),
        cust.alias("source_key"), "o_orderstatus")


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Source events; ``seq`` is unique and is the total order."""
    kind = F.col("event_type")
    return load(spark, folder, "events").select(
        F.col("event_id").alias("seq"), "ts",
        F.concat(F.lit("s"), text_of(F.col("user_id") % 20)).alias("source"),
        F.concat(F.lit("k"), text_of((F.col("user_id") * 13 + F.col("event_id")) % 97)).alias("event_key"),
        F.when(kind.isin("view", "signup"), "seen").when(kind.isin("click", "error"), "pending")
        .otherwise("emitted").alias("status"),
        kind, "user_id", "value", "props")


def doc_records(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Documents as records; ask for the columns needed so that ``text`` is read only when used."""
    docs, labels = load(spark, folder, "documents"), load(spark, folder, "labels")
    d = docs.join(labels, "doc_id", "left") if not columns or {"quality", "toxic", "outcome"} & set(columns) else docs
    full = {
        "candidate_id": F.concat(F.lit("doc-"), text_of("doc_id")),
        "doc_id": F.col("doc_id"), "source": F.col("source"), "lang": F.col("lang"), "text": F.col("text"),
        "category": F.when(F.col("doc_id") % 3 == 0, "Paper").when(F.col("doc_id") % 3 == 1, "News")
        .otherwise("Policy"),
        "path": F.concat_ws("/", "source", "lang", F.concat(text_of("doc_id"), F.lit(".md"))),
        "quality": F.col("quality") if "quality" in d.columns else None,
        "toxic": F.col("toxic") if "toxic" in d.columns else None,
    }
    if "quality" in d.columns:
        full["outcome"] = (F.when(F.col("quality").isNull(), "uncovered")
                           .when(F.col("quality") == 1, "success").otherwise("dropped"))
    return d.select(*[full[c].alias(c) for c in (columns or full)])


def conv_stages(spark: SparkSession, folder: str) -> DataFrame:
    turn, conv = F.col("turn"), F.col("conv_id")
    return load(spark, folder, "conversations").select(
        "conv_id", turn.cast("int").alias("pos"), F.col("role").alias("stage"), "text",
        F.when(turn % 4 == 0, "full_text").when(turn % 4 == 1, "official").when(turn % 4 == 2, "supplement")
        .otherwise("attempt").alias("kind"),
        F.concat(F.lit("https://example.org/"), text_of(conv), F.lit("/"), text_of(turn % 3)).alias("url"),
        F.when(conv % 3 == 0, "Paper").when(conv % 3 == 1, "News").otherwise("Policy").alias("category"))


def score_dims(spark: SparkSession, folder: str) -> DataFrame:
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        ((order * 3 + line) % 33).alias("relevance"), ((order * 5 + line) % 23).alias("novelty"),
        ((order * 7 + line) % 23).alias("credibility"), ((order * 11 + line) % 18).alias("impact"),
        ((order * 13 + line) % 13).alias("team"), ((order * 17 + line) % 8).alias("timeliness"))
