"""URL filter in the manner of safe-browsing lists: expressions, short hash prefixes, full digests, precedence.

A rule is a host and the start of a path (``example.net/en/``). A URL is expanded into the host suffixes and path starts
that rules can have, their SHA-256 prefixes meet the rules' in an equi-join, full digests confirm, the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: hex digits of the digest that the join is keyed by (4 bytes)
PREFIX_DIGITS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 2)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(action, rule) pairs as the table that ``judge`` takes."""
    return compiled(spark.createDataFrame(rules, "action string, rule string"))


def compiled(rules: DataFrame) -> DataFrame:
    """Rules with their parts, their shape (labels of the host, length of the path) and their digests."""
    host = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    path = F.expr("if(instr(rule, '/') > 0, substring(rule, instr(rule, '/')), '')")
    return (rules.where(F.col("rule").isNotNull() & F.col("action").isin("allow", "block"))
            .select("action", "rule", host.alias("host"), path.alias("path"))
            .select("*", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_length"),
                    F.sha2(F.concat("host", "path"), 256).alias("digest"))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS)))


def judge(urls: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) for every row of ``urls``; ``rules`` comes from ``compiled``.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest rule wins; of equal
    ones that with the longer host, then an allowing one, then the last by text. URLs that no rule fits get ``default``.

    Null URLs and those without ``://`` have empty host and path. Rows that repeat (key, url) are judged once and come back
    as often as they came; null keys are kept. Other columns of ``urls`` are not read.

    Expressions are built only for the shapes that occur among the rules, which is exact: no other can be equal
    to a rule. Shapes are collected to the driver: label counts times path lengths of rules, not rules.
    """
    shapes = [(r.labels, r.path_length) for r in rules.select("labels", "path_length").distinct().collect()]
    own = urls.select(F.col(key).alias("_key"), F.col(url).alias("_url")).groupBy("_key", "_url").agg(F.count(F.lit(1)).alias("_times"))
    parts = own.select("*", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path"))
    labels = F.size(F.split("_host", r"\."))
    expressions = [F.when((labels >= n) & (F.length("_path") >= size),
                          F.concat(F.substring_index("_host", ".", -n), F.substring("_path", 1, size)))
                   for n, size in shapes]
    built = F.array_compact(F.array(*expressions)) if expressions else F.array().cast("array<string>")
    expanded = (parts.select("*", F.explode_outer(built).alias("_expression"))
                .withColumn("_digest", F.sha2("_expression", 256)).withColumn("_prefix", F.substring("_digest", 1, PREFIX_DIGITS)))
    known = rules.select(F.col("prefix").alias("_rule_prefix"), F.col("digest").alias("_rule_digest"), F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
        (F.col("action") == "allow").alias("allows"), F.col("rule"), F.col("action")).alias("_found"))
    met = expanded.join(known, (F.col("_prefix") == F.col("_rule_prefix")) & (F.col("_digest") == F.col("_rule_digest")), "left")
    top = met.groupBy("_key", "_url", "_times", "_host", "_path").agg(F.max("_found").alias("_top"))
    return (top.select("*", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
            .select(F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path"),
                    F.col("_top.rule").alias("rule"), F.coalesce("_top.action", F.lit(default)).alias("verdict")))
