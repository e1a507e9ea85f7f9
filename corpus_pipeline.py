"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

A stage takes (spark, docs, folder of the tables) and returns a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressledger.llm import passage_model, personal_data, sentence_pieces
from pressledger.llm.mixing import Mixture
from pressledger.llm.queries import QUALITY_THRESHOLD, held_out
from pressledger.llm.shingle_join import ShingleJoin
from pressledger.llm.tables import pinned, ready, table

#: power of a source's number of rows that its weight in the mixture follows
TEMPERATURE = 0.9


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier scores at the threshold or above; empty texts are scored like all others."""
    ready(spark)
    model = passage_model.train(docs, table(spark, folder, "labels"), ~held_out())
    return passage_model.accepted(docs, model, QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The smallest doc_id of every group of documents linked by runs of five words and a Jaccard similarity of 0.8 or more.

    Rows that repeat a doc_id are one document, linked by any of their texts, of which one row stays: that of the smallest hash. Rows without doc_id, and texts
    without words, stay.
    """
    ready(spark)
    groups = pinned(ShingleJoin(docs, width=5, num=8, den=10).components())
    dropped = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    repeated = groups.where("doc_id is not null").groupBy(F.col("doc_id").alias("_many")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_many")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("_row"), F.col("doc_id").alias("_id"))
    kept = held.join(dropped, F.col("_id") == F.col("_gone"), "left_anti")
    if repeated.isEmpty():
        return kept.select("_row.*")
    first = F.struct(F.sha2(F.coalesce(F.col("_row.text").cast("string"), F.lit("")), 256), F.xxhash64(F.to_json("_row")))
    one = (kept.join(repeated, F.col("_id") == F.col("_many"), "left_semi").groupBy("_id").agg(F.min_by("_row", first).alias("_row")).select("_row.*"))
    return kept.join(repeated, F.col("_id") == F.col("_many"), "left_anti").select("_row.*").unionByName(one)


def redaction(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; n_chars follows the text."""
    ready(spark)
    return personal_data.redacted(docs, personal_data.train(docs))


def mixture(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents in the order of the schedule, by their source's weight; null is a source of its own. The part files of the stage are
    in that order, which the tokens take over as their position."""
    ready(spark)
    return Mixture(docs, temperature=TEMPERATURE, nulls=True).ordered()


def in_file_order(docs: DataFrame) -> DataFrame:
    """(_key: doc_id and position, text): the place of every row in the part files that it is read from, from 0. Rows that come from no file have none."""
    try:
        read = docs.metadataColumn("_metadata")
        rows = docs.select("doc_id", "text", read["file_path"].alias("_file"), read["row_index"].alias("_at"))
    except AnalysisException:
        return docs.select(F.struct("doc_id", F.lit(None).cast("bigint").alias("position")).alias("_key"), "text")
    # one row for each file, written so that its size is known; tasks number the files
    files = rows.groupBy("_file").agg((F.max("_at") + 1).alias("_rows"))
    number = F.expr(r"try_cast(regexp_extract(_file, 'part-([0-9]+)[^/]*$', 1) as bigint)")
    starts = F.sum("_rows").over(Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1))
    starts = pinned(files.select(F.col("_file").alias("_of"), F.coalesce(starts, F.lit(0)).alias("_start")))
    placed = rows.join(starts, F.col("_file") == F.col("_of"))
    return placed.select(F.struct("doc_id", (F.col("_start") + F.col("_at")).alias("position")).alias("_key"), "text")


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip, parity, position) of every document; ``position`` is its place in the order of the stage before, from 0."""
    ready(spark)
    coded = sentence_pieces.encoded(in_file_order(docs), public_tokenizers.path("piece_bpe_32k.model"), key="_key")
    return coded.select("_key.doc_id", "ids", "n_tokens", "round_trip", "parity", "_key.position")


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("personal data", redaction),
          ("mixing sources", mixture), ("SentencePiece", tokens)]
#: SQL cannot express the learned stages and the tokenizer; the tests hold every stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = pinned(stage(spark, docs, folder))
    return docs
