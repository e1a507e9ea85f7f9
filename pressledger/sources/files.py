"""Binary and text trees, and the content store."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import in_publishable_scope


def without_control_files(files: DataFrame, manifest: str | None = None) -> DataFrame:
    kept = files.where(~F.col("path").endswith(".lock"))
    return kept.where(F.col("path") != manifest) if manifest else kept


def _relative(folder: str):
    file_path = F.regexp_replace(F.col("_metadata.file_path"), r"^file:/+", "/")
    return F.substring_index(file_path, folder.rstrip("/") + "/", -1)


def binary_inventory(spark: SparkSession, folder: str, manifest: str | None = None) -> DataFrame:
    """(path, sha256, size) of every file below ``folder``, lock files and the manifest itself left out."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
             .select(_relative(folder).alias("path"), F.sha2("content", 256).alias("sha256"),
                     F.length("content").cast("bigint").alias("size")))
    return without_control_files(files, manifest)


def inventory_receipt(inventory: DataFrame) -> DataFrame:
    """Files, bytes and whether the build stays within its limits."""
    return inventory.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).withColumn(
        "within_limits", (F.col("files") <= rules.ARTIFACT_FILES) & (F.col("bytes") <= rules.ARTIFACT_BYTES))


def read_text_tree(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of the publishable text files below ``folder``; excluded files are skipped before they are read
    into rows. Whole files, one row each."""
    return (spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True)
            .select(_relative(folder).alias("path"), F.col("value").alias("text"))
            .where(in_publishable_scope(F.col("path"))))


def write_content_store(df: DataFrame, content: str, folder: str) -> None:
    """Append every content the store does not have yet, once, partitioned by the first two hash digits. Only the parts of the store that
    the new contents fall in are read, and of those the digests."""
    binary = F.col(content).cast("binary")
    blobs = (df.select(F.sha2(binary, 256).alias("sha256"), binary.alias("content")).dropDuplicates(["sha256"])
             .withColumn("size", F.length("content").cast("bigint"))
             .withColumn("prefix2", F.substring("sha256", 1, 2)))
    known = read_content_store(df.sparkSession, folder)
    if known is not None:
        # at most 256 names
        parts = [r[0] for r in blobs.select("prefix2").distinct().collect()]
        # the names of folders such as 05 would be read as numbers
        held = df.sparkSession.read.schema("sha256 string, prefix2 string").parquet(folder)
        blobs = blobs.join(held.where(F.col("prefix2").isin(*parts)).select("sha256"), "sha256", "left_anti") if parts else blobs
    blobs.write.mode("append").partitionBy("prefix2").parquet(folder)


def read_content_store(spark: SparkSession, folder: str) -> DataFrame | None:
    """The store, or None while nothing has been written to it."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
