"""An append-only history in which a key counts once and a batch commits once.

Rows are stored by the first digits of their key's digest. A batch meets only the parts of the history whose digits it has itself, so the cost of an append follows the batch
and not the history. The commit of a batch, a receipt of one row, is written last; a batch that is offered again returns its receipt and appends nothing,
and one that failed between its rows and its receipt is completed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import pinned

#: digits of the key's digest by which rows are stored, where nothing else is said: 256 parts
DIGITS = 2
#: rows of one part that a task writes on average
PART_ROWS = 500_000
RECEIPT = "batch bigint, offered bigint, appended bigint, replayed bigint, conflicts bigint"


def digest_of(columns: Sequence[str]) -> Column:
    """Digest of some columns as JSON; NULL is a value of its own."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


class History:
    """The history of ``schema`` rows below ``folder``; ``keys`` name a row and ``order`` says which of a batch's rows of one key comes first;
    ``digits`` sets the number of parts, 16 to that power.

    * ``append``: judges and appends a batch, returns its receipt: rows offered (one for each key), appended, replayed (the history has the same row) and in
      conflict (it has another row of that key, which stays).
    * ``rows``: the rows with the number of their batch. ``commits``: the receipts.

    NULL keys are keys. Rows of equal keys and order are told apart by their digest, so repeating a batch chooses the same one. An empty batch commits too.
    One writer at a time, as a stream's micro-batches are.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, keys: Sequence[str], order: str, digits: int = DIGITS) -> None:
        self.digits = digits
        self.spark, self.keys, self.order, self.columns = spark, list(keys), order, schema.names
        self.data, self.done = f"{folder.rstrip('/')}/rows", f"{folder.rstrip('/')}/commits"
        self.schema = StructType([*[StructField(f.name, f.dataType) for f in schema.fields], StructField("_batch", LongType()),
                                  StructField("_key", StringType()), StructField("_digest", StringType()), StructField("_part", StringType())])

    def _read(self, path: str, schema: StructType | str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def rows(self) -> DataFrame:
        return self._read(self.data, self.schema).select(*self.columns, F.col("_batch").alias("batch"))

    def commits(self) -> DataFrame:
        return self._read(self.done, RECEIPT)

    def known(self, parts: Sequence[str]) -> DataFrame:
        """(_key, _digest, _batch) in the named parts of the history; others are not read."""
        return self._read(self.data, self.schema).where(F.col("_part").isin(*parts)).select(
            "_part", "_key", F.col("_digest").alias("_held"), F.col("_batch").alias("_by"))

    def judged(self, batch: DataFrame) -> DataFrame:
        """The first row of every key of a batch, with ``_held`` and ``_by`` where the history has that key."""
        others = [c for c in self.columns if c not in (*self.keys, self.order)]
        marked = batch.select(*self.columns).withColumn("_key", digest_of(self.keys)).withColumn("_digest", digest_of([*self.keys, *others]))
        first = marked.groupBy("_key").agg(F.min(F.struct(self.order, "_digest", *[c for c in self.columns if c != self.order])).alias("_row"))
        rows = pinned(first.select("_key", F.substring("_key", 1, self.digits).alias("_part"), *[F.col(f"_row.{c}").alias(c) for c in (*self.columns, "_digest")]))
        # at most 16 ** digits names
        parts = sorted(r[0] for r in rows.select("_part").distinct().collect())
        if not parts:
            return rows.withColumn("_held", F.lit(None).cast("string")).withColumn("_by", F.lit(None).cast("bigint"))
        return rows.join(self.known(parts), ["_part", "_key"], "left")

    def append(self, batch: DataFrame, number: int) -> Row:
        receipt = self.commits().where(F.col("batch") == number).first()
        if receipt is not None:
            return receipt
        judged = pinned(self.judged(batch).select("*", F.when(F.col("_held").isNull(), "new").when(F.col("_by") == number, "appended").when(
            F.col("_held") == F.col("_digest"), "replayed").otherwise("conflict").alias("_outcome")))
        fresh = judged.where("_outcome = 'new'").withColumn("_batch", F.lit(number).cast("bigint"))
        counts = judged.agg(F.count(F.lit(1)).alias("offered"), *[F.count_if(F.col("_outcome").isin(*names)).alias(c) for c, names in (
            ("appended", ("new", "appended")), ("replayed", ("replayed",)), ("conflicts", ("conflict",)))]).select(F.lit(number).cast("bigint").alias("batch"), "*").first()
        # one file for each part, more for large batches
        salt = F.pmod(F.xxhash64("_key"), F.lit(1 + counts["appended"] // (PART_ROWS * 16**self.digits)))
        fresh.select(*self.schema.names).repartition(F.col("_part"), salt).write.mode("append").partitionBy("_part").parquet(self.data)
        self.spark.createDataFrame([tuple(counts)], RECEIPT).coalesce(1).write.mode("append").parquet(self.done)
        return counts

    def sink(self) -> Callable[[DataFrame, int], None]:
        """A writer for ``foreachBatch``."""
        def write(batch: DataFrame, number: int) -> None:
            self.append(batch, number)
        return write
