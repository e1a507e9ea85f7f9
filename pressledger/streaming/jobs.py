"""Streaming jobs: sources, keyed state, sinks that survive replays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_log(spark: SparkSession, folder: str, glob: str, files_per_trigger: int | None = None,
             bytes_per_trigger: int = 1 << 30) -> DataFrame:
    """A file stream of Parquet logs with the schema of the files already there.

    The size of a micro-batch is bounded, and with it the rows of any one key a stateful task sees at a time.
    """
    schema = spark.read.option("pathGlobFilter", glob).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(folder)


def stateful(log: DataFrame, keys: list[str], machine: tuple[StatefulProcessor, str]) -> DataFrame:
    processor, schema = machine
    log.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return log.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="None")


def run_to_end(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Process everything available into Parquet, exactly once under the checkpoint."""
    query = (stream.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()


def run_batches_to_end(stream: DataFrame, counted: Callable[[DataFrame], DataFrame], output: str, checkpoint: str) -> None:
    """Count every micro-batch on its own and write its partial counts under its own number, so a replayed micro-batch overwrites itself.

    Counts add up, so nothing waits for a watermark and no row is too late: it counts in the batch it came with.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        counted(batch).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def summed_rows(spark: SparkSession, output: str, keys: list[str], columns: list[str]) -> DataFrame:
    """The partial counts written by ``run_batches_to_end``, added up."""
    parts = spark.read.option("basePath", output).parquet(output)
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def event_column(event: str, field: str):
    return F.get_json_object(event, f"$.{field}")
