"""How the operators of this package meet a session, its tables and its shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession

from pressledger.session import pinned, prepare

#: Python workers get batches of at most so many rows and bytes, however long the texts are
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return spark


Batches = Iterator[pa.RecordBatch]


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``; when its task ends, the worker gives its freed memory back to the machine. Workers serve task after
    task, and what they have once held would otherwise count against the executor for good."""
    def own(batches: Batches) -> Batches:
        import ctypes

        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return own


def smallest(rows: DataFrame, number: Column, most: int, *ties: str) -> DataFrame:
    """The ``most`` rows of smallest ``number`` (evenly spread over 0 to 1), then of ``ties``. ``rows`` is read twice, so pin what is dear.

    Rows are counted and cut at a share that leaves a few more than wanted, so that tasks do not each send ``most`` rows to the last step.
    """
    total = rows.count()
    share = (most + 6 * most**0.5 + 10) / max(total, 1)
    kept = rows.where(number < share) if share < 1 else rows
    return kept.orderBy(number, *ties).limit(most)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


__all__ = ["pinned", "ready", "released", "smallest", "table"]
