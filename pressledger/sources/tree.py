"""Trees of documents: one file per row, written in two phases, and whole trees read back by many tasks.

Tasks write files below a staging folder and list them; nothing stands in the tree until all tasks are done and no path occurs twice. Then the
files are moved by a second job, each move idempotent, and the manifest (a Parquet table) is written last: a reader trusts what it names. A failed
task, or a failed job, leaves no file in the tree.

Files are reached through ``pyarrow.fs``, so folders may be local or mounted paths, ``file:``, ``s3:``, ``gs:`` or ``hdfs:`` addresses that all executors reach.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

# executors need none of the library's files
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: files that a task lists at a time
INDEX_ROWS = 10_000
INDEX = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("attempt", pa.string())])


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path on it."""
    if folder.startswith("file:"):
        folder = "/" + folder[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def relative(path: str | None) -> str:
    """A path that stays below its folder, or an error."""
    if not path or path.startswith("/") or "\\" in path or any(part in ("", ".", "..") for part in path.split("/")):
        raise ValueError(f"not a relative path of a document: {path!r}")
    return path


@dataclass
class Written(WriterCommitMessage):
    attempt: str
    files: int


class StagedTree(DataSource):
    """Target of (path, content) rows: files below ``<folder>.pending/<job>/<attempt>`` and a list of them for each task."""

    @classmethod
    def name(cls) -> str:
        return "staged_tree"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return StagingWriter(self.options["path"])


class StagingWriter(DataSourceArrowWriter):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, root = opened(self.folder)
        attempt = f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}"
        stage, made, count = f"{root}/{attempt}", set(), 0
        files.create_dir(f"{root}/index", recursive=True)
        try:
            with pq.ParquetWriter(f"{root}/index/{attempt}.parquet", INDEX, filesystem=files) as index:
                for batch in iterator:
                    rows = []
                    for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                        body, parent = content.as_buffer() or b"", f"{stage}/{relative(path)}".rsplit("/", 1)[0]
                        if parent not in made:
                            files.create_dir(parent, recursive=True)
                            made.add(parent)
                        with files.open_output_stream(f"{stage}/{path}") as out:
                            out.write(body)
                        rows.append((path, len(body), hashlib.sha256(body).hexdigest(), attempt))
                    for first in range(0, len(rows), INDEX_ROWS):
                        index.write_table(pa.table([pa.array(c, t) for c, t in zip(zip(*rows[first:first + INDEX_ROWS], strict=True), INDEX.types, strict=True)], schema=INDEX))
                    count += len(rows)
        except BaseException:
            # the task may be repeated under another name
            discard(files, stage)
            if files.get_file_info(f"{root}/index/{attempt}.parquet").type != fs.FileType.NotFound:
                files.delete_file(f"{root}/index/{attempt}.parquet")
            raise
        return Written(attempt, count)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Names the attempts that count, one for each task; others may have been lost with their executor."""
        files, root = opened(self.folder)
        done = pa.table({"attempt": pa.array([m.attempt for m in messages if m is not None], pa.string())})
        files.create_dir(f"{root}/committed", recursive=True)
        pq.write_table(done, f"{root}/committed/attempts.parquet", filesystem=files)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        discard(*opened(self.folder))


def discard(files: fs.FileSystem, folder: str) -> None:
    if files.get_file_info(folder).type != fs.FileType.NotFound:
        files.delete_dir(folder)


def _moved(pending: str, folder: str):
    """Moves listed files into the tree. A file that an earlier attempt of the task has moved is already there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (files, source), (_, target) = opened(pending), opened(folder)
        made: set[str] = set()
        for batch in batches:
            for path, size, attempt in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "attempt")), strict=True):
                staged, place = f"{source}/{attempt}/{path}", f"{target}/{path}"
                parent = place.rsplit("/", 1)[0]
                if parent not in made:
                    files.create_dir(parent, recursive=True)
                    made.add(parent)
                if files.get_file_info(staged).type == fs.FileType.File:
                    files.move(staged, place)
                elif files.get_file_info(place).size != size:
                    raise FileNotFoundError(f"{path} is neither staged nor in the tree")
            yield batch.select(["path", "bytes", "sha256"])
    return run


def stage_tree(documents: DataFrame, folder: str) -> str:
    """First phase: writes (path, content) rows below a staging folder, whose name is returned. Paths that leave the tree fail the write."""
    spark = documents.sparkSession
    spark.dataSource.register(StagedTree)
    pending = f"{folder.rstrip('/')}.pending/{uuid.uuid4().hex}"
    documents.select(F.col("path").cast("string"), F.col("content").cast("binary")).write.format("staged_tree").mode("append").save(pending)
    return pending


def publish_tree(spark: SparkSession, pending: str, folder: str) -> DataFrame:
    """Second phase: moves the staged files and writes the manifest, which is returned: (path, bytes, sha256). May be repeated after a failure."""
    listed = spark.read.schema("path string, bytes long, sha256 string, attempt string").parquet(f"{pending}/index")
    counted = listed.join(spark.read.parquet(f"{pending}/committed"), "attempt", "left_semi")
    twice = counted.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("path").first()
    if twice is not None:
        discard(*opened(pending))
        raise ValueError(f"two documents have the path {twice[0]!r}; nothing is published")
    manifest = f"{folder.rstrip('/')}.manifest/{pending.rsplit('/', 1)[1]}"
    counted.mapInArrow(_moved(pending, folder), "path string, bytes long, sha256 string").write.mode("overwrite").parquet(manifest)
    discard(*opened(pending))
    return spark.read.schema("path string, bytes long, sha256 string").parquet(manifest)


def write_tree(documents: DataFrame, folder: str) -> DataFrame:
    """Writes one file for each (path, content) row below ``folder`` and returns the manifest.

    NULL content is an empty file; a NULL or unsafe path, and two rows with one path, fail the write before the tree is touched. A file that stands at a path already
    is replaced. An empty table writes an empty manifest.
    """
    return publish_tree(documents.sparkSession, stage_tree(documents, folder), folder)


def _found(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = opened(folder)
        for batch in batches:
            sizes, digests = [], []
            for path in batch.column("path").to_pylist():
                there = files.get_file_info(f"{root}/{relative(path)}")
                digest = hashlib.sha256()
                if there.type == fs.FileType.File:
                    with files.open_input_stream(f"{root}/{path}") as stream:
                        while block := stream.read(1 << 20):
                            digest.update(block)
                sizes.append(there.size if there.type == fs.FileType.File else None)
                digests.append(digest.hexdigest() if there.type == fs.FileType.File else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], [*batch.schema.names, "found_bytes", "found_sha256"])
    return run


def read_back(manifest: DataFrame, folder: str) -> DataFrame:
    """(path, bytes, sha256, found_bytes, found_sha256, verdict) of every file that a manifest names: ``ok``, ``changed`` or ``missing``. Files are read
    by the tasks that hold their names, a block at a time; the driver lists nothing."""
    rows = manifest.select("path", "bytes", "sha256").mapInArrow(_found(folder), "path string, bytes long, sha256 string, found_bytes long, found_sha256 string")
    same = (F.col("bytes") == F.col("found_bytes")) & (F.col("sha256") == F.col("found_sha256"))
    return rows.withColumn("verdict", F.when(F.col("found_sha256").isNull(), "missing").when(same, "ok").otherwise("changed"))


def stray_files(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """(path, found_bytes) of the files below ``folder`` that the manifest does not name; names and sizes only are read."""
    root = opened(folder)[1].rstrip("/") + "/"
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
              .select(F.substring_index("path", root, -1).alias("path"), F.col("length").alias("found_bytes")))
    return listed.join(manifest.select("path"), "path", "left_anti")
