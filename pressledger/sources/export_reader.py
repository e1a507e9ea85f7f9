"""Large nested exports read by many tasks through a structural index.

An export is one JSON object ``{tables: {T: {records: [...]}}, columns: {T: {columns: [...]}}, attachments: [...], attachment_failures: []}``. A file is cut into
blocks of bytes. A first scan gives what each block does to the state of a parser: the parity of its quotes and, for a beginning inside and outside a string, how far it goes
down or up. Both add up, so a prefix over one row per block tells every block where it begins. With that, blocks find the few keys of the envelope, and then,
each on its own, the elements that begin in them; an element that ends in a later block is read to its end by the task where it begins.

Files are reached through ``pyarrow.fs`` by ranges; nobody holds a whole file.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import few_slices, prior
from ..session import pinned
from . import tree
from .tree import opened

# executors need none of the library's files
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: bytes of a block, and bytes that are read at a time beyond its ends
BLOCK, LOOK = 2 << 20, 1 << 16
#: blocks that a task reads on average
TASK_BLOCKS = 16
QUOTE, BACKSLASH, COLON = ord('"'), ord("\\"), ord(":")
#: fixed values of the format: members of the envelope and what opens their values, and the list that a table holds
ENVELOPE = {"tables": "{", "columns": "{", "attachments": "[", "attachment_failures": "["}
LISTS = {"tables": "records", "columns": "columns"}
WHITE = b" \t\r\n"


class Structure:
    """Quotes, brackets and colons of some bytes that begin inside a string or not, and after an odd number of backslashes or not."""

    def __init__(self, data: bytes, escaped: bool = False) -> None:
        self.bytes = np.frombuffer(data, np.uint8)
        place = np.arange(len(self.bytes))
        slash = self.bytes == BACKSLASH
        # a quote counts unless an odd run of backslashes stands before it
        plain = np.maximum.accumulate(np.where(slash, -1 - int(escaped), place)) if len(place) else place
        quotes = np.flatnonzero(self.bytes == QUOTE)
        before = np.where(quotes > 0, plain[quotes - 1] if len(plain) else 0, -1 - int(escaped))
        self.quotes = quotes[(quotes - 1 - before) % 2 == 0]
        self.marks = np.flatnonzero(np.isin(self.bytes, np.frombuffer(b"{}[]:", np.uint8)))

    def outside(self, in_string: bool) -> np.ndarray:
        """Places of the brackets and colons that are not in a string."""
        return self.marks[(np.searchsorted(self.quotes, self.marks) + int(in_string)) % 2 == 0]

    def steps(self, places: np.ndarray) -> np.ndarray:
        kinds = self.bytes[places]
        return np.isin(kinds, np.frombuffer(b"{[", np.uint8)).astype(np.int64) - np.isin(kinds, np.frombuffer(b"}]", np.uint8))


class Bytes:
    """Ranges of one file."""

    def __init__(self, path: str) -> None:
        files, place = opened(path)
        self.file = files.open_input_file(place)
        self.size = self.file.size()

    def read(self, lo: int, hi: int) -> bytes:
        lo, hi = max(lo, 0), min(hi, self.size)
        return self.file.read_at(hi - lo, lo) if hi > lo else b""

    def escaped(self, at: int) -> bool:
        """Whether an odd run of backslashes stands before a place."""
        run, lo = 0, at
        while lo > 0:
            part = self.read(lo - LOOK, lo)
            kept = part.rstrip(b"\\")
            run += len(part) - len(kept)
            if kept:
                break
            lo -= len(part)
        return run % 2 == 1

    def structure(self, lo: int, hi: int) -> Structure:
        return Structure(self.read(lo, hi), self.escaped(lo))

    def key_before(self, colon: int) -> str:
        """The key that a colon stands behind."""
        size = LOOK
        while True:
            part = self.read(colon - size, colon).rstrip(WHITE)
            at = part.rfind(b'"', 0, len(part) - 1)
            while at > 0 and (at - len(part[:at].rstrip(b"\\"))) % 2 == 1:
                at = part.rfind(b'"', 0, at)
            if at > 0 or (at == 0 and size >= colon):
                return json.loads(part[at:].decode())
            if size >= colon:
                raise ValueError("a colon without a key")
            size *= 4

    def first_after(self, place: int) -> tuple[int, str]:
        """Place and character of what follows, white space left out."""
        while place < self.size:
            part = self.read(place, place + LOOK)
            kept = part.lstrip(WHITE)
            if kept:
                return place + len(part) - len(kept), chr(kept[0])
            place += len(part)
        return self.size, ""

    def element(self, lo: int, known: int) -> bytes:
        """The object that begins at ``lo``; ``known`` bytes are looked at first."""
        size = max(known, LOOK)
        while True:
            found = Structure(self.read(lo, lo + size))
            places = found.outside(False)
            depth = np.cumsum(found.steps(places))
            end = np.flatnonzero((depth == 0) & (found.bytes[places] != COLON))
            if len(end):
                return found.bytes[:places[end[0]] + 1].tobytes()
            if lo + size >= self.size:
                raise ValueError("an element of the export is cut off")
            size *= 2


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Bytes]]:
    held = None
    for batch in batches:
        for row in batch.to_pylist():
            if held is None or held[0] != row["file"]:
                held = (row["file"], Bytes(row["file"]))
            yield row, held[1]


def _states(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, file in _each(batches):
            lo = row["block"] * block
            found = file.structure(lo, lo + block)
            deep = [int(found.steps(found.outside(inside)).sum()) for inside in (False, True)]
            yield pa.RecordBatch.from_pylist([{"file": row["file"], "block": row["block"], "quotes": len(found.quotes), "outside": deep[0], "inside": deep[1]}])
    return run


def _keys(block: int):
    """The envelope's keys: all of depth 1 and 2 outside lists, and of depth 3 those that name a table's list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, file in _each(batches):
            lo = row["block"] * block
            found = file.structure(lo, lo + block)
            places = found.outside(row["in_string"])
            depth = row["depth"] + np.cumsum(found.steps(places))
            rows = []
            for place, level in zip(places.tolist(), depth.tolist(), strict=True):
                if found.bytes[place] == COLON and level <= 3:
                    key = file.key_before(lo + place)
                    if level == 3 and key not in LISTS.values():
                        continue
                    at, opener = file.first_after(lo + place + 1)
                    rows.append({"file": row["file"], "depth": level, "key": key, "at": at, "opener": opener, "empty": file.first_after(at + 1)[1] in "]}"})
            if rows:
                yield pa.RecordBatch.from_pylist(rows)
    return run


def _elements(block: int):
    """(file, section, name, at, element) of the objects in the envelope's lists that begin in a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, file in _each(batches):
            lo = row["block"] * block
            found = file.structure(lo, lo + block)
            places = found.outside(row["in_string"])
            steps = found.steps(places)
            before = row["depth"] + np.cumsum(steps) - steps
            opens = found.bytes[places] == ord("{")
            keys = {level: [(k["at"], k["key"]) for k in row["keys"] if k["depth"] == level] for level in (1, 2, 3)}
            current = lambda level, at: next((k for place, k in reversed(keys[level]) if place < at), None)
            rows, size = [], 0
            for level in (2, 4):
                starts = places[opens & (before == level)]
                closes = places[(found.bytes[places] == ord("}")) & (before + steps == level)]
                ends = np.searchsorted(closes, starts)
                for place, end in zip(starts.tolist(), ends.tolist(), strict=True):
                    section = current(1, lo + place)
                    if level == 2 and section != "attachments" or level == 4 and (section not in LISTS or current(3, lo + place) != LISTS[section]):
                        continue
                    if end < len(closes):
                        body = found.bytes[place:closes[end] + 1].tobytes()
                    else:
                        body = file.element(lo + place, block)
                    rows.append((row["file"], section, current(2, lo + place) if level == 4 else None, lo + place, body.decode()))
                    size += len(body)
                    if size > BLOCK:
                        yield _rows(rows)
                        rows, size = [], 0
            if rows:
                yield _rows(rows)
    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)],
                                      ["file", "section", "name", "at", "element"])


def _one(condition: DataFrame, message: str) -> None:
    found = condition.first()
    if found is not None:
        raise ValueError(f"{message}: {', '.join(map(str, found))}")


class Export:
    """The export files at ``path`` (a file, a folder or a pattern), read in blocks.

    * ``elements``: (file, section, name, at, element) of every object in a list of the envelope, written once; ``section`` is tables, columns or attachments,
      ``name`` the table, ``at`` its place in the file.
    * ``table``: typed rows of one table; ``cells``: (table, row_id, column, value) of all tables, values as VARIANT;
      ``columns``: (table, column, type); ``attachments``: (file, id, path, bytes, metadata_id, file_size).

    A file with another envelope, one that is cut off, and one that reports attachment failures are refused when the export is opened. Rows need not be in
    any order, lists may be empty, and elements may be longer than a block.
    """

    def __init__(self, spark: SparkSession, path: str, block: int = BLOCK) -> None:
        listed = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")
        cut = listed.select("file", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"greatest(length - 1, 0) div {block}"))).alias("block"))
        # a row stands for megabytes of a file, which Spark cannot know when it sizes partitions
        blocks = listed.agg(F.sum(F.expr(f"greatest(length - 1, 0) div {block} + 1"))).first()[0] or 0
        tasks = max(spark.sparkContext.defaultParallelism, -(-blocks // TASK_BLOCKS))
        spread = lambda rows: rows.repartition(tasks, "file", "block").sortWithinPartitions("file", "block")
        # written, as cutting into slices samples its input first and would read all files twice
        states = pinned(spread(cut).mapInArrow(_states(block), "file string, block bigint, quotes bigint, outside bigint, inside bigint"))
        # rows are slim, one for each block; a file of any size is cut into slices of blocks
        state = F.col("before") % 2 == 1
        begun = prior(states, ["file"], "block", [{"before": ("sum", F.col("quotes"))}, {"depth": ("sum", F.when(state, F.col("inside")).otherwise(F.col("outside")))}], few_slices(spark, blocks))
        placed = pinned(begun.select("file", "block", "quotes", "outside", "inside", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("depth", F.lit(0)).alias("depth")))
        ends = placed.groupBy("file").agg(F.sum("quotes").alias("q"), F.sum(F.when(state, F.col("inside")).otherwise(F.col("outside"))).alias("d"))
        _one(ends.where("q % 2 = 1 or d <> 0").select("file"), "the export is cut off or malformed")
        known = placed.select("file", "block", state.alias("in_string"), "depth")
        found = pinned(spread(known).mapInArrow(_keys(block), "file string, depth bigint, key string, at bigint, opener string, empty boolean"))
        # a few keys for each table
        keys = found.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("at", "depth", "key", "opener", "empty"))).alias("keys"))
        top = F.filter("keys", lambda k: k["depth"] == 1)
        wanted = F.array(*[F.lit(f"{k}{v}") for k, v in sorted(ENVELOPE.items())])
        shape = F.array_sort(F.transform(top, lambda k: F.concat(k["key"], k["opener"])))
        _one(listed.join(keys, "file", "left").where(~shape.eqNullSafe(wanted)).select("file"), "unsupported export envelope")
        _one(keys.where(F.exists(top, lambda k: (k["key"] == "attachment_failures") & ~k["empty"])).select("file"), "export reports attachment failures")
        placed_keys = known.join(keys, "file").select("file", "block", "in_string", "depth", F.transform("keys", lambda k: F.struct(
            k["at"].alias("at"), k["depth"].alias("depth"), k["key"].alias("key"))).alias("keys"))
        self.elements = pinned(spread(placed_keys).mapInArrow(_elements(block), "file string, section string, name string, at bigint, element string"))
        self.spark = spark

    def table(self, name: str, fields: T.StructType) -> DataFrame:
        kind = T.StructType([T.StructField("id", T.LongType()), T.StructField("fields", fields)])
        own = (F.col("section") == "tables") & (F.col("name") == name)
        # conditions that Spark moves before the filter meet other elements too
        parsed = F.when(own, F.from_json("element", kind, {"mode": "FAILFAST"}))
        return self.elements.where(own).select(parsed.alias("r")).select(F.col("r.id").alias("row_id"), "r.fields.*")

    def cells(self) -> DataFrame:
        rows = self.elements.where("section = 'tables'").select(F.col("name").alias("table"), F.parse_json("element").alias("v"))
        rows = rows.select("table", F.variant_get("v", "$.id", "bigint").alias("row_id"), F.variant_get("v", "$.fields", "variant").alias("fields"))
        opened_up = rows.lateralJoin(self.spark.tvf.variant_explode(F.col("fields").outer()))
        return opened_up.select("table", "row_id", F.col("key").alias("column"), "value")

    def columns(self) -> DataFrame:
        rows = self.elements.where("section = 'columns'")
        return rows.select(F.col("name").alias("table"), F.get_json_object("element", "$.id").alias("column"), F.get_json_object("element", "$.fields.type").alias("type")).distinct()

    def attachments(self) -> DataFrame:
        kind = "id bigint, path string, bytes bigint, metadata struct<id: bigint, fields: struct<fileSize: bigint>>"
        own = F.col("section") == "attachments"
        return (self.elements.where(own).select("file", F.when(own, F.from_json("element", kind, {"mode": "FAILFAST"})).alias("a"))
                .select("file", "a.id", "a.path", "a.bytes", F.col("a.metadata.id").alias("metadata_id"), F.col("a.metadata.fields.fileSize").alias("file_size")))

    def attachment_verdicts(self, folder: str) -> DataFrame:
        """(id, path, bytes, verdict) of every attachment: ok, repeated id, other id in its metadata, missing, or another size than is said. Files are looked at by name."""
        rows = self.attachments()
        uses = rows.groupBy("id").agg(F.count(F.lit(1)).alias("uses"))
        sized = rows.select("path").distinct().select("path", F.lit(0).cast("bigint").alias("bytes"), F.lit("").alias("sha256"))
        found = tree.read_back(sized, folder).select(F.col("path").alias("_path"), "found_bytes")
        size = F.col("found_bytes")
        return (rows.join(uses, "id").join(found, F.col("path") == F.col("_path")).select("id", "path", "bytes", F.when(F.col("uses") > 1, "repeated id")
                .when(~F.col("metadata_id").eqNullSafe(F.col("id")), "other id").when(size.isNull(), "missing")
                .when(~(size.eqNullSafe(F.col("bytes")) & (F.col("file_size").isNull() | (size == F.col("file_size")))), "other size").otherwise("ok").alias("verdict")))


def typed_references(export: Export, required: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """(table, row_id, column, type, target, ref, problem) of every reference that the columns' metadata declares, in one pass over all cells.

    ``Ref:T`` holds an id of T, 0 and null refer to nothing. ``RefList:T`` and ``Attachments`` hold ``["L", id, ...]``, null and the empty string are an empty list.
    ``problem`` is null for a readable reference; other values are ``malformed``, text in an attachment cell is an ``anomaly``, and a target that
    is no table of the export is ``unsupported target``. ``required`` names (table, column, type) that are checked whether or not the metadata has them.
    """
    spark = export.spark
    declared = export.columns().where("type = 'Attachments' or type like 'Ref:%' or type like 'RefList:%'")
    if required:
        declared = declared.unionByName(spark.createDataFrame(list(required), "table string, column string, type string")).distinct()
    # few rows, one for each column of a table, and few columns: written, so that their size is known and cells are not shuffled by the names of columns
    kinds = pinned(declared.select(F.col("table").alias("_table"), F.col("column").alias("_column"), "type",
                                   F.when(F.col("type") == "Attachments", "@attachments").otherwise(F.substring_index("type", ":", -1)).alias("target")))
    cells = export.cells().join(kinds, (F.col("table") == F.col("_table")) & (F.col("column") == F.col("_column")))
    text = F.to_json("value")
    single, is_list = F.col("type").startswith("Ref:"), text.rlike(r'^\["L"(,[1-9][0-9]*)*\]$')
    nothing = text.isNull() | (text == "null") | F.when(single, text == "0").otherwise(text == '""')
    readable = F.when(single, text.rlike("^[1-9][0-9]*$")).otherwise(is_list)
    is_text = (F.col("type") == "Attachments") & text.startswith('"')
    tables = pinned(export.elements.where("section = 'tables'").select(F.col("name").alias("_target")).distinct())
    refs = F.when(readable, F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))).otherwise(F.array(F.lit(None).cast("string")))
    problem = F.when(is_text, "anomaly").when(~readable, "malformed").when((F.col("target") != "@attachments") & F.col("_target").isNull(), "unsupported target")
    return (cells.where(~F.coalesce(nothing, F.lit(True))).join(tables, F.col("target") == F.col("_target"), "left")
            .select("table", "row_id", "column", "type", "target", F.explode(F.transform(refs, lambda r: r.cast("bigint"))).alias("ref"), problem.alias("problem")))


def reference_problems(export: Export, required: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """(source_table, column_name, missing_key, problem, references): dangling, malformed and anomalous references. Equal references are counted before
    they meet the known ids."""
    found = typed_references(export, required)
    used = found.groupBy("table", "column", "target", "ref", "problem").agg(F.count(F.lit(1)).alias("references"))
    known = (export.elements.where("section = 'tables'").select(F.col("name").alias("target"), F.get_json_object("element", "$.id").cast("bigint").alias("ref"))
             .unionByName(export.attachments().select(F.lit("@attachments").alias("target"), F.col("id").alias("ref"))))
    dangling = used.where("problem is null").join(known, ["target", "ref"], "left_anti").withColumn("problem", F.lit("dangling"))
    rows = dangling.unionByName(used.where("problem is not null").select(*dangling.columns))
    return rows.select(F.col("table").alias("source_table"), F.col("column").alias("column_name"), F.col("ref").alias("missing_key"), "problem", "references")

