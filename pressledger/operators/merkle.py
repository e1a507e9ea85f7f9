"""Snapshots compared by descent: digests of the whole, of nodes, of leaves, and rows only of leaves that differ.

A row belongs to the leaf that the hash of its key names. An ordered relation takes its position into the key, so neither a parent with very many rows nor
a frequent value makes a large leaf; equal rows are counted before they meet. Rows are stored by the first digits of their leaf, so the rows of few leaves
are read from few folders.

A leaf's digest is taken over its number of rows and the XOR of their 256-bit hashes, which tasks add up before anything is shuffled: rows that differ by accident are told apart,
rows that someone made so as to cancel out are not. Above the leaves digests are SHA-256 over the names and digests below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType, MapType, StructField, StructType

from .contracts import violations

#: hex digits of a key's hash that name its folder, its node and its leaf
PART, NODE, LEAF = 2, 3, 5

#: 64-bit words of a row's hash
WORDS = 4

#: nested values as text that differs where the values do, to the microsecond
EXACT = {"ignoreNullFields": "false", "dateFormat": "G yyyy-MM-dd", "timestampFormat": "G yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "G yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _hashed(field: StructField) -> Column:
    """What ``xxhash64`` takes in for a value: it passes over NULLs inside nested ones, and hashes 1 as int and as long differently."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (ArrayType, MapType, StructType)):
        return F.to_json(column, EXACT)
    return column.cast("long") if isinstance(field.dataType, IntegralType) else column


def _hex(number: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(number)), digits, "0")


def _above(level: DataFrame, digits: int) -> DataFrame:
    """Digests of the names that are ``digits`` long, over the names and digests below; at most 256 of them for each step of two digits."""
    entry = F.concat(F.col("name"), F.lit(":"), F.col("digest"))
    return level.groupBy(F.substring("name", 1, digits).alias("name")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(entry)), ","), 256).alias("digest"), F.sum("rows").alias("rows"))


class Snapshot:
    """Rows written below ``folder`` with the digests of their leaves and nodes. ``keys`` may repeat; NULL is a key and a value like others.

    ``write`` makes one, ``read`` opens one that was written. ``root`` is (digest, rows); equal roots mean equal rows, with repeats.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, keys: Sequence[str]) -> None:
        self.spark, self.folder, self.keys = spark, folder.rstrip("/"), list(keys)
        self.values = [f.name for f in schema.fields if f.name not in self.keys]
        self.schema = schema
        self.stored = StructType([*schema.fields]).add("_times", "long").add("_part", "string")

    @classmethod
    def write(cls, rows: DataFrame, folder: str, keys: Sequence[str]) -> Snapshot:
        own = cls(rows.sparkSession, folder, rows.schema, keys)
        # equal rows become one with their number, whatever their number
        counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_times"))
        part = _hex(F.shiftright(own.leaf(), 4 * (LEAF - PART)), PART)
        counted.withColumn("_part", part).select(*own.stored.names).repartition("_part").write.partitionBy("_part").parquet(f"{own.folder}/rows")
        own.leaves().write.parquet(f"{own.folder}/leaves")
        _above(own.level("leaves"), NODE).coalesce(1).write.parquet(f"{own.folder}/nodes")
        return own

    def leaf(self) -> Column:
        """The number of the leaf that a row's key names."""
        return F.pmod(F.xxhash64(*[_hashed(self.schema[k]) for k in self.keys]), F.lit(16 ** LEAF))

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.stored).parquet(f"{self.folder}/rows").withColumn("_leaf", self.leaf())

    def leaves(self) -> DataFrame:
        """(name, digest, rows) of every leaf, from the stored rows: of any number of rows, a task passes on one for each leaf."""
        line = [x for f in self.schema.fields for x in (F.col(f"`{f.name}`").isNull(), _hashed(f))]
        words = [F.bit_xor(F.xxhash64(F.lit(i), *line, "_times")).cast("string") for i in range(WORDS)]
        return self.rows().groupBy("_leaf").agg(F.sha2(F.concat_ws(",", *words, F.sum("_times").cast("string")), 256).alias("digest"), F.sum("_times").alias("rows")).select(
            _hex(F.col("_leaf"), LEAF).alias("name"), "digest", "rows")

    def level(self, name: str) -> DataFrame:
        return self.spark.read.schema("name string, digest string, rows bigint").parquet(f"{self.folder}/{name}")

    def root(self) -> tuple[str | None, int]:
        found = _above(_above(self.level("nodes"), 1), 0).first()
        return (None, 0) if found is None else (found["digest"], found["rows"])


def _unlike(before: DataFrame, after: DataFrame) -> DataFrame:
    """Names whose digests differ or that one side lacks."""
    old, new = before.select("name", F.col("digest").alias("_old")), after.select("name", F.col("digest").alias("_new"))
    return old.join(new, "name", "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new"))).select("name")


def differing_leaves(before: Snapshot, after: Snapshot) -> tuple[DataFrame, list[str]]:
    """Names of the leaves that differ, and of the folders they are in (at most 256). Leaves of equal nodes are not compared."""
    nodes = _unlike(before.level("nodes"), after.level("nodes"))
    # at most 4,096 names
    names = [r[0] for r in nodes.collect()]
    inside = F.substring("name", 1, NODE).isin(*names) if names else F.lit(False)
    leaves = _unlike(*(s.level("leaves").where(inside) for s in (before, after)))
    return leaves, sorted({n[:PART] for n in names})


def differences(before: Snapshot, after: Snapshot) -> DataFrame:
    """(keys, status, fields, gone, come) of every key whose rows differ: ``missing`` and ``extra`` rows, ``changed`` where one row took the place of one, with
    the fields that changed, ``repeats`` where only the numbers of equal rows differ, and ``mixed`` for the rest. ``gone`` and ``come`` count rows. Rows of equal leaves
    are not read."""
    keys, values = before.keys, before.values
    leaves, parts = differing_leaves(before, after)
    # at most 16 ** LEAF numbers, however many rows there are: they go to the rows, not the rows to them
    leaves = F.broadcast(leaves.select(F.conv("name", 16, 10).cast("long").alias("_leaf")))

    def side(snapshot: Snapshot, sign: int) -> DataFrame:
        rows = snapshot.rows().where(F.col("_part").isin(*parts) if parts else F.lit(False)).join(leaves, "_leaf", "left_semi")
        return rows.select(*[F.col(f"`{c}`") for c in keys], F.struct(*values).alias("_row") if values else F.lit(None).alias("_row"), (F.col("_times") * sign).alias("_times"))

    # old rows count down, new ones up: what is left is the difference
    net = side(before, -1).unionByName(side(after, 1)).groupBy(*keys, "_row").agg(F.sum("_times").alias("_net"), F.count(F.lit(1)).alias("_sides")).where("_net <> 0")
    old, new = F.col("_net") < 0, F.col("_net") > 0
    found = net.groupBy(*keys).agg(
        F.sum(F.when(old, -F.col("_net")).otherwise(0)).alias("gone"), F.sum(F.when(new, F.col("_net")).otherwise(0)).alias("come"),
        F.max(F.when(old, F.struct(F.col("_row").alias("r")))).alias("_old"), F.max(F.when(new, F.struct(F.col("_row").alias("r")))).alias("_new"), F.min("_sides").alias("_least"))
    changed = (F.col("gone") == 1) & (F.col("come") == 1) & (F.col("_least") == 1)
    status = (F.when(changed, "changed").when(F.col("_least") > 1, "repeats").when(F.col("come") == 0, "missing").when(F.col("gone") == 0, "extra").otherwise("mixed"))
    names = violations(**{f: ~F.col(f"_old.r.{f}").eqNullSafe(F.col(f"_new.r.{f}")) for f in values}) if values else F.lit("")
    return found.select(*keys, status.alias("status"), F.when(changed, names).otherwise("").alias("fields"), "gone", "come")
