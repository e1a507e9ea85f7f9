"""Digests of records and trees, change detection, manifests and readback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sha256_text(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def record_digest(**fields: Column) -> Column:
    """SHA-256 of the record as JSON with sorted keys; render floats to text before, NULLs stay in."""
    struct = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return sha256_text(F.to_json(struct, {"ignoreNullFields": "false"}))


#: hex digits of a path's hash that name its leaf, and of those the ones that name the node above
LEAF_DIGITS, NODE_DIGITS = 6, 3


def tree_fingerprints(files: DataFrame, group: str, path: str, sha256: str, size: str) -> DataFrame:
    """Fingerprint, file count and bytes per group: one definition for every size.

    The path's SHA-256 puts a file into one of 4,096 nodes of 4,096 leaves. A leaf is the SHA-256 over ``len:name`` and the raw file
    hash of its files, ordered by path components; a node is that over its leaves' names and digests in order, and the group that over its
    nodes'. So no task gathers more than 4,096 digests or one leaf, a 16-millionth of the group.
    """
    entry = F.concat(F.hex(F.concat(F.octet_length(path).cast("string"), F.lit(":"), F.col(path)).cast("binary")), F.upper(F.col(sha256)))
    cut = files.select(group, F.substring(sha256_text(F.col(path)), 1, LEAF_DIGITS).alias("_leaf"), F.split(path, "/").alias("_parts"),
                       entry.alias("_entry"), F.col(size).alias("_size"))

    def digest(items: Column, field: str) -> Column:
        return F.sha2(F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(items)), lambda i: i[field]), "")), 256)

    def above(level: DataFrame, by: list[str | Column]) -> DataFrame:
        return level.groupBy(*by).agg(digest(F.struct("_leaf", F.concat(F.hex("_leaf"), "_digest").alias("_named")), "_named").alias("_digest"),
                                      F.sum("files").alias("files"), F.sum("bytes").cast("bigint").alias("bytes"))

    leaves = cut.groupBy(group, "_leaf").agg(digest(F.struct("_parts", "_entry"), "_entry").alias("_digest"),
                                             F.count(F.lit(1)).alias("files"), F.sum("_size").cast("bigint").alias("bytes"))
    nodes = above(leaves, [group, F.substring("_leaf", 1, NODE_DIGITS).alias("_node")]).withColumnRenamed("_node", "_leaf")
    return above(nodes, [group]).select(group, "files", "bytes", F.col("_digest").alias("fingerprint"))


def detect_changes(current: DataFrame, last_runs: DataFrame, key: str) -> DataFrame:
    """reuse / run / conflict / gone per key from the current fingerprint and the last run (key, fingerprint, status)."""
    last = last_runs.select(key, F.col("fingerprint").alias("last_fingerprint"), "status")
    complete = F.coalesce(F.col("status") == "complete", F.lit(False))
    same = F.col("fingerprint").eqNullSafe(F.col("last_fingerprint"))
    return (current.select(key, "fingerprint").join(last, key, "full_outer")
            .select(key, F.when(F.col("fingerprint").isNull(), "gone").when(complete & same, "reuse")
                    .when(complete, "conflict").otherwise("run").alias("decision")))


def plan_files(before: DataFrame, after: DataFrame, owned: Column) -> DataFrame:
    """add / modify / same / unowned / collision per path; both sides have path and sha256.

    ``owned`` is a predicate over the path: a change to an existing unowned path is a collision.
    """
    old, new = before.select("path", F.col("sha256").alias("before")), after.select("path", F.col("sha256").alias("after"))
    action = (F.when(F.col("after").isNull(), "unowned").when(F.col("before").isNull(), "add")
              .when(F.col("before") == F.col("after"), "same").when(owned, "modify").otherwise("collision"))
    return old.join(new, "path", "full_outer").withColumn("action", action)


def read_back(receipts: DataFrame, observed: DataFrame, key: str = "path") -> DataFrame:
    """ok / missing / changed for every receipt; both sides have the key, sha256 and size."""
    seen = observed.select(key, F.col("sha256").alias("_sha"), F.col("size").alias("_size"))
    return (receipts.join(seen, key, "left")
            .withColumn("readback", F.when(F.col("_sha").isNull(), "missing")
                        .when((F.col("_sha") != F.col("sha256")) | (F.col("_size") != F.col("size")), "changed")
                        .otherwise("ok")).drop("_sha", "_size"))


ASSET_NAME = r"^assets/[0-9a-f]{2}/[0-9a-f]{64}$"


def verify_manifest(manifest: DataFrame, observed: DataFrame, control_names: tuple[str, ...] = ()) -> DataFrame:
    """Restore-side check in both directions: every manifest file is present and equal, no name is unexpected."""
    seen = observed.select("path", F.col("sha256").alias("seen_sha256"), F.col("size").alias("seen_size"))
    named = F.col("path").rlike(ASSET_NAME) | F.col("path").isin(*control_names)
    verdict = (F.when(~named, "unexpected_name").when(F.col("sha256").isNull(), "not_in_manifest")
               .when(F.col("seen_sha256").isNull(), "missing")
               .when((F.col("sha256") != F.col("seen_sha256")) | (F.col("size") != F.col("seen_size")), "mismatch")
               .otherwise("ok"))
    return manifest.join(seen, "path", "full_outer").withColumn("verdict", verdict)


def content_addressed(df: DataFrame, content: str) -> DataFrame:
    """One row per distinct content with its store path; copies are reduced before the shuffle."""
    binary = F.col(content).cast("binary")
    return (df.select(F.sha2(binary, 256).alias("sha256"), F.length(binary).cast("bigint").alias("size"))
            .groupBy("sha256").agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("copies"))
            .withColumn("path", F.concat(F.lit("assets/"), F.substring("sha256", 1, 2), F.lit("/"), F.col("sha256"))))
