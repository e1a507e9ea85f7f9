"""Pages, frozen exports, managed manifests and the idempotent batch sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.scoring import category_ordinal
from ..functions.text import asset_key, strip
from ..operators.fingerprints import sha256_text
from .files import read_content_store


def json_text(value: Column) -> Column:
    """One value as JSON text."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def slug(candidate_id: Column) -> Column:
    """First 16 digits of the digest of the id as a JSON string, quotes included."""
    return F.substring(sha256_text(json_text(candidate_id)), 1, 16)


def page_path(day: Column, category: Column, rank: Column, candidate_id: Column) -> Column:
    number = F.when(rank < 10, F.concat(F.lit("0"), rank.cast("string"))).otherwise(rank.cast("string"))
    return F.concat(F.lit("docs/daily/"), F.date_format(day, "yyyy-MM-dd"), F.lit("/"), F.lower(category), F.lit("/"),
                    number, F.lit("-"), slug(candidate_id), F.lit(".md"))


def front_matter(**fields: Column) -> Column:
    """Ordered keys with JSON values between rules."""
    lines = [F.concat(F.lit(f"{key}: "), F.coalesce(json_text(value), F.lit("null"))) for key, value in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n\n"))


def render_pages(records: DataFrame) -> DataFrame:
    """(display_date, category, path, content, bytes) for records with candidate_id, display_date, category,
    group_rank, title and body. A projection: no shuffle."""
    header = front_matter(
        schemaVersion=F.lit(3), candidateId=F.col("candidate_id"), date=F.date_format("display_date", "yyyy-MM-dd"),
        category=F.col("category"), groupRank=F.col("group_rank"), title=F.col("title"))
    content = F.concat(header, strip(F.col("body")), F.lit("\n"))
    return (records.select("candidate_id", "display_date", "category",
                           page_path(F.col("display_date"), F.col("category"), F.col("group_rank"),
                                     F.col("candidate_id")).alias("path"), content.alias("content"))
            .withColumn("bytes", F.octet_length("content").cast("bigint")))


def preview_path(day: Column, candidate_id: Column, extension: Column) -> Column:
    """Where the preview image of a candidate is published; NULL without an extension or with an unsafe id."""
    return F.concat(F.lit("docs/public/daily/"), F.date_format(day, "yyyy-MM-dd"), F.lit("/assets/"), asset_key(candidate_id), F.lit("/preview."), extension)


def publication_documents(records: DataFrame) -> DataFrame:
    """(cycle_id, kind, path, content) of a publication: a page for each record, its preview image where it has one, and a manifest for each cycle.

    ``records`` has cycle_id (a date), candidate_id, category, group_rank, title, body, and preview (bytes) with its extension or NULL. A quota selection:
    a cycle has at most 20 records, so its manifest is put together in one row. No text is shuffled for it but paths and sizes.
    """
    day, image = F.col("cycle_id"), preview_path(F.col("cycle_id"), F.col("candidate_id"), F.col("extension"))
    has_image = F.col("preview").isNotNull() & image.isNotNull()
    header = front_matter(
        schemaVersion=F.lit(3), candidateId=F.col("candidate_id"), date=F.date_format(day, "yyyy-MM-dd"), category=F.col("category"), groupRank=F.col("group_rank"),
        title=F.col("title"), previewImage=F.when(has_image, F.concat(F.lit("/"), F.substring_index(image, "docs/public/", -1))))
    rows = records.select(
        "cycle_id", "candidate_id", "category", "group_rank", page_path(day, F.col("category"), F.col("group_rank"), F.col("candidate_id")).alias("path"),
        F.encode(F.concat(header, strip(F.col("body")), F.lit("\n")), "utf-8").alias("content"),
        F.when(has_image, image).alias("asset_path"), F.when(has_image, F.col("preview")).alias("asset"))
    pages = rows.select("cycle_id", F.lit("page").alias("kind"), "path", "content")
    media = rows.where("asset is not null").select("cycle_id", F.lit("media"), F.col("asset_path"), F.col("asset"))
    size = lambda c: F.octet_length(c).cast("bigint").alias("bytes")
    entry = F.struct(category_ordinal(F.col("category")).alias("o"), "group_rank", F.to_json(F.struct("candidate_id", "group_rank", "path", size("content"))).alias("line"))
    asset = F.when(F.col("asset").isNotNull(), F.struct(category_ordinal(F.col("category")).alias("o"), "group_rank", F.to_json(F.struct(
        "candidate_id", F.col("asset_path").alias("path"), size("asset"))).alias("line")))
    listed = lambda items: F.array_join(F.transform(items, lambda e: e["line"]), ",")
    of = lambda o: lambda e: e["o"] == o
    grouped = rows.groupBy("cycle_id").agg(F.array_sort(F.collect_list(entry)).alias("_entries"), F.array_sort(F.collect_list(asset)).alias("_assets"))
    groups = F.concat_ws(",", *[F.concat(F.lit(f'"{name}":['), listed(F.filter("_entries", of(o))), F.lit("]")) for o, name in enumerate(rules.CATEGORIES, 1)])
    text = F.concat(F.lit('{"cycle_id":"'), F.date_format(day, "yyyy-MM-dd"), F.lit('","groups":{'), groups, F.lit('},"assets":['), listed(F.col("_assets")), F.lit("]}\n"))
    manifests = grouped.select("cycle_id", F.lit("manifest"), F.concat(F.lit("docs/daily/"), F.date_format(day, "yyyy-MM-dd"), F.lit("/.managed-manifest.json")), F.encode(text, "utf-8"))
    return pages.union(media).union(manifests)


def write_pages(pages: DataFrame, folder: str) -> None:
    """Pages as rows of Parquet partitioned like their paths; a publisher turns rows into files."""
    pages.write.mode("append").partitionBy("display_date", "category").parquet(folder)


def freeze(selection: DataFrame, cycle: str = "cycle_id") -> DataFrame:
    """One canonical envelope and digest per cycle. A cycle holds at most the 20 records its quota admits."""
    record = F.struct(category_ordinal(F.col("category")).alias("o"), F.col("group_rank").alias("r"),
                      F.to_json(F.struct("candidate_id", "category", "group_rank", "score")).alias("j"))
    ordered = F.transform(F.array_sort(F.collect_list(record)), lambda r: r["j"])
    envelope = F.concat(F.lit('{"cycle_id":"'), F.col(cycle).cast("string"), F.lit('","records":['),
                        F.array_join("_records", ","), F.lit("]}"))
    return (selection.groupBy(cycle).agg(F.count(F.lit(1)).alias("records"), ordered.alias("_records"))
            .select(cycle, "records", envelope.alias("envelope"))
            .withColumn("frozen_sha256", sha256_text(F.col("envelope"))))


def verify_frozen(exports: DataFrame, stored: DataFrame, cycle: str = "cycle_id") -> DataFrame:
    """ok / changed / missing per stored digest."""
    now = exports.select(cycle, sha256_text(F.col("envelope")).alias("_now"))
    return stored.join(now, cycle, "left").withColumn(
        "verdict", F.when(F.col("_now").isNull(), "missing").when(F.col("_now") == F.col("frozen_sha256"), "ok")
        .otherwise("changed")).drop("_now")


def managed_manifest(pages: DataFrame) -> DataFrame:
    """One manifest text per cycle: categories in order, and path, rank and bytes of their pages. ``pages`` is a quota
    selection, so a category lists at most ten pages."""
    entry = F.struct(F.col("group_rank"), F.concat_ws(":", F.col("group_rank").cast("string"), "path",
                                                      F.col("bytes").cast("string")).alias("line"))
    groups = pages.groupBy("cycle_id", "category").agg(F.concat(
        F.col("category"), F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["line"]), " "),
        F.lit("]")).alias("_group"), F.sum("bytes").alias("_bytes"))
    ordered = F.array_sort(F.collect_list(F.struct(category_ordinal(F.col("category")).alias("o"), "_group")))
    return groups.groupBy("cycle_id").agg(
        F.array_join(F.transform(ordered, lambda g: g["_group"]), " ").alias("manifest"), F.sum("_bytes").alias("bytes"))


def new_operations(batch: DataFrame, ledger: DataFrame | None, keys: list[str], order: str) -> DataFrame:
    """First row of every operation id the ledger does not hold yet: what an idempotent sink may append."""
    others = [c for c in batch.columns if c not in keys]
    payload = F.struct(F.col(order).alias("_order"), *[F.col(c) for c in others])
    fresh = batch.groupBy(*keys).agg(F.min(payload).alias("_p")).select(*keys, *[F.col(f"_p.{c}") for c in others])
    fresh = fresh.select(*batch.columns)
    return fresh if ledger is None else fresh.join(ledger.select(*keys), keys, "left_anti")


def ledger_sink(folder: str, keys: list[str], order: str):
    """A ``foreachBatch`` writer: replayed batches and repeated operations append nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        new_operations(batch, read_content_store(batch.sparkSession, folder), keys, order).write.mode("append").parquet(folder)
    return write
