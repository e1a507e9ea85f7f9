"""Scans over page and text corpora: scopes, links, contracts, private data, bounded samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import urls
from ..functions.binding import bound
from ..functions.text import WHITESPACE, private_finding

LINK = r"""\b(?:href|src)="([^"]+)\""""
NOT_FETCHED = r"(?i)^(?:mailto|tel|data|javascript):"


def local_links(pages: DataFrame, page: str, url: str, html: str, base_path: str = "/") -> DataFrame:
    """Distinct same-origin link targets per page, with a flag for targets outside ``base_path``."""
    raw = pages.select(page, url, F.explode(F.array_distinct(F.regexp_extract_all(html, F.lit(LINK), 1))).alias("_raw"))
    fetched = (raw.withColumn("_raw", F.replace("_raw", F.lit("&amp;"), F.lit("&")))
               .where(~F.col("_raw").startswith("#") & ~F.col("_raw").rlike(NOT_FETCHED)))
    target = urls.resolve(F.col(url), F.col("_raw"))
    return (fetched.select(page, url, target.alias("target"))
            .where(urls.origin(F.col("target")) == urls.origin(F.col(url)))
            .select(page, "target", (~urls.path(F.col("target")).startswith(base_path)).alias("escapes_base"))
            .distinct())


def broken_links(links: DataFrame, known: DataFrame) -> DataFrame:
    """Links whose path is no known page (``known`` has a column path).

    Known paths are reduced to distinct ones before they are shuffled; a path linked from every page is skewed on the link
    side only, which the adaptive join splits.
    """
    located = links.withColumn("path", urls.path(F.col("target")))
    return located.join(known.select("path").distinct(), "path", "left_anti")


def page_contract(expected: Column, ordered: Column, body: Column, escape) -> tuple[Column, Column]:
    """(all expected strings present raw or escaped, ordered strings at strictly increasing positions)."""
    present = F.forall(expected, lambda value: body.contains(value) | body.contains(escape(value)))
    places = F.transform(ordered, lambda value: F.position(value, body))
    rising = bound(places, lambda p: F.aggregate(
        p, F.struct(F.lit(True).alias("ok"), F.lit(0).alias("at")),
        lambda acc, at: F.struct((acc["ok"] & (at > acc["at"])).alias("ok"), at.alias("at")))["ok"])
    return present, rising


def published_name(path: Column) -> Column:
    """Published file of a source path, NULL when it publishes nothing."""
    return (F.when(path.startswith("docs/public/"), F.regexp_replace(path, "^docs/public/", ""))
            .when(path.startswith("docs/daily/") & path.endswith(".md"),
                  F.regexp_replace(F.regexp_replace(path, "^docs/", ""), r"\.md$", ".html"))
            .when(path == "docs/index.md", "index.html"))


def bounded_sample(changed: DataFrame, receipts: DataFrame, release: str) -> DataFrame:
    """Names to verify per release: changed ones and the index that have a receipt, and the first 16 others by name.

    ``changed`` has (release, path), ``receipts`` has (release, name). Sixteen is the feature; the literal limit keeps
    sixteen rows per release on the map side.
    """
    names = (changed.select(release, published_name(F.col("path")).alias("name"))
             .where(F.col("name").isNotNull())
             .unionByName(receipts.select(release).distinct().withColumn("name", F.lit("index.html"))).distinct())
    must = receipts.select(release, "name").distinct().join(names, [release, "name"], "left_semi")
    others = receipts.select(release, "name").distinct().join(names, [release, "name"], "left_anti")
    sampled = (others.withColumn("_n", F.row_number().over(Window.partitionBy(release).orderBy("name")))
               .where(F.col("_n") <= rules.SAMPLED_ARTIFACTS).drop("_n"))
    return (must.withColumn("reason", F.lit("changed"))
            .unionByName(sampled.withColumn("reason", F.lit("sampled"))))


#: bytes at the start of a value that are looked for in texts, and slots of the filter over them (4 MB, whatever the values)
ANCHOR_BYTES, SLOTS = 6, 4194301


def _anchors(text: str, sizes: list[int], flags: np.ndarray, longest: int):
    """(key, anchor, tail) wherever a text has bytes that may start a value; the tail is as long as the longest value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, anchors, tails = [], [], []
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                body = (content or "").encode()
                data = np.frombuffer(body, np.uint8).astype(np.int64)
                for size in sizes:
                    if len(body) < size:
                        continue
                    number = np.zeros(len(body) - size + 1, np.int64)
                    for k in range(size):
                        number = number << 8 | data[k:len(body) - size + 1 + k]
                    for at in np.flatnonzero(flags[number % SLOTS]).tolist():
                        keys.append(key)
                        anchors.append(body[at:at + size].hex().upper())
                        tails.append(body[at:at + longest])
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(anchors, pa.string()), pa.array(tails, pa.binary())],
                                             ["_key", "_anchor", "_tail"])
    return run


def value_hits(df: DataFrame, key: str, text: str, values: DataFrame) -> DataFrame:
    """The distinct keys of the rows whose whole text contains one of ``values`` (column ``value``), whatever their number.

    Every value has an anchor, its first bytes. Texts give the places whose bytes may be an anchor, by a filter of fixed size; these meet the
    values in an equi-join on the anchor and the whole value is compared. NULL and empty values and NULL texts never match.
    """
    body = F.encode("value", "utf-8")
    table = (values.where(F.length("value") > 0).select(body.alias("_value")).distinct()
             .withColumn("_anchor", F.hex(F.substring("_value", 1, ANCHOR_BYTES))))
    slot = F.conv("_anchor", 16, 10).cast("bigint") % SLOTS
    # at most one row for each slot and anchor length
    found = table.select(slot.alias("slot"), (F.length("_anchor") / 2).cast("int").alias("size")).distinct().toPandas()
    longest = table.agg(F.max(F.octet_length("_value"))).first()[0] or 0
    flags = np.zeros(SLOTS, bool)
    flags[found["slot"].to_numpy(dtype=np.int64)] = True
    kind = df.schema[key].dataType.simpleString()
    places = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).mapInArrow(
        _anchors("_text", sorted(set(found["size"].tolist())), flags, longest), f"_key {kind}, _anchor string, _tail binary")
    return (places.join(table, "_anchor").where(F.expr("startswith(_tail, _value)")).select(F.col("_key").alias(key)).distinct())


def private_scan(df: DataFrame, key: str, text: str, values: DataFrame) -> DataFrame:
    """(key, finding) of the rows with private data: a configured value first, then the kinds of ``private_finding``."""
    hits = value_hits(df, key, text, values).withColumn("_value", F.lit("private configuration value"))
    kinds = df.select(key, private_finding(F.col(text)).alias("_kind")).where(F.col("_kind").isNotNull())
    return kinds.join(hits, key, "full_outer").select(key, F.coalesce("_value", "_kind").alias("finding"))


def joined_texts(parts: DataFrame, keys: list[str], order: str, part: str, most_chars: int) -> DataFrame:
    """(keys, parts, content): one joined text per key; content is NULL for texts longer than ``most_chars``.

    Lengths are summed first, so only texts within the length that the contract allows are assembled; a longer one is refused by its
    length alone. Line breaks between parts count, which bounds the number of parts too; white space at the end does not.
    """
    size = F.coalesce(F.length(part), F.lit(0))
    length = F.sum(size + 1) - 1 - F.max_by(size - F.coalesce(F.length(F.rtrim(part, F.lit(WHITESPACE))), F.lit(0)), order)
    sizes = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("parts"), length.alias("_chars"))
    kept = parts.join(sizes.where(F.col("_chars") <= most_chars), keys, "left_semi")
    joined = kept.groupBy(*keys).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(order, part))), lambda p: p[part]), "\n").alias("content"))
    return sizes.drop("_chars").join(joined, keys, "left")
