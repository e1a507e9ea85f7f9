"""Closed-world checks of JSON payloads, as VARIANT expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .binding import bound
from .text import relative_name_ok


# A checked value is a struct (kind, text, value), so its type and text are worked out once.


def _checked(value: Column) -> Column:
    return F.struct(F.schema_of_variant(value).alias("kind"), F.try_variant_get(value, "$", "string").alias("text"),
                    value.alias("value"))


def _is_int(c: Column) -> Column:
    return (c["kind"] == "BIGINT") | c["kind"].rlike(r"^DECIMAL\(\d+,0\)$")


def _is_number(c: Column) -> Column:
    return c["kind"].isin("BIGINT", "DOUBLE", "FLOAT") | c["kind"].startswith("DECIMAL")


def _is_line(c: Column, maximum: int) -> Column:
    """A string of bounded length without a newline."""
    return (c["kind"] == "STRING") & (F.length(c["text"]) <= maximum) & ~c["text"].contains("\n")


def _items(c: Column) -> Column:
    return F.transform(F.try_variant_get(c["value"], "$", "array<variant>"), _checked)


def _entries(c: Column) -> Column:
    """Members of an object as (key, v) with v checked; NULL for anything else."""
    return F.transform(F.map_entries(F.try_variant_get(c["value"], "$", "map<string,variant>")),
                       lambda e: F.struct(e["key"].alias("key"), _checked(e["value"]).alias("v")))


def _array(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _up_to(items: Column, size: int, check) -> Column:
    return F.coalesce(bound(items, lambda i: (F.size(i) <= size) & F.forall(i, check)), F.lit(False))


def _object(payload: Column, rule) -> Column:
    """Apply ``rule(members, bytes)`` to the top-level object; anything else is 'not_object'."""
    def judge(parsed: Column) -> Column:
        members = _entries(F.struct(parsed.alias("value")))
        return bound(F.struct(members.alias("members"), F.octet_length(F.to_json(parsed)).alias("size")),
                     lambda o: F.when(o["members"].isNull(), "not_object").otherwise(rule(o["members"], o["size"])))

    return bound(F.try_parse_json(payload), judge)


def control_metadata_reason(payload: Column) -> Column:
    """First broken bound of a control-metadata object, NULL when it is within them."""
    def mapping(item: Column, check) -> Column:
        return _up_to(_entries(item), 64, lambda e: (F.length(e["key"]) <= 128) & check(e["v"]))

    def path(c: Column) -> Column:
        return _is_line(c, 1024) & relative_name_ok(c["text"])

    def count(c: Column) -> Column:
        return _is_int(c) & ~c["text"].startswith("-")

    def checksum(c: Column) -> Column:
        return (c["kind"] == "STRING") & c["text"].rlike(r"\A[0-9a-f]{64}\z")

    def scalar(c: Column) -> Column:
        return c["kind"].isin("VOID", "BOOLEAN") | _is_int(c) | _is_line(c, 256)

    def fits(m: Column) -> Column:
        return (F.when(m["key"] == "paths", _up_to(_items(m["v"]), 64, path))
                .when(m["key"] == "counts", mapping(m["v"], count))
                .when(m["key"] == "checksums", mapping(m["v"], checksum))
                .when(m["key"] == "identity", mapping(m["v"], scalar))
                .otherwise(_is_line(m["v"], 300)))

    def rule(members: Column, size: Column) -> Column:
        wrong = F.filter(members, lambda m: ~F.coalesce(fits(m), F.lit(False)))
        return (F.when(F.exists(members, lambda m: ~m["key"].isin(*rules.CONTROL_KEYS)), "keys")
                .when(size > rules.CONTROL_BYTES, "bytes")
                .otherwise(F.get(F.array_sort(F.transform(wrong, lambda m: m["key"])), F.lit(0))))

    return _object(payload, rule)


def event_reason(payload: Column) -> Column:
    """First broken bound of a source event: whitelist, 4 KiB, lists of at most 32 short lines."""
    def fits(m: Column) -> Column:
        return F.when(m["key"].isin(*rules.EVENT_LISTS), _up_to(_items(m["v"]), 32, lambda i: _is_line(i, 128))).otherwise(
            (m["v"]["kind"] == "VOID") | _is_line(m["v"], 2048))

    def rule(members: Column, size: Column) -> Column:
        return (F.when(F.exists(members, lambda m: ~m["key"].isin(*rules.EVENT_FIELDS)), "fields")
                .when(size > rules.EVENT_BYTES, "bytes")
                .when(~F.coalesce(F.forall(members, fits), F.lit(False)), "values"))

    return _object(payload, rule)


def cursor_reason(payload: Column) -> Column:
    """First broken bound of a source cursor: few scalar members, no document-like keys."""
    def fits(m: Column) -> Column:
        return m["v"]["kind"].isin("VOID", "BOOLEAN") | _is_number(m["v"]) | _is_line(m["v"], 256)

    def rule(members: Column, size: Column) -> Column:
        return (F.when((F.size(members) > 64) | (size > rules.CURSOR_BYTES), "bytes")
                .when(F.exists(members, lambda m: (F.length(m["key"]) > 128)
                               | F.lower(m["key"]).isin(*rules.CURSOR_FORBIDDEN)), "keys")
                .when(~F.coalesce(F.forall(members, fits), F.lit(False)), "values"))

    return _object(payload, rule)


def has_exact_fields(payload: Column, *fields: str) -> Column:
    keys = F.array_sort(F.json_object_keys(payload))
    return F.coalesce(keys == _array(*sorted(fields)), F.lit(False))


REFERENCES = r'^\s*\[\s*"L"\s*((?:,\s*[1-9][0-9]*\s*)*)\]\s*$'


def reference_list(value: Column) -> Column:
    """Struct (refs, malformed): ``["L", 1, 2]`` gives [1, 2], NULL and "" give [], the rest is malformed.

    The whole shape, with positive integers only, is one pattern over the JSON text, so no value is parsed as JSON.
    """
    empty = value.isNull() | value.isin("", '""', "null")
    refs = F.transform(F.regexp_extract_all(value, F.lit("[0-9]+"), 0), lambda r: r.try_cast("bigint"))
    # ids are 64-bit integers, so a longer number is malformed
    ok = empty | (value.rlike(REFERENCES) & ~(value.rlike("[0-9]{19}") & F.exists(refs, lambda r: r.isNull())))
    return F.struct(F.when(empty, F.array().cast("array<bigint>")).when(ok, refs).alias("refs"), (~ok).alias("malformed"))


def is_text_anomaly(cell: Column) -> Column:
    """A nonempty string where a reference list belongs; ``cell`` is JSON text."""
    return F.coalesce(cell.rlike(r'(?s)^\s*".+"\s*$') & F.try_parse_json(cell).isNotNull(), F.lit(False))
