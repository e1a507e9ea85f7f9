"""Identity URLs and preprint ids of source records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules


def identity_urls(content: Column) -> Column:
    """Ordered distinct URLs of a record: JSON lists, then JSON scalars; a regex over the text only if JSON gave none."""
    parsed = F.try_parse_json(content)

    def strings(name: str) -> Column:
        items = F.try_variant_get(parsed, f"$.{name}", "array<variant>")
        texts = F.transform(F.filter(items, lambda v: F.schema_of_variant(v) == "STRING"),
                            lambda v: F.try_variant_get(v, "$", "string"))
        return F.coalesce(F.filter(texts, lambda t: t != ""), F.array().cast("array<string>"))

    def scalar(name: str) -> Column:
        value = F.try_variant_get(parsed, f"$.{name}", "variant")
        text = F.try_variant_get(value, "$", "string")
        return F.when((F.schema_of_variant(value) == "STRING") & (text != ""), text)

    urls = F.concat(strings("source_identities"), strings("source_urls"),
                    F.array_compact(F.array(*[scalar(n) for n in ("canonical_url", "url", "source_url")])))
    fallback = F.coalesce(F.regexp_extract_all(content, F.lit(rules.TEXT_URL), 0), F.array().cast("array<string>"))
    return F.array_distinct(F.when(F.size(urls) > 0, urls).otherwise(fallback))


def preprint_id(urls: Column, candidate_id: Column) -> Column:
    """First preprint id in the URLs, then in the candidate id; the version is dropped."""
    searched = F.concat(urls, F.array(F.coalesce(candidate_id, F.lit(""))))
    return F.get(F.filter(F.transform(searched, lambda u: F.regexp_extract(u, rules.PREPRINT, 1)), lambda m: m != ""), F.lit(0))


def category_recall(categories: Column, subjects: tuple[str, ...]) -> Column:
    return F.coalesce(F.arrays_overlap(categories, F.array(*[F.lit(s) for s in subjects])), F.lit(False))
