"""Text predicates, escapes, names and scans. Whole texts, never prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .binding import bound

# fixed values: Unicode whitespace
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
              "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def hygiene_reason(text: Column, maximum: int = 1000) -> Column:
    """First broken rule of a published text, NULL when clean."""
    size = F.length(strip(text))
    return (F.when(text.isNull() | (size == 0) | (size > maximum), "length")
            .when(text.rlike(r"[\x00-\x08\x0b-\x1f]"), "control")
            .when(text.rlike(rules.PRIVATE_MARKERS), "marker"))


def candidate_id_ok(text: Column) -> Column:
    return F.coalesce((F.length(text) <= rules.CANDIDATE_ID_CHARS) & text.rlike(rules.CANDIDATE_ID), F.lit(False))


def asset_key(text: Column) -> Column:
    """``%HH`` becomes ``_hh``; NULL for an unsafe id."""
    parts = F.split(text, "%")
    key = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(
        F.concat(F.lower(F.substring(p, 1, 2)), F.substr(p, F.lit(3))))), "_")
    return F.when(candidate_id_ok(text), key)


def relative_name_ok(text: Column) -> Column:
    return F.coalesce((text != "") & ~text.contains("\\") & F.forall(
        F.split(text, "/"), lambda s: ~s.isin("", ".", "..")), F.lit(False))


def clean_url(path: Column) -> Column:
    """``docs/x.md`` -> ``/x``; NULL for any other path."""
    inner = F.regexp_extract(path, r"(?s)\Adocs/(.*)\.md\z", 1)
    return F.when(path.startswith("docs/") & path.endswith(".md") & (F.length(path) >= 8),
                  F.concat(F.lit("/"), inner))


def html_escape(text: Column) -> Column:
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def private_finding(text: Column) -> Column:
    """First kind of private data in a whole text, NULL when there is none. Configured values: ``operators.corpus.private_scan``."""
    return (F.when(text.rlike(rules.HOME_PATH), "absolute personal home path")
            .when(text.rlike(rules.AUTHORIZATION), "credential material")
            .when(text.rlike(rules.PRIVATE_KEY), "private key material"))


def in_publishable_scope(path: Column) -> Column:
    """Relative path outside the excluded folders and files, with a text suffix or a known name."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    suffix = F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))
    excluded = F.arrays_overlap(parts, F.array(*[F.lit(f) for f in rules.EXCLUDED_FOLDERS]))
    return (~excluded & ~name.isin(*rules.EXCLUDED_FILES)
            & (suffix.isin(*rules.TEXT_SUFFIXES) | name.isin(*rules.ALWAYS_TEXT_FILES)))


def topic_groups(text: Column, category_hit: Column) -> Column:
    """Groups recalled by a text. An acronym alone counts only with a second term or a subject category."""
    every = sorted({t.lower() for terms in rules.TOPIC_TERMS.values() for t in terms})
    latin = [t for t in every if t.isascii()]
    literals = lambda terms: F.array(*[F.lit(t) for t in terms])
    found_in = lambda low, terms: F.filter(literals(terms), lambda term: low.contains(term))
    # one look for any CJK character spares the aliases in other texts
    hits = bound(F.lower(text), lambda low: F.when(
        low.rlike("[\\x{4e00}-\\x{9fff}]"), found_in(low, every)).otherwise(found_in(low, latin)))

    def groups(found: Column) -> Column:
        recalled = []
        for group, terms in rules.TOPIC_TERMS.items():
            hit = F.arrays_overlap(found, literals([t.lower() for t in terms if t not in rules.ACRONYMS]))
            short = [t.lower() for t in terms if t in rules.ACRONYMS]
            if short:
                hit = hit | (F.arrays_overlap(found, literals(short)) & (category_hit | (F.size(found) >= 2)))
            recalled.append(F.when(hit, F.lit(group)))
        return F.array_compact(F.array(*recalled))

    return bound(hits, groups)


# --- Markdown section contract -----------------------------------------------------------------
FENCE = r"(?ms)^ {0,3}(`{3,}|~{3,})[^\n]*\n.*?(?:^ {0,3}\1[`~]*[ \t]*$|\z)"
ATX = r"(?m)^ {0,3}(#{1,6})(?:[ \t]+[^\n]*)?$"
LEVEL_TWO = r"(?m)^ {0,3}##(?:[ \t]+([^\n]*?))?(?:[ \t]+#+)?[ \t]*$"
SETEXT = r"(?m)^ {0,3}[^\s#>][^\n]*\n {0,3}(?:=+|-{2,})[ \t]*$"


def section_reason(content: Column, category: Column, sections: dict[str, list[str]] | None = None) -> Column:
    """First broken rule of a Markdown body, NULL when it follows its category's sections.

    Line based: fenced code is taken out first, ATX headings and inline or reference links are read, and underlined
    headings are refused. This approximates CommonMark.
    """
    from .urls import public_url_reason
    sections = sections or rules.SECTIONS
    plain = F.regexp_replace(content, FENCE, "code")
    levels = F.regexp_extract_all(plain, F.lit(ATX), 1)
    titles = F.transform(F.regexp_extract_all(plain, F.lit(LEVEL_TWO), 1), lambda t: F.trim(t))
    wanted = F.lit(None).cast("array<string>")
    for name, headings in sections.items():
        wanted = F.when(category == name, F.array(*[F.lit(h) for h in headings])).otherwise(wanted)
    parts = F.split(plain, LEVEL_TWO)
    bodies = F.slice(parts, F.lit(2), F.size(parts))
    empty = F.exists(bodies, lambda b: F.length(strip(F.regexp_replace(b, ATX, ""))) == 0)
    links = F.concat(
        F.regexp_extract_all(plain, F.lit(r"\]\(\s*([^)\s]*)"), 1),
        F.regexp_extract_all(plain, F.lit(r"(?m)^ {0,3}\[[^\]]+\]:[ \t]*(\S+)"), 1))
    return (F.when(hygiene_reason(content, rules.SECTION_CHARS).isNotNull(), "text")
            .when(content.contains("<") | content.contains("{{")
                  | content.rlike(r"(?m)^\s*(---|:::|@import)\s*$"), "directive")
            .when(F.exists(levels, lambda m: ~F.length(m).isin(2, 3, 4)) | plain.rlike(SETEXT), "heading_level")
            .when(plain.rlike(r"!\["), "image")
            .when(F.exists(links, lambda u: public_url_reason(u).isNotNull()), "link")
            .when(~titles.eqNullSafe(wanted), "sections")
            .when(empty, "empty_section"))
