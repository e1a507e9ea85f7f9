"""Publication contracts as set-based data quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules

PUBLIC_FIELDS = ("candidate_id", "category", "source", "lang", "path")


def public_projection(df: DataFrame) -> DataFrame:
    """Only the display fields; scores and labels never leave."""
    return df.select(*PUBLIC_FIELDS)


def violations(**checks: Column) -> Column:
    """Names of the failing checks, in the order given, as one text."""
    return F.array_join(F.array_compact(F.array(*[F.when(failed, F.lit(name)) for name, failed in checks.items()])), ",")


def blank(value: Column) -> Column:
    return value.isNull() | (F.length(F.trim(value)) == 0)


def record_violations(candidate_id: Column, title: Column, category: Column, identities: Column,
                      display_date: Column) -> Column:
    day = display_date.rlike(r"\A\d{4}-\d{2}-\d{2}\z") & display_date.try_cast("date").isNotNull()
    return violations(
        candidate_id=blank(candidate_id), title=blank(title),
        category=~F.coalesce(category.isin(*rules.CATEGORIES), F.lit(False)),
        identities=identities.isNull() | F.exists(identities, lambda s: s.isNull() | (s == "")),
        display_date=~F.coalesce(day, F.lit(False)))


def evidence_ok(evidence: Mapping[str, Column], frozen: Column) -> Column:
    flags = [evidence[name].eqNullSafe(F.lit(True)) for name in ("local_verified", "push_verified", "public_verified")]
    hashes = (evidence["commit_sha"].rlike(r"\A([0-9a-f]{40}|[0-9a-f]{64})\z")
              & evidence["artifact_sha256"].rlike(r"\A[0-9a-f]{64}\z"))
    return F.coalesce(reduce(lambda a, b: a & b, flags) & (evidence["frozen_sha256"] == frozen) & hashes, F.lit(False))


def image_violations(image_format: Column, width: Column, height: Column, size: Column, animated: Column,
                     extension: Column) -> Column:
    allowed = F.create_map(*[x for name, ext in rules.IMAGE_EXTENSIONS.items()
                             for x in (F.lit(name), F.array(*[F.lit(e) for e in ext]))])
    return violations(
        bytes=~F.coalesce((size > 0) & (size <= rules.IMAGE_BYTES), F.lit(False)),
        format=~F.coalesce(image_format.isin(*rules.IMAGE_EXTENSIONS), F.lit(False)),
        dimensions=~F.coalesce((F.least(width, height) >= 32) & (F.greatest(width, height) <= 16_000)
                               & (width.cast("bigint") * height <= 40_000_000), F.lit(False)),
        animated=F.coalesce(animated, F.lit(True)),
        extension=~F.coalesce(F.array_contains(F.try_element_at(allowed, image_format), F.lower(extension)), F.lit(False)))


@dataclass(frozen=True)
class Reference:
    """A typed column: ``kind`` is ``Ref:table`` or ``RefList:table``, ``target_key`` the referenced column."""
    table: str
    row: Column
    column: str
    value: Column
    kind: str
    target_key: str


def orphan_references(tables: Mapping[str, DataFrame], references: Sequence[Reference]) -> DataFrame:
    """Dangling references as (source_table, column_name, missing_key, references): zero and NULL refer to nothing.

    Reference values are counted per key first, so a key referenced by a third of all rows is one row in the join.
    """
    found = []
    for ref in references:
        mode, target = ref.kind.split(":", 1)
        values = F.explode(ref.value) if mode == "RefList" else ref.value
        used = (tables[ref.table].select(values.alias("_value"))
                .select(F.col("_value").cast("bigint").alias("missing_key"))
                .where(F.col("missing_key").isNotNull() & (F.col("missing_key") != 0))
                .groupBy("missing_key").agg(F.count(F.lit(1)).alias("references")))
        known = tables[target].select(F.col(ref.target_key).cast("bigint").alias("missing_key"))
        found.append(used.join(known, "missing_key", "left_anti").select(
            F.lit(ref.table).alias("source_table"), F.lit(ref.column).alias("column_name"), "missing_key", "references"))
    return reduce(DataFrame.unionByName, found)


def coverage(selected: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """Does success plus dropped cover the input exactly once? Status per id: success, dropped, uncovered, foreign,
    repeated or contradicting. ``outcomes`` has (key, outcome)."""
    wanted = selected.groupBy(key).agg(F.count(F.lit(1)).alias("_in"))
    seen = outcomes.groupBy(key).agg(F.count(F.lit(1)).alias("_out"), F.min("outcome").alias("_low"),
                                     F.max("outcome").alias("_high"))
    status = (F.when(F.col("_in").isNull(), "foreign").when(F.col("_out").isNull(), "uncovered")
              .when(F.col("_low") != F.col("_high"), "contradicting")
              .when((F.col("_out") > 1) | (F.col("_in") > 1), "repeated").otherwise(F.col("_low")))
    return wanted.join(seen, key, "full_outer").select(key, status.alias("status"))


def changed_fields(before: DataFrame, after: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Rows whose immutable fields differ, with the names of the fields."""
    old = before.select(key, *[F.col(f).alias(f"_old_{f}") for f in fields])
    joined = old.join(after.select(key, *fields), key)
    return (joined.select(key, violations(**{f: ~F.col(f"_old_{f}").eqNullSafe(F.col(f)) for f in fields})
                          .alias("changed_fields")).where(F.col("changed_fields") != ""))


def reconcile(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """missing / extra / changed rows of two snapshots with a unique key, and the changed fields."""
    fields = [c for c in before.columns if c != key]
    old = before.select(F.col(key), F.struct(*fields).alias("_old"))
    new = after.select(F.col(key), F.struct(*fields).alias("_new"))
    status = (F.when(F.col("_new").isNull(), "missing").when(F.col("_old").isNull(), "extra")
              .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed"))
    names = violations(**{f: ~F.col(f"_old.{f}").eqNullSafe(F.col(f"_new.{f}")) for f in fields})
    return (old.join(new, key, "full_outer")
            .select(key, status.alias("status"), F.when(status == "changed", names).otherwise("").alias("fields"))
            .where(F.col("status").isNotNull()))


def taxonomy_violations(keywords: Column, terms: Column, assigned: Column) -> Column:
    return violations(
        count=~F.size(keywords).between(2, 5),
        repeated=F.size(F.array_distinct(keywords)) != F.size(keywords),
        unknown=F.size(F.array_except(keywords, terms)) > 0,
        assignment=~keywords.eqNullSafe(assigned))


def taxonomy_stats(terms: DataFrame, group: str, term: str) -> DataFrame:
    """Set-level term rules per group: 2..15 distinct terms of at most 40 characters with a CJK character; fewer than
    ten need a reason. ``terms`` has one row per use."""
    used = terms.groupBy(group, term).agg(F.count(F.lit(1)).alias("_uses"))
    long, cjk = F.length(term) > 40, F.col(term).rlike("[\\x{4e00}-\\x{9fff}]")
    counted = used.groupBy(group).agg(
        F.count(F.lit(1)).alias("terms"), F.sum("_uses").alias("uses"), F.max("_uses").alias("most_used"),
        F.count_if(long).alias("long_terms"), F.count_if(~cjk).alias("without_cjk"))
    return (counted.withColumn("violations", violations(
        too_few=F.col("terms") < 2, too_many=F.col("terms") > 15, long=F.col("long_terms") > 0,
        without_cjk=F.col("without_cjk") > 0)).withColumn("needs_reason", F.col("terms") < 10))


def evidence_completeness(candidates: DataFrame, entries: DataFrame, key: str, category: str, dropped: Column) -> DataFrame:
    """Entry, kind and URL rules per candidate (``key`` and ``category``), those without evidence included. ``entries`` has the key, kind
    and url; pairs are reduced before the candidate meets."""
    reduced = entries.groupBy(key, "kind", "url").agg(F.count(F.lit(1)).alias("_n"))
    per_url = reduced.groupBy(key, "url").agg(
        F.sum("_n").alias("_n"), F.bool_or(F.col("kind") == "full_text").alias("_full"),
        F.bool_or(F.col("kind") == "official").alias("_official"),
        F.bool_or(~F.col("kind").isin(*rules.EVIDENCE_KINDS)).alias("_odd"))
    found = per_url.groupBy(key).agg(
        F.sum("_n").alias("entries"), F.count(F.lit(1)).alias("urls"), F.bool_or("_full").alias("_full"),
        F.bool_or("_official").alias("_official"), F.bool_or("_odd").alias("_odd"))
    per_key = (candidates.select(key, category).distinct().join(found, key, "left").na.fill(0, ["entries", "urls"])
               .na.fill(False, ["_full", "_official", "_odd"]))
    needed = F.when(F.col(category) == "Paper", F.col("_full")).otherwise(F.col("_official"))
    return per_key.select(key, category, "entries", "urls", violations(
        kind=F.col("_odd"), entries=~F.col("entries").between(1, rules.EVIDENCE_LIMIT),
        paths=dropped & (F.col("urls") < 2), required=~dropped & ~needed).alias("violations"))


def context_isolation(contexts: DataFrame, ratings: DataFrame, cycle: str, context: str) -> DataFrame:
    """Are the context ids of a cycle all distinct and disjoint from its rating ids?"""
    uses = contexts.groupBy(cycle, context).agg(F.count(F.lit(1)).alias("_n"))
    shared = uses.join(ratings.select(cycle, context).distinct().withColumn("_rating", F.lit(1)), [cycle, context], "left")
    return (shared.groupBy(cycle).agg(F.sum("_n").alias("contexts"), F.count(F.lit(1)).alias("distinct_contexts"),
                                      F.count("_rating").alias("rating_overlaps"))
            .withColumn("isolated", (F.col("contexts") == F.col("distinct_contexts")) & (F.col("rating_overlaps") == 0)))


def stage_sequence(stages: DataFrame, key: str, category: str, expected: Mapping[str, Sequence[str]],
                   extra_ok: Column | None = None) -> DataFrame:
    """Is the ordered stage list of each candidate the one of its category? Counted per position, never collected.

    ``stages`` has pos (from 0) and stage; ``extra_ok`` is a per-stage rule, for instance on the status.
    """
    wanted = F.lit(None).cast("array<string>")
    for name, names in expected.items():
        wanted = F.when(F.col(category) == name, F.array(*[F.lit(s) for s in names])).otherwise(wanted)
    fits = F.coalesce(F.get(wanted, F.col("pos")) == F.col("stage"), F.lit(False))
    extra = F.lit(True) if extra_ok is None else extra_ok
    per_pos = stages.groupBy(key, category, "pos").agg(
        F.count(F.lit(1)).alias("_n"), F.bool_and(fits).alias("_fits"), F.bool_and(extra).alias("_extra"))
    return (per_pos.groupBy(key, category).agg(
        F.sum("_n").alias("stages"), F.count(F.lit(1)).alias("_positions"), F.bool_and("_fits").alias("_fits"),
        F.bool_and("_extra").alias("statuses_ok"))
        .select(key, category, "stages", "statuses_ok",
                (F.col("_fits") & (F.col("_positions") == F.col("stages"))
                 & (F.col("stages") == F.size(wanted))).alias("sequence_ok")))


def stage_ownership(selected: DataFrame, stages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Flag whether selected media appear in a ``found`` stage of the same candidate."""
    found = stages.where(F.col("status") == "found").select(*keys).distinct().withColumn("_found", F.lit(True))
    return selected.join(found, list(keys), "left").withColumn("owned", F.coalesce("_found", F.lit(False))).drop("_found")


def validation_receipt(counts: DataFrame, violation_rows: DataFrame, cycle: str) -> DataFrame:
    """Counts, the eight named checks and the gate per cycle. ``violation_rows`` stacks (cycle, key, rule) of every
    quality operator; ``counts`` has one row per cycle with digest and bound_digest."""
    failed = violation_rows.groupBy(cycle).agg(
        *[F.count_if(F.col("rule") == name).alias(name) for name in rules.VALIDATION_CHECKS])
    joined = counts.join(failed, cycle, "left").na.fill(0, list(rules.VALIDATION_CHECKS))
    passed = [(F.col(name) == 0) for name in rules.VALIDATION_CHECKS]
    gate = reduce(lambda a, b: a & b, passed) & F.col("digest").eqNullSafe(F.col("bound_digest"))
    return joined.select(
        *[c for c in counts.columns if c not in ("digest", "bound_digest")],
        *[p.alias(f"{name}_ok") for p, name in zip(passed, rules.VALIDATION_CHECKS)], gate.alias("gate"))


def status_summary(tables: Mapping[str, DataFrame], cycles: DataFrame) -> DataFrame:
    """Row counts per table and cycle counts per phase in one table."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("table").alias("kind"), F.lit(name).alias("name"), "n")
              for name, df in tables.items()]
    phases = cycles.groupBy("phase").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("phase").alias("kind"), F.col("phase").alias("name"), "n")
    return reduce(DataFrame.unionByName, [*counts, phases])


EVIDENCE_FIELDS = ("frozen_sha256", "local_verified", "push_verified", "public_verified", "artifact_sha256", "commit_sha")


def release_gate(cycles: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Cycles with a frozen digest (cycle_id, frozen_sha256) and a confirmed deployment whose evidence holds for that digest.

    ``deliveries`` has cycle_id, channel, state and the fields of the evidence.
    """
    frozen = cycles.where(F.col("frozen_sha256").isNotNull())
    confirmed = (deliveries.where((F.col("channel") == "deployment") & (F.col("state") == "confirmed"))
                 .select(F.col("cycle_id").alias("_cycle"), *[F.col(f).alias(f"_{f}") for f in EVIDENCE_FIELDS]))
    holds = evidence_ok({f: F.col(f"_{f}") for f in EVIDENCE_FIELDS}, F.col("frozen_sha256"))
    return frozen.join(confirmed, (F.col("cycle_id") == F.col("_cycle")) & holds, "left_semi")
