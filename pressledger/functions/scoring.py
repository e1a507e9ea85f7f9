"""Score dimensions, bands, cutoffs and emphasis."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules


def score_violations(dims: Mapping[str, Column], track: str) -> Column:
    """Names of the dimensions outside 0..cap, in rubric order."""
    caps = rules.SCORE_CAPS[track]
    return F.array_compact(F.array(*[
        F.when((dims[name] < 0) | (dims[name] > cap) | dims[name].isNull(), F.lit(name))
        for name, cap in caps.items()]))


def track_score(dims: Mapping[str, Column], track: str, bonus: Column | None = None) -> Column:
    """Sum of the dimensions, NULL when one breaks its cap. The News bonus lifts materiality up to its cap."""
    values = dict(dims)
    if bonus is not None:
        if track != "News":
            raise ValueError("only the News track has a bonus")
        lift = F.least(F.greatest(bonus, F.lit(0)), F.lit(rules.NEWS_BONUS))
        values["materiality"] = F.when(
            dims["materiality"] <= rules.SCORE_CAPS["News"]["materiality"],
            F.least(dims["materiality"] + lift, F.lit(rules.SCORE_CAPS["News"]["materiality"]))
        ).otherwise(dims["materiality"])
    total = sum((values[name] for name in rules.SCORE_CAPS[track]), F.lit(0))
    return F.when(F.size(score_violations(values, track)) == 0, total)


def score_band(score: Column) -> Column:
    return (F.when(score >= 90, "90-100").when(score >= 80, "80-89").when(score >= 70, "70-79")
            .when(score >= 60, "60-69").otherwise("below-60"))


def passes_cutoff(category: Column, score: Column, policy_exception: Column | None = None,
                  relevance: Column | None = None) -> Column:
    """At least 60; Policy from 55 with the exception (strong topic, formal body, clear action, official URL);
    a Paper needs relevance of 15 where relevance is known."""
    passed = score >= rules.CUTOFF
    if policy_exception is not None:
        passed = passed | ((category == "Policy") & (score >= rules.POLICY_CUTOFF)
                           & F.coalesce(policy_exception, F.lit(False)))
    if relevance is not None:
        passed = passed & ((category != "Paper") | relevance.isNull() | (relevance >= rules.PAPER_MIN_RELEVANCE))
    return passed


def emphasis(category: Column, rank: Column) -> Column:
    return (category == "Paper") & (rank <= rules.EMPHASIS_RANK)


def category_ordinal(category: Column) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in rules.CATEGORIES]), category).cast("bigint")
