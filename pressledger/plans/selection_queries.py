"""Selection family: scores, ranks, quotas, report order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring
from ..operators import selection as ops
from ..tables import candidates, load, score_dims
from .registry import query
from .views import CANDIDATES, SCORE_DIMS, SELECTION


def qualified(spark, folder):
    rows = candidates(spark, folder)
    return rows.where(scoring.passes_cutoff(F.col("category"), F.col("score")))


def selected(spark, folder):
    return ops.select_by_quota(qualified(spark, folder))


@query("quota_selection", f"""with {SELECTION}
select cycle_id, category, candidate_id, score, group_rank, emphasis from selection""")
def quota_selection(spark, folder):
    return selected(spark, folder).select("cycle_id", "category", "candidate_id", "score", "group_rank", "emphasis")


@query("paper_backfill", f"""with {CANDIDATES},
r as (select *, row_number() over (partition by cycle_id order by (score >= 60) desc, score desc, candidate_id) as group_rank
      from candidates where category = 'Paper' and score >= 50),
s as (select *, count(*) over (partition by cycle_id) as n from r where group_rank <= 10)
select c.cycle_id, s.candidate_id, s.score, s.group_rank, s.score < 60 as backfilled, 10 - coalesce(s.n, 0) as shortage
from (select distinct cycle_id from candidates) c left join s on c.cycle_id = s.cycle_id""")
def paper_backfill(spark, folder):
    return ops.backfill_papers(candidates(spark, folder), F.col("score") >= 50)


@query("group_rank", f"""with {CANDIDATES}
select cycle_id, category, candidate_id, score,
       row_number() over (partition by cycle_id, category order by score desc, candidate_id) as group_rank
from candidates""")
def group_rank(spark, folder):
    return ops.group_rank(candidates(spark, folder).select("cycle_id", "category", "candidate_id", "score"))


@query("rank_density", """select l_orderkey, count(*) as rank_count, count(distinct l_linenumber) as distinct_ranks,
       cast(min(l_linenumber) as bigint) as min_rank, cast(max(l_linenumber) as bigint) as max_rank,
       min(l_linenumber) = 1 and max(l_linenumber) = count(*) and count(distinct l_linenumber) = count(*) as dense
from lineitem group by l_orderkey""")
def rank_density(spark, folder):
    return ops.rank_density(load(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query("rank_compress", f"""with {CANDIDATES},
o as (select *, row_number() over (partition by cycle_id, category order by score desc, candidate_id) as old_rank
      from candidates)
select cycle_id, category, candidate_id, old_rank,
       row_number() over (partition by cycle_id, category order by old_rank) as new_rank
from o where o_orderstatus <> 'F'""")
def rank_compress(spark, folder):
    rows = candidates(spark, folder).select("cycle_id", "category", "candidate_id", "score", "o_orderstatus")
    return (ops.compress_ranks(rows, F.col("o_orderstatus") == "F")
            .select("cycle_id", "category", "candidate_id", "old_rank", "new_rank"))


@query("legacy_rerank", f"""with {CANDIDATES},
o as (select cycle_id, category, candidate_id,
             row_number() over (partition by cycle_id order by score desc, candidate_id) as legacy_rank from candidates)
select *, row_number() over (partition by cycle_id, category order by legacy_rank) as group_rank from o""")
def legacy_rerank(spark, folder):
    rows = candidates(spark, folder).select("cycle_id", "category", "candidate_id", "score")
    return ops.rerank_legacy(rows).drop("score")


@query("latest_report", f"""with {SELECTION}
select cycle_id, category, candidate_id, group_rank from selection
where cycle_id = (select max(cycle_id) from selection)""")
def latest_report(spark, folder):
    # the newest cycle is found on the base rows, so only its partition is ranked
    newest = ops.latest_report(qualified(spark, folder))
    return ops.select_by_quota(newest).select("cycle_id", "category", "candidate_id", "group_rank")


@query("emphasis", f"""with {SELECTION}
select cycle_id, category, count(*) as selected, count(*) filter (where emphasis) as emphasised
from selection group by cycle_id, category""")
def emphasis(spark, folder):
    return selected(spark, folder).groupBy("cycle_id", "category").agg(
        F.count(F.lit(1)).alias("selected"), F.count_if("emphasis").alias("emphasised"))


@query("report_order", f"""with {SELECTION}
select cycle_id, candidate_id, category,
       cast(case category when 'Paper' then 1 when 'News' then 2 else 3 end as bigint) as category_order,
       row_number() over (partition by cycle_id
         order by case category when 'Paper' then 1 when 'News' then 2 else 3 end, group_rank) as position
from selection""")
def report_order(spark, folder):
    return ops.report_order(selected(spark, folder)).select(
        "cycle_id", "candidate_id", "category", "category_order", "position")


@query("quota_check", f"""with {CANDIDATES},
cycles as (select cycle_id from candidates union select cast(cycle_id + interval 7 day as date) from candidates),
c as (select cycle_id, count(*) as total, count(*) filter (where category = 'Paper') as paper_count,
             count(*) filter (where category = 'News') as news_count,
             count(*) filter (where category = 'Policy') as policy_count
      from candidates group by cycle_id),
n as (select cycles.cycle_id, coalesce(total, 0) as total, coalesce(paper_count, 0) as paper_count, coalesce(news_count, 0) as news_count,
             coalesce(policy_count, 0) as policy_count from cycles left join c on cycles.cycle_id = c.cycle_id)
select *, concat_ws(',', case when total = 0 then 'empty' end, case when total > 20 then 'total' end, case when paper_count > 10 then 'paper' end,
                    case when policy_count > 3 then 'policy' end,
                    case when news_count + policy_count > 10 then 'news_policy' end) as violations from n""")
def quota_check(spark, folder):
    """The weeks that have a candidate and those after them, of which at least the last has none."""
    rows = candidates(spark, folder)
    cycles = rows.select("cycle_id").unionByName(rows.select(F.date_add("cycle_id", 7).alias("cycle_id")))
    return ops.quota_violations(rows, cycles)


@query("quota_proof", f"""with {SELECTION},
rev as (select distinct cycle_id, case day(cycle_id) % 3 when 0 then 'policy3' when 1 then 'archive-r1' end as revision
        from candidates),
n as (select rev.cycle_id, revision, count(*) filter (where category = 'Paper') as p,
             count(*) filter (where category = 'News') as w, count(*) filter (where category = 'Policy') as q
      from rev left join selection s on rev.cycle_id = s.cycle_id group by rev.cycle_id, revision),
d as (select *, coalesce(revision = 'archive-r1', false) as ext,
             case when revision = 'archive-r1' then 6 else 10 - q end as cap,
             case when revision = 'policy3' then 3 else 5 end as pcap from n)
select cycle_id, revision, cast(20 as bigint) as selection_limit, p as paper_count, w as news_count, q as policy_count,
       p + w + q as selected_total, w + q as news_policy_total, cast(10 as bigint) as paper_capacity,
       cast(pcap as bigint) as policy_capacity, cast(cap as bigint) as news_final_capacity,
       cast(greatest(0, least(w, cap) - 5) as bigint) as news_fallback_used,
       (not ext or (p = 10 and w = 6 and q = 5)) and p + w + q <= 20 + case when ext then 1 else 0 end
         and p <= 10 and q <= pcap and w <= cap as quotas_hold,
       case when day(cycle_id) % 5 = 0 then w + 1 else w end = w as proof_equal
from d""")
def quota_proof(spark, folder):
    day = F.dayofmonth("cycle_id")
    revisions = candidates(spark, folder).select("cycle_id").distinct().withColumn(
        "revision", F.when(day % 3 == 0, "policy3").when(day % 3 == 1, "archive-r1"))
    proof = ops.quota_proof(selected(spark, folder), revisions)
    stored = F.when(day % 5 == 0, F.col("news_count") + 1).otherwise(F.col("news_count"))
    return proof.withColumn("proof_equal", stored.eqNullSafe(F.col("news_count")))


@query("digest_message", f"""with {SELECTION},
r as (select *, row_number() over (partition by cycle_id, category order by score desc, candidate_id) as rk from selection),
k as (select c.cycle_id, t.category, t.o from (select distinct cycle_id from r) c cross join (values ('Paper', 1), ('News', 2), ('Policy', 3)) t(category, o)),
b as (select k.cycle_id, k.category, k.o,
             concat_ws(chr(10), concat(k.category, ': ', cast(count(r.candidate_id) as varchar)),
                       string_agg(concat('- ', r.candidate_id), chr(10) order by rk) filter (where rk <= 3),
                       case when count(r.candidate_id) > 3 then concat('- 另有 ', cast(count(r.candidate_id) - 3 as varchar), ' 条') end) as block
      from k left join r on k.cycle_id = r.cycle_id and k.category = r.category group by k.cycle_id, k.category, k.o)
select cycle_id, string_agg(block, chr(10) order by o) as message, length(string_agg(block, chr(10))) <= 4000 as within_limit
from b group by cycle_id""")
def digest_message(spark, folder):
    return ops.digest_messages(selected(spark, folder), F.col("candidate_id"))


@query("track_score", f"""with {SCORE_DIMS},
v as (select *, concat_ws(',', case when relevance > 30 then 'relevance' end, case when novelty > 20 then 'novelty' end,
       case when credibility > 20 then 'credibility' end, case when impact > 15 then 'impact' end,
       case when team > 10 then 'team' end, case when timeliness > 5 then 'timeliness' end) as violations from score_dims)
select l_orderkey, l_linenumber, violations,
       case when violations = '' then relevance + novelty + credibility + impact + team + timeliness end as score
from v""")
def track_score(spark, folder):
    names = ("relevance", "novelty", "credibility", "impact", "team", "timeliness")
    dims = {name: F.col(name) for name in names}
    return score_dims(spark, folder).select(
        "l_orderkey", "l_linenumber", F.array_join(scoring.score_violations(dims, "Paper"), ",").alias("violations"),
        scoring.track_score(dims, "Paper").alias("score"))


@query("news_score", f"""with {SCORE_DIMS},
d as (select l_orderkey, l_linenumber, relevance as materiality, novelty + 4 as evidence, impact + 4 as impact, team + 4 as novelty, timeliness + 4 as timeliness,
  l_linenumber - 2 as bonus from score_dims),
v as (select *, case when materiality <= 30 then least(materiality + least(greatest(bonus, 0), 5), 30) else materiality end as lifted,
  concat_ws(',', case when materiality > 30 then 'materiality' end, case when evidence > 25 then 'evidence' end, case when impact > 20 then 'impact' end,
  case when novelty > 15 then 'novelty' end, case when timeliness > 10 then 'timeliness' end) as violations from d)
select l_orderkey, l_linenumber, violations, case when violations = '' then lifted + evidence + impact + novelty + timeliness end as score from v""")
def news_score(spark, folder):
    dims = {"materiality": F.col("relevance"), "evidence": F.col("novelty") + 4, "impact": F.col("impact") + 4, "novelty": F.col("team") + 4,
            "timeliness": F.col("timeliness") + 4}
    return score_dims(spark, folder).select(
        "l_orderkey", "l_linenumber", F.array_join(scoring.score_violations(dims, "News"), ",").alias("violations"),
        scoring.track_score(dims, "News", F.col("l_linenumber") - 2).alias("score"))


@query("policy_score", f"""with {SCORE_DIMS},
d as (select l_orderkey, l_linenumber, relevance as materiality, novelty + 4 as authority, impact + 4 as scope, team + 4 as implementation,
  timeliness + 4 as timeliness from score_dims),
v as (select *, concat_ws(',', case when materiality > 30 then 'materiality' end, case when authority > 25 then 'authority' end, case when scope > 20 then 'scope' end,
  case when implementation > 15 then 'implementation' end, case when timeliness > 10 then 'timeliness' end) as violations from d)
select l_orderkey, l_linenumber, violations, case when violations = '' then materiality + authority + scope + implementation + timeliness end as score from v""")
def policy_score(spark, folder):
    dims = {"materiality": F.col("relevance"), "authority": F.col("novelty") + 4, "scope": F.col("impact") + 4, "implementation": F.col("team") + 4,
            "timeliness": F.col("timeliness") + 4}
    return score_dims(spark, folder).select(
        "l_orderkey", "l_linenumber", F.array_join(scoring.score_violations(dims, "Policy"), ",").alias("violations"),
        scoring.track_score(dims, "Policy").alias("score"))


@query("score_band", f"""with {CANDIDATES}
select category, case when score >= 90 then '90-100' when score >= 80 then '80-89' when score >= 70 then '70-79'
                      when score >= 60 then '60-69' else 'below-60' end as band, count(*) as n
from candidates group by all""")
def score_band(spark, folder):
    return (candidates(spark, folder)
            .groupBy("category", scoring.score_band(F.col("score")).alias("band"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("cutoff", f"""with {CANDIDATES},
f as (select *, source_key % 4 = 0 as strong, source_key % 33 as relevance from candidates)
select candidate_id, (score >= 60 or (category = 'Policy' and score >= 55 and strong))
       and (category <> 'Paper' or relevance >= 15) as passes
from f""")
def cutoff(spark, folder):
    return candidates(spark, folder).select("candidate_id", scoring.passes_cutoff(
        F.col("category"), F.col("score"), F.col("source_key") % 4 == 0, F.col("source_key") % 33).alias("passes"))
