"""Contract family: metadata bounds, references, coverage, taxonomy, evidence, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import json_checks as js
from ..operators import contracts as ops
from ..operators.fingerprints import sha256_text
from ..operators.windows import running_sums
from ..session import pinned
from ..tables import candidates, conv_stages, doc_records, event_log, load, spread, text_of
from .registry import query
from .views import CANDIDATES, CONV_STAGES, DOC_RECORDS, EVENT_LOG


def choose(index, *values):
    """values[index] as a column; strings are literals."""
    result = F.lit(None).cast("string")
    for i, value in reversed(list(enumerate(values))):
        result = F.when(index == i, F.lit(value) if isinstance(value, str) else value).otherwise(result)
    return result


@query("metadata_bounds", """select event_id, case event_id % 14 when 1 then 'keys' when 2 then 'paths' when 3 then 'paths' when 4 then 'counts'
  when 5 then 'counts' when 7 then 'checksums' when 8 then 'identity' when 9 then 'reason' when 11 then 'not_object' when 12 then 'paths'
  when 13 then 'not_object' end as reason from events""")
def metadata_bounds(spark, folder):
    event, k = F.col("event_id"), F.col("event_id") % 14
    many = F.concat(F.lit('{"paths":['), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(65)), lambda i: F.concat(
        F.lit('"a/'), i.cast("string"), F.lit('"'))), ","), F.lit("]}"))
    payload = choose(
        k, F.concat(F.lit('{"status":"'), F.col("event_type"), F.lit('","counts":{"n":'), text_of(event), F.lit("}}")),
        '{"content":"x"}', '{"paths":["a/b","../escape"]}', '{"paths":["/absolute"]}', '{"counts":{"n":-1}}',
        F.concat(F.lit('{"counts":'), F.replace("props", F.lit("}"), F.lit('.5}')), F.lit("}")),
        F.concat(F.lit('{"checksums":{"0":"'), sha256_text(text_of(event)), F.lit('"}}')),
        F.concat(F.lit('{"checksums":{"0":"'), F.upper(sha256_text(text_of(event))), F.lit('"}}')),
        F.concat(F.lit('{"identity":{"a":'), F.col("props"), F.lit("}}")),
        F.concat(F.lit('{"reason":"'), F.repeat(F.lit("x"), 301), F.lit('"}')),
        '{"identity":{"a":null,"b":true,"c":"t"},"context_id":"c1"}', "[1]", many, '{"a":1,"a":2}')
    return spread(load(spark, folder, "events")).select("event_id", payload.alias("payload")).select(
        "event_id", js.control_metadata_reason(F.col("payload")).alias("reason"))


@query("event_bounds", f"""with {EVENT_LOG}
select seq, case seq % 6 when 1 then 'fields' when 2 then 'values' when 3 then 'bytes' when 5 then 'values' end as reason from event_log""")
def event_bounds(spark, folder):
    rows, k = spread(event_log(spark, folder)), F.col("seq") % 6
    head = F.concat(F.lit('{"key":"'), F.col("event_key"), F.lit('","source_id":"'), F.col("source"), F.lit('","status":"'),
                    F.col("status"), F.lit('"'))
    payload = choose(
        k, F.concat(head, F.lit(',"announce_types":["'), F.col("event_type"), F.lit('"],"cycle_id":null}')),
        F.concat(head, F.lit(',"summary":"text"}')), F.concat(head, F.lit(',"version":'), text_of("seq"), F.lit("}")),
        F.concat(head, F.lit(',"canonical_url":"'), F.repeat(F.lit("u"), 4096), F.lit('"}')), F.concat(head, F.lit("}")),
        F.concat(head, F.lit(',"announce_types":['), F.col("props"), F.lit("]}")))
    return rows.select("seq", payload.alias("payload")).select("seq", js.event_reason(F.col("payload")).alias("reason"))


@query("cursor_bounds", """select event_id, case event_id % 5 when 1 then 'keys' when 2 then 'values' when 3 then 'values' end as reason from events""")
def cursor_bounds(spark, folder):
    payload = choose(
        F.col("event_id") % 5, F.col("props"), F.concat(F.lit('{"Body":'), text_of("value"), F.lit("}")),
        F.concat(F.lit('{"nested":'), F.col("props"), F.lit("}")),
        F.concat(F.lit('{"long":"'), F.repeat(F.col("event_type"), 100), F.lit('"}')),
        F.concat(F.lit('{"etag":"'), F.col("event_type"), F.lit('","n":'), text_of("value"), F.lit(',"done":false,"x":null}')))
    return spread(load(spark, folder, "events")).select("event_id", payload.alias("payload")).select(
        "event_id", js.cursor_reason(F.col("payload")).alias("reason"))


@query("exact_fields", """with f as (select event_id, case event_id % 4 when 0 then concat('{"value":', cast(value as varchar), ',"k":1}') when 1 then props
  when 2 then concat('{"k":1,"value":2,"more":', props, '}') else concat('{"k":', props, ',"value":null}') end as payload from events)
select event_id, list_sort(json_keys(payload)) = ['k', 'value'] as exact from f""")
def exact_fields(spark, folder):
    payload = choose(
        F.col("event_id") % 4, F.concat(F.lit('{"value":'), text_of("value"), F.lit(',"k":1}')), F.col("props"),
        F.concat(F.lit('{"k":1,"value":2,"more":'), F.col("props"), F.lit("}")),
        F.concat(F.lit('{"k":'), F.col("props"), F.lit(',"value":null}')))
    return load(spark, folder, "events").select(
        "event_id", js.has_exact_fields(payload, "k", "value").alias("exact"))


@query("public_projection", f"with {DOC_RECORDS} select candidate_id, category, source, lang, path from doc_records where outcome = 'success'")
def public_projection(spark, folder):
    rows = doc_records(spark, folder, "candidate_id", "category", "source", "lang", "path", "outcome")
    return ops.public_projection(rows.where(F.col("outcome") == "success"))


def evidence_fields(k, h):
    """The evidence of a delivery in eight variants of which two are sound; ``h`` is the frozen digest."""
    return {
        "frozen_sha256": F.when(k == 2, F.reverse(h)).otherwise(h), "local_verified": k != 3,
        "push_verified": F.when(k == 4, F.lit(None).cast("boolean")).otherwise(F.lit(True)), "public_verified": F.lit(True),
        "commit_sha": F.when(k == 5, F.substring(h, 1, 39)).when(k == 1, F.substring(h, 1, 40)).otherwise(h),
        "artifact_sha256": F.when(k == 6, F.concat(F.lit("G"), F.substring(h, 2, 63))).otherwise(h)}


# the same fields and then the rule, over rows with k and h
EVIDENCE_SQL = """case when k = 2 then reverse(h) else h end as frozen, k <> 3 as local_ok, case when k = 4 then null else true end as push_ok, true as public_ok,
  case when k = 5 then h[1:39] when k = 1 then h[1:40] else h end as commit_sha, case when k = 6 then concat('G', h[2:64]) else h end as artifact"""
EVIDENCE_RULE = """coalesce(local_ok and push_ok and public_ok and frozen = h and regexp_full_match(commit_sha, '[0-9a-f]{40}|[0-9a-f]{64}')
  and regexp_full_match(artifact, '[0-9a-f]{64}'), false)"""


@query("evidence_ok", f"""with f as (select event_id, sha256(cast(event_id as varchar)) as h, event_id % 8 as k from events),
e as (select event_id, h, {EVIDENCE_SQL} from f)
select event_id, {EVIDENCE_RULE} as ok from e""")
def evidence_ok(spark, folder):
    rows = load(spark, folder, "events").select("event_id", sha256_text(text_of("event_id")).alias("h"))
    return rows.select("event_id", ops.evidence_ok(evidence_fields(F.col("event_id") % 8, F.col("h")), F.col("h")).alias("ok"))


@query("record_rules", f"""with {DOC_RECORDS}
select doc_id, concat_ws(',', case when doc_id % 17 = 0 then 'candidate_id' end, case when doc_id % 19 = 0 then 'title' end,
  case when doc_id % 23 = 0 then 'category' end, case when doc_id % 29 = 0 then 'identities' end,
  case when doc_id % 31 in (0, 1, 2) then 'display_date' end) as violations from doc_records""")
def record_rules(spark, folder):
    doc = F.col("doc_id")
    date = (F.when(doc % 31 == 0, "2024-13-01").when(doc % 31 == 1, "2024-1-1").when(doc % 31 == 2, "2023-02-29")
            .otherwise("2024-02-29"))
    return doc_records(spark, folder, "doc_id", "candidate_id", "category", "source", "path").select(
        "doc_id", ops.record_violations(
            F.when(doc % 17 == 0, " ").otherwise(F.col("candidate_id")),
            F.when(doc % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("path")),
            F.when(doc % 23 == 0, "Other").otherwise(F.col("category")),
            F.when(doc % 29 == 0, F.array(F.col("source"), F.lit(""))).otherwise(F.array("source")), date).alias("violations"))


@query("orphan_refs", """with r as (
  select 'lineitem' as source_table, 'l_orderkey' as column_name, l_orderkey as k from lineitem where l_orderkey not in (select o_orderkey from orders)
  union all select 'lineitem', 'parts', p from (select unnest([l_partkey, l_partkey + l_linenumber]) as p from lineitem)
    where p <> 0 and p not in (select p_partkey from part)
  union all select 'orders', 'o_custkey', o_custkey from orders where o_custkey <> 0 and o_custkey not in (select c_custkey from customer)
  union all select 'nation', 'n_regionkey', n_regionkey from nation where n_regionkey not in (select r_regionkey from region))
select source_table, column_name, k as missing_key, count(*) as "references" from r group by all""")
def orphan_refs(spark, folder):
    tables = {name: load(spark, folder, name) for name in ("lineitem", "orders", "part", "customer", "nation", "region")}
    line = F.col("l_orderkey")
    references = [
        ops.Reference("lineitem", line, "l_orderkey", line, "Ref:orders", "o_orderkey"),
        ops.Reference("lineitem", line, "parts", F.array(F.col("l_partkey"), F.col("l_partkey") + F.col("l_linenumber")),
                      "RefList:part", "p_partkey"),
        ops.Reference("orders", F.col("o_orderkey"), "o_custkey", F.col("o_custkey"), "Ref:customer", "c_custkey"),
        ops.Reference("nation", F.col("n_nationkey"), "n_regionkey", F.col("n_regionkey"), "Ref:region", "r_regionkey")]
    return ops.orphan_references(tables, references)


@query("coverage", f"""with {DOC_RECORDS},
o as (select doc_id, outcome from doc_records where outcome <> 'uncovered'
  union all select doc_id, outcome from doc_records where outcome <> 'uncovered' and doc_id % 5 = 0
  union all select doc_id, 'dropped' from doc_records where outcome = 'success' and doc_id % 7 = 0
  union all select doc_id + 1000000000, outcome from doc_records where outcome <> 'uncovered' and doc_id % 13 = 0),
n as (select doc_id, count(*) as c, min(outcome) as a, max(outcome) as b from o group by doc_id)
select coalesce(d.doc_id, n.doc_id) as doc_id, case when d.doc_id is null then 'foreign' when n.doc_id is null then 'uncovered'
  when a <> b then 'contradicting' when c > 1 then 'repeated' else a end as status
from documents d full join n on d.doc_id = n.doc_id""")
def coverage(spark, folder):
    labels = load(spark, folder, "labels")
    doc = F.col("doc_id")
    seen = labels.select("doc_id", F.when(F.col("quality") == 1, "success").otherwise("dropped").alias("outcome"))
    outcomes = (seen.unionByName(seen.where(doc % 5 == 0))
                .unionByName(seen.where((doc % 7 == 0) & (F.col("outcome") == "success")).withColumn("outcome", F.lit("dropped")))
                .unionByName(seen.where(doc % 13 == 0).withColumn("doc_id", doc + 1_000_000_000)))
    return ops.coverage(load(spark, folder, "documents"), outcomes, "doc_id")


@query("immutable_fields", f"""with {CANDIDATES},
b as (select candidate_id, source_key, category, score, concat(lower(category), '-v3') as rating_track from candidates),
a as (select candidate_id, case when source_key % 10 = 0 then 'News' else category end as category, case when source_key % 7 = 0 then score + 1 else score end as score,
  case when source_key % 9 = 0 then null else rating_track end as rating_track from b),
d as (select b.candidate_id, concat_ws(',', case when a.category is distinct from b.category then 'category' end, case when a.score is distinct from b.score then 'score' end,
  case when a.rating_track is distinct from b.rating_track then 'rating_track' end) as changed_fields from b join a on a.candidate_id = b.candidate_id)
select * from d where changed_fields <> ''""")
def immutable_fields(spark, folder):
    key = F.col("source_key")
    before = candidates(spark, folder).select(
        "candidate_id", "source_key", "category", "score", F.concat(F.lower("category"), F.lit("-v3")).alias("rating_track"))
    after = before.select(
        "candidate_id", F.when(key % 10 == 0, "News").otherwise(F.col("category")).alias("category"),
        F.when(key % 7 == 0, F.col("score") + 1).otherwise(F.col("score")).alias("score"),
        F.when(key % 9 == 0, F.lit(None).cast("string")).otherwise(F.col("rating_track")).alias("rating_track"))
    return ops.changed_fields(before, after, "candidate_id", ["category", "score", "rating_track"])


@query("taxonomy_mapping", """with f as (select doc_id, case doc_id % 5 when 0 then [lang] when 1 then [lang, source, lang] else [lang, source] end as kw,
   case when doc_id % 6 = 0 then [source, lang] when doc_id % 5 = 0 then [lang] when doc_id % 5 = 1 then [lang, source, lang]
        else [lang, source] end as assigned, source from documents)
select doc_id, concat_ws(',', case when doc_id % 5 = 0 then 'count' end, case when doc_id % 5 = 1 then 'repeated' end,
  case when doc_id % 5 <> 0 and length(source) > 4 then 'unknown' end, case when kw <> assigned then 'assignment' end) as violations from f""")
def taxonomy_mapping(spark, folder):
    k = F.col("doc_id") % 5
    terms = F.array(*[F.lit(t) for t in ("en", "fr", "de", "es", *[f"src{i}" for i in range(10)])])
    keywords = (F.when(k == 0, F.array("lang")).when(k == 1, F.array("lang", "source", "lang"))
                .otherwise(F.array("lang", "source")))
    docs = load(spark, folder, "documents").select("doc_id", keywords.alias("keywords"), "lang", "source")
    assignments = docs.select("doc_id", F.when(F.col("doc_id") % 6 == 0, F.array("source", "lang"))
                              .otherwise(F.col("keywords")).alias("assigned"))
    return docs.join(assignments, "doc_id").select(
        "doc_id", ops.taxonomy_violations(F.col("keywords"), terms, F.col("assigned")).alias("violations"))


@query("ordered_relation", """with r as (select l_orderkey, l_partkey, row_number() over (partition by l_orderkey
    order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as position from lineitem)
select l_orderkey, position, l_partkey, p_name from r join part on l_partkey = p_partkey""")
def ordered_relation(spark, folder):
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")]
    ranked = running_sums(lines, ["l_orderkey"], order, {"position": F.lit(1)})
    parts = load(spark, folder, "part").select("p_partkey", "p_name")
    return (ranked.select("l_orderkey", "position", "l_partkey")
            .join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey"))


@query("stage_ownership", f"""with {CONV_STAGES},
s as (select conv_id, url, case pos % 3 when 0 then 'found' when 1 then 'unavailable' else 'unsuitable' end as status from conv_stages),
sel as (select distinct conv_id, url from conv_stages where pos in (1, 3))
select conv_id, url, exists (select 1 from s where s.conv_id = sel.conv_id and s.url = sel.url and status = 'found') as owned from sel""")
def stage_ownership(spark, folder):
    rows = conv_stages(spark, folder)
    pos = F.col("pos") % 3
    stages = rows.select("conv_id", "url", F.when(pos == 0, "found").when(pos == 1, "unavailable")
                         .otherwise("unsuitable").alias("status"))
    selected = rows.where(F.col("pos").isin(1, 3)).select("conv_id", "url").distinct()
    return ops.stage_ownership(selected, stages, ["conv_id", "url"])


@query("evidence_complete", f"""with {CONV_STAGES},
k as (select distinct conv_id, category from conv_stages union select -1 - conv_id, category from conv_stages where conv_id % 10 = 0),
e as (select k.conv_id, k.category, count(s.kind) as entries, count(distinct url) as urls, coalesce(bool_or(kind = 'full_text'), false) as f,
      coalesce(bool_or(kind = 'official'), false) as o from k left join conv_stages s on k.conv_id = s.conv_id group by k.conv_id, k.category)
select conv_id, category, entries, urls, concat_ws(',', case when entries > 24 or entries < 1 then 'entries' end,
  case when conv_id % 4 = 0 and urls < 2 then 'paths' end,
  case when conv_id % 4 <> 0 and not (case when category = 'Paper' then f else o end) then 'required' end) as violations from e""")
def evidence_complete(spark, folder):
    """Every tenth conversation has a twin of negative id without any evidence."""
    stages, conv = conv_stages(spark, folder), F.col("conv_id")
    keys = stages.select("conv_id", "category")
    every = keys.unionByName(keys.where(conv % 10 == 0).withColumn("conv_id", -1 - conv))
    return ops.evidence_completeness(every, stages, "conv_id", "category", conv % 4 == 0)


@query("context_isolation", f"""with {CONV_STAGES},
c as (select conv_id, concat(stage, '-', cast(length(text) % 5 as varchar)) as ctx from conv_stages),
r as (select distinct conv_id, 'user-0' as ctx from conv_stages)
select c.conv_id, count(*) as contexts, count(distinct c.ctx) as distinct_contexts,
  count(distinct case when r.ctx is not null then c.ctx end) as rating_overlaps,
  count(*) = count(distinct c.ctx) and count(r.ctx) = 0 as isolated
from c left join r on c.conv_id = r.conv_id and c.ctx = r.ctx group by c.conv_id""")
def context_isolation(spark, folder):
    rows = conv_stages(spark, folder)
    contexts = rows.select("conv_id", F.concat("stage", F.lit("-"), text_of(F.length("text") % 5)).alias("ctx"))
    ratings = rows.select("conv_id", F.lit("user-0").alias("ctx")).distinct()
    return ops.context_isolation(contexts, ratings, "conv_id", "ctx")


@query("validation_receipt", f"""with {DOC_RECORDS},
t as (select source, count(distinct lang) as terms, count(*) as selected, count(*) filter (where outcome = 'success') as published,
  count(*) filter (where outcome = 'dropped') as dropped, count(*) filter (where toxic = 1) as bad_evidence,
  count(*) filter (where category = 'Policy') as policy, count(*) filter (where length(trim(text)) = 0) as bad_schema,
  count(*) filter (where outcome = 'success' and toxic = 1 and lang = 'en') as bad_refine,
  count(*) filter (where not (length(text) between 32 and 16000)) as bad_images, count(*) filter (where outcome = 'success' and length(text) between 150 and 199) as bad_owners
  from doc_records group by source)
select source, terms, selected, published, dropped, bad_evidence = 0 as evidence_ok, policy <= 20 as grouped_selection_ok, bad_images = 0 as images_ok,
  bad_owners = 0 as ownership_ok, selected <= 52 as quotas_ok, bad_refine = 0 as refine_ok, bad_schema = 0 as schema_ok, terms >= 4 as taxonomy_ok,
  bad_evidence = 0 and policy <= 20 and selected <= 52 and bad_refine = 0 and bad_schema = 0 and terms >= 4 and bad_images = 0 and bad_owners = 0 and selected % 3 <> 0 as gate from t""")
def validation_receipt(spark, folder):
    """A document stands for an image of its length by 600; it is selected from 150 characters on and found in a stage from 200 on."""
    # the text is read once, for its length and whether it is blank
    length = F.length("text")
    image = ops.image_violations(F.lit("PNG"), length, F.lit(600), F.octet_length("text"), F.lit(False), F.lit("png"))
    docs = pinned(doc_records(spark, folder, "doc_id", "source", "lang", "text", "category", "quality", "toxic", "outcome").select(
        "doc_id", "source", "lang", "category", "toxic", "outcome", length.alias("length"), (F.length(F.trim("text")) == 0).alias("blank"), image.alias("image")))
    success = F.col("outcome") == "success"
    owned = ops.stage_ownership(docs.where(success & (F.col("length") >= 150)).select("source", "doc_id"),
                                docs.select("source", "doc_id", F.when(F.col("length") >= 200, "found").otherwise("unsuitable").alias("status")), ["source", "doc_id"])
    per_lang = docs.groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("selected"), F.count_if(F.col("outcome") == "success").alias("published"),
        F.count_if(F.col("outcome") == "dropped").alias("dropped"), F.count_if(F.col("category") == "Policy").alias("policy"))
    counts = per_lang.groupBy("source").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("selected").alias("selected"), F.sum("published").alias("published"),
        F.sum("dropped").alias("dropped"), F.sum("policy").alias("_policy"))
    row_rules = F.array_compact(F.array(
        F.when(F.col("toxic") == 1, "evidence"), F.when(F.col("blank"), "schema"), F.when(F.col("image") != "", "images"),
        F.when((F.col("outcome") == "success") & (F.col("toxic") == 1) & (F.col("lang") == "en"), "refine")))
    set_rules = F.array_compact(F.array(
        F.when(F.col("_policy") > 20, "grouped_selection"), F.when(F.col("selected") > 52, "quotas"),
        F.when(F.col("terms") < 4, "taxonomy")))
    stacked = (docs.select("source", text_of("doc_id").alias("key"), F.explode(row_rules).alias("rule"))
               .unionByName(owned.where(~F.col("owned")).select("source", text_of("doc_id").alias("key"), F.lit("ownership").alias("rule")))
               .unionByName(counts.select("source", F.col("source").alias("key"), F.explode(set_rules).alias("rule"))))
    digest = sha256_text(text_of("selected"))
    bound = counts.select("source", "terms", "selected", "published", "dropped", digest.alias("digest"), F.when(
        F.col("selected") % 3 == 0, "other").otherwise(digest).alias("bound_digest"))
    return ops.validation_receipt(bound, stacked, "source")


@query("taxonomy_stats", r"""with t as (select lang, unnest(string_split_regex(text, '[ \n]+')) as term from documents),
u as (select lang, term, count(*) as n from t where term <> '' group by lang, term),
s as (select lang, count(*) as terms, cast(sum(n) as bigint) as uses, max(n) as most_used, count(*) filter (where length(term) > 40) as long_terms,
  count(*) filter (where not regexp_matches(term, '[\x{4e00}-\x{9fff}]')) as without_cjk from u group by lang)
select *, concat_ws(',', case when terms < 2 then 'too_few' end, case when terms > 15 then 'too_many' end, case when long_terms > 0 then 'long' end,
  case when without_cjk > 0 then 'without_cjk' end) as violations, terms < 10 as needs_reason from s""")
def taxonomy_stats(spark, folder):
    docs = spread(load(spark, folder, "documents").select("lang", "text"))
    terms = docs.select("lang", F.explode(F.split(F.translate("text", "\n", " "), " ")).alias("term"))
    return ops.taxonomy_stats(terms.where(F.col("term") != ""), "lang", "term")


@query("stage_sequence", f"""with {CONV_STAGES},
g as (select conv_id, category, count(*) as stages, string_agg(stage, ',' order by pos) as seq,
  bool_and(case when length(text) % 4 = 0 then length(text) % 3 <> 0 else true end) as statuses_ok from conv_stages group by conv_id, category)
select conv_id, category, stages, statuses_ok, seq = case category when 'Paper' then 'user,assistant' when 'News' then 'system,user,assistant'
  else 'user,assistant,user,assistant' end as sequence_ok from g""")
def stage_sequence(spark, folder):
    from .corpus_queries import TALK_SECTIONS
    size = F.length("text")
    # every fourth text stands for a stage without a result, which needs a reason
    reason = F.when(size % 3 == 0, F.lit(None).cast("string")).otherwise("checked")
    status = F.when(size % 4 == 0, "unavailable").otherwise("found")
    rows = conv_stages(spark, folder).select("conv_id", "category", "pos", "stage", status.alias("status"), reason.alias("reason"))
    complete = F.col("status").isin("found", "unavailable", "unsuitable") & (
        (F.col("status") == "found") | F.col("reason").isNotNull())
    return ops.stage_sequence(rows, "conv_id", "category", TALK_SECTIONS, complete)


@query("ref_list", r"""with f as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, concat(cast(l_partkey + 1 as varchar), ',', cast(l_suppkey + 1 as varchar)) as pair from lineitem),
p as (select *, case l_linenumber when 3 then '' when 4 then null when 5 then concat('[', pair, ']') when 6 then concat('["L",-', pair, ']') else concat('["L",', pair, ']') end as packed from f),
m as (select *, coalesce(packed <> '' and not regexp_full_match(packed, '\["L"(,[1-9][0-9]*)*\]'), false) as malformed from p)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, malformed,
  case when malformed then null else coalesce(regexp_replace(packed, '[^0-9]*([0-9].*)\]$', '\1'), '') end as refs from m""")
def ref_list(spark, folder):
    line = F.col("l_linenumber")
    pair = F.concat(text_of(F.col("l_partkey") + 1), F.lit(","), text_of(F.col("l_suppkey") + 1))
    packed = (F.when(line == 3, "").when(line == 4, F.lit(None).cast("string"))
              .when(line == 5, F.concat(F.lit("["), pair, F.lit("]")))
              .when(line == 6, F.concat(F.lit('["L",-'), pair, F.lit("]"))).otherwise(F.concat(F.lit('["L",'), pair, F.lit("]"))))
    rows = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", packed.alias("packed"))
    return rows.withColumn("d", js.reference_list(F.col("packed"))).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "d.malformed", F.array_join("d.refs", ",").alias("refs"))


@query("anomaly_split", """with f as (select event_id, case event_id % 3 when 0 then concat('["L",', cast(event_id + 1 as varchar), ']')
  when 1 then concat('"', event_type, '"') else '""' end as cell from events),
t as (select event_id, json_type(cell) = 'VARCHAR' and json_extract_string(cell, '$') <> '' as anomaly from f)
select event_id, case when anomaly then 'quarantine' else 'relation' end as destination, case when anomaly then 'text in a reference cell' end as reason from t""")
def anomaly_split(spark, folder):
    cell = choose(F.col("event_id") % 3, F.concat(F.lit('["L",'), text_of(F.col("event_id") + 1), F.lit("]")),
                  F.concat(F.lit('"'), F.col("event_type"), F.lit('"')), '""')
    rows = load(spark, folder, "events").select("event_id", js.is_text_anomaly(cell).alias("anomaly"))
    return rows.select("event_id", F.when(F.col("anomaly"), "quarantine").otherwise("relation").alias("destination"),
                       F.when(F.col("anomaly"), "text in a reference cell").alias("reason"))


@query("status_summary", f"""select 'table' as kind, 'orders' as name, count(*) as n from orders union all select 'table', 'customer', count(*) from customer
union all select 'table', 'lineitem', count(*) from lineitem union all select 'phase', o_orderstatus, count(*) from orders group by o_orderstatus""")
def status_summary(spark, folder):
    orders = load(spark, folder, "orders")
    return ops.status_summary({"orders": orders, "customer": load(spark, folder, "customer"),
                               "lineitem": load(spark, folder, "lineitem")}, orders.select(F.col("o_orderstatus").alias("phase")))


@query("release_gate", f"""with {EVENT_LOG},
d as (select *, concat(source, '-', cast(cast(ts as date) as varchar)) as cycle_id from event_log),
e as (select cycle_id, user_id, event_type, seq % 8 as k, sha256(cycle_id) as h from d),
c as (select cycle_id, h, {EVIDENCE_SQL} from e where user_id % 40 < 20 and event_type = 'purchase')
select distinct cycle_id from d where event_type = 'view' and cycle_id in (select cycle_id from c where {EVIDENCE_RULE})""")
def release_gate(spark, folder):
    rows = event_log(spark, folder).select(
        F.concat("source", F.lit("-"), text_of(F.col("ts").cast("date"))).alias("cycle_id"),
        F.when(F.col("user_id") % 40 < 20, "deployment").otherwise("notification").alias("channel"),
        F.when(F.col("event_type") == "purchase", "confirmed").otherwise("unknown").alias("state"), "seq", "event_type")
    # a cycle counts as frozen once it had a 'view'
    digest = sha256_text(F.col("cycle_id"))
    cycles = rows.groupBy("cycle_id").agg(F.max(F.when(F.col("event_type") == "view", digest)).alias("frozen_sha256"))
    evidence = evidence_fields(F.col("seq") % 8, digest)
    return ops.release_gate(cycles, rows.select("cycle_id", "channel", "state", *[c.alias(n) for n, c in evidence.items()])).select("cycle_id")


@query("referenced_union", """select l_partkey as blob from lineitem union select p_partkey from part""")
def referenced_union(spark, folder):
    return (load(spark, folder, "lineitem").select(F.col("l_partkey").alias("blob"))
            .union(load(spark, folder, "part").select("p_partkey")).distinct())


@query("orphan_blobs", """select c_custkey from customer where c_custkey not in (select o_custkey from orders)""")
def orphan_blobs(spark, folder):
    used = load(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return load(spark, folder, "customer").select("c_custkey").join(used, "c_custkey", "left_anti")


@query("reconcile", """select o_orderkey, 'missing' as status, '' as fields from orders where o_orderkey % 11 = 0
union all select o_orderkey + 1000000000, 'extra', '' from orders where o_orderkey % 13 = 0
union all select o_orderkey, 'changed', concat_ws(',', case when o_orderkey % 7 = 0 then 'o_orderstatus' end, case when o_orderkey % 5 = 0 then 'o_totalprice' end)
from orders where o_orderkey % 11 <> 0 and (o_orderkey % 7 = 0 or o_orderkey % 5 = 0)""")
def reconcile(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    key = F.col("o_orderkey")
    after = (orders.where(key % 11 != 0)
             .withColumn("o_orderstatus", F.when(key % 7 == 0, F.concat("o_orderstatus", F.lit("x"))).otherwise(F.col("o_orderstatus")))
             .withColumn("o_totalprice", F.when(key % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
             .unionByName(orders.where(key % 13 == 0).withColumn("o_orderkey", key + 1_000_000_000)))
    return ops.reconcile(orders, after, "o_orderkey")
