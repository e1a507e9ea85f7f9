"""Ingest family: windows, stamps, identities, inventory, prior cycles, recall."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import identity, text, times
from ..operators import ingest as ops
from ..operators.identity_merge import identity_components
from ..sources.json_records import strict_json
from ..tables import candidates, doc_records, event_log, load, spread, text_of
from .registry import query
from .views import CANDIDATES, DOC_RECORDS, EVENT_LOG


@query("daily_window", """select event_id, ts, user_id, event_type from events
where ts >= timestamp '2024-01-13 16:00:00' and ts < timestamp '2024-01-14 16:00:00'""")
def daily_window(spark, folder):
    return (load(spark, folder, "events").where(times.in_daily_window(F.col("ts"), "2024-01-15"))
            .select("event_id", "ts", "user_id", "event_type"))


@query("aware_ts", """with f as (
  select event_id, ts, event_id % 4 as k, concat(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
    case event_id % 4 when 0 then 'Z' when 1 then '+00:00' when 2 then '+08:00' else '' end) as stamp from events)
select event_id, stamp, k <> 3 as is_aware,
       case when k <> 3 then epoch_us(ts) - case when k = 2 then 28800000000 else 0 end end as epoch_us from f""")
def aware_ts(spark, folder):
    k = F.col("event_id") % 4
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                     F.when(k == 0, "Z").when(k == 1, "+00:00").when(k == 2, "+08:00").otherwise(""))
    rows = load(spark, folder, "events").select("event_id", stamp.alias("stamp"))
    instant = times.aware(F.col("stamp"))
    return rows.select("event_id", "stamp", instant.isNotNull().alias("is_aware"),
                       F.unix_micros(instant).alias("epoch_us"))


@query("cycle_assign", """select event_id, cast(ts + interval 8 hour as date) as display_date,
  concat('daily-', strftime(cast(ts + interval 8 hour as date), '%Y-%m-%d')) as cycle_id,
  cast(cast(ts + interval 8 hour as date) - interval 1 day as date) as source_day from events""")
def cycle_assign(spark, folder):
    day = times.display_date(F.col("ts"))
    return load(spark, folder, "events").select(
        "event_id", day.alias("display_date"), times.cycle_id(day).alias("cycle_id"),
        F.date_sub(day, 1).alias("source_day"))


STAMP_SQL = """with f as (select event_id, ts, epoch_us(ts) as us, event_id % 5 as k from events)
select event_id, case k
  when 0 then concat(strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S'), '+00:00')
  when 1 then concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'),
                     case when us % 1000000 = 0 then '' else strftime(ts, '.%f') end, '+00:00')
  when 2 then strftime(ts, '%Y-%m-%d') end as stamp from f"""


@query("stamp", STAMP_SQL)
def stamp(spark, folder):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = text_of(F.floor(us / F.lit(1_000_000)).cast("bigint"))
    k = F.col("event_id") % 5
    payload = (F.when(k == 0, seconds)
               .when(k == 1, F.concat(seconds, F.lit("."), F.lpad(text_of(us % 1_000_000), 6, "0")))
               .when(k == 2, F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"')))
               .when(k == 3, "true").otherwise('"  "'))
    return load(spark, folder, "events").select(
        "event_id", times.stamp(F.try_parse_json(payload)).alias("stamp"))


@query("source_identity", r"""with f as (
  select page_id, url, case page_id % 3
    when 0 then cast(json_object('source_urls', [url, concat(url, '-b'), url], 'canonical_url', concat(url, '-c'), 'source_identities', '') as varchar)
    when 1 then cast(json_object('title', html, 'url', url) as varchar)
    else concat(html, ' (see ', url, ') and <', url, '> again') end as content from pages),
u as (select page_id, case page_id % 3 when 0 then [url, concat(url, '-b'), concat(url, '-c')] when 1 then [url]
        else list_distinct(regexp_extract_all(content, 'https?://[^\s<>"\)\]\}]+')) end as urls, url,
        regexp_extract(content, 'https?://[^\s<>"\)\]\}]+') as first_url from f)
select page_id, case when page_id % 3 = 2 then first_url else url end as canonical_url, cast(len(urls) as bigint) as n_urls,
       array_to_string(list_sort(urls), ' ') as urls from u""")
def source_identity(spark, folder):
    k, url = F.col("page_id") % 3, F.col("url")
    content = (F.when(k == 0, F.to_json(F.struct(
        F.array(url, F.concat(url, F.lit("-b")), url).alias("source_urls"),
        F.concat(url, F.lit("-c")).alias("canonical_url"), F.lit("").alias("source_identities"))))
        .when(k == 1, F.to_json(F.struct(F.col("html").alias("title"), url.alias("url"))))
        .otherwise(F.concat(F.col("html"), F.lit(" (see "), url, F.lit(") and <"), url, F.lit("> again"))))
    urls = identity.identity_urls(content)
    return spread(load(spark, folder, "pages")).select("page_id", urls.alias("u")).select(
        "page_id", F.get("u", F.lit(0)).alias("canonical_url"), F.size("u").cast("bigint").alias("n_urls"),
        F.array_join(F.array_sort("u"), " ").alias("urls"))


@query("arxiv_id", r"""with f as (select doc_id, case doc_id % 4
    when 0 then ['https://example.org/x', concat('https://arxiv.org/abs/2401.', lpad(cast(doc_id % 100000 as varchar), 5, '0'), 'v2')]
    when 2 then [concat('http://arxiv.org/pdf/2403.', lpad(cast(doc_id % 100000 as varchar), 5, '0')), concat('https://arxiv.org/abs/2404.', lpad(cast(doc_id % 100000 as varchar), 5, '0'))]
    else [concat('https://example.org/', cast(doc_id as varchar))] end as urls,
  case when doc_id % 4 = 1 then concat('arxiv:2402.', lpad(cast(doc_id % 10000 as varchar), 4, '0'), 'v1') else concat('doc-', cast(doc_id as varchar)) end as candidate from documents)
select doc_id, list_filter(list_transform(list_append(urls, candidate),
    lambda u: regexp_extract(u, '(?:arxiv:|arxiv\.org/(?:abs|pdf)/)([0-9]{4}\.[0-9]{4,5})(?:v[0-9]+)?', 1)), lambda m: m <> '')[1] as normalized_id from f""")
def arxiv_id(spark, folder):
    doc, k = F.col("doc_id"), F.col("doc_id") % 4
    five = F.lpad(text_of(doc % 100_000), 5, "0")
    urls = (F.when(k == 0, F.array(F.lit("https://example.org/x"),
                                   F.concat(F.lit("https://arxiv.org/abs/2401."), five, F.lit("v2"))))
            .when(k == 2, F.array(F.concat(F.lit("http://arxiv.org/pdf/2403."), five),
                                  F.concat(F.lit("https://arxiv.org/abs/2404."), five)))
            .otherwise(F.array(F.concat(F.lit("https://example.org/"), text_of(doc)))))
    candidate = F.when(k == 1, F.concat(F.lit("arxiv:2402."), F.lpad(text_of(doc % 10_000), 4, "0"), F.lit("v1"))
                       ).otherwise(F.concat(F.lit("doc-"), text_of(doc)))
    return load(spark, folder, "documents").select(
        "doc_id", identity.preprint_id(urls, candidate).alias("normalized_id"))


@query("strict_json", """with f as (
  select event_id, case event_id % 5 when 0 then props when 1 then concat('{"k":', cast(event_id as varchar), ',"k":2}')
    when 2 then '{"k": NaN}' when 3 then concat('{"k": [', cast(value as varchar), ', null]}') else '{"k": ' end as payload
  from events),
v as (select event_id, json_valid(payload) and not contains(payload, 'NaN') and coalesce(len(json_keys(case when json_valid(payload) then payload end))
    = len(list_distinct(json_keys(case when json_valid(payload) then payload end))), false) as accepted from f)
select event_id, accepted, case when not accepted then 'rejected' end as quarantine_reason from v""")
def strict(spark, folder):
    event, k = F.col("event_id"), F.col("event_id") % 5
    payload = (F.when(k == 0, F.col("props"))
               .when(k == 1, F.concat(F.lit('{"k":'), text_of(event), F.lit(',"k":2}')))
               .when(k == 2, '{"k": NaN}')
               .when(k == 3, F.concat(F.lit('{"k": ['), text_of("value"), F.lit(", null]}")))
               .otherwise('{"k": '))
    good, bad = strict_json(load(spark, folder, "events").select("event_id", payload.alias("payload")), "payload")
    return (good.select("event_id", F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("quarantine_reason"))
            .unionByName(bad.select("event_id", F.lit(False).alias("accepted"), F.lit("rejected").alias("quarantine_reason"))))


@query("source_inventory", f"""with u as (
  select 'documents' as feed, source, doc_id as record_id, length(text) as n from documents
  union all select 'pages', regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), page_id, length(html) from pages
  union all select 'conversations', role, conv_id, length(text) from conversations),
c as (select feed, source, count(*) as records, count(*) filter (where n > 0) as valid_records,
             cast(sum(n) as bigint) as chars from u group by feed, source)
select feed, source, records, valid_records, chars,
  case when length(source) % 5 = 0 and feed = 'pages' then 'failed'
       when length(source) % 3 = 2 then 'partial' else 'complete' end as status from c""")
def source_inventory(spark, folder):
    docs = load(spark, folder, "documents").select(
        "source", F.col("doc_id").alias("record_id"), F.length("text").alias("body_chars"))
    pages = load(spark, folder, "pages").select(
        F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("source"), F.col("page_id").alias("record_id"),
        F.length("html").alias("body_chars"))
    talks = load(spark, folder, "conversations").select(
        F.col("role").alias("source"), F.col("conv_id").alias("record_id"), F.length("text").alias("body_chars"))
    feeds = {"documents": docs, "pages": pages, "conversations": talks}
    receipts = None
    for name, feed in feeds.items():
        size = F.length("source")
        failed = (size % 5 == 0) & F.lit(name == "pages")
        one = feed.select("source").distinct().select(
            F.lit(name).alias("feed"), "source", F.when(failed, 1).otherwise(0).alias("return_code"),
            F.when(failed, "failed").when(size % 3 == 2, "partial").when(size % 3 == 1, "success").alias("manifest_status"))
        receipts = one if receipts is None else receipts.unionByName(one)
    return ops.source_inventory(feeds, receipts)


@query("announcement_merge", f"""with {EVENT_LOG}
select source, event_key, min(ts) as first_seen, max(ts) as last_seen, count(*) as events,
       array_to_string(list_sort(list(distinct event_type)), ',') as types
from event_log group by source, event_key""")
def announcement_merge(spark, folder):
    merged = ops.merge_announcements(event_log(spark, folder), "source", "event_key", "ts", "event_type")
    return merged.withColumn("types", F.array_join("types", ","))


@query("duplicate_keys", """select sha256(text) as text_sha256, count(*) as copies, min(doc_id) as first_record
from documents group by text having count(*) > 1""")
def duplicate_keys(spark, folder):
    return ops.duplicate_keys(load(spark, folder, "documents"),
                              {"text_sha256": F.sha2(F.col("text").cast("binary"), 256)}, "doc_id")


PRIOR_SQL = f"""{CANDIDATES},
cycles as (select cycle_id, case when day(cycle_id) % 2 = 0 then 'Released' else 'PHASE_release' end as phase
           from (select distinct cycle_id from candidates)),
prior as (select cycle_id, phase, last_value(case when phase = 'Released' then cycle_id end ignore nulls)
            over (order by cycle_id rows between unbounded preceding and 1 preceding) as prior_cycle_id from cycles)"""


def weekly_cycles(spark, folder):
    return (candidates(spark, folder).select("cycle_id").distinct()
            .withColumn("phase", F.when(F.dayofmonth("cycle_id") % 2 == 0, "Released").otherwise("PHASE_release"))
            .withColumn("cycle_no", F.unix_date("cycle_id")))


@query("prior_asof", f"with {PRIOR_SQL} select *, prior_cycle_id is null as first_cycle from prior")
def prior_asof(spark, folder):
    return ops.prior_cycles(weekly_cycles(spark, folder)).drop("cycle_no")


@query("prior_exclusion", f"""with {PRIOR_SQL},
i as (select *, list_concat(case when source_key % 4 = 0 then [] else [concat('source-', cast(source_key as varchar)), concat('page-', cast(source_key * 7 + score as varchar))] end,
    [case when source_key % 3 = 0 then concat('arxiv-', cast(source_key * 5 as varchar)) end, concat('page-', cast(source_key * 7 + 61 as varchar))]) as ids from candidates)
select c.cycle_id, c.candidate_id, c.category from i c join prior p on c.cycle_id = p.cycle_id
where not exists (select 1 from i h where h.cycle_id = p.prior_cycle_id and (h.candidate_id = c.candidate_id
                  or list_has_any(list_filter(h.ids, lambda x: x is not null), c.ids)))""")
def prior_exclusion(spark, folder):
    """Identities of a candidate: a list of sources and pages that may be empty, a preprint id that may be NULL, and a canonical page."""
    rows = candidates(spark, folder).select("cycle_id", "candidate_id", "category", "source_key", "score")
    key = F.col("source_key")
    page = lambda number: F.concat(F.lit("page-"), text_of(key * 7 + number))
    listed = F.when(key % 4 != 0, F.array(F.concat(F.lit("source-"), text_of(key)), page(F.col("score"))))
    kept = ops.exclude_prior(rows, ops.prior_cycles(weekly_cycles(spark, folder)), {
        "candidate": [F.col("candidate_id")],
        "source": [listed, F.when(key % 3 == 0, F.concat(F.lit("arxiv-"), text_of(key * 5))), page(61)]})
    return kept.select("cycle_id", "candidate_id", "category")


@query("identity_merge", """with recursive k as (
  select doc_id, sha256(text) as key from documents
  union all select doc_id, concat(source, '/', cast(n_chars as varchar)) from documents),
reach as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, b.doc_id from reach r join k a on a.doc_id = r.other join k b on a.key = b.key),
comp as (select doc_id, min(other) as component from reach group by doc_id)
select c.component, d.source, count(*) as records, max(c.doc_id) as last_record
from comp c join documents d on c.doc_id = d.doc_id group by c.component, d.source""")
def identity_merge(spark, folder):
    """One row per object and source identity, so an object never has to list its sources in one place."""
    docs = load(spark, folder, "documents")
    keys = docs.select("doc_id", F.explode(F.array(
        F.sha2(F.col("text").cast("binary"), 256), F.concat("source", F.lit("/"), text_of("n_chars")))).alias("key"))
    merged = identity_components(keys, "doc_id", "key").join(docs.select("doc_id", "source"), "doc_id")
    return merged.groupBy("component", "source").agg(
        F.count(F.lit(1)).alias("records"), F.max("doc_id").alias("last_record"))


@query("category_recall", """with f as (
  select p_partkey, ['cs.RO','cs.AI','cs.CV','cs.LG','cs.CL','cs.MA','eess.SY','stat.ML','math.OC','physics.optics'] as s,
         p_size % 10 + 1 as a, p_partkey % 10 + 1 as b from part)
select p_partkey, concat(s[a], ' ', s[b]) as categories, a <= 7 or b <= 7 as recalled from f""")
def category_recall(spark, folder):
    names = F.array(*[F.lit(s) for s in (*rules.SUBJECTS, "stat.ML", "math.OC", "physics.optics")])
    cats = F.array(F.element_at(names, (F.col("p_size") % 10 + 1).cast("int")),
                   F.element_at(names, (F.col("p_partkey") % 10 + 1).cast("int")))
    return load(spark, folder, "part").select("p_partkey", cats.alias("c")).select(
        "p_partkey", F.array_join("c", " ").alias("categories"),
        identity.category_recall(F.col("c"), rules.SUBJECTS).alias("recalled"))


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def topic_sql() -> str:
    every = sorted({t.lower() for terms in rules.TOPIC_TERMS.values() for t in terms})
    count = " + ".join(f"cast(contains(t, {sql_text(term)}) as int)" for term in every)
    cases = []
    for group, terms in rules.TOPIC_TERMS.items():
        words = " or ".join(f"contains(t, {sql_text(x.lower())})" for x in terms if x not in rules.ACRONYMS)
        short = " or ".join(f"contains(t, {sql_text(x.lower())})" for x in terms if x in rules.ACRONYMS) or "false"
        cases.append(f"case when ({words}) or (({short}) and (hit or n >= 2)) then '{group}' end")
    return f"""with f as (select doc_id, lower(text) as t, doc_id % 7 = 0 as hit from documents
  union all select -1, 'vla only', false union all select -2, 'vla policy with drone', false
  union all select -3, '具身智能与世界模型', false union all select -4, 'an llm paper', true),
c as (select *, {count} as n from f)
select doc_id, concat_ws(',', {", ".join(cases)}) as topic_groups from c"""


@query("topic_recall", topic_sql())
def topic_recall(spark, folder):
    known = spark.createDataFrame([(-1, "VLA only", False), (-2, "VLA policy with drone", False),
                                   (-3, "具身智能与世界模型", False), (-4, "An LLM paper", True)],
                                  "doc_id bigint, text string, hit boolean")
    docs = load(spark, folder, "documents").select("doc_id", "text", (F.col("doc_id") % 7 == 0).alias("hit"))
    return spread(docs).unionByName(known).select(
        "doc_id", F.array_join(text.topic_groups(F.col("text"), F.col("hit")), ",").alias("topic_groups"))


@query("recall_monitor", f"""with {DOC_RECORDS},
f as (select source, lang, quality = 1 as relevant, contains(lower(text), 'tion') as b,
             contains(lower(text), 'tion') or contains(lower(text), 'ung') as a from doc_records)
select source, lang, count(*) filter (where b) as before_candidates,
  count(*) filter (where relevant and not b) as before_misses,
  count(*) filter (where not relevant and b) as before_irrelevant,
  count(*) filter (where a) as after_candidates, count(*) filter (where relevant and not a) as after_misses,
  count(*) filter (where not relevant and a) as after_irrelevant,
  round(count(*) filter (where not relevant and b) / nullif(count(*) filter (where relevant is not null and b), 0), 6) as before_irrelevant_share,
  round(count(*) filter (where not relevant and a) / nullif(count(*) filter (where relevant is not null and a), 0), 6) as after_irrelevant_share
from f group by source, lang""")
def recall_monitor(spark, folder):
    docs = doc_records(spark, folder, "source", "lang", "text", "quality")
    lowered = F.lower("text")
    flagged = docs.select("source", "lang", (F.col("quality") == 1).alias("relevant"),
                          lowered.contains("tion").alias("b"),
                          (lowered.contains("tion") | lowered.contains("ung")).alias("a"))
    return ops.recall_monitor(flagged, ["source", "lang"], F.col("b"), F.col("a"), F.col("relevant"))
