"""Output family: nested exports, pages, frozen envelopes, manifests, the idempotent sink."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import running_sums
from ..session import pinned_folder
from ..sources import publication as pub
from ..sources.history import History
from ..sources.json_records import parse_export
from ..tables import doc_records, event_log, load, text_of
from .registry import query
from .selection_queries import selected
from .views import DOC_RECORDS, EVENT_LOG, SELECTION


@query("nested_scan", """select 'customer' as table_name, c_custkey as row_id, c_name as name, c_acctbal as amount, cast(null as bigint) as ref from customer
union all select 'orders', o_orderkey, o_orderpriority, o_totalprice, o_custkey from orders""")
def nested_scan(spark, folder):
    """Customers and orders packed into export envelopes of at most 1,000 consecutive ids, and read back."""
    rows = (load(spark, folder, "customer").select(
        F.lit("customer").alias("t"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("amount"), F.lit(None).cast("bigint").alias("ref"))
        .unionByName(load(spark, folder, "orders").select(
            F.lit("orders").alias("t"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"),
            F.col("o_totalprice").alias("amount"), F.col("o_custkey").alias("ref"))))
    record = F.struct("id", F.struct("name", "amount", "ref").alias("fields"))
    packed = rows.groupBy(F.expr("id div 1000").alias("chunk")).agg(
        F.collect_list(F.when(F.col("t") == "customer", record)).alias("customer"),
        F.collect_list(F.when(F.col("t") == "orders", record)).alias("orders"))
    envelope = F.to_json(F.struct(
        F.struct(F.struct(F.col("customer").alias("records")).alias("customer"),
                 F.struct(F.col("orders").alias("records")).alias("orders")).alias("tables"),
        F.lit("{}").alias("columns"), F.array().cast("array<string>").alias("attachments"),
        F.array().cast("array<string>").alias("attachment_failures")))
    fields = T.StructType([T.StructField("name", T.StringType()), T.StructField("amount", T.DoubleType()),
                           T.StructField("ref", T.LongType())])
    tables = parse_export(packed.select(envelope.alias("value")), "value", {"customer": fields, "orders": fields})
    return (tables["customer"].withColumn("table_name", F.lit("customer"))
            .unionByName(tables["orders"].withColumn("table_name", F.lit("orders"))))


SPACE = r"[ \t\n\r\x0b\x0c]"


@query("render_pages", rf"""with {DOC_RECORDS},
r as (select *, row_number() over (partition by source, category order by doc_id) as rk,
        cast(date '2024-01-01' + cast(doc_id % 30 as integer) as date) as day from doc_records),
p as (select candidate_id, category, day as display_date, concat('docs/daily/', strftime(day, '%Y-%m-%d'), '/', lower(category), '/',
   case when rk < 10 then '0' else '' end, cast(rk as varchar), '-', sha256(concat('"', candidate_id, '"'))[1:16], '.md') as path,
  concat('---', chr(10), 'schemaVersion: 3', chr(10), 'candidateId: "', candidate_id, '"', chr(10), 'date: "', strftime(day, '%Y-%m-%d'), '"', chr(10),
   'category: "', category, '"', chr(10), 'groupRank: ', cast(rk as varchar), chr(10), 'title: "', path, '"', chr(10), '---', chr(10), chr(10),
   regexp_replace(regexp_replace(text, '^{SPACE}+', ''), '{SPACE}+$', ''), chr(10)) as content from r)
select candidate_id, category, display_date, path, md5(content) as content_md5, cast(octet_length(encode(content)) as bigint) as bytes from p""")
def render_pages(spark, folder):
    docs = doc_records(spark, folder, "doc_id", "candidate_id", "source", "category", "path", "text")
    # ranks are computed without the text, which is attached afterwards by key
    ranks = running_sums(docs.select("doc_id", "source", "category"), ["source", "category"], [F.col("doc_id")],
                         {"group_rank": F.lit(1)}).select("doc_id", "group_rank")
    records = docs.join(ranks, "doc_id").select(
        "candidate_id", "category", "group_rank", F.col("path").alias("title"), F.col("text").alias("body"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("display_date"))
    return pub.render_pages(records).select(
        "candidate_id", "category", "display_date", "path", F.md5(F.col("content").cast("binary")).alias("content_md5"), "bytes")


PATH_SQL = """concat('docs/daily/', strftime(cycle_id, '%Y-%m-%d'), '/', lower(category), '/', case when group_rank < 10 then '0' else '' end,
  cast(group_rank as varchar), '-', sha256(concat('"', candidate_id, '"'))[1:16], '.md')"""


@query("page_path", f"with {SELECTION} select cycle_id, candidate_id, {PATH_SQL} as path from selection")
def page_path(spark, folder):
    return selected(spark, folder).select("cycle_id", "candidate_id", pub.page_path(
        F.col("cycle_id"), F.col("category"), F.col("group_rank"), F.col("candidate_id")).alias("path"))


@query("frozen_export", f"""with {SELECTION},
e as (select cycle_id, count(*) as records, concat('{{"cycle_id":"', cast(cycle_id as varchar), '","records":[',
  string_agg(concat('{{"candidate_id":"', candidate_id, '","category":"', category, '","group_rank":', cast(group_rank as varchar), ',"score":',
    cast(score as varchar), '}}'), ',' order by case category when 'Paper' then 1 when 'News' then 2 else 3 end, group_rank), ']}}') as envelope
  from selection group by cycle_id)
select cycle_id, records, sha256(envelope) as frozen_sha256, case when day(cycle_id) % 6 = 0 then 'changed' else 'ok' end as verdict from e""")
def frozen_export(spark, folder):
    exports = pub.freeze(selected(spark, folder))
    digest = F.col("frozen_sha256")
    stored = exports.select("cycle_id", F.when(F.dayofmonth("cycle_id") % 6 == 0, F.concat(digest, F.lit("-old")))
                            .otherwise(digest).alias("frozen_sha256"))
    verdicts = pub.verify_frozen(exports, stored).select("cycle_id", "verdict")
    return exports.drop("envelope").join(verdicts, "cycle_id")


@query("managed_manifest", f"""with {SELECTION},
p as (select cycle_id, category, group_rank, {PATH_SQL} as path, score as bytes from selection),
g as (select cycle_id, category, concat(category, '[', string_agg(concat(cast(group_rank as varchar), ':', path, ':', cast(bytes as varchar)), ' ' order by group_rank), ']') as grp,
  sum(bytes) as bytes from p group by cycle_id, category)
select cycle_id, string_agg(grp, ' ' order by case category when 'Paper' then 1 when 'News' then 2 else 3 end) as manifest, cast(sum(bytes) as bigint) as bytes
from g group by cycle_id""")
def managed_manifest(spark, folder):
    pages = selected(spark, folder).select("cycle_id", "category", "group_rank", F.col("score").alias("bytes"), pub.page_path(
        F.col("cycle_id"), F.col("category"), F.col("group_rank"), F.col("candidate_id")).alias("path"))
    return pub.managed_manifest(pages)


@query("idempotent_sink", f"""with {EVENT_LOG},
o as (select source, concat('op-', cast(seq // 2 as varchar)) as operation_id, seq, value, case when extract(day from ts) <= 16 then 1 else 0 end as b1,
  case when extract(day from ts) >= 15 then 1 else 0 end as b2 from event_log),
f as (select source, operation_id, min(seq) as seq, 1 as batch from o where b1 = 1 group by source, operation_id),
s as (select source, operation_id, min(seq) as seq, 2 as batch from o where b2 = 1 group by source, operation_id)
select source, operation_id, seq, batch from f union all
select s.* from s anti join f on s.source = f.source and s.operation_id = f.operation_id""")
def idempotent_sink(spark, folder):
    """Two overlapping batches of one month go through the sink, the first one twice; the second must append only what the first did not commit."""
    rows = event_log(spark, folder).select(
        "source", F.concat(F.lit("op-"), text_of(F.floor(F.col("seq") / 2).cast("bigint"))).alias("operation_id"), "seq", "ts")
    day = F.dayofmonth("ts")
    first, second = rows.where(day <= 16).drop("ts"), rows.where(day >= 15).drop("ts")
    history = History(spark, f"{pinned_folder(spark)}/operations-{uuid.uuid4().hex}", first.schema, ["source", "operation_id"], "seq", digits=1)
    write = history.sink()
    for batch, number in ((first, 1), (first, 1), (second, 2)):
        write(batch, number)
    return history.rows().withColumn("batch", F.col("batch").cast("int"))
