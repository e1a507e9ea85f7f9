"""Tree family: publications written as documents and read back, snapshots, nested exports read in blocks."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merkle import Snapshot, differences
from ..session import pinned, pinned_folder
from ..sources import publication as pub
from ..sources import tree
from ..sources.export_reader import Export, reference_problems
from ..tables import load, text_of
from .output_queries import PATH_SQL
from .registry import query
from .selection_queries import selected
from .views import SELECTION


def folder_for(spark, name: str) -> str:
    return f"{pinned_folder(spark)}/{name}-{uuid.uuid4().hex}"


def publication(spark, folder):
    """The selection as records to publish: a body from the order, and a preview for papers, drawn from the customer."""
    customers = load(spark, folder, "customer").select(F.col("c_custkey").alias("source_key"), F.col("c_name").alias("_name"))
    image = F.concat(F.lit("<svg><title>"), "_name", F.lit("</title></svg>"))
    paper = F.col("category") == "Paper"
    return selected(spark, folder).join(customers, "source_key", "left").select(
        "cycle_id", "candidate_id", "category", "group_rank", F.concat(F.lit('Report "'), text_of("source_key"), F.lit('"')).alias("title"),
        F.concat(F.lit("  Score "), text_of("score"), F.lit(" · é\n\n")).alias("body"), F.when(paper, F.encode(image, "utf-8")).alias("preview"),
        F.when(paper, "svg").alias("extension"))


DOCUMENTS_SQL = f"""{SELECTION},
rec as (select cycle_id, strftime(cycle_id, '%Y-%m-%d') as day, candidate_id, category, group_rank, score, source_key, {PATH_SQL} as path,
  case category when 'Paper' then 1 when 'News' then 2 else 3 end as o,
  case when category = 'Paper' then '<svg><title>' || c_name || '</title></svg>' end as image,
  case when category = 'Paper' and c_name is not null then 'docs/public/daily/' || strftime(cycle_id, '%Y-%m-%d') || '/assets/' || candidate_id || '/preview.svg' end as image_path
  from selection left join customer on c_custkey = source_key),
page as (select *, concat('---', chr(10), 'schemaVersion: 3', chr(10), 'candidateId: "', candidate_id, '"', chr(10), 'date: "', day, '"', chr(10), 'category: "', category, '"', chr(10),
  'groupRank: ', cast(group_rank as varchar), chr(10), 'title: "Report \\"', cast(source_key as varchar), '\\""', chr(10),
  'previewImage: ', case when image_path is null then 'null' else '"/' || substr(image_path, 13) || '"' end, chr(10), '---', chr(10), chr(10),
  'Score ', cast(score as varchar), ' · é', chr(10)) as content from rec),
sized as (select *, octet_length(encode(content)) as bytes, octet_length(encode(image)) as image_bytes from page),
line as (select *, concat('{{"candidate_id":"', candidate_id, '","group_rank":', cast(group_rank as varchar), ',"path":"', path, '","bytes":', cast(bytes as varchar), '}}') as line,
  case when image_path is not null then concat('{{"candidate_id":"', candidate_id, '","path":"', image_path, '","bytes":', cast(image_bytes as varchar), '}}') end as asset from sized),
manifest as (select day, concat('{{"cycle_id":"', day, '","groups":{{"Paper":[', coalesce(string_agg(line, ',' order by group_rank) filter (where o = 1), ''),
  '],"News":[', coalesce(string_agg(line, ',' order by group_rank) filter (where o = 2), ''), '],"Policy":[', coalesce(string_agg(line, ',' order by group_rank) filter (where o = 3), ''),
  ']}},"assets":[', coalesce(string_agg(asset, ',' order by o, group_rank) filter (where asset is not null), ''), ']}}', chr(10)) as content from line group by day),
documents_ as (select 'page' as kind, path, content from page union all select 'media', image_path, image from page where image_path is not null
  union all select 'manifest', concat('docs/daily/', day, '/.managed-manifest.json'), content from manifest)"""


@query("page_tree", f"""with {DOCUMENTS_SQL}
select kind, path, octet_length(encode(content)) as bytes, sha256(content) as sha256, 'ok' as verdict from documents_""")
def page_tree(spark, folder):
    """The selection published as files (pages, previews, a manifest for each cycle), read back file by file."""
    site = folder_for(spark, "site")
    documents = pinned(pub.publication_documents(publication(spark, folder)))
    manifest = tree.write_tree(documents, site)
    kinds = documents.select("path", "kind")
    return tree.read_back(manifest, site).join(kinds, "path").select("kind", "path", F.col("found_bytes").alias("bytes"), F.col("found_sha256").alias("sha256"), "verdict")


@query("snapshot_restore", f"""with {DOCUMENTS_SQL},
n as (select kind, path, content, ('0x' || sha256(path)[1:7])::bigint as mark from documents_),
kept as (select path, sha256(content) as wanted, case when mark % 7 = 0 then sha256(content || 'x') when mark % 11 <> 0 then sha256(content) end as found from n)
select path, case when found is null then 'missing' when found = wanted then 'ok' else 'changed' end as verdict from kept
union all select concat('docs/stray/', md5(path)), 'stray' from n where mark % 13 = 0""")
def snapshot_restore(spark, folder):
    """A snapshot's manifest against a restored tree in which files were changed, left out and added."""
    documents = pinned(pub.publication_documents(publication(spark, folder)).select("path", "content"))
    snapshot, restored = folder_for(spark, "snapshot"), folder_for(spark, "restored")
    manifest = tree.write_tree(documents, snapshot)
    mark = F.conv(F.substring(F.sha2(F.encode("path", "utf-8"), 256), 1, 7), 16, 10).cast("bigint")
    changed = F.when(mark % 7 == 0, F.concat("content", F.encode(F.lit("x"), "utf-8"))).otherwise(F.col("content"))
    kept = documents.where((mark % 7 == 0) | (mark % 11 != 0)).select("path", changed.alias("content"))
    stray = documents.where(mark % 13 == 0).select(F.concat(F.lit("docs/stray/"), F.md5(F.encode("path", "utf-8"))).alias("path"), "content")
    now = tree.write_tree(kept.unionByName(stray), restored)
    return (tree.read_back(manifest, restored).select("path", "verdict")
            .unionByName(now.join(manifest.select("path"), "path", "left_anti").select("path", F.lit("stray").alias("verdict"))))


#: ids in one export file, bytes in a block, and of how many orders one has an attachment
FILE_IDS, BLOCK_BYTES, ATTACHED = 5000, 1 << 18, 50


def written_export(spark, folder) -> tuple[str, str]:
    """Customers and orders as export files, with columns' metadata and attachments; some references dangle, some files are missing or of another size."""
    key = F.col("o_orderkey")
    attached, listed = key % ATTACHED == 0, lambda *ids: F.concat(F.lit('["L"'), *[F.concat(F.lit(","), text_of(i)) for i in ids], F.lit("]"))
    cell = (F.when(key % (3 * ATTACHED) == 0, listed(key, key + 1)).when(attached, listed(key)).when(key % 10 == 1, '""').when(key % 10 == 2, "null")
            .when(key % 10 == 3, F.concat(F.lit('"old \\" {text '), text_of(key), F.lit('"'))).otherwise(listed()))
    customer = F.when(key % 40 == 0, F.col("o_custkey") + 1_000_000_000).when(key % 41 == 0, 0).otherwise(F.col("o_custkey"))
    path = F.concat(F.lit("files/"), text_of(F.expr(f"o_orderkey div {FILE_IDS}")), F.lit("/"), text_of(key), F.lit(".bin"))
    body = F.encode(F.repeat(F.col("o_orderpriority"), (key % 5).cast("int") + 1), "utf-8")
    size = F.octet_length(body).cast("bigint") + F.when(key % (7 * ATTACHED) == 0, 1).otherwise(0)
    orders = load(spark, folder, "orders").select(
        F.expr(f"o_orderkey div {FILE_IDS}").alias("part"), F.struct(key.alias("id"), F.struct(
            F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("amount"), customer.alias("ref"), F.parse_json(cell).alias("preview")).alias("fields")).alias("row"),
        F.when(attached, F.struct(key.alias("id"), path.alias("path"), size.alias("bytes"), F.struct(key.alias("id"), F.struct(size.alias("fileSize")).alias("fields")).alias("metadata"))).alias("file"))
    customers = load(spark, folder, "customer").select(F.expr(f"c_custkey div {FILE_IDS}").alias("part"), F.struct(
        F.col("c_custkey").alias("id"), F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")).alias("fields")).alias("row"))
    # a part holds FILE_IDS ids at most
    parts = (orders.groupBy("part").agg(F.collect_list("row").alias("orders"), F.collect_list("file").alias("files"))
             .join(customers.groupBy("part").agg(F.collect_list("row").alias("customers")), "part", "full"))
    columns = {"customer": [("name", "Text")], "orders": [("name", "Text"), ("ref", "Ref:customer"), ("preview", "Attachments"), ("amount", "Number")]}
    described = F.lit("{" + ",".join('"%s":{"columns":[%s]}' % (t, ",".join('{"id":"%s","fields":{"type":"%s"}}' % c for c in cs)) for t, cs in columns.items()) + "}")
    array = lambda c: F.coalesce(F.to_json(c), F.lit("[]"))
    text = F.concat(F.lit('{"tables":{"customer":{"records":'), array("customers"), F.lit('},"orders":{"records":'), array("orders"), F.lit('}},"columns":'), described,
                    F.lit(',"attachments":'), array("files"), F.lit(',"attachment_failures":[]}\n'))
    where = folder_for(spark, "export")
    exports = parts.select(F.concat(F.lit("exports/part-"), text_of("part"), F.lit(".json")).alias("path"), F.encode(text, "utf-8").alias("content"))
    files = load(spark, folder, "orders").where(attached & (key % (11 * ATTACHED) != 0)).select(path.alias("path"), body.alias("content"))
    tree.write_tree(exports.unionByName(files), where)
    return f"{where}/exports", where


FIELDS = T.StructType([T.StructField("name", T.StringType()), T.StructField("amount", T.DoubleType()), T.StructField("ref", T.LongType())])


@query("export_scan", f"""select 'customer' as table_name, c_custkey as row_id, c_name as name, c_acctbal as amount, cast(null as bigint) as ref, cast(null as varchar) as verdict from customer
union all select 'orders', o_orderkey, o_orderpriority, o_totalprice, case when o_orderkey % 40 = 0 then o_custkey + 1000000000 when o_orderkey % 41 = 0 then 0 else o_custkey end, null from orders
union all select 'attachments', o_orderkey, concat('files/', cast(o_orderkey // {FILE_IDS} as varchar), '/', cast(o_orderkey as varchar), '.bin'),
  cast(length(o_orderpriority) * (o_orderkey % 5 + 1) + case when o_orderkey % {7 * ATTACHED} = 0 then 1 else 0 end as double), null,
  case when o_orderkey % {11 * ATTACHED} = 0 then 'missing' when o_orderkey % {7 * ATTACHED} = 0 then 'other size' else 'ok' end from orders where o_orderkey % {ATTACHED} = 0""")
def export_scan(spark, folder):
    """Nested export files read in blocks by many tasks: typed tables, and attachments held against their files."""
    path, where = written_export(spark, folder)
    export = Export(spark, path, BLOCK_BYTES)
    tables = [export.table(name, FIELDS).select(F.lit(name).alias("table_name"), "row_id", "name", "amount", "ref", F.lit(None).cast("string").alias("verdict")) for name in ("customer", "orders")]
    files = export.attachment_verdicts(where).select(F.lit("attachments").alias("table_name"), F.col("id").alias("row_id"), F.col("path").alias("name"),
                                                     F.col("bytes").cast("double").alias("amount"), F.lit(None).cast("bigint").alias("ref"), "verdict")
    return tables[0].unionByName(tables[1]).unionByName(files)


@query("typed_references", f"""with cells as (
  select 'ref' as column_name, case when o_orderkey % 40 = 0 then o_custkey + 1000000000 when o_orderkey % 41 = 0 then 0 else o_custkey end as k, null as problem, '' as target from orders
  union all select 'preview', case when o_orderkey > 0 then o_orderkey end, case when o_orderkey = 0 then 'malformed' end, '@' from orders where o_orderkey % {ATTACHED} = 0
  union all select 'preview', o_orderkey + 1, null, '@' from orders where o_orderkey % {3 * ATTACHED} = 0 and o_orderkey > 0
  union all select 'preview', null, 'anomaly', '@' from orders where o_orderkey % 10 = 3),
judged as (select *, coalesce(problem, case when target = '' and k <> 0 and k not in (select c_custkey from customer) then 'dangling'
  when target = '@' and k not in (select o_orderkey from orders where o_orderkey % {ATTACHED} = 0) then 'dangling' end) as p from cells)
select 'orders' as source_table, column_name, k as missing_key, p as problem, count(*) as "references" from judged where p is not null group by all""")
def typed_references(spark, folder):
    """References as the exported columns' metadata declares them, held against the exported ids and attachments."""
    path, _ = written_export(spark, folder)
    return reference_problems(Export(spark, path, BLOCK_BYTES))


@query("ordered_reconcile", """with b as (select l_orderkey, l_linenumber as position, l_partkey, l_quantity from lineitem),
a as (select l_orderkey, case when l_orderkey % 211 = 3 and position in (1, 2) then 3 - position else position end as position,
    case when l_orderkey % 199 = 2 and position = 1 then l_partkey + 1 else l_partkey end as l_partkey, l_quantity from b where l_orderkey % 197 <> 1
  union all select l_orderkey + 1000000000, 1, 1, 1.0 from b where l_orderkey % 223 = 4 and position = 1
  union all select * from b where l_orderkey % 227 = 5 and position = 2 and l_orderkey % 197 <> 1 and l_orderkey % 211 <> 3),
n as (select l_orderkey, position, l_partkey, l_quantity, sum(s) as net, count(distinct s) as sides from (select *, -1 as s from b union all select *, 1 from a) group by all having net <> 0),
k as (select l_orderkey, position, cast(sum(case when net < 0 then -net else 0 end) as bigint) as gone, cast(sum(case when net > 0 then net else 0 end) as bigint) as come, min(sides) as least,
  max(l_partkey) filter (where net < 0) as p0, max(l_partkey) filter (where net > 0) as p1, max(l_quantity) filter (where net < 0) as q0, max(l_quantity) filter (where net > 0) as q1
  from n group by l_orderkey, position)
select l_orderkey, position, gone, come, case when gone = 1 and come = 1 and least = 1 then 'changed' when least > 1 then 'repeats' when come = 0 then 'missing' when gone = 0 then 'extra' else 'mixed' end as status,
  case when gone = 1 and come = 1 and least = 1 then concat_ws(',', case when p0 is distinct from p1 then 'l_partkey' end, case when q0 is distinct from q1 then 'l_quantity' end) else '' end as fields from k""")
def ordered_reconcile(spark, folder):
    """Two snapshots of an ordered relation: rows lost, changed, added, repeated, and positions that changed places."""
    key, place = F.col("l_orderkey"), F.col("position")
    lines = load(spark, folder, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("position"), "l_partkey", "l_quantity")
    kept = lines.where(key % 197 != 1)
    after = kept.select("l_orderkey", F.when((key % 211 == 3) & place.isin(1, 2), 3 - place).otherwise(place).alias("position"),
                        F.when((key % 199 == 2) & (place == 1), F.col("l_partkey") + 1).otherwise(F.col("l_partkey")).alias("l_partkey"), "l_quantity")
    more = lines.where((key % 223 == 4) & (place == 1)).select((key + 1_000_000_000).alias("l_orderkey"), F.lit(1).alias("position"), F.lit(1).cast("bigint").alias("l_partkey"), F.lit(1.0).alias("l_quantity"))
    again = kept.where((key % 227 == 5) & (place == 2) & (key % 211 != 3))
    keys = ["l_orderkey", "position"]
    sides = [(lines, folder_for(spark, "before")), (after.unionByName(more).unionByName(again), folder_for(spark, "after"))]
    # neither snapshot waits for the other's last tasks
    with ThreadPoolExecutor(len(sides)) as pool:
        snapshots = list(pool.map(inheritable_thread_target(spark)(lambda side: Snapshot.write(*side, keys)), sides))
    return differences(*snapshots)
