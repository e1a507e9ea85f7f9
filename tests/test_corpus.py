import hashlib
import json
import random
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressledger.operators import fingerprints as fp
from pressledger.operators.corpus import broken_links, joined_texts, local_links
from pressledger.operators.identity_merge import identity_components
from pressledger.sources import files, publication
from pressledger.sources.json_records import read_nested_export, strict_json


def components(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    by_key = {}
    for record, key in pairs:
        find(record)
        if key in by_key:
            a, b = sorted((find(record), find(by_key[key])))
            parent[b] = a
        by_key[key] = record
    return {r: find(r) for r, _ in pairs}


@pytest.mark.parametrize("make", [
    lambda: [(i, f"k{j}") for i in range(60) for j in (i, i + 1)],                      # one long chain
    lambda: [(i, "hot") for i in range(40)] + [(i, f"p{i // 2}") for i in range(80)],   # a key held by half of the records
    lambda: [(r, f"k{random.Random(r * 7 + j).randrange(90)}") for r in range(80) for j in range(2)]])
def test_identity_components(spark, make):
    pairs = make()
    df = spark.createDataFrame(pairs, "record bigint, key string").repartition(4)
    assert {r.record: r.component for r in identity_components(df, "record", "key").collect()} == components(pairs)


def test_records_without_keys_stay_alone(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "a")], "record bigint, key string")
    assert {r.record: r.component for r in identity_components(df, "record", "key").collect()} == {1: 1, 2: 2, 3: 2}


def tree_digest(entries):
    total = hashlib.sha256()
    for name, data in sorted(entries, key=lambda e: PurePosixPath(e[0])):
        raw = name.encode()
        total.update(str(len(raw)).encode() + b":" + raw + hashlib.sha256(data).digest())
    return total.hexdigest()


ENTRIES = [("a/b.txt", b"1"), ("a.txt", b"2"), ("a/é.md", b"3"), ("a-b/c", b""), ("z", b"5")]


def levelled(entries):
    """The digest by its definition: leaves by six hex digits of the path's hash, nodes by three, then the root."""
    leaves, nodes = {}, {}
    for name, data in entries:
        leaves.setdefault(hashlib.sha256(name.encode()).hexdigest()[:6], []).append((name, data))
    for leaf in sorted(leaves):
        nodes.setdefault(leaf[:3], []).append(leaf.encode() + bytes.fromhex(tree_digest(leaves[leaf])))
    return hashlib.sha256(b"".join(n.encode() + hashlib.sha256(b"".join(nodes[n])).digest() for n in sorted(nodes))).hexdigest()


def test_tree_fingerprint_has_one_definition(spark):
    many = [(f"d{i % 7}/f{i}", str(i).encode()) for i in range(3000)]
    rows = [(g, n, hashlib.sha256(d).hexdigest(), len(d)) for g, e in (("g", ENTRIES), ("h", [("x", b"x")]), ("m", many)) for n, d in e]
    df = spark.createDataFrame(rows, "g string, path string, sha string, size bigint").repartition(5)
    got = {r.g: r for r in fp.tree_fingerprints(df, "g", "path", "sha", "size").collect()}
    assert {g: r.fingerprint for g, r in got.items()} == {"g": levelled(ENTRIES), "h": levelled([("x", b"x")]), "m": levelled(many)}
    assert (got["g"].files, got["g"].bytes, got["m"].files) == (5, 4, 3000)


def test_binary_and_text_trees(spark, tmp_path):
    for name, data in {"a/x.md": b"text", "a/y.bin": b"\x00\x01", "node_modules/z.md": b"no", "w.lock": b"l", "manifest.json": b"{}"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    inventory = files.binary_inventory(spark, str(tmp_path), "manifest.json")
    assert {r.path: (r.sha256, r.size) for r in inventory.collect()} == {
        n: (hashlib.sha256(d).hexdigest(), len(d)) for n, d in (("a/x.md", b"text"), ("a/y.bin", b"\x00\x01"), ("node_modules/z.md", b"no"))}
    receipt = files.inventory_receipt(inventory).first()
    assert (receipt.files, receipt.bytes, receipt.within_limits) == (3, 8, True)
    assert {r.path for r in files.read_text_tree(spark, str(tmp_path)).collect()} == {"a/x.md", "manifest.json"}


def test_content_store_keeps_one_blob_per_content(spark, tmp_path):
    folder = str(tmp_path / "store")
    for batch in (["a", "b", "a"], ["b", "c"]):
        files.write_content_store(spark.createDataFrame([(t,) for t in batch], "t string"), "t", folder)
    stored = files.read_content_store(spark, folder).collect()
    assert sorted(bytes(r.content) for r in stored) == [b"a", b"b", b"c"]
    assert all(r.sha256 == hashlib.sha256(bytes(r.content)).hexdigest() for r in stored)


FIELDS = {"Publish": T.StructType([T.StructField("CycleID", T.StringType())]),
          "Records": T.StructType([T.StructField("Publish", T.LongType()), T.StructField("Title", T.StringType())])}


def export(**changes):
    return {"tables": {"Publish": {"records": [{"id": 7, "fields": {"CycleID": "c"}}]},
                       "Records": {"records": [{"id": 10, "fields": {"Publish": 7, "Title": "t"}}, {"id": 11, "fields": {"Publish": 7}}]}},
            "columns": {}, "attachments": [], "attachment_failures": [], **changes}


def test_nested_export(spark, tmp_path):
    (tmp_path / "ok.json").write_text(json.dumps(export(), indent=1))
    tables = read_nested_export(spark, str(tmp_path / "ok.json"), FIELDS)
    assert [tuple(r) for r in tables["Records"].orderBy("row_id").collect()] == [(10, 7, "t"), (11, 7, None)]
    assert tables["Publish"].collect()[0].CycleID == "c"
    for name, changes in {"failures": {"attachment_failures": ["x"]}, "extra": {"more": 1}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(export(**changes)))
        with pytest.raises(Exception, match="attachment failures|envelope"):
            read_nested_export(spark, str(tmp_path / f"{name}.json"), FIELDS)["Records"].collect()


def test_strict_json(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"a":1,"a":2}',), ('{"a":NaN}',), ("{",)], "j string")
    good, bad = strict_json(df, "j")
    assert good.count() == 1 and bad.count() == 3


def test_ledger_sink_ignores_replays(spark, tmp_path):
    sink = publication.ledger_sink(str(tmp_path / "ledger"), ["source", "op"], "seq")
    first = spark.createDataFrame([("s", "1", 0, "a"), ("s", "2", 1, "b"), ("s", "1", 2, "late")], "source string, op string, seq bigint, v string")
    second = spark.createDataFrame([("s", "2", 3, "again"), ("s", "3", 4, "c")], "source string, op string, seq bigint, v string")
    for batch_id, batch in enumerate((first, first, second)):
        sink(batch, batch_id)
    rows = spark.read.parquet(str(tmp_path / "ledger")).collect()
    assert sorted((r.op, r.v) for r in rows) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_pages_and_frozen_exports(spark):
    df = spark.createDataFrame([("c-1", "2024-01-02", "Paper", 3, 'a "title"', "  body\n\n")], "candidate_id string, d string, category string, group_rank int, title string, body string")
    page = publication.render_pages(df.withColumn("display_date", F.col("d").cast("date"))).first()
    assert page.path == f"docs/daily/2024-01-02/paper/03-{hashlib.sha256(b'\"c-1\"').hexdigest()[:16]}.md"
    assert page.content == '---\nschemaVersion: 3\ncandidateId: "c-1"\ndate: "2024-01-02"\ncategory: "Paper"\ngroupRank: 3\ntitle: "a \\"title\\""\n---\n\nbody\n'
    assert page.bytes == len(page.content.encode())
    rows = spark.createDataFrame([("c", "News", "n", 1, 70), ("c", "Paper", "p", 1, 60)], "cycle_id string, category string, candidate_id string, group_rank int, score int")
    frozen = publication.freeze(rows).first()
    assert json.loads(frozen.envelope)["records"][0]["candidate_id"] == "p"
    assert frozen.frozen_sha256 == publication.freeze(rows.orderBy(F.desc("category"))).first().frozen_sha256


def test_links(spark):
    html = '<a href="/a">x</a><a href="b?x=1&amp;y=2#f"><img src="/a"><a href="mailto:x@y"><a href="#t"><a href="https://o.org/"><a href="/a#z">'
    pages = spark.createDataFrame([(1, "https://h.org/d/p", html)], "page_id bigint, url string, html string")
    links = local_links(pages, "page_id", "url", "html", base_path="/d/")
    assert sorted((r.target, r.escapes_base) for r in links.collect()) == [("https://h.org/a", True), ("https://h.org/d/b?x=1&y=2", False)]
    dead = broken_links(links, spark.createDataFrame([("/d/b",)], "path string"))
    assert [r.path for r in dead.collect()] == ["/a"]


def test_texts_are_joined_up_to_the_length_of_the_contract(spark):
    df = spark.createDataFrame([("a", i, f"l{i}") for i in range(3)] + [("b", i, "x") for i in range(9)] + [("c", 0, "12345678"), ("d", 0, "123456789"), ("e", 0, "1234    ")] +
                               [("f", i, "") for i in range(1500)], "k string, pos int, part string").repartition(3)
    got = {r.k: (r.parts, r.content) for r in joined_texts(df, ["k"], "pos", "part", 8).collect()}
    assert got == {"a": (3, "l0\nl1\nl2"), "b": (9, None), "c": (1, "12345678"), "d": (1, None), "e": (1, "1234    "), "f": (1500, None)}


def test_long_conversations_are_judged(spark):
    from pressledger.functions import text
    names = ["研究问题与贡献", "方法与系统", "实验设置与数据", "结果、限制与结论", "来源链接"]
    parts = [("k", i, f"line {i}") for i in range(1500)]
    parts = [(k, i, f"## {names[i // 300]}\n\n{p}" if i % 300 == 0 else p) for k, i, p in parts]
    joined = joined_texts(spark.createDataFrame(parts, "k string, pos int, part string").repartition(4), ["k"], "pos", "part", 150_000)
    row = joined.select("parts", text.section_reason(F.col("content"), F.lit("Paper")).alias("reason")).first()
    assert (row.parts, row.reason) == (1500, None)


def test_manifest_verification(spark):
    sha = {c: hashlib.sha256(c.encode()).hexdigest() for c in "abcd"}
    name = lambda c: f"assets/{sha[c][:2]}/{sha[c]}"
    manifest = spark.createDataFrame([(name(c), sha[c], 1) for c in "abc"], "path string, sha256 string, size bigint")
    observed = spark.createDataFrame([(name("a"), sha["a"], 1), (name("b"), sha["b"], 2), (name("d"), sha["d"], 1), ("../x", sha["a"], 1)], "path string, sha256 string, size bigint")
    got = {r.path: r.verdict for r in fp.verify_manifest(manifest, observed).collect()}
    assert got == {name("a"): "ok", name("b"): "mismatch", name("c"): "missing", name("d"): "not_in_manifest", "../x": "unexpected_name"}
