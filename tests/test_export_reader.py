"""Nested exports in blocks against Python's JSON reader; typed references against a row-by-row check."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressledger.sources import export_reader as E

NASTY = ['"', "\\", '\\"', "{", "}]", '{"tables": [', ":", "é🙂", "\n\t", "\\\\\\", "", "x" * 300, '"records": [{']


def sample(seed, records=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(NASTY) for _ in range(rng.randrange(4)))
    nested = lambda: rng.choice([word(), rng.randrange(100), None, [word(), {"records": [{"id": 1}]}], {word(): {"columns": []}}])
    tables = {name: {"records": [{"id": i + 1, "fields": {"Title": word(), "Score": rng.randrange(50), "Any": nested()}} for i in range(n)], word() or "note": word()}
              for name, n in (("Records", records), ("Publish", 3), ('odd "name"\\', 2), ("Empty", 0))}
    columns = {name: {"columns": [{"id": "Title", "fields": {"type": "Text", "help": word()}}]} for name in tables}
    attachments = [{"id": i, "metadata": {"id": i, "fields": {"fileSize": i, "fileName": word()}}, "path": f"files/{i}", "bytes": i} for i in range(1, 6)]
    return {"tables": tables, "columns": columns, "attachments": attachments, "attachment_failures": []}


def write(folder, *exports, indent=None, ascii_only=False):
    folder.mkdir()
    for i, export in enumerate(exports):
        (folder / f"export-{i}.json").write_text(export if isinstance(export, str) else json.dumps(export, indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    return str(folder)


def wanted(*exports):
    rows = []
    for export in exports:
        for section, part in (("tables", "records"), ("columns", "columns")):
            rows += [(section, name, json.dumps(e, sort_keys=True)) for name, t in export[section].items() for e in t[part]]
        rows += [("attachments", None, json.dumps(e, sort_keys=True)) for e in export["attachments"]]
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed,block,indent,ascii_only", [(1, 37, None, False), (2, 1000, 2, True), (3, 1 << 20, None, False)])
def test_elements_equal_the_json_reader(spark, tmp_path, seed, block, indent, ascii_only):
    exports = [sample(seed), sample(seed + 10, 3)]
    found = E.Export(spark, write(tmp_path / "in", *exports, indent=indent, ascii_only=ascii_only), block=block).elements.collect()
    assert sorted(((r.section, r.name, json.dumps(json.loads(r.element), sort_keys=True)) for r in found), key=str) == wanted(*exports)


def test_tables_columns_and_attachments(spark, tmp_path):
    export = sample(5)
    own = E.Export(spark, write(tmp_path / "in", export), block=500)
    fields = T.StructType([T.StructField("Title", T.StringType()), T.StructField("Score", T.LongType())])
    got = sorted(tuple(r) for r in own.table("Records", fields).collect())
    assert got == sorted((r["id"], r["fields"]["Title"], r["fields"]["Score"]) for r in export["tables"]["Records"]["records"])
    assert own.table("Empty", fields).collect() == []
    assert {tuple(r) for r in own.columns().collect()} == {(t, "Title", "Text") for t in export["tables"]}
    (tmp_path / "files").mkdir()
    for i, size in ((1, 1), (2, 2), (3, 4)):
        (tmp_path / f"files/{i}").write_bytes(b"x" * size)
    assert {r.id: r.verdict for r in own.attachment_verdicts(str(tmp_path)).collect()} == {1: "ok", 2: "ok", 3: "other size", 4: "missing", 5: "missing"}


def test_an_element_longer_than_many_blocks(spark, tmp_path):
    export = sample(6, 2)
    export["tables"]["Records"]["records"][0]["fields"]["Title"] = "\\\"{" * 100_000
    found = E.Export(spark, write(tmp_path / "in", export), block=4096).elements.collect()
    assert sorted(((r.section, r.name, json.dumps(json.loads(r.element), sort_keys=True)) for r in found), key=str) == wanted(export)


@pytest.mark.parametrize("change,message", [
    (lambda e: e | {"more": 1}, "envelope"), (lambda e: {k: v for k, v in e.items() if k != "columns"}, "envelope"), (lambda e: e | {"attachments": {}}, "envelope"),
    (lambda e: e | {"attachment_failures": ["lost"]}, "failures"), (lambda e: json.dumps(e)[:-40], "cut off"), (lambda e: json.dumps(e) + '"', "cut off"), (lambda e: "[]", "envelope")])
def test_wrong_exports_are_refused(spark, tmp_path, change, message):
    with pytest.raises(ValueError, match=message):
        E.Export(spark, write(tmp_path / "in", sample(7), change(sample(7))), block=300)


def test_typed_references(spark, tmp_path):
    records = [(10, {"Publish": 7, "Image": ["L", 4, 4], "Tags": ["L", 1, 9], "Bad": 1}), (11, {"Publish": 0, "Image": "", "Tags": None}), (12, {"Publish": 8, "Image": "old text", "Tags": ["L"]}),
               (13, {"Publish": "7", "Image": ["L", 5], "Tags": ["X", 1]}), (14, {"Publish": None, "Image": None, "Tags": ["L", 0]}), (15, {"Publish": -7, "Tags": ["L", 1]})]
    export = {"tables": {"Publish": {"records": [{"id": 7, "fields": {}}]}, "Tag": {"records": [{"id": 1, "fields": {}}]},
                         "Records": {"records": [{"id": i, "fields": f} for i, f in records]}},
              "columns": {"Records": {"columns": [{"id": "Publish", "fields": {"type": "Ref:Publish"}}, {"id": "Tags", "fields": {"type": "RefList:Tag"}},
                                                  {"id": "Image", "fields": {"type": "Attachments"}}, {"id": "Bad", "fields": {"type": "Ref:Nowhere"}}]}},
              "attachments": [{"id": 4, "metadata": {"id": 4}, "path": "a", "bytes": 1}], "attachment_failures": []}
    own = E.Export(spark, write(tmp_path / "in", export), block=100)
    got = {tuple(r) for r in E.reference_problems(own).collect()}
    assert got == {("Records", "Publish", 8, "dangling", 1), ("Records", "Publish", None, "malformed", 2), ("Records", "Tags", 9, "dangling", 1), ("Records", "Tags", None, "malformed", 2),
                   ("Records", "Image", 5, "dangling", 1), ("Records", "Image", None, "anomaly", 1), ("Records", "Bad", 1, "unsupported target", 1)}
    assert {(r.row_id, r.ref) for r in E.typed_references(own).where("column = 'Image' and problem is null").collect()} == {(10, 4), (13, 5)}
    # a required reference is checked where the metadata leaves it out
    export["columns"] = {}
    bare = E.Export(spark, write(tmp_path / "bare", export), block=100)
    assert E.reference_problems(bare).collect() == []
    assert {r.missing_key for r in E.reference_problems(bare, [("Records", "Publish", "Ref:Publish")]).collect()} == {8, None}


def test_structure_counts_backslashes_before_a_block():
    text = r'{"a": "\\\"{", "b\\": 1}'.encode()
    whole = E.Structure(text)
    for cut in range(len(text)):
        run = len(text[:cut]) - len(text[:cut].rstrip(b"\\"))
        parts = E.Structure(text[:cut]), E.Structure(text[cut:], run % 2 == 1)
        assert [*parts[0].quotes.tolist(), *(parts[1].quotes + cut).tolist()] == whole.quotes.tolist()


def test_nothing_is_planned_in_one_task(spark, tmp_path):
    own = E.Export(spark, write(tmp_path / "in", sample(8, 400)), block=200)
    files = own.elements.select(F.col("_metadata.file_name").alias("written_by")).distinct().count()
    assert files >= spark.sparkContext.defaultParallelism


def test_cells_meet_their_columns_without_a_shuffle(spark, tmp_path):
    """Few columns have all the cells, so cells dealt by the names of columns would lie in as few tasks."""
    export = {"tables": {"A": {"records": [{"id": i, "fields": {"r": i % 3, "n": i}} for i in range(50)]}}, "attachments": [], "attachment_failures": [],
              "columns": {"A": {"columns": [{"id": "r", "fields": {"type": "Ref:A"}}, {"id": "n", "fields": {"type": "Number"}}]}}}
    found = E.typed_references(E.Export(spark, write(tmp_path / "in", export), block=100))
    assert found.count() == 33
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
