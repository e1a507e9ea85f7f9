"""The document tree: two-phase writes, verification, failures that leave nothing."""

import hashlib
import os

import pytest

from pressledger.sources import tree

KIND = "path string, content binary, other int"


def files_below(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if not f.endswith(".crc"))


def test_documents_are_written_and_read_back(spark, tmp_path):
    folder = f"{tmp_path}/site"
    rows = [(f"docs/{i % 7}/page-{i}.md", f"text {i} é".encode() * (i % 5), i) for i in range(200)] + [("empty.md", None, 0), ("a b/ü.txt", b"\x00\xff", 1)]
    manifest = tree.write_tree(spark.createDataFrame(rows, KIND).repartition(5), folder)
    assert files_below(folder) == sorted(p for p, _, _ in rows) and not os.path.exists(f"{folder}.pending") or os.listdir(f"{folder}.pending") == []
    got = {r.path: (r.bytes, r.sha256, r.verdict) for r in tree.read_back(manifest, folder).collect()}
    assert got == {p: (len(c or b""), hashlib.sha256(c or b"").hexdigest(), "ok") for p, c, _ in rows}
    # a file of another job may replace one
    tree.write_tree(spark.createDataFrame([("empty.md", b"now full", 1)], KIND), f"file:{folder}")
    with open(f"{folder}/docs/1/page-1.md", "wb") as file:
        file.write(b"damaged")
    os.remove(f"{folder}/docs/2/page-2.md")
    with open(f"{folder}/stray.md", "w") as file:
        file.write("x")
    verdicts = {r.path: r.verdict for r in tree.read_back(manifest, folder).where("verdict <> 'ok'").collect()}
    assert verdicts == {"docs/1/page-1.md": "changed", "docs/2/page-2.md": "missing", "empty.md": "changed"}
    assert [tuple(r) for r in tree.stray_files(spark, manifest, folder).collect()] == [("stray.md", 1)]


@pytest.mark.parametrize("path", ["../up.md", "/root.md", "a//b", "", None, "a/./b", "a\\b"])
def test_a_failed_task_leaves_no_file(spark, tmp_path, path):
    folder = f"{tmp_path}/site"
    rows = [(f"ok-{i}.md", b"x", 1) for i in range(20)] + [(path, b"bad", 2)]
    with pytest.raises(Exception, match="relative path"):
        tree.write_tree(spark.createDataFrame(rows, KIND).repartition(4), folder)
    assert files_below(tmp_path) == []


def test_two_documents_of_one_path_publish_nothing(spark, tmp_path):
    folder = f"{tmp_path}/site"
    with pytest.raises(ValueError, match="two documents"):
        tree.write_tree(spark.createDataFrame([("a", b"1", 1), ("b", b"1", 1), ("a", b"1", 1)], KIND).repartition(3), folder)
    assert files_below(tmp_path) == []


def test_publishing_may_be_repeated_and_empty_tables(spark, tmp_path):
    folder = f"{tmp_path}/site"
    rows = spark.createDataFrame([(f"p{i}", b"x" * i, i) for i in range(9)], KIND)
    pending = tree.stage_tree(rows, folder)
    assert not os.path.exists(folder)
    # a first attempt that moved some files and died
    index = spark.read.parquet(f"{pending}/index").limit(4).collect()
    os.makedirs(folder)
    for r in index:
        os.rename(f"{pending}/{r.attempt}/{r.path}", f"{folder}/{r.path}")
    assert tree.publish_tree(spark, pending, folder).count() == 9 and files_below(folder) == sorted(f"p{i}" for i in range(9))
    assert tree.write_tree(rows.where("false"), f"{tmp_path}/none").count() == 0


def test_attempts_of_lost_executors_do_not_count(spark, tmp_path):
    folder = f"{tmp_path}/site"
    pending = tree.stage_tree(spark.createDataFrame([("a", b"1", 1)], KIND), folder)
    # an attempt that listed and staged its file before it was lost, and was made again
    kept = spark.read.parquet(f"{pending}/index").first()
    os.makedirs(f"{pending}/0-lost")
    with open(f"{pending}/0-lost/a", "w") as file:
        file.write("other")
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table([["a"], [5], ["?"], ["0-lost"]], schema=tree.INDEX), f"{pending}/index/0-lost.parquet")
    assert [tuple(r) for r in tree.publish_tree(spark, pending, folder).collect()] == [("a", 1, kept.sha256)]
    with open(f"{folder}/a") as file:
        assert file.read() == "1"
