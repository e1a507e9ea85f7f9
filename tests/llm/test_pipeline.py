import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as C
from pressledger.llm import passage_model, personal_data
from pressledger.llm.mixing import Mixture
from pressledger.llm.queries import QUERIES, SQL, held_out
from pressledger.llm.tables import pinned, table
from tests.llm.test_personal_data import plain
from tests.llm.test_sentence_pieces import MODEL
from tests.llm.test_shingle_join import brute_force

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, FOLDER, "documents")]
    for _, stage in C.STAGES:
        docs.append(pinned(stage(spark, docs[-1], FOLDER)))
    return docs


def test_stages_equal_brute_force(spark, steps):
    start, good, single, clean, mixed, coded = steps
    for step in steps[:-1]:
        assert step.dtypes == start.dtypes
    model = passage_model.train(start, table(spark, FOLDER, "labels"), ~held_out())
    scores = {r.doc_id: r.score for r in passage_model.scored(start, model).collect()}
    rows = {r.doc_id: r for r in good.collect()}
    assert set(rows) == {i for i, s in scores.items() if s >= 0.3}
    groups = brute_force([(i, r.text) for i, r in rows.items()], 5, 8, 10)
    assert {r.doc_id for r in single.collect()} == {i for i, (_, top) in groups.items() if top == i}
    for r in clean.collect():
        text = rows[r.doc_id].text
        assert (r.text == text) if not plain(text or "") and r.text == text else plain(r.text) == [] and r.n_chars == len(r.text)
    assert clean.count() == single.count()
    mix = Mixture(clean, temperature=C.TEMPERATURE)
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in mix.placed().where(f"slot < {mix.slots()}").collect()}
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    texts = {r.doc_id: r.text or "" for r in mixed.collect()}
    got = {r.doc_id: r for r in coded.collect()}
    assert {i: r.ids for i, r in got.items()} == {i: library.encode(t) for i, t in texts.items()}
    assert all(r.parity and r.n_tokens == len(r.ids) for r in got.values())


def test_tokens_follow_the_mixture(steps):
    *_, clean, mixed, coded = steps
    place = {r.doc_id: r.position for r in Mixture(clean, temperature=C.TEMPERATURE, nulls=True).placed().collect()}
    got = sorted((r.position, r.doc_id) for r in coded.collect())
    assert [p for p, _ in got] == list(range(len(place))) and [i for _, i in got] == sorted(place, key=place.get)


def test_positions_over_many_part_files(spark, docs_of):
    docs = docs_of([(i, f"text {i}") for i in range(3000)]).repartition(7)
    mixed = pinned(C.mixture(spark, docs, FOLDER).repartitionByRange(13, F.col("doc_id").desc()).sortWithinPartitions(F.col("doc_id").desc()))
    assert len(mixed.inputFiles()) == 13
    assert all(r.position == 2999 - r.doc_id for r in C.tokens(spark, mixed, FOLDER).collect())
    assert {r.position for r in C.tokens(spark, docs, FOLDER).collect()} == {None}


def test_stages_take_any_rows(spark, docs_of):
    long = "many words of one long text " * 4000
    rows = [(1, None), (2, ""), (3, long), (4, long), (4, long), (None, "no id"), (None, "no id"), (6, "mail a@b.c now")]
    docs = docs_of(rows)
    for _, stage in C.STAGES[1:4]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and stage(spark, docs.where("false"), FOLDER).count() == 0
        out.count()
    assert sorted(str(r.doc_id) for r in C.near_duplicates(spark, docs, FOLDER).collect()) == ["1", "2", "3", "6", "None", "None"]
    assert C.quality(spark, docs, FOLDER).columns == docs.columns and C.quality(spark, docs.where("false"), FOLDER).count() == 0
    assert C.tokens(spark, docs, FOLDER).count() == len(rows)


def test_columns_whose_names_clash_pass_through(spark, docs_of):
    rows = [(i, f"text {i} of some words and some more of them") for i in range(12)] + [(3, "an unlike text under an id that is there already")]
    docs = docs_of(rows)
    for name in ("_place", "_place_key", "_cut", "_cut_source", "_row", "_id", "_many", "_gone", "_n", "rep", "component_id", "a", "b", "node", "slot", "block"):
        docs = docs.withColumn(name, F.lit(name))
    for _, stage in C.STAGES[:4]:
        docs = pinned(stage(spark, docs, FOLDER))
        assert {r["_place"] for r in docs.collect()} <= {"_place"}
    given = Mixture(docs_of(rows).withColumn("_cut", F.lit(1)).withColumn("_cut_source", F.lit(2)), weights={"src0": 1, "src1": 1})
    assert given.ordered().columns[-2:] == ["_cut", "_cut_source"] and given.ordered().count() == given.kept().count()


def test_one_row_of_a_repeated_id_stays_by_a_fixed_order(spark, docs_of):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(3, a), (5, a), (5, b), (2, b), (7, "first text of seven"), (7, "second one")]
    seen = {tuple(sorted((r.doc_id, r.text) for r in C.near_duplicates(spark, docs_of(rows[::step], parts), FOLDER).collect())) for step in (1, -1) for parts in (1, 4)}
    assert len(seen) == 1
    kept = dict(seen.pop())
    assert sorted(kept) == [2, 7] and kept[2] == b


def test_mixture_keeps_every_row(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, "t", "en", "one" if i == 0 else None if i % 9 == 0 else "ab"[i % 2], 1) for i in range(20000)], kind)
    assert C.mixture(spark, docs, FOLDER).select("doc_id").distinct().count() == 20000


def test_registered(spark):
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(SQL) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and names["pipeline"] is C.run


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb

    from tools.check import TABLES, normal
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df, wanted = QUERIES[name](spark, FOLDER), db.sql(SQL[name])
    assert sorted(df.columns) == sorted(wanted.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(wanted.fetchall(), wanted.columns)
