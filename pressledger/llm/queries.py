"""The queries of this package beside the SQL that must give the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_text, licenses, passage_model, personal_data, quality_rules, sentence_pieces, token_counts, url_rules, weighted_sampling
from .hard_negatives import HardNegatives
from .mixing import Mixture
from .shingle_join import ShingleJoin
from .tables import table
from .token_alignment import Alignment

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build
    return register


@query("op8_token_counts")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


#: the rules of the contract
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query("op9_url_filters", r"""
with rules(action, rule, host, path) as (values ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
    ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
parts as (select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path from pages)
select p.page_id, p.host, p.path, r.rule, coalesce(r.action, 'allow') as verdict
from parts p left join lateral (select * from rules r
    where (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
    order by length(r.rule) desc limit 1) r on true""")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(table(spark, folder, "pages"), url_rules.rule_table(spark, URL_RULES))


@query("op10_quality_rules", r"""
with w as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
windows as (select doc_id, unnest(range(1, len(words) - 1)) as i, words from w where len(words) >= 3),
named as (select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as win from windows),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as c from named) where c > 1),
covered as (select doc_id, count(distinct j) as n from (select doc_id, unnest([i, i + 1, i + 2]) as j from twice) group by doc_id),
m as (select w.doc_id, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
        cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
        cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
        cast(len(lines) as bigint) as n_lines, cast(length(regexp_replace(t, '[^A-Z]+', '', 'g')) as bigint) as n_upper
    from w left join covered c on w.doc_id = c.doc_id),
bits as (select *, cast(case when n_words < 50 then 1 else 0 end + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
        + case when 100 * n_symbols > 25 * n_words then 4 else 0 end + case when 100 * n_dup_lines > 50 * n_lines then 8 else 0 end
        + case when 100 * n_upper > 50 * word_chars then 16 else 0 end
        + case when word_chars > 20 * n_words or word_chars < 2 * n_words then 32 else 0 end as bigint) as failure_bits from m)
select *, failure_bits & 3 <> 0 as base_failed, failure_bits = 0 as kept from bits""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, folder, "documents"))
    return rows.select("*", quality_rules.fails("base").alias("base_failed"), (~quality_rules.fails("corpus-1")).alias("kept"))


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return ShingleJoin(table(spark, folder, "documents"), width=3, num=90, den=100).components()


def held_out(key: str = "doc_id"):
    """Rows that no label is learned from: the CRC-32 of the id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


#: documents that score less are predicted 0
QUALITY_THRESHOLD = 0.3


@query("op4_quality_classifier")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = passage_model.train(docs, table(spark, folder, "labels"), ~held_out())
    return passage_model.scored(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


@query("op5_document_fingerprints")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return weighted_sampling.compared(table(spark, folder, "documents"))


@query("op7_personal_data")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = personal_data.spans_of(docs, personal_data.train(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op3_source_mixing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its place in a mixture whose weights flatten the sources' sizes."""
    return Mixture(table(spark, folder, "documents"), temperature=0.7).placed()


@query("op6_license_scan")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files below source, language and a folder for each thousand ids."""
    docs = table(spark, folder, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


@query("op2_sentence_pieces")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    rows = sentence_pieces.encoded(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", "n_tokens", F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), "round_trip", "parity")


@query("op11_html_text")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extracted(table(spark, folder, "pages"))


@query("op12_hard_negatives", r"""
with own as (select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else cast(label as bigint) end as label, embedding from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
vectors as (select vec_id, label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from own),
scored as (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
    from vectors a join vectors b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (select anchor_id, other_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.positive_id, cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id) as integer) as rank,
    s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on p.anchor_id = s.anchor_id and not s.same
    and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return HardNegatives(table(spark, folder, "embeddings"), label=label, is_anchor=F.col("vec_id") % 100 == 0).mined()


@query("op13_token_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return Alignment(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).documents()
