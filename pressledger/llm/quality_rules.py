"""Quality rules as a ledger: every rule is evaluated once, its failure is one bit, and policies are masks over the bits.

Only DataFrame functions. The ledger keeps measurements and bits, so a new policy or an ablation reads the ledger, never a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"

#: (name, condition of failure over the measurements); the position is the bit and never changes
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 25 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("upper_case", "100 * n_upper > 50 * word_chars"),
    ("word_length", "word_chars > 20 * n_words or word_chars < 2 * n_words"),
]
#: policy -> names of the rules it applies
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_words"],
    "corpus-1": ["few_words", "repeated_words", "symbols", "duplicate_lines", "upper_case", "word_length"],
}


def mask(policy: str) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(name) for name in POLICIES[policy])


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper) of every row.

    A null or empty text, and one of white space, has no words and only zeros. Rows that repeat stay. Other columns are not read.
    Windows of three words are compared by a 64-bit hash inside one text; each stage is a projection of its own, so
    no array is built twice. Everything is narrow: no row leaves its task, whatever its key.
    """
    base = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    split = base.select("*", F.array_remove(F.split("_text", WORD_BREAK), "").alias("_words"),
                        F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)).alias("_lines"))
    windows = split.select("*", F.expr(
        "case when size(_words) < 3 then cast(array() as array<struct<h: bigint, i: int>>) else "
        "transform(slice(_words, 1, size(_words) - 2), (w, i) -> struct(xxhash64(w, _words[i + 1], _words[i + 2]) as h, i as i)) end")
        .alias("_windows"))
    ordered = windows.select("*", F.sort_array("_windows").alias("_sorted"))
    repeated = ordered.select("*", F.expr(
        "filter(_sorted, (x, k) -> (k > 0 and _sorted[k - 1].h = x.h) or (k + 1 < size(_sorted) and _sorted[k + 1].h = x.h)).i")
        .alias("_starts"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_starts", lambda i: F.array(i, i + 1, i + 2)))))
    return repeated.select(
        F.col("_key").alias(key), F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"), F.size("_lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("_text", "[^A-Z]+", "")).cast("long").alias("n_upper"))


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements and ``failure_bits`` of every row."""
    bits = [F.when(F.expr(rule), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, (_, rule) in enumerate(RULES)]
    total: Column = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(docs, key, text).withColumn("failure_bits", total.cast("long"))


def fails(policy: str) -> Column:
    return F.col("failure_bits").bitwiseAND(F.lit(mask(policy))) != 0


def ablations(rows: DataFrame) -> DataFrame:
    """(policy, rule, n_docs, n_failing, n_only, kept, kept_without): what each rule of each policy does, from the bits alone.

    Rows are first counted by their bits, of which there are at most two to the number of rules.
    """
    counted = rows.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("n"))
    masks = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(mask(p)).cast("long").alias("mask"), F.lit(name).alias("rule"),
                                         F.lit(1 << bit).cast("long").alias("bit"))
                                for p in POLICIES for bit, (name, _) in enumerate(RULES) if name in POLICIES[p]]))
    seen = counted.select("*", masks.alias("m")).select("failure_bits", "n", "m.*")
    failed = F.col("failure_bits").bitwiseAND(F.col("mask"))
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return seen.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"), total(failed.bitwiseAND(F.col("bit")) != 0).alias("n_failing"),
        total(failed == F.col("bit")).alias("n_only"), total(failed == 0).alias("kept"),
        total(failed.bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"))
