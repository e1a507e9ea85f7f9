"""JSON sources: strict ingest and nested table exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strict_json(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): duplicate keys, non-finite numbers and malformed text are refused.

    ``good`` gains ``parsed`` (VARIANT). Both sides are filters over the same scan.
    """
    parsed = df.withColumn("parsed", F.try_parse_json(column))
    return parsed.where(F.col("parsed").isNotNull()), df.where(F.try_parse_json(column).isNull())


ENVELOPE = ("attachment_failures", "attachments", "columns", "tables")


def read_nested_export(spark: SparkSession, path: str, fields: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """Tables of nested export files, one export per file."""
    return parse_export(spark.read.text(path, wholetext=True), "value", fields)


def parse_export(exports: DataFrame, column: str, fields: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """Tables of nested exports: ``{tables: {T: {records: [{id, fields}]}}, columns, attachments, ...}``.

    Records become typed rows with ``row_id`` and the declared fields. A wrong envelope or a reported attachment failure
    makes the load fail when it is read.
    """
    tables = T.StructType([T.StructField(name, T.StructType([
        T.StructField("records", T.ArrayType(T.StructType([
            T.StructField("id", T.LongType()), T.StructField("fields", schema)])))])) for name, schema in fields.items()])
    schema = T.StructType([T.StructField("tables", tables),
                           T.StructField("attachment_failures", T.ArrayType(T.StringType()))])
    keys = F.array_sort(F.json_object_keys(column))
    wrong = ~keys.eqNullSafe(F.array(*[F.lit(k) for k in ENVELOPE]))
    parsed = exports.select(
        F.when(wrong, F.raise_error(F.lit("unsupported export envelope")).cast(schema))
        .otherwise(F.from_json(column, schema)).alias("e"))
    checked = parsed.select(
        F.when(F.size("e.attachment_failures") > 0, F.raise_error(F.lit("export reports attachment failures"))
               .cast(tables)).otherwise(F.col("e.tables")).alias("t"))
    return {name: checked.select(F.explode(f"t.{name}.records").alias("r"))
            .select(F.col("r.id").alias("row_id"), "r.fields.*") for name in fields}
