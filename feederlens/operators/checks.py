"""Data-quality checks over named tables; each is one job."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from feederlens.functions.numbers import strip
from feederlens.functions.picks import count_where
from feederlens.operators.cleaning import quoted


def _stack(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame], rows: Mapping[str, int] | None = None) -> DataFrame:
    """One row per table: its name and its number of rows, counted unless ``rows`` has it."""
    if rows is not None:
        return _noted(tables, rows, "table_name string, row_count long")
    return _stack(
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


def lost_rows(tables: Mapping[str, DataFrame], rows: Mapping[str, int]) -> DataFrame:
    """One row per table: the rows written to it, those it holds, and what lies between."""
    written = _noted(tables, rows, "table_name string, written_rows long")
    stored = row_counts(tables).withColumnRenamed("row_count", "stored_rows")
    # One row for each table.
    return written.join(F.broadcast(stored), "table_name").withColumn(
        "lost_rows", F.col("written_rows") - F.col("stored_rows")
    )


def _noted(tables, rows, schema):
    [spark] = {df.sparkSession for df in tables.values()}
    return spark.createDataFrame([(name, rows[name]) for name in tables], schema)


def null_counts(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row: how many rows lack each column; ``{output name: column}``."""
    return df.agg(*[count_where(F.col(c).isNull()).alias(name) for name, c in columns.items()])


def entity_counts(
    tables: Mapping[str, tuple[DataFrame, str]], rows: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per table: rows, counted unless ``rows`` has them, against distinct values of its key column."""

    def check(name, df, key):
        distinct = F.countDistinct(key).alias("unique_business_entities")
        if rows is None:
            return df.agg(F.count("*").alias("rows"), distinct)
        return df.agg(distinct).withColumn("rows", F.lit(rows[name]).cast("bigint"))

    return _stack(
        check(name, df, key).select(F.lit(name).alias("dataset"), "rows", "unique_business_entities")
        for name, (df, key) in tables.items()
    )


def rejected_keys(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per raw table: rows, and rows whose key is missing or blank."""

    def check(name, df, key):
        text = strip(quoted(key))
        nameless = text.isNull() | (text == "")
        return df.agg(
            F.count("*").alias("row_count"),
            F.coalesce(count_where(nameless), F.lit(0)).alias("rejected_keys"),
        ).select(F.lit(name).alias("table_name"), "row_count", "rejected_keys")

    return _stack(check(name, df, key) for name, (df, key) in tables.items())


def key_checks(tables: Mapping[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row per table: rows, rows with a missing key part, and rows beyond one per key."""

    def check(name, df, keys):
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        per_key = df.groupBy(*keys).agg(F.count("*").alias("copies"))
        return per_key.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(missing, F.col("copies"))), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("repeated_keys"),
        ).select(F.lit(name).alias("table_name"), "row_count", "null_keys", "repeated_keys")

    return _stack(check(name, df, keys) for name, (df, keys) in tables.items())
