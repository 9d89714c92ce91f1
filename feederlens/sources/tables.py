"""Layer namespaces and stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from feederlens.settings import LAYERS


def create_layers(spark: SparkSession, layers: Mapping[str, str] = LAYERS) -> None:
    """Create one schema per layer, with its description."""
    for name, comment in layers.items():
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT '{text}'")


def save_table(
    df: DataFrame, name: str, fmt: str = "parquet", buckets: tuple[int, str] | None = None
) -> DataFrame:
    """Replace a stored table, schema included, and return it as read back.

    ``buckets=(n, key)`` stores the rows hashed by the key, so later joins of
    tables bucketed alike need no shuffle. It suits keys without heavy values.
    """
    writer = df.write
    if buckets:
        n, key = buckets
        writer = df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
    writer.mode("overwrite").option("overwriteSchema", "true").format(fmt).saveAsTable(name)
    return df.sparkSession.table(name)
