"""Text exports: reading, and a file-order row id for every row."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feederlens.operators import cleaning as C

# One row per scan block goes into the broadcast offsets, about 150 bytes each.
MAX_BROADCAST_BLOCKS = 200_000


_CSV = {"encoding": "ISO-8859-1", "escape": '"'}


BAD_ROWS = ("error", "set_aside")


def _parsed(spark: SparkSession, path: str, multiline: bool) -> tuple[DataFrame, list[str]]:
    """Rows as text with ``_malformed``, the line of a row with more cells than the header, and the header's columns."""
    # Which rows are malformed must not depend on the columns that are asked for.
    reader = spark.read.options(**_CSV).option("header", True).option("multiLine", multiline).option("columnPruning", False)
    columns, bad = reader.csv(path).columns, "_malformed"
    # The header as it stands; Spark names blank and repeated cells anew, and cannot check repeated ones.
    header = [cell or "" for cell in reader.option("header", False).csv(path).first()]
    checked = len({cell.lower() for cell in header}) == len(header) == len(columns)
    fields = [StructField(c, StringType()) for c in [*(header if checked else columns), bad]]
    rows = (
        reader.option("header", True).option("enforceSchema", not checked)
        .option("columnNameOfCorruptRecord", bad).schema(StructType(fields)).csv(path).toDF(*columns, bad)
    )
    # Parsed again with room for one cell more, to tell long rows from short ones.
    wider = ", ".join(f"c{i} string" for i in range(len(columns) + 1))
    last = F.from_csv(bad, wider, {"escape": '"', "multiLine": "true"})[f"c{len(columns)}"]
    # Spark refuses to read the malformed lines alone; this names a cell besides and always holds.
    read = F.length(F.concat_ws("", C.quoted(columns[0]))) >= 0
    long = F.col(bad).isNotNull() & last.isNotNull() & read
    return rows.withColumn(bad, F.when(long, F.col(bad))), columns


def read_export(spark: SparkSession, path: str, multiline: bool = False, bad_rows: str = "error") -> DataFrame:
    """Read a latin-1 CSV export with a header row; every column is text.

    Quotes inside quoted cells are doubled. Rows with fewer cells than the
    header end in missing values. A row with more cells is an error when the
    rows are read, whichever columns are; with ``bad_rows`` "set_aside" it is
    left out and to be had from ``set_aside_rows``. A file whose header differs
    from the others' is an error. ``multiline`` allows line breaks inside
    quoted cells, at the price of one task per file.
    """
    if bad_rows not in BAD_ROWS:
        raise ValueError(f"bad_rows must be one of {BAD_ROWS}, not {bad_rows!r}")
    rows, columns = _parsed(spark, path, multiline)
    fits = F.col("_malformed").isNull()
    if bad_rows == "error":
        error = F.raise_error(F.concat(F.lit("more cells than the header has: "), F.col("_malformed")))
        fits = F.when(fits, True).otherwise(error.cast("boolean"))
    return rows.where(fits).select(*map(C.quoted, columns))


def set_aside_rows(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """(source_file, source_row_id, raw_text) of the rows with more cells than the header.

    Row ids count all rows of a file here, the malformed and empty ones too.
    """
    rows, _ = _parsed(spark, path, multiline)
    return with_lineage(rows).where(F.col("_malformed").isNotNull()).select(
        "source_file", "source_row_id", F.col("_malformed").alias("raw_text")
    )


def read_exports(
    spark: SparkSession, base: str, files: Mapping[str, str], multiline: bool = False, bad_rows: str = "error"
) -> dict[str, DataFrame]:
    """Read a named set of exports into raw tables with lineage."""
    return {
        name: raw_table(read_export(spark, f"{base}/{file}", multiline, bad_rows)) for name, file in files.items()
    }


def set_aside_exports(
    spark: SparkSession, base: str, files: Mapping[str, str], multiline: bool = False
) -> DataFrame:
    """The rows that a named set of exports sets aside, by ``table_name``."""
    return reduce(DataFrame.unionByName, [
        set_aside_rows(spark, f"{base}/{file}", multiline).select(F.lit(name).alias("table_name"), "*")
        for name, file in files.items()
    ])


def raw_table(export: DataFrame) -> DataFrame:
    """Header rule, missing tokens, empty rows out, then lineage."""
    return with_lineage(C.drop_all_null(C.null_tokens(C.normalize_columns(export))))


def with_lineage(df: DataFrame) -> DataFrame:
    """Add ``source_file`` and ``source_row_id``, 1..n per file in file order.

    For a frame read from files, before any shuffle. Every scan block is read
    by one task in file order, so a row's place in its block is its running id
    minus the first one of the block. Blocks are counted in a pass of their own
    and the rows ahead of each block are joined back; rows are not shuffled.
    """
    block = ["_path", "_start"]
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_seen"),
    )
    ahead = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    # The path is a URL; "+" stands for itself in it.
    name = F.replace(F.substring_index("_path", "/", -1), F.lit("+"), F.lit("%2B"))
    offsets = (
        tagged.groupBy(*block)
        .agg(F.min("_seen").alias("_first"), F.count("*").alias("_rows"))
        .select(
            *block,
            "_first",
            F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_ahead"),
            F.url_decode(name).alias("source_file"),
        )
    )
    # A block ends where its file or its task's share of it ends.
    blocks = len(df.inputFiles()) + 2 * df.rdd.getNumPartitions()
    if blocks <= MAX_BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    place = F.col("_seen") - F.col("_first") + F.col("_ahead") + 1
    return tagged.join(offsets, block).select(
        *[C.quoted(c) for c in df.columns], "source_file", place.alias("source_row_id")
    )
