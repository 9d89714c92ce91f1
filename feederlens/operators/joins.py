"""Joins on a bus or element name, and one-row values added to every row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

#: A name is split if its result fills more than this part of a mean partition, into cells of a quarter of that.
SPLIT_FROM = 0.25
CELLS_PER_SPLIT = 4

#: Bounds of the frequent-names aggregate: names it returns, and names it tracks.
MOST_NAMES = 100_000
MOST_TRACKED = 1_000_000


def left_star(
    fact: DataFrame, sides: list[DataFrame], key: str, names: Sequence[DataFrame] | None = None
) -> DataFrame:
    """Left-join every side to the fact table on one key, keeping all matches.

    All joins share the key, so each input is shuffled once and nothing between
    the joins. A key of which the result is large, because it is frequent in the
    fact table, in a side, or in several, is joined in a grid of cells: each
    input deals its own rows of the key into parts, by the row's hash, and
    repeats each part along the parts of the others. Rows without a key, which
    match nothing, are spread over all tasks.

    Which keys these are is part of the plan: one aggregate over the key column
    of each input, and no job when the plan is built. Where inputs are costly to
    compute for that, ``names`` are other frames to count, one for each input,
    with about as many rows of a key; keys of a side's must be in that side.
    """
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inputs = [fact, *sides]
    grid = _grid(inputs if names is None else list(names), key, partitions)
    dealt = [_dealt(df, i, grid, key, len(inputs), partitions) for i, df in enumerate(inputs)]
    joined = reduce(lambda rows, side: rows.join(side, [key, "_cell"], "left"), dealt)
    # Every row of a key meets all parts of a side; only where the side is whole does no match mean none.
    met = " AND ".join(f"(coalesce(_parts{i}, 1) = 1 OR _there{i})" for i in range(1, len(inputs))) or "true"
    return joined.where(met).select(*fact.columns, *[c for s in sides for c in s.columns if c != key])


# Expressions are SQL text here: each step of one built from columns is a call to the JVM.

def _named(*columns: str) -> str:
    return ", ".join("`" + c.replace("`", "``") + "`" for c in columns)


def _dealt(df: DataFrame, i: int, grid: DataFrame, key: str, n: int, partitions: int) -> DataFrame:
    """Rows of input ``i`` with the cells they go to, a row for each; cells are numbered with the last input's parts fastest."""
    parts = [f"_parts{k}" for k in range(n)]
    own, after, others = parts[i], " * ".join(parts[i + 1 :] or ["1"]), " * ".join(parts[:i] + parts[i + 1 :] or ["1"])
    cells = (
        f"CASE WHEN _parts0 IS NULL THEN array(0L) ELSE transform(sequence(0L, bigint({others}) - 1), x -> "
        f"(x div ({after})) * {own} * ({after}) + pmod(_place, {own}) * ({after}) + x % ({after})) END"
    )
    if i == 0:
        cells = f"CASE WHEN {_named(key)} IS NULL THEN array(pmod(_place, {partitions}L)) ELSE {cells} END"
    # The place by value, so a recomputed task splits the same way. Whole-row copies
    # stay together; dedupe() removes them earlier.
    placed = df.selectExpr("*", f"xxhash64({_named(*df.columns)}) AS _place").join(grid, key, "left")
    kept = [_named(c) for c in df.columns]
    return placed.selectExpr(*kept, *(parts if i == 0 else [f"true AS _there{i}"]), f"explode({cells}) AS _cell")


def _frequent(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """(name, rows, total): keys with more than a small part of a mean partition, by one aggregate over the key column.

    The sketch keeps a bounded number of names, merges partial results and
    reports only names that are surely there.
    """
    wanted = min(MOST_NAMES, max(100, 4 * partitions))
    tracked = min(MOST_TRACKED, 16 * wanted)
    return (
        df.select(F.col(key).alias("name")).where("name IS NOT NULL")
        .agg(F.expr(f"approx_top_k(name, {wanted}, {tracked})").alias("names"), F.expr("count(*)").alias("total"))
        .selectExpr("total", "inline(names)").selectExpr("item AS name", "count AS rows", "total")
    )


def _grid(inputs: list[DataFrame], key: str, partitions: int) -> DataFrame:
    """(key, _parts0, _parts1, ...) of keys to split: in how many parts each input deals its rows.

    Fewer keys than a small multiple of the partitions, so they are sent to all.
    """
    n = len(inputs)
    frequent = reduce(DataFrame.unionByName, [
        _frequent(df, key, partitions).selectExpr("*", f"{i} AS input") for i, df in enumerate(inputs)
    ])
    named = frequent.groupBy("name").agg(
        *[F.expr(f"double(coalesce(max(rows) FILTER (WHERE input = {i}), 1))").alias(f"_rows{i}") for i in range(n)],
        F.expr("max(total) FILTER (WHERE input = 0)").alias("_fact_rows"),
    )
    rows = [f"_rows{i}" for i in range(n)]
    hot = named.selectExpr(
        "name", *rows, f"{' * '.join(rows)} AS _result",
        # Rows of the whole result: the fact table's, and what frequent names add.
        f"(coalesce(max(_fact_rows) OVER (), 0) + sum({' * '.join(rows)} - _rows0) OVER ()) * {SPLIT_FROM} / {partitions} AS _split_from",
    ).where("_result > greatest(_split_from, 1)")
    steps = [f"ceil(_result / _split_from * {CELLS_PER_SPLIT}) AS _left0"]
    for i in range(n):
        # What is dealt into parts is repeated along the others' parts: near the square root, repeating costs both the least.
        rest = " * ".join(rows[i + 1 :] or ["1"])
        even = f"ceil(sqrt(_left{i} * _rows{i} / ({rest})))"
        steps += [
            f"int(greatest(1, least({even}, _left{i}, bigint(_rows{i})))) AS _parts{i}",
            f"ceil(_left{i} / _parts{i}) AS _left{i + 1}",
        ]
    split = hot.selectExpr(f"name AS {_named(key)}", *steps)
    return F.broadcast(split.select(key, *[f"_parts{i}" for i in range(n)]))


def with_values(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, as a scalar subquery."""
    packed = one_row.select(F.struct("*").alias("v"))
    added = [F.col(f"_values.{c}").alias(c) for c in one_row.columns]
    return df.withColumn("_values", packed.scalar()).select(*df.columns, *added)
