"""Global rank and running totals without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Here the order is cut into slots first. One aggregate reads the order column
and gives the number of rows and a mergeable quantile sketch of the values,
as numbers that sort like them; its quantiles are the cut points. A value that
holds a slot or more, NULL too, is cut by the whole order key, tie-breaks
included, at points from a sample of that value's rows. Rows move once, to
their slot, and that one exchange is read twice: for the small per-slot counts
and sums, which are broadcast back, and for the positions within a slot, which
they turn into global ones.

The cut points are constants of the plan and the slot is computed from the
row's own values, so a recomputed task always lands in the same slot. Which
points the sketch yields affects balance, never the result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window, functions as F
from pyspark.sql import types as T

from feederlens.functions.numbers import exact

# Rows per slot: at least the first, so a table up to it is one slot, and at
# most the second, until MAX_SLOTS bounds what is broadcast and sampled.
ROWS_PER_SLOT = (50_000, 250_000)
MAX_SLOTS = 10_000
SAMPLE_PER_SLOT = 32

# Values that the sketch holds on a level, by the cores that slots are made
# for. Half as many slots can be told apart: 1,024 on one machine, 16,384 on a cluster.
SKETCH_SIZE = (2_048, 32_768)

# Cut points that are searched by nested conditions, compiled with the rest; more are searched in an array.
MAX_NESTED = 255


def global_rank(
    df: DataFrame,
    measure: str,
    name: str,
    descending: bool = False,
    ties: Sequence[str] = (),
    slots: int | None = None,
) -> DataFrame:
    """Add ``name``: 1..n by the measure, equal measures by ``ties`` ascending.

    Missing measures come first ascending and last descending.
    """
    return ordered_totals(df, measure, descending, ties, rank=name, slots=slots)


def ordered_totals(
    df: DataFrame,
    measure: str,
    descending: bool = False,
    ties: Sequence[str] = (),
    rank: str | None = None,
    running: Mapping[str, str] | None = None,
    slots: int | None = None,
) -> DataFrame:
    """Add a global rank and running sums ``{new column: summed column}`` in one pass.

    Runs one job when called: the aggregate of rows and quantiles. A second one
    follows only if one value holds slots of its own. ``ties`` should tell rows
    apart; rows equal in all of them are ranked in any order among themselves.
    ``slots`` overrides the number of slots.
    """
    return _exactly(df, dict(running or {}), lambda df, sums: _ordered_totals(
        df, measure, descending, ties, rank, sums, slots
    ), [rank] if rank else [])


def _ordered_totals(df, measure, descending, ties, rank, running, slots) -> DataFrame:
    survey = _survey(df, measure, descending)
    if slots is None:
        slots = _slots_for(survey.rows, df.sparkSession.sparkContext.defaultParallelism)
    if slots <= 1 or not survey.rows:
        return _within(df, Window.orderBy(*_order(measure, descending, ties)), rank, running)

    ties = list(ties)
    columns = df.columns
    cuts, copies = _cut_points(df, survey, measure, descending, ties, slots)
    if copies:
        # Rows equal in the whole order key fill more than a slot. Any order
        # among them will do, but it must not change: the other columns tell them apart.
        ties.append("_hash")
        df = df.withColumn("_hash", F.xxhash64(*columns))
        cuts, copies = _cut_points(df, survey, measure, descending, ties, slots)
    if copies:
        # So do copies of one whole row: number and store them.
        ties.append("_copy")
        df = df.withColumn("_copy", F.monotonically_increasing_id()).checkpoint()
        cuts, _ = _cut_points(df, survey, measure, descending, ties, slots)

    moved = _with_slot(df, cuts, measure, descending, ties).repartitionById(cuts.slots, F.col("_slot"))
    # One for each row, by an expression that names every column: so that both
    # readers of the exchange want the same of it, and rows move only once.
    one = F.lit(1) + F.xxhash64(*moved.columns).bitwiseAND(F.lit(0))
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slot.
    offsets = (
        moved.groupBy("_slot")
        .agg(F.sum(one).alias("_rows"), *[_sum(df, c).alias(f"_sum_{n}") for n, c in running.items()])
        .select(
            "_slot",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rank_before"),
            *[F.try_sum(f"_sum_{n}").over(before).alias(f"_before_{n}") for n in running],
        )
    )
    inside = Window.partitionBy("_slot").orderBy(*_order(measure, descending, ties))
    placed = _within(
        moved, inside, "_row" if rank else None, {f"_inside_{n}": c for n, c in running.items()}
    ).join(F.broadcast(offsets), "_slot")

    totals = {
        n: F.coalesce(
            F.col(f"_inside_{n}") + F.coalesce(f"_before_{n}", F.lit(0)),
            f"_before_{n}",
        )
        for n in running
    }
    if rank:
        totals[rank] = F.col("_row") + F.col("_rank_before")
    kept = [c for c in columns if c not in totals]
    return placed.select(*kept, *[value.alias(n) for n, value in totals.items()])


def running_by_rank(df: DataFrame, rank: str, running: Mapping[str, str]) -> DataFrame:
    """Add running sums ``{new column: summed column}`` to rows that hold their rank, 1..n.

    Slots are ranges of ranks, so nothing is counted, sampled or ordered over
    the table: one shuffle by slot, and one row per slot for the sums before it.
    """
    return _exactly(df, running, lambda df, sums: _running_by_rank(df, rank, sums))


def _running_by_rank(df, rank, running) -> DataFrame:
    slotted = df.withColumn("_slot", F.floor((F.col(rank) - 1) / ROWS_PER_SLOT[1]).cast("bigint"))
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slotted.groupBy("_slot").agg(*[_sum(df, c).alias(f"_sum_{n}") for n, c in running.items()])
        .select("_slot", *[F.try_sum(f"_sum_{n}").over(before).alias(f"_before_{n}") for n in running])
    )
    inside = Window.partitionBy("_slot").orderBy(rank)
    placed = _within(slotted, inside, None, {f"_inside_{n}": c for n, c in running.items()})
    sums = [
        F.coalesce(F.col(f"_inside_{n}") + F.coalesce(f"_before_{n}", F.lit(0)), f"_before_{n}").alias(n)
        for n in running
    ]
    return placed.join(offsets, "_slot").select(*df.columns, *sums)


def _exactly(df: DataFrame, running: Mapping[str, str], summed, added: Sequence[str] = ()) -> DataFrame:
    """Running sums of doubles by way of decimals, which have the same bits however the rows are cut into slots.

    Up to the first value or sum that has no room in a decimal; from there on it is the plain sum.
    """
    doubles = [n for n, c in running.items() if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
    if not doubles:
        return summed(df, running)
    parts = {}
    for n in doubles:
        value = F.col(running[n]).cast("double")
        decimal = exact(value)
        parts |= {f"_d_{n}": decimal, f"_p_{n}": value, f"_u_{n}": (value.isNotNull() & decimal.isNull()).cast("bigint")}
    sums = {n: c for n, c in running.items() if n not in doubles}
    found = summed(df.withColumns(parts), sums | {f"_s{p}": p for p in parts})

    def total(n):
        decimal, plain = F.col(f"_s_d_{n}").cast("double"), F.col(f"_s_p_{n}")
        # A sum that had no room somewhere is off by far more than rounding.
        sound = (F.col(f"_s_u_{n}") == 0) & (F.abs(decimal - plain) < 1e9)
        return F.coalesce(F.when(sound, decimal), plain)

    totals = {n: total(n) if n in doubles else F.col(n) for n in running}
    kept = [c for c in df.columns if c not in running and c not in added]
    return found.select(*kept, *[value.alias(n) for n, value in totals.items()], *added)


def _slots_for(total: int, cores: int) -> int:
    """One slot per core, within the bounds on rows per slot and on slots."""
    least, most = ROWS_PER_SLOT
    return min(MAX_SLOTS, max(cores, math.ceil(total / most)), math.ceil(total / least))


def _sum(df: DataFrame, column: str) -> Column:
    """A decimal without room for the sum gives NULL, not an error; see ``_exactly``."""
    return F.try_sum(column) if isinstance(df.schema[column].dataType, T.DecimalType) else F.sum(column)


def _within(df, window, rank, running):
    added = {
        n: _sum(df, c).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        for n, c in running.items()
    }
    if rank:
        added[rank] = F.row_number().over(window).cast("bigint")
    return df.withColumns(added)


def _order(measure, descending, ties):
    first = F.col(measure).desc_nulls_last() if descending else F.col(measure).asc_nulls_first()
    return [first, *[F.col(t).asc_nulls_first() for t in ties]]


def _key(measure, descending, ties) -> Column:
    """What the order compares, raw: where NULL goes, the value, and the ties."""
    value = F.col(measure)
    return F.struct(
        F.when(value.isNull(), 2 if descending else 0).otherwise(1).alias("group"),
        value.alias("value"),
        F.struct(F.lit(0).alias("none"), *[F.col(t).alias(f"tie{i}") for i, t in enumerate(ties)]).alias("ties"),
    )


def _behind(one: Column, other: Column, descending: bool, or_equal: bool) -> Column:
    """Whether one key comes after another; values compare as Spark sorts them, NaN above all numbers."""
    value = one["value"] < other["value"] if descending else one["value"] > other["value"]
    ties = one["ties"] >= other["ties"] if or_equal else one["ties"] > other["ties"]
    same = one["value"].eqNullSafe(other["value"])
    inside = F.coalesce(value, F.lit(False)) | (same & ties)
    return (one["group"] > other["group"]) | ((one["group"] == other["group"]) & inside)


@dataclass
class Survey:
    """What one reading of the order column tells."""

    #: Rows before the numbers, with a number, and behind them: NULL on one end, NaN on the upper one of the values.
    groups: tuple[int, int, int]
    sketch: bytes | None
    real: bool
    #: Parts that the sketch can still tell apart.
    finest: int

    @property
    def rows(self) -> int:
        return sum(self.groups)


@dataclass
class Cuts:
    """Cut points between slots.

    Slots go by group. Among the numbers, ``images`` cut where a number begins
    and ``keys`` cut the rows of one number, or of a group without numbers:
    ``keyed[0]`` those before the numbers, ``keyed[1 + i]`` those of
    ``images[i]``, ``keyed[-1]`` those behind.
    """

    images: list = field(default_factory=list)
    keyed: list[list[Row]] = field(default_factory=list)

    @property
    def slots(self) -> int:
        return len(self.images) + sum(map(len, self.keyed)) + 3


def _image(measure: str, kind: T.DataType) -> tuple[Column, bool]:
    """The measure as a number that never falls where the measure rises, and whether it is a double.

    Types without such a number share one, so all cuts are by the whole key.
    """
    value = F.col(measure)
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return value.cast("double") + F.lit(0.0), True
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return value.cast("bigint"), False
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("bigint"), False
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint"), False
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value), False
    if type(kind) in (T.StringType, T.BinaryType):
        first = F.hex(F.substring(value.cast("binary"), 1, 7))
        return F.conv(F.rpad(first, 14, "0"), 16, 10).cast("bigint"), False
    return F.when(value.isNotNull(), F.lit(0).cast("bigint")), False


def _group(measure: str, kind: T.DataType, descending: bool) -> Column:
    """0, 1 or 2: before, among or behind the rows that have a number."""
    value = F.col(measure)
    group = F.when(value.isNull(), 2 if descending else 0)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        group = group.when(F.isnan(value), 0 if descending else 2)
    return group.otherwise(1)


def _survey(df: DataFrame, measure: str, descending: bool) -> Survey:
    """Rows by group and the quantile sketch, in one aggregate."""
    kind = df.schema[measure].dataType
    (image, real), group = _image(measure, kind), _group(measure, kind, descending)
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = max(SKETCH_SIZE[0], min(SKETCH_SIZE[1], 128 * cores))
    sketch = F.kll_sketch_agg_double if real else F.kll_sketch_agg_bigint
    found = (
        df.select(group.alias("g"), F.when(group == 1, image).alias("image"))
        .agg(*[F.count_if(F.col("g") == i).alias(f"g{i}") for i in range(3)], sketch("image", size).alias("sketch"))
        .first()
    )
    return Survey((found.g0, found.g1, found.g2), found.sketch if found.g1 else None, real, size // 2)


def _quantiles(df: DataFrame, survey: Survey, parts: int) -> list:
    """The values that cut the numbers into ``parts``; worked out without a job."""
    if not survey.groups[1] or parts < 2:
        return []
    ranks = F.lit([i / parts for i in range(1, parts)])
    quantile = F.kll_sketch_get_quantile_double if survey.real else F.kll_sketch_get_quantile_bigint
    return df.sparkSession.sql("SELECT * FROM VALUES (1) AS one(x)").select(quantile(F.lit(survey.sketch), ranks).alias("q")).first().q


def _cut_points(df, survey: Survey, measure, descending, ties, slots) -> tuple[Cuts, bool]:
    """Cut points for about ``slots`` slots, and whether one key alone fills a slot."""
    per_slot = survey.rows / slots
    before, numbers, behind = survey.groups
    found = Counter(_quantiles(df, survey, min(survey.finest, round(numbers / per_slot))))
    images = sorted(found, reverse=descending)
    # A number that is cut point more than once holds slots of its own.
    parts = [round(before / per_slot), *[found[i] + 1 if found[i] > 1 else 1 for i in images], round(behind / per_slot)]
    cuts = Cuts(images, [[] for _ in parts])
    hot = {i: n for i, n in enumerate(parts) if n > 1}
    copies = False
    for which, sampled, keys in _hot_keys(df, measure, descending, ties, images, hot, per_slot):
        cuts.keyed[which] = [k for j, k in enumerate(keys) if j == 0 or k != keys[j - 1]]
        copies |= len(cuts.keyed[which]) < len(keys) and sampled >= hot[which] * SAMPLE_PER_SLOT // 2
    return cuts, copies


def _hot_keys(df, measure, descending, ties, images, hot: dict[int, int], per_slot) -> list:
    """(place in ``Cuts.keyed``, rows sampled, keys that cut them evenly) for values that hold slots of their own."""
    if not hot:
        return []
    kind = df.schema[measure].dataType
    (image, _), group = _image(measure, kind), _group(measure, kind, descending)
    numbers = {images[i - 1]: i for i in hot if 0 < i <= len(images)}
    wanted = (group == 1) & image.isin(list(numbers)) if numbers else F.lit(False)
    ends = {0: 0, 2: len(images) + 1}
    for g, place in ends.items():
        if place in hot:
            wanted = wanted | (group == g)
    places = F.when(group == 0, ends[0]).when(group == 2, ends[2])
    if numbers:
        at = F.array_position(_points(list(numbers)), image).cast("int") - 1
        places = places.otherwise(F.get(F.lit(list(numbers.values())), at))
    parts = F.get(F.lit([hot.get(i, 0) for i in range(len(images) + 2)]), F.col("place"))

    def in_order(one, other):
        after = _behind(one, other, descending, or_equal=False)
        return F.when(after, 1).when(_behind(other, one, descending, or_equal=False), -1).otherwise(0)

    sampled = (
        df.where(wanted).sample(min(1.0, SAMPLE_PER_SLOT / per_slot), seed=7)
        .select(places.alias("place"), _key(measure, descending, ties).alias("k"))
        .groupBy("place").agg(F.array_sort(F.collect_list("k"), in_order).alias("s"))
    )
    chosen = F.transform(
        F.sequence(F.lit(1), parts - 1),
        lambda i: F.get("s", F.floor(F.size("s").cast("bigint") * i / parts).cast("int")),
    )
    return sampled.select("place", F.size("s"), chosen).collect()


def _with_slot(df, cuts: Cuts, measure, descending, ties) -> DataFrame:
    """Number of cut points at or before the row's key."""
    kind = df.schema[measure].dataType
    (image, _), group = _image(measure, kind), _group(measure, kind, descending)
    lengths = list(map(len, cuts.keyed))
    n = len(cuts.images)
    # By the number of images at or before a row's: the slots before, and of the last of those images its keys.
    starts = list(accumulate(lengths, initial=0))
    first = [1 + j + starts[1 + j] for j in range(n + 1)]
    ends = {0: 0, 2: first[n] + 1}
    df = df.withColumns({"_image": image, "_group": group})
    passed = (lambda x, p: x <= p) if descending else (lambda x, p: x >= p)
    if n <= MAX_NESTED:
        at = _nested(F.col("_image"), cuts.images, passed, 0, n)
    else:
        points = _points(cuts.images)
        at = _searched(points, F.lit(0), F.lit(n), n, lambda p: passed(F.col("_image"), p))
    df = df.withColumn("_at", F.when(F.col("_group") == 0, -1).when(F.col("_group") == 2, n).otherwise(at))
    ahead = F.when(F.col("_group") == 0, ends[0]).when(F.col("_group") == 2, ends[2]).otherwise(F.get(F.lit(first), F.col("_at")))
    if not any(lengths):
        return df.withColumn("_slot", _given(ahead)).drop("_image", "_group", "_at")

    # Rows of an image that has keys, or of a group that has some, search among those.
    place = F.when(F.col("_group") == 0, 0).when(F.col("_group") == 2, n + 1).otherwise(F.col("_at"))
    mine = F.col("_group") != 1
    if n:
        mine = mine | (F.get(_points(cuts.images), F.col("_at") - 1) == F.col("_image"))
    own = F.when(mine, F.get(F.lit(lengths), place)).otherwise(0)
    # An image's keys lie behind its own cut, which counts the slots of all of them as ahead.
    passed_by = F.when(mine & (F.col("_group") == 1), F.get(F.lit(lengths), place)).otherwise(0)
    key = _key(measure, descending, ties)
    df = df.withColumns({"_own": own, "_from": F.get(F.lit(starts), place), "_ahead": ahead - passed_by, "_key": key})
    points = T.StructType([T.StructField("cuts", T.ArrayType(df.schema["_key"].dataType))])
    row = df.sparkSession.createDataFrame([([k for keys in cuts.keyed for k in keys],)], points)
    df = df.withColumn("_cuts", row.scalar())
    inner = _searched(
        F.col("_cuts"), F.col("_from"), F.col("_own"), max(lengths),
        lambda p: _behind(F.col("_key"), p, descending, or_equal=True),
    )
    slot = F.col("_ahead") + F.when(F.col("_own") > 0, inner).otherwise(0)
    return df.withColumn("_slot", _given(slot)).drop("_image", "_group", "_at", "_own", "_from", "_ahead", "_key", "_cuts")


def _given(slot: Column) -> Column:
    """A slot that is never NULL for the optimizer either: a test for it would go below one reading of the exchange only."""
    return F.coalesce(slot.cast("int"), F.lit(0))


def _points(images: list) -> Column:
    return F.lit(images).cast("array<double>" if isinstance(images[0], float) else "array<bigint>")


def _nested(value: Column, points: list, passed, low: int, high: int) -> Column:
    """Number of sorted points that the value has passed, ``low`` at least and ``high`` at most."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(
        passed(value, F.lit(points[middle])), _nested(value, points, passed, middle + 1, high)
    ).otherwise(_nested(value, points, passed, low, middle))


def _searched(points: Column, start: Column, n: Column, most: int, passed) -> Column:
    """The same among the ``n`` points of an array from ``start`` on, by binary search.

    The search is one expression: written as a column for each step, the
    optimizer would put every step several times into the next.
    """
    steps = [F.lit(1 << bit) for bit in reversed(range(max(1, most.bit_length())))]

    def onward(found, step):
        ahead = F.array(F.get(points, start + found + step - 1))
        taken = F.transform(ahead, lambda p: F.when((found + step <= n) & passed(p), step).otherwise(0))
        return found + F.get(taken, F.lit(0))

    return F.aggregate(F.array(*steps), F.lit(0), onward)
