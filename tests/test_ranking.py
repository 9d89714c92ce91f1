import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from feederlens.functions.picks import exact_mean, exact_sum
from feederlens.operators import ranking as R


@pytest.fixture(scope="module")
def measures(spark):
    """Heavy ties, NULLs, and one value that holds a third of the rows."""
    pick = random.Random(5)
    values = [
        (i, f"n{pick.randrange(4000):05d}",
         None if i % 11 == 0 else 7.0 if i % 3 == 0 else float(pick.randrange(-40, 40)),
         float(pick.randrange(10)) if i % 13 else None)
        for i in range(6000)
    ]
    pick.shuffle(values)
    return spark.createDataFrame(values, "id int, name string, x double, y double").repartition(5)


def ordered(data, descending):
    """Rows in rank order, worked out in Python."""
    sign = -1 if descending else 1

    def key(row):
        _, name, x, _ = row
        missing = (x is None) if descending else (x is not None)
        return (missing, sign * (x or 0.0), name, row[0])

    return sorted(data, key=key)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("slots", [1, 4, 30])
def test_rank_and_running_sum(measures, descending, slots):
    data = [tuple(r) for r in measures.collect()]
    result = R.ordered_totals(
        measures, "x", descending, ties=["name", "id"], rank="r", running={"total": "y"},
        slots=slots,
    )
    assert result.columns == ["id", "name", "x", "y", "total", "r"]
    found = {r.id: (r.r, r.total) for r in result.collect()}
    so_far, any_seen = 0.0, False
    for place, (i, _, _, y) in enumerate(ordered(data, descending), 1):
        so_far, any_seen = so_far + (y or 0.0), any_seen or y is not None
        assert found[i] == (place, so_far if any_seen else None)


@pytest.mark.parametrize("descending", [False, True])
def test_nan_and_signed_zero_rank_as_spark_sorts_them(spark, descending):
    value = (
        F.when(F.col("id") % 5 == 0, float("nan")).when(F.col("id") % 5 == 1, None)
        .when(F.col("id") % 5 == 2, F.lit(-0.0)).when(F.col("id") % 5 == 3, F.lit(0.0))
        .otherwise(F.col("id") - 200)
    )
    df = spark.range(400).select("id", value.cast("double").alias("x"))
    in_slots = R.global_rank(df, "x", "r", descending, ["id"], slots=20)
    plain = R.global_rank(df, "x", "r", descending, ["id"], slots=1)
    assert dict(in_slots.select("id", "r").collect()) == dict(plain.select("id", "r").collect())


def test_ranks_of_whole_numbers_and_decimals(spark):
    df = spark.range(300).select("id", (F.col("id") % 7).alias("n"), (F.col("id") % 9).cast("decimal(9,2)").alias("d"))
    for measure in ("n", "d"):
        in_slots = R.global_rank(df, measure, "r", True, ["id"], slots=9)
        plain = R.global_rank(df, measure, "r", True, ["id"], slots=1)
        assert dict(in_slots.select("id", "r").collect()) == dict(plain.select("id", "r").collect())


def test_many_slots_leave_some_empty(spark):
    few = spark.range(50).select("id", F.lit(1.5).alias("x"))
    ranked = R.global_rank(few, "x", "r", ties=["id"], slots=50)
    assert [(r.id, r.r) for r in ranked.orderBy("r").collect()] == [(i, i + 1) for i in range(50)]


def test_rows_equal_in_the_whole_key_are_numbered_once(spark):
    df = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias("x"), F.lit("n").alias("n"))
    ranked = R.global_rank(df, "x", "r", ties=["n"], slots=30)
    assert ranked.columns == ["x", "n", "r"]
    by_rank = [(r.r, r.x) for r in ranked.orderBy("r").collect()]
    assert by_rank == [(i + 1, 0 if i < 2000 else 1) for i in range(3000)]


def slotted(df, descending, ties, slots):
    survey = R._survey(df, "x", descending)
    cuts, copies = R._cut_points(df, survey, "x", descending, ties, slots)
    sizes = [r["count"] for r in R._with_slot(df, cuts, "x", descending, ties).groupBy("_slot").count().collect()]
    return cuts, copies, sizes


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("value", [3.0, None, float("nan")])
def test_a_hot_value_is_split_by_its_ties(measures, value, descending):
    hot = measures.withColumn("x", F.lit(value).cast("double"))
    cuts, copies, sizes = slotted(hot, descending, ["name", "id"], 12)
    assert not copies and sum(sizes) == 6000
    assert 10 <= len(sizes) <= 14 and max(sizes) < 2 * 6000 / 12
    assert cuts.slots >= len(sizes)


@pytest.mark.parametrize("descending", [False, True])
def test_slots_are_even_with_and_without_hot_values(spark, measures, descending):
    _, copies, sizes = slotted(measures, descending, ["name", "id"], 20)
    assert not copies and sum(sizes) == 6000 and max(sizes) < 2.5 * 6000 / 20
    plain = spark.range(100_000).select("id", (F.xxhash64("id") % 1000).alias("x"))
    _, copies, sizes = slotted(plain, descending, ["id"], 40)
    assert not copies and 38 <= len(sizes) <= 44 and max(sizes) < 1.5 * 100_000 / 40


def jobs_of(spark, run):
    """Jobs that ``run`` starts; without adaptive execution a query is one job."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.sparkContext.setJobGroup("counted", "")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def executed_plan(df):
    """The plan as it ran, with the exchanges that were read again."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("Final Plan"):plan.index("\n+- == Initial Plan ==")]


def test_the_input_is_read_twice(spark, tmp_path):
    """Once for rows and cut points, once for the rows themselves; one job when the plan is built."""
    spark.range(60_000).select("id", (F.xxhash64("id") % 5000).cast("double").alias("x")).repartition(4).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = {}
    assert jobs_of(spark, lambda: found.setdefault("r", R.ordered_totals(
        df, "x", ties=["id"], rank="r", running={"s": "x"}, slots=12))) == 1
    ranked = found["r"].select("*")
    plan = executed_plan(ranked)
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1
    assert ranked.count() == 60_000


def test_the_bucketed_plan_moves_rows_once_and_not_into_one_task(measures):
    plan = executed_plan(R.global_rank(measures, "x", "r", ties=["name", "id"], slots=12))
    single = plan.index("Exchange SinglePartition")
    # The only single-partition step is over per-slot counts.
    assert plan.count("Exchange SinglePartition") == 1
    assert "HashAggregate(keys=[_slot" in plan[single:].splitlines()[1]
    moved = [line for line in plan.splitlines() if "shufflepartitionidpassthrough" in line]
    assert len(moved) == 2 and sum("ReusedExchange" in line for line in moved) == 1
    assert "Python" not in plan and "BatchEval" not in plan


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "id int, x double")
    assert R.global_rank(empty, "x", "r", ties=["id"]).collect() == []
    assert R.global_rank(spark.createDataFrame([(1, None)], "id int, x double"), "x", "r").first().r == 1


def test_rank_is_a_bigint(measures):
    for slots in (1, 12):
        ranked = R.global_rank(measures, "x", "r", ties=["id"], slots=slots)
        assert ranked.schema["r"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("total,cores,slots", [
    (0, 8, 0), (50_000, 8, 1), (50_001, 8, 2), (600_000, 8, 8), (24_000_000, 8, 96),
    (24_000_000, 4000, 480), (10**12, 8000, R.MAX_SLOTS),
])
def test_number_of_slots(total, cores, slots):
    assert R._slots_for(total, cores) == slots


def test_many_slots(spark):
    df = spark.range(150_000).select("id", F.pmod(F.xxhash64("id"), F.lit(10**6)).cast("double").alias("x"))
    cuts, copies, sizes = slotted(df, True, ["id"], 1000)
    assert not copies and len(cuts.images) > R.MAX_NESTED and max(sizes) < 8 * 150
    ranked = R.global_rank(df, "x", "r", descending=True, ties=["id"], slots=500)
    plain = R.global_rank(df, "x", "p", descending=True, ties=["id"], slots=1)
    assert ranked.join(plain, "id").filter("r != p").count() == 0
    assert ranked.count() == 150_000


TYPED = {
    "text": ("string", ["b", "a", None, "10", "9", "", "é"]),
    "date": ("date", [date(2020, 1, 2), None, date(1999, 5, 5), date(2020, 1, 3)]),
    "time": ("timestamp", [datetime(2020, 1, 2, 3), None, datetime(1999, 5, 5), datetime(2020, 1, 2, 4)]),
    "flag": ("boolean", [True, None, False]),
    "exact": ("decimal(12,2)", [Decimal("1.50"), None, Decimal("-3.25"), Decimal("1.49")]),
    "whole": ("bigint", [-(1 << 63), None, 5, (1 << 63) - 1, -1]),
    "real": ("double", [float("nan"), None, 1.5, float("-inf"), -0.0]),
}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind", TYPED)
def test_every_type_ranks_as_the_plain_window(spark, kind, descending):
    of, values = TYPED[kind]
    data = [(values[i * i % len(values)], i) for i in range(3000)]
    df = spark.createDataFrame(data, f"m {of}, id bigint")
    order = F.col("m").desc_nulls_last() if descending else F.col("m").asc_nulls_first()
    plain = df.withColumn("r", F.row_number().over(Window.orderBy(order, "id")).cast("bigint"))
    for slots in (1, 5):
        ranked = R.global_rank(df, "m", "r", descending, ["id"], slots=slots)
        assert ranked.select("id", "r").exceptAll(plain.select("id", "r")).isEmpty()
        assert ranked.count() == 3000


@pytest.mark.parametrize("per_slot", [1, 7, 250_000])
def test_running_by_rank(spark, monkeypatch, per_slot):
    monkeypatch.setattr(R, "ROWS_PER_SLOT", (1, per_slot))
    df = spark.range(1, 101).select(F.col("id").alias("r"), F.when(F.col("id") % 9 != 1, F.col("id")).alias("x"))
    plain = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    found = R.running_by_rank(df.repartition(5), "r", {"s": "x"})
    assert found.columns == ["r", "x", "s"]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, df.withColumn("s", F.sum("x").over(plain)).collect()))


def test_ties_that_other_columns_tell_apart_are_not_stored(spark, monkeypatch):
    df = spark.range(20_000).select("id", F.lit(1.0).alias("x"))
    monkeypatch.setattr(type(df), "checkpoint", lambda *a, **k: pytest.fail("stored"))
    ranked = R.global_rank(df, "x", "place", slots=8)
    assert ranked.columns == ["id", "x", "place"]
    assert sorted(r["place"] for r in ranked.collect()) == list(range(1, 20_001))


@pytest.mark.parametrize("partitions", [1, 8, 60])
def test_sums_have_the_same_bits_for_any_partitions(spark, partitions):
    """Fractions that binary sums round differently in every order, and a value too large for a decimal."""
    data = [(i, 0.1 * (i % 97) + 1e-7 * i, -1e9 / (i % 13 + 1)) for i in range(4000)]
    df = spark.createDataFrame(data, "id int, x double, y double").repartition(partitions)
    exact = {n: sum((Decimal(repr(r[k])) for r in data), Decimal(0)) for n, k in (("x", 1), ("y", 2))}
    total = df.agg(exact_sum("x").alias("x"), exact_sum("y").alias("y"), exact_mean("x").alias("m")).first()
    assert (total.x, total.y) == (float(exact["x"]), float(exact["y"])) and total.m == total.x / 4000
    so_far, want = Decimal(0), {}
    for i, x, _ in data:
        so_far += Decimal(repr(x))
        want[i] = float(so_far)
    for slots in (1, 7, 40):
        found = R.ordered_totals(df, "id", ties=[], rank="r", running={"s": "x"}, slots=slots)
        assert found.columns == ["id", "x", "y", "s", "r"]
        assert {r.id: r.s for r in found.collect()} == want
    ranked = df.withColumn("r", F.col("id") + 1)
    assert {r.id: r.s for r in R.running_by_rank(ranked, "r", {"s": "x"}).collect()} == want


def test_sums_beyond_decimals_are_plain_sums(spark):
    df = spark.createDataFrame([(1, 1.5), (2, 1e300), (3, None), (4, 2.0)], "id int, x double")
    assert df.agg(exact_sum("x")).first()[0] == 1e300
    assert df.where("id = 3").agg(exact_sum("x"), exact_mean("x")).first()[:] == (None, None)
    for slots in (1, 3):
        found = R.ordered_totals(df, "id", running={"s": "x"}, slots=slots).collect()
        assert {r.id: r.s for r in found} == {1: 1.5, 2: 1e300, 3: 1e300, 4: 1e300}


@pytest.mark.parametrize("descending", [False, True])
def test_ranked_rows_lie_in_rank_order(measures, descending):
    ranked = R.global_rank(measures, "x", "r", descending, ["name", "id"], slots=12)
    assert [r.r for r in ranked.collect()] == list(range(1, 6001))
    assert "rangepartitioning" not in ranked._jdf.queryExecution().executedPlan().toString()
