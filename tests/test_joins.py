import pytest
from pyspark.sql import functions as F

from feederlens.operators import joins as J
from feederlens.operators.shares import share_of_total


@pytest.fixture(scope="module")
def star(spark):
    """Fact rows of which a third share one key and some have none."""
    fact = spark.range(6000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 != 1, F.concat(F.lit("k"), (F.col("id") % 900).cast("string")))
        .alias("bus"),
    )
    first = spark.createDataFrame([("hot", 1.0), ("k1", 2.0), ("k1", 3.0), ("none", 9.0)], "bus string, a double")
    second = spark.createDataFrame([("hot", "u"), ("hot", "v"), ("k2", "w")], "bus string, b string")
    return fact, [first, second]


def grid_of(inputs, key, partitions):
    return {r[0]: tuple(r)[1:] for r in J._grid(inputs, key, partitions).collect()}


def test_frequent_names_are_those_that_are_there(star):
    fact, _ = star
    found = {r["name"]: r["rows"] for r in J._frequent(fact, "bus", 4).collect()}
    counts = {r["bus"]: r["count"] for r in fact.where("bus is not null").groupBy("bus").count().collect()}
    assert found["hot"] == counts["hot"] and set(found) <= set(counts) and len(found) == 100


@pytest.mark.parametrize("partitions", [4, 50, 1000])
def test_names_with_large_results_are_split(star, partitions):
    fact, sides = star
    grid = grid_of([fact, *sides], "bus", partitions)
    counts = [{r["bus"]: r["count"] for r in df.where("bus is not null").groupBy("bus").count().collect()} for df in (fact, *sides)]
    result = {k: n * counts[1].get(k, 1) * counts[2].get(k, 1) for k, n in counts[0].items()}
    total = sum(result.values())
    for name, n in result.items():
        if n > 1.1 * max(1, J.SPLIT_FROM * total / partitions):
            parts = grid[name]
            cells = parts[0] * parts[1] * parts[2]
            # Rows of one cell, of a key that has that many.
            assert n / cells <= max(4.0, J.SPLIT_FROM * total / partitions)
            assert all(p <= c.get(name, 1) for p, c in zip(parts, counts, strict=True))
    assert "hot" in grid and len(grid) < 4 * J.CELLS_PER_SPLIT * partitions


def test_both_sides_of_a_hot_name_are_dealt(spark):
    fact = spark.range(3000).select("id", F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("bus"))
    side = spark.range(1500).select(F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("bus"), F.col("id").alias("a"))
    [parts] = grid_of([fact, side], "bus", 8).values()
    assert parts[0] > 3 and parts[1] > 3 and parts[0] * parts[1] >= 8 * J.CELLS_PER_SPLIT


@pytest.mark.parametrize("fact_rows,side_rows", [(100, 1000), (1000, 100), (100_000, 1), (1, 50_000)])
def test_no_task_has_twice_the_mean(spark, rows, fact_rows, side_rows):
    """A name that is hot in a side, in the fact table, or in both, with adaptive execution off."""
    names = F.when(F.col("id") < 0, "").otherwise(F.concat(F.lit("n"), F.col("id").cast("string")))
    fact = spark.range(fact_rows).select("id", F.lit("hot").alias("bus")).union(spark.range(400).select("id", names))
    side = spark.range(side_rows).select(F.lit("hot").alias("bus"), F.col("id").alias("a")).union(spark.range(300).select(names, "id"))
    other = spark.createDataFrame([("hot", "u"), ("hot", "v"), ("n1", "w"), ("n350", None)], "bus string, b string")
    settings = {"spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = J.left_star(fact, [side, other], "bus")
        tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain = fact.join(side, "bus", "left").join(other, "bus", "left").select(*joined.columns)
        total = fact_rows * side_rows * 2 + 400
        assert sum(tasks) == plain.count() == total
        assert max(tasks) < 2 * total / 8
        digest = [F.sum(F.xxhash64(*plain.columns).cast("decimal(38,0)")), F.sum("id"), F.count("a"), F.count("b")]
        assert joined.agg(*digest).first() == plain.agg(*digest).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_names_may_be_counted_elsewhere(spark, star, rows):
    fact, (first, second) = star
    many = spark.range(100).select(F.lit("k7").alias("bus"))
    named = [many, first.union(first).select("bus"), second.select("bus")]
    assert rows(J.left_star(fact, [first, second], "bus", named)) == rows(J.left_star(fact, [first, second], "bus"))


def test_no_job_when_the_plan_is_built(spark, star):
    fact, sides = star
    spark.sparkContext.setJobGroup("star", "")
    J.left_star(fact, sides, "bus")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("star")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


@pytest.mark.parametrize("partitions", ["1", "4", "60"])
def test_splitting_a_hot_key_changes_nothing(spark, star, rows, partitions):
    fact, (first, second) = star
    plain = fact.join(first, "bus", "left").join(second, "bus", "left").select("id", "bus", "a", "b")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        split = J.left_star(fact, [first, second], "bus")
        assert split.columns == plain.columns
        assert rows(split) == rows(plain)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert plain.count() > fact.count()


def test_a_hot_key_lands_in_several_tasks(spark, star):
    fact, sides = star
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in {"spark.sql.shuffle.partitions": "30", "spark.sql.autoBroadcastJoinThreshold": "-1",
                       "spark.sql.adaptive.enabled": "false"}.items():
        spark.conf.set(key, value)
    try:
        joined = J.left_star(fact, sides, "bus").where("bus = 'hot'")
        assert joined.select(F.spark_partition_id().alias("p")).distinct().count() >= 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_star_of_empty_tables(spark):
    none = spark.createDataFrame([], "bus string, x int")
    assert J.left_star(none, [none.withColumnRenamed("x", "y")], "bus").collect() == []


def test_with_values_adds_one_row_to_every_row(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    added = J.with_values(df, df.agg(F.sum("x").alias("t"), F.max("x").alias("m")))
    assert rows(added) == [(1, 3, 2), (2, 3, 2)]
    plan = added._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_shares(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", 3.0, 0.0), ("c", None, 0.0)], "n string, x double, z double")
    shared = share_of_total(df, {"xs": "x", "zs": "z"}, {"xt": "x", "zt": "z"})
    assert rows(shared.select("n", "xt", "xs", "zs")) == [
        ("a", 4.0, 25.0, None), ("b", 4.0, 75.0, None), ("c", 4.0, None, None),
    ]
