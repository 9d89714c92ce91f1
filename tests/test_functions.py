import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType

from feederlens.functions import bands, numbers as N, picks as P
from feederlens.plans import gold
from feederlens import settings as S


def one(spark, expression, **values):
    """Value of an expression over one row of text or double cells."""
    cells = [
        F.lit(v).cast("string" if isinstance(v, str) else "double").alias(k)
        for k, v in values.items()
    ]
    return spark.range(1).select(*cells).select(expression).first()[0]


@pytest.mark.parametrize("text,number", [
    ("12", 12.0), (" 1.5 ", 1.5), ("1e3", 1000.0), ("-.5", -0.5), ("+7.", 7.0),
    ("\t3\n", 3.0), ("inf", math.inf), ("-Infinity", -math.inf),
    ("abc", None), ("1,000", None), ("1.5d", None), ("2f", None), ("0x10", None),
    ("NaN", None), ("nan", None), ("", None), ("  ", None), ("1 2", None), ("e5", None),
])
def test_to_number_of_text(spark, text, number):
    assert one(spark, N.to_number(F.col("x"), StringType()), x=text) == number


def test_to_number_never_yields_nan(spark):
    assert one(spark, N.to_number(F.col("x"), DoubleType()), x=math.nan) is None


@pytest.mark.parametrize("text,terminal", [("1", 1), ("2.0", 2), ("1.5", None), ("x", None)])
def test_to_terminal(spark, text, terminal):
    assert one(spark, N.to_terminal(F.col("x"), StringType()), x=text) == terminal


def test_to_terminal_of_int(spark):
    df = spark.range(1).select(F.lit(2).alias("x"))
    assert df.select(N.to_terminal(F.col("x"), IntegerType())).first()[0] == 2


@pytest.mark.parametrize("cells,mean,spread", [
    ((1.0, 2.0, 6.0), 3.0, 5.0),
    ((210.0, 216.0, None), 213.0, 6.0),
    ((0.0, None, 4.0), 2.0, 4.0),
    ((None, None, None), None, None),
])
def test_row_statistics_skip_missing(spark, cells, mean, spread):
    values = dict(zip("abc", cells))
    columns = [F.col(c) for c in "abc"]
    assert one(spark, N.row_mean(*columns), **values) == mean
    assert one(spark, N.spread(*columns), **values) == spread


def test_ratios_are_null_without_a_base(spark):
    assert one(spark, N.percent_of(F.col("p"), F.col("w")), p=1.0, w=0.0) is None
    assert one(spark, N.percent_of(F.col("p"), F.col("w")), p=1.0, w=None) is None
    assert one(spark, N.per_unit(F.col("p"), F.col("w")), p=3.0, w=2.0) == 1.5


def test_power_triangle(spark):
    assert one(spark, N.apparent_power(F.col("p"), F.col("q")), p=3.0, q=4.0) == 5.0
    assert one(spark, N.power_factor(F.col("p"), F.col("s")), p=-3.0, s=5.0) == -0.6
    assert one(spark, N.power_factor(F.col("p"), F.col("s")), p=0.0, s=0.0) is None


@pytest.mark.parametrize("kv,level", [
    (30.0, "33kV_HT"), (33.0, "33kV_HT"), (20.0, "11kV_HT"), (1.0, "11kV_HT"),
    (0.99, "415V_LT"), (0.0, "415V_LT"), (-5.0, "415V_LT"),
    (25.0, "Unknown"), (20.01, "Unknown"), (None, "Unknown"),
])
def test_network_level(spark, kv, level):
    assert one(spark, bands.band(F.col("x"), S.LEVEL_BANDS, S.LEVEL_DEFAULT), x=kv) == level


@pytest.mark.parametrize("pu,status", [
    (0.8999, "Severe Deviation"), (0.90, "Low Voltage"), (0.9499, "Low Voltage"),
    (0.95, "Within Range"), (1.20, "Within Range"), (None, "Within Range"),
])
def test_voltage_status(spark, pu, status):
    assert one(spark, gold.voltage_status(F.col("x")), x=pu) == status


@pytest.mark.parametrize("percent,status", [
    (1.0, "High Unbalance"), (0.5, "Moderate Unbalance"), (0.4999, "Low Unbalance"),
    (None, "Low Unbalance"),
])
def test_unbalance_status(spark, percent, status):
    assert one(spark, gold.unbalance_status(F.col("x")), x=percent) == status


@pytest.mark.parametrize("percent,loading,capacity", [
    (100.1, "Overloaded", "Above Normal Rating"),
    (100.0, "High Loading", "High Utilization"),
    (80.1, "High Loading", "High Utilization"),
    (80.0, "Normal / Not Rated", "High Utilization"),
    (79.9, "Normal / Not Rated", "Within Reported Rating"),
    (None, "Normal / Not Rated", "Rating Not Available"),
])
def test_loading_and_capacity_differ_at_80(spark, percent, loading, capacity):
    assert one(spark, gold.loading_status(F.col("x")), x=percent) == loading
    assert one(spark, gold.capacity_status(F.col("x")), x=percent) == capacity


@pytest.mark.parametrize("name,loading,power", [
    ("Transformer.T1", "Transformer", "Transformer"), ("Line.L1", "Line", "Line"),
    ("Vsource.S", "Source", "Source"), ("Load.X", "Other", "Pump Load"),
    ("line.x", "Other", "Other"), ("Transformer", "Other", "Other"),
])
def test_asset_type(spark, name, loading, power):
    assert one(spark, gold.loading_type(F.col("x")), x=name) == loading
    assert one(spark, gold.power_type(F.col("x")), x=name) == power


def test_band_without_rules_is_the_default(spark):
    assert one(spark, bands.band(F.col("x"), (), "none"), x=1.0) == "none"


def test_picks(spark):
    df = spark.createDataFrame(
        [("c", 1.0), ("a", 1.0), ("b", None), ("z", 9.0), ("y", 9.0)], "name string, x double"
    )
    name, x = F.col("name"), F.col("x")
    picked = df.agg(P.name_of_lowest(name, x), P.count_where(x > 1)).first()
    assert tuple(picked) == ("a", 2)
    assert [tuple(r) for r in P.name_of_highest(df, "name", "x", "top").collect()] == [("y",)]


@pytest.mark.parametrize("kind,low,high", [
    ("bigint", -(1 << 63), 5), ("bigint", -(1 << 63), -(1 << 63) + 1), ("string", "9", "a"),
    ("date", dt.date(1, 1, 1), dt.date(2020, 1, 1)), ("boolean", False, True),
])
def test_highest_of_any_type(spark, kind, low, high):
    df = spark.createDataFrame([("b", high), ("a", high), ("c", low), ("d", None)], f"name string, x {kind}")
    assert P.name_of_highest(df, "name", "x", "top").first()["top"] == "a"
    assert P.name_of_highest(df.where("name >= 'c'"), "name", "x", "top").first()["top"] == "c"
    assert P.name_of_highest(df.limit(0), "name", "x", "top").first()["top"] is None


def test_picks_over_nothing_are_null(spark):
    df = spark.createDataFrame([], "name string, x double")
    picked = df.agg(
        P.name_of_lowest(F.col("name"), F.col("x")), P.count_where(F.col("x") > 1), F.count("*")
    ).first()
    assert tuple(picked) == (None, None, 0)
