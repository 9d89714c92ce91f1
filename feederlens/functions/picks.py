"""Aggregates used by marts and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feederlens.functions.numbers import exact


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; NULL (not 0) over an empty input."""
    return F.sum(F.when(condition, 1).otherwise(0))


def exact_sum(measure: str) -> Column:
    """Sum of a double column with the same bits for any order of rows and any partitions.

    Decimals are summed without rounding. With a value or a sum beyond their
    18 digits before the point, it is the plain sum.
    """
    decimal = exact(F.col(measure))
    all_fit = F.count(measure) == F.count(decimal)
    return F.coalesce(F.when(all_fit, F.try_sum(decimal).cast("double")), F.sum(measure))


def exact_mean(measure: str) -> Column:
    return F.try_divide(exact_sum(measure), F.count(measure))


def name_of_lowest(name: Column, measure: Column) -> Column:
    """Name of the row with the lowest measure; of equal rows, the first name."""
    return F.min(F.when(measure.isNotNull(), F.struct(measure, name.alias("name"))))["name"]


def name_of_highest(df: DataFrame, name: str, measure: str, alias: str) -> DataFrame:
    """One row: name of the row with the highest measure, of any type; of equal rows, the first name."""
    highest = df.agg(F.max(measure)).scalar()
    return df.filter(F.col(measure) == highest).agg(F.min(name).alias(alias))
