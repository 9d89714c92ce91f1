"""Shares of a column total."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from feederlens.functions.numbers import percent_of
from feederlens.functions.picks import exact_sum
from feederlens.operators.joins import with_values


def share_of_total(
    df: DataFrame,
    shares: Mapping[str, str],
    totals: Mapping[str, str],
    of: DataFrame | None = None,
) -> DataFrame:
    """Add column totals ``{new: column}`` and shares ``{new: column}`` in percent.

    Every shared column needs a total. The totals are one aggregate, taken from
    ``of`` if given (the same rows before a costly step), and NULL shares follow
    from a total of 0.
    """
    total_of = {column: total for total, column in totals.items()}
    source = df if of is None else of
    one_row = source.agg(*[exact_sum(column).alias(total) for total, column in totals.items()])
    return with_values(df, one_row).withColumns({
        share: percent_of(F.col(column), F.col(total_of[column]))
        for share, column in shares.items()
    })
