"""Row-wise numeric expressions. Missing stays NULL, and no NaN comes out."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, StringType

from feederlens.settings import KEY_WHITESPACE, NUMBER_PATTERN


def strip(text: Column) -> Column:
    """Remove latin-1 whitespace from both ends."""
    return F.trim(text, F.lit(KEY_WHITESPACE))


def to_number(value: Column, dtype: DataType) -> Column:
    """Read a column as double; text that is not a plain number becomes NULL."""
    if isinstance(dtype, StringType):
        # The guard turns away text Spark would take ("1.5d", "0x1p3", "NaN").
        return F.when(value.rlike(NUMBER_PATTERN), strip(value).try_cast("double"))
    return F.nanvl(value.cast("double"), F.lit(None))


def to_terminal(value: Column, dtype: DataType) -> Column:
    """Read a terminal number as int; fractions and bad text become NULL."""
    number = to_number(value, dtype)
    return F.when(number == F.floor(number), number.try_cast("int"))


def row_mean(*cells: Column) -> Column:
    """Mean over the cells that are present; NULL when none is."""
    total = reduce(add, [F.coalesce(c, F.lit(0.0)) for c in cells])
    present = reduce(add, [c.isNotNull().cast("int") for c in cells])
    return F.try_divide(total, present)


def deviation(value: Column, reference: Column) -> Column:
    return value - reference


def percent_of(part: Column, whole: Column) -> Column:
    """part / whole in percent; NULL when whole is 0 or missing."""
    return F.try_divide(part, whole) * 100


def per_unit(value: Column, base: Column) -> Column:
    return F.try_divide(value, base)


def spread(*cells: Column) -> Column:
    """Largest minus smallest present cell."""
    return F.greatest(*cells) - F.least(*cells)


def kilo_to_unit(value: Column) -> Column:
    return value * 1000


def unit_to_kilo(value: Column) -> Column:
    return value / 1000


def phase_nominal(line_kv: Column) -> Column:
    """Phase-to-neutral volts of a line-to-line nominal in kV."""
    return kilo_to_unit(line_kv) / F.sqrt(F.lit(3.0))


def apparent_power(active: Column, reactive: Column) -> Column:
    return F.sqrt(active * active + reactive * reactive)


def power_factor(active: Column, apparent: Column) -> Column:
    """Signed P/S, only where S is positive."""
    return F.when(apparent > 0, active / apparent)


def exact(value: Column) -> Column:
    """A double as the decimal that it is written as, so that sums come out the same in any order.

    Up to 20 digits behind the point; NULL where the decimal has no room for it.
    """
    return value.try_cast("decimal(38,20)")
