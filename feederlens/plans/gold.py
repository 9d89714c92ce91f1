"""Gold layer: voltage health, loading, power flow, unbalance, asset summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feederlens.functions import bands, numbers as N
from feederlens import settings as S


def loading_type(name: Column) -> Column:
    """Asset type in loading tables; pumps have no branch of their own."""
    return bands.prefix_label(name, S.LOADING_PREFIXES, S.PREFIX_DEFAULT)


def power_type(name: Column) -> Column:
    """Asset type in power tables, pump loads included."""
    return bands.prefix_label(name, S.POWER_PREFIXES, S.PREFIX_DEFAULT)


def voltage_status(per_unit: Column) -> Column:
    return bands.band(per_unit, S.VOLTAGE_BANDS, S.VOLTAGE_DEFAULT)


def unbalance_status(percent: Column) -> Column:
    return bands.band(percent, S.UNBALANCE_BANDS, S.UNBALANCE_DEFAULT)


def loading_status(percent: Column) -> Column:
    return bands.band(percent, S.LOADING_BANDS, S.LOADING_DEFAULT)


def capacity_status(percent: Column) -> Column:
    return bands.band(percent, S.CAPACITY_BANDS, S.CAPACITY_DEFAULT)


def voltage_analysis(voltages: DataFrame) -> DataFrame:
    """Bus voltage against the phase nominal, with a status."""
    average = F.col("voltage_average_v")
    nominal = F.col("nominal_phase_voltage_v")
    return (
        voltages.select(
            "bus_name", "base_voltage_kv", "nominal_voltage_kv", "network_level",
            "voltage_average_v", "phase_voltage_spread_v",
            N.phase_nominal(F.col("nominal_voltage_kv")).alias("nominal_phase_voltage_v"),
        )
        .withColumns({
            "average_voltage_pu": N.per_unit(average, nominal),
            "voltage_deviation_percent": N.percent_of(N.deviation(average, nominal), nominal),
        })
        .withColumn("voltage_status", voltage_status(F.col("average_voltage_pu")))
    )


def asset_loading(currents: DataFrame) -> DataFrame:
    """Current and loading per element terminal, with the asset type."""
    return currents.select(
        "element_name", "terminal", "current_a",
        "normal_loading_percent", "emergency_loading_percent",
        loading_type(F.col("element_name")).alias("asset_type"),
    )


def power_flow(powers: DataFrame) -> DataFrame:
    """P, Q, S and power factor per element terminal, with the asset type."""
    return powers.select(
        "element_name", "terminal", "active_power_kw", "reactive_power_kvar",
        "apparent_power_kva", "power_factor",
        power_type(F.col("element_name")).alias("asset_type"),
    )


def voltage_unbalance(voltages: DataFrame) -> DataFrame:
    """Unbalance per bus, with a status."""
    return voltages.select(
        "bus_name", "positive_sequence_voltage_v", "voltage_pu",
        "voltage_unbalance_percent", "nema_unbalance_percent",
        unbalance_status(F.col("voltage_unbalance_percent")).alias("unbalance_status"),
    )


def _peaks(df: DataFrame, measures: list[str]) -> DataFrame:
    return df.groupBy("element_name").agg(*[F.max(m).alias(f"max_{m}") for m in measures])


def loading_by_element(loading: DataFrame) -> DataFrame:
    """Highest current and loading per element, over its terminals.

    The type follows from the name, so grouping by the name alone is enough,
    and leaves the rows where the join by name needs them.
    """
    peaks = _peaks(loading, ["current_a", "normal_loading_percent", "emergency_loading_percent"])
    return peaks.select(
        "element_name",
        loading_type(F.col("element_name")).alias("asset_type"),
        *peaks.columns[1:],
    )


def power_by_element(power: DataFrame) -> DataFrame:
    """Highest signed P, Q and S per element, over its terminals."""
    return _peaks(power, ["apparent_power_kva", "active_power_kw", "reactive_power_kvar"])


def asset_summary(loading: DataFrame, power: DataFrame) -> DataFrame:
    """One row per element with loading; its power is NULL where not reported.

    Both sides are one row per element by the time they meet, so no element
    is hot in the join.
    """
    joined = loading_by_element(loading).join(power_by_element(power), "element_name", "left")
    return joined.withColumn("loading_status", loading_status(F.col("max_normal_loading_percent")))
