"""Read-only reports. Each sorts by the unrounded measure, then by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from feederlens.functions.bands import first_match
from feederlens.operators.joins import left_star
from feederlens import settings as S


def show(df: DataFrame, order: list, spec: dict, in_order: bool = False) -> DataFrame:
    """Sort, then project ``{output: column or (column, digits)}``.

    Rows that were ranked in the same plan lie in rank order, slot after slot,
    and stay ``in_order`` without another exchange; rows of a stored table do not.
    """

    def column(name, source):
        if isinstance(source, tuple):
            source, digits = source
            return F.round(source, digits).alias(name)
        return F.col(source).alias(name)

    rows = df if in_order else df.orderBy(*order)
    return rows.select(*[column(n, s) for n, s in spec.items()])


def _same(*names: str) -> dict:
    return {n: n for n in names}


def _low(name: str):
    return F.col(name).asc_nulls_first()


def _high(name: str):
    return F.col(name).desc_nulls_last()


# Listings of the gold tables -------------------------------------------------

def voltage_listing(voltage: DataFrame) -> DataFrame:
    """Buses by level, highest voltage first, then by name."""
    level = F.col("network_level")
    place = first_match([(level == "33kV_HT", 1), (level == "11kV_HT", 2)], 3)
    return voltage.orderBy(place, _low("bus_name")).select(
        "bus_name", "network_level", "nominal_voltage_kv", "nominal_phase_voltage_v",
        "voltage_average_v", "average_voltage_pu", "voltage_deviation_percent",
        "phase_voltage_spread_v", "voltage_status",
    )


def loading_listing(loading: DataFrame) -> DataFrame:
    return loading.orderBy(
        _high("normal_loading_percent"), _high("current_a"), "element_name", "terminal"
    ).select(
        "element_name", "asset_type", "terminal", "current_a",
        "normal_loading_percent", "emergency_loading_percent",
    )


def power_listing(power: DataFrame) -> DataFrame:
    return power.orderBy(_high("apparent_power_kva"), "element_name", "terminal").select(
        "element_name", "asset_type", "terminal", "active_power_kw",
        "reactive_power_kvar", "apparent_power_kva", "power_factor",
    )


def unbalance_listing(unbalance: DataFrame) -> DataFrame:
    return unbalance.orderBy(_high("voltage_unbalance_percent"), "bus_name")


def asset_listing(summary: DataFrame) -> DataFrame:
    return summary.orderBy(
        _high("max_normal_loading_percent"), _high("max_apparent_power_kva"), "element_name"
    )


def level_counts(voltage: DataFrame) -> DataFrame:
    """Buses per network level, most first."""
    counted = voltage.groupBy("network_level").agg(F.count("*").alias("bus_count"))
    return counted.orderBy(F.col("bus_count").desc(), "network_level")


# Business questions ----------------------------------------------------------

def voltage_concentration(performance: DataFrame) -> DataFrame:
    """Q1: buses from the lowest deviation up."""
    return show(performance, [_low("voltage_deviation_percent"), _low("bus_name")], {
        **_same("bus_name", "network_level"),
        "average_voltage_v": ("voltage_average_v", 2),
        "voltage_pu": ("average_voltage_pu", 4),
        "voltage_deviation_percent": ("voltage_deviation_percent", 2),
        **_same("voltage_status"),
    })


def risk_locations(
    performance: DataFrame, settings: S.GridSettings = S.DEFAULTS, in_order: bool = False
) -> DataFrame:
    """Q1: buses with a low or severe voltage, by their rank among all buses; ``in_order`` as in ``show``."""
    at_risk = performance.filter(F.col("voltage_status").isin(*settings.risk_statuses))
    return show(at_risk, [F.col("voltage_risk_rank")], {
        **_same("bus_name", "network_level"),
        "average_voltage_v": ("voltage_average_v", 2),
        "voltage_deviation_percent": ("voltage_deviation_percent", 2),
        **_same("voltage_status", "voltage_risk_rank"),
    }, in_order)


def pump_contribution(contribution: DataFrame) -> DataFrame:
    """Q2: pumps by apparent power, with their share."""
    return show(contribution, [_high("apparent_power_kva"), _low("pump_name")], {
        **_same("pump_name"),
        "active_power_kw": ("active_power_kw", 2),
        "reactive_power_kvar": ("reactive_power_kvar", 2),
        "apparent_power_kva": ("apparent_power_kva", 2),
        "power_factor": ("power_factor", 3),
        "apparent_power_contribution_percent": ("apparent_power_contribution_percent", 2),
    })


def top_pumps(contribution: DataFrame, settings: S.GridSettings = S.DEFAULTS) -> DataFrame:
    """Q2: the pumps with the highest apparent power."""
    return show(contribution, [_high("apparent_power_kva"), _low("pump_name")], {
        **_same("pump_name"),
        "apparent_power_kva": ("apparent_power_kva", 2),
        "contribution_percent": ("apparent_power_contribution_percent", 2),
    }).limit(settings.top_pumps)


_DEMAND = {
    **_same("demand_rank", "element_name", "asset_type"),
    "apparent_power_kva": ("apparent_power_kva", 2),
    "active_power_kw": ("active_power_kw", 2),
    "reactive_power_kvar": ("reactive_power_kvar", 2),
}


def asset_demand_report(demand: DataFrame, in_order: bool = False) -> DataFrame:
    """Q3: network assets by apparent power; ``in_order`` as in ``show``."""
    return show(
        demand, [_high("apparent_power_kva"), _low("element_name")],
        {**_DEMAND, "power_factor": ("power_factor", 3)}, in_order,
    )


def top_assets(rows: DataFrame, settings: S.GridSettings = S.DEFAULTS) -> DataFrame:
    """Q3: the network assets with the highest apparent power, taken first and then numbered."""
    order = [
        _high("apparent_power_kva"), _low("element_name"), _low("active_power_kw"), _low("reactive_power_kvar")
    ]
    top = rows.orderBy(*order).limit(settings.top_assets)
    # At most the few rows of the report.
    rank = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return show(top.withColumn("demand_rank", rank), [F.col("demand_rank")], _DEMAND)


def downstream_deterioration(deterioration: DataFrame) -> DataFrame:
    """Q4: low-voltage buses from the largest drop up."""
    order = [_low("voltage_change_from_dt_side_percent"), _low("bus_name")]
    return show(deterioration, order, {
        **_same("bus_name"),
        "average_voltage_v": ("voltage_average_v", 2),
        "voltage_change_v": ("voltage_change_from_dt_side_v", 2),
        "voltage_change_percent": ("voltage_change_from_dt_side_percent", 2),
        **_same("voltage_status"),
    })


def transformer_capacity(transformers: DataFrame) -> DataFrame:
    """Q5: transformers from the highest loading down."""
    order = [_high("max_normal_loading_percent"), _low("transformer_name")]
    return show(transformers, order, {
        **_same("transformer_name"),
        "max_current_a": ("max_current_a", 2),
        "normal_loading_percent": ("max_normal_loading_percent", 2),
        "emergency_loading_percent": ("max_emergency_loading_percent", 2),
        "apparent_power_kva": ("max_apparent_power_kva", 2),
        **_same("loading_status", "transformer_capacity_status"),
    })


def unbalance_hotspots(hotspots: DataFrame, in_order: bool = False) -> DataFrame:
    """Q6: buses by unbalance rank; ``in_order`` as in ``show``."""
    return show(hotspots, [F.col("unbalance_rank")], {
        **_same("unbalance_rank", "bus_name"),
        "positive_sequence_voltage_v": ("positive_sequence_voltage_v", 2),
        "voltage_unbalance_percent": ("voltage_unbalance_percent", 3),
        "nema_unbalance_percent": ("nema_unbalance_percent", 3),
        **_same("unbalance_status"),
    }, in_order)


def moderate_unbalance(hotspots: DataFrame) -> DataFrame:
    """Q6: buses with moderate unbalance, highest first."""
    moderate = hotspots.filter(F.col("unbalance_status") == "Moderate Unbalance")
    return show(moderate, [_high("voltage_unbalance_percent"), _low("bus_name")], {
        **_same("bus_name"),
        "voltage_unbalance_percent": ("voltage_unbalance_percent", 3),
        "nema_unbalance_percent": ("nema_unbalance_percent", 3),
    })


# The executive view of the KPI row: column and digits, or None to take it as is.
SNAPSHOT = {
    "total_buses": None,
    "lt_buses": None,
    "low_voltage_buses": None,
    "severe_voltage_buses": None,
    "worst_voltage_bus": None,
    "worst_voltage_deviation_percent": 2,
    "greatest_deterioration_bus": None,
    "max_downstream_deterioration_percent": 2,
    "pump_count": None,
    "total_pump_active_power_kw": 2,
    "total_pump_apparent_power_kva": 2,
    "average_pump_power_factor": 3,
    "highest_loaded_transformer": None,
    "max_transformer_normal_loading_percent": 2,
    "moderate_unbalance_buses": None,
    "low_unbalance_buses": None,
}


def executive_snapshot(kpi: DataFrame) -> DataFrame:
    """Q7: the KPI row without reactive power and the highest pump."""
    return kpi.select(*SNAPSHOT)


def bus_profile(
    performance: DataFrame, deterioration: DataFrame, hotspots: DataFrame, names: Sequence[DataFrame] | None = None
) -> DataFrame:
    """Voltage, deterioration and unbalance side by side, one bus name each.

    ``names`` as in ``left_star``, where the tables are not stored.
    """
    return left_star(performance, [
        deterioration.select(
            "bus_name", "voltage_change_from_dt_side_v", "voltage_change_from_dt_side_percent"
        ),
        hotspots.select(
            "bus_name", "voltage_unbalance_percent", "nema_unbalance_percent", "unbalance_status"
        ),
    ], "bus_name", names)


def low_voltage_profile(
    performance: DataFrame,
    deterioration: DataFrame,
    hotspots: DataFrame,
    settings: S.GridSettings = S.DEFAULTS,
    names: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """The bus profile of the low-voltage level alone."""
    low = performance.filter(F.col("network_level") == settings.low_voltage_level)
    return bus_profile(low, deterioration, hotspots, names)


def priority_locations(
    performance: DataFrame,
    deterioration: DataFrame,
    hotspots: DataFrame,
    settings: S.GridSettings = S.DEFAULTS,
    names: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Q8: low-voltage buses from the lowest deviation up."""
    profile = low_voltage_profile(performance, deterioration, hotspots, settings, names)
    return show(profile, [_low("voltage_deviation_percent"), _low("bus_name")], {
        **_same("bus_name", "network_level"),
        "voltage_deviation_percent": ("voltage_deviation_percent", 2),
        "downstream_change_percent": ("voltage_change_from_dt_side_percent", 2),
        "voltage_unbalance_percent": ("voltage_unbalance_percent", 3),
        **_same("voltage_status", "unbalance_status"),
    })
