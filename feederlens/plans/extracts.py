"""BI extracts: rounded, renamed and unordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from feederlens.plans.reports import SNAPSHOT, bus_profile, low_voltage_profile
from feederlens import settings as S


def _rounded(df: DataFrame, spec: dict) -> DataFrame:
    """Project ``{output: (column, digits)}``; digits None takes the column as is."""
    return df.select(*[
        (F.col(source) if digits is None else F.round(source, digits)).alias(name)
        for name, (source, digits) in spec.items()
    ])


def network_health(
    performance: DataFrame, deterioration: DataFrame, hotspots: DataFrame, names: Sequence[DataFrame] | None = None
) -> DataFrame:
    """Every bus with voltage, downstream change and unbalance."""
    return _rounded(bus_profile(performance, deterioration, hotspots, names), {
        "bus_name": ("bus_name", None),
        "network_level": ("network_level", None),
        "nominal_voltage_kv": ("nominal_voltage_kv", 3),
        "average_voltage_v": ("voltage_average_v", 2),
        "voltage_pu": ("average_voltage_pu", 4),
        "voltage_deviation_percent": ("voltage_deviation_percent", 2),
        "phase_voltage_spread_v": ("phase_voltage_spread_v", 2),
        "voltage_status": ("voltage_status", None),
        "downstream_voltage_change_v": ("voltage_change_from_dt_side_v", 2),
        "downstream_voltage_change_percent": ("voltage_change_from_dt_side_percent", 2),
        "voltage_unbalance_percent": ("voltage_unbalance_percent", 3),
        "nema_unbalance_percent": ("nema_unbalance_percent", 3),
        "unbalance_status": ("unbalance_status", None),
    })


def pump_demand(contribution: DataFrame) -> DataFrame:
    """Every pump with its share and the cumulative share."""
    return _rounded(contribution, {
        "pump_name": ("pump_name", None),
        "active_power_kw": ("active_power_kw", 2),
        "reactive_power_kvar": ("reactive_power_kvar", 2),
        "apparent_power_kva": ("apparent_power_kva", 2),
        "power_factor": ("power_factor", 3),
        "demand_contribution_percent": ("apparent_power_contribution_percent", 2),
        "cumulative_demand_contribution_percent": ("cumulative_apparent_power_percent", 2),
    })


def asset_performance(summary: DataFrame) -> DataFrame:
    """Every element with its peaks and loading status."""
    return _rounded(summary, {
        "element_name": ("element_name", None),
        "asset_type": ("asset_type", None),
        "max_current_a": ("max_current_a", 2),
        "normal_loading_percent": ("max_normal_loading_percent", 2),
        "emergency_loading_percent": ("max_emergency_loading_percent", 2),
        "apparent_power_kva": ("max_apparent_power_kva", 2),
        "active_power_kw": ("max_active_power_kw", 2),
        "reactive_power_kvar": ("max_reactive_power_kvar", 2),
        "loading_status": ("loading_status", None),
    })


def kpi_summary(kpi: DataFrame) -> DataFrame:
    """The KPI row as the BI tool reads it."""
    return _rounded(kpi, {name: (name, digits) for name, digits in SNAPSHOT.items()})


def priority_locations(
    performance: DataFrame,
    deterioration: DataFrame,
    hotspots: DataFrame,
    settings: S.GridSettings = S.DEFAULTS,
    names: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Low-voltage buses with voltage, downstream change and unbalance."""
    profile = low_voltage_profile(performance, deterioration, hotspots, settings, names)
    return _rounded(profile, {
        "bus_name": ("bus_name", None),
        "network_level": ("network_level", None),
        "average_voltage_v": ("voltage_average_v", 2),
        "voltage_deviation_percent": ("voltage_deviation_percent", 2),
        "voltage_status": ("voltage_status", None),
        "downstream_voltage_change_percent": ("voltage_change_from_dt_side_percent", 2),
        "voltage_unbalance_percent": ("voltage_unbalance_percent", 3),
        "unbalance_status": ("unbalance_status", None),
    })
