"""Analytics marts: rankings, deterioration, demand shares, KPIs.

Marts that only add a rank have an unranked twin (``pump_rows`` and so on):
what does not need the rank reads that and saves the sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feederlens.functions import numbers as N, picks as P
from feederlens.operators.joins import with_values
from feederlens.operators.ranking import global_rank, ordered_totals, running_by_rank
from feederlens.operators.shares import share_of_total
from feederlens.plans import gold as G
from feederlens import settings as S

POWER_COLUMNS = ("active_power_kw", "reactive_power_kvar", "apparent_power_kva", "power_factor")


def rounded(digits: int, *columns: str) -> dict:
    return {c: F.round(c, digits) for c in columns}


def voltage_performance(voltage: DataFrame) -> DataFrame:
    """Bus voltages ranked from the lowest deviation up; unknown ones come first."""
    rows = voltage.select(
        "bus_name", "network_level", "nominal_voltage_kv", "nominal_phase_voltage_v",
        "voltage_average_v", "average_voltage_pu", "voltage_deviation_percent",
        "phase_voltage_spread_v", "voltage_status",
    )
    return global_rank(
        rows, "voltage_deviation_percent", "voltage_risk_rank",
        ties=["bus_name", "nominal_voltage_kv", "phase_voltage_spread_v"],
    )


def reference_voltage(low_voltage: DataFrame, settings: S.GridSettings = S.DEFAULTS) -> DataFrame:
    """One row: average voltage of the reference bus, NULL if there is none.

    Filtering first lets the scan skip what cannot hold the bus; the maximum
    over no rows is still one row.
    """
    at_reference = low_voltage.filter(F.col("bus_name") == settings.reference_bus)
    return at_reference.agg(F.max("voltage_average_v").alias("dt_side_reference_voltage_v"))


def voltage_deterioration(
    voltage: DataFrame, settings: S.GridSettings = S.DEFAULTS
) -> DataFrame:
    """Low-voltage buses against the reference bus at the transformer side."""
    rows = voltage.filter(F.col("network_level") == settings.low_voltage_level).select(
        "bus_name", "nominal_voltage_kv", "voltage_average_v", "average_voltage_pu",
        "voltage_deviation_percent", "phase_voltage_spread_v", "voltage_status",
    )
    average, reference = F.col("voltage_average_v"), F.col("dt_side_reference_voltage_v")
    change = N.deviation(average, reference)
    return with_values(rows, reference_voltage(rows, settings)).withColumns({
        "voltage_change_from_dt_side_v": change,
        "voltage_change_from_dt_side_percent": N.percent_of(change, reference),
    })


def asset_demand_rows(power: DataFrame, settings: S.GridSettings = S.DEFAULTS) -> DataFrame:
    """Transformers and lines at the metered terminal."""
    return power.filter(
        (F.col("terminal") == settings.metered_terminal)
        & F.col("asset_type").isin(*settings.network_types)
    ).select("element_name", "asset_type", *POWER_COLUMNS)


def asset_demand(power: DataFrame, settings: S.GridSettings = S.DEFAULTS) -> DataFrame:
    """Transformers and lines at the metered terminal, ranked by apparent power."""
    rows = asset_demand_rows(power, settings)
    ranked = global_rank(
        rows, "apparent_power_kva", "demand_rank", descending=True,
        ties=["element_name", "active_power_kw", "reactive_power_kvar"],
    )
    return ranked.select("demand_rank", *rows.columns)


def pump_rows(power: DataFrame, settings: S.GridSettings = S.DEFAULTS) -> DataFrame:
    """Pump loads at the metered terminal."""
    return power.filter(
        (F.col("asset_type") == settings.pump_type)
        & (F.col("terminal") == settings.metered_terminal)
    ).select(F.col("element_name").alias("pump_name"), *POWER_COLUMNS)


PUMP_ORDER = {
    "measure": "apparent_power_kva",
    "descending": True,
    "ties": ["pump_name", "active_power_kw", "reactive_power_kvar"],
}


def pump_demand(power: DataFrame, settings: S.GridSettings = S.DEFAULTS) -> DataFrame:
    """Pump loads ranked by apparent power."""
    rows = pump_rows(power, settings)
    return global_rank(rows, name="demand_rank", **PUMP_ORDER).select("demand_rank", *rows.columns)


def pump_shares(pumps: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Share of every pump in the total active and apparent power."""
    return share_of_total(
        pumps,
        shares={
            "active_power_contribution_percent": "active_power_kw",
            "apparent_power_contribution_percent": "apparent_power_kva",
        },
        totals={f"total_{c}": c for c in POWER_COLUMNS[:3]},
        of=of,
    )


def pump_demand_contribution(pumps: DataFrame) -> DataFrame:
    """The shares of every pump, its rank, and the cumulative share by rank.

    Pumps that have their ``demand_rank`` are not ranked again.
    """
    rows, running = pumps.select("pump_name", *POWER_COLUMNS), {"_so_far": "apparent_power_kva"}
    if "demand_rank" in pumps.columns:
        ranked = pumps.select("demand_rank", *rows.columns)
        ordered = running_by_rank(ranked, "demand_rank", running)
    else:
        ordered = ordered_totals(rows, **PUMP_ORDER, rank="demand_rank", running=running)
    shared = pump_shares(ordered, of=rows)
    cumulative = N.percent_of(F.col("_so_far"), F.col("total_apparent_power_kva"))
    return shared.select(
        "demand_rank", *[c for c in shared.columns if c not in ("demand_rank", "_so_far")],
        cumulative.alias("cumulative_apparent_power_percent"),
    )


def pump_demand_kpi(pumps: DataFrame) -> DataFrame:
    """One row of totals and extremes over all pumps."""
    return pumps.agg(
        F.count("*").alias("pump_count"),
        *[P.exact_sum(c).alias(f"total_{c}") for c in POWER_COLUMNS[:3]],
        P.exact_mean("power_factor").alias("average_power_factor"),
        F.max("apparent_power_kva").alias("highest_pump_apparent_power_kva"),
        F.min("apparent_power_kva").alias("lowest_pump_apparent_power_kva"),
    )


def transformer_performance(
    summary: DataFrame, settings: S.GridSettings = S.DEFAULTS
) -> DataFrame:
    """Transformers with a capacity status."""
    return summary.filter(F.col("asset_type") == settings.transformer_type).select(
        F.col("element_name").alias("transformer_name"),
        "max_current_a", "max_normal_loading_percent", "max_emergency_loading_percent",
        "max_apparent_power_kva", "max_active_power_kw", "max_reactive_power_kvar",
        "loading_status",
        G.capacity_status(F.col("max_normal_loading_percent")).alias("transformer_capacity_status"),
    )


def voltage_unbalance_hotspots(unbalance: DataFrame) -> DataFrame:
    """Buses ranked from the highest unbalance down; unknown ones come last."""
    ranked = global_rank(
        unbalance, "voltage_unbalance_percent", "unbalance_rank", descending=True,
        ties=["bus_name", "positive_sequence_voltage_v", "nema_unbalance_percent"],
    )
    return ranked.select("unbalance_rank", *unbalance.columns)


def voltage_kpi(voltage: DataFrame, settings: S.GridSettings = S.DEFAULTS) -> DataFrame:
    """One row: bus counts by level and status, and the worst bus."""
    status, off = F.col("voltage_status"), F.col("voltage_deviation_percent")
    return voltage.agg(
        F.count("*").alias("total_buses"),
        P.count_where(F.col("network_level") == settings.low_voltage_level).alias("lt_buses"),
        P.count_where(status == "Low Voltage").alias("low_voltage_buses"),
        P.count_where(status == "Severe Deviation").alias("severe_voltage_buses"),
        F.min(off).alias("worst_voltage_deviation_percent"),
        P.name_of_lowest(F.col("bus_name"), off).alias("worst_voltage_bus"),
    )


def deterioration_kpi(deterioration: DataFrame) -> DataFrame:
    """One row: the largest change either way, and the bus with the largest drop."""
    change = F.col("voltage_change_from_dt_side_percent")
    return deterioration.agg(
        F.max(F.abs(change)).alias("max_downstream_deterioration_percent"),
        P.name_of_lowest(F.col("bus_name"), change).alias("greatest_deterioration_bus"),
    )


def transformer_kpi(transformers: DataFrame) -> DataFrame:
    """One row: the highest loading and the transformer that has it."""
    loading = "max_normal_loading_percent"
    highest = transformers.agg(F.max(loading).alias("max_transformer_normal_loading_percent"))
    return with_values(highest, P.name_of_highest(
        transformers, "transformer_name", loading, "highest_loaded_transformer"
    ))


def unbalance_kpi(unbalance: DataFrame) -> DataFrame:
    """One row: buses with moderate and with low unbalance."""
    status = F.col("unbalance_status")
    return unbalance.agg(
        P.count_where(status == "Moderate Unbalance").alias("moderate_unbalance_buses"),
        P.count_where(status == "Low Unbalance").alias("low_unbalance_buses"),
    )


def management_kpi_summary(
    voltage: DataFrame,
    deterioration: DataFrame,
    pumps: DataFrame,
    transformers: DataFrame,
    unbalance: DataFrame,
    settings: S.GridSettings = S.DEFAULTS,
) -> DataFrame:
    """One row of network KPIs, each part a one-row aggregate of its own."""
    pump_part = pump_demand_kpi(pumps).select(
        "pump_count",
        F.col("total_active_power_kw").alias("total_pump_active_power_kw"),
        F.col("total_reactive_power_kvar").alias("total_pump_reactive_power_kvar"),
        F.col("total_apparent_power_kva").alias("total_pump_apparent_power_kva"),
        F.col("average_power_factor").alias("average_pump_power_factor"),
        "highest_pump_apparent_power_kva",
    )
    row = voltage_kpi(voltage, settings)
    for part in (
        deterioration_kpi(deterioration), pump_part,
        transformer_kpi(transformers), unbalance_kpi(unbalance),
    ):
        row = with_values(row, part)
    return row.withColumns({
        **rounded(
            2, "worst_voltage_deviation_percent", "max_downstream_deterioration_percent",
            "total_pump_active_power_kw", "total_pump_reactive_power_kvar",
            "total_pump_apparent_power_kva", "highest_pump_apparent_power_kva",
            "max_transformer_normal_loading_percent",
        ),
        **rounded(3, "average_pump_power_factor"),
    })
