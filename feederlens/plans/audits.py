"""Audits over the gold, analytics and BI tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from feederlens.operators import checks
from feederlens.settings import EXPORT_KEYS

# Tables in audit order.
ANALYTICS_TABLES = (
    "voltage_performance", "voltage_deterioration", "asset_demand", "pump_demand",
    "pump_demand_contribution", "pump_demand_kpi", "transformer_performance",
    "voltage_unbalance_hotspots", "management_kpi_summary",
)
EXTRACT_TABLES = (
    "powerbi_network_health", "powerbi_pump_demand", "powerbi_asset_performance",
    "powerbi_kpi_summary", "powerbi_priority_locations",
)
# KPI columns that must never be missing, by the name of their counter.
CRITICAL_KPIS = {
    "null_total_buses": "total_buses",
    "null_worst_voltage_bus": "worst_voltage_bus",
    "null_pump_count": "pump_count",
    "null_total_pump_power": "total_pump_active_power_kw",
    "null_transformer": "highest_loaded_transformer",
    "null_unbalance": "moderate_unbalance_buses",
}
# Extract, its table and the column that names its entities.
EXTRACT_ENTITIES = {
    "network_health": ("powerbi_network_health", "bus_name"),
    "pump_demand": ("powerbi_pump_demand", "pump_name"),
    "asset_performance": ("powerbi_asset_performance", "element_name"),
    "priority_locations": ("powerbi_priority_locations", "bus_name"),
}
GOLD_KEYS = {
    "voltage_analysis": ["bus_name"],
    "asset_loading": ["element_name", "terminal"],
    "power_flow": ["element_name", "terminal"],
    "voltage_unbalance": ["bus_name"],
    "asset_summary": ["element_name"],
}


def audit_row_counts(
    tables: Mapping[str, DataFrame], rows: Mapping[str, int] | None = None
) -> DataFrame:
    """Rows of every analytics table and BI extract; ``rows`` that are known need no reading."""
    return checks.row_counts({n: tables[n] for n in ANALYTICS_TABLES + EXTRACT_TABLES}, rows)


def audit_written(tables: Mapping[str, DataFrame], rows: Mapping[str, int]) -> DataFrame:
    """Rows written to every table against those it holds, which the files' footers tell."""
    return checks.lost_rows(tables, rows)


def audit_critical_nulls(kpi: DataFrame) -> DataFrame:
    """Missing values among the critical KPIs."""
    return checks.null_counts(kpi, CRITICAL_KPIS)


def audit_entities(
    tables: Mapping[str, DataFrame], rows: Mapping[str, int] | None = None
) -> DataFrame:
    """Rows against distinct entities; more rows than entities means a join fanned out."""
    named = {n: (tables[t], key) for n, (t, key) in EXTRACT_ENTITIES.items()}
    return checks.entity_counts(named, rows and {n: rows[t] for n, (t, _) in EXTRACT_ENTITIES.items()})


def audit_gold(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, rows without a key, and rows beyond one per key, for every gold table."""
    return checks.key_checks({n: (tables[n], keys) for n, keys in GOLD_KEYS.items()})


def audit_rejected(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every raw export, and how many of them cleaning rejects as nameless."""
    return checks.rejected_keys({name: (raw[name], key) for name, key in EXPORT_KEYS.items()})


def audit_malformed(set_aside: DataFrame) -> DataFrame:
    """Rows that did not fit the header, by export and file; ``set_aside`` as ``set_aside_exports`` gives them."""
    return set_aside.groupBy("table_name", "source_file").agg(
        F.count("*").alias("malformed_rows"), F.min("source_row_id").alias("first_row_id")
    )
