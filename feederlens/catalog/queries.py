"""Every operator, mart, report, extract and audit as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from feederlens.catalog.projections import PROJECTIONS, REFERENCE_BUS, project
from feederlens.functions import bands, numbers as N, picks as P
from feederlens.operators import cleaning as C
from feederlens.operators.joins import with_values
from feederlens.operators.ranking import global_rank, ordered_totals
from feederlens.operators.shares import share_of_total
from feederlens.plans import audits, build, extracts, gold, marts, reports, silver
from feederlens.sources.exports import with_lineage
from feederlens import settings as S

SETTINGS = replace(S.DEFAULTS, reference_bus=REFERENCE_BUS)

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# Bands for the general classifier, shown on line quantities.
QUANTITY_BANDS = (
    ("<=", 5, "single"),
    ("between", (10, 20), "box"),
    (">", 40, "pallet"),
    ("<", 10, "pack"),
)
QUANTITY_DEFAULT = "crate"


class Grid:
    """The grid tables of one data folder, each a lazy plan over its parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def projected(self, name: str) -> DataFrame:
        return project(self.table(PROJECTIONS[name][0]), name)

    def named(self, table: str) -> DataFrame:
        """Base silver of an export: copies, nameless rows and text that is no number are out."""
        return silver.clean_export(self.projected(EXPORTS[table]), table)

    @cached_property
    def std_voltages(self):
        return silver.voltages_standardized(self.named("voltages"), SETTINGS)

    @cached_property
    def std_currents(self):
        return silver.seqcurrents_standardized(self.named("seqcurrents"))

    @cached_property
    def std_powers(self):
        return silver.seqpowers_standardized(self.named("seqpowers"))

    @cached_property
    def std_seqvoltages(self):
        return silver.seqvoltages_standardized(self.named("seqvoltages"))

    @cached_property
    def voltage(self):
        return gold.voltage_analysis(self.std_voltages)

    @cached_property
    def loading(self):
        return gold.asset_loading(self.std_currents)

    @cached_property
    def power(self):
        return gold.power_flow(self.std_powers)

    @cached_property
    def unbalance(self):
        return gold.voltage_unbalance(self.std_seqvoltages)

    @cached_property
    def summary(self):
        return gold.asset_summary(self.loading, self.power)

    @cached_property
    def deterioration(self):
        return marts.voltage_deterioration(self.voltage, SETTINGS)

    @cached_property
    def pumps(self):
        return marts.pump_rows(self.power, SETTINGS)

    @cached_property
    def contribution(self):
        return marts.pump_demand_contribution(self.pumps)

    @cached_property
    def transformers(self):
        return marts.transformer_performance(self.summary, SETTINGS)

    @cached_property
    def kpi(self):
        return marts.management_kpi_summary(
            self.voltage, self.deterioration, self.pumps,
            self.transformers, self.unbalance, SETTINGS,
        )

    @property
    def profile(self):
        return self.voltage, self.deterioration, self.unbalance

    @cached_property
    def bus_names(self):
        """Names of the profile's three tables as the exports have them, for counting; one column each.

        Cleaning keeps a row of every name, and the low-voltage level is what lies under the lowest nominal.
        """
        voltages, unbalance = self.projected("g_voltages"), self.projected("g_seqvoltages")
        low = voltages.where(F.col("BasekV") < SETTINGS.snap_below_kv)
        name = N.strip(F.col("Bus"))
        return [
            df.select(F.when(name != "", name).alias("bus_name")) for df in (voltages, low, unbalance)
        ]

    @cached_property
    def built(self):
        """All layers, stored and read back; runs the build."""
        folder = self.spark.conf.get("spark.checkpoint.dir", None)
        root = f"{folder.rstrip('/')}/builds" if folder else None
        raw = {table: self.projected(name) for table, name in EXPORTS.items()}
        return build.run(self.spark, raw, SETTINGS, root=root, publish=False)

    @cached_property
    def gold_tables(self):
        return {
            "voltage_analysis": self.voltage,
            "asset_loading": self.loading,
            "power_flow": self.power,
            "voltage_unbalance": self.unbalance,
            "asset_summary": self.summary,
        }

    def audited(self, *names: str) -> dict[str, DataFrame]:
        """Analytics and BI tables, each as its mart or extract builds it."""
        builders = {
            "voltage_performance": lambda: marts.voltage_performance(self.voltage),
            "voltage_deterioration": lambda: self.deterioration,
            "asset_demand": lambda: marts.asset_demand(self.power, SETTINGS),
            "pump_demand": lambda: marts.pump_demand(self.power, SETTINGS),
            "pump_demand_contribution": lambda: self.contribution,
            "pump_demand_kpi": lambda: marts.pump_demand_kpi(self.pumps),
            "transformer_performance": lambda: self.transformers,
            "voltage_unbalance_hotspots": lambda: marts.voltage_unbalance_hotspots(self.unbalance),
            "management_kpi_summary": lambda: self.kpi,
            "powerbi_network_health": lambda: extracts.network_health(*self.profile, self.bus_names),
            "powerbi_pump_demand": lambda: extracts.pump_demand(self.contribution),
            "powerbi_asset_performance": lambda: extracts.asset_performance(self.summary),
            "powerbi_kpi_summary": lambda: extracts.kpi_summary(self.kpi),
            "powerbi_priority_locations": lambda: extracts.priority_locations(
                *self.profile, SETTINGS, self.bus_names
            ),
        }
        return {name: builders[name]() for name in names or builders}


EXPORTS = {
    "voltages": "g_voltages",
    "seqcurrents": "g_currents",
    "seqpowers": "g_powers",
    "seqvoltages": "g_seqvoltages",
}


# Cleaning --------------------------------------------------------------------

def clean_null_tokens(g: Grid) -> DataFrame:
    return C.null_tokens(g.projected("g_dirty"))


def clean_drop_all_null(g: Grid) -> DataFrame:
    return C.drop_all_null(C.null_tokens(g.projected("g_dirty").drop("source_row_id")))


def clean_trim_keys(g: Grid) -> DataFrame:
    return C.trim_keys(g.projected("g_dirty"), ["raw_key"])


def clean_coerce_numeric(g: Grid) -> DataFrame:
    return C.coerce_numeric(g.projected("g_dirty"), ["raw_value", "no_such_column"])


def clean_dedupe(g: Grid) -> DataFrame:
    """Distinct business values of the lines, each with its first row id."""
    lines = g.table("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("source_row_id"),
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )
    return C.dedupe(lines)


def clean_require_key(g: Grid) -> DataFrame:
    dirty = C.trim_keys(C.null_tokens(g.projected("g_dirty")), ["raw_key"])
    return C.require_key(dirty, "raw_key")


def lineage_rows(g: Grid) -> DataFrame:
    """File and place in it of every order."""
    return with_lineage(g.table("orders")).select("o_orderkey", "source_file", "source_row_id")


def columns_normalized(g: Grid) -> DataFrame:
    """Parts under headers as exports have them, cleaned; the blank header's column goes."""
    raw = g.table("part").select(
        F.col("p_partkey").alias(" Part Key "), F.col("p_name").alias("  "),
        F.col("p_size").alias("Size (mm)"), F.col("p_retailprice").alias("Price/Unit %"),
    )
    return C.drop_unnamed(C.normalize_columns(raw))


def columns_resolved(g: Grid) -> DataFrame:
    """The standard power columns out of an export that uses other spellings."""
    powers = g.projected("g_powers").select(
        F.col("Element").alias("element"), F.col("Terminal").alias("TERMINAL"),
        F.col("P1kW").alias("P1 (kW)"), F.col("Q1kvar").alias("q1_(KVAR)"), "source_row_id",
    )
    return silver.standardize(powers, "seqpowers")


def clean_limit_flags(g: Grid) -> DataFrame:
    return C.with_limit_flags(g.projected("g_powers"))


# Filters, labels and row-wise numbers ----------------------------------------

def filter_transformers(g: Grid) -> DataFrame:
    return g.summary.filter(F.col("asset_type") == SETTINGS.transformer_type)


def filter_in_status(g: Grid) -> DataFrame:
    return g.voltage.filter(F.col("voltage_status").isin(*SETTINGS.risk_statuses))


def filter_pumps_terminal1(g: Grid) -> DataFrame:
    return g.power.filter((F.col("asset_type") == "Pump Load") & (F.col("terminal") == 1))


def classify_bands(g: Grid) -> DataFrame:
    label = bands.band(F.col("l_quantity"), QUANTITY_BANDS, QUANTITY_DEFAULT)
    return g.table("lineitem").select(*LINE_KEY, "l_quantity", label.alias("quantity_band"))


def classify_network_level(g: Grid) -> DataFrame:
    return g.std_voltages.select("bus_name", "nominal_voltage_kv", "network_level")


def classify_voltage_status(g: Grid) -> DataFrame:
    return g.voltage.select("bus_name", "average_voltage_pu", "voltage_status")


def classify_asset_type(g: Grid) -> DataFrame:
    name = F.col("element_name")
    return g.std_currents.select(
        "element_name", "terminal",
        gold.loading_type(name).alias("loading_type"),
        gold.power_type(name).alias("power_type"),
    )


def classify_unbalance_status(g: Grid) -> DataFrame:
    return g.unbalance.select("bus_name", "voltage_unbalance_percent", "unbalance_status")


def classify_loading_status(g: Grid) -> DataFrame:
    return g.loading.select(
        "element_name", "terminal", "normal_loading_percent",
        gold.loading_status(F.col("normal_loading_percent")).alias("loading_status"),
    )


def classify_capacity_status(g: Grid) -> DataFrame:
    return g.loading.select(
        "element_name", "terminal", "normal_loading_percent",
        gold.capacity_status(F.col("normal_loading_percent")).alias("capacity_status"),
    )


def row_stats(g: Grid) -> DataFrame:
    phases = [F.col(f"Magnitude{i}") for i in (1, 2, 3)]
    mean, gap = N.row_mean(*phases), N.spread(*phases)
    return g.projected("g_voltages").select(
        "Bus",
        mean.alias("mean_v"),
        F.least(*phases).alias("min_v"),
        F.greatest(*phases).alias("max_v"),
        gap.alias("spread_v"),
        N.percent_of(gap, mean).alias("spread_percent"),
    )


def deviation_percent(g: Grid) -> DataFrame:
    average, nominal = F.col("voltage_average_v"), F.col("nominal_voltage_v")
    off = N.deviation(average, nominal)
    return g.std_voltages.select(
        "bus_name", off.alias("off_v"), N.percent_of(off, nominal).alias("off_percent")
    )


def power_triangle(g: Grid) -> DataFrame:
    return g.std_powers.select(
        "element_name", "terminal", "active_power_kw", "reactive_power_kvar",
        "apparent_power_kva", "power_factor",
    )


# Aggregates, ranks and shares ------------------------------------------------

def reference_value(g: Grid) -> DataFrame:
    low = g.voltage.filter(F.col("network_level") == SETTINGS.low_voltage_level)
    return marts.reference_voltage(low, SETTINGS)


def extreme_entity(g: Grid) -> DataFrame:
    """The orders with the lowest and with the highest price."""
    orders = g.table("orders").select("o_orderkey", "o_totalprice")
    lowest = orders.agg(
        P.name_of_lowest(F.col("o_orderkey"), F.col("o_totalprice")).alias("lowest_order")
    )
    return with_values(
        lowest, P.name_of_highest(orders, "o_orderkey", "o_totalprice", "highest_order")
    )


def rank_global(g: Grid) -> DataFrame:
    lines = g.table("lineitem").select(*LINE_KEY, "l_quantity")
    return global_rank(lines, "l_quantity", "quantity_rank", descending=True, ties=LINE_KEY)


def rank_text(g: Grid) -> DataFrame:
    """Parts by their type, last in the alphabet first."""
    parts = g.table("part").select("p_partkey", "p_type")
    return global_rank(parts, "p_type", "type_rank", descending=True, ties=["p_partkey"])


def rank_date(g: Grid) -> DataFrame:
    """Lines by the time of shipping, latest first."""
    lines = g.table("lineitem").select(*LINE_KEY, "l_shipdate")
    ranked = global_rank(lines, "l_shipdate", "shipped_rank", descending=True, ties=LINE_KEY)
    return ranked.select(*LINE_KEY, "shipped_rank")


def cumulative_share(g: Grid) -> DataFrame:
    """Share of the quantity in the lines up to each one, dearest first.

    Quantities are whole numbers, so their sums are the same in any order.
    """
    lines = g.table("lineitem").select(*LINE_KEY, "l_extendedprice", "l_quantity")
    ordered = ordered_totals(
        lines, "l_extendedprice", descending=True, ties=LINE_KEY,
        rank="price_rank", running={"so_far": "l_quantity"},
    )
    total = lines.agg(F.sum("l_quantity").alias("total_quantity"))
    share = N.percent_of(F.col("so_far"), F.col("total_quantity"))
    return with_values(ordered, total).select(
        *lines.columns, "price_rank", share.alias("cumulative_percent")
    )


def share_of_total_lines(g: Grid) -> DataFrame:
    lines = g.table("lineitem").select(*LINE_KEY, "l_quantity")
    return share_of_total(
        lines, {"quantity_percent": "l_quantity"}, {"total_quantity": "l_quantity"}
    )


_BY_NAME: dict[str, Callable[[Grid], DataFrame]] = {
    "clean_null_tokens": clean_null_tokens,
    "clean_drop_all_null": clean_drop_all_null,
    "clean_trim_keys": clean_trim_keys,
    "clean_coerce_numeric": clean_coerce_numeric,
    "clean_dedupe": clean_dedupe,
    "clean_require_key": clean_require_key,
    "lineage_rows": lineage_rows,
    "columns_normalized": columns_normalized,
    "columns_resolved": columns_resolved,
    "clean_limit_flags": clean_limit_flags,
    "filter_transformers": filter_transformers,
    "filter_in_status": filter_in_status,
    "filter_pumps_terminal1": filter_pumps_terminal1,
    "classify_bands": classify_bands,
    "classify_network_level": classify_network_level,
    "classify_voltage_status": classify_voltage_status,
    "classify_asset_type": classify_asset_type,
    "classify_unbalance_status": classify_unbalance_status,
    "classify_loading_status": classify_loading_status,
    "classify_capacity_status": classify_capacity_status,
    "row_stats": row_stats,
    "deviation_percent": deviation_percent,
    "power_triangle": power_triangle,
    "silver_voltages": lambda g: silver.clean_export(g.projected("g_voltages"), "voltages"),
    "silver_seqcurrents": lambda g: silver.clean_export(g.projected("g_currents"), "seqcurrents"),
    "silver_seqpowers": lambda g: silver.clean_export(g.projected("g_powers"), "seqpowers"),
    "silver_seqvoltages": lambda g: silver.clean_export(
        g.projected("g_seqvoltages"), "seqvoltages"
    ),
    "silver_voltages_standardized": lambda g: g.std_voltages,
    "silver_seqcurrents_standardized": lambda g: g.std_currents,
    "silver_seqpowers_standardized": lambda g: g.std_powers,
    "silver_seqvoltages_standardized": lambda g: g.std_seqvoltages,
    "gold_voltage_analysis": lambda g: g.voltage,
    "gold_asset_loading": lambda g: g.loading,
    "gold_power_flow": lambda g: g.power,
    "gold_voltage_unbalance": lambda g: g.unbalance,
    "gold_asset_summary": lambda g: g.summary,
    "agg_loading_by_element": lambda g: gold.loading_by_element(g.loading),
    "agg_power_by_element": lambda g: gold.power_by_element(g.power),
    "kpi_voltage": lambda g: marts.voltage_kpi(g.voltage, SETTINGS),
    "reference_value": reference_value,
    "extreme_entity": extreme_entity,
    "rank_global": rank_global,
    "rank_text": rank_text,
    "rank_date": rank_date,
    "cumulative_share": cumulative_share,
    "share_of_total": share_of_total_lines,
    "mart_voltage_performance": lambda g: marts.voltage_performance(g.voltage),
    "mart_voltage_deterioration": lambda g: g.deterioration,
    "mart_asset_demand": lambda g: marts.asset_demand(g.power, SETTINGS),
    "mart_pump_demand": lambda g: marts.pump_demand(g.power, SETTINGS),
    "mart_pump_demand_contribution": lambda g: g.contribution,
    "mart_pump_demand_kpi": lambda g: marts.pump_demand_kpi(g.pumps),
    "mart_transformer_performance": lambda g: g.transformers,
    "mart_voltage_unbalance_hotspots": lambda g: marts.voltage_unbalance_hotspots(g.unbalance),
    "mart_management_kpi_summary": lambda g: g.kpi,
    "report_voltage_listing": lambda g: reports.voltage_listing(g.voltage),
    "report_loading_listing": lambda g: reports.loading_listing(g.loading),
    "report_power_listing": lambda g: reports.power_listing(g.power),
    "report_unbalance_listing": lambda g: reports.unbalance_listing(g.unbalance),
    "report_asset_listing": lambda g: reports.asset_listing(g.summary),
    "report_level_counts": lambda g: reports.level_counts(g.voltage),
    "report_q1_voltage": lambda g: reports.voltage_concentration(g.voltage),
    "report_q1_risk_locations": lambda g: reports.risk_locations(
        marts.voltage_performance(g.voltage), SETTINGS, in_order=True
    ),
    "report_q2_pumps": lambda g: reports.pump_contribution(marts.pump_shares(g.pumps)),
    "topn_pumps": lambda g: reports.top_pumps(marts.pump_shares(g.pumps), SETTINGS),
    "report_q3_assets": lambda g: reports.asset_demand_report(
        marts.asset_demand(g.power, SETTINGS), in_order=True
    ),
    "topn_assets": lambda g: reports.top_assets(marts.asset_demand_rows(g.power, SETTINGS), SETTINGS),
    "report_q4_deterioration": lambda g: reports.downstream_deterioration(g.deterioration),
    "report_q5_transformers": lambda g: reports.transformer_capacity(g.transformers),
    "report_q6_hotspots": lambda g: reports.unbalance_hotspots(
        marts.voltage_unbalance_hotspots(g.unbalance), in_order=True
    ),
    "report_q6_moderate": lambda g: reports.moderate_unbalance(g.unbalance),
    "report_q7_snapshot": lambda g: reports.executive_snapshot(g.kpi),
    "report_q8_priority": lambda g: reports.priority_locations(*g.profile, SETTINGS, g.bus_names),
    "bi_network_health": lambda g: extracts.network_health(*g.profile, g.bus_names),
    "bi_pump_demand": lambda g: extracts.pump_demand(g.contribution),
    "bi_asset_performance": lambda g: extracts.asset_performance(g.summary),
    "bi_kpi_summary": lambda g: extracts.kpi_summary(g.kpi),
    "bi_priority_locations": lambda g: extracts.priority_locations(
        *g.profile, SETTINGS, g.bus_names
    ),
    "audit_row_counts": lambda g: audits.audit_row_counts(g.audited()),
    "audit_critical_nulls": lambda g: audits.audit_critical_nulls(g.kpi),
    "audit_entities": lambda g: audits.audit_entities(
        g.audited(*[table for table, _ in audits.EXTRACT_ENTITIES.values()])
    ),
    "audit_gold": lambda g: audits.audit_gold(g.gold_tables),
    "audit_written": lambda g: audits.audit_written(g.built, g.built.rows),
    "stored_network_health": lambda g: g.built["powerbi_network_health"],
    "stored_kpi_summary": lambda g: g.built["powerbi_kpi_summary"],
    "audit_rejected": lambda g: audits.audit_rejected(
        {table: g.projected(name) for table, name in EXPORTS.items()}
    ),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: build(Grid(spark, sf_dir))

    return {name: bind(build) for name, build in _BY_NAME.items()}
