"""Exports to BI extracts, every layer stored. Later tables read stored ones.

A build is stored beside the published one and audited before it takes its
place, so a fault half way leaves the published tables as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from feederlens.plans import audits, extracts, gold, marts, silver
from feederlens.sources.exports import read_exports
from feederlens.sources.staging import StagedBuild, Stored
from feederlens.sources.tables import create_layers
from feederlens import settings as S

STANDARDIZE = {
    "voltages": silver.voltages_standardized,
    "seqcurrents": lambda df, _: silver.seqcurrents_standardized(df),
    "seqpowers": lambda df, _: silver.seqpowers_standardized(df),
    "seqvoltages": lambda df, _: silver.seqvoltages_standardized(df),
}


class Built(dict):
    """Stored tables by name, with the rows written to each (``rows``) and the name of the build."""

    def __init__(self, build: str, stored: Mapping[str, Stored]):
        super().__init__({name: t.table for name, t in stored.items()})
        self.build = build
        self.rows = {name: t.rows for name, t in stored.items()}


class BuildRejected(Exception):
    """The audits found faults in a build; it is stored, but not published."""


class Layers:
    """Stored tables by name, one folder per layer."""

    def __init__(self, staged: StagedBuild):
        self.staged = staged
        self.stored: dict[str, Stored] = {}
        self.tables: dict[str, DataFrame] = {}

    def save(self, layer: str, **builds: Callable[[], DataFrame]) -> None:
        """Build and save tables that do not need each other, side by side."""

        def one(name):
            return name, self.staged.save(layer, name, builds[name])

        with ThreadPoolExecutor(len(builds)) as pool:
            for name, stored in pool.map(one, builds):
                self.stored[name], self.tables[name] = stored, stored.table


def build_silver(
    out: Layers,
    raw: Mapping[str, DataFrame],
    settings: S.GridSettings,
    one_file: Collection[str] = (),
) -> None:
    t = out.tables
    out.save("silver", **{
        name: lambda name=name: silver.clean_export(raw[name], name, name in one_file)
        for name in STANDARDIZE
    })
    out.save("silver", **{
        f"{name}_standardized": lambda name=name: STANDARDIZE[name](t[name], settings)
        for name in STANDARDIZE
    })


def build_gold(out: Layers) -> None:
    t = out.tables
    out.save(
        "gold",
        voltage_analysis=lambda: gold.voltage_analysis(t["voltages_standardized"]),
        asset_loading=lambda: gold.asset_loading(t["seqcurrents_standardized"]),
        power_flow=lambda: gold.power_flow(t["seqpowers_standardized"]),
        voltage_unbalance=lambda: gold.voltage_unbalance(t["seqvoltages_standardized"]),
    )
    out.save(
        "gold", asset_summary=lambda: gold.asset_summary(t["asset_loading"], t["power_flow"])
    )


def build_analytics(out: Layers, settings: S.GridSettings) -> None:
    t = out.tables
    out.save(
        "analytics",
        voltage_performance=lambda: marts.voltage_performance(t["voltage_analysis"]),
        asset_demand=lambda: marts.asset_demand(t["power_flow"], settings),
        pump_demand=lambda: marts.pump_demand(t["power_flow"], settings),
        transformer_performance=lambda: marts.transformer_performance(
            t["asset_summary"], settings
        ),
        voltage_unbalance_hotspots=lambda: marts.voltage_unbalance_hotspots(
            t["voltage_unbalance"]
        ),
    )
    out.save(
        "analytics",
        voltage_deterioration=lambda: marts.voltage_deterioration(
            t["voltage_performance"], settings
        ),
        pump_demand_contribution=lambda: marts.pump_demand_contribution(t["pump_demand"]),
        pump_demand_kpi=lambda: marts.pump_demand_kpi(t["pump_demand"]),
    )
    out.save(
        "analytics",
        management_kpi_summary=lambda: marts.management_kpi_summary(
            t["voltage_analysis"], t["voltage_deterioration"], t["pump_demand"],
            t["transformer_performance"], t["voltage_unbalance_hotspots"], settings,
        ),
    )


def build_extracts(out: Layers, settings: S.GridSettings) -> None:
    t = out.tables
    profile = (
        t["voltage_performance"], t["voltage_deterioration"], t["voltage_unbalance_hotspots"]
    )
    out.save(
        "analytics",
        powerbi_network_health=lambda: extracts.network_health(*profile),
        powerbi_pump_demand=lambda: extracts.pump_demand(t["pump_demand_contribution"]),
        powerbi_asset_performance=lambda: extracts.asset_performance(t["asset_summary"]),
        powerbi_kpi_summary=lambda: extracts.kpi_summary(t["management_kpi_summary"]),
        powerbi_priority_locations=lambda: extracts.priority_locations(*profile, settings),
    )


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    settings: S.GridSettings = S.DEFAULTS,
    fmt: str = "parquet",
    one_file: Collection[str] = (),
    build: str | None = None,
    root: str | None = None,
    publish: bool = True,
) -> Built:
    """Build, store and publish all 27 tables from the four raw tables; returns them by name.

    ``one_file`` names the raw tables that come from a single file. ``build``
    names the build: one that stopped goes on behind its last stored table if
    it is run again under its name, with the same inputs. ``root`` is the
    folder of the builds. Faults that the audits find raise ``BuildRejected``
    and leave the published build; with ``publish`` off nothing is switched.
    """
    staged = StagedBuild(spark, build or uuid.uuid4().hex, root, fmt)
    out = Layers(staged)
    build_silver(out, raw, settings, one_file)
    build_gold(out)
    build_analytics(out, settings)
    build_extracts(out, settings)
    built = Built(staged.build, out.stored)
    if publish:
        if found := faults(built):
            raise BuildRejected("; ".join(found))
        create_layers(spark)
        staged.publish(out.stored.values())
    return built


def faults(built: Built) -> list[str]:
    """What keeps a build from being published: rows lost in storing, gold rows without a key."""
    lost = audits.audit_written(built, built.rows).where("lost_rows != 0").collect()
    nameless = audits.audit_gold(built).where("null_keys > 0").collect()
    return [
        *[f"{r.table_name}: {r.written_rows} rows written, {r.stored_rows} stored" for r in lost],
        *[f"{r.table_name}: {r.null_keys} rows without a key" for r in nameless],
    ]


def audited(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The audits over what ``run`` stored, by name; each reads the stored tables only.

    Row counts are those taken while writing, where ``tables`` is what ``run``
    returned; ``written`` holds them against the rows that are stored now.
    """
    rows = getattr(tables, "rows", None)
    found = {
        "row_counts": audits.audit_row_counts(tables, rows),
        "critical_nulls": audits.audit_critical_nulls(tables["management_kpi_summary"]),
        "entities": audits.audit_entities(tables, rows),
        "gold": audits.audit_gold(tables),
    }
    if rows is not None:
        found["written"] = audits.audit_written(tables, rows)
    return found


def run_exports(
    spark: SparkSession,
    base: str,
    files: Mapping[str, str],
    settings: S.GridSettings = S.DEFAULTS,
    fmt: str = "parquet",
    multiline: bool = False,
    build: str | None = None,
    root: str | None = None,
    bad_rows: str = "error",
) -> Built:
    """The whole way from four CSV exports; ``multiline`` and ``bad_rows`` as in ``read_export``, the rest as in ``run``."""
    raw = read_exports(spark, base, files, multiline, bad_rows)
    one_file = {name for name, df in raw.items() if len(df.inputFiles()) == 1}
    return run(spark, raw, settings, fmt, one_file, build, root)
