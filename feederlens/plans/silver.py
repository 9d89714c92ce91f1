"""Silver layer: cleaned exports and their standardized form."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feederlens.functions import bands, numbers as N
from feederlens.operators import cleaning as C
from feederlens import settings as S


def clean_export(raw: DataFrame, table: str, one_file: bool = False) -> DataFrame:
    """Base silver table of a raw export: typed, without copies and nameless rows."""
    key = S.EXPORT_KEYS[table]
    df = C.trim_keys(raw, [key])
    df = C.coerce_numeric(df, S.EXPORT_NUMBERS[table])
    df = C.coerce_terminal(df, [S.TERMINAL])
    # Rejecting nameless rows first keeps them out of the shuffle of dedupe.
    df = C.dedupe(C.require_key(df, key), one_file=one_file)
    df = C.drop_unnamed(df)
    return C.with_limit_flags(df) if table == "seqpowers" else df


def standardize(df: DataFrame, table: str) -> DataFrame:
    """Select and rename into the standard schema; lineage is kept where present."""
    types = {f.name: f.dataType for f in df.schema.fields}
    convert = {
        "key": lambda value, _: N.strip(value),
        "number": N.to_number,
        "terminal": N.to_terminal,
    }

    found = C.resolve_all(df, {name: spellings for name, _, spellings in S.STANDARD_COLUMNS[table]})

    def column(name, kind, _):
        return convert[kind](C.quoted(found[name]), types[found[name]]).alias(name)

    lineage = [c for c in S.LINEAGE if c in types]
    return df.select(*[column(*spec) for spec in S.STANDARD_COLUMNS[table]], *lineage)


def _with_lineage_last(df, added):
    lineage = [c for c in S.LINEAGE if c in df.columns]
    return df.withColumns(added).select(
        *[c for c in df.columns if c not in lineage], *added, *lineage
    )


def voltages_standardized(
    voltages: DataFrame, settings: S.GridSettings = S.DEFAULTS
) -> DataFrame:
    """One row per bus: nominal voltage, network level and phase statistics."""
    df = standardize(voltages, "voltages")
    base = F.col("base_voltage_kv")
    nominal_kv = F.when(base < settings.snap_below_kv, settings.snap_to_kv).otherwise(base)
    phases = [F.col(f"voltage_phase_{p}_v") for p in "abc"]
    df = _with_lineage_last(df, {
        "nominal_voltage_kv": nominal_kv,
        "nominal_voltage_v": N.kilo_to_unit(nominal_kv),
        "network_level": bands.band(nominal_kv, S.LEVEL_BANDS, S.LEVEL_DEFAULT),
        "voltage_average_v": N.row_mean(*phases),
        "voltage_min_v": F.least(*phases),
        "voltage_max_v": F.greatest(*phases),
    })
    average, nominal = F.col("voltage_average_v"), F.col("nominal_voltage_v")
    # Against the line-to-line nominal; gold has its own, phase-based value.
    off = N.deviation(average, nominal)
    gap = N.spread(*phases)
    return _with_lineage_last(df, {
        "voltage_average_kv": N.unit_to_kilo(average),
        "voltage_deviation_v": off,
        "voltage_deviation_percent": N.percent_of(off, nominal),
        "phase_voltage_spread_v": gap,
        "phase_voltage_spread_percent": N.percent_of(gap, average),
    })


def seqcurrents_standardized(currents: DataFrame) -> DataFrame:
    """One row per element terminal: currents, unbalance and loading."""
    return standardize(currents, "seqcurrents")


def seqpowers_standardized(powers: DataFrame) -> DataFrame:
    """One row per element terminal: P, Q, S and power factor."""
    df = standardize(powers, "seqpowers")
    apparent = N.apparent_power(F.col("active_power_kw"), F.col("reactive_power_kvar"))
    df = _with_lineage_last(df, {"apparent_power_kva": apparent})
    factor = N.power_factor(F.col("active_power_kw"), F.col("apparent_power_kva"))
    return _with_lineage_last(df, {"power_factor": factor})


def seqvoltages_standardized(voltages: DataFrame) -> DataFrame:
    """One row per bus: sequence voltages and unbalance."""
    return standardize(voltages, "seqvoltages")
