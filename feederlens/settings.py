"""Domain constants: labels, bounds, spellings and rounding, all in one place."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. Labels, bounds, prefixes and spellings below are part of the
# data contract: stored tables and reports carry them literally.
# ---------------------------------------------------------------------------

# Ordered bands: (comparison, bound, label); the first match wins.
LEVEL_BANDS = (
    (">=", 30, "33kV_HT"),
    ("between", (1, 20), "11kV_HT"),
    ("<", 1, "415V_LT"),
)
LEVEL_DEFAULT = "Unknown"

VOLTAGE_BANDS = (
    ("<", 0.90, "Severe Deviation"),
    ("<", 0.95, "Low Voltage"),
)
VOLTAGE_DEFAULT = "Within Range"

UNBALANCE_BANDS = (
    (">=", 1, "High Unbalance"),
    (">=", 0.5, "Moderate Unbalance"),
)
UNBALANCE_DEFAULT = "Low Unbalance"

LOADING_BANDS = (
    (">", 100, "Overloaded"),
    (">", 80, "High Loading"),
)
LOADING_DEFAULT = "Normal / Not Rated"

CAPACITY_BANDS = (
    (">", 100, "Above Normal Rating"),
    (">=", 80, "High Utilization"),
    ("missing", None, "Rating Not Available"),
)
CAPACITY_DEFAULT = "Within Reported Rating"

# Element-name prefixes (case-sensitive). Loading has no pump branch.
LOADING_PREFIXES = (
    ("Transformer.", "Transformer"),
    ("Line.", "Line"),
    ("Vsource.", "Source"),
)
POWER_PREFIXES = LOADING_PREFIXES + (("Load.", "Pump Load"),)
PREFIX_DEFAULT = "Other"

# Cells that mean "missing" in a text export.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Characters removed from both ends of a key: all whitespace of latin-1 text.
KEY_WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"

# Text accepted as a number.
NUMBER_PATTERN = (
    r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
)

# Prefix given to a column whose header cell is blank.
UNNAMED_PREFIX = "Unnamed:_"

# Key column and numeric columns of each cleaned export.
EXPORT_KEYS = {
    "voltages": "Bus",
    "seqcurrents": "Element",
    "seqpowers": "Element",
    "seqvoltages": "Bus",
}
EXPORT_NUMBERS = {
    "voltages": (
        "BasekV",
        "Node1", "Magnitude1", "Angle1", "pu1",
        "Node2", "Magnitude2", "Angle2", "pu2",
        "Node3", "Magnitude3", "Angle3", "pu3",
        "Node4", "Magnitude4", "Angle4", "pu4",
    ),
    "seqcurrents": (
        "I1", "PercentNormal", "PercentEmergency", "I2", "PercentI2_I1",
        "I0", "PercentI0_I1", "Iresidual", "PercentNEMA",
    ),
    "seqpowers": (
        "P1kW", "Q1kvar", "P2", "Q2", "P0", "Q0",
        "P_Normal", "Q_Normal", "P_Emergency", "Q_Emergency",
    ),
    "seqvoltages": (
        "V1", "p.u.", "Base_kV", "V2", "PercentV2_V1", "V0", "PercentV0_V1",
        "Vresidual", "PercentNEMA",
    ),
}
TERMINAL = "Terminal"

# Standard name, kind and accepted spellings of every standardized column.
STANDARD_COLUMNS = {
    "voltages": (
        ("bus_name", "key", ("Bus",)),
        ("base_voltage_kv", "number", ("BasekV", "Base_kV", "Base kV")),
        ("voltage_phase_a_v", "number", ("Magnitude1",)),
        ("voltage_phase_b_v", "number", ("Magnitude2",)),
        ("voltage_phase_c_v", "number", ("Magnitude3",)),
    ),
    "seqcurrents": (
        ("element_name", "key", ("Element",)),
        ("terminal", "terminal", ("Terminal",)),
        ("current_a", "number", ("I1",)),
        ("negative_sequence_current_a", "number", ("I2",)),
        ("zero_sequence_current_a", "number", ("I0",)),
        ("residual_current_a", "number", ("Iresidual",)),
        ("current_unbalance_percent", "number", ("%I2/I1", "PercentI2_I1")),
        ("normal_loading_percent", "number", ("%Normal", "PercentNormal")),
        ("emergency_loading_percent", "number", ("%Emergency", "PercentEmergency")),
        ("nema_unbalance_percent", "number", ("%NEMA", "PercentNEMA")),
    ),
    "seqpowers": (
        ("element_name", "key", ("Element",)),
        ("terminal", "terminal", ("Terminal",)),
        ("active_power_kw", "number", ("P1kW", "P1(kW)")),
        ("reactive_power_kvar", "number", ("Q1kvar", "Q1(kvar)")),
    ),
    "seqvoltages": (
        ("bus_name", "key", ("Bus",)),
        ("positive_sequence_voltage_v", "number", ("V1",)),
        ("negative_sequence_voltage_v", "number", ("V2",)),
        ("zero_sequence_voltage_v", "number", ("V0",)),
        ("residual_voltage_v", "number", ("Vresidual",)),
        ("voltage_pu", "number", ("p.u.", "pu")),
        ("voltage_unbalance_percent", "number", ("%V2/V1", "PercentV2_V1")),
        ("zero_sequence_percent", "number", ("%V0/V1", "PercentV0_V1")),
        ("nema_unbalance_percent", "number", ("%NEMA", "PercentNEMA")),
    ),
}
LINEAGE = ("source_file", "source_row_id")

# Layer namespaces and their descriptions.
LAYERS = {
    "bronze": "Raw exports",
    "silver": "Cleaned and standardized tables",
    "gold": "Business tables",
    "analytics": "Marts, reports and BI extracts",
}


@dataclass(frozen=True)
class GridSettings:
    """Values an operator of another network may want to change."""

    reference_bus: str = "LTBUS1"
    low_voltage_level: str = "415V_LT"
    snap_below_kv: float = 1.0
    snap_to_kv: float = 0.415
    metered_terminal: int = 1
    network_types: tuple[str, ...] = ("Transformer", "Line")
    pump_type: str = "Pump Load"
    transformer_type: str = "Transformer"
    risk_statuses: tuple[str, ...] = ("Low Voltage", "Severe Deviation")
    top_pumps: int = 5
    top_assets: int = 10


DEFAULTS = GridSettings()
