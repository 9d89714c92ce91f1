"""The four grid exports, and a dirty one, as projections of the given tables.

Buses come from ``customer`` and element terminals from ``part``. Every source
row gives its export rows; a blank name, which cleaning rejects, stands for a
bus without sequence values or an element without power. The expressions mean
the same in Spark SQL and in the SQL of the check. Every tenth part comes twice
with the same values, for the removal of copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

REFERENCE_BUS = "Customer#000000002"

_BASE_KV = (
    "CAST(CASE c_custkey % 5 WHEN 0 THEN 33 WHEN 1 THEN 11 WHEN 2 THEN 0.42"
    " WHEN 3 THEN 0.415 ELSE 25 END AS DOUBLE)"
)
_PHASE = (
    f"(CASE WHEN {_BASE_KV} < 1 THEN CAST(0.415 AS DOUBLE) ELSE {_BASE_KV} END)"
    " * 1000 / sqrt(CAST(3 AS DOUBLE))"
)
_SHARE = "(c_acctbal + 1000) / 11000"
_ELEMENT = (
    "(CASE p_partkey % 5 WHEN 0 THEN 'Transformer.' WHEN 1 THEN 'Line.' WHEN 2 THEN 'Vsource.'"
    " WHEN 3 THEN 'Load.' ELSE 'Capacitor.' END) || CAST(p_partkey AS STRING)"
)


def _magnitude(low: str, missing: str) -> str:
    return f"CASE WHEN {missing} THEN NULL ELSE {_PHASE} * ({low} + 0.2e0 * ({_SHARE})) END"


# Source table, then (expression, column) pairs. "part" rows come once per terminal and copy.
PROJECTIONS = {
    "g_voltages": ("customer", [
        ("c_custkey", "source_row_id"),
        ("c_name", "Bus"),
        (_BASE_KV, "BasekV"),
        (_magnitude("0.85e0", "c_custkey % 29 = 0"), "Magnitude1"),
        (_magnitude("0.86e0", "c_custkey % 29 = 0"), "Magnitude2"),
        (_magnitude("0.87e0", "c_custkey % 29 = 0 OR c_custkey % 7 = 0"), "Magnitude3"),
    ]),
    "g_seqvoltages": ("customer", [
        ("c_custkey", "source_row_id"),
        ("CASE WHEN c_custkey % 9 = 0 THEN '  ' ELSE c_name END", "Bus"),
        ("(c_acctbal + 1000) / 40", "V1"),
        (_SHARE, "pu"),
        ("(c_acctbal + 1000) / 5000", "V2"),
        (f"CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE {_SHARE} * 1.5e0 END", "PercentV2_V1"),
        ("(c_acctbal + 1000) / 7000", "V0"),
        ("(c_acctbal + 1000) / 9000", "PercentV0_V1"),
        ("(c_acctbal + 1000) / 3000", "Vresidual"),
        ("(c_acctbal + 1000) / 8000", "PercentNEMA"),
    ]),
    "g_currents": ("part", [
        ("p_partkey * 4 + terminal + copy * 2", "source_row_id"),
        (_ELEMENT, "Element"),
        ("terminal", "Terminal"),
        ("p_retailprice / 10 + terminal", "I1"),
        ("CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size * 2.5e0 END", "PercentNormal"),
        ("CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size * 2e0 END", "PercentEmergency"),
        ("p_size * 0.25e0", "I2"),
        ("p_size * 0.1e0", "PercentI2_I1"),
        ("p_size * 0.05e0", "I0"),
        ("p_size * 0.15e0", "Iresidual"),
        ("p_size * 0.2e0", "PercentNEMA"),
    ]),
    "g_powers": ("part", [
        ("p_partkey * 4 + terminal + copy * 2", "source_row_id"),
        (f"CASE WHEN p_partkey % 13 = 0 THEN '  ' ELSE {_ELEMENT} END", "Element"),
        ("terminal", "Terminal"),
        (
            "CASE WHEN p_partkey % 17 = 0 THEN 0e0 WHEN terminal = 1 THEN p_retailprice / 10"
            " ELSE -p_retailprice / 10 END",
            "P1kW",
        ),
        ("CASE WHEN p_partkey % 17 = 0 THEN 0e0 ELSE p_size * 0.5e0 END", "Q1kvar"),
        ("CASE WHEN p_partkey % 4 = 0 THEN p_size * 3e0 END", "P_Normal"),
        ("CASE WHEN p_partkey % 6 = 0 THEN p_size * 2e0 END", "Q_Normal"),
        ("CASE WHEN p_partkey % 8 = 0 THEN p_size * 4e0 END", "P_Emergency"),
        ("CASE WHEN p_partkey % 10 = 0 THEN p_size * 3e0 END", "Q_Emergency"),
    ]),
    "g_dirty": ("customer", [
        ("c_custkey", "source_row_id"),
        (
            "CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '   '"
            " WHEN 2 THEN ' ' || c_name || ' ' WHEN 3 THEN 'NA' ELSE c_name END",
            "raw_key",
        ),
        (
            "CASE c_custkey % 8 WHEN 0 THEN 'n/a' WHEN 1 THEN '1.5d' WHEN 2 THEN ' 12.5 '"
            " WHEN 3 THEN '1e3' WHEN 4 THEN '1,000' WHEN 5 THEN NULL"
            " ELSE CAST(c_acctbal AS STRING) END",
            "raw_value",
        ),
    ]),
}


def project(df: DataFrame, name: str) -> DataFrame:
    """A projection of its source table."""
    source, columns = PROJECTIONS[name]
    if source == "part":
        df = df.withColumn("terminal", F.explode(F.array(F.lit(1), F.lit(2))))
        df = df.withColumn("copy", F.explode(F.expr("IF(p_partkey % 10 = 0, array(0, 1), array(0))")))
    return df.selectExpr(*[f"{expression} AS `{column}`" for expression, column in columns])


def projection_sql(name: str) -> str:
    source, columns = PROJECTIONS[name]
    if source == "part":
        source = (
            "(SELECT *, unnest(if(p_partkey % 10 = 0, [0, 1], [0])) AS copy"
            " FROM (SELECT *, unnest([1, 2]) AS terminal FROM part)) AS ends"
        )
    picked = ", ".join(f'{expression} AS "{column}"' for expression, column in columns)
    return f"SELECT {picked} FROM {source}"
