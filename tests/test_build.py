"""Four small CSV exports to BI extracts, against values worked out by hand."""

import pytest

from feederlens.plans import audits, build, gold, marts, reports
from feederlens.settings import GridSettings
from feederlens.sources.exports import read_exports

FILES = {
    "voltages": "GRID VOLTAGES 1.csv",
    "seqcurrents": "GRID SEQCURRENTS 1.csv",
    "seqpowers": "GRID SEQPOWERS 1.csv",
    "seqvoltages": "GRID SEQVOLTAGES 1.csv",
}
CSV = {
    "voltages": """\
Bus, Base kV ,Node1,Magnitude1,Angle1,pu1,Node2,Magnitude2,Angle2,pu2,Node3,Magnitude3,Angle3,pu3
SRC33,33,1,19052,0,1,2,19052,-120,1,3,19052,120,1
HT1,11,1,6000,0,1,2,6010,-120,1,3,5990,120,1
,,,,,,,,,,,,,
 LTBUS1 ,0.42,1,240,0,1,2,240,-120,1,3,240,120,1
LTBUS2,0.415,1,210,0,1,2,216,-120,1,3,,,
LTBUS3,0.42,1,,0,1,2,NA,-120,1,3,n/a,120,1
MID25,25,1,14433,0,1,2,14433,-120,1,3,14433,120,1
   ,11,1,1,0,1,2,1,-120,1,3,1,120,1
NA,11,1,1,0,1,2,1,-120,1,3,1,120,1
HT1,11,1,6000,0,1,2,6010,-120,1,3,5990,120,1
B\xfcrger,0.42,1,241,0,1,2,240,-120,1,3,239,120,1
""",
    "seqvoltages": """\
Bus,V1,,p.u.,Base kV,V2,%V2/V1,V0,%V0/V1,Vresidual,%NEMA
SRC33,19052,,1,33,0,NA,0,0,0,0
HT1,6000,,0.945,11,30,0.4999,0,0,0,0.3
LTBUS1,240,x,1.002,0.42,2.4,1.0,0,0,0,1.2
LTBUS2,213,,0.889,0.42,1,0.5,0,0,0,0.6
MID25,14433,,1,25,101,0.7004,0,0,0,0.7
""",
    "seqcurrents": """\
Element,Terminal,I1,%Normal,%Emergency,I2,%I2/I1,I0,%I0/I1,Iresidual,%NEMA
Transformer.T1,1,10.125,100,90,1,10,0,0,0,2
Transformer.T1,2,20,80,95,1,10,0,0,0,2
Transformer.T2,1,5,100.1,60,0,0,0,0,0,0
Transformer.T3,1,6,80,60,0,0,0,0,0,0
Transformer.T4,1,7,,,0,0,0,0,0,0
Line.L1,1,8,50,40,0,0,0,0,0,0
Load.P1,1,3,abc,10,0,0,0,0,0,0
Line.ONLYCUR,1,2,20,10,0,0,0,0,0,0
""",
    "seqpowers": """\
Element,Terminal,P1(kW),Q1(kvar),P2,Q2,P0,Q0,P_Normal,Q_Normal,P_Emergency,Q_Emergency
Load.P1,1,3,4,0,0,0,0,1,,,
Load.P1,2,-3,-4,0,0,0,0,,,,
Load.P2,1,6,8,0,0,0,0,,2,,
Load.P3,1,0,0,0,0,0,0,,,3,
Load.P4,1,3,4,0,0,0,0,,,,4
Line.L1,1,-3,4,0,0,0,0,,,,
Line.L1,2,3,-4,0,0,0,0,,,,
Transformer.T1,1,30,40,0,0,0,0,,,,
Transformer.T1,2,-30,-40,0,0,0,0,,,,
Line.ONLYPOW,1,1,0,0,0,0,0,,,,
""",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("exports")
    for name, text in CSV.items():
        (base / FILES[name]).write_bytes(text.encode("latin-1"))
    return str(base)


@pytest.fixture(scope="module")
def tables(spark, folder):
    return build.run_exports(spark, folder, FILES)


def by(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}


def near(*values):
    return tuple(pytest.approx(v, abs=5e-5) if isinstance(v, float) else v for v in values)


def test_all_tables_are_stored(spark, tables):
    assert len(tables) == 27
    stored = {
        layer: {t.name for t in spark.catalog.listTables(layer)}
        for layer in ("bronze", "silver", "gold", "analytics")
    }
    assert {layer: len(names) for layer, names in stored.items()} == {
        "bronze": 0, "silver": 8, "gold": 5, "analytics": 14,
    }


def test_audits_read_the_stored_tables(tables):
    found = build.audited(tables)
    counts = by(found["row_counts"], "table_name", "row_count")
    assert len(counts) == 14
    assert counts == {name: (tables[name].count(),) for name in counts}
    assert by(found["gold"], "table_name", "row_count")["asset_summary"] == (tables["asset_summary"].count(),)
    assert found["critical_nulls"].count() == 1 and found["entities"].count() == 4


def test_contribution_is_the_same_with_and_without_ranks(tables, rows):
    ranked = tables["pump_demand"]
    with_rank, without = (
        marts.pump_demand_contribution(p) for p in (ranked, ranked.drop("demand_rank"))
    )
    assert with_rank.columns == without.columns and rows(with_rank) == rows(without)


def test_base_silver(tables):
    base = tables["voltages"]
    assert by(base, "Bus", "source_row_id") == {
        "SRC33": (1,), "HT1": (2,), "LTBUS1": (3,), "LTBUS2": (4,), "LTBUS3": (5,),
        "MID25": (6,), "B\xfcrger": (10,),
    }
    assert {r.source_file for r in base.collect()} == {FILES["voltages"]}
    assert "Unnamed:_2" not in tables["seqvoltages"].columns
    flags = by(tables["seqpowers"].filter("Terminal = 1"), "Element", "has_normal_limit", "has_emergency_limit")
    assert flags["Load.P1"] == (True, False) and flags["Load.P2"] == (True, False)
    assert flags["Load.P3"] == (False, True) and flags["Load.P4"] == (False, True)
    assert flags["Line.L1"] == (False, False)


def test_voltage_health(tables):
    found = by(
        tables["voltage_performance"], "bus_name",
        "network_level", "voltage_average_v", "average_voltage_pu", "voltage_status",
    )
    assert found == {
        "SRC33": near("33kV_HT", 19052.0, 0.99997, "Within Range"),
        "HT1": near("11kV_HT", 6000.0, 0.94475, "Low Voltage"),
        "LTBUS1": near("415V_LT", 240.0, 1.00167, "Within Range"),
        "LTBUS2": near("415V_LT", 213.0, 0.88898, "Severe Deviation"),
        "LTBUS3": ("415V_LT", None, None, "Within Range"),
        "MID25": near("Unknown", 14433.0, 0.99995, "Within Range"),
        "B\xfcrger": near("415V_LT", 240.0, 1.00167, "Within Range"),
    }
    ranks = by(tables["voltage_performance"], "bus_name", "voltage_risk_rank")
    assert [b for b, _ in sorted(ranks.items(), key=lambda i: i[1])] == [
        "LTBUS3", "LTBUS2", "HT1", "MID25", "SRC33", "B\xfcrger", "LTBUS1",
    ]


def test_two_deviations_stay_apart(tables):
    silver = by(tables["voltages_standardized"], "bus_name", "voltage_deviation_percent")
    gold = by(tables["voltage_analysis"], "bus_name", "voltage_deviation_percent")
    assert silver["LTBUS1"] == near(-42.16867) and gold["LTBUS1"] == near(0.16678)


def test_deterioration(tables):
    found = by(
        tables["voltage_deterioration"], "bus_name",
        "dt_side_reference_voltage_v", "voltage_change_from_dt_side_v",
        "voltage_change_from_dt_side_percent",
    )
    assert found == {
        "LTBUS1": (240.0, 0.0, 0.0), "LTBUS2": (240.0, -27.0, -11.25),
        "LTBUS3": (240.0, None, None), "B\xfcrger": (240.0, 0.0, 0.0),
    }


def test_pumps(tables):
    found = by(
        tables["pump_demand_contribution"], "pump_name",
        "demand_rank", "apparent_power_kva", "power_factor", "total_apparent_power_kva",
        "active_power_contribution_percent", "apparent_power_contribution_percent",
        "cumulative_apparent_power_percent",
    )
    assert found == {
        "Load.P2": (1, 10.0, 0.6, 20.0, 50.0, 50.0, 50.0),
        "Load.P1": (2, 5.0, 0.6, 20.0, 25.0, 25.0, 75.0),
        "Load.P4": (3, 5.0, 0.6, 20.0, 25.0, 25.0, 100.0),
        "Load.P3": (4, 0.0, None, 20.0, 0.0, 0.0, 100.0),
    }
    kpi = tables["pump_demand_kpi"].first()
    assert tuple(kpi) == (4, 12.0, 16.0, 20.0, pytest.approx(0.6), 10.0, 0.0)


def test_asset_demand_keeps_terminal_one_of_network_assets(tables):
    found = by(tables["asset_demand"], "element_name", "demand_rank", "apparent_power_kva", "power_factor")
    assert found == {
        "Transformer.T1": (1, 50.0, 0.6), "Line.L1": (2, 5.0, -0.6), "Line.ONLYPOW": (3, 1.0, 1.0),
    }


def test_asset_summary(tables):
    found = by(
        tables["powerbi_asset_performance"], "element_name",
        "asset_type", "max_current_a", "normal_loading_percent", "apparent_power_kva",
        "active_power_kw", "reactive_power_kvar", "loading_status",
    )
    unrated = "Normal / Not Rated"
    assert found == {
        "Transformer.T1": ("Transformer", 20.0, 100.0, 50.0, 30.0, 40.0, "High Loading"),
        "Transformer.T2": ("Transformer", 5.0, 100.1, None, None, None, "Overloaded"),
        "Transformer.T3": ("Transformer", 6.0, 80.0, None, None, None, unrated),
        "Transformer.T4": ("Transformer", 7.0, None, None, None, None, unrated),
        "Line.L1": ("Line", 8.0, 50.0, 5.0, 3.0, 4.0, unrated),
        "Load.P1": ("Other", 3.0, None, 5.0, 3.0, 4.0, unrated),
        "Line.ONLYCUR": ("Line", 2.0, 20.0, None, None, None, unrated),
    }
    capacity = by(tables["transformer_performance"], "transformer_name", "transformer_capacity_status")
    assert capacity == {
        "Transformer.T1": ("High Utilization",), "Transformer.T2": ("Above Normal Rating",),
        "Transformer.T3": ("High Utilization",), "Transformer.T4": ("Rating Not Available",),
    }


def test_management_kpis(tables):
    assert tables["management_kpi_summary"].first().asDict() == {
        "total_buses": 7, "lt_buses": 4, "low_voltage_buses": 1, "severe_voltage_buses": 1,
        "worst_voltage_deviation_percent": -11.1, "worst_voltage_bus": "LTBUS2",
        "max_downstream_deterioration_percent": 11.25, "greatest_deterioration_bus": "LTBUS2",
        "pump_count": 4, "total_pump_active_power_kw": 12.0, "total_pump_reactive_power_kvar": 16.0,
        "total_pump_apparent_power_kva": 20.0, "average_pump_power_factor": 0.6,
        "highest_pump_apparent_power_kva": 10.0, "max_transformer_normal_loading_percent": 100.1,
        "highest_loaded_transformer": "Transformer.T2",
        "moderate_unbalance_buses": 2, "low_unbalance_buses": 2,
    }
    extract = tables["powerbi_kpi_summary"]
    assert len(extract.columns) == 16
    assert extract.columns == reports.executive_snapshot(tables["management_kpi_summary"]).columns


def test_network_health(tables):
    found = by(
        tables["powerbi_network_health"], "bus_name",
        "nominal_voltage_kv", "voltage_pu", "voltage_deviation_percent",
        "downstream_voltage_change_v", "downstream_voltage_change_percent",
        "voltage_unbalance_percent", "unbalance_status",
    )
    assert found == {
        "SRC33": (33.0, 1.0, -0.0, None, None, None, "Low Unbalance"),
        "HT1": (11.0, 0.9448, -5.52, None, None, 0.5, "Low Unbalance"),
        "LTBUS1": (0.415, 1.0017, 0.17, 0.0, 0.0, 1.0, "High Unbalance"),
        "LTBUS2": (0.415, 0.889, -11.1, -27.0, -11.25, 0.5, "Moderate Unbalance"),
        "LTBUS3": (0.415, None, None, None, None, None, None),
        "MID25": (25.0, 0.9999, -0.01, None, None, 0.7, "Moderate Unbalance"),
        "B\xfcrger": (0.415, 1.0017, 0.17, 0.0, 0.0, None, None),
    }


def test_pump_and_priority_extracts(tables):
    pumps = by(tables["powerbi_pump_demand"], "pump_name", "demand_contribution_percent", "cumulative_demand_contribution_percent")
    assert pumps == {
        "Load.P2": (50.0, 50.0), "Load.P1": (25.0, 75.0), "Load.P4": (25.0, 100.0), "Load.P3": (0.0, 100.0),
    }
    places = by(tables["powerbi_priority_locations"], "bus_name", "downstream_voltage_change_percent", "unbalance_status")
    assert places == {
        "LTBUS1": (0.0, "High Unbalance"), "LTBUS2": (-11.25, "Moderate Unbalance"),
        "LTBUS3": (None, None), "B\xfcrger": (0.0, None),
    }


def test_reports_are_in_order(tables):
    q1 = [r.bus_name for r in reports.voltage_concentration(tables["voltage_performance"]).collect()]
    assert q1 == ["LTBUS3", "LTBUS2", "HT1", "MID25", "SRC33", "B\xfcrger", "LTBUS1"]
    risk = [(r.bus_name, r.voltage_risk_rank) for r in reports.risk_locations(tables["voltage_performance"]).collect()]
    assert risk == [("LTBUS2", 2), ("HT1", 3)]
    listing = [r.bus_name for r in reports.voltage_listing(tables["voltage_analysis"]).collect()]
    assert listing == ["SRC33", "HT1", "B\xfcrger", "LTBUS1", "LTBUS2", "LTBUS3", "MID25"]
    top = [r.pump_name for r in reports.top_pumps(tables["pump_demand_contribution"]).collect()]
    assert top == ["Load.P2", "Load.P1", "Load.P4", "Load.P3"]
    q4 = [r.bus_name for r in reports.downstream_deterioration(tables["voltage_deterioration"]).collect()]
    assert q4 == ["LTBUS3", "LTBUS2", "B\xfcrger", "LTBUS1"]
    q6 = [r.bus_name for r in reports.unbalance_hotspots(tables["voltage_unbalance_hotspots"]).collect()]
    assert q6 == ["LTBUS1", "MID25", "LTBUS2", "HT1", "SRC33"]
    levels = [tuple(r) for r in reports.level_counts(tables["voltage_analysis"]).collect()]
    assert levels == [("415V_LT", 4), ("11kV_HT", 1), ("33kV_HT", 1), ("Unknown", 1)]


def test_audits(tables):
    counts = by(audits.audit_row_counts(tables), "table_name", "row_count")
    assert counts == {
        "voltage_performance": (7,), "voltage_deterioration": (4,), "asset_demand": (3,),
        "pump_demand": (4,), "pump_demand_contribution": (4,), "pump_demand_kpi": (1,),
        "transformer_performance": (4,), "voltage_unbalance_hotspots": (5,),
        "management_kpi_summary": (1,), "powerbi_network_health": (7,), "powerbi_pump_demand": (4,),
        "powerbi_asset_performance": (7,), "powerbi_kpi_summary": (1,),
        "powerbi_priority_locations": (4,),
    }
    assert set(audits.audit_critical_nulls(tables["management_kpi_summary"]).first()) == {0}
    entities = by(audits.audit_entities(tables), "dataset", "rows", "unique_business_entities")
    assert entities["network_health"] == (7, 7) and entities["asset_performance"] == (7, 7)
    gold = by(audits.audit_gold(tables), "table_name", "row_count", "null_keys", "repeated_keys")
    assert gold == {
        "voltage_analysis": (7, 0, 0), "asset_loading": (8, 0, 0), "power_flow": (10, 0, 0),
        "voltage_unbalance": (5, 0, 0), "asset_summary": (7, 0, 0),
    }


def test_rejected_rows_are_counted(spark, folder):
    rejected = audits.audit_rejected(read_exports(spark, folder, FILES))
    assert by(rejected, "table_name", "row_count", "rejected_keys") == {
        "voltages": (10, 2), "seqcurrents": (8, 0), "seqpowers": (10, 0), "seqvoltages": (5, 0),
    }


def test_no_pumps_and_no_reference_bus(spark, tables):
    none = tables["power_flow"].filter("asset_type = 'nothing'")
    kpi = marts.pump_demand_kpi(marts.pump_rows(none)).first()
    assert tuple(kpi) == (0, None, None, None, None, None, None)
    assert marts.pump_demand_contribution(marts.pump_rows(none)).count() == 0
    other = GridSettings(reference_bus="NOWHERE")
    changes = marts.voltage_deterioration(tables["voltage_analysis"], other)
    assert {r.voltage_change_from_dt_side_percent for r in changes.collect()} == {None}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_stored_tables(tables):
    summary = gold.asset_summary(tables["asset_loading"], tables["power_flow"])
    transformers = plan_of(marts.transformer_performance(summary))
    # Below both aggregations, as a test of the name.
    assert sum("- Filter" in line and "Transformer." in line for line in transformers.splitlines()) == 2
    stored = plan_of(marts.transformer_performance(tables["asset_summary"]))
    assert "EqualTo(asset_type,Transformer)" in stored
    pumps = plan_of(marts.pump_rows(tables["power_flow"]))
    assert "EqualTo(asset_type,Pump Load)" in pumps and "EqualTo(terminal,1)" in pumps
    reference = plan_of(marts.reference_voltage(tables["voltage_analysis"]))
    assert "EqualTo(bus_name,LTBUS1)" in reference
