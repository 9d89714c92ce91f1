"""Registered queries against their SQL, and the shape of their plans."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from feederlens.catalog import oracle, queries as registered
from feederlens.plans import gold, marts, silver

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registered.queries(), oracle.oracle_sql()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert contract.entry(spark).count() == 150


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(SQL[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert types == {f.name: TYPES[f.dataType.simpleString()] for f in df.schema}
    order = [df.columns.index(c) for c in types]
    found = sorted((tuple(r[i] for i in order) for r in df.collect()), key=repr)
    assert found == sorted(result.fetchall(), key=repr)
    plan = executed(df)
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize("name", ["topn_pumps", "topn_assets"])
def test_top_n_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in executed(QUERIES[name](spark, SF))


def test_asset_summary_shuffles_each_side_once(spark):
    # Without base silver, whose removal of copies shuffles once more.
    grid = registered.Grid(spark, SF)
    currents, powers = (grid.projected(registered.EXPORTS[t]) for t in ("seqcurrents", "seqpowers"))
    loading = gold.asset_loading(silver.seqcurrents_standardized(currents))
    plan = executed(gold.asset_summary(loading, gold.power_flow(silver.seqpowers_standardized(powers))))
    assert plan.count("Exchange hashpartitioning(element_name") == 2
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 2


def test_scans_read_only_what_they_need(spark):
    plan = executed(QUERIES["agg_power_by_element"](spark, SF))
    read = plan[plan.index("ReadSchema"):]
    assert "p_partkey" in read and "p_retailprice" in read and "p_name" not in read


def test_contract_has_all_queries():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_top_assets_are_numbered_after_the_limit(spark):
    plan = QUERIES["topn_assets"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("GlobalLimit")
    assert plan.count("Window") == 1


def test_audit_counts_the_mart_it_names(spark, monkeypatch):
    before = {r["table_name"]: r for r in QUERIES["audit_row_counts"](spark, SF).collect()}
    ranked = marts.voltage_performance
    monkeypatch.setattr(marts, "voltage_performance", lambda *a, **k: ranked(*a, **k).limit(3))
    after = {r["table_name"]: r for r in QUERIES["audit_row_counts"](spark, SF).collect()}
    assert [t for t in before if before[t] != after[t]] == ["voltage_performance"]
    assert 3 in after["voltage_performance"].asDict().values()


@pytest.mark.parametrize("name", ["report_q6_hotspots", "report_q3_assets", "report_q1_risk_locations"])
def test_reports_of_ranked_rows_sort_no_second_time(spark, monkeypatch, name):
    from feederlens.operators import ranking

    monkeypatch.setattr(ranking, "ROWS_PER_SLOT", (20, 40))
    report = QUERIES[name](spark, SF)
    rank = next(c for c in report.columns if c.endswith("rank"))
    found = [r[rank] for r in report.collect()]
    assert found == sorted(found) and len(found) > 20
    plan = executed(report)
    # The removal of copies, then the ranking's one exchange of rows.
    assert "rangepartitioning" not in plan
    assert plan[plan.index("Final Plan"):plan.index("\n+- == Initial Plan ==")].count("Exchange shufflepartitionidpassthrough") >= 1
