"""Builds are published whole or not at all, go on where they stopped, and count what they write."""

from pathlib import Path

import pytest

from feederlens.plans import build, gold
from feederlens.sources import staging
from feederlens.sources.exports import raw_table, read_export
from test_build import CSV, FILES


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("exports")
    for name, text in CSV.items():
        (folder / FILES[name]).write_bytes(text.encode("latin-1"))
    return {name: raw_table(read_export(spark, str(folder / file))) for name, file in FILES.items()}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("builds"))


@pytest.fixture(scope="module")
def first(spark, raw, root):
    return build.run(spark, raw, build="first", root=root)


def buses(df):
    return {r.bus_name for r in df.select("bus_name").collect()}


def without(raw, bus):
    return raw | {t: raw[t].where(f"Bus != '{bus}'") for t in ("voltages", "seqvoltages")}


def test_nothing_is_published_at_first(spark, tmp_path):
    assert staging.current(spark, str(tmp_path)) is None
    with pytest.raises(LookupError):
        staging.published(spark, str(tmp_path))


def test_rows_are_counted_while_writing(first):
    assert len(first.rows) == 27 and first.rows == {name: df.count() for name, df in first.items()}
    found = build.audited(first)
    plan = found["row_counts"]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    assert {r.table_name: r.row_count for r in found["row_counts"].collect()} == {
        r.table_name: r.row_count for r in build.audits.audit_row_counts(dict(first)).collect()
    }
    entities = sorted(map(tuple, found["entities"].collect()))
    assert entities == sorted(map(tuple, build.audits.audit_entities(dict(first)).collect()))
    assert {r.lost_rows for r in found["written"].collect()} == {0} and not build.faults(first)


def test_stored_tables_keep_pushing_filters_down(spark, first):
    for df in (first["power_flow"], spark.table("gold.power_flow")):
        plan = df.where("terminal = 1").select("element_name")._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(terminal,1)" in plan and "apparent_power_kva" not in plan[plan.index("ReadSchema"):]


def test_tables_saved_before_are_replaced_by_views(spark, first, root):
    spark.sql("DROP VIEW gold.power_flow")
    spark.range(3).write.saveAsTable("gold.power_flow")
    staging.point_views(spark, root)
    assert "element_name" in spark.table("gold.power_flow").columns


def test_a_fault_half_way_leaves_the_published_tables(spark, raw, root, first, monkeypatch):
    everyone = buses(spark.table("analytics.powerbi_network_health"))
    made = []
    clean, loading = build.silver.clean_export, gold.asset_loading
    monkeypatch.setattr(build.silver, "clean_export", lambda df, name, *a: made.append(name) or clean(df, name, *a))

    def broken(*_):
        raise RuntimeError("no loading today")

    monkeypatch.setattr(gold, "asset_loading", broken)
    with pytest.raises(RuntimeError, match="no loading today"):
        build.run(spark, without(raw, "MID25"), build="second", root=root)
    assert sorted(made) == sorted(FILES)
    # Readers still see the old build, in every layer.
    assert staging.current(spark, root)["build"] == "first"
    assert buses(spark.table("analytics.powerbi_network_health")) == everyone
    assert buses(spark.table("silver.voltages_standardized")) == everyone
    assert buses(staging.published(spark, root)["voltage_performance"]) == everyone

    # Run again under its name, the build goes on behind silver; the views, which stop here, follow later.
    monkeypatch.setattr(gold, "asset_loading", loading)
    point = staging.point_views
    monkeypatch.setattr(staging, "point_views", lambda *a: None)
    built = build.run(spark, without(raw, "MID25"), build="second", root=root)
    assert sorted(made) == sorted(FILES)
    assert built.build == staging.current(spark, root)["build"] == "second"
    for tables in (built, staging.published(spark, root)):
        assert buses(tables["powerbi_network_health"]) == everyone - {"MID25"}
    assert buses(spark.table("analytics.powerbi_network_health")) == everyone
    point(spark, root)
    assert buses(spark.table("analytics.powerbi_network_health")) == everyone - {"MID25"}
    staging.drop_build(spark, "first", root)
    assert not (Path(root) / "first").exists()
    with pytest.raises(ValueError, match="is published"):
        staging.drop_build(spark, "second", root)


def test_a_lost_row_shows_and_is_not_published(spark, raw, tmp_path):
    root = str(tmp_path)
    built = build.run(spark, raw, build="short", root=root, publish=False)
    folder = tmp_path / "short" / "gold" / "power_flow"
    rows = built["power_flow"].collect()
    # A file that went, as after a disk's loss.
    for file in folder.glob("part-*.parquet"):
        file.unlink()
    spark.createDataFrame(rows[1:], built["power_flow"].schema).write.mode("append").parquet(str(folder))
    again = build.run(spark, raw, build="short", root=root, publish=False)
    written = {r.table_name: r for r in build.audited(again)["written"].collect()}
    assert (written["power_flow"].written_rows, written["power_flow"].stored_rows, written["power_flow"].lost_rows) == (10, 9, 1)
    with pytest.raises(build.BuildRejected, match="power_flow: 10 rows written, 9 stored"):
        build.run(spark, raw, build="short", root=root)
    assert staging.current(spark, root) is None
