import pytest

from feederlens.plans import audits, silver
from feederlens.sources import exports as X
from feederlens.sources.tables import create_layers, save_table


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "500"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write_parts(folder, sizes):
    """CSV files whose ``n`` counts the rows that are not empty, per file."""
    for f, size in enumerate(sizes):
        lines, n = ["n,text"], 0
        for i in range(size):
            if i % 7 == 3:
                lines.append(",")
            else:
                n += 1
                lines.append(f"{n},{'x' * (i % 40)}row")
        (folder / f"part {f}+1%.csv").write_text("\n".join(lines) + "\n", encoding="latin-1")


@pytest.mark.parametrize("broadcast", [True, False])
def test_row_ids_follow_file_order_over_many_blocks(spark, tmp_path, small_blocks, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(X, "MAX_BROADCAST_BLOCKS", 0)
    write_parts(tmp_path, [2000, 1, 900, 30, 0])
    export = X.read_export(spark, str(tmp_path))
    assert export.rdd.getNumPartitions() > 10
    raw = X.raw_table(export)
    assert raw.columns == ["n", "text", "source_file", "source_row_id"]
    found = raw.collect()
    assert len(found) == sum(1 for s in [2000, 1, 900, 30] for i in range(s) if i % 7 != 3)
    assert all(int(r.n) == r.source_row_id for r in found)
    assert {r.source_file for r in found} == {f"part {i}+1%.csv" for i in range(4)}


def test_rows_are_not_shuffled_for_their_ids(spark, tmp_path):
    write_parts(tmp_path, [50])
    plan = X.raw_table(X.read_export(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    joined = plan[plan.index("BroadcastHashJoin"):plan.index("BroadcastExchange")]
    assert "Exchange" not in joined and "Window" not in joined


def test_latin1_quotes_and_blank_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(
        ' Bus ,V1,,%V2/V1\nB\xfcrger,"1,5",q,NA\n,,,\n\n"",n/a,,\nC,2,,0.5\n'.encode("latin-1")
    )
    raw = X.raw_table(X.read_export(spark, str(tmp_path / "a.csv")))
    assert raw.columns[:4] == ["Bus", "V1", "Unnamed:_2", "PercentV2_V1"]
    assert [tuple(r) for r in raw.orderBy("source_row_id").collect()] == [
        ("B\xfcrger", "1,5", "q", None, "a.csv", 1),
        ("C", "2", None, "0.5", "a.csv", 2),
    ]


def test_copies_over_several_files_are_removed(spark, tmp_path):
    for part in "ab":
        (tmp_path / f"{part}.csv").write_text("Bus,V1\nX,1\nY,2\nX,1\n")
    raw = X.raw_table(X.read_export(spark, str(tmp_path)))
    assert len(raw.inputFiles()) == 2
    clean = silver.clean_export(raw, "seqvoltages")
    assert sorted(tuple(r) for r in clean.collect()) == [("X", 1.0, "a.csv", 1), ("Y", 2.0, "a.csv", 2)]
    single = X.raw_table(X.read_export(spark, str(tmp_path / "b.csv")))
    assert len(single.inputFiles()) == 1
    clean = silver.clean_export(single, "seqvoltages", one_file=True)
    assert sorted(tuple(r) for r in clean.collect()) == [("X", 1.0, "b.csv", 1), ("Y", 2.0, "b.csv", 2)]


def test_multiline_cells(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(b'Bus,V1\n"two\nlines",1\nx,2\n')
    raw = X.raw_table(X.read_export(spark, str(tmp_path / "m.csv"), multiline=True))
    assert [(r.Bus, r.source_row_id) for r in raw.orderBy("source_row_id").collect()] == [
        ("two\nlines", 1), ("x", 2),
    ]


def test_save_table_replaces_rows_and_schema(spark):
    create_layers(spark, {"layer_a": "it's a test"})
    save_table(spark.createDataFrame([(1, 2)], "a int, b int"), "layer_a.t")
    again = save_table(spark.createDataFrame([("x",)], "c string"), "layer_a.t")
    assert [tuple(r) for r in again.collect()] == [("x",)] and again.columns == ["c"]
    comment = spark.sql("DESCRIBE SCHEMA layer_a").collect()
    assert any("it's a test" in r.info_value for r in comment)


def test_tables_bucketed_alike_join_without_a_shuffle(spark):
    create_layers(spark, {"layer_b": "buckets"})
    left = save_table(spark.range(100).selectExpr("cast(id as string) k", "id a"), "layer_b.l", buckets=(4, "k"))
    right = save_table(spark.range(50).selectExpr("cast(id as string) k", "id b"), "layer_b.r", buckets=(4, "k"))
    joined = left.hint("merge").join(right, "k", "left")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 100


def test_quotes_and_line_breaks_inside_cells(spark, tmp_path):
    (tmp_path / "q.csv").write_bytes(b'Bus,V1,V2\n"say ""hi"", ok",1,2\n"two\nlines",3,4\n')
    found = [tuple(r) for r in X.read_export(spark, str(tmp_path / "q.csv"), multiline=True).collect()]
    assert found == [('say "hi", ok', "1", "2"), ("two\nlines", "3", "4")]


def test_short_rows_end_in_missing_cells(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes(b"Bus,V1,V2\nA,1\nB,2,3\n")
    found = [tuple(r) for r in X.read_export(spark, str(tmp_path / "s.csv")).collect()]
    assert found == [("A", "1", None), ("B", "2", "3")]


def test_long_rows_show_whatever_is_read(spark, tmp_path):
    (tmp_path / "long.csv").write_bytes(b"Bus,V1,V2\nA,1,2\nB,3,4,5\nC,6\n")
    export = X.read_export(spark, str(tmp_path))
    for read in (export.count, export.select("V1").collect, export.select("V2").distinct().count):
        with pytest.raises(Exception, match="more cells"):
            read()


def test_long_rows_are_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'Bus,V1,V2\nA,1,2\nB,3,4,5\n,,\nC,6\n"D,d",7,8,9,"x\xfc"\nE,1,1\n')
    (tmp_path / "b.csv").write_bytes(b"Bus,V1,V2\nF,1,2\n")
    (tmp_path / "c.csv").write_bytes(b"Bus,V1,V2\nG,1,2,\nH,1,2,3\n")
    good = X.raw_table(X.read_export(spark, str(tmp_path), bad_rows="set_aside"))
    assert sorted((r.Bus, r.V1) for r in good.collect()) == [("A", "1"), ("C", "6"), ("E", "1"), ("F", "1"), ("G", "1")]
    assert good.count() == 5 and good.select("V2").where("V2 = '4'").isEmpty()
    aside = X.set_aside_exports(spark, str(tmp_path.parent), {"voltages": tmp_path.name})
    assert sorted(map(tuple, aside.collect())) == [
        ("voltages", "a.csv", 2, "B,3,4,5"), ("voltages", "a.csv", 5, '"D,d",7,8,9,"x\xfc"'), ("voltages", "c.csv", 2, "H,1,2,3"),
    ]
    counted = audits.audit_malformed(aside)
    assert sorted(map(tuple, counted.collect())) == [("voltages", "a.csv", 2, 2), ("voltages", "c.csv", 1, 2)]
    with pytest.raises(ValueError, match="bad_rows"):
        X.read_export(spark, str(tmp_path), bad_rows="drop")


@pytest.mark.parametrize("files", [
    {"long.csv": b"Bus,V1,V2\nA,1,2\nB,3,4,5\n"},
    {"a.csv": b"Bus,V1,V2\nA,1,2\n", "b.csv": b"Bus,V2,V1\nB,3,4\n"},
])
def test_what_does_not_fit_the_header_is_an_error(spark, tmp_path, files):
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    with pytest.raises(Exception, match="more cells|header"):
        X.read_export(spark, str(tmp_path)).collect()
