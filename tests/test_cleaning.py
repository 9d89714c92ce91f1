import pytest

from feederlens.operators import cleaning as C


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1,) * 6], [" Bus ", "Base kV", "%I2/I1", "P1(kW)", "_c4", "p.u."])
    assert C.normalize_columns(df).columns == [
        "Bus", "Base_kV", "PercentI2_I1", "P1kW", "Unnamed:_4", "p.u.",
    ]


def test_blank_header_cell():
    assert C.normalize_name("  ", 2) == "Unnamed:_2"


def test_colliding_names_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], ["P1(kW)", "P1kW"])
    with pytest.raises(ValueError, match="p1kw"):
        C.normalize_columns(df)


def test_null_tokens_match_whole_cells(spark, rows):
    df = spark.createDataFrame(
        [("NA", 1), ("n/a", 2), (" NA", 3), ("", 4), ("Nah", 5), (None, 6)], ["p.u.", "id"]
    )
    assert rows(C.null_tokens(df)) == [
        (None, 1), (None, 2), (None, 4), (None, 6), (" NA", 3), ("Nah", 5),
    ]


def test_drop_all_null_keeps_partly_filled_rows(spark, rows):
    df = spark.createDataFrame([(None, None), ("a", None), (None, 1)], "x string, y int")
    assert rows(C.drop_all_null(df)) == [(None, 1), ("a", None)]


def test_trim_keys_removes_all_whitespace(spark):
    df = spark.createDataFrame([("\t B1 \n\xa0",), (None,)], "Bus string")
    assert [r.Bus for r in C.trim_keys(df, ["Bus"]).collect()] == ["B1", None]


def test_coerce_skips_absent_columns_and_takes_dots(spark):
    df = spark.createDataFrame([("1.5", "x")], ["p.u.", "Bus"])
    cast = C.coerce_numeric(df, ["p.u.", "V9"])
    assert cast.columns == ["p.u.", "Bus"]
    assert tuple(cast.first()) == (1.5, "x")


@pytest.fixture
def copies(spark):
    return spark.createDataFrame(
        [("a", 1.0, "f1", 3), ("a", 1.0, "f1", 2), ("a", None, "f1", 1),
         ("a", None, "f1", 9), ("b", 1.0, "f2", 1), ("a", 1.0, "f0", 7)],
        "Bus string, V1 double, source_file string, source_row_id bigint",
    )


def test_dedupe_keeps_the_first_row_in_file_order(copies, rows):
    assert rows(C.dedupe(copies)) == [
        ("a", None, "f1", 1), ("a", 1.0, "f0", 7), ("b", 1.0, "f2", 1),
    ]


def test_dedupe_within_one_file_needs_no_sort(copies, rows):
    within = C.dedupe(copies, one_file=True)
    assert rows(within) == [
        ("a", None, "f1", 1), ("a", 1.0, "f0", 7), ("a", 1.0, "f1", 2), ("b", 1.0, "f2", 1),
    ]
    plan = within._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    one = copies.filter("source_file = 'f1'")
    assert rows(C.dedupe(one, one_file=True)) == rows(C.dedupe(one))


def test_dedupe_with_row_id_only(copies, rows):
    assert rows(C.dedupe(copies.drop("source_file"))) == [("a", None, 1), ("a", 1.0, 2), ("b", 1.0, 1)]


def test_dedupe_without_lineage(copies, rows):
    bare = copies.drop("source_file", "source_row_id")
    assert rows(C.dedupe(bare)) == [("a", None), ("a", 1.0), ("b", 1.0)]


def test_dedupe_including_lineage_removes_nothing(copies):
    assert C.dedupe(copies, include_lineage=True).count() == copies.count()


def test_dedupe_collapses_copies_before_the_shuffle(copies):
    plan = C.dedupe(copies)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")


def test_require_key(spark, rows):
    df = spark.createDataFrame([("a",), ("",), (None,)], "Bus string")
    assert rows(C.require_key(df, "Bus")) == [("a",)]
    assert rows(C.require_key(df, "Bus", null_key="keep_literal")) == [("a",), ("nan",)]
    with pytest.raises(ValueError):
        C.require_key(df, "Bus", null_key="keep")


def test_drop_unnamed(spark):
    df = spark.createDataFrame([(1, 2)], ["Unnamed:_2", "V1"])
    assert C.drop_unnamed(df).columns == ["V1"]
    assert C.drop_unnamed(df.select("V1")).columns == ["V1"]


def test_limit_flags_need_one_of_two(spark):
    df = spark.createDataFrame(
        [(1.0, None, None, None), (None, 2.0, None, 3.0), (None, None, None, None)],
        "P_Normal double, Q_Normal double, P_Emergency double, Q_Emergency double",
    )
    flags = C.with_limit_flags(df).select("has_normal_limit", "has_emergency_limit").collect()
    assert [tuple(f) for f in flags] == [(True, False), (True, True), (False, False)]


def test_resolve_takes_the_first_candidate_present(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Base_kV", "p.u.", "PercentI2_I1"])
    assert C.resolve(df, ["BasekV", "Base kV"]) == "Base_kV"
    assert C.resolve(df, ["p.u.", "pu"]) == "p.u."
    assert C.resolve(df, ["%I2/I1", "PercentI2_I1"]) == "PercentI2_I1"
    with pytest.raises(KeyError, match="Base_kV"):
        C.resolve(df, ["Magnitude1"])


def test_resolve_refuses_what_could_be_two_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["V_1", "V1", "Bus"])
    with pytest.raises(KeyError, match="one of .*V_1.*missing"):
        C.resolve_all(df, {"v1": ["V1"], "bus": ["bus"], "v2": ["V2"]})
    assert C.resolve_all(df, {"bus": ["BUS "]}) == {"bus": "Bus"}
