"""The string kernel, the Nyström map and the regression against their plain forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feederlens.llm import langid

TEXTS = [
    ("en", "the ferry runs to the other side"), ("en", "they went over the old bridge"), ("en", "the river was high"),
    ("de", "die Fähre fährt auf die andere Seite"), ("de", "sie gingen über die alte Brücke"), ("de", "der Fluss war hoch"),
    ("fr", "le bac va de l'autre côté"), ("fr", "ils passèrent le vieux pont"), ("fr", "la rivière était haute"),
]


def grams(text):
    plain = f" {' '.join(text.lower().split())} "
    return {plain[i : i + n] for n in langid.ORDERS for i in range(len(plain) - n + 1)}


def test_kernel_counts_common_grams():
    rows = langid.presence([t for _, t in TEXTS])
    sets = [grams(t) for _, t in TEXTS]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            # Two of some hundred n-grams may share a bucket.
            assert abs(rows[i] @ rows[j] - len(a & b)) <= 2
    assert langid.presence(["one  two\n"])[0].tolist() == langid.presence(["One two"])[0].tolist()


@pytest.mark.parametrize("marks", [range(9), (0, 3, 6), (0, 1, 4, 8)])
def test_fit_is_kernel_ridge_in_the_landmarks_space(marks):
    """The folded matrix against the dual regression with the Nyström kernel, worked out in full."""
    rows = langid.presence([t for _, t in TEXTS])
    labels = [x for x, _ in TEXTS]
    langs, matrix, constants = langid.fit(rows, labels, np.array(marks))
    unit = (rows / np.sqrt(rows.sum(1, keepdims=True))).astype(np.float64)
    kernel = unit @ unit.T
    to_marks, of_marks = kernel[:, list(marks)], kernel[np.ix_(list(marks), list(marks))]
    approximate = to_marks @ np.linalg.pinv(of_marks, rcond=1e-6, hermitian=True) @ to_marks.T + 1
    targets = np.where(np.array(labels)[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    # Three rows a language, so every row weighs a third; the ridge is scaled by the mean weight.
    dual = approximate @ np.linalg.solve(approximate + langid.RIDGE * np.eye(9), targets)
    found = (rows @ matrix) / np.sqrt(rows.sum(1, keepdims=True)) + constants
    assert langs == ["de", "en", "fr"]
    assert found == pytest.approx(dual, abs=2e-4)


def test_long_and_repeated_rows_and_clashing_columns(spark):
    long = TEXTS[3][1] + ". "
    data = [(i, t, x, "x", 0.5) for i, (x, t) in enumerate(TEXTS * 8)]
    data += [(1000, long * 5000, None, "y", None)] * 2 + [(1001, None, "en", None, None), (None, TEXTS[0][1], "en", "z", 1.0), (1002, "12 34", "fr", "z", 1.0)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, lang_pred string, score double")
    found = langid.identify(df).collect()
    assert len(found) == len(data)
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert by_id[1000][0] == "de" and by_id[1001] == by_id[1002] == ("und", 0.0)
    assert len({(r.lang_pred, r.score) for r in found if r.doc_id == 1000}) == 1
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_learnt_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    rare = [(500 + i, f"seldom {i}", f"l{i}") for i in range(50)]
    data = [(i, t, x) for i, (x, t) in enumerate([r for r in TEXTS * 20 if r[0] != "fr"])] + rare
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(df).select("lang_pred").distinct().collect()} <= {"en", "de", "und"}
    names, _, _ = langid.train(df.withColumn("x", F.lit(1)))
    assert names == ["de", "en"]
