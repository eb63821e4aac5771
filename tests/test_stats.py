"""Outliers, duplicates and exact order statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from casaframe.operators import order_stats
from casaframe.operators.duplicates import duplicate_report, mark_duplicates
from casaframe.operators.outliers import outlier_report, outlier_rows, outlier_total


def _one(spark, values, name="x"):
    return spark.createDataFrame([(float(v),) if v is not None else (None,) for v in values],
                                 f"{name} double")


@pytest.mark.parametrize("values", [[7.0, 7.4, 7.1, 7.3, 31.0], [-4, -5, -3, -60],
                                    [0.21, 0.2, 0.22, 0.19, 0.23, 4.5]])
def test_small_samples_use_modified_z(spark, values):
    r = outlier_report(_one(spark, values), ["x"]).first()
    assert r.zscore_outliers == 1 and r.iqr_outliers == 1


def test_zero_iqr_and_zero_mad_give_zero(spark):
    r = outlier_report(_one(spark, [6.25] * 5), ["x"]).first()
    assert (r.zscore_outliers, r.iqr_outliers) == (0, 0)


def test_zscore_matches_numpy(spark):
    rng = np.random.RandomState(7)
    vals = np.concatenate([rng.normal(0, 1, 2000), [9.0, -8.5, 12.0]])
    z = np.abs((vals - vals.mean()) / vals.std(ddof=0))
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    iqr = q3 - q1
    expect_iqr = int(((vals < q1 - 1.5 * iqr) | (vals > q3 + 1.5 * iqr)).sum())
    df = spark.createDataFrame(pd.DataFrame({"x": vals})).repartition(5)
    r = outlier_report(df, ["x", "missing_col"]).collect()
    assert len(r) == 1
    assert r[0].zscore_outliers == int((z > 3).sum())
    assert r[0].iqr_outliers == expect_iqr
    assert outlier_total(outlier_report(df, ["x"])) == max(r[0].zscore_outliers, expect_iqr)


def test_text_and_nan_are_missing(spark):
    df = spark.createDataFrame([("1",), ("2",), ("abc",), ("NaN",), (None,), ("1e3",)], "x string")
    st = outlier_report(df, ["x"]).first()
    assert st.column_name == "x"  # numeric view of text: 1, 2, 1000
    num = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,)], "x double")
    assert outlier_report(num, ["x"]).first().zscore_outliers == 0


def test_outlier_rows_flags(spark):
    vals = [7.0, 7.4, 7.1, 7.3, 31.0]
    flags = {r.x: (r.x_zscore_outlier, r.x_iqr_outlier)
             for r in outlier_rows(_one(spark, vals), ["x"]).collect()}
    assert flags[31.0] == (True, True) and flags[7.0] == (False, False)


def test_duplicates_report(valid_frame):
    dup = valid_frame.unionByName(valid_frame.limit(1))
    r = duplicate_report(dup).first()
    assert (r.total_rows, r.duplicate_rows, r.duplicate_pct) == (5, 1, 20.0)
    r0 = duplicate_report(valid_frame).first()
    assert (r0.duplicate_rows, r0.duplicate_pct) == (0, 0.0)


def test_duplicates_missing_equals_missing(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, None, float("nan")), (3, "a", -0.0),
                                (4, "a", 0.0)], "k int, s string, d double")
    assert duplicate_report(df, ["s", "d"]).first().duplicate_rows == 2
    marks = {r.k: r.is_duplicate for r in mark_duplicates(df, "k").collect()}
    assert marks == {1: False, 2: True, 3: False, 4: True}


def test_empty_duplicate_report(spark):
    r = duplicate_report(spark.createDataFrame([], "a int")).first()
    assert (r.total_rows, r.duplicate_rows, r.duplicate_pct) == (0, 0, 0.0)


@pytest.mark.parametrize("parts", [1, 8])
def test_exact_quantiles_match_numpy(spark, parts):
    rng = np.random.RandomState(3)
    a = rng.randint(0, 50, 3001).astype(float)       # many ties
    b = rng.normal(10, 3, 1234)
    pdf = pd.concat([pd.DataFrame({"feature": "a", "value": a}),
                     pd.DataFrame({"feature": "b", "value": b})])
    long = spark.createDataFrame(pdf).repartition(parts)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0, 0.333]
    got = order_stats.exact_quantiles(long, probs, collect_rows=20 * parts)
    for name, arr in (("a", a), ("b", b)):
        assert np.allclose(got[name], np.quantile(arr, probs), rtol=0, atol=1e-9)


def test_cumulative_counts_across_partitions(spark):
    pdf = pd.DataFrame({"feature": ["f"] * 100, "value": np.arange(100.0), "n": 1})
    cum = order_stats.cumulative_counts(spark.createDataFrame(pdf), ["n"], num_partitions=7)
    got = sorted((r.value, r.cum_n, r.total_n) for r in cum.collect())
    assert got == [(float(i), i + 1, 100) for i in range(100)]


def test_partition_invariance(spark):
    from casaframe.operators import drift

    rng = np.random.RandomState(11)
    a = spark.createDataFrame(pd.DataFrame({"x": rng.normal(0, 1, 3000).round(2)}))
    b = spark.createDataFrame(pd.DataFrame({"x": rng.normal(0.1, 1, 2500).round(2)}))
    one = drift.drift_features(a.coalesce(1), b.coalesce(1)).first()
    many = drift.drift_features(a.repartition(8), b.repartition(8)).first()
    assert one == many
    d1 = duplicate_report(a.coalesce(1)).first()
    d8 = duplicate_report(a.repartition(8)).first()
    assert d1 == d8


def test_quantiles_of_very_uneven_values(spark):
    # values of all sizes, a few repeated, one gap so small that only counting settles it
    vals = np.concatenate([2.0 ** np.arange(-1000, 1000, 1.7), -(3.0 ** np.arange(0, 500, 1.3)),
                           np.zeros(400), [np.nextafter(1.0, 2.0)] * 3])
    rows = [("a.b", float(v)) for v in vals] + [("one", 4.5), ("none", None)]
    long = spark.createDataFrame(rows, "feature string, value double").repartition(5)
    order = np.sort(vals)
    ranks = {0, 1, 399, 400, 500, 801, 802, len(vals) - 1}
    got = order_stats.ranked_values(long, {"a.b": ranks}, {"a.b": len(vals)}, collect_rows=3)
    assert {k: got[("a.b", k)] for k in ranks} == {k: order[k] for k in ranks}
    q = order_stats.exact_quantiles(long, [0.5])
    assert q["one"] == [4.5] and q["none"] == [None]


def test_hot_value_third_of_rows(spark):
    # one value holds a third of all rows: quantiles stay exact and spread over partitions
    rng = np.random.RandomState(9)
    vals = np.concatenate([np.full(3000, 42.0), rng.normal(0, 50, 6000).round(1)])
    long = spark.createDataFrame(pd.DataFrame({"feature": "x", "value": vals})).repartition(8)
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = order_stats.exact_quantiles(long, probs, collect_rows=10)["x"]
    assert np.allclose(got, np.quantile(vals, probs), atol=1e-9)


def test_hot_duplicate_group(spark):
    # a third of the rows are the same record
    rows = [(i, "same", 1) for i in range(300)] + [(300 + i, f"t{i}", i) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, text string, n int").repartition(8)
    assert duplicate_report(df, ["text", "n"]).first().duplicate_rows == 299
    marks = mark_duplicates(df, "k", ["text", "n"])
    assert marks.where("is_duplicate").count() == 299
    assert marks.where("NOT is_duplicate AND text = 'same'").first().k == 0


def test_approx_mode_runs_and_agrees_on_z(spark):
    rng = np.random.RandomState(4)
    vals = np.concatenate([rng.normal(0, 1, 3000), [10.0, -9.0]])
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    exact = outlier_report(df, ["x"]).first()
    approx = outlier_report(df, ["x"], approx=True).first()
    assert approx.zscore_outliers == exact.zscore_outliers
    assert abs(approx.iqr_outliers - exact.iqr_outliers) <= 3
    small = outlier_report(_one(spark, [1000, 1100, 1050, 5000]), ["x"], approx=True).first()
    assert small.zscore_outliers == 1


def test_columns_without_numbers_report_zero(spark):
    df = spark.createDataFrame([(None, "a", 1.0), (None, "b", 2.0)], "e double, t string, x double")
    rows = {r.column_name: (r.zscore_outliers, r.iqr_outliers) for r in
            outlier_report(df, ["e", "t", "x"]).collect()}
    assert rows == {"e": (0, 0), "t": (0, 0), "x": (0, 0)}


def test_quantiles_with_adaptive_range_partitions(spark):
    # no explicit partition count: AQE may merge neighbouring ranges
    rng = np.random.RandomState(21)
    pdf = pd.concat([pd.DataFrame({"feature": f, "value": rng.gamma(2.0, 3.0, 4000).round(3)})
                     for f in ("p", "q", "r")])
    long = spark.createDataFrame(pdf).repartition(6)
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = order_stats.exact_quantiles(long, probs)
    for f in ("p", "q", "r"):
        assert np.allclose(got[f], np.quantile(pdf[pdf.feature == f].value, probs), atol=1e-9)


def test_hash_collisions_are_resolved_exactly(spark):
    # the row hash skips NULLs, so these two different rows share a hash
    df = spark.createDataFrame([(1, None, "a"), (2, "a", None), (3, "b", "b"), (4, "b", "b")],
                               "k int, x string, y string")
    assert duplicate_report(df, ["x", "y"]).first().duplicate_rows == 1
    marks = {r.k: r.is_duplicate for r in mark_duplicates(df, "k").collect()}
    assert marks == {1: False, 2: False, 3: False, 4: True}


def test_nested_columns_use_exact_grouping(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [1, 2]), (3, [2])], "k int, a array<int>")
    assert duplicate_report(df, ["a"]).first().duplicate_rows == 1
    assert mark_duplicates(df, "k").where("is_duplicate").first().k == 2


def test_hot_record_without_broadcast(spark):
    """A third of the rows are one record; with broadcasts off the salted join deals it out."""
    rows = [(k, "hot", 1.5) if k % 3 == 0 else (k, f"r{k % 500}", float(k % 500)) for k in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, s string, d double").repartition(6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        want = len(rows) - len({r[1:] for r in rows})
        assert duplicate_report(df.drop("k")).first().duplicate_rows == want
        marks = {r.k: r.is_duplicate for r in mark_duplicates(df, "k").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    seen, expect = set(), {}
    for k, *rest in rows:
        expect[k] = tuple(rest) in seen
        seen.add(tuple(rest))
    assert marks == expect


def test_marks_need_a_unique_key(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, s string")
    with pytest.raises(ValueError, match="unique"):
        mark_duplicates(df, "k")


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 50)], "`a.b` double")
    assert outlier_report(df, ["a.b"]).first().outliers == 1
    assert outlier_report(df, ["a.b"], approx=True).first().column_name == "a.b"
    assert outlier_rows(df, ["a.b"]).where("`a.b_iqr_outlier`").count() == 1


def test_marks_in_file_order_need_no_key(spark, tmp_path):
    from casaframe.operators.duplicates import mark_duplicates_in_order
    path = str(tmp_path / "t")
    rows = [("a", 1.0), ("b", None), ("a", 1.0), ("b", None), ("c", 2.0), ("a", 1.0)] * 40
    spark.createDataFrame(rows, "`s.x` string, d double").coalesce(1).write.option(
        "maxRecordsPerFile", 50).parquet(path)
    for _ in range(2):
        table = spark.read.parquet(path)
        got = mark_duplicates_in_order(table).collect()
        assert sum(r["is_duplicate"] for r in got) == len(rows) - 3
    files = table.select("*", "_metadata.file_path", "_metadata.row_index")
    marked = mark_duplicates_in_order(files, ["s.x", "d"]).where("NOT is_duplicate").collect()
    first = min(r["file_path"] for r in files.collect())
    assert sorted((r["s.x"], r["file_path"] == first, r["row_index"]) for r in marked) == [
        ("a", True, 0), ("b", True, 1), ("c", True, 4)]
