from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from casaframe.operators import drift


def _frames(spark, ref: dict, cur: dict):
    return spark.createDataFrame(pd.DataFrame(ref)), spark.createDataFrame(pd.DataFrame(cur))


def _by_hand(ref, cur):
    """Histogram over the joint range, PSI and D, from sorted values and plain sums."""
    lo, hi = min(ref.min(), cur.min()), max(ref.max(), cur.max())
    inner = [lo + k * ((hi - lo) / 10) for k in range(1, 10)]
    h = [np.bincount(np.searchsorted(inner, x, side="right"), minlength=10) for x in (ref, cur)]
    p, q = ((x + 1e-4) / (x + 1e-4).sum() for x in h)
    grid = np.concatenate((ref, cur))
    d = max(abs((ref <= v).mean() - (cur <= v).mean()) for v in grid)
    return h, float(((q - p) * np.log(q / p)).sum()), d


@pytest.mark.parametrize("seed,n,m,shift", [(3, 240, 310, 0.0), (4, 150, 90, 0.6), (5, 333, 401, 4.0)])
def test_statistics_by_hand(spark, seed, n, m, shift):
    rng = np.random.default_rng(seed)
    ref = {"a.b": rng.gamma(3.0, 2.0, n), "side": rng.integers(0, 12, n).astype(float)}
    cur = {"a.b": rng.gamma(3.0, 2.0, m) + shift, "side": rng.integers(0, 12, m).astype(float)}
    r, c = _frames(spark, ref, cur)
    bins = {(b.column_name, b.bin): (b.reference_count, b.current_count)
            for b in drift.psi_bins(r, c).collect()}
    feats = {f.column_name: f for f in drift.drift_features(r, c).collect()}
    for name in ref:
        h, psi, d = _by_hand(ref[name], cur[name])
        assert [bins[(name, k)] for k in range(10)] == list(zip(*h))
        assert feats[name].psi == pytest.approx(psi, abs=2e-6)
        assert feats[name].ks_statistic == pytest.approx(d, abs=1e-6)
        assert feats[name].ks_pvalue == pytest.approx(drift.ks_exact_pvalue(n, m, d), abs=1e-6)
        assert feats[name].drifted == (psi > 0.25 or drift.ks_exact_pvalue(n, m, d) < 0.05)
    assert drift.drift_report(drift.drift_features(r, c)).first().dataset_drift == any(
        f.drifted for f in feats.values())


def _largest_gap(ref, cur):
    ref, cur = np.sort(ref), np.sort(cur)
    grid = np.concatenate((ref, cur))
    return np.abs(np.searchsorted(ref, grid, "right") / len(ref)
                  - np.searchsorted(cur, grid, "right") / len(cur)).max()


def test_ks_is_exact_whatever_the_bins_hold(spark):
    rng = np.random.default_rng(12)
    n, m = 4000, 3000
    ref = {"smooth": rng.normal(size=n), "far": np.append(rng.normal(size=n - 1), 1e300),
           "hot": np.where(rng.random(n) < 0.4, 2.0, rng.normal(size=n)),
           "narrow": 1.0 + rng.integers(0, 9, n) * 2.0 ** -52, "same": np.full(n, 7.0),
           "wide": rng.choice([-1.0, 1.0], n) * 10.0 ** rng.uniform(-300, 307, n)}
    cur = {"smooth": rng.normal(0.02, 1, m), "far": np.append(rng.normal(size=m - 1), -1e300),
           "hot": np.where(rng.random(m) < 0.3, 2.0, rng.normal(size=m)),
           "narrow": 1.0 + rng.integers(0, 8, m) * 2.0 ** -52, "same": np.full(m, 7.0),
           "wide": rng.choice([-1.0, 1.0], m) * 10.0 ** rng.uniform(-290, 307, m)}
    r, c = _frames(spark, ref, cur)
    got = {row.column_name: row.ks_statistic for row in
           drift.ks_statistic(r.repartition(3), c.repartition(4)).collect()}
    want = {k: _largest_gap(ref[k], cur[k]) for k in ref}
    assert got == pytest.approx(want, abs=1e-12)
    feats = {f.column_name: f.ks_statistic for f in drift.drift_features(r, c, method="asymp").collect()}
    assert feats == pytest.approx(want, abs=6e-7)


def _traced(spark, ref, cur):
    r, c = _frames(spark, ref, cur)
    both = drift.pooled(r, c, list(ref))
    stats = drift.side_stats(both, list(ref), bulk=True)
    trace = []
    got = drift.ks_from_histogram(both, stats, drift.histogram(both, stats), trace=trace)
    return got, trace, both.rdd.getNumPartitions()


def test_ks_counts_shifted_columns_and_reads_few_values(spark):
    # a shifted column: the middle decides, bins at both ends are counted once only
    rng = np.random.default_rng(13)
    ref, cur = {"x": rng.normal(size=30000)}, {"x": rng.normal(0.5, 1, 30000)}
    got, trace, _ = _traced(spark, ref, cur)
    assert got["x"] == pytest.approx(_largest_gap(ref["x"], cur["x"]), abs=1e-12)
    assert trace[0]["values"] < 6000 and trace[-1]["finish"]


def test_ks_of_equal_samples_moves_under_a_hundredth(spark):
    """Columns that do not differ leave most first bins open; they are split, not ordered."""
    rng = np.random.default_rng(14)
    n = 200_000
    ref = {"a": rng.normal(size=n), "b": rng.exponential(size=n)}
    cur = {"a": rng.normal(size=n), "b": rng.exponential(size=n)}
    got, trace, tasks = _traced(spark, ref, cur)
    assert got == pytest.approx({k: _largest_gap(ref[k], cur[k]) for k in ref}, abs=1e-12)
    assert trace[0]["values"] > n                       # what the first pass leaves open
    values = [t["values"] for t in trace]
    assert values == sorted(values, reverse=True) and trace[-1]["finish"]
    # a pass moves at most a row per task and part, the last one the values that are left
    moved = sum(tasks * min(drift.KS_CELLS, t["values"]) for t in trace[:-1]) + values[-1]
    rows = 4 * n
    assert values[-1] <= drift.KS_FINISH and values[-1] < 0.01 * rows
    assert moved < 0.4 * rows and len(trace) <= 6      # the bound on counts falls with rows per task


@pytest.mark.parametrize(("cells", "finish"), [(8, 20), (256, 1)])
def test_ks_splits_to_the_end_at_any_setting(spark, monkeypatch, cells, finish):
    monkeypatch.setattr(drift, "KS_CELLS", cells)
    monkeypatch.setattr(drift, "KS_FINISH", finish)
    monkeypatch.setattr(drift, "KS_BINS", 16)
    rng = np.random.default_rng(15)
    n = 600
    ref = {"steep": 10.0 ** rng.uniform(-300, 300, n), "narrow": 1.0 + rng.integers(0, 9, n) * 2.0 ** -52,
           "plain": rng.normal(size=n), "ends": rng.choice([-1.7e308, 1.7e308, 0.0], n)}
    cur = {"steep": 10.0 ** rng.uniform(-300, 300, n), "narrow": 1.0 + rng.integers(0, 9, n) * 2.0 ** -52,
           "plain": rng.normal(size=n), "ends": rng.choice([-1.7e308, 1.7e308, 1.0], n)}
    got, _, _ = _traced(spark, ref, cur)
    assert got == pytest.approx({k: _largest_gap(ref[k], cur[k]) for k in ref}, abs=1e-12)


def test_ks_without_values_on_a_side(spark):
    sch = "x double, y double"
    r = spark.createDataFrame([(1.0, None), (2.0, None)], sch)
    c = spark.createDataFrame([(None, None), (None, None)], sch)
    rows = drift.ks_statistic(r, c).collect()
    assert [(x.column_name, x.n_reference, x.n_current, x.ks_statistic) for x in rows] == [
        ("x", 2, 0, None)]


def test_finite_law():
    # one value: D_1 = max(u, 1 - u), so P(D_1 >= d) = 2 (1 - d) from one half on
    for d in (0.55, 0.7, 0.95):
        assert drift.one_sample_sf(1, d) == pytest.approx(2 * (1 - d), abs=1e-12)
    # the smallest gap is 1 / (2 n); just above it P(D_n < d) = n! (2 d - 1 / n)^n
    for n, d in ((3, 0.2), (6, 0.1)):
        want = 1 - math.factorial(n) * (2 * d - 1 / n) ** n
        assert drift.one_sample_sf(n, d) == pytest.approx(want, abs=1e-12)
    assert drift.one_sample_sf(5, 0.58) == pytest.approx(0.039816, abs=1e-6)


def test_large_sides_use_the_finite_law(spark):
    """20001 against 5 values: the limit law would say 0.069 and miss the shift."""
    df = spark.createDataFrame([(20001, 5, 0.58), (9_000_000, 9_000_000, 0.0007), (30_000, 30_000, None)],
                               "a bigint, b bigint, d double")
    got = [r.p for r in df.select(drift.ks_pvalue(F.col("a"), F.col("b"), F.col("d")).alias("p")).collect()]
    assert got[0] == pytest.approx(0.039816, abs=1e-6) and 0.0 < got[1] < 0.05 and got[2] is None
    # both branches meet where they change over
    n = drift.FINITE_MAX_N
    for d in (0.015, 0.02, 0.03):
        exact = drift.one_sample_sf(n + 1, d)
        near = spark.range(1).select(drift.ks_asymptotic_pvalue(
            F.lit(d), F.lit(2 * n + 2), F.lit(2 * n + 2))).first()[0]
        assert near == pytest.approx(exact, abs=2e-5)


def test_exact_method_never_gives_null(spark):
    df = spark.createDataFrame([(10_500, 40, 0.2)], "a bigint, b bigint, d double")
    p = df.select(drift.ks_pvalue(F.col("a"), F.col("b"), F.col("d"), "exact")).first()[0]
    assert p == pytest.approx(drift.ks_exact_pvalue(10_500, 40, 0.2)) and p > 0


def test_infinite_values_are_named(spark):
    r, c = _frames(spark, {"v": [1.0, 2.0, 3.0]}, {"v": [1.0, float("inf"), 2.0]})
    with pytest.raises(ValueError, match="v"):
        drift.drift_features(r, c).collect()


def test_constant_column_last_bin(spark):
    r, c = _frames(spark, {"v": [5.0] * 3}, {"v": [5.0] * 2})
    bins = sorted((b.bin, b.reference_count, b.current_count)
                  for b in drift.psi_bins(r, c).collect())
    assert bins[-1] == (9, 3, 2) and all(b[1] == 0 and b[2] == 0 for b in bins[:-1])
    assert drift.psi(r, c).first().psi == pytest.approx(6.0766617e-05, abs=1e-12)
    assert drift.drift_features(r, c).first().psi == 6.1e-05  # reported rounded to 6 places


def test_too_few_values_and_non_numeric(spark):
    r = spark.createDataFrame([(1.0, "a", True), (None, "b", False)], "v double, s string, b boolean")
    c = spark.createDataFrame([(1.0, "a", True), (2.0, "b", True)], "v double, s string, b boolean")
    assert drift.numeric_columns(r, c) == ["v"]
    f = drift.drift_features(r, c).first()
    assert (f.psi, f.ks_pvalue, f.drifted) == (0.0, 1.0, False)


def test_exact_pvalue_equal_sizes_closed_form():
    # n1 = n2: P(D >= k/n) has a closed form sum; compare for n = 20, k = 6
    from math import comb
    n, k = 20, 6
    closed = 2 * sum((-1) ** (j - 1) * comb(2 * n, n - j * k) for j in range(1, n // k + 1)) / comb(2 * n, n)
    assert drift.ks_exact_pvalue(n, n, k / n) == pytest.approx(closed, abs=1e-12)


def test_save_report(spark, tmp_path):
    found = drift.DriftReport(True, 0.5, {"q": 0.4, "r": 0.0}, {"q": 0.001, "r": 0.7},
                              {"q": True, "r": False})
    out = str(tmp_path / "reports")
    name = drift.save_drift_report(found, out, spark).rsplit("/", 1)[-1]
    rows = [json.loads(x.value) for x in spark.read.text(out).collect()]
    assert len(rows) == 1 and rows[0]["report_name"] == name
    assert {k: rows[0][k] for k in vars(found)} == vars(found)


def _all_points_pvalue(n1, n2, d):
    """The lattice walk over every point of every anti-diagonal, in fractions."""
    from fractions import Fraction

    prev = {0: Fraction(1)}
    for s in range(1, n1 + n2 + 1):
        prev = {i: (prev.get(i - 1, 0) * i + prev.get(i, 0) * (s - i)) / Fraction(s)
                for i in range(max(0, s - n2), min(n1, s) + 1)
                if abs(Fraction(i, n1) - Fraction(s - i, n2)) < d}
    return float(1 - prev.get(n1, 0))


def test_banded_walk_equals_the_full_one():
    from fractions import Fraction
    from math import lcm

    for n1, n2 in ((1, 1), (1, 7), (5, 5), (9, 4), (12, 30), (31, 17)):
        whole = lcm(n1, n2)
        for h in {1, 2, whole // 5, whole // 3, whole // 2, whole - 1, whole} - {0}:
            want = _all_points_pvalue(n1, n2, Fraction(h, whole))
            for p in (drift.ks_exact_pvalue(n1, n2, h / whole), drift.ks_exact_pvalue(n2, n1, h / whole)):
                assert p == pytest.approx(want, abs=1e-12), (n1, n2, h)


def test_exact_walk_over_large_samples_keeps_to_the_band(spark):
    import time

    start = time.time()
    got = drift.ks_exact_pvalue(300_000, 20_000, 0.01)
    assert time.time() - start < 30  # all points of all diagonals: minutes
    near = spark.range(1).select(drift.ks_asymptotic_pvalue(F.lit(0.01), F.lit(300_000), F.lit(20_000))).first()[0]
    assert got == pytest.approx(near, rel=0.02)
    assert drift.ks_exact_pvalue(900_000, 60_000, 0.2) == 0.0
    assert drift.ks_exact_pvalue(900_000, 60_000, 0.0002) == 1.0


def test_ks_narrowing_reads_only_features_still_open(spark, monkeypatch):
    # few distinct values are settled by the histogram; the smooth column takes several passes
    rng = np.random.default_rng(15)
    n = 60_000
    ref = {"few": rng.integers(0, 9, n).astype(float), "smooth": rng.normal(size=n)}
    cur = {"few": rng.integers(0, 9, n).astype(float), "smooth": rng.normal(size=n)}
    r, c = _frames(spark, ref, cur)
    asked, whole = [], drift.pooled
    monkeypatch.setattr(drift, "pooled", lambda a, b, names: asked.append(list(names)) or whole(a, b, names))
    want = {k: _largest_gap(ref[k], cur[k]) for k in ref}
    for keep in (drift.KS_KEEP, 0):  # open values kept, or read again by every pass
        asked.clear()
        monkeypatch.setattr(drift, "KS_KEEP", keep)
        got = {x.column_name: x.ks_statistic for x in drift.ks_statistic(r, c).collect()}
        assert got == pytest.approx(want, abs=1e-12)
        assert asked == [["few", "smooth"], ["smooth"]]
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == 0
