"""The stored reference profile: merging, stated errors, brackets that hold the exact scores."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from casaframe.operators import drift
from casaframe.operators import reference_profile as rp

COLS = ["normal", "wide", "whole", "constant"]


def frame(spark, seed: int, n: int, shift: float = 0.0):
    g = np.random.default_rng(seed)
    rows = [(float(a) if i % 11 else None, float(b), int(c), 7.5, f"p{i % 5}" if i % 13 else None)
            for i, (a, b, c) in enumerate(zip(g.normal(shift, 3, n), np.exp(g.normal(0, 9, n)) * g.choice([-1, 1], n),
                                              g.integers(-4, 90, n)))]
    return spark.createDataFrame(rows, "normal double, wide double, whole int, constant double, part string")


def counts(profile):
    return {(r["column_name"], r["cell"]): (r["n"], r["n_missing"], r["lo"], r["hi"])
            for r in profile.drop("sketch", "part").collect()}


def test_merged_parts_equal_the_whole(spark):
    df = frame(spark, 1, 6000)
    parts = rp.profile_of(df, COLS, part=F.col("part"))
    assert parts.select("part").distinct().count() == 6  # five names and NULL
    whole = counts(rp.profile_of(df, COLS))
    assert counts(rp.merge(parts)) == whole
    assert counts(rp.merge(rp.merge(parts))) == whole
    assert whole["normal", None][1] == 546 and whole["constant", None][0] == 6000


def test_cells_never_fall_and_hold_one_small_whole_number(spark):
    g = np.random.default_rng(3)
    values = sorted({float(v) for v in np.concatenate([
        -np.exp(g.normal(0, 150, 2000)), np.exp(g.normal(0, 150, 2000)), np.arange(-2048.0, 2049.0),
        [0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf")]])})
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", rp.cell_of(F.col("v")).alias("cell")).collect()
    cells = {r["v"]: r["cell"] for r in rows}
    order = [cells[v] for v in values]
    assert order == sorted(order)
    small = [cells[float(k)] for k in range(-2048, 2049)]
    assert len(set(small)) == len(small)
    assert cells[5e-324] > 0 > cells[-5e-324] and cells[0.0] == 0


def test_brackets_hold_the_exact_scores_and_flags(spark):
    ref, cur = frame(spark, 1, 6000), frame(spark, 2, 3000, 0.06)
    got = {r["column_name"]: r for r in rp.drift_of(rp.profile_of(ref, COLS), cur, COLS).collect()}
    exact = {r["column_name"]: r for r in drift.drift_features(ref, cur, COLS).collect()}
    assert set(got) == set(exact) == set(COLS)
    for c in COLS:
        a, b = got[c], exact[c]
        assert (a["n_reference"], a["n_current"]) == (b["n_reference"], b["n_current"])
        assert a["psi_low"] - 1e-6 <= b["psi"] <= a["psi_high"] + 1e-6
        assert a["ks_low"] - 1e-6 <= b["ks_statistic"] <= a["ks_high"] + 1e-6
        assert a["pvalue_low"] - 1e-6 <= b["ks_pvalue"] <= a["pvalue_high"] + 1e-6
        assert a["ks_high"] - a["ks_low"] < 0.05
        assert a["drifted"] in (None, b["drifted"])
    for c in ("whole", "constant"):  # one value a cell: no doubt is left
        assert got[c]["psi_high"] - got[c]["psi_low"] < 1e-9
        assert got[c]["ks_high"] - got[c]["ks_low"] < 1e-9


def test_what_the_brackets_leave_open_is_settled_by_the_exact_test(spark):
    # values so near to each other that a cell holds many of them
    near = lambda n, step: spark.range(n).select(
        (1000 + F.col("id") * step).alias("near"), (F.col("id") % 40).alias("whole"))
    ref, cur = near(3000, 0.0001), near(1500, 0.00019)
    verdicts = rp.drift_of(rp.profile_of(ref), cur)
    got = {r["column_name"]: r["drifted"] for r in verdicts.collect()}
    assert got["near"] is None and got["whole"] is False
    got = {r["column_name"]: r["drifted"] for r in rp.settle(verdicts, ref, cur).collect()}
    assert got == {r["column_name"]: r["drifted"] for r in drift.drift_features(ref, cur).collect()}


def test_sketched_quantiles_keep_their_stated_error(spark):
    df = frame(spark, 5, 60_000)
    probs = [0.01, 0.25, 0.5, 0.9, 0.999]
    got = rp.quantiles(rp.profile_of(df, ["normal", "wide"], part=F.col("part")), probs).collect()
    assert len(got) == 10
    for r in got:
        values = np.sort(df.where(F.col(r["column_name"]).isNotNull()).select(r["column_name"]).toPandas()
                         .iloc[:, 0].to_numpy())
        below, upto = (np.searchsorted(values, r["quantile"], s) / len(values) for s in ("left", "right"))
        assert below - 2 * rp.RANK_ERROR <= r["prob"] <= upto + 2 * rp.RANK_ERROR


def test_parts_are_replaced_and_two_writers_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "profile")
    assert rp.load(spark, path).count() == 0
    old, new = frame(spark, 1, 600), frame(spark, 9, 500)
    rp.add(rp.profile_of(old, COLS, part=F.col("part")), path)
    rp.add(rp.profile_of(new.where("part = 'p2'"), COLS, part=F.col("part")), path)
    rp.add(rp.profile_of(new.where("part IS NULL"), COLS, part=F.col("part")), path)
    rp.add(rp.profile_of(new.limit(0), COLS, part=F.col("part")), path)
    # rows without a record are those of a failed writer
    rp.profile_of(new, COLS, part=F.col("part")).withColumn("added", F.lit("x")).write.parquet(f"{path}/x")
    kept = old.where("part IS NOT NULL AND part <> 'p2'").unionByName(new.where("part = 'p2' OR part IS NULL"))
    assert counts(rp.merge(rp.load(spark, path))) == counts(rp.profile_of(kept, COLS))


def test_odd_inputs(spark):
    empty = frame(spark, 1, 4).limit(0)
    few = spark.createDataFrame([(1.0, 2), (None, 3)], "`a.b` double, c int")
    got = {r["column_name"]: r for r in rp.drift_of(rp.profile_of(few), few).collect()}
    assert got["a.b"]["drifted"] is False and got["a.b"]["psi_high"] == 0.0 and got["a.b"]["pvalue_low"] == 1.0
    assert got["c"]["n_reference"] == 2 and got["c"]["ks_high"] == 0.0
    none = rp.drift_of(rp.profile_of(frame(spark, 1, 50), COLS), empty, COLS).collect()
    assert {r["drifted"] for r in none} == {False} and {r["n_current"] for r in none} == {0}
    with pytest.raises(ValueError, match="not in the profile: c"):
        rp.drift_of(rp.profile_of(frame(spark, 1, 50), COLS), few, ["c"])
    endless = spark.createDataFrame([(1.0,), (float("inf"),), (3.0,)], "normal double")
    with pytest.raises(ValueError, match="infinite values in normal"):
        rp.drift_of(rp.profile_of(endless), endless)


def test_frozen_bins_are_those_of_the_reference(spark):
    from casaframe.streaming.drift_stream import reference_bins, reference_edges

    ref = frame(spark, 4, 20_000)
    cols = ["normal", "whole"]
    edges, held = rp.frozen_bins(rp.profile_of(ref, cols, part=F.col("part")), cols)
    assert edges == reference_edges(ref, cols)
    want = {c: [0] * 10 for c in cols}
    for r in reference_bins(ref, edges).collect():
        want[r["column_name"]][r["bin"]] = r["reference_count"]
    assert held["whole"] == want["whole"]
    assert sum(held["normal"]) == sum(want["normal"])
    n = sum(want["normal"])
    assert np.abs(np.cumsum(held["normal"]) - np.cumsum(want["normal"])).max() <= 2 * rp.RANK_ERROR * n
