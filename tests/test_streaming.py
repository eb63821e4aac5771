from __future__ import annotations

from pyspark.sql import functions as F

from casaframe.operators import features, model
from casaframe.operators.score import score
from casaframe.sources import fixtures as fx
from casaframe.streaming import drift_stream as ds
from casaframe.streaming.score_stream import read_log, read_scored, start_stream_score
from conftest import SF001


def test_stream_score_matches_batch(spark, tmp_path):
    prepared, enc = features.prepare(fx.properties_clean(spark, SF001))
    res = model.train_and_select(prepared, features.feature_columns(prepared),
                                 names=["Linear Regression"])
    mdir = str(tmp_path / "model")
    model.persist_model(res, mdir, encoder=enc.to_dict())
    pm, meta = model.load_model(spark, mdir)
    req = fx.requests(spark, SF001).drop("l_shipdate")
    src = str(tmp_path / "src")
    req.repartition(4).write.parquet(src)
    q = start_stream_score(spark, src, req.schema, pm, meta, str(tmp_path / "sink"),
                           str(tmp_path / "ckpt"), passthrough=["order_id"])
    q.awaitTermination()
    valid, rejected = read_scored(spark, str(tmp_path / "sink"))
    bv, br = score(req, pm, meta, passthrough=["order_id"])
    assert (valid.count(), rejected.count()) == (bv.count(), br.count())
    diff = valid.select("order_id", "precio_predicho").exceptAll(bv.select("order_id", "precio_predicho"))
    assert diff.count() == 0
    log = read_log(spark, str(tmp_path / "sink"))
    assert log.count() == req.count() == log.select("request_id").distinct().count()
    assert log.where("status = 'scored'").join(valid, "request_id").count() == bv.count()
    assert log.where("latency_ms > 0 AND model_version IS NOT NULL AND ts IS NOT NULL").count() == req.count()


def test_a_killed_batch_shows_nothing_and_its_replay_once(spark, tmp_path, monkeypatch):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    from casaframe.streaming import score_stream as ss
    flat = PipelineModel([SQLTransformer(statement="SELECT *, 1000.0 AS prediction FROM __THIS__")])
    meta = {"modelo": "flat", "features": [], "r2": 0.9, "model_version": "7"}
    req = fx.requests(spark, SF001).drop("l_shipdate").limit(50)
    src, sink, ck = (str(tmp_path / x) for x in ("src", "sink", "ck"))
    req.coalesce(1).write.parquet(src)
    run = lambda: ss.start_stream_score(spark, src, req.schema, flat, meta, sink, ck,
                                        passthrough=["order_id"]).awaitTermination()

    def killed(*args):
        raise RuntimeError("killed before the commit")

    monkeypatch.setattr(ss, "create_if_absent", killed)
    import pytest
    with pytest.raises(Exception, match="killed before the commit"):
        run()
    monkeypatch.undo()
    assert [d.count() for d in (*read_scored(spark, sink), read_log(spark, sink))] == [0, 0, 0]
    run()
    valid, rejected = read_scored(spark, sink)
    log = read_log(spark, sink)
    assert valid.count() + rejected.count() == 50 == log.select("request_id").distinct().count() == log.count()
    # the batch is replayed although it was committed (its offset commit was lost)
    for name in (tmp_path / "ck" / "commits").iterdir():
        name.unlink()
    run()
    assert read_log(spark, sink).count() == 50 and read_scored(spark, sink)[0].count() == valid.count()


def test_stream_drift_single_batch(spark, tmp_path):
    ref, _ = fx.drift_pair(spark, SF001)
    cols = ["gr_liv_area", "saleprice"]
    edges = ds.reference_edges(ref, cols)
    raw = fx.properties_raw(spark, SF001)
    cut = F.expr(f"timestamp_ntz'{fx.DRIFT_CUTOFF}'")
    cur = raw.where(~(F.col("l_shipdate") < cut))
    src = str(tmp_path / "src")
    cur.write.parquet(src)
    q = ds.start_stream_drift(spark, src, cur.schema, "l_shipdate", edges, str(tmp_path / "sink"),
                              str(tmp_path / "ckpt"), window="30 days")
    q.awaitTermination()
    psi = ds.window_psi(spark, str(tmp_path / "sink"), ds.reference_bins(ref, edges))
    total = {r.column_name: r.n for r in psi.groupBy("column_name")
             .agg(F.sum("n_current").alias("n")).collect()}
    n_cur = cur.count()
    assert total == {"gr_liv_area": n_cur, "saleprice": n_cur}
    assert psi.where(F.col("psi") < 0).count() == 0


def test_late_rows_counted(spark, tmp_path):
    """The second run starts with the watermark of the first: its old rows are dropped and counted."""
    import datetime as dt
    import time

    fields = "ts timestamp, v double"
    src, late = str(tmp_path / "late"), ds.LateRows()
    spark.streams.addListener(late)
    try:
        for part, days in (("a", [10, 40]), ("b", [2, 3, 41])):
            rows = [(dt.datetime(2021, 1, 1) + dt.timedelta(days=d), 4.5) for d in days]
            spark.createDataFrame(rows, fields).coalesce(1).write.parquet(f"{src}/{part}")
            q = ds.start_stream_drift(spark, src + "/*", spark.createDataFrame([], fields).schema, "ts",
                                      {"v": [float(x) for x in range(11)]}, str(tmp_path / "sink"),
                                      str(tmp_path / "ckpt"), window="1 day", watermark="1 day")
            q.awaitTermination()
        end = time.time() + 20
        while late.of(q) < 2 and time.time() < end:
            time.sleep(0.2)
        assert late.of(q) == 2
    finally:
        spark.streams.removeListener(late)


def test_ks_of_every_batch(spark, tmp_path):
    import numpy as np
    import pandas as pd

    from casaframe.operators.drift import ks_test
    from casaframe.streaming import drift_stream as ds

    rng = np.random.default_rng(31)
    ref = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=900)}))
    parts = [spark.createDataFrame(pd.DataFrame({"x": rng.normal(shift, 1, 200)}))
             for shift in (0.0, 0.8)]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = ds.start_stream_ks(spark, str(tmp_path / "in"), ref.schema, ref, ["x"],
                           str(tmp_path / "out"), str(tmp_path / "ck"), max_files=1)
    q.awaitTermination()
    got = sorted((r.ks_statistic, r.ks_pvalue, r.n_current)
                 for r in ds.read_ks(spark, str(tmp_path / "out")).collect())
    want = sorted((r.ks_statistic, r.ks_pvalue, r.n_current)
                  for part in parts for r in ks_test(ref, part, ["x"]).collect())
    assert got == want and want[0][1] > 0.05 > want[1][1]


# ------------------------------------------------------------------ verdicts in the stream

DAY = 86_400


def _readings(rng, day, n, shift=0.0):
    import datetime as dt

    import pandas as pd
    at = dt.datetime(2021, 1, 1) + dt.timedelta(days=day)
    return pd.DataFrame({"ts": [at + dt.timedelta(seconds=int(x)) for x in rng.integers(0, DAY, n)],
                         "x": rng.normal(shift, 1, n), "y": rng.normal(0, 1, n)})


def _monitor(spark, tmp, name, ref, **kw):
    from casaframe.streaming import drift_monitor as dm
    edges = ds.reference_edges(ref, ["x", "y"])
    q = dm.start_drift_monitor(spark, f"{tmp}/{name}/in/*", spark.createDataFrame(
        [], "ts timestamp, x double, y double").schema, "ts", ref, edges, f"{tmp}/{name}/sink",
        f"{tmp}/{name}/ck", window="1 day", watermark="1 day", **kw)
    q.awaitTermination()
    return edges


def _put(spark, tmp, name, part, pdf):
    spark.createDataFrame(pdf).coalesce(1).write.parquet(f"{tmp}/{name}/in/{part}")


def _verdicts(spark, tmp, name):
    from casaframe.streaming import drift_monitor as dm
    return sorted(map(str, dm.read_verdicts(spark, f"{tmp}/{name}/sink").drop("batch_id").collect()))


def test_verdict_of_every_closed_window(spark, tmp_path):
    """PSI, gap, flags and share against a plain computation; late rows change no verdict."""
    import numpy as np
    import pandas as pd

    from casaframe.streaming import drift_monitor as dm
    rng = np.random.default_rng(5)
    ref = spark.createDataFrame(_readings(rng, -5, 2000).drop(columns="ts"))
    days = {0: _readings(rng, 0, 400), 1: _readings(rng, 1, 400, shift=1.5), 2: _readings(rng, 2, 1),
            6: _readings(rng, 6, 50)}
    days[0].loc[3, "x"] = None
    _put(spark, tmp_path, "a", "1", pd.concat([days[d] for d in days]))
    edges = _monitor(spark, tmp_path, "a", ref)
    late = _readings(rng, 1, 30, shift=9)
    _put(spark, tmp_path, "a", "2", pd.concat([late, _readings(rng, 7, 5)]))
    _monitor(spark, tmp_path, "a", ref)
    got = {(r["window_start"].day - 1, r["column_name"]): r for r in
           dm.read_verdicts(spark, f"{tmp_path}/a/sink").collect()}
    assert sorted(got) == [(d, c) for d in (0, 1, 2) for c in "xy"]
    held = ref.toPandas()
    for (d, c), r in got.items():
        cut = lambda v: np.bincount(np.searchsorted(edges[c][1:-1], v.dropna(), side="right"), minlength=10)  # noqa: E731,B023
        a, b = cut(held[c]), cut(days[d][c])
        if b.sum() < 2:
            assert (r["psi"], r["ks_gap"], r["drifted"]) == (0.0, None, False)
            continue
        p, q = (a + 1e-4) / (a + 1e-4).sum(), (b + 1e-4) / (b + 1e-4).sum()
        assert abs(r["psi"] - ((q - p) * np.log(q / p)).sum()) < 1e-9
        assert abs(r["ks_gap"] - np.abs(a.cumsum() / a.sum() - b.cumsum() / b.sum()).max()) < 1e-12
        assert r["n_current"] == b.sum()
    assert [got[d, c]["drifted"] for d in (0, 1, 2) for c in "xy"] == [False, False, True, False, False, False]
    assert {(d, r["dataset_drift"], r["drift_share"]) for (d, _), r in got.items()} == {
        (0, False, 0.0), (1, True, 0.5), (2, False, 0.0)}
    assert {(r["window_start"].day, r["column_name"], r["n_late"]) for r in
            dm.read_late(spark, f"{tmp_path}/a/sink").collect()} == {(2, "x", 30), (2, "y", 30)}


def test_restart_in_mid_window_gives_the_same_verdicts(spark, tmp_path):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(6)
    ref = spark.createDataFrame(_readings(rng, -5, 1000).drop(columns="ts"))
    first, second = _readings(rng, 0, 300), _readings(rng, 0, 300, shift=0.7)
    parts = [first, pd.concat([second, _readings(rng, 1, 100)]), _readings(rng, 4, 50)]
    for k, part in enumerate(parts):
        _put(spark, tmp_path, "whole", str(k), part)
        _put(spark, tmp_path, "cut", str(k), part)
        _monitor(spark, tmp_path, "cut", ref)          # a new query on the same checkpoint
    _monitor(spark, tmp_path, "whole", ref)
    assert _verdicts(spark, tmp_path, "cut") == _verdicts(spark, tmp_path, "whole")
    assert len(_verdicts(spark, tmp_path, "cut")) == 4


def test_limit_point_is_that_of_the_limit_law(spark):
    from casaframe.operators.drift import kolmogorov_sf
    from casaframe.streaming.drift_monitor import limit_point
    for p in (0.2, 0.05, 0.001):
        got = spark.range(1).select(kolmogorov_sf(F.lit(limit_point(p)))).first()[0]
        assert abs(got - p) < 1e-9
