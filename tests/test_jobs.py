from __future__ import annotations

import pytest

from casaframe import schema
from casaframe.plans.jobs import Paths, run_step
from casaframe.plans.runlog import RunLog, model_info
from casaframe.sources import fixtures as fx
from casaframe.sources.sinks import write_csv
from conftest import SF001

SMALL = {"Random Forest": {"numTrees": 3, "maxDepth": 3},
         "Gradient Boosting": {"maxIter": 3, "maxDepth": 2}}


def test_full_run(spark, tmp_path):
    src = str(tmp_path / "raw.csv")
    raw = fx.properties_raw(spark, SF001).drop("l_shipdate").withColumnRenamed("order_id", "Order")
    write_csv(raw.withColumnRenamed("gr_liv_area", "Gr Liv Area"), src)
    w = str(tmp_path)
    paths = Paths(src, f"{w}/raw", f"{w}/prepared", f"{w}/model", f"{w}/log", f"{w}/reports")
    # the raw fixture contains prices <= 0, but the clean view filters them out
    out = run_step(spark, "full", paths, params=SMALL)
    assert out["train"]["r2"] >= 0.85
    assert out["drift"].startswith("skipped")
    assert model_info(spark, paths.model_dir).first().n_features > 0
    log = RunLog(spark, paths.runlog)
    keys = {r.key for r in log.metrics().collect()}
    assert {"raw_rows", "raw_columns", "raw_total_nulls", "mae", "rmse", "r2", "best_model"} <= keys
    assert log.versions().first().version == 1
    # the model is kept under its run; the next run leaves it as it is
    kept = log.model_path(schema.MODEL_NAME)
    assert f"run_id={log.versions().first().run_id}" in kept
    assert model_info(spark, kept).drop("model_version").collect() == model_info(
        spark, paths.model_dir).drop("model_version").collect()
    r2 = log.nested("model", "$.metrics").where("key = 'r2'").first()
    assert r2.value == out["train"]["r2"] and r2.run_id == log.versions().first().run_id
    missing = {r.key: r.value for r in log.nested("raw_profile", "$.null_counts", "bigint").collect()}
    assert missing["lot_frontage"] == raw.where("lot_frontage IS NULL").count()
    v = run_step(spark, "validate", paths)["validate"]
    assert v["summary"]["is_valid"] is True
    with pytest.raises(SystemExit):
        run_step(spark, "drift", paths)
    ref = f"{w}/ref.parquet"
    cur = f"{w}/cur.parquet"
    r, c = fx.drift_pair(spark, SF001)
    r.write.parquet(ref)
    c.write.parquet(cur)
    d = run_step(spark, "drift", paths, reference=ref, current=cur)["drift"]
    assert 0.0 <= d["drift_share"] <= 1.0 and d["report"].endswith(".json")
    assert {r.key: r.value for r in log.nested("drift_report", "$.per_feature_drift", "boolean").collect()}
    # the same step from a stored profile of the reference
    from casaframe.plans.jobs import store_reference_profile
    paths.profile = f"{w}/profile"
    store_reference_profile(spark, ref, paths.profile, part="neighborhood")
    p = run_step(spark, "drift", paths, current=cur)["drift"]
    assert p["dataset_drift"] in (None, d["dataset_drift"])
    assert set(p["undecided"]) == {c for c, f in p["per_feature_drift"].items() if f is None}


def test_documents_of_many_runs(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    assert log.documents().count() == 0 and log.nested("a").count() == 0
    log.log_document("r1", "s", "a", {"m": {"x": 1.5, "y": float("nan"), "t": "word"}, "n": [1, 2]})
    log.log_document("r2", "s", "a", {"m": {"x": 2}})
    log.log_document("r3", "s", "a", {"other": 1})
    log.log_document("r1", "s", "b", {"m": {"x": 9.0}})
    got = {(r.run_id, r.key): r.value for r in log.nested("a", "$.m").collect()}
    assert got == {("r1", "x"): 1.5, ("r1", "y"): None, ("r1", "t"): None, ("r2", "x"): 2.0}
    assert log.model_path("nobody") is None


def test_cli_parser_and_unknown_step(spark, tmp_path):
    from casaframe.plans.jobs import STEPS, main

    assert STEPS == ["ingest", "validate", "clean", "train", "drift", "full"]
    with pytest.raises(SystemExit):
        main(["nonsense", "--work", str(tmp_path)])
    with pytest.raises(ValueError):
        run_step(spark, "convert", Paths())


def test_steps_one_by_one_equal_the_full_run(spark, tmp_path):
    from casaframe.operators.model import load_model
    from casaframe.operators.score import score

    raw = fx.properties_raw(spark, SF001).drop("l_shipdate")
    src = str(tmp_path / "raw.parquet")
    raw.withColumnRenamed("order_id", "order").write.parquet(src)
    prices = {}
    for name, steps in (("full", ["full"]), ("steps", ["ingest", "clean", "train"]),
                        ("bare", ["ingest", "train"])):
        w = str(tmp_path / name)
        paths = Paths(src, f"{w}/raw", f"{w}/prepared", f"{w}/model", f"{w}/log", f"{w}/reports")
        for step in steps:
            run_step(spark, step, paths, params=SMALL)
        pm, meta = load_model(spark, paths.model_dir)
        assert meta["encoder"]["categories"]
        scored, _ = score(fx.requests(spark, SF001).drop("l_shipdate"), pm, meta, ["order_id"])
        assert "neighborhood" not in meta["features"]
        assert not any(f.startswith("nbh_") for f in scored.first().missing_features.split(","))
        prices[name] = {r.order_id: r.precio_predicho for r in scored.collect()}
    assert prices["full"] == prices["steps"] == prices["bare"] and prices["full"]


def test_ingest_reads_its_source_once_for_table_profile_and_contract(spark, tmp_path, monkeypatch):
    from casaframe.operators.clean import clean_view
    from casaframe.operators.profile import profile_dict, raw_profile
    from casaframe.operators.validate import validate_rules
    from casaframe.plans import jobs
    raw = fx.properties_raw(spark, SF001).drop("l_shipdate").withColumnRenamed("order_id", "order")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    monkeypatch.setattr(jobs, "read_tabular", lambda *_: raw.mapInPandas(count, raw.schema))
    paths = Paths("unused", str(tmp_path / "t"), runlog=str(tmp_path / "log"))
    log = RunLog(spark, paths.runlog)
    clean, table, violations = jobs.ingest_observed(spark, paths, log)
    n = raw.count()
    assert read.value == n and clean.count() == clean_view(raw.withColumnRenamed("order", "order_id")).count()
    assert table["row_count"] == n
    want = profile_dict(raw_profile(raw))
    assert {c: table["null_counts"][c] for c in want["null_counts"] if c in table["null_counts"]} == {
        c: v for c, v in want["null_counts"].items() if c in table["null_counts"]}
    rules = {f"{r['rule']}:{r['column_name']}": r["violations"] for r in validate_rules(clean_view(raw.withColumnRenamed("order", "order_id"))).collect()}
    assert violations == rules
    got = {r["key"]: r["value"] for r in log.metrics().where("kind = 'metric'").collect()}
    assert (got["raw_rows"], got["raw_total_nulls"]) == (n, sum(want["null_counts"].values()))


def test_a_broken_contract_keeps_the_old_table(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from casaframe.plans import jobs
    from casaframe.sources.snapshots import read_published
    raw = fx.properties_raw(spark, SF001).drop("l_shipdate").withColumnRenamed("order_id", "order")
    paths = Paths("unused", str(tmp_path / "t"))
    monkeypatch.setattr(jobs, "read_tabular", lambda *_: raw.limit(500))
    jobs.ingest(spark, paths, gate=True)
    broken = raw.withColumn("neighborhood", F.lit(None).cast("string"))
    monkeypatch.setattr(jobs, "read_tabular", lambda *_: broken)
    with pytest.raises(ValueError, match="not_null:neighborhood"):
        jobs.ingest(spark, paths, gate=True)
    assert read_published(spark, paths.raw_table).count() == 500
