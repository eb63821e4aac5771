"""Pipeline steps over one SparkSession: ingest, validate, clean, train, drift, full.

Each step is a function; ``run_step`` keeps the original step names and the
rule that ``drift`` needs both inputs (an error alone, a skip inside
``full``).  Validation has no side effects.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from casaframe import schema
from casaframe.functions.exprs import qcol
from casaframe.functions.names import select_known_columns
from casaframe.operators import drift as drift_ops
from casaframe.operators import reference_profile
from casaframe.operators.clean import clean_filter, clean_values, clean_view
from casaframe.operators.duplicates import duplicate_report
from casaframe.operators.features import feature_columns, prepare
from casaframe.operators.model import (_read_json, _write_json, enforce_r2_gate, persist_model,
                                       train_and_select)
from casaframe.operators.outliers import outlier_report
from casaframe.operators.profile import metrics_of, observed_profile
from casaframe.operators.validate import observed_rules, require_valid, validate_summary
from casaframe.plans.runlog import RunLog
from casaframe.sources.readers import path_exists, read_tabular
from casaframe.sources.sinks import replace_table, write_prepared
from casaframe.sources.snapshots import read_published

STEPS = ["ingest", "validate", "clean", "train", "drift", "full"]


@dataclass
class Paths:
    """Where a run reads and writes; on a cluster all of these are shared storage."""

    raw_source: str | None = None      # CSV / Parquet input of ingest
    raw_table: str | None = None       # Parquet table written by ingest
    prepared: str | None = None        # prepared dataset (key, features, target)
    model_dir: str | None = None
    runlog: str | None = None
    report_dir: str | None = None
    profile: str | None = None         # stored reference profile, for drift without the reference


def ingest(spark: SparkSession, paths: Paths, run_log: RunLog | None = None,
           gate: bool = False) -> DataFrame:
    """Read, normalise, select and rename, replace the raw table, log the raw profile.

    One pass over the source writes the table and takes both profiles and the
    contract's counts on the way.  With ``gate`` a table whose clean rows break
    the contract is not published; the old one stays.
    """
    return ingest_observed(spark, paths, run_log, gate)[0]


def ingest_observed(spark: SparkSession, paths: Paths, run_log: RunLog | None = None,
                    gate: bool = False) -> tuple[DataFrame, dict, dict]:
    """``ingest``'s clean view, the profile of the table and the violations of the contract."""
    raw, raw_result = observed_profile(read_tabular(spark, paths.raw_source))
    kept, kept_result = observed_profile(select_known_columns(raw))
    watched, violations = observed_rules(kept, clean_filter(kept), clean_values())

    def check() -> None:
        broken = {k: n for k, n in violations().items() if n}
        if gate and broken:
            raise ValueError(f"the contract is broken, the table stays as it was: {broken}")

    clean = replace_table(watched, paths.raw_table, before_commit=check)
    if run_log is not None:
        run_id = RunLog.new_run_id()
        run_log.log_metrics(run_id, "ingest", metrics_of(raw_result()))
        run_log.log_artifact(run_id, "ingest", "raw_data_stats.json", raw_result())
        run_log.log_document(run_id, "ingest", "raw_profile", raw_result())
    return clean, kept_result(), violations()


def load_clean(spark: SparkSession, paths: Paths) -> DataFrame:
    return clean_view(read_published(spark, paths.raw_table))


def validate(spark: SparkSession, paths: Paths, numeric: list[str] | None = None) -> dict:
    """Contract summary plus (information only) outlier and duplicate reports."""
    clean = load_clean(spark, paths)
    numeric = numeric or ["gr_liv_area", "total_bsmt_sf", "garage_area", "lot_frontage", "saleprice"]
    return {
        "summary": validate_summary(clean).first().asDict(),
        "outliers": [r.asDict() for r in outlier_report(clean, numeric).collect()],
        "duplicates": duplicate_report(clean.drop(schema.KEY_COLUMN)).first().asDict(),
    }


def clean(spark: SparkSession, paths: Paths) -> tuple[DataFrame, dict]:
    """Gate on validity, derive features, fit and apply one-hot, write one prepared dataset."""
    frame = load_clean(spark, paths)
    require_valid(validate_summary(frame))
    prepared, encoder = prepare(frame, sparse=True)
    write_prepared(prepared, paths.prepared)
    _write_json(spark, _categories(paths), encoder.to_dict())
    return read_published(spark, paths.prepared), encoder.to_dict()


def _categories(paths: Paths) -> str:
    """Where the category list of the prepared dataset lies."""
    return f"{paths.prepared.rstrip('/')}_categories"


def load_training_data(spark: SparkSession, paths: Paths) -> tuple[DataFrame, dict]:
    """The prepared dataset and its category list; both made from the clean view if absent."""
    if paths.prepared and path_exists(spark, paths.prepared) and path_exists(spark, _categories(paths)):
        return read_published(spark, paths.prepared), _read_json(spark, _categories(paths))
    prepared, encoder = prepare(load_clean(spark, paths), sparse=True)
    return prepared, encoder.to_dict()


def train(spark: SparkSession, paths: Paths, encoder: dict | None = None,
          params: dict | None = None, run_log: RunLog | None = None,
          threshold: float = schema.R2_MIN_THRESHOLD):
    """Train, select, gate (before anything is logged or saved), log, register, persist."""
    data, fitted = load_training_data(spark, paths)
    encoder = encoder or fitted
    features = feature_columns(data)
    result = train_and_select(data, features, params=params)
    enforce_r2_gate(result.metrics["r2"], threshold)
    run_id = RunLog.new_run_id()
    if run_log is not None:
        run_log.log_params(run_id, "train", {"best_model": result.best_name,
                                             "r2_min_threshold": threshold})
        run_log.log_metrics(run_id, "train", result.metrics)
    persist_model(result, paths.model_dir, encoder=encoder)
    if run_log is not None:
        try:
            run_log.register_model(schema.MODEL_NAME, run_id, run_log.log_model(run_id, result, encoder))
        except Exception as exc:  # registration failure marks the run, then propagates
            run_log.log_params(run_id, "train", {"promotion_status": "failed",
                                                 "promotion_error": str(exc)[:250]})
            raise RuntimeError(f"model registration failed: {exc}") from exc
    return result


def drift(spark: SparkSession, reference_path: str, current_path: str,
          report_dir: str | None = None):
    ref = read_tabular(spark, reference_path)
    cur = read_tabular(spark, current_path)
    report = drift_ops.detect_drift(ref, cur)
    out = drift_ops.save_drift_report(report, report_dir, spark) if report_dir else None
    return report, out


def store_reference_profile(spark: SparkSession, reference_path: str, profile_path: str,
                            part: str | None = None) -> int:
    """Profile a reference data set and add its parts (by the column ``part``) to the stored profile."""
    ref = read_tabular(spark, reference_path)
    return reference_profile.add(
        reference_profile.profile_of(ref, part=qcol(part) if part else None), profile_path)


def drift_from_profile(spark: SparkSession, profile_path: str, current_path: str,
                       reference_path: str | None = None,
                       threshold: float = schema.DRIFT_SHARE_THRESHOLD) -> dict:
    """The dataset's verdict against a stored profile.

    Features that the profile leaves open are judged against the reference
    where it is given; else they are listed, and the verdict is None if it
    hangs on them.
    """
    cur = read_tabular(spark, current_path)
    found = reference_profile.drift_of(reference_profile.load(spark, profile_path), cur)
    if reference_path is not None:
        found = reference_profile.settle(found, read_tabular(spark, reference_path), cur)
    flags = {r["column_name"]: r["drifted"] for r in found.select("column_name", "drifted").collect()}
    n, sure = max(len(flags), 1), sum(1 for f in flags.values() if f)
    still_open = sorted(c for c, f in flags.items() if f is None)
    least, most = sure / n, (sure + len(still_open)) / n
    verdict = True if least >= threshold else False if most < threshold else None
    return {"dataset_drift": verdict, "drift_share": round(least, 4), "undecided": still_open,
            "per_feature_drift": flags}


def run_step(spark: SparkSession, step: str, paths: Paths, reference: str | None = None,
             current: str | None = None, params: dict | None = None) -> dict:
    if step not in STEPS:
        raise ValueError(f"unknown step {step!r}; choose from {STEPS}")
    log = RunLog(spark, paths.runlog) if paths.runlog else None
    out: dict = {}
    encoder = None
    if step in ("ingest", "full"):
        _, out["ingest"], _ = ingest_observed(spark, paths, log)
    if step == "validate":
        out["validate"] = validate(spark, paths)
    if step in ("clean", "full"):
        _, encoder = clean(spark, paths)
        out["clean"] = {"prepared": paths.prepared}
    if step in ("train", "full"):
        res = train(spark, paths, encoder=encoder, params=params, run_log=log)
        out["train"] = {"best": res.best_name, **res.metrics}
    if step in ("drift", "full"):
        if reference is not None and current is not None:
            report, path = drift(spark, reference, current, paths.report_dir)
            if log is not None:
                log.log_document(RunLog.new_run_id(), "drift", "drift_report", asdict(report))
            out["drift"] = {"dataset_drift": report.dataset_drift,
                            "drift_share": report.drift_share, "report": path}
        elif current is not None and paths.profile and path_exists(spark, paths.profile):
            out["drift"] = drift_from_profile(spark, paths.profile, current)
        elif step == "drift":
            raise SystemExit("drift needs both a reference and a current dataset (csv/parquet)")
        else:
            out["drift"] = "skipped: pass reference and current to enable it"
    return out


def main(argv: list[str] | None = None) -> None:
    import argparse
    import json

    from casaframe.session import local_session

    p = argparse.ArgumentParser(description="casaframe pipeline runner")
    p.add_argument("step", choices=STEPS)
    p.add_argument("--raw-source")
    p.add_argument("--work", required=True, help="shared folder for tables, model and logs")
    p.add_argument("--reference")
    p.add_argument("--current")
    a = p.parse_args(argv)
    spark = SparkSession.getActiveSession() or local_session()
    w = a.work.rstrip("/")
    paths = Paths(a.raw_source, f"{w}/properties_raw", f"{w}/prepared", f"{w}/model",
                  f"{w}/runlog", f"{w}/reports")
    print(json.dumps(run_step(spark, a.step, paths, a.reference, a.current), default=str))


if __name__ == "__main__":
    main()
