"""Drift decided inside the stream: bin counts as keyed state, one verdict per window.

Rows are binned on the JVM with edges frozen from the reference frame, and
every task adds them up to one array of counts per window before anything is
shuffled, so a busy window costs its owner a few rows a task.  The counts of
a window are the state of its key; a timer at the window's end fires once
the watermark has passed it and emits, for every feature, the PSI, the gap
of both distribution functions at the bin edges, the flag, and the share of
drifted features with the dataset's verdict.  Then the state goes.

A row whose window the watermark has passed is late: it changes no verdict,
and is counted by window and feature in an output of its own.

The gap at the edges is a lower bound of the two-sample KS statistic, so its
test (the limit law with the finite-size correction of ``operators.drift``)
flags no feature that the full test at the same limit would not.  A feature
with fewer than 2 values on a side has PSI 0 and does not drift.

Verdicts depend on rows and watermarks alone: Spark replays both from the
checkpoint, so a restart in mid-window gives the same rows, and each batch is
written under its id with overwrite.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from casaframe import schema
from casaframe.functions.exprs import to_double
from casaframe.operators.drift import bin_index
from casaframe.streaming.drift_stream import reference_bins

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = ("late boolean, start_ms long, end_ms long, column_name string, n_current long, psi double, "
          "ks_gap double, drifted boolean, n_features long, n_drifted long, drift_share double, "
          "dataset_drift boolean")


def limit_point(p_limit: float) -> float:
    """Where the tail of the Kolmogorov limit law falls to ``p_limit``."""
    tail = lambda z: 2.0 * sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * z * z)
                               for k in range(1, 60))
    lo, hi = 0.3, 6.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if tail(mid) > p_limit else (lo, mid)
    return (lo + hi) / 2


def judge(reference: np.ndarray, current: np.ndarray, psi_limit: float, point: float,
          eps: float = schema.PSI_EPSILON) -> tuple[float, float | None, bool]:
    """(PSI, gap at the edges, drifted) of one feature from its two histograms."""
    n0, n1 = int(reference.sum()), int(current.sum())
    if n0 < 2 or n1 < 2:
        return 0.0, None, False
    p = (reference + eps) / (reference + eps).sum()
    q = (current + eps) / (current + eps).sum()
    psi = float(((q - p) * np.log(q / p)).sum())
    gap = float(np.abs(np.cumsum(reference) / n0 - np.cumsum(current) / n1).max())
    en = float(np.round(n0 * n1 / (n0 + n1)))
    z = gap * math.sqrt(en)
    z = z + 1.0 / (6.0 * math.sqrt(en)) + (z - 1.0) / (4.0 * en) if z > 0 else 0.0
    return psi, gap, psi > psi_limit or z > point


class WindowVerdict(StatefulProcessor):
    """State of a window: an array of counts, features x bins."""

    def __init__(self, names: list[str], reference: np.ndarray, psi_limit: float, p_limit: float,
                 threshold: float):
        self.names, self.reference, self.threshold = names, reference, threshold
        self.psi_limit, self.point = psi_limit, limit_point(p_limit)

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "counts array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start, end = map(int, key)
        total = np.zeros(self.reference.size, dtype=np.int64)
        for pdf in rows:
            for counts in pdf["counts"]:
                total += np.asarray(counts, dtype=np.int64)
        if end <= timerValues.getCurrentWatermarkInMs():
            n = total.reshape(self.reference.shape).sum(axis=1)
            yield self._rows(start, end, late=True, column_name=self.names, n_current=n)
            return
        if self.counts.exists():
            total += np.asarray(self.counts.get()[0], dtype=np.int64)
        else:
            self.handle.registerTimer(end)
        self.counts.update((total.tolist(),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, end = map(int, key)
        current = np.asarray(self.counts.get()[0], dtype=np.int64).reshape(self.reference.shape)
        self.counts.clear()
        psi, gap, drifted = zip(*(judge(r, c, self.psi_limit, self.point)
                                  for r, c in zip(self.reference, current)))
        share = sum(drifted) / max(1, len(drifted))
        yield self._rows(start, end, late=False, column_name=self.names, n_current=current.sum(axis=1),
                         psi=psi, ks_gap=gap, drifted=drifted, n_features=len(drifted),
                         n_drifted=sum(drifted), drift_share=round(share, 4),
                         dataset_drift=share >= self.threshold)

    def _rows(self, start: int, end: int, **columns) -> pd.DataFrame:
        pdf = pd.DataFrame({"start_ms": start, "end_ms": end, **columns}, index=range(len(self.names)))
        return pdf.reindex(columns=[c.split()[0] for c in OUTPUT.split(", ")]).astype({
            "late": "boolean", "n_current": "Int64", "n_features": "Int64", "n_drifted": "Int64",
            "psi": "float64", "ks_gap": "float64", "drift_share": "float64", "drifted": "boolean",
            "dataset_drift": "boolean"})

    def close(self) -> None:
        pass


def window_counts(stream: DataFrame, ts_col: str, edges: dict[str, list[float]], window: str,
                  watermark: str, bins: int = schema.PSI_BINS) -> DataFrame:
    """(start_ms, end_ms, counts): one array of features x bins per window and Arrow batch.

    The event time ends here: what follows sees the watermark, but drops no row by it.
    """
    dtypes = {f.name: f.dataType for f in stream.schema.fields}
    cols = list(edges)
    slot = F.window(F.col("__ts"), window)
    binned = (stream.withColumn("__ts", F.col(ts_col).cast("timestamp")).withWatermark("__ts", watermark)
              .where(F.col("__ts").isNotNull())
              .select(slot.alias("w"), *[F.coalesce(bin_index(to_double(c, dtypes[c]), edges[c]), F.lit(-1))
                                         .cast("int").alias(f"b{i}") for i, c in enumerate(cols)])
              .select(F.unix_millis("w.start").alias("start_ms"), F.unix_millis("w.end").alias("end_ms"),
                      *[f"b{i}" for i in range(len(cols))]))

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for (start, end), part in pdf.groupby(["start_ms", "end_ms"]):
                got = [np.bincount(part[f"b{i}"].to_numpy() + 1, minlength=bins + 1)[1:]
                       for i in range(len(cols))]
                out.append((start, end, np.concatenate(got).tolist()))
            yield pd.DataFrame(out, columns=["start_ms", "end_ms", "counts"])

    return binned.mapInPandas(add_up, "start_ms long, end_ms long, counts array<bigint>")


def start_drift_monitor(spark: SparkSession, source_dir: str, source_schema: T.StructType, ts_col: str,
                        reference: DataFrame | dict, edges: dict[str, list[float]], sink_dir: str,
                        checkpoint_dir: str, *, window: str = "30 days", watermark: str = "1 day",
                        psi_limit: float = schema.PSI_LIMIT, p_limit: float = schema.KS_P_LIMIT,
                        threshold: float = schema.DRIFT_SHARE_THRESHOLD, available_now: bool = True,
                        fmt: str = "parquet", max_files: int | None = None) -> StreamingQuery:
    """Start the monitor; ``edges`` as of ``drift_stream.reference_edges``.

    ``reference`` may also be the counts per feature and bin that
    ``reference_profile.frozen_bins`` returns with its edges; no reference is read then.
    """
    reader = spark.readStream.schema(source_schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    counts = window_counts(reader.load(source_dir), ts_col, edges, window, watermark)
    names = list(edges)
    if isinstance(reference, dict):
        held = {(c, k): n for c in names for k, n in enumerate(reference[c])}
    else:
        held = {(r["column_name"], r["bin"]): r["reference_count"]
                for r in reference_bins(reference, edges).collect()}  # features x bins
    table = np.array([[held[c, k] for k in range(schema.PSI_BINS)] for c in names], dtype=np.int64)
    verdicts = counts.groupBy("start_ms", "end_ms").transformWithStateInPandas(
        WindowVerdict(names, table, psi_limit, p_limit, threshold), OUTPUT, "Append", "EventTime")
    sink = sink_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            at = lambda c: F.timestamp_millis(c)
            named = batch.select("*", at("start_ms").alias("window_start"), at("end_ms").alias("window_end"))
            (named.where("NOT late").drop("late", "start_ms", "end_ms")
             .write.mode("overwrite").parquet(f"{sink}/verdicts/batch_id={batch_id}"))
            (named.where("late AND n_current > 0")
             .select("window_start", "window_end", "column_name", F.col("n_current").alias("n_late"))
             .write.mode("overwrite").parquet(f"{sink}/late/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    writer = (verdicts.writeStream.outputMode("append").foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)  # the store that such state needs; a query keeps its own copy
    try:
        return writer.start()
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def read_verdicts(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sink_dir.rstrip('/')}/verdicts")


def read_late(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sink_dir.rstrip('/')}/late")
