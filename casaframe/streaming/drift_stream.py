"""Streaming drift: PSI per event-time window against a fixed reference frame.

In a stream the joint range of both samples is unknown, so the bin edges
are frozen from the reference frame; current values below/above it fall in
the first/last bin.  Numbers therefore differ from the batch PSI by design.

The stream keeps only (window, feature, bin) counts as state, bounded by the
watermark.  ``update`` mode emits changed windows every trigger (append
would hold the last window back until the watermark passes it); each
trigger's rows are written under their batch id and readers keep, per
window/feature/bin, the row from the latest batch.

``start_stream_ks`` adds the exact two-sample KS test of every micro-batch
against the reference; it needs no state, and a replayed batch replaces its
own result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from casaframe import schema
from casaframe.functions.exprs import to_double
from casaframe.operators.drift import bin_edges, bin_index, ks_test, pooled, side_stats
from casaframe.operators.order_stats import in_rows


def reference_edges(reference: DataFrame, columns: list[str],
                    bins: int = schema.PSI_BINS) -> dict[str, list[float]]:
    both = pooled(reference, reference.limit(0), columns)
    st = side_stats(both, columns)
    return {c: bin_edges(st[c]["lo0"], st[c]["hi0"], bins)
            for c in columns if st[c]["n0"] and st[c]["n0"] >= 2}


def reference_bins(reference: DataFrame, edges: dict[str, list[float]],
                   bins: int = schema.PSI_BINS) -> DataFrame:
    """Dense reference histogram (column_name, bin, reference_count) in one aggregate."""
    dtypes = {f.name: f.dataType for f in reference.schema.fields}
    cols = list(edges)
    binned = reference.select(*[
        bin_index(to_double(c, dtypes[c]), edges[c]).alias(f"b{i}") for i, c in enumerate(cols)])
    wide = binned.agg(*[F.count_if(F.col(f"b{i}") == k).alias(f"c{i}_{k}")
                        for i in range(len(cols)) for k in range(bins)])
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("bin"),
                               F.col(f"c{i}_{k}").cast("bigint").alias("reference_count"))
                      for i, c in enumerate(cols) for k in range(bins)])
    return wide.select(F.explode(items).alias("r")).select("r.*")


def windowed_bins(stream: DataFrame, ts_col: str, edges: dict[str, list[float]],
                  window: str, watermark: str) -> DataFrame:
    """Streaming (window, column_name, bin) counts of the current data."""
    dtypes = {f.name: f.dataType for f in stream.schema.fields}
    cols = list(edges)
    ts = F.col(ts_col).cast("timestamp")
    long = in_rows(stream, {c: bin_index(to_double(c, dtypes[c]), edges[c]) for c in cols},
                   "column_name", "bin", (ts.alias("event_ts"),)).where(F.col("bin").isNotNull())
    return (long.withWatermark("event_ts", watermark)
            .groupBy(F.window("event_ts", window).alias("window"), "column_name", "bin")
            .agg(F.count(F.lit(1)).alias("current_count")))


def start_stream_drift(spark: SparkSession, source_dir: str, source_schema: T.StructType,
                       ts_col: str, edges: dict[str, list[float]], sink_dir: str,
                       checkpoint_dir: str, window: str = "30 days",
                       watermark: str = "3650 days", available_now: bool = True,
                       fmt: str = "parquet") -> StreamingQuery:
    stream = spark.readStream.schema(source_schema).format(fmt).load(source_dir)
    counts = windowed_bins(stream, ts_col, edges, window, watermark)
    sink = sink_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), "column_name", "bin",
                      "current_count", F.lit(batch_id).alias("batch"))
         .write.mode("overwrite").parquet(f"{sink}/counts/batch_id={batch_id}"))

    writer = (counts.writeStream.outputMode("update").foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start()


def window_psi(spark: SparkSession, sink_dir: str, ref_bins: DataFrame,
               eps: float = schema.PSI_EPSILON) -> DataFrame:
    """PSI per (window, feature) from the latest counts of every window, dense bins."""
    counts = spark.read.parquet(f"{sink_dir.rstrip('/')}/counts")
    latest = (counts.groupBy("window_start", "window_end", "column_name", "bin")
              .agg(F.max_by("current_count", "batch").alias("current_count")))
    windows = latest.select("window_start", "window_end", "column_name").distinct()
    # ref_bins has bins x features rows: bounded, broadcast is safe.
    dense = (windows.join(F.broadcast(ref_bins), "column_name")
             .join(latest, ["window_start", "window_end", "column_name", "bin"], "left")
             .fillna({"current_count": 0}))
    per = Window.partitionBy("window_start", "column_name")
    p = (F.col("reference_count") + eps) / F.sum(F.col("reference_count") + eps).over(per)
    q = (F.col("current_count") + eps) / F.sum(F.col("current_count") + eps).over(per)
    return (dense.select("window_start", "window_end", "column_name", "current_count",
                         ((q - p) * F.ln(q / p)).alias("term"))
            .groupBy("window_start", "window_end", "column_name")
            .agg(F.sum("term").alias("psi"), F.sum("current_count").alias("n_current")))


def start_stream_ks(spark: SparkSession, source_dir: str, source_schema: T.StructType,
                    reference: DataFrame, columns: list[str], sink_dir: str, checkpoint_dir: str,
                    available_now: bool = True, fmt: str = "parquet",
                    max_files: int | None = None) -> StreamingQuery:
    """KS statistic and p-value of each micro-batch against ``reference``, by feature.

    A feature without values in a batch has no p-value there; an empty batch
    writes nothing.  ``max_files`` bounds the files of a batch.
    """
    reader = spark.readStream.schema(source_schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    sink = sink_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            (ks_test(reference, batch, columns)
             .write.mode("overwrite").parquet(f"{sink}/ks/batch_id={batch_id}"))

    writer = (reader.load(source_dir).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start()


def read_ks(spark: SparkSession, sink_dir: str) -> DataFrame:
    """batch_id, column_name, n_reference, n_current, ks_statistic, ks_pvalue."""
    return spark.read.parquet(f"{sink_dir.rstrip('/')}/ks")


class LateRows(StreamingQueryListener):
    """Adds up the rows that watermarks drop, over the whole life of each query.

    ``query.recentProgress`` keeps only the last updates; a listener sees
    every one.  Register before the query starts:
    ``spark.streams.addListener(late := LateRows())``.
    """

    def __init__(self) -> None:
        self.total: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.total.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.total[str(p.id)] = self.total.get(str(p.id), 0) + sum(
            int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.total.get(str(query.id), 0)
