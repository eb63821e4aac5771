"""Outlier report: z-score (modified z below 10 values) and IQR, all columns at once.

Pass 1 is one aggregate over the wide frame (count, mean, population std
per column).  Quartiles are exact, bracketed by counting passes (or a sketch
when ``approx=True``).  The last pass is one more aggregate counting every
rule for every column.  No values are shuffled, only counts; a handful of
numbers per column reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casaframe import schema
from casaframe.functions.exprs import qcol, to_double
from casaframe.operators import order_stats

REPORT_SCHEMA = T.StructType([
    T.StructField("column_name", T.StringType()),
    T.StructField("zscore_outliers", T.LongType()),
    T.StructField("iqr_outliers", T.LongType()),
    T.StructField("outliers", T.LongType()),
])


def _numeric_view(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    present = [c for c in columns if c in df.columns]
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    return df.select([to_double(c, dtypes[c]).alias(c) for c in present]), present


def column_moments(num: DataFrame, cols: list[str]) -> dict[str, tuple[int, float, float]]:
    """(non-missing count, mean, population std) per column in one pass."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(qcol(c)).alias(f"n{i}"), F.avg(qcol(c)).alias(f"m{i}"),
                 F.stddev_pop(qcol(c)).alias(f"s{i}")]
    row = num.agg(*aggs).first()
    return {c: (int(row[f"n{i}"]), row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def _small_medians(num: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Median and MAD for columns with fewer than 10 values (bounded exact aggregate)."""
    if not cols:
        return {}
    meds = num.agg(*[F.median(qcol(c)) for c in cols]).first()
    mads = num.agg(*[F.median(F.abs(qcol(c) - F.lit(m))) for c, m in zip(cols, meds)]).first()
    return {c: (med, mad) for c, med, mad in zip(cols, meds, mads)}


def outlier_stats(df: DataFrame, columns: list[str], approx: bool = False,
                  quartiles: bool = True) -> dict:
    """All per-column statistics the rules need, keyed by column.

    Without ``quartiles`` (the z-score rules need none) one aggregate is all.
    ``approx=True`` takes the quartiles from a sketch instead of exactly.
    """
    num, cols = _numeric_view(df, columns)
    if not cols:
        return {}
    moments = column_moments(num, cols)
    small = [c for c in cols if 0 < moments[c][0] < schema.MODIFIED_Z_MAX_N]
    medians = _small_medians(num, small)
    filled = [c for c in cols if moments[c][0] > 0]
    quart = {}
    if filled and quartiles:
        long = order_stats.long_values(num, filled)
        quart = (order_stats.approx_quantiles(long, [0.25, 0.75]) if approx else
                 order_stats.exact_quantiles(long, [0.25, 0.75], {c: moments[c][0] for c in filled}))
    stats = {}
    for c in cols:
        n, mean, std = moments[c]
        q1, q3 = quart.get(c, [None, None])
        med, mad = medians.get(c, (None, None))
        stats[c] = {"n": n, "mean": mean, "std": std, "q1": q1, "q3": q3,
                    "median": med, "mad": mad}
    return stats


def zscore_rule(x, st: dict):
    """Row predicate of the z-score family on value ``x``, or None when it yields 0."""
    n = st["n"]
    if n == 0:
        return None
    if n < schema.MODIFIED_Z_MAX_N:
        if not st["mad"]:
            return None
        mz = F.lit(schema.MODIFIED_Z_FACTOR) * (x - F.lit(st["median"])) / F.lit(st["mad"])
        return F.abs(mz) > schema.MODIFIED_Z_LIMIT
    if not st["std"]:
        return None
    return F.abs((x - F.lit(st["mean"])) / F.lit(st["std"])) > schema.ZSCORE_LIMIT


def iqr_rule(x, st: dict):
    """Row predicate outside the 1.5 x IQR fences, or None when IQR is 0."""
    if st["n"] == 0 or st["q1"] is None:
        return None
    iqr = st["q3"] - st["q1"]
    if iqr == 0:
        return None
    lower = st["q1"] - schema.IQR_FACTOR * iqr
    upper = st["q3"] + schema.IQR_FACTOR * iqr
    return (x < F.lit(lower)) | (x > F.lit(upper))


def outlier_report(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    """One row per existing column: z-score count, IQR count, max of the two."""
    spark = df.sparkSession
    num, cols = _numeric_view(df, columns)
    if not cols:
        return spark.createDataFrame([], REPORT_SCHEMA)
    stats = outlier_stats(df, cols, approx=approx)
    data = []
    aggs = []
    for i, c in enumerate(cols):
        z, q = zscore_rule(qcol(c), stats[c]), iqr_rule(qcol(c), stats[c])
        aggs.append((F.count_if(z) if z is not None else F.lit(0)).cast("bigint").alias(f"z{i}"))
        aggs.append((F.count_if(q) if q is not None else F.lit(0)).cast("bigint").alias(f"q{i}"))
    row = num.agg(*aggs).first()
    found = {c: (int(row[f"z{i}"]), int(row[f"q{i}"])) for i, c in enumerate(cols)}
    for c in cols:
        z, q = found[c]
        data.append((c, z, q, max(z, q)))
    return spark.createDataFrame(data, REPORT_SCHEMA)


def outlier_total(report: DataFrame) -> int:
    """Sum over columns of max(z-score count, IQR count)."""
    return int(report.agg(F.coalesce(F.sum("outliers"), F.lit(0))).first()[0])


def outlier_rows(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    """``df`` plus boolean flags ``<col>_zscore_outlier`` and ``<col>_iqr_outlier``.

    The statistics are a few literals per column, so flagging is a narrow
    projection with no shuffle and no join.
    """
    cols = [c for c in columns if c in df.columns]
    stats = outlier_stats(df, cols, approx=approx)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    flags = []
    for c in cols:
        x = to_double(c, dtypes[c])
        for name, rule in ((f"{c}_zscore_outlier", zscore_rule(x, stats[c])),
                           (f"{c}_iqr_outlier", iqr_rule(x, stats[c]))):
            flags.append((F.coalesce(rule, F.lit(False)) if rule is not None
                          else F.lit(False)).alias(name))
    return df.select("*", *flags)
