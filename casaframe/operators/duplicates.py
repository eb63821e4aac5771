"""Exact duplicate rows: report and row marks.

Equality is over all listed columns with missing equal to missing (Spark's
grouping already treats NULL = NULL, NaN = NaN and -0.0 = 0.0).  A group of
identical rows is combined map-side by the partial aggregate, so one hot
group never lands in one task.

Rows whose hash is unique are never shuffled whole: rows are first grouped
by a 64-bit hash, which moves only the hashes; only rows whose hash occurs
more than once are then grouped on their full columns.  A hash collision
merely adds a candidate, so the result stays exact.  Where the repeated
hashes are too many to broadcast, the join that finds their rows moves the
rows once; it is salted, so that a record that makes up a third of the data
is dealt to many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casaframe.functions.exprs import qcol

_ATOMIC = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
           T.TimestampNTZType, T.BinaryType)


def _row_hash(df: DataFrame, cols: list[str]) -> Column | None:
    """64-bit hash that agrees with grouping equality, or None for nested columns."""
    parts = []
    for c in cols:
        dt = df.schema[c].dataType
        if not isinstance(dt, _ATOMIC):
            return None
        # -0.0 + 0.0 = 0.0; NaN is hashed through its canonical bits
        parts.append(qcol(c) + F.lit(0.0) if isinstance(dt, (T.FloatType, T.DoubleType))
                     else qcol(c))
    return F.xxhash64(*parts)


def _hash_groups(df: DataFrame, cols: list[str]):
    """(rows with their hash, per-hash counts) or None for nested columns."""
    h = _row_hash(df, cols)
    if h is None:
        return None
    hashed = df.withColumn("_h", h)
    return hashed, hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))


SALTS = 32


def _repeated(hashed: DataFrame, shared: DataFrame) -> DataFrame:
    """Rows of ``hashed`` whose ``_h`` is in ``shared``; equal hashes are spread over SALTS tasks.

    The salt is the task's number: a task that runs again deals its rows the same way.
    """
    salted = hashed.withColumn("_salt", F.spark_partition_id().cast("bigint") % SALTS)
    spread = shared.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                             F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(spread, ["_h", "_salt"], "left_semi").drop("_salt")


def duplicate_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: total_rows, duplicate_rows (rows equal to an earlier row), duplicate_pct."""
    cols = columns or df.columns
    hg = _hash_groups(df, cols)
    if hg is None:
        groups = df.groupBy(*[qcol(c) for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
        parts = groups.agg(F.sum("_n").alias("t"), F.sum(F.col("_n") - 1).alias("d"))
    else:
        hashed, per_hash = hg
        shared = per_hash.where(F.col("_n") > 1).select("_h")
        # only rows whose hash repeats are grouped (and shuffled) on their full columns
        cand = _repeated(hashed, shared)
        exact = cand.groupBy(*[qcol(c) for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
        parts = (per_hash.agg(F.sum("_n").alias("t")).withColumn("d", F.lit(0).cast("bigint"))
                 .unionByName(exact.agg(F.sum(F.col("_n") - 1).alias("d"))
                              .withColumn("t", F.lit(0).cast("bigint"))))
    totals = parts.agg(F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("total_rows"),
                       F.coalesce(F.sum("d"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
    return totals.select(
        "total_rows", "duplicate_rows",
        F.when(F.col("total_rows") > 0,
               F.round(F.col("duplicate_rows") / F.col("total_rows") * 100, 2))
        .otherwise(F.lit(0.0)).alias("duplicate_pct"),
    )


def mark_duplicates(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """``df`` plus ``is_duplicate``: true for every row but the one with the smallest ``key``
    in its group of equal rows.  ``key`` must be present and unique; anything else is an error.

    Instead of a window over each group (a hot group would be one task), the
    first key of every group is found by aggregation, and only the keys of
    later copies are joined back on the unique key, which cannot be skewed.
    """
    cols = columns or [c for c in df.columns if c != key]
    bad = df.groupBy(qcol(key).alias("k")).count().where("k IS NULL OR count > 1")
    if not bad.isEmpty():
        raise ValueError(f"{key} is missing or repeated in some rows; duplicates need a unique key")
    return _mark(df, [key], cols)


def _mark(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """``is_duplicate`` for all rows but the one with the smallest ``keys`` of each group."""
    hg = _hash_groups(df, cols)
    if hg is None:
        cand = df
    else:
        hashed, per_hash = hg
        cand = _repeated(hashed, per_hash.where(F.col("_n") > 1).select("_h"))
    named = [qcol(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    on = [f"_k{i}" for i in range(len(keys))]
    firsts = (cand.groupBy(*[qcol(c) for c in cols]).agg(F.min(F.struct(*named)).alias("_first"))
              .select("_first.*"))
    later = cand.select(*named).join(firsts, on, "left_anti").withColumn("_dup", F.lit(True))
    same = [qcol(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    return (df.join(later, same, "left")
            .select(*[qcol(c) for c in df.columns],
                    F.coalesce(F.col("_dup"), F.lit(False)).alias("is_duplicate")))


FILE, ROW = "__file", "__row"


def mark_duplicates_in_order(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``table`` plus ``is_duplicate``: true for every row but the first of its group in file order.

    ``table`` is read from Parquet files as they are (filters and projections
    may follow the read, no shuffle).  A row's identity is its file's path and
    its place in the file, so no key is needed, and a task that runs again
    gives the same marks.  Written files are named in the order of their tasks.
    """
    cols = columns or table.columns
    placed = table.select(*[qcol(c) for c in table.columns], F.col("_metadata.file_path").alias(FILE),
                          F.col("_metadata.row_index").alias(ROW))
    return _mark(placed, [FILE, ROW], cols).drop(FILE, ROW)
