"""Distribution drift between a reference and a current frame: PSI and two-sample KS.

Plan shape (all features at once, never a loop of jobs per feature):

* stats  -- one aggregate over ``reference UNION ALL current`` gives per side
  and feature: count, min, max.  Edges of the 10 equal-width bins over the
  joint range are computed from those few numbers.
* bins   -- one more aggregate counts (side, feature, bin) with conditional
  counts; the bin index is a chain of 9 comparisons, so the last bin is
  closed on the right and a constant column lands in the last bin.
* KS     -- a fine histogram per side bounds the gap of both empirical CDFs in
  every bin.  Bins that can beat the largest gap seen at a bin's end are split
  and counted again, until few values are left to read, so D is exact though
  values are only counted.  The p-value is exact (lattice paths) up to 10000
  values per side; above it is that of the one-sample law at the effective
  size.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casaframe import schema
from casaframe.functions.exprs import is_numeric_type, to_double
from casaframe.operators import order_stats

SIDE_REF, SIDE_CUR = 0, 1
KS_BINS = 1024   # fine bins per feature for the bounds on the KS gap
KS_CELLS = 4096  # parts that one pass counts, over all features
LEAST_PARTS = 8  # into which an open bin is split at least
LOG_RATIO = 1024.0  # a cell whose ends differ more is split by logarithms
KS_FINISH = 4096  # open values that are read rather than split again
KS_KEEP = 8_000_000  # open values that are kept for later passes rather than read again
BULK = 0.001     # share of the values left out on either end of the fine bins' range


def numeric_columns(reference: DataFrame, current: DataFrame) -> list[str]:
    """Numeric columns of the reference that the current frame also has, in reference order."""
    cur = set(current.columns)
    return [f.name for f in reference.schema.fields
            if is_numeric_type(f.dataType) and f.name in cur]


def pooled(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Both samples as rows (side, column_name, value); side 0 = reference, 1 = current."""
    def proj(df: DataFrame, side: int) -> DataFrame:
        dtypes = {f.name: f.dataType for f in df.schema.fields}
        return order_stats.in_rows(df, {c: to_double(c, dtypes[c]) for c in columns},
                                   "column_name", "value", (F.lit(side).alias("side"),))
    return proj(reference, SIDE_REF).unionByName(proj(current, SIDE_CUR))


def require_finite(stats: dict[str, dict]) -> None:
    """A column with an infinite value has no bin edges: an error that names it."""
    bad = sorted(c for c, s in stats.items() if any(
        s[k] is not None and math.isinf(s[k]) for k in ("lo0", "lo1", "hi0", "hi1")))
    if bad:
        raise ValueError(f"infinite values in {', '.join(bad)}: drift bins need a finite range")


def side_stats(both: DataFrame, columns: list[str], bulk: bool = False,
               finite: bool = True) -> dict[str, dict]:
    """n / min / max per side and feature; with ``bulk`` also where its values mostly lie.

    ``both`` holds the rows of ``pooled``; the partial aggregate leaves at most
    2 x features rows per task, so the shuffle is tiny and the generated code
    stays small for wide frames.
    """
    extra = [F.percentile_approx("value", [BULK, 1 - BULK], 5000).alias("q")] if bulk else []
    rows = (both.groupBy("column_name", "side")
            .agg(F.count("value").alias("n"), F.min("value").alias("lo"),
                 F.max("value").alias("hi"), *extra)
            .collect())
    out = {c: {"n0": 0, "n1": 0, "lo0": None, "lo1": None, "hi0": None, "hi1": None}
           for c in columns}
    for r in rows:
        s, st = int(r["side"]), out[r["column_name"]]
        st.update({f"n{s}": int(r["n"]), f"lo{s}": r["lo"], f"hi{s}": r["hi"]})
        if bulk and r["q"] is not None:
            st["from"] = min(st.get("from", r["q"][0]), r["q"][0])
            st["to"] = max(st.get("to", r["q"][1]), r["q"][1])
    if finite:
        require_finite(out)
    return out


def bin_edges(lo: float, hi: float, bins: int = schema.PSI_BINS) -> list[float]:
    """Evenly spaced edges over [lo, hi]; the last edge is exactly ``hi``."""
    step = (hi - lo) / bins
    edges = [lo + i * step for i in range(bins)]
    return edges + [hi]


def bin_index(x: Column, edges: list) -> Column:
    """Bin of ``x`` for edges e0..eB (numbers or columns): the number of inner edges at or below x.

    Edges never decrease, so that count is the highest inner edge x reaches;
    a CASE chain from the top keeps the generated code small (a sum of
    casts per edge made the fused stage too large to be JIT-compiled).
    """
    inner = edges[1:-1]
    if not inner:
        return F.when(x.isNotNull(), F.lit(0))
    out = None
    for k in range(len(inner), 0, -1):
        cond = x >= F.lit(inner[k - 1])  # lit leaves a column as it is
        out = F.when(cond, F.lit(k)) if out is None else out.when(cond, F.lit(k))
    return out.otherwise(F.when(x.isNotNull(), F.lit(0)))


def with_bins(both: DataFrame, edges: dict[str, list[float]] | None = None,
              stats: dict[str, dict] | None = None) -> DataFrame:
    """The non-missing rows of ``pooled`` with their PSI bin (``bin``) and fine bin (``fine``).

    The edges come from a broadcast table of one row per feature and not from a
    CASE over all features, whose generated code grows too large to be compiled.
    Features in neither argument are left out; a bin not asked for is -1.
    """
    names = list(edges if edges is not None else stats)
    inner = max((len(e) - 2 for e in edges.values()), default=0) if edges else 0
    rows = []
    for c in names:
        start, stop, width = fine_range(stats[c]) if stats else (0.0, 0.0, 1.0)
        rows.append((c, start, stop, width, *(edges[c][1:-1] if edges else [])))
    table = both.sparkSession.createDataFrame(rows, "column_name string, " + ", ".join(
        f"{c} double" for c in ["start", "stop", "width", *[f"e{k}" for k in range(inner)]]))
    v = F.col("value")
    psi_bin, fine = F.lit(-1), F.lit(-1)
    if edges:
        psi_bin = bin_index(v, [None, *[F.col(f"e{k}") for k in range(inner)], None])
    if stats:
        fine = fine_bin(v, F.col("start"), F.col("stop"), F.col("width"))
    return (both.where(v.isNotNull()).join(F.broadcast(table), "column_name")
            .select("column_name", "side", "value", fine.alias("fine"), psi_bin.alias("bin")))


BINS_SCHEMA = "column_name string, bin int, reference_count bigint, current_count bigint"


def psi_bins(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
             bins: int = schema.PSI_BINS, stats: dict | None = None) -> DataFrame:
    """Long histogram: column_name, bin, reference_count, current_count (dense bins).

    Features with fewer than 2 values on a side are left out (their PSI is 0).
    """
    columns = numeric_columns(reference, current) if columns is None else columns
    both = pooled(reference, current, columns)
    stats = stats or side_stats(both, columns)
    usable = [c for c in columns if stats[c]["n0"] >= 2 and stats[c]["n1"] >= 2]
    spark = reference.sparkSession
    if not usable:
        return spark.createDataFrame([], BINS_SCHEMA)
    edges = {c: bin_edges(min(stats[c]["lo0"], stats[c]["lo1"]),
                          max(stats[c]["hi0"], stats[c]["hi1"]), bins) for c in usable}
    counts = (with_bins(both, edges)
              .groupBy("column_name", "bin")
              .agg(F.count_if(F.col("side") == SIDE_REF).alias("reference_count"),
                   F.count_if(F.col("side") == SIDE_CUR).alias("current_count")))
    # every (feature, bin) pair, so empty bins still count: features x bins rows
    grid = spark.createDataFrame([(c, k) for c in usable for k in range(bins)],
                                 "column_name string, bin int")
    return (grid.join(F.broadcast(counts), ["column_name", "bin"], "left")
            .select("column_name", "bin",
                    F.coalesce("reference_count", F.lit(0)).cast("bigint").alias("reference_count"),
                    F.coalesce("current_count", F.lit(0)).cast("bigint").alias("current_count")))


def psi_from_bins(bins_df: DataFrame, eps: float = schema.PSI_EPSILON) -> DataFrame:
    """PSI per feature: sum((q - p) * ln(q / p)) with eps added to every bin count."""
    per = Window.partitionBy("column_name")  # at most 10 rows per feature
    p = (F.col("reference_count") + eps) / F.sum(F.col("reference_count") + eps).over(per)
    q = (F.col("current_count") + eps) / F.sum(F.col("current_count") + eps).over(per)
    return (bins_df.select("column_name", ((q - p) * F.ln(q / p)).alias("term"))
            .groupBy("column_name").agg(F.sum("term").alias("psi")))


def psi(reference: DataFrame, current: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return psi_from_bins(psi_bins(reference, current, columns))


def ks_statistic(reference: DataFrame, current: DataFrame,
                 columns: list[str] | None = None) -> DataFrame:
    """column_name, n_reference, n_current, ks_statistic (D = max |F_ref - F_cur|).

    A feature without values on a side has a NULL statistic, one without any no row.
    """
    columns = numeric_columns(reference, current) if columns is None else columns
    both = pooled(reference, current, columns)
    stats = side_stats(both, columns, bulk=True, finite=False)
    found = ks_from_histogram(both, stats, histogram(both, stats),
                              only=lambda names: pooled(reference, current, names))
    return reference.sparkSession.createDataFrame(
        [(c, stats[c]["n0"], stats[c]["n1"], found.get(c)) for c in columns
         if stats[c]["n0"] + stats[c]["n1"]],
        "column_name string, n_reference bigint, n_current bigint, ks_statistic double")


def fine_range(stats: dict) -> tuple[float, float, float]:
    """Start, stop and width of a feature's fine bins; stop = start leaves two bins only."""
    start, stop = stats["from"], stats["to"]
    width = (stop - start) / KS_BINS
    if not (math.isfinite(width) and width > 0 and math.isfinite(KS_BINS / width)):
        return start, start, 1.0
    return start, stop, width


def fine_bin(x: Column, start: Column, stop: Column, width: Column) -> Column:
    """Bin of ``x``: 0 below ``start``, KS_BINS + 1 from ``stop`` on, equal widths between.

    It never falls as x rises, which is all that the bounds need.
    """
    inner = 1 + F.floor((x - start) / width).cast("int")
    return (F.when(x < start, F.lit(0)).when(x >= stop, F.lit(KS_BINS + 1))
            .otherwise(F.least(inner, F.lit(KS_BINS + 1))))


def _filled(stats: dict[str, dict]) -> dict[str, dict]:
    return {c: s for c, s in stats.items() if "from" in s}


def histogram(both: DataFrame, stats: dict[str, dict],
              edges: dict[str, list[float]] | None = None) -> list:
    """Rows (column_name, fine, bin, n_ref, n_cur, lo, hi), ascending; ``bin`` is the PSI bin.

    One aggregate; at most features x (KS_BINS + PSI bins + 2) rows reach the driver.
    """
    rows = (with_bins(both, edges, _filled(stats))
            .groupBy("column_name", "fine", "bin")
            .agg(F.count_if(F.col("side") == SIDE_REF).alias("n_ref"),
                 F.count_if(F.col("side") == SIDE_CUR).alias("n_cur"),
                 F.min("value").alias("lo"), F.max("value").alias("hi"))
            .collect())
    return sorted(rows, key=lambda r: (r["column_name"], r["fine"], r["bin"]))


def psi_bins_of(spark, hist: list, usable: list[str], bins: int = schema.PSI_BINS) -> DataFrame:
    """Dense PSI histogram (as of ``psi_bins``) from the rows of ``histogram``."""
    found = {(c, k): [0, 0] for c in usable for k in range(bins)}
    for r in hist:
        cell = found.get((r["column_name"], r["bin"]))
        if cell is not None:
            cell[0] += r["n_ref"]
            cell[1] += r["n_cur"]
    return spark.createDataFrame([(c, k, a, b) for (c, k), (a, b) in found.items()], BINS_SCHEMA)


@dataclass
class Cell:
    """A range of one feature's values, [lo, hi], that may hold a larger gap than any seen."""

    column: str
    lo: float
    hi: float
    key: tuple      # how its rows are found: (fine, bin), later (cell, part)
    a: int          # reference values below it
    b: int          # current values below it
    n: int          # values in it
    bound: float


class Gaps:
    """The largest gap of both distribution functions seen per feature, and what is still open."""

    def __init__(self, stats: dict[str, dict]):
        self.n = {c: (s["n0"], s["n1"]) for c, s in stats.items() if s["n0"] and s["n1"]}
        self.best = dict.fromkeys(self.n, 0.0)
        self.inside: list[Cell] = []

    def see(self, c: str, a: int, b: int) -> None:
        n0, n1 = self.n[c]
        self.best[c] = max(self.best[c], abs(a / n0 - b / n1))

    def part(self, c: str, key: tuple, a: int, b: int, n_ref: int, n_cur: int, lo: float,
             hi: float) -> tuple[int, int]:
        """Takes in a range with the counts below and in it; returns the counts up to its end.

        Between two values both functions stand between their counts before and
        after the range, which bounds the gap inside; one value has no inside.
        """
        n0, n1 = self.n[c]
        after_a, after_b = a + n_ref, b + n_cur
        self.see(c, after_a, after_b)
        if lo < hi:
            self.inside.append(Cell(c, lo, hi, key, a, b, n_ref + n_cur,
                                    max(after_a / n0 - b / n1, after_b / n1 - a / n0)))
        return after_a, after_b

    def open(self) -> list[Cell]:
        found = [x for x in self.inside if x.bound > self.best[x.column]]
        self.inside = []
        return found


def _split(cell: Cell, parts: int) -> tuple[float | None, float, float, float | None]:
    """(sign, base, width, cut): how a cell is cut into parts.

    Equal widths of the value, or of its logarithm (``sign`` set) where the
    values span orders of magnitude, so passes stay few for any distribution;
    a cut in two around zero, and where doubles are too coarse for parts.
    """
    lo, hi = cell.lo, cell.hi
    if lo < 0 <= hi:
        return None, 0.0, 1.0, 0.0
    if lo == 0:
        return None, 0.0, 1.0, math.ulp(0.0)
    sign = 1.0 if lo > 0 else -1.0
    if max(abs(lo), abs(hi)) > LOG_RATIO * min(abs(lo), abs(hi)):
        base = sign * math.log(sign * lo)
        return sign, base, (sign * math.log(sign * hi) - base) / parts, None
    width = (hi - lo) / parts
    if width > 0 and lo + width > lo:
        return None, lo, width, None
    mid = lo / 2 + hi / 2
    return None, 0.0, 1.0, mid if lo < mid <= hi else hi


def _part(parts: int) -> Column:
    """The part of ``value`` in its cell; it never falls as the value rises."""
    v, sign = F.col("value"), F.col("sign")
    u = F.when(sign.isNull(), v).otherwise(sign * F.ln(sign * v))
    by_width = F.greatest(F.lit(0), F.least(F.floor((u - F.col("base")) / F.col("width")),
                                            F.lit(parts - 1)))
    return F.when(F.col("cut").isNotNull(), (v >= F.col("cut")).cast("int")).otherwise(
        by_width.cast("int"))


def ks_from_histogram(both: DataFrame, stats: dict[str, dict], hist: list,
                      edges: dict[str, list[float]] | None = None,
                      trace: list[dict] | None = None,
                      only: Callable[[list[str]], DataFrame] | None = None) -> dict[str, float]:
    """D per feature by branch and bound; ``edges`` must be those of ``histogram``.

    Bins that may hold a larger gap than the largest seen are split again, and
    their parts counted in one more aggregate over the rows found through a
    chain of broadcast lookups (a row per open bin).  Every pass shrinks what
    is open, until at most KS_FINISH values are left to read.  No value is
    ordered or moved but these.  ``trace`` gets a record per pass.

    ``only`` gives the rows of ``pooled`` for some of its columns: features
    that the histogram settles are not read again.  Open values that are
    KS_KEEP or fewer are kept on the executors for the passes after.
    """
    gaps = Gaps(stats)
    done = dict.fromkeys(gaps.n, (0, 0))
    for r in hist:
        c = r["column_name"]
        if c in done:
            done[c] = gaps.part(c, (r["fine"], r["bin"]), *done[c], r["n_ref"], r["n_cur"], r["lo"], r["hi"])
    cells = gaps.open()
    spark, rows, on = both.sparkSession, None, ["column_name", "fine", "bin"]
    sides = (F.count_if(F.col("side") == SIDE_REF).alias("n_ref"),
             F.count_if(F.col("side") == SIDE_CUR).alias("n_cur"))
    kept = None
    try:
        while cells:
            left, parts = sum(x.n for x in cells), max(LEAST_PARTS, min(KS_BINS, KS_CELLS // len(cells)))
            table = spark.createDataFrame(
                [(*((x.column,) if rows is None else ()), *x.key, i, *_split(x, parts))
                 for i, x in enumerate(cells)],
                ("column_name string, fine int, bin int, " if rows is None else "cell int, part int, ")
                + "next int, sign double, base double, width double, cut double")
            if rows is None:
                names = {x.column for x in cells}
                source = with_bins(only([c for c in stats if c in names]) if only else both, *(
                    x and {c: v for c, v in x.items() if c in names} for x in (edges, _filled(stats))))
            else:
                source = rows
            rows = source.join(F.broadcast(table), on).select(  # a row per open bin: bounded
                F.col("next").alias("cell"), "side", "value", _part(parts).alias("part"))
            on = ["cell", "part"]
            if KS_FINISH < left <= KS_KEEP and kept is None:
                kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
            if trace is not None:
                trace.append({"values": left, "cells": len(cells), "finish": left <= KS_FINISH})
            if left <= KS_FINISH:
                for c, a, b in _walk(cells, rows.groupBy("cell", "value").agg(*sides).collect()):
                    gaps.see(c, a, b)
                break
            found = rows.groupBy("cell", "part").agg(
                *sides, F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
            at = {}
            for r in sorted(found, key=lambda r: (r["cell"], r["part"])):
                x = cells[r["cell"]]
                at[r["cell"]] = gaps.part(x.column, (r["cell"], r["part"]), *at.get(r["cell"], (x.a, x.b)),
                                          r["n_ref"], r["n_cur"], r["lo"], r["hi"])
            cells = gaps.open()
    finally:
        if kept is not None:
            kept.unpersist()
    return gaps.best


def _walk(cells: list[Cell], values: list):
    """(column, reference values, current values) up to and with each of the read values."""
    at = {}
    for r in sorted(values, key=lambda r: (r["cell"], r["value"])):
        x = cells[r["cell"]]
        a, b = at.get(r["cell"], (x.a, x.b))
        at[r["cell"]] = a + r["n_ref"], b + r["n_cur"]
        yield x.column, *at[r["cell"]]


# ------------------------------------------------------------------ p-values

def kolmogorov_sf(z: Column, terms: int = 100) -> Column:
    """P(K > z) of the Kolmogorov distribution, as a JVM expression.

    The alternating series converges fast for z >= 1; below that the Jacobi
    theta form of the CDF is used instead.
    """
    ks = F.sequence(F.lit(1), F.lit(terms))
    big = F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
                      * F.exp(-2.0 * k * k * z * z)) * 2.0
    small_cdf = F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + F.exp(
        -((2 * k - 1) * (2 * k - 1)) * (math.pi ** 2) / (8.0 * z * z))) * (math.sqrt(2 * math.pi) / z)
    raw = F.when(z <= 0, F.lit(1.0)).when(z < 1.0, 1.0 - small_cdf).otherwise(big)
    return F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0))


LOG_NEGLIGIBLE = -45.0  # shares of paths below exp(-45) = 3e-20 do not change a double near 1
WALK_STEPS = 4096    # steps of the lattice walk whose bounds are computed at once
FINITE_MAX_N = 2000  # effective size up to which the one-sample law is summed exactly


def one_sample_sf(n: int, d: float) -> float:
    """P(D_n >= d) of the one-sample statistic: the power of a banded matrix.

    The CDF is n! / n^n times an entry of H^n, with H of size 2 k - 1 and
    k = ceil(n d); the power is taken by squaring, rescaled on the way.
    """
    if n < 1 or not 0.0 < d < 1.0:
        return 1.0 if d <= 0.0 or n < 1 else 0.0
    if n * d * d > 18.0:  # far below any double the report shows
        return float(min(1.0, 2.0 * math.exp(-2.0 * n * d * d)))
    k = int(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    row, col = np.indices((m, m))
    band = np.where(row - col + 1 >= 0, 1.0, 0.0)
    edge = h ** np.arange(1, m + 1)
    band[:, 0] -= edge
    band[m - 1, :] -= edge[::-1]
    if 2 * h - 1 > 0:
        band[m - 1, 0] += (2 * h - 1) ** m
    fact = np.array([math.lgamma(max(i, 0) + 1) for i in range(m + 1)])
    band *= np.exp(-fact[np.maximum(row - col + 1, 0)])
    out, scale, power, shift, e = np.eye(m), 0.0, band, 0.0, n
    while e:
        if e & 1:
            out, scale = out @ power, scale + shift
            top = out.max()
            out, scale = out / top, scale + math.log(top)
        power, shift = power @ power, 2 * shift
        top = power.max()
        power, shift = power / top, shift + math.log(top)
        e >>= 1
    mid = out[k - 1, k - 1]
    cdf = math.exp(scale + math.lgamma(n + 1) - n * math.log(n) + math.log(mid)) if mid > 0 else 0.0
    return float(min(max(1.0 - cdf, 0.0), 1.0))


@F.pandas_udf(T.DoubleType())
def _one_sample_udf(n: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) or pd.isna(k) else one_sample_sf(int(k), float(x))
                      for k, x in zip(n, d)], dtype="float64")


def ks_asymptotic_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """The one-sample law at the rounded effective size n1 n2 / (n1 + n2).

    Summed exactly up to FINITE_MAX_N; above, the limit law at an argument
    corrected for the size, whose error is below 1e-5 there.
    """
    en = F.bround(n1.cast("double") * n2.cast("double") / (n1 + n2).cast("double"), 0)
    z = d * F.sqrt(en)
    corrected = F.when(z > 0, z + 1.0 / (6.0 * F.sqrt(en)) + (z - 1.0) / (4.0 * en)).otherwise(0.0)
    # Spark calls a Python function for every row, whatever the condition around it:
    # rows of the other branch go in as NULL
    small = en <= FINITE_MAX_N
    exact = _one_sample_udf(F.when(small, en), F.when(small, d))
    return F.when(small, exact).when(d.isNotNull(), kolmogorov_sf(corrected))


def ks_exact_pvalue(n1: int, n2: int, d: float) -> float:
    """Two-sided exact p-value: share of lattice paths that leave the band |i/n1 - j/n2| < d.

    Walks the anti-diagonals of the (n1+1) x (n2+1) grid keeping, per point
    inside the band, the probability that a uniformly random path reaches it
    inside the band.  i counts the smaller sample (the law is symmetric).

    A path is at i after s steps by the hypergeometric law, so by Hoeffding's
    bound it strays t from its mean with probability exp(-2 t^2 / n1) at most;
    a band that all paths but a share below double precision stay in is not
    walked, and one that is walked has at most some ten times sqrt(n1) points.
    """
    n1, n2 = sorted((int(n1), int(n2)))
    steps = n1 + n2
    g = math.gcd(n1, n2)
    lcm = (n1 // g) * n2
    h = int(round(d * lcm))
    if h == 0:
        return 1.0
    a, b = lcm // n1, lcm // n2
    half = h / (a + b)  # half the band's width in i
    if math.log(2 * steps) - 2.0 * half * half / n1 < LOG_NEGLIGIBLE:
        return 0.0
    at = np.zeros(n1 + 2)  # the point i is at[i + 1]; zero outside the band
    at[1] = 1.0
    idx, low = np.arange(n1 + 1, dtype="float64"), 0
    for start in range(1, steps + 1, WALK_STEPS):
        s = np.arange(start, min(start + WALK_STEPS, steps + 1))
        los = np.maximum(np.maximum(s - n2, 0), (s * b - h) // (a + b) + 1)
        his = np.minimum(np.minimum(s, n1), -((-s * b - h) // (a + b)) - 1)
        # no point of a diagonal is inside, or none that paths still reach by any share worth a digit
        if (los > his).any() or at.max() < math.exp(LOG_NEGLIGIBLE):
            return 1.0
        for k, lo, hi in zip(s.tolist(), los.tolist(), his.tolist()):
            here = at[lo + 1:hi + 2]
            moved = at[lo:hi + 1] - here  # (before * i + here * (k - i)) / k
            moved *= idx[lo:hi + 1]
            moved /= k
            here += moved
            if lo > low:
                at[lo] = 0.0
                low = lo
    return float(min(max(1.0 - at[n1 + 1], 0.0), 1.0))


@F.pandas_udf(T.DoubleType())
def _exact_pvalue_udf(n1: pd.Series, n2: pd.Series, d: pd.Series) -> pd.Series:
    out = []
    for a, b, x in zip(n1, n2, d):
        if pd.isna(x) or min(a, b) < 1:
            out.append(None)
        else:
            out.append(ks_exact_pvalue(int(a), int(b), float(x)))
    return pd.Series(out, dtype="float64")


def ks_pvalue(n1: Column, n2: Column, d: Column, method: str = "auto") -> Column:
    """p-value: exact up to 10000 values per side (``auto``), else by the one-sample law.

    ``method="exact"`` walks the lattice at any size: n1 + n2 steps of at most some
    ten times the root of the smaller size points.
    """
    asym = ks_asymptotic_pvalue(d, n1, n2)
    if method == "asymp":
        return asym
    exact = _exact_pvalue_udf(n1, n2, d)
    if method == "exact":
        return exact
    small = F.greatest(n1, n2) <= schema.KS_EXACT_MAX_N
    exact = _exact_pvalue_udf(F.when(small, n1), F.when(small, n2), F.when(small, d))
    return F.when(small, exact).otherwise(asym)


def ks_test(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
            method: str = "auto") -> DataFrame:
    ks = ks_statistic(reference, current, columns)
    return ks.withColumn("ks_pvalue", ks_pvalue(F.col("n_reference"), F.col("n_current"),
                                                F.col("ks_statistic"), method))


# ------------------------------------------------------------------ report

FEATURES_SCHEMA = ("column_name string, n_reference bigint, n_current bigint, psi double, "
                   "ks_statistic double, ks_pvalue double, drifted boolean")


def drift_features(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
                   psi_limit: float = schema.PSI_LIMIT, p_limit: float = schema.KS_P_LIMIT,
                   method: str = "auto") -> DataFrame:
    """Per feature: counts, PSI and KS p-value (rounded to 6), drift flag on unrounded values.

    A feature with fewer than 2 values on a side reports PSI 0, p 1, no drift.
    """
    columns = numeric_columns(reference, current) if columns is None else columns
    spark = reference.sparkSession
    if not columns:
        return spark.createDataFrame([], FEATURES_SCHEMA)
    both = pooled(reference, current, columns)
    stats = side_stats(both, columns, bulk=True)
    names = spark.createDataFrame(
        [(c, int(stats[c]["n0"]), int(stats[c]["n1"])) for c in columns],
        "column_name string, n_reference bigint, n_current bigint")
    usable = [c for c in columns if stats[c]["n0"] >= 2 and stats[c]["n1"] >= 2]
    if usable:
        edges = {c: bin_edges(min(stats[c]["lo0"], stats[c]["lo1"]),
                              max(stats[c]["hi0"], stats[c]["hi1"])) for c in usable}
        both = both.where(F.col("column_name").isin(usable))
        hist = histogram(both, {c: stats[c] for c in usable}, edges)
        psi_df = psi_from_bins(psi_bins_of(spark, hist, usable))
        found = ks_from_histogram(both, {c: stats[c] for c in usable}, hist, edges,
                                  only=lambda names: pooled(reference, current, names))
        ks_df = spark.createDataFrame([(c, found[c]) for c in usable],
                                      "column_name string, ks_statistic double")
        scores = psi_df.join(ks_df, "column_name")
    else:
        scores = spark.createDataFrame([], "column_name string, psi double, ks_statistic double")
    # names and scores have one row per feature: a bounded, tiny join.
    joined = (names.join(F.broadcast(scores), "column_name", "left")
              .withColumnsRenamed({"psi": "_psi", "ks_statistic": "_d"}))
    # Features that take the exact p-value (each up to 10000 x 10000 lattice
    # steps) are known from the counts; spread them over tasks when several do.
    exact = [c for c in usable if max(stats[c]["n0"], stats[c]["n1"]) <= schema.KS_EXACT_MAX_N]
    if method != "asymp" and len(exact) > 1:
        joined = joined.repartition(min(len(exact), 64), "column_name")
    # unrounded scores get their own names so the rounded outputs cannot shadow them
    scored = joined.withColumn(
        "_p", ks_pvalue(F.col("n_reference"), F.col("n_current"), F.col("_d"), method))
    ok = F.col("_psi").isNotNull()
    return scored.select(
        "column_name", "n_reference", "n_current",
        F.when(ok, F.round("_psi", 6)).otherwise(F.lit(0.0)).alias("psi"),
        F.when(ok, F.round("_d", 6)).alias("ks_statistic"),
        F.when(ok, F.round("_p", 6)).otherwise(F.lit(1.0)).alias("ks_pvalue"),
        F.when(ok, (F.col("_psi") > psi_limit) | (F.col("_p") < p_limit)).otherwise(F.lit(False))
        .alias("drifted"),
    )


def drift_report(features: DataFrame, threshold: float = schema.DRIFT_SHARE_THRESHOLD) -> DataFrame:
    """One row: dataset_drift, drift_share (rounded to 4), n_features, n_drifted."""
    agg = features.agg(F.count(F.lit(1)).alias("n_features"),
                       F.count_if("drifted").alias("n_drifted"))
    share = F.col("n_drifted") / F.greatest(F.col("n_features"), F.lit(1))
    return agg.select(
        (share >= threshold).alias("dataset_drift"),
        F.round(share, 4).alias("drift_share"),
        F.col("n_features").cast("bigint").alias("n_features"),
        F.col("n_drifted").cast("bigint").alias("n_drifted"),
    )


# --- fixed values: the fields are the keys of the report's JSON
@dataclass
class DriftReport:
    dataset_drift: bool
    drift_share: float
    psi_scores: dict
    ks_pvalues: dict
    per_feature_drift: dict


def detect_drift(reference: DataFrame, current: DataFrame,
                 threshold: float = schema.DRIFT_SHARE_THRESHOLD) -> DriftReport:
    """The report as a plain record (bounded: one entry per feature)."""
    feats = drift_features(reference, current).collect()
    n = len(feats)
    drifted = sum(1 for r in feats if r["drifted"])
    share = drifted / max(n, 1)
    return DriftReport(
        dataset_drift=share >= threshold,
        drift_share=round(share, 4),
        psi_scores={r["column_name"]: r["psi"] for r in feats},
        ks_pvalues={r["column_name"]: r["ks_pvalue"] for r in feats},
        per_feature_drift={r["column_name"]: bool(r["drifted"]) for r in feats},
    )


def save_drift_report(report: DriftReport, output_dir: str, spark) -> str:
    """Append the report, with its time and name, to the JSON dataset in ``output_dir``."""
    from datetime import datetime, timezone

    now = datetime.now(timezone.utc)
    name = now.strftime("drift_report_%Y%m%d_%H%M%S.json")
    body = json.dumps({**asdict(report), "report_ts": now.isoformat(), "report_name": name})
    spark.createDataFrame([(body,)], "json string").coalesce(1).write.mode("append").text(output_dir)
    return f"{output_dir.rstrip('/')}/{name}"
