"""Exact order statistics over long (feature, value) data without sorting it.

Quantiles (``exact_quantiles``): the wanted ranks are bracketed, not sorted for.

1. a quantile sketch per feature names values near each wanted rank;
2. one aggregate counts exactly how many values are below, at and between them,
   so every rank is either found or known to lie between two of them;
3. what lies between is narrowed again by a sketch of its own until it holds at
   most ``COLLECT_ROWS`` values, whose (value, count) rows are read.

The exact counts decide, so a poor sketch costs another pass and never a wrong
result; each pass leaves out at least the named values, as a rule 99.8 % of
the rest.  Nothing larger than sketches and counts is shuffled.

Running sums (``cumulative_counts``), for the few values of an empirical CDF
that must be ordered: distinct values are range-partitioned on (feature,
value) and written to the reliable checkpoint folder with their partition id,
so every later branch sees the same assignment even after a lost executor.
Totals per (partition, feature) -- ranges are contiguous, so at most
``partitions + features`` rows -- give offsets, broadcast back, and a window
within (partition, feature) adds up the rest.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casaframe.session import reliable_checkpoint

PART = "_range_part"
GRID = 1000              # sketched quantiles per gap and pass
SKETCH_ACCURACY = 5000   # rank error of the sketch: 1 / 5000 of its rows
COLLECT_ROWS = 4096      # a gap with at most this many values is read


def long_values(df: DataFrame, columns: list[str], value_exprs: dict | None = None,
                feature_col: str = "feature", value_col: str = "value") -> DataFrame:
    """Unpivot ``columns`` of ``df`` into (feature, value) double rows, NULLs dropped."""
    from casaframe.functions.exprs import to_double

    dtypes = {f.name: f.dataType for f in df.schema.fields}
    return in_rows(df, {c: (value_exprs or {}).get(c, to_double(c, dtypes[c])) for c in columns},
                   feature_col, value_col).where(F.col(value_col).isNotNull())


def in_rows(df: DataFrame, exprs: dict, feature_col: str, value_col: str,
            keep: tuple = ()) -> DataFrame:
    """One row per input row and expression: ``keep``, the expression's name, its value.

    Names are values here, so any column name will do (``unpivot`` parses them).
    """
    return df.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(c).alias(feature_col), e.alias(value_col)) for c, e in exprs.items()])))


def range_partitioned(counts: DataFrame, feature_col: str = "feature", value_col: str = "value",
                      num_partitions: int | None = None) -> DataFrame:
    """``counts`` range-partitioned on (feature, value) with its partition id, checkpointed.

    The result can feed several aggregates (and ``running_sums``) that all
    see the same rows and partition ids, from one pass over the input.
    """
    # Without an explicit count, AQE may merge neighbouring ranges after seeing
    # the real sizes; a merged partition is still one contiguous key range, and
    # the ids are read after that decision and then checkpointed.
    if num_partitions:
        ranged = counts.repartitionByRange(num_partitions, feature_col, value_col)
    else:
        ranged = counts.repartitionByRange(feature_col, value_col)
    return reliable_checkpoint(ranged.withColumn(PART, F.spark_partition_id()))


def cumulative_counts(counts: DataFrame, weights: list[str], feature_col: str = "feature",
                      value_col: str = "value", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``weights`` per feature in value order.

    ``counts`` must hold one row per (feature, value).  Output columns:
    feature, value, each weight, ``cum_<w>`` and ``total_<w>``.
    """
    ranged = range_partitioned(counts, feature_col, value_col, num_partitions)
    return running_sums(ranged, weights, feature_col, value_col)


def running_sums(ranged: DataFrame, weights: list[str], feature_col: str = "feature",
                 value_col: str = "value") -> DataFrame:
    """Running sums over the output of ``range_partitioned``."""
    per_part = ranged.groupBy(PART, feature_col).agg(*[F.sum(w).alias(w) for w in weights])
    before = Window.partitionBy(feature_col).orderBy(PART).rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(feature_col)
    offsets = per_part.select(
        PART, feature_col,
        *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"_off_{w}") for w in weights],
        *[F.sum(w).over(whole).alias(f"total_{w}") for w in weights],
    )
    # ranges are contiguous, so offsets has at most parts + features rows
    joined = ranged.join(F.broadcast(offsets), [PART, feature_col])
    running = Window.partitionBy(PART, feature_col).orderBy(value_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        feature_col, value_col, *weights,
        *[(F.sum(w).over(running) + F.col(f"_off_{w}")).alias(f"cum_{w}") for w in weights],
        *[F.col(f"total_{w}") for w in weights],
    )


def value_counts(long_df: DataFrame, feature_col: str = "feature",
                 value_col: str = "value") -> DataFrame:
    return long_df.groupBy(feature_col, value_col).agg(F.count(F.lit(1)).alias("n"))


def _positions(n: int, q: float) -> tuple[int, int, float]:
    pos = q * (n - 1)
    lo = math.floor(pos)
    return lo, min(lo + 1, n - 1), pos - lo


def _lerp(a: float, b: float, t: float) -> float:
    """Linear interpolation written the way numpy evaluates it."""
    diff = b - a
    return b - diff * (1 - t) if t >= 0.5 else a + diff * t


@dataclass
class _Gap:
    """Values of one feature strictly between ``lo`` and ``hi`` that hold wanted ranks."""

    feature: str
    lo: float | None
    hi: float | None
    below: int          # values of the feature before the gap
    rows: int           # values in the gap
    ranks: set[int]


def _case(choices) -> Column:
    """CASE over (condition, result) pairs, NULL otherwise."""
    out = None
    for cond, result in choices:
        out = F.when(cond, result) if out is None else out.when(cond, result)
    return out


def _in_gaps(long_df: DataFrame, gaps: list[_Gap], feature_col: str, value_col: str) -> DataFrame:
    """(gap, v): the values inside the gaps.

    The bounds come from a broadcast table of one row per gap (at most one per
    wanted rank) and not from a CASE over all features, whose generated code
    grows too large to be compiled.
    """
    table = long_df.sparkSession.createDataFrame(
        [(i, g.feature, g.lo, g.hi) for i, g in enumerate(gaps)],
        "gap int, f string, lo double, hi double")
    f, v = F.col(feature_col), F.col(value_col)
    inside = ((f == F.col("f")) & (F.col("lo").isNull() | (v > F.col("lo")))
              & (F.col("hi").isNull() | (v < F.col("hi"))))
    return (long_df.select(f, v).where(v.isNotNull()).join(F.broadcast(table), inside)
            .select("gap", v.alias("v")))


def _read(long_df: DataFrame, gaps: list[_Gap], found: dict, *cols: str) -> None:
    """Find the ranks of gaps with at most COLLECT_ROWS values by reading those."""
    rows = _in_gaps(long_df, gaps, *cols).groupBy("gap", "v").count().collect()
    per_gap: dict[int, list] = {}
    for i, v, n in rows:
        per_gap.setdefault(i, []).append((v, n))
    for i, g in enumerate(gaps):
        start = g.below
        for v, n in sorted(per_gap.get(i, [])):
            found.update({(g.feature, k): float(v) for k in g.ranks if start <= k < start + n})
            start += n


def _narrow(long_df: DataFrame, gaps: list[_Gap], found: dict, *cols: str) -> list[_Gap]:
    """Find ranks that fall on named values; return the smaller gaps of the others."""
    inside = _in_gaps(long_df, gaps, *cols)
    grid = [i / GRID for i in range(1, GRID)]
    near = {r[0]: r[1] for r in inside.groupBy("gap").agg(
        F.percentile_approx("v", grid, SKETCH_ACCURACY)).collect()}
    named: list[list[float]] = []
    for i, g in enumerate(gaps):
        at = {min(max(int((k - g.below + 0.5) / g.rows * GRID) + step, 0), GRID - 2)
              for k in g.ranks for step in (-2, -1, 0, 1)}
        named.append(sorted({float(near[i][j]) for j in at}))
    # cell 2 j lies before the j-th named value, cell 2 j + 1 is that value
    most = max(len(values) for values in named)
    table = long_df.sparkSession.createDataFrame(
        [(i, len(values), *values, *[None] * (most - len(values)))
         for i, values in enumerate(named)],
        "gap int, size int, " + ", ".join(f"p{j} double" for j in range(most)))
    cell = _case([c for j in range(most) for c in (
        (F.col("v") < F.col(f"p{j}"), F.lit(2 * j)), (F.col("v") == F.col(f"p{j}"), F.lit(2 * j + 1)))]
    ).otherwise(2 * F.col("size"))
    counted = {(r[0], r[1]): r[2] for r in inside.join(F.broadcast(table), "gap")
               .groupBy("gap", cell.alias("cell")).count().collect()}
    left = []
    for i, g in enumerate(gaps):
        edges = [g.lo, *named[i], g.hi]
        start = g.below
        for c in range(2 * len(named[i]) + 1):
            n = counted.get((i, c), 0)
            held = {k for k in g.ranks if start <= k < start + n}
            if held and c % 2:
                found.update({(g.feature, k): edges[c // 2 + 1] for k in held})
            elif held:
                left.append(_Gap(g.feature, edges[c // 2], edges[c // 2 + 1], start, n, held))
            start += n
    return left


def ranked_values(long_df: DataFrame, wanted: dict[str, set[int]], totals: dict[str, int],
                  feature_col: str = "feature", value_col: str = "value",
                  collect_rows: int | None = None) -> dict[tuple[str, int], float]:
    """The values at the wanted 0-based ranks, keyed by (feature, rank).

    ``long_df`` is read three times while a feature has up to about two million
    values, and twice more for every further factor of 500.
    """
    limit = COLLECT_ROWS if collect_rows is None else collect_rows
    found: dict[tuple[str, int], float] = {}
    gaps = [_Gap(f, None, None, 0, totals[f], set(ranks)) for f, ranks in wanted.items() if ranks]
    while gaps:
        small = [g for g in gaps if g.rows <= limit]
        if small:
            _read(long_df, small, found, feature_col, value_col)
        large = [g for g in gaps if g.rows > limit]
        gaps = _narrow(long_df, large, found, feature_col, value_col) if large else []
    return found


def exact_quantiles(long_df: DataFrame, probs: list[float], totals: dict[str, int] | None = None,
                    feature_col: str = "feature", value_col: str = "value",
                    collect_rows: int | None = None) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles per feature (numpy/pandas default)."""
    if totals is None:
        totals = {r[0]: int(r[1]) for r in
                  long_df.groupBy(feature_col).agg(F.count(value_col)).collect()}
    spots = {f: [_positions(n, q) for q in probs] if n > 0 else [] for f, n in totals.items()}
    wanted = {f: {k for lo, hi, _ in at for k in (lo, hi)} for f, at in spots.items()}
    found = ranked_values(long_df, wanted, totals, feature_col, value_col, collect_rows)
    lost = sorted(f"{k} of {f}" for f, ranks in wanted.items() for k in ranks if (f, k) not in found)
    if lost:
        raise RuntimeError(f"ranks not found, the input changed between passes: {lost[:5]}")
    return {f: [_lerp(found[(f, lo)], found[(f, hi)], t) for lo, hi, t in at] or [None] * len(probs)
            for f, at in spots.items()}


def approx_quantiles(long_df: DataFrame, probs: list[float], accuracy: int = 100000,
                     feature_col: str = "feature", value_col: str = "value") -> dict:
    """Bounded-memory quantiles (sketch) per feature, for very high cardinality."""
    rows = (long_df.groupBy(feature_col)
            .agg(F.percentile_approx(value_col, probs, accuracy).alias("q"))
            .collect())
    return {r[0]: [float(v) for v in r[1]] for r in rows}
