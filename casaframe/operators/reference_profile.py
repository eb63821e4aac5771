"""A stored profile of the reference: drift of new data without reading the reference again.

A profile is kept per part of the reference (a day, a region) and merges by
adding up, so a new or corrected part costs one pass over that part alone.
Per part and feature it holds

* a row of totals (``cell`` NULL): values, missing values, least, greatest and
  a KLL sketch, whose quantiles have a stated rank error (``RANK_ERROR``);
* a histogram over cells that do not depend on the data: a cell is a ratio of
  e^(1/2048) on either side of zero, and zero one of its own, with its number
  of values and their least and greatest.  Any two profiles have the same
  cells, so merged parts equal the profile of the whole exactly.

Against these ``drift_of`` compares a current frame.  The reference's values
are known up to their order inside a cell, so every score is a bracket that
surely holds the exact one: the KS gap is known at the ends of the cells and
bounded inside them; a PSI bin's count is uncertain only by the cell that its
edge cuts.  A cell of a single value leaves no doubt (whole numbers up to 2048
always, and the brackets then close to a point).  A feature is flagged or
cleared where both ends of the brackets agree; else ``drifted`` is NULL, and
``settle`` runs the exact test on those features alone.

A feature has at most six million cells whatever the table's size (doubles span
1,455 powers of e on either side), so a window over them is bounded.

Defined results: NULL and NaN count as missing; a NULL part is a part of its
own; an empty frame adds no part; infinite values raise and are named, as in
``operators.drift``.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casaframe import schema
from casaframe.functions.exprs import is_numeric_type, to_double
from casaframe.operators import drift, order_stats
from casaframe.session import reliable_checkpoint
from casaframe.sources.snapshots import _complete, commit, numbered, numbers, read_text

PER_E = 2048          # cells per factor e
SHIFT = PER_E * 750    # above any cell of a double: keeps the cells of positive values positive
OFFSET = 0.137        # moves the cells' ends off the powers of e and off round numbers
OUTSIDE = 1 << 30     # the cells of the infinities
SKETCH_K = 4096       # size of the KLL sketch
RANK_ERROR = 2.296 / SKETCH_K ** 0.9021  # published rank error of such a sketch at 99 %: 0.0013
PROFILE_SCHEMA = ("part string, column_name string, cell int, n bigint, n_missing bigint, "
                  "lo double, hi double, sketch binary")


def cell_of(x: Column) -> Column:
    """The cell of a value; it never falls as the value rises."""
    size = (F.floor(F.ln(F.abs(x)) * PER_E + OFFSET) + SHIFT).cast("int")
    return (F.when(x == 0, F.lit(0)).when(F.abs(x) == float("inf"), F.signum(x).cast("int") * OUTSIDE)
            .when(x > 0, size).otherwise(-size))


def _values(df: DataFrame, columns: list[str], part: Column) -> DataFrame:
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    return order_stats.in_rows(df, {c: to_double(c, dtypes[c]) for c in columns},
                               "column_name", "value", (part.cast("string").alias("part"),))


def _cells(values: DataFrame) -> DataFrame:
    return (values.where(F.col("value").isNotNull())
            .groupBy("part", "column_name", cell_of(F.col("value")).alias("cell"))
            .agg(F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")))


def profile_of(df: DataFrame, columns: list[str] | None = None, part: Column | None = None) -> DataFrame:
    """The profile of a frame, a set of rows per part and feature; two aggregates over the frame."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]
    values = _values(df, columns, F.lit("") if part is None else part)
    totals = values.groupBy("part", "column_name").agg(
        F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("sketch"))
    order = [c.split()[0] for c in PROFILE_SCHEMA.split(", ")]
    cells = _cells(values)
    return (totals.withColumn("cell", F.lit(None).cast("int"))
            .unionByName(cells, allowMissingColumns=True).select(*order))


def merge(profile: DataFrame) -> DataFrame:
    """All parts of a profile as one (``part`` empty): the profile of the whole."""
    totals = (profile.where(F.col("cell").isNull()).groupBy("column_name")
              .agg(F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"), F.min("lo").alias("lo"),
                   F.max("hi").alias("hi"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch")))
    cells = (profile.where(F.col("cell").isNotNull()).groupBy("column_name", "cell")
             .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    order = [c.split()[0] for c in PROFILE_SCHEMA.split(", ")]
    return (totals.withColumn("cell", F.lit(None).cast("int"))
            .unionByName(cells, allowMissingColumns=True)
            .withColumn("part", F.lit("")).select(*order))


# ------------------------------------------------------------------ storage

def add(profile: DataFrame, path: str) -> int:
    """Add the parts of a profile to a stored one; a part that is there already is replaced.

    A numbered record, created only if absent, names the written rows, and for
    every part the highest number counts: two writers at a time lose nothing,
    and a failed write leaves rows that nobody names.
    """
    spark, name = profile.sparkSession, uuid.uuid4().hex
    profile.withColumn("added", F.lit(name)).write.parquet(f"{path.rstrip('/')}/{name}")
    return commit(spark, f"{path.rstrip('/')}/_log", {"added": name})


def load(spark: SparkSession, path: str) -> DataFrame:
    """The stored profile, the newest rows of every part."""
    base = path.rstrip("/")
    log = {}
    for n in numbers(spark, f"{base}/_log"):
        got = _complete(read_text(spark, numbered(f"{base}/_log", n)))
        if got is not None:
            log[got["added"]] = n
    if not log:
        return spark.createDataFrame([], PROFILE_SCHEMA)
    rows = spark.read.parquet(*[f"{base}/{name}" for name in log])
    versions = spark.createDataFrame(list(log.items()), "added string, version int")
    rows = rows.join(F.broadcast(versions), "added").drop("added")  # one row per addition
    newest = rows.groupBy("part").agg(F.max("version").alias("newest")).withColumnRenamed("part", "of")
    return (rows.join(newest, F.col("part").eqNullSafe(F.col("of")) & (F.col("version") == F.col("newest")))
            .drop("version", "of", "newest"))


# ------------------------------------------------------------------ quantiles

def quantiles(profile: DataFrame, probs: list[float]) -> DataFrame:
    """column_name, prob, quantile: from the merged sketches, ranks right within RANK_ERROR."""
    totals = merge(profile).where(F.col("cell").isNull() & (F.col("n") > 0))
    return totals.select("column_name", F.inline(F.array(*[
        F.struct(F.lit(p).alias("prob"),
                 F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("quantile")) for p in probs])))


# ------------------------------------------------------------------ drift

VERDICT_SCHEMA = ("column_name string, n_reference bigint, n_current bigint, psi_low double, "
                  "psi_high double, ks_low double, ks_high double, pvalue_low double, "
                  "pvalue_high double, drifted boolean")


def _sides(cells: DataFrame, now: DataFrame) -> DataFrame:
    """One row per feature and cell: counts of both sides, their range, and that of the reference."""
    one = lambda df, side: df.select("column_name", "cell", "n", "lo", "hi", F.lit(side).alias("side"))
    ref = F.col("side") == drift.SIDE_REF
    return (one(cells, drift.SIDE_REF).unionByName(one(now, drift.SIDE_CUR))
            .groupBy("column_name", "cell")
            .agg(F.sum(F.when(ref, F.col("n")).otherwise(0)).alias("n_ref"),
                 F.sum(F.when(~ref, F.col("n")).otherwise(0)).alias("n_cur"),
                 F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                 F.min(F.when(ref, F.col("lo"))).alias("ref_lo"),
                 F.max(F.when(ref, F.col("hi"))).alias("ref_hi")))


def ks_bracket(both: DataFrame) -> DataFrame:
    """column_name, n_reference, n_current, ks_low, ks_high from the rows of ``_sides``."""
    upto = Window.partitionBy("column_name").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("column_name")  # at most six million cells
    n0, n1 = F.col("n_reference"), F.col("n_current")
    a, b = F.col("a"), F.col("b")
    gap = F.abs(F.try_divide(a, n0) - F.try_divide(b, n1))
    # inside a cell both functions stand between their counts before and after it
    inside = F.greatest(F.try_divide(a, n0) - F.try_divide(b - F.col("n_cur"), n1),
                        F.try_divide(b, n1) - F.try_divide(a - F.col("n_ref"), n0))
    return (both.withColumns({"a": F.sum("n_ref").over(upto), "b": F.sum("n_cur").over(upto),
                              "n_reference": F.sum("n_ref").over(whole),
                              "n_current": F.sum("n_cur").over(whole)})
            .groupBy("column_name", "n_reference", "n_current")
            .agg(F.max(gap).alias("ks_low"),
                 F.max(F.when(F.col("lo") < F.col("hi"), F.greatest(gap, inside)).otherwise(gap)).alias("ks_high")))


def reference_below(both: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """column_name, edge (1 .. bins - 1), low, top: reference values below an edge, at least and at most."""
    inner = [(c, k, e) for c, es in edges.items() for k, e in enumerate(es[1:-1], 1)]
    table = both.sparkSession.createDataFrame(inner, "column_name string, edge int, at double")
    held = both.where(F.col("n_ref") > 0).select("column_name", "n_ref", "ref_lo", "ref_hi")
    return (held.join(F.broadcast(table), "column_name")  # features x 9 rows
            .groupBy("column_name", "edge")
            .agg(F.sum(F.when(F.col("ref_hi") < F.col("at"), F.col("n_ref")).otherwise(0)).alias("low"),
                 F.sum(F.when(F.col("ref_lo") < F.col("at"), F.col("n_ref")).otherwise(0)).alias("top")))


def psi_bracket(below: DataFrame, now_bins: DataFrame, totals: DataFrame, bins: int,
                eps: float = schema.PSI_EPSILON) -> DataFrame:
    """column_name, psi_low, psi_high; ``now_bins`` has the current counts (column_name, bin, n).

    A bin's term (q - p) ln(q / p) is convex in p and 0 at p = q, so its range
    over the reference shares that are possible is found at their ends.
    """
    left = below.select("column_name", F.col("edge").alias("bin"), F.col("low").alias("low0"),
                        F.col("top").alias("top0"))
    right = below.select("column_name", (F.col("edge") - 1).alias("bin"), F.col("low").alias("low1"),
                         F.col("top").alias("top1"))
    n = F.col("n_reference")
    rows = (totals.select("column_name", "n_reference", "n_current",
                          F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
            .join(F.broadcast(left), ["column_name", "bin"], "left")      # features x bins rows each
            .join(F.broadcast(right), ["column_name", "bin"], "left")
            .join(F.broadcast(now_bins), ["column_name", "bin"], "left"))
    low0, top0 = F.coalesce("low0", F.lit(0)), F.coalesce("top0", F.lit(0))
    low1, top1 = F.coalesce("low1", n), F.coalesce("top1", n)
    share = lambda count, total: (count + eps) / (total + bins * eps)
    p0, p1 = share(F.greatest(low1 - top0, F.lit(0)), n), share(top1 - low0, n)
    q = share(F.coalesce("n", F.lit(0)), F.col("n_current"))
    term = lambda p: (q - p) * F.ln(q / p)
    least = F.when((p0 <= q) & (q <= p1), F.lit(0.0)).otherwise(F.least(term(p0), term(p1)))
    return rows.groupBy("column_name").agg(F.sum(least).alias("psi_low"),
                                           F.sum(F.greatest(term(p0), term(p1))).alias("psi_high"))


def drift_of(profile: DataFrame, current: DataFrame, columns: list[str] | None = None,
             psi_limit: float = schema.PSI_LIMIT, p_limit: float = schema.KS_P_LIMIT,
             bins: int = schema.PSI_BINS, method: str = "auto") -> DataFrame:
    """Per feature: brackets of PSI, KS and p-value, and the flag where they decide it.

    The current frame is read twice (its cells; its PSI bins, whose edges need
    the joint range), the reference not at all.  A feature with fewer than 2
    values on a side has PSI 0, p 1 and does not drift.
    """
    spark = current.sparkSession
    # a row per feature and cell; both branches below must see the same rows
    known = reliable_checkpoint(merge(profile))
    totals = {r["column_name"]: r for r in known.where(F.col("cell").isNull())
              .select("column_name", "n", "lo", "hi").collect()}
    if columns is None:
        columns = [f.name for f in current.schema.fields if is_numeric_type(f.dataType) and f.name in totals]
    absent = sorted(c for c in columns if c not in totals)
    if absent:
        raise ValueError(f"not in the profile: {', '.join(absent)}")
    if not columns:
        return spark.createDataFrame([], VERDICT_SCHEMA)
    values = _values(current, columns, F.lit(""))
    now = reliable_checkpoint(_cells(values))
    seen = {r["column_name"]: r for r in now.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}
    stats = {}
    for c in columns:
        r, s = totals[c], seen.get(c)
        stats[c] = {"n0": r["n"] or 0, "lo0": r["lo"], "hi0": r["hi"], "n1": s["n"] if s else 0,
                    "lo1": s["lo"] if s else None, "hi1": s["hi"] if s else None}
    drift.require_finite(stats)
    names = spark.createDataFrame([(c, s["n0"], s["n1"]) for c, s in stats.items()],
                                  "column_name string, n_reference bigint, n_current bigint")
    edges = {c: drift.bin_edges(min(s["lo0"], s["lo1"]), max(s["hi0"], s["hi1"]), bins)
             for c, s in stats.items() if s["n0"] >= 2 and s["n1"] >= 2}
    if not edges:
        scores = spark.createDataFrame([], "column_name string, psi_low double, psi_high double, "
                                           "ks_low double, ks_high double")
    else:
        both = _sides(known.where(F.col("cell").isNotNull()), now).where(F.col("column_name").isin(list(edges)))
        now_bins = (drift.with_bins(values.select("column_name", F.lit(drift.SIDE_CUR).alias("side"), "value"), edges)
                    .groupBy("column_name", "bin").agg(F.count("value").alias("n")))
        ks = ks_bracket(both)
        psi = psi_bracket(reference_below(both, edges), now_bins, ks, bins)
        scores = psi.join(ks.drop("n_reference", "n_current"), "column_name")
    joined = names.join(F.broadcast(scores), "column_name", "left")  # a row per feature
    n0, n1 = F.col("n_reference"), F.col("n_current")
    scored = joined.withColumns({
        "pvalue_low": drift.ks_pvalue(n0, n1, F.col("ks_high"), method),
        "pvalue_high": drift.ks_pvalue(n0, n1, F.col("ks_low"), method)})
    known_score = F.col("psi_low").isNotNull()
    sure = (F.col("psi_low") > psi_limit) | (F.col("pvalue_high") < p_limit)
    clear = (F.col("psi_high") <= psi_limit) & (F.col("pvalue_low") >= p_limit)
    return scored.select(
        "column_name", "n_reference", "n_current",
        F.coalesce("psi_low", F.lit(0.0)).alias("psi_low"), F.coalesce("psi_high", F.lit(0.0)).alias("psi_high"),
        "ks_low", "ks_high",
        F.when(known_score, F.col("pvalue_low")).otherwise(1.0).alias("pvalue_low"),
        F.when(known_score, F.col("pvalue_high")).otherwise(1.0).alias("pvalue_high"),
        F.when(~known_score, F.lit(False)).when(sure, F.lit(True)).when(clear, F.lit(False)).alias("drifted"))


def settle(verdicts: DataFrame, reference: DataFrame, current: DataFrame, **limits) -> DataFrame:
    """column_name, drifted: the undecided features judged by the exact test, which reads the reference."""
    verdicts = reliable_checkpoint(verdicts)  # a row per feature
    left = [r["column_name"] for r in verdicts.where(F.col("drifted").isNull()).select("column_name").collect()]
    done = verdicts.where(F.col("drifted").isNotNull()).select("column_name", "drifted")
    if not left:
        return done
    return done.unionByName(drift.drift_features(reference, current, sorted(left), **limits)
                            .select("column_name", "drifted"))


def frozen_bins(profile: DataFrame, columns: list[str], bins: int = schema.PSI_BINS) -> tuple[dict, dict]:
    """(edges, counts) of the reference's own PSI bins per feature, for a stream's frozen edges.

    The number of values below an edge is the sketch's rank, held within the
    bounds that the cells leave; it is exact where no cell is cut.
    """
    known = reliable_checkpoint(merge(profile).where(F.col("column_name").isin(columns)))
    totals = known.where(F.col("cell").isNull() & (F.col("n") > 0))
    stats = {r["column_name"]: r for r in totals.select("column_name", "n", "lo", "hi").collect()}
    drift.require_finite({c: {"lo0": r["lo"], "hi0": r["hi"], "lo1": None, "hi1": None} for c, r in stats.items()})
    edges = {c: drift.bin_edges(stats[c]["lo"], stats[c]["hi"], bins) for c in columns if c in stats}
    if not edges:
        return {}, {}
    cells = known.where(F.col("cell").isNotNull())
    both = cells.select("column_name", F.col("n").alias("n_ref"), F.col("lo").alias("ref_lo"),
                        F.col("hi").alias("ref_hi"))
    # the rank of the greatest double below an edge counts what is smaller than the edge
    at = {c: F.array(*[F.lit(math.nextafter(e, -math.inf)) for e in es[1:-1]]) for c, es in edges.items()}
    rank = F.coalesce(*[F.when(F.col("column_name") == c, F.kll_sketch_get_rank_double("sketch", points))
                        for c, points in at.items()])
    ranks = (totals.where(F.col("column_name").isin(list(edges)))
             .select("column_name", "n", F.posexplode(rank).alias("k", "rank"))
             .select("column_name", (F.col("k") + 1).alias("edge"),
                     F.round(F.col("rank") * F.col("n")).cast("long").alias("rank")))
    rows = reference_below(both, edges).join(ranks, ["column_name", "edge"]).select(
        "column_name", "edge",
        F.greatest("low", F.least("top", "rank")).alias("below")).collect()  # features x 9 rows
    below = {(r["column_name"], r["edge"]): r["below"] for r in rows}
    counts = {}
    for c in edges:
        upto = [0, *[below[c, k] for k in range(1, bins)], stats[c]["n"]]
        for k in range(1, bins + 1):
            upto[k] = max(upto[k], upto[k - 1])
        counts[c] = [b - a for a, b in zip(upto, upto[1:])]
    return edges, counts
