"""Line dedup by distinct-site spread: boilerplate that many sites share goes.

Every line of every document is hashed (128 bits of its trimmed text); per
line hash a HyperLogLog sketch of the sites that hold it is built in each
task and merged by the aggregation, beside the line's first occurrence.
Lines whose estimate lies well above the threshold are boilerplate; lines
near it get an exact distinct count.  A boilerplate line is removed wherever
it stands but at its first occurrence (least doc_id, then line number), so
that text is never lost altogether and one copy of a widely copied document
stays whole.

What is joined back are line hashes and positions; texts move at most once,
in the last join, and not at all while the removals are few enough to be
broadcast.  A line that stands in a third of the documents is summed up
before its hash is shuffled.

Defined results: null texts stay null, empty ones empty; lines shorter than
``min_chars`` are left alone; a null site counts as no site; rows repeated
in full are treated alike (a first occurrence in them stays in each); null
ids sort first; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casaframe.llm.common import MAX_BROADCAST_ROWS, join_small, written

SITES = 8            # distinct sites that make a line boilerplate
MIN_CHARS = 16       # shorter lines are too common by chance
LG_K = 12            # sketch size: 2**12 buckets, relative error 1.6 %
MARGIN = 0.1         # estimates this near to the threshold are counted exactly


def _lines(docs: DataFrame, site: str, min_chars: int) -> DataFrame:
    """(doc_id, th, pos, site, h1, h2): the lines long enough to count."""
    line = F.trim("line")
    return (docs.select(F.col("doc_id"), F.xxhash64("text").alias("th"),
                        F.col(f"`{site}`").cast("string").alias("site"),
                        F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .where(F.char_length(line) >= min_chars)
            .select("doc_id", "th", "pos", "site", F.xxhash64(line).alias("h1"),
                    F.xxhash64(F.lit(1), line).alias("h2")))


def boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES,
                min_chars: int = MIN_CHARS, lg_k: int = LG_K, margin: float = MARGIN) -> DataFrame:
    """(h1, h2, first): hashes of lines on at least ``sites`` sites, first occurrence."""
    lines = _lines(docs, site, min_chars)
    slack = max(1, round(margin * sites))
    spread = written(
        lines.groupBy("h1", "h2").agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("estimate"),
            F.min(F.struct("doc_id", "pos")).alias("first"))
        .where(F.col("estimate") >= sites - slack), "line_spread")
    sure = spread.where(F.col("estimate") > sites + slack).select("h1", "h2", "first")
    near = spread.where(F.col("estimate") <= sites + slack).select("h1", "h2", "first")
    # exact: one row per line and site first, so a frequent line is summed up in each task
    exact = (join_small(lines.select("h1", "h2", "site"), near.select("h1", "h2"),
                        ["h1", "h2"], "left_semi")
             .where("site IS NOT NULL").groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
             .groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= sites))
    return written(sure.unionByName(near.join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi")),
                   "line_boilerplate")


def _mask(at: Column) -> Column:
    """Ascending line numbers as bytes, 1 at each of them and 0 before: a line is looked up at once."""
    gap = lambda x, i: x - F.coalesce(F.get(at, i - 1), F.lit(-1)) - 1
    steps = F.transform(at, lambda x, i: F.concat(F.repeat(F.lit("0"), gap(x, i)), F.lit("1")))
    return F.array_join(steps, "").cast("binary")


def dedup_lines(docs: DataFrame, *, site: str = "source", sites: int = SITES,
                min_chars: int = MIN_CHARS, removed: str = "n_removed") -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``; ``removed`` counts them.

    All columns are kept; a text that has lost every line is empty.
    """
    known = boilerplate(docs, site, sites, min_chars)
    hits = (join_small(_lines(docs, site, min_chars).select("doc_id", "th", "pos", "h1", "h2"),
                       known, ["h1", "h2"], "inner")
            .where(~F.struct("doc_id", "pos").eqNullSafe(F.col("first"))))
    drops = written(hits.groupBy(F.col("doc_id").alias("__cf_doc"), F.col("th").alias("__cf_th"))
                    .agg(F.sort_array(F.collect_set("pos")).alias("at"))
                    .select("__cf_doc", "__cf_th", F.size("at").alias("__cf_n"),
                            _mask(F.col("at")).alias("__cf_mask")), "line_drops")
    n, places = drops.agg(F.count("*"), F.sum(F.octet_length("__cf_mask") / 8)).first()
    if n <= MAX_BROADCAST_ROWS // 4 and (places or 0) <= MAX_BROADCAST_ROWS:
        drops = F.broadcast(drops)
    joined = docs.join(drops, F.col("doc_id").eqNullSafe(F.col("__cf_doc"))
                       & (F.xxhash64("text") == F.col("__cf_th")), "left")
    kept = F.filter(F.split("text", "\n"),
                    lambda _, i: F.substring(F.col("__cf_mask"), i + 1, F.lit(1)) != F.lit(b"1"))
    text = F.when(F.col("__cf_mask").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return (joined.withColumn(removed, F.coalesce("__cf_n", F.lit(0)).cast("long"))
            .withColumn("text", text)
            .select(*[F.col(f"`{c}`") for c in docs.columns], removed))
