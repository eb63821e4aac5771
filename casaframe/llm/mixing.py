"""Mixing sources to target weights by Poisson replication.

A source that holds b of all B bytes and shall hold the share w of the
mixture gets the mean repetition rate w * B / b.  Each document draws a
uniform number from a hash of the seed, its id and its text, inverts the
Poisson distribution of its source's rate with it, and is repeated that
often; the copies are dealt to partitions and ordered by a hash, which
shuffles them globally.  Draws depend on nothing but the row, so a task that
runs again, on any executor, makes the same copies.

Rates above ``SPLIT_RATE`` are drawn as sums of equal independent parts, so
no count is capped.  Rates by source come from one aggregate; the join is
broadcast only if the sources are few, and a source that holds a third of
the rows is summed up per task before its bytes are shuffled.

Defined results: documents without a source form a source of their own; a
null text counts 0 bytes, and a source without bytes has the rate 1; rows
repeated in full draw alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casaframe.llm.common import join_small, written

TEMPERATURE = 0.5    # target share of a source: its bytes to this power
SEED = 7
SPLIT_RATE = 16.0    # largest rate inverted in one piece
TERMS = 96           # terms of the distribution; beyond lies less than 1e-40 at SPLIT_RATE


def rates(docs: DataFrame, source: str = "source", text: str = "text",
          weights: Mapping[str, float] | None = None,
          temperature: float = TEMPERATURE) -> DataFrame:
    """(source, rate): mean repetitions that turn the sources' bytes into the target shares.

    ``weights`` gives target weights by source (others get 0); without it a
    source's weight is its bytes to the power ``temperature``.
    """
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0))
    each = docs.groupBy(F.col(source).alias("s")).agg(F.sum(size).cast("double").alias("b"))
    if weights is None:
        weight = F.when(F.col("b") > 0, F.pow("b", F.lit(temperature))).otherwise(0.0)
    else:
        table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        weight = F.coalesce(F.get(F.map_values(F.map_filter(table, lambda k, _: k == F.col("s"))), 0)
                            .cast("double"), F.lit(0.0))
    each = written(each.withColumn("w", weight), "mixing_sources")
    all_bytes, all_weights = each.agg(F.sum("b"), F.sum("w")).first()
    return each.select("s", F.when((F.col("b") > 0) & F.lit(bool(all_weights)), F.round(
        F.col("w") / F.lit(all_weights) * (F.lit(all_bytes) / F.col("b")), 9)).otherwise(1.0)
        .alias("rate"))


def uniform(*key: Column) -> Column:
    """A number in [0, 1) from the md5 of the key's text: 52 bits of it."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *key)), 1, 13), 16, 10).cast(
        "double") / F.lit(float(1 << 52))


def poisson_table(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... at a rate of at most SPLIT_RATE."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))
    step = lambda acc, k: F.struct(
        (acc["p"] * rate / k).alias("p"),
        F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + acc["p"] * rate / k)).alias("c"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda acc: acc["c"])


def mix_sources(docs: DataFrame, *, source: str = "source", text: str = "text",
                doc_id: str = "doc_id", weights: Mapping[str, float] | None = None,
                temperature: float = TEMPERATURE, seed: int = SEED,
                copy: str = "copy", copies: str = "copies", key: str = "shuffle_key") -> DataFrame:
    """Every document as often as drawn, in global random order.

    Adds ``copy`` (from 0), ``copies`` and ``key``, the place in the order.
    """
    s, part, parts, table = "__cf_s", "__cf_part", "__cf_parts", "__cf_table"
    per_source = (rates(docs, source, text, weights, temperature)
                  .withColumn(parts, F.greatest(F.lit(1), F.ceil(F.col("rate") / SPLIT_RATE)))
                  .select(F.col("s").alias(s), parts,
                          poisson_table(F.col("rate") / F.col(parts)).alias(table)))
    # the (null-safe) key as text: a prefix tells a null from the empty name
    marked = F.coalesce(F.concat(F.lit("="), F.col(s)), F.lit("-")).alias(s)
    per_source = per_source.select(marked, parts, table)
    own = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("-"))
    ident = [F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
             F.md5(F.coalesce(F.col(text), F.lit("")))]
    base = "__cf_ident"
    drawn = join_small(docs.withColumn(s, own), per_source, s, "left").withColumn(
        base, F.concat_ws(":", *ident))
    # the draws are an array of their own, so each is made once and not once per term
    draws = F.transform(F.sequence(F.lit(1).cast("long"), F.col(parts)),
                        lambda j: uniform(F.lit(str(seed)), j.cast("string"), F.col(base)))
    count = F.aggregate(draws, F.lit(0), lambda acc, u: acc + F.size(F.filter(
        F.col(table), lambda c: c <= u)))
    drawn = drawn.withColumn(copies, count).where(F.col(copies) > 0)
    out = (drawn.withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(copies) - 1)))
           .withColumn(key, F.md5(F.concat_ws(":", F.lit(f"order{seed}"),
                                              F.col(copy).cast("string"), F.col(base))))
           .drop(s, parts, table, base))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartition(n, key).sortWithinPartitions(key)
