"""Sharding: a k-d tree over document metadata, split at weighted medians.

Documents with equal texts form one point, weighted with the bytes of all
its rows, so copies never part.  A node with several shards to fill is split
along the dimension that is widest in it, at the weighted quantile that
gives each side the bytes of its shards, until each leaf is one shard of the
target size.  Dimensions (text length, least id, source, language) are
scaled to the range they have in the whole table; a hash of the text breaks
ties, so any point can be split from any other.

Quantiles come from counting: every round adds up the weight by node and
bin, narrows each node's interval to the bin that holds its quantile and
goes on inside it, until the bin is under a thousandth of the node (or one
point).  A round moves nodes x bins sums, whatever the size of the table.

Slots are numbered in parts of about ``SLOT_ROWS`` rows, as many as the table
needs; rows that are equal in everything and more than that many are dealt
over parts of their own, which come after the others of their part, so no
other row's slot hangs on the deal.  The deal is drawn when the rows are
written, and is the same for every later reader of the table.

Defined results: null texts count as empty; null metadata count as 0 or as
the empty name; rows without an id have a place like any other; an empty
table gives no rows.  The law is ``bytes``: shards of nearly equal size, as
far as points can be divided at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casaframe.llm.common import join_small, written

SHARDS = 16
BINS = 64            # bins per node and round
TOLERANCE = 1e-3     # weight of the split bin, as a share of its node, that ends the search
ROUNDS = 8           # 64 ** 8 distinct places: as fine as a double
SLOT_ROWS = 50_000   # rows numbered by one task


def _metadata(docs: DataFrame) -> dict[str, Column]:
    """Numbers in no particular range, one per dimension."""
    place = lambda c: F.pmod(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit(""))),
                             F.lit(1 << 20)).cast("double")
    dims = {"length": F.log2(F.col("size").cast("double"))}
    if "doc_id" in docs.columns:
        number = F.try_to_number(F.col("doc_id").cast("string"), F.lit("S" + "9" * 19))
        dims["id"] = F.coalesce(number.cast("double"), F.lit(0.0))
    for c in ("source", "lang"):
        if c in docs.columns:
            dims[c] = place(c)
    return dims


def points(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """(text_key, bytes, tie, d0, d1, ...): one row per distinct text, scaled to [0, 1]."""
    sized = docs.withColumn("size", F.octet_length("text").cast("long") + 1)
    dims = _metadata(docs)
    grouped = sized.select("text_key", "size", *[c.alias(f"d_{k}") for k, c in dims.items()]).groupBy(
        "text_key").agg(F.sum("size").alias("bytes"),
                        *[F.min(f"d_{k}").alias(f"d_{k}") for k in dims])
    names = [f"d_{k}" for k in dims]
    grouped = written(grouped, "sharding_points")
    lim = grouped.agg(*[f(c).alias(f"{n}_{c}") for c in names
                        for n, f in (("lo", F.min), ("hi", F.max))]).first()
    tie = F.pmod(F.xxhash64(F.lit(11), "text_key"), F.lit(1 << 30)) / float(1 << 30)
    scaled = []
    for c in names:
        lo, hi = lim[f"lo_{c}"], lim[f"hi_{c}"]
        width = (hi - lo) if lo is not None and hi > lo else 1.0
        # the tie takes the place below the resolution of the scaled value
        scaled.append((F.round((F.col(c) - F.lit(lo or 0.0)) / width, 6)
                       + F.col("tie") * 1e-6).alias(c))
    return grouped.withColumn("tie", tie).select("text_key", "bytes", *scaled), names


def kd_tree(pts: DataFrame, dims: list[str], shards: int) -> list[dict]:
    """Splits {node, dim, cut, left, right}; leaves are {node, shard}.  Node 0 is the root."""
    tree: list[dict] = [{"node": 0, "first": 0, "shards": shards}]
    for at in range(64):
        todo = [t for t in tree if t["shards"] > 1 and "cut" not in t]
        if not todo:
            return tree
        ids = [t["node"] for t in todo]
        placed = pts.withColumn("node", locate(tree)).where(F.col("node").isin(ids))
        spread = {r["node"]: r for r in placed.groupBy("node").agg(
            F.sum("bytes").alias("w"),
            *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))]
        ).collect()}  # at most ``shards`` rows
        search = []
        for t in todo:
            r = spread.get(t["node"])
            if r is None:  # no points: any cut will do
                t.update(dim=dims[0], cut=0.0)
                continue
            dim = max(dims, key=lambda d: r[f"hi_{d}"] - r[f"lo_{d}"])
            t["dim"] = dim
            left = t["shards"] // 2
            search.append({"t": t, "lo": r[f"lo_{dim}"], "hi": r[f"hi_{dim}"] + 1e-9, "below": 0,
                           "goal": r["w"] * left / t["shards"], "w": r["w"]})
        for _ in range(ROUNDS):
            if not search:
                break
            value, lo, width = F.lit(0.0), F.lit(0.0), F.lit(1.0)
            for s in search:
                here = F.col("node") == s["t"]["node"]
                value = F.when(here, F.col(s["t"]["dim"])).otherwise(value)
                lo = F.when(here, s["lo"]).otherwise(lo)
                width = F.when(here, s["hi"] - s["lo"]).otherwise(width)
            sums: dict[int, dict[int, int]] = {}
            rows = (placed.where(F.col("node").isin([s["t"]["node"] for s in search]))
                    .withColumn("x", F.floor((value - lo) / width * BINS))
                    .where(F.col("x").between(0, BINS - 1))
                    .groupBy("node", "x").agg(F.sum("bytes").alias("w")).collect())  # nodes x BINS
            for r in rows:
                sums.setdefault(r["node"], {})[r["x"]] = r["w"]
            going = []
            for s in search:
                got, step = sums.get(s["t"]["node"], {}), (s["hi"] - s["lo"]) / BINS
                x = 0
                while x < BINS - 1 and s["below"] + got.get(x, 0) <= s["goal"]:
                    s["below"] += got.get(x, 0)
                    x += 1
                held, lo = got.get(x, 0), s["lo"]
                s["lo"], s["hi"] = lo + x * step, lo + (x + 1) * step
                # the cut goes to the nearer border of the bin that holds the quantile
                near = s["lo"] if s["goal"] - s["below"] <= held / 2 else s["hi"]
                s["t"]["cut"] = near
                if held > TOLERANCE * s["w"] and step > 1e-14:
                    going.append(s)
            search = going
        for t in todo:
            left = t["shards"] // 2
            for side, first, n in (("left", t["first"], left),
                                   ("right", t["first"] + left, t["shards"] - left)):
                t[side] = len(tree)
                tree.append({"node": len(tree), "first": first, "shards": n})
    return tree


def locate(tree: list[dict], at: int = 0) -> Column:
    """The node a point is in now, as one expression over the dimensions."""
    t = tree[at]
    if "left" not in t:
        return F.lit(t["node"])
    return F.when(F.col(t["dim"]) < t["cut"], locate(tree, t["left"])).otherwise(
        locate(tree, t["right"]))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(*[c for c in ("doc_id", "source", "lang") if c in docs.columns],
                        text.alias("text")).withColumn("text_key", F.xxhash64("text"))
    rows = keyed.select("doc_id", "text_key", (F.octet_length("text") + 1).cast("long").alias("size"),
                        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    pts, dims = points(keyed)
    pts = written(pts, "sharding_scaled")
    tree = kd_tree(pts, dims, shards)
    of_node = F.lit(0)
    for t in tree:
        if "left" not in t:
            of_node = F.when(F.col("node") == t["node"], t["first"]).otherwise(of_node)
    leaf = pts.withColumn("node", locate(tree)).select("text_key", of_node.alias("shard"))
    same = F.xxhash64("doc_id", "text_crc32", "size")  # a collision only deals more rows
    placed = written(rows.join(leaf, "text_key").drop("text_key").withColumns(
        {"same": same, "draw": F.monotonically_increasing_id()}), "sharding_rows")
    return numbered(placed).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                   F.lit(None).cast("int").alias("grown_shard"))


def numbered(placed: DataFrame) -> DataFrame:
    """``placed`` with ``slot``: its rows numbered from 0 in every shard.

    ``placed`` is a written table with shard, doc_id, text_crc32, size, a hash
    ``same`` of equal rows and a number ``draw`` that spreads them.
    """
    parts = max(1, placed.count() // SLOT_ROWS)
    hot = (placed.groupBy("same").agg(F.count("*").alias("n")).where(F.col("n") > SLOT_ROWS)
           .select("same", F.ceil(F.col("n") / SLOT_ROWS).alias("deals")))
    deal = F.when(F.col("deals").isNull(), 0).otherwise(1 + F.pmod("draw", "deals"))
    dealt = (join_small(placed, written(hot, "sharding_hot"), "same", "left")
             .withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)))
             .withColumn("deal", deal))
    key = ["shard", "part", "deal"]
    before = Window.partitionBy("shard").orderBy("part", "deal").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(dealt.groupBy(*key).agg(F.count("*").alias("n")).select(  # a row per part
        *key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "sharding_offsets")
    order = Window.partitionBy(*key).orderBy("doc_id", "text_crc32", "size")
    return (join_small(dealt.withColumn("at", F.row_number().over(order)), offsets, key, "inner")
            .withColumn("slot", F.col("base") + F.col("at") - 1))
