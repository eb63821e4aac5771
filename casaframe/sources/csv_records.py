"""Quoted CSV read by many tasks: every split finds its own place in the quoting.

A file is read as lines, split anywhere.  A line turns "outside quotes" or
"inside a quoted cell" at its start into one of the two at its end, so a line
is a function on two states, and so is a split: the composition of its lines.
A line is constant (it ends the same way whatever came before), or it keeps
the state, or it swaps it.  The state anywhere is therefore the value of the
last constant line before, plus the swaps since: running sums, first within
every split, then over the few rows that describe splits.

With its state known, a line starts a record or goes on with one.  Records of
one line are parsed where they are; only the lines of longer records are
brought together, by the place where the record starts.  Everything is
DataFrame operations on the JVM.

Quotes count as such only where a cell starts with one, as in the one-task
reader; doubled quotes inside are one quote, line ends inside are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# possessive throughout: matched without recursion, in time linear in the line
INSIDE = r'[^"]*+(?:""[^"]*+)*+'
CELL = rf'(?:"{INSIDE}"[^,]*+|[^",][^,]*+)?+,'
OPEN_AFTER = rf'(?:{CELL})*+"{INSIDE}\z'
OPENS = rf'^{OPEN_AFTER}'                                    # outside -> inside
STAYS = rf'^{INSIDE}(?:\z|"[^,]*+,{OPEN_AFTER})'             # inside -> inside
PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")  # cannot be split


def _running(df: DataFrame, order: Window, start: Column | None) -> DataFrame:
    """Adds ``before``: the state before a row, NULL-free if ``start`` is given, else relative.

    Rows hold ``s`` and ``q``, their end state from outside and from inside.
    Without ``start``, ``fixed`` tells whether ``before`` is known whatever the start.
    """
    swap = ((F.col("s") == 1) & (F.col("q") == 0)).cast("int")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("swaps", F.sum(swap).over(upto))
    last = F.last(F.when(F.col("s") == F.col("q"), F.struct("s", "swaps")), True).over(earlier)
    df = df.withColumns({"last": last, "earlier": F.coalesce(F.sum(swap).over(earlier), F.lit(0))})
    known = F.col("last").isNotNull()
    moved = F.pmod(F.when(known, F.col("last.s") + F.col("earlier") - F.col("last.swaps"))
                   .otherwise(F.col("earlier") + (F.lit(0) if start is None else start)), F.lit(2))
    return df.withColumns({"before": moved.cast("int"), "fixed": known}).drop("swaps", "last", "earlier")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, at, value, s, q): lines in file order by (block, at)."""
    # ids follow the scan itself, so they are the same whenever a task runs again
    lines = (spark.read.option("lineSep", "\n").text(paths)
             .select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at"), "value"))
    value = F.when((F.col("block") == 0) & F.startswith("value", F.lit("﻿")),
                   F.expr("substring(value, 2)")).otherwise(F.col("value"))
    quoted = F.contains("value", F.lit('"'))
    body = F.rtrim("value", F.lit("\r"))
    return lines.withColumn("value", value).withColumns({
        "s": F.when(quoted, body.rlike(OPENS).cast("int")).otherwise(0),
        "q": F.when(quoted, body.rlike(STAYS).cast("int")).otherwise(1)})


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, at, record): the records of the files but each one's first (the header)."""
    lines = _lines(spark, paths)
    within = Window.partitionBy("file", "block").orderBy("at")
    rel = _running(lines, within, None).withColumn("n", F.row_number().over(within))
    # a split as one function: that of its last line's end
    ends = lambda start: F.when((F.col("before") + F.when(F.col("fixed"), 0).otherwise(start)) % 2 == 0,
                                F.col("s")).otherwise(F.col("q"))
    full = ~F.rtrim("value", F.lit("\r")).eqNullSafe(F.lit(""))
    splits = rel.groupBy("file", "block").agg(
        F.max_by(F.struct(ends(F.lit(0)).alias("s"), ends(F.lit(1)).alias("q")), "at").alias("f"),
        # lines that start a record, and the last such, for either start state
        *[F.max(F.when((F.col("before") + F.when(F.col("fixed"), 0).otherwise(F.lit(x))) % 2 == 0,
                       F.col("at"))).alias(f"start{x}") for x in (0, 1)],
        F.min(F.when(full, F.struct("at", F.endswith("value", F.lit("\r")).alias("crlf")))).alias("first"))
    over = Window.partitionBy("file").orderBy("block")   # a row per split
    placed = _running(splits.select("file", "block", "f.s", "f.q", "start0", "start1", "first"), over, F.lit(0))
    last = F.when(F.col("before") == 0, F.col("start0")).otherwise(F.col("start1"))
    placed = placed.withColumn("last", F.when(last.isNotNull(), F.struct("block", last.alias("at"))))
    placed = placed.select(
        "file", "block", F.col("before").alias("x"),
        # the record that goes on into a split: the last one started before it
        F.last("last", True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("open"),
        F.first(F.when(F.col("first").isNotNull(), F.struct("block", "first.at", "first.crlf")), True)
        .over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("header"))
    known = (rel.join(placed, ["file", "block"])
             .withColumn("before", (F.col("before") + F.when(F.col("fixed"), 0).otherwise(F.col("x"))) % 2)
             .withColumn("after", F.when(F.col("before") == 0, F.col("s")).otherwise(F.col("q"))))
    begun = F.last(F.when(F.col("before") == 0, F.col("at")), True).over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = known.withColumn("of", F.when(begun.isNotNull(), F.struct("block", begun.alias("at")))
                             .otherwise(F.col("open")))
    known = known.where(~F.col("of").eqNullSafe(F.struct("header.block", "header.at")))
    alone = (F.col("before") == 0) & (F.col("after") == 0)
    short = known.where(alone).select("file", "of.block", "of.at", F.col("value").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    glued = F.array_join(F.transform("p", lambda x: x["value"]), "\n")
    # where lines end in \r\n, line ends inside cells become \n, as in the one-task reader
    long = (known.where(~alone).groupBy("file", "of", "header.crlf").agg(pieces.alias("p"))
            .select("file", "of.block", "of.at", F.when(F.col("crlf"), F.replace(
                glued, F.lit("\r\n"), F.lit("\n"))).otherwise(glued).alias("record")))
    out = short.unionByName(long)
    return out.withColumn("record", F.rtrim("record", F.lit("\r"))).where("record <> ''")


def parsed(records_df: DataFrame, names: list[str]) -> DataFrame:
    """The cells of ``record`` as text columns ``names``."""
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    row = F.from_csv("record", cells.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                     {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"})
    return records_df.select(row.alias("r")).select(
        *[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])


def large_files(spark: SparkSession, path: str, limit: int) -> tuple[list[str], list[str]]:
    """Files under ``path`` of more than ``limit`` bytes that can be split, and the others."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    large = files.where((F.col("length") > limit) & ~F.lower("path").rlike(
        "(" + "|".join(x.replace(".", r"\.") for x in PACKED) + ")$"))
    big = [r["path"] for r in large.collect()]  # at most the input's bytes / limit
    if not big:
        return [], []
    return big, [r["path"] for r in files.join(large, "path", "left_anti").collect()]
