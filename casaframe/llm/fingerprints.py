"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

Paragraphs are the lines of a text, pieces their sentences cut to 64
characters; a section ends behind a blank paragraph and behind one whose own
hash says so (about one in eight), so that an edit moves no section border
outside its surroundings.  A piece's node is its SHA-256, and every other
node the SHA-256 of its children's: paragraphs of pieces, sections of
paragraphs, the root of sections.  Equal roots, equal texts.

Two trees are compared from the top.  Sections that both hold are equal with
all below them and are not opened; of the others the paragraphs are compared,
and of paragraphs that differ the pieces.  Likeness is the Jaccard share of
the nodes of both trees found equal that way, repeats counted, so order and
number show in it: a moved sentence changes its paragraph's and its section's
node.  An edit is located likewise: in the first and the last section that
differ, then among their paragraphs.

Everything is DataFrame expressions over one row; only ``with_next`` (the
next document's text beside each text) moves rows: one shuffle into blocks
of consecutive ids, in which the first document of a block also stands
behind the last of the block before.

Defined results: a null text is the empty text, with one empty paragraph;
likeness is 1.0 for equal roots; repeated ids follow each other in the order
of their texts' hashes; documents without an id are followed by the first
document with one (a lone document, or one in a table without ids, by itself).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = r"[^.!?]{1,64}[.!?]*|[.!?]+"   # pieces of a paragraph; together they are the paragraph
SECTION_MARKS = ("0", "1")   # a paragraph whose hash starts so ends its section
ROWS_PER_BLOCK = 4096
MAX_BLOCKS = 10_000


def pieces(text: Column) -> Column:
    """Nodes of the pieces, an array for each paragraph."""
    return F.transform(F.split(text, "\n"), lambda p: F.transform(
        F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), lambda x: F.sha2(x, 256)))


def paragraphs(piece_nodes: Column) -> Column:
    return F.transform(piece_nodes, lambda p: F.sha2(F.concat_ws("", p), 256))


def section_ends(nodes: Column) -> Column:
    """Behind which paragraphs (1-based) the sections end."""
    blank = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # of no bytes
    n = F.size(nodes)
    return F.filter(F.sequence(F.lit(1), n), lambda i: (
        (i == n) | (F.get(nodes, i - 1) == blank)
        | F.substring(F.get(nodes, i - 1), 1, 1).isin(*SECTION_MARKS)))


def sections(nodes: Column, ends: Column) -> Column:
    """array<struct<node, begin, end>> of the sections over paragraph nodes."""
    begins = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
    return F.zip_with(begins, ends, lambda b, e: F.struct(
        F.sha2(F.concat_ws("", F.slice(nodes, b + 1, e - b)), 256).alias("node"),
        b.alias("begin"), e.alias("end")))


def root(section_nodes: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(section_nodes, lambda x: x["node"])), 256)


def with_tree(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds ``name``_pieces, _nodes and _sections."""
    df = df.withColumn(f"{name}_pieces", pieces(text))
    df = df.withColumn(f"{name}_nodes", paragraphs(F.col(f"{name}_pieces")))
    df = df.withColumn(f"{name}_ends", section_ends(F.col(f"{name}_nodes")))
    return df.withColumn(f"{name}_sections", sections(F.col(f"{name}_nodes"), F.col(f"{name}_ends"))
                         ).drop(f"{name}_ends")


def _sorted(a: Column, b: Column) -> Column:
    """The nodes of two arrays of struct<node, ...> in one order, with their side."""
    # one sort of both together: time is not quadratic in their lengths
    return F.array_sort(F.concat(
        F.transform(a, lambda x: F.struct(x["node"].alias("node"), F.lit(0).alias("side"), x.alias("x"))),
        F.transform(b, lambda x: F.struct(x["node"].alias("node"), F.lit(1).alias("side"), x.alias("x")))))


def _grouped(both: Column) -> Column:
    """Equal nodes of both sides together: array<struct<a, b>> of arrays."""
    n = F.size(both)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (
        F.get(both, i)["node"] != F.get(both, i - 1)["node"]))
    ends = F.concat(F.slice(starts, 2, n), F.array(n))
    side = lambda run, k: F.transform(F.filter(run, lambda x: x["side"] == k), lambda x: x["x"])
    runs = F.zip_with(starts, ends, lambda s, e: F.slice(both, s + 1, e - s))
    return F.when(n > 0, F.transform(runs, lambda r: F.struct(side(r, 0).alias("a"), side(r, 1).alias("b"))))


def _shared(runs: Column, weight) -> Column:
    """Nodes equal on both sides, each with ``weight`` nodes in all."""
    return F.coalesce(F.aggregate(runs, F.lit(0).cast("long"), lambda acc, r: acc + F.when(
        F.least(F.size(r["a"]), F.size(r["b"])) > 0,
        F.least(F.size(r["a"]), F.size(r["b"])) * weight(F.get(r["a"], 0))).otherwise(0)), F.lit(0))


def _open(runs: Column, side: str) -> Column:
    """The nodes of a side without an equal one on the other."""
    common = lambda r: F.least(F.size(r["a"]), F.size(r["b"]))
    return F.flatten(F.transform(runs, lambda r: F.slice(r[side], common(r) + 1, F.size(r[side]))))


def with_likeness(df: DataFrame, one: str, other: str, name: str) -> DataFrame:
    """Adds ``name``: the likeness of two trees of the row, opening only what differs."""
    col = lambda c: F.col(f"__{c}")
    keep = list(df.columns)
    pars = lambda t: F.zip_with(F.col(f"{t}_nodes"), F.col(f"{t}_pieces"), lambda n, p: F.struct(
        n.alias("node"), p.alias("pieces")))
    inner = lambda t, opened: F.flatten(F.transform(opened, lambda s: F.slice(
        pars(t), s["begin"] + 1, s["end"] - s["begin"])))
    size = lambda t: (F.size(f"{t}_sections") + F.size(f"{t}_nodes")
                      + F.aggregate(f"{t}_pieces", F.lit(0), lambda acc, p: acc + F.size(p)))
    below = lambda t: lambda s: (1 + s["end"] - s["begin"] + F.aggregate(
        F.slice(F.col(f"{t}_pieces"), s["begin"] + 1, s["end"] - s["begin"]), F.lit(0),
        lambda acc, p: acc + F.size(p)))
    as_nodes = lambda opened: F.flatten(F.transform(opened, lambda p: F.transform(
        p["pieces"], lambda x: F.struct(x.alias("node")))))
    df = df.withColumn("__s", _sorted(F.col(f"{one}_sections"), F.col(f"{other}_sections")))
    df = df.withColumn("__s", _grouped(col("s")))
    df = df.withColumns({"__n": _shared(col("s"), below(one)), "__pa": inner(one, _open(col("s"), "a")),
                         "__pb": inner(other, _open(col("s"), "b"))})
    df = df.withColumn("__p", _sorted(col("pa"), col("pb")))
    df = df.withColumn("__p", _grouped(col("p")))
    df = df.withColumns({"__n": col("n") + _shared(col("p"), lambda p: 1 + F.size(p["pieces"])),
                         "__la": as_nodes(_open(col("p"), "a")), "__lb": as_nodes(_open(col("p"), "b"))})
    df = df.withColumn("__l", _sorted(col("la"), col("lb")))
    df = df.withColumn("__l", _grouped(col("l")))
    df = df.withColumn("__n", col("n") + _shared(col("l"), lambda _: F.lit(1)))
    return df.select(*keep, (col("n") / (size(one) + size(other) - col("n"))).alias(name))


def first_difference(nodes_a: Column, nodes_b: Column) -> Column:
    """0-based place of the first differing node; the shorter length if none differs."""
    at = F.array_position(F.zip_with(nodes_a, nodes_b, lambda a, b: a.eqNullSafe(b)), False)
    return F.when(at > 0, at - 1).otherwise(F.least(F.size(nodes_a), F.size(nodes_b)).cast("long"))


def differing_paragraphs(one: str, other: str, back: bool = False) -> Column:
    """Paragraphs before (behind, with ``back``) the first (last) one that differs.

    Whole sections are passed over by their nodes; only the one that differs is opened.
    """
    turn = (lambda x: F.reverse(x)) if back else (lambda x: x)
    a, b = F.col(f"{one}_sections"), F.col(f"{other}_sections")
    node = lambda s: F.transform(turn(s), lambda x: x["node"])
    k = first_difference(node(a), node(b)).cast("int")
    opened = lambda t, s: turn(F.slice(F.col(f"{t}_nodes"), F.get(turn(s), k)["begin"] + 1,
                                       F.get(turn(s), k)["end"] - F.get(turn(s), k)["begin"]))
    here = F.coalesce(first_difference(opened(one, a), opened(other, b)), F.lit(0))
    passed = F.aggregate(F.slice(turn(a), 1, k), F.lit(0), lambda acc, x: acc + x["end"] - x["begin"])
    return (passed + here).cast("long")


def with_next(docs: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """(doc_id, text, next_text) of every row; ``doc_id`` is a number."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n, n_ids, first_id = docs.agg(F.count("*"), F.count("doc_id"), F.min("doc_id")).first()
    if not n_ids:
        return docs.withColumn("next_text", F.col("text"))
    blocks = min(MAX_BLOCKS, -(-n_ids // rows_per_block))
    firsts = [first_id]
    if blocks > 1:
        at = [i / blocks for i in range(1, blocks)]
        cuts = docs.agg(F.percentile_approx("doc_id", at, 10 * blocks)).first()[0]
        firsts += sorted(set(cuts) - {first_id})
    # the block of an id: a search in two steps over at most MAX_BLOCKS border ids
    step = max(1, int(len(firsts) ** 0.5))
    coarse = F.from_json(F.lit(json.dumps(firsts[::step])), "array<bigint>")
    fine = F.from_json(F.lit(json.dumps([firsts[i:i + step] for i in range(0, len(firsts), step)])),
                       "array<array<bigint>>")
    doc_id = F.col("doc_id")
    row = F.size(F.filter(coarse, lambda c: c <= doc_id)) - 1
    block = row * step + F.size(F.filter(F.get(fine, row), lambda c: c <= doc_id)) - 1
    begins = F.get(F.from_json(F.lit(json.dumps(firsts)), "array<bigint>"), F.col("block")) == doc_id
    here = F.struct(F.col("block").alias("block"), F.lit(False).alias("ghost"))
    before = F.struct(F.pmod(F.col("block") - 1, F.lit(len(firsts))).alias("block"),
                      F.lit(True).alias("ghost"))
    dealt = (docs.where("doc_id IS NOT NULL").withColumn("block", block)
             .withColumn("to", F.explode(F.when(begins, F.array(here, before))
                                         .otherwise(F.array(here))))
             .select("doc_id", "text", "to.block", "to.ghost"))
    order = Window.partitionBy("block").orderBy("ghost", "doc_id", F.xxhash64("text"))
    chained = (dealt.withColumn("next_text", F.lead("text").over(order))
               .where(~F.col("ghost")).select("doc_id", "text", "next_text"))
    if n_ids == n:
        return chained
    # one document's text
    first = (docs.where(doc_id == first_id)
             .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))).first()[0]["text"])
    lost = docs.where("doc_id IS NULL").withColumn("next_text", F.lit(first))
    return chained.unionByName(lost)


def edited_text(text: Column, next_text: Column) -> Column:
    """The last half of the code points replaced by as many of the next document's first ones."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Trees of every text and of its edited text, compared with each other and the next's."""
    rows = with_next(docs).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    rows = rows.withColumns({"n_chars": F.char_length("text").cast("long"),
                             "edited_sha256": F.sha2("edited", 256)})
    for name, text in (("own", "text"), ("edit", "edited"), ("next", "next_text")):
        rows = with_tree(rows, F.col(text), name).drop(text)
    rows = rows.withColumns({"fingerprint": root(F.col("own_sections")),
                             "edited_fingerprint": root(F.col("edit_sections")),
                             "next_root": root(F.col("next_sections")),
                             "front": differing_paragraphs("own", "edit"),
                             "back": differing_paragraphs("own", "edit", back=True)})
    rows = with_likeness(rows, "own", "edit", "like_edited")
    rows = with_likeness(rows, "own", "next", "like_next")
    same = F.col("fingerprint") == F.col("edited_fingerprint")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        F.when(same, 1.0).otherwise(F.col("like_edited")).alias("near_edited"),
        F.when(F.col("fingerprint") == F.col("next_root"), 1.0).otherwise(F.col("like_next")).alias("near_next"),
        F.when(~same, F.col("front")).alias("edit_first_paragraph"),
        F.when(~same, F.greatest(F.col("front"), F.size("edit_nodes") - F.col("back") - 1)
               ).alias("edit_last_paragraph"))
