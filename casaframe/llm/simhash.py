"""SimHash near-duplicates: byte-position inverted index with count filtering.

Fingerprints are 64-bit SimHashes of word shingles.  Two fingerprints at
most ``max_distance`` bits apart differ in at most that many of their 8
bytes, so they agree in at least ``8 - max_distance`` byte positions: the
guaranteed minimum of matches.  The index posts every distinct fingerprint
under each choice of ``posted`` positions with the bytes found there, one
fewer than the minimum, so a pair that meets has yet to reach it: its shared
positional bytes are tallied, pairs below the minimum dropped, the rest
verified by bit count.

Only links are needed that keep the groups connected, so a posting is
searched breadth first (a fingerprint leaves the search once reached) and
yields a spanning forest, never all pairs; a link is emitted only under the
first posting that can hold it.  A posting longer than ``block`` is cut into
blocks that are compared two by two in separate tasks.  Groups are the
connected components over all links, found by min-label propagation with a
reliable checkpoint each round.

Defined results: null and empty texts have the fingerprint zero and are
linked like any other; repeated rows share a fingerprint; a component whose
ids are all null has a null component_id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casaframe.llm import words as W
from casaframe.llm.common import MAX_BROADCAST_ROWS, append_columns, written
from casaframe.session import reliable_checkpoint

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
POSTED = 3           # byte positions of one posting, at most 8 - MAX_DISTANCE
BLOCK = 1 << 15      # fingerprints of one posting compared in one task
SALTS = 16           # parts of a fingerprint's documents when ids are looked up


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of the shingles of a text; 0 without words."""
    from xxhash import xxh64_intdigest
    # bytes.split() cuts at the ASCII white space only
    words = (text or "").encode("utf-8", "surrogatepass").translate(W.LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle_words, len(words))
    spans = list(zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()))
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(spans), 8192):
        h = np.array([xxh64_intdigest(joined[s:e], seed) for s, e in spans[lo:lo + 8192]],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(spans), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(docs: DataFrame, name: str, *, keep: list[str],
                      shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """The ``keep`` columns and the fingerprint of ``text`` as a long, without a shuffle."""
    def make():
        return lambda texts: ([simhash(t, shingle_words, seed) for t in texts],)

    return append_columns(docs, keep, f"`{name}` long", make)


def _positions(posted: int) -> list[tuple[int, ...]]:
    return list(combinations(range(8), posted))


def _posting_masks(posted: int) -> list[int]:
    return [sum(0xFF << (8 * p) for p in ps) for ps in _positions(posted)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _matching(x: np.ndarray) -> np.ndarray:
    """Of each xor of two fingerprints: which of the 8 bytes agree."""
    return x.view(np.uint8).reshape(-1, 8) == 0


def forest(fps: np.ndarray, posting: int, max_distance: int,
           posted: int = POSTED) -> Iterator[tuple[int, int]]:
    """Links of a posting's distinct fingerprints: a spanning forest by breadth-first search.

    Left out are links whose pair already meets under an earlier posting;
    there it is connected, if not by this link then by others.
    """
    first = {ps: k for k, ps in enumerate(_positions(posted))}
    need = 8 - max_distance
    left = fps.astype("<i8").view(np.uint64)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            a = queue.pop()
            x = left ^ a
            near = np.flatnonzero(_matching(x).sum(axis=1) >= need)      # count filter
            near = near[np.bitwise_count(x[near]) <= max_distance]       # verification
            if not len(near):
                continue
            for b, agree in zip(left[near], _matching(x[near])):
                if first[tuple(np.flatnonzero(agree)[:posted].tolist())] == posting:
                    yield _signed(int(a)), _signed(int(b))
            queue.extend(left[near])
            left = np.delete(left, near)


class _Postings:
    """Walks sorted rows (posting, at, fp); collects links, and blocks of long postings."""

    def __init__(self, max_distance: int, block: int, posted: int):
        self.max_distance, self.block, self.posted = max_distance, block, posted
        self.masks = np.array(_posting_masks(posted), dtype=np.uint64)
        self.key, self.parts, self.n, self.flushed = None, [], 0, 0
        self.found: list[tuple] = []   # (a, b, posting, at, part); links have part -1

    def _flush(self, fps: np.ndarray) -> None:
        self.found += [(int(f), 0, *self.key, self.flushed) for f in fps]
        self.flushed += 1

    def close(self) -> None:
        fps = np.concatenate(self.parts) if self.parts else np.zeros(0, dtype=np.int64)
        if self.flushed and len(fps):
            self._flush(fps)
        elif len(fps) > 1:
            self.found += [(a, b, 0, 0, -1) for a, b in
                           forest(fps, self.key[0], self.max_distance, self.posted)]
        self.key, self.parts, self.n, self.flushed = None, [], 0, 0

    def feed(self, key: tuple[int, int], fps: np.ndarray) -> None:
        if key != self.key:
            self.close()
            self.key = key
        self.parts.append(fps)
        self.n += len(fps)
        while self.n >= self.block:
            fps = np.concatenate(self.parts)
            self._flush(fps[:self.block])
            self.parts, self.n = [fps[self.block:]], self.n - self.block

    def batch(self, posting: np.ndarray, at: np.ndarray, fps: np.ndarray) -> None:
        cut = np.flatnonzero((posting[1:] != posting[:-1]) | (at[1:] != at[:-1])) + 1
        lo, hi = np.concatenate(([0], cut)), np.concatenate((cut, [len(fps)]))
        size = hi - lo
        run = lambda r: self.feed((int(posting[lo[r]]), int(at[lo[r]])), fps[lo[r]:hi[r]])
        run(0)
        inner = np.arange(1, len(lo) - 1)
        self._pairs(posting, fps, lo[inner[size[inner] == 2]])
        for r in inner[size[inner] > 2]:
            run(r)
        if len(lo) > 1:
            run(len(lo) - 1)

    def _pairs(self, posting: np.ndarray, fps: np.ndarray, at: np.ndarray) -> None:
        """Postings of just two fingerprints, all at once."""
        x = (fps[at] ^ fps[at + 1]).view(np.uint64)
        agree = _matching(x)
        ok = ((agree.sum(axis=1) >= 8 - self.max_distance)
              & (np.bitwise_count(x) <= self.max_distance))
        # the first posting that holds the pair has the pair's first agreeing bytes
        rank = np.cumsum(agree, axis=1)
        taken = agree & (rank <= self.posted)
        mask = (taken * (np.uint64(0xFF) << (np.uint64(8) * np.arange(8, dtype=np.uint64)))
                ).sum(axis=1, dtype=np.uint64)
        ok &= mask == self.masks[posting[at]]
        self.found += [(a, b, 0, 0, -1) for a, b in
                       zip(fps[at[ok]].tolist(), fps[at[ok] + 1].tolist())]

    def taken(self) -> pd.DataFrame:
        out = pd.DataFrame(self.found, columns=["a", "b", "posting", "at", "part"],
                           dtype=np.int64)
        self.found = []
        return out


def links(distinct: DataFrame, fp: str, *, max_distance: int = MAX_DISTANCE,
          block: int = BLOCK, posted: int = POSTED) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints connected by all links.

    ``distinct`` holds every fingerprint once, as a long.  More ``posted``
    positions, up to the guaranteed minimum, mean shorter postings but more of
    them.
    """
    if not 1 <= posted <= 8 - max_distance:
        raise ValueError(f"posted must be between 1 and {8 - max_distance}")
    spark = distinct.sparkSession
    entries = distinct.select(F.col(fp).alias("fp"), F.explode(F.array(*[
        F.struct(F.lit(k).cast("long").alias("posting"),
                 F.col(fp).bitwiseAND(F.lit(_signed(m))).alias("at"))
        for k, m in enumerate(_posting_masks(posted))])).alias("p"))
    dealt = (entries.select("p.posting", "p.at", "fp")
             .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "posting", "at")
             .sortWithinPartitions("posting", "at", "fp"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walker = _Postings(max_distance, block, posted)
        for pdf in batches:
            if len(pdf):
                walker.batch(*(pdf[c].to_numpy(dtype=np.int64) for c in ("posting", "at", "fp")))
                yield walker.taken()
        walker.close()
        yield walker.taken()

    schema = "a long, b long, posting long, at long, part long"
    found = written(dealt.mapInPandas(walk, schema), "simhash_postings")
    short = found.where("part < 0").select("a", "b")
    blocks = found.where("part >= 0").select("posting", "at", "part", F.col("a").alias("fp"))
    if blocks.isEmpty():
        return short
    last = blocks.groupBy("posting", "at").agg(F.max("part").alias("last"))
    met = (blocks.join(last, ["posting", "at"])
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
           .select("posting", "at", "fp", F.least("part", "other").alias("i"),
                   F.greatest("part", "other").alias("j")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = np.sort(pdf["fp"].to_numpy(dtype=np.int64))
        return pd.DataFrame(list(forest(fps, int(pdf["posting"].iloc[0]), max_distance,
                                        posted)),
                            columns=["a", "b"], dtype=np.int64)

    return short.unionByName(met.groupBy("posting", "at", "i", "j")
                             .applyInPandas(compare, "a long, b long"))


def components(edges: DataFrame, own: DataFrame) -> DataFrame:
    """(node, label): the least label reachable, for every node of ``own`` that has a link.

    ``own`` (node, label) gives each node's own label, ``edges`` (a, b) the
    links.  Each round a node takes the least label around it and then the
    label of that label's holder, so long chains shorten by doubling.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = written(both, "component_links")
    # labels are ranks of (own label, node): one total order, no ties
    state = reliable_checkpoint(
        both.select(F.col("a").alias("node")).distinct().join(own, "node", "left")
        .select("node", F.struct("label", "node").alias("best")))
    while True:
        around = (both.join(state, both["b"] == state["node"])
                  .groupBy(F.col("a").alias("node")).agg(F.min("best").alias("near")))
        hop = (state.join(around, "node")
               .select("node", "best", F.least("best", "near").alias("near")))
        held = state.select(F.col("node").alias("holder"), F.col("best").alias("far"))
        now = reliable_checkpoint(
            hop.join(held, F.col("near.node") == F.col("holder"))
            .select("node", F.least("near", "far").alias("best"),
                    (F.col("best") != F.least("near", "far")).alias("moved")))
        state = now.select("node", "best")
        if now.where("moved").isEmpty():
            return state.select("node", F.col("best.label").alias("label"))


def groups(docs: DataFrame, *, shingle_words: int = SHINGLE_WORDS,
           max_distance: int = MAX_DISTANCE, block: int = BLOCK, posted: int = POSTED) -> DataFrame:
    """(doc_id, th, fp, least) of every row.

    ``th`` is a hash of the text, ``least`` (lost, doc_id, th) the first row
    of the row's group: the least id, rows without an id last.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    prints = written(with_fingerprints(docs, "fp", keep=["doc_id", "th"],
                                       shingle_words=shingle_words), "simhash")
    # a fingerprint shared by many documents is summed up before anything is joined
    label = F.min(F.struct(F.isnull("doc_id").alias("lost"), "doc_id", "th")).alias("label")
    distinct = written(prints.groupBy("fp").agg(label), "simhash_distinct")
    edges = links(distinct, "fp", max_distance=max_distance, block=block, posted=posted)
    linked = components(edges, distinct.select(F.col("fp").alias("node"), "label"))
    final = (distinct.join(linked.select(F.col("node").alias("fp"), F.col("label").alias("found")),
                           "fp", "left")
             .select("fp", F.coalesce("found", "label").alias("least")))
    # one fingerprint may belong to a third of the documents: its row is dealt to SALTS parts
    salt = F.pmod(F.xxhash64("doc_id", "th"), F.lit(SALTS))
    spread = final.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                           F.lit(SALTS - 1).cast("long"))))
    return (prints.withColumn("salt", salt).join(spread, ["fp", "salt"])
            .select("doc_id", "th", "fp", "least"))


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every row, at the contract's settings."""
    return groups(docs).select("doc_id", hex16(F.col("fp")).alias("fingerprint"),
                               F.col("least.doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay: the first row of every group, all columns unchanged.

    Rows repeated with id and text are one row.  Few removals are broadcast;
    with many, the removal is a shuffled join.
    """
    found = written(groups(docs).select(
        F.col("doc_id").alias("__cf_doc"), F.col("th").alias("__cf_th"),
        (F.struct(F.isnull("doc_id").alias("lost"), "doc_id", "th") == F.col("least")).alias("first")),
        "simhash_rows")
    gone = found.where(~F.col("first")).select("__cf_doc", "__cf_th").distinct()
    if gone.count() <= MAX_BROADCAST_ROWS:
        gone = F.broadcast(gone)
    stay = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__cf_doc"))
                     & (F.xxhash64("text") == F.col("__cf_th")), "left_anti")
    repeated = found.where("first").groupBy("__cf_doc", "__cf_th").count().where("count > 1")
    if repeated.isEmpty():
        return stay
    return (stay.withColumn("__cf_th", F.xxhash64("text")).dropDuplicates(["doc_id", "__cf_th"])
            .drop("__cf_th"))
