"""Ranked lexical search: K2-treaps over the grid of terms and documents.

A cell of the grid holds the impact of a term in a document.  Documents are
cut into shards, and a shard's grid becomes a quadtree: every inner cell is a
4-bit mask of its non-empty quarters and the largest impact below it, stored
level after level without pointers (the rank of a mask's bit names the
child).  Rows are ordered by document frequency, so a cell's terms are alike
and its maximum says something about each.

An item descends along the paths of all its rows jointly.  A state is a
range of documents with the cell of each row over it; its bound is the sum
of the rows' weights times the maxima of their cells.  States are opened best bound
first, a batch at a time, and split by halving their documents; single
documents have their exact score.  States whose bound is below the tenth
score found so far in the task are left, ties stay.  So the result is exact.

Steps: (1) one scan counts documents and terms and writes, per document,
the frequencies of those terms that items ask for (other rows of the grid
would never be descended); (2) document frequencies are summed; (3) each
task builds the treaps of its documents, searches every item in them and
emits at most ten documents per item; (4) these are ranked.  No text and no
posting is shuffled.  The items' terms are broadcast in blocks of at most
``BLOCK_TERMS`` terms; more items mean more passes.

Terms are named by 64-bit hashes of their bytes.

Defined results: null and empty texts have no term and are never found; an
item without terms has no rows; repeated items count once, items that share
an id but not a text are ranked each for itself; repeated documents each
have a rank; null ids come last among equal scores; an empty table gives no
rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from casaframe.llm import words as W
from casaframe.llm.common import written

TOP = 10
SHARD_DOCS = 4096            # columns of one grid
SHARD_CELLS = 1 << 20        # cells of one grid, but for its last document
BATCH = 256                  # states opened at once
POOL = 1 << 21               # cells of the states that wait; beyond, finishing comes first
BLOCK_TERMS = 200_000        # terms of the items searched in one pass (about 10 MB on each task)


def tokens(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, number of the text, hash) of all terms of a run of texts."""
    hasher = W.WordHasher(W.ALNUM)
    for first, buf, starts in W.groups(texts, fold=True):
        at, h = hasher.hashes(buf)
        yield first, np.searchsorted(starts, at, side="right") - 1, h


def item_terms(items: DataFrame) -> list[tuple[int | None, list[int]]]:
    """(item_id, term hashes) of the distinct items of a block."""
    rows = items.collect()  # one block
    out = [(r["item_id"], set()) for r in rows]
    for first, of, h in tokens([r["text"] for r in rows]):
        for i, x in zip(of.tolist(), h.tolist()):
            out[first + i][1].add(x)
    return [(i, sorted(t)) for i, t in out if t]


def postings(docs: DataFrame, asked: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term; terms are places in ``asked``."""
    asked = np.sort(asked)
    schema = StructType.fromDDL("doc_id long, n long, terms array<int>, tfs array<long>")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, of, h in tokens(batch.column("text").to_pylist()):
                held, n = np.unique(of, return_counts=True)
                at = np.minimum(np.searchsorted(asked, h), max(0, len(asked) - 1))
                hit = asked[at] == h if len(asked) else np.zeros(len(h), dtype=bool)
                pair, tf = np.unique(of[hit].astype(np.int64) * len(asked) + at[hit], return_counts=True)
                ends = np.searchsorted(pair, (held + 1).astype(np.int64) * len(asked))
                if not len(held):
                    continue
                cut = pa.array(np.concatenate(([0], ends)), type=pa.int32())
                term = pa.array(pair % max(1, len(asked)), type=pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(held + first)), pa.array(n, type=pa.int64()),
                     pa.ListArray.from_arrays(cut, term),
                     pa.ListArray.from_arrays(cut, pa.array(tf, type=pa.int64()))], schema=arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


class Treap:
    """K2-treap of (row, column, impact) cells: masks and maxima by level, ranks for children."""

    def __init__(self, row: np.ndarray, col: np.ndarray, impact: np.ndarray, rows: int, cols: int):
        self.levels = max(1, int(max(rows, cols, 2) - 1).bit_length())
        code = np.zeros(len(row), dtype=np.uint64)
        for b in range(self.levels):  # quarters in the order (row bit, column bit)
            code |= ((row.astype(np.uint64) >> np.uint64(b)) & np.uint64(1)) << np.uint64(2 * b + 1)
            code |= ((col.astype(np.uint64) >> np.uint64(b)) & np.uint64(1)) << np.uint64(2 * b)
        order = np.argsort(code)
        code, best = code[order], impact[order].astype(np.int64)
        levels = [(best, None)]
        for _ in range(self.levels):
            up = code >> np.uint64(2)
            lo = np.flatnonzero(np.concatenate(([True], up[1:] != up[:-1])))
            mask = np.bitwise_or.reduceat(
                np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), lo)
            code, best = up[lo], np.maximum.reduceat(best, lo)
            levels.append((best, mask))
        # root first; the children of all cells of a level follow one another on the next
        self.best = np.concatenate([b for b, _ in reversed(levels)])
        masks = np.concatenate([m for _, m in reversed(levels[1:])])
        self.mask = np.concatenate((masks, np.zeros(len(impact), dtype=np.uint8)))
        self.rank = 1 + np.concatenate(([0], np.cumsum(np.bitwise_count(masks), dtype=np.int64)))

    def child(self, cell: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The cell's quarter, -1 where that is empty or the cell is."""
        mask = np.where(cell >= 0, self.mask[cell], 0)
        there = (mask >> quarter) & 1
        before = np.bitwise_count((mask & ((np.uint8(1) << quarter) - np.uint8(1))).astype(np.uint8))
        inner = np.minimum(np.maximum(cell, 0), len(self.rank) - 1)
        return np.where(there == 1, self.rank[inner] + before, -1)

    def search(self, rows: np.ndarray, weight: np.ndarray, least: int, top: int,
               batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
        """(column, score) of every column that may be among the ``top``: score > 0 and >= ``least``."""
        level, lo = np.array([self.levels]), np.zeros(1, dtype=np.int64)
        cells = np.zeros((1, len(rows)), dtype=np.int64)
        bound = np.array([int((weight * self.best[0]).sum())])
        found_col, found = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        while len(bound):
            if len(bound) > batch:  # the best bounds first; the lowest states if there are too many
                first = bound if cells.size <= POOL else np.lexsort((bound, -level)).argsort()
                pick = np.argpartition(first, len(bound) - batch)[-batch:]
                stay = np.ones(len(bound), dtype=bool)
                stay[pick] = False
            else:
                pick, stay = np.arange(len(bound)), np.zeros(len(bound), dtype=bool)
            lev = level[pick] - 1
            row_bit = (rows[None, :] >> lev[:, None]) & 1
            parts = []
            for half in (0, 1):
                got = self.child(cells[pick], (2 * row_bit + half).astype(np.uint8))
                top_of = (np.where(got >= 0, self.best[got], 0) * weight).sum(axis=1)
                parts.append((lev, 2 * lo[pick] + half, got, top_of))
            lev, at, got, top_of = (np.concatenate(x) for x in zip(*parts))
            ready = (lev == 0) & (top_of > 0) & (top_of >= least)
            if ready.any():
                found_col, found = np.append(found_col, at[ready]), np.append(found, top_of[ready])
                if len(found) >= top:
                    least = max(least, int(np.partition(found, len(found) - top)[len(found) - top]))
                    near = found >= least
                    found_col, found = found_col[near], found[near]
            go = (lev > 0) & (top_of > 0)
            level = np.concatenate((level[stay], lev[go]))
            lo, cells = np.concatenate((lo[stay], at[go])), np.concatenate((cells[stay], got[go]))
            bound = np.concatenate((bound[stay], top_of[go]))
            near = bound >= least
            level, lo, cells, bound = level[near], lo[near], cells[near], bound[near]
        return found_col, found


class _Best:
    """The best documents of an item so far: score, then id (nulls last)."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    def least(self) -> int:
        return self.rows[-1][0] if len(self.rows) == self.top else 0

    def add(self, ids: list, scores: list) -> None:
        rows = self.rows + list(zip(scores, ids))
        rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        self.rows = rows[:self.top]


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weights(df: dict[int, int], n_docs: int) -> dict[int, int]:
    return {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}


def search(posted: DataFrame, items: list[tuple[int | None, list[int]]], asked: np.ndarray,
           df: dict[int, int], n_docs: int, n_terms: int, top: int = TOP,
           shard_docs: int = SHARD_DOCS, shard_cells: int = SHARD_CELLS) -> DataFrame:
    """(item, doc_id, score): the best documents of each task for each item."""
    asked = np.sort(asked)
    order = sorted(df, key=lambda t: (-df[t], t))          # rows: frequent terms first
    row_of = np.full(len(asked), -1, dtype=np.int64)
    row_of[order] = np.arange(len(order))
    w = weights(df, n_docs)
    weight = np.array([w[t] for t in order], dtype=np.int64)
    place = {h: i for i, h in enumerate(asked.tolist())}
    wanted = []
    for _, terms in items:
        rows = row_of[[place[t] for t in terms]]
        wanted.append(np.sort(rows[rows >= 0]))
    sent = posted.sparkSession.sparkContext.broadcast((row_of, weight, wanted))  # one block of items
    schema = StructType.fromDDL("item int, doc_id long, score long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of, weight, wanted = sent.value
        best = [_Best(top) for _ in wanted]

        def close(ids, cols, rows, values) -> None:
            col, row, value = (np.concatenate(x) for x in (cols, rows, values))
            if not len(row):
                return
            treap = Treap(row, col, value, len(weight), len(ids))
            for b, mine in zip(best, wanted):
                if len(mine):
                    at, score = treap.search(mine, weight[mine], b.least(), top)
                    if len(at):
                        b.add([ids[k] for k in at.tolist()], score.tolist())

        ids, cols, rows, values, cells = [], [], [], [], 0
        for batch in batches:
            terms, tfs = batch.column("terms"), batch.column("tfs")
            doc_ids = batch.column("doc_id").to_pylist()
            n = batch.column("n").to_pylist()
            m = np.array([10 + (90 * x * n_docs) // n_terms for x in n], dtype=np.int64)
            sizes = np.diff(terms.offsets.to_numpy())
            ends = np.cumsum(sizes)
            flat, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
            lo = 0
            while lo < len(n):
                # as many documents as the grid still takes
                base = ends[lo] - sizes[lo]
                room = int(np.searchsorted(ends[lo:] - base, shard_cells - cells, side="right"))
                hi = min(len(n), lo + max(1, min(room, shard_docs - len(ids))))
                part = slice(base, ends[hi - 1])
                col = np.repeat(np.arange(hi - lo), sizes[lo:hi])
                cols.append(col + len(ids))
                rows.append(row_of[flat[part]])
                values.append(impacts(tf[part], m[lo:hi][col]))
                ids += doc_ids[lo:hi]
                cells += int(ends[hi - 1] - base)
                lo = hi
                if len(ids) >= shard_docs or cells >= shard_cells:
                    close(ids, cols, rows, values)
                    ids, cols, rows, values, cells = [], [], [], [], 0
        if ids:
            close(ids, cols, rows, values)
        out = [(k, i, s) for k, b in enumerate(best) for s, i in b.rows]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)

    return posted.mapInArrow(run, schema)


def _blocks(items: DataFrame, block_terms: int) -> list[DataFrame]:
    """Distinct items, dealt to blocks by hash so that each has about ``block_terms`` words at most."""
    items = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    n_words = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 2 + 1
    blocks = -(-n_words // block_terms)
    if blocks == 1:
        return [items]
    mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [items.where(mine == k) for k in range(blocks)]


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, *,
                  block_terms: int = BLOCK_TERMS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every item."""
    spark = docs.sparkSession
    parts = []
    for k, block in enumerate(_blocks(items, block_terms)):
        wanted = item_terms(block)
        asked = np.unique(np.array([t for _, ts in wanted for t in ts], dtype=np.uint64))
        posted = written(postings(docs, asked), "search_postings")
        n_docs, n_terms = posted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # one count for each term that is asked for
        df = {r["t"]: r["df"] for r in posted.select(F.explode("terms").alias("t"))
              .groupBy("t").agg(F.count("*").alias("df")).collect()}
        found = search(posted, wanted, asked, df, n_docs, n_terms, top, shard_docs)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(wanted)],
                                      "item int, item_id long")
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        parts.append(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
                     .join(F.broadcast(names), "item")  # one block of items
                     .select("item_id", "rank", "doc_id", "score"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
