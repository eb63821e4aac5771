"""Toxicity scores: FTRL-proximal logistic regression over hashed n-grams.

Features of a whole text are the hashes of its words, their stems (the
leading 4 and 6 bytes, for compounds never seen whole), word pairs and skip
pairs (one word left out), each present or absent.  The learner keeps one
rate per coordinate and an L1 term that holds most weights at exactly 0, so
the fitted model is a short list of (bucket, weight), small enough to ship
to every task whatever the size of the corpus.

Fitting is spread over a fixed number of shards of a bounded sample of the
labelled rows: each shard runs the learner on its own rows, and the weights
are averaged in Spark (parameter mixing).  Scoring is one pass over the
documents, without a shuffle.

Defined results: a null text counts as empty and gets the score of the
intercept; a document without an id is scored but never learnt from; of
repeated labels for one id the largest wins; without any labelled row (or
with one class only) the score is the smoothed share of toxic labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaframe.llm import words as W
from casaframe.llm.common import append_columns, written

BITS = 20            # feature buckets: 2**BITS
TRAIN_ROWS = 16384   # expected bound of the sample of labelled rows that is learnt from
SHARD_ROWS = 4096    # rows of one learner; their weights are averaged
STEMS = (4, 6)       # bytes of a word that stand for its family
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1
THRESHOLD = 0.7
SEED = 20240607


def _features(hashes: np.ndarray, stems: list[np.ndarray], doc: np.ndarray,
              bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every word, stem, pair and skip pair; bucket 0 is the intercept."""
    feats, docs = [hashes, *stems], [doc] * (1 + len(stems))
    for skip in (1, 2):
        same = doc[:-skip] == doc[skip:]
        feats.append(W.pair(hashes[:-skip][same], hashes[skip:][same], skip))
        docs.append(doc[:-skip][same])
    bucket = (np.concatenate(feats) >> np.uint64(64 - bits)).astype(np.int64)
    return np.concatenate(docs), np.where(bucket == 0, 1, bucket)


def _text_features(texts: list, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    hasher = W.WordHasher(W.ALNUM)
    for first, buf, starts in W.groups(texts, fold=True):
        at, h, *stems = hasher.hashes(buf, STEMS)
        doc = np.searchsorted(starts, at, side="right") - 1
        yield first, len(starts), *_features(h, stems, doc, bits)


class FtrlProximal:
    """Per-coordinate FTRL-proximal; the weights follow from (z, n) on demand."""

    def __init__(self, dims: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros(dims), np.zeros(dims)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, idx: np.ndarray) -> np.ndarray:
        z = self.z[idx]
        l1 = np.where(idx == 0, 0.0, self.l1)
        step = (self.beta + np.sqrt(self.n[idx])) / self.alpha + self.l2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / step)

    def learn(self, idx: np.ndarray, label: float) -> None:
        w = self.weights(idx)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[idx]
        self.z[idx] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[idx] = n + g * g


def fit(labelled: DataFrame, *, train_rows: int = TRAIN_ROWS, shard_rows: int = SHARD_ROWS,
        epochs: int = EPOCHS, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA,
        l1: float = L1, l2: float = L2) -> dict[int, float]:
    """Weights by bucket (0: intercept) learnt from ``labelled`` (doc_id, text, label).

    At most about ``train_rows`` rows are used, chosen by a hash of the id;
    every learner gets about ``shard_rows`` whole texts.
    """
    rows, positive = labelled.agg(F.count("label"), F.sum("label")).first()
    prior = ((positive or 0) + 0.5) / (rows + 1.0)
    if not positive or positive == rows:
        return {0: float(np.log(prior / (1 - prior)))}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000))
    share = min(1.0, train_rows / rows)
    shards = max(1, round(share * rows / shard_rows))
    # every id draws a fixed place and shard, so a retried task learns the same
    sample = (labelled.where(draw < int(share * 1_000_000) + 1)
              .select("doc_id", "text", "label",
                      F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(shards)).alias("shard")))

    def learner(part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(o=part["text"].str.len()).sort_values(["doc_id", "o", "label"])
        # labels alternate evenly through the pass, whatever the ids say
        order = np.argsort(W.mix(part["doc_id"].to_numpy().astype(np.uint64)), kind="stable")
        texts, y = part["text"].to_numpy()[order], part["label"].to_numpy()[order]
        rows = [None] * len(texts)
        for first, n, doc, bucket in _text_features(list(texts), bits):
            key = np.unique((doc << bits) | bucket)
            cut = np.searchsorted(key >> bits, np.arange(n + 1))
            low = (key & ((1 << bits) - 1)).astype(np.int32)
            for i in range(n):
                rows[first + i] = np.concatenate(([0], low[cut[i]:cut[i + 1]]))
        model = FtrlProximal(1 << bits, alpha, beta, l1, l2)
        for _ in range(epochs):
            for idx, label in zip(rows, y):
                model.learn(idx, label)
        every = np.arange(1 << bits)
        w = model.weights(every)
        keep = np.flatnonzero(w)
        return pd.DataFrame({"bucket": np.append(keep, -1).astype(np.int64),
                             "weight": np.append(w[keep], 0.0)})

    mixed = (sample.groupBy("shard").applyInPandas(learner, "bucket long, weight double")
             .groupBy("bucket").agg(F.sum("weight").alias("w"), F.count("*").alias("k")))
    got = {r["bucket"]: (r["w"], r["k"]) for r in mixed.collect()}  # at most 2**bits rows
    learners = got.pop(-1)[1]  # every learner that had rows reports itself once
    return {b: w / learners for b, (w, _) in got.items()}


def score(docs: DataFrame, weights: dict[int, float], *, bits: int = BITS,
          threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``score`` and ``predicted``, in one pass."""
    sc = docs.sparkSession.sparkContext
    buckets = np.array(sorted(b for b in weights if b), dtype=np.int64)
    values = np.array([weights[b] for b in buckets.tolist()])
    model = sc.broadcast((buckets, values, weights.get(0, 0.0)))

    def make():
        buckets, values, bias = model.value
        dense = np.zeros(1 << bits)
        dense[buckets] = values

        def compute(texts: list) -> tuple[np.ndarray, np.ndarray]:
            logit = np.full(len(texts), bias)
            for first, n, doc, bucket in _text_features(texts, bits):
                live = dense[bucket] != 0
                key = np.unique((doc[live] << bits) | bucket[live])
                logit[first:first + n] += np.bincount(
                    key >> bits, weights=dense[key & ((1 << bits) - 1)], minlength=n)
            p = 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35)))
            return p, (p >= threshold).astype(np.int32)

        return compute

    others = [c for c in docs.columns if c != "text"]
    return append_columns(docs, others, "score double, predicted int", make)


def held_out(doc_id: str = "doc_id"):
    """Rows no label is learnt from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Fit on the labels outside the held-out third, then score all of ``docs``."""
    docs = docs.select("doc_id", "text")
    marks = (labelled.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("double")).alias("label"))
             .where(~held_out()))
    n = marks.count()
    if n > 2 * TRAIN_ROWS:  # only ids that may be drawn travel; the draw itself is in fit()
        draw = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(1_000_000))
        marks = marks.where(draw < int(2 * TRAIN_ROWS / n * 1_000_000) + 1)
    # about 2 * TRAIN_ROWS ids at most, so this side is bounded
    train = docs.join(F.broadcast(marks), "doc_id")
    weights = fit(written(train.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                                       "label"), "toxicity_train"))
    return (score(docs, weights)
            .select("doc_id", held_out().alias("held_out"), "score", "predicted"))
