"""Quality rules: base text statistics and a hashed n-gram likelihood ratio.

Two multinomials over hashed words and word pairs are counted over whole
tables: one over the trusted documents (quality label 1), one over every
document.  Each distinct text counts once on both sides, however many rows
repeat it (and is trusted if any of them is), so leaving a text's own n-grams
out leaves out those of all its copies.  A document's score is the mean over its n-grams of
log(p_trusted / p_raw), so it does not depend on the length; both are
smoothed alike at the size of the trusted corpus.  A document is kept when the score reaches a fixed threshold and the base rules pass.

A first pass finds the repeated texts by their 64-bit hashes, of which only
those are shuffled.  Counting is one pass whose tasks each send at most 2**BITS
counters; scoring is a third pass with the 2 x 2**BITS counts shipped to every
task (1 MB).  No text is shuffled, but in the join of more than a million
repeated texts.

Defined results: a null text has no words (and so fails the base rules); a
repeated id is trusted if any of its quality labels is 1; without trusted
documents every ratio is 0 and only the base rules decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaframe.llm import words as W
from casaframe.llm.common import append_columns, join_small, written

BITS = 16
SMOOTHING = 4.0       # pseudo-count of each bucket, at the size of the trusted corpus
THRESHOLD = -0.1      # mean log ratio per n-gram below which a document is rejected
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def _grams(h: np.ndarray, doc: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    same = doc[:-1] == doc[1:]
    gram = np.concatenate((h, W.pair(h[:-1][same], h[1:][same], 1)))
    return (np.concatenate((doc, doc[:-1][same])),
            (gram >> np.uint64(64 - bits)).astype(np.int64))


def _repeated_words(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per text: words in a 3-word window that the text holds at least twice."""
    if len(h) < 3:
        return np.zeros(n, dtype=np.int64)
    ok = np.flatnonzero(doc[:-2] == doc[2:])
    key = W.pair(W.pair(h[ok], h[ok + 1], 1), h[ok + 2] + doc[ok].astype(np.uint64), 2)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marked = np.zeros(len(h), dtype=bool)
    for k in range(3):
        marked[ok[twice] + k] = True
    return np.bincount(doc[marked], minlength=n)


def _dup_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def distinct_weights(docs: DataFrame, trusted: str, copies: str) -> DataFrame:
    """(text, trusted, copies) of every row: the rows with its text, and if any of them is trusted."""
    h, any_trusted = "__cf_hash", "__cf_any"
    keyed = docs.select("text", trusted, F.xxhash64("text").alias(h))
    repeated = written(
        keyed.where("text IS NOT NULL").groupBy(h).agg(
            F.count("*").alias(copies), F.max(trusted).alias(any_trusted)).where(F.col(copies) > 1),
        "quality_copies")
    return join_small(keyed, repeated, h, "left").select(
        "text", F.coalesce(any_trusted, trusted).alias(trusted),
        F.coalesce(copies, F.lit(1)).alias(copies))


def gram_counts(docs: DataFrame, trusted: str, bits: int = BITS) -> DataFrame:
    """(bucket, trusted_count, raw_count) over every n-gram of the distinct texts of ``docs``."""
    copies = "__cf_copies"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = W.WordHasher(W.NOT_SPACE)
        raw, good = np.zeros(1 << bits), np.zeros(1 << bits)
        for pdf in batches:
            flag = pdf[trusted].to_numpy(dtype=bool)
            share = 1.0 / pdf[copies].to_numpy(dtype=np.float64)
            for first, buf, starts in W.groups(pdf["text"].tolist(), fold=True):
                at, h = hasher.hashes(buf)
                doc, bucket = _grams(h, np.searchsorted(starts, at, side="right") - 1, bits)
                part, mine = share[first + doc], flag[first + doc]
                raw += np.bincount(bucket, weights=part, minlength=1 << bits)
                good += np.bincount(bucket[mine], weights=part[mine], minlength=1 << bits)
        live = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": live, "t": good[live], "r": raw[live]})

    # the shares of a text's copies add up to 1, so the sums are whole but for rounding
    return (distinct_weights(docs, trusted, copies)
            .mapInPandas(run, "bucket long, t double, r double")
            .groupBy("bucket").agg(F.round(F.sum("t")).cast("long").alias("trusted_count"),
                                   F.round(F.sum("r")).cast("long").alias("raw_count")))


def collected(counts: DataFrame, bits: int = BITS) -> np.ndarray:
    """Trusted and raw counts by bucket, 2 x 2**bits; at most that many rows reach the driver."""
    out = np.zeros((2, 1 << bits))
    for row in counts.collect():
        out[:, row["bucket"]] = row["trusted_count"], row["raw_count"]
    return out


def mean_log_ratio(doc: np.ndarray, bucket: np.ndarray, n: int, counts: np.ndarray,
                   smoothing: float = SMOOTHING) -> np.ndarray:
    """Per text the mean of log(p_trusted / p_raw) over its n-grams.

    The raw counts, in which each distinct text stands once, are taken without
    the text's own n-grams and scaled to the
    trusted total, so both sides have one sum and one smoothing: an n-gram
    seen nowhere else is neutral, in a corpus of any size.
    """
    trusted, raw = counts
    if not trusted.sum() or not len(doc):
        return np.zeros(n)
    bits = int(len(raw)).bit_length() - 1
    pairs, own = np.unique((doc << bits) | bucket, return_counts=True)
    d, b = pairs >> bits, pairs & ((1 << bits) - 1)
    others = np.maximum(raw[b] - own, 0) * (trusted.sum() / raw.sum())
    ratio = np.log((trusted[b] + smoothing) / (others + smoothing))
    return (np.bincount(d, weights=own * ratio, minlength=n)
            / np.maximum(1, np.bincount(d, weights=own, minlength=n)))


def quality_scores(docs: DataFrame, counts: np.ndarray, *, bits: int = BITS,
                   threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",),
                   prefix: str = "") -> DataFrame:
    """The ``keep`` columns with base statistics, mean log ratio and verdict of every row.

    ``prefix`` is put before the names of the new columns, for inputs that
    already have columns of these names.
    """
    model = docs.sparkSession.sparkContext.broadcast(counts)
    new = [prefix + c for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                "n_repeat_words", "base_failed", "kept", "score")]
    ddl = ", ".join(f"`{c}` {t}" for c, t in zip(new, ["long"] * 5 + ["boolean"] * 2 + ["double"]))

    def make():
        counts, hasher = model.value, W.WordHasher(W.NOT_SPACE)

        def compute(texts: list) -> list:
            got = np.zeros((5, len(texts)), dtype=np.int64)
            mean = np.zeros(len(texts))
            for first, buf, starts in W.groups(texts, fold=False):
                n = len(starts)
                span = slice(first, first + n)
                in_word = W.NOT_SPACE[buf]
                got[1, span] = np.add.reduceat(in_word & ((buf & 0xC0) != 0x80), starts,
                                               dtype=np.int64)
                got[2, span] = np.add.reduceat(SYMBOLS[buf], starts, dtype=np.int64)
                at, h = hasher.hashes(buf)
                doc = np.searchsorted(starts, at, side="right") - 1
                got[0, span] = np.bincount(doc, minlength=n)
                got[4, span] = _repeated_words(h, doc, n)
                folded = np.frombuffer(buf.tobytes().translate(W.LOWER), dtype=np.uint8)
                doc, bucket = _grams(hasher.hashes(folded)[1], doc, bits)
                mean[span] = mean_log_ratio(doc, bucket, n, counts)
            got[3] = [_dup_lines(t) for t in texts]
            failed = (got[0] < MIN_WORDS) | (100 * got[4] > MAX_REPEAT_PCT * got[0])
            return [*got, failed, ~failed & (mean >= threshold), mean]

        return compute

    return append_columns(docs, list(keep), ddl, make)


def quality_rules(docs: DataFrame, labelled: DataFrame, *, keep: tuple[str, ...] = ("doc_id",),
                  prefix: str = "", threshold: float = THRESHOLD) -> DataFrame:
    """Count both multinomials over all of ``docs``, then judge every document."""
    flag = "__cf_trusted"
    good = (labelled.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
            .withColumn(flag, F.lit(True)))
    marked = join_small(docs.select("doc_id", "text"), good, "doc_id", "left").select(
        "text", F.coalesce(F.col(flag), F.lit(False)).alias(flag))
    return quality_scores(docs, collected(gram_counts(marked, flag)), keep=keep, prefix=prefix,
                          threshold=threshold)
