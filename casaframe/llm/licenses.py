"""License scans: exact set-similarity join of text blocks with license templates.

A block is a sentence of a line, or any run of words as long as the template
and a quarter more, whatever line breaks or full stops lie within (a wrapped
header, "v. 2.0"); a template is the token set of a license sentence; a block
meets it when it holds at least the threshold share of its tokens.  Tokens
are put in one global order, rarest first by the number of documents that
hold them, counted over the whole corpus.  Then

* prefix filter: a block that meets template T holds one of the first
  |T| - need + 1 tokens of T, need being the tokens the threshold asks for;
  documents and then blocks without any such token are passed over, and only
  runs around such a token are looked at;
* length filter: the block must hold at least ``need`` template tokens;
* positional filter: behind the first common token both sides must have
  enough tokens left to reach ``need``;
* verification: the exact overlap.

Templates are a fixed list, so their side of the join is a constant in the
plan: one pass counts frequencies, one pass scans, no text is shuffled.
Every template that a block meets gives its label, unless the tokens it
matched are a proper subset of those that a better one (by containment, then
size) matched there: the GPL 2 sentence within that of GPL 3 gives no label.
For a run, "there" is the run and the words around it that its extra quarter
allows; only templates that meet the threshold there count.

Next to the join stand the base labels: phrases whose words follow each
other.  All of it is DataFrame expressions.

Defined results: a null text is empty; empty texts have no words, labels or
score; repeated rows are scanned each on their own.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_ENDS = r"[\n;]|[.!?][ \t\r\n]+"
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"),
           ("cc by nc", "cc-by-nc"))
TEMPLATES = (
    ("all-rights-reserved", "all rights reserved"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of "
            "conditions and the following disclaimer"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "it under the terms of the gnu general public license as published by the free "
              "software foundation either version 3 of the license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), GAPS), "")


def token_order(docs: DataFrame, templates=TEMPLATES) -> list[str]:
    """The templates' tokens, rarest first by documents that hold them (ties by name)."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    held = F.array_intersect(words(F.coalesce("text", F.lit(""))), F.lit(vocabulary))
    counted = docs.select(F.explode(held).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    n = {r["w"]: r["n"] for r in counted.collect()}  # at most the templates' tokens
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


class Template:
    def __init__(self, label: str, text: str, order: list[str], threshold: float):
        rank = {w: i for i, w in enumerate(order)}
        self.label, self.tokens = label, sorted(set(text.split()), key=rank.__getitem__)
        self.need = max(1, math.ceil(threshold * len(self.tokens) - 1e-9))
        self.prefix = self.tokens[:len(self.tokens) - self.need + 1]
        self.run = len(text.split()) * 5 // 4
        self.slack = self.run - len(text.split())

    def containment(self, held: Column) -> Column:
        """Share of the template in ``held`` (the block's template tokens, rarest first), or 0."""
        mine, size = F.lit(self.tokens), len(self.tokens)
        first = F.get(F.array_intersect(mine, held), 0)
        left = F.least(F.lit(size) - F.array_position(mine, first),
                       F.size(held) - F.array_position(held, first)) + 1
        overlap = F.size(F.array_intersect(mine, held))
        passes = ((F.size(held) >= self.need) & F.arrays_overlap(F.lit(self.prefix), held)
                  & (left >= self.need) & (overlap >= self.need))
        return F.when(passes, overlap / F.lit(float(size))).otherwise(0.0)


def _fit(t: Template, containment: Column, held: Column) -> Column:
    """One template against one block: what it matched there and how well."""
    return F.struct(F.lit(t.label).alias("label"),
                    F.struct(containment.alias("containment"),
                             F.lit(len(t.tokens)).alias("size")).alias("fit"),
                    F.array_intersect(F.lit(t.tokens), held).alias("tokens"))


def _within(x: Column, better: Column) -> Column:
    """Whether ``better`` fits better and matched all tokens of ``x`` and more."""
    return ((better["fit"] > x["fit"]) & (F.size(better["tokens"]) > F.size(x["tokens"]))
            & (F.size(F.array_except(x["tokens"], better["tokens"])) == 0))


def _meets_better(x: Column, u: Column, y: Column) -> Column:
    """Whether template ``u``, fitting like ``y``, meets the threshold and leaves ``x`` no label."""
    return (F.size(y["tokens"]) >= u["need"]) & _within(x, y)


def block_labels(text: Column, order: list[str], templates=TEMPLATES,
                 threshold: float = THRESHOLD) -> Column:
    """array<struct<block, label, containment, best>> of the sentences of one text that meet a template."""
    known = [Template(label, t, order, threshold) for label, t in templates]
    prefixes = sorted({w for t in known for w in t.prefix})
    blocks = F.split(F.translate(text, UPPER, LOWER), BLOCK_ENDS)
    # blocks without a prefix token are dropped before anything is compared
    held = F.filter(
        F.transform(blocks, lambda b, i: F.struct(
            i.alias("block"),
            F.array_intersect(F.lit(order), F.split(b, GAPS)).alias("held"))),
        lambda b: F.arrays_overlap(b["held"], F.lit(prefixes)))
    met = F.transform(held, lambda b: F.struct(b["block"].alias("block"), F.filter(
        F.array(*[_fit(t, t.containment(b["held"]), b["held"]) for t in known]),
        lambda x: x["fit"]["containment"] > 0).alias("met")))

    def labelled(b: Column) -> Column:
        own = F.filter(b["met"], lambda x: ~F.exists(b["met"], lambda y: _within(x, y)))
        return F.transform(own, lambda x: F.struct(
            b["block"].alias("block"), x["label"].alias("label"),
            x["fit"]["containment"].alias("containment"),
            (~F.exists(b["met"], lambda y: y["fit"] > x["fit"])).alias("best")))

    return F.flatten(F.transform(met, labelled))


def run_labels(w: Column, order: list[str], templates=TEMPLATES,
               threshold: float = THRESHOLD) -> Column:
    """array<struct<label, containment>> of the runs of words that meet a template.

    A run that meets one holds a prefix token of it, so every start is covered
    by the runs around each such token.
    """
    known = [Template(label, t, order, threshold) for label, t in templates]
    prefixes = sorted({x for t in known for x in t.prefix})
    marked = F.transform(w, lambda x, i: F.when(x.isin(prefixes), i).otherwise(-1))
    # the templates as one constant array: the plan does not grow with their pairs
    table = F.array(*[F.struct(
        F.lit(t.label).alias("label"), F.lit(len(t.tokens)).alias("size"),
        F.lit(t.need).alias("need"), F.lit(t.run).alias("run"), F.lit(t.slack).alias("slack"),
        F.lit(t.tokens).alias("tokens"),
        F.lit(t.prefix).alias("prefix")) for t in known])

    def fit(t: Column, tokens: Column) -> Column:
        return F.struct(t["label"].alias("label"), F.struct(
            (F.size(tokens) / t["size"].cast("double")).alias("containment"),
            t["size"].alias("size")).alias("fit"), tokens.alias("tokens"))

    def around(i: Column) -> Column:
        near = F.filter(table, lambda t: F.array_contains(t["prefix"], F.get(w, i)) & (F.size(
            F.array_intersect(t["tokens"], F.slice(w, F.greatest(i - t["run"] + 2, F.lit(1)),
                                                   F.least(i + 1, t["run"]) + t["run"] - 1))) >= t["need"]))
        return F.flatten(F.transform(near, lambda t: judged(t, i)))

    def judged(t: Column, i: Column) -> Column:
        # every run that holds word i, and the same with a few words more on either side
        runs = F.transform(
            F.sequence(F.greatest(i - t["run"] + 1, F.lit(0)), i),
            lambda s: F.struct(
                fit(t, F.array_intersect(t["tokens"], F.slice(w, s + 1, t["run"]))).alias("x"),
                F.slice(w, F.greatest(s - t["slack"], F.lit(0)) + 1,
                        F.least(s, t["slack"]) + t["run"] + t["slack"]).alias("wide")))
        met = F.filter(runs, lambda r: F.size(r["x"]["tokens"]) >= t["need"])
        own = F.filter(met, lambda r: ~F.exists(table, lambda u: _meets_better(
            r["x"], u, fit(u, F.array_intersect(u["tokens"], r["wide"])))))
        best = F.array_max(F.transform(own, lambda r: r["x"]["fit"]["containment"]))
        return F.when(F.size(own) > 0, F.array(F.struct(
            t["label"].alias("label"), best.alias("containment")))).otherwise(F.array().cast(
                "array<struct<label:string,containment:double>>"))

    return F.flatten(F.transform(F.filter(marked, lambda i: i >= 0), around))


def phrase_places(w: Column, phrase: str) -> Column:
    """0-based word places where the phrase's words stand one after the other."""
    want = phrase.split()
    last = F.size(w) - len(want)
    rare = want[-2] if want[-1].isdigit() else want[-1]
    hit = lambda i: reduce(lambda a, b: a & b, [
        F.get(w, i + k) == x for k, x in enumerate(want)])
    return F.when((last >= 0) & F.array_contains(w, rare),
                  F.filter(F.sequence(F.lit(0), last), hit)).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, n_words, places (phrase, word), matches (block, label, containment), met.

    ``matches`` are the best templates of each sentence, ``met`` all (label,
    containment) that a sentence or a run of words meets.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = token_order(docs, templates)
    prefixes = sorted({w for label, t in templates for w in
                       Template(label, t, order, threshold).prefix})
    candidate = F.arrays_overlap("w", F.lit(prefixes))
    rows = docs.withColumn("w", words(F.col("text"))).select(
        "*", F.when(candidate, block_labels(F.col("text"), order, templates, threshold)).alias("hits"),
        F.when(candidate, run_labels(F.col("w"), order, templates, threshold)).alias("runs"))

    def named(phrase: str, label: str) -> Column:
        return F.transform(phrase_places(F.col("w"), phrase), lambda i: F.struct(
            i.cast("long").alias("word"), F.lit(label).alias("label")))

    places = F.flatten(F.array(*[named(*p) for p in phrases]))
    matches = F.transform(F.filter("hits", lambda h: h["best"]), lambda h: F.struct(
        h["block"].alias("block"), h["label"].alias("label"), h["containment"].alias("containment")))
    met = F.concat(F.transform("hits", lambda h: F.struct(
        h["label"].alias("label"), h["containment"].alias("containment"))), F.col("runs"))
    return rows.select("doc_id", F.size("w").cast("long").alias("n_words"),
                       places.alias("places"),
                       F.coalesce(matches, F.expr(
                           "CAST(array() AS array<struct<block:int,label:string,containment:double>>)"
                       )).alias("matches"),
                       F.coalesce(met, F.expr(
                           "CAST(array() AS array<struct<label:string,containment:double>>)"
                       )).alias("met"))


def license_report(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    base = F.transform("places", lambda p: p["label"])
    method = F.transform("met", lambda m: m["label"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    starts = F.transform("places", lambda p: p["word"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, method)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(
            F.transform("met", lambda m: m["containment"])), F.lit(0.0))).alias("score"))
