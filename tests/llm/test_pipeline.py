"""The pipeline's stages: columns, clashing names, empty tables, planted copies."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import SCHEMA, corpus, frame, prose

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Clean documents, exact and near copies, junk, a boilerplate line on every site."""
    rng = random.Random(21)
    clean = [(i, prose(rng, 150)) for i in range(60)]
    shared = "this very line of boilerplate stands on each and every site"
    rows = [(i, t + ("\n" + shared if i < 40 else ""), "en", f"s{i % 10}", 0) for i, t in clean]
    rows += [(100 + i, clean[5][1], "de", f"s{i}", 0) for i in range(3)]
    rows += [(200, clean[6][1] + " end", "en", "s1", 0), (300, "too short", "en", "s1", 0),
             (301, None, "en", "s1", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = tmp_path_factory.mktemp("sf")
    docs.write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{out}/labels.parquet")
    return str(out)


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for name, stage in pipeline.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.schema.names == docs.schema.names and out.dtypes == docs.dtypes
        docs = out.cache()
        seen.append(docs)
    ids = [sorted(r["doc_id"] for r in d.select("doc_id").collect()) for d in seen]
    assert ids[0] == [*range(60), 100, 101, 102, 200]
    texts = {r["doc_id"]: r["text"] for r in seen[1].collect()}
    assert sum("line of boilerplate" in t for t in texts.values()) == 1 and "boilerplate" in texts[0]
    assert len(ids[2]) == len(set(ids[2])) and not {100, 101, 102} & set(ids[2])
    assert set(ids[3]) <= set(ids[2])


def test_run_packs_the_mixture(spark, sf):
    out = pipeline.run(spark, sf)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    per = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert per and max(r["n"] for r in per) <= 1024


@pytest.mark.parametrize("k", range(5))
def test_each_stage_on_odd_and_empty_tables(spark, sf, k):
    name, stage = pipeline.STAGES[k]
    odd = frame(spark, corpus(n=20))
    for c in ("score", "kept", "fp", "pos", "n_removed", "copies", "s", "b", "sequence_id", "label"):
        odd = odd.withColumn(c, F.when(F.col("doc_id") > 3, F.lit("own")))
    out = stage(spark, odd, sf)
    if k < 4:
        assert out.columns == odd.columns
    assert out.count() >= 1
    empty = stage(spark, odd.limit(0), sf)
    assert empty.count() == 0
