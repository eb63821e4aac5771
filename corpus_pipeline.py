"""Training-data pipeline: five stages over the table of documents.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and returns the columns of ``docs`` (the last one returns the packed
pieces); ``run`` writes each result as Parquet and rereads it.  The stages
call the operators with their production settings:

1. quality rules: rejected documents go;
2. line dedup: cross-site boilerplate lines go, and with them documents that
   lose every line (another document keeps each of them);
3. SimHash near-dedup: the least id of each group stays;
4. mixing: documents are repeated to bring sources to their target weights;
5. packing: sequences of 1024 tokens.

Null texts fail the quality rules, so later stages see none unless called on
their own; an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casaframe.llm.common import documents, labels, written
from casaframe.llm.lines import dedup_lines
from casaframe.llm.mixing import mix_sources
from casaframe.llm.packing import pack
from casaframe.llm.quality import quality_rules
from casaframe.llm.simhash import one_of_each


def _same(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality_rules(docs, labels(spark, sf_dir), keep=tuple(docs.columns), prefix="__cf_")
    return _same(judged.where("__cf_kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs, removed="__cf_removed")
    changed = F.col("__cf_removed") > 0
    out = out.where(~(changed & (F.trim("text") == "")))
    if "n_chars" in docs.columns:
        n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, n).otherwise(F.col("n_chars")))
    return _same(out, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _same(mix_sources(docs, copy="__cf_copy", copies="__cf_copies", key="__cf_key"), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, with_ids=False)


STAGES = [("quality rules", quality), ("line dedup", line_dedup),
          ("simhash near-dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

# Hashed n-grams, SimHash and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return docs
