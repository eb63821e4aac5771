"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from casaframe.session import shared_dir

# Rows of a (long, small value) side that may be broadcast: about 50 MB of
# hash table.  Beyond it the same join runs as an ordinary shuffled join.
MAX_BROADCAST_ROWS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back (cuts lineage).

    The tables stay there, under ``casaframe/llm``: results are read from
    them lazily, so only their reader knows when they may go.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_small(left: DataFrame, right: DataFrame, on: str | list[str], how: str) -> DataFrame:
    """Join; broadcast ``right`` only after its rows have been counted and are few."""
    small = right.count() <= MAX_BROADCAST_ROWS
    return left.join(F.broadcast(right) if small else right, on, how)


def append_columns(docs: DataFrame, keep: list[str], new: str, make: Callable) -> DataFrame:
    """The ``keep`` columns of ``docs``, unchanged, and columns computed from its texts.

    ``new`` is a DDL list of the added columns; ``make()`` runs once per task
    and returns a function from a list of texts to one sequence per column.
    The kept columns pass as Arrow arrays, so any type and null survives.
    """
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    added = StructType.fromDDL(new)
    schema = StructType([*kept.schema.fields, *added.fields])
    types = [(f.name, t) for f, t in zip(added.fields, to_arrow_schema(added).types)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            got = compute(batch.column("text").to_pylist())
            arrays = [batch.column(c) for c in keep]
            arrays += [pa.array(v, type=t) for v, (_, t) in zip(got, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *[n for n, _ in types]])

    need = dict.fromkeys([*keep, "text"])
    return docs.select(*[F.col(f"`{c}`") for c in need]).mapInArrow(run, schema)
