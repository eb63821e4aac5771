"""Sinks: replace a table and its clean view, write the prepared dataset, CSV export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from casaframe.operators.clean import clean_view
from casaframe.sources.snapshots import publish, read_published


def replace_table(df: DataFrame, path: str, raw_view: str = "properties_raw",
                  clean_name: str = "vw_properties_clean",
                  before_commit: Callable[[], None] | None = None) -> DataFrame:
    """Publish the raw table at ``path`` (Parquet, no index column), then recreate
    the raw and clean views over the new snapshot.  Returns the clean view."""
    spark = df.sparkSession
    publish(df, path, before_commit)
    raw = read_published(spark, path)
    raw.createOrReplaceTempView(raw_view)
    clean = clean_view(raw)
    clean.createOrReplaceTempView(clean_name)
    return clean


def write_prepared(df: DataFrame, path: str) -> str:
    """One dataset with key, features and target, so rows stay paired."""
    publish(df, path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with header, no index; missing values as empty cells, quotes doubled, spaces kept."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def raw_table_ddl(name: str, location: str, table_schema=None) -> str:
    """``CREATE TABLE ... USING parquet`` text for the declared raw schema."""
    from casaframe import schema as sch

    fields = (table_schema or sch.RAW_SCHEMA).fields
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}"
                        + ("" if f.nullable else " NOT NULL") for f in fields)
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING parquet LOCATION '{location}'"
