"""Clean view: zero-fill four columns and drop out-of-range rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaframe import schema


def clean_filter(df: DataFrame):
    """saleprice > 0 AND gr_liv_area < 4000 AND saleprice < 500000.

    Written on stored columns so the comparisons reach the Parquet scan as
    pushed filters; a NULL operand rejects the row.
    """
    price, area = F.col("saleprice"), F.col("gr_liv_area")
    return (price > 0) & (area < schema.CLEAN_MAX_LIVING_AREA) & (price < schema.CLEAN_MAX_PRICE)


def clean_view(df: DataFrame) -> DataFrame:
    """The 12-column clean projection over the raw table (lazy, inlined by Catalyst)."""
    return df.where(clean_filter(df)).select(*[x.alias(c) for c, x in clean_values().items()])


def clean_values() -> dict:
    """The view's columns as expressions over the raw ones."""
    return {c: F.coalesce(F.col(c), F.lit(0)) if c in schema.CLEAN_ZERO_FILL else F.col(c)
            for c in schema.CLEAN_COLUMNS}


def register_clean_view(df: DataFrame, raw_name: str = "properties_raw",
                        view_name: str = "vw_properties_clean") -> DataFrame:
    """Register raw and clean views in the session catalog, replacing old ones."""
    df.createOrReplaceTempView(raw_name)
    clean = clean_view(df.sparkSession.table(raw_name))
    clean.createOrReplaceTempView(view_name)
    return clean
