"""Column-name normalisation and known-column projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaframe import schema


def normalize_name(name: str) -> str:
    """Lower case; space and slash become underscore."""
    return name.lower().replace(" ", "_").replace("/", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its normalised form; refuse names that collide."""
    seen: dict[str, str] = {}
    for raw in df.columns:
        norm = normalize_name(raw)
        if norm in seen:
            raise ValueError(
                f"columns {seen[norm]!r} and {raw!r} both normalise to {norm!r}")
        seen[norm] = raw
    return df.toDF(*[normalize_name(c) for c in df.columns])


def select_known_columns(df: DataFrame, wanted: list[str] | None = None,
                         renames: dict[str, str] | None = None) -> DataFrame:
    """Keep the wanted columns that exist, in list order, and apply renames.

    Missing columns are skipped without error, as in the raw ingest.
    """
    wanted = schema.SELECTED_COLUMNS if wanted is None else wanted
    renames = schema.RENAMES if renames is None else renames
    present = set(df.columns)
    return df.select([F.col(f"`{c}`").alias(renames.get(c, c)) for c in wanted if c in present])
