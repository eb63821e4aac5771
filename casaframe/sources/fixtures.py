"""Housing-shaped views derived from the TPC-H-like test tables.

The SQL text of ``PROPERTIES_RAW_SQL`` is plain ANSI and runs unchanged in
Spark and DuckDB, so the same rows back both the Spark queries and their
SQL oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

PROPERTIES_RAW_SQL = """
SELECT (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS order_id,
       concat('N', lpad(cast(l_suppkey % 12 AS varchar(4)), 2, '0')) AS neighborhood,
       cast(1 + l_partkey % 10 AS int) AS overall_qual,
       cast(1900 + l_suppkey % 100 AS int) AS year_built,
       cast(l_quantity * 100 AS int) AS gr_liv_area,
       nullif(round(l_tax * 10000, 0), 0) AS total_bsmt_sf,
       cast(l_linenumber % 4 AS int) AS full_bath,
       cast(round(l_discount * 100, 0) AS int) AS bedroom_abvgr,
       nullif(cast(l_suppkey % 4 AS double), 0) AS garage_cars,
       nullif(cast((l_suppkey % 4) * 250 AS double), 0) AS garage_area,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE cast(20 + l_partkey % 90 AS double) END AS lot_frontage,
       cast(CASE WHEN l_partkey % 101 = 0 THEN 0
            ELSE 40 * cast(l_quantity AS int) * 100 + 42000 * (1 + l_partkey % 10)
                 + (l_orderkey * 7919 + l_partkey * 31) % 30011 END AS bigint) AS saleprice,
       l_shipdate
FROM {lineitem}
"""

PROPERTIES_CLEAN_SQL = """
SELECT order_id, neighborhood, overall_qual, year_built, gr_liv_area,
       coalesce(total_bsmt_sf, 0) AS total_bsmt_sf, full_bath, bedroom_abvgr,
       coalesce(garage_cars, 0) AS garage_cars, coalesce(garage_area, 0) AS garage_area,
       coalesce(lot_frontage, 0) AS lot_frontage, saleprice
FROM {properties_raw}
WHERE saleprice > 0 AND gr_liv_area < 4000 AND saleprice < 500000
"""

# Reference / current split of the drift pair (naive timestamp, no time zone involved).
DRIFT_CUTOFF = "1998-06-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def properties_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """36-column housing shape reduced to the 12 modelled columns plus a ship date."""
    return spark.sql(PROPERTIES_RAW_SQL, lineitem=table(spark, sf_dir, "lineitem"))


def properties_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    from casaframe.operators.clean import clean_view

    return clean_view(properties_raw(spark, sf_dir))


def drift_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference = rows shipped before the cut-off, current = the rest."""
    from pyspark.sql import functions as F

    raw = properties_raw(spark, sf_dir)
    cut = F.expr(f"timestamp_ntz'{DRIFT_CUTOFF}'")
    ship = F.col("l_shipdate").cast("timestamp_ntz")
    ref = raw.where(ship < cut).drop("order_id", "l_shipdate")
    cur = raw.where(~(ship < cut)).drop("order_id", "l_shipdate")
    return ref, cur


def duckdb_ctes() -> str:
    """The fixture views as a DuckDB WITH prefix for oracle SQL."""
    raw = PROPERTIES_RAW_SQL.replace("{lineitem}", "lineitem")
    clean = PROPERTIES_CLEAN_SQL.replace("{properties_raw}", "properties_raw")
    return f"properties_raw AS ({raw}), properties_clean AS ({clean})"


# Scoring requests derived from lineitem: some rows break the range rules
# (quality 11 and 13, living area not above 0, negative basement area, no
# neighborhood) and some omit optional fields (garage_cars).
REQUESTS_SQL = """
SELECT (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS order_id,
       cast(2 * l_linenumber - 1 AS int) AS overall_qual,
       cast(l_quantity * 100 AS int) - 500 AS gr_liv_area,
       round((l_tax - 0.01) * 10000, 0) AS total_bsmt_sf,
       cast(l_linenumber % 4 AS int) AS full_bath,
       cast(round(l_discount * 100, 0) AS int) AS bedroom_abvgr,
       nullif(cast(l_suppkey % 4 AS double), 0) AS garage_cars,
       cast((l_suppkey % 4) * 250 AS double) AS garage_area,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE cast(20 + l_partkey % 90 AS double) END AS lot_frontage,
       CASE WHEN l_partkey % 97 = 0 THEN NULL
            ELSE concat('N', lpad(cast(l_suppkey % 12 AS varchar(4)), 2, '0')) END AS neighborhood,
       l_shipdate
FROM {lineitem}
"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REQUESTS_SQL, lineitem=table(spark, sf_dir, "lineitem"))


def duckdb_request_cte() -> str:
    return f"requests AS ({REQUESTS_SQL.replace('{lineitem}', 'lineitem')})"
