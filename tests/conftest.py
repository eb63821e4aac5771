from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def valid_frame(spark):
    """Four valid rows (the contract's shape), no two of them equal."""
    return spark.createDataFrame(
        [(3, 842.5, 611.0, 1, 1, 0.0, 0.0, 41.5, "Harbour", 73250.0),
         (9, 2310.0, 1204.0, 3, 5, 3.0, 720.0, 98.0, "Hillside", 412900.0),
         (4, 977.0, 0.0, 1, 2, 1.0, 231.0, 52.0, "Mill Row", 91400.0),
         (8, 1768.0, 930.5, 2, 4, 2.0, 515.0, 77.0, "Harbour", 268000.0)],
        "overall_qual bigint, gr_liv_area double, total_bsmt_sf double, full_bath bigint, "
        "bedroom_abvgr bigint, garage_cars double, garage_area double, lot_frontage double, "
        "neighborhood string, saleprice double")


@pytest.fixture(scope="module", autouse=True)
def _no_cached_frames_left(spark):
    """A module's cached frames end with it: others count what is kept."""
    yield
    spark.catalog.clearCache()
