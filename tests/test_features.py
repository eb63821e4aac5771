from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from casaframe.functions.names import normalize_columns, select_known_columns
from casaframe.operators.features import (CategoryEncoder, align_features, create_features,
                                          feature_columns, split_xy)


HOUSES = ("k int, gr_liv_area double, full_bath int, bedroom_abvgr int, total_bsmt_sf double, "
          "garage_cars double")


def test_derived_columns_by_hand(spark):
    rng = random.Random(17)
    rows = [(k, rng.choice([None, 640.0, 912.5, 2048.0]), rng.choice([None, 0, 1, 4]),
             rng.choice([None, 0, 2, 6]), rng.choice([None, -1.0, 0.0, 333.0]),
             rng.choice([None, 0.0, 0.5, 3.0])) for k in range(60)]
    got = {r.k: r for r in create_features(spark.createDataFrame(rows, HOUSES)).collect()}
    ratio = lambda a, b: None if a is None or b is None else a / (b + 1)
    for k, area, bath, rooms, cellar, cars in rows:
        assert got[k].ratio_area_banos == ratio(area, bath)
        assert got[k].area_por_habitacion == ratio(area, rooms)
        assert got[k].tiene_sotano == int(cellar is not None and cellar > 0)
        assert got[k].tiene_garage == int(cars is not None and cars > 0)


def test_zero_denominator_is_null_not_error(spark):
    # full_bath = -1 makes the denominator 0: NULL, never an ANSI error or infinity
    df = spark.createDataFrame([(1500, -1, -1, 1.0, 1.0)],
                               "gr_liv_area int, full_bath int, bedroom_abvgr int, "
                               "total_bsmt_sf double, garage_cars double")
    r = create_features(df).first()
    assert r.ratio_area_banos is None and r.area_por_habitacion is None


def test_one_hot_drops_first_sorted_category_and_zero_fills(spark):
    df = spark.createDataFrame([(1, "Quay"), (2, "Mews"), (3, "Dale"), (4, None)],
                               "k int, neighborhood string")
    enc = CategoryEncoder.fit(df)
    assert enc.categories == ["Dale", "Mews", "Quay"]
    out = enc.transform(df)
    assert out.columns == ["k", "nbh_Mews", "nbh_Quay"]
    rows = {r.k: (r.nbh_Mews, r.nbh_Quay) for r in out.collect()}
    assert rows == {1: (0, 1), 2: (1, 0), 3: (0, 0), 4: (0, 0)}
    unseen = spark.createDataFrame([(9, "Unknown")], "k int, neighborhood string")
    assert enc.transform(unseen).first().asDict() == {"k": 9, "nbh_Mews": 0, "nbh_Quay": 0}


def test_many_categories_encode_and_align(spark):
    df = spark.range(1500).select(F.col("id").alias("k"), F.concat(
        F.lit("zone."), F.lpad(F.col("id").cast("string"), 4, "0")).alias("neighborhood"))
    enc = CategoryEncoder.fit(df)
    assert len(enc.categories) == 1500 and len(enc.output_columns) == 1499


def test_align_order_fill_and_drop(spark):
    df = spark.createDataFrame([(1, 7, 1500, 99)], "order_id int, overall_qual int, "
                               "gr_liv_area int, extra int")
    names = ["gr_liv_area", "nbh_X", "overall_qual", "tiene_garage"]
    out = align_features(df, names)
    assert out.columns == names
    assert out.first().asDict() == {"gr_liv_area": 1500, "nbh_X": 0, "overall_qual": 7,
                                    "tiene_garage": 0}
    assert align_features(df, names, keep=["order_id"]).columns[0] == "order_id"


def test_split_xy_keeps_key(spark):
    df = spark.createDataFrame([(1, 5, 100.0)], "order_id int, overall_qual int, saleprice double")
    x, y = split_xy(df)
    assert x.columns == ["order_id", "overall_qual"]
    assert y.columns == ["order_id", "saleprice"]
    assert feature_columns(df) == ["overall_qual"]


def test_normalize_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2.0)], "`Sale Price` int, `Lot/Area` double")
    assert normalize_columns(df).columns == ["sale_price", "lot_area"]
    clash = spark.createDataFrame([(1, 2)], "`A B` int, `a_b` int")
    with pytest.raises(ValueError, match="A B"):
        normalize_columns(clash)


def test_select_known_skips_missing_and_renames(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`order` int, `1st_flr_sf` int, saleprice int")
    out = select_known_columns(df)
    assert out.columns == ["order_id", "first_flr_sf", "saleprice"]


def test_category_values_with_dots_and_spaces(spark):
    from casaframe.operators.features import prepare

    df = spark.createDataFrame(
        [(1, "St. Louis", 1500, 2, 3, 10.0, 1.0, 100.0), (2, "A-B C", 1600, 1, 2, 0.0, 0.0, 200.0),
         (3, "Zed", 1700, 2, 2, 5.0, 2.0, 300.0)],
        "order_id int, neighborhood string, gr_liv_area int, full_bath int, bedroom_abvgr int, "
        "total_bsmt_sf double, garage_cars double, saleprice double")
    prepared, enc = prepare(df)
    assert "nbh_St. Louis" in prepared.columns and "nbh_Zed" in prepared.columns
    aligned = align_features(prepared, ["nbh_St. Louis", "gr_liv_area", "nbh_None"], keep=["order_id"])
    assert {r.order_id: r["nbh_St. Louis"] for r in aligned.collect()} == {1: 1, 2: 0, 3: 0}
    x, y = split_xy(prepared)
    assert "nbh_St. Louis" in x.columns and y.columns == ["order_id", "saleprice"]
