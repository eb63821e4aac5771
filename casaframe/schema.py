"""Schemas, column lists, contract and request rules.

Every list below is a fixed value: results only agree with the original
pipeline when these names, orders and limits are the same.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw columns kept after normalisation, in output order ---
SELECTED_COLUMNS = [
    "order", "pid", "ms_subclass", "ms_zoning", "lot_frontage", "lot_area",
    "street", "lot_shape", "neighborhood", "overall_qual", "overall_cond",
    "year_built", "year_remod_add", "house_style", "bldg_type", "gr_liv_area",
    "total_bsmt_sf", "1st_flr_sf", "2nd_flr_sf", "full_bath", "half_bath",
    "bedroom_abvgr", "kitchen_abvgr", "totrms_abvgrd", "garage_type",
    "garage_yr_blt", "garage_cars", "garage_area", "wood_deck_sf",
    "open_porch_sf", "pool_area", "mo_sold", "yr_sold", "sale_type",
    "sale_condition", "saleprice",
]

# --- fixed values: renames applied after selection ---
RENAMES = {"order": "order_id", "1st_flr_sf": "first_flr_sf", "2nd_flr_sf": "second_flr_sf"}

# --- fixed values: raw table declaration (Spark types for the DDL types) ---
RAW_SCHEMA = T.StructType([
    T.StructField("order_id", T.IntegerType()),
    T.StructField("pid", T.LongType()),
    T.StructField("ms_subclass", T.IntegerType()),
    T.StructField("ms_zoning", T.StringType()),
    T.StructField("lot_frontage", T.DoubleType()),
    T.StructField("lot_area", T.IntegerType()),
    T.StructField("street", T.StringType()),
    T.StructField("lot_shape", T.StringType()),
    T.StructField("neighborhood", T.StringType()),
    T.StructField("overall_qual", T.ShortType()),
    T.StructField("overall_cond", T.ShortType()),
    T.StructField("year_built", T.ShortType()),
    T.StructField("year_remod_add", T.ShortType()),
    T.StructField("house_style", T.StringType()),
    T.StructField("bldg_type", T.StringType()),
    T.StructField("gr_liv_area", T.IntegerType()),
    T.StructField("total_bsmt_sf", T.DoubleType()),
    T.StructField("first_flr_sf", T.IntegerType()),
    T.StructField("second_flr_sf", T.IntegerType()),
    T.StructField("full_bath", T.ShortType()),
    T.StructField("half_bath", T.ShortType()),
    T.StructField("bedroom_abvgr", T.ShortType()),
    T.StructField("kitchen_abvgr", T.ShortType()),
    T.StructField("totrms_abvgrd", T.ShortType()),
    T.StructField("garage_type", T.StringType()),
    T.StructField("garage_yr_blt", T.DoubleType()),
    T.StructField("garage_cars", T.DoubleType()),
    T.StructField("garage_area", T.DoubleType()),
    T.StructField("wood_deck_sf", T.IntegerType()),
    T.StructField("open_porch_sf", T.IntegerType()),
    T.StructField("pool_area", T.IntegerType()),
    T.StructField("mo_sold", T.ShortType()),
    T.StructField("yr_sold", T.ShortType()),
    T.StructField("sale_type", T.StringType()),
    T.StructField("sale_condition", T.StringType()),
    T.StructField("saleprice", T.IntegerType(), nullable=False),
])

# --- fixed values: clean view projection and the columns it fills with 0 ---
CLEAN_COLUMNS = [
    "order_id", "neighborhood", "overall_qual", "year_built", "gr_liv_area",
    "total_bsmt_sf", "full_bath", "bedroom_abvgr", "garage_cars", "garage_area",
    "lot_frontage", "saleprice",
]
CLEAN_ZERO_FILL = ["total_bsmt_sf", "garage_cars", "garage_area", "lot_frontage"]
# clean view filter: saleprice > 0 AND gr_liv_area < 4000 AND saleprice < 500000
CLEAN_MAX_LIVING_AREA = 4000
CLEAN_MAX_PRICE = 500000

# --- fixed values: data contract (column -> kind); "int" must already be integral,
# "float" may be coerced from text, "str" must be text ---
CONTRACT = {
    "overall_qual": "int",
    "gr_liv_area": "float",
    "total_bsmt_sf": "float",
    "full_bath": "int",
    "bedroom_abvgr": "int",
    "garage_cars": "float",
    "garage_area": "float",
    "lot_frontage": "float",
    "neighborhood": "str",
    "saleprice": "float",
}
CONTRACT_POSITIVE = ["saleprice"]

# --- fixed values: scoring request fields ---
# (name, kind, required, lower bound, lower inclusive, upper bound)
REQUEST_FIELDS = [
    ("overall_qual", "int", True, 1, True, 10),
    ("gr_liv_area", "int", True, 0, False, None),
    ("total_bsmt_sf", "float", False, 0, True, None),
    ("full_bath", "int", False, 0, True, None),
    ("bedroom_abvgr", "int", False, 0, True, None),
    ("garage_cars", "float", False, 0, True, None),
    ("garage_area", "float", False, 0, True, None),
    ("lot_frontage", "float", False, 0, True, None),
    ("neighborhood", "str", True, None, None, None),
]

# --- fixed values: derived feature names ---
FEATURE_RATIO_BATH = "ratio_area_banos"
FEATURE_AREA_ROOM = "area_por_habitacion"
FEATURE_HAS_BASEMENT = "tiene_sotano"
FEATURE_HAS_GARAGE = "tiene_garage"
CATEGORY_COLUMN = "neighborhood"
CATEGORY_PREFIX = "nbh"
KEY_COLUMN = "order_id"
TARGET_COLUMN = "saleprice"

# --- fixed values: thresholds and defaults ---
ZSCORE_LIMIT = 3.0
MODIFIED_Z_LIMIT = 3.5
MODIFIED_Z_FACTOR = 0.6745
MODIFIED_Z_MAX_N = 10          # modified z-score is used below this many values
IQR_FACTOR = 1.5
PSI_BINS = 10
PSI_EPSILON = 1e-4
PSI_LIMIT = 0.25
KS_P_LIMIT = 0.05
KS_EXACT_MAX_N = 10000         # exact p-value up to this sample size, asymptotic above
DRIFT_SHARE_THRESHOLD = 0.1
R2_MIN_THRESHOLD = 0.85
SPLIT_TEST_SHARE = 0.2
SPLIT_SEED = 42
MODEL_NAME = "housing_prices_model"
DEFAULT_MODEL_LABEL = "Random Forest"

# --- fixed values: text tokens that pandas' CSV reader treats as missing ---
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
