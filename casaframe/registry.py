"""Named queries over the test tables and their DuckDB oracle SQL.

Each query takes (spark, sf_dir) and returns a DataFrame built by the
library operators over whole tables.  ``ORACLE`` holds, for the queries
that SQL can express, an independent statement of the same result for
DuckDB (tables are registered there as views of the same Parquet files).
Computed columns carry the same alias on both sides; doubles are rounded
to 6 places on both sides.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casaframe import schema
from casaframe.functions.names import normalize_columns, select_known_columns
from casaframe.operators import drift, duplicates, features, model, outliers, profile, validate
from casaframe.operators.clean import clean_view
from casaframe.operators.split import is_test_row
from casaframe.session import shared_dir
from casaframe.sources import fixtures as fx
from casaframe.sources.readers import read_csv
from casaframe.sources.sinks import write_csv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + "\n"


FIX = fx.duckdb_ctes()
RAW_COLS = ["order_id", "neighborhood", "overall_qual", "year_built", "gr_liv_area",
            "total_bsmt_sf", "full_bath", "bedroom_abvgr", "garage_cars", "garage_area",
            "lot_frontage", "saleprice", "l_shipdate"]
DRIFT_COLS = ["overall_qual", "year_built", "gr_liv_area", "total_bsmt_sf", "full_bath",
              "bedroom_abvgr", "garage_cars", "garage_area", "lot_frontage", "saleprice"]
OUTLIER_COLS = ["gr_liv_area", "total_bsmt_sf", "garage_area", "lot_frontage", "saleprice"]
IMPUTE_COLS = ["total_bsmt_sf", "garage_cars", "garage_area", "lot_frontage"]
SCALE_COLS = ["overall_qual", "gr_liv_area", "saleprice"]


# ------------------------------------------------------------------ load / project

@query("raw_profile", _with(FIX) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
    f"CAST(count(*) AS BIGINT) AS row_count, CAST({len(RAW_COLS)} AS BIGINT) AS column_count "
    f"FROM properties_raw" for c in RAW_COLS))
def q_raw_profile(spark, sf):
    return profile.raw_profile(fx.properties_raw(spark, sf))


@query("ingest_profile", ORACLE["raw_profile"])
def q_ingest_profile(spark, sf):
    """The raw profile taken by the pass that publishes the table."""
    from casaframe.sources.snapshots import publish

    watched, result = profile.observed_profile(fx.properties_raw(spark, sf))
    publish(watched, shared_dir(spark, "scratch", "observed", unique=True))
    got = result()
    return spark.createDataFrame(
        [(c, n, got["row_count"], got["column_count"]) for c, n in got["null_counts"].items()],
        "column_name string, null_count bigint, row_count bigint, column_count bigint")


PART_HEADERS = {"p_partkey": "P PartKey", "p_name": "P Name", "p_brand": "P Brand",
                "p_type": "P/Type", "p_size": "P Size", "p_retailprice": "P RetailPrice"}
PART_WANTED = ["p_partkey", "p_brand", "p_type", "p_container", "p_size", "p_retailprice"]
PART_RENAMES = {"p_partkey": "part_id", "p_retailprice": "retail_price"}


@query("select_rename",
       "SELECT p_partkey AS part_id, p_brand, p_type, p_size, p_retailprice AS retail_price "
       "FROM part")
def q_select_rename(spark, sf):
    part = fx.table(spark, sf, "part")
    shown = part.select([F.col(c).alias(PART_HEADERS[c]) for c in part.columns])
    return select_known_columns(normalize_columns(shown), PART_WANTED, PART_RENAMES)


@query("csv_roundtrip",
       "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) "
       "AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_csv_roundtrip(spark, sf):
    path = shared_dir(spark, "scratch", "customer_csv", unique=True)
    write_csv(fx.table(spark, sf, "customer"), path)
    return read_csv(spark, path)


@query("csv_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_documents(spark, sf):
    """Whole texts through CSV: quotes, line breaks and spaces survive."""
    path = shared_dir(spark, "scratch", "documents_csv", unique=True)
    write_csv(fx.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars"),
              path)
    return read_csv(spark, path)


@query("text_numbers", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS DOUBLE) "
       "WHEN 1 THEN p_retailprice WHEN 2 THEN p_size * 1000.0 ELSE NULL END AS number FROM part")
def q_text_numbers(spark, sf):
    """Text columns as numbers: plain decimals and exponents count, anything else is missing."""
    from casaframe.functions.exprs import to_double

    part = fx.table(spark, sf, "part")
    size, price, k = F.col("p_size").cast("string"), F.col("p_retailprice"), F.col("p_partkey") % 4
    text = (F.when(k == 0, F.concat(F.lit(" "), size, F.lit(" "))).when(k == 1, price.cast("string"))
            .when(k == 2, F.concat(size, F.lit("e3"))).otherwise(F.concat(size, F.lit("d"))))
    shown = part.select("p_partkey", text.alias("size text"))
    return shown.select("p_partkey", to_double("size text", shown.schema["size text"].dataType)
                        .alias("number"))


@query("table_read", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_table_read(spark, sf):
    from casaframe.sources.readers import read_table

    fx.table(spark, sf, "nation").createOrReplaceTempView("cf_nation")
    return read_table(spark, "cf_nation").select("n_nationkey", "n_name", "n_regionkey")


@query("clean_view", _with(FIX) + "SELECT * FROM properties_clean")
def q_clean_view(spark, sf):
    return fx.properties_clean(spark, sf)


FEATURES_SQL = (
    "SELECT *, round(gr_liv_area / nullif(full_bath + 1, 0), 6) AS ratio_area_banos, "
    "round(gr_liv_area / nullif(bedroom_abvgr + 1, 0), 6) AS area_por_habitacion, "
    "CAST(coalesce(total_bsmt_sf > 0, false) AS INTEGER) AS tiene_sotano, "
    "CAST(coalesce(garage_cars > 0, false) AS INTEGER) AS tiene_garage FROM properties_clean")


@query("create_features", _with(FIX) + FEATURES_SQL)
def q_create_features(spark, sf):
    out = features.create_features(fx.properties_clean(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in
                            (schema.FEATURE_RATIO_BATH, schema.FEATURE_AREA_ROOM)})


@query("prepared_roundtrip", ORACLE["create_features"])
def q_prepared_roundtrip(spark, sf):
    """The prepared dataset written and read back; it exists, so nothing is built again."""
    from casaframe.sources.readers import load_prepared
    from casaframe.sources.sinks import write_prepared

    path = shared_dir(spark, "scratch", "prepared", unique=True)
    write_prepared(q_create_features(spark, sf), path)
    return load_prepared(spark, path, lambda: q_create_features(spark, sf).limit(0))


@query("prepared_build", ORACLE["create_features"])
def q_prepared_build(spark, sf):
    """No prepared dataset is there: the plan that builds it is returned."""
    from casaframe.sources.readers import load_prepared

    path = shared_dir(spark, "scratch", "prepared_absent", unique=True)
    return load_prepared(spark, path, lambda: q_create_features(spark, sf))


@query("csv_tabular", ORACLE["csv_documents"])
def q_csv_tabular(spark, sf):
    """Whole texts through the reader chosen by suffix, files split within their quoted cells."""
    from casaframe.sources.readers import read_tabular

    path = shared_dir(spark, "scratch", "tabular", unique=True) + "/documents.csv"
    write_csv(fx.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars"), path)
    return read_tabular(spark, path, split_bytes=1 << 16)


@query("table_replace", "SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey > 1")
def q_table_replace(spark, sf):
    """A published table is replaced by rows read from itself."""
    from casaframe.sources.snapshots import publish, read_published

    path = shared_dir(spark, "scratch", "replaced", unique=True)
    publish(fx.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey"), path)
    publish(read_published(spark, path).where("n_regionkey > 1"), path)
    return read_published(spark, path)


# Category values of the clean view at the oracle's scale (sf 0.01): N00..N11.
ORACLE_CATEGORIES = [f"N{i:02d}" for i in range(12)]


def _dummies_sql(cats: list[str]) -> str:
    return ", ".join(f"CAST(coalesce(neighborhood = '{v}', false) AS INTEGER) AS nbh_{v}"
                     for v in cats[1:])


@query("one_hot", _with(FIX) + "SELECT order_id, overall_qual, gr_liv_area, saleprice, "
       + _dummies_sql(ORACLE_CATEGORIES) + " FROM properties_clean")
def q_one_hot(spark, sf):
    clean = fx.properties_clean(spark, sf).select(
        "order_id", "neighborhood", "overall_qual", "gr_liv_area", "saleprice")
    return features.one_hot(clean)


ALIGN_LIST = ["nbh_N03", "gr_liv_area", "overall_qual", "ratio_area_banos", "tiene_garage",
              "nbh_N01", "nbh_N12", "nbh_N13", "lot_frontage"]


@query("align_features", _with(FIX) + "SELECT order_id, "
       "CAST(coalesce(neighborhood = 'N03', false) AS INTEGER) AS nbh_N03, gr_liv_area, "
       "overall_qual, round(gr_liv_area / nullif(full_bath + 1, 0), 6) AS ratio_area_banos, "
       "CAST(coalesce(garage_cars > 0, false) AS INTEGER) AS tiene_garage, "
       "CAST(coalesce(neighborhood = 'N01', false) AS INTEGER) AS nbh_N01, "
       "0 AS nbh_N12, 0 AS nbh_N13, lot_frontage FROM properties_clean")
def q_align_features(spark, sf):
    prepared, _ = features.prepare(fx.properties_clean(spark, sf))
    out = features.align_features(prepared, ALIGN_LIST, keep=["order_id"])
    return out.withColumn(schema.FEATURE_RATIO_BATH, F.round(schema.FEATURE_RATIO_BATH, 6))


@query("prepare_xy", _with(FIX) + "SELECT order_id, overall_qual, year_built, gr_liv_area, "
       "total_bsmt_sf, full_bath, bedroom_abvgr, garage_cars, garage_area, lot_frontage, "
       "ratio_area_banos, area_por_habitacion, tiene_sotano, tiene_garage, "
       + _dummies_sql(ORACLE_CATEGORIES) + ", saleprice FROM (" + FEATURES_SQL + ")")
def q_prepare_xy(spark, sf):
    prepared, _ = features.prepare(fx.properties_clean(spark, sf))
    # one dataset: key, X columns, target -- rows stay paired without a position
    out = prepared.select("order_id", *features.feature_columns(prepared), "saleprice")
    return out.withColumns({c: F.round(c, 6) for c in
                            (schema.FEATURE_RATIO_BATH, schema.FEATURE_AREA_ROOM)})


@query("profile_metrics", _with(FIX) + "SELECT CAST(count(*) AS BIGINT) AS raw_rows, "
       f"CAST({len(RAW_COLS)} AS BIGINT) AS raw_columns, CAST(" + " + ".join(
           f"(count(*) - count({c}))" for c in RAW_COLS) + " AS BIGINT) AS raw_total_nulls "
       "FROM properties_raw")
def q_profile_metrics(spark, sf):
    return profile.profile_metrics(profile.raw_profile(fx.properties_raw(spark, sf)))


@query("table_roundtrip", _with(FIX) + "SELECT * FROM properties_clean")
def q_table_roundtrip(spark, sf):
    from casaframe.sources.readers import load_prepared
    from casaframe.sources.sinks import replace_table

    path = shared_dir(spark, "tables", "properties_raw", unique=True)
    replace_table(fx.properties_raw(spark, sf), path)
    # the table exists now, so this reads it back instead of rebuilding it
    raw = load_prepared(spark, path, lambda: fx.properties_raw(spark, sf))
    return clean_view(raw)


# ------------------------------------------------------------------ validation

def _rules_sql(source: str) -> str:
    parts, order = [], 0
    for col, kind in schema.CONTRACT.items():
        rows = [("required", "0"), ("type", "0"), ("not_null", f"count(*) - count({col})"),
                ("coercible", "0")]
        if col in schema.CONTRACT_POSITIVE:
            rows.append(("gt_0", f"count(*) FILTER (WHERE {col} <= 0)"))
        for rule, expr in rows:
            parts.append(f"SELECT '{rule}' AS rule, '{col}' AS column_name, "
                         f"CAST({expr} AS BIGINT) AS violations, {order} AS rule_order, "
                         f"CAST(count(*) AS BIGINT) AS total_rows FROM {source}")
            order += 1
    return "\nUNION ALL\n".join(parts)


@query("validate_rules", _with(FIX) + _rules_sql("properties_raw"))
def q_validate_rules(spark, sf):
    return validate.validate_rules(fx.properties_raw(spark, sf))


def _summary_sql(source: str) -> str:
    return (_with(FIX, f"rules AS ({_rules_sql(source)})") +
            "SELECT count(*) FILTER (WHERE violations > 0) = 0 AS is_valid, "
            "coalesce(string_agg(CASE WHEN violations > 0 THEN rule || ':' || column_name || ' (' "
            "|| CAST(violations AS VARCHAR) || ')' END, '; ' ORDER BY rule_order), '') AS errors, "
            "CAST(CASE WHEN count(*) FILTER (WHERE violations > 0) = 0 THEN max(total_rows) "
            "ELSE 0 END AS BIGINT) AS validated_rows, max(total_rows) AS total_rows FROM rules")


@query("validate_summary", _summary_sql("properties_raw"))
def q_validate_summary(spark, sf):
    return validate.validate_summary(fx.properties_raw(spark, sf))


@query("validate_summary_clean", _summary_sql("properties_clean"))
def q_validate_summary_clean(spark, sf):
    return validate.validate_summary(fx.properties_clean(spark, sf))


def _gate_sql() -> str:
    one = lambda source: ("SELECT '" + source + "' AS source, is_valid AS passed, CASE WHEN is_valid THEN '' "  # noqa: E731
                          "ELSE 'dataset is not valid: ' || errors END AS message, validated_rows FROM ("
                          + _summary_sql(source) + ")")
    return one("properties_raw") + " UNION ALL " + one("properties_clean")


@query("contract_gate", _gate_sql())
def q_contract_gate(spark, sf):
    """What the gate says of the raw and of the clean table: rows let through, or the broken rules."""
    said = []
    for source, make in (("properties_raw", fx.properties_raw), ("properties_clean", fx.properties_clean)):
        try:
            rows, message = validate.require_valid(validate.validate_summary(make(spark, sf))), ""
        except ValueError as e:
            rows, message = 0, str(e)
        said.append((source, not message, message, rows))
    return spark.createDataFrame(
        said, "source string, passed boolean, message string, validated_rows bigint")


def _request_sql() -> str:
    msgs, counts = [], []
    for name, kind, required, lo, lo_incl, hi in schema.REQUEST_FIELDS:
        conds = []
        if required:
            conds.append((f"{name} IS NULL", f"{name}: field required"))
        if kind != "str":
            if lo is not None:
                op = "<" if lo_incl else "<="
                word = ">=" if lo_incl else ">"
                conds.append((f"{name} {op} {lo}", f"{name}: must be {word} {lo}"))
            if hi is not None:
                conds.append((f"{name} > {hi}", f"{name}: must be <= {hi}"))
        for cond, msg in conds:
            msgs.append(f"CASE WHEN {cond} THEN '{msg}' END")
            counts.append(f"CASE WHEN {cond} THEN 1 ELSE 0 END")
    return (_with(fx.duckdb_request_cte()) + "SELECT order_id, CAST(" + " + ".join(counts) +
            " AS INTEGER) AS n_errors, concat_ws('; ', " + ", ".join(msgs) +
            ") AS errors FROM requests")


@query("request_validation", _request_sql())
def q_request_validation(spark, sf):
    req = fx.requests(spark, sf).drop("l_shipdate")
    return req.select("order_id", validate.request_error_count(req).alias("n_errors"),
                      validate.request_error_text(req).alias("errors"))


def _defaults_sql() -> str:
    cols = []
    for name, kind, required, *_ in schema.REQUEST_FIELDS:
        if required or kind == "str":
            cols.append(name)
        else:
            t = "BIGINT" if kind == "int" else "DOUBLE"
            cols.append(f"CAST(coalesce(CAST({name} AS DOUBLE), 0.0) AS {t}) AS {name}")
    conds = []
    for name, kind, required, lo, lo_incl, hi in schema.REQUEST_FIELDS:
        if required:
            conds.append(f"{name} IS NOT NULL")
        if kind != "str" and lo is not None:
            conds.append(f"coalesce(NOT ({name} {'<' if lo_incl else '<='} {lo}), true)")
        if kind != "str" and hi is not None:
            conds.append(f"coalesce(NOT ({name} > {hi}), true)")
    return (_with(fx.duckdb_request_cte()) + "SELECT order_id, " + ", ".join(cols) +
            " FROM requests WHERE " + " AND ".join(conds))


@query("request_defaults", _defaults_sql())
def q_request_defaults(spark, sf):
    req = fx.requests(spark, sf).drop("l_shipdate")
    valid, _ = validate.split_requests(req)
    return valid


# ------------------------------------------------------------------ outliers

def _zscore_sql(table: str, col: str) -> str:
    return (f"WITH s AS (SELECT count({col}) AS n, avg({col}) AS m, stddev_pop({col}) AS sd "
            f"FROM {table}) SELECT '{col}' AS column_name, CAST(max(s.n) AS BIGINT) AS n, "
            f"CAST(count(*) FILTER (WHERE s.n >= 10 AND s.sd > 0 AND "
            f"abs(({col} - s.m) / s.sd) > 3) AS BIGINT) AS zscore_outliers FROM {table}, s")


@query("zscore_outliers", _zscore_sql("events", "value"))
def q_zscore_outliers(spark, sf):
    ev = fx.table(spark, sf, "events")
    st = outliers.outlier_stats(ev, ["value"], quartiles=False)["value"]
    rule = outliers.zscore_rule(F.col("value"), st)
    return ev.agg(F.lit("value").alias("column_name"), F.count("value").cast("bigint").alias("n"),
                  (F.count_if(rule) if rule is not None else F.lit(0)).cast("bigint")
                  .alias("zscore_outliers"))


REGION_TOTALS_SQL = ("SELECT n_regionkey, sum(s_acctbal) AS acctbal FROM supplier "
                     "JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey")


def region_totals(spark, sf) -> DataFrame:
    """Supplier balance per region: a 5-value column, which takes the modified z-score path."""
    sup, nat = fx.table(spark, sf, "supplier"), fx.table(spark, sf, "nation")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
            .groupBy("n_regionkey").agg(F.sum("s_acctbal").alias("acctbal")))


@query("modified_zscore_outliers",
       f"WITH t AS ({REGION_TOTALS_SQL}), m AS (SELECT median(acctbal) AS med FROM t), "
       "d AS (SELECT median(abs(acctbal - m.med)) AS mad FROM t, m) "
       "SELECT 'acctbal' AS column_name, CAST(count(*) AS BIGINT) AS n, round(max(m.med), 6) AS median, "
       "round(max(d.mad), 6) AS mad, CAST(count(*) FILTER (WHERE d.mad <> 0 AND "
       "abs(0.6745 * (acctbal - m.med) / d.mad) > 3.5) AS BIGINT) AS zscore_outliers FROM t, m, d")
def q_modified_zscore(spark, sf):
    t = region_totals(spark, sf)
    st = outliers.outlier_stats(t, ["acctbal"])["acctbal"]
    rule = outliers.zscore_rule(F.col("acctbal"), st)
    return t.agg(F.lit("acctbal").alias("column_name"), F.count("acctbal").cast("bigint").alias("n"),
                 F.round(F.lit(st["median"]), 6).cast("double").alias("median"),
                 F.round(F.lit(st["mad"]), 6).cast("double").alias("mad"),
                 (F.count_if(rule) if rule is not None else F.lit(0)).cast("bigint")
                 .alias("zscore_outliers"))


def _iqr_sql(table: str, col: str) -> str:
    return (f"WITH q AS (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 "
            f"FROM {table}) SELECT '{col}' AS column_name, round(max(q.q1), 6) AS q1, "
            f"round(max(q.q3), 6) AS q3, CAST(count(*) FILTER (WHERE q.q3 - q.q1 <> 0 AND "
            f"({col} < q.q1 - 1.5 * (q.q3 - q.q1) OR {col} > q.q3 + 1.5 * (q.q3 - q.q1))) "
            f"AS BIGINT) AS iqr_outliers FROM {table}, q")


@query("iqr_outliers", _iqr_sql("events", "value"))
def q_iqr_outliers(spark, sf):
    ev = fx.table(spark, sf, "events")
    st = outliers.outlier_stats(ev, ["value"])["value"]
    rule = outliers.iqr_rule(F.col("value"), st)
    return ev.agg(F.lit("value").alias("column_name"),
                  F.round(F.lit(st["q1"]), 6).cast("double").alias("q1"),
                  F.round(F.lit(st["q3"]), 6).cast("double").alias("q3"),
                  (F.count_if(rule) if rule is not None else F.lit(0)).cast("bigint")
                  .alias("iqr_outliers"))


def _report_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS column_name, z.zscore_outliers, i.iqr_outliers, "
            f"greatest(z.zscore_outliers, i.iqr_outliers) AS outliers FROM "
            f"({_zscore_sql(table, c)}) z, ({_iqr_sql(table, c)}) i")
    return "\nUNION ALL\n".join(parts)


@query("outlier_report", _with(FIX, "raw AS (SELECT * FROM properties_raw)")
       + _report_sql("raw", OUTLIER_COLS))
def q_outlier_report(spark, sf):
    return outliers.outlier_report(fx.properties_raw(spark, sf), OUTLIER_COLS)


@query("outlier_rows",
       "WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd, "
       "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events) "
       "SELECT event_id, value, coalesce(abs((value - s.m) / s.sd) > 3, false) AS value_zscore_outlier, "
       "coalesce(value < s.q1 - 1.5 * (s.q3 - s.q1) OR value > s.q3 + 1.5 * (s.q3 - s.q1), false) "
       "AS value_iqr_outlier FROM events, s")
def q_outlier_rows(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "value")
    return outliers.outlier_rows(ev, ["value"])


# ------------------------------------------------------------------ duplicates

DOC_COLS = ["text", "lang", "source", "n_chars"]


@query("duplicate_report",
       "WITH g AS (SELECT count(*) AS n FROM documents GROUP BY text, lang, source, n_chars) "
       "SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, "
       "round(sum(n - 1) / sum(n) * 100, 2) AS duplicate_pct FROM g")
def q_duplicate_report(spark, sf):
    return duplicates.duplicate_report(fx.table(spark, sf, "documents"), DOC_COLS)


@query("duplicate_rows",
       "SELECT doc_id, row_number() OVER (PARTITION BY text, lang, source, n_chars "
       "ORDER BY doc_id) > 1 AS is_duplicate FROM documents")
def q_duplicate_rows(spark, sf):
    docs = fx.table(spark, sf, "documents")
    return duplicates.mark_duplicates(docs, "doc_id", DOC_COLS).select("doc_id", "is_duplicate")


@query("duplicate_rows_in_order", ORACLE["duplicate_rows"])
def q_duplicate_rows_in_order(spark, sf):
    """Marks in file order, without a key."""
    docs = fx.table(spark, sf, "documents").select("doc_id", *DOC_COLS)
    return duplicates.mark_duplicates_in_order(docs, DOC_COLS).select("doc_id", "is_duplicate")


# ------------------------------------------------------------------ drift

CUT = f"TIMESTAMP '{fx.DRIFT_CUTOFF}'"
POOLED_SQL = (
    "pooled AS (SELECT 0 AS side, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DRIFT_COLS)
    + f" FROM properties_raw WHERE l_shipdate < {CUT} UNION ALL SELECT 1 AS side, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DRIFT_COLS)
    + f" FROM properties_raw WHERE NOT (l_shipdate < {CUT}))")
LONG_SQL = ("long AS (SELECT side, column_name, value FROM (UNPIVOT pooled ON "
            + ", ".join(DRIFT_COLS) + " INTO NAME column_name VALUE value) WHERE value IS NOT NULL)")
STATS_SQL = ("stats AS (SELECT column_name, count(*) FILTER (WHERE side = 0) AS n0, "
             "count(*) FILTER (WHERE side = 1) AS n1, min(value) AS lo, max(value) AS hi "
             "FROM long GROUP BY column_name)")
BINS_SQL = (
    "bins AS (SELECT l.column_name, "
    + " + ".join(f"CAST(l.value >= s.lo + {i} * ((s.hi - s.lo) / 10) AS INTEGER)" for i in range(1, 10))
    + " AS bin, l.side FROM long l JOIN stats s USING (column_name) WHERE s.n0 >= 2 AND s.n1 >= 2), "
    "dense AS (SELECT s.column_name, b.bin FROM stats s, (SELECT range AS bin FROM range(0, 10)) b "
    "WHERE s.n0 >= 2 AND s.n1 >= 2), "
    "hist AS (SELECT d.column_name, CAST(d.bin AS INTEGER) AS bin, "
    "CAST(count(bins.side) FILTER (WHERE bins.side = 0) AS BIGINT) AS reference_count, "
    "CAST(count(bins.side) FILTER (WHERE bins.side = 1) AS BIGINT) AS current_count "
    "FROM dense d LEFT JOIN bins ON bins.column_name = d.column_name AND bins.bin = d.bin "
    "GROUP BY d.column_name, d.bin)")
PSI_SQL = (
    "psi AS (SELECT column_name, sum((q - p) * ln(q / p)) AS psi FROM (SELECT column_name, "
    "(reference_count + 0.0001) / sum(reference_count + 0.0001) OVER (PARTITION BY column_name) AS p, "
    "(current_count + 0.0001) / sum(current_count + 0.0001) OVER (PARTITION BY column_name) AS q "
    "FROM hist) GROUP BY column_name)")
KS_SQL = (
    "counts AS (SELECT column_name, value, count(*) FILTER (WHERE side = 0) AS n_ref, "
    "count(*) FILTER (WHERE side = 1) AS n_cur FROM long GROUP BY column_name, value), "
    "cum AS (SELECT column_name, sum(n_ref) OVER w AS c_ref, sum(n_cur) OVER w AS c_cur, "
    "sum(n_ref) OVER (PARTITION BY column_name) AS t_ref, sum(n_cur) OVER (PARTITION BY column_name) AS t_cur "
    "FROM counts WINDOW w AS (PARTITION BY column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW)), "
    "ks AS (SELECT column_name, CAST(max(t_ref) AS BIGINT) AS n_reference, "
    "CAST(max(t_cur) AS BIGINT) AS n_current, max(abs(c_ref / t_ref - c_cur / t_cur)) AS d "
    "FROM cum GROUP BY column_name)")
PI2 = repr(math.pi ** 2)
SQRT2PI = repr(math.sqrt(2 * math.pi))
PV_SQL = (
    "zs AS (SELECT column_name, n_reference, n_current, d, "
    "z0 + 1.0 / (6.0 * sqrt(en)) + (z0 - 1.0) / (4.0 * en) AS z FROM (SELECT *, d * sqrt(en) AS z0 FROM (SELECT *, "
    "round_even(CAST(n_reference AS DOUBLE) * CAST(n_current AS DOUBLE) / CAST(n_reference + n_current AS DOUBLE), 0) AS en FROM ks))), "
    "pv AS (SELECT column_name, least(greatest(CASE WHEN max(z) <= 0 THEN 1.0 WHEN max(z) < 1.0 THEN "
    f"1.0 - sum(exp(-((2 * k - 1) * (2 * k - 1)) * {PI2} / (8.0 * z * z))) * ({SQRT2PI} / max(z)) "
    "ELSE 2.0 * sum(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * z * z)) END, 0.0), 1.0) "
    "AS p FROM zs, (SELECT range AS k FROM range(1, 101)) t GROUP BY column_name)")
DRIFT_BASE = _with(FIX, POOLED_SQL, LONG_SQL, STATS_SQL, BINS_SQL, PSI_SQL, KS_SQL, PV_SQL)


@query("psi_bins", DRIFT_BASE + "SELECT column_name, bin, reference_count, current_count FROM hist")
def q_psi_bins(spark, sf):
    ref, cur = fx.drift_pair(spark, sf)
    return drift.psi_bins(ref, cur, DRIFT_COLS)


@query("psi", DRIFT_BASE + "SELECT column_name, round(psi, 6) AS psi FROM psi")
def q_psi(spark, sf):
    ref, cur = fx.drift_pair(spark, sf)
    return drift.psi(ref, cur, DRIFT_COLS).select("column_name", F.round("psi", 6).alias("psi"))


@query("ks_statistic", DRIFT_BASE + "SELECT column_name, n_reference, n_current, "
       "round(d, 6) AS ks_statistic FROM ks")
def q_ks_statistic(spark, sf):
    ref, cur = fx.drift_pair(spark, sf)
    return drift.ks_statistic(ref, cur, DRIFT_COLS).withColumn(
        "ks_statistic", F.round("ks_statistic", 6))


@query("ks_pvalue", DRIFT_BASE + "SELECT column_name, round(p, 6) AS ks_pvalue FROM pv")
def q_ks_pvalue(spark, sf):
    ref, cur = fx.drift_pair(spark, sf)
    return drift.ks_test(ref, cur, DRIFT_COLS).select(
        "column_name", F.round("ks_pvalue", 6).alias("ks_pvalue"))


# A lattice path inside the band |i/n0 - j/n1| < d; ``p`` holds, per point i of the
# anti-diagonal s, the share of paths to it that stayed inside.
EXACT_SQL = (
    "long AS (SELECT 'acctbal' AS column_name, 0 AS side, CAST(c_acctbal AS DOUBLE) AS value FROM customer "
    "UNION ALL SELECT 'acctbal', 1, CAST(s_acctbal AS DOUBLE) FROM supplier)", KS_SQL,
    "size AS (SELECT *, CAST(round(d * lcm(n_reference, n_current)) AS BIGINT) AS h, "
    "lcm(n_reference, n_current) // n_reference AS a, lcm(n_reference, n_current) // n_current AS b FROM ks)",
    "walk(s, p) AS (SELECT CAST(0 AS BIGINT), list_transform(range(0, n_reference + 1), "
    "lambda i: CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FROM size UNION ALL "
    "SELECT s + 1, list_transform(range(0, n_reference + 1), lambda i: CASE "
    "WHEN i > s + 1 OR s + 1 - i > n_current OR abs(i * a - (s + 1 - i) * b) >= h THEN 0.0::DOUBLE "
    "ELSE (CASE WHEN i > 0 THEN p[i] * i ELSE 0.0 END + p[i + 1] * (s + 1 - i)) / (s + 1) END) "
    "FROM walk, size WHERE s < n_reference + n_current)")


@query("ks_exact", "WITH RECURSIVE " + ", ".join(EXACT_SQL) +
       " SELECT column_name, n_reference, n_current, round(d, 6) AS ks_statistic, "
       "round(CASE WHEN h = 0 THEN 1.0 ELSE 1.0 - p[n_reference + 1] END, 6) AS ks_pvalue "
       "FROM walk JOIN size ON s = n_reference + n_current")
def q_ks_exact(spark, sf):
    """Do balances of customers and suppliers differ?  The exact law, at any size."""
    ref = fx.table(spark, sf, "customer").select(F.col("c_acctbal").cast("double").alias("acctbal"))
    cur = fx.table(spark, sf, "supplier").select(F.col("s_acctbal").cast("double").alias("acctbal"))
    return drift.ks_test(ref, cur, ["acctbal"], method="exact").select(
        "column_name", "n_reference", "n_current", F.round("ks_statistic", 6).alias("ks_statistic"),
        F.round("ks_pvalue", 6).alias("ks_pvalue"))


DRIFT_FEATURES_SQL = (
    "SELECT s.column_name, CAST(s.n0 AS BIGINT) AS n_reference, CAST(s.n1 AS BIGINT) AS n_current, "
    "CASE WHEN psi.psi IS NULL THEN 0.0 ELSE round(psi.psi, 6) END AS psi, "
    "round(ks.d, 6) AS ks_statistic, CASE WHEN psi.psi IS NULL THEN 1.0 ELSE round(pv.p, 6) END AS ks_pvalue, "
    "CASE WHEN psi.psi IS NULL THEN false ELSE (psi.psi > 0.25 OR pv.p < 0.05) END AS drifted "
    "FROM stats s LEFT JOIN psi USING (column_name) LEFT JOIN ks USING (column_name) "
    "LEFT JOIN pv USING (column_name)")


@query("drift_features", DRIFT_BASE + DRIFT_FEATURES_SQL)
def q_drift_features(spark, sf):
    ref, cur = fx.drift_pair(spark, sf)
    return drift.drift_features(ref, cur, DRIFT_COLS)


@query("drift_report", DRIFT_BASE +
       "SELECT (count(*) FILTER (WHERE drifted) / greatest(count(*), 1)) >= 0.1 AS dataset_drift, "
       "round(count(*) FILTER (WHERE drifted) / greatest(count(*), 1), 4) AS drift_share, "
       "CAST(count(*) AS BIGINT) AS n_features, CAST(count(*) FILTER (WHERE drifted) AS BIGINT) "
       "AS n_drifted FROM (" + DRIFT_FEATURES_SQL + ")")
def q_drift_report(spark, sf):
    ref, cur = fx.drift_pair(spark, sf)
    return drift.drift_report(drift.drift_features(ref, cur, DRIFT_COLS))


@query("drift_report_file", DRIFT_BASE + "SELECT column_name, psi, ks_pvalue, drifted, "
       "(count(*) FILTER (WHERE drifted) OVER ()) / (count(*) OVER ()) >= 0.1 AS dataset_drift, "
       "round((count(*) FILTER (WHERE drifted) OVER ()) / (count(*) OVER ()), 4) AS drift_share "
       "FROM (" + DRIFT_FEATURES_SQL + ")")
def q_drift_report_file(spark, sf):
    """The saved report read back; its features are the numeric columns that both sides have."""
    ref, cur = (side.select(*DRIFT_COLS, "neighborhood") for side in fx.drift_pair(spark, sf))
    path = shared_dir(spark, "scratch", "drift_report", unique=True)
    drift.save_drift_report(drift.detect_drift(ref, cur), path, spark)
    saved = spark.read.schema(
        "dataset_drift boolean, drift_share double, psi_scores map<string, double>, "
        "ks_pvalues map<string, double>, per_feature_drift map<string, boolean>").json(path)
    return saved.select("dataset_drift", "drift_share", "psi_scores", "ks_pvalues",
                        F.explode("per_feature_drift").alias("column_name", "drifted")).select(
        "column_name", F.col("psi_scores")[F.col("column_name")].alias("psi"),
        F.col("ks_pvalues")[F.col("column_name")].alias("ks_pvalue"), "drifted", "dataset_drift",
        "drift_share")


def _profile_drift_sql() -> str:
    from casaframe.operators.reference_profile import OFFSET, PER_E, SHIFT
    from casaframe.streaming.drift_monitor import limit_point

    size = f"(floor(ln(CASE WHEN value = 0 THEN 1 ELSE abs(value) END) * {PER_E} + {OFFSET}) + {SHIFT})"
    beyond = lambda d: (f"{d} > 0 AND {d} * sqrt(en) + 1.0 / (6.0 * sqrt(en)) + ({d} * sqrt(en) - 1.0) "  # noqa: E731
                        f"/ (4.0 * en) > {limit_point(schema.KS_P_LIMIT)!r}")
    share = lambda n, total: f"(({n}) + 0.0001) / ({total} + 0.001)"
    return _with(
        FIX, POOLED_SQL, LONG_SQL, STATS_SQL, BINS_SQL,
        f"cells AS (SELECT column_name, CASE WHEN value = 0 THEN 0 WHEN value > 0 THEN {size} ELSE -{size} END "
        "AS cell, count(*) FILTER (WHERE side = 0) AS a, count(*) FILTER (WHERE side = 1) AS b, "
        "min(value) AS lo, max(value) AS hi, min(value) FILTER (WHERE side = 0) AS rlo, "
        "max(value) FILTER (WHERE side = 0) AS rhi FROM long GROUP BY ALL)",
        "cum AS (SELECT c.*, n0, n1, sum(a) OVER w AS ca, sum(b) OVER w AS cb FROM cells c JOIN stats USING "
        "(column_name) WINDOW w AS (PARTITION BY column_name ORDER BY cell ROWS UNBOUNDED PRECEDING))",
        "ks AS (SELECT column_name, max(abs(ca / n0 - cb / n1)) AS ks_low, max(CASE WHEN lo < hi THEN greatest("
        "abs(ca / n0 - cb / n1), ca / n0 - (cb - b) / n1, cb / n1 - (ca - a) / n0) "
        "ELSE abs(ca / n0 - cb / n1) END) AS ks_high FROM cum GROUP BY column_name)",
        "edges AS (SELECT column_name, n0, n1, k, lo + k * ((hi - lo) / 10) AS cut FROM stats, "
        "(SELECT CAST(range AS INTEGER) AS k FROM range(1, 10)))",
        "inner_below AS (SELECT e.column_name, k, sum(CASE WHEN rhi < cut THEN a ELSE 0 END) AS low, "
        "sum(CASE WHEN rlo < cut THEN a ELSE 0 END) AS top FROM edges e JOIN cells c USING (column_name) "
        "WHERE a > 0 GROUP BY ALL)",
        "below AS (FROM inner_below UNION ALL SELECT column_name, 0, 0, 0 FROM stats "
        "UNION ALL SELECT column_name, 10, n0, n0 FROM stats)",
        f"shares AS (SELECT h.column_name, {share('greatest(r.low - l.top, 0)', 'n0')} AS p0, "
        f"{share('r.top - l.low', 'n0')} AS p1, {share('current_count', 'n1')} AS q FROM hist h "
        "JOIN stats s USING (column_name) JOIN below l ON l.column_name = h.column_name AND l.k = h.bin "
        "JOIN below r ON r.column_name = h.column_name AND r.k = h.bin + 1)",
        "terms AS (SELECT column_name, p0 <= q AND q <= p1 AS held, (q - p0) * ln(q / p0) AS t0, "
        "(q - p1) * ln(q / p1) AS t1 FROM shares)",
        "ps AS (SELECT column_name, sum(CASE WHEN held THEN 0 ELSE least(t0, t1) END) AS psi_low, "
        "sum(greatest(t0, t1)) AS psi_high FROM terms GROUP BY column_name)") + (
        "SELECT column_name, CAST(n0 AS BIGINT) AS n_reference, CAST(n1 AS BIGINT) AS n_current, "
        "round(psi_low, 6) AS psi_low, round(psi_high, 6) AS psi_high, round(ks_low, 6) AS ks_low, "
        f"round(ks_high, 6) AS ks_high, CASE WHEN psi_low > {schema.PSI_LIMIT} OR ({beyond('ks_low')}) THEN true "
        f"WHEN psi_high <= {schema.PSI_LIMIT} AND NOT ({beyond('ks_high')}) THEN false END AS drifted "
        "FROM (SELECT *, round_even(CAST(n0 AS DOUBLE) * n1 / (n0 + n1), 0) AS en FROM stats JOIN ks USING "
        "(column_name) JOIN ps USING (column_name))")


def _stored_profile(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The profile of the reference side, stored by neighborhood and read again; the current side."""
    from casaframe.operators import reference_profile as rp

    ref, cur = fx.drift_pair(spark, sf)
    path = shared_dir(spark, "scratch", "reference_profile", unique=True)
    rp.add(rp.profile_of(ref, DRIFT_COLS, part=F.col("neighborhood")), path)
    return rp.load(spark, path), cur


@query("profile_drift", _profile_drift_sql())
def q_profile_drift(spark, sf):
    """Drift of the current side against the stored profile; the reference is not read again."""
    from casaframe.operators import reference_profile as rp

    stored, cur = _stored_profile(spark, sf)
    score = ["psi_low", "psi_high", "ks_low", "ks_high"]
    return rp.drift_of(stored, cur, DRIFT_COLS).select(
        "column_name", "n_reference", "n_current", *[F.round(c, 6).alias(c) for c in score], "drifted")


@query("profile_settled", DRIFT_BASE + "SELECT column_name, drifted FROM (" + DRIFT_FEATURES_SQL + ")")
def q_profile_settled(spark, sf):
    """The same flags as the exact test: what the stored profile leaves open is judged by it."""
    from casaframe.operators import reference_profile as rp

    stored, cur = _stored_profile(spark, sf)
    ref, _ = fx.drift_pair(spark, sf)
    return rp.settle(rp.drift_of(stored, cur, DRIFT_COLS), ref, cur)


# ------------------------------------------------------------------ modelling (SQL forms)

@query("train_test_split", _with(FIX) + "SELECT order_id, saleprice, "
       "substr(md5(concat(CAST(order_id AS VARCHAR), '|42')), 1, 8) < '33333333' AS is_test "
       "FROM properties_clean")
def q_train_test_split(spark, sf):
    return fx.properties_clean(spark, sf).select("order_id", "saleprice",
                                                 is_test_row().alias("is_test"))


@query("median_impute", _with(FIX, "m AS (SELECT " + ", ".join(
    f"median({c}) AS {c}" for c in IMPUTE_COLS) + " FROM properties_raw)") +
       "SELECT r.order_id, " + ", ".join(
    f"round(coalesce(r.{c}, m.{c}), 6) AS {c}" for c in IMPUTE_COLS) + " FROM properties_raw r, m")
def q_median_impute(spark, sf):
    raw = fx.properties_raw(spark, sf).select("order_id", *IMPUTE_COLS)
    meds = model.fit_medians(raw, IMPUTE_COLS)
    out = model.impute_median(raw, meds)
    return out.withColumns({c: F.round(c, 6) for c in IMPUTE_COLS})


@query("standard_scale", _with(FIX, "s AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE_COLS) + " FROM properties_clean)") +
       "SELECT order_id, " + ", ".join(
    f"round(({c} - s.m_{c}) / CASE WHEN s.s_{c} = 0 THEN 1 ELSE s.s_{c} END, 6) AS {c}"
    for c in SCALE_COLS) + " FROM properties_clean, s")
def q_standard_scale(spark, sf):
    clean = fx.properties_clean(spark, sf).select("order_id", *SCALE_COLS)
    stats = model.fit_standard_scaler(clean, SCALE_COLS)
    return model.standard_scale(clean, stats).withColumns({c: F.round(c, 6) for c in SCALE_COLS})


@query("linear_fit", _with(FIX) + "SELECT 'overall_qual' AS feature, "
       "round(regr_slope(saleprice, overall_qual), 4) AS slope, "
       "round(regr_intercept(saleprice, overall_qual), 4) AS intercept, "
       "round(regr_r2(saleprice, overall_qual), 6) AS r2, CAST(count(*) AS BIGINT) AS n "
       "FROM properties_clean")
def q_linear_fit(spark, sf):
    clean = fx.properties_clean(spark, sf)
    return clean.agg(F.lit("overall_qual").alias("feature"),
                     F.round(F.regr_slope("saleprice", "overall_qual"), 4).alias("slope"),
                     F.round(F.regr_intercept("saleprice", "overall_qual"), 4).alias("intercept"),
                     F.round(F.regr_r2("saleprice", "overall_qual"), 6).alias("r2"),
                     F.count(F.lit(1)).cast("bigint").alias("n"))


@query("linear_predictions", _with(FIX, "f AS (SELECT regr_slope(saleprice, overall_qual) AS b, "
       "regr_intercept(saleprice, overall_qual) AS a FROM properties_clean WHERE NOT "
       "(substr(md5(concat(CAST(order_id AS VARCHAR), '|42')), 1, 8) < '33333333'))") +
       "SELECT order_id, round(a + b * overall_qual, 2) AS prediction FROM properties_clean, f "
       "WHERE substr(md5(concat(CAST(order_id AS VARCHAR), '|42')), 1, 8) < '33333333'")
def q_linear_predictions(spark, sf):
    """The trained linear pipeline on one feature, applied to the test part."""
    from casaframe.operators.split import train_test_split

    clean = fx.properties_clean(spark, sf).select("order_id", "overall_qual", "saleprice")
    res = model.train_and_select(clean, ["overall_qual"], names=["Linear Regression"])
    _, test = train_test_split(clean)
    return res.model.transform(test).select("order_id", F.round("prediction", 2).alias("prediction"))


# Three one-variable least-squares lines on the clean data (in tie-break order).
BASELINES = [("line on overall_qual", "overall_qual"), ("line on gr_liv_area", "gr_liv_area"),
             ("line on bedroom_abvgr", "bedroom_abvgr")]


def _baseline_metrics(spark, sf) -> DataFrame:
    clean = fx.properties_clean(spark, sf)
    frames = []
    for order, (name, feat) in enumerate(BASELINES):
        # the fit is two numbers (one aggregate row); they enter the plan as literals
        fit = clean.agg(F.regr_slope("saleprice", feat).alias("b"),
                        F.regr_intercept("saleprice", feat).alias("a")).first()
        pred = clean.select(F.col("saleprice").alias("label"),
                            (F.lit(fit["a"]) + F.lit(fit["b"]) * F.col(feat)).alias("prediction"))
        m = model.regression_metrics(pred)
        frames.append(m.select(F.lit(name).alias("model"), F.lit(order).alias("model_order"),
                               "mae", "rmse", "r2"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _baseline_sql() -> str:
    parts = []
    for order, (name, feat) in enumerate(BASELINES):
        parts.append(
            f"SELECT '{name}' AS model, {order} AS model_order, avg(abs(e)) AS mae, "
            f"sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / (var_pop(y) * count(y)) AS r2 FROM "
            f"(SELECT saleprice AS y, (f.a + f.b * {feat}) - saleprice AS e FROM properties_clean, "
            f"(SELECT regr_intercept(saleprice, {feat}) AS a, regr_slope(saleprice, {feat}) AS b "
            f"FROM properties_clean) f)")
    return "metrics AS (" + "\nUNION ALL\n".join(parts) + ")"


@query("regression_metrics", _with(FIX, _baseline_sql()) +
       "SELECT model, model_order, round(mae, 4) AS mae, round(rmse, 4) AS rmse, "
       "round(r2, 6) AS r2 FROM metrics")
def q_regression_metrics(spark, sf):
    m = _baseline_metrics(spark, sf)
    return m.select("model", "model_order", F.round("mae", 4).alias("mae"),
                    F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("model_selection", _with(FIX, _baseline_sql()) +
       "SELECT model, model_order, round(r2, 6) AS r2 FROM metrics "
       "ORDER BY r2 DESC, model_order ASC LIMIT 1")
def q_model_selection(spark, sf):
    best = model.select_best(_baseline_metrics(spark, sf))
    return best.select("model", "model_order", F.round("r2", 6).alias("r2"))


@query("r2_gate", _with(FIX, _baseline_sql()) +
       "SELECT model, round(r2, 6) AS r2, NOT (r2 < 0.85) AS passed FROM metrics")
def q_r2_gate(spark, sf):
    m = _baseline_metrics(spark, sf)
    return m.select("model", F.round("r2", 6).alias("r2"), model.r2_gate(F.col("r2")).alias("passed"))


@query("format_price", _with(FIX) + "SELECT order_id, round(saleprice / 3.0, 2) AS precio_predicho, "
       "format('${:,.0f} USD', saleprice / 3.0) AS precio_formateado FROM properties_clean")
def q_format_price(spark, sf):
    from casaframe.functions.exprs import format_usd

    clean = fx.properties_clean(spark, sf)
    price = F.col("saleprice") / F.lit(3.0)
    return clean.select("order_id", F.round(price, 2).alias("precio_predicho"),
                        format_usd(price).alias("precio_formateado"))


# ------------------------------------------------------------------ ML, scoring, streams

# All three models at their full settings are fitted once per application and
# table folder; the queries below share the chosen one, saved in the shared folder.
_FITTED: dict[tuple[str, str], tuple] = {}


def _trained(spark, sf) -> tuple:
    """(train result, folder of the saved best model)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        prepared, enc = features.prepare(fx.properties_clean(spark, sf), sparse=True)
        res = model.train_and_select(prepared, features.feature_columns(prepared))
        out = shared_dir(spark, "models", unique=True)
        model.persist_model(res, out, encoder=enc.to_dict())
        _FITTED[key] = (res, out)
    return _FITTED[key]


@query("train_models")
def q_train_models(spark, sf):
    res, _ = _trained(spark, sf)
    return res.all_metrics.withColumn("selected", F.col("model") == F.lit(res.best_name))


def _saved_model(spark, sf) -> str:
    return _trained(spark, sf)[1]


@query("score_batch")
def q_score_batch(spark, sf):
    from casaframe.operators.score import score

    mdir = _saved_model(spark, sf)
    pm, meta = model.load_model(spark, mdir)
    scored, rejected = score(fx.requests(spark, sf).drop("l_shipdate"), pm, meta,
                             passthrough=["order_id"])
    return scored.select("order_id", "precio_predicho", "precio_formateado", "modelo_usado",
                         F.lit("scored").alias("status")).unionByName(
        rejected.select("order_id", F.lit(None).cast("double").alias("precio_predicho"),
                        F.lit(None).cast("string").alias("precio_formateado"),
                        F.lit(None).cast("string").alias("modelo_usado"),
                        F.lit("rejected").alias("status")))


@query("stream_score")
def q_stream_score(spark, sf):
    from casaframe.streaming.score_stream import read_scored, start_stream_score

    mdir = _saved_model(spark, sf)
    pm, meta = model.load_model(spark, mdir)
    base = shared_dir(spark, "streams", "score", unique=True)
    req = fx.requests(spark, sf).drop("l_shipdate")
    req.write.mode("overwrite").parquet(f"{base}/source")
    q = start_stream_score(spark, f"{base}/source", req.schema, pm, meta, f"{base}/sink",
                           f"{base}/checkpoint", passthrough=["order_id"])
    q.awaitTermination()
    valid, rejected = read_scored(spark, f"{base}/sink")
    return valid.select("order_id", "precio_predicho", F.lit("scored").alias("status")).unionByName(
        rejected.select("order_id", F.lit(None).cast("double").alias("precio_predicho"),
                        F.lit("rejected").alias("status")))


_REF_BIN = " + ".join(f"CAST(value >= lo + {i} * ((hi - lo) / 10) AS INTEGER)" for i in range(1, 10))
STREAM_SQL = _with(
    FIX, POOLED_SQL, LONG_SQL,
    "sref AS (SELECT column_name, min(value) AS lo, max(value) AS hi FROM long WHERE side = 0 "
    "GROUP BY column_name HAVING count(*) >= 2)",
    "cur AS (SELECT TIMESTAMP '1970-01-01' + to_days(30 * CAST(floor(epoch(CAST(l_shipdate AS TIMESTAMP)) "
    "/ 2592000) AS INTEGER)) AS ws, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DRIFT_COLS)
    + f" FROM properties_raw WHERE NOT (l_shipdate < {CUT}))",
    "wlong AS (SELECT ws, column_name, value FROM (UNPIVOT cur ON " + ", ".join(DRIFT_COLS)
    + " INTO NAME column_name VALUE value) WHERE value IS NOT NULL)",
    f"rb AS (SELECT column_name, {_REF_BIN} AS bin, count(*) AS n FROM long JOIN sref USING (column_name) "
    "WHERE side = 0 GROUP BY ALL)",
    f"cb AS (SELECT ws, column_name, {_REF_BIN} AS bin, count(*) AS n FROM wlong "
    "JOIN sref USING (column_name) GROUP BY ALL)",
    "dense AS (SELECT w.ws, w.column_name, coalesce(rb.n, 0) AS r, coalesce(cb.n, 0) AS c "
    "FROM (SELECT DISTINCT ws, column_name FROM cb) w CROSS JOIN (SELECT range AS bin FROM range(0, 10)) b "
    "LEFT JOIN rb ON rb.column_name = w.column_name AND rb.bin = b.bin "
    "LEFT JOIN cb ON cb.column_name = w.column_name AND cb.bin = b.bin AND cb.ws = w.ws)",
    "shares AS (SELECT ws, column_name, c, (r + 0.0001) / sum(r + 0.0001) OVER p AS p, "
    "(c + 0.0001) / sum(c + 0.0001) OVER p AS q FROM dense WINDOW p AS (PARTITION BY ws, column_name))",
) + ("SELECT strftime(ws, '%Y-%m-%d') AS window_start, strftime(ws + INTERVAL 30 DAY, '%Y-%m-%d') AS window_end, "
     "column_name, round(sum((q - p) * ln(q / p)), 6) AS psi, CAST(sum(c) AS BIGINT) AS n_current "
     "FROM shares GROUP BY ws, column_name")


def _drift_source(spark, sf, base: str) -> DataFrame:
    """The current side of the drift pair, written as the source of a stream."""
    cut = F.expr(f"timestamp_ntz'{fx.DRIFT_CUTOFF}'")
    current = fx.properties_raw(spark, sf).where(~(F.col("l_shipdate").cast("timestamp_ntz") < cut))
    current.write.mode("overwrite").parquet(f"{base}/source")
    return current


@query("stream_drift", STREAM_SQL)
def q_stream_drift(spark, sf):
    from casaframe.streaming import drift_stream as ds

    ref, _ = fx.drift_pair(spark, sf)
    edges = ds.reference_edges(ref, DRIFT_COLS)
    base = shared_dir(spark, "streams", "drift", unique=True)
    current = _drift_source(spark, sf, base)
    q = ds.start_stream_drift(spark, f"{base}/source", current.schema, "l_shipdate", edges,
                              f"{base}/sink", f"{base}/checkpoint")
    q.awaitTermination()
    psi_rows = ds.window_psi(spark, f"{base}/sink", ds.reference_bins(ref, edges))
    return psi_rows.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("window_start"),
        F.date_format("window_end", "yyyy-MM-dd").alias("window_end"),
        "column_name", F.round("psi", 6).alias("psi"), "n_current")


def _verdict_sql() -> str:
    from casaframe.streaming.drift_monitor import limit_point

    z = "g * sqrt(en)"
    drifted = (f"enough AND (psi > {schema.PSI_LIMIT} OR (g > 0 AND {z} + 1.0 / (6.0 * sqrt(en)) "
               f"+ ({z} - 1.0) / (4.0 * en) > {limit_point(schema.KS_P_LIMIT)!r}))")
    head = STREAM_SQL[:STREAM_SQL.index(", shares AS")]
    return head.replace(
        "SELECT w.ws, w.column_name, coalesce", "SELECT w.ws, w.column_name, b.bin, coalesce").replace(
        "(SELECT DISTINCT ws, column_name FROM cb) w",
        "(SELECT ws, column_name FROM (SELECT DISTINCT ws FROM cur), sref) w") + (
        ", sums AS (SELECT ws, column_name, bin, r, c, sum(r) OVER t AS nr, sum(c) OVER t AS nc, "
        "sum(r) OVER o AS cr, sum(c) OVER o AS cc FROM dense "
        "WINDOW t AS (PARTITION BY ws, column_name), o AS (PARTITION BY ws, column_name ORDER BY bin)), "
        "shares AS (SELECT *, (r + 0.0001) / (nr + 0.001) AS p, (c + 0.0001) / (nc + 0.001) AS q FROM sums), "
        "scored AS (SELECT ws, column_name, CAST(max(nc) AS BIGINT) AS n, max(nc) >= 2 AS enough, "
        "sum((q - p) * ln(q / p)) AS psi, max(abs(cr / nr - cc / greatest(nc, 1))) AS g, "
        "round(max(nr) * max(nc) / (max(nr) + max(nc))) AS en FROM shares GROUP BY ws, column_name), "
        f"judged AS (SELECT *, {drifted} AS drifted FROM scored) "
        "SELECT strftime(ws, '%Y-%m-%d') AS window_start, column_name, n AS n_current, "
        "CASE WHEN enough THEN round(psi, 6) ELSE 0.0 END AS psi, "
        "CASE WHEN enough THEN round(g, 6) END AS ks_gap, drifted, "
        "count(*) OVER w AS n_features, count(*) FILTER (WHERE drifted) OVER w AS n_drifted, "
        "round(count(*) FILTER (WHERE drifted) OVER w / count(*) OVER w, 4) AS drift_share, "
        f"count(*) FILTER (WHERE drifted) OVER w / count(*) OVER w >= {schema.DRIFT_SHARE_THRESHOLD} "
        "AS dataset_drift FROM judged WHERE ws + INTERVAL 31 DAY <= "
        "(SELECT max(CAST(l_shipdate AS TIMESTAMP)) FROM properties_raw) "
        "WINDOW w AS (PARTITION BY ws)")


@query("stream_drift_verdicts", _verdict_sql())
def q_stream_drift_verdicts(spark, sf):
    from casaframe.streaming import drift_monitor as dm
    from casaframe.streaming.drift_stream import reference_edges

    ref, _ = fx.drift_pair(spark, sf)
    base = shared_dir(spark, "streams", "verdicts", unique=True)
    current = _drift_source(spark, sf, base)
    q = dm.start_drift_monitor(spark, f"{base}/source", current.schema, "l_shipdate", ref,
                               reference_edges(ref, DRIFT_COLS), f"{base}/sink", f"{base}/checkpoint")
    q.awaitTermination()
    return dm.read_verdicts(spark, f"{base}/sink").select(
        F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "column_name", "n_current",
        F.round("psi", 6).alias("psi"), F.round("ks_gap", 6).alias("ks_gap"), "drifted", "n_features",
        "n_drifted", "drift_share", "dataset_drift")


@query("stream_ks", DRIFT_BASE + "SELECT column_name, n_reference, n_current, "
       "round(d, 6) AS ks_statistic FROM ks")
def q_stream_ks(spark, sf):
    from casaframe.streaming import drift_stream as ds

    ref, _ = fx.drift_pair(spark, sf)
    base = shared_dir(spark, "streams", "ks", unique=True)
    current = _drift_source(spark, sf, base)
    q = ds.start_stream_ks(spark, f"{base}/source", current.schema, ref, DRIFT_COLS,
                           f"{base}/sink", f"{base}/checkpoint")
    q.awaitTermination()
    return ds.read_ks(spark, f"{base}/sink").select(
        "column_name", "n_reference", "n_current", F.round("ks_statistic", 6).alias("ks_statistic"))


@query("score_line", _with(FIX, fx.duckdb_request_cte(), "f AS (SELECT regr_slope(saleprice, overall_qual) AS b, "
       "regr_intercept(saleprice, overall_qual) AS a FROM properties_clean WHERE NOT "
       "(substr(md5(concat(CAST(order_id AS VARCHAR), '|42')), 1, 8) < '33333333'))",
       f"judged AS ({ORACLE['request_validation'].replace(_with(FIX, fx.duckdb_request_cte()), '').replace('SELECT order_id,', 'SELECT order_id, overall_qual,', 1)})")
       + "SELECT order_id, CASE WHEN n_errors = 0 THEN 'scored' ELSE 'rejected' END AS status, "
       "CASE WHEN n_errors = 0 THEN round(f.a + f.b * overall_qual, 2) END AS precio_predicho "
       "FROM judged, f")
def q_score_line(spark, sf):
    """Requests through rules, features, alignment and a saved one-feature linear model."""
    from casaframe.operators.score import score

    clean = fx.properties_clean(spark, sf).select("order_id", "overall_qual", "saleprice")
    res = model.train_and_select(clean, ["overall_qual"], names=["Linear Regression"])
    out = shared_dir(spark, "models", unique=True)
    model.persist_model(res, out)
    pm, meta = model.load_model(spark, out)
    scored, rejected = score(fx.requests(spark, sf).drop("l_shipdate"), pm, meta, passthrough=["order_id"])
    return scored.select("order_id", F.lit("scored").alias("status"), "precio_predicho").unionByName(
        rejected.select("order_id", F.lit("rejected").alias("status"),
                        F.lit(None).cast("double").alias("precio_predicho")))


@query("ingest_log", _with(FIX) + "SELECT 'ingest' AS step, k AS key, CAST(v AS DOUBLE) AS value, 2 AS version "
       f"FROM (SELECT count(*) AS raw_rows, {len(RAW_COLS)} AS raw_columns, "
       + " + ".join(f"(count(*) - count({c}))" for c in RAW_COLS)
       + " AS raw_total_nulls FROM properties_raw) UNPIVOT (v FOR k IN (raw_rows, raw_columns, raw_total_nulls))")
def q_ingest_log(spark, sf):
    """Metrics of an ingest in the run log, beside the second version registered under one name."""
    from casaframe.plans.runlog import RunLog

    log = RunLog(spark, shared_dir(spark, "runlog", unique=True))
    run_id = RunLog.new_run_id()
    prof = profile.raw_profile(fx.properties_raw(spark, sf))
    log.log_metrics(run_id, "ingest", profile.profile_metrics(prof).first().asDict())
    for _ in range(2):
        log.register_model(schema.MODEL_NAME, run_id, "none")
    last = log.versions().agg(F.max("version").cast("int").alias("version"))
    return log.metrics().select("step", "key", "value").crossJoin(F.broadcast(last))  # one row


@query("run_documents", DRIFT_BASE + "SELECT 'raw_profile' AS document, column_name AS key, "
       "CAST(null_count AS DOUBLE) AS value FROM (" + ORACLE["raw_profile"].replace(_with(FIX), "") + ") UNION ALL "
       "SELECT 'drift_report', column_name, psi FROM (" + DRIFT_FEATURES_SQL + ")")
def q_run_documents(spark, sf):
    """Nested metrics of two logged documents: missing cells of a profile, PSI scores of a drift report."""
    from dataclasses import asdict

    from casaframe.plans.runlog import RunLog

    log = RunLog(spark, shared_dir(spark, "runlog", unique=True))
    run_id = RunLog.new_run_id()
    log.log_document(run_id, "ingest", "raw_profile",
                     profile.profile_dict(profile.raw_profile(fx.properties_raw(spark, sf))))
    ref, cur = fx.drift_pair(spark, sf)
    report = drift.detect_drift(ref.select(*DRIFT_COLS), cur.select(*DRIFT_COLS))
    log.log_document(run_id, "drift", "drift_report", asdict(report))
    parts = [log.nested(name, path).select(F.lit(name).alias("document"), "key", "value")
             for name, path in (("raw_profile", "$.null_counts"), ("drift_report", "$.psi_scores"))]
    return parts[0].unionByName(parts[1])


@query("metrics_log")
def q_metrics_log(spark, sf):
    from casaframe.plans.runlog import RunLog

    log = RunLog(spark, shared_dir(spark, "runlog", unique=True))
    run_id = RunLog.new_run_id()
    prof = profile.raw_profile(fx.properties_raw(spark, sf))
    log.log_metrics(run_id, "ingest", profile.profile_metrics(prof).first().asDict())
    res, saved = _trained(spark, sf)
    log.log_params(run_id, "train", {"best_model": res.best_name,
                                     "r2_min_threshold": schema.R2_MIN_THRESHOLD})
    log.log_metrics(run_id, "train", res.metrics)
    log.register_model(schema.MODEL_NAME, run_id, saved)
    return log.metrics().drop("ts", "run_id")


@query("model_info")
def q_model_info(spark, sf):
    from casaframe.plans.runlog import model_info

    return model_info(spark, _saved_model(spark, sf))
