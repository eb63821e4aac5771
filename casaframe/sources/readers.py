"""Readers: CSV with pandas-like missing tokens, suffix dispatch, tables, JDBC, prepared data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casaframe import schema as sch
from casaframe.functions.exprs import NUMBER_PATTERN, is_float_type, nan_to_null
from casaframe.functions.names import normalize_columns
from casaframe.sources.csv_records import large_files, parsed, records
from casaframe.sources.snapshots import read_published

INT_PATTERN = r"^[+-]?\d+$"
BOOL_PATTERN = "^(true|false|True|False|TRUE|FALSE)$"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def missing_to_null(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Text cells equal to a missing token become NULL; NaN in float columns becomes NULL."""
    tokens = sch.MISSING_TOKENS if tokens is None else tokens
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            cols.append(F.when(c.isin(tokens), F.lit(None)).otherwise(c).alias(f.name))
        elif is_float_type(f.dataType):
            cols.append(nan_to_null(c).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def infer_types(df: DataFrame) -> DataFrame:
    """Type every text column from its values in one distributed pass.

    All non-missing values integral -> bigint, or decimal(38, 0) where 64 bits
    do not hold them all (double beyond 38 digits); all plain numbers ->
    double; all true/false -> boolean; no value at all -> double; otherwise
    text.  Only six counts per column reach the driver.
    """
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text_cols:
        return df
    aggs = []
    for i, c in enumerate(text_cols):
        v = F.trim(F.col(f"`{c}`"))
        aggs += [F.count(F.col(f"`{c}`")).alias(f"n{i}"),
                 F.count_if(v.rlike(INT_PATTERN)).alias(f"i{i}"),
                 F.count_if(v.rlike(INT_PATTERN) & v.try_cast("bigint").isNotNull()).alias(f"l{i}"),
                 F.count_if(v.rlike(INT_PATTERN) & v.try_cast("decimal(38,0)").isNotNull())
                 .alias(f"w{i}"),
                 F.count_if(v.rlike(BOOL_PATTERN)).alias(f"b{i}"),
                 F.count_if(v.rlike(NUMBER_PATTERN)).alias(f"d{i}")]
    row = df.agg(*aggs).first()
    casts = {}
    for i, c in enumerate(text_cols):
        n, ints, nums = row[f"n{i}"], row[f"i{i}"], row[f"d{i}"]
        if n == 0:
            casts[c] = "double"
        elif ints == n:
            casts[c] = ("bigint" if row[f"l{i}"] == n else
                        "decimal(38,0)" if row[f"w{i}"] == n else "double")
        elif row[f"b{i}"] == n:
            casts[c] = "boolean"
        elif nums == n:
            casts[c] = "double"
    return df.select(*[
        F.expr(f"try_cast(trim(`{f.name}`) AS {casts[f.name]})").alias(f.name)
        if f.name in casts else F.col(f"`{f.name}`") for f in df.schema.fields])


def apply_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast text columns to a declared schema; unparseable numbers become NULL."""
    cols = []
    present = set(df.columns)
    for f in target.fields:
        if f.name not in present:
            continue
        c = F.trim(F.col(f"`{f.name}`"))
        if isinstance(f.dataType, T.NumericType):
            num = F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))
            if isinstance(f.dataType, T.IntegralType):
                # whole numbers keep every digit; only text with a fraction is rounded
                num = F.when(c.rlike(INT_PATTERN), c.try_cast(f.dataType)).otherwise(
                    F.round(num, 0).try_cast(f.dataType))
            cols.append(num.cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.col(f"`{f.name}`"))
        else:
            cols.append(F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in {f.name for f in target.fields}]
    return df.select(*cols, *extra)


def _split_bytes(spark: SparkSession) -> int:
    conf = spark._jsparkSession.sessionState().conf()
    return int(conf.filesMaxPartitionBytes())


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = True, normalize: bool = True,
             tokens: list[str] | None = None, multi_line: bool = True,
             split_bytes: int | None = None) -> DataFrame:
    """CSV with a header row; quotes inside quoted cells are doubled.

    Quoted cells may hold line breaks.  Files larger than a split
    (``split_bytes``, else ``spark.sql.files.maxPartitionBytes``) are read by many tasks all the same
    (``csv_records``), smaller ones by a task each; ``multi_line=False`` is a
    plainer plan where no cell holds a line break.

    Cells are read as text, missing tokens become NULL, then either the
    declared ``schema`` (matched after name normalisation) or value-based
    inference types the columns, and names are normalised.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
              .option("mode", "PERMISSIVE"))
    raw = reader.csv(path)
    if multi_line:
        large, small = large_files(spark, path, split_bytes or _split_bytes(spark))
        if large:
            whole = parsed(records(spark, large), raw.columns)
            raw = whole.unionByName(reader.schema(raw.schema).csv(small)) if small else whole
    if normalize:
        raw = normalize_columns(raw)
    raw = missing_to_null(raw, tokens)
    if schema is not None:
        return apply_schema(raw, schema)
    return infer_types(raw) if infer else raw


def read_tabular(spark: SparkSession, path: str, **csv_options) -> DataFrame:
    """Reader chosen by suffix (case-insensitive): .csv, .parquet, .pq."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"file not found: {path}")
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if suffix == "csv":
        return read_csv(spark, path, **csv_options)
    if suffix in ("parquet", "pq"):
        return missing_to_null(spark.read.parquet(path))
    raise ValueError(f"unsupported format: {path}; use .csv or .parquet")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view (lazy; Catalyst inlines views)."""
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, properties: dict | None = None) -> DataFrame:
    """A database table read in parallel slices of ``partition_column``."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=properties or {})


def load_prepared(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The prepared dataset at ``path`` if it exists, else the plan that builds it."""
    if path_exists(spark, path):
        return read_published(spark, path)
    return build()
