"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Plain decimal number text: optional sign, digits with optional fraction, optional exponent.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def qcol(name: str) -> Column:
    """A column by its exact name (dots, spaces and dashes are not parsed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_float_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def nan_to_null(col: Column) -> Column:
    """NaN becomes NULL, the single notion of missing used throughout."""
    return F.nanvl(col, F.lit(None).cast("double"))


def to_double(name: str, dtype: T.DataType) -> Column:
    """Numeric value of a column as double, NULL where it is missing or not a number.

    Text is accepted only when it is a plain decimal number, which keeps
    ANSI casts from failing and rejects forms such as ``1d`` or ``nan``.
    """
    col = qcol(name)
    if is_numeric_type(dtype):
        out = col.cast("double")
        return nan_to_null(out) if is_float_type(dtype) else out
    if isinstance(dtype, T.StringType):
        txt = F.trim(col)
        return F.when(txt.rlike(NUMBER_PATTERN), txt.try_cast("double"))
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("double")
    return F.lit(None).cast("double")


def is_missing(name: str, dtype: T.DataType) -> Column:
    """NULL, or NaN for float columns."""
    col = qcol(name)
    if is_float_type(dtype):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL instead of failing on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def positive_flag(col: Column) -> Column:
    """1 when the value is greater than 0, else 0 (missing counts as 0)."""
    return F.coalesce(col > 0, F.lit(False)).cast("int")


def format_usd(col: Column) -> Column:
    """``$1,234 USD`` with thousands separators and no decimals."""
    return F.concat(F.lit("$"), F.format_number(col, 0), F.lit(" USD"))
