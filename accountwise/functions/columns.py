"""Column expressions shared by the operators. All stay inside JVM code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountwise.config import HIGH_RISK, MEDIUM_RISK


def lookup(key: Column, table: Mapping, default) -> Column:
    """Small fixed rule table as a CASE expression: no join, no broadcast."""
    out = None
    for k, v in table.items():
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def blank_to(col: Column, default: str) -> Column:
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def clamp01(col: Column) -> Column:
    """Clamp to [0, 1] but keep NULL as NULL (least/greatest alone would skip it)."""
    return F.when(col.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), col)))


def rate(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL when whole is 0 or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def risk_level(score: Column) -> Column:
    return F.when(score > HIGH_RISK, "High").when(score > MEDIUM_RISK, "Medium").otherwise("Low")


def month_boundaries(start: Column, end: Column) -> Column:
    """Calendar months crossed between two dates (2021-01-31 to 2021-02-01 is 1)."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def day(value: date) -> Column:
    return F.lit(value).cast("date")


def cents(amount: Column) -> Column:
    """Money as whole cents. Long sums are exact, independent of order and far cheaper than decimal sums;
    an overflow raises under ANSI mode instead of wrapping."""
    return F.floor(amount.cast("double") * 100 + 0.5)


def money(total_cents: Column) -> Column:
    return total_cents / F.lit(100.0)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def as_comparable(df: DataFrame) -> DataFrame:
    """Decimals to double, dates to ISO text, nested values to JSON: the form two engines agree on."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)
