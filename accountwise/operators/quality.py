"""Quality gates: each returns a DataFrame of checks, never raises on data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwise.config import MIN_ROWS, PRIMARY_KEY, REQUIRED_COLUMNS
from accountwise.functions.columns import numeric_columns
from accountwise.operators.assemble import feature_statistics

CHECKS = "table_name string, check_name string, observed bigint, expected bigint, ok boolean"


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def row_counts(tables: Mapping[str, DataFrame], minimum: Mapping[str, int] = MIN_ROWS) -> DataFrame:
    """Count against the minimum. A Parquet count reads footers only."""
    parts = []
    for name, df in tables.items():
        if name in minimum:
            n = F.count(F.lit(1))
            parts.append(df.agg(
                F.lit(name).alias("table_name"), F.lit("min_rows").alias("check_name"), n.alias("observed"),
                F.lit(minimum[name]).cast("bigint").alias("expected"), (n >= minimum[name]).alias("ok"),
            ))
    return _union(parts)


def null_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = PRIMARY_KEY) -> DataFrame:
    parts = []
    for name, df in tables.items():
        if name in keys:
            bad = F.count_if(F.col(keys[name]).isNull())
            parts.append(df.agg(
                F.lit(name).alias("table_name"), F.lit("null_keys").alias("check_name"), bad.alias("observed"),
                F.lit(0).cast("bigint").alias("expected"), (bad == 0).alias("ok"),
            ))
    return _union(parts)


def required_columns(
    spark: SparkSession, tables: Mapping[str, DataFrame],
    required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS,
) -> DataFrame:
    """Missing tables and columns; looks at schemas only."""
    rows = []
    for name, columns in required.items():
        if name not in tables:
            rows.append((name, "missing_table", 0, 1, False))
            continue
        missing = sorted(set(columns) - set(tables[name].columns))
        rows.append((name, "missing_columns:" + ",".join(missing), len(missing), 0, not missing))
    return spark.createDataFrame(rows, CHECKS)


def feature_gate(features: DataFrame, min_rows: int = 4500, min_columns: int = 30, target: str = "clv_12m") -> DataFrame:
    """Rows, columns, numeric NULLs and target, from one pass."""
    holes = F.lit(0).cast("bigint")
    for c in numeric_columns(features):
        holes = holes + F.count_if(F.col(c).isNull())
    columns = len(features.columns)
    seen = features.agg(F.count(F.lit(1)).alias("rows"), holes.alias("nulls"))
    check = lambda name, observed, expected, ok: F.struct(
        F.lit("account_features").alias("table_name"), F.lit(name).alias("check_name"),
        observed.cast("bigint").alias("observed"), F.lit(expected).cast("bigint").alias("expected"), ok.alias("ok"),
    )
    return seen.select(F.inline(F.array(
        check("min_rows", F.col("rows"), min_rows, F.col("rows") >= min_rows),
        check("min_columns", F.lit(columns), min_columns, F.lit(columns >= min_columns)),
        check("numeric_nulls", F.col("nulls"), 0, F.col("nulls") == 0),
        check("target_present", F.lit(int(target in features.columns)), 1, F.lit(target in features.columns)),
    )))


def table_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and megabytes of file-backed tables. File sizes come from the scan's metadata column,
    so no table column is read."""
    parts = []
    for name, df in tables.items():
        per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("bytes")
        )
        parts.append(per_file.agg(F.sum("n").alias("rows"), F.sum("bytes").alias("bytes")).select(
            F.lit(name).alias("table_name"), F.coalesce("rows", F.lit(0)).alias("rows"),
            F.lit(len(df.columns)).alias("columns"),
            F.round(F.coalesce("bytes", F.lit(0)) / (1024.0 * 1024.0), 2).alias("size_mb"),
        ))
    return _union(parts)


def all_feature_statistics(features: DataFrame) -> DataFrame:
    return feature_statistics(features, redact=False).drop("redacted_columns")
