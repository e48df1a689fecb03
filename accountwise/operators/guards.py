"""Feature guard and drift measure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwise.functions.columns import rate
from accountwise.operators.ranking import exact_quantiles


def winsorise(df: DataFrame, column: str, share: float = 0.99, cuts=None) -> DataFrame:
    """Clip a column at an upper quantile (exact). Off by default in the feature build."""
    top = exact_quantiles(df, [], column, {"top": share}, cuts).select("top").scalar()
    return df.withColumn(column, F.when(F.col(column).isNotNull(), F.least(F.col(column).cast("double"), top)))


def score_drift(expected: DataFrame, actual: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Population stability per bin of [0, 1]; the index is the sum of ``stability``."""

    def shares(df: DataFrame, name: str) -> DataFrame:
        at = F.least(F.lit(bins - 1), F.floor(F.col(column) * bins)).cast("int").alias("bin")
        counts = df.where(F.col(column).isNotNull()).groupBy(at).agg(F.count(F.lit(1)).alias("n"))
        total = df.agg(F.count(column)).scalar()
        return counts.select("bin", rate(F.col("n"), total).alias(name))

    both = shares(expected, "expected").join(shares(actual, "actual"), "bin", "full_outer")
    e, a = (F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(1e-4)) for c in ("expected", "actual"))
    return both.select(
        "bin", F.coalesce("expected", F.lit(0.0)).alias("expected"), F.coalesce("actual", F.lit(0.0)).alias("actual"),
        ((a - e) * F.log(a / e)).alias("stability"),
    )
