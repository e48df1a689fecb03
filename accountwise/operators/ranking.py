"""Running totals, exact quantiles and ranks without a single-task global sort.

``Window.orderBy`` over a large group sorts that group in one task. Here the rows are first combined to
distinct values, then cut into value ranges of about equal size; a running total is the range-local
running total plus the totals of the ranges before it. The number of ranges follows the number of distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwise.session import cut_lineage

MIN_RANGES, ROWS_A_RANGE = 16, 1_000_000


def value_cuts(df: DataFrame, order: str, ranges: int | None = None) -> list[float]:
    """Cut points giving about equal numbers of rows per range (a small sketch, one pass after a count)."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = ranges or max(MIN_RANGES, 2 * tasks, df.count() // ROWS_A_RANGE)
    cuts = df.approxQuantile(order, [i / n for i in range(1, n)], 0.25 / n)
    return sorted({float(c) for c in cuts})


def running_totals(
    counted: DataFrame,
    keys: Sequence[str],
    order: str,
    measures: Sequence[str],
    cuts: Sequence[float] | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<m>`` (this value included) and ``total_<m>`` for every measure, per group in ``keys``.

    ``counted`` holds one row per (keys, order); rows whose ``order`` is NULL or NaN have no place in the order and
    are left out, of the totals too. ``cuts`` may be given when the distribution is known, otherwise ``counted`` is
    stored and they are sketched on it, so that its input is read once. The ranges depend on the value only, so a
    recomputed task agrees.
    """
    counted = counted.where(~F.isnan(F.col(order).cast("double")) & F.col(order).isNotNull())
    if cuts is None:
        counted = cut_lineage(counted)
        cuts = value_cuts(counted, order)
    else:
        cuts = sorted(set(cuts))
    # one struct as the group key: equal to itself also where a key is NULL, and the same expression in the
    # window and in the join, so that the join reuses the partitioning of the window
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    keyed = counted.withColumn("_group", group)
    if cuts:
        ranged = Bucketizer(
            splits=[float("-inf"), *cuts, float("inf")], inputCol="_order", outputCol="_range"
        ).transform(keyed.withColumn("_order", F.col(order).cast("double"))).drop("_order")
        ranged = ranged.withColumn("_range", F.col("_range").cast("int"))
    else:
        ranged = keyed.withColumn("_range", F.lit(0))
    direction = (lambda c: c.desc()) if descending else (lambda c: c.asc())
    totals = ranged.groupBy("_group", "_range").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    # at most one row per range and group from here on
    span = Window.partitionBy("_group")
    before = span.orderBy(direction(F.col("_range"))).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_group").alias("_g"), F.col("_range").alias("_r"),
        *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(span).alias(f"total_{m}") for m in measures],
    )
    if not keys:
        offsets = F.broadcast(offsets)  # one row per range: at most one for ROWS_A_RANGE values, or two per task
    inside = (
        Window.partitionBy("_group", "_range").orderBy(direction(F.col(order)))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = ranged.select("*", *[F.sum(m).over(inside).alias(f"_in_{m}") for m in measures])
    return local.join(offsets, (F.col("_group") == F.col("_g")) & (F.col("_range") == F.col("_r")), "inner").select(
        *counted.columns,
        *[(F.col(f"_before_{m}") + F.col(f"_in_{m}")).alias(f"cum_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], cuts: Sequence[float] | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles per group: one row per group, one column per entry of probs.

    NULL and NaN values are left out.
    """
    counted = (
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(counted, keys, value, ["n"], cuts)
    first = F.col("cum_n") - F.col("n")  # zero-based position of the first copy of this value
    last = F.col("cum_n") - 1
    picks = []
    for name, p in probs.items():
        pos = (F.col("total_n") - 1) * F.lit(float(p))
        low, high = F.floor(pos), F.ceil(pos)
        picks += [
            F.max(F.when((first <= low) & (low <= last), F.col(value))).alias(f"_lo_{name}"),
            F.max(F.when((first <= high) & (high <= last), F.col(value))).alias(f"_hi_{name}"),
            F.max(pos - low).alias(f"_w_{name}"),
        ]
    return ranked.groupBy(*keys).agg(*picks).select(
        *keys,
        *[
            (F.col(f"_lo_{n}").cast("double")
             + (F.col(f"_hi_{n}").cast("double") - F.col(f"_lo_{n}").cast("double")) * F.col(f"_w_{n}")).alias(n)
            for n in probs
        ],
    )


def melt(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Long form of numeric columns in one scan."""
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keys), list(columns), name, value
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global top-n: each task keeps n rows, then n rows per task are merged."""
    return df.orderBy(*order).limit(n)
