"""Booking features per account: recency/frequency/spend windows, trends, cancellations, policy.

Input of every function: bookings that already carry ``account_id`` (see staging).

The windows are nested, so a booking is classified once, by the shortest window that contains it (its
*band*), and counted in one cell. Cells are few per account, are combined map-side and then summed to any
window: one scan and one heavy shuffle whatever the number of windows, and a hot account arrives as its
cells, not as its bookings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwise.config import Params
from accountwise.functions.columns import cents, day, days_between, money, rate
from accountwise.session import dealt_by_size

RECENT_DAYS, YEAR_DAYS = 180, 365
OLDER = 2_000_000_000  # band of everything before the longest window
MONTH, BAND, PLACE = "month", "band", "destination"


def history(bookings: DataFrame, p: Params, *more: Column, until: Column | None = None) -> DataFrame:
    """Bookings strictly before the cutoff (or ``until``) whose account is known, reduced to what the features read."""
    end = day(p.cutoff) if until is None else until
    past = bookings.where((F.col("booking_date") < end) & F.col("account_id").isNotNull())
    return past.select(
        "account_id", "booking_date", "is_cancelled", "is_out_of_policy",
        F.col("destination_region").alias(PLACE), cents(F.col("amount")).alias("paid"),
        days_between(F.col("booking_date"), F.col("travel_date")).alias("lead"),
        F.trunc("booking_date", "month").alias(MONTH), _band(p).alias(BAND), *more,
    )


def _band(p: Params) -> Column:
    out = None
    for w in sorted({*p.windows, *p.rate_windows, RECENT_DAYS, YEAR_DAYS}):
        inside = F.col("booking_date") >= day(p.back(w))
        out = F.when(inside, F.lit(w)) if out is None else out.when(inside, F.lit(w))
    return out.otherwise(F.lit(OLDER))


def _cells(rows: DataFrame, keys: tuple[str, ...], *more: Column) -> DataFrame:
    kept = ~F.col("is_cancelled")
    return rows.groupBy("account_id", *keys).agg(
        F.count("booking_date").alias("n"),
        F.count_if(kept).alias("n_kept"),
        F.sum(F.when(kept, F.col("paid"))).alias("paid"),
        F.count_if(kept & F.col("paid").isNotNull()).alias("priced"),
        F.max(F.when(kept, F.col("booking_date"))).alias("last_kept"),
        F.count_if("is_out_of_policy").alias("n_oop"),
        F.sum("lead").alias("lead_days"), F.count("lead").alias("lead_n"), *more,
    )


def _within(w: int, column: str) -> Column:
    return F.sum(F.when(F.col(BAND) <= w, F.col(column)))


def _rfm(p: Params) -> dict[str, Column]:
    out = {}
    for w in p.windows:
        spent = money(_within(w, "paid"))
        out[f"booking_count_{w}d"] = F.nullif(_within(w, "n_kept"), F.lit(0))
        out[f"total_spend_{w}d"] = spent
        out[f"avg_booking_amount_{w}d"] = rate(spent, _within(w, "priced"))
    return out | {
        "days_since_last_booking": days_between(F.max("last_kept"), day(p.cutoff)),
        "total_booking_count": F.nullif(F.sum("n_kept"), F.lit(0)),
        "total_spend": money(F.sum("paid")),
    }


def _behaviour(p: Params) -> dict[str, Column]:
    recent = rate(money(_within(RECENT_DAYS, "paid")), _within(RECENT_DAYS, "priced"))
    before = F.col(BAND) == YEAR_DAYS
    for w in p.windows:
        if RECENT_DAYS < w < YEAR_DAYS:
            before = before | (F.col(BAND) == w)
    older = rate(
        money(F.sum(F.when(before, F.col("paid")))), F.sum(F.when(before, F.col("priced")))
    )
    out = {"spend_acceleration": F.coalesce(recent - older, F.lit(0.0))}
    for w in p.rate_windows:
        total = _within(w, "n")
        out[f"cancellation_rate_{w}d"] = rate(total - _within(w, "n_kept"), total)
    return out


def _policy(p: Params) -> dict[str, Column]:
    rates = {w: rate(_within(w, "n_oop"), _within(w, "n")) for w in p.rate_windows}
    out = {f"out_of_policy_rate_{w}d": r for w, r in rates.items()}
    # NULL (later 0) when the short window is empty, not minus the long rate
    out["oop_trend"] = rates[min(p.rate_windows)] - rates[max(p.rate_windows)]
    out["destination_diversity"] = F.count_distinct(PLACE)
    out["avg_lead_time_days"] = rate(F.sum("lead_days"), F.sum("lead_n"))
    return out


def _trends() -> dict[str, Column]:
    kept = F.col("month_kept") > 0
    paid = F.when(kept, F.coalesce("paid", F.lit(0)))
    return {
        "booking_volume_trend": slope(F.max("x_all") + 1, F.sum(F.col("x_all") * F.col("n")), F.sum("n")),
        "spend_trend": slope(
            F.max(F.when(kept, F.col("x_kept"))) + 1, money(F.sum(F.col("x_kept") * paid)), money(F.sum(paid))
        ),
    }


def slope(points: Column, sum_xy: Column, sum_y: Column) -> Column:
    """Least-squares slope of y over x = 0..points-1; 0 below three points, NULL without any."""
    n = points.cast("double")
    top = sum_xy - (n - 1) / 2.0 * sum_y
    return F.when(n >= 3, top / (n * (n * n - 1) / 12.0)).when(n.isNotNull(), F.lit(0.0))


def _with_month_positions(cells: DataFrame) -> DataFrame:
    """Dense index over the months present, and over those with a kept booking.

    A window partition holds one account's cells: bounded by the calendar. Cells without a month (places)
    get no index. All windows agree on one order, (account, month, band), so the cells are sorted once.
    """
    dated = F.col(MONTH).isNotNull()
    month = Window.partitionBy("account_id", MONTH)
    marked = cells.withColumn("first_of_month", dated & (F.row_number().over(month.orderBy(BAND)) == 1))
    marked = marked.withColumn("month_kept", F.when(dated, F.sum("n_kept").over(month)))
    sofar = Window.partitionBy("account_id").orderBy(MONTH, BAND).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    position = lambda seen: F.sum(seen.cast("int")).over(sofar) - 1
    kept = F.coalesce(F.col("month_kept") > 0, F.lit(False))
    return marked.select(
        "*", F.when(dated, position(F.col("first_of_month"))).alias("x_all"),
        F.when(kept, position(F.col("first_of_month") & kept)).alias("x_kept"),
    )


def _per_account(cells: DataFrame, features: dict[str, Column]) -> DataFrame:
    return cells.groupBy("account_id").agg(*[c.alias(name) for name, c in features.items()])


def rfm(bookings: DataFrame, p: Params) -> DataFrame:
    kept = history(bookings, p).where(~F.col("is_cancelled"))
    return _per_account(_cells(kept, (BAND,)), _rfm(p))


def trajectory(bookings: DataFrame, p: Params) -> DataFrame:
    """Trends, spend acceleration and cancellation rates."""
    cells = _cells(history(bookings, p), (MONTH, BAND))
    return _per_account(_with_month_positions(cells), _trends() | _behaviour(p))


def policy(bookings: DataFrame, p: Params) -> DataFrame:
    return _per_account(_cells(history(bookings, p), (BAND, PLACE)), _policy(p))


def booking_features(bookings: DataFrame, p: Params, with_revenue: bool = False) -> DataFrame:
    """All three families from ONE scan and ONE join to travelers.

    Each booking feeds its (month, band) cell, which carries the counts, and an empty cell that only marks
    its destination. The second shuffle, by account, moves cells and serves the month index, the final
    sums and the joins of the assembly; it has more partitions for more input, so that no task grows with it. ``with_revenue`` adds ``revenue_ahead``, the cents of the kept bookings of
    the label period, which enter one more cell of their account and no feature.
    """
    ahead = F.col("booking_date") >= day(p.cutoff)
    kinds = F.when(ahead, F.array(F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1)))
    kind = F.explode(kinds if with_revenue else F.array(F.lit(0), F.lit(1))).alias("kind")
    rows = history(bookings, p, until=day(p.ahead(p.label_days)) if with_revenue else None).select("*", kind)
    counted = ("booking_date", "is_cancelled", "is_out_of_policy", "paid", "lead", MONTH, BAND)
    rows = rows.select(
        "account_id", *[F.when(F.col("kind") == 0, F.col(c)).alias(c) for c in counted],
        F.when(F.col("kind") == 1, F.col(PLACE)).alias(PLACE),
        F.when((F.col("kind") == 2) & ~F.col("is_cancelled"), F.col("paid")).alias("ahead"),
    )
    cells = dealt_by_size(_cells(rows, (MONTH, BAND, PLACE), F.sum("ahead").alias("ahead")), "account_id")
    features = _rfm(p) | _trends() | _behaviour(p) | _policy(p)
    if with_revenue:
        features["revenue_ahead"] = F.sum("ahead")
    # every destination is one marked cell by now: a plain count is the distinct count
    features["destination_diversity"] = F.count(PLACE)
    return _per_account(_with_month_positions(cells), features)


def rfm_with_cancelled(accounts: DataFrame, bookings: DataFrame, p: Params) -> DataFrame:
    """Variant that keeps cancelled bookings and reports average order values (0 without bookings)."""
    rows = history(bookings, p).groupBy("account_id", BAND).agg(
        F.count("booking_date").alias("n"), F.sum("paid").alias("paid"), F.max("booking_date").alias("last")
    )
    features = {
        "total_booking_count": F.sum("n"), "total_spend": money(F.sum("paid")),
        "days_since_last_booking": days_between(F.max("last"), day(p.cutoff)),
    }
    for w in p.windows:
        spent = money(_within(w, "paid"))
        features[f"booking_count_{w}d"] = _within(w, "n")
        features[f"total_spend_{w}d"] = spent
        features[f"aov_{w}d"] = rate(spent, _within(w, "n"))
    return accounts.select("account_id").join(_per_account(rows, features), "account_id", "left").na.fill(
        0, list(features)
    )
