"""Survival analysis: Kaplan-Meier tables, Cox regression, concordance, churn scoring."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import erfc, exp, log2, sqrt

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accountwise.config import HIGH_RISK, SURVIVAL_COVARIATES, SURVIVAL_HORIZONS
from accountwise.functions.columns import rate
from accountwise.operators.ranking import exact_quantiles, running_totals
from accountwise.operators.scaling import Scaler, fit_scaler
from accountwise.session import cut_lineage


def survival_frame(
    features: DataFrame, covariates: Sequence[str] = SURVIVAL_COVARIATES, scaler: Scaler | None = None
) -> tuple[DataFrame, Scaler]:
    """duration = tenure (at least one day), event = churned, covariates standardised."""
    scaler = scaler or fit_scaler(features, covariates)
    frame = features.select(
        "account_id", F.greatest(F.lit(1), F.col("tenure_days")).alias("duration"),
        F.coalesce(F.col("is_churned").cast("int"), F.lit(0)).alias("event"),
        F.col("tier_rank").alias("tier_rank_raw"), *covariates,
    )
    return scaler.transform(frame), scaler


def kaplan_meier(frame: DataFrame, by: str | None = None, min_rows: int = 0) -> DataFrame:
    """Survival table. Rows are combined to (group, day) first, so the windows see at most one row per
    calendar day and group; groups of ``min_rows`` rows or fewer are left out."""
    keys = [by] if by else []
    days = frame.groupBy(*keys, "duration").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event").alias("events")
    )
    span = Window.partitionBy(*(keys or [F.lit(0)]))
    later = span.orderBy("duration").rowsBetween(0, Window.unboundedFollowing)
    sofar = span.orderBy("duration").rowsBetween(Window.unboundedPreceding, 0)
    at_risk = days.select(
        "*", F.sum("n").over(later).alias("at_risk"), F.sum("n").over(span).alias("group_rows")
    ).where(F.col("group_rows") > min_rows)
    step = F.log(F.greatest(1 - F.col("events") / F.col("at_risk").cast("double"), F.lit(1e-300)))
    return at_risk.select(
        *keys, "duration", "at_risk", "events",
        F.round(F.exp(F.sum(step).over(sofar)), 12).alias("survival"),
    )


def tier_thirds(frame: DataFrame, column: str = "tier_rank_raw") -> DataFrame:
    """Three equal-width groups of a rank, right-closed: the fallback when quartiles are not distinct."""
    bounds = frame.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    width = (bounds["hi"] - bounds["lo"]) / F.lit(3.0)
    third = F.greatest(F.lit(1), F.ceil(F.try_divide(F.col(column) - bounds["lo"], width)))
    return frame.withColumn(
        "tier_group", F.when(third <= 1, "Low").when(third == 2, "Medium").otherwise("High")
    )


def median_survival(table: DataFrame, by: str | None = None) -> DataFrame:
    """First day with S <= 0.5; infinite when the curve never gets there."""
    first = F.coalesce(
        F.min(F.when(F.col("survival") <= 0.5, F.col("duration"))).cast("double"), F.lit(float("inf"))
    ).alias("median_survival_days")
    return table.groupBy(by).agg(first) if by else table.agg(first)


@dataclass
class CoxModel:
    covariates: tuple[str, ...]
    coef: np.ndarray
    se: np.ndarray
    times: np.ndarray
    cumulative_hazard: np.ndarray
    iterations: int

    def log_hazard(self) -> Column:
        terms = [F.lit(float(b)) * F.col(c) for b, c in zip(self.coef, self.covariates)]
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    def summary(self, spark: SparkSession) -> DataFrame:
        """coef, hazard ratio, standard error, 95 % interval, z and p per covariate."""
        rows = []
        for name, b, s in zip(self.covariates, self.coef, self.se):
            z = b / s if s > 0 else float("nan")
            p = erfc(abs(z) / sqrt(2.0))
            lo, hi = b - 1.959963984540054 * s, b + 1.959963984540054 * s
            rows.append((name, float(b), exp(b), float(s), float(lo), float(hi), exp(lo), exp(hi), float(z), p,
                         -log2(p) if p > 0 else float("inf")))
        return spark.createDataFrame(
            rows,
            "covariate string, coef double, hazard_ratio double, se double, coef_lower_95 double, "
            "coef_upper_95 double, hazard_ratio_lower_95 double, hazard_ratio_upper_95 double, z double, p double, "
            "neg_log2_p double",
        )

    def hazard_at(self, t: float) -> float:
        """Baseline cumulative hazard, linear between observed days and 0 at day 0."""
        return float(np.interp(t, np.append(0.0, self.times), np.append(0.0, self.cumulative_hazard)))


def _moments(packed: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight, first and second moments from rows of [w, wx (p), wxx (p*p)]."""
    return packed[..., 0], packed[..., 1:p + 1], packed[..., p + 1:].reshape(packed.shape[:-1] + (p, p))


def _day_moments(frame: DataFrame, covariates: Sequence[str], beta: np.ndarray) -> DataFrame:
    """One row per (duration, event): the account count n and the weighted moments m with w = exp(beta x).

    Every task folds its Arrow batches into one row per day it has seen, so what is shuffled is bounded by
    tasks x calendar days, never by accounts, and the wide products exist for one batch at a time.
    """
    names, p = list(covariates), len(covariates)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, int], np.ndarray] = {}
        counts: dict[tuple[int, int], int] = {}
        for batch in batches:
            x = batch[names].to_numpy(dtype=float)
            w = np.exp(x @ beta)
            wx = x * w[:, None]
            wide = np.hstack([w[:, None], wx, np.einsum("ni,nj->nij", wx, x).reshape(len(x), p * p)])
            key = batch["duration"].to_numpy(dtype=np.int64) * 2 + batch["event"].to_numpy(dtype=np.int64)
            order = np.argsort(key, kind="stable")
            days, starts, rows = np.unique(key[order], return_index=True, return_counts=True)
            for day, n, total in zip(days, rows, np.add.reduceat(wide[order], starts, axis=0) if len(x) else ()):
                at = (int(day) // 2, int(day) % 2)
                seen[at] = seen[at] + total if at in seen else total
                counts[at] = counts.get(at, 0) + int(n)
        if seen:
            yield pd.DataFrame({
                "duration": [k[0] for k in seen], "event": [k[1] for k in seen], "n": [counts[k] for k in seen],
                "m": [v.tolist() for v in seen.values()],
            })

    parts = frame.select("duration", "event", *names).mapInPandas(fold, "duration bigint, event int, n bigint, m array<double>")
    # the summarizer's sum is a mean times a weight: near enough for moments, but a count of it may lie just below the number
    merged = Summarizer.metrics("sum").summary(array_to_vector("m")).getField("sum")
    return parts.groupBy("duration", "event").agg(F.sum("n").alias("n"), vector_to_array(merged).alias("m"))


#: Tied events of a day that are added one by one; beyond, only as many as lie next to the end, the rest by integrals.
TIED = 4096
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(16)


def _terms(s0: float, d0: float, d: int, at: np.ndarray) -> np.ndarray:
    """1/f, a/f, 1/f2, a/f2, a2/f2, log f at the given places of the tied events, with f = s0 - a*d0 and a = place / d."""
    a = at / d
    f = s0 - a * d0
    g = 1.0 / f
    return np.array([g, a * g, g * g, a * g * g, a * a * g * g, np.log(f)])


def _tie_sums(s0: float, d0: float, d: int) -> np.ndarray:
    """Efron: the sums of the terms over the d tied events, in O(log d).

    The terms are smooth but for the end, where f may come near 0: the last events are added one by one. The sum over all before is
    the integral, taken over pieces that halve towards the end, and the first two corrections of Euler and Maclaurin.
    """
    if d <= TIED:
        return _terms(s0, d0, d, np.arange(d)).sum(1)
    m = d - TIED // 2
    bounds, left = [0.0], float(m)
    while left > TIED:
        bounds.append(m - left / 2)
        left /= 2
    bounds = np.array([*bounds, float(m)])
    half, middle = np.diff(bounds) / 2, (bounds[1:] + bounds[:-1]) / 2
    nodes = middle[:, None] + half[:, None] * _NODES
    integral = (_terms(s0, d0, d, nodes) * (half[:, None] * _WEIGHTS)).sum((1, 2))
    ends = _terms(s0, d0, d, np.array([0.0, float(m)]))
    # derivatives by the place, in closed form: f' = -d0 / d, a' = 1 / d
    g, ag, gg, agg, aagg, _ = ends
    c, a = d0 / d, np.array([0.0, m / d])
    slope = np.array([c * gg, g / d + c * agg, 2 * c * g**3, gg / d + 2 * c * a * g**3, 2 * a * gg / d + 2 * c * a * a * g**3, -c * g])
    sums = integral - (ends[:, 1] - ends[:, 0]) / 2 + (slope[:, 1] - slope[:, 0]) / 12
    return sums + _terms(s0, d0, d, np.arange(m, d)).sum(1)


@dataclass
class CoxTerms:
    """The penalised log-likelihood at some coefficients, its derivatives, and what the baseline hazard needs, by day."""

    loglik: float
    gradient: np.ndarray
    hessian: np.ndarray
    days: np.ndarray
    deaths: np.ndarray
    at_risk: np.ndarray

    def cumulative_hazard(self) -> np.ndarray:
        return np.cumsum(np.where(self.deaths > 0, self.deaths / self.at_risk, 0.0))


def cox_terms(
    data: DataFrame, covariates: Sequence[str], beta: np.ndarray, penalty: float = 0.0, ties: str = "efron"
) -> CoxTerms:
    """One aggregate of weighted moments per duration; one row per distinct day reaches the driver, which sums them up from
    the last day on. The work on the driver is bounded by days, however many events are tied."""
    p = len(covariates)
    width = 1 + p + p * p
    rows = _day_moments(data, covariates, beta).collect()
    days = sorted({r["duration"] for r in rows})
    place = {d: i for i, d in enumerate(days)}
    n, deaths = 0, np.zeros(len(days), dtype=int)
    everyone, dead = np.zeros((len(days), width)), np.zeros((len(days), width))
    for r in rows:
        at, line = place[r["duration"]], np.array(r["m"])
        everyone[at] += line
        n += r["n"]
        if r["event"]:
            deaths[at], dead[at] = r["n"], line
    s0, s1, s2 = _moments(everyone[::-1].cumsum(0)[::-1], p)
    own = data.where(F.col("event") == 1).agg(*[F.sum(c).alias(c) for c in covariates]).first()
    grad = np.array([own[c] or 0.0 for c in covariates], dtype=float)
    loglik, hess = float(grad @ beta), np.zeros((p, p))
    for k in np.flatnonzero(deaths):
        d0, d1, d2 = _moments(dead[k] if ties == "efron" else np.zeros(width), p)
        f, af, ff, aff, aaff, logs = _tie_sums(float(s0[k]), float(d0), int(deaths[k]))
        loglik -= logs
        grad -= s1[k] * f - d1 * af
        cross = np.outer(s1[k], d1)
        hess += s2[k] * f - d2 * af
        hess -= np.outer(s1[k], s1[k]) * ff - (cross + cross.T) * aff + np.outer(d1, d1) * aaff
    loglik -= 0.5 * n * penalty * float(beta @ beta)
    return CoxTerms(
        loglik, grad - n * penalty * beta, hess + n * penalty * np.eye(p), np.array(days, dtype=float), deaths, s0)


def fit_cox(
    frame: DataFrame, covariates: Sequence[str] = SURVIVAL_COVARIATES, penalty: float = 0.01,
    ties: str = "efron", max_iter: int = 100, tol: float = 1e-9,
) -> CoxModel:
    """Proportional hazards with an L2 penalty of n * penalty / 2 * |beta|^2, by Newton steps.

    A fit that doesn't settle in ``max_iter`` rounds is an error.
    """
    data = cut_lineage(frame.select("duration", "event", *covariates))
    beta = np.zeros(len(covariates))
    now = cox_terms(data, covariates, beta, penalty, ties)
    rounds = 0
    for rounds in range(1, max_iter + 1):
        move = np.linalg.solve(now.hessian, now.gradient)
        shrink = 1.0
        while True:
            trial = cox_terms(data, covariates, beta + shrink * move, penalty, ties)
            if trial.loglik >= now.loglik - 1e-9 * max(1.0, abs(now.loglik)):
                break
            if shrink < 1e-4:
                raise RuntimeError(f"the Cox fit finds no better step in round {rounds}")
            shrink /= 2
        beta = beta + shrink * move
        gained, now = trial.loglik - now.loglik, trial
        if abs(gained) < tol * max(1.0, abs(now.loglik)) and np.abs(move).max() < 1e-6:
            break
    else:
        raise RuntimeError(f"the Cox fit has not settled after {max_iter} rounds")
    se = np.sqrt(np.diag(np.linalg.inv(now.hessian)))
    return CoxModel(tuple(covariates), beta, se, now.days, now.cumulative_hazard(), rounds)


def score_churn(model: CoxModel, frame: DataFrame) -> DataFrame:
    """Survival at fixed horizons, risk = 1 - S(last horizon), relative hazard, expected lifetime.

    The lifetime is the area under exp(-H0(t) * hazard): a numpy helper on Arrow batches, with the
    baseline (one number per calendar day) shipped in the closure.
    """
    steps = np.append(0.0, model.times)
    baseline = np.append(0.0, model.cumulative_hazard)

    @F.pandas_udf("double")
    def area(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for hazard in batches:
            out = np.empty(len(hazard))
            values = hazard.to_numpy()
            for i in range(0, len(values), 256):
                curve = np.exp(-np.outer(values[i:i + 256], baseline))
                out[i:i + 256] = np.trapezoid(curve, steps, axis=1)
            yield pd.Series(out)

    hazard = F.col("partial_hazard")
    scored = frame.select("account_id", F.exp(model.log_hazard()).alias("partial_hazard"))
    probs = [
        F.exp(-F.lit(model.hazard_at(h)) * hazard).alias(f"survival_prob_{h}d") for h in SURVIVAL_HORIZONS
    ]
    last = F.col(f"survival_prob_{max(SURVIVAL_HORIZONS)}d")
    return scored.select(
        "account_id", *probs, hazard, area(hazard).alias("expected_lifetime_days")
    ).withColumn("churn_risk_score", 1 - last)


def concordance(df: DataFrame, risk: str = "risk", cuts=None) -> DataFrame:
    """Share of comparable pairs in which the account that churned earlier had the higher risk.

    Pairs are never formed. Risks become dense ranks; two different ranks first differ at exactly one
    bit, so for every bit the accounts that agree above it are counted per day, and a running sum over
    days gives the pairs won and lost. Windows hold at most two rows per calendar day.
    """
    # a censored account outlives one that churned on the same day
    order = 2 * F.col("duration").cast("bigint") + F.when(F.col("event") == 1, 0).otherwise(1)
    cells = df.groupBy(F.col(risk).alias("risk"), order.alias("t")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event").alias("e")
    )
    ranks = running_totals(
        cells.select("risk").distinct().withColumn("one", F.lit(1)), [], "risk", ["one"], cuts
    ).select(F.col("risk").alias("_risk"), (F.col("cum_one") - 1).alias("rank"), "total_one")
    ranked = cells.join(ranks, F.col("risk") == F.col("_risk"))
    top = F.greatest(F.lit(0), F.ceil(F.log2(F.col("total_one").cast("double"))).cast("int"))
    # level 0 pairs equal ranks, level b pairs ranks that differ first at bit b
    levels = ranked.select("t", "n", "e", "rank", F.explode(F.sequence(F.lit(0), top)).alias("level"))
    equal = F.col("level") == 0
    prefix = F.call_function("shiftright", F.col("rank"), F.col("level"))
    upper = F.call_function("shiftright", F.col("rank"), F.greatest(F.lit(0), F.col("level") - 1)).bitwiseAND(1) == 1
    sided = levels.groupBy("level", prefix.alias("prefix"), "t").agg(
        F.sum(F.when(equal | ~upper, F.col("n")).otherwise(0)).alias("low_n"),
        F.sum(F.when(~equal & upper, F.col("n")).otherwise(0)).alias("high_n"),
        F.sum(F.when(equal | upper, F.col("e")).otherwise(0)).alias("high_e"),
        F.sum(F.when(~equal & ~upper, F.col("e")).otherwise(0)).alias("low_e"),
    )
    later = Window.partitionBy("level", "prefix").orderBy("t").rowsBetween(1, Window.unboundedFollowing)
    won = F.col("high_e") * F.coalesce(F.sum("low_n").over(later), F.lit(0))
    lost = F.col("low_e") * F.coalesce(F.sum("high_n").over(later), F.lit(0))
    pairs = sided.select("level", won.alias("won"), lost.alias("lost"))
    sums = pairs.agg(
        F.sum(F.when(F.col("level") > 0, F.col("won")).otherwise(0)).alias("concordant"),
        F.sum("lost").alias("discordant"),
        F.sum(F.when(F.col("level") == 0, F.col("won")).otherwise(0)).alias("tied"),
    )
    every = F.col("concordant") + F.col("discordant") + F.col("tied")
    return sums.withColumn("concordance_index", rate(F.col("concordant") + F.col("tied") / 2.0, every))


def risk_summary(scores: DataFrame, cuts=None) -> DataFrame:
    """Mean, exact median and number above the high-risk threshold."""
    score = F.col("churn_risk_score")
    median = exact_quantiles(scores, [], "churn_risk_score", {"median": 0.5}, cuts).select("median").scalar()
    return scores.agg(
        F.avg(score).alias("mean"), F.count_if(score > HIGH_RISK).alias("high_risk"), F.count(score).alias("accounts")
    ).withColumn("median", median)


def risk_histogram(scores: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins between the smallest and the largest score, the last one closed."""
    score = F.col("churn_risk_score")
    bounds = scores.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi"))).scalar()
    width = (bounds["hi"] - bounds["lo"]) / F.lit(float(bins))
    index = F.least(F.lit(bins - 1), F.floor(F.try_divide(score - bounds["lo"], width)))
    return (
        scores.where(score.isNotNull())
        .groupBy(F.coalesce(index, F.lit(0)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("accounts"))
    )
