"""The distributed algorithms against brute force, with hot keys, and with other partition counts."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountwise import session
from accountwise.operators import bookings, clv, cross_sell, guards, segments, staging, survival
from accountwise.operators.ranking import exact_quantiles, running_totals


def hot(rng, n):
    """A third of all values are the same."""
    return [5.0 if rng.random() < 0.34 else round(rng.expovariate(0.1), 2) for _ in range(n)]


def test_running_totals(spark):
    rng = random.Random(1)
    rows = [(k, float(v), rng.randrange(5)) for k in ("a", None) for v in rng.sample(range(1000), 300)]
    df = spark.createDataFrame(rows, "k string, v double, n int")
    for descending in (False, True):
        got = {(r["k"], r["v"]): (r["cum_n"], r["total_n"]) for r in
               running_totals(df, ["k"], "v", ["n"], descending=descending).collect()}
        for k in ("a", None):
            total = 0
            for _, v, n in sorted([r for r in rows if r[0] == k], key=lambda r: r[1], reverse=descending):
                total += n
                assert got[(k, v)][0] == total
            assert all(t == total for (kk, _), (_, t) in got.items() if kk == k)


@pytest.mark.parametrize("parts", ["1", "8"])
def test_quantiles_do_not_depend_on_partitions(spark, parts):
    rng = random.Random(2)
    rows = [(i % 3, v) for i, v in enumerate(hot(rng, 3000))]
    df = spark.createDataFrame(rows, "g int, v double").repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"q1": 0.25, "m": 0.5, "p99": 0.99}).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for g in range(3):
        want = np.quantile([v for k, v in rows if k == g], [0.25, 0.5, 0.99])
        assert np.allclose([got[g]["q1"], got[g]["m"], got[g]["p99"]], want)


def test_split_is_exact_within_strata(spark):
    df = spark.range(5000).select(F.col("id").alias("account_id"), F.when(F.col("id") < 3000, "hot").otherwise("b").alias("tier"))
    parts = {"train": 0.7, "validation": 0.15, "test": 0.15}
    split = clv.hash_split(df, "account_id", parts, "s", by="tier")
    got = Counter((r["tier"], r["split"]) for r in split.collect())
    for tier, n in (("hot", 3000), ("b", 2000)):
        for name, share in parts.items():
            assert got[(tier, name)] == pytest.approx(n * share, abs=1)
    again = clv.hash_split(df.repartition(13), "account_id", parts, "s", by="tier")
    assert again.exceptAll(split).isEmpty()


def test_concordance(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(1, 40), rng.randrange(2), rng.choice([0.1, 0.5, 0.5, rng.random()])) for _ in range(400)]
    got = survival.concordance(spark.createDataFrame(rows, "duration int, event int, risk double")).first()
    won = lost = tied = 0
    for ti, ei, ri in rows:
        for tj, ej, rj in rows:
            if ei and (ti < tj or (ti == tj and not ej)):
                won, lost, tied = won + (ri > rj), lost + (ri < rj), tied + (ri == rj)
    assert (got["concordant"], got["discordant"], got["tied"]) == (won, lost, tied)


def test_kaplan_meier_and_median(spark):
    df = spark.createDataFrame([(5, 1), (6, 1), (6, 0), (8, 1)], "duration int, event int")
    table = survival.kaplan_meier(df)
    assert [r["survival"] for r in table.orderBy("duration").collect()] == [0.75, 0.5, 0.0]
    assert survival.median_survival(table).first()[0] == 6
    assert survival.median_survival(survival.kaplan_meier(df.where("event = 0"))).first()[0] == float("inf")


def efron(beta, x, t, e, lam):
    total = -0.5 * len(t) * lam * float(beta @ beta)
    w = np.exp(x @ beta)
    for day in np.unique(t[e == 1]):
        dead = (t == day) & (e == 1)
        d, at_risk = dead.sum(), w[t >= day].sum()
        total += (x[dead] @ beta).sum() - sum(np.log(at_risk - k / d * w[dead].sum()) for k in range(d))
    return total


@pytest.mark.parametrize("ties", ["efron", "breslow"])
def test_cox_maximises_the_partial_likelihood(spark, ties):
    rng = np.random.default_rng(5)
    n = 200
    x = rng.normal(size=(n, 2))
    t = np.ceil(rng.exponential(8, n) * np.exp(-0.7 * x[:, 0])).astype(int)
    e = (rng.random(n) < 0.7).astype(int)
    df = spark.createDataFrame([(int(a), int(b), *map(float, r)) for a, b, r in zip(t, e, x)],
                               "duration int, event int, a double, b double")
    model = survival.fit_cox(df.repartition(5), ("a", "b"), penalty=0.01, ties=ties)
    if ties == "efron":
        h, f = 1e-4, lambda b: efron(b, x, t, e, 0.01)
        for i in range(2):
            step = np.eye(2)[i] * h
            assert abs(f(model.coef + step) - f(model.coef - step)) / (2 * h) < 1e-3
            curve = -(f(model.coef + step) - 2 * f(model.coef) + f(model.coef - step)) / h**2
            assert curve >= 1 / model.se[i] ** 2 * 0.99
    assert 0.3 < model.coef[0] < 1.2
    scores = survival.score_churn(model, df.withColumn("account_id", F.monotonically_increasing_id()))
    row = scores.agg(F.min("survival_prob_365d"), F.max("survival_prob_30d"), F.min("expected_lifetime_days")).first()
    assert 0 <= row[0] <= row[1] <= 1 and row[2] > 0
    assert scores.where("survival_prob_30d < survival_prob_90d").isEmpty()


def brute_clusters(points, cell, min_neighbours, min_size):
    cells = Counter(tuple(int(np.floor(c / cell)) for c in p) for p in points)
    around = lambda c: [(c[0] + i, c[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    core = {c for c in cells if sum(cells.get(n, 0) for n in around(c)) >= min_neighbours}
    name = lambda c: f"{c[0]},{c[1]}"
    label, todo = {}, set(core)
    while todo:
        group, stack = set(), [next(iter(todo))]
        while stack:
            c = stack.pop()
            if c not in group:
                group.add(c)
                stack += [n for n in around(c) if n in core and n not in group]
        todo -= group
        low = min(map(name, group))
        label |= {c: low for c in group}
    owned = {c: label.get(c) or min((label[n] for n in around(c) if n in core), default=None) for c in cells}
    sizes = Counter()
    for c, k in owned.items():
        if k:
            sizes[k] += cells[c]
    kept = {k: i for i, (k, _) in enumerate(sorted(((k, n) for k, n in sizes.items() if n >= min_size), key=lambda t: (-t[1], t[0])))}
    return [kept.get(owned[tuple(int(np.floor(c / cell)) for c in p)], -1) for p in points]


def test_density_clusters(spark):
    rng = np.random.default_rng(6)
    blobs = [rng.normal(c, 0.6, (n, 2)) for c, n in (((0, 0), 200), ((8, 8), 120), ((-9, 4), 15))]
    chain = np.column_stack([np.linspace(10, 40, 400), np.full(400, -10.0)])
    same = np.full((300, 2), 20.5)
    points = np.vstack([*blobs, chain, same, rng.uniform(-30, 60, (40, 2))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "account_id int, x double, y double")
    got = {r["account_id"]: r["cluster"] for r in segments.density_clusters(df, ["x", "y"], 0.7, 8, 30).collect()}
    assert [got[i] for i in range(len(points))] == brute_clusters(points, 0.7, 8, 30)


def test_ranking_metrics(spark):
    rng = random.Random(8)
    rows = [("Neo", rng.choice([0.2, 0.5, 0.9, round(rng.random(), 2)]), rng.randrange(2)) for _ in range(300)]
    got = cross_sell.ranking_metrics(spark.createDataFrame(rows, "product string, score double, label int")).first()
    pos, neg = [s for _, s, y in rows if y], [s for _, s, y in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0
    for s in sorted({s for _, s, _ in rows}, reverse=True):
        here = sum(1 for p in pos if p == s)
        tp, fp = sum(p >= s for p in pos), sum(n >= s for n in neg)
        ap += here / len(pos) * tp / (tp + fp)
    assert got["auc_roc"] == pytest.approx(auc, abs=1e-4) and got["avg_precision"] == pytest.approx(ap, abs=1e-4)
    assert got["support"] == len(pos)


def test_winsorise_and_drift(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "v double")
    out = [r[0] for r in guards.winsorise(df, "v", 0.9).collect()]
    assert max(v for v in out if v is not None) == 90.0 and out.count(None) == 1
    scores = spark.range(100).select((F.col("id") / 100).alias("s"))
    assert guards.score_drift(scores, scores, "s").agg(F.sum("stability")).first()[0] == pytest.approx(0.0)


def test_unscored_rows_count_nowhere(spark):
    from accountwise.operators import cross_sell

    rows = [("P", float(i % 10) / 10, i % 2) for i in range(100)]
    unscored = [("P", None, 1), ("P", float("nan"), 0)] * 10
    schema = "product string, score double, label int"
    plain = cross_sell.ranking_metrics(spark.createDataFrame(rows, schema)).collect()
    assert cross_sell.ranking_metrics(spark.createDataFrame(rows + unscored, schema)).collect() == plain
    values = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "v double")
    assert exact_quantiles(values, [], "v", {"m": 0.5}).first()["m"] == 2.0


def test_hot_traveler_is_split(spark):
    """One traveler has a third of the bookings: the adaptive join splits that key, and every row keeps its account."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        n = 60_000
        who = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).cast("long")
        bookings = spark.range(n).repartition(16).select(F.col("id").alias("booking_id"), who.alias("traveler_id"))
        travelers = spark.range(990).select(F.col("id").alias("traveler_id"), (F.col("id") % 50).alias("account_id"))
        got = staging.bookings_with_account(bookings, travelers)
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    want = {}
    for i in range(n):
        t = 7 if i % 3 == 0 else i % 997
        want[i] = (t, t % 50 if t < 990 else None)
    assert len(rows) == n
    assert {r["booking_id"]: (r["traveler_id"], r["account_id"]) for r in rows} == want


@pytest.mark.parametrize("s0, d0, d", [(1.5e6, 1.5e6, 1_000_000), (7e9, 3e4, 200_000), (9000.0, 8000.0, 4097), (55.0, 50.0, 60)])
def test_tied_events_are_summed_without_a_loop(s0, d0, d):
    from accountwise.operators import survival

    want = survival._terms(s0, d0, d, np.arange(d)).sum(1)
    assert survival._tie_sums(s0, d0, d) == pytest.approx(want, rel=1e-9)


def test_cox_counts_tied_events_over_many_tasks(spark):
    """Each task holds another number of a day's accounts; none may be lost where the tasks are put together."""
    df = spark.range(0, 60_000, numPartitions=23).select(
        (F.col("id") * 7919 % 997 % 37 + 1).alias("duration"), (F.col("id") * 31 % 7 < 3).cast("int").alias("event"),
        ((F.col("id") % 11) / 10.0).alias("a"))
    want = {r["duration"]: r["n"] for r in df.where("event = 1").groupBy("duration").agg(F.count(F.lit(1)).alias("n")).collect()}
    terms = survival.cox_terms(df, ("a",), np.array([0.3]), penalty=0.01)
    assert {int(d): int(n) for d, n in zip(terms.days, terms.deaths)} == want


def test_percentile_of_half_a_digit(spark):
    """23 of 80 are 28.75 percent, which a quotient rounded before it is scaled falls short of."""
    actual = spark.range(80).select(F.col("id").cast("double").alias("clv_12m"))
    pred = spark.createDataFrame([(1, 23.0)], "account_id long, predicted_clv double")
    assert clv.clv_percentiles(pred, actual).first()["clv_percentile"] == 28.8


def test_cells_of_more_input_are_dealt_to_more_tasks(spark, params, tmp_path, monkeypatch):
    rows = [(k % 50, f"2022-{1 + k % 12:02d}-03", "EU", k % 7 == 0) for k in range(400)]
    spark.createDataFrame(rows, "account_id long, d string, destination_region string, is_cancelled boolean").selectExpr(
        "account_id", "date(d) booking_date", "date(d) + 5 travel_date", "is_cancelled", "false is_out_of_policy",
        "destination_region", "cast(10 as decimal(10,2)) amount").coalesce(1).write.parquet(str(tmp_path / "b"))
    table = spark.read.parquet(str(tmp_path / "b"))
    plain = bookings.booking_features(table, params).orderBy("account_id").collect()
    monkeypatch.setattr(session, "PART_BYTES", 50)
    fine = bookings.booking_features(table, params)
    size = sum(f.stat().st_size for f in (tmp_path / "b").glob("*.parquet"))
    assert session.dealt_by_size(table, "account_id").rdd.getNumPartitions() == -(-size // 50) > 40
    assert "hashpartitioning(account_id#" in (plan := fine._jdf.queryExecution().toString()) and f", {-(-size // 50)})" in plan
    assert fine.orderBy("account_id").collect() == plain and len(plain) == 50
