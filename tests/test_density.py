"""The density hierarchy against plain loops over all pairs."""

import numpy as np
import pytest

from accountwise.operators import density


def snapped(points, reach, steps):
    return [tuple(int(np.floor(abs(v) * (steps / reach) + 0.5)) * (1 if v >= 0 else -1) for v in p) for p in points]


def brute(points, reach, steps, m, min_size, per_halving=4):
    """(clusters by account, {(level, component): accounts})."""
    at = {}
    for account, p in enumerate(snapped(points, reach, steps)):
        at.setdefault(p, []).append(account)
    ids = {p: min(a) for p, a in at.items()}
    square = lambda p, q: sum((a - b) ** 2 for a, b in zip(p, q))
    core = {}
    for p in at:
        near = sorted((square(p, q), len(a)) for q, a in at.items() if square(p, q) <= steps * steps)
        total = 0
        for d, n in near:
            total += n
            if total >= m:
                core[p] = d
                break
    radii = density.level_radii(steps, per_halving)
    labels, sizes = [], {}
    for level, r in enumerate(radii):
        alive = [p for p in core if core[p] <= r * r]
        label = {p: ids[p] for p in alive}
        moved = True
        while moved:
            moved = False
            for p in alive:
                for q in alive:
                    if max(square(p, q), core[p], core[q]) <= r * r and label[q] < label[p]:
                        label[p], moved = label[q], True
        labels.append(label)
        for p in alive:
            sizes[level, label[p]] = sizes.get((level, label[p]), 0) + len(at[p])
    big = {k for k, n in sizes.items() if n >= min_size}
    by_id = {i: p for p, i in ids.items()}
    parent = {(lv, c): (lv - 1, labels[lv - 1][by_id[c]]) for lv, c in big if lv}
    below = {}
    for k, up in parent.items():
        below.setdefault(up, []).append(k)

    def best(node):
        """Stability of the cluster that begins here, and the best choice in and below it."""
        own, chain = 0.0, node
        while True:
            lv = chain[0]
            own += sizes[chain] * (1 / radii[lv] - 1 / radii[max(0, lv - 1)])
            parts = below.get(chain, [])
            if len(parts) != 1:
                break
            chain = parts[0]
        inner = [best(k) for k in parts]
        total = sum(v for v, _ in inner)
        return (own, [node]) if own >= total else (total, [c for _, x in inner for c in x])

    chosen = [c for k in sorted(big) if k[0] == 0 for c in best(k)[1]]
    chosen.sort(key=lambda c: (-sizes[c], c))
    out = [-1] * len(points)
    for number, (level, c) in enumerate(chosen):
        for p, label in labels[level].items():
            if label == c:
                for account in at[p]:
                    out[account] = number
    return out, sizes


def frame_of(spark, points):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "account_id long, x double, y double")


@pytest.mark.parametrize("seed", [1, 2])
def test_hierarchy(spark, seed):
    rng = np.random.default_rng(seed)
    blobs = [rng.normal(c, s, (n, 2)) for c, s, n in (((0, 0), 0.1, 60), ((0.8, 0), 0.1, 50), ((0.4, 0.5), 0.5, 60), ((6, 6), 0.3, 40))]
    chain = np.column_stack([np.linspace(10, 14, 50), np.full(50, -10.0)])
    points = np.vstack([*blobs, chain, np.full((45, 2), 20.5), rng.uniform(-5, 20, (25, 2))])
    want, sizes = brute(points, 1.0, 16, 6, 25)
    df = frame_of(spark, points).repartition(5)
    got = {r["account_id"]: r["cluster"] for r in density.density_hierarchy(df, ["x", "y"], 1.0, 16, 6, 25).collect()}
    assert [got[i] for i in range(len(points))] == want and len(set(want)) > 3
    _, levels, _ = density.density_levels(df, ["x", "y"], 1.0, 16, 6)
    assert {(r["level"], r["component"]): r["accounts"] for r in density.level_summary(levels).collect()} == sizes


def test_a_crowded_area_costs_its_positions(spark):
    """A cell with most of all accounts: as many rows as it has steps."""
    rng = np.random.default_rng(3)
    points = np.vstack([rng.uniform(0, 0.5, (20_000, 2)), rng.uniform(5, 5.3, (300, 2))])
    df = frame_of(spark, points)
    _, places = density.positions(df, ["x", "y"], 1.0, 16)
    assert places.count() < 150
    got = {r["cluster"]: r["n"] for r in density.density_hierarchy(df, ["x", "y"], 1.0, 16, 20, 100).groupBy("cluster").agg({"*": "count"}).toDF("cluster", "n").collect()}
    assert got == {0: 20_000, 1: 300}


def test_nulls_few_rows_and_none(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, 0.0, 0.0), (3, 0.0, 0.0)], "account_id long, x double, y double")
    assert {r["account_id"]: r["cluster"] for r in density.density_hierarchy(df, ["x", "y"], min_neighbours=2, min_size=2).collect()} == {1: -1, 2: 0, 3: 0}
    assert {r["cluster"] for r in density.density_hierarchy(df, ["x", "y"]).collect()} == {-1}
    assert density.density_hierarchy(df.where("false"), ["x", "y"]).count() == 0


def test_components_have_no_limit_of_rounds(spark):
    rows = [(k, k + 1) for k in range(0, 3000)]
    nodes = spark.range(3001).withColumnRenamed("id", "id")
    links = spark.createDataFrame(rows, "a long, b long")
    assert [r["label"] for r in density.components(nodes, links).select("label").distinct().collect()] == [0]


def test_components_of_long_paths_take_few_rounds(spark, monkeypatch):
    """Shuffled ids along a path: labels once moved a few nodes a round, and the plan doubled with every round."""
    n = 3000
    ids = np.random.default_rng(5).permutation(n).tolist()
    links = spark.createDataFrame([(a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if i != 1200], "a long, b long")
    rounds, write = [], density.written_again

    def counted(df, *label):
        assert len(rounds) < 40, "too many rounds"
        rounds.append(1)
        return write(df, *label)

    monkeypatch.setattr(density, "written_again", counted)
    got = {r["id"]: r["label"] for r in density.components(spark.range(n), links).collect()}
    assert all(got[i] == min(ids[:1201]) for i in ids[:1201]) and all(got[i] == min(ids[1201:]) for i in ids[1201:])
