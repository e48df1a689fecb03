"""Density hierarchy: neighbours within a distance, core distances, spanning forests, clusters chosen by stability.

Coordinates are counted in steps of ``reach / steps``: accounts at one position are one weighted row, so an area of
``reach`` by ``reach`` holds at most ``steps`` squared rows on two axes, however crowded it is, and all distances are exact
integers. Everything then follows from neighbours within ``reach``:

- the core distance of a position is the least radius that holds ``min_neighbours`` accounts, its own included;
- two positions are linked at the largest of their distance and both core distances;
- every cell of the side ``reach`` finds the minimum spanning forest of its positions' links inside its task. Components at any
  distance are the same under all links and under those of the forests, of which there are only a few for each position;
- the components at all levels of distance are found together; a component of ``min_size`` accounts or more is a node of the
  tree. It goes on as the same cluster until it breaks into two or more nodes at a shorter distance;
- the stability of a cluster adds its accounts times the growth of 1 / distance over the levels at which it lives. From the
  leaves up, a cluster is taken if it is at least as stable as the best of its parts together.

Positions without ``min_neighbours`` accounts within ``reach``, and accounts in no taken cluster, are noise (-1). Accounts with
a NULL coordinate are noise.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accountwise.session import cut_lineage, written_again

NOISE = -1


def level_radii(steps: int, per_halving: int = 4) -> list[int]:
    """Radii in steps, from ``steps`` down to 1, about ``per_halving`` to each halving; equal ones once."""
    radii, k = [], 0
    while not radii or radii[-1] > 1:
        r = max(1, round(steps * 2.0 ** (-k / per_halving)))
        if not radii or r < radii[-1]:
            radii.append(r)
        k += 1
    return radii


def positions(points: DataFrame, axes: Sequence[str], reach: float, steps: int) -> tuple[DataFrame, DataFrame]:
    """Accounts with the id of their position, and the positions: id, x_0.., n."""
    grid = [f"x_{i}" for i in range(len(axes))]
    placed = points.where(" and ".join(f"{a} is not null" for a in axes)).select(
        "account_id", *[F.round(F.col(a) * F.lit(steps / reach)).cast("bigint").alias(g) for a, g in zip(axes, grid)])
    counted = placed.groupBy(*grid).agg(F.count(F.lit(1)).alias("n"), F.min("account_id").alias("id"))
    counted = cut_lineage(counted.select("id", *grid, "n"))
    return placed.join(counted.drop("n"), grid).select("account_id", "id"), counted


def _around(places: DataFrame, grid: Sequence[str], steps: int) -> DataFrame:
    """Every position at home in its cell and as a visitor of the cells around it."""
    moves = F.array(*[
        F.struct(*[F.lit(s).alias(f"s{i}") for i, s in enumerate(step)]) for step in product((-1, 0, 1), repeat=len(grid))])
    moved = places.withColumn("move", F.explode(moves))
    home = [F.floor(F.col(g) / F.lit(steps)) for g in grid]
    return moved.select(
        *[(h + F.col(f"move.s{i}")).cast("bigint").alias(f"cell_{i}") for i, h in enumerate(home)],
        *[F.col(c) for c in places.columns],
        F.expr(" and ".join(f"move.s{i} = 0" for i in range(len(grid)))).alias("own"),
    )


def core_distances(places: DataFrame, grid: Sequence[str], steps: int, min_neighbours: int) -> DataFrame:
    """Positions with ``core``, the square of the core distance; those beyond the reach are left out."""
    names = list(grid)

    def within(frame: pd.DataFrame) -> pd.DataFrame:
        own = np.flatnonzero(frame["own"].to_numpy(bool))
        x, n = frame[names].to_numpy(np.int64), frame["n"].to_numpy(np.int64)
        core = np.full(len(own), -1, np.int64)
        for k, at in enumerate(own):
            square = ((x - x[at]) ** 2).sum(1)
            near = np.flatnonzero(square <= steps * steps)
            order = near[np.argsort(square[near], kind="stable")]
            enough = np.searchsorted(np.cumsum(n[order]), min_neighbours)
            if enough < len(order):
                core[k] = square[order[enough]]
        return pd.DataFrame({"id": frame["id"].to_numpy()[own], "core": core}).query("core >= 0")

    cells = [f"cell_{i}" for i in range(len(names))]
    found = _around(places, names, steps).groupBy(*cells).applyInPandas(within, "id long, core long")
    return places.join(found, "id")


def forest_links(cores: DataFrame, grid: Sequence[str], steps: int) -> DataFrame:
    """Links (a, b, square) of the minimum spanning forests of all cells."""
    names = list(grid)
    far = np.iinfo(np.int64).max

    def grown(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame["own"].to_numpy(bool)
        x, core, ids = frame[names].to_numpy(np.int64), frame["core"].to_numpy(np.int64), frame["id"].to_numpy()
        best, source = np.full(len(frame), far), np.full(len(frame), -1)
        waiting, out = np.ones(len(frame), bool), []
        for start in np.flatnonzero(own):
            if not waiting[start]:
                continue
            at = start
            while True:
                waiting[at] = False
                if source[at] >= 0:
                    a, b = sorted((int(ids[source[at]]), int(ids[at])))
                    out.append((a, b, int(best[at])))
                square = np.maximum(((x - x[at]) ** 2).sum(1), np.maximum(core, core[at]))
                nearer = waiting & (square <= steps * steps) & (square < best)
                if not own[at]:  # two visitors meet in a cell of their own
                    nearer &= own
                best[nearer], source[nearer] = square[nearer], at
                left = np.where(waiting, best, far)
                at = int(left.argmin())
                if left[at] == far:
                    break
        return pd.DataFrame(out, columns=["a", "b", "square"]).astype("int64")

    cells = [f"cell_{i}" for i in range(len(names))]
    links = _around(cores.select("id", *names, "core"), names, steps).groupBy(*cells).applyInPandas(
        grown, "a long, b long, square long")
    return links.groupBy("a", "b").agg(F.min("square").alias("square"))


def components(nodes: DataFrame, links: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Nodes (within, id) with ``label``, the least id that can be reached over links (within, a, b).

    In every round a node takes the least label among its neighbours, the node it is named after takes the least of what those
    named after it found, and every label is replaced by that label's own; it ends when nothing changes. Whole parts are thus
    joined at once, and the number of rounds follows the logarithm of a path's length.
    """
    keys = list(within)
    both = written_again(links.select(*keys, "a", "b").union(links.select(*keys, F.col("b"), F.col("a"))))
    labels = written_again(nodes.select(*keys, "id", F.col("id").alias("label")))
    while True:
        seen = both.join(labels.withColumnRenamed("id", "b"), [*keys, "b"]).groupBy(*keys, "a").agg(F.min("label").alias("near"))
        found = written_again(labels.join(seen.withColumnRenamed("a", "id"), [*keys, "id"], "left").select(
            *keys, "id", "label", F.least("label", F.coalesce("near", "label")).alias("next")))
        lower = found.where("next < label").groupBy(*keys, F.col("label").alias("id")).agg(F.min("next").alias("told"))
        lowered = found.join(lower, [*keys, "id"], "left").select(
            *keys, "id", "label", F.least("next", F.coalesce("told", "next")).alias("next"))
        roots = lowered.select(*keys, F.col("id").alias("next"), F.col("next").alias("jump"))
        stepped = written_again(lowered.join(roots, [*keys, "next"]).select(
            *keys, "id", F.col("jump").alias("label"), (F.col("jump") != F.col("label")).alias("moved")))
        labels = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            return labels


def density_levels(
    points: DataFrame, axes: Sequence[str], reach: float = 1.0, steps: int = 32, min_neighbours: int = 20,
    per_halving: int = 4,
) -> tuple[DataFrame, DataFrame, list[int]]:
    """Accounts with their position (account_id, id), positions with their component at every level at which they are core
    (level, id, n, label), and the radii of the levels in steps. Level 0 is the reach."""
    grid = [f"x_{i}" for i in range(len(axes))]
    placed, places = positions(points, axes, reach, steps)
    cores = cut_lineage(core_distances(places, grid, steps, min_neighbours))
    links = forest_links(cores, grid, steps)
    radii = level_radii(steps, per_halving)
    at_levels = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.lit(r * r).alias("most")) for k, r in enumerate(radii)]))

    def levelled(rows: DataFrame, square: str) -> DataFrame:
        wide = rows.withColumn("at", at_levels).where(F.col(square) <= F.col("at.most"))
        return wide.select(F.col("at.level").alias("level"), *[F.col(c) for c in rows.columns])

    nodes = levelled(cores.select("id", "n", "core"), "core")
    labels = components(nodes, levelled(links, "square"), ["level"])
    return placed, labels.join(cores.select("id", "n"), "id").select("level", "id", "n", "label"), radii


def level_summary(levels: DataFrame) -> DataFrame:
    """Components of every level: level, component (its least position id), positions and accounts."""
    return levels.groupBy("level", F.col("label").alias("component")).agg(
        F.count(F.lit(1)).alias("positions"), F.sum("n").alias("accounts"))


def condensed_tree(levels: DataFrame, radii: Sequence[int], min_size: int) -> DataFrame:
    """Clusters: level and label of their first component, their parent's, size at first, and stability."""
    sizes = levels.groupBy("level", "label").agg(F.sum("n").alias("size")).where(F.col("size") >= min_size)
    above = levels.select((F.col("level") + 1).alias("level"), F.col("id").alias("label"), F.col("label").alias("parent"))
    nodes = sizes.join(above, ["level", "label"], "left")
    siblings = nodes.where("level > 0").groupBy("level", "parent").agg(F.count(F.lit(1)).alias("parts"))
    nodes = written_again(nodes.join(siblings, ["level", "parent"], "left").select(
        "level", "label", "parent", "size", ((F.col("level") == 0) | (F.col("parts") > 1)).alias("born")))
    # every node points to the first component of its cluster; pointers double their length in each round
    up = written_again(nodes.select(
        "level", "label", F.when(F.col("born"), F.col("level")).otherwise(F.col("level") - 1).alias("to_level"),
        F.when(F.col("born"), F.col("label")).otherwise(F.col("parent")).alias("to_label")))
    for _ in range(max(1, len(radii)).bit_length()):
        next_up = up.select(*[F.col(c).alias(f"n_{c}") for c in up.columns])
        up = written_again(up.join(next_up, (F.col("to_level") == F.col("n_level")) & (F.col("to_label") == F.col("n_label"))).select(
            "level", "label", F.col("n_to_level").alias("to_level"), F.col("n_to_label").alias("to_label")))
    density = [1.0 / r for r in radii]
    gain = F.element_at(F.array(*[F.lit(density[k] - density[max(0, k - 1)]) for k in range(len(radii))]), F.col("level") + 1)
    clusters = up.join(nodes, ["level", "label"]).groupBy(
        F.col("to_level").alias("first"), F.col("to_label").alias("label")).agg(
        F.sum(F.col("size") * gain).alias("stability"), F.max(F.when(F.col("level") == F.col("to_level"), F.col("size"))).alias("size"))
    parents = nodes.where("born and level > 0").select(
        F.col("level").alias("first"), "label", (F.col("level") - 1).alias("p_level"), F.col("parent").alias("p_label")
    ).join(up.select(F.col("level").alias("p_level"), F.col("label").alias("p_label"), F.col("to_level").alias("parent_first"),
                     F.col("to_label").alias("parent_label")), ["p_level", "p_label"])
    return clusters.join(parents.drop("p_level", "p_label"), ["first", "label"], "left")


def most_stable(tree: DataFrame) -> DataFrame:
    """The clusters (first, label, size) of the best choice: none within another, the sum of stabilities largest."""
    tree = written_again(tree)
    births = sorted(r["first"] for r in tree.select("first").distinct().collect())  # levels: a few dozen
    done = None
    for first in reversed(births):
        own = tree.where(F.col("first") == first)
        if done is None:
            valued = own.withColumn("parts", F.lit(0.0))
        else:
            parts = done.groupBy(F.col("parent_first").alias("first"), F.col("parent_label").alias("label")).agg(F.sum("value").alias("parts"))
            valued = own.join(parts, ["first", "label"], "left").withColumn("parts", F.coalesce("parts", F.lit(0.0)))
        valued = valued.select(
            "first", "label", "size", "parent_first", "parent_label", (F.col("stability") >= F.col("parts")).alias("taken"),
            F.greatest("stability", "parts").alias("value"))
        done = written_again(valued if done is None else done.unionByName(valued))
    if done is None:
        return tree.select("first", "label", "size")
    settled = None
    for first in births:
        own = done.where(F.col("first") == first)
        if settled is None:
            judged = own.withColumn("within", F.lit(False))
        else:
            above = settled.select(
                F.col("first").alias("parent_first"), F.col("label").alias("parent_label"), (F.col("taken") | F.col("within")).alias("inside"))
            judged = own.join(above, ["parent_first", "parent_label"], "left").withColumn(
                "within", F.coalesce("inside", F.lit(False))).drop("inside")
        judged = judged.select("first", "label", "size", "taken", "within")
        settled = written_again(judged if settled is None else settled.unionByName(judged))
    return settled.where("taken and not within").select("first", "label", "size")


def density_hierarchy(
    points: DataFrame, axes: Sequence[str], reach: float = 1.0, steps: int = 32, min_neighbours: int = 20, min_size: int = 100,
    per_halving: int = 4,
) -> DataFrame:
    """account_id and cluster: the most stable clusters, numbered by size from 0; noise is -1."""
    placed, levels, radii = density_levels(points, axes, reach, steps, min_neighbours, per_halving)
    levels = written_again(levels)
    chosen = most_stable(condensed_tree(levels, radii, min_size))
    # one row for each cluster of at least min_size accounts
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("size"), "first", "label")
    numbered = chosen.withColumn("cluster", (F.row_number().over(order) - 1).cast("int")).select(
        F.col("first").alias("level"), "label", "cluster")
    members = levels.join(numbered, ["level", "label"]).select("id", "cluster")
    found = placed.join(members, "id", "left").select("account_id", "cluster")
    return points.select("account_id").join(found, "account_id", "left").select(
        "account_id", F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))
