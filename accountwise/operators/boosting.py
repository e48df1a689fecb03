"""Boosted classifiers over the same rows, grown together: the trees of MLlib's ``GBTClassifier`` without a Spark job for each of their levels.

MLlib runs two stages for every level of every tree: twelve thousand for four products and 300 rounds, whose start costs more than
their rows. Here the rows are binned once by MLlib's own thresholds and stored as blocks of bytes. Up to ``ROWS_AT_ONCE`` rows, one
task a product grows all its trees over its blocks. Beyond, the blocks stay where they are, and one job a level counts for all products.

Bags, input subsets, splits and stopping rules are MLlib's, and so is the order of the sums in one block, which gives its trees to the last
digit. Over more blocks MLlib adds sums as they arrive; there inputs are counted together and one side of a split is taken from the
other. Memory: a byte per row, input and product and two per group of inputs, and per block the sums of one level's nodes.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from decimal import Decimal, localcontext
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwise.session import run_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: Rows up to which a product's trees are grown in one task.
ROWS_AT_ONCE = 5_000_000
#: Joint bins of inputs that are counted together.
JOINT_BINS = 2048
#: Rounds between two checkpoints of the predictions, where rows stay in their blocks.
KEPT_ROUNDS = 10
#: Spark's tables of a saved ensemble, and the release whose layout they have.
LAYOUT = "4.1.2"
NODE = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
    "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)
LEAST, EPSILON = -np.finfo(float).max, np.finfo(float).eps
_MASK, _MASK32 = (1 << 64) - 1, (1 << 32) - 1


# --- Spark's random numbers ------------------------------------------------------------
def _hashed(seed: int) -> int:
    """The state that ``XORShiftRandom`` starts with."""
    def murmur(h: int) -> int:
        data = (seed & _MASK).to_bytes(8, "big")
        for i in (0, 4):
            k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & _MASK32
            k = ((k << 15 | k >> 17) & _MASK32) * 0x1B873593 & _MASK32
            h ^= k
            h = ((h << 13 | h >> 19) & _MASK32) * 5 + 0xE6546B64 & _MASK32
        h ^= 8
        h = (h ^ h >> 16) * 0x85EBCA6B & _MASK32
        h = (h ^ h >> 13) * 0xC2B2AE35 & _MASK32
        return h ^ h >> 16

    low = murmur(0x3C074A61)
    return murmur(low) << 32 | low


def _step(s):
    """The next state, of one or of an array of them."""
    if isinstance(s, int):
        s ^= s << 21 & _MASK
        s ^= s >> 35
        return (s ^ s << 4) & _MASK
    s = s ^ s << np.uint64(21)
    s ^= s >> np.uint64(35)
    return s ^ s << np.uint64(4)


def _jumped(columns: np.ndarray, s: np.ndarray) -> np.ndarray:
    """A jump of every state; it is linear, and given by what becomes of each of the 64 bits."""
    bits = s >> np.arange(64, dtype=np.uint64)[:, None] & np.uint64(1)
    return np.bitwise_xor.reduce(bits * columns[:, None], axis=0)


class Bag:
    """The rows of a block that a round draws: n numbers of ``XORShiftRandom(seed + block + 1).nextDouble()`` below the share.

    The sequence is cut into runs that are stepped side by side; the jumps from run to run are the same in every round.
    """

    def __init__(self, part: int, n: int, share: float):
        self.part, self.n, self.share = part, n, share
        self.lanes = 1 << (2 * n).bit_length() // 2
        self.steps, self.jumps = -(-2 * n // self.lanes), []
        jump = np.uint64(1) << np.arange(64, dtype=np.uint64)
        for digit in f"{self.steps:b}":
            jump = _jumped(jump, jump)
            jump = _step(jump) if digit == "1" else jump
        for _ in range(self.lanes.bit_length() - 1):
            self.jumps.append(jump)
            jump = _jumped(jump, jump)

    def uniforms(self, seed: int) -> np.ndarray:
        lane = np.array([_hashed(seed)], dtype=np.uint64)
        for jump in self.jumps:
            lane = np.concatenate([lane, _jumped(jump, lane)])
        states = np.empty((self.steps, self.lanes), dtype=np.uint64)
        for k in range(self.steps):
            lane = states[k] = _step(lane)
        two = states.T.reshape(-1)[:2 * self.n].reshape(self.n, 2)
        high, low = two[:, 0] & np.uint64((1 << 26) - 1), two[:, 1] & np.uint64((1 << 27) - 1)
        return ((high << np.uint64(27)) + low).astype(float) * 2.0**-53

    def rows(self, seed: int) -> np.ndarray:
        return np.flatnonzero(self.uniforms(seed + self.part + 1) < self.share) if self.share < 1 else np.arange(self.n)


class _Longs:
    """``java.util.Random(seed).nextLong()``."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next(self) -> int:
        self.state = self.state * 0x5DEECE66D + 0xB & (1 << 48) - 1
        top = self.state >> 16
        return top - (1 << 32) if top >> 31 else top

    def draw(self) -> int:
        return (self._next() << 32) + self._next() & _MASK


def _subset(inputs: int, k: int, seed: int) -> np.ndarray:
    """The inputs that a node may split by: a reservoir sample, in its order."""
    kept, state = list(range(k)), _hashed(seed)
    for i in range(k, inputs):
        high = _step(state)
        state = _step(high)
        at = int((((high & (1 << 26) - 1) << 27) + (state & (1 << 27) - 1)) * 2.0**-53 * (i + 1))
        if at < k:
            kept[at] = i
    return np.array(kept)


# --- Java's exponential ----------------------------------------------------------------
# Math.exp of a JVM on x86: 2^(j/64), cut to a double, times a polynomial of the rest. numpy's differs in the last digit of one in 400 values,
# which decides between splits of the same rows.
def _double(bits: int) -> float:
    return float(np.array(bits, dtype=np.uint64).view(float))


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """2^(j/64), cut, and what was cut off in proportion."""
    with localcontext() as exact:
        exact.prec = 60
        roots = [Decimal(2) ** (Decimal(j) / 64) for j in range(64)]
        cut = [float(r) if Decimal(float(r)) <= r else float(np.nextafter(float(r), 0)) for r in roots]
        return np.array(cut), np.array([float((r - Decimal(c)) / Decimal(c)) for r, c in zip(roots, cut)])


_POWER, _REST = _powers()
_PER_LOG, _LOG, _LOG_REST, _HALF, _THIRD, _FOURTH, _FIFTH, _SIXTH = map(_double, (
    0x40571547652B82FE, 0x3F862E42FEFA0000, 0x3D1CF79ABC9E3B3A, 0x3FDFFFFFFFFFFFFE,
    0x3FC5555555548BA1, 0x3FA55555555B9E25, 0x3F811115C090CF0F, 0x3F56C15CE3289860))


def java_exp(x: np.ndarray) -> np.ndarray:
    inside = np.clip(x, -700, 700)
    m = np.rint(inside * _PER_LOG)
    r = inside - m * _LOG - m * _LOG_REST
    at = m.astype(np.int64)
    power = _POWER[at & 63]
    r2 = r * r
    r3 = r * r2
    p = r3 * (_THIRD + _FOURTH * r) + ((r + _REST[at & 63]) + r3 * r2 * (_FIFTH + _SIXTH * r)) + r2 * _HALF
    with np.errstate(over="ignore", under="ignore"):
        return np.where(inside == x, np.ldexp(p * power + power, at >> 6), np.exp(x))


# --- growing one tree ------------------------------------------------------------------
@dataclass
class Plan:
    """What a fit has in common over its rounds."""

    thresholds: list[list[float]]
    subset: int
    rounds: int
    depth: int
    step: float
    share: float
    weight: float
    seed: int
    ordered: bool  # one block: rows are added in their order, as MLlib does

    @property
    def groups(self) -> list[list[int]]:
        """The inputs that have splits, counted together as far as their joint bins are few, else alone."""
        bins = {f: len(t) + 1 for f, t in enumerate(self.thresholds) if t}
        if self.ordered:
            return [[f] for f in bins]
        groups: list = []
        for f in sorted(bins, key=lambda f: -bins[f]):
            fits = next((g for g in groups if np.prod([bins[m] for m in [*g, f]]) <= JOINT_BINS), None)
            fits.append(f) if fits else groups.append([f])
        return groups

    @property
    def width(self) -> int:
        return max(1, *(len(t) + 1 for t in self.thresholds))

    def learner_weight(self, k: int) -> float:
        return self.step if k else 1.0


@dataclass
class Tree:
    """A tree in heap order, the root at 1: the input and the last bin of the left side (input -1: a leaf), and what is known of a node."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    stats: dict[int, tuple] = field(default_factory=dict)  # weight, sum, sum of squares
    impurity: dict[int, float] = field(default_factory=dict)
    gain: dict[int, float] = field(default_factory=dict)

    def __post_init__(self):
        self.feature, self.cut = np.full(2 << self.depth, -1), np.zeros(2 << self.depth, dtype=np.int64)

    @classmethod
    def known(cls, depth: int, **kept) -> Tree:
        tree = cls(depth)
        vars(tree).update(kept)
        return tree

    def prediction(self, node: int) -> float:
        weight, total, _ = self.stats[node]
        return total / weight if weight else 0.0

    def below(self, at: np.ndarray, bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The nodes of the rows one level down, where there is one."""
        by = self.feature[at]
        value = bins.reshape(-1).take(by * bins.shape[1] + rows, mode="clip")
        return np.where(by < 0, at, 2 * at + (value > self.cut[at]))

    def places(self, bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The node at which each row ends."""
        at, deepest = np.ones(len(rows), dtype=np.int64), int(np.flatnonzero(self.feature >= 0).max(initial=0))
        for _ in range(deepest.bit_length()):
            at = self.below(at, bins, rows)
        return at

    def outputs(self, bins: np.ndarray) -> np.ndarray:
        values = np.zeros(2 << self.depth)
        for node in self.stats:
            values[node] = self.prediction(node)
        return values[self.places(bins, np.arange(bins.shape[1]))]


def _variance(weight, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(weight == 0, 0.0, (squares - total * total / weight) / weight)


def joint_codes(bins: np.ndarray, plan: Plan) -> list[tuple]:
    """By group: its inputs, their numbers of bins, and the joint bin of every row."""
    found = []
    for group in plan.groups:
        shape = [len(plan.thresholds[f]) + 1 for f in group]
        code = bins[group[0]]
        for f, n in zip(group[1:], shape[1:]):
            code = code.astype(np.uint16) * np.uint16(n) + bins[f]
        found.append((group, shape, code))
    return found


def node_sums(codes: Sequence[tuple], place: np.ndarray, y: np.ndarray, weight: np.ndarray, rows: np.ndarray, nodes: Sequence[int], plan: Plan) -> np.ndarray:
    """Per input, sum (weight, weighted label, weighted square), node and bin: the rows added in their order. ``place`` is the rows' node."""
    slots = np.full(2 << plan.depth, -1)
    slots[list(nodes)] = np.arange(len(nodes))
    slot = slots[place]
    inside = np.flatnonzero(slot >= 0)
    rows, slot = rows[inside], slot[inside]
    w = weight[rows]
    wy = w * y[rows]
    weights = (w, wy, wy * y[rows])
    out = np.zeros((len(plan.thresholds), 3, len(nodes), plan.width))
    for group, shape, code in codes:
        size = int(np.prod(shape))
        at = slot * size
        at += code[rows]
        for k, v in enumerate(weights):
            counted = np.bincount(at, v, len(nodes) * size).reshape(len(nodes), *shape)
            for axis, f in enumerate(group):
                out[f, k, :, :shape[axis]] = counted.sum(axis=tuple(i + 1 for i in range(len(group)) if i != axis)) if len(group) > 1 else counted
    return out


def split_node(tree: Tree, node: int, sums: np.ndarray, inputs: np.ndarray, splits: np.ndarray) -> tuple[bool, bool]:
    """Chooses the node's split from the sums of its inputs' bins. Returns whether the left and the right side can be split again."""
    known = np.cumsum(sums[inputs], axis=2)  # input, sum, bin
    total = known[:, :, -1:]
    left = known[:, :, :-1]
    right = total - left
    allowed = np.arange(left.shape[2]) < splits[inputs][:, None]
    if node not in tree.stats:  # MLlib adds up the sides of the first split
        first = np.flatnonzero(allowed.any(axis=1))
        tree.stats[node] = tuple(left[first[0], :, 0] + right[first[0], :, 0]) if len(first) else tuple(total[0, :, 0])
        tree.impurity[node] = float(_variance(*tree.stats[node]))
    best = LEAST
    if allowed.any():
        of_left, of_right = _variance(*left.transpose(1, 0, 2)), _variance(*right.transpose(1, 0, 2))
        both = left[:, 0] + right[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = tree.impurity[node] - left[:, 0] / both * of_left - right[:, 0] / both * of_right
        allowed &= (left[:, 0] > 0) & (right[:, 0] > 0) & (gains >= 0)
        gains = np.where(allowed, gains, LEAST)
        i, cut = np.unravel_index(gains.argmax(), gains.shape)
        best = float(gains[i, cut])
    if best <= 0:
        if best == LEAST:
            tree.impurity[node] = -1.0
        return False, False
    tree.feature[node], tree.cut[node], tree.gain[node] = inputs[i], cut, best
    again = []
    for child, side, impurity in ((2 * node, left, of_left), (2 * node + 1, right, of_right)):
        tree.stats[child], tree.impurity[child] = tuple(side[i, :, cut]), float(impurity[i, cut])
        again.append(child < 1 << tree.depth and abs(tree.impurity[child]) >= EPSILON)
    return tuple(again)


class Grower:
    """The trees of one product, level by level. ``wanted`` names the nodes to count; ``told`` takes their sums.

    Of two sides of a split only the lighter is counted, unless rows are added in order: the other is what is left of their parent.
    """

    def __init__(self, plan: Plan):
        self.plan, self.trees, self.splits = plan, [], np.array([len(t) for t in plan.thresholds])
        self.tree, self.asked, self.parents = None, [], {}

    def begin(self, k: int) -> None:
        self.tree, self.asked, self.longs = Tree(self.plan.depth), [1], _Longs(self.plan.seed + k)

    @property
    def wanted(self) -> list[int]:
        def light(node: int) -> tuple:
            return self.tree.stats[node][0], node

        return [n for n in self.asked if self.plan.ordered or n ^ 1 not in self.asked or light(n) < light(n ^ 1)]

    def told(self, sums: np.ndarray) -> None:
        if not self.plan.ordered:
            at = {node: i for i, node in enumerate(self.wanted)}
            sums = np.stack([sums[:, :, at[n]] if n in at else self.parents[n >> 1] - sums[:, :, at[n ^ 1]] for n in self.asked], axis=2)
            self.parents = {n: sums[:, :, i] for i, n in enumerate(self.asked)}
        n, queued = len(self.splits), []
        every = np.arange(n)
        subsets = [every if self.plan.subset == n else _subset(n, self.plan.subset, self.longs.draw()) for _ in self.asked]
        for slot, (node, inputs) in enumerate(zip(self.asked, subsets)):
            queued += [2 * node + side for side, again in enumerate(split_node(self.tree, node, sums[:, :, slot], inputs, self.splits)) if again]
        self.asked = queued[::-1]  # a stack
        if not self.asked:
            self.trees.append(self.tree)


def _pulls(y: np.ndarray, predicted: np.ndarray | None) -> np.ndarray:
    """What a round's tree is fitted to: the labels, then the negative gradient of the logistic loss."""
    return y if predicted is None else 4.0 * y / (1.0 + java_exp(2.0 * y * predicted))


# --- blocks of rows --------------------------------------------------------------------
def _blocks(assembled: DataFrame, flags: Sequence[str], plans: Sequence[Plan]) -> DataFrame:
    """One row per partition and product: the labels and the bins of all its rows, input by input, in their order."""
    thresholds = [[np.array(t) for t in plan.thresholds] for plan in plans]
    names = list(flags)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, bins = [[] for _ in names], [[] for _ in names]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for k, cuts in enumerate(thresholds):
                labels[k].append(batch.column(k + 1).to_numpy(zero_copy_only=False).astype(np.int8))
                bins[k].append(np.stack([np.searchsorted(t, x[:, f]) for f, t in enumerate(cuts)]).astype(np.uint8))
        part = TaskContext.get().partitionId()
        if not bins[0]:
            return
        for k in range(len(names)):  # one at a time, as a block can be large
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "product": pa.array([k], pa.int32()),
                "labels": pa.array([np.concatenate(labels[k]).tobytes()], pa.binary()),
                "bins": pa.array([np.concatenate(bins[k], axis=1).tobytes()], pa.binary()),
            })
            labels[k] = bins[k] = None

    rows = assembled.select(vector_to_array("_inputs").alias("x"), *names)
    return rows.mapInArrow(packed, "part int, product int, labels binary, bins binary")


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins by input, labels of -1 and 1, and whether a label is positive."""
    flags = np.frombuffer(row["labels"], dtype=np.int8)
    return np.frombuffer(row["bins"], dtype=np.uint8).reshape(-1, len(flags)), flags * 2.0 - 1, flags == 1


def grown_at_once(blocks: Sequence, plan: Plan) -> list[Tree]:
    """All rounds over the blocks of one product, inside a task."""
    blocks = sorted(blocks, key=lambda r: r["part"])
    parts = [_unpacked(row) for row in blocks]
    bags = [Bag(row["part"], len(row["labels"]), plan.share) for row in blocks]
    starts = np.cumsum([0, *(bag.n for bag in bags)])
    bins, y = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts])
    weight = np.where(np.concatenate([p[2] for p in parts]), plan.weight, 1.0)
    codes, predicted, grower = joint_codes(bins, plan), None, Grower(plan)
    for k in range(plan.rounds):
        pulls = _pulls(y, predicted)
        rows = np.concatenate([start + bag.rows(plan.seed + k) for start, bag in zip(starts, bags)])
        place = np.ones(len(rows), dtype=np.int64)
        grower.begin(k)
        while grower.asked:
            grower.told(node_sums(codes, place, pulls, weight, rows, grower.wanted, plan))
            place = grower.tree.below(place, bins, rows)
        added = grower.trees[k].outputs(bins) * plan.learner_weight(k)
        predicted = added if predicted is None else predicted + added
    return grower.trees


def grown_in_place(blocks: DataFrame, plans: Sequence[Plan]) -> list[list[Tree]]:
    """All rounds over blocks that stay in their partitions: a job a level counts for all products, and its sums go to the driver.

    A round's first job also adds the last trees to the predictions, which are stored from round to round.
    """
    sc, one = blocks.sparkSession.sparkContext, BatchedSerializer(CPickleSerializer(), 1)  # zipped as they are stored

    def stored(rdd):
        return rdd._reserialize(one).persist(StorageLevel.MEMORY_AND_DISK)

    data = stored(blocks.rdd.mapPartitions(lambda rows: [[(r["part"], bytes(r["labels"]), bytes(r["bins"])) for r in sorted(rows, key=lambda r: r["product"])]]))
    state, growers, outdated = stored(data.map(lambda _: None)), [Grower(p) for p in plans], []

    def counted(pair, k: int, asked: list) -> list:
        held, predicted = pair
        if not held:
            return []
        found, rows = [], Bag(held[0][0], len(held[0][1]), plans[0].share).rows(plans[0].seed + k)
        for i, (plan, row) in enumerate(zip(plans, held)):
            if asked[i] is None:
                found.append(None)
                continue
            bins, y, positive = _unpacked({"labels": row[1], "bins": row[2]})
            weight = np.where(positive, plan.weight, 1.0)
            tree, nodes = asked[i]
            place = tree.places(bins, rows)
            found.append(node_sums(joint_codes(bins, plan), place, _pulls(y, predicted and predicted[i]), weight, rows, nodes, plan))
        return [(held[0][0], found)]

    def added(pair, k: int, trees: list):
        held, predicted = pair
        more = [t.outputs(_unpacked({"labels": r[1], "bins": r[2]})[0]) * p.learner_weight(k) for t, r, p in zip(trees, held, plans)]
        return more if predicted is None else [a + b for a, b in zip(predicted, more)]

    for k in range(plans[0].rounds):
        before = state
        if k:
            last = [g.trees[-1] for g in growers]
            state = stored(data.zip(before).map(lambda pair, k=k - 1, trees=last: added(pair, k, trees)))
            if k % KEPT_ROUNDS == 0:
                state.checkpoint()
        for g in growers:
            g.begin(k)
        while any(g.asked for g in growers):
            asked = [(g.tree, g.wanted) if g.asked else None for g in growers]
            told = sorted(data.zip(state).flatMap(lambda pair, k=k, asked=asked: counted(pair, k, asked)).collect(), key=lambda t: t[0])
            for i, g in enumerate(growers):
                if g.asked:
                    sums = told[0][1][i]
                    for _, other in told[1:]:
                        sums = sums + other[i]
                    g.told(sums)
            if before is not state:
                before.unpersist()
                before = state
        if state.isCheckpointed():
            outdated.append(state.getCheckpointFile())
            for old in outdated[:-1]:
                path = sc._jvm.org.apache.hadoop.fs.Path(old)
                path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
            outdated = outdated[-1:]
    state.unpersist()
    data.unpersist()
    return [g.trees for g in growers]


# --- to and from MLlib -----------------------------------------------------------------
def _plan(learner: GBTClassifier, rows: DataFrame, weight: float, ordered: bool) -> Plan:
    """MLlib's own checks of the rows, its thresholds and how many inputs a node may split by."""
    jvm = rows.sparkSession.sparkContext._jvm

    def scala(name: str):
        return jvm.java.lang.Class.forName(f"{name}$").getField("MODULE$").get(None)

    learner._transfer_params_to_java()
    strategy = learner._java_obj.getOldBoostingStrategy(
        scala("scala.collection.immutable.Map").empty(), scala("org.apache.spark.mllib.tree.configuration.Algo").Classification()).treeStrategy()
    getattr(strategy, "algo_$eq")(scala("org.apache.spark.mllib.tree.configuration.Algo").Regression())
    instances = scala("org.apache.spark.ml.util.DatasetUtils").extractInstances(learner._java_obj, rows._jdf, jvm.scala.Some(2))
    metadata = jvm.org.apache.spark.ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, learner.getFeatureSubsetStrategy())
    found = scala("org.apache.spark.ml.tree.impl.RandomForest").findSplits(instances, metadata, learner.getSeed())
    return Plan(
        [[split.threshold() for split in of] for of in found], metadata.numFeaturesPerNode(), learner.getMaxIter(), learner.getMaxDepth(),
        learner.getStepSize(), learner.getSubsamplingRate(), weight, learner.getSeed(), ordered)


def _nodes(tree: Tree, thresholds: Sequence[Sequence[float]]) -> list[tuple]:
    """The nodes in preorder; two leaves with the same prediction become one, as in MLlib."""
    leaf: dict[int, float] = {}

    def settle(node: int) -> None:
        if tree.feature[node] < 0:
            leaf[node] = tree.prediction(node)
            return
        settle(2 * node)
        settle(2 * node + 1)
        if {2 * node, 2 * node + 1} <= leaf.keys() and leaf[2 * node] == leaf[2 * node + 1]:
            leaf[node] = leaf[2 * node]

    rows: list = []

    def add(node: int) -> int:
        at, stats = len(rows), [float(s) for s in tree.stats[node]]
        rows.append(None)
        known = (at, tree.prediction(node) if node not in leaf else leaf[node], tree.impurity[node], stats, -1)
        if node in leaf:
            rows[at] = (*known, -1.0, -1, -1, (-1, [], -1))
        else:
            f = int(tree.feature[node])
            rows[at] = (*known, tree.gain[node], add(2 * node), add(2 * node + 1), (f, [thresholds[f][tree.cut[node]]], -1))
        return at

    settle(1)
    add(1)
    return [tuple(float(v) if isinstance(v, np.floating) else v for v in row) for row in rows]


def _model(learner: GBTClassifier, plan: Plan, trees: Sequence[Tree], rows: DataFrame) -> GBTClassificationModel:
    """The trees as MLlib's model: written in the layout of a saved one and loaded."""
    spark, path = rows.sparkSession, run_dir(rows.sparkSession, "boosted")
    given, default = ({p.name: v for p, v in kept.items()} for kept in (learner._paramMap, learner._defaultParamMap))

    def described(kind: str, uid: str, some: Sequence[str] | None = None, **more) -> str:
        return json.dumps({
            "class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": LAYOUT, "uid": uid,
            "paramMap": {k: v for k, v in given.items() if some is None or k in some},
            "defaultParamMap": {k: v for k, v in default.items() if some is None or k in some}, **more})

    of_tree = ("featuresCol", "labelCol", "weightCol", "predictionCol", "maxDepth", "maxBins", "seed")
    whole = described("classification.GBTClassificationModel", learner.uid, numFeatures=len(plan.thresholds), numTrees=len(trees))
    heads = [(k, described("regression.DecisionTreeRegressionModel", f"{learner.uid}_{k}", of_tree), plan.learner_weight(k)) for k in range(len(trees))]
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(k, row) for k, tree in enumerate(trees) for row in _nodes(tree, plan.thresholds)], NODE, verifySchema=False).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def fit_together(assembled: DataFrame, learners: dict[str, GBTClassifier], weight: float) -> list[GBTClassificationModel]:
    """One model for each flag, in their order; rows with the flag have the weight, others 1.

    ``assembled`` is stored: the vectors under the learners' ``featuresCol`` and the flags. The learners name their flag as label and
    ``_weight`` as weight, and differ in nothing else.
    """
    ordered = assembled.rdd.getNumPartitions() == 1

    def planned(flag: str) -> Plan:
        return _plan(learners[flag], assembled.withColumn("_weight", F.when(F.col(flag) == 1, weight).otherwise(1.0)), weight, ordered)

    with ThreadPool(len(learners)) as pool:
        plans = pool.map(planned, learners)
    blocks = _blocks(assembled, list(learners), plans)
    if assembled.count() <= ROWS_AT_ONCE:
        dealt = blocks.rdd.map(lambda row: (row["product"], row)).groupByKey(len(plans), partitionFunc=int)
        grown = dict(dealt.map(lambda kv: (kv[0], [vars(t) for t in grown_at_once(list(kv[1]), plans[kv[0]])])).collect())
        trees = [[Tree.known(**kept) for kept in grown[k]] for k in range(len(plans))]
    else:
        trees = grown_in_place(blocks, plans)
    with ThreadPool(len(learners)) as pool:
        return pool.starmap(lambda *of: _model(*of, assembled), zip(learners.values(), plans, trees))
