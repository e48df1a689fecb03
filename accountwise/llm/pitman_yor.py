"""A hierarchical Pitman-Yor language model: words after words, over words, over spelling contexts, seated by Gibbs sampling.

Every word of the training texts is a customer of the restaurant of the word before it (of the end, if it is the first).
The tables of these restaurants are the customers of the word restaurant, at tables that serve the word. Their dish
is drawn from the word's spelling: its bytes and an end sign, each a customer of the restaurant of the two bytes before
it. Context restaurants with the same last byte share a parent, all those share the root, and the root draws from the
uniform distribution of 256 bytes and the end. Discounts come from the counts of ones and twos of each level.

The context restaurants are seated once, from the words' shares as parent and the number of different followers as tables:
a word that follows another once has one table, the others a first seating and passes as below. Then the words are seated.
A sweep is a pass over all customers: each gets up once, in random order, and is seated anew: at a table with probability
proportional to its size less the discount, at a new one with (strength + discount * tables) * probability of the
spelling. Words of many customers are passed in blocks, each accepted by Metropolis' rule. Then the tables' spellings are seated
in the context restaurants, level by level, by tasks that share the cells. Within a sweep tasks see the totals of the sweep before. The first sweep starts from tables drawn at their expected number. Predictive probabilities are averaged over the
sweeps after the first.

The words of the corpus and their tables are a distributed table that grows with it. Spelling contexts are bounded, at most
65,536 by 257 numbers whatever the corpus; only they go to all tasks. So are the pairs (word before, word), counted inside tasks
before they are passed on. The numbers of the most frequent words, 131,072 at most, go to the tasks that score pairs, and
those of as many pairs to the tasks that read the texts; other words and pairs, each about one in 131,072 of all tokens
at most, meet theirs in a join, so that a common word before others is no hot spot. Pairs are known by 64-bit hashes of their words.

A null text is empty: its only token is the end. Rows may repeat; each is scored by itself. Without training texts every
word has the probability of its spelling.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwise.llm.texts import dropped, mix, slices, stored_alone, stream, text_of, texts_array, tidied, word_hashes

SWEEPS = 3
BURN = 1
#: Passes over the pairs, and over the cells of the spelling contexts; a sweep over the words is one pass.
ROUNDS = 3
STRENGTH = 1.0
HEAD = 131_072
#: Longer words are never sent to all tasks.
HEAD_BYTES = 64
#: Words that a task counts before it passes them on.
HELD = 400_000
#: Tokens of which a task counts the pairs before it passes them on.
HELD_TOKENS = 1_500_000
#: Customers that are seated again together; a dish of more is by itself.
HELD_CUSTOMERS = 1 << 20
#: Dishes of no more customers have them seated again one by one, others in so many blocks at least.
BLOCKS = 64
#: Passes in which pairs are scored and meet the texts, by the pair's word: files of one pass at a time, not of all.
PARTS = 8
#: The hash of the end, which is also what stands before the first word.
END_HASH = np.uint64(0)
SIGNS = 257
END = 256
PAD = 0x20


def tokens(text: str) -> list[bytes]:
    """Words with A-Z lowered, as bytes; the end is the empty word."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def counted(docs: DataFrame, text: str, training: Column) -> DataFrame:
    """(word, c, m): occurrences in training texts and in all texts; the end is the empty word."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            words = list(seen[0].keys() | seen[1].keys())
            own = [seen[1][w] for w in words]
            every = [seen[0][w] + n for w, n in zip(words, own)]
            seen[0].clear(), seen[1].clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(own, pa.int64()), pa.array(every, pa.int64())], names=["word", "c", "m"]
            )

        for batch in batches:
            for value, train in zip(batch.column(0), batch.column(1).to_pylist()):
                count = seen[bool(train)]
                count.update(tokens(value.as_py()))
                count[b""] += 1
                if len(seen[0]) + len(seen[1]) > HELD:
                    yield flush()
        yield flush()

    parts = docs.select(text_of(text), F.coalesce(training, F.lit(False))).mapInArrow(run, "word binary, c long, m long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("m").alias("m"))


# ---- words and pairs by their hashes

def hashes_of(words: pa.Array) -> np.ndarray:
    """A hash of every word, that of ``word_hashes``; the empty word is the end."""
    h, offsets = word_hashes(words)
    out = np.full(len(words), END_HASH)
    out[np.diff(offsets) > 0] = h
    return out.view(np.int64)


def pairs_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word before, word, text) of every token, the end of every text included."""
    h, offsets = word_hashes(texts, fold=True)
    counts = np.diff(offsets) + 1
    word, keep = np.full(int(counts.sum()), END_HASH), np.ones(int(counts.sum()), dtype=bool)
    keep[np.cumsum(counts) - 1] = False
    word[keep] = h
    # before the first word stands the end of the text before
    before = np.concatenate([[END_HASH], word[:-1]])
    return before.view(np.int64), word.view(np.int64), np.repeat(np.arange(len(counts)), counts)


_FACTORS = stream(91, 2) | np.uint64(1)


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(before.view(np.uint64) * _FACTORS[0] + np.uint64(1)) + word.view(np.uint64) * _FACTORS[1]).view(np.int64)


def place_of(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``wanted`` is in the sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def paired(docs: DataFrame, text: str, training: Column) -> DataFrame:
    """(u, w, c, m): how often word w follows word u in training texts and in all texts."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            u, w, train = (np.concatenate(x) for x in zip(*held))
            held.clear()
            key = pair_key(u, w)
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            m, c = np.diff(np.append(first, len(key))), np.add.reduceat(train[order].astype(np.int64), first)
            at = order[first]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (u[at], w[at], c, m)], names=["u", "w", "c", "m"])

        for batch in batches:
            column, train = texts_array(batch.column(0)), np.array(batch.column(1).to_pylist(), dtype=bool)
            for a, b in slices(column):
                u, w, owner = pairs_of(column.slice(a, b - a))
                held.append((u, w, train[a:b][owner]))
                if sum(len(x[0]) for x in held) > HELD_TOKENS:
                    yield flush()
        if held:
            yield flush()

    parts = docs.select(text_of(text), F.coalesce(training, F.lit(False))).mapInArrow(run, "u long, w long, c long, m long")
    return parts.groupBy("u", "w").agg(F.sum("c").alias("c"), F.sum("m").alias("m"))


def shared_words(words: DataFrame, head: int) -> Broadcast:
    """The numbers of the most frequent of ``words``: (h, word, m, c, follow, p), for the tasks of ``with_words``."""
    top = frequent(words, head).select("h", "c", "follow", "p").toArrow().sort_by("h")
    return words.sparkSession.sparkContext.broadcast(tuple(np.asarray(top.column(k).to_numpy()) for k in range(4)))


def with_words(pairs: DataFrame, words: DataFrame, head: int, shared: Broadcast | None = None) -> DataFrame:
    """Pairs (u, w, c, m, t) with the count and tables of u (cu, tu) and the count and probability of w (cw, pw).

    ``words``: (h, word, m, c, follow, p). Rows whose words are both frequent are not moved. ``shared``: of a call before.
    """
    shared = shared or shared_words(words, head)
    names = ["u", "w", "c", "m", "t", "cu", "tu", "cw", "pw"]
    kind = "u long, w long, c long, m long, t long, cu long, tu long, cw long, pw double"

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, count, follow, p = shared.value
        for batch in batches:
            columns = [batch.column(k) for k in range(5)]
            for k, given in ((0, (count, follow)), (1, (count, p))):
                at, hit = place_of(keys, columns[k].to_numpy())
                for x in given:
                    columns.append(pa.array(x[at], mask=~hit) if len(keys) else pa.nulls(len(at), pa.float64() if x is p else pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    found = pairs.select(names[:5]).mapInArrow(run, kind)
    both = F.col("cu").isNotNull() & F.col("cw").isNotNull()
    apart = F.xxhash64("u", "w")  # a row that has its numbers meets no word, wherever it goes
    rest = found.where(~both).withColumns({
        "ku": F.when(F.col("cu").isNull(), F.col("u")).otherwise(apart), "kw": F.when(F.col("cw").isNull(), F.col("w")).otherwise(apart),
    })
    rest = rest.join(words.select(F.col("h").alias("ku"), F.col("c").alias("cu2"), F.col("follow").alias("tu2")), "ku", "left")
    rest = rest.join(words.select(F.col("h").alias("kw"), F.col("c").alias("cw2"), F.col("p").alias("pw2")), "kw", "left")
    rest = rest.select(*names[:5], *(F.coalesce(k, f"{k}2").alias(k) for k in names[5:]))
    return found.where(both).unionByName(rest)


def seat_pairs(pairs: DataFrame, words: DataFrame, d: float, head: int, rounds: int, seed: int) -> DataFrame:
    """(u, w, c, m, t): pairs with their tables; ``words``: (h, word, m, c, follow, p), p the parent's probability."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            rng = np.random.default_rng([seed, 0, part, k])
            c, tables, p = (batch.column(i).to_numpy() for i in (2, 6, 8))
            a = (STRENGTH + d * tables) * p
            sizes, begin = first_seating(c, a, d, rng)
            for _ in range(rounds):
                sizes, begin = reseat(sizes, begin, c, a, d, rng)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(np.diff(begin))], names=["u", "w", "c", "m", "t"])

    more = with_words(pairs.where("c > 1").withColumn("t", F.lit(0).cast("long")), words, head)
    more = more.mapInArrow(run, "u long, w long, c long, m long, t long")
    return pairs.where("c <= 1").withColumn("t", F.col("c")).unionByName(stored_alone(more, "pair-seats"))


# ---- seating: the same for words and for spelling signs

def expected_tables(c: np.ndarray, a: np.ndarray, d: float, steps: int = 24) -> np.ndarray:
    """About how many tables c customers of a dish open, one after the other, if a is the pull of a new one."""
    t, i = np.ones(len(c)), np.ones(len(c))
    top = np.maximum(c, 1).astype(float)
    factor = top ** (1.0 / steps)
    for _ in range(steps):
        nxt = i * factor
        t = np.minimum(t + (nxt - i) * a / np.maximum(a + i - d * t, 1e-12), nxt)
        i = nxt
    return np.clip(t, 1, top)


def first_seating(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(table sizes, where each dish's tables begin)."""
    want = expected_tables(c, a, d)
    t = np.minimum(np.floor(want) + (rng.random(len(c)) < want % 1), c).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(t)])
    share = rng.gamma(1 - d, size=int(begin[-1])) + 1e-300
    dish = np.repeat(np.arange(len(c)), t)
    total = np.add.reduceat(share, begin[:-1]) if len(c) else share
    sizes = 1 + np.floor(share / total[dish] * (c - t)[dish]).astype(np.int64)
    if len(c):
        sizes[begin[:-1]] += c - np.add.reduceat(sizes, begin[:-1])
    return sizes, begin


def reseat(sizes: np.ndarray, begin: np.ndarray, c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A pass over all customers: each of a dish of two or more gets up once, in random order, and is seated again."""
    counts, ends = np.diff(begin), np.cumsum(c)
    parts, at = [], 0
    while at < len(c):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] - c[at] + HELD_CUSTOMERS, side="right")))
        inside = slice(at, upto)
        moves = c[inside] >= 2
        own, of = sizes[begin[at] : begin[upto]], np.repeat(moves, counts[inside])
        dish = np.repeat(np.arange(at, upto), counts[inside])
        new, number = _pass(own[of], counts[inside][moves], c[inside][moves], a[inside][moves], d, rng)
        dish = np.concatenate([dish[~of], np.repeat(np.flatnonzero(moves) + at, number)])
        order = np.argsort(dish, kind="stable")
        parts.append((np.concatenate([own[~of], new])[order], dish[order]))
        at = upto
    if not parts:
        return sizes, begin
    sizes, dish = (np.concatenate(x) for x in zip(*parts))
    return sizes, np.concatenate([[0], np.cumsum(np.bincount(dish, minlength=len(c)))])


def _pass(sizes: np.ndarray, tables: np.ndarray, c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(table sizes, tables of each dish) after all customers were seated again; every dish has two customers at least.

    Customers of a dish stand in random order, cut into blocks; up to ``BLOCKS`` customers, each is a block of its own. A block
    gets up and its customers sit down one after the other, at a table by its size less the discount, or at a new one. For a
    block of several, that is a proposal: seated so, the weights of a new seating and of the one before differ by
    the totals that the draws were divided by, and it is taken or left by their ratio, so that the posterior stays exact.
    An old table is found by following a customer at random; the customer that opened it counts 1 - d.
    """
    if not len(c):
        return sizes, tables
    old_tables, n = len(sizes), int(c.sum())
    owner = np.repeat(np.arange(len(c), dtype=np.int32), c)
    table = np.repeat(np.arange(old_tables), sizes)[np.argsort(owner + rng.random(n))]
    size = np.concatenate([sizes, np.zeros(n, dtype=sizes.dtype)])  # a table opened by customer k has the number old_tables + k
    dish_of = np.repeat(np.arange(len(c)), tables)
    tables, first = tables.copy(), np.cumsum(c) - c
    blocks = np.minimum(c, np.maximum(BLOCKS, np.ceil(3 * np.cbrt(tables)).astype(np.int64)))
    act, number = np.arange(len(c)), 0
    while len(act):
        low, high = c[act] * number // blocks[act], c[act] * (number + 1) // blocks[act]
        many = high - low
        begin = np.cumsum(many) - many
        g = np.repeat(np.arange(len(act)), many)
        i = np.arange(len(g)) - begin[g]
        who = first[act][g] + low[g] + i
        was = table[who]
        np.subtract.at(size, was, 1)
        gone = np.flatnonzero(size[was] == 0)
        opened_before = np.zeros(len(g), dtype=bool)
        opened_before[gone[np.unique(was[gone], return_index=True)[1]]] = True
        rest = c[act] - many
        left = tables[act] - np.bincount(g[opened_before], minlength=len(act))
        pull, stay = a[act], rest - d * left
        to, opened, settled, behind = np.empty_like(was), np.zeros(len(g), dtype=bool), np.zeros(len(g), dtype=bool), np.full(len(g), -1)
        todo = np.arange(len(g))
        while len(todo):
            free = todo[behind[todo] < 0]
            x = rng.random(len(free)) * (pull[g[free]] + stay[g[free]] + i[free]) - pull[g[free]]
            fresh, within = x < 0, x >= stay[g[free]]
            opened[free[fresh]] = settled[free[fresh]] = True
            to[free[fresh]] = old_tables + who[free[fresh]]
            near = free[within]
            behind[near] = begin[g[near]] + np.minimum((x - stay[g[free]])[within].astype(np.int64), i[near] - 1)
            seek = free[~fresh & ~within]
            settled[seek] = True
            while len(seek):
                k = g[seek]
                spot = rng.integers(0, rest[k])
                found = table[first[act[k]] + spot + np.where(spot < low[k], 0, many[k])]
                fine = (left[k] == 1) | (left[k] == rest[k]) | (rng.random(len(seek)) * size[found] >= d)
                to[seek[fine]] = found[fine]
                seek = seek[~fine]
            # those who follow one of their own block wait until that one sits
            near = todo[~settled[todo]]
            ahead = behind[near]
            known = settled[ahead]
            again = known & opened[ahead] & (rng.random(len(near)) < d)
            behind[near[again]] = -1
            sits = known & ~again
            to[near[sits]] = to[ahead[sits]]
            settled[near[sits]] = True
            todo = near[~sits]
        if (many > 1).any():
            total = (pull + stay)[g] + i
            ratio = np.log(total - d * _before(opened, begin, g)) - np.log(total - d * _before(opened_before, begin, g))
            back = (np.log(rng.random(len(act))) >= np.bincount(g, weights=ratio, minlength=len(act)))[g]
            to[back], opened[back] = was[back], opened_before[back]
        np.add.at(size, to, 1)
        table[who] = to
        tables[act] = left + np.bincount(g[opened], minlength=len(act))
        number += 1
        act = act[blocks[act] > number]
    used = np.flatnonzero(size)
    dish = np.where(used < old_tables, dish_of[np.minimum(used, old_tables - 1)], owner[np.maximum(used - old_tables, 0)])
    return size[used[np.argsort(dish, kind="stable")]], tables


def _before(marks: np.ndarray, begin: np.ndarray, g: np.ndarray) -> np.ndarray:
    """How many marked ones stand before each, within its block."""
    upto = np.cumsum(marks) - marks
    return upto - upto[begin][g]


def discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5


# ---- spelling contexts

@dataclass
class Spelling:
    """Probabilities of signs: ``row`` leads from a context of two bytes to its row."""

    row: np.ndarray
    p: np.ndarray


def flat_words(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Signs of all words, each word ended, and where words begin."""
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    begin = offsets[:-1] + np.arange(len(words))
    signs = np.full(len(data) + len(words), END, dtype=np.int64)
    keep = np.ones(len(signs), dtype=bool)
    keep[begin + np.diff(offsets)] = False
    signs[keep] = data
    return signs, begin


def contexts(signs: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The two bytes before each sign; before the first of a word there is padding."""
    one = np.concatenate([[PAD], signs[:-1]])
    one[begin] = PAD
    two = np.concatenate([[PAD], one[:-1]])
    two[begin] = PAD
    return two * 256 + one


def spelled(words: pa.Array, model: Spelling) -> np.ndarray:
    """Log probability of each word's spelling."""
    if not len(words):
        return np.empty(0)
    signs, begin = flat_words(words)
    return np.add.reduceat(np.log(model.p[model.row[contexts(signs, begin)], signs].astype(np.float64)), begin)


def seat_spelling(spark: SparkSession, cells: np.ndarray, before: Spelling | None, rng: np.random.Generator) -> Spelling:
    """Seats the customers (context, sign, n) of the longest contexts, then the tables' dishes in the parents.

    ``before``: the sweep before; without it parents are judged from one table for each kind of customer.
    """
    levels = []
    ctx, sign, n = cells[:, 0], cells[:, 1], cells[:, 2]
    for width in (2, 1, 0):
        if width < 2:
            key = (ctx % 256 if width else np.zeros_like(ctx)) * SIGNS + sign
            key, inverse = np.unique(key, return_inverse=True)
            n, ctx, sign = np.bincount(inverse, weights=n).astype(np.int64), key // SIGNS, key % SIGNS
        d = discount(int((n == 1).sum()), int((n == 2).sum()))
        levels.append((width, ctx, sign, n, d))
        n = np.ones_like(n) if before is None else _tables(spark, ctx, sign, n, d, before, width, rng)
        levels[-1] += (n,)
    p, index = np.full((1, SIGNS), 1.0 / SIGNS), None
    for width, ctx, sign, n, d, t in reversed(levels):
        which, inverse = np.unique(ctx, return_inverse=True)
        if width == 0:
            parent = p[0][None, :].repeat(len(which), axis=0)
        elif width == 1:
            parent = root[None, :].repeat(len(which), axis=0)
        else:
            parent = p1[index1[which % 256]]
        customers, tables = np.bincount(inverse, weights=n), np.bincount(inverse, weights=t)
        own = parent * (STRENGTH + d * tables)[:, None]
        own[inverse, sign] += n - d * t
        own /= (STRENGTH + customers)[:, None]
        if width == 0:
            root = own[0] if len(own) else p[0]
        elif width == 1:
            p1 = np.concatenate([own, root[None, :]])
            index1 = np.full(256, len(own))
            index1[which] = np.arange(len(which))
        else:
            row = len(own) + index1[np.arange(65_536) % 256]
            row[which] = np.arange(len(which))
            return Spelling(row.astype(np.int32), np.concatenate([own, p1]).astype(np.float32))
    raise AssertionError


def _tables(
    spark: SparkSession, ctx: np.ndarray, sign: np.ndarray, n: np.ndarray, d: float, before: Spelling, width: int, rng: np.random.Generator,
) -> np.ndarray:
    """Tables of each (context, sign) after a first seating and a few passes, in tasks: each has some of the cells."""
    if not len(n):
        return n
    which, inverse = np.unique(ctx, return_inverse=True)
    # the parent's probability of the sign, from the shorter contexts of the sweep before
    last = before.p[-257:] if len(before.p) >= 257 else before.p
    parent = last.mean(axis=0)[sign] if width < 2 else before.p[before.row[ctx % 256]][np.arange(len(sign)), sign]
    parent, tables, seed = np.maximum(parent, 1e-6).astype(float), np.bincount(inverse).astype(float), int(rng.integers(1 << 40))
    # heavy cells first, dealt one by one: tasks get about as many customers each
    order = np.argsort(-n, kind="stable")
    parts = int(min(len(n), max(1, spark.sparkContext.defaultParallelism, n.sum() // HELD_CUSTOMERS)))
    for turn in range(2):
        a = (STRENGTH + d * tables[inverse]) * parent
        cells = [(k, order[k::parts].tolist(), n[order[k::parts]].tolist(), a[order[k::parts]].tolist()) for k in range(parts)]

        def run(cell: tuple) -> tuple[list[int], list[int]]:
            k, at, own, pull = cell
            rng, own, pull = np.random.default_rng([seed, turn, k]), np.array(own), np.array(pull)
            sizes, begin = first_seating(own, pull, d, rng)
            for _ in range(ROUNDS):
                sizes, begin = reseat(sizes, begin, own, pull, d, rng)
            return at, np.diff(begin).tolist()

        t = np.zeros(len(n), dtype=np.int64)
        for at, found in spark.sparkContext.parallelize(cells, parts).map(run).collect():
            t[at] = found
        tables = np.bincount(inverse, weights=t)
    return t


def _cells(state: DataFrame) -> np.ndarray:
    """(context, sign, n) over the spellings of all tables; bounded by contexts times signs."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in batches:
            signs, begin = flat_words(batch.column(0))
            if not len(begin):
                continue
            t = np.repeat(batch.column(1).to_numpy(), np.diff(np.append(begin, len(signs))))
            keys, inverse = np.unique(contexts(signs, begin) * SIGNS + signs, return_inverse=True)
            for k, n in zip(keys.tolist(), np.bincount(inverse, weights=t).tolist()):
                sums[k] += int(n)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(list(sums), pa.int64()), "n": pa.array(list(sums.values()), pa.int64())})

    tables = state.where("c > 0").select("word", F.element_at("ts", -1).cast("long").alias("t"))
    rows = tables.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return np.empty((0, 3), np.int64)
    x = np.array([(r["cell"], r["n"]) for r in sorted(rows)], dtype=np.int64)
    return np.stack([x[:, 0] // SIGNS, x[:, 0] % SIGNS, x[:, 1]], axis=1)


def _sweep(state: DataFrame, spelling: Spelling, tables: int, d: float, number: int, seed: int) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast((spelling.row, spelling.p))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Spelling(*shared.value)
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            rng = np.random.default_rng([seed, number, part, k])
            c = batch.column(1).to_numpy()
            a = (STRENGTH + d * tables) * np.exp(spelled(batch.column(0), model))
            if number == 1:
                sizes, begin = first_seating(c, a, d, rng)
            else:
                listed = batch.column(3)
                begin = np.asarray(listed.offsets).astype(np.int64)
                sizes, begin = np.asarray(listed.values)[begin[0] : begin[-1]].astype(np.int64), begin - begin[0]
            sizes, begin = reseat(sizes, begin, c, a, d, rng)
            t, before = np.diff(begin), batch.column(4)
            ts = np.concatenate([np.asarray(before.values).reshape(len(c), -1), t[:, None]], axis=1) if number > 1 else t[:, None]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2),
                    pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(sizes.astype(np.int64))),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1, dtype=np.int32) * ts.shape[1]), pa.array(ts.ravel().astype(np.int64))),
                    *(batch.column(i) for i in (5, 6, 7)),
                ],
                names=["word", "c", "m", "sizes", "ts", "h", "own", "follow"],
            )

    return state.mapInArrow(run, "word binary, c long, m long, sizes array<long>, ts array<long>, h long, own long, follow long")


@dataclass
class Model:
    """``words``: (word, h, c, m, follow, base, score), every word of the corpus; ``pairs``: (u, w, c, m, t), every pair."""

    words: DataFrame
    pairs: DataFrame
    #: Training tokens and words, and the discount of the context restaurants.
    n: int
    v: int
    d: float


def _ones_and_twos(rows: DataFrame, c: str) -> list[Column]:
    return [F.coalesce(F.sum((F.col(c) == k).cast("long")), F.lit(0)) for k in (1, 2)]


def word_scores(docs: DataFrame, text: str, training: Column, **options) -> tuple[DataFrame, int]:
    """The words of the model, with log10 probabilities in the word restaurant; and the training tokens."""
    model = seated_model(docs, text, training, **options)
    return model.words, model.n


def seated_model(
    docs: DataFrame, text: str, training: Column, sweeps: int = SWEEPS, burn: int = BURN, rounds: int = ROUNDS, seed: int = 42, head: int = HEAD,
) -> Model:
    @tidied
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes_of(batch.column(0)))], names=["word", "own", "m", "h"])

    corpus = words = stored_alone(counted(docs, text, training).mapInArrow(hashed, "word binary, own long, m long, h long"), "words")
    n, v = words.agg(F.coalesce(F.sum("own"), F.lit(0)), F.coalesce(F.sum((F.col("own") > 0).cast("long")), F.lit(0))).first()
    pairs = stored_alone(paired(docs, text, training), "pairs")
    d_pairs = discount(*pairs.agg(*_ones_and_twos(pairs, "c")).first())
    follow = pairs.where("c > 0").groupBy(F.col("u").alias("h")).agg(F.count("*").alias("follow"))
    share = (F.col("own") + 0.5) / F.lit(n + 0.5 * (v + 1))
    first = words.join(follow, "h", "left").select("h", "word", "m", F.col("own").alias("c"), F.coalesce("follow", F.lit(0).cast("long")).alias("follow"), share.alias("p"))
    first = stored_alone(first, "first-words")
    pairs = seat_pairs(pairs, first, d_pairs, head, rounds, seed)
    taken = pairs.where("t > 0")
    follow = taken.groupBy(F.col("u").alias("h")).agg(F.sum("t").alias("follow"))
    guests = taken.groupBy(F.col("w").alias("h")).agg(F.sum("t").alias("c"))
    none = F.lit(0).cast("long")
    words = words.join(follow, "h", "left").join(guests, "h", "left").select(
        "word", F.coalesce("c", none).alias("c"), "m", "h", "own", F.coalesce("follow", none).alias("follow"),
    )
    words = stored_alone(words, "customers")
    dropped(corpus, first)
    guests, ones, twos = words.agg(F.coalesce(F.sum("c"), F.lit(0)), *_ones_and_twos(words, "c")).first()
    d = discount(ones, twos)
    rng = np.random.default_rng(seed)
    empty = F.array().cast("array<long>")
    seated = words.where("c > 0").select("word", "c", "m", empty.alias("sizes"), empty.alias("ts"), "h", "own", "follow")
    start = seated.withColumn("ts", F.array(F.lit(1).cast("long")))
    spelling, tables, kept = seat_spelling(docs.sparkSession, _cells(start), None, rng), v, []
    for number in range(1, sweeps + 1):
        last, seated = seated, stored_alone(_sweep(seated, spelling, tables, d, number, seed), "seats")
        if number > 1:
            dropped(last)
        tables = seated.agg(F.coalesce(F.sum(F.element_at("ts", -1)), F.lit(0))).first()[0]
        spelling = seat_spelling(docs.sparkSession, _cells(seated), spelling, rng)
        if number > burn:
            kept.append((spelling.row, spelling.p, tables))
    shared = docs.sparkSession.sparkContext.broadcast(kept)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, count = batch.column(1).to_numpy().astype(float), batch.num_rows
            ts = np.asarray(batch.column(3).flatten()).reshape(count, -1) if count else np.empty((0, sweeps))
            p = np.zeros(count)
            for k, (row, prob, total) in enumerate(shared.value):
                h = np.exp(spelled(batch.column(0), Spelling(row, prob)))
                p += np.maximum(c - d * ts[:, burn + k], 0) + (STRENGTH + d * total) * h
            p /= len(shared.value) * (STRENGTH + guests)
            own = batch.column(5).to_numpy()
            base = np.log10((own + 0.5) / (n + 0.5 * (v + 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(batch.column(k) for k in (4, 5, 2, 6)), pa.array(base), pa.array(np.log10(np.maximum(p, 1e-300)))],
                names=["word", "h", "c", "m", "follow", "base", "score"],
            )

    none = F.array(*(F.lit(0).cast("long") for _ in range(sweeps)))
    columns = ["word", "c", "m", "ts", "h", "own", "follow"]
    rows = seated.select(columns).unionByName(words.where("c = 0").withColumn("ts", none).select(columns))
    kind = "word binary, h long, c long, m long, follow long, base double, score double"
    scores = stored_alone(rows.mapInArrow(run, kind), "word-scores")
    dropped(words, seated)
    return Model(scores, pairs, n, v, d_pairs)


def pair_scores(pairs: DataFrame, words: DataFrame, head: int, shared: Broadcast, d: float) -> DataFrame:
    """(key, m, cw, score): log10 probability of a pair's word after the word before it, and the word's count."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, w, c, _, t, cu, tu, cw, p = (x.to_numpy() for x in batch.columns)
            own = (np.maximum(c - d * t, 0) + (STRENGTH + d * tu) * p) / (STRENGTH + cu)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair_key(u, w)), batch.column(3), pa.array(cw), pa.array(np.log10(np.maximum(own, 1e-300)))], names=["key", "m", "cw", "score"]
            )

    return with_words(pairs, words, head, shared).mapInArrow(run, "key long, m long, cw long, score double")


def frequent(rows: DataFrame, head: int) -> DataFrame:
    """At most ``head`` words or pairs, the most frequent: all from a frequency on, found from a histogram of its logarithm."""
    step = F.floor(F.log2(F.greatest(F.col("m"), F.lit(1)).cast("double")) * 64).cast("int")
    short = (rows.where(F.octet_length("word") <= HEAD_BYTES) if "word" in rows.columns else rows).withColumn("step", step)
    sizes = sorted(((r["step"], r["n"]) for r in short.groupBy("step").agg(F.count("*").alias("n")).collect()), reverse=True)
    least, held = None, 0
    for at, n in sizes:  # 64 steps for each doubling
        if held + n > head:
            break
        least, held = at, held + n
    return short.where(F.lit(False) if least is None else F.col("step") >= least)


def scored(docs: DataFrame, training: Column, id: str = "doc_id", text: str = "text", head: int = HEAD, **options) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    model = seated_model(docs, text, training, head=head, **options)
    n, least = model.n, model.n + 0.5 * (model.v + 1)
    words = model.words.select("h", "word", "m", "c", "follow", F.pow(F.lit(10.0), "score").alias("p"))
    known_words = shared_words(words, head)
    top = pair_scores(frequent(model.pairs, head), words, head, known_words, model.d).select("key", "cw", "score").toArrow().sort_by("key")
    key, cw, score = (np.asarray(top.column(k).to_numpy()) for k in range(3))
    shared = docs.sparkSession.sparkContext.broadcast((key, np.stack([cw > 0, np.log10((cw + 0.5) / least), score], axis=1)))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers = shared.value
        numbers = numbers if len(keys) else np.zeros((1, 3))
        for batch in batches:
            column, rows = texts_array(batch.column(3)), batch.column(0).to_numpy()
            for a, b in slices(column):
                u, w, owner = pairs_of(column.slice(a, b - a))
                key = pair_key(u, w)
                at, hit = place_of(keys, key)
                own = numbers[at] * hit[:, None]
                sums = [np.bincount(owner, weights=own[:, k], minlength=b - a) for k in range(3)]
                key, w, owner, tokens_ = key[~hit], w[~hit], owner[~hit], np.bincount(owner, minlength=b - a)
                order = np.lexsort((key, owner))
                key, w, owner = key[order], w[order], owner[order]
                fresh = np.ones(len(key), dtype=bool)
                fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(fresh)
                times = np.diff(np.append(first, len(key)))
                rare, nothing = len(first), pa.nulls
                summed = pa.StructArray.from_arrays(
                    [batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(tokens_.astype(np.int64)),
                     pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])],
                    names=["doc_id", "held_out", "tokens", "known", "base", "score"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([rows[a:b], rows[a:b][owner[first]]])),
                        pa.concat_arrays([nothing(b - a, pa.int64()), pa.array(key[first])]),
                        pa.concat_arrays([nothing(b - a, pa.int32()), pa.array(times.astype(np.int32))]),
                        # what is summed already meets no pair and is of no part
                        pa.concat_arrays([nothing(b - a, pa.int32()), pa.array((w[first] % PARTS).astype(np.int32))]),
                        pa.concat_arrays([summed, nothing(rare, summed.type)]),
                    ],
                    names=["row", "key", "n", "part", "text"],
                )

    slim = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("doc_id"),
        (~F.coalesce(training, F.lit(False))).alias("held_out"), text_of(text).alias("text"),
    )
    kind = "row long, key long, n int, part int, text struct<doc_id:long, held_out:boolean, tokens:long, known:long, base:double, score:double>"
    found = stored_alone(slim.mapInArrow(run, kind), "text-pairs")
    known = F.when(F.col("cw") > 0, F.col("n")).otherwise(0).cast("long")
    base = F.col("n") * F.log10((F.col("cw") + 0.5) / F.lit(least))
    sums = found.where("part is null").select("row", "text.*")
    for part in range(PARTS):
        pairs = model.pairs.where(F.pmod("w", F.lit(PARTS)) == part)
        scores = pair_scores(pairs, words, head, known_words, model.d).select("key", "cw", F.col("score").alias("own"))
        met = found.where(F.col("part") == part).join(scores, "key", "left").groupBy("row").agg(
            F.sum(known).alias("known"), F.sum(base).alias("base"), F.sum(F.col("n") * F.col("own")).alias("score"),
        )
        sums = sums.unionByName(stored_alone(met, "text-sums"), allowMissingColumns=True)
    dropped(model.words, model.pairs)
    return sums.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("tokens").alias("n_tokens"),
        F.sum("known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    ).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
