"""Phrases of two to four words that occur together more often than their parts suggest, by language.

Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces, and those at blanks and tabs into words; a phrase lies
within a piece. All counts are exact. A phrase is at most as frequent as any part of it, so each pass over the texts need only
look at what the pass before leaves possible:

1. words of every language;
2. pairs of frequent words, then three words of such pairs, by a hash: bit maps of a fixed size keep which can be frequent;
3. phrases of two to four words that pass the maps of all their parts, as words. A map may let too much through, never too little.

The last pass counts in a HAT-trie: a shallow trie of word ids under each language, with hash containers of counts
below it that burst into a node of containers when they grow. When a task holds too many phrases it spills its largest
subtrees whole, each as a sorted run. Runs go to the shared folder; prefix ranges of phrases then gather and merge
them, so that a prefix in every third phrase is spread over several ranges.

A candidate occurs at least ``least`` times. It scores floor(2000000 a / (l + r)) at its weakest cut, a its count, l and r
those of both parts; ties go to the first cut. It is dropped if a longer candidate that contains it has at least 80 % of its
count. Each language's first ``top`` are returned; two rounds of ranking, the first over shares of a language, keep any
sort small.

Null and empty texts have no words; a null language is ``und``, as is a language of that name. Repeated rows and ids count
each time. Texts and words of any length are taken whole. Ties in the ranking follow the count, then the phrase. Empty tables
and languages without candidates give no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwise.llm.texts import _offsets, finished, mix, slices, stored, stream, texts_array, word_hashes

LEAST, LONGEST, TOP, SHADOW = 30, 4, 2000, 80
#: Bits of the maps of frequent words, pairs and threes: 4 MB each, whatever the corpus.
BITS = 25
#: Phrases that a container holds before it bursts, and levels of the trie above the last containers.
BURST, DEPTH = 4096, 2
#: Phrases, words and keys that a task holds before it combines or spills them.
HELD = 1 << 19
#: Shares in which a language's candidates are ranked first.
SHARES = 64

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_BETWEEN, _BREAK = (np.isin(np.arange(256), [ord(c) for c in signs]) for signs in (" \t.,;:!?\n\v\f\r", ".,;:!?\n\v\f\r"))


class Words:
    """The words of some texts in order: ``ids`` into ``names``, each word's language, and whether it and the next lie in one
    piece."""

    def __init__(self, texts: pa.Array, langs: np.ndarray):
        offsets = _offsets(texts)
        raw = texts.buffers()[2]
        data = _FOLD[np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]] if raw else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        inside = ~_BETWEEN[data]
        begin, stop = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]
        begin[offsets[:-1][filled]] = inside[offsets[:-1][filled]]
        stop[offsets[1:][filled] - 1] = inside[offsets[1:][filled] - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))
        breaks = np.searchsorted(np.flatnonzero(_BREAK[data]), starts)
        self.joined = (owner[1:] == owner[:-1]) & (breaks[1:] == breaks[:-1])
        self.lang = langs[owner]
        ends = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        spelled = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
        coded = spelled.dictionary_encode()
        self.names, self.ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A hash of every word and its language."""
        own, _ = word_hashes(self.names)
        return mix(own[self.ids] + stream(31, 1) * (self.lang.astype(np.uint64) + np.uint64(1)))


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))


def _slices(batches: Iterator[pa.RecordBatch], known: dict[str, int] | None = None) -> Iterator[tuple[Words, list[str]]]:
    """Words of bounded slices of a task's rows; languages are numbered by ``known``, or as they come."""
    numbers = {} if known is None else dict(known)
    for batch in batches:
        texts = texts_array(batch.column(0))
        langs = np.array([numbers.setdefault(x, len(numbers)) for x in batch.column(1).to_pylist()], dtype=np.int64)
        for a, b in slices(texts):
            yield Words(texts.slice(a, b - a), langs[a:b]), list(numbers)


class Sums:
    """Counts by number; sorted and combined when many have come, handed on when many are held."""

    def __init__(self) -> None:
        self.keys, self.counts, self.fresh, self.waiting = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def add(self, keys: np.ndarray) -> bool:
        self.fresh.append(keys)
        self.waiting += len(keys)
        if self.waiting >= 2 * HELD:
            self.combine()
        return len(self.keys) >= HELD

    def combine(self) -> None:
        own, n = np.unique(np.concatenate([*self.fresh, np.empty(0, np.int64)]), return_counts=True)
        keys, at = np.unique(np.concatenate([self.keys, own]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([self.counts, n]), minlength=len(keys))
        self.keys, self.counts, self.fresh, self.waiting = keys, counts.astype(np.int64), [], 0

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        self.combine()
        out = self.keys, self.counts
        self.__init__()
        return out


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, n) for single words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh: list[pa.Table] = []
        langs: list[str] = []
        waiting = 0

        def combined() -> pa.Table:
            return pa.concat_tables(fresh).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")]).select(
                ["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"])

        def records(table: pa.Table):
            named = table.set_column(0, "lang", pa.array([langs[k] for k in table["lang"].to_pylist()], pa.string()))
            return named.combine_chunks().to_batches()

        for words, langs in _slices(batches):
            width = max(1, len(words.names))
            codes, n = np.unique(words.lang * width + words.ids, return_counts=True)
            fresh.append(pa.table({
                "lang": pa.array(codes // width), "phrase": words.names.take(pa.array(codes % width)).cast(pa.string()), "n": pa.array(n)}))
            waiting += len(codes)
            if waiting >= HELD:
                fresh = [combined()]
                waiting = len(fresh[0])
                if waiting >= HELD // 2:
                    yield from records(fresh[0])
                    fresh, waiting = [], 0
        if fresh:
            yield from records(combined())
        finished()

    parts = _texts(docs, text, lang).mapInArrow(run, "lang string, phrase string, n long")
    return parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _bit_map(places: DataFrame) -> np.ndarray:
    """Bits for the places of a frame (at), one row for each 64 of them: 2^BITS bits at most reach the driver."""
    words = places.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros((1 << BITS) // 64, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITS)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _word_map(frequent: DataFrame, langs: dict[str, int]) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a word alone in its text has the hash that it has among others
            names = texts_array(batch.column(1))
            own = np.array([langs[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            for a, b in slices(names):
                yield pa.RecordBatch.from_pydict({"at": pa.array(_place(Words(names.slice(a, b - a), own[a:b]).hashes()))})
        finished()

    return _bit_map(frequent.select("lang", "phrase").mapInArrow(run, "at long"))


def _runs(words: Words, maps: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For one word, two words and so on: the hash of the run that begins at each word, and whether all that is known of it
    allows it to be frequent. There is one more entry than maps: the last has only passed the maps of its parts."""
    odd = stream(57, 2) | np.uint64(1)
    h, fine = words.hashes(), np.ones(len(words.ids), bool)
    out = []
    for size, known in enumerate([*maps, None], 1):
        if known is not None:
            fine = fine.copy()
            fine[fine] = _in_map(known, h[fine])
        out.append((h, fine))
        if len(h) < 2:
            none = np.zeros(0, bool)
            out += [(h[:0], none)] * (len(maps) + 1 - size)
            break
        if size <= len(maps):
            both = fine[:-1] & fine[1:]
            if size == 1:
                both = both & words.joined
            h, fine = mix(h[:-1] * odd[0] + h[1:] * odd[1]), both
    return out


def _run_map(texts: DataFrame, shared: list, langs: dict[str, int], least: int) -> np.ndarray:
    """The map of runs one word longer than those of the last map given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps, sums = [m.value for m in shared], Sums()

        def record():
            keys, n = sums.taken()
            return pa.RecordBatch.from_pydict({"key": pa.array(keys), "n": pa.array(n)})

        for words, _ in _slices(batches, langs):
            h, fine = _runs(words, maps)[-1]
            if sums.add(h[fine].view(np.int64)):
                yield record()
        yield record()
        finished()

    counted = texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return _bit_map(counted.where(F.col("n") >= least).select(F.shiftrightunsigned("key", 64 - BITS).alias("at")))


class HatTrie:
    """Counts of phrases: nodes by word id above, hash containers by the rest of the phrase below.

    A phrase is its words' ids, packed 32 bits each with the first word lowest, so that a node takes its key off with a
    mask and a container's keys are what is left.
    """

    MASK = (1 << 32) - 1

    class Container(dict):
        """Rest of the phrase: count."""

    class Node(dict):
        """Next word's id: container or node."""

    def __init__(self, burst: int = BURST, depth: int = DEPTH):
        self.burst, self.depth, self.roots, self.size = burst, depth, {}, 0

    def add(self, root: int, phrase: int, n: int) -> None:
        """Ids must be above 0, so that a rest of 0 is the end of a phrase."""
        node, parent, key, level = self.roots.get(root), self.roots, root, 0
        if node is None:
            node = self.roots[root] = HatTrie.Container()
        while type(node) is HatTrie.Node:
            parent, key = node, phrase & self.MASK
            phrase >>= 32
            level += 1
            node = parent.get(key)
            if node is None:
                node = parent[key] = HatTrie.Container()
        before = node.get(phrase)
        if before is not None:
            node[phrase] = before + n
            return
        node[phrase] = n
        self.size += 1
        if len(node) > self.burst and level < self.depth:
            parent[key] = self._burst(node)

    def _burst(self, full: Container) -> Node:
        node = HatTrie.Node()
        for phrase, n in full.items():
            key = phrase & self.MASK
            if key not in node:
                node[key] = HatTrie.Container()
            node[key][phrase >> 32] = n
        return node

    def _held(self, node) -> int:
        return len(node) if type(node) is HatTrie.Container else sum(map(self._held, node.values()))

    def _run(self, node, prefix: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int]]:
        if type(node) is HatTrie.Node:
            for key, below in node.items():
                yield from self._run(below, (*prefix, key) if key else prefix)
            return
        for rest, n in node.items():
            phrase = list(prefix)
            while rest:
                phrase.append(rest & self.MASK)
                rest >>= 32
            yield tuple(phrase), n

    def spill(self, least: int) -> Iterator[tuple[int, list[tuple[tuple[int, ...], int]]]]:
        """Takes the largest subtrees out whole, until ``least`` phrases are gone: (root, its phrases and counts)."""
        subtrees = []
        for root, node in self.roots.items():
            if type(node) is HatTrie.Node:
                subtrees += [(self._held(x), root, key) for key, x in node.items()]
            else:
                subtrees.append((len(node), root, None))
        gone = 0
        for size, root, key in sorted(subtrees, key=lambda x: -x[0]):
            if gone >= least:
                break
            node = self.roots.pop(root) if key is None else self.roots[root].pop(key)
            yield root, list(self._run(node, (key,) if key else ()))
            gone += size
        self.size -= gone


def phrase_runs(texts: DataFrame, shared: list, langs: dict[str, int], longest: int = LONGEST) -> DataFrame:
    """Sorted runs of (lang, phrase, n) from every task: phrases of two words and more that pass the maps of all their parts."""
    spelled_langs = list(langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps, trie = [m.value for m in shared], HatTrie()
        numbers: dict[str, int] = {}
        spelled: list[str] = [""]

        def record(root, found):
            body = sorted((" ".join([spelled[k] for k in ids]), n) for ids, n in found)
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([spelled_langs[root]] * len(body), pa.string()),
                "phrase": pa.array([x for x, _ in body], pa.string()), "n": pa.array([n for _, n in body], pa.int64()),
            })

        fresh: list[np.ndarray] = []
        waiting = 0

        def gather() -> None:
            """Into the trie: what the last slices have found, equal phrases as one."""
            nonlocal fresh, waiting
            table = np.concatenate([*fresh, np.zeros((0, longest + 1), np.int32)])
            fresh, waiting = [], 0
            table = table[np.lexsort(table.T)]
            new = np.append(True, (table[1:] != table[:-1]).any(axis=1))[: len(table)]
            first = np.flatnonzero(new)
            for row, n in zip(table[first].tolist(), np.diff(np.append(first, len(table))).tolist()):
                phrase = 0
                for word in row[:0:-1]:
                    phrase = phrase << 32 | word
                trie.add(row[0], phrase, n)

        for part, _ in _slices(batches, langs):
            fine = [f for _, f in _runs(part, maps)][1:]
            while len(fine) < longest - 1:  # beyond the maps: all shorter runs within must pass
                fine.append(fine[-1][:-1] & fine[-1][1:])
            used = np.unique(np.concatenate([part.ids[:-1][fine[0]], part.ids[1:][fine[0]]])) if len(fine[0]) else []
            to = np.zeros(len(part.names), np.int64)
            for k in used:
                word = part.names[k].as_py()
                to[k] = numbers.setdefault(word, len(numbers) + 1)
                if to[k] == len(spelled):
                    spelled.append(word)
            ids = to[part.ids]
            for size, begins in enumerate(fine[: longest - 1], 2):
                at = np.flatnonzero(begins)
                table = np.zeros((len(at), longest + 1), np.int32)
                table[:, 0] = part.lang[at]
                for k in range(size):
                    table[:, k + 1] = ids[at + k]
                fresh.append(table)
                waiting += len(at)
            if waiting >= HELD:
                gather()
            if trie.size >= HELD:
                for root, found in trie.spill(trie.size // 2):
                    yield record(root, found)
            if len(spelled) >= HELD:  # ids start anew, so nothing may be left that uses them
                gather()
                for root, found in trie.spill(trie.size):
                    yield record(root, found)
                numbers.clear()
                del spelled[1:]
        gather()
        for root, found in trie.spill(trie.size):
            yield record(root, found)
        finished()

    return texts.mapInArrow(run, "lang string, phrase string, n long")


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) for every phrase of one to ``longest`` words with n >= least; and (lang, n), all words of each."""
    texts = _texts(docs, text, lang)
    words = stored(word_counts(docs, text, lang), "collocations-words")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "collocations-totals")
    langs = {r["lang"]: k for k, r in enumerate(totals.select("lang").orderBy("lang").collect())}
    context = docs.sparkSession.sparkContext
    frequent = words.where(F.col("n") >= least)
    maps = [context.broadcast(_word_map(frequent, langs))]
    for _ in range(2, longest):
        maps.append(context.broadcast(_run_map(texts, maps, langs, least)))
    runs = stored(phrase_runs(texts, maps, langs, longest), "collocations-runs")
    merged = runs.repartitionByRange("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return frequent.unionByName(merged.where(F.col("n") >= least)), totals


def _part(words: Column, start: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP,
    shadow: int = SHADOW,
) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    counted, totals = phrase_counts(docs, text, lang, least, longest)
    counted = stored(counted, "collocations-counts")
    words = F.split("phrase", " ")
    candidates = counted.where(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("n").alias("a"), words.alias("w"))

    # both parts of every cut, looked up together
    cuts = F.explode(F.expr("sequence(1, size(w) - 1)"))
    cut = candidates.select("lang", "phrase", "a", "w", cuts.alias("k"))
    size = F.size("w")
    parts = cut.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("first"), _part(F.col("w"), F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit(False).alias("first"), _part(F.col("w"), F.col("k") + 1, size - F.col("k")).alias("part")),
    )).alias("x")).select("lang", "phrase", "a", "k", "x.first", "x.part")
    known = counted.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    cells = parts.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    exact = "decimal(20,0)"
    score = F.expr(f"2000000 * cast(a as {exact}) div (cast(l as {exact}) + cast(r as {exact}))")
    weakest = cells.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))

    # the most frequent longer candidate around each phrase
    inner = F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    around = candidates.where(F.size("w") > 2).select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("longer"))
    covered = F.lit(100).cast(exact) * F.col("longer").cast(exact) >= F.lit(shadow).cast(exact) * F.col("a").cast(exact)
    kept = weakest.join(around, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    kept = kept.select("lang", "phrase", "a", "x.l", "x.r", "x.score")

    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    some = kept.withColumn("share", share).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "share").orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12 = r"""
WITH pieces AS (
    SELECT lang, row, unnest(range(1, len(cut) + 1)) AS piece, unnest(cut) AS body
    FROM (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS row, regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS cut
        FROM documents)
), worded AS (
    SELECT lang, regexp_extract_all(body, '[^\x20\x09]+') AS w FROM pieces
), phrases AS (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
    FROM worded, (SELECT unnest(range(1, 5)) AS m) WHERE len(w) >= m
), counted AS (
    SELECT lang, phrase, any_value(m) AS m, count(*) AS f FROM phrases GROUP BY lang, phrase
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang
), candidates AS (
    SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m >= 2 AND f >= 30
), cuts AS (
    SELECT lang, phrase, m, a, w, unnest(range(1, m)) AS k FROM candidates
), scored AS (
    SELECT c.*, l.f AS l, r.f AS r, (2000000::HUGEINT * a // (l.f + r.f))::BIGINT AS score
    FROM cuts c JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : k], ' ')
    JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 : c.m], ' ')
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, inner_phrase, max(a) AS f FROM (
        SELECT lang, a, unnest(list_transform(range(1, m - s + 2), lambda i: array_to_string(w[i : i + s - 1], ' '))) AS inner_phrase
        FROM candidates, (SELECT unnest(range(2, 4)) AS s) WHERE s < m)
    GROUP BY ALL
), ranked AS (
    SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
    FROM weakest w LEFT JOIN longer g ON g.lang = w.lang AND g.inner_phrase = w.phrase
    WHERE g.f IS NULL OR 100::HUGEINT * g.f < 80::HUGEINT * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
