"""Benchmark items inside documents, by size-partitioned MinHash containment search.

An item is the set of its runs of five words, A-Z lowered. Items are partitioned by size: class u holds the items of
more than u/2 and at most u runs. For class u a document is cut into windows of 1.5 u runs that start every u/2 runs, so
every passage of up to u runs lies in one of them. A window and an item of its class are then of like size, and containment
becomes a Jaccard similarity of at least 0.25 wherever the item stands in however long a document. With one row a band
and 48 hash functions a contained item is missed with a probability of one in a million. Minima of larger windows come from those of
smaller ones, so a run of words is hashed 48 times whatever the classes. Candidates are verified on the words
themselves: the share of the item's runs that occur anywhere in the document.

The documents are read once and not shuffled. Items are the stated query set; they go to the tasks in blocks of bounded
size, each block a pass.

Items of fewer than five words, or null, have no run and are found nowhere; so have such documents. Items and documents
may repeat: every row counts for itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountwise.llm.texts import put_back, set_apart, shingle_hashes, slices, stream, text_of, texts_array, tidied, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 48
#: Characters of items that go to the tasks at once.
BLOCK_CHARS = 8_000_000
SMALLEST = 8

HIT = "item_id long, n_item int, n_shared int"
_SPLIT = {c: " " for c in (9, 10, 11, 12, 13)} | {c: c + 32 for c in range(65, 91)}


def shingle_set(text: str, size: int) -> set[tuple[str, ...]]:
    w = [x for x in text.translate(_SPLIT).split(" ") if x]
    return set(zip(*(w[k:] for k in range(size))))


class Items:
    """A block of items: signatures by class, and the texts for verification."""

    def __init__(self, rows: list[tuple[int, str]], shingle: int, hashes: int) -> None:
        self.shingle = shingle
        self.factors = stream(21, hashes) | np.uint64(1)
        self.ids, self.texts = [r[0] for r in rows], [r[1] for r in rows]
        by_class: dict[int, list[tuple[int, np.ndarray]]] = {}
        for k, text in enumerate(self.texts):
            s, _ = shingle_hashes(*word_hashes(pa.array([text], pa.large_string()), fold=True), shingle)
            s = np.unique(s)
            if len(s):
                u = max(SMALLEST, 1 << int(len(s) - 1).bit_length())
                by_class.setdefault(u, []).append((k, s))
        self.classes = []
        for u, members in sorted(by_class.items()):
            which = np.array([k for k, _ in members])
            minima = np.array([[(s * f >> np.uint64(32)).min() for f in self.factors] for _, s in members])
            bits = max(16, int(64 * len(members)).bit_length())
            tables = []
            for j in range(hashes):
                order = np.argsort(minima[:, j], kind="stable")
                tables.append((minima[order, j].astype(np.uint32), which[order]))
            self.classes.append((u, np.uint32((1 << min(bits, 24)) - 1), tables))

    def marked(self) -> list[np.ndarray]:
        """By class: for each hash function the low bits that minima of items have; made once in a task, not sent to it."""
        if not hasattr(self, "_marked"):
            self._marked = []
            for _, mask, tables in self.classes:
                seen = np.zeros((len(tables), int(mask) + 1), dtype=bool)
                for j, (values, _) in enumerate(tables):
                    seen[j, values & mask] = True
                self._marked.append(seen)
        return self._marked

    def candidates(self, s: np.ndarray, docs: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs of which a window and the item agree in a minimum."""
        found: set[tuple[int, int]] = set()
        if not len(s) or not self.classes:
            return found
        counts = np.bincount(docs)
        cuts = []  # by block size: where blocks begin in the level below, and whose they are
        begin, block = np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0], SMALLEST // 2
        owner, sizes = np.flatnonzero(counts), counts[counts > 0]
        while block <= self.classes[-1][0] // 2:
            step = block if not cuts else 2
            n = -(-sizes // step)
            first = np.cumsum(n) - n
            inner = np.arange(n.sum()) - np.repeat(first, n)
            cuts.append((np.repeat(begin, n) + inner * step, np.repeat(owner, n)))
            begin, sizes, block = first, n, block * 2
        marked = self.marked()
        for j, f in enumerate(self.factors):
            level = (s * f >> np.uint64(32)).astype(np.uint32)
            at = 0
            for (u, mask, tables), seen in zip(self.classes, marked):
                while at < len(cuts) and (SMALLEST // 2) << at <= u // 2:
                    level = np.minimum.reduceat(level, cuts[at][0])
                    at += 1
                whose = cuts[at - 1][1]
                window = level.copy()
                for k in (1, 2):
                    same = whose[k:] == whose[:-k]
                    window[:-k] = np.where(same, np.minimum(window[:-k], level[k:]), window[:-k])
                hit = np.flatnonzero(seen[j][window & mask])
                if len(hit):
                    values, which = tables[j]
                    lo, hi = np.searchsorted(values, window[hit], "left"), np.searchsorted(values, window[hit], "right")
                    for d, a, b in zip(whose[hit][hi > lo], lo[hi > lo], hi[hi > lo]):
                        found.update((int(d), int(k)) for k in which[a:b])
        return found


def _scan(docs: DataFrame, text: str, block: Items, hits: str, threshold: float) -> DataFrame:
    """The documents with the items of one block added to the list in column ``hits``."""
    names = docs.columns
    at, listed = names.index(text), names.index(hits)
    shared = docs.sparkSession.sparkContext.broadcast(vars(block))
    size = block.shingle
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("n_item", pa.int32()), ("n_shared", pa.int32())]))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items.__new__(Items)
        vars(items).update(shared.value)
        sets: dict[int, set] = {}
        for batch in batches:
            column = texts_array(batch.column(at))
            for a, b in slices(column):
                part = column.slice(a, b - a)
                s, d = shingle_hashes(*word_hashes(part, fold=True), size)
                found = [list(x or []) for x in batch.column(listed).slice(a, b - a).to_pylist()]
                own: tuple[int, set] = (-1, set())
                for doc, k in sorted(items.candidates(s, d)):
                    if own[0] != doc:
                        own = (doc, shingle_set(part[doc].as_py(), size))
                    if k not in sets:
                        if len(sets) > 1000:
                            sets.clear()
                        sets[k] = shingle_set(items.texts[k], size)
                    common = len(sets[k] & own[1])
                    if common >= threshold * len(sets[k]):
                        found[doc].append({"item_id": items.ids[k], "n_item": len(sets[k]), "n_shared": common})
                columns = [c.slice(a, b - a) for c in batch.columns]
                columns[listed] = pa.array(found, kind)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def found_in(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    hits: str = "_hits", shingle: int = SHINGLE, threshold: float = THRESHOLD, hashes: int = HASHES,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents, every row and column, with ``hits``: the items that they contain to the threshold."""
    few = items.select(F.col(item_id).cast("long").alias("item_id"), text_of(item_text).alias("text"))
    sizes = few.select(F.xxhash64("item_id", "text").alias("h"), F.length("text").alias("n"))
    blocks, longest = 1, few.agg(F.max(F.length("text"))).first()[0] or 0
    while True:
        largest = sizes.groupBy(F.pmod("h", F.lit(blocks))).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
        if largest <= max(block_chars, longest):
            break
        blocks *= 2
    out = docs.withColumn(hits, F.lit(None).cast(T.ArrayType(T.StructType.fromDDL(HIT))))
    for k in range(blocks):
        part = few.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        out = _scan(out, text, Items([tuple(r) for r in part.collect()], shingle, hashes), hits, threshold)
    return out


def contaminations(docs: DataFrame, items: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) for every item in every document."""
    text = options.get("text", "text")
    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = found_in(slim, items, **(options | {"text": "text", "hits": "hits"}))
    return found.select("doc_id", F.explode("hits").alias("h")).select(
        "doc_id", "h.item_id", "h.n_item", "h.n_shared", (F.col("h.n_shared") / F.col("h.n_item")).alias("containment")
    )


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without those that contain an item; columns as given."""
    given = {"text": f"in_{options.get('text', 'text')}", "hits": "_hits"}
    found = found_in(set_apart(docs), items, **(options | given))
    return put_back(found.where(F.size("_hits") == 0), docs.columns)
