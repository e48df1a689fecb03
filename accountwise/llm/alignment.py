"""Alignment of the tokens of two public vocabularies over the same bytes.

Tasks encode each whole text, with a blank before it, by a byte-level vocabulary (A) and by a piece vocabulary (B). The
ends of A's and B's tokens, in bytes, are two sorted lists; merging them gives everything: where both end, a group ends,
and every different end closes the overlap of just one A token with one B token, a link. The merge follows its path:
binary searches on equally spaced diagonals cut it into pieces of equal work that need nothing from each other but one
look across their border; each emits its overlaps and its common ends, and running sums over the pieces number the
groups, also those that cross a border. Pieces run over many texts at once, so a long text is many pieces and short
texts share one.

The count of an id pair is the number of documents in which it is linked. Documents keep their distinct pairs; tasks add
them up before the shuffle. The ``HEAD`` most common pairs return to the documents as one sorted array of bounded size,
all others by a join; which way a pair takes does not change its count.

A text that is null or empty, or whose tokens of either kind do not join to its own bytes (a text with U+2581, which B
writes for a blank), has no tokens: all counts are zero and the groups are ''. Strings of special tokens are plain text.
Every row is a document: repeated rows count each time, an id may be null or repeat. Long texts are encoded whole. Ties
of an A id's highest count are all best. Empty tables give no rows; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwise.llm.lengths import encode_whole, encoding
from accountwise.llm.texts import finished, slices, stored, texts_array

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Steps of the merge in one piece.
STEPS = 1 << 16
#: Pairs whose counts return to the documents as an array: 9 MB at most.
HEAD = 1 << 19
#: Different pairs that a task holds before it passes their counts on.
HELD = 1 << 21

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string"
_PAIRS = "a_step array<int>, b array<int>, times array<int>"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_tokens(vocabulary: bytes) -> list[bytes | None]:
    """The bytes of every id of a byte-level vocabulary, without its special tokens."""
    data, letters = json.loads(vocabulary), byte_letters()
    special = {t["id"] for t in data["added_tokens"]}
    ids = data["model"]["vocab"]
    out: list[bytes | None] = [None] * (max(ids.values()) + 1)
    for token, k in ids.items():
        if k not in special:
            out[k] = bytes(letters[c] for c in token)
    return out


def piece_tokens(processor) -> list[bytes]:
    """The bytes of every id of a piece vocabulary; U+2581 is a blank, <0xHH> a byte."""
    return [
        bytes([int(processor.id_to_piece(k)[3:5], 16)]) if processor.is_byte(k)
        else processor.id_to_piece(k).replace("▁", " ").encode()
        for k in range(processor.get_piece_size())
    ]


def merge_path(a: np.ndarray, b: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of a and of b come before every ``steps``-th step of their merge; at ties a comes first."""
    d = np.append(np.arange(0, len(a) + len(b), steps), len(a) + len(b))
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        ahead = np.zeros(len(d), dtype=bool)
        ahead[open_] = a[mid[open_]] <= b[d[open_] - mid[open_] - 1]
        low, high = np.where(open_ & ahead, mid + 1, low), np.where(open_ & ~ahead, mid, high)
    return low, d - low


def piece(a: np.ndarray, b: np.ndarray, i: tuple[int, int], j: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """What one piece of the merge emits: its links as places in a and in b, and which of its ends are common."""
    own_a, own_b = a[i[0] : i[1]], b[j[0] : j[1]]
    to_b = j[0] + np.searchsorted(own_b, own_a)
    to_a = i[0] + np.searchsorted(own_a, own_b)
    # an equal end can lie just across the border: b's after this piece, a's before it
    both_a = (to_b < len(b)) & (b[np.minimum(to_b, len(b) - 1)] == own_a)
    both_b = np.zeros(len(own_b), dtype=bool)
    inside = to_a < i[1]
    both_b[inside] = a[to_a[inside]] == own_b[inside]
    if len(own_b) and i[0] and a[i[0] - 1] == own_b[0]:
        both_b[0] = True
    single = ~both_b
    links_a = np.concatenate([np.arange(i[0], i[1]), to_a[single]])
    links_b = np.concatenate([to_b, np.arange(j[0], j[1])[single]])
    return links_a, links_b, both_a, both_b


def overlaps(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, ...]:
    """Links (places in a, places in b) and the group of every token of a and of b, from their ends.

    Both lists rise and close with the same end.
    """
    i, j = merge_path(a, b, steps)
    parts = [piece(a, b, (i[k], i[k + 1]), (j[k], j[k + 1])) for k in range(len(i) - 1)]
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, none, none
    links_a, links_b, both_a, both_b = (np.concatenate(x) for x in zip(*parts))
    return links_a, links_b, np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b


class Names:
    """Ids in decimal, each with the sign after it: a comma, a bar or a semicolon, or none."""

    SIGNS = (b",", b"|", b";", b"")

    def __init__(self, ids: int):
        self.of = [b"%d%s" % (k, sign) for k in range(ids) for sign in self.SIGNS]

    def written(self, places: np.ndarray, ids: np.ndarray, signs: np.ndarray) -> list[bytes]:
        code = np.empty(len(ids), np.int64)
        code[places] = ids * len(self.SIGNS) + signs
        of = self.of
        return [of[k] for k in code.tolist()]


class Aligner:
    """Both vocabularies, loaded in a task from their files' bytes."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece

        self.bytes_a = byte_tokens(a)
        self.a = encoding({t: k for k, t in enumerate(self.bytes_a) if t is not None})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.bytes_b = piece_tokens(self.b)
        self.length_a = np.array([len(x or b"") for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        self.names = Names(max(len(self.bytes_a), len(self.bytes_b)))

    def tokens(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of A and of B; none if either does not join to the text."""
        if not text:
            return [], []
        want = b" " + text.encode()
        a, b = encode_whole(self.a, " " + text), self.b.encode(text)
        of_a, of_b = self.bytes_a, self.bytes_b
        if b"".join([of_a[k] for k in a]) != want or b"".join([of_b[k] for k in b]) != want:
            return [], []
        return a, b

    def aligned(self, texts: list[str], with_groups: bool) -> dict[str, pa.Array]:
        n = len(texts)
        encoded = [self.tokens(t) for t in texts]
        n_a, n_b = (np.array([len(e[k]) for e in encoded], dtype=np.int64) for k in (0, 1))
        a, b = (np.array([x for e in encoded for x in e[k]], dtype=np.int64) for k in (0, 1))
        del encoded
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        link_a, link_b, group_a, group_b = overlaps(end_a, end_b)

        # tokens in the order in which groups are written: each group's A, then its B
        groups = int(group_a[-1]) + 1 if len(a) else 0
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        upto_a, before_b = np.cumsum(in_a), np.cumsum(in_b) - in_b
        last_a = np.append(group_a[1:] != group_a[:-1], True)[: len(a)]
        last_b = np.append(group_b[1:] != group_b[:-1], True)[: len(b)]
        closing = np.append(doc_b[1:] != doc_b[:-1], True)[: len(b)]
        places = np.concatenate([np.arange(len(a)) + before_b[group_a], np.arange(len(b)) + upto_a[group_b]])
        signs = np.concatenate([np.where(last_a, 1, 0), np.where(closing, 3, np.where(last_b, 2, 0))])
        written = self.names.written(places, np.concatenate([a, b]), signs)
        bounds = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        bodies = [b"".join(written[x:y]) for x, y in zip(bounds, bounds[1:])]
        del written

        # distinct id pairs of each document
        width_a, width_b = len(self.bytes_a), len(self.bytes_b)
        key, times = np.unique((doc_a[link_a] * width_a + a[link_a]) * width_b + b[link_b], return_counts=True)
        pair_b, rest = key % width_b, key // width_b
        pair_a, doc = rest % width_a, rest // width_a
        step = np.diff(pair_a, prepend=0)
        starts = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
        opening = starts[:-1][starts[:-1] < starts[1:]]
        step[opening] = pair_a[opening]

        def lists(x: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(starts), pa.array(x.astype(np.int32)))

        return {
            "n_a": pa.array(n_a), "n_b": pa.array(n_b),
            "n_groups": pa.array(np.bincount(doc_a[last_a], minlength=n).astype(np.int64)),
            "n_links": pa.array(np.bincount(doc_a[link_a], minlength=n).astype(np.int64)),
            "groups_sha256": pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in bodies], pa.string()),
            "groups": pa.array([x.decode() if with_groups else None for x in bodies], pa.string()),
            "a_step": lists(step), "b": lists(pair_b), "times": lists(times),
        }


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoded(
    docs: DataFrame, text: str = "text", id: str = "doc_id", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
    with_groups: bool = True,
) -> DataFrame:
    """Every row's tokens, links and groups (``a1,a2|b1;a3|b2,b3``), and its distinct id pairs: a_step (differences of
    the rising A ids), b, times. The driver reads the vocabularies' files; tasks get their bytes."""
    files = docs.sparkSession.sparkContext.broadcast((file_bytes(vocabulary_a), file_bytes(vocabulary_b)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(*files.value)
            column = texts_array(batch.column(1))
            for x, y in slices(column):
                parts = aligner.aligned(column.slice(x, y - x).to_pylist(), with_groups)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(x, y - x)} | parts)
        finished()

    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, f"{ALIGNED}, {_PAIRS}")


def _keys(batch: pa.RecordBatch, step: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of all rows as A << 32 | B, and where each row's pairs begin."""
    steps = batch.column(step)
    starts = np.asarray(steps.offsets).astype(np.int64)
    base = starts[0]
    flat, others = np.asarray(steps.flatten()).astype(np.int64), np.asarray(batch.column(b).flatten()).astype(np.int64)
    starts = starts - base
    total = np.concatenate([[0], np.cumsum(flat)])
    a = total[1:] - np.repeat(total[starts[:-1]], np.diff(starts))
    return a << 32 | others, starts


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, docs, best): in how many documents each id pair is linked, and whether no pair of that A id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def record(keys, docs):
            return pa.RecordBatch.from_pydict({"a": pa.array(keys >> 32), "b": pa.array(keys & 0xFFFFFFFF), "docs": pa.array(docs)})

        keys, docs, fresh, n = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def merged():
            every = np.concatenate([keys, *fresh])
            weight = np.concatenate([docs, np.ones(len(every) - len(keys), np.int64)])
            found, at = np.unique(every, return_inverse=True)
            return found, np.bincount(at, weights=weight, minlength=len(found)).astype(np.int64)

        for batch in batches:
            some = _keys(batch, 0, 1)[0]
            fresh.append(some)
            n += len(some)
            if n >= HELD:
                keys, docs = merged()
                fresh, n = [], 0
                if len(keys) >= HELD:
                    yield record(keys, docs)
                    keys, docs = keys[:0], docs[:0]
        yield record(*merged())
        finished()

    parts = rows.select("a_step", "b").mapInArrow(run, "a long, b long, docs long")
    counts = stored(parts.groupBy("a", "b").agg(F.sum("docs").alias("docs")), "alignment-pairs")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def aligned(
    docs: DataFrame, text: str = "text", id: str = "doc_id", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
    with_groups: bool = True,
) -> DataFrame:
    """Every row with n_a, n_b, n_groups, n_links, groups and their digest, n_best and count_sum."""
    rows = stored(encoded(docs, text, id, vocabulary_a, vocabulary_b, with_groups), "alignment")
    counts = stored(pair_counts(rows), "alignment-counts")

    # the head: pairs of at least 2^k documents, for the least k that keeps it within its size
    levels = {r["level"]: r["n"] for r in counts.groupBy(
        (F.length(F.bin("docs")) - 1).alias("level")).agg(F.count("*").alias("n")).collect()}
    least, pairs = 64, 0
    while least and pairs + levels.get(least - 1, 0) <= HEAD:
        least -= 1
        pairs += levels.get(least, 0)
    bound = 1 << min(least, 62)
    top = counts.where(F.col("docs") >= bound).toPandas()
    key = top["a"].to_numpy(np.int64) << 32 | top["b"].to_numpy(np.int64)
    order = np.argsort(key)
    head = rows.sparkSession.sparkContext.broadcast(
        (key[order], top["docs"].to_numpy(np.int64)[order] * 2 + top["best"].to_numpy(bool)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, value = head.value
        names = list(ALIGNED_NAMES)
        for batch in batches:
            keys, starts = _keys(batch, len(names), len(names) + 1)
            times = np.asarray(batch.column(len(names) + 2).flatten()).astype(np.int64)
            at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            found = value[at[hit]]
            best, total = np.zeros(len(keys) + 1, np.int64), np.zeros(len(keys) + 1, np.int64)
            best[1:][hit], total[1:][hit] = times[hit] * (found & 1), times[hit] * (found >> 1)
            best, total = np.cumsum(best), np.cumsum(total)
            missed = np.concatenate([[0], np.cumsum(~hit)])
            rest = pa.array(missed[starts].astype(np.int32))
            out = {n: batch.column(k) for k, n in enumerate(names)} | {
                "n_best": pa.array(best[starts[1:]] - best[starts[:-1]]),
                "count_sum": pa.array(total[starts[1:]] - total[starts[:-1]]),
                "rest": pa.StructArray.from_arrays(
                    [pa.ListArray.from_arrays(rest, pa.array(x)) for x in (keys[~hit] >> 32, keys[~hit] & 0xFFFFFFFF, times[~hit])],
                    ["a", "b", "times"]),
            }
            yield pa.RecordBatch.from_pydict(out)
        finished()

    first = rows.select(*ALIGNED_NAMES, "a_step", "b", "times").mapInArrow(
        run, f"{ALIGNED}, n_best long, count_sum long, rest struct<a:array<long>,b:array<long>,times:array<long>>")
    if pairs == sum(levels.values()):
        return first.drop("rest")
    first = stored(first.withColumn("row", F.monotonically_increasing_id()), "alignment-head")
    rare = counts.where(F.col("docs") < bound)
    tail = (
        first.select("row", F.explode(F.arrays_zip("rest.a", "rest.b", "rest.times")).alias("x"))
        .select("row", F.col("x.a").alias("a"), F.col("x.b").alias("b"), F.col("x.times").alias("times"))
        .join(rare, ["a", "b"]).groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("docs")).alias("more_sum"))
    )
    whole = first.drop("rest").join(tail, "row", "left")
    more = {"n_best": "more_best", "count_sum": "more_sum"}
    return whole.withColumns({k: F.col(k) + F.coalesce(v, F.lit(0)) for k, v in more.items()}).drop("row", *more.values())


ALIGNED_NAMES = tuple(c.split()[0] for c in ALIGNED.split(", "))


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
