"""Near-duplicate classes by BagMinHash.

A text is the multiset of its runs of five words (a text of one to four words has one run, all its words). Its signature
comes from one Poisson process for every run and every dyadic block of its discretised weight: block 0 is the first
copy, block k the copies 2^(k-1) to 2^k - 1, at a rate of as many points a unit of time. A point counts if the copy it
falls on exists; the earliest point in each of the signature's places stays. Two texts agree in a place with probability
equal to their weighted Jaccard similarity. The blocks are the hierarchy: only the points before a horizon are drawn, so
a long text costs one draw a run and a few hundred more.

Texts that agree in a band of the signature are candidates; the multisets themselves decide. In every bucket the best
connected text is compared with all others first, so a group of many copies costs as many comparisons as it has
members. Texts of a bucket that are still in different classes then are compared by their whole signatures, in blocks of
bounded size and inside tasks; pairs of which at least the share ``LIKELY`` of places is equal go to the multisets, which
a pair at similarity 0.8 misses with probability 4e-5. Only links that join classes leave a task.

Null, empty and wordless texts are classes of their own, row by row. Equal texts are one class. Rows may repeat, and
different texts may carry the same id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwise.llm.texts import (
    mix, put_back, set_apart, shingle_hashes, slices, stored, stream, text_of, texts_array, tidied, word_hashes,
)

SHINGLE = 5
THRESHOLD = 0.8
#: 25 bands of 5 places miss a pair at similarity 0.8 with probability 5e-5.
BANDS, ROWS = 25, 5
#: Places of the whole signature, and the share of them that must agree before multisets are compared.
PLACES, LIKELY = 250, 0.7
#: Members compared with one leader in one task; members of a bucket that one task compares with as many others.
CHUNK, BLOCK = 64, 256
#: Bits of the map that spares texts which no pair needs the shuffle; 2 MB at most.
BITS = 24

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _unit(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def bag_minhash(elements: np.ndarray, docs: np.ndarray, n_docs: int, places: int) -> np.ndarray:
    """Signatures of many multisets at once: ``elements`` repeat as often as their weight, ``docs`` says whose they are."""
    best = np.full((n_docs, places), np.inf)
    if not len(elements):
        return best
    order = np.lexsort((elements, docs))
    e, d = elements[order], docs[order]
    new = np.ones(len(e), dtype=bool)
    new[1:] = (e[1:] != e[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(e)))
    e, d = e[first], d[first]
    total = np.bincount(d, weights=weight, minlength=n_docs)

    # one process for each element and dyadic block of its weight
    state, doc, low, size, limit = [e], [d], [np.zeros(len(e))], [np.ones(len(e))], [weight]
    blocks = stream(13, 64)
    k = 1
    while len(at := np.flatnonzero(weight >= (1 << (k - 1)) + 1)):
        state.append(mix(e[at] ^ blocks[k]))
        doc.append(d[at])
        low.append(np.full(len(at), float(1 << (k - 1))))
        size.append(np.full(len(at), float(1 << (k - 1))))
        limit.append(weight[at])
        k += 1
    state, doc, low, size, limit = (np.concatenate(x) for x in (state, doc, low, size, limit))
    seed = stream(5, 3)
    time = -np.log(_unit(mix(state ^ seed[0]))) / size
    with np.errstate(divide="ignore"):
        horizon = places * (np.log(places) + 2) / total
    flat = best.ravel()
    live = np.arange(len(state))
    while len(live):
        now = live[time[live] <= horizon[doc[live]]]
        while len(now):
            state[now] = mix(state[now] + _MIX)
            h = state[now]
            place = (mix(h ^ seed[1]) % np.uint64(places)).astype(np.int64)
            copy = low[now] + np.floor(_unit(mix(h ^ seed[2])) * size[now])
            hit = copy < limit[now]
            np.minimum.at(flat, doc[now][hit] * places + place[hit], time[now][hit])
            time[now] -= np.log(_unit(mix(h ^ seed[0]))) / size[now]
            now = now[time[now] <= horizon[doc[now]]]
        open_docs = np.isinf(best).any(axis=1) & (total > 0)
        horizon = np.where(open_docs, horizon * 2, horizon)
        live = live[open_docs[doc[live]]]
    return best


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band of each signature; it tells bands apart."""
    bits = signatures.view(np.uint64).reshape(len(signatures), bands, rows)
    h = np.broadcast_to(stream(9, bands), (len(signatures), bands)).copy()
    for r in range(rows):
        h = mix(h + bits[:, :, r])
    return h


def folded(signatures: np.ndarray) -> np.ndarray:
    """Two bytes for each place."""
    return (mix(signatures.view(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def signed(docs: DataFrame, text: str, shingle: int, bands: int, rows: int, places: int) -> DataFrame:
    """(doc_id, digest, n, bands, signature) for every row; n: runs in the text. No bands where it has no word."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.int64())
        for batch in batches:
            column = texts_array(batch.column(2))
            for a, b in slices(column):
                part = column.slice(a, b - a)
                s, d = shingle_hashes(*word_hashes(part), shingle, short=True)
                n = np.bincount(d, minlength=b - a)
                whole = bag_minhash(s, d, b - a, places)
                keys = band_hashes(np.ascontiguousarray(whole[:, : bands * rows]), bands, rows).view(np.int64)
                short = folded(whole)
                offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(n.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[n > 0].ravel())).cast(kinds),
                        pa.array([x.tobytes() for x in short], pa.binary()),
                    ],
                    names=["doc_id", "digest", "n", "bands", "signature"],
                )

    return docs.mapInArrow(run, "doc_id long, digest binary, n long, bands array<long>, signature binary")


def _bag(body: str, shingle: int) -> Counter:
    """The multiset of a text."""
    w = [x for x in body.translate(_TO_BLANK).split(" ") if x]
    if len(w) < shingle:
        return Counter([tuple(w)])
    return Counter(zip(*(w[k:] for k in range(shingle))))


def _alike(x: Counter, y: Counter, threshold: float) -> bool:
    if len(y) < len(x):
        x, y = y, x
    common = sum(min(n, y[e]) for e, n in x.items() if e in y)
    return common >= threshold * (x.total() + y.total() - common)


def _joined(members: DataFrame, shingle: int, likely: float, threshold: float) -> DataFrame:
    """(a, b): links between different classes of a bucket, as many as join what can be joined.

    A bucket of k members is dealt into blocks; one task sees two blocks of it, so members travel k / BLOCK times. A pair
    is looked at in the first bucket that it shares, if its sizes and signatures allow the threshold, and unless the
    task has joined its classes already; the multisets decide.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    own = F.pmod(F.xxhash64("digest"), F.col("blocks"))
    dealt = members.join(sizes, "key").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    dealt = dealt.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "digest", "class", "n",
        "bands", "signature", "body",
    )
    together = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    @tidied
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(group: pd.DataFrame) -> pd.DataFrame:
            x = np.frombuffer(b"".join(group["signature"]), np.uint16).reshape(len(group), -1)
            bands = np.stack(group["bands"].to_numpy())
            n, own = group["n"].to_numpy(), group["own"].to_numpy()
            key, two = group["key"].iloc[0], group["i"].iloc[0] != group["j"].iloc[0]
            names, bodies = group["digest"].to_numpy(), group["body"].to_numpy()
            classes = pd.factorize(group["class"])[0]
            bags: dict[int, Counter] = {}

            def bag(k: int) -> Counter:
                if k not in bags:
                    bags[k] = _bag(bodies[k], shingle)
                return bags[k]

            found, here = [], np.arange(len(group))
            for k in here:
                ok = (classes != classes[k]) & (np.minimum(n, n[k]) >= threshold * np.maximum(n, n[k]))
                ok &= (own > own[k]) if two else (here > k)
                at = np.flatnonzero(ok)
                if not len(at):
                    continue
                at = at[(x[at] == x[k]).mean(axis=1) >= likely]
                same = bands[at] == bands[k]
                at = at[bands[k][np.argmax(same, axis=1)] == key]
                for o in at:
                    if classes[o] != classes[k] and _alike(bag(k), bag(o), threshold):
                        found.append((names[k], names[o]))
                        classes[classes == classes[o]] = classes[k]
            return pd.DataFrame(found, columns=["a", "b"])

        for group in _groups(frames, ["key", "i", "j"]):
            yield links(group)

    return together.mapInPandas(run, "a binary, b binary").distinct()


def _groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of rows with equal keys, from sorted batches."""
    rest = None
    for frame in frames:
        if not len(frame):
            continue
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        new = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
        cuts = np.flatnonzero(new)
        for a, b in zip(cuts, cuts[1:]):
            yield frame.iloc[a:b]
        rest = frame.iloc[cuts[-1] :]
    if rest is not None and len(rest):
        yield rest


def _marked(digests: DataFrame) -> DataFrame:
    """(word, bits): a map of 2^BITS bits in which every digest sets one; bounded whatever there is."""
    at = F.pmod(F.xxhash64("digest"), F.lit(1 << BITS))
    return digests.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")
    )


def _maybe(docs: DataFrame, bits: DataFrame, digest: str) -> DataFrame:
    """The rows with ``_in``: false if the digest is certainly not in the map."""
    at = F.pmod(F.xxhash64(digest), F.lit(1 << BITS))
    joined = docs.withColumn("_at", at).join(
        F.broadcast(bits.withColumnsRenamed({"word": "_word", "bits": "_bits"})), F.shiftright("_at", 6) == F.col("_word"), "left"
    )
    inside = F.coalesce(F.expr("bit_get(_bits, cast(_at & 63 as int)) = 1"), F.lit(False))
    return joined.withColumn("_in", inside).drop("_at", "_word", "_bits")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """The pairs (a, b) of digests whose multisets overlap by the threshold.

    Each member travels with its own text; a leader's text goes once to every chunk of its members.
    """
    sized = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("chunks"))
    chunked = pairs.join(sized, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"))
    members = chunked.join(texts, F.col("b") == F.col("digest")).select("a", "chunk", "b", "body")
    leaders = (
        chunked.select("a", "chunk").distinct().join(texts, F.col("a") == F.col("digest"))
        .select("a", "chunk", F.lit(None).cast("binary").alias("b"), "body")
    )
    together = members.unionByName(leaders)
    together = together.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    @tidied
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leader = Counter()
        for frame in frames:
            kept = []
            for a, b, body in zip(frame["a"], frame["b"], frame["body"]):
                own = _bag(body, shingle)
                if b is None:
                    leader = own
                elif _alike(leader, own, threshold):
                    kept.append((a, b))
            yield pd.DataFrame(kept, columns=["a", "b"])

    return together.mapInPandas(run, "a binary, b binary")


_TO_BLANK = {c: " " for c in (9, 10, 11, 12, 13)}


def components(edges: DataFrame) -> DataFrame:
    """(digest, class): the least digest that can be reached. Every round shortens paths; it ends when none changes."""
    both = stored(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("class")), "labels")
    while True:
        seen = (
            both.join(labels.withColumnsRenamed({"a": "b"}), "b").groupBy("a").agg(F.min("class").alias("near"))
        )
        better = labels.join(seen, "a").select("a", "class", F.least("class", "near").alias("next"))
        # jump: the class of the class
        upper = better.select(F.col("a").alias("next"), F.col("next").alias("top"))
        jumped = stored(better.join(upper, "next").select("a", "class", F.least("next", "top").alias("next")), "labels")
        changed = jumped.where(F.col("class") != F.col("next")).limit(1).count()
        labels = jumped.select("a", F.col("next").alias("class"))
        if not changed:
            return labels.withColumnRenamed("a", "digest")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD,
    bands: int = BANDS, rows: int = ROWS, places: int = PLACES, likely: float = LIKELY,
) -> DataFrame:
    """One row for each input row: doc_id, digest, copy_id, group_id (long), n_copies, group_size (long).

    copy_id is the least id among equal texts, group_id the least id of the class (null if no member has an id),
    n_copies and group_size count rows. ``digest`` identifies the text and ``class_digest`` the class; both are null
    for a row without words, which stands alone.
    """
    base = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.unhex(F.md5(text_of(text).cast("binary"))).alias("digest"),
        text_of(text).alias("body"),
    )
    rows_of = stored(signed(base, "body", shingle, bands, rows, places), "signed")
    nodes = stored(
        rows_of.where("n > 0").groupBy("digest").agg(
            F.min("doc_id").alias("copy_id"), F.count("*").alias("n_copies"), F.first("n").alias("n"),
            F.first("bands").alias("bands"), F.first("signature").alias("signature"),
        ),
        "nodes",
    )
    entries = nodes.select("digest", "n", F.explode("bands").alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    entries = stored(entries.join(sizes, "key"), "buckets")
    degree = entries.groupBy("digest").agg(F.sum("members").alias("degree"))
    entries = stored(entries.drop("members").join(degree, "digest"), "members")

    def texts(needed: DataFrame) -> DataFrame:
        some = _maybe(base, _marked(needed), "digest").where("_in").join(needed, "digest", "left_semi")
        return stored(some.groupBy("digest").agg(F.first("body").alias("body")), "texts")

    leaders = entries.groupBy("key").agg(F.max(F.struct("degree", "digest", "n")).alias("t")).select("key", "t.digest", "t.n")
    x, y = leaders.alias("x"), entries.alias("y")
    alike = F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * F.lit(threshold)
    first = x.join(y, (F.col("x.key") == F.col("y.key")) & alike & (F.col("x.digest") != F.col("y.digest"))).select(
        F.col("x.digest").alias("a"), F.col("y.digest").alias("b")
    )
    first = stored(first.distinct(), "pairs")
    needed = first.select(F.col("a").alias("digest")).union(first.select(F.col("b").alias("digest"))).distinct()
    edges = stored(_verified(first, texts(needed), shingle, threshold), "links")

    classes = components(edges)
    open_ = entries.join(classes, "digest", "left").withColumn("class", F.coalesce("class", "digest"))
    apart = open_.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi").select("key")
    open_ = stored(open_.join(apart, "key", "left_semi").select("key", "digest", "class", "n"), "open")
    bodies = texts(open_.select("digest").distinct())
    open_ = open_.join(nodes.select("digest", "bands", "signature"), "digest").join(bodies, "digest")
    edges = edges.union(stored(_joined(open_, shingle, likely, threshold), "links"))

    classes = components(edges)
    known = nodes.select("digest", "copy_id", "n_copies").join(classes, "digest", "left").withColumn(
        "class", F.coalesce("class", "digest")
    )
    groups = known.groupBy("class").agg(F.min("copy_id").alias("group_id"), F.sum("n_copies").alias("group_size"))
    known = stored(known.join(groups, "class"), "known")
    worded, bare = rows_of.where("n > 0").select("doc_id", "digest"), rows_of.where("n = 0")
    return worded.join(known, "digest").select(
        "doc_id", "digest", "copy_id", "group_id", "n_copies", "group_size", F.col("class").alias("class_digest")
    ).unionByName(
        bare.select(
            "doc_id", F.lit(None).cast("binary").alias("digest"), F.col("doc_id").alias("copy_id"),
            F.col("doc_id").alias("group_id"), F.lit(1).cast("long").alias("n_copies"),
            F.lit(1).cast("long").alias("group_size"), F.lit(None).cast("binary").alias("class_digest"),
        )
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents with one row left of every class, that with the least id; columns as given.

    Equal texts with an equal id differ in other columns at most; the least row of them by those columns stays. Rows
    without ids come after all others.
    """
    given = docs.columns
    id_, text = f"in_{options.get('id', 'doc_id')}", f"in_{options.get('text', 'text')}"
    docs = set_apart(docs)
    groups = stored(near_duplicates(docs, **(options | {"id": id_, "text": text})), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    kept = groups.where("class_digest is not null").groupBy("class_digest").agg(F.min(order).alias("first"))
    kept = kept.join(
        groups.where("class_digest is not null").groupBy("digest", "doc_id").agg(F.count("*").alias("rows")),
        F.col("first.digest").eqNullSafe(F.col("digest")) & F.col("first.doc_id").eqNullSafe(F.col("doc_id")),
    ).select(F.col("digest").alias("_digest"), F.col("doc_id").alias("_doc"), F.col("rows").alias("_rows"))
    kept = stored(kept, "kept")
    # rows of texts that are alone in their class stay where they are; only the others meet in a join
    several = groups.where("class_digest is not null and group_size > 1").select("digest").distinct()
    marked = docs.withColumn("_digest", F.unhex(F.md5(text_of(text).cast("binary")))).withColumn("_doc", F.col(id_).cast("long"))
    marked = _maybe(marked, stored(_marked(several), "several"), "_digest")
    has_word = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    names = docs.columns
    joined = marked.where(has_word & F.col("_in")).join(
        kept.withColumnsRenamed({"_digest": "_d", "_doc": "_i"}),
        (F.col("_digest") == F.col("_d")) & F.col("_doc").eqNullSafe(F.col("_i")),
    )
    single = joined.where("_rows = 1").select(names)
    repeated = joined.where("_rows > 1").groupBy("_digest").agg(F.min(F.struct(*names)).alias("row")).select("row.*")
    kept_rows = marked.where(~has_word | ~F.col("_in")).select(names).unionByName(single).unionByName(repeated)
    return put_back(kept_rows, given)
