"""Toxicity: Levenshtein automata over a lexicon trie, and context windows that tell quotation from abuse.

The lexicon is learned: words, and beginnings of words of four to six letters, that occur in far more labelled toxic
documents than in others, by a likelihood-ratio test over the classes of near copies of each label (those of ``near_dedup``),
one document of each. A word of a text
is compared with the terms, one edit allowed from five letters, two from ten: terms of at most one edit are found by
what a word and they have in common without one letter, for those of two edits the word is run as a Levenshtein
automaton against their trie.
A term at an edit distance has a weight of its own, its log-odds among the labelled documents, so that ordinary words near a term
don't count. At a distance that no labelled document has, the weight is the log-odds of the term less a penalty for each edit, the
mean loss of the distances that were seen. Words with digits or signs inside are run as they stand, and by their runs of letters if
that finds nothing. A hit is quoted if a quotation mark opens before it and closes after it within 80 characters. A logistic
regression over the sums of weights outside and inside quotations, the largest weight and the hits by length gives
the score.

Labels are learned from a bounded sample (``TOXIC`` and ``CLEAN`` documents about), which bounds the lexicon. Every text is scored as a whole. Null and empty texts have no hit and get the score of a text without one. If one
of the two labels is missing, every score is the share of toxic labels (0 without labels). A document with several
labels is toxic if one says so; labels without a document are ignored. Repeated rows are scored each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwise.llm import near_dedup
from accountwise.llm.language import LETTERS
from accountwise.llm.texts import stored, text_of, uniform

TOXIC, CLEAN = 2_000, 8_000
#: Least likelihood ratio (twice the gain in nats) of a lexicon entry.
EVIDENCE = 20.0
LEAST_WEIGHT = 1.0
#: Log-odds that an edit costs, as if one term had shown it.
EDIT_PENALTY = 1.0
WINDOW = 80
REMEMBERED = 300_000
#: Runs of letters, and those that digits or signs join.
TOKENS = re.compile(r"[^\W\d_]++(?:[0-9*@$!#+|&%^~_.-]++[^\W\d_]++)*")
OPENS = re.compile(r"(?:^|[\s(\[])[\"'“„«‘][^\"“”„«»]*$")
CLOSES = re.compile(r"^[^\"“”„«»]*?[\"'”“»’](?:[\s.,;:!?)\]]|$)")


def edits(length: int) -> int:
    return 0 if length < 5 else 1 if length < 10 else 2


class Node:
    """A trie node: children, the terms that end here, and the edits that some term below allows."""

    __slots__ = ("children", "ends", "allowed")

    def __init__(self) -> None:
        self.children: dict[str, Node] = {}
        self.ends: list[int] = []
        self.allowed = 0


def shortened(word: str) -> Iterator[str]:
    """The word, and the word without one of its letters; words one edit apart have one of these in common."""
    yield word
    for i in range(len(word)):
        yield word[:i] + word[i + 1 :]


class Lexicon:
    """A trie of terms. A term that ends in * is the beginning of a word."""

    def __init__(self, terms: list[str]) -> None:
        self.open = [t.endswith("*") for t in terms]
        self.root = Node()
        parts: dict[tuple[int, int], set[str]] = {}
        self.terms = [t.removesuffix("*") for t in terms]
        #: Terms of at most one edit by what is left without a letter: whole words, and beginnings with their lengths in a word.
        self.whole: dict[str, list[int]] = {}
        self.begin: dict[str, list[int]] = {}
        lengths: set[int] = set()
        for k, term in enumerate(terms):
            word = term.removesuffix("*")
            e, node = edits(len(word)), self.root
            if e < 2:
                for v in set(shortened(word)) if e else (word,):
                    (self.begin if self.open[k] else self.whole).setdefault(v, []).append(k)
                if self.open[k]:
                    lengths.update(range(len(word) - e, len(word) + e + 1))
                continue
            for c in word:
                node.allowed = max(node.allowed, e)
                node = node.children.setdefault(c, Node())
            node.allowed = max(node.allowed, e)
            node.ends.append(k)
            # of e + 1 parts of a term one is untouched by e edits, and at most e places away from where it was
            cut = [round(len(word) * i / (e + 1)) for i in range(e + 2)]
            for a, b in zip(cut, cut[1:]):
                for at in range(max(0, a - e), a + e + 1):
                    parts.setdefault((at, at + b - a), set()).add(word[a:b])
        self.lengths = sorted(lengths)
        self.parts = [(a, b, known) for (a, b), known in parts.items()]
        # letters after these change nothing: no term allows three edits
        self.longest = max((len(t) for t in terms), default=0) + 3

    def possible(self, word: str) -> bool:
        for a, b, known in self.parts:
            if word[a:b] in known:
                return True
        return False

    def distance(self, k: int, word: str) -> int:
        """Edits from a term of at most one edit, 2 for more than that."""
        term = self.terms[k]
        if word == term or self.open[k] and word.startswith(term):
            return 0
        i = 0
        while i < len(term) and i < len(word) and term[i] == word[i]:
            i += 1
        rests = (term[i + 1 :], word[i + 1 :]), (term[i:], word[i + 1 :]), (term[i + 1 :], word[i:])
        return 1 if any(b.startswith(a) if self.open[k] else a == b for a, b in rests) else 2

    def near(self, word: str) -> tuple[int, int] | None:
        """(term, edits): the nearest term within its allowance, the longest and first of equals."""
        found: set[int] = set()
        if len(word) <= self.longest:
            for v in shortened(word):
                found.update(self.whole.get(v, ()))
        for n in self.lengths:
            for v in shortened(word[:n]):
                found.update(self.begin.get(v, ()))
        close = ((self.distance(k, word), -len(self.terms[k]), k) for k in found)
        best = min((x for x in close if x[0] <= edits(-x[1])), default=None)
        stack = [] if not self.possible(word) else [(self.root, list(range(len(word) + 1)), 0)]
        while stack:
            node, row, depth = stack.pop()
            for k in node.ends:
                distance = min(row) if self.open[k] else row[-1]
                if distance <= edits(depth):
                    one = (distance, -depth, k)
                    best = one if best is None else min(best, one)
            for c, child in node.children.items():
                # the automaton of the word reads c; states further than the allowance from the diagonal are dead
                allowed = child.allowed
                low, high = max(1, depth + 1 - allowed), min(len(word), depth + 1 + allowed)
                dead = allowed + 1
                new = [dead] * len(row)
                new[0] = depth + 1
                least = new[0] if low == 1 else dead
                for j in range(low, high + 1):
                    cost = row[j - 1] + (word[j - 1] != c)
                    if row[j] + 1 < cost:
                        cost = row[j] + 1
                    if new[j - 1] + 1 < cost:
                        cost = new[j - 1] + 1
                    new[j] = cost
                    if cost < least:
                        least = cost
                if least <= allowed:
                    stack.append((child, new, depth + 1))
        return None if best is None else (best[2], best[0])


def entries(words: set[str]) -> set[str]:
    """Words, and beginnings of longer words."""
    return words | {f"{w[:n]}*" for w in words for n in (4, 5, 6) if len(w) > n}


def one_of_each(sample: DataFrame) -> DataFrame:
    """(text, toxic, key) of (_id, text, toxic): of the near copies of a label the row with the least id and text."""
    least = F.min(F.struct("_id", "text")).alias("row")
    exact = sample.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary")))).groupBy("digest", "toxic").agg(least)
    exact = stored(exact.select("digest", "toxic", "row._id", "row.text"), "toxic-texts")
    classes = near_dedup.near_duplicates(exact, id="_id").where("class_digest is not null").select("digest", "class_digest").distinct()
    key = F.coalesce("class_digest", "digest").alias("key")
    apart = exact.join(classes, "digest", "left").select("_id", "text", "toxic", key)
    return apart.groupBy("key", "toxic").agg(least).select("row.text", "toxic", "key")


class Finder:
    """Hits of a lexicon in texts, remembering words it has met."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.met: set[str] = set()
        #: (start, end, term, edits) by token; a token of several runs of letters that is no hit itself has those of its runs.
        self.hit: dict[str, list[tuple[int, int, int, int]]] = {}
        self.runs: dict[str, int] = {}

    def meet(self, token: str) -> None:
        near = lambda w: self.lexicon.near(w[: self.lexicon.longest])
        runs = list(LETTERS.finditer(token))
        if len(runs) > 1:
            self.runs[token] = len(runs)
            found = near(token)
            if found:
                self.hit[token] = [(0, len(token), *found)]
                return
        own = [(m.start(), m.end(), *found) for m in runs if (found := near(m.group()))]
        if own:
            self.hit[token] = own

    def hits(self, text: str) -> tuple[int, list[tuple[int, int, bool]]]:
        """The number of runs of letters, and (term, edits, quoted) of each hit."""
        low = text.lower()
        tokens = TOKENS.findall(low)
        own = set(tokens)
        if len(self.met) > REMEMBERED:
            self.met.clear()
            self.hit.clear()
            self.runs.clear()
        new = own - self.met
        for w in new:
            self.meet(w)
        self.met |= new
        words = len(tokens)
        if not own.isdisjoint(self.runs):
            words += sum(self.runs[w] - 1 for w in tokens if w in self.runs)
        if own.isdisjoint(self.hit):
            return words, []
        out = []
        for m in TOKENS.finditer(low):
            for a, b, term, e in self.hit.get(m.group(), ()):
                first, last = m.start() + a, m.start() + b
                quoted = OPENS.search(low[max(0, first - WINDOW) : first]) and CLOSES.search(low[last : last + WINDOW])
                out.append((term, e, bool(quoted)))
        return words, out


def default_weights(
    terms: list[str], odds: list[float], seen: dict[tuple[int, int], float],
) -> dict[tuple[int, int], float]:
    """Weights of terms at the distances that no labelled document has; ``odds`` are the terms' log-odds, ``seen`` those of the others."""
    lost = [(odds[t] - w) / e for (t, e), w in seen.items() if e]
    penalty = max(0.0, (EDIT_PENALTY + sum(lost)) / (1 + len(lost)))
    every = ((k, e) for k, t in enumerate(terms) for e in range(edits(len(t.removesuffix("*"))) + 1))
    return {(k, e): w for k, e in every if (k, e) not in seen and (w := odds[k] - penalty * e) >= LEAST_WEIGHT}


def features(words: int, hits: list[tuple[int, int, bool]], weights: dict[tuple[int, int], float]) -> list[float]:
    own = [(weights.get((term, e), 0.0), quoted) for term, e, quoted in hits]
    plain, said = [w for w, q in own if not q and w], [w for w, q in own if q and w]
    return [
        1.0, math.log1p(sum(plain)), max(plain, default=0.0), math.log1p(sum(said)),
        100.0 * len(plain) / (words + 100.0),
    ]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method; the intercept is not penalised."""
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def learn(docs: DataFrame, labels: DataFrame, open_ids: Column, id: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple:
    """(terms, weights, coefficients, share): what scoring needs, bounded by the lexicon."""
    known = labels.where(open_ids & F.col(id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(id).cast("long").alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_toxic"))
    sizes = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if not sizes.get(1) or not sizes.get(0):
        return [], {}, None, share
    part = F.when(F.col("_toxic") == 1, F.lit(TOXIC / sizes[1])).otherwise(F.lit(CLEAN / sizes[0]))
    some = known.where(uniform(F.lit(17), F.col("_id")) < part)
    # about TOXIC + CLEAN rows of two numbers: a bounded broadcast
    read = docs.select(F.col(id).cast("long").alias("_id"), text_of(text).alias("text")).join(F.broadcast(some), "_id")

    sample = one_of_each(read.select("_id", "text", F.col("_toxic").alias("toxic")))
    spread = docs.sparkSession.sparkContext.defaultParallelism
    sample = stored(sample.repartition(spread, "key"), "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for v, t in zip(batch.column(0), batch.column(1).to_pylist()):
                seen[t].update(entries(set(LETTERS.findall(v.as_py().lower()))))
        keys = list(seen[1])
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(keys, pa.string()), "pos": pa.array([seen[1][k] for k in keys], pa.int64()),
            "neg": pa.array([seen[0][k] for k in keys], pa.int64()),
        })
        rest = [k for k in seen[0] if k not in seen[1]]
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(rest, pa.string()), "pos": pa.array([0] * len(rest), pa.int64()),
            "neg": pa.array([seen[0][k] for k in rest], pa.int64()),
        })

    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return [], {}, None, share
    counts = sample.select("text", "toxic").mapInArrow(count, "term string, pos long, neg long")
    counts = counts.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    p, q, both = F.col("pos").cast("double"), F.col("neg").cast("double"), float(n[1] + n[0])
    expected = (p + q) * F.lit(n[1] / both)
    evidence = 2 * (p * F.log(p / expected) + F.when(q > 0, q * F.log(q / (p + q - expected))).otherwise(0.0))
    found = counts.where(p > expected).withColumn("evidence", evidence).where(F.col("evidence") >= EVIDENCE)
    found = found.withColumn("odds", F.log((p + 0.5) / (q + 0.5) * F.lit(n[0] / n[1]))).where(F.col("odds") >= LEAST_WEIGHT)
    chosen = sorted(found.select("evidence", "term", "odds").collect(), key=lambda r: (-r["evidence"], r["term"]))
    terms, odds = [r["term"] for r in chosen], [r["odds"] for r in chosen]
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(Lexicon(shared.value))
        for batch in batches:
            toxic, words, term, near, said = [], [], [], [], []
            for v, t in zip(batch.column(0), batch.column(1).to_pylist()):
                count_, hits = finder.hits(v.as_py())
                toxic.append(t), words.append(count_)
                term.append([h[0] for h in hits]), near.append([h[1] for h in hits]), said.append([h[2] for h in hits])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(toxic, pa.int32()), pa.array(words, pa.int64()), pa.array(term, pa.list_(pa.int32())),
                    pa.array(near, pa.list_(pa.int32())), pa.array(said, pa.list_(pa.bool_())),
                ],
                names=["toxic", "words", "term", "near", "said"],
            )

    kind = "toxic int, words long, term array<int>, near array<int>, said array<boolean>"
    rows = [
        (r["toxic"], r["words"], list(zip(r["term"], r["near"], r["said"])))
        for r in sample.select("text", "toxic").mapInArrow(match, kind).collect()  # the bounded sample, without texts
    ]
    pos, neg = Counter(), Counter()
    for toxic, _, hits in rows:
        (pos if toxic else neg).update({(t, e) for t, e, _ in hits})
    told = {k: math.log((pos[k] + 0.5) / (neg[k] + 0.5) * n[0] / n[1]) for k in pos | neg}
    weights = {k: w for k, w in told.items() if k in pos and w >= LEAST_WEIGHT} | default_weights(terms, odds, told)
    x = np.array([features(words, hits, weights) for _, words, hits in rows])
    return terms, weights, fit(x, np.array([r[0] for r in rows], dtype=float)), share


def scored(
    docs: DataFrame, labels: DataFrame, open_ids: Column, id: str = "doc_id", text: str = "text", label: str = "toxic",
    threshold: float = 0.7,
) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits, n_quoted) for every row; ``open_ids`` tells which labels are learned."""
    terms, weights, beta, share = learn(docs, labels, open_ids, id, text, label)
    shared = docs.sparkSession.sparkContext.broadcast((terms, weights, beta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, w, b = shared.value
        finder = Finder(Lexicon(known))
        for batch in batches:
            score, hits_, said = [], [], []
            for v in batch.column(2):
                words, hits = finder.hits(v.as_py())
                hits = [h for h in hits if h[:2] in w]
                z = 0.0 if b is None else float(np.dot(b, features(words, hits, w)))
                score.append(share if b is None else 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                hits_.append(len(hits)), said.append(sum(h[2] for h in hits))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array(hits_, pa.int64()), pa.array(said, pa.int64())],
                names=["doc_id", "held_out", "score", "n_hits", "n_quoted"],
            )

    slim = docs.select(F.col(id).cast("long").alias("doc_id"), (~open_ids).alias("held_out"), text_of(text).alias("text"))
    out = slim.mapInArrow(run, "doc_id long, held_out boolean, score double, n_hits long, n_quoted long")
    return out.select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits", "n_quoted"
    )
