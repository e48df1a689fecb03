"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary. A language is a probability for each piece; the probability of a word
is the sum over all its segmentations into pieces, by the forward algorithm, and that of a text the product over its
words. Piece probabilities are learned by expectation maximisation: forward and backward sums give the expected
count of every piece over all segmentations of the words of labelled texts. Words are runs of letters in lower
case, with the vocabulary's mark for a word's beginning. A character that no piece covers has one small
probability in every language.

The learned numbers are as many as pieces times languages, whatever the corpus. Training takes a bounded sample of
documents of each language (``sample``); every text is scored as a whole. Texts without a letter, or null, are
``und`` with score 0; so is everything if nothing is labelled. The score is the probability of the predicted language among those
learned, all languages being equally likely beforehand; ties go to the language first in order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwise.llm.texts import put_back, set_apart, stored, text_of, tidied, uniform

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: About so many documents of each language are learned from.
SAMPLE = 400
ROUNDS = 2
UNKNOWN = 1e-7
SMOOTH = 0.01
MARK = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
#: Longer words are summed one by one, with rescaling; shorter ones together, and remembered.
LONG = 32
REMEMBERED = 150_000


def letter_words(text: str) -> list[str]:
    found = LETTERS.findall(text.lower())
    if found and not found[0].isalpha():  # characters such as superscripts count as alphanumeric
        found = [w for w in found if any(map(str.isalpha, w))]
    return found


def pieces(vocabulary: str) -> dict[str, int]:
    """The pieces that lower-case words can contain."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    every = (model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k)))
    usable = [p for p in every if (p == MARK or p.removeprefix(MARK).isalpha()) and p == p.lower()]
    return {p: k for k, p in enumerate(dict.fromkeys(usable))}


class Lattice:
    """All segmentations of words. Row ``unknown`` of the probabilities is for characters without a piece, the one after for no edge."""

    def __init__(self, ids: dict[str, int]) -> None:
        self.ids = ids
        self.unknown, self.none = len(ids), len(ids) + 1
        self.longest = max((len(p) for p in ids), default=1)

    def places(self, n: int) -> list[tuple[int, int]]:
        """(end, length - 1) of the pieces that a word of n characters can have, in the order of the columns of edges."""
        return [(j, l) for j in range(n) for l in range(min(j + 1, self.longest))]

    def edges(self, words: list[str]) -> np.ndarray:
        """For words of one length: the piece at each place, or ``none``."""
        n, get, none = len(words[0]), self.ids.get, self.none
        cuts = [(j - l, j + 1) for j, l in self.places(n)]
        flat = np.fromiter((get(w[a:b], none) for w in words for a, b in cuts), dtype=np.int32, count=len(words) * len(cuts))
        out = flat.reshape(len(words), len(cuts))
        single = [k for k, (a, b) in enumerate(cuts) if b - a == 1]
        out[:, single] = np.where(out[:, single] == none, self.unknown, out[:, single])
        return out

    def forward(self, edges: np.ndarray, n: int, p: np.ndarray) -> np.ndarray:
        """Sums up to each place (0 to n), by place, word and column of p."""
        a = np.zeros((n + 1, len(edges), p.shape[1]))
        a[0] = 1
        for k, (j, l) in enumerate(self.places(n)):
            a[j + 1] += a[j - l] * p[edges[:, k]]
        return a

    def backward(self, edges: np.ndarray, n: int, p: np.ndarray) -> np.ndarray:
        b = np.zeros((n + 1, len(edges), p.shape[1]))
        b[n] = 1
        for k, (j, l) in reversed(list(enumerate(self.places(n)))):
            b[j - l] += b[j + 1] * p[edges[:, k]]
        return b

    def long_logs(self, word: str, p: np.ndarray) -> np.ndarray:
        """Log probability of one word of any length: the last sums are kept, rescaled at every step."""
        window, shift = [np.ones(p.shape[1])], np.zeros(p.shape[1])
        for j in range(len(word)):
            total = np.zeros(p.shape[1])
            for l in range(min(j + 1, self.longest)):
                at = self.ids.get(word[j - l : j + 1], self.unknown if l == 0 else self.none)
                if at != self.none:
                    total += window[-1 - l] * p[at]
            window = [*window[-self.longest :], total]
            window = [x / total for x in window]
            shift += np.log(total)
        return shift

    def logs(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """Log probabilities of words, by word and language."""
        out = np.empty((len(words), p.shape[1]))
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_length.setdefault(len(w), []).append(k)
        for n, ks in by_length.items():
            if n > LONG:
                for k in ks:
                    out[k] = self.long_logs(words[k], p)
                continue
            for c in range(0, len(ks), 4096):
                some = ks[c : c + 4096]
                out[some] = np.log(self.forward(self.edges([words[k] for k in some]), n, p)[n])
        return out


def _expected(words_of: DataFrame, ids: dict[str, int], p: np.ndarray, langs: list[str]) -> DataFrame:
    """(lang, piece, n): expected piece counts over all segmentations of the counted words."""
    shared = words_of.sparkSession.sparkContext.broadcast((ids, p))

    @tidied
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, prob = shared.value
        lattice = Lattice(known)
        sums = np.zeros(prob.shape)
        for frame in frames:
            frame = frame.assign(length=frame["word"].str.len())
            for (lang, n), part in frame[frame["length"] <= LONG].groupby(["lang", "length"]):
                k = langs.index(lang)
                column = prob[:, k : k + 1]
                for c in range(0, len(part), 4096):
                    some = part.iloc[c : c + 4096]
                    edges = lattice.edges(list(some["word"]))
                    a, b = lattice.forward(edges, n, column)[:, :, 0], lattice.backward(edges, n, column)[:, :, 0]
                    weight = some["n"].to_numpy() / a[n]
                    for place, (j, l) in enumerate(lattice.places(n)):
                        at = edges[:, place]
                        np.add.at(sums[:, k], at, weight * a[j - l] * column[at, 0] * b[j + 1])
        at, k = np.nonzero(sums[: len(known)])
        yield pd.DataFrame({"lang": [langs[x] for x in k], "piece": at, "n": sums[at, k]})

    spread = words_of.repartition(words_of.sparkSession.sparkContext.defaultParallelism, "word")
    return spread.mapInPandas(run, "lang string, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def learn(
    labelled: DataFrame, text: str = "text", lang: str = "lang", vocabulary: str = VOCABULARY, sample: int = SAMPLE,
    rounds: int = ROUNDS,
) -> tuple[dict[str, int], list[str], np.ndarray]:
    """Pieces, languages in order, and piece probabilities by piece and language."""
    ids = pieces(vocabulary)
    known = labelled.select(text_of(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null")
    sizes = {r["lang"]: r["docs"] for r in known.groupBy("lang").agg(F.count("*").alias("docs")).collect()}
    langs = sorted(sizes)
    share = F.lit(0.0)
    for name, docs in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(sample / docs)).otherwise(share)
    some = known.where(uniform(F.lit(3), F.col("text")) < share)

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1)):
                name = name.as_py()
                seen.update((name, MARK + w) for w in letter_words(value.as_py()))
        keys = list(seen)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([k[0] for k in keys], pa.string()), "word": pa.array([k[1] for k in keys], pa.string()),
            "n": pa.array([seen[k] for k in keys], pa.int64()),
        })

    counted = some.select("text", "lang").mapInArrow(count, "lang string, word string, n long")
    counted = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    p = np.full((len(ids) + 2, len(langs)), 1.0 / max(1, len(ids)))
    p[len(ids)], p[len(ids) + 1] = UNKNOWN, 0
    for _ in range(rounds if langs else 0):
        sums = np.full((len(ids), len(langs)), SMOOTH)
        for r in _expected(counted, ids, p, langs).collect():  # pieces times languages at most
            sums[r["piece"], langs.index(r["lang"])] += r["n"]
        p[: len(ids)] = sums / sums.sum(axis=0)
    return ids, langs, p


def predicted(docs: DataFrame, model: tuple[dict[str, int], list[str], np.ndarray], text: str, prefix: str = "lang_") -> DataFrame:
    """The documents, every row and column, with ``pred`` and ``score`` under the prefix."""
    langs = model[1]
    names = docs.columns
    at = names.index(text)
    shared = docs.sparkSession.sparkContext.broadcast((model[0], model[2]))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, p = shared.value
        lattice = Lattice(ids)
        place: dict[str, int] = {}
        table = np.empty((0, len(langs)))
        for batch in batches:
            column = batch.column(at)
            pred, score = [], []
            for lo in range(0, len(column), 256):
                part = [letter_words(v.as_py() or "") for v in column.slice(lo, 256)]
                new = [w for w in dict.fromkeys(w for doc in part for w in doc) if w not in place]
                if len(place) + len(new) > REMEMBERED:
                    new, table = list(dict.fromkeys(w for doc in part for w in doc)), table[:0]
                    place.clear()
                if new and langs:
                    place.update(zip(new, range(len(table), len(table) + len(new))))
                    table = np.concatenate([table, lattice.logs([MARK + w for w in new], p)])
                for doc in part:
                    if not doc or not langs:
                        pred.append("und")
                        score.append(0.0)
                        continue
                    logs = table[[place[w] for w in doc]].sum(axis=0)
                    logs -= logs.max()
                    best = int(np.argmax(logs))
                    pred.append(langs[best])
                    score.append(float(1.0 / np.exp(logs).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=[*names, f"{prefix}pred", f"{prefix}score"],
            )

    schema = docs.withColumn(f"{prefix}pred", F.lit("")).withColumn(f"{prefix}score", F.lit(0.0)).schema
    for field in schema.fields:
        field.nullable = True
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, learn_from: Column, id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; held_out: the row was not open to learning."""
    model = learn(docs.where(learn_from), text, lang, **options)
    slim = docs.select(F.col(id).cast("long").alias("doc_id"), (~learn_from).alias("held_out"), F.col(text).alias("text"))
    return predicted(slim, model, "text").select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def recognised(docs: DataFrame, learn_from: Column, text: str = "text", lang: str = "lang", least: float = 0.5, **options) -> DataFrame:
    """The documents whose language is recognised with at least the given probability; columns as given."""
    model = learn(docs.where(learn_from), text, lang, **options)
    kept = predicted(set_apart(docs), model, f"in_{text}", "_lang_")
    return put_back(kept.where((F.col("_lang_pred") != "und") & (F.col("_lang_score") >= least)), docs.columns)
