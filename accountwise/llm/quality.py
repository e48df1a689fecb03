"""Quality rules: decision lists learned by sequential covering.

Statistics of whole texts are Spark expressions. From a bounded sample of labelled documents (``SAMPLE``) a list of rules
is learned: a rule is a conjunction of thresholds grown one by one for the largest information gain on two thirds
of the documents that no earlier rule covers, and pruned on the rest from its end while (p - n) / (p + n) doesn't fall. A rule
stays if it is right for at least ``PRECISION`` of the documents it covers in the pruning part; the first that
doesn't ends the list. The list becomes one conditional expression: the first rule that holds rejects a document.

A null text has no words. Documents without words fail the base rule. Without labels of both kinds the list is empty. Several labels of
a document: the worst counts. Repeated rows are judged each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwise.llm.texts import text_of, uniform, words

SAMPLE = 20_000
PRECISION = 0.95
RULES = 16
CONDITIONS = 4
#: A rule must cover so many bad documents of the growing part.
SUPPORT = 3
WINDOW = 5

#: A condition: feature, whether the value must be at least the threshold (else at most), threshold.
Condition = tuple[str, bool, float]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Computes a value once for each row and uses it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: neighbours in the sorted windows are equal; overlaps count once."""

    def places(s: Column) -> Column:
        same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
        marked = F.transform(
            s, lambda x, j: F.when(same(F.get(s, j - 1), x) | same(F.get(s, j + 1), x), x["i"])
        )
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    at = _let(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), places)
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        at, start,
        lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(a["end"], i)).cast("long").alias("n")),
        lambda a: a["n"],
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and a few more, with _ before."""
    body = text_of(text)
    out = docs.withColumn("_words", words(text))
    out = out.withColumn("_n_words", F.size("_words").cast("long"))
    hashed = F.transform(
        F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))
    )
    out = out.withColumn("_windows", F.when(F.size("_words") > WINDOW, hashed).otherwise(F.array().cast("array<long>")))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("_lines", lines)
    repeated = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), _covered(F.col("_windows")))
    count = lambda signs: F.length(F.regexp_replace(body, f"[^{signs}]+", "")).cast("long")
    return out.withColumns({
        "_word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "_n_symbols": count(r"#*$%&|<>"),
        "_n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_repeat_words": F.coalesce(repeated, F.lit(0)).cast("long"),
        "_n_lines": F.size("_lines").cast("long"),
        "_n_upper": count(r"\p{Lu}"),
        "_n_digits": count("0-9"),
        "_n_exclaimed": count("!?"),
    }).drop("_words", "_windows", "_lines")


FEATURES = ("words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "exclaimed")


def feature(name: str) -> Column:
    per = lambda x, of: F.col(x) / F.greatest(F.col(of), F.lit(1))
    return {
        "words": F.col("_n_words").cast("double"), "word_length": per("_word_chars", "_n_words"),
        "symbols": per("_n_symbols", "_word_chars"), "dup_lines": per("_n_dup_lines", "_n_lines"),
        "repeats": per("_n_repeat_words", "_n_words"), "upper": per("_n_upper", "_word_chars"),
        "digits": per("_n_digits", "_word_chars"), "exclaimed": per("_n_exclaimed", "_word_chars"),
    }[name]


# ---- the learner: a few thousand rows of statistics

def _holds(x: np.ndarray, rule: Sequence[Condition]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for name, least, value in rule:
        column = x[:, FEATURES.index(name)]
        out &= column >= value if least else column <= value
    return out


def _grow(x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    covered = np.ones(len(x), dtype=bool)
    while len(rule) < CONDITIONS and (covered & ~bad).any():
        p0, n0 = (covered & bad).sum(), (covered & ~bad).sum()
        best, gain = None, 1e-9
        for k, name in enumerate(FEATURES):
            values = np.unique(np.quantile(x[covered & bad, k], np.linspace(0, 1, 33)))
            for value in values:
                for least in (True, False):
                    hold = covered & (x[:, k] >= value if least else x[:, k] <= value)
                    p, n = (hold & bad).sum(), (hold & ~bad).sum()
                    if p < SUPPORT:
                        continue
                    g = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                    if g > gain:
                        best, gain = (name, least, float(value)), g
        if best is None:
            break
        rule.append(best)
        covered &= _holds(x, [best])
    return rule


def learn_list(x: np.ndarray, bad: np.ndarray, seed: int = 7) -> list[list[Condition]]:
    """Ordered rules that tell bad documents, from their features."""
    part = np.random.default_rng(seed).random(len(x)) < 2 / 3
    left = np.ones(len(x), dtype=bool)
    rules: list[list[Condition]] = []
    while len(rules) < RULES and (left & part & bad).sum() >= SUPPORT and (~bad).any():
        rule = _grow(x[left & part], bad[left & part])
        px, pb = x[left & ~part], bad[left & ~part]

        def worth(r: Sequence[Condition]) -> float:
            hold = _holds(px, r)
            p, n = (hold & pb).sum(), (hold & ~pb).sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hold = _holds(px, rule)
        if not rule or not hold.any() or pb[hold].mean() < PRECISION:
            break
        rules.append(rule)
        left &= ~_holds(x, rule)
    return rules


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> list[list[Condition]]:
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(id).cast("long").alias("_id")).agg(F.min(F.col(label).cast("int")).alias("_good"))
    total = known.count()
    some = known.where(uniform(F.lit(23), F.col("_id")) < F.lit(sample / max(1, total)))
    # about ``sample`` rows of two numbers: a bounded broadcast
    read = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("text")).join(F.broadcast(some), "_id")
    read = measured(read, "text").where(F.col("_n_words") > 0)
    rows = sorted(read.select("_id", "_good", *(feature(f).alias(f) for f in FEATURES)).collect())
    if not rows:
        return []
    x = np.array([tuple(r)[2:] for r in rows], dtype=float)
    return learn_list(x, np.array([r["_good"] == 0 for r in rows]))


def verdict(rules: Sequence[Sequence[Condition]]) -> Column:
    """The list as a conditional expression: false where a rule rejects the document."""
    out = F.when(F.lit(False), F.lit(True))
    for rule in rules:
        holds = F.lit(True)
        for name, least, value in rule:
            holds = holds & (feature(name) >= value if least else feature(name) <= value)
        out = out.when(holds, F.lit(False))
    return out.otherwise(F.lit(True))


def judged(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) for every row."""
    rules = learn(docs, labels, id, text, label)
    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    m = measured(slim).drop("text")
    failed = (F.col("_n_words") < 10) | (100 * F.col("_n_repeat_words") > 20 * F.col("_n_words"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return m.select(
        "doc_id", *(F.col(f"_{c}").alias(c) for c in names), failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept")
    )
