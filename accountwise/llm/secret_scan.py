"""Secrets in texts: fixed rules, and Markov models of random strings against ordinary identifiers.

The rules find assignments to a key word, access keys and long hexadecimal runs. Beyond them every run of 16 or more
characters of [A-Za-z0-9+/_=-] with a letter is a candidate. Two character Markov models of first order give its
log-likelihood ratio: one learned from what the rules find (random strings), one from the candidates apart
from it (ordinary identifiers). ``SMOOTH`` counts are added to each transition: few for random strings, many for ordinary
ones, so that the odd secret which no rule finds doesn't make its transitions ordinary. A ratio of at least ``ODDS`` (natural
logarithm) marks a secret of kind ``markov``; it does not touch a span of a rule. All of it is Spark expressions;
the models are 67 x 67 numbers.

A null text is empty. Empty texts have no span. Repeated rows are scanned each. Places are code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwise.llm import spans
from accountwise.llm.texts import stored, text_of, uniform

#: The rules of the contract.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 20
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
ODDS = math.log(1e4)
#: Counts added to each transition, by label: random, ordinary.
SMOOTH = {True: 0.5, False: 20.0}
#: About so many strings of each label are learned from.
SAMPLE = 50_000


def _rules(text: Column) -> dict[str, Column]:
    low = F.lower(text)
    worded = F.lit(False)
    for w in WORDS:
        worded = worded | F.contains(low, F.lit(w))
    none = spans.none_found()
    assign = F.filter(spans.found(text, ASSIGN, 2), lambda m: F.length(m["part"]) >= ASSIGN_LEAST)
    access = F.filter(spans.found(text, ACCESS), lambda m: m["end"] - m["start"] >= ACCESS_LEAST)
    return {
        "_assign": F.when(worded, assign).otherwise(none),
        "_access": F.when(F.contains(text, F.lit("AKIA")), access).otherwise(none),
        "_hex": F.when(text.rlike(HEX), spans.found(text, HEX)).otherwise(none),
    }


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with _assign, _access, _hex, _base (their spans in order) and _candidates (apart from those)."""
    out = docs.withColumns(_rules(text_of(text)))
    base = F.array_sort(F.concat(spans.spans(F.col("_assign"), 0), spans.spans(F.col("_access"), 1), spans.spans(F.col("_hex"), 2)))
    out = out.withColumn("_base", base)
    some = F.when(
        text_of(text).rlike(CANDIDATE),
        spans.apart(F.filter(spans.found(text_of(text), CANDIDATE), lambda m: m["text"].rlike("[A-Za-z]")), F.col("_base")),
    ).otherwise(spans.none_found())
    return out.withColumn("_candidates", some)


def learn(samples: DataFrame) -> list[float]:
    """Log-odds of each transition, random over ordinary, from (text, random): row-major over the alphabet."""
    twos = spans.bound(F.split("text", ""), lambda letters: F.transform(
        F.sequence(F.lit(1), F.size(letters) - 1), lambda i: F.concat(F.get(letters, i - 1), F.get(letters, i))))
    pairs = samples.where(F.length("text") > 1).select("random", F.explode(twos).alias("two"))
    n = len(ALPHABET)
    counts = {label: [added] * (n * n) for label, added in SMOOTH.items()}
    place = {c: k for k, c in enumerate(ALPHABET)}
    for r in pairs.groupBy("random", "two").agg(F.count("*").alias("n")).collect():  # transitions times two at most
        if r["two"][0] in place and r["two"][1] in place:
            counts[r["random"]][place[r["two"][0]] * n + place[r["two"][1]]] += r["n"]
    logs = {k: [math.log(x / sum(c[i // n * n : i // n * n + n])) for i, x in enumerate(c)] for k, c in counts.items()}
    return [a - b for a, b in zip(logs[True], logs[False])]


def labelled(found: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, random): what the rules found, and candidates apart from it; about ``sample`` of each."""
    values = F.concat(
        F.transform("_assign", lambda m: F.struct(m["part"].alias("text"), F.lit(True).alias("random"))),
        F.transform(F.concat("_access", "_hex"), lambda m: F.struct(m["text"].alias("text"), F.lit(True).alias("random"))),
        F.transform("_candidates", lambda m: F.struct(m["text"].alias("text"), F.lit(False).alias("random"))),
    )
    every = found.select(F.explode(values).alias("s")).select("s.*")
    sizes = {r["random"]: r["n"] for r in every.groupBy("random").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("random") == label, F.lit(sample / n)).otherwise(share)
    return every.where(uniform(F.lit(11), F.col("text")) < share)


def ratio(token: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of a string under the models."""
    n = len(ALPHABET)
    odds = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    places = F.split(F.lit(",".join(str(ALPHABET.find(chr(c))) for c in range(128))), ",").cast("array<int>")
    codes = F.transform(F.split(token, ""), lambda c: F.get(places, F.ascii(c)))
    return spans.bound(codes, lambda at: F.aggregate(
        F.sequence(F.lit(1), F.size(at) - 1), F.lit(0.0), lambda s, i: s + F.get(odds, F.get(at, i - 1) * n + F.get(at, i))))


def judged(found: DataFrame, model: list[float], odds: float = ODDS) -> DataFrame:
    """The scanned rows with _spans: all spans in order."""
    marked = F.filter("_candidates", lambda m: ratio(m["text"], model) >= odds)
    return found.withColumn("_spans", F.array_sort(F.concat("_base", spans.spans(marked, 3))))


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", odds: float = ODDS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base, spans) for every row; base and spans are arrays of structs."""
    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = stored(scanned(slim).drop("text"), "secrets")
    return judged(found, learn(labelled(found)), odds).select(
        "doc_id", *(F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        (F.size("_spans") - F.size("_base")).cast("long").alias("n_markov"),
        F.col("_base").alias("base"), F.col("_spans").alias("spans"),
    )


def digest(scan_rows: DataFrame) -> DataFrame:
    """The scan with base_sha256 and spans as text."""
    return scan_rows.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(spans.listed(F.col("base"), KINDS), 256).alias("base_sha256"),
        spans.listed(F.col("spans"), KINDS).alias("spans"), "n_markov",
    )


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", odds: float = ODDS) -> DataFrame:
    """The documents, columns as given, with a mark in place of every secret."""
    model = learn(labelled(stored(scanned(docs.select(F.col(text).alias("text"))).drop("text"), "secrets")))
    inner = docs.withColumnsRenamed({c: f"_in_{c}" for c in docs.columns})
    out = judged(scanned(inner, f"_in_{text}"), model, odds)
    out = out.withColumn(f"_in_{text}", F.when(F.size("_spans") > 0, spans.masked(F.col(f"_in_{text}"), F.col("_spans"), [mark] * len(KINDS))).otherwise(F.col(f"_in_{text}")))
    return out.select(*(F.col(f"_in_{c}").alias(c) for c in docs.columns))
