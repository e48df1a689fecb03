"""Licence scan against regular expressions and a plain search."""

import re

import pytest

from accountwise.llm import licences, texts
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base(text):
    words = WORD.findall(lowered(text))
    at, labels = [], set()
    for phrase, label in licences.PHRASES:
        p = phrase.split()
        hits = [k for k in range(len(words)) if words[k : k + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def check(frame):
    rows = frame.collect()
    got = licences.digest(licences.scan(frame)).collect()
    assert len(got) == len(rows)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r["doc_id"], *base(r["text"])) for r in rows], key=key) == sorted(
        [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got], key=key)
    for r in got:
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
    return got


def test_base_and_labels_of_the_documents(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        docs = texts.tables(spark, sf, "documents")
        rows, got = docs.collect(), check(docs)
        by_id = {r["doc_id"]: r for r in got}
        assert all(("cc-by-nc" in by_id[r["doc_id"]]["labels"].split(",")) == ("Licensed under CC BY-NC 4.0." in (r["text"] or "")) for r in rows)
        assert any(r["labels"] for r in got)


def test_odd_rows(spark, odd, empty):
    check(odd)
    assert licences.digest(licences.scan(empty)).count() == 0
    tricky = ["mit license mit license", "MIT\x00LICENSE", "mit licenseé", "é mit-license", "mit", "general public", "license general public license",
              "x" * 100_000 + " mit license", "\x7fapache {license}", "K mit license", "mit license " * 20_000]
    check(spark.createDataFrame(list(enumerate(tricky)), "doc_id long, text string"))


def longest(templates, words, end):
    """The longest run that ends there and stands in a template, by looking everywhere."""
    best = 0
    for t in templates:
        for stop in range(1, len(t) + 1):
            n = 0
            while n < min(stop, end) and t[stop - 1 - n] == words[end - 1 - n]:
                n += 1
            best = max(best, n)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_automaton_against_search(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    templates = [rng.integers(0, 3, rng.integers(3, 12)).tolist() for _ in range(4)]
    words = rng.integers(0, 4, 60).tolist()
    automaton = licences.Automaton(templates)
    stats = [longest(templates, words, end) for end in range(len(words) + 1)]
    want = [(e, stats[e]) for e in range(1, len(words) + 1) if stats[e] >= 2 and (e == len(words) or stats[e + 1] <= stats[e])]
    got = list(automaton.matches(words, 2))
    assert [(e, n) for e, n, _ in got] == want
    for end, n, state in got:
        run = words[end - n : end]
        assert automaton.ends[state] == {(t, k) for t, body in enumerate(templates) for k in range(n, len(body) + 1) if body[k - n : k] == run}


def brute_chain(matches):
    best = 0
    def go(k, end, high, score):
        nonlocal best
        best = max(best, score)
        for j in range(k, len(matches)):
            s, e, low, top = matches[j]
            if s >= end and low >= high:
                go(j + 1, e, top, score + e - s)
    go(0, 0, 0, 0)
    return best


@pytest.mark.parametrize("seed", range(20))
def test_best_chain_against_all_chains(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    matches = []
    for _ in range(10):
        s, low, n = rng.integers(0, 40), rng.integers(0, 24), rng.integers(1, 7)
        matches.append((int(s), int(s + n), int(low), int(low + n)))
    chain = licences.best_chain(sorted(matches), 30)
    assert sum(e - s for s, e, *_ in chain) == brute_chain(sorted(matches))
    assert all(a[1] <= b[0] and a[3] <= b[2] for a, b in zip(chain, chain[1:]))


def test_changed_and_repeated_templates(spark):
    mit = licences.TEMPLATES[0][1]
    changed = mit.replace("free of charge", "at no cost").replace("NONINFRINGEMENT", "anything else")
    half = " ".join(mit.split()[: len(mit.split()) // 2])
    frame = spark.createDataFrame(
        [(0, mit), (1, "start " * 50 + changed + " end" * 9), (2, half), (3, (changed + "\n") * 40), (4, "nothing of the kind to see here")],
        "doc_id long, text string")
    got = {r["doc_id"]: r for r in licences.scan(frame).collect()}
    assert [len(got[k]["spans"]) for k in range(5)] == [1, 1, 0, 40, 0]
    assert got[0]["best_share"] == 1 and 0.9 < got[1]["best_share"] < 1 and 0.4 < got[2]["best_share"] < 0.6 and got[4]["best_share"] == 0
    assert got[1]["spans"][0]["start"] == 50
    assert {r["doc_id"]: r["labels"] for r in licences.digest(licences.scan(frame)).collect()} == {0: "mit", 1: "mit", 2: "", 3: "mit", 4: ""}
