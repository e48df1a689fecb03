"""Phrases against DuckDB and brute force."""

from collections import Counter

import numpy as np
import pytest

from accountwise.llm import collocations
from tests.compare import compare, duck
from tests.llm.conftest import SF


def brute(rows, least):
    counts: Counter = Counter()
    totals: Counter = Counter()
    for text, lang in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(c, "\n")
        for piece in text.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            totals[lang or "und"] += len(w)
            for m in range(1, 5):
                counts.update((lang or "und", tuple(w[k : k + m])) for k in range(len(w) - m + 1))
    out = {}
    candidates = {k: n for k, n in counts.items() if len(k[1]) > 1 and n >= least}
    for (lang, p), a in candidates.items():
        inside = any(
            x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * f >= 80 * a
            for (x, q), f in candidates.items())
        if not inside:
            s, k = min((2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-s, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, totals[lang], -s)
        for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:2000], 1))


def found(frame, **kw):
    rows = collocations.collocations(frame, **kw).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    return sorted(map(tuple, rows))


def test_statement_on_the_smallest_tables(spark):
    from accountwise.llm import registry

    got = registry.queries()["op12_hat_trie_collocations"](spark, SF)
    assert compare("op12", got, duck(SF), registry.statements()["op12_hat_trie_collocations"]) == "ok"


@pytest.fixture(scope="module")
def lines():
    rng = np.random.default_rng(4)
    some = ["de", "la", "mer", "Été", "the", "of", "x\x00y", "\x01", "ÀÉ", "i\xa0j", "w" * 300]
    out = []
    for k in range(120):
        words = [some[x] for x in np.minimum(rng.geometric(0.25, 60) - 1, len(some) - 1)]
        signs = [[" ", "  ", "\t", ". ", ",", "\r\n", "; "][x] for x in rng.choice(7, 60, p=[0.6, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05])]
        out.append(("".join(w + s for w, s in zip(words, signs)), [None, "und", "fr", "en"][k % 4]))
    return out + [(None, "en"), ("", None), (" \t . ,", "xx"), (" a b", "fr"), ("a b ", "fr")] + out[:9]


def test_brute_force(spark, lines):
    frame = spark.createDataFrame(lines, "text string, lang string").repartition(5)
    assert found(frame, least=5) == brute(lines, 5) != []


def test_spills_bursts_and_crowded_maps(spark, lines, monkeypatch):
    want = brute(lines, 5)
    monkeypatch.setattr(collocations, "HELD", 7)
    monkeypatch.setattr(collocations, "BITS", 7)
    monkeypatch.setattr(collocations.HatTrie.__init__, "__defaults__", (2, 2))
    assert found(spark.createDataFrame(lines, "text string, lang string").repartition(3), least=5) == want


def test_trie_holds_what_it_was_given():
    rng = np.random.default_rng(1)
    trie, want, got = collocations.HatTrie(burst=3, depth=2), Counter(), Counter()
    for _ in range(4000):
        ids = tuple(rng.integers(1, 9, rng.integers(1, 5)).tolist())
        root, n = int(rng.integers(0, 2)), int(rng.integers(1, 4))
        want[root, ids] += n
        trie.add(root, sum(k << 32 * at for at, k in enumerate(ids)), n)
        if trie.size > 500:
            before = trie.size
            for r, part in trie.spill(200):
                got.update({(r, ids): n for ids, n in part})
            assert trie.size <= before - 200
    for r, part in trie.spill(trie.size):
        got.update({(r, ids): n for ids, n in part})
    assert got == want and trie.size == 0


def test_odd_rows(spark, odd, empty):
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    assert found(odd, least=2) == brute(rows, 2)
    assert found(empty) == []
