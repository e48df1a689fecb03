"""The operators against brute force on the smallest tables, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from accountwise.llm import (
    decontaminate, language, lengths, mixing, near_dedup, pitman_yor, quality, registry, sanitise, secret_scan, texts,
    toxicity,
)
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return texts.tables(spark, SF, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


def runs(text, n=5, short=True):
    w = WORD.findall(text or "")
    if short and 0 < len(w) < n:
        return Counter([tuple(w)])
    return Counter(zip(*(w[k:] for k in range(n))))


def similarity(x, y):
    common = sum((x & y).values())
    return common / (x.total() + y.total() - common)


# ---- helpers

def test_word_hashes_agree_with_words():
    column = pa.array(["a b  c", "", "\ta\n", "b a", "Ab", "ab"])
    h, o = texts.word_hashes(column)
    assert np.diff(o).tolist() == [3, 0, 1, 2, 1, 1]
    assert h[0] == h[3] == h[5] and h[1] == h[4] and h[6] != h[7]
    folded, _ = texts.word_hashes(column, fold=True)
    assert folded[6] == folded[7]


def test_slices_cover_sliced_arrays():
    column = pa.array(["x" * 700_000] * 4 + ["a b"]).slice(1)
    parts = list(texts.slices(column))
    assert parts[0][0] == 0 and parts[-1][1] == 4 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert texts.word_hashes(column.slice(3, 1))[1].tolist() == [0, 2]


# ---- 1

@pytest.mark.parametrize("most", [2, 3, 9, 40])
def test_bag_minhash_is_unbiased(most):
    off = []
    for seed in range(10):
        rng = np.random.default_rng(seed)
        wa, wb = rng.integers(0, most, 200), rng.integers(0, most, 200)
        names = texts.stream(1000 + seed, 200)
        e = np.concatenate([np.repeat(names, wa), np.repeat(names, wb)])
        d = np.repeat([0, 1], [wa.sum(), wb.sum()])
        s = near_dedup.bag_minhash(e, d, 2, 1000)
        off.append((s[0] == s[1]).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum())
    assert abs(np.mean(off)) < 0.02


def classes(rows):
    bags = {r["text"]: runs(r["text"]) for r in rows if WORD.search(r["text"] or "")}
    names, up = sorted(bags), {t: t for t in bags}

    def top(t):
        while up[t] != t:
            t = up[t]
        return t

    by_run = {}
    for t in names:
        for s in bags[t]:
            by_run.setdefault(s, []).append(t)
    pairs = {(a, b) for g in by_run.values() for i, a in enumerate(g) for b in g[i + 1 :]}
    for a, b in pairs:
        if similarity(bags[a], bags[b]) >= 0.8:
            up[top(a)] = top(b)
    return {t: top(t) for t in names}


def test_near_duplicates_match_brute_force(docs, rows):
    of = classes(rows)
    least = {}
    for r in rows:
        if r["text"] in of:
            least[of[r["text"]]] = min(least.get(of[r["text"]], math.inf), r["doc_id"])
    want = sorted((r["doc_id"], least[of[r["text"]]] if r["text"] in of else r["doc_id"]) for r in rows)
    got = near_dedup.near_duplicates(docs).select("doc_id", "group_id").collect()
    assert sorted(map(tuple, got)) == want
    kept = near_dedup.keep_one(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({g for _, g in want})


def test_blocks_join_what_leaders_miss(spark, monkeypatch):
    """Many texts that share a bucket but not a class, with close pairs among them, in blocks of a few."""
    core = [f"core{k}" for k in range(60)]
    bodies = []
    for k in range(40):
        rest = [f"own{k // 2}x{j}" for j in range(24)]
        bodies.append(" ".join(core + rest + ([f"tail{k}"] if k % 2 else [])))
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    frame = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    got = {r["doc_id"]: r["group_id"] for r in near_dedup.near_duplicates(frame).collect()}
    assert got == {k: k // 2 * 2 for k in range(40)}


def test_near_duplicates_of_odd_rows(odd, empty):
    got = near_dedup.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r["group_size"] for r in got if r["doc_id"] in (1, 2)} == {3}
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 1").count() == 1 and kept.where("doc_id = 2").count() == 0
    assert kept.count() == odd.count() - 2 and near_dedup.keep_one(empty).count() == 0


# ---- 2 and 7

def spans_of(kinds, text):
    out = []
    for k, (name, pattern, keep) in enumerate(kinds):
        out += [(m.start(), k, m.end(), name) for m in re.finditer(pattern, text) if keep(m)]
    return sorted(out)


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m.group())


SECRETS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 24),
]
PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]


def base_matches(got, frame, kinds):
    want = Counter()
    for r in frame.collect():
        found = spans_of(kinds, r["text"] or "")
        sha = hashlib.sha256(",".join(f"{n}:{a}:{b}" for a, _, b, n in found).encode()).hexdigest()
        want[(r["doc_id"], *(sum(n == k for *_, n in found) for k, *_ in kinds), sha)] += 1
    names = ["doc_id", *(f"n_{k}" for k, *_ in kinds), "base_sha256"]
    assert Counter(tuple(r) for r in got.select(names).collect()) == want


def test_secrets_base(docs, odd, empty):
    base_matches(secret_scan.digest(secret_scan.scan(docs)), docs, SECRETS)
    base_matches(secret_scan.digest(secret_scan.scan(odd)), odd, SECRETS)
    assert secret_scan.scan(empty).count() == 0


def test_secrets_of_the_models_and_redaction(spark):
    rng = np.random.default_rng(4)
    rand = lambda n: "".join(rng.choice(list("abcdefABCDEFGHJKMNPQRSTUVXYZ0123456789"), n))
    rows = [(k, f"see password={rand(20)} in thisordinarylongidentifier{'abc' * (k % 4)} here") for k in range(200)]
    rows.append((1000, f"😀 value Q{rand(30)} then configurationmanagerfactory"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secret_scan.digest(secret_scan.scan(frame)).collect()}
    assert got[1000] == "markov:8:39"
    masked = {r["doc_id"]: r["text"] for r in secret_scan.redacted(frame).collect()}
    assert masked[1000] == "😀 value [SECRET] then configurationmanagerfactory" and "password" not in masked[0]


def test_personal_base(docs, odd, empty):
    base_matches(sanitise.digest(sanitise.scan(docs)), docs, PERSONAL)
    base_matches(sanitise.digest(sanitise.scan(odd)), odd, PERSONAL)
    assert sanitise.scan(empty).count() == 0


def test_disclosing_terms(spark):
    rows = [(k, f"common words here number {k} and more common words") for k in range(40)]
    rows += [(100 + k, f"note {k} call Zorblax at joe@example.com about common words number {k}") for k in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in sanitise.sanitised(frame).collect()}
    assert "Zorblax" not in got[100] and "[EMAIL]" in got[100] and "common" in got[100] and got[3] == rows[3][1]


def disclosing_brute(rows):
    """Places of disclosing terms by row, straight from the definition; the rows' entities are e-mail addresses."""
    email, term = re.compile(PERSONAL[0][1]), re.compile(r"[^\W\d_]{3,}")
    texts_ = {t for _, t in rows}
    entities = {t: {m.group().lower() for m in email.finditer(t)} for t in texts_}
    words = {t: {m.group().lower() for m in term.finditer(t)} for t in texts_}
    df_e, df_t = Counter(e for s in entities.values() for e in s), Counter(w for s in words.values() for w in s)
    both = Counter((e, w) for t in texts_ for e in entities[t] for w in words[t])
    out = {}
    for k, t in rows:
        found = []
        for m in term.finditer(t):
            w, best = m.group().lower(), 0
            for e in entities[t]:
                p = df_e[e] / len(texts_)
                if p < 1:
                    best = max(best, math.log2((both[e, w] + sanitise.SMOOTH * p) / (df_t[w] + sanitise.SMOOTH) / p) / -math.log2(p))
            inside = any(m.start() < x.end() and x.start() < m.end() for x in email.finditer(t))
            if best >= sanitise.GENERALISE and not inside:
                found.append((m.start(), 5 if best >= sanitise.REMOVE else 4, m.end()))
        out.setdefault(k, []).append(found)
    return {k: sorted(v) for k, v in out.items()}


def test_disclosing_terms_match_brute_force(spark):
    draw = random.Random(5)
    vocabulary = [f"{a}{b}{c}" for a in "bdfg" for b in ("an", "ol", "ir") for c in "kmstv"] + ["rare" + "abcdefghij"[k] * 2 for k in range(10)]
    people = ["ann@x.org", "bob@y.com", "Cy@z.net", "dee@w.org"]
    rows = []
    for k in range(300):
        w = draw.choices(vocabulary, k=draw.randint(0, 12))
        who = draw.randint(0, 40)
        if who < 4:
            w += [people[who], "Known" + "abcd"[who], *["of"] * 5, "KNOWN" + "abcd"[who]]
        if who == 5:
            w += [f"only{k}@once.org", f"single{'xyz'[k % 3] * (k // 3)}"]
        rows.append((k, " ".join(w)))
    rows += [rows[3], (1000, ""), *[(1001 + k, "copied knownword at many@copies.org") for k in range(30)]]
    got = {}
    for r in sanitise.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], []).append([tuple(s) for s in r["spans"] if s["kind"] >= sanitise.RULES])
    want = disclosing_brute(rows)
    assert {k: sorted(v) for k, v in got.items()} == want
    assert {s[1] for v in want.values() for found in v for s in found} == {4, 5}


def test_a_disclosing_term_is_masked_wherever_it_stands(spark):
    rows = [(k, f"common words here number {k} and more common words") for k in range(400)]
    rows += [(1000 + k, f"Zorblax joe@example.com {'common words ' * 20 * (k + 1)} ask zorblax about number {k}") for k in range(4)]
    got = {r["doc_id"]: r["text"] for r in sanitise.sanitised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("zorblax" not in got[1000 + k].lower() and "common" in got[1000 + k] for k in range(4)) and got[7] == rows[7][1]


# ---- 3

def test_contaminations_match_brute_force(spark, docs, rows):
    items = texts.tables(spark, SF, "benchmark")
    want = []
    lowered = lambda t: set(runs((t or "").translate({c: c + 32 for c in range(65, 91)}), short=False))
    of_doc = [(r["doc_id"], lowered(r["text"])) for r in rows]
    for i in items.collect():
        own = lowered(i["text"])
        want += [(d, i["item_id"], len(own), len(own & s)) for d, s in of_doc if own and len(own & s) >= 0.8 * len(own)]
    got = decontaminate.contaminations(docs, items, block_chars=1500)
    assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(want) and want
    dirty = {w[0] for w in want}
    assert {r["doc_id"] for r in decontaminate.clean(docs, items).collect()} == {r["doc_id"] for r in rows} - dirty


def test_items_in_long_documents_and_odd_rows(spark, odd, empty):
    passage = " ".join(f"p{k}" for k in range(300))
    items = spark.createDataFrame([(1, passage), (2, None), (3, "too short"), (None, "word1 tail1 word2 tail2 word3 tail3 word4")], "item_id long, text string")
    long_doc = " ".join(["x y z"] * 5000 + [passage] + ["u v w"] * 5000)
    frame = odd.unionByName(spark.createDataFrame([(50, long_doc, "en", "a", 1, "q")], odd.schema))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(frame, items).collect()}
    assert got == {(50, 1), (7, None)}
    assert decontaminate.contaminations(empty, items).count() == 0
    assert decontaminate.clean(odd, items.where("false")).count() == odd.count()


# ---- 4

def test_mixture(docs, rows):
    got = mixing.mixed(docs).collect()
    size = Counter()
    for r in rows:
        size[r["source"]] += len(WORD.findall(r["text"] or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, rest = {}, set(order), 1.5 * sum(size.values())
    while open_:
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in full} if full else share
        rest -= sum(2.0 * size[s] for s in full)
        open_ = open_ - full if full else set()
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == size[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert sum(abs(taken[s] - target[s]) for s in size) < 0.05 * sum(target.values())
    again = mixing.mixed(docs.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mixture_of_odd_rows(odd, empty):
    got = mixing.mixed(odd).collect()
    assert len(got) == odd.count() and all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mixed(empty).count() == 0 and mixing.drawn(odd).columns == [*odd.columns, "mix_copies", "mix_target"]


def test_inclusion_is_near_its_probability(spark):
    rows = [(k, " ".join(["w"] * (1 + k % 40)), "s") for k in range(4000)] + [(9999, "v " * 200_000, "t")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(frame, weights=(1, 9), share=0.3).where("source = 's'").collect()
    one = [r["copies"] for r in got]
    assert 0 < sum(one) < len(one) or set(one) <= {0, 1, 2}


# ---- 5

def test_forward_sums_all_segmentations():
    ids = {p: k for k, p in enumerate(["▁", "▁a", "a", "b", "ab", "▁ab"])}
    p = np.array([[0.1], [0.2], [0.3], [0.15], [0.05], [0.2], [language.UNKNOWN], [0.0]])
    lattice = language.Lattice(ids)

    def brute(w):
        if not w:
            return 1.0
        return sum(p[ids[w[:n]], 0] * brute(w[n:]) for n in range(1, len(w) + 1) if w[:n] in ids)

    for w in ("▁ab", "▁aab", "▁abab", "▁ba"):
        assert np.exp(lattice.logs([w], p))[0, 0] == pytest.approx(brute(w))
        assert np.exp(lattice.long_logs(w, p))[0] == pytest.approx(brute(w))


def test_language_held_out(docs):
    got = language.identify(docs, texts.bucket("doc_id", 3) != 1).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r["lang"] == r["lang_pred"] for r in got if r["held_out"]]
    assert np.mean(held) > 0.95


def test_language_of_odd_rows(odd, empty):
    got = {r["doc_id"]: r for r in language.identify(odd, texts.bucket("doc_id", 3) != 9).collect()}
    assert len(got) and all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (3, 4, 5, 6))
    assert language.identify(empty, F.lit(True)).count() == 0
    assert language.recognised(odd, F.lit(True)).columns == odd.columns


# ---- 6

def test_quality_statistics(docs, rows, odd):
    for frame, every in ((docs, rows), (odd, odd.collect())):
        want = Counter()
        for r in every:
            t = r["text"] or ""
            w = WORD.findall(t)
            lines = [x for x in t.split("\n") if WORD.search(x)]
            seen = Counter(zip(*(w[k:] for k in range(5))))
            hit = {i + j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(5)}
            want[(r["doc_id"], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))] += 1
        got = quality.measured(frame.select("doc_id", "text"))
        cols = ["doc_id", "_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words"]
        assert Counter(tuple(r) for r in got.select(cols).collect()) == want


def test_decision_list_learns_conjunctions():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.FEATURES)))
    bad = (x[:, 2] > 0.8) | ((x[:, 0] < 0.3) & (x[:, 4] > 0.6))
    rules = quality.learn_list(x, bad)
    said = np.zeros(len(x), dtype=bool)
    for rule in rules:
        said |= quality._holds(x, rule)
    assert rules and (said == bad).mean() > 0.97
    assert quality.learn_list(x, np.zeros(3000, dtype=bool)) == []


def test_quality_without_labels(spark, odd, empty):
    labels = texts.tables(spark, SF, "labels").where("false")
    got = quality.judged(odd, labels).collect()
    assert len(got) == odd.count() and all(not r["kept"] for r in got if r["base_failed"])
    assert quality.judged(empty, labels).count() == 0


# ---- 8

def test_length_report(docs, rows):
    encode = lengths.encoder(lengths.VOCABULARY).encode_ordinary
    n = [len(encode(r["text"] or "")) for r in rows]
    for r in lengths.length_report(docs).collect():
        k = r["n_tokens"]
        longer = [x for x in n if x >= k]
        assert (r["docs"], r["docs_at_least"], r["tokens_at_least"]) == (n.count(k), len(longer), sum(longer))
        assert r["tokens_cut_here"] == sum(min(x, k) for x in n)
        assert r["share_up_to"] == pytest.approx(sum(x <= k for x in n) / len(n))


def test_lengths_of_odd_rows(odd, empty):
    assert sum(r["docs"] for r in lengths.length_report(odd).collect()) == odd.count()
    assert lengths.length_report(empty).count() == 0


# ---- 9

def test_base_score(docs, rows):
    train = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1]
    tokens = lambda r: [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(r["text"] or "")] + [None]
    c = Counter(t for r in train for t in tokens(r))
    n, v = c.total(), len(c)
    want = {r["doc_id"]: (len(tokens(r)), sum(c[t] > 0 for t in tokens(r)), sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(r))) for r in rows}
    got = pitman_yor.scored(docs, texts.bucket("doc_id", 5) != 1, head=500).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_tokens"], r["n_known"]) == want[r["doc_id"]][:2] and r["train_tokens"] == n
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][2]) and r["score"] < 0
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)


def test_seating_keeps_customers():
    rng = np.random.default_rng(1)
    c = np.array([1, 2, 5, 1000, 3])
    a = np.array([0.5, 0.1, 3.0, 20.0, 1e-9])
    sizes, begin = pitman_yor.first_seating(c, a, 0.7, rng)
    for _ in range(200):
        sizes, begin = pitman_yor.reseat(sizes, begin, c, a, 0.7, rng)
        assert (np.add.reduceat(sizes, begin[:-1]) == c).all() and (sizes > 0).all()
    assert np.diff(begin)[0] == 1


def test_gibbs_finds_the_posterior_of_two_customers():
    """Two customers of one dish share a table with odds (1 - d) : a."""
    rng = np.random.default_rng(2)
    n, a, d = 20_000, 0.6, 0.4
    c, pull = np.full(n, 2), np.full(n, a)
    sizes, begin = np.full(n, 2), np.arange(n + 1)
    for _ in range(20):
        sizes, begin = pitman_yor.reseat(sizes, begin, c, pull, d, rng)
    assert (np.diff(begin) == 1).mean() == pytest.approx((1 - d) / (1 - d + a), abs=0.02)


@pytest.mark.parametrize("blocks", (64, 5))  # one by one, and in blocks
def test_a_pass_reaches_every_customer(blocks, monkeypatch):
    """From one table, a few passes find the posterior of the number of tables, a**t times a generalised Stirling number."""
    monkeypatch.setattr(pitman_yor, "BLOCKS", blocks)
    rng, n, c, a, d = np.random.default_rng(3), 4000, 60, 30.0, 0.3
    ways = [0.0, 1.0] + [0.0] * c
    for k in range(1, c):
        ways = [0.0] + [ways[t - 1] + (k - d * t) * ways[t] for t in range(1, c + 2)]
        ways = [x / max(ways) for x in ways]
    share = np.array(ways[1 : c + 1]) * a ** np.arange(1, c + 1)
    want = (share * np.arange(1, c + 1)).sum() / share.sum()
    many, pull = np.full(n, c), np.full(n, a)
    sizes, begin = np.full(n, c), np.arange(n + 1)
    for _ in range(12):
        sizes, begin = pitman_yor.reseat(sizes, begin, many, pull, d, rng)
    assert np.diff(begin).mean() == pytest.approx(want, rel=0.01)
    assert (np.add.reduceat(sizes, begin[:-1]) == many).all()


def test_word_probabilities_sum_below_one(docs):
    scores, _ = pitman_yor.word_scores(docs, "text", F.lit(True))
    assert 0.5 < scores.agg(F.sum(F.pow(F.lit(10.0), "score"))).first()[0] <= 1.001


def test_score_depends_on_the_order_of_words(spark):
    rows = [(k, "one two three four five six") for k in range(50)] + [(100, "one two three four five six"), (101, "six two four one five three")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for head in (3, 1000):  # by joins, and inside tasks
        got = {r["doc_id"]: r for r in pitman_yor.scored(frame, F.col("doc_id") < 50, head=head).collect()}
        assert got[100]["base_score"] == pytest.approx(got[101]["base_score"]) and got[100]["score"] > got[101]["score"] + 4


def test_words_after_a_word_sum_below_one(docs):
    model = pitman_yor.seated_model(docs, "text", F.lit(True))
    total = pitman_yor.with_words(model.pairs, model.words.withColumn("p", F.pow(F.lit(10.0), "score")), 1000).where("c > 0")
    after = F.sum((F.col("c") - model.d * F.col("t")) / (1 + F.col("cu"))) + F.first((1 + model.d * F.col("tu")) / (1 + F.col("cu")))
    got = total.groupBy("u").agg(after.alias("p"), F.sum("c").alias("c"), F.sum("t").alias("t"), F.first("cu").alias("cu"), F.first("tu").alias("tu")).collect()
    assert got and all(r["p"] == pytest.approx(1) and r["c"] == r["cu"] and r["t"] == r["tu"] for r in got)


def test_model_of_odd_rows(odd, empty):
    assert pitman_yor.scored(odd, texts.bucket("doc_id", 5) != 1).count() == odd.count()
    assert pitman_yor.scored(odd, F.lit(False)).count() == odd.count()
    assert pitman_yor.scored(empty, F.lit(True)).count() == 0


# ---- 10

def test_trie_matches_edit_distance():
    terms = ["scum", "moron", "loser*", "worthless", "disgusting", "lowei*", "id*"]
    lexicon = toxicity.Lexicon(terms)

    def distance(a, b, open_):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return min(row) if open_ else row[-1]

    rng = np.random.default_rng(3)
    words = ["scum", "scumm", "morron", "mron", "lozers", "loserly", "wortless", "disgustng", "discustin", "xlowei", "lower", "idea", ""]
    words += ["".join(rng.choice(list("moronlserwti"), rng.integers(1, 9))) for _ in range(2000)]
    for w in words:
        near = [(e, -len(t.removesuffix("*")), k) for k, t in enumerate(terms) if (e := distance(t.removesuffix("*"), w, t.endswith("*"))) <= toxicity.edits(len(t.removesuffix("*")))]
        want = min(near) if near else None
        assert lexicon.near(w) == (None if want is None else (want[2], want[0]))


def test_quotation():
    finder = toxicity.Finder(toxicity.Lexicon(["moron"]))
    assert finder.hits("you are a morron indeed")[1] == [(0, 1, False)]
    assert finder.hits('he called them "a moron", she said')[1] == [(0, 0, True)]


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    frame, labels = texts.tables(spark, d, "documents"), texts.tables(spark, d, "labels")
    got = toxicity.scored(frame, labels, texts.bucket("doc_id", 3) != 1).where("held_out")
    got = got.join(labels.select("doc_id", "toxic"), "doc_id").collect()
    caught = [r["predicted"] for r in got if r["toxic"] == 1]
    wrong = [r["predicted"] for r in got if r["toxic"] == 0]
    assert np.mean(caught) > 0.9 and np.mean(wrong) < 0.01


def test_labelled_texts_that_share_common_words_all_count(spark):
    rng = np.random.default_rng(7)
    common = [f"{a}{b}" for a in "bcdfghjklm" for b in ("ane", "ise", "ote", "ulk", "err", "ash", "imp", "ond", "ust", "elt")]
    own = lambda k: "".join("abcdefghij"[int(c)] for c in f"{k:04}")
    rows = [(k, " ".join([*rng.permutation(common), own(k)] + ["blorgh"] * (k < 30))) for k in range(150)]
    rows += [(200 + k, rows[0][1]) for k in range(50)]  # copies count once
    rows += [(300 + k, rows[1][1] + " " + own(300 + k)) for k in range(50)]  # near copies too
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sample = frame.select(F.col("doc_id").alias("_id"), "text", (F.instr("text", "blorgh") > 0).cast("int").alias("toxic"))
    terms = toxicity.learn(frame, sample.select(F.col("_id").alias("doc_id"), "toxic"), F.lit(True))[0]
    assert "blorgh" in terms
    kept = toxicity.one_of_each(sample).collect()
    assert sorted(r["text"] for r in kept) == sorted(t for _, t in rows[:150])


def test_words_with_digits_and_signs_inside():
    finder = toxicity.Finder(toxicity.Lexicon(["moron", "idiot", "lose*"]))
    assert finder.hits("a m0ron, an idi*t")[1] == [(0, 1, False), (1, 1, False)]
    assert finder.hits("an idiot-moron. idiot.") == (4, [(1, 0, False), (0, 0, False), (1, 0, False)])
    assert finder.hits("x" * 100_000 + "1" * 100_000 + "y loser" + "-z" * 50_000)[1] == [(2, 0, False)]


def test_misspellings_no_labelled_text_has(spark):
    own = lambda k: "".join("abcdefghij"[int(c)] for c in f"{k:05}")
    rows = [(k, " ".join(f"qq{own(k)}{c}" for c in "abcdefgh") + (" you idiot" if k % 4 == 0 else " you see")) for k in range(400)]
    asked = ["you idlot", "you idi*t", "you 1see", "you ridge"]
    frame = spark.createDataFrame(rows + [(1000 + k, t) for k, t in enumerate(asked)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.scored(frame, labels, F.col("doc_id") < 1000).collect()}
    assert [got[1000 + k]["predicted"] for k in range(4)] == [1, 1, 0, 0] and got[1000]["score"] < got[0]["score"]


def test_a_lexicon_of_many_words(spark):
    """No word that passes the test is left out: 250 words of 20 toxic documents each."""
    own = lambda k: "".join("bcdfghjklmnp"[(k // 12**i) % 12] for i in range(4))
    word = lambda k: f"{own(k)}tox"
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(rng.permutation([word((k * 25 + j) % 250) for j in range(25)] + [f"e{own(k)}" for _ in range(3)]))) for k in range(200)]
    rows += [(1000 + k, " ".join(f"zz{own(k)}{c}" for c in "abcdefgh")) for k in range(800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = frame.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("toxic"))
    terms = toxicity.learn(frame, labels, F.lit(True))[0]
    assert {word(k) for k in range(250)} <= set(terms) and len(terms) > 600


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (9, 1), (9, 0), (None, 1), (77, None)], "doc_id long, toxic int")
    got = toxicity.scored(odd, labels, F.lit(True)).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.scored(empty, labels.where("false"), F.lit(True)).count() == 0


# ---- all

def test_registered_names():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in registry.queries()) == list(range(1, 11))
    assert set(registry.statements()) <= set(registry.queries())
