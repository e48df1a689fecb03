"""Aligned tokens against the tokenizers' own libraries and plain loops."""

import bisect
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from accountwise.llm import alignment, lengths, texts
from tests.llm.conftest import SF


def placed(tokens):
    out, at = [], 0
    for k, body in tokens:
        out.append((k, at, at + len(body)))
        at += len(body)
    return out


def brute(rows):
    a_side = Tokenizer.from_file(alignment.VOCABULARY_A)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=alignment.VOCABULARY_B)
    letters, counts, done = alignment.byte_letters(), Counter(), []
    for r in rows:
        text, want = r["text"] or "", b" " + (r["text"] or "").encode()
        a = [(k, bytes(letters[c] for c in a_side.id_to_token(k))) for k in a_side.encode(" " + text, add_special_tokens=False).ids]
        b = [
            (k, bytes([int(b_side.id_to_piece(k)[3:5], 16)]) if b_side.is_byte(k) else b_side.id_to_piece(k).replace("▁", " ").encode())
            for k in b_side.encode(text)
        ]
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            done.append((r["doc_id"], 0, 0, 0, [], ""))
            continue
        a, b = placed(a), placed(b)
        common = sorted({x[2] for x in a} & {x[2] for x in b})
        parts = [([], []) for _ in common]
        for side, tokens in enumerate((a, b)):
            for k, _, end in tokens:
                parts[bisect.bisect_left(common, end)][side].append(str(k))
        groups = ["|".join(",".join(side) for side in part) for part in parts]
        links, starts = [], [x for _, x, _ in b]
        for k, x, y in a:
            at = bisect.bisect_right(starts, x) - 1
            while at < len(b) and b[at][1] < y:
                links.append((k, b[at][0]))
                at += 1
        counts.update(set(links))
        done.append((r["doc_id"], len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (d, a, b, g, len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), digest)
        for d, a, b, g, links, digest in done
    ]


def same(frame):
    key = lambda r: tuple((x is not None, x) for x in r)
    got = alignment.digest(alignment.aligned(frame)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(frame.collect()), key=key)


def test_documents(spark):
    same(texts.tables(spark, SF, "documents"))


def test_rare_pairs_take_the_join_and_pieces_are_stitched(spark, monkeypatch):
    monkeypatch.setattr(alignment, "HEAD", 300)
    monkeypatch.setattr(alignment.overlaps, "__defaults__", (5,))
    monkeypatch.setattr(alignment, "HELD", 1000)
    same(texts.tables(spark, SF, "documents").limit(60))


def test_odd_rows(spark, odd, empty):
    same(odd)
    assert alignment.aligned(empty).count() == 0
    tricky = ["▁x", "<|endoftext|> </s> <0x41>", "\x00", "  a", "a ", "\n\n\nb", "🙂🙂 ñandú", "a" * 5000, " " * 300 + "x", "ﬁ ①  Å", "x y", "'ll 's"]
    same(spark.createDataFrame(list(enumerate(tricky)), "doc_id long, text string"))


def test_groups_are_those_of_the_digest(spark):
    row = alignment.aligned(spark.createDataFrame([(1, "Hello wörld")], "doc_id long, text string")).first()
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"] and row["groups"].count(";") == row["n_groups"] - 1


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 100])
def test_pieces_of_the_merge(steps):
    rng = np.random.default_rng(steps)
    for _ in range(50):
        a, b = (np.unique(np.append(rng.integers(1, 40, rng.integers(0, 20)), 40)) for _ in range(2))
        links_a, links_b, group_a, group_b = alignment.overlaps(a, b, steps)
        spans_a, spans_b = ([(int(x), int(y)) for x, y in zip(np.append(0, e[:-1]), e)] for e in (a, b))
        want = {(i, j) for i, (p, q) in enumerate(spans_a) for j, (x, y) in enumerate(spans_b) if max(p, x) < min(q, y)}
        assert sorted(zip(links_a.tolist(), links_b.tolist())) == sorted(want)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert group_a.tolist() == [bisect.bisect_left(common, x) for x in a] and group_b.tolist() == [bisect.bisect_left(common, x) for x in b]
        i, j = alignment.merge_path(a, b, steps)
        assert (np.diff(i + j)[:-1] == steps).all() and (i + j)[-1] == len(a) + len(b)


def test_blanks_of_any_length():
    encode = lengths.encoder(lengths.VOCABULARY)
    whole = Tokenizer.from_file(alignment.VOCABULARY_A)
    for text in ["x" + " " * 12_000 + "y z", "\n" * 15_000, " " * 20_000 + "\n", "a" + " \t" * 9_000 + "b" + " " * 11_000 + "　c"]:
        assert lengths.encode_whole(encode, text) == whole.encode(text, add_special_tokens=False).ids
    assert lengths.encode_whole(encode, " " * 2_000_000) == whole.encode(" " * 2_000_000, add_special_tokens=False).ids
