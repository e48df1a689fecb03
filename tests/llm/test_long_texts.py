"""Long runs and many matches in one text: the same as Python's expressions, and soon."""

import time
from collections import Counter

from pyspark.sql import functions as F

from accountwise.llm import lengths, sanitise, secret_scan, spans
from tests.llm.test_operators import PERSONAL, SECRETS, base_matches

#: Seconds for all texts of a test on a busy machine; the square of any of them would be minutes.
SOON = 300


def texts_of(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")


def test_personal_data(spark):
    """Small ones against Python's expressions, which need the square of a run; large ones against what is known of them."""
    small = texts_of(spark, [
        "7" * 300, "4111 1111 1111 1111 " * 20, "a@b" + ".c" * 200, "x " + "1.2.3.4, " * 40, "1." * 200, "w" * 500 + " me@here.org",
        "+1 " + "(" * 200 + "5 +1 604 555 8469", "%a@b.c%d@e.f g@h.i@j.k", "a@b.c@d.e.f", "1.2.3.4.5.6.7.8.9", "256.1.1.1.1 01.002.0003.4",
        "9" * 30 + " " + "4-" * 50,
    ])
    base_matches(sanitise.digest(sanitise.scan(small)), small, PERSONAL)
    large = [
        ("7" * 100_000, (0, 0, 0, 0)), ("a@b" + ".c" * 100_000, (1, 0, 0, 0)), ("x " + "1.2.3.4, " * 300, (0, 300, 0, 0)),
        ("w" * 1_000_000 + " me@here.org", (1, 0, 0, 0)),
    ]
    frame = texts_of(spark, [body for body, _ in large])
    begun = time.time()
    got = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in sanitise.scan(frame).collect()}
    assert got == {k: want for k, (_, want) in enumerate(large)}
    assert time.time() - begun < SOON


def test_secrets(spark):
    frame = texts_of(spark, [
        "0123456789abcdef01234567 " * 20_000, "token=" + "a" * 500_000, "secret: abcdefgh " * 10_000, "password" + " " * 500_000 + "= abcdefgh",
        "AKIA" * 100_000, "q" * 1_000_000, "ordinaryidentifierword " * 20_000 + "0123456789abcdef01234567",
    ])
    begun = time.time()
    base_matches(secret_scan.digest(secret_scan.scan(frame)), frame, SECRETS)
    masked = {r["doc_id"]: r["text"] for r in secret_scan.redacted(frame).collect()}
    assert masked[0] == "[SECRET] " * 20_000 and masked[2] == "[SECRET] " * 10_000
    assert time.time() - begun < SOON


def test_lengths(spark):
    frame = texts_of(spark, [" " * 2_000_000, "a" * 1_000_000, "\n" * 700_000 + "x"])
    assert sum(r["docs"] for r in lengths.length_report(frame).collect()) == 3


def test_masked_texts_are_joined_the_same_both_ways(spark):
    bodies = [f"🙂{'key ' * n}" + " ".join(f"é{k} u{k}@example.org," for k in range(n)) for n in (0, 1, 16, 17, 300)]
    import re

    want = [re.sub(PERSONAL[0][1], "[EMAIL]", b) for b in bodies]
    text = F.col("text")
    done = spans.masked(text, spans.spans(spans.found(text, sanitise.EMAIL), 0), ["[EMAIL]"])
    got = [r["done"] for r in texts_of(spark, bodies).select(done.alias("done")).collect()]
    assert Counter(got) == Counter(want)
