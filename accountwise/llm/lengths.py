"""Exact length histogram: token counts answer every context limit.

Tasks encode whole texts with a public byte-level vocabulary and add up documents by length before anything is
shuffled. Suffix sums over the histogram give, for every length that occurs, how many documents and tokens are at least
as long, the tokens that remain if every document is cut there, and the share of documents up to it. A null text has
no tokens. Repeated rows count each time. Long texts are encoded whole, runs of white space of any length too. The
driver reads the vocabulary's file and sends its bytes to the tasks.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accountwise.llm.texts import stored, text_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the public vocabulary splits texts before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lengths that share a step of the suffix sums.
SPAN = 1024
#: Runs of white space from this length on are encoded without the pattern, whose engine ends on very long ones.
LONG_BLANK = 10_000
_BLANKS = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{%d,}" % LONG_BLANK)


def encoding(ids: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})


def ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


def encoder(vocabulary: str):
    with open(vocabulary, "rb") as file:
        return encoding(ranks(file.read()))


def encode_whole(encode, text: str) -> list[int]:
    """The ids of a text of any length. The pattern splits a run of white space before its last sign, or at its end."""
    out, at = [], 0
    for run in _BLANKS.finditer(text) if len(text) >= LONG_BLANK else ():
        stop = run.end() - (run.end() < len(text))
        out += encode.encode_ordinary(text[at : run.start()]) + encode._encode_single_piece(text[run.start() : stop])
        at = stop
    return out + encode.encode_ordinary(text[at:])


def histogram(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(n_tokens, docs): how many documents have each length."""

    with open(vocabulary, "rb") as file:
        lines = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = None, Counter()
        for batch in batches:
            encode = encode or encoding(ranks(lines.value))
            for value in batch.column(0):
                seen[len(encode_whole(encode, value.as_py()))] += 1
        yield pa.RecordBatch.from_pydict(
            {"n_tokens": pa.array(list(seen), pa.int64()), "docs": pa.array(list(seen.values()), pa.int64())}
        )

    parts = docs.select(text_of(text).alias("text")).mapInArrow(run, "n_tokens long, docs long")
    return parts.groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


def length_report(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each length: n_tokens, docs, docs_at_least, tokens_at_least, tokens_cut_here, share_up_to.

    Answers for a limit L between two lengths follow from the next longer row: documents at least as long as L are its
    docs_at_least, and tokens kept at L are all tokens less tokens_at_least plus L times docs_at_least.
    """
    cells = stored(histogram(docs, text, vocabulary), "lengths").withColumn("span", F.floor(F.col("n_tokens") / SPAN))
    spans = cells.groupBy("span").agg(
        F.sum("docs").alias("span_docs"), F.sum(F.col("docs") * F.col("n_tokens")).alias("span_tokens")
    )
    # spans are as few as the longest document has thousands of tokens
    later = Window.orderBy("span").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy()
    spans = spans.select(
        "span", F.coalesce(F.sum("span_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("span_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("span_docs").over(whole).alias("all_docs"), F.sum("span_tokens").over(whole).alias("all_tokens"),
    )
    here = Window.partitionBy("span").orderBy("n_tokens").rowsBetween(0, Window.unboundedFollowing)
    rows = cells.join(spans, "span").withColumns({
        "docs_at_least": F.sum("docs").over(here) + F.col("later_docs"),
        "tokens_at_least": F.sum(F.col("docs") * F.col("n_tokens")).over(here) + F.col("later_tokens"),
    })
    return rows.select(
        "n_tokens", "docs", "docs_at_least", "tokens_at_least",
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("tokens_cut_here"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("docs")) / F.col("all_docs")).alias("share_up_to"),
    )
