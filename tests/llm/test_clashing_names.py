"""Stages on documents whose columns are named like the stages' own."""

from pyspark.sql import functions as F

from accountwise.llm import decontaminate, language, mixing, near_dedup, secret_scan
from accountwise.llm.texts import bucket


def test_columns_come_back_as_they_were(spark, odd):
    names = ("_hits", "_digest", "_doc", "_in", "_at", "_lang_pred", "_lang_score", "_rows", "_word", "_bits", "_d", "_i", "row", "in_text")
    docs = odd.withColumns({n: F.concat(F.lit(n), F.coalesce("text", F.lit("")).substr(1, 5)) for n in names})
    items = spark.createDataFrame([(1, "same id, other text, 10.20.30.255 and more")], "item_id long, text string")
    kept = {
        "clean": decontaminate.clean(docs, items), "one": near_dedup.keep_one(docs), "lang": language.recognised(docs, bucket("doc_id", 3) != 1),
        "secrets": secret_scan.redacted(docs), "mix": mixing.drawn(docs),
    }
    for stage, out in kept.items():
        assert out.columns[: len(docs.columns)] == docs.columns, stage
        rows = out.collect()
        assert rows and all(r[n].startswith(n) for r in rows for n in names), stage
