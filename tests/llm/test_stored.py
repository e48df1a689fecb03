"""Stored tables: their shuffle files, and those that nothing reads any more."""

import os

from pyspark.sql import functions as F

from accountwise.llm import pitman_yor, texts


def folder_of(df):
    return df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]


def test_dropped_leaves_what_is_not_stored(spark, tmp_path):
    given = str(tmp_path / "documents")
    spark.range(5).write.parquet(given)
    kept, gone = spark.read.parquet(given), texts.stored_alone(spark.range(5), "gone")
    folder = folder_of(gone)
    assert os.path.exists(folder)
    texts.dropped(kept, gone.unionByName(kept))
    assert not os.path.exists(folder) and kept.count() == 5


def test_the_setting_is_as_before(spark):
    before = spark.conf.get(texts._CLEANED, None)
    assert texts.stored_alone(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "few").count() == 7
    assert spark.conf.get(texts._CLEANED, None) == before


def test_a_model_keeps_its_words_and_pairs_only(spark, monkeypatch):
    made = []

    def noted(df, label, first=texts.stored):
        out = first(df, label)
        made.append(folder_of(out))
        return out

    monkeypatch.setattr(texts, "stored", noted)
    docs = spark.createDataFrame([(k, f"a b{k % 3} c a b{k % 5}") for k in range(30)], "doc_id long, text string")
    model = pitman_yor.seated_model(docs, "text", F.lit(True))
    read = {f.removeprefix("file://").rsplit("/", 1)[0] for df in (model.words, model.pairs) for f in df.inputFiles()}
    assert len(made) == 9 and {f for f in made if os.path.exists(f)} == read
