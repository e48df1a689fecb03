import duckdb

import corpus_pipeline
from accountwise.llm import registry, texts
from tests.compare import compare, duck
from tests.llm.conftest import SF


def test_stages_keep_their_contract(spark):
    docs = texts.tables(spark, SF, "documents")
    whole = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = texts.stored(stage(spark, docs, SF), name)
        if name != "mixture":
            assert out.columns == docs.columns
        assert 0 < out.count() <= whole
        docs = out
    assert docs.columns[-2:] == ["mix_copies", "mix_target"]


def test_stages_on_odd_and_empty_rows(spark, odd, empty):
    for frame in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = texts.stored(stage(spark, frame, SF), name)
            assert out.columns[: len(frame.columns)] == frame.columns
            assert name == "mixture" or out.count() <= frame.count()


def test_statements(spark):
    con: duckdb.DuckDBPyConnection = duck(SF)
    for name, sql in registry.statements().items():
        assert compare(name, registry.queries()[name](spark, SF), con, sql).startswith("ok")
