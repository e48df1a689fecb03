"""The operators applied to the given tables, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from accountwise.llm import (
    alignment, collocations, decontaminate, language, lengths, licences, mixing, near_dedup, pitman_yor, quality, sanitise,
    secret_scan, toxicity,
)
from accountwise.llm.texts import bucket, tables

Query = Callable[[SparkSession, str], DataFrame]


def op1_bag_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs).select("doc_id", "copy_id", "group_id", "n_copies", "group_size")


def op2_markov_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(tables(spark, sf_dir, "documents")))


def op3_containment_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "benchmark"))


def op4_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(tables(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(tables(spark, sf_dir, "documents"), bucket("doc_id", 3) != 1)


def op6_decision_list_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels"))


def op7_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.digest(sanitise.scan(tables(spark, sf_dir, "documents")))


def op8_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_report(tables(spark, sf_dir, "documents"))


def op9_pitman_yor_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scored(tables(spark, sf_dir, "documents"), bucket("doc_id", 5) != 1)


def op10_toxicity_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels"), bucket("doc_id", 3) != 1)


def op11_merge_path_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(alignment.aligned(tables(spark, sf_dir, "documents"), with_groups=False))


def op12_hat_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(tables(spark, sf_dir, "documents"))


def op13_suffix_automaton_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(licences.scan(tables(spark, sf_dir, "documents")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_bag_minhash_dedup, op2_markov_secret_scan, op3_containment_decontamination, op4_pareto_mixing, op5_language_id,
        op6_decision_list_quality, op7_disclosure_sanitisation, op8_length_histogram, op9_pitman_yor_lm,
        op10_toxicity_automata, op11_merge_path_alignment, op12_hat_trie_collocations,
        op13_suffix_automaton_licences,
    )}


OP3 = r"""
WITH lowered AS (
    SELECT 0 AS kind, doc_id AS id, row_number() OVER () AS row, text FROM documents
    UNION ALL SELECT 1, item_id, row_number() OVER (), text FROM benchmark
), cut AS (
    SELECT kind, id, row, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM lowered
), runs AS (
    SELECT DISTINCT kind, id, row, w[i : i + 4] AS run
    FROM (SELECT kind, id, row, w, unnest(range(1, len(w) - 3)) AS i FROM cut WHERE len(w) >= 5)
), sized AS (
    SELECT row, count(*) AS n FROM runs WHERE kind = 1 GROUP BY row
)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n) AS n_item, count(*) AS n_shared, count(*) / any_value(n) AS containment
FROM runs b JOIN runs d ON b.kind = 1 AND d.kind = 0 AND b.run = d.run JOIN sized s ON s.row = b.row
GROUP BY d.id, d.row, b.id, b.row
HAVING count(*) >= 0.8 * any_value(n)
"""


def statements() -> dict[str, str]:
    return {"op3_containment_decontamination": OP3, "op12_hat_trie_collocations": collocations.OP12}
