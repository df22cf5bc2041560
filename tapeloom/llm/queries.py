"""The registered queries of this package, one ``opN_<name>`` each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm import (
    chat, conversations, decontam, divergence, fingerprints, html_text, language, lm_score, near_dups, packing, token_file)
from tapeloom.llm import quality as quality_op
from tapeloom.llm import toxicity as toxicity_op
from tapeloom.llm.common import prepare, read


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents in length buckets and batches."""
    prepare(spark)
    return packing.pack(read(spark, sf_dir, "documents"))


def op2_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of benchmark items."""
    prepare(spark)
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lattice likelihood of every document."""
    prepare(spark)
    return lm_score.held_out_scores(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    prepare(spark)
    return toxicity_op.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    prepare(spark)
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    prepare(spark)
    return html_text.main_text(read(spark, sf_dir, "pages"))


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by near-equal sets of four-word shingles."""
    prepare(spark)
    return near_dups.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, percent=80)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    prepare(spark)
    return language.languages(read(spark, sf_dir, "documents"))


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and checksums of every document's ids, read back from the written files."""
    prepare(spark)
    return token_file.token_files(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    prepare(spark)
    return quality_op.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation."""
    prepare(spark)
    return conversations.repair(read(spark, sf_dir, "conversations"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and the terms that stand out in them."""
    prepare(spark)
    return divergence.divergence(read(spark, sf_dir, "documents"))


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted turns."""
    prepare(spark)
    return chat.conversations(read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_decontam, op3_lm_score, op4_toxicity, op5_fingerprints, op6_html_text,
    op7_near_dups, op8_language, op9_token_file, op10_quality,
    op11_repair, op12_divergence, op13_chat)}

#: words of a text, A-Z in lower case
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


def components_sql(table: str, size: int, percent: int) -> str:
    """doc_id, n_shingles, component_id and kept of ``table`` (doc_id, text); equal sets are compared once."""
    return f"""
    WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM {table}),
    g AS MATERIALIZED (
        SELECT doc_id, list_sort(list_distinct(CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' ')) END)) AS g
        FROM w),
    s AS MATERIALIZED (SELECT min(doc_id) AS id, g, len(g) AS n FROM g WHERE len(g) > 0 GROUP BY g),
    e AS (SELECT id, n, unnest(g) AS x FROM s),
    l AS MATERIALIZED (
        SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON a.x = b.x AND a.id < b.id
        GROUP BY ALL HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))),
    u AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT id AS a, id AS b FROM s UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
    c AS (SELECT a AS id, min(b) AS c FROM r GROUP BY a)
    SELECT g.doc_id, CAST(len(g.g) AS BIGINT) AS n_shingles, coalesce(c.c, g.doc_id) AS component_id,
           coalesce(c.c, g.doc_id) = g.doc_id AS kept
    FROM g LEFT JOIN s USING (g) LEFT JOIN c ON c.id = s.id"""


SQL: dict[str, str] = {
    "op1_packing": packing.pack_sql("documents"),
    "op7_near_dups": components_sql("documents", 4, 80),
    "op12_divergence": divergence.DIVERGENCE_SQL,
    "op13_chat": chat.CHAT_SQL,
}
