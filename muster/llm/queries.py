"""The registered corpus queries and, where SQL can express one, its SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from muster.llm import (
    bpe, classifier, divergence, mixing, neighbours, packing, quotes, repeats, rules, runs, secrets, simhash, tokens,
)
from muster.llm.common import cut, table

BPE_50K = "byte_bpe_50k.json"
BPE_MULTI = "byte_bpe_multi_50k.tiktoken"


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return classifier.score(docs, classifier.fit(docs, table(spark, folder, "labels")))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """As even as four passes over the smallest source allow, in as many words as there are."""
    docs = table(spark, folder, "documents")
    counted = cut(docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("n_tokens")))
    return mixing.mix(counted, tokens="n_tokens")


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(table(spark, folder, "documents")))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(BPE_50K))


def op6_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(table(spark, folder, "documents"))


def op7_quotations(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.link(table(spark, folder, "conversations"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.judge(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "quality")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(BPE_50K))


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


def op11_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path(BPE_MULTI))


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.collapse(runs.with_periods(table(spark, folder, "documents"))))


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_simhash, op3_mixing, op4_secrets, op5_token_counts,
    op6_repeats, op7_quotations, op8_quality_rules, op9_packing, op10_neighbours,
    op11_bpe, op12_runs, op13_divergence,
)}
# The same arithmetic over a dense table of every source and kept term.
DIVERGENCE = """
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), w AS (
    SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), kept AS (
    SELECT lang, term, count(*) AS n_lang FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), cells AS (
    SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), l AS (
    SELECT lang, count(*) AS v, sum(n_lang) AS total FROM kept GROUP BY lang
), t AS (
    SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source
), g AS (
    SELECT lang, source, coalesce(t.total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN t USING (lang, source)
), dense AS (
    SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (g.total + 5 * l.v)::HUGEINT AS p,
           1 + (1000000000::HUGEINT * (n_lang + 5)) // (l.total + 5 * l.v)::HUGEINT AS q
    FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN cells USING (lang, source, term)
), far AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM dense a JOIN dense b USING (lang, term) WHERE a.source <> b.source GROUP BY a.lang, a.source, b.source
), f AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM dense WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM f QUALIFY part = 'pair' OR rank <= 50
"""
ORACLES: dict[str, str] = {"op13_divergence": DIVERGENCE}
