"""The registered queries of the subpackage and the oracle SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import (
    copies, decontam, idfiles, jaccard, maintext, neighbours, periodic, pieces, pii, rules, substrings, tokens, variants)
from wayfare.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_pieces")
def piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), spans=True)


@query("op2_quality_rules", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
           FROM documents),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS x(k) GROUP BY doc_id),
c AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
             length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
             length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits
      FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 60 * n_lines
            OR word_chars < 3 * n_words OR word_chars > 12 * n_words
            OR 100 * n_upper > 40 * (n_upper + n_lower) OR 100 * n_digits > 20 * word_chars) AS kept
FROM j
""")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.count_and_judge(docs, rules.order_rules(docs, rules.METHOD_RULES))


@query("op4_substrings", r"""
WITH w AS (SELECT doc_id, i, w[i] AS x FROM (
             SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (
               SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents))),
g AS (SELECT doc_id, i, string_agg(x, ' ') OVER s AS run, count(*) OVER s AS n
      FROM w WINDOW s AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY run) AS c FROM g WHERE n = 35) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM twice, (SELECT unnest(range(35)) AS k)),
kept AS (SELECT w.doc_id, count(*) AS n_words, count(gone.i) AS n_removed,
                string_agg(CASE WHEN gone.i IS NULL THEN x END, ' ' ORDER BY w.i) AS t
         FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.i = gone.i GROUP BY w.doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
""")
def substrings_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest_repeats(table(spark, sf_dir, "documents"))


@query("op5_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query("op7_ngram_jaccard", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN c ON c.x = d.doc_id
""")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(spark, table(spark, sf_dir, "documents"))


@query("op8_main_text")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(table(spark, sf_dir, "pages"))


@query("op10_quality_votes")
def quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return neighbours.score(docs, neighbours.fit(docs, table(spark, sf_dir, "labels"), "quality"))


@query("op6_decontamination")
def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_id_files")
def id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    idfiles.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return idfiles.digest_ids(spark, path)


@query("op11_spelling_variants")
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = variants.count_words(table(spark, sf_dir, "documents"), damage=variants.DAMAGE)
    return variants.group_variants(spark, counted)


@query("op12_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.equal_texts(spark, table(spark, sf_dir, "documents"))


@query("op13_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest_runs(table(spark, sf_dir, "documents"), rewrite=periodic.planted_tail)
