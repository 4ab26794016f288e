"""The registered training-data queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from screenroi.llm.collocations import collocations
from screenroi.llm.common import read_table
from screenroi.llm.exact_dedup import exact_dedup
from screenroi.llm.line_dedup import line_dedup_digest
from screenroi.llm.mixing import mixing_order
from screenroi.llm.packing import pack_documents
from screenroi.llm.pii import personal_data
from screenroi.llm.quality_rules import quality_rules
from screenroi.llm.simhash import simhash_dedup
from screenroi.llm.suffix_dedup import suffix_dedup_digest
from screenroi.llm.token_files import token_files
from screenroi.llm.toxicity import toxicity
from screenroi.llm.url_filter import rule_labels, url_verdicts
from screenroi.llm.whitening import whiten


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(read_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup_digest(read_table(spark, sf_dir, "documents"))


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_order(read_table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_verdicts(pages, rule_labels(pages))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_files": op3_token_files,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_temperature_mixing": op7_temperature_mixing,
    "op8_personal_data": op8_personal_data,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_collocations": op11_collocations,
    "op12_url_filter": op12_url_filter,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": r"""
        WITH l AS (
          SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines,
                 unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line
          FROM documents),
        t AS (
          SELECT doc_id, line, lines[line + 1] AS raw,
                 trim(lines[line + 1], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
          FROM l),
        w AS (
          SELECT doc_id, line AS l0, lead(line) OVER o AS l1, lead(line, 2) OVER o AS l2,
                 body AS b0, lead(body) OVER o AS b1, lead(body, 2) OVER o AS b2
          FROM t WHERE body <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY line)),
        r AS (
          SELECT doc_id, l0, l1, l2,
                 row_number() OVER (PARTITION BY b0, b1, b2 ORDER BY doc_id, l0) AS n
          FROM w WHERE l2 IS NOT NULL),
        gone AS (SELECT DISTINCT doc_id, unnest([l0, l1, l2]) AS line FROM r WHERE n > 1)
        SELECT t.doc_id, count(*) AS n_lines, count(gone.line) AS n_removed,
               sha256(coalesce(string_agg(t.raw, chr(10) ORDER BY t.line) FILTER (WHERE gone.line IS NULL), ''))
                 AS kept_sha256
        FROM t LEFT JOIN gone USING (doc_id, line)
        GROUP BY t.doc_id
    """,
    "op5_exact_dedup": r"""
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS points,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
          FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY sha) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha AS text_sha256
        FROM d
        WINDOW w AS (PARTITION BY sha ORDER BY points DESC, doc_id NULLS LAST)
    """,
    "op11_collocations": r"""
        WITH p AS (
          SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) AS piece
          FROM (SELECT coalesce(lang, 'und') AS lang,
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
                FROM documents)),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
        totals AS (SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang),
        g AS (
          SELECT lang, size, list_slice(words, pos, pos + size - 1) AS phrase
          FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS pos
                FROM w CROSS JOIN range(1, 6) AS s(size) WHERE len(words) >= size)),
        f AS (
          SELECT lang, size, array_to_string(phrase, ' ') AS phrase, any_value(phrase) AS words, count(*) AS f
          FROM g GROUP BY lang, size, phrase HAVING count(*) >= 100),
        c AS (SELECT * FROM f WHERE size > 1),
        k AS (
          SELECT c.lang, c.phrase, c.f AS a, cut, l.f AS l, r.f AS r, n,
                 (1000 * CAST(c.f AS HUGEINT) * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
          FROM (SELECT *, unnest(range(1, size)) AS cut FROM c) c
          JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.words, 1, cut), ' ')
          JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.words, cut + 1, c.size), ' ')
          JOIN totals ON totals.lang = c.lang),
        lowest AS (
          SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS turn FROM k),
        inner_ AS (
          SELECT lang, array_to_string(list_slice(words, pos, pos + m - 1), ' ') AS phrase, max(f) AS around
          FROM (SELECT *, unnest(range(1, size - m + 2)) AS pos
                FROM (SELECT *, unnest(range(2, size)) AS m FROM c))
          GROUP BY ALL),
        ranked AS (
          SELECT x.lang, x.phrase, a, l, r, n, score,
                 row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, x.phrase) AS rank
          FROM lowest x LEFT JOIN inner_ USING (lang, phrase)
          WHERE turn = 1 AND (around IS NULL OR 100 * around < 100 * a))
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
               CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked WHERE rank <= 2000
    """,
}
