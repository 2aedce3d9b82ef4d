"""One registered query for each operator, over its whole table, and the SQL it must
agree with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from silverlode.llm import (
    bpe, corpus_queries, debruijn, decontamination, grading, language, ngram_join, pii, quality_rules, suffix_dedup,
    token_counts,
)
from silverlode.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_decontaminate(spark, sf):
    return decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op7_bpe(spark, sf):
    shared = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(table(spark, sf, "documents"), shared)


# Letters A-Z alone are lowered; words end at ASCII characters that are neither letters nor digits.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SQL["op2_decontaminate"] = rf"""
WITH items AS (
  SELECT cast(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_LETTERED}') AS w FROM benchmark
), gram AS (
  SELECT DISTINCT item, len(g) AS size, array_to_string(g, ' ') AS g FROM (
    SELECT item, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w]
                        ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS g FROM items)
), doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_LETTERED}') AS w FROM documents
), place AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM doc, (SELECT DISTINCT size FROM gram) WHERE len(w) >= size)
), found AS (
  SELECT doc_id, p.size, i, item FROM place p JOIN gram USING (size, g)
), hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT doc_id, size, i FROM found)) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op1_grade(spark, sf):
    return grading.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op3_pii(spark, sf):
    return pii.digest(table(spark, sf, "documents"))


@query
def op5_language(spark, sf):
    return language.identify(table(spark, sf, "documents"))


@query
def op8_quality_rules(spark, sf):
    return quality_rules.verdicts(table(spark, sf, "documents")).drop("fail_bits")


SQL["op8_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
         length(t) - length(regexp_replace(t, '\p{L}', '', 'g')) AS n_letters,
         length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper
  FROM d
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) > 4)
), r AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS k FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY doc_id
), x AS (
  SELECT m.*, coalesce(r.n, 0) AS n_repeat_words FROM m LEFT JOIN r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 10 * n_words
            OR 100 * n_dup_lines > 30 * n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_upper > 70 * n_letters) AS kept
FROM x
"""


@query
def op10_token_counts(spark, sf):
    # id 50256 is free in this vocabulary and ends a document
    shared = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return token_counts.measure(table(spark, sf, "documents"), shared, 50256).select("doc_id", "n_tokens")


@query
def op9_substring_dedup(spark, sf):
    return debruijn.digest(table(spark, sf, "documents"))


SQL["op9_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) > 12)
), hit AS (
  SELECT doc_id, list(DISTINCT k) AS gone FROM (
    SELECT doc_id, unnest(range(i, i + 13)) AS k FROM (
      SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM g) WHERE least < doc_id) GROUP BY doc_id
), word AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t FROM word LEFT JOIN (SELECT doc_id, unnest(gone) AS k, 1 AS out FROM hit) USING (doc_id, k)
  WHERE out IS NULL GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op4_ngram_join(spark, sf):
    return ngram_join.near_duplicates(table(spark, sf, "documents"))


SQL["op4_ngram_join"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(g, ' ') AS g, len(g) AS k FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                          ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS g FROM d)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), link AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g, k) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""


@query
def op6_suffix_dedup(spark, sf):
    return suffix_dedup.digest(table(spark, sf, "documents"))


QUERIES |= corpus_queries.QUERIES
SQL |= corpus_queries.SQL
