"""Registered queries of the numbered operators over their whole tables, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import (
    alignment, bpe, chosen_path, exact_dedup, line_dedup, mixing, quality_classifier, quality_rules, repair, rollups, toxicity, url_filter, vector_codes,
)
from ebbtide.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_rules.fit_line_model(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.line_quality(docs, model).drop("line_labels")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.mixture(docs, mixing.fit_topics(docs))


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), rules)


def op5_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    repair.write_tokens(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path(VOCABULARY))
    return repair.read_tokens(spark, folder, with_tokens=False)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all documents under the first tokenizer; English ones revised to the second; short ones deleted. The
    second batch comes twice."""
    docs, root = _table(spark, sf_dir, "documents"), scratch_path(spark, "rollups")
    first = rollups.counted(docs, "blank-1", rollups.blank_words(F.col("text")))
    second = rollups.counted(docs, "split-2", rollups.split_words(F.col("text")))
    english, short, none = F.col("lang") == "en", rollups.blank_words(F.col("text")) < 50, F.lit(None)
    inserted = docs.select(none.cast("int").alias("nothing"), first.alias("new")).select(F.when(F.col("nothing").isNotNull(), F.col("new")).alias("old"), "new")
    revised = docs.filter(english).select(first.alias("old"), second.alias("new"))
    live = docs.filter(short).select(F.when(english, second).otherwise(first).alias("old"))
    deleted = live.select("old", F.when(F.lit(False), F.col("old")).alias("new"))
    for name, changes in (("1", inserted), ("2", revised), ("2", revised), ("3", deleted)):
        rollups.commit(root, name, changes)
    return rollups.totals(spark, root)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_classifier.site_quality(docs, quality_classifier.fit_classifier(docs, _table(spark, sf_dir, "labels")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.without_repeated_lines(_table(spark, sf_dir, "documents"), passages=True)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_copies(_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fit_machine(docs, _table(spark, sf_dir, "labels")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(_table(spark, sf_dir, "embeddings"))


def _codes_sql(parts: int, entries: int, rounds: int) -> str:
    """The rounds of vector coding as one chain of tables."""

    def assigned(k: int) -> str:
        return f"""
near{k} AS MATERIALIZED (
  SELECT r, part, MIN(apart) AS apart, ARG_MIN(entry, apart * {entries} + entry) AS entry
  FROM (SELECT c.r, c.part, b.entry, SUM((c.x - b.c) * (c.x - b.c))::BIGINT AS apart FROM comps c JOIN book{k} b ON c.part = b.part AND c.place = b.place GROUP BY ALL)
  GROUP BY r, part)"""

    def moved(k: int) -> str:
        return f"""
book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.place, COALESCE((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.c) AS c
  FROM book{k} b LEFT JOIN (
    SELECT c.part, n.entry, c.place, SUM(c.x)::BIGINT AS s, COUNT(*) AS n FROM comps c JOIN near{k} n ON n.r = c.r AND n.part = c.part GROUP BY ALL) m
  ON m.part = b.part AND m.entry = b.entry AND m.place = b.place)"""

    chain = ",".join(assigned(k) + "," + moved(k) for k in range(rounds)) + "," + assigned(rounds)
    return rf"""
WITH kept AS (
  SELECT ROW_NUMBER() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding FROM embeddings
  WHERE LEN(embedding) > 0 AND LEN(LIST_FILTER(embedding, lambda x: x IS NOT NULL AND ISFINITE(x))) = LEN(embedding)),
flat AS (SELECT r, LEN(embedding) // {parts} AS width, UNNEST(embedding) AS x, UNNEST(RANGE(LEN(embedding))) AS k FROM kept),
comps AS MATERIALIZED (SELECT r, k // width AS part, k % width AS place, FLOOR(4096 * x::DOUBLE)::BIGINT AS x FROM flat),
book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, place, x AS c FROM comps WHERE r <= {entries}),{chain},
coded AS (SELECT r, STRING_AGG(PRINTF('%02x', entry::INTEGER), '' ORDER BY part) AS code, SUM(apart)::BIGINT AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, SUM(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT SHA256(STRING_AGG(c::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded ON coded.r = kept.r
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_bpe, op3_mixing, op4_url_filters, op5_repair, op6_token_counts, op7_quality_classifier, op8_exact_dedup,
        op9_line_dedup, op10_ngram_jaccard, op11_alignment, op12_toxicity, op13_vector_codes,
    )
}

ORACLES: dict[str, str] = {
    "op4_url_filters": r"""
WITH parts AS (
  SELECT page_id,
         TRANSLATE(REGEXP_EXTRACT(COALESCE(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         REGEXP_EXTRACT(COALESCE(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages)
SELECT page_id, host, path, rule, CASE WHEN rule = 'net/' OR rule = 'example.com/de/' THEN 'block' ELSE 'allow' END AS verdict
FROM (SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM parts)
""",
    "op6_token_counts": r"""
WITH counted AS (
  SELECT source, lang, LEN(REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS blank_1,
         LEN(REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[0-9]|[!-/:-@\[-`{-~]|[^0-9!-/:-@\[-`{-~\x20\x09-\x0D]+')) AS split_2
  FROM documents)
SELECT source, lang, CASE WHEN lang = 'en' THEN 'split-2' ELSE 'blank-1' END AS tokenizer, COUNT(*) AS n_docs,
       CAST(SUM(CASE WHEN lang = 'en' THEN split_2 ELSE blank_1 END) AS BIGINT) AS n_tokens
FROM counted WHERE blank_1 >= 50 GROUP BY ALL
""",
    "op8_exact_dedup": r"""
WITH bare AS (
  SELECT doc_id, REGEXP_REPLACE(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t, LENGTH(COALESCE(text, '')) AS n FROM documents)
SELECT doc_id, FIRST_VALUE(doc_id) OVER best AS keep_id, COUNT(*) OVER (PARTITION BY t) AS group_size,
       ROW_NUMBER() OVER best = 1 AS kept, SHA256(t) AS text_sha256
FROM bare WINDOW best AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST)
""",
    "op9_line_dedup": r"""
WITH docs AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
parts AS (
  SELECT doc_id, UNNEST(STRING_SPLIT(text, chr(10))) AS line, UNNEST(RANGE(LEN(STRING_SPLIT(text, chr(10))))) AS place FROM docs),
numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY place) AS k, LEN(REGEXP_EXTRACT_ALL(line, '[^\x20\x09-\x0D]+')) AS words
  FROM parts WHERE REGEXP_MATCHES(line, '[^\x20\x09-\x0D]')),
runs AS (
  SELECT doc_id, k, 3 AS n, LIST(line) OVER w AS content, COUNT(*) OVER w AS held FROM numbered
  WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)
  UNION ALL
  SELECT doc_id, k, 2, content, held + 1 FROM (
    SELECT doc_id, k, LIST(line) OVER v AS content, COUNT(*) OVER v AS held, SUM(words) OVER v AS words FROM numbered
    WINDOW v AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING)) WHERE words >= 50
  UNION ALL
  SELECT doc_id, k, 1, [line], 3 FROM numbered WHERE words >= 50),
later AS (
  SELECT doc_id, k, n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY n, content ORDER BY doc_id, k) AS nth FROM runs WHERE held = 3) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, UNNEST(RANGE(k, k + n)) AS k FROM later),
marked AS (
  SELECT p.doc_id, p.line, p.place, m.k, g.k AS gone FROM parts p
  LEFT JOIN numbered m ON m.doc_id = p.doc_id AND m.place = p.place LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.k = m.k)
SELECT doc_id, COUNT(k) AS n_lines, COUNT(gone) AS n_removed,
       SHA256(COALESCE(STRING_AGG(line, chr(10) ORDER BY place) FILTER (gone IS NULL), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op10_ngram_jaccard": r"""
WITH RECURSIVE split AS (
  SELECT doc_id, REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT doc_id, UNNEST(LIST_DISTINCT(CASE WHEN LEN(w) < 5 THEN [ARRAY_TO_STRING(w, ' ')]
         ELSE LIST_TRANSFORM(RANGE(1, LEN(w) - 3), lambda i: ARRAY_TO_STRING(w[i:i+4], ' ')) END)) AS s
  FROM split WHERE LEN(w) > 0),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM both_ JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 10 * c >= 8 * (x.n + y.n - c)),
reach(doc_id, to_id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.to_id)
SELECT doc_id, MIN(to_id) AS class_id, (SELECT COUNT(*) FROM links WHERE a = reach.doc_id) AS n_links FROM reach GROUP BY doc_id
""",
    "op13_vector_codes": _codes_sql(8, 16, 6),
}
