"""Registered queries of the corpus operators, with their SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from clickweave.llm import bpe, counts, infill, jaccard, mixing, negatives, pii, quality, rules, sentence, tiling, tokenfiles, urls
from clickweave.llm.common import table
from clickweave.llm.pieces import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# fixed values of the contract: verdict, host, path
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
TOKEN_LIMIT = 2048


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


@register("op1_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest, folder = tokenfiles.write_shards(docs, stored("byte_bpe_50k.json"))
    return tokenfiles.read_by_key(docs.select("doc_id"), manifest, folder)


@register("op2_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


RULES_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS solid FROM t),
g AS (SELECT r, i, array_to_string(words[i:i+7], ' ') AS gram
      FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM d, range(0, 8) AS s(k) GROUP BY r),
m AS (SELECT w.r, doc_id, text, words, solid, len(words) AS n_words, length(solid) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
        len(string_split(text, chr(10))) AS n_lines
      FROM w LEFT JOIN c ON w.r = c.r),
b AS (SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed
    OR n_symbols * 100 > n_words * 10
    OR (length(text) - length(replace(text, '!', ''))) * 100 > n_words * 25
    OR word_chars < n_words * 2 OR word_chars > n_words * 14
    OR (n_dup_lines >= 3 AND n_dup_lines * 100 > n_lines * 30)
    OR len(list_filter(range(1, n_words), lambda i: words[i] = words[i + 1])) * 100 > n_words * 25
    OR length(regexp_replace(text, '[^A-Z]', '', 'g')) * 100 > word_chars * 40
    OR length(regexp_replace(text, '[^0-9]', '', 'g')) * 100 > word_chars * 30
    OR (len(regexp_extract_all(text, '(\.\.\.|…)[\x20\x09-\x0D]*(\n|$)')) + 1) * 100 > n_lines * 50 + 100) AS kept
FROM b
"""


@register("op3_quality_rules", RULES_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_report(table(spark, sf_dir, "documents")).drop("rejected_by")


JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i+3], ' ') AS gram
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.gram = y.gram AND x.doc_id <> y.doc_id
      GROUP BY x.doc_id, y.doc_id),
e AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
      WHERE 100 * common >= 85 * (na.n + nb.n - common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(reach.b) AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n
"""


@register("op4_jaccard_join", JACCARD_SQL)
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@register("op5_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counts.token_counts(table(spark, sf_dir, "documents"), stored("word_bpe_49k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


URLS_SQL = r"""
WITH rules(v, h, p) AS (VALUES """ + ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES) + r"""),
u AS (SELECT row_number() OVER () AS r, page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
f AS (SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM u JOIN rules
      ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN f ON u.r = f.r
"""


@register("op6_url_filters", URLS_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_report(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


@register("op7_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans_report(table(spark, sf_dir, "documents"))


@register("op8_context_mixing")
def context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.scored(table(spark, sf_dir, "documents"))


@register("op9_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), stored("word_bpe_49k.json"), with_ids=False)


@register("op10_string_tiling")
def string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("item").alias("benchmark_item"), "covered", "item_tokens", "coverage", F.size("tiles").alias("n_tiles"))


@register("op11_sentence_pieces")
def sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence.digested(table(spark, sf_dir, "documents"), stored("piece_bpe_32k.model"))


NEGATIVES_SQL = r"""
WITH r AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, b.label = a.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.r <> b.r),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.a, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank, n.vec_id AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.a = n.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


@register("op12_hard_negatives", NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


INFILL_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, length(text) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, text[1:a] AS prefix, CASE WHEN b > a THEN text[a + 1:b] ELSE '' END AS middle,
        CASE WHEN n > b THEN text[b + 1:n] ELSE '' END AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


@register("op13_fill_in_middle", INFILL_SQL)
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.restored_texts(infill.transformed(table(spark, sf_dir, "documents")))
    cuts = [F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars")]
    digests = [F.sha2(F.col(c), 256).alias(f"{n}_sha256") for c, n in (("output", "output"), ("text", "restored"))]
    return made.select("doc_id", "n", "form", *cuts, *digests)


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
