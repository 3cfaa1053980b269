"""Registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopanel.llm.alignment import alignment_digest
from geopanel.llm.common import pick, table
from geopanel.llm.langid import identify
from geopanel.llm.licenses import TEMPLATES, license_matches
from geopanel.llm.linededup import drop_repeated_lines
from geopanel.llm.lmscore import score_documents
from geopanel.llm.mixing import mix
from geopanel.llm.negatives import hard_negatives
from geopanel.llm.neighbours import nearest
from geopanel.llm.packing import packed_digest
from geopanel.llm.quality import judge
from geopanel.llm.secrets import find_secrets
from geopanel.llm.sharding import ROUNDS, shard_documents
from geopanel.llm.simhash import simhash_components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The byte-level tokenizer that sequences are packed with.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The sentence piece model that it is aligned with.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that must agree."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


#: The tree of op1: the collections a source number stands for, then language, then source.
MIX_LEVELS = {
    "domain": r"concat('d', coalesce(string(try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) "
              r"AS BIGINT) % 3), 'x'))",
    "lang": "lang",
    "source": "source",
}
MIX_WEIGHTS = {
    "domain": "CASE domain WHEN 'd0' THEN 5 WHEN 'd1' THEN 3 ELSE 2 END",
    "lang": "IF(lang = 'en', 4, 2)",
}

# Equal to mix() with the parameters of op1_mixing. One query block per level of the tree:
# sort siblings by capacity over weight, fill those that can't take their share.
MIX_SQL = r"""
WITH words AS (
  SELECT doc_id, 'd' || coalesce((try_cast(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '')
           AS BIGINT) % 3)::VARCHAR, 'x') AS domain, coalesce(lang, '') AS lang,
         coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
  FROM documents),
slim AS (SELECT * FROM words WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * 2 AS cap,
                1::HUGEINT AS w FROM slim GROUP BY ALL),
lng AS (SELECT domain, lang, sum(cap)::HUGEINT AS cap,
               (CASE WHEN lang = 'en' THEN 4 ELSE 2 END)::HUGEINT AS w FROM leaf GROUP BY ALL),
dom AS (SELECT domain, sum(cap)::HUGEINT AS cap,
               (CASE domain WHEN 'd0' THEN 5 WHEN 'd1' THEN 3 ELSE 2 END)::HUGEINT AS w
        FROM lng GROUP BY ALL),
d1 AS (SELECT *, least((SELECT floor(sum(tokens) * 0.8)::HUGEINT FROM leaf),
                       sum(cap) OVER ()::HUGEINT) AS b,
         coalesce(sum(cap) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
         sum(w) OVER (s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS since
       FROM dom WINDOW s AS (ORDER BY cap::DOUBLE / w::DOUBLE, domain)),
d2 AS (SELECT *, (b - before) * w >= cap * since AS full_ FROM d1),
d3 AS (SELECT domain, CASE WHEN full_ THEN cap ELSE (b - coalesce(sum(cap) FILTER (full_) OVER (), 0)::HUGEINT) * w
              // (sum(w) FILTER (NOT full_) OVER ())::HUGEINT END AS alloc FROM d2),
l1 AS (SELECT lng.*, alloc AS b,
         coalesce(sum(cap) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
         sum(w) OVER (s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS since
       FROM lng JOIN d3 USING (domain)
       WINDOW s AS (PARTITION BY domain ORDER BY cap::DOUBLE / w::DOUBLE, lang)),
l2 AS (SELECT *, (b - before) * w >= cap * since AS full_ FROM l1),
l3 AS (SELECT domain, lang, CASE WHEN full_ THEN cap ELSE
              (b - coalesce(sum(cap) FILTER (full_) OVER (PARTITION BY domain), 0)::HUGEINT) * w
              // (sum(w) FILTER (NOT full_) OVER (PARTITION BY domain))::HUGEINT END AS alloc FROM l2),
s1 AS (SELECT leaf.*, alloc AS b,
         coalesce(sum(cap) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
         sum(w) OVER (s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS since
       FROM leaf JOIN l3 USING (domain, lang)
       WINDOW s AS (PARTITION BY domain, lang ORDER BY cap::DOUBLE / w::DOUBLE, source)),
s2 AS (SELECT *, (b - before) * w >= cap * since AS full_ FROM s1),
s3 AS (SELECT domain, lang, source, tokens, CASE WHEN full_ THEN cap ELSE
              (b - coalesce(sum(cap) FILTER (full_) OVER (PARTITION BY domain, lang), 0)::HUGEINT) * w
              // (sum(w) FILTER (NOT full_) OVER (PARTITION BY domain, lang))::HUGEINT END AS alloc FROM s2),
plan AS (SELECT *, (alloc // tokens)::BIGINT AS epochs, alloc % tokens AS left_ FROM s3),
placed AS (SELECT slim.*, epochs, left_, sum(n_tokens) OVER (
             PARTITION BY domain, lang, source ORDER BY md5('42:' || epochs || ':' || coalesce(doc_id::VARCHAR, '-'))
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
           FROM slim JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens,
       unnest(range(epochs + CASE WHEN upto <= left_ THEN 1 ELSE 0 END))::INTEGER AS epoch
FROM placed
"""


@query(MIX_SQL)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source")
    return mix(docs, MIX_LEVELS, MIX_WEIGHTS, budget_share=0.8, max_epochs=2, seed=42)


@query()
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


# Equal to license_matches() with its own templates and threshold 0.8.
LICENSE_SQL = r"""
WITH given(license, template) AS (VALUES {templates}),
docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents WHERE text IS NOT NULL),
units AS (
  SELECT rid, doc_id, 'text' AS unit, 0 AS pos, text AS part FROM docs
  UNION ALL SELECT rid, doc_id, 'line', unnest(range(1, len(ls) + 1)), unnest(ls) FROM (
    SELECT *, string_split(text, chr(10)) AS ls FROM docs) WHERE len(ls) > 1
  UNION ALL SELECT rid, doc_id, 'paragraph', unnest(range(1, len(ps) + 1)), unnest(ps) FROM (
    SELECT *, string_split_regex(text, '\n[ \t\r]*\n') AS ps FROM docs) WHERE len(ps) > 1),
both_ AS (SELECT rid, doc_id, unit, pos, NULL AS license, part FROM units
          UNION ALL SELECT NULL, NULL, NULL, NULL, license, template FROM given),
words AS (SELECT * EXCLUDE part, list_filter(string_split(regexp_replace(
            lower(part), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM both_),
pairs AS (SELECT * EXCLUDE w, list_distinct(list_transform(range(1, len(w)),
            lambda i: w[i] || ' ' || w[i + 1])) AS b FROM words),
mine AS (SELECT rid, doc_id, unit, pos, len(b) AS n, unnest(b) AS bigram FROM pairs WHERE license IS NULL),
theirs AS (SELECT license, len(b) AS m, unnest(b) AS bigram FROM pairs WHERE license IS NOT NULL)
SELECT doc_id, unit, pos::INTEGER AS "at", license, n::INTEGER AS n_bigrams, m::INTEGER AS n_template,
       count(*) AS n_shared, 2.0::DOUBLE * count(*) / (n + m) AS dice
FROM mine JOIN theirs USING (bigram) GROUP BY rid, doc_id, unit, pos, license, n, m
HAVING 2.0::DOUBLE * count(*) / (n + m) >= 0.8
""".replace("{templates}", ", ".join(
    "('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items()))


@query(LICENSE_SQL)
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"), threshold=0.8)


@query()
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), words=3, threshold=3)


@query()
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source")
    return drop_repeated_lines(docs, min_words=30, over_blank=True)


# Equal to nearest() with k 10 and every 100.
NEAREST_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(
           list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
WHERE rank <= 10
"""


@query(NEAREST_SQL)
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(table(spark, sf_dir, "documents"), TOKENIZER, capacity=2048, end_id=1)


# Equal to judge() with limit 0.5 and the source as host. Rates are compared with the limit
# only, so the last digits of the prior don't matter.
QUALITY_SQL = r"""
WITH base AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM base),
wins AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM parts WHERE len(ws) >= 8),
grams AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS g FROM wins),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY doc_id),
m AS (
  SELECT p.doc_id, host, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM parts p LEFT JOIN rep USING (doc_id)),
r AS (
  SELECT *, n_words < 20 AS f1, 100 * n_repeat_words > 30 * n_words AS f2, 10 * n_symbols > n_words AS f3,
         10 * n_dup_lines > 3 * n_lines AS f4, word_chars < 3 * n_words OR word_chars > 10 * n_words AS f5 FROM m),
h AS (SELECT host, count(*) AS n, unnest([count_if(f1), count_if(f2), count_if(f3), count_if(f4), count_if(f5)]) AS bad,
             unnest(range(5)) AS rule FROM r GROUP BY host),
p AS (SELECT rule, sum(bad) / sum(n) AS m, count(*) - 1 AS others, sum(bad::DOUBLE * bad / n) - sum(bad) * m AS between_,
             sum(n) - sum(n::DOUBLE * n) / sum(n) - (count(*) - 1) AS room FROM h GROUP BY rule),
e AS (SELECT rule, m, room, CASE WHEN m > 0 AND m < 1 THEN between_ / (m * (1 - m)) - others ELSE 0 END AS surplus,
             CASE WHEN m < 0.5 THEN 1 / (0.5::DOUBLE - m) ELSE 1 END AS least_ FROM p),
s AS (SELECT rule, m, least(greatest(CASE WHEN room > 0 AND surplus > 0 THEN room / surplus - 1 ELSE 1e6::DOUBLE END,
             1::DOUBLE, least_), 1e6::DOUBLE) AS k FROM e),
v AS (SELECT host, max((bad + m * k) / (n + k)) AS host_rate FROM h JOIN s USING (rule) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
       NOT (f1 OR f2) AND NOT (host_rate > 0.5 AND (f1 OR f2 OR f3 OR f4 OR f5)) AS kept, n_lines,
       r.host, host_rate > 0.5 AS host_failed, round(host_rate, 6) AS host_rate
FROM r JOIN v ON r.host IS NOT DISTINCT FROM v.host
"""


@query(QUALITY_SQL)
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), host="source", limit=0.5)
    return judged.withColumn("host_rate", F.round("host_rate", 6))


# Equal to hard_negatives() with its own numbers, on the query's labels.
NEGATIVES_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT vec_id, label, list_transform(e, lambda x: floor(256 * x)::BIGINT) AS x FROM v),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS mine, a.x AS ax, c.vec_id, c.label,
         coalesce(list_sum(list_transform(list_zip(a.x, c.x), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM w a JOIN w c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.x) = len(c.x)),
p AS (
  SELECT anchor_id, mine, ax, vec_id AS positive_id, score AS positive_score FROM s WHERE label = mine
  QUALIFY row_number() OVER (PARTITION BY anchor_id, mine, ax ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.mine, p.ax, positive_id, positive_score
                            ORDER BY score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND p.mine = s.mine AND p.ax = s.ax AND s.label <> s.mine
   AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""


@query(NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(table(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding")
    moved = F.when(F.expr("vec_id % 7 = 0"), F.expr("(label + 1) % 10")).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), every=50, positives=5, negatives=3,
                          low=50, high=95, scale=256)


@query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digest(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


# Equal to shard_documents() with 16 shards and seed 42. The network is walked turn by turn;
# a checksum is folded over the bytes of a text.
SHARDING_SQL = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, coalesce(text, '') AS t, md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(md5(text), '-'))
         AS digest FROM documents),
feedback AS (
  SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM feedback WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS f FROM feedback WHERE k = 8),
size_ AS (SELECT n, a, (n + a - 1) // a AS b FROM (
  SELECT count(*) AS n, greatest(1, floor(sqrt(count(*) - 1))::BIGINT + 1) AS a FROM base)),
rows_ AS (
  SELECT doc_id, octet_length(encode(t)) + 1 AS size, row_number() OVER (ORDER BY digest) - 1 AS number,
         xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(t)), '..'),
           lambda h: ('0x' || h)::BIGINT), lambda c, v: xor(c >> 8, f[(xor(c, v) & 255) + 1]),
           4294967295::BIGINT)) AS text_crc32 FROM base, crc),
walk AS (
  SELECT number, number % a AS l, number // a AS r, 0 AS turn FROM rows_, size_
  UNION ALL
  SELECT number,
         CASE WHEN turn % 2 = 0 THEN (l + ('0x' || substr(md5('42:' || turn % {rounds} || ':' || r), 1, 15))::BIGINT % a) % a
              ELSE l END,
         CASE WHEN turn % 2 = 1 THEN (r + ('0x' || substr(md5('42:' || turn % {rounds} || ':' || l), 1, 15))::BIGINT % b) % b
              ELSE r END,
         turn % {rounds} + 1
  FROM walk, size_ WHERE turn < {rounds} OR l + r * a >= n)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law,
       ((l + r * a) % 16)::INTEGER AS shard, ((l + r * a) // 16)::BIGINT AS slot,
       NULL::INTEGER AS grown_shard, number::BIGINT AS number
FROM rows_ JOIN walk USING (number), size_ WHERE turn = {rounds} AND l + r * a < n
""".replace("{rounds}", str(ROUNDS))


@query(SHARDING_SQL)
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"), shards=16, seed=42)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
                         "number")
