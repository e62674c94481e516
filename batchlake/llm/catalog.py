"""The operators as queries over the given tables, with SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.llm import bpe, bpe_stream, conversations, decontaminate, embedding_dedup, filter_audit, licences, line_dedup, ngram_join, secrets, sharding, toxicity, warc
from batchlake.llm.base import table

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


def component_sql(node: str, edges: str) -> str:
    """Recursive part: (node, root) with the smallest node reachable, by steps along ``edges`` (x, y)."""
    return f"""
  reach(x, y) AS (SELECT {node} AS x, {node} AS y FROM nodes UNION SELECT r.x, e.y FROM reach r JOIN {edges} e ON e.x = r.y),
  roots AS (SELECT x, min(y) AS root FROM reach GROUP BY x)"""


def ngram_sql(n: int, percent: int, texts: str = "documents") -> str:
    """DuckDB: doc_id, n_shingles, component_id of the n-gram Jaccard join over ``texts``."""
    return f"""
WITH RECURSIVE
  words AS (SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM {texts}),
  sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []
      WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) END AS s FROM words),
  nodes AS (SELECT doc_id, len(s) AS n_shingles FROM sets),
  grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
  shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
  linked AS (SELECT x, y FROM shared JOIN nodes p ON p.doc_id = x JOIN nodes q ON q.doc_id = y
    WHERE 100 * n_both >= {percent} * (p.n_shingles + q.n_shingles - n_both)),{component_sql("doc_id", "linked")}
SELECT doc_id, n_shingles, root AS component_id FROM nodes JOIN roots ON x = doc_id"""


@query("op1_ngram_jaccard", ngram_sql(4, 85))
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"), n=4, percent=85)


LEAST_COSINE = 0.93

OP2_SQL = f"""
WITH RECURSIVE
  nodes AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
  good AS (SELECT * FROM nodes WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
  linked AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= {LEAST_COSINE}),{component_sql("vec_id", "linked")},
  links AS (SELECT x, count(*) AS n FROM linked GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, root AS component_id, vec_id = root AS kept
FROM nodes JOIN roots ON roots.x = vec_id LEFT JOIN links ON links.x = vec_id"""


@query("op2_embedding_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), LEAST_COSINE)


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.with_secrets(table(spark, sf_dir, "documents"), [F.col("doc_id")])


@query("op4_licence_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.with_licences(docs, licences.train(docs), [F.col("doc_id")])


@query("op5_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


OP6_SQL = f"""
WITH page AS (SELECT DISTINCT source AS host, text FROM documents WHERE text IS NOT NULL),
total AS (SELECT host, count(*) AS all_pages FROM page GROUP BY host),
carried AS (
  SELECT host, line, count(*) AS pages FROM (
    SELECT DISTINCT host, text, unnest(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' '))) AS line FROM page)
  WHERE line <> '' GROUP BY host, line),
boiler AS (
  SELECT c.host, list(c.line) AS dropped FROM carried c JOIN total t ON c.host IS NOT DISTINCT FROM t.host
  WHERE pages >= {line_dedup.LEAST_PAGES} AND pages > {line_dedup.BOILERPLATE_RATIO} * all_pages GROUP BY c.host),
done AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines,
    list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(dropped, []), trim(x, ' '))) AS kept
  FROM documents d LEFT JOIN boiler b ON d.source IS NOT DISTINCT FROM b.host)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text,
  coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(kept), 0) AS n_dropped
FROM done
"""


@query("op6_line_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = line_dedup.drop_boilerplate(docs, F.col("source"))
    return done.select("row.doc_id", "text", "n_lines", "n_dropped")


@query("op7_decontaminate")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.matched(docs, benchmark, [F.col("doc_id")]).select(
        "doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.col("matches.item_id").alias("item_ids"),
        "matches",
    )


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encoded(docs, F.col("text"), path, public_tokenizers.PATTERN, ["doc_id"], ids=False)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, [F.col("doc_id")]).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


OP10_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS digest FROM p),
o AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS owner FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {warc.LEAST_REVISIT_BYTES} AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {warc.LEAST_REVISIT_BYTES} AND page_id <> owner THEN owner END AS refers_to
FROM o
"""


@query("op10_warc", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.read_archive(spark, path).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  min(doc_id) OVER (PARTITION BY t) AS least FROM d),
failing AS (
  SELECT part,
    concat(CASE WHEN len(words) < 100 THEN 'A' END,
      CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
      CASE WHEN doc_id > least THEN 'E' END) AS failed,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM w),
seen AS (SELECT part, failed, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n FROM failing GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
  FROM (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM l a, l b, l c, l d, l e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5), (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)),
done AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(failed, f) AS fails, failed = f AS alone,
    translate(earlier, failed, '') <> earlier AS gone FROM seen, steps),
counts AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT gone AND fails), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (gone AND fails), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (NOT gone AND fails AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (NOT gone AND fails AND toxic), 0)::BIGINT AS toxic_lost
  FROM done GROUP BY ALL)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM counts
"""


@query("op11_filter_audit", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


MERGES = "byte_bpe_50k.json"


@query("op12_bpe_stream")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe_stream.encoded(docs, F.col("text"), public_tokenizers.path(MERGES), ["doc_id"], ids=False)


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.report(conversations.damaged(rows), rows, F.col("copies"))
