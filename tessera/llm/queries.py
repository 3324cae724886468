"""The registered queries of this subpackage: thin calls with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, embedding_dedup, ngram_join, packing, quality, secrets, sharding, token_counts, token_output, toxicity


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"), with_ids=False)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), width=3, percent=90)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_digest(sharding.shuffle_rows(docs))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.write_and_read(_table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_packing": op2_packing,
        "op3_token_counts": op3_token_counts,
        "op4_ngram_join": op4_ngram_join,
        "op5_toxicity": op5_toxicity,
        "op6_sharding": op6_sharding,
        "op7_embedding_dedup": op7_embedding_dedup,
        "op8_secrets": op8_secrets,
        "op9_quality": op9_quality,
        "op10_token_output": op10_token_output,
    }


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: Smallest node reachable from each node: {nodes} selects n, links holds every link as (a, b) in both directions.
_REACH = "reach AS (SELECT n, n AS m FROM ({nodes}) UNION SELECT r.n, l.b FROM reach r JOIN links l ON l.a = r.m), part AS (SELECT n, min(m) AS c FROM reach GROUP BY n), deg AS (SELECT a, count(*) AS d FROM links GROUP BY a)"

_OP1 = f"""WITH wd AS (SELECT doc_id, {_WORDS} AS ws FROM documents), wi AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
  k AS (SELECT item_id, ws, least(len(ws), 13) AS k FROM wi WHERE len(ws) > 0),
  win AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM k)),
  grams AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM wd, (SELECT DISTINCT k FROM win))),
  hit AS (SELECT doc_id, i, k, item_id FROM grams JOIN win USING (k, g)),
  words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
  FROM wd LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OP4 = rf"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
  {_REACH.format(nodes="SELECT doc_id AS n FROM documents")}
  SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, part.c AS component_id, coalesce(deg.d, 0) AS n_links
  FROM documents d LEFT JOIN n USING (doc_id) JOIN part ON part.n = d.doc_id LEFT JOIN deg ON deg.a = d.doc_id"""

_OP7 = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
  {_REACH.format(nodes="SELECT vec_id AS n FROM embeddings")}
  SELECT vec_id, coalesce(d, 0) AS n_links, c AS component_id, vec_id = c AS kept FROM embeddings JOIN part ON n = vec_id LEFT JOIN deg ON a = vec_id"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express; the others are tested against brute-force versions."""
    return {"op1_decontamination": _OP1, "op4_ngram_join": _OP4, "op7_embedding_dedup": _OP7}
