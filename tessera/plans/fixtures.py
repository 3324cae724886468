"""Test tables mapped to the shapes that the engine works on. The same SQL serves Spark and the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_URL = "https://archive.example.org"

#: Index rows with a text. Numbers repeat so that keys collide; some are null or empty; dates come in all forms.
INDEX = """
SELECT CAST(doc_id AS STRING) AS id, doc_id AS line_no, source AS daireKurul,
  CASE WHEN doc_id % 5 = 4 THEN NULL WHEN doc_id % 5 = 3 THEN '' ELSE concat('2000/', CAST(doc_id % 11 AS STRING)) END AS esasNo,
  CASE WHEN doc_id % 7 = 6 THEN NULL ELSE concat('2001/', CAST(doc_id % 13 AS STRING)) END AS kararNo,
  CASE WHEN doc_id % 17 = 0 THEN '' WHEN doc_id % 19 = 0 THEN ' 01.02.2003 ' WHEN doc_id % 23 = 0 THEN '2003-01-02' WHEN doc_id % 29 = 0 THEN NULL
    WHEN doc_id % 31 = 0 THEN '99.99.2011'
    ELSE concat(lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0'), '.', lpad(CAST(1 + doc_id % 12 AS STRING), 2, '0'), '.', CAST(1990 + doc_id % 30 AS STRING)) END AS kararTarihi,
  CASE WHEN doc_id % 3 = 0 THEN 'tax & fee' WHEN doc_id % 3 = 1 THEN '' ELSE NULL END AS arananKelime,
  CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id % 50 AS STRING) WHEN doc_id % 4 = 1 THEN '' ELSE NULL END AS mevzuatNo,
  CASE doc_id % 3 WHEN 0 THEN 'danistay' WHEN 1 THEN 'yargitay' ELSE 'mevzuat' END AS kaynak,
  text
FROM documents"""

#: Dated decisions for search, from orders.
DECISIONS = """
SELECT o_orderkey AS id, concat('chamber ', CAST(o_custkey % 10 AS STRING)) AS chamber, CAST(1980 + o_orderkey % 40 AS INT) AS case_year,
  CAST(o_orderkey % 5000 AS INT) AS case_no, CAST(extract(YEAR FROM o_orderdate) AS INT) AS decision_year, CAST(o_orderkey % 7000 AS INT) AS decision_no,
  CAST(o_orderdate AS DATE) AS decided, CAST(o_orderkey % 300 AS STRING) AS statute_no, o_orderpriority AS statute_name, CAST(o_orderkey % 20 AS STRING) AS article,
  o_orderkey % 5000 AS case_order, o_orderkey % 7000 AS decision_order
FROM orders"""

#: A request log from events.
REQUESTS = """
SELECT event_id, user_id, ts, event_type,
  CASE event_type WHEN 'error' THEN 'backoff' WHEN 'signup' THEN 'captcha' ELSE 'ok' END AS outcome,
  CASE WHEN event_type = 'error' THEN 'down' ELSE 'up' END AS state
FROM events"""

#: Recorded responses from events.
RESPONSES = """
SELECT event_id, CAST(CASE event_id % 7 WHEN 0 THEN 429 WHEN 1 THEN 503 WHEN 2 THEN 500 WHEN 3 THEN NULL ELSE 200 END AS INT) AS status,
  CASE WHEN event_id % 7 IN (4, 5) THEN 'ERROR' END AS kind,
  CASE event_id % 7 WHEN 4 THEN 'reCaptcha timeout' WHEN 5 THEN 'bad criteria' END AS message
FROM events"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shaped(spark: SparkSession, rows: DataFrame, sql: str, source: str) -> DataFrame:
    """``rows``, which may be a stream, under a fixture mapping written over the table ``source``."""
    escaped = sql.replace("{", "{{").replace("}", "}}")
    return spark.sql(escaped.replace(f"FROM {source}", "FROM {src}"), src=rows)


def mapped(spark: SparkSession, sf_dir: str, sql: str, source: str) -> DataFrame:
    """A fixture mapping over one table."""
    return shaped(spark, table(spark, sf_dir, source), sql, source)
