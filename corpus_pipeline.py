"""A training-data pipeline over ``documents``: good, distinct, decontaminated, redacted and packed.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; what it returns is
written as Parquet and reread by the next. All but the last return the columns of ``documents``, and further
columns of the input, whatever their names. Texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, ngram_join, packing, quality, secrets
from tessera.llm.queries import public_tokenizer
from tessera.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects.

    Each row is judged by its own text: a null or empty one, rows without an id and repeated rows like any other. Without
    labels of known ids every score is 0.5, so every row stays. An empty table gives no rows.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five-word shingles, similarity 0.8 or more).

    A row of the group's smallest id stays; of repeated rows, one does. Rows without an id, a text or a word are in no group
    and stay; rows of one id with different texts stay or go each for itself. An empty table gives no rows.
    """
    return ngram_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents of which at least one word in twenty lies in a benchmark window.

    Each row is judged by its own text, whatever its id; texts that are null or without words stay. Items that are null or
    without words give no window, items without an id are left out; an empty benchmark drops nothing.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; no document goes.

    ``n_chars`` follows a text that changed; null texts stay null, and every other row and column stays as it is.
    """
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full windows, with their ids.

    A null or empty text is one end id; rows without an id and repeated rows are packed each for itself; an empty table
    gives no pieces. Columns other than the id and the text are left out.
    """
    return packing.pack(docs, public_tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", packed),
]

#: Boosted trees and tokenizers have no SQL form; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's rows are written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
