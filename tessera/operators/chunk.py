"""Overlapping token windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import Chunking

#: What a chunk takes over from its document.
INHERITED = ("kaynak", "esas_no", "karar_no", "daire", "karar_tarihi", "mevzuat_no", "mevzuat_turu", "url")


def _tokens(text: Column) -> Column:
    """Tokens are runs without ASCII white space."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def chunk_windows(docs: DataFrame, key: str, text: str = "text", settings: Chunking = Chunking()) -> DataFrame:
    """All columns of ``docs`` with chunk_text, chunk_index (from 0) and total_chunks.

    Windows start every ``size - overlap`` tokens while more than the overlap is left; windows under
    ``least`` tokens are dropped, also where they are a whole document. Rows are exploded where they
    are, without a shuffle.
    """
    step = settings.size - settings.overlap

    def windows(tokens: Column) -> Column:
        left = lambda s: F.size(tokens) - s
        starts = F.sequence(F.lit(0), F.greatest(left(settings.overlap + 1), F.lit(0)), F.lit(step))
        kept = F.filter(starts, lambda s: F.least(left(s), F.lit(settings.size)) >= settings.least)
        return F.transform(kept, lambda s: F.array_join(F.slice(tokens, s + 1, settings.size), " "))

    # The tokens are bound once; only the texts of the windows leave the expression.
    chunks = F.flatten(F.transform(F.array(_tokens(F.col(text))), windows))
    at = docs.withColumn("_chunks", chunks)
    return at.select(*docs.columns, F.size("_chunks").alias("total_chunks"), F.posexplode("_chunks").alias("chunk_index", "chunk_text")).select(*docs.columns, "chunk_index", "total_chunks", "chunk_text")


def chunked_documents(docs: DataFrame, settings: Chunking = Chunking()) -> DataFrame:
    """Chunk records with the fields they inherit; ids follow from the document and the index."""
    chunks = chunk_windows(docs, "id", settings=settings)
    return chunks.select(
        F.sha2(F.concat_ws("#", "id", "chunk_index").cast("binary"), 256).alias("chunk_id"), F.col("id").alias("doc_id"), F.col("chunk_text").alias("text"),
        "chunk_index", "total_chunks", *[c for c in INHERITED if c in docs.columns],
    )
