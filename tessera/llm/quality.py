"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

The trees learn from at most ``sample`` labelled rows, taken by a hash of the id among those whose
crc32(doc_id as text) mod 5 is not 0, and are flattened into arrays that score batches in numpy.

Defined results: a null or empty text has all statistics zero and gets the score the trees give those;
ids that are null are scored and count as not held out; repeated rows get equal scores; label rows that
are null or unknown are ignored and an id labelled twice counts as good if any of its rows says so;
without labels, or with labels of one kind only, every row gets the (clipped) share of good labels, 0.5
if there is none; an empty table gives no rows. Only the id and the text are read, whatever other
columns there are; long texts are read whole. There is no shuffle of texts: labels of the sample are
broadcast, at most ``sample``.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrow import as_bytes, sliced
from tessera.llm.boosting import Forest, fit

SAMPLE = 20_000
THRESHOLD = 0.3
FOLDS = 5

STATISTICS = (
    "bytes", "words", "lines", "mean_word", "upper", "digits", "spaces", "non_ascii", "stops", "symbols", "bars", "marks",
    "distinct_words", "distinct_pairs", "top_word", "top_pair", "distinct_lines", "capital_words", "symbol_ends", "short_words", "long_words", "max_word", "words_a_stop",
)


def statistics_of(raw: bytes | None) -> tuple[float, ...]:
    """Statistics of one whole text, in the order of STATISTICS."""
    if not raw:
        return (0.0,) * len(STATISTICS)
    n = len(raw)
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    k = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    singles, pairs = Counter(words), Counter(zip(words, words[1:]))
    ends = Counter(w[-1] for w in words)
    stops = int(c[0x2E] + c[0x2C])
    return (
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), n / k, c[0x41:0x5B].sum() / n, c[0x30:0x3A].sum() / n, c[0x20] / n, c[0x80:].sum() / n,
        stops / k, (c[0x23:0x27].sum() + c[0x2A]) / n, c[0x7C] / n, c[0x21] / n,
        len(singles) / k, len(pairs) / max(k - 1, 1), max(singles.values(), default=0) / k, max(pairs.values(), default=0) / max(k - 1, 1), len(set(lines)) / len(lines),
        sum(map(bytes.isupper, words)) / k, sum(ends[x] for x in b"#$%&*!|") / k, (lengths <= 3).sum() / k, (lengths >= 12).sum() / k, np.log1p(lengths.max(initial=0)),
        np.log1p(k / (stops + 1)),
    )


def matrix_of(raws: list[bytes | None]) -> np.ndarray:
    return np.array([statistics_of(r) for r in raws], dtype=np.float64).reshape(len(raws), len(STATISTICS))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, sample: int) -> DataFrame:
    """doc_id and label of at most ``sample`` rows that are not held out, by a hash of the id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    ids = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> Forest:
    chosen = labelled_sample(labels, "quality", sample)
    schema = "doc_id long, label int, stats array<double>"

    def run(batches):
        for b in sliced(batches):
            x = matrix_of(b.column("_utf8").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(STATISTICS), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), lists], names=["doc_id", "label", "stats"])

    texts = as_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "_utf8")
    # Statistics are made where the texts are; only they meet, at most ``sample`` rows though an id is repeated.
    got = texts.mapInArrow(run, schema).orderBy("doc_id", F.xxhash64("stats")).limit(sample).toArrow()
    y = got["label"].to_numpy().astype(np.float64)
    x = np.array(got["stats"].to_pylist(), dtype=np.float64).reshape(len(y), len(STATISTICS))
    return fit(x, y, **options)


def score(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for b in sliced(batches):
            p = shared.value.probability(matrix_of(b.column("_utf8").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    ids = as_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    scored = ids.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    return score(docs, train(docs, labels, sample), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns; texts are read once."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.probability(matrix_of(texts.tolist())) >= threshold)

    return docs.where(good(F.col("text").cast("binary")))
