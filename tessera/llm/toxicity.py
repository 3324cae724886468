"""Toxicity by a classifier chain of linear models over words and stems.

The chain predicts one category after the other; each later model sees the probabilities of the
earlier ones. While it is trained, those are out-of-fold predictions, so a later model learns from
probabilities as uncertain as it will meet. The last link is the label ``toxic`` itself. The labels name
no kinds of abuse, so the earlier links are found in the data: the toxic texts of the sample are
clustered by the words they hold, and a text belongs to a kind if it is toxic and of that cluster. Models
are trained here, in numpy, on at most ``sample`` labelled rows chosen by a hash of the id among those
with crc32(doc_id as text) mod 5 not 0.

Defined results: a null or empty text has no words and gets the models' intercepts; each row is scored
for itself, repeated rows and null ids included; without labels every probability is 0.5 and nothing
is toxic; an empty table gives no rows; only the id and the text are read. Texts are read whole and
not shuffled; the labels of the sample are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrow import as_bytes, sliced
from tessera.llm.decontaminate import words_of
from tessera.llm.quality import held_out, labelled_sample
from tessera.session import discard, materialize

SAMPLE = 20_000
THRESHOLD = 0.5
MAX_WORDS = 256
#: Words longer than this also count by their first bytes, so that compounds of one stem add up.
STEM = 6

#: Earlier links: clusters of the toxic texts.
KINDS = 2


@dataclass(frozen=True)
class Chain:
    names: tuple[str, ...]
    words: dict[bytes, int]
    weights: np.ndarray  # (links, words + links): earlier probabilities follow the words
    intercepts: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(rows, links) for word indicators ``x``."""
        out, w = np.zeros((len(x), len(self.names))), len(self.words)
        for k in range(len(self.names)):
            out[:, k] = _sigmoid(x @ self.weights[k, :w] + out @ self.weights[k, w:] + self.intercepts[k])
        return out

    def indicators(self, texts: list[set[bytes]]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.words)), dtype=np.float32)
        for row, words in enumerate(texts):
            x[row, [self.words[w] for w in words & self.words.keys()]] = 1
        return x


def features_of(raw: bytes | None) -> set[bytes]:
    """The distinct words of a text, and the stems of its longer ones, marked by a star."""
    words = set(words_of(raw))
    return words | {w[:STEM] + b"*" for w in words if len(w) > STEM}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 12) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton's method; the intercept is not penalised."""
    mean = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    w = np.append(np.zeros(x.shape[1]), np.log(mean / (1 - mean)))
    if len(y) == 0 or y.min() == y.max():
        return w[:-1], float(w[-1])
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float32)
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(steps):
        p = _sigmoid(x @ w.astype(np.float32)).astype(np.float64)
        curve = (x * np.maximum(p * (1 - p), 1e-4).astype(np.float32)[:, None]).T @ x
        step = np.linalg.solve(curve.astype(np.float64) + np.diag(penalty), x.T.astype(np.float64) @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-3:
            break
    return w[:-1], float(w[-1])


def fit_chain(names: tuple[str, ...], words: list[bytes], x: np.ndarray, y: np.ndarray, folds: int = 3) -> Chain:
    """The chain for word indicators ``x`` and labels ``y`` (rows, links); folds go by the rows' position.

    Each link is fitted on all rows and, for the later links to learn from, predicted out of fold.
    """
    chain = Chain(names, {w: i for i, w in enumerate(words)}, np.zeros((len(names), len(words) + len(names))), np.zeros(len(names)))
    both, fold = np.hstack([x, np.zeros((len(x), len(names)))]).astype(np.float32), np.arange(len(x)) % folds
    for k in range(len(names)):
        out = np.zeros(len(x), dtype=np.float32)
        for f in range(folds):
            w, b = fit_linear(both[fold != f], y[fold != f, k])
            out[fold == f] = _sigmoid(both[fold == f] @ w + b)
        chain.weights[k], chain.intercepts[k] = fit_linear(both, y[:, k])
        both[:, len(words) + k] = out
    return chain


def kinds_of(x: np.ndarray, toxic: np.ndarray, kinds: int, steps: int = 20) -> np.ndarray:
    """(rows, kinds) of 0 and 1: the toxic rows' clusters by spherical k-means from far-apart rows, large ones first.

    Ties go to the first row or cluster; kinds for which there are too few different rows stay empty.
    """
    out, rows = np.zeros((len(x), kinds)), np.flatnonzero((toxic == 1) & (x.sum(axis=1) > 0))
    if not len(rows):
        return out
    unit = x[rows] / np.sqrt(x[rows].sum(axis=1, keepdims=True))
    centres = [unit[int((unit @ unit.mean(axis=0)).argmax())]]
    while len(centres) < kinds:
        near = np.max(unit @ np.array(centres).T, axis=1)
        if near.min() > 1 - 1e-9:
            break
        centres.append(unit[int(near.argmin())])
    at = np.zeros(len(rows), np.int64)
    for _ in range(steps):
        new = (unit @ np.array(centres).T).argmax(axis=1)
        sums = [unit[new == k].sum(axis=0) for k in range(len(centres))]
        centres = [s / max(float(np.linalg.norm(s)), 1e-12) for s in sums]
        if (new == at).all():
            break
        at = new
    for k, cluster in enumerate(np.argsort(-np.bincount(at, minlength=len(centres)), kind="stable").tolist()):
        out[rows[at == cluster], k] = 1
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, kinds: int = KINDS, max_words: int = MAX_WORDS) -> Chain:
    """Words are chosen, and indicators made, on the executors; bits of at most ``sample`` rows are gathered."""
    chosen = labelled_sample(labels, "toxic", sample)
    texts = as_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "_utf8")

    def distinct(batches):
        for b in sliced(batches):
            sets = [sorted(features_of(raw)) for raw in b.column("_utf8").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(sets, pa.list_(pa.binary()))], names=["doc_id", "label", "words"])

    rows = materialize(texts.mapInArrow(distinct, "doc_id long, label int, words array<binary>"), "toxicity-sample")
    n_bad, n_good = rows.agg(F.greatest(F.sum("label"), F.lit(1)), F.greatest(F.sum(1 - F.col("label")), F.lit(1))).first()
    counts = rows.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    # Words by the difference of their shares among toxic and other texts, in standard errors; ties by the word.
    gap = F.abs(F.col("bad") / F.lit(n_bad or 1) - F.col("good") / F.lit(n_good or 1)) / F.sqrt(F.col("bad") + F.col("good"))
    words = [bytes(r["word"]) for r in counts.where("bad + good >= 3").orderBy(gap.desc(), "word").limit(max_words).select("word").collect()]
    at = {w: i for i, w in enumerate(words)}

    def bits(batches):
        for b in sliced(batches):
            x = np.zeros((b.num_rows, len(at)), dtype=bool)
            for row, own in enumerate(b.column("words").to_pylist()):
                x[row, [at[w] for w in at.keys() & own]] = True
            packed = [r.tobytes() for r in np.packbits(x, axis=1)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(packed, pa.binary())], names=["doc_id", "label", "bits"])

    got = rows.mapInArrow(bits, "doc_id long, label int, bits binary").orderBy("doc_id", "bits").limit(sample).toArrow()
    discard(rows)
    raw = np.frombuffer(b"".join(got["bits"].to_pylist()), np.uint8).reshape(len(got), -(-len(words) // 8))
    x, toxic = np.unpackbits(raw, axis=1)[:, : len(words)].astype(np.float32), got["label"].to_numpy().astype(np.float64)
    y = np.column_stack([kinds_of(x, toxic, kinds), toxic])
    return fit_chain((*(f"kind_{k + 1}" for k in range(kinds)), "toxic"), words, x, y)


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, a probability per link, and whether the last one is over ``threshold``."""
    shared, names = docs.sparkSession.sparkContext.broadcast(chain), [f"p_{n}" for n in chain.names]

    def run(batches):
        for b in sliced(batches):
            p = shared.value.probabilities(shared.value.indicators([features_of(raw) for raw in b.column("_utf8").to_pylist()]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(p[:, k]) for k in range(p.shape[1]))], names=["doc_id", *names])

    rows = as_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    scored = rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} double" for n in names))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *names, (F.col(names[-1]) > threshold).alias("toxic"))


def detect(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    return score(docs, train(docs, labels, sample), threshold)
