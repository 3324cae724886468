"""The k rows of highest dot product with each of a block of queries, over the Arrow batches of one task.

A matrix product finds which rows can be among the k; only their scores are then summed as the engine's ``dot``
sums them, so that the scores are those of the plain comparison to the last bit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Rows and queries whose products are held at once.
ROWS, QUERIES = 8192, 256
#: Pairs that are summed exactly at once.
PAIRS = 1 << 15
#: Scores that differ by more are in the same order after rounding to six places.
ROUNDING = 2e-6
#: Components beyond this may give infinite products: such vectors are always summed exactly.
HUGE = 1e140


def vectors_by_length(column: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Positions and matrix of the vectors of each length; null vectors, and those with null components, at -1."""
    at, null = np.asarray(column.offsets), np.asarray(column.is_null())
    empty = np.concatenate([[0], np.cumsum(np.asarray(column.values.is_null()))])
    length = np.where(null | (empty[at[1:]] > empty[at[:-1]]), -1, np.diff(at))
    values = column.values.to_numpy(zero_copy_only=False)
    out = {}
    for n in map(int, np.unique(length)):
        rows = np.flatnonzero(length == n)
        out[n] = rows, values[at[rows][:, None] + np.arange(max(n, 0))]
    return out


def _wild(x: np.ndarray) -> np.ndarray:
    return ~(np.abs(x) < HUGE).all(axis=1)


def _least(group: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Of rows sorted by group and id, whether any query can need them: k rows of each id, k + 1 ids of each group."""
    n = np.arange(len(ids))
    first = np.ones(len(ids), bool)
    first[1:] = group[1:] != group[:-1]
    other = first.copy()
    other[1:] |= ids[1:] != ids[:-1]
    repeat = n - np.maximum.accumulate(np.where(other, n, 0))
    place = np.cumsum(other)
    return (repeat < k) & (place - np.maximum.accumulate(np.where(first, place, 0)) <= k)


class _Queries:
    """Queries of one length, and the best rows of each so far."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.ids, self.matrix, self.k = ids, matrix, k
        self.wild = _wild(matrix)
        self.tame = np.where(self.wild[:, None], 0.0, matrix)
        self.norms = np.sqrt((self.tame**2).sum(axis=1))
        self.best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(ids)
        self.least = np.full(len(ids), -np.inf)
        self.unscored: np.ndarray | None = None

    def pass_over(self, ids: np.ndarray) -> None:
        """Rows without a score: they rank last, by id."""
        ids = np.sort(ids if self.unscored is None else np.concatenate([self.unscored, ids]), kind="stable")
        self.unscored = ids[_least(np.zeros(len(ids)), ids, self.k)]

    def compare(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Rows of this length, in the order of their ids."""
        if x.shape[1]:  # of equal vectors few can be needed
            same = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, 8 * x.shape[1]))).ravel(), return_inverse=True)[1].ravel()
            order = np.argsort(same, kind="stable")
            keep = np.sort(order[_least(same[order], ids[order], self.k)])
            ids, x = ids[keep], x[keep]
        wild = _wild(x)
        tame = np.where(wild[:, None], 0.0, x)
        reach = np.sqrt((tame**2).sum(axis=1)).max() * 8 * (x.shape[1] + 2) * np.finfo(float).eps
        low, high = np.searchsorted(ids, self.ids, "left"), np.searchsorted(ids, self.ids, "right")
        for q in range(0, len(self.ids), QUERIES):
            part = slice(q, q + QUERIES)
            products = self.tame[part] @ tame.T
            products[:, wild] = -np.inf
            selves = [(i, slice(low[q + i], high[q + i])) for i in np.flatnonzero(high[part] > low[part])]
            for i, own in selves:
                products[i, own] = -np.inf
            least = self.least[part].copy()
            new = np.flatnonzero(np.isneginf(least))
            if len(new) and len(ids) > self.k:
                least[new] = np.partition(products[new], len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            met = products >= (least - ROUNDING - reach * self.norms[part])[:, None]
            met[:, wild] = True
            met[self.wild[part]] = True
            for i, own in selves:
                met[i, own] = False
            a, b = np.nonzero(met)
            scores = np.zeros(len(a))
            for p in range(0, len(a), PAIRS):
                left, right, total = self.matrix[part][a[p : p + PAIRS]], x[b[p : p + PAIRS]], scores[p : p + PAIRS]
                with np.errstate(all="ignore"):
                    for j in range(x.shape[1]):
                        total += left[:, j] * right[:, j]
            cuts = np.flatnonzero(np.diff(a, prepend=-1)).tolist() + [len(a)]
            for s, e in zip(cuts[:-1], cuts[1:]):
                self._merge(q + int(a[s]), scores[s:e], ids[b[s:e]])

    def _merge(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.best[q] is not None:
            scores, ids = np.concatenate([self.best[q][0], scores]), np.concatenate([self.best[q][1], ids])
        order = np.argsort(ids, kind="stable")
        nan = np.isnan(scores[order])
        order = order[np.lexsort((-np.where(nan, 0.0, scores[order]), ~nan))]  # NaN is the largest
        scores, ids = scores[order], ids[order]
        n = np.arange(len(ids))
        other = np.ones(len(ids), bool)
        other[1:] = (scores[1:] != scores[:-1]) & ~(np.isnan(scores[1:]) & np.isnan(scores[:-1]))
        keep = n - np.maximum.accumulate(np.where(other, n, 0)) < self.k
        if len(ids) >= self.k:
            last = scores[self.k - 1]
            keep &= np.isnan(scores) | (scores >= last - ROUNDING)
            self.least[q] = np.inf if np.isnan(last) else last
        self.best[q] = scores[keep], ids[keep]

    def found(self):
        """Query id, row ids and scores, None for rows without one."""
        for q, own in enumerate(self.ids):
            scores, ids = self.best[q] if self.best[q] is not None else (np.zeros(0), self.ids[:0])
            if len(ids):
                yield own, ids, scores
            if len(ids) < self.k and self.unscored is not None:
                yield own, self.unscored[self.unscored != own][: self.k], None


def compared(ids: pa.Array, vectors: pa.ListArray, k: int, schema: pa.Schema):
    """A function of batches of id and vector that gives, by query, all rows that can be among its k best, with their scores."""

    def run(batches):
        names = ids.to_numpy(zero_copy_only=False)
        queries = {n: _Queries(names[at], x, k) for n, (at, x) in vectors_by_length(vectors).items()}
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                b = whole.slice(start, ROWS)
                have = b.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(have, kind="stable")
                b, have = b.take(pa.array(order)), have[order]
                found = vectors_by_length(b.column(1))
                for n, some in queries.items():
                    scored = found[n][0] if n >= 0 and n in found else np.zeros(0, int)
                    if len(scored):
                        some.compare(have[scored], found[n][1])
                    if len(scored) < len(have):
                        some.pass_over(np.delete(have, scored))
        rows = [r for some in queries.values() for r in some.found()]
        for s in range(0, len(rows), 1024):
            part = rows[s : s + 1024]
            size = [len(r[1]) for r in part]
            columns = [np.repeat(np.array([r[0] for r in part], names.dtype), size), np.concatenate([r[1] for r in part])]
            scores = pa.concat_arrays([pa.nulls(len(r[1]), pa.float64()) if r[2] is None else pa.array(r[2]) for r in part])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)] + [scores], schema=schema)

    return run
