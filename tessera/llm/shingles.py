"""Hashed word shingles of whole texts, vectorised over a batch.

Words are maximal runs of bytes other than ASCII white space, A-Z lower-cased. Each distinct word of a
chunk is hashed once, to 64 bits by XXH3; a shingle's hash is a mixed linear form, with odd factors, of
the hashes of its words. A text of fewer words than the width, but at least one, is one shingle of all
its words. For words whose hashes behave like random numbers two different shingles share a hash with
a probability of about 2^-64; XXH3 is no cryptographic hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_CHUNK = 1 << 20
_LUT = np.arange(256, dtype=np.uint8)
_LUT[0x41:0x5B] += 0x20
_LUT[0x09:0x0E] = 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the position where it starts."""
    data = _LUT[np.frombuffer(raw, np.uint8)]
    solid = np.concatenate([[False], data != 0x20, [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.append(0, np.cumsum(ends - starts))
    kind, small = (pa.binary(), np.int32) if offsets[-1] < 2**31 else (pa.large_binary(), np.int64)
    words = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(offsets.astype(small)), pa.py_buffer(data[solid[1:-1]])])
    coded = words.dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return hashes[coded.indices.to_numpy()], starts


def _sets_of(raws: list[bytes], width: int, levels: np.ndarray | None) -> list[tuple[np.ndarray, np.ndarray | None]]:
    sizes = np.array([len(r) + 1 for r in raws], dtype=np.int64)
    words, starts = word_hashes(b" ".join(raws))
    bounds = np.searchsorted(starts, np.append(0, np.cumsum(sizes)))
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    n = max(len(words) - width + 1, 0)
    forms = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        forms += words[j : j + n] * factors[j]
    forms = mix(forms)
    common = None
    if levels is not None:
        level = levels[(words & np.uint64(len(levels) - 1)).astype(np.int64)].astype(np.int32)
        common = np.zeros(n, dtype=np.int32)
        for j in range(width):
            common += level[j : j + n]
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        k = b - a
        if k >= width and common is None:
            out.append((np.unique(forms[a : b - width + 1]), None))
        elif k >= width:
            own, at = np.unique(forms[a : b - width + 1], return_index=True)
            out.append((own, common[a + at]))
        elif k:
            out.append((mix((words[a:b] * factors[:k]).sum(dtype=np.uint64, keepdims=True) + np.uint64(k)), np.zeros(1, np.int32)))
        else:
            out.append((np.zeros(0, dtype=np.uint64), np.zeros(0, np.int32)))
    return out


def _chunks(raws: list[bytes | None]):
    chunk: list[bytes] = []
    size = 0
    for raw in raws:
        chunk.append(raw or b"")
        size += len(raw or b"") + 1
        if size >= _CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def shingle_sets(raws: list[bytes | None], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; none for texts without words."""
    with np.errstate(over="ignore"):
        return [s for chunk in _chunks(raws) for s, _ in _sets_of(chunk, width, None)]


def weighed_sets(raws: list[bytes | None], width: int, levels: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sets as from ``shingle_sets``, with the sum of each shingle's word levels by ``levels``, a table by word hash."""
    with np.errstate(over="ignore"):
        return [s for chunk in _chunks(raws) for s in _sets_of(chunk, width, levels)]


def word_table(raws: list[bytes | None], bits: int) -> np.ndarray:
    """Counts of words by the low bits of their hashes."""
    out = np.zeros(1 << bits, dtype=np.int64)
    with np.errstate(over="ignore"):
        for chunk in _chunks(raws):
            words, _ = word_hashes(b" ".join(chunk))
            out += np.bincount((words & np.uint64(len(out) - 1)).astype(np.int64), minlength=len(out))
    return out
