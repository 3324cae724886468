"""Token counts by a linear longest-match automaton.

The vocabulary is a byte trie. Every node carries a failure link and the number of pieces that greedy
longest match is then sure of; both are computed beforehand. A word is read once, byte by byte: where
a node has no child for the byte, its sure pieces are counted and the failure link followed. No piece
is ever built. Distinct words of a batch are read in lock-step, but for the ends of the few longest, and each
batch counts a word once.

A text's words are its runs without ASCII white space, each taken with one leading space, as byte-level
vocabularies hold them. The vocabulary must hold every single byte, as byte-level ones do, so greedy
matching never fails.

Defined results: a null or empty text, or one of white space, has no words and no pieces; each row is
counted for itself, repeated rows and null ids included; an empty table gives no rows; other columns
are ignored. Texts are read whole; there is no shuffle, so hot keys cost nothing.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: While more words than this go on, they are read in lock-step; the rest of the longest ones is read word by word.
FEW = 64


def byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


def byte_vocabulary(path: str) -> list[bytes]:
    """The entries of a byte-level BPE vocabulary file as byte strings."""
    symbols = byte_of_symbol()
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["model"]["vocab"]
    return [bytes(symbols[c] for c in t) for t in tokens if t and all(c in symbols for c in t)]


class LongestMatch:
    """Flat automaton: sorted edge keys node * 256 + byte, their targets, failure links, sure pieces."""

    def __init__(self, vocabulary: list[bytes]):
        children: list[dict[int, int]] = [{}]
        word = [False]
        for entry in vocabulary:
            node = 0
            for byte in entry:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    word.append(False)
                node = children[node][byte]
            word[node] = node != 0
        if len(children[0]) < 256 or not all(word[n] for n in children[0].values()):
            raise ValueError("the vocabulary must hold every single byte")
        fail, sure = [-1] * len(children), [0] * len(children)
        level = [0]
        while level:
            below = []
            for u in level:
                for byte, v in children[u].items():
                    if word[v]:
                        fail[v], sure[v] = 0, 1
                    else:
                        z, n = fail[u], sure[u]
                        while z >= 0 and byte not in children[z]:
                            n, z = n + sure[z], fail[z]
                        if z >= 0:
                            fail[v], sure[v] = children[z][byte], n
                    below.append(v)
            level = below
        edges = sorted((u * 256 + b, v) for u, c in enumerate(children) for b, v in c.items())
        self.keys, self.targets = (np.array(x, dtype=np.int64) for x in zip(*edges))
        self.fail, self.sure = np.array(fail, dtype=np.int64), np.array(sure, dtype=np.int64)
        self.edges, self.fails, self.sures = dict(edges), fail, sure

    def _child(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        want = nodes * 256 + byte
        at = np.searchsorted(self.keys, want)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == want, self.targets[at], -1)

    def _read_on(self, node: int, rest: bytes) -> tuple[int, int]:
        """The node after ``rest`` is read from ``node``, and the pieces counted on the way."""
        child, pieces = self.edges.get, 0
        for byte in rest:
            while (to := child(node * 256 + byte)) is None:
                pieces, node = pieces + self.sures[node], self.fails[node]
            node = to
        return node, pieces

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Pieces of each word data[offsets[i]:offsets[i+1]], each after one space; empty words have none."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = offsets[:-1][order], lengths[order]
        pieces = np.zeros(len(order), dtype=np.int64)
        nodes = np.zeros(len(order), dtype=np.int64)
        live = np.searchsorted(-lengths, 0, side="left")  # words with a byte
        nodes[:live] = self._child(nodes[:live], np.full(live, 0x20))
        for i in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -i, side="left"))
            if live <= FEW:
                for row in range(live):
                    rest = data[starts[row] + i : starts[row] + lengths[row]].tobytes()
                    nodes[row], more = self._read_on(int(nodes[row]), rest)
                    pieces[row] += more
                break
            byte = data[starts[:live] + i].astype(np.int64)
            rows = np.arange(live)
            while len(rows):
                to = self._child(nodes[rows], byte[rows])
                nodes[rows[to >= 0]] = to[to >= 0]
                rows = rows[to < 0]
                pieces[rows] += self.sure[nodes[rows]]
                nodes[rows] = self.fail[nodes[rows]]
        rows = np.flatnonzero(nodes > 0)
        while len(rows):
            pieces[rows] += self.sure[nodes[rows]]
            nodes[rows] = self.fail[nodes[rows]]
            rows = rows[nodes[rows] > 0]
        out = np.zeros_like(pieces)
        out[order] = pieces
        return out


_BUILT: dict[str, LongestMatch] = {}


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes, n_words and n_pieces of every row of ``docs``."""

    def run(batches):
        if vocabulary not in _BUILT:
            _BUILT[vocabulary] = LongestMatch(byte_vocabulary(vocabulary))
        automaton = _BUILT[vocabulary]
        for b in batches:
            texts = pc.fill_null(b.column("text"), "")
            cut = pc.split_pattern_regex(texts, "[\\x09-\\x0D ]") if pc.any(pc.match_substring_regex(texts, "[\\x09\\x0B-\\x0D]")).as_py() else pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            coded = cut.flatten().dictionary_encode()
            words = coded.dictionary.cast(pa.large_binary())
            offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
            data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
            pieces = automaton.counts(data, offsets) if len(words) else np.zeros(0, np.int64)
            codes = coded.indices.to_numpy(zero_copy_only=False)
            at = cut.offsets.to_numpy() - cut.offsets[0].as_py()
            per = lambda values: np.diff(np.append(0, np.cumsum(values[codes]))[at])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(per((np.diff(offsets) > 0).astype(np.int64))), pa.array(per(pieces))],
                names=["doc_id", "n_bytes", "n_words", "n_pieces"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_words long, n_pieces long")
