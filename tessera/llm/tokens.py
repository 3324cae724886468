"""Token ids of whole texts by the tokenizers library, each distinct word encoded once while it is remembered.

Byte-level BPE and BPE with word ends encode every pre-token by itself, so the ids of a text are the
joined ids of its pieces between safe cut points: a space, or a line feed, between two characters
that are not white space, and the place before the ASCII punctuation that ends a piece. Distinct
pieces go to the library many at a time. What is learned stays in two generations of flat arrays under
a budget of bytes: pieces that are met again move to the newer one, and the older one is dropped when the
newer one is full. Texts with other white space, or with an added token of the tokenizer's file, are
given to the library whole where a cut could change their ids.
"""

from __future__ import annotations

import json
import os
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that remembered pieces take per process, and bytes of text encoded at a time.
BUDGET, SLICE = 48 << 20, 8 << 20
#: Longer pieces, in bytes, are not remembered; so many pieces go to the library in one text.
LONG, JOINED = 64, 1000
_PUNCT = string.punctuation
#: A piece is cut before its last punctuation only after one of these; U+0130 becomes a letter and a mark in lower case.
_WORD_END = r"[0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]$"
_OTHER_SPACE = r"[\t\x0B\x0C\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_OPEN: dict[str, "TextEncoder"] = {}


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each pair, joined."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class _Generation:
    """Pieces and their ids: piece i has ids[start[i] : start[i] + length[i]]."""

    def __init__(self, kind: type):
        self.keys = pa.array([], pa.string())
        self.start, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, kind)

    def find(self, pieces: pa.Array) -> np.ndarray:
        """The place of each piece, -1 where it is unknown."""
        if not len(self.keys):
            return np.full(len(pieces), -1, np.int64)
        return pc.fill_null(pc.index_in(pieces, value_set=self.keys), -1).to_numpy().astype(np.int64)

    def add(self, pieces: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The places of new pieces."""
        at = np.arange(len(self.keys), len(self.keys) + len(pieces))
        self.keys = pa.concat_arrays([self.keys, pieces])
        self.start = np.append(self.start, len(self.ids) + np.cumsum(lengths) - lengths)
        self.length = np.append(self.length, lengths.astype(np.int32))
        self.ids = np.append(self.ids, ids.astype(self.ids.dtype))
        return at

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[at].astype(np.int64)
        return self.ids[spread(self.start[at], lengths)], lengths

    @property
    def size(self) -> int:
        return self.keys.nbytes + self.start.nbytes + self.length.nbytes + self.ids.nbytes


class TextEncoder:
    def __init__(self, path: str, budget: int = BUDGET):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            suffix = json.load(f)["model"].get("end_of_word_suffix")
        self.word_ends, self.budget = bool(suffix), budget
        self.added = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        most = max(vocab.values(), default=0)
        self.kind = np.uint16 if most < 1 << 16 else np.uint32
        self.marked = np.zeros(most + 2, dtype=bool)
        for token, i in vocab.items():
            # U+0120 stands for a leading space in byte-level vocabularies.
            self.marked[i] = token.endswith(suffix) if suffix else token.startswith("Ġ")
        self.new, self.old = _Generation(self.kind), _Generation(self.kind)
        self.newline = self._alone(["\n"])[0]

    @classmethod
    def open(cls, path: str) -> "TextEncoder":
        """One encoder per path and worker process."""
        if path not in _OPEN:
            _OPEN[path] = cls(path)
        return _OPEN[path]

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(e.ids, dtype=self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(ids) if ids else np.zeros(0, self.kind), np.array([len(x) for x in ids], dtype=np.int64)

    def _joined(self, pieces: pa.Array, lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that each give one marked id after ``lead``: many in one text, cut at their marks."""
        cuts = list(range(0, len(pieces), JOINED)) + [len(pieces)]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pieces), lead).to_pylist()
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b, text in zip(cuts, cuts[1:], texts):
            ids = self._alone([lead + text])[0]
            marks = np.flatnonzero(ids == self.newline[0] if lead == "\n" else self.marked[ids])
            if len(marks) == b - a:
                out.append((ids, np.diff(marks, prepend=-1) if self.word_ends else np.diff(marks, append=len(ids))))
            else:
                out.append(self._alone([lead + p for p in pieces.slice(a, b - a).to_pylist()]))
        return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])

    def _learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, joined, and how many each has."""
        if self.word_ends:
            plain = pc.match_substring_regex(pieces, r"^\pL+$")
            ways = [(plain, lambda p: self._joined(p, " ")), (pc.invert(plain), lambda p: self._alone(p.to_pylist()))]
        else:
            bare = pc.is_in(pieces, value_set=pa.array(["", "\n"]))
            line = pc.and_not(pc.starts_with(pieces, "\n"), bare)
            rest = pc.invert(pc.or_(bare, line))
            ways = [(bare, lambda p: self._alone(p.to_pylist())), (line, lambda p: self._joined(pc.binary_replace_slice(p, 0, 1, ""), "\n")), (rest, lambda p: self._joined(p, " "))]
        return self._parted(pieces, [(np.flatnonzero(mask.to_numpy(zero_copy_only=False)), how) for mask, how in ways])

    @staticmethod
    def _parted(texts: pa.Array, parts: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in their order, each text's by the way that its part names."""
        lengths, starts, joined, base = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [], 0
        for rows, how in parts:
            if len(rows):
                ids, n = how(texts if len(rows) == len(texts) else texts.take(pa.array(rows)))
                if len(rows) == len(texts):
                    return ids, n
                lengths[rows], starts[rows] = n, base + np.cumsum(n) - n
                joined.append(ids)
                base += len(ids)
        return np.concatenate(joined)[spread(starts, lengths)], lengths

    def _known(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A buffer of ids, and where the ids of each distinct key begin there and how many they are."""
        if self.new.size > self.budget // 2:
            self.old, self.new = self.new, _Generation(self.kind)
        at = self.new.find(keys)
        out = np.flatnonzero(at < 0)
        if len(out):
            before = self.old.find(keys.take(pa.array(out)))
            back = before >= 0
            if back.any():
                at[out[back]] = self.new.add(keys.take(pa.array(out[back])), *self.old.gather(before[back]))
                out = out[~back]
        extra = start = length = None
        if len(out):
            missing = keys.take(pa.array(out))
            ids, n = self._learn(missing)
            short = pc.binary_length(missing).to_numpy() <= LONG
            starts = np.cumsum(n) - n
            if short.all():
                at[out] = self.new.add(missing, ids, n)
            else:
                at[out[short]] = self.new.add(missing.filter(pa.array(short)), ids[spread(starts[short], n[short])], n[short])
                extra, start, length = ids, starts, n
        known = at >= 0
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[known], count[known] = self.new.start[at[known]], self.new.length[at[known]]
        if extra is None:
            return self.new.ids, first, count
        first[out[~short]], count[out[~short]] = len(self.new.ids) + start[~short], length[~short]
        return np.append(self.new.ids, extra), first, count

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.word_ends:
            cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        else:
            # Every line, the first included, becomes a piece that begins with a line feed.
            cut = pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), ""), " ")
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary
        cores = pc.ascii_rtrim(pieces, _PUNCT)
        tailed = pc.and_(pc.not_equal(cores, pieces), pc.match_substring_regex(cores, _WORD_END))
        keys = pc.if_else(tailed, cores, pieces)
        if self.word_ends:
            keys = pc.if_else(pc.string_is_ascii(keys), pc.ascii_lower(keys), keys)
        keys = keys.dictionary_encode()
        buffer, first, count = self._known(keys.dictionary)
        of = keys.indices.to_numpy()
        first, count, with_tail = first[of], count[of], np.flatnonzero(tailed.to_numpy(zero_copy_only=False))
        if len(with_tail):
            some = pa.array(with_tail)
            tails = pa.array([p[len(c) :] for p, c in zip(pieces.take(some).to_pylist(), cores.take(some).to_pylist())], pa.string()).dictionary_encode()
            ids, n = self._alone(tails.dictionary.to_pylist())
            starts, lengths = np.zeros((len(pieces), 2), np.int64), np.zeros((len(pieces), 2), np.int64)
            starts[:, 0], lengths[:, 0] = first, count
            which = tails.indices.to_numpy()
            starts[with_tail, 1], lengths[with_tail, 1] = len(buffer) + (np.cumsum(n) - n)[which], n[which]
            buffer = np.append(buffer, ids)[spread(starts.ravel(), lengths.ravel())]
            count = lengths.sum(axis=1)
            first = np.cumsum(count) - count
        met = coded.indices.to_numpy()
        lengths = count[met]
        ids = buffer[spread(first[met], lengths)]
        at = np.append(0, np.cumsum(lengths))[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        if self.word_ends:
            return ids, np.diff(at)
        keep = np.ones(len(ids), bool)
        keep[at[:-1]] = False  # the line feed that each text was given
        return ids[keep], np.diff(at) - 1

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, joined, and how many each has; a null is an empty text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = pc.fill_null(texts, "")
        group = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // SLICE
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        parts = [self._slice(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])]
        return np.concatenate([p[0] for p in parts]).astype(np.uint32), np.concatenate([p[1] for p in parts])

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = pa.array(np.zeros(len(texts), bool))
        for token in self.added:
            # Looked for in any case, since a file may lower-case texts before it matches.
            whole = pc.or_(whole, pc.match_substring(texts, token, ignore_case=True))
        if not self.word_ends:
            whole = pc.or_(whole, pc.match_substring_regex(texts, _OTHER_SPACE))
            for pair in ("  ", "\n\n", " \n", "\n "):
                whole = pc.or_(whole, pc.match_substring(texts, pair))
            for edge in (" ", "\n"):
                whole = pc.or_(whole, pc.or_(pc.starts_with(texts, edge), pc.ends_with(texts, edge)))
        mask = whole.to_numpy(zero_copy_only=False)
        return self._parted(texts, [(np.flatnonzero(~mask), self._by_pieces), (np.flatnonzero(mask), lambda t: self._alone(t.to_pylist()))])
