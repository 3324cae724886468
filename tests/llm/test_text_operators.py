"""Decontamination, token counts, secrets, shingles and joins against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import decontaminate, ngram_join, secrets, token_counts
from tessera.llm.queries import public_tokenizer
from tessera.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, windows string, _utf8 int, part int, spans int, label string, token int, n int"


def _docs(spark, rows):
    """Rows of (id, text) with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "w", 1, 2, 3, "l", 4, 5) for i, t in rows], DOCS)


def _contamination(docs, items, window, one_in):
    out = {}
    keys = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        for i in range(max(len(words) - window, 0) + 1 if words else 0):
            keys.setdefault(tuple(words[i : i + window]), set()).add(str(item))
    for doc, text in docs:
        words, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
        for key, ids in keys.items():
            for i in range(len(words) - len(key) + 1):
                if tuple(words[i : i + len(key)]) == key:
                    hit.update(range(i, i + len(key)))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(found), digest, bool(hit) and one_in * len(hit) >= len(words))
    return out


@pytest.mark.parametrize("max_bytes", [1 << 20, 40])
def test_contamination_against_brute_force(spark, max_bytes):
    rng = random.Random(3)
    words = ["a", "B", "é", "x1", "c", "Don't", "zü"]
    text = lambda n: rng.choice([" ", ", ", "-"]).join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.randint(1, 6))) for i in range(12)] + [(20, None), (21, "..."), (22, "a b"), (23, "a b")]
    docs = [(i, text(rng.choice([1, 3, 30, 200]))) for i in range(60)] + [(100, None), (101, ""), (102, "!!"), (103, " ab ab")]
    found = decontaminate.find_contamination(_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string"), 3, 2, max_bytes)
    want = _contamination(docs, items, 3, 2)
    for r in found.collect():
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == want[r["doc_id"]]
        original = dict(docs)[r["doc_id"]]
        assert sum(len(WORD.findall(original[s["start"] : s["end"]].translate(LOWER))) for s in r["spans"]) == r["n_hit"]
    kept = decontaminate.drop_contaminated(_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string"), 3, 2, max_bytes)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, v in want.items() if not v[4])


@pytest.mark.parametrize("max_bytes", [1 << 20, 8])
def test_rows_with_null_and_repeated_ids_are_judged_by_their_own_text(spark, max_bytes):
    docs = [(None, "a b c"), (None, "clean one"), (1, "a b c"), (1, "clean two"), (1, "clean two"), (2, "x y z"), (2, "x y z"), (3, None), (None, None)]
    items = spark.createDataFrame([(1, "a b c"), (2, "x y z"), (3, "q r s")], "item_id long, text string")
    rows = _docs(spark, docs).withColumn("_row", F.lit(7))
    kept = decontaminate.drop_contaminated(rows, items, 3, 2, max_bytes)
    assert kept.columns == rows.columns
    want = [(i, t, "w", 1, 2, 3, "l", 4, 5, 7) for i, t in docs if t not in ("a b c", "x y z")]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


def test_contamination_of_empty_tables(spark):
    none, items = _docs(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(none, items).count() == 0
    assert decontaminate.find_contamination(_docs(spark, [(1, "a")]), items).first()["contaminated"] is False


def _greedy(word: bytes, vocabulary: set[bytes]) -> int:
    at = n = 0
    most = max(map(len, vocabulary))
    while at < len(word):
        at = next(e for e in range(min(len(word), at + most), at, -1) if word[at:e] in vocabulary)
        n += 1
    return n


def test_longest_match_against_greedy_search():
    rng = random.Random(5)
    vocabulary = {bytes([b]) for b in range(256)} | {bytes(rng.choice(b"abc ") for _ in range(rng.randint(2, 6))) for _ in range(60)}
    automaton = token_counts.LongestMatch(sorted(vocabulary))
    words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 14))) for _ in range(500)] + [b"a" * 3000]
    counts = automaton.counts(np.frombuffer(b"".join(words), np.uint8), np.append(0, np.cumsum([len(w) for w in words])))
    assert counts.tolist() == [_greedy(b" " + w, vocabulary) if w else 0 for w in words]


@pytest.mark.parametrize("few", [0, 3, 64])
def test_long_words_against_greedy_search(monkeypatch, few):
    monkeypatch.setattr(token_counts, "FEW", few)
    rng = random.Random(6)
    vocabulary = {bytes([b]) for b in range(256)} | {bytes(rng.choice(b"ab ") for _ in range(rng.randint(2, 9))) for _ in range(40)}
    automaton = token_counts.LongestMatch(sorted(vocabulary))
    words = [bytes(rng.choices(b"abc", k=n)) for n in (0, 1, 5, 40_000, 40_000, 3, 17, 20_001)]
    counts = automaton.counts(np.frombuffer(b"".join(words), np.uint8), np.append(0, np.cumsum([len(w) for w in words])))
    assert counts.tolist() == [_greedy(b" " + w, vocabulary) if w else 0 for w in words]


def test_a_text_that_is_one_word_of_four_million_bytes(spark):
    path = public_tokenizer("byte_bpe_50k.json")
    word = "".join(random.Random(7).choices("abcdefghij0123456789", k=100_000))
    vocabulary = set(token_counts.byte_vocabulary(path))
    docs = [(1, word * 40), (2, word)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_words"], r["n_pieces"]) for r in token_counts.count_tokens(_docs(spark, docs), path).collect()}
    assert got[2] == (100_000, 1, _greedy(b" " + word.encode(), vocabulary)) and got[1][:2] == (4_000_000, 1) and got[1][2] > 39 * got[2][2]


def test_token_counts_of_documents(spark):
    path = public_tokenizer("byte_bpe_50k.json")
    vocabulary = set(token_counts.byte_vocabulary(path))
    docs = [(1, "The quick\tbrown\n fox"), (2, None), (3, ""), (4, " \n "), (5, "éé thandered " * 50), (5, "éé thandered " * 50), (None, "x")]
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["n_pieces"]) for r in token_counts.count_tokens(_docs(spark, docs), path).collect()))
    want = sorted((i or 0, len((t or "").encode().split()), sum(_greedy(b" " + w, vocabulary) for w in (t or "").encode().split())) for i, t in docs)
    assert got == want
    assert token_counts.count_tokens(_docs(spark, []), path).count() == 0


KINDS = {
    "assign": re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def _base(text):
    spans = []
    for rank, (kind, pattern) in enumerate(KINDS.items()):
        for m in pattern.finditer(text or ""):
            long = len(m[2]) >= 6 if kind == "assign" else m.end() - m.start() >= (20 if kind == "access" else 24)
            if long:
                spans.append((m.start(), rank, kind, m.end()))
    return sorted(spans)


def _entropy(word, window=20):
    best = 0.0
    for i in range(len(word) - window + 1):
        part = word[i : i + window]
        best = max(best, -sum(part.count(c) / window * math.log2(part.count(c) / window) for c in set(part)))
    return best


def test_base_secrets_against_python(spark):
    rng = random.Random(8)
    bits = ["password", "Secret", "TOKEN", "api_key", "apikey", ":", "=", " ", '"', "'", "abc", "0123456789abcdef01234567", "AKIA", "ABCDEFGH12345678", "é😀", "\n", "passwd", "deadbeefdeadbeefdeadbeefdead", "x"]
    docs = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))) for i in range(600)] + [(1000, None), (1001, "secret=token: abcdefgh")]
    got = {r["doc_id"]: r for r in secrets.find_secrets(_docs(spark, docs)).collect()}
    for i, text in docs:
        assert [tuple(s) for s in got[i]["base"]] == _base(text), text
        assert set(map(tuple, got[i]["base"])) <= set(map(tuple, got[i]["spans"]))
    digest = {r["doc_id"]: r for r in secrets.secret_digest(secrets.find_secrets(_docs(spark, docs))).collect()}
    for i, text in docs:
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in _base(text))
        assert digest[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_window_entropy_against_python(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcXYZ0123") for _ in range(rng.randint(15, 60))) for _ in range(80)] + ["a" * 20]
    for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", secrets.max_entropy(F.col("w")).alias("e")).collect():
        assert (r["e"] is None) == (len(r["w"]) < 20)
        assert r["e"] is None or abs(r["e"] - _entropy(r["w"])) < 1e-9


def test_entropy_spans_and_allow_list(spark):
    key = "q7Zp1LmX9vRt4KsW2yBn8Hd"
    docs = [(1, f"é use {key} now"), (2, "123e4567-e89b-12d3-a456-426614174000"), (3, "12345678901234567890123"), (4, f"example{key}"), (5, f"token={key}"), (6, "thelongestwordsofprose1aaaaaaaaaaaa")]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.find_secrets(_docs(spark, docs)).collect()}
    assert got[1] == [("entropy", 6, 6 + len(key))] and got[2] == got[3] == got[4] == got[6] == []
    assert got[5] == [("assign", 0, 6 + len(key))]


def test_entropy_spans_of_letters_and_of_keys_with_a_slash(spark):
    letters, slash = "qZpLmXvRtKsWyBnHdGfJcTeUa", "/q7Zp1LmX9vRt4KsW2yBn8Hd+Gf"
    docs = [(1, f"use {letters} now"), (2, f"use {slash} now"), (3, "/usr/local/lib64/python3/site"), (4, "/Users/Shared/docs2/report2024"), (5, letters.lower()), (6, "Thelongestwordsofproseareplain"), (7, f"x {letters[:12]}/{letters[12:]}== y")]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secrets.find_secrets(_docs(spark, docs)).collect()}
    assert got[1] == [("entropy", 4, 4 + len(letters))] and got[2] == [("entropy", 4, 4 + len(slash))] and got[7] == [("entropy", 2, 2 + len(letters) + 3)]
    assert got[3] == got[4] == got[5] == got[6] == []
    assert {r["doc_id"]: r["text"] for r in secrets.redact(_docs(spark, docs).select("doc_id", "text")).collect()}[2] == "use [SECRET] now"


ENTROPY = {"letters": 3.9, "hex": 3.0, "alnum": 3.6, "base64": 3.8}


def _all_spans(text):
    """Base spans and the entropy spans that the docstring of the module describes, by plain Python."""
    base, more = _base(text), []
    for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}", text or ""):
        word = m[0].rstrip("=")
        digit, lower, upper = (any(c in s for c in word) for s in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        if not digit and not (lower and upper) or any(a < m.end() and m.start() < b for a, _, _, b in base):
            continue
        kind = "letters" if not digit else "hex" if re.fullmatch("[0-9a-fA-F]+", m[0]) else "alnum" if re.fullmatch("[A-Za-z0-9]+", m[0]) else "base64"
        if _allowed(m[0]):
            continue
        if _entropy(word) >= ENTROPY[kind] - 1e-9:
            more.append((m.start(), 3, "entropy", m.end()))
    return sorted(base + more)


def _allowed(word):
    placeholder = r"(?i:example|sample|dummy|placeholder|changeme|redacted|test_?key|xxxx|abcdefghij)|0123456789|1234567890"
    return bool(
        re.fullmatch(r"[0-9_/+-]+", word) or re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", word) or re.search(placeholder, word)
        or re.search(r"(/[A-Za-z_-]{2,}){3}", word) or re.match(r"(/[A-Z]?[a-z0-9_-]{2,}){3}", word)
    )


def _cases(rng):
    key = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    kinds = ("0123456789abcdef", "0123456789ABCDEF", "abcdefghij0123", "ABCdefXYZuvw", "abcABC012+/_-", "ab1", "aB", "0123456789-")
    bits = [" ", "\n", "é", "😀", "=", "==", ":", "token=", "password: ", "/usr/local/lib", "example", "AKIA", "x"]
    for i in range(1, 1001):
        parts = [key(rng.choice(kinds), rng.choice([5, 16, 20, 24, 40])) if rng.random() < 0.5 else rng.choice(bits) for _ in range(rng.randint(0, 14))]
        yield i, "".join(parts)


def test_all_spans_and_redaction_against_python(spark):
    docs = [*_cases(random.Random(12)), (900, None), (901, ""), (902, "same"), (902, "same"), (None, "token=abcdef123 x")]
    frame = _docs(spark, docs)
    found = sorted(((r["doc_id"] or -1, r["spans"]) for r in secrets.secret_digest(secrets.find_secrets(frame)).collect()))
    want = sorted((i or -1, ",".join(f"{k}:{a}:{b}" for a, _, k, b in _all_spans(t))) for i, t in docs)
    assert found == want and sum("entropy" in s for _, s in found) > 100

    def redacted(text):
        out, at = [], 0
        for a, _, _, b in _all_spans(text):
            if a >= at:
                out.append(text[at:a])
            at = max(at, b)
        return text if text is None else "[SECRET]".join([*out, text[at:]]) if at else text

    got = secrets.redact(frame)
    assert got.columns == frame.columns
    assert sorted((r["text"] or "" for r in got.collect())) == sorted(redacted(t) or "" for _, t in docs)
    none = _docs(spark, [])
    assert secrets.find_secrets(none).count() == secrets.redact(none).count() == 0


def test_many_and_long_candidates(spark):
    rng = random.Random(13)
    key = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    long = key("ghijklmGHIJKLM012345", 100_000)  # no run of 24 hexadecimal digits, which would be a base span
    many = " ".join(key("0123456789abcdef", 24) + " " + key("abcdefABCDEF0123", 24) for _ in range(3000))
    got = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(_docs(spark, [(1, long), (2, many)])).collect()}
    assert [tuple(s) for s in got[1]] == [(0, 3, "entropy", 100_000)]
    want = _all_spans(many)  # some keys stay under their bar
    assert [(x["start"], x["rank"], x["kind"], x["end"]) for x in got[2]] == want and len(want) > 5900
    starts = {a for a, *_ in want}
    words = [many[a : a + 24] for a in range(0, len(many), 25)]
    assert secrets.redact(_docs(spark, [(2, many)])).first()["text"] == " ".join("[SECRET]" if 25 * i in starts else w for i, w in enumerate(words))


def test_redaction_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, 'a é password = "hunter22" z', 27), (2, None, None), (3, "clean", 5)], "doc_id long, text string, n_chars long")
    got = secrets.redact(docs)
    assert got.columns == docs.columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in got.collect()} == {1: ('a é [SECRET]" z', 15), 2: (None, None), 3: ("clean", 5)}


def _sets(rows, width):
    out = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out[i] = frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)] if words else [])
    return out


def _components(sets, percent):
    ids = sorted(sets)
    parent, links = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), links[i]) for i in ids}


def _family(rng):
    base = [f"w{rng.randint(0, 40)}" for _ in range(60)]
    docs = []
    for i in range(150):
        words = list(base) if i % 3 else [f"v{rng.randint(0, 900)}" for _ in range(rng.randint(1, 50))]
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 30)}"
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(words).upper() if i % 4 == 0 else " ".join(words)))
    return docs + [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE two"), (905, docs[1][1]), (906, docs[1][1])]


@pytest.mark.parametrize("width, percent, block, frequent", [(3, 90, 512, 64), (5, 80, 512, 64), (3, 80, 8, 2), (2, 60, 16, 4)])
def test_jaccard_components_against_brute_force(spark, monkeypatch, width, percent, block, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    docs = _family(random.Random(width * percent))
    want = _components(_sets(docs, width), percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.jaccard_components(_docs(spark, docs), width, percent, block).collect()}
    assert got == want


def test_repeated_rows_and_ids_in_the_join(spark):
    near = " ".join(f"w{i}" for i in range(40))
    docs = [(1, near), (1, near), (2, near + " more"), (1, "q0 q1 q2 q3 q4 q5"), (None, near), (3, None), (3, "q0 q1 q2 q3 q4 q5"), (4, "lone"), (4, "lone")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.jaccard_components(_docs(spark, docs), 3, 90).collect()), key=str)
    want = [(1, 38, 1, 2), (1, 38, 1, 2), (2, 39, 1, 2), (1, 4, 1, 1), (None, 38, None, 0), (3, 0, 3, 0), (3, 4, 1, 1), (4, 1, 4, 1), (4, 1, 4, 1)]
    assert got == sorted(want, key=str)


def test_keep_one_and_empty_tables(spark):
    docs = _docs(spark, [(2, "a b c d e f g"), (1, "a b c d e f g"), (3, "other words in this one here"), (3, "other words in this one here"), (None, "a b c d e f g"), (4, None), (5, None)])
    got = ngram_join.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 1, 3, 4, 5]
    assert ngram_join.keep_one(_docs(spark, [])).count() == 0


def test_keep_one_judges_rows(spark):
    w, q = " ".join(f"w{i}" for i in range(60)), " ".join(f"q{i}" for i in range(60))
    docs = spark.createDataFrame([(1, w, 7), (1, q, 8), (2, w + " end", 9), (2, q, 10)], "doc_id long, text string, _row int")
    got = ngram_join.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["text"], r["_row"]) for r in got.collect()) == [(1, q, 8), (1, w, 7)]


def test_blocks_are_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "WEIGHT", 10)
    docs = _family(random.Random(77))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.jaccard_components(_docs(spark, docs), 3, 90, 16).collect()}
    assert got == _components(_sets(docs, 3), 90)


def test_count_tables_add_up_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FAN_IN", 2)
    rows = _docs(spark, _family(random.Random(5))).repartition(9).select("doc_id", F.col("text").cast("binary").alias("_utf8")).withColumn("row", F.monotonically_increasing_id())
    found = ngram_join._signatures(rows, 3, 16).where("part is not null").select("part", "task", "counts").cache()
    assert found.select("task").distinct().count() > 4
    shingles, words = ngram_join._tables(found, 16)
    raws = [r["_utf8"] for r in rows.collect()]
    assert int(shingles.sum()) == sum(map(len, shingle_sets(raws, 3))) and int(words.sum()) == sum(len((r or b"").split()) for r in raws)


def test_shingles_of_alternating_letters_differ():
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    (a,), (b,) = shingle_sets([f"x {word} y".encode()], 3), shingle_sets([f"x {other} y".encode()], 3)
    assert a[0] != b[0] and shingle_sets([b" X\ty  z\n", b"x y z"], 3)[0][0] == shingle_sets([b"x y z"], 3)[0][0]


def test_shingles_of_long_texts_are_whole():
    text = " ".join(f"w{i}" for i in range(300_000)).encode()
    (a,) = shingle_sets([text], 5)
    assert len(a) == 300_000 - 4
