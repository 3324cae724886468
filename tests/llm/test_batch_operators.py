"""Packing, token files, sharding, vectors and classifiers against brute force, round trips and held-out rows."""

import functools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import embedding_dedup, packing, quality, sharding, token_output, tokens, toxicity
from tessera.llm.boosting import fit
from tessera.llm.queries import public_tokenizer
from tessera.llm.tokens import TextEncoder

BYTES, WORDS = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("word_bpe_49k.json")
TEXTS = [(1, "The cat.\nThen the dog"), (2, None), (3, ""), (4, "é" * 3000), (5, "a b  c\t\n\n d"), (6, "word " * 5000), (7, "copy"), (7, "copy"), (None, "no id"), (9, "<|endoftext|> İstanbul's 12,5%!!")]


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, ids int, part int, offset string")


@functools.cache
def _tokenizer(path):
    return Tokenizer.from_file(path)


def _ids(path, text):
    return _tokenizer(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_agrees_with_the_library(path):
    rng = random.Random(4)
    bits = ["a", "B", "é", " ", "\n", " ", ".", ",", "'s", "1", "İ", "Σ", "́", "!!", "<|endoftext|>", "日本", "\t", " ", "\x1c", "Ġ", "ab", "\r", "😀", "word", "Word", "<|startoftext|>", "<|EndOfText|>", "<|end", "é,", "x" * 80]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 16))) for _ in range(800)]
    for budget in (1 << 20, 2000):
        encoder = TextEncoder(path, budget)
        for at in range(0, 800, 100):  # the pieces of earlier calls are met again, moved and dropped
            some = [*texts[at : at + 100], None]
            ids, lengths = encoder.encode(pa.array(some))
            for text, got in zip(some, np.split(ids, np.cumsum(lengths))[:-1]):
                assert got.tolist() == _ids(path, text), repr(text)


def test_long_texts_without_white_space():
    for path in (BYTES, WORDS):
        for text in ("ab1," * 20_000, "é" * 30_000, "." * 5000, "x" * 9000 + " y"):
            assert TextEncoder(path).encode(pa.array([text]))[0].tolist() == _ids(path, text)


def test_encoder_gives_the_same_in_slices(monkeypatch):
    texts = pa.array(["skip", *[f"word{i} and {i} more,\nlines {i % 7}" for i in range(300)], None, "", " a"]).slice(1)
    for path in (BYTES, WORDS):
        whole = TextEncoder(path).encode(texts)
        with monkeypatch.context() as m:
            m.setattr(tokens, "SLICE", 500)
            parts = TextEncoder(path, 2000).encode(texts)
        assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_best_fill_is_optimal():
    rng = random.Random(6)
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(0, 6))}
        room = rng.randint(0, 60)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        used = packing.best_fill(room, counts)
        assert all(n <= counts[k] for k, n in used.items())
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)


def test_windows_and_tail_hold_every_piece_once():
    rng = random.Random(7)
    lengths = [rng.randint(1, 63) for _ in range(500)]
    windows, rest = packing.fill_windows(lengths, 64)
    assert all(sum(b - a for _, a, b in w) == 64 for w in windows) and sum(b - a for _, a, b in rest) < 64
    tail = packing.cut_tail(rest)
    assert all((n := sum(b - a for _, a, b in s)) & n - 1 == 0 for s in tail)
    met = sorted(p for s in windows + tail for p in s)
    assert [x for i, a, b in met for x in range(1000 * i + a, 1000 * i + b)] == [x for i, n in enumerate(lengths) for x in range(1000 * i, 1000 * i + n)]
    # Few documents are cut: for the slack of a window, and for the last one.
    assert sum(1 for _, a, _ in met if a) < 30


@pytest.mark.parametrize("lengths", [[], [5], [64], [40] * 9, [63] * 200, [1] * 130, [33, 33], [17] * 300])
def test_windows_of_equal_lengths(lengths):
    windows, rest = packing.fill_windows(lengths, 64)
    assert len(windows) == sum(lengths) // 64
    met = sorted(p for s in windows + packing.cut_tail(rest) for p in s)
    assert [x for i, a, b in met for x in range(1000 * i + a, 1000 * i + b)] == [x for i, n in enumerate(lengths) for x in range(1000 * i, 1000 * i + n)]


def test_packing_is_whole_and_unpadded(spark):
    rows = packing.pack(_docs(spark, TEXTS).repartition(2), BYTES).collect()
    want = sorted([*(_ids(BYTES, t)), 0] for _, t in TEXTS)
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        if r["doc_id"] not in (7,):
            by_doc.setdefault(r["doc_id"], []).append((r["start"], r["ids"], r["doc_tokens"]))
    for doc_id, text in TEXTS:
        if doc_id != 7:
            pieces = sorted(by_doc[doc_id])
            ids = [x for _, part, _ in pieces for x in part]
            assert ids == [*_ids(BYTES, text), 0] and {n for *_, n in pieces} == {len(ids)}
            assert [s for s, *_ in pieces] == list(np.cumsum([0] + [len(p) for _, p, _ in pieces[:-1]]))
    for parts in by_sequence.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist()
        assert ends[-1] <= 1024 and (ends[-1] & ends[-1] - 1) == 0
    assert sum(r["length"] for r in rows) == sum(map(len, want))
    assert packing.pack(_docs(spark, []), BYTES).count() == 0


def test_token_files_round_trip(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_output.write_token_files(_docs(spark, TEXTS), WORDS, path)
    rows = token_output.read_token_files(spark, path)
    got = sorted(((r["doc_id"] or 0, r["start"], r["ids"]) for r in rows.collect()), key=lambda x: x[1])
    at, want = 0, []
    for doc_id, text in sorted(((i or 0, t) for i, t in TEXTS), key=lambda x: x[0]):  # rows of one id have equal texts
        ids = [*_ids(WORDS, text), 1]
        want.append((doc_id, at, ids))
        at += len(ids)
    assert got == want
    sums = {(r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_output.with_checksums(rows).collect()}
    assert sums == {(s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for _, s, i in want}
    plan = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    assert "EqualTo(doc_id,4)" in rows.where("doc_id = 4")._jdf.queryExecution().explainString(plan)
    token_output.write_token_files(_docs(spark, []), WORDS, str(tmp_path / "none"))
    assert token_output.read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_matrix_rows_sum_to_places():
    counts, places = [5, 0, 17, 3, 40], np.array([10, 9, 9, 9, 9, 9, 10])
    rows = [sharding.matrix_row(counts, places, p, 3) for p in range(len(counts))]
    assert [int(r.sum()) for r in rows] == counts and (np.sum(rows, axis=0) == places).all() and min(r.min() for r in rows) >= 0


def test_matrix_follows_the_hypergeometric_law():
    draws = np.array([sharding.matrix_row([6, 6], np.array([4, 8]), 0, s)[0] for s in range(4000)])
    assert abs(draws.mean() - 2) < 0.06 and abs(draws.var() - 6 * (4 / 12) * (8 / 12) * (6 / 11)) < 0.08
    rng = np.random.default_rng(1)
    large = np.array([sharding._hypergeometric(rng, 10**9, 10**9, 10**4) for _ in range(300)])
    assert abs(large.mean() - 5000) < 15 and 35 < large.std() < 65


def test_shards_hold_every_row_once(spark):
    rows = [(i, None if i % 9 == 0 else f"é{i % 5}") for i in range(997)] + [(None, "x"), (3, "é3")]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, _block string")
    got = sharding.shuffle_rows(df, block_rows=16)
    assert got.columns == ["doc_id", "text", "_block", "shard", "slot"]
    got = got.collect()
    assert sorted(((r["doc_id"] or -1), r["text"] or "") for r in got) == sorted(((i or -1), t or "") for i, t in rows)
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots))) and len(slots) in (124, 125)
    digest = sharding.shard_digest(sharding.shuffle_rows(df))
    for r in digest.collect():
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert {(r["size"], r["text_crc32"]) for r in digest.collect()} == {(len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows}
    assert sharding.shuffle_rows(df.where("doc_id < -5")).count() == 0


def test_sharding_with_clashing_columns_and_long_texts(spark):
    df = spark.createDataFrame([(1, "x" * 200_000, 5, 6, 7), (1, None, 5, 6, 7)], "doc_id long, text string, Shard int, slot int, slot_ int")
    got = sharding.shuffle_rows(df, shards=2)
    assert got.columns == ["doc_id", "text", "Shard_", "slot__", "slot_", "shard", "slot"]
    assert sorted((len(r["text"] or ""), r["Shard_"], r["slot__"], r["slot_"], r["slot"]) for r in got.collect()) == [(0, 5, 6, 7, 0), (200_000, 5, 6, 7, 0)]


def test_every_order_of_rows_is_equally_likely(spark):
    df = spark.range(3).repartition(2).toDF("doc_id")
    orders = {}
    for seed in range(60):
        got = tuple(r["doc_id"] for r in sharding.shuffle_rows(df, shards=2, seed=seed, block_rows=1).orderBy("shard", "slot").collect())
        orders[got] = orders.get(got, 0) + 1
    # 6 orders, 10 each: the chi-squared statistic of 5 degrees of freedom is below 20.6 but once in 1,000 times.
    assert len(orders) == 6 and sum((n - 10) ** 2 / 10 for n in orders.values()) < 20.6


def _vectors(rng):
    base = rng.normal(size=(6, 8))
    rows = []
    for i in range(400):
        v = base[i % 6] + rng.normal(size=8) * rng.choice([0.02, 0.1, 1.0]) * np.linalg.norm(base[i % 6]) / 3
        rows.append((i, [float(x) for x in v.astype(np.float32)], None if i % 50 == 7 else i % 2))
    rows += [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 8, 0), (1003, [float("nan")] + [1.0] * 7, 0), (1004, [float("inf")] + [1.0] * 7, 0), (1005, [None] + [1.0] * 7, 0), (1006, [1.0, 2.0], 0), (1007, [2.0, 4.0], 0)]
    rows += [(2000 + i, rows[0][1], 0) for i in range(5)] + [(2100, [x * 1e30 for x in rows[0][1]], 0)]
    return rows


@pytest.mark.parametrize("cell, block", [(2048, 512), (20, 8)])
def test_vectors_against_brute_force(spark, cell, block):
    rows = _vectors(np.random.default_rng(2))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("cell", F.lit("x"))
    ok = {i: np.array(v, float) for i, v, label in rows if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: y for i, _, y in rows}
    links, parent = dict.fromkeys(label, 0), {i: i for i in label}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(ok)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            u, v = ok[a], ok[b]
            if label[a] == label[b] and len(u) == len(v) and (u / np.linalg.norm(u)) @ (v / np.linalg.norm(v)) >= 0.98:
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df, cell=cell, block=block).collect()}
    assert got == {i: (links[i], root(i), root(i) == i) for i in label}
    assert sum(links.values()) > 1000


def test_vectors_of_repeated_and_null_ids(spark):
    a, b, c = [1.0, 0.0, 0.0], [1.0, 0.01, 0.0], [0.0, 0.0, 1.0]
    rows = [(1, a, 0), (1, a, 0), (2, b, 0), (3, c, 0), (1, c, 0), (None, a, 0), (None, None, 0), (None, [0.0, 1.0, 0.0], 0), (9, [1.0] * 3000, 1), (9, [1.0] * 3000, 1)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    want = [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (None, 3, 1, False), (3, 1, 1, False), (1, 1, 1, True), (None, 0, None, True), (None, 0, None, True), (9, 1, 9, True), (9, 1, 9, True)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(df).count() == 0


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    forest = fit(x[:1500], y[:1500])
    assert ((forest.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert fit(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]


def test_forest_against_a_plain_walk_and_exhaustive_splits():
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, 12, size=(300, 3)).astype(float), rng.integers(0, 2, 300).astype(float)
    forest = fit(x, y, trees=5, depth=3)
    for row, got in zip(x, forest.raw(x)):
        total = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            k = 0
            while k < len(feature):
                k = 2 * k + (2 if row[feature[k]] > threshold[k] else 1)
            total += leaf[k - len(feature)]
        assert abs(total - got) < 1e-12
    p = np.full(300, y.mean())
    g, h, best = y - p, p * (1 - p), (-1.0, None)
    for j in range(3):
        for t in sorted(set(x[:, j]))[:-1]:
            right = x[:, j] > t
            if min(right.sum(), (~right).sum()) >= 5:
                gain = sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (right, ~right)) - g.sum() ** 2 / (h.sum() + 1)
                best = max(best, (gain, (j, t)), key=lambda b: b[0])
    j, t = best[1]
    assert forest.feature[0][0] == j and ((x[:, j] > forest.threshold[0][0]) == (x[:, j] > t)).all()


def _plain_statistics(text):
    raw = (text or "").encode()
    return [float(v) for v in quality.statistics_of(raw)]


def test_quality_query_against_plain_scores(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["good", "words", "here.", "and", "#$%", "||", "12"], rng.integers(1, 30), p=[0.2, 0.2, 0.1, 0.2, 0.1, 0.1, 0.1])) for _ in range(300)]
    docs = [(i, t, 1, 2.0) for i, t in enumerate(texts)] + [(500, None, 1, 2.0), (501, "", 1, 2.0), (None, "good", 1, 2.0), (3, texts[3], 1, 2.0), (502, "long " * 200_000, 1, 2.0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, label int, score double")
    marks = [(i, int("#" in t)) for i, t in enumerate(texts)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    learned = sorted((i, t) for i, t, *_ in docs if i is not None and i < 500 and zlib.crc32(str(i).encode()) % 5)
    forest = fit(np.array([_plain_statistics(t) for _, t in learned]), np.array([float("#" in t) for _, t in learned]))
    want = sorted((i if i is not None else -1, float(forest.probability(np.array([_plain_statistics(t)]))[0])) for i, t, *_ in docs)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["score"], r["predicted"]) for r in quality.classify(frame, labels).collect())
    assert [g[0] for g in got] == [w[0] for w in want] and all(abs(g[1] - w[1]) < 1e-9 and g[2] == (g[1] >= 0.3) for g, w in zip(got, want))


def test_toxicity_query_against_plain_scores(spark):
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(["fine", "Words", "nasty", "nastiness", "vile", "plain", "thing"], rng.integers(1, 12))) for _ in range(200)]
    docs = [(i, t, "w", "b", "l") for i, t in enumerate(texts)] + [(500, None, "w", "b", "l"), (None, "nasty", "w", "b", "l"), (3, texts[3], "w", "b", "l"), (501, "nasty " * 100_000, "w", "b", "l")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, words string, bits string, label string")
    labels = spark.createDataFrame([(i, int("nast" in t or "vile" in t)) for i, t in enumerate(texts)], "doc_id long, toxic int")
    chain = toxicity.train(frame, labels)
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    want = []
    for i, text, *_ in docs:
        words = set((text or "").lower().encode().split())
        words |= {w[:6] + b"*" for w in words if len(w) > 6}
        p = []
        for k in range(len(chain.names)):
            z = chain.intercepts[k] + sum(chain.weights[k, chain.words[w]] for w in words if w in chain.words) + sum(chain.weights[k, len(chain.words) + j] * p[j] for j in range(k))
            p.append(sigmoid(z))
        want.append((i if i is not None else -1, *p))
    rows = toxicity.detect(frame, labels).collect()
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, *(r[f"p_{n}"] for n in chain.names)) for r in rows)
    assert np.allclose(np.array(got, float), np.array(sorted(want), float), atol=1e-5)
    assert sum(r["toxic"] == ("nast" in (r["text"] or "") or "vile" in (r["text"] or "")) for r in toxicity.detect(frame, labels).join(frame, "doc_id").collect()) > 200
    assert {n for n in chain.names} == {"kind_1", "kind_2", "toxic"}


def test_kinds_are_the_clusters_of_toxic_rows():
    x = np.array([[1, 1, 0, 0], [1, 0, 0, 0], [1, 1, 0, 0], [0, 0, 1, 1], [0, 0, 1, 0], [1, 1, 1, 1], [0, 0, 0, 0]], float)
    toxic = np.array([1, 1, 1, 1, 1, 0, 1], float)
    assert toxicity.kinds_of(x, toxic, 2).tolist() == [[1, 0], [1, 0], [1, 0], [0, 1], [0, 1], [0, 0], [0, 0]]
    assert toxicity.kinds_of(x[:2] * 0 + 1, np.ones(2), 2).tolist() == [[1, 0], [1, 0]] and toxicity.kinds_of(x[:0], toxic[:0], 2).shape == (0, 2)


def test_quality_on_held_out_rows(spark, small):
    sf = small.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.where("predicted = 1").count()


def test_classifiers_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a", 5), (None, None, 6), (2, "", 7), (2, "", 7)], "doc_id long, text string, quality int")
    none = spark.createDataFrame([(1, None, None), (None, 1, 1), (3, 7, 7)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, none).collect()
    assert len(got) == 4 and {r["score"] for r in got} == {0.5} and {r["predicted"] for r in got} == {1}
    assert {r["toxic"] for r in toxicity.detect(docs, none).collect()} == {False}
    empty = docs.where("doc_id < 0")
    assert quality.classify(empty, none).count() == 0 and toxicity.detect(empty, none).count() == 0


def test_toxicity_on_held_out_rows(spark, small):
    sf = small.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.detect(docs, labels).withColumnRenamed("toxic", "found").join(labels, "doc_id").where("held_out").collect()
    assert sum(r["found"] for r in rows if r["toxic"]) >= 0.85 * sum(r["toxic"] for r in rows)
    assert sum(r["found"] for r in rows if not r["toxic"]) <= 0.01 * len(rows)


def test_later_links_learn_from_out_of_fold_probabilities():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, size=(600, 3))
    y = np.column_stack([x[:, 0], x[:, 0] & x[:, 1]]).astype(float)
    chain = toxicity.fit_chain(("first", "second"), [b"a", b"b", b"c"], x, y)
    assert chain.weights.shape == (2, 5) and chain.weights[0, 3:].tolist() == [0, 0] and chain.weights[1, 3] != 0
    assert ((chain.probabilities(x.astype(np.float32)) > 0.5) == y).all()
