"""Edge cases of operators, and the throttle against its rules."""

from pyspark.sql import functions as F

from tessera.config import Chunking, Seen, Topics, Vectors
from tessera.operators import chunk, dedup, resume, throttle, vectors
from tessera.plans.components import connected_components
from tessera.sources.index import read_offset


def _states(outcomes):
    state = throttle.State()
    for x in outcomes:
        state = state.apply(x)
    return state


def test_throttle_rules():
    assert _states(["backoff"] * 6).multiplier == 30 and _states(["backoff"] * 6).escalation == 4
    assert _states(["captcha"]) == throttle.State(30, 0, 1, 1)
    eased = _states(["captcha"] + ["ok"] * 20)
    assert (eased.multiplier, eased.streak, eased.escalation, eased.strikes) == (15, 0, 0, 1)
    assert _states(["captcha"] * 3 + ["ok"] * 100) == throttle.State(1.0, 0, 0, 0)
    assert _states(["ok"] * 5) == throttle.State()
    assert _states(["backoff", "ok", "backoff"]).streak == 0


def test_replay_streams_long_keys(spark):
    log = spark.range(5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("n"), F.when(F.col("id") % 50 < 2, "captcha").otherwise("ok").alias("outcome"))
    got = throttle.replay(log, "k", "n", "outcome").orderBy("n").collect()
    states = {0: throttle.State(), 1: throttle.State()}
    for r in got:
        states[r["k"]] = states[r["k"]].apply(r["outcome"])
        s = states[r["k"]]
        assert (r["multiplier"], r["streak"], r["escalation"], r["strikes"]) == (s.multiplier, s.streak, s.escalation, s.strikes)


def test_waits(spark):
    rows = spark.createDataFrame([("captcha", 0, 1), ("captcha", 0, 9), ("backoff", 2, 0), ("network", 1, 0), ("ok", 0, 0)], "o string, a int, e int")
    assert [r[0] for r in rows.select(throttle.wait_seconds(F.col("o"), F.col("a"), F.col("e"))).collect()] == [180, 3600, 90, 20, None]


def test_chunk_sizes(spark):
    sizes = [0, 40, 49, 50, 512, 513, 960, 1000, 1344]
    docs = spark.createDataFrame([(n, " ".join(f"w{i}" for i in range(n))) for n in sizes], "id int, text string")
    got = {}
    for r in chunk.chunk_windows(docs, "id").collect():
        got.setdefault(r["id"], []).append((r["chunk_index"], r["total_chunks"], len(r["chunk_text"].split()), r["chunk_text"].split()[0]))
    assert {k: [x[2] for x in sorted(v)] for k, v in got.items()} == {50: [50], 512: [512], 513: [512, 65], 960: [512, 512], 1000: [512, 512, 104], 1344: [512, 512, 448]}
    for rows in got.values():
        assert [r[0] for r in sorted(rows)] == list(range(rows[0][1])) and [r[3] for r in sorted(rows)] == [f"w{448 * i}" for i in range(len(rows))]


def test_small_chunk_settings_cover_all_tokens(spark):
    docs = spark.createDataFrame([(n, " ".join(map(str, range(n)))) for n in range(1, 40)], "id int, text string")
    rows = chunk.chunk_windows(docs, "id", settings=Chunking(8, 3, 1)).orderBy("id", "chunk_index").collect()
    for n in range(1, 40):
        parts = [r["chunk_text"].split() for r in rows if r["id"] == n]
        assert parts[0] + [t for p in parts[1:] for t in p[3:]] == [str(i) for i in range(n)]


def test_dedup_is_idempotent_and_first_wins(spark):
    docs = spark.createDataFrame([(i, f"k{i % 7}" if i % 5 else None) for i in range(100)], "n int, key string")
    once = dedup.first_wins(docs, "key", [F.col("n")])
    twice = dedup.first_wins(once, "key", [F.col("n")])
    assert sorted(r["n"] for r in once.collect()) == sorted(r["n"] for r in twice.collect()) == [0, 1, 2, 3, 4, 6, 7, 12]


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    old, new = spark.range(3000).select(F.col("id").cast("string").alias("key")), spark.range(3000, 13000).select(F.col("id").cast("string").alias("key"))
    bloom = dedup.BloomFilter(Seen(3000, 0.01)).add(old, "key")
    assert old.where(~bloom.may_hold(spark, F.col("key"))).count() == 0
    assert new.where(bloom.may_hold(spark, F.col("key"))).count() < 300


def test_an_overfull_bloom_filter_loses_no_document(spark):
    docs = spark.range(4000).select(F.col("id").alias("n"), F.when(F.col("id") % 1000 != 999, F.concat(F.lit("k"), F.col("id") % 2000)).alias("key"))
    seen = docs.where("n % 2 = 0").select("key").distinct()
    want = sorted(r["n"] for r in dedup.unseen(docs, seen, "key", [F.col("n")]).collect())
    got = dedup.probably_unseen(docs, seen, "key", [F.col("n")], Seen(20, 0.001))
    assert got.columns == docs.columns and sorted(r["n"] for r in got.collect()) == want and len(want) == 999


def test_row_cap_counts_physical_lines(spark):
    lines = spark.createDataFrame([(0, "a"), (1, " "), (2, "b"), (3, ""), (4, "c"), (5, "d")], "line_no long, value string")
    take = lambda start, most: [r["line_no"] for r in resume.lines_window(lines, start, most).orderBy("line_no").collect()]
    assert take(0, 0) == [0, 2, 4, 5] and take(0, 1) == [0] and take(0, 2) == [0, 2] and take(0, 3) == [0, 2]
    assert take(0, 4) == [0, 2, 4] and take(1, 1) == [2] and take(9, 2) == []


def test_stored_offsets():
    assert [read_offset(x) for x in (None, "", " 7\n", "x")] == [0, 0, 7, 0]


def test_components(spark):
    pairs = [(1, 2), (2, 3), (10, 11), (11, 12), (12, 9), (5, 5), (None, 4)] + [(100, 101 + i) for i in range(300)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    want = {1: 1, 2: 1, 3: 1, 9: 9, 10: 9, 11: 9, 12: 9} | {100 + i: 100 for i in range(301)} | {1000 + i: 1000 for i in range(61)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_nearest_and_collections(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    top = vectors.nearest(rows, rows.where("vec_id = 1"), 1).collect()
    assert [(r["query_id"], r["neighbour_id"], r["rank"]) for r in top] == [(1, 2, 1)]
    assert vectors.vector_records(rows, size=3).count() == 0 and dict(Vectors().collections)["mevzuat"] == "mevzuat"


def test_topic_settings():
    t = Topics(brokers="a:1,b:2")
    assert t.broker_list == ["a:1", "b:2"] and t.kafka_options()["kafka.acks"] == "all"
