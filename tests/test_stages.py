"""Consumers, the vector store, saved throttle state, attempts, line ordinals, and the single writer."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.config import Topics
from tessera.operators import normalize, resume, search, throttle, vectors
from tessera.operators.vectors import VectorStore, dot, nearest
from tessera.plans import catalog
from tessera.session import AlreadyRunning, single_writer
from tessera.sources import files, index, line_stream
from tessera.streaming import topics


def _messages(spark, path, number, rows):
    spark.createDataFrame(rows, "topic string, key string, value string").write.parquet(f"{path}/batch={number}")


def test_a_group_goes_on_where_it_ended_and_groups_do_not_share_offsets(spark, tmp_path):
    sent, out, state = str(tmp_path / "raw"), str(tmp_path / "chunks"), str(tmp_path / "groups")
    text = " ".join(f"w{i}" for i in range(513))
    _messages(spark, sent, 0, [("legal.danistay.raw", "k1", f'{{"id": "d1", "kaynak": "danistay", "text": "{text}"}}'), ("legal.danistay.raw", "k2", "no json"),
                               ("legal.mevzuat.raw", "k3", f'{{"id": "m1", "text": "{text}"}}'), ("legal.danistay.raw", "k4", '{"id": "d2"}')])

    def read(source):
        topics.chunk_source(spark, sent, source, f"{out}/{source}", state)
        got = topics.chunk_records(spark.read.parquet(f"{out}/{source}/batch=*")).collect()
        return sorted((r["doc_id"], r["chunk_index"], r["total_chunks"], len(r["text"].split())) for r in got)

    first = [("d1", 0, 2, 512), ("d1", 1, 2, 65)]
    assert read("danistay") == first
    _messages(spark, sent, 1, [("legal.danistay.raw", "k5", f'{{"id": "d3", "text": "{text}"}}')])
    assert read("danistay") == first + [("d3", 0, 2, 512), ("d3", 1, 2, 65)]
    assert len(read("danistay")) == 4 and len(read("mevzuat")) == 2


def test_consumer_settings():
    options = Topics(brokers="a:1").consumer_options("legal.danistay.raw", "chunker-danistay")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "legal.danistay.raw" and options["groupIdPrefix"] == "chunker-danistay"


def test_vector_store_keeps_the_latest_of_each_key(spark, tmp_path):
    store = VectorStore(str(tmp_path / "v"), size=2)
    rows = lambda *r: spark.createDataFrame(r, "collection string, vec_id long, embedding array<float>")
    have = lambda **k: {(r["collection"], r["vec_id"]): r["embedding"] for r in store.current(spark, **k).collect()}
    order = [F.col("embedding")]
    assert have() == {}
    store.upsert(rows(("a", 1, [1.0, 0.0]), ("a", 1, [0.0, 9.0]), ("b", 1, [2.0, 0.0]), ("a", 2, [1.0]), (None, 3, [1.0, 1.0]), ("a", None, [1.0, 1.0]), ("a", 4, None)), 0, order)
    first = {("a", 1): [0.0, 9.0], ("b", 1): [2.0, 0.0]}
    assert have() == first
    store.upsert(rows(("a", 1, [5.0, 5.0])), 1, order)
    store.upsert(rows(("a", 1, [6.0, 6.0]), ("a", 7, [7.0, 7.0])), 1, order)
    after = first | {("a", 1): [6.0, 6.0], ("a", 7): [7.0, 7.0]}
    assert have() == after and have(through=0) == first
    store.compact(spark, 1)
    store.compact(spark, 0)
    assert have() == after
    store.upsert(rows(("a", 7, [8.0, 8.0])), 2, order)
    assert have() == after | {("a", 7): [8.0, 8.0]}
    store.upsert(spark.createDataFrame([], "collection string, vec_id long, embedding array<float>"), 3, order)
    assert have() == after | {("a", 7): [8.0, 8.0]}


def test_throttle_state_is_saved_with_two_decimals_and_restored_within_limits(spark, tmp_path):
    file = str(tmp_path / ".throttle")
    assert throttle.load_state(file) == throttle.State()
    throttle.save_state(throttle.State(7.501, 3, 2, 1), file)
    assert (tmp_path / ".throttle").read_text() == "7.50\n" and throttle.load_state(file) == throttle.State(7.5)
    for text, m in (("99", 30.0), ("0.2", 1.0), ("", 1.0), ("nan", 1.0), ("much", 1.0)):
        (tmp_path / ".throttle").write_text(text)
        assert throttle.load_state(file).multiplier == m
    saved = spark.createDataFrame([(1, "99.00"), (2, "x"), (3, None), (4, " 7.50 "), (5, "NaN"), (6, "-3")], "k int, value string")
    assert {r["k"]: r["multiplier"] for r in throttle.restored_multipliers(saved).collect()} == {1: 30.0, 2: 1.0, 3: 1.0, 4: 7.5, 5: 1.0, 6: 1.0}


def test_requests_end_at_their_first_final_outcome_or_after_four_attempts(spark):
    cases = {1: ["ok"], 2: ["network", "backoff", "error"], 3: ["backoff"] * 5, 4: ["captcha", "network"], 5: ["backoff"] * 4 + ["ok"], 6: ["http_error", "ok"]}
    log = spark.createDataFrame([(r, n, o) for r, os in cases.items() for n, o in enumerate(os)], "request int, n int, outcome string")
    got = {r["request"]: (r["attempts"], r["result"]) for r in throttle.settled(log, ["request"], "n", "outcome").collect()}
    assert got == {1: (1, "ok"), 2: (3, "error"), 3: (4, "exhausted"), 4: (2, "pending"), 5: (4, "exhausted"), 6: (1, "http_error")}
    assert throttle.settled(log.limit(0), ["request"], "n", "outcome").count() == 0


def test_three_captchas_stop_a_run(spark):
    outcomes = ["captcha", "ok", "captcha", "backoff", "captcha", "ok", "captcha"]
    log = spark.createDataFrame([(1, i, o) for i, o in enumerate(outcomes)] + [(2, i, "captcha") for i in range(2)], "k int, n int, outcome string")
    left = throttle.until_stop(throttle.replay(log, "k", "n", "outcome"), "k", "n").collect()
    assert sorted((r["k"], r["n"]) for r in left) == [(1, i) for i in range(5)] + [(2, 0), (2, 1)]


def test_range_waits(spark):
    rows = spark.createDataFrame([("captcha", 1), ("captcha", 29), ("captcha", 30), ("error", 1), ("error", 4), ("error", 5), ("ok", 1)], "o string, t int")
    assert [r[0] for r in rows.select(throttle.range_wait(F.col("o"), F.col("t"))).collect()] == [1800, 1800, None, 300, 300, None, None]


def test_a_preview_tells_its_total_even_without_rows(spark):
    rows = spark.createDataFrame([(i, i) for i in range(9)], "id int, decided int")
    assert [(r["id"], r["records_total"]) for r in search.preview(rows, F.col("id") > 3).collect()] == [(8, 5), (7, 5), (6, 5)]
    assert [tuple(r) for r in search.preview(rows, F.col("id") > 30).collect()] == [(None, None, 0)]


def test_without_full_text_no_text_is_read(spark, tmp_path):
    path = str(tmp_path / "texts")
    spark.createDataFrame([("1", "a")], "id string, text string").write.parquet(path)
    rows, texts = spark.createDataFrame([("1",), ("2",)], "id string"), spark.read.parquet(path)
    assert sorted(tuple(r) for r in resume.saved_rows(rows, texts).collect()) == [("1", "a"), ("2", None)]
    off = resume.saved_rows(rows, texts, full_text=False)
    assert sorted(tuple(r) for r in off.collect()) == [("1", None), ("2", None)]
    assert "FileScan" not in off._jdf.queryExecution().toString()


def test_run_counters_count_ids_once(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert tuple(resume.run_counters(ids("1", "2", "2", None), ids("1", "3", "3")).first()) == (1, 3)
    assert tuple(resume.run_counters(ids("1").limit(0), ids("1").limit(0)).first()) == (0, 0)


def test_line_ordinals_over_blocks_and_files(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    wanted = []
    for name, n in (("a", 700), ("b", 0), ("c", 2), ("d", 900)):
        lines = [f"{name}{i} " + "x" * (i % 90) if i % 50 else "" for i in range(n)]
        (folder / name).write_text("\n".join(lines), encoding="utf-8")
        wanted += lines
    (folder / "e").write_bytes(b"bad \xff\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = sorted((r["line_no"], r["value"]) for r in index.numbered_lines(spark, str(folder)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(enumerate(wanted + ["bad �"]))


def test_numbering_moves_no_line(spark, tmp_path):
    (tmp_path / "l").write_text("a\nb\n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.numbered_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_file_of_lines_is_drained_in_limited_batches(spark, tmp_path):
    file, out, state = tmp_path / "l", str(tmp_path / "out"), str(tmp_path / "state")
    file.write_text("".join(f"l{i}\n" for i in range(10)))
    line_stream.register(spark)
    lines = lambda: spark.readStream.format("growing_lines").option("path", str(file)).option("maxLinesPerBatch", 4).option("startLine", 5).load()
    line_stream.drain(lines, out, state)
    have = lambda: sorted((r["line_no"], r["value"]) for r in spark.read.parquet(out).collect())
    assert have() == [(i, f"l{i}") for i in range(5, 10)]
    with file.open("a") as f:
        f.write("l10\n")
    line_stream.drain(lines, out, state)
    assert have() == [(i, f"l{i}") for i in range(5, 11)]


def test_a_file_of_lines_is_drained_by_one_query(spark, tmp_path):
    file, out, state = tmp_path / "l", str(tmp_path / "out"), str(tmp_path / "state")
    file.write_text("".join(f"l{i}\n" for i in range(10)))
    line_stream.register(spark)
    started = []
    lines = lambda: started.append(1) or spark.readStream.format("growing_lines").option("path", str(file)).option("maxLinesPerBatch", 4).load()
    assert line_stream.drain(lines, out, state) == 3 and len(started) == 1
    assert line_stream.drain(lines, out, state) == 0
    assert sorted(r["line_no"] for r in spark.read.parquet(out).collect()) == list(range(10))


def test_a_batch_reads_little_more_than_its_lines(tmp_path, monkeypatch):
    file, seen = tmp_path / "l", []
    file.write_bytes(b"".join(b"%04d\n" % i for i in range(1000)) + b"x" * 999 + b"\nend")
    plain = line_stream.read_from
    monkeypatch.setattr(line_stream, "read_from", lambda path, s, e: seen.append(e - s) or plain(path, s, e))
    reader, got, at = line_stream.LineReader(str(file), 30, 0), [], {"line": 0, "byte": 0}
    reader.STEP = 100
    for _ in range(99):
        rows, after = reader.read(at)
        rows = list(rows)
        assert rows == list(reader.readBetweenOffsets(at, after))
        got, at = got + rows, after
    assert got == [(i, "%04d" % i) for i in range(1000)] + [(1000, "x" * 999)] and at == {"line": 1001, "byte": 6000}
    assert max(seen[:2]) == 100


def test_texts_become_lines_in_bounded_files_and_one_joined_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "_LINES", 500)
    rows = spark.range(300).select((299 - F.col("id")).alias("doc_id"), F.concat(F.lit("a\nb"), F.col("id").cast("string"), F.repeat(F.lit("x"), 40)).alias("text")).coalesce(1)
    catalog._write_lines(rows, str(tmp_path / "p"), 1)
    sizes = [f.stat().st_size for f in (tmp_path / "p").glob("part-*")]
    assert len(sizes) >= 20 and max(sizes) < 2000
    want = [f"a b{299 - i}" + "x" * 40 for i in range(300)]
    numbered = index.numbered_lines(spark, str(tmp_path / "p"))
    assert sorted((r["line_no"], r["value"]) for r in numbered.collect()) == list(enumerate(want))
    files.join_parts(spark, f"file://{tmp_path}/p", f"file://{tmp_path}/p/lines")
    assert (tmp_path / "p" / "lines").read_text().split("\n") == want + [""] and not list((tmp_path / "p").glob("part-*"))


def test_a_second_writer_is_refused(spark, tmp_path):
    with single_writer(spark, str(tmp_path)):
        with pytest.raises(AlreadyRunning):
            with single_writer(spark, str(tmp_path)):
                pass
    with single_writer(spark, str(tmp_path)):
        pass


def test_nearest_in_blocks_gives_the_rows_of_one_block(spark):
    rows = spark.range(60).select(F.col("id").alias("vec_id"), F.array(F.sin("id"), F.cos("id")).cast("array<float>").alias("embedding"))
    asked = rows.where("vec_id % 3 = 0").unionByName(rows.where("vec_id = 3"))
    found = lambda n: sorted(tuple(r) for r in nearest(rows, asked, 4, block=n).select("query_id", "rank", "neighbour_id", "score").collect())
    assert found(5) == found(100) and len(found(100)) == 80
    assert nearest(rows, asked.limit(0), 4).count() == 0


def test_payloads_are_checked_for_types_and_content(spark):
    cases = {
        '{"id": "1", "kaynak": "mevzuat", "url": "u", "text": "t"}': None, '{"id": "1", "kaynak": "mevzuat", "url": "u", "text": "t", "daire": true}': "a field is not a text",
        '{"id": 1, "kaynak": "mevzuat", "url": "u", "text": "t"}': "a field is not a text", '{"id": "1", "kaynak": "x", "url": "u", "text": "t"}': "kaynak is not a known source",
        '{"id": "1", "kaynak": "mevzuat", "url": "u", "text": null}': "text is missing", "[1]": "not a JSON object", "": "not a JSON object", "{": "not a JSON object", None: "not a JSON object",
        '{"kaynak": "mevzuat", "url": "u", "text": "t"}': "id is missing",
    }
    got = normalize.checked_payloads(spark.createDataFrame([(c,) for c in cases], "value string")).collect()
    assert {r["value"]: r["_dlq_error"] for r in got} == cases


def test_nearest_gives_the_rows_of_the_plain_comparison(spark, monkeypatch):
    """Copies, repeated ids, near ties, and vectors that are null, short, not finite or huge, against the plain expression; rows in many tasks."""
    nan, inf = float("nan"), float("inf")
    made = [(i, [math.sin(i * j + 1) for j in range(8)]) for i in range(400)] + [(i, [0.5] * 8) for i in range(400, 700)] + [(i, [0.5 + (i % 7) * 1e-8] * 8) for i in range(700, 800)]
    odd = [None, [], [1.0], [1.0] * 7 + [None], [nan] * 8, [inf] * 8, [-inf] + [0.0] * 7, [1e200] * 8, [-1e200] * 4 + [1e200] * 4, [0.0] * 8, [-0.0] * 8]
    made += [(900 + i, v) for i, v in enumerate(odd)] + [(10, [0.5] * 8)] * 9 + [(None, [1.0] * 8)]
    rows = spark.createDataFrame(made, "vec_id long, embedding array<double>").repartition(3)
    asked = rows.where("vec_id % 20 = 0 or vec_id >= 900")
    for k in (1, 4):
        first = asked.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("_q"))
        met = rows.join(first, F.col("vec_id") != F.col("query_id")).select("query_id", F.col("vec_id").alias("n"), F.round(dot(F.col("embedding"), F.col("_q")), 6).alias("score"))
        ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "n"))).where(F.col("rank") <= k)
        want = sorted(map(str, ranked.select("query_id", "rank", "n", "score").collect()))
        for task, block in ((1 << 16, 4096), (100, 7)):
            monkeypatch.setattr(vectors, "TASK_ROWS", task)
            got = nearest(rows, asked, k, block=block).select("query_id", "rank", F.col("neighbour_id").alias("n"), "score").collect()
            assert sorted(map(str, got)) == want


def test_nearest_compares_blocks_without_a_row_per_pair(spark):
    rows = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(F.sin("id"), F.cos("id")).alias("embedding"))
    plan = nearest(rows, rows.where("vec_id % 3 = 0"), 4)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_nearest_takes_ids_of_text(spark):
    rows = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.5, 0.0]), ("d", None)], "vec_id string, embedding array<float>")
    got = nearest(rows, rows.where("vec_id in ('a', 'c')"), 3).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["neighbour_id"], r["score"]) for r in got] == [("a", "b", 1.0), ("a", "c", 0.5), ("a", "d", None), ("c", "a", 0.5), ("c", "b", 0.5), ("c", "d", None)]
