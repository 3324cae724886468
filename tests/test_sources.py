"""Recorded pages, growing line files, and publishing across restarts."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators.normalize import raw_documents, rows_of
from tessera.operators.publish import write_messages
from tessera.sources import files, index, line_stream, paged
from tessera.streaming.publish import Publisher, publish_available, with_late_texts


def _pages(folder, pages):
    folder.mkdir()
    for i, page in enumerate(pages, 1):
        (folder / f"page-{i}.json").write_text(json.dumps(page), encoding="utf-8")
    return str(folder)


def _page(*ids, **extra):
    return {"data": {"data": [{"id": i, "daireKurul": f"c{i % 2}", "esasNo": f"{i}"} for i in ids], "recordsTotal": 5}} | extra


def test_paged_source(spark, tmp_path):
    paged.register(spark)
    path = _pages(tmp_path / "p", [_page(1, 2), _page(3, 4), {}, _page(5)])
    rows = spark.read.format("paged_search").option("pagesPerPartition", 2).load(path)
    assert sorted(r["id"] for r in rows.collect()) == ["1", "2", "3", "4", "5"]
    assert sorted(r["id"] for r in rows.where("daireKurul = 'c1' and esasNo >= '3'").collect()) == ["3", "5"]
    assert spark.read.format("paged_search").load(_pages(tmp_path / "none", [])).count() == 0


def test_paged_source_stops_at_a_captcha(spark, tmp_path):
    paged.register(spark)
    path = _pages(tmp_path / "p", [_page(1), {"metadata": {"FMTY": "ERROR", "FMTE": "reCaptcha timeout"}}])
    with pytest.raises(Exception, match="reCaptcha timeout"):
        spark.read.format("paged_search").load(path).collect()


@pytest.mark.parametrize("per", [1, 2, 8])
def test_an_error_page_is_named_whatever_the_blocks(spark, tmp_path, per):
    paged.register(spark)
    path = _pages(tmp_path / "q", [_page(1), _page(2), {"metadata": {"FMTY": "ERROR", "FMTE": "captcha-like, but bad"}}, _page(3), _page(4)])
    read = spark.read.format("paged_search").option("pagesPerPartition", per)
    with pytest.raises(Exception, match="PageError: page 3: captcha-like, but bad"):
        read.load(path).collect()
    assert sorted(r["id"] for r in read.option("until", 3).load(path).collect()) == ["1", "2"]


def test_files_of_their_own(spark, tmp_path):
    rows = spark.createDataFrame([("7", "é\n"), ("a/b", "x"), ("8", ""), ("9", None), (None, "y")], "id string, page string")
    for _ in range(2):  # again: the same files
        got = files.save_each(rows, f"file://{tmp_path}/out", ".html").collect()
        assert sorted(map(tuple, got)) == [("7", 3), ("a/b", 1)]
    assert {f.name: f.read_text(encoding="utf-8") for f in (tmp_path / "out").iterdir()} == {"7.html": "é\n", "a%2Fb.html": "x"}


def test_many_files_are_spread_over_folders_and_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PER_FOLDER", 20)
    made = [(f"k/{i} +%ü", f"é{i}\n".encode() + b"\xff") for i in range(400)]
    rows = spark.createDataFrame(made + [("8", b""), ("9", None), (None, b"y")], "id string, page binary").coalesce(1)
    for _ in range(2):  # again: the same files
        got = files.save_each(rows, f"file://{tmp_path}/out", ".txt", spread=True).withColumn("task", F.spark_partition_id()).collect()
        assert sorted((r["key"], r["bytes"]) for r in got) == sorted((k, len(v)) for k, v in made)
    inside = {f.name: len(list(f.iterdir())) for f in (tmp_path / "out").iterdir()}
    assert len(inside) == len({r["task"] for r in got}) >= 20 and max(inside.values()) <= 45 and sum(inside.values()) == 400
    few = files.save_each(rows.limit(90), f"file://{tmp_path}/few", ".txt", spread=True)
    assert few.count() == 90 and few.rdd.getNumPartitions() == 1 and len(list((tmp_path / "few").iterdir())) == 5
    read = files.read_each(spark, f"file://{tmp_path}/out", ".txt")
    assert sorted((r["key"], bytes(r["raw"])) for r in read.collect()) == sorted(made) and read.rdd.getNumPartitions() == len(inside)
    texts = index.read_texts(spark, f"file://{tmp_path}/out", spread=True).collect()
    assert sorted((r["id"], r["text"]) for r in texts) == sorted((k, v.decode("utf-8", "replace")) for k, v in made)
    assert files.read_each(spark, f"file://{tmp_path}/none", ".txt").count() == 0


def test_envelopes(spark):
    rows = spark.createDataFrame([(1, '{"data": {"data": [{"id": 7}], "recordsTotal": 1}}'), (2, "{}"), (3, "broken"), (4, None)], "page int, payload string")
    got = [(r["page"], r["records_total"], r["id"]) for r in rows_of(rows).orderBy("page").collect()]
    assert got == [(1, 1, "7"), (2, 0, None), (3, 0, None), (4, 0, None)]


def test_index_and_texts(spark, tmp_path):
    (tmp_path / "index.jsonl").write_text('{"id": 1}\n\nbroken\n{"id": "ç"}\n', encoding="utf-8")
    rows = index.read_index(spark, str(tmp_path / "index.jsonl"))
    assert sorted(r["id"] for r in rows.cache().where("_corrupt_record is null").collect()) == ["1", "ç"]
    assert index.read_index(spark, str(tmp_path / "missing.jsonl")).count() == 0
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a b.txt").write_bytes(b"x\xff\ny")
    assert [(r["id"], r["text"]) for r in index.read_texts(spark, str(tmp_path / "docs")).collect()] == [("a b", "x�\ny")]


def _run(spark, path, out, state, **options):
    line_stream.register(spark)
    stream = spark.readStream.format("growing_lines").option("path", path)
    for k, v in options.items():
        stream = stream.option(k, v)
    q = stream.load().writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    q.awaitTermination()
    return sorted((r["line_no"], r["value"]) for r in spark.read.parquet(out).collect())


def test_growing_lines_go_on_after_a_restart(spark, tmp_path):
    file, out, state = tmp_path / "l.jsonl", str(tmp_path / "out"), str(tmp_path / "state")
    file.write_text("a\nb\nhalf", encoding="utf-8")
    assert _run(spark, str(file), out, state) == [(0, "a"), (1, "b")]
    with file.open("a") as f:
        f.write(" line\n\nc\n")
    assert _run(spark, str(file), out, state) == [(0, "a"), (1, "b"), (2, "half line"), (3, ""), (4, "c")]
    assert len(_run(spark, str(file), out, state)) == 5


def test_line_reader_limits_a_batch(tmp_path):
    file = tmp_path / "l"
    file.write_text("a\nbb\nccc\n")
    reader = line_stream.LineReader(str(file), 2, 1)
    rows, end = reader.read(reader.initialOffset())
    assert list(rows) == [(1, "bb")] and end == {"line": 2, "byte": 5}
    rows, end = reader.read(end)
    assert list(rows) == [(2, "ccc")] and end == {"line": 3, "byte": 9}
    assert list(reader.readBetweenOffsets({"line": 0, "byte": 0}, {"line": 2, "byte": 5})) == [(1, "bb")]
    assert list(line_stream.LineReader(str(tmp_path / "none"), 0, 0).read({"line": 0, "byte": 0})[0]) == []


def _batch(spark, rows):
    made = spark.createDataFrame(rows, "line_no long, id string, esasNo string, kararNo string, daireKurul string, kararTarihi string, arananKelime string, text string")
    return raw_documents(made, "https://h", keep=("line_no",))


def test_publisher_sends_each_key_once_and_repeats_a_failed_batch(spark, tmp_path):
    publisher = Publisher(str(tmp_path / "out"))
    one = _batch(spark, [(0, "1", "a", "b", "c", "", "", "t"), (1, "2", "a", "b", "c", "", "", "u"), (2, "3", None, None, "c", "", "", "  ")])
    publisher(one, 0)
    publisher(one, 0)
    publisher(_batch(spark, [(3, "4", "a", "b", "c", "", "", "t"), (4, "5", "", "b", "c", "", "", "t")]), 1)
    sent = publisher.published(spark).orderBy("batch").collect()
    assert [(r["topic"], r["key"]) for r in sent] == [("legal.danistay.raw", "danistay:a:b"), ("legal.danistay.raw", "danistay:https://h/arama/getDokuman?id=5")]
    assert json.loads(sent[0]["value"])["id"] == "danistay:1" and "mevzuat_no" in json.loads(sent[0]["value"])


def test_publisher_puts_invalid_documents_aside(spark, tmp_path):
    publisher = Publisher(str(tmp_path / "out"))
    publisher(_batch(spark, [(0, "1", "a", "b", "c", "", "", "t")]).withColumn("kaynak", F.lit("other")), 0)
    (bad,) = publisher.refused(spark).collect()
    assert publisher.published(spark).count() == 0
    assert bad["topic"] == "legal.dlq" and bad["key"] is None and json.loads(bad["value"])["_dlq_error"] == "kaynak is not a known source"


def test_stream_of_lines_to_topics(spark, tmp_path):
    line_stream.register(spark)
    file = tmp_path / "index.jsonl"
    file.write_text('{"id": "1", "esasNo": "x", "kararNo": "y"}\nbroken\n', encoding="utf-8")
    publisher = Publisher(str(tmp_path / "out"))

    def run():
        lines = spark.readStream.format("growing_lines").option("path", str(file)).load()
        rows = index.parse_lines(lines.where(F.trim("value") != "")).where("_corrupt_record is null").withColumn("text", F.lit("full text"))
        publish_available(raw_documents(rows, "https://h", keep=("line_no",)), publisher, str(tmp_path / "state"))
        return publisher.published(spark).count()

    assert run() == 1
    with file.open("a") as f:
        f.write('{"id": "2", "esasNo": "x", "kararNo": "y"}\n{"id": "3"}\n')
    assert run() == 2 and run() == 2


def test_texts_that_come_late_are_tried_again(spark):
    rows = spark.createDataFrame([("1",), ("2",)], "id string")
    none = rows.limit(0)
    ready, waiting = with_late_texts(rows, none, spark.createDataFrame([("1", "a")], "id string, text string"))
    assert [r["id"] for r in ready.collect()] == ["1"]
    ready, waiting = with_late_texts(none, waiting, spark.createDataFrame([("2", "b")], "id string, text string"))
    assert [(r["id"], r["text"]) for r in ready.collect()] == [("2", "b")] and waiting.count() == 0


def test_messages_are_written_by_topic(spark, tmp_path):
    write_messages(spark.createDataFrame([("a", "k", "{}"), ("b", None, "{}")], "topic string, key string, value string"), str(tmp_path / "t"))
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"topic=a", "topic=b"}
