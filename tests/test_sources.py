import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import discovery as S_
from corpusloom.sources import readers as R
from corpusloom.sources import writers as W
from corpusloom.streaming import incremental as S


def test_wet(spark, tmp_path):
    rec = lambda u, t: f"WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: {u}\r\n\r\n{t}\r\n\r\n"
    (tmp_path / "a.wet.gz").write_bytes(gzip.compress((rec("http://a", "x\r\n\r\ny") + rec("http://b", "  ") + rec("http://c", "z")).encode()))
    assert sorted(map(tuple, R.read_wet(spark, str(tmp_path / "a.wet.gz")).collect())) == [("http://a", "x\n\ny"), ("http://c", "z")]


def test_warc():
    raw = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>x</p>"
    assert R.parse_warc_record(gzip.compress(raw)) == ("response", "http://a", 200, {"content-type": "text/html"}, b"<p>x</p>", True, "")
    # an error page is a good record; its status tells what it is
    assert R.parse_warc_record(gzip.compress(raw.replace(b" 200 ", b" 404 ")))[2:] == (404, {"content-type": "text/html"}, b"<p>x</p>", True, "")
    assert R.parse_warc_record(gzip.compress(raw.replace(b" 200 ", b" x ")))[2] == 0
    for bad in (b"\x1f\x8bxx", raw, None, b"", gzip.compress(raw)[:-12], gzip.compress(raw)[:20] + b"\xff" * 40):
        assert R.parse_warc_record(bad)[-2] is False and R.parse_warc_record(bad)[-1].startswith("decompress_failed: ")
    assert R.parse_warc_record(gzip.compress(b"nothing"))[-1] == "no_warc_headers"
    assert R.parse_warc_record(gzip.compress(b"WARC-Type: request\r\n\r\n"))[-1] == "not_response: request"
    assert R.parse_warc_record(gzip.compress(raw[: raw.index(b"HTTP")] + b"HTTP/1.1 200"))[-1] == "no_http_headers"


def test_wiki(spark, tmp_path):
    page = lambda t, ns, x, red="": f"<page><title>{t}</title><ns>{ns}</ns><id>7</id>{red}<revision><text>{x}</text></revision></page>"
    (tmp_path / "w.xml").write_text("<mediawiki>" + page("A", 0, "text") + page("B", 1, "talk") + page("C", 0, "r", '<redirect title="A"/>') + page("D", 0, "u").replace("<ns>0</ns>", "") + page(" ", 0, "u") + page("E", 0, " ") + "</mediawiki>")
    assert [(r.title, r.page_id, r.wikitext) for r in R.read_wiki(spark, str(tmp_path / "w.xml")).collect()] == [("A", 7, "text"), ("D", 7, "u")]


def test_cdx_seeds_gold(spark, tmp_path):
    (tmp_path / "c").write_text('{"url":"u","filename":"f","offset":"1","length":"2","status":"200","mime":"text/html"}\nbad\n{"url":"v","status":"404"}\n')
    assert R.read_cdx(spark, str(tmp_path / "c"), "x").count() == 1
    (tmp_path / "w").write_text(json.dumps([["timestamp", "original"], ["2020", "http://a", "200", "text/html", "zz"]]))
    assert R.read_archive_cdx(spark, str(tmp_path / "w")).first().length == 0
    (tmp_path / "s").write_text("# c\nwww.A.rw precision\nhttp://b.rw/x/\na.rw\n")
    assert sorted(map(tuple, R.read_seeds(spark, str(tmp_path / "s")).collect())) == [("a.rw", "", "precision"), ("b.rw", "/x/", "recall")]
    (tmp_path / "g").write_text('# c\n{"prompt":" p ","response":"r"}\n{"prompt":"p"}\n')
    assert [tuple(r) for r in R.read_gold_examples(spark, str(tmp_path / "g")).collect()] == [("qa", "p", "r")]


def test_shards_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(str(i), f"text {i}", None) for i in range(50)], "id string, text string, url string").coalesce(1)
    m = W.write_shards(df, str(tmp_path), "p", "src", "r1", target_bytes=1 << 30).collect()
    assert sum(r.records_count for r in m) == 50 and all(r.filename.endswith(".jsonl.zst") for r in m)
    import zstandard

    lines = zstandard.ZstdDecompressor().stream_reader(open(m[0].path, "rb")).read().decode().splitlines()
    assert json.loads(lines[0]) == {"id": "0", "text": "text 0", "url": None}
    # a shard is closed by the record that reaches the size; nothing is written for no rows
    noise = spark.createDataFrame([(str(i), os.urandom(50_000).hex()) for i in range(50)], "id string, text string").coalesce(1)
    many = W.write_shards(noise, f"file://{tmp_path}/small", "p", "src", "r1", target_bytes=200_000).collect()
    assert sum(r.records_count for r in many) == 50 and len(many) > 1 and len({r.filename for r in many}) == len(many)
    assert W.write_shards(df.limit(0), str(tmp_path / "none"), "p", "src", "r1").count() == 0 and not list((tmp_path / "none").glob("*.zst"))


def test_ranges(spark, tmp_path):
    df = spark.createDataFrame([(i, bytearray(b"%d" % i * (i + 1))) for i in range(9)] + [(9, None)], "i int, content binary")
    places = W.write_blobs(df, str(tmp_path), "blob", ["i"])
    places.write.parquet(str(tmp_path / "places"))
    places = spark.read.parquet(str(tmp_path / "places"))
    assert {r.i: bytes(r.content) for r in R.read_ranges(places, str(tmp_path)).collect()} == {i: b"%d" % i * (i + 1) for i in range(9)}
    odd = spark.createDataFrame([("none", 0, 1, "x"), (None, 0, 1, "x"), (places.first().filename, 0, 10**6, "x"), (places.first().filename, -1, 1, "x")], "filename string, offset bigint, length bigint, error string")
    got = R.read_ranges(odd, str(tmp_path)).collect()
    assert not any(r.ok for r in got) and {r.error for r in got} == {"bad_range", "short_read", "read_failed: FileNotFoundError"}
    assert R.read_ranges(odd.limit(0), str(tmp_path)).count() == 0


def test_publication(spark, tmp_path):
    df = spark.createDataFrame([(str(i), f"text {i}") for i in range(20)], "id string, text string").coalesce(2)
    W.write_shards(df, str(tmp_path / "a"), "p", "src", "r1").write.parquet(str(tmp_path / "m"))
    m = spark.read.parquet(str(tmp_path / "m"))
    state = lambda: {r.published for r in W.publish(m, str(tmp_path / "a"), str(tmp_path / "b")).collect()}
    assert state() == {"copied"} and state() == {"there"}
    for f in (tmp_path / "b").glob("*.zst"):
        f.write_bytes(b"x")
    assert state() == {"conflict"}
    assert not any(r.removed for r in W.remove_published(m, str(tmp_path / "a"), str(tmp_path / "b")).collect())
    for f in (tmp_path / "b").glob("*.zst"):
        f.unlink()
    one = next((tmp_path / "a").glob("*.zst"))
    one.write_bytes(b"damaged")
    assert state() >= {"failed"} and not list((tmp_path / "b").glob(".*"))
    one.unlink()
    assert "missing" in state()


def test_lists(spark, tmp_path):
    (tmp_path / "l").write_text("# x\n a/b \n\nc\n")
    assert [r.url for r in S_.listed(spark, str(tmp_path / "l"), "h/").collect()] == ["h/a/b", "h/c"] and S_.listed(spark, str(tmp_path / "l"), most=1).count() == 1
    ids = spark.createDataFrame([("CC-MAIN-2024-10",), ("CC-MAIN-2025-05",), ("X-2025",), (None,)], "id string")
    assert [r.id for r in S_.crawls(ids).collect()] == ["CC-MAIN-2025-05", "CC-MAIN-2024-10"] and [r.id for r in S_.crawls(ids, "2024-11", "2025-99", 1).collect()] == ["CC-MAIN-2025-05"]
    shards = spark.createDataFrame([("a", "s", "r"), ("b", "s", "r"), ("c", "s", "r"), ("d", "s", "r")], "shard_name string, source string, run_id string")
    files = spark.createDataFrame([("f:/x/s/shards/run_id=r/a",), ("f:/x/a",), ("f:/x/r/b",), ("f:/a/b",), ("f:/q/c",)], "path string")
    assert {r.shard_name: r.path for r in S_.resolve_shards(shards, files).collect()} == {"a": "f:/x/s/shards/run_id=r/a", "b": "f:/x/r/b", "c": "f:/q/c", "d": None}
    (tmp_path / "books").write_text("http://a\tTitle\tAuthor\trw\nhttp://a\tOther\nnothing\nhttps://b\n# http://c\n")
    assert sorted(map(tuple, R.read_book_seeds(spark, str(tmp_path / "books")).collect())) == [("http://a", "Title", "Author", "rw"), ("https://b", "", "", "")]


def test_stream(spark, tmp_path):
    good = " ".join(f"ijambo{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120))
    rows = [("a", good, "rw", 0.99), ("b", good, "rw", 0.99), ("c", "x", "rw", 0.99)]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, lid_score double")
    for _ in range(2):
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        S.ingest(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r.doc_id for r in spark.read.parquet(str(tmp_path / "out/kept")).collect()] == ["a"]


def test_stream_stops_at_a_limit_and_goes_on(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    from corpusloom.operators.config import Guardrails, Limits

    good = " ".join(f"ijambo{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120))
    df = spark.createDataFrame([(f"d{i}", f"{good} {'x' * (i + 1)}", "rw", 0.99) for i in range(4)], "doc_id string, text string, lang string, lid_score double")
    df.repartition(4, "doc_id").write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / "in"))
    run = lambda limits: S.ingest(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "out"), str(tmp_path / "cp"), files_per_batch=1, limits=limits).awaitTermination()
    with pytest.raises(StreamingQueryException, match="guardrail.max_items: 2 >= 2"):
        run(Guardrails(Limits(max_items=2)))
    kept = lambda: sorted(r.doc_id for r in S.read_kept(spark, str(tmp_path / "out"), df.schema).collect())
    assert len(kept()) == 2
    run(None)
    assert kept() == ["d0", "d1", "d2", "d3"]


def test_windows_of_a_stream(spark, tmp_path):
    """What a stream has closed is what a table gives."""
    rows = [(f"2024-01-01 {h:02}:{m:02}:00", k, 1.0) for h in range(6) for m in (5, 50) for k in "ab"]
    df = spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    S.event_counts(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    closed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert closed and closed <= {tuple(r) for r in S.event_counts(df).collect()}
