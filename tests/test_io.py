import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import contracts
from tidemark.sources import readers, sinks
from tidemark.streaming import events as stream

HEADER = "ticker,volume,open,close,high,low,window_start,transactions"


def test_csv(spark, tmp_path):
    path = tmp_path / "day.csv.gz"
    path.write_bytes(gzip.compress(f"{HEADER}\nAAPL,250,10,11,11.25,9.75,1704171600000000000,10\nnull,,1,1,1,1,1,\n".encode()))
    got = readers.csv_bars(spark, str(path)).collect()
    assert got[0]["window_start"] == 1704171600000000000 and got[1]["ticker"] is None and got[1]["volume"] is None
    other = tmp_path / "bad.csv"
    other.write_text(HEADER.replace("open,close", "close,open") + "\n")
    with pytest.raises(readers.HeaderError):
        readers.csv_bars(spark, str(other))


def test_json_pages_and_hashes(spark, tmp_path):
    page = tmp_path / "p.json.gz"
    page.write_bytes(gzip.compress(json.dumps({"status": "OK", "results": [{"T": "A", "c": 1.5}, {"T": "B"}]}).encode()))
    rows = readers.json_pages(spark, str(page), "T string, c double").orderBy("row_ordinal").collect()
    assert [(r["row_ordinal"], r["T"], r["c"]) for r in rows] == [(0, "A", 1.5), (1, "B", None)] and rows[0]["source_path"].endswith("p.json.gz")
    name = f"file:{page}"
    expected = spark.createDataFrame([(name, hashlib.sha256(page.read_bytes()).hexdigest()), ("file:/gone", "x")], "path string, sha256 string")
    assert {r["state"] for r in readers.verified_files(spark, str(page), expected).collect()} == {"matched", "missing"}
    assert readers.verified_files(spark, str(page), expected.limit(0)).first()["state"] == "orphan"


def test_pipe_text(spark, tmp_path):
    (tmp_path / "l.txt").write_text("Symbol|Name|Test\nA|Alpha|N\nB|Beta|N\nFile Creation Time: 0101|||\n")
    assert [r["Symbol"] for r in readers.pipe_text(spark, str(tmp_path / "l.txt"), "Symbol string, Name string, Test string").collect()] == ["A", "B"]


@pytest.mark.parametrize("line", ["2", "3|y|z|N", "|", "4|x"])
def test_pipe_text_of_another_width(spark, tmp_path, line):
    (tmp_path / "l.txt").write_text(f"Symbol|Name|Test\nA|Alpha|N\n{line}\nFile Creation Time: 0101|||\n")
    with pytest.raises(Exception, match="not 3 fields"):
        readers.pipe_text(spark, str(tmp_path / "l.txt"), "Symbol string, Name string, Test string").select("Symbol").collect()


def test_pipe_text_types_and_nulls(spark, tmp_path):
    (tmp_path / "l.txt").write_text("a|b\r\n1|\r\n2|x\r\n")
    assert [tuple(r) for r in readers.pipe_text(spark, str(tmp_path / "l.txt"), "a int, b string").collect()] == [(1, None), (2, "x")]


def test_readers_never_miss_the_pointer(spark, tmp_path):
    """A reader that looks on between every two file operations of 30 swaps sees the old or the new text."""
    import threading

    path, seen, over = str(tmp_path / "CURRENT"), [], threading.Event()
    sinks.point(spark, path, "0")

    def look():
        while not over.is_set():
            seen.append(sinks.pointed(spark, path))

    reader = threading.Thread(target=look)
    reader.start()
    for k in range(1, 30):
        sinks.point(spark, path, str(k))
    over.set()
    reader.join()
    assert None not in seen and [int(x) for x in seen] == sorted(int(x) for x in seen) and sinks.pointed(spark, path) == "29"


def test_unfinished_folder_is_written_anew(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(3).write.parquet(str(path))
    (path / "_SUCCESS").unlink()
    digest = sinks.write_immutable(spark.range(5), str(path))
    assert spark.read.parquet(str(path)).count() == 5 and sinks.content_digest(spark.range(5).repartition(2)) == digest
    other = spark.range(5).selectExpr("if(id = 4, 5, id) id")
    assert sinks.content_digest(other) != digest and sinks.content_digest(spark.range(0)) == "0-0-0-0-0"


def test_immutable_and_reuse(spark, tmp_path):
    df = spark.range(10)
    path = str(tmp_path / "t")
    digest = sinks.write_immutable(df, path)
    assert sinks.write_immutable(df.orderBy(F.desc("id")).repartition(3), path) == digest
    with pytest.raises(sinks.ImmutableError):
        sinks.write_immutable(spark.range(11), path)
    kept = str(tmp_path / "k")
    assert sinks.reuse_or_build(spark, kept, "d1", lambda: spark.range(3)).count() == 3
    assert sinks.reuse_or_build(spark, kept, "d1", lambda: 1 / 0).count() == 3
    with pytest.raises(sinks.ImmutableError):
        sinks.reuse_or_build(spark, kept, "d2", lambda: spark.range(4))


def test_publish_is_atomic(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(LookupError):
        sinks.published(spark, root, "a")
    sinks.publish({"a": spark.range(1), "b": spark.range(2)}, root, "r1")
    sinks.publish({"a": spark.range(5)}, root, "r2")
    assert sinks.published(spark, root, "a").count() == 5
    with pytest.raises(LookupError):
        sinks.published(spark, root, "b")


def test_contract_write_replaces_only_its_partitions(spark, tmp_path):
    c = contracts.TableContract("x", 1, (("d", "int64", False), ("k", "int64", False)), ("d", "k"), ("d",), ("k",))
    path = str(tmp_path / "x")
    sinks.write_contract(spark.createDataFrame([(1, 1), (2, 2)], "d long, k long"), c, path)
    sinks.write_contract(spark.createDataFrame([(2, 3)], "d long, k long"), c, path)
    assert sorted((r["d"], r["k"]) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 3)]


def test_request_lines(spark, tmp_path):
    sinks.request_lines(spark.createDataFrame([("B",), ("A",)], "t string"), "t", str(tmp_path / "r"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "r")).collect()] == ["A", "B"]
    with pytest.raises(ValueError):
        sinks.request_lines(spark.createDataFrame([("A\nB",)], "t string"), "t", str(tmp_path / "q"))


def run_stream(spark, frames, schema, folder, make, mode="append"):
    """Feeds one micro-batch for each frame; the rows that came out."""
    src, name = folder / "src", f"out_{abs(hash(str(folder))) % 10**9}"
    src.mkdir()
    q = None
    for k, rows in enumerate(frames):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src / f"b{k}"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(src))
    q = make(source).writeStream.outputMode(mode).format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return spark.sql(f"select * from {name}")


def test_stream_intervals_do_not_depend_on_batches(spark, tmp_path):
    rows = [("T", k, s) for k, s in enumerate(["A", "A", "B", None, "B", "A"])] + [("U", 0, "Z"), ("U", 2, "Z"), ("U", 3, "Y")]
    schema = "ticker string, session_index long, state string"
    want = [("T", "A", 0, 1, 2), ("T", "B", 2, 2, 1), ("T", "B", 4, 4, 1), ("U", "Z", 0, 0, 1), ("U", "Z", 2, 2, 1)]
    for n, split in enumerate(([rows], [rows[:3] + rows[6:7], rows[3:6] + rows[7:]])):
        folder = tmp_path / str(n)
        folder.mkdir()
        got = run_stream(spark, split, schema, folder, stream.closed_intervals)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_state_sink_equals_full(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("day", F.to_date("ts"))
    sink = stream.StateSink(str(tmp_path / "state"), "user_id", "day", ["event_type"])
    for k, (a, b) in enumerate((("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "2024-12-31"))):
        batch = e.where(F.col("day").between(a, b))
        sink(batch, k)
        sink(batch, k)  # a batch that runs again changes nothing
    want = stream.batch_state(e, "user_id", "day", ["event_type"])
    assert sorted(map(str, sink.read(spark, 2).select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_stream_windows_equal_batch(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", F.lit(1).alias("one"))
    rows = [tuple(r) for r in e.collect()]
    got = run_stream(spark, [rows[:500], rows[500:]], e.schema, tmp_path, lambda s: stream.tumbling(s, "ts", "1 day", ["event_type"], "one"), "complete")
    want = stream.tumbling(e, "ts", "1 day", ["event_type"], "one")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def linked(pages, fail=()):
    """A transport over pages {url: next}; each url in fail answers 503 once."""
    left = list(fail)

    def fetch(url):
        if url in left:
            left.remove(url)
            return 503, "", None
        return 200, json.dumps({"results": [url], "next_url": pages[url]}), None

    return fetch


def test_connector_follows_guards_and_resumes():
    from tidemark.sources import connector

    urls = {"https://a/1": "https://a/2", "https://a/2": "https://a/3", "https://a/3": None}
    waits = []
    source = connector.PagedSource(linked(urls, ["https://a/2"]), sleep=waits.append)
    assert [(k, u, last) for k, u, _, last in source.pages("https://a/1")] == [(0, "https://a/1", False), (1, "https://a/2", False), (2, "https://a/3", True)] and waits == [0.5]
    for bad in ({"https://a/1": "https://b/2"}, {"https://a/1": "https://a/1"}):
        with pytest.raises(connector.SourceError):
            list(connector.PagedSource(linked(bad)).pages("https://a/1"))
    with pytest.raises(connector.SourceError):
        connector.PagedSource(lambda u: (404, "", None)).read("https://a/1")
    kept = {}
    broken = connector.PagedSource(linked(urls, ["https://a/3"] * 9), attempts=2, sleep=waits.append)
    with pytest.raises(connector.SourceError):
        connector.keep_pages(broken, "r", "https://a/1", kept.get, kept.__setitem__)
    asked = []
    again = connector.PagedSource(lambda u: (asked.append(u), linked(urls)(u))[1])
    assert connector.keep_pages(again, "r", "https://a/1", kept.get, kept.__setitem__) == 3 and asked == ["https://a/3"]
    assert connector.keep_pages(again, "r", "https://a/1", kept.get, kept.__setitem__) == 3 and asked == ["https://a/3"]


def test_connector_rows(spark):
    from tidemark.sources import connector

    plan = spark.createDataFrame([(f"r{k}", f"https://a/{k}") for k in range(5)], "request_id string, url string")
    got = connector.PagedSource(connector.mock).rows(plan, 3).collect()
    assert sorted(r["request_id"] for r in got) == [f"r{k}" for k in range(5)] and all(r["is_last"] for r in got)


def test_gate_before_publish(spark, tmp_path):
    results = spark.createDataFrame([("a", "passed"), ("b", "warning")], "rule string, status string")
    with pytest.raises(sinks.GateError):
        sinks.publish_checked({"t": spark.range(1)}, str(tmp_path), "r1", results)
    sinks.publish_checked({"t": spark.range(1)}, str(tmp_path), "r1", results, ("b",))
    with pytest.raises(sinks.GateError):
        sinks.publish_checked({"t": spark.range(1)}, str(tmp_path), "r2", results.withColumn("status", F.lit("failed")))
