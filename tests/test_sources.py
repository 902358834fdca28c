"""The sink of files, the source of pages and the crawl as a stream, with what fails on the way."""

import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.operators import crawl
from millrace.sources import files, sink, web
from millrace.streaming.crawl import CrawlStream


def held(path: Path) -> dict[str, str]:
    return {str(p.relative_to(path)): p.read_text() for p in path.rglob("*") if p.is_file() and not p.name.endswith(".crc")}


def test_files_are_there_after_the_commit(spark, tmp_path):
    out = tmp_path / "out"
    rows = [(f"d/{k}.md", f"text {k}\n" if k else None) for k in range(50)]
    frame = spark.createDataFrame(rows, "file string, text string").repartition(5)
    sink.write_documents(frame, str(out))
    wanted = {f"{k}.md": f"text {k}\n" if k else "" for k in range(50)}
    assert held(out) == wanted
    assert {r.file: r.text for r in files.documents(spark, str(out)).collect()} == {k: v for k, v in wanted.items() if v}  # Spark passes over files without bytes
    sink.write_documents(spark.createDataFrame([("1.md", "new"), ("x.md", "é")], "file string, text string"), f"file://{out}")
    assert held(out) == wanted | {"1.md": "new", "x.md": "é"}
    sink.write_documents(spark.createDataFrame([("y.md", "y")], "file string, text string"), str(out), overwrite=True)
    assert held(out) == {"y.md": "y"}
    sink.write_documents(frame.limit(0), str(tmp_path / "none"))
    assert held(tmp_path / "none") == {}


def test_a_failed_job_leaves_the_folder_as_it_was(spark, tmp_path):
    out = tmp_path / "out"
    sink.write_documents(spark.createDataFrame([("old.md", "old")], "file string, text string"), str(out))
    bad = spark.range(40).repartition(4).select(F.concat(F.col("id").cast("string"), F.lit(".md")).alias("file"), F.when(F.col("id") == 37, F.raise_error("no")).otherwise("t").alias("text"))
    for overwrite in (False, True):
        with pytest.raises(Exception, match="no"):
            sink.write_documents(bad, str(out), overwrite=overwrite)
        assert held(out) == {"old.md": "old"}
    for rows in ([("a.md", "1"), ("d/a.md", "2")], [(None, "1")], [("..", "1")]):
        with pytest.raises(Exception, match="not a name"):
            sink.write_documents(spark.createDataFrame(rows, "file string, text string").coalesce(1), str(out))
        assert held(out) == {"old.md": "old"}


def test_of_two_attempts_one_counts(tmp_path, monkeypatch):
    """Two runs of one task, of which the driver hears of one."""

    class Task:
        attempt = 0

        def partitionId(self):
            return 3

        def taskAttemptId(self):
            Task.attempt += 1
            return Task.attempt

    monkeypatch.setattr(sink.TaskContext, "get", staticmethod(lambda: Task()))
    writer = sink.DocumentWriter(str(tmp_path), False)
    batch = lambda text: iter([pa.record_batch([pa.array(["a.md"]), pa.array([text])], names=["name", "text"])])
    writer.write(batch("half"))
    counted = writer.write(batch("whole"))
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith("_")] == []
    writer.commit([counted, None])
    assert held(tmp_path) == {"a.md": "whole"} and len(list(tmp_path.iterdir())) == 1


def test_a_retried_task_writes_each_file_once(tmp_path):
    """A session of its own, whose tasks may fail twice: each fails at first, after some of its rows."""
    code = f"""
import sys; sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from millrace.sources.sink import write_documents
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.execution.arrow.maxRecordsPerBatch", "4").getOrCreate()
def run(batches):
    for n, batch in enumerate(batches):
        if n == 2 and TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("first attempt")
        yield batch
frame = spark.range(60).repartition(3).selectExpr("concat(id, '.md') AS file", "concat('t', id) AS text").mapInArrow(run, "file string, text string")
write_documents(frame, {str(tmp_path / "out")!r})
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "first attempt" in done.stderr
    assert held(tmp_path / "out") == {f"{k}.md": f"t{k}" for k in range(60)}


CALLS: dict[str, int] = {}


def flaky(argument: str):
    """Fails in several ways; what it counts lives as long as the task."""

    def get(url: str) -> tuple[int, bytes]:
        CALLS[url] = CALLS.get(url, 0) + 1
        if "gone" in url:
            return 404, b""
        if "busy" in url and CALLS[url] < 3:
            return 503, b""
        if "down" in url:
            raise OSError("no route")
        return 200, f"{argument} {url} \xff".encode("latin-1")

    return get


def test_pages_by_host(spark):
    urls = ["http://a/1", "http://a/gone", "http://b/busy", "http://c/down", "http://a/1", None, "no scheme"]
    read = web.fetched(spark.createDataFrame([(u,) for u in urls], "url string"), f"{__name__}:flaky", "page", attempts=3, pause=0.0)
    got = sorted(((r.url or "", r.status, r.html, r.attempts, r.error) for r in read.collect()), key=str)
    page = lambda u, n: (u, 200, f"page {u} �", n, None)
    assert got == sorted([page("http://a/1", 1), page("http://a/1", 1), ("http://a/gone", 404, None, 1, "status 404"), page("http://b/busy", 3), ("http://c/down", None, None, 3, "OSError: no route"), ("", None, None, 0, "no url"), page("no scheme", 1)], key=str)
    assert web.fetched(spark.createDataFrame([], "url string"), f"{__name__}:flaky", "page").count() == 0


def test_a_large_host_has_several_queues(spark):
    """Nine tenths of the URLs on one host: cut into as many queues as it may have connections, each in the given order."""
    rows = [(f"http://{'big' if k % 10 else f'h{k}'}/{k}", k) for k in range(400)]
    path = web.queues(spark.createDataFrame(rows, "url string, at int"), connections=4, order="at")
    found = [r.split("\n") for r in (spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.array_join(F.collect_list("url"), "\n").alias("u")).toPandas()["u"])]
    big = [[int(u.rsplit("/", 1)[1]) for u in one if "//big/" in u] for one in found]
    assert sum(map(len, big)) == 360 and max(map(len, big)) < 360
    host_of = lambda u: u.split("/")[2]
    for host in {host_of(u) for u, _ in rows} - {"big"}:
        assert sum(any(host_of(u) == host for u in one) for one in found) == 1


EDGES = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("c", "skip1"), ("x", "y"), ("d", "a")]


def hops(frame) -> dict[str, int]:
    rows = frame.collect()
    assert len({r.url for r in rows}) == len(rows)
    return {r.url: r.hop for r in rows}


def test_crawl_stream_equals_crawl(spark, tmp_path):
    edges = spark.createDataFrame(EDGES, "url string, link string")
    seeds = spark.createDataFrame([("a",), ("a",), ("x",)], "url string")
    for n, most in enumerate((0, 1, 3, None)):
        stream = CrawlStream(spark, str(tmp_path / str(n)), edges, most, ["skip*"])
        stream.seed(seeds)
        assert hops(stream.run()) == hops(crawl.crawl(seeds, edges, most, ["skip*"]))


def test_crawl_stream_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    """Killed before, inside and after a level's writing: what was reached stays reached, and nothing comes twice."""
    edges = spark.createDataFrame(EDGES, "url string, link string")
    wanted = {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3, "f": 4}
    for when in ("before", "inside", "after"):
        root = str(tmp_path / when)
        first = CrawlStream(spark, root, edges, None, ["skip*"])
        first.seed(spark.createDataFrame([("a",)], "url string"))
        first.advance()
        step, offer = CrawlStream.step, CrawlStream.offer

        def broken(self, *args, when=when):
            if when == "after":
                step(self, *args)
            raise RuntimeError("killed")

        monkeypatch.setattr(CrawlStream, "offer" if when == "inside" else "step", broken)
        with pytest.raises(Exception, match="killed"):
            first.advance()
        monkeypatch.setattr(CrawlStream, "step", step)
        monkeypatch.setattr(CrawlStream, "offer", offer)
        assert hops(CrawlStream(spark, root, edges, None, ["skip*"]).run()) == wanted
    again = CrawlStream(spark, root, edges, None, ["skip*"])
    again.seed(spark.createDataFrame([("a",), ("x",)], "url string"))
    assert hops(again.run()) == wanted | {"x": 0, "y": 1}
