"""Pages as a source: URLs are dealt by host, every host has its own queue, and failures are rows.

URLs are first written as a table whose files hold the queues of whole hosts, in
the order they came; the source then reads one file in a task and asks for its
URLs one after another. A host that holds most of the URLs is cut into as many
queues as it may have connections.
"""

from __future__ import annotations

import hashlib
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from importlib import import_module

import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from millrace.functions.tables import shared_dir
from millrace.functions.urls import authority

SCHEMA = "url string, status int, html string, attempts int, error string"
#: Answers after which another attempt may help.
PASSING = {408, 425, 429, 500, 502, 503, 504}


def http(url: str, timeout: float = 30.0) -> tuple[int, bytes]:
    """A backend: (status, body) over HTTP."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "millrace"}), timeout=timeout) as answer:
            return answer.status, answer.read()
    except urllib.error.HTTPError as e:
        return e.code, b""


def mirror(root: str) -> Callable[[str], tuple[int, bytes]]:
    """A backend over a folder of pages, named by ``mirror_name``; what isn't there is 404."""
    files, path = fs.FileSystem.from_uri(root)

    def get(url: str) -> tuple[int, bytes]:
        try:
            with files.open_input_stream(f"{path}/{mirror_name(url)}") as page:
                return 200, page.read()
        except FileNotFoundError:
            return 404, b""

    return get


def mirror_name(url: str) -> str:
    return hashlib.sha256(url.encode()).hexdigest() + ".html"


def backend_of(name: str, argument: str | None) -> Callable[[str], tuple[int, bytes]]:
    """``module:function``; with an argument what the function makes of it."""
    module, _, function = name.partition(":")
    found = getattr(import_module(module), function)
    return found if argument is None else found(argument)


@dataclass
class Queue(InputPartition):
    path: str


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.backend, self.argument = options.get("backend", f"{__name__}:http"), options.get("argument")
        self.attempts, self.pause, self.delay = int(options.get("attempts", "3")), float(options.get("pause", "1")), float(options.get("delay", "0"))

    def partitions(self) -> list[Queue]:
        files, root = fs.FileSystem.from_uri(self.path)
        return [Queue(x.path) for x in files.get_file_info(fs.FileSelector(root)) if x.base_name.endswith(".parquet") and x.size] or [Queue("")]

    def read(self, partition: Queue) -> Iterator[tuple]:
        if not partition.path:
            return
        files, _ = fs.FileSystem.from_uri(self.path)
        get = backend_of(self.backend, self.argument)
        queue = pq.ParquetFile(files.open_input_file(partition.path))
        asked = "ask" if "ask" in queue.schema_arrow.names else "url"
        for batch in queue.iter_batches(1024, columns=["url"] if asked == "url" else ["url", asked]):
            for url, ask in zip(batch.column("url").to_pylist(), batch.column(asked).to_pylist()):
                yield url, *self.page(get, ask)[1:]
                if self.delay:
                    time.sleep(self.delay)

    def page(self, get: Callable[[str], tuple[int, bytes]], url: str | None) -> tuple:
        status, error, n = None, None, 0
        while url is not None and n < self.attempts:
            if n:
                time.sleep(self.pause * 2 ** (n - 1))
            n += 1
            try:
                status, body = get(url)
            except Exception as e:  # noqa: BLE001  a backend may fail in any way; the row says how
                status, error = None, f"{type(e).__name__}: {e}"
                continue
            if status not in PASSING:
                if 200 <= status < 300:
                    return url, status, body.decode("utf-8", "replace"), n, None
                return url, status, None, n, f"status {status}"
            error = f"status {status}"
        return url, status, None, n, error or "no url"


class Pages(DataSource):
    """``spark.read.format("millrace_pages").load(folder)`` of a folder of queues."""

    @classmethod
    def name(cls) -> str:
        return "millrace_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))


def queues(urls: DataFrame, connections: int = 4, order: str | None = None, ask: str | None = None) -> str:
    """Write the ``url`` column, and what to ``ask`` for where that is another, in queues, a host over ``connections`` of them at most, and return their folder."""
    spark = urls.sparkSession
    path = f"{shared_dir(spark)}/millrace-queues-{uuid.uuid4().hex}"
    host, lane = F.coalesce(authority(F.col("url")), F.lit("")), F.pmod(F.xxhash64("url"), F.lit(connections))
    kept = ["url", *(["ask"] if ask else [])]
    keyed = urls.select("url", *([F.col(ask).alias("ask")] if ask else []), host.alias("host"), lane.alias("lane"), (F.col(order) if order else F.lit(0)).alias("at"))
    # The number is given, or Spark would put small queues together.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed.repartition(n, "host", "lane").sortWithinPartitions("host", "lane", "at", *kept).select(*kept).write.parquet(path)
    return path


def fetched(urls: DataFrame, backend: str = f"{__name__}:http", argument: str | None = None, connections: int = 4, attempts: int = 3, pause: float = 1.0, delay: float = 0.0, order: str | None = None, ask: str | None = None) -> DataFrame:
    """(url, status, html, attempts, error) of every row of ``urls`` (url), repeats included.

    ``backend`` names a function from a URL to (status, body) that the tasks can
    import; passing failures are tried again, ``attempts`` times in all with
    growing pauses, and whatever fails is a row with an ``error`` and no page. A
    null URL is such a row. ``ask`` names a column with what the backend is asked
    for in place of the URL, such as one of several captures of a page; hosts are
    still those of the URLs. A task that is lost asks for its queue's URLs again;
    write the result before it is used twice.
    """
    spark: SparkSession = urls.sparkSession
    spark.dataSource.register(Pages)
    read = spark.read.format("millrace_pages").option("backend", backend).option("attempts", attempts).option("pause", pause).option("delay", delay)
    return (read if argument is None else read.option("argument", argument)).load(queues(urls, connections, order, ask))
