"""A crawl as a stream of levels, which goes on after it was stopped or killed.

What is known is the state of a stream: a URL that was ever admitted is in its
state store. Candidates of a level are files of a folder; the stream lets each
URL pass once, and what passes is written as reached and followed over the edges
to the candidates of the next level. Everything lies under one folder, so the
same call on that folder continues where the last one ended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.crawl import admission

URLS = "url string, hop int"


class CrawlStream:
    """Folders below ``root``: ``candidates``, ``reached`` and the stream's ``checkpoint``."""

    def __init__(self, spark: SparkSession, root: str, edges: DataFrame, max_hops: int | None = 2, skip: Sequence[str] = ()):
        self.spark, self.root, self.edges, self.max_hops, self.skip = spark, root.rstrip("/"), edges.select("url", "link"), max_hops, list(skip)

    def offer(self, urls: DataFrame, name: str) -> None:
        """Put (url, hop) candidates that patterns and hops admit, each at its smallest hop, under ``name``, in place of what was there."""
        fresh = admission(urls, self.skip, self.max_hops).filter("reason = 'new'").groupBy("url").agg(F.min("hop").cast("int").alias("hop"))
        fresh.write.mode("overwrite").parquet(f"{self.root}/candidates/{name}")

    def seed(self, seeds: DataFrame) -> None:
        """Start from ``seeds`` (url) at hop 0, or (url, hop); what is known already doesn't pass again."""
        self.offer(seeds if "hop" in seeds.columns else seeds.select("url", F.lit(0).alias("hop")), "seeds")

    def step(self, level: DataFrame, batch: int) -> None:
        # A batch that is run again writes the same URLs in place of those it wrote before.
        level.write.mode("overwrite").parquet(f"{self.root}/reached/batch={batch}")
        new = self.spark.read.schema(URLS).parquet(f"{self.root}/reached/batch={batch}")
        self.offer(new.join(self.edges, "url").select(F.col("link").alias("url"), (F.col("hop") + 1).alias("hop")), f"after-{batch}")

    def advance(self) -> int:
        """Let the candidates that are there pass; how many there were."""
        found = self.spark.readStream.schema(URLS).parquet(f"{self.root}/candidates/*")
        query = (
            found.dropDuplicates(["url"]).writeStream.foreachBatch(self.step).option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    def run(self) -> DataFrame:
        """All levels; (url, hop) of what was reached, each URL at its smallest hop."""
        while self.advance():
            pass
        return self.reached()

    def reached(self) -> DataFrame:
        return self.spark.read.schema(URLS).option("recursiveFileLookup", "true").parquet(f"{self.root}/reached")
