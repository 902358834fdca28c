"""Link discovery and the hop-limited crawl."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from millrace.functions.tables import written
from millrace.functions.text import matches_any

# What holds no tags: comments, declarations, scripts and styles.
HIDDEN = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)")
# An opening tag with its attributes; quoted values are units, so a ``>`` inside them ends nothing.
ANCHOR = re.compile(r"""(?i)<a(?=[\s/>])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")


def hrefs(html: str) -> list[str]:
    """The href of every anchor of a page, entities decoded; of repeated attributes the last counts."""
    out = []
    for tag in ANCHOR.findall(HIDDEN.sub("", html)):
        found = [value for name, value in ATTRIBUTE.findall(tag) if name.lower() == "href"]
        if found:
            value = found[-1]
            out.append(unescape(value[1:-1] if value[:1] in ("'", '"') and value[:1] == value[-1:] else value))
    return out


def page_links(url: str, html: str) -> list[str]:
    """The distinct links of a page to its own domain, ``www.`` aside: resolved as RFC 3986 says, without fragment and parameters; hrefs that can't be read are left out."""
    own, out = urlparse(url).netloc.replace("www.", ""), {}
    for href in dict.fromkeys(hrefs(html)):
        try:
            there = urlparse(urljoin(url, href))
        except ValueError:
            continue
        if there.netloc.replace("www.", "") == own:
            out[f"{there.scheme}://{there.netloc}{there.path}" + (f"?{there.query}" if there.query else "")] = None
    return list(out)


@F.pandas_udf(ArrayType(StringType()))
def linked(pages: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """``page_links`` of every page; a null URL or page has none."""
    for urls, htmls in pages:
        yield pd.Series([[] if u is None or h is None else page_links(u, h) for u, h in zip(urls, htmls)], dtype=object)


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, link): the distinct canonical links of every page to its own domain, in one pass without a shuffle.

    Links are distinct within their page; pages that occur twice give their links twice. A null page has none.
    """
    return pages.select(F.col(url).alias("url"), F.explode(linked(url, html)).alias("link"))


def admission(candidates: DataFrame, skip: Sequence[str] = (), max_hops: int | None = None, url: str = "url", hop: str = "hop") -> DataFrame:
    """Add ``reason``: ``pattern``, ``hop`` or ``new``; patterns are tested before hops."""
    late = F.col(hop) > max_hops if max_hops is not None else F.lit(False)
    return candidates.withColumn("reason", F.when(matches_any(F.col(url), list(skip)), F.lit("pattern")).when(late, F.lit("hop")).otherwise(F.lit("new")))


def admit(candidates: DataFrame, known: DataFrame, skip: Sequence[str] = (), max_hops: int | None = None) -> DataFrame:
    """(url, hop): candidates that pass patterns and hops and aren't ``known`` (url), each at its smallest hop."""
    passed = admission(candidates, skip, max_hops).filter("reason = 'new'").groupBy("url").agg(F.min("hop").alias("hop"))
    return passed.join(known.select("url"), "url", "left_anti")


def admission_counts(candidates: DataFrame, known: DataFrame, skip: Sequence[str] = (), max_hops: int | None = None) -> DataFrame:
    """(reason, n): ``pattern``, ``hop``, ``known`` and ``new`` over distinct candidates."""
    judged = admission(candidates.groupBy("url").agg(F.min("hop").alias("hop")), skip, max_hops)
    seen = judged.join(known.select("url", F.lit(True).alias("seen")).distinct(), "url", "left")
    return seen.withColumn("reason", F.when((F.col("reason") == "new") & F.col("seen"), F.lit("known")).otherwise(F.col("reason"))).groupBy("reason").agg(F.count("*").alias("n"))


def crawl(seeds: DataFrame, edges: DataFrame, max_hops: int | None = 2, skip: Sequence[str] = (), visited: DataFrame | None = None, frontier: DataFrame | None = None) -> DataFrame:
    """(url, hop) of all that is reached from ``seeds`` (url) over ``edges`` (url, link), breadth first, each at its smallest hop.

    Every level is one join of the last level with the edges and an anti join
    with what is known; levels are written tables, so lineage stays short and a
    lost executor costs tasks of one level. ``visited`` (url) and ``frontier``
    (url, hop), a queue that was left over, resume a crawl: waiting URLs are
    taken up at their own hops. Without a hop limit it ends when a level is
    empty and no later hop waits.
    """
    spark = seeds.sparkSession
    known = visited.select("url", F.lit(None).cast("int").alias("hop")) if visited is not None else spark.createDataFrame([], "url string, hop int")
    edges = written(edges.select("url", "link"))
    start = seeds.select("url", F.lit(0).alias("hop"))
    waiting = written(start if frontier is None else start.unionByName(frontier.select("url", F.col("hop").cast("int").alias("hop"))))
    hop, last = waiting.agg(F.min("hop"), F.max("hop")).head()
    reached = spark.createDataFrame([], "url string, hop int")
    if hop is None:
        return reached
    level = None
    while max_hops is None or hop <= max_hops:
        found = waiting.filter(F.col("hop") == hop)
        if level is not None:
            found = found.unionByName(level.select("url").join(edges, "url").select(F.col("link").alias("url"), F.lit(hop).alias("hop")))
        level = written(admit(found, known.unionByName(reached), skip, max_hops))
        if level.isEmpty() and hop >= last:
            break
        reached, hop = reached.unionByName(level), hop + 1
    return reached


def crawl_summary(reached: DataFrame, fetched: DataFrame) -> DataFrame:
    """Processed, successful and failed URLs; ``fetched`` has the urls whose pages could be read."""
    ok = fetched.select("url", F.lit(True).alias("ok")).distinct()
    return reached.join(ok, "url", "left").agg(F.count("*").alias("processed"), F.count_if(F.col("ok")).alias("successful"), F.count_if(F.col("ok").isNull()).alias("failed"))
