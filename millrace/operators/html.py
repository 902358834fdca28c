"""HTML to Markdown."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions.urls import file_name
from millrace.operators.cleaning import collapse_blank_lines
from millrace.operators.frontmatter import yaml_block

SILENT = {"script", "style", "svg", "template"}
BLOCKS = {"p", "div", "section", "article", "header", "footer", "main", "nav", "aside", "form", "figure", "table", "tr", "dl", "dd", "dt", "address", "body", "html", "head", "title"}
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`", "kbd": "`", "samp": "`", "del": "~~", "s": "~~"}


class Converter(HTMLParser):
    """Markdown with ATX headings, ``-`` bullets, fences without a language; images and drawings vanish."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.silent, self.fixed, self.lists, self.hrefs, self.quotes = 0, 0, [], [], 0

    def block(self, lines: int = 2) -> None:
        """End the line; ``lines`` 2 leaves a blank one."""
        text = "".join(self.out[-3:])
        have = len(text) - len(text.rstrip("\n"))
        if self.out and have < lines:
            self.out.append("\n" * (lines - have) + "> " * self.quotes)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT:
            self.silent += 1
        elif self.silent:
            return
        elif re.fullmatch("h[1-6]", tag):
            self.block()
            self.out.append("#" * int(tag[1]) + " ")
        elif tag == "br":
            self.out.append("\n" if self.fixed else "  \n")
        elif tag == "hr":
            self.block()
            self.out.append("---")
            self.block()
        elif tag in ("ul", "ol"):
            self.block(1 if self.lists else 2)
            self.lists.append([tag, 0])
        elif tag == "li":
            self.block(1)
            depth = max(len(self.lists) - 1, 0)
            if self.lists and self.lists[-1][0] == "ol":
                self.lists[-1][1] += 1
                self.out.append("   " * depth + f"{self.lists[-1][1]}. ")
            else:
                self.out.append("  " * depth + "- ")
        elif tag == "pre":
            self.block()
            self.out.append("```\n")
            self.fixed += 1
        elif tag == "blockquote":
            self.block()
            self.quotes += 1
            self.out.append("> ")
        elif tag == "a":
            self.hrefs.append(dict(attrs).get("href"))
            self.out.append("[" if self.hrefs[-1] else "")
        elif tag in ("td", "th"):
            self.out.append("| ")
        elif tag in MARKS and not self.fixed:
            self.out.append(MARKS[tag])
        elif tag in BLOCKS:
            self.block()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in SILENT:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif self.silent:
            return
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self.block(1 if self.lists else 2)
        elif tag == "pre":
            self.fixed = max(0, self.fixed - 1)
            self.block(1)
            self.out.append("```")
            self.block()
        elif tag == "blockquote":
            self.quotes = max(0, self.quotes - 1)
            self.block()
        elif tag == "a":
            if self.hrefs and (href := self.hrefs.pop()):
                self.out.append(f"]({href})")
        elif tag in ("td", "th"):
            self.out.append(" ")
        elif tag in MARKS and not self.fixed:
            self.out.append(MARKS[tag])
        elif tag in BLOCKS or re.fullmatch("h[1-6]", tag):
            self.block()

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        if not self.fixed:
            data = re.sub(r"[ \t\r\n\f]+", " ", data)
            if not self.out or self.out[-1].endswith(("\n", "- ", "# ", "> ")):
                data = data.lstrip(" ")
        if data:
            self.out.append(data)

    def markdown(self) -> str:
        lines = ["" if x.isspace() else x for x in "".join(self.out).split("\n")]
        return "\n".join(x if x.endswith("  ") and n + 1 < len(lines) else x.rstrip(" ") for n, x in enumerate(lines)).strip("\n")


def to_markdown(html: str) -> str:
    converter = Converter()
    converter.feed(html)
    converter.close()
    return converter.markdown()


@F.pandas_udf(StringType())
def markdown(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Markdown of whole HTML documents; a document that can't be read gives null and no other row is lost."""

    def one(html: str | None) -> str | None:
        if html is None:
            return None
        try:
            return to_markdown(html)
        except (AssertionError, ValueError, RecursionError):
            return None

    for part in pages:
        yield part.map(one)


def without_scripts(html: Column) -> Column:
    """Drop ``script`` and ``style`` with all inside."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", "")


# Entities that stand in titles.
NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&copy;": "©", "&middot;": "·", "&nbsp;": " ", "&amp;": "&"}


def title(html: Column, entities: Mapping[str, str] = NAMED) -> Column:
    """The title's text with ``entities`` decoded; ``Untitled`` without a title element, and ``None`` for one that is empty or holds elements."""
    inside = F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    decoded = inside
    for name, character in entities.items():
        decoded = F.replace(decoded, F.lit(name), F.lit(character))
    return F.when(~html.rlike(r"(?is)<title\b"), F.lit("Untitled")).when((inside == "") | inside.contains("<"), F.lit("None")).otherwise(decoded)


def scrapes(pages: DataFrame, scrape_date: str, url: str = "url", html: str = "html", key: str | None = None, entities: Mapping[str, str] = NAMED) -> DataFrame:
    """(url, file, title, text, error): each page as a Markdown document with front matter; ``error`` where it can't be read. A ``key`` column is kept in front; ``entities`` are those that titles are decoded by."""
    kept = [F.col(key)] if key and key != url else []
    body, titled = markdown(without_scripts(F.col(html))), title(F.col(html), entities)
    head = F.to_json(F.struct(F.col(url).alias("original_url"), F.lit(scrape_date).alias("scrape_date"), titled.alias("title")))
    made = pages.select(*kept, F.col(url).alias("url"), file_name(F.col(url)).alias("file"), titled.alias("title"), head.alias("head"), body.alias("body"))
    text = F.concat(yaml_block("head"), F.lit("\n"), collapse_blank_lines(F.col("body")))
    return made.select(*kept, "url", "file", "title", text.alias("text"), F.col("body").isNull().alias("error"))



def scrape_list(seeds: DataFrame, pages: DataFrame, scrape_date: str, key: str = "url", entities: Mapping[str, str] = NAMED) -> DataFrame:
    """(url, file, title, text, error) for every row of ``seeds`` (url), repeats included; ``error`` where its page was not fetched. ``pages`` (url, html) has a row for each ``key``, a column of both that tells several pages of one URL apart."""
    made = scrapes(pages, scrape_date, key=key, entities=entities).drop("file", *(["url"] if key != "url" else []))
    listed = seeds.select(*dict.fromkeys(["url", key]), file_name(F.col("url")).alias("file"))
    return listed.join(made, key, "left").withColumn("error", F.coalesce("error", F.lit(True))).select("url", "file", "title", "text", "error")


def fetch(urls: DataFrame, fetcher: Callable[[str], str]) -> DataFrame:
    """(url, html) of every row of ``urls`` (url); ``fetcher`` runs in the tasks, and a URL on which it fails has a null page."""

    def one(url: str | None) -> str | None:
        try:
            return fetcher(url)
        except Exception:  # noqa: BLE001  a fetcher may fail in any way; its row is the failed page then
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("html", pa.array(map(one, batch.column("url").to_pylist()), pa.string()))

    return urls.select("url").mapInArrow(run, "url string, html string")
