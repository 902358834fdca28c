"""Chunk documents to one merged table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import tables
from millrace.functions.text import strip, word_count
from millrace.operators.frontmatter import has_block, lenient, split_block, with_parsed


def merge_chunks(chunks: DataFrame, file: str = "chunk_file", text: str = "text", strict: bool = True) -> DataFrame:
    """(original_url, scrape_date, title, chunk_index, content, total_chunks, source_file, section_path, char_count, word_count, chunk_file).

    Five fields have defaults, the others are null where front matter lacks
    them. Without front matter the content is the text, not stripped. A missing
    URL is taken from front matter at the head of the content, if there is any.
    ``strict`` reads YAML and falls back to ``key: value`` lines; without it only
    those are read, which needs no Python.
    """
    block, body = split_block(F.col(text))
    split = chunks.select(F.col(file).alias("chunk_file"), F.col(text).alias("whole"), has_block(F.col(text)).alias("has"), block.alias("block"), body.alias("body"))
    inner_block, _ = split_block(F.col("body"))
    holds_more = F.col("has") & strip(F.col("body")).startswith("---") & has_block(F.col("body"))
    fenced = F.when(F.col("has"), F.col("block"))
    # Both maps are columns of a step of their own, so they are made once, however many fields are read from them.
    read = with_parsed(split, fenced, "fm") if strict else split.withColumn("fm", lenient(fenced))
    # The rescue reads inner blocks leniently: they were written by scrapers that did not quote.
    outer = read.withColumn("inner", F.when(holds_more, lenient(inner_block)))
    of = lambda key: F.try_element_at("fm", F.lit(key))
    found = F.coalesce(F.size(F.map_keys("fm")) > 0, F.lit(False))
    legacy = F.coalesce(of("original_url"), F.lit("")) == ""
    rescued = lambda key: F.coalesce(F.when(of(key) != "", of(key)), F.when(legacy, F.try_element_at("inner", F.lit(key))), F.lit("")).alias(key)
    return outer.select(
        rescued("original_url"), F.coalesce(of("scrape_date"), F.lit("")).alias("scrape_date"), rescued("title"),
        F.coalesce(of("chunk_index").try_cast("int"), F.lit(0)).alias("chunk_index"), F.when(found, strip(F.col("body"))).otherwise(F.col("whole")).alias("content"),
        of("total_chunks").try_cast("int").alias("total_chunks"), of("source_file").alias("source_file"), F.from_json(of("section_path"), "array<string>").alias("section_path"),
        of("char_count").try_cast("long").alias("char_count"), of("word_count").try_cast("long").alias("word_count"), "chunk_file",
    )


def in_order(merged: DataFrame) -> DataFrame:
    """By source file and index (missing ones first), then by chunk file."""
    return merged.orderBy(F.coalesce("source_file", F.lit("")), F.coalesce("chunk_index", F.lit(0)), "chunk_file")


def placed(merged: DataFrame) -> DataFrame:
    """Add ``place``, from 0, in the order of ``in_order``."""
    return tables.in_order(merged, [F.coalesce("source_file", F.lit("")), F.coalesce("chunk_index", F.lit(0)), "chunk_file"])


def with_url(merged: DataFrame, url: str | None) -> DataFrame:
    """Chunks of one URL. The reference announces such a filter but keeps everything; None does the same."""
    return merged if url is None else merged.filter(F.col("original_url") == url)


def may_have_url(chunks: DataFrame, url: str | None, text: str = "text") -> DataFrame:
    """Chunk documents that can have this URL, found in their texts before any front matter is read.

    YAML writes a URL as it is, unless it is escaped or has quotes or spaces.
    """
    if url is None:
        return chunks
    whole = F.col(text).contains(url) | F.col(text).contains("\\")
    return chunks.filter(whole if not set(url) & set("' \t\n\"") else F.lit(True))


def merge_summary(merged: DataFrame) -> DataFrame:
    """One row: chunks, characters, words, distinct URLs."""
    return merged.agg(
        F.count("*").alias("chunks"), F.coalesce(F.sum(F.coalesce("char_count", F.length("content").cast("long"))), F.lit(0)).alias("total_chars"),
        F.coalesce(F.sum(F.coalesce("word_count", word_count(F.col("content")))), F.lit(0)).alias("total_words"), F.count_distinct(F.nullif("original_url", F.lit(""))).alias("unique_urls"),
    )


def as_json(row: Column) -> Column:
    """One JSON object; fields that are null are left out."""
    return F.to_json(row)
