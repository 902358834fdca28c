"""Cleaning and chunking over a stream of documents (an extension: the reference has batches only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.chunking import smart_chunks
from millrace.operators.cleaning import clean
from millrace.operators.rules import Rule


def chunk_stream(docs: DataFrame, rules: Sequence[Rule] = (), key: str = "doc_id", text: str = "text", **sizes) -> DataFrame:
    """Chunks of cleaned documents, row by row and without state, so any output mode but complete will do."""
    cleaned = clean(docs.select(key, text), rules, text)
    return smart_chunks(cleaned.select(key, "cleaned"), key, "cleaned", **sizes)


def run(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, rules: Sequence[Rule] = (), **sizes) -> StreamingQuery:
    """Read new Parquet files of documents, append their chunks to ``target``, and stop when all are read."""
    docs = spark.readStream.schema(schema).parquet(source)
    out = chunk_stream(docs, rules, **sizes)
    return out.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
