"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.tables import dropped, shared_dir, written  # noqa: F401

#: ASCII white space: the separators of words in most contracts.
SPACE = b" \t\n\x0b\x0c\r"
#: Tasks over which a hot join key is dealt.
SALTS = 16


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """As ``written``, in buckets by ``key``, so that grouping by it later shuffles nothing."""
    spark = df.sparkSession
    name = f"millrace_{uuid.uuid4().hex}"
    df.write.bucketBy(partitions(spark), key).option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def salted_join(many: DataFrame, one: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``many`` joined with ``one``, which has a row for each key, where a key may hold any share of ``many``: its rows are dealt over ``SALTS`` tasks."""
    salt = unused("salt", many.columns + one.columns)
    dealt = many.withColumn(salt, F.pmod(F.xxhash64(*many.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(one.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*keys, salt], how).drop(salt)


def keyed_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id`` (long) and ``text`` under these names; columns that are so already get no alias, which would hide equal shuffles from Spark."""
    plain = docs.schema[doc_id].dataType.simpleString() == "bigint" and (doc_id, text) == ("doc_id", "text")
    return docs.select("doc_id", "text") if plain else docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def unused(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        part = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null is empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words (runs without ASCII white space) of all texts in one array, and the offset of each text's first word."""
    lists = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    offsets, flat = offsets - offsets[0], lists.flatten()
    full = np.asarray(pc.binary_length(flat)) > 0
    if not full.all():
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        flat = flat.filter(pa.array(full))
    return flat, offsets


def spread(x: np.ndarray) -> np.ndarray:
    """Mix the bits of unsigned 64-bit integers (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def planes(x: np.ndarray) -> bytes:
    """The bytes of small integers, plane by plane, which compresses well."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)
