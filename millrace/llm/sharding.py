"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; the
fractional rank (rank + 1/2) / (rows of the source) puts all sources on one
scale; the order by fractional rank is cut into shards whose row counts differ
by one at most. Any stretch of that order holds every source in proportion, so
every shard matches the mixture.

Neither a source nor the whole table is ever ranked in one task: rows are
counted by (source, slice of the hash) and by slice of the fractional rank, the
small tables of counts are summed up, and rows are numbered inside their slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import unused, written

#: Hex digits of the hash that name a slice of a source: 4096 slices each.
SLICE_DIGITS = 3
#: Slices of the scale of fractional ranks.
SCALE = 4096
#: Rows of a file of a shard.
FILE_ROWS = 1 << 17

COLUMNS = ["doc_id", "source", "size", "text_crc32"]


def shuffle_key(seed: int, doc_id: Column, text_crc32: Column, size: Column) -> Column:
    """The seeded shuffle: SHA-256 of seed and row, as hex digits."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), text_crc32.cast("string"), size.cast("string")), 256)


def shard(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` and ``slot`` (0-based, gapless) to rows of ``doc_id, source, size, text_crc32``.

    A null source is a source of its own; a null doc_id takes part like any
    other. Rows that are alike in all four columns are interchangeable. With
    fewer rows than shards some shards stay empty; an empty table stays empty.
    """
    keyed = rows.select(*COLUMNS, shuffle_key(seed, F.col("doc_id"), F.col("text_crc32"), F.col("size")).alias("key"))
    keyed = keyed.withColumn("slice", F.substring("key", 1, SLICE_DIGITS)).withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    in_slice = Window.partitionBy("source_key", "slice").orderBy("key", "doc_id")
    counts = keyed.groupBy("source_key", "slice").agg(F.count("*").alias("n"))
    before = counts.select(
        "source_key", "slice",
        F.coalesce(F.sum("n").over(Window.partitionBy("source_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("source_key")).alias("of"),
    )
    ranked = keyed.withColumn("r", F.row_number().over(in_slice) - 1).join(before, ["source_key", "slice"])
    exact = (2 * (F.col("before") + F.col("r")) + 1) / (2 * F.col("of")).cast("double")
    placed = written(ranked.select(*COLUMNS, "source_key", exact.alias("place"), F.least(F.floor(exact * SCALE), F.lit(SCALE - 1)).cast("int").alias("band")))
    bands = placed.groupBy("band").agg(F.count("*").alias("n"))
    # At most SCALE rows, whatever the input.
    ahead = bands.select(
        "band",
        F.coalesce(F.sum("n").over(Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"),
        F.sum("n").over(Window.partitionBy()).alias("rows"),
    )
    order = Window.partitionBy("band").orderBy("place", "source_key", "doc_id", "text_crc32", "size")
    at = placed.withColumn("r", F.row_number().over(order) - 1).join(F.broadcast(ahead), "band").withColumn("at", F.col("ahead") + F.col("r"))
    number = F.expr(f"at * {shards} div rows")
    return at.withColumn("shard", number.cast("int")).select(*COLUMNS, "shard", (F.col("at") - F.expr(f"(shard * rows + {shards - 1}) div {shards}")).alias("slot"))


def measured(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``doc_id, source, size, text_crc32`` of every row: UTF-8 bytes of the text plus 16, and its CRC-32; a null text counts as empty."""
    return docs.select(*measured_columns(doc_id, source, text))


def measured_columns(doc_id: str, source: str, text: str) -> list[Column]:
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), (F.octet_length(whole).cast("long") + 16).alias("size"), F.crc32(whole).alias("text_crc32")]


def numbered(rows: DataFrame, order: Column) -> DataFrame:
    """Add ``key``, which names the values of ``COLUMNS``, and ``copy``, which numbers the rows that share it."""
    number, source, rest = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "source", "size"))
    keyed = rows.withColumn("key", F.concat_ws(":", number, rest, "text_crc32", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), source))))
    return keyed.withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy(order)))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, doc_id: str = "doc_id", source: str = "source", text: str = "text", rows_per_file: int = FILE_ROWS) -> None:
    """Write all columns of ``docs`` as one folder of Parquet files a shard, rows in slot order inside a file of at most ``rows_per_file`` rows.

    ``assigned`` is what ``shard`` makes of ``measured(docs)``. Its columns
    ``shard`` and ``slot`` are written too, under longer names where docs has
    these. A row finds its slot by what ``measured`` says of it, a null doc_id or
    source included; rows alike in all of that take their slots by a hash of
    their columns, each row one. A shard is dealt over tasks by ranges of slots,
    so no task holds a whole one. An empty table gives an empty folder.
    """
    shard_name, slot_name = unused("shard", docs.columns), unused("slot", docs.columns)
    held = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(*(c for c, kind in docs.dtypes if "map<" not in kind)).alias("hash"), *measured_columns(doc_id, source, text))
    mine = numbered(held, F.col("hash")).select("row", "key", "copy")
    places = numbered(assigned.select(*COLUMNS, "shard", "slot"), F.struct("shard", "slot")).select("key", "copy", F.col("shard").alias(shard_name), F.col("slot").alias(slot_name))
    found = mine.join(places, ["key", "copy"]).select("row.*", shard_name, slot_name)
    dealt = found.repartition(shard_name, F.floor(F.col(slot_name) / rows_per_file)).sortWithinPartitions(shard_name, slot_name)
    dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy(shard_name).parquet(path)
