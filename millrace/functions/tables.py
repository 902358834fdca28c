"""Tables between steps, in the folder that driver and executors share, and places in an order."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder of the warehouse where the cluster names none."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/millrace_written"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet and read it back: lineage ends there, so a lost executor costs a task. Without ``spark.checkpoint.dir`` it goes to the warehouse."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Delete the files of tables made by ``written`` that no later step reads."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def in_order(df: DataFrame, order: Sequence[Column | str], within: str | None = None, place: str = "place", size: str | None = None) -> DataFrame:
    """Add ``place``: 0, 1, 2, ... of every row in ``order``, or in that order among the rows of the same ``within``; the result is a written table.

    ``order`` must begin with ``within`` where that is given, which may not be
    null. Spark samples the order for the bounds of its ranges, so ranges hold
    about equal numbers of rows however the values lie, and sorts each range in a
    task of its own. A row's number inside its range plus the rows of the ranges
    before is its place. There are at most as many counts to sum up as ranges and
    values of ``within``. Rows that tie take their places either way; ``size``, if
    given, counts the rows that share the value of ``within``. Columns of ``df``
    must not be named ``_at``, ``_range``, ``_first``, ``_n`` or ``_shift``.
    """
    once = written(df)  # its bounds are sampled in a pass of their own
    sorted_ = written(once.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    ranged = sorted_.withColumn("_range", F.shiftright("_at", 33))
    keys = ["_range"] if within is None else [within, "_range"]
    counts = ranged.groupBy(*keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy(*([within] if within else []))
    before = F.coalesce(F.sum("_n").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = counts.select(*keys, (before - F.col("_first")).alias("_shift"), *([F.sum("_n").over(group).alias(size)] if size else []))
    placed = ranged.join(found if within else F.broadcast(found), keys)
    out = written(placed.withColumn(place, F.col("_at") + F.col("_shift")).select(*df.columns, place, *([size] if size else [])))
    dropped(once, sorted_)
    return out
