"""Readers and writers of the files between the stages."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions.tables import written
from millrace.functions.text import strip
from millrace.operators.cleaning import report
from millrace.operators.review import CSV_HEADER, report_head, report_title, test_case
from millrace.sources.sink import write_documents  # noqa: F401

SUFFIX = r"(?i)\.(md|mdx|markdown)\z"


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """(url): the non-blank lines of a text file, stripped; repeats stay."""
    return spark.read.text(path).select(strip(F.col("value")).alias("url")).filter("url <> ''")


def queue(spark: SparkSession, path: str) -> DataFrame:
    """(url, hop) from JSON lines; a line that is no JSON object is a URL at hop 0."""
    line = spark.read.text(path).select(strip(F.col("value")).alias("line")).filter("line <> ''")
    read = F.from_json("line", "url string, hop int")
    plain = F.col("read.url").isNull()
    return line.withColumn("read", F.when(F.col("line").startswith("{"), read)).select(F.when(plain, F.col("line")).otherwise(F.col("read.url")).alias("url"), F.when(plain, F.lit(0)).otherwise(F.coalesce("read.hop", F.lit(0))).alias("hop"))


def visited(spark: SparkSession, path: str) -> DataFrame:
    return seeds(spark, path).distinct()


def write_queue(frontier: DataFrame, path: str) -> None:
    frontier.select("url", "hop").write.mode("overwrite").json(path)


def write_visited(urls: DataFrame, path: str) -> None:
    """The URLs in order, in as many files as there are partitions."""
    urls.select("url").distinct().orderBy("url").select(F.col("url").alias("value")).write.mode("overwrite").text(path)


@F.pandas_udf(StringType())
def without_invalid(contents: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Bytes as UTF-8, those that are invalid left out."""
    for part in contents:
        yield part.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def decoded(content: Column, lenient: bool = False) -> Column:
    """Bytes as UTF-8; ``lenient`` drops what is invalid, else a document with invalid bytes is null."""
    return without_invalid(content) if lenient else F.try_validate_utf8(content.cast("string"))


def in_runs(files: DataFrame, run: int = 32) -> DataFrame:
    """The same rows in fewer tasks: Spark counts a small file as some MB and gives a task a few of them; here one takes ``run`` such partitions, but all cores keep some tasks."""
    parts = files.rdd.getNumPartitions()
    return files.coalesce(max(parts // run, min(parts, 4 * files.sparkSession.sparkContext.defaultParallelism)))


def documents(spark: SparkSession, path: str, recursive: bool = True, lenient: bool = False) -> DataFrame:
    """(path, file, text) of Markdown files: ``.md``, ``.mdx`` and ``.markdown`` below ``path``, or only ``*.md`` in it."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    reader = reader if recursive else reader.option("pathGlobFilter", "*.md")
    found = in_runs(reader.load(path)).filter(F.col("path").rlike(SUFFIX))
    return found.select("path", F.substring_index("path", "/", -1).alias("file"), decoded(F.col("content"), lenient).alias("text"))


def curated(spark: SparkSession, path: str) -> DataFrame:
    """The questions of ``{metadata, questions: [...]}`` documents, numbered by ``seq``."""
    found = spark.read.option("multiLine", "true").json(path)
    return found.select(F.posexplode("questions").alias("seq", "q")).select("seq", "q.*")


def lines_of(frame: DataFrame) -> DataFrame:
    """One JSON object a line: the merged corpus as a table that many tasks can write."""
    return frame.select(F.to_json(F.struct(*frame.columns)).alias("value"))


def write_json_lines(frame: DataFrame, path: str) -> None:
    lines_of(frame).write.mode("overwrite").text(path)


def as_document(frame: DataFrame, order: Sequence[str | Column], line: Column, head: str, tail: str | None, between: str = "") -> DataFrame:
    """(value), sorted: ``head``, a ``line`` for each row in ``order``, each but the last followed by ``between``, and ``tail``.

    The part files of such a table, one after another, are one document; no task
    ever holds it. Ties of the order may fall either way.
    """
    placed = written(frame.orderBy(*order).select(line.alias("value"), F.monotonically_increasing_id().alias("at")))
    last = placed.agg(F.max("at")).head()[0]
    ends = [(head, -1)] + ([] if tail is None else [(tail, (1 << 63) - 1)])
    rows = placed.select(F.concat("value", F.when(F.col("at") == last, F.lit("")).otherwise(F.lit(between))).alias("value"), "at") if last is not None else placed
    return rows.unionByName(frame.sparkSession.createDataFrame(ends, "value string, at long")).orderBy("at").select("value")


def json_array(frame: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows as one JSON array; fields that are null are left out."""
    return as_document(frame, order, F.to_json(F.struct(*frame.columns)), "[", "]", ",")


def write_json_array(frame: DataFrame, path: str, order: Sequence[str]) -> None:
    """Merged chunks, or merged questions, as a JSON array over the part files of ``path``."""
    json_array(frame, order).write.mode("overwrite").text(path)


def question_json(questions: DataFrame, order: Sequence[str], metadata: dict) -> DataFrame:
    """``{metadata, questions}``, the form that ``curated`` reads; ``metadata`` gets the counts of questions."""
    n = questions.agg(F.count("*").alias("total_questions"), F.count_if(F.col("confidence") == "extracted").alias("extracted_questions"), F.count_if(F.coalesce("confidence", F.lit("")) != "extracted").alias("synthetic_questions"))
    head = json.dumps(n.head().asDict() | metadata, ensure_ascii=False)
    return as_document(questions, order, F.to_json(F.struct(*questions.columns), {"ignoreNullFields": "false"}), f'{{"metadata": {head}, "questions": [', "]}", ",")


def write_cleaned(cleaned: DataFrame, path: str, dry_run: bool = False, flush: bool = False, file: str = "file", text: str = "text") -> DataFrame:
    """Write the ``cleaned`` texts as files and return their report; ``dry_run`` only reports.

    With ``flush`` the files that ``path`` held before go once the new ones are
    written, so a failed run loses nothing; a dry run leaves them.
    """
    if not dry_run:
        write_documents(cleaned, path, file, "cleaned", overwrite=flush)
    return report(cleaned, text)


def exported(numbered: DataFrame, kind: str, created_at: str = "", order: Sequence[str | Column] | None = None) -> DataFrame:
    """(value), sorted by ``order``, else by the number of the question: the lines of one export document: json, jsonl, csv, trec or report."""
    order, line = order or [F.substring("question_id", 3, 20).cast("long")], test_case(kind)
    if kind == "json":
        head = json.dumps({"created_at": created_at, "total_questions": numbered.count(), "format": "retrieval_test_set_v1"})
        return as_document(numbered, order, line, f'{{"metadata": {head}, "test_cases": [', "]}", ",")
    if kind == "csv":
        return as_document(numbered, order, line, CSV_HEADER, None)
    if kind == "report":
        types = [r.line for r in report_head(numbered).orderBy("source_type").collect()]  # one line for each source type
        return as_document(numbered, order, F.regexp_replace(line, r"\n\z", ""), report_title(numbered.count(), created_at) + "\n".join(types) + "\n\n## Questions\n", None)
    return numbered.orderBy(*order).select(line.alias("value"))


def export(numbered: DataFrame, path: str, kind: str, created_at: str = "") -> None:
    """Write questions that have ids in one form, or in ``all``, each in a folder of its own below ``path``; the report is always written beside."""
    for one in (*(("json", "jsonl", "csv", "trec") if kind == "all" else (kind,)), *(() if kind == "report" else ("report",))):
        exported(numbered, one, created_at).write.mode("overwrite").text(f"{path}/{one}")
