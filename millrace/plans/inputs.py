"""Inputs of the queries: driver tables, some with Markdown structure put in line by line.

Each column expression here has its DuckDB counterpart beside it, so that both
engines see the same bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import lines
from millrace.operators.rules import Rule


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_line(text: Column, rule) -> Column:
    return F.array_join(F.transform(lines(text), rule), "\n")


def sql_by_line(rule: str) -> str:
    return f"array_to_string(list_transform(string_split(text, chr(10)), lambda l, i: {rule}), chr(10))"


def with_headers(text: Column) -> Column:
    """Headers of levels 1, 2 and 4 before some lines."""
    n = lambda i: i.cast("string")
    return by_line(
        text,
        lambda x, i: F.when(i % 11 == 0, F.concat(F.lit("# T"), n(i), F.lit("\n\n"), x))
        .when(i % 7 == 0, F.concat(F.lit("\n## S"), n(i), F.lit("\n"), x))
        .when(i % 5 == 0, F.concat(F.lit("\n#### D"), n(i), F.lit("\n"), x))
        .otherwise(x),
    )


SQL_HEADERS = sql_by_line(
    "CASE WHEN (i-1)%11=0 THEN '# T' || (i-1) || chr(10) || chr(10) || l WHEN (i-1)%7=0 THEN chr(10) || '## S' || (i-1) || chr(10) || l"
    " WHEN (i-1)%5=0 THEN chr(10) || '#### D' || (i-1) || chr(10) || l ELSE l END"
)


def with_blanks(text: Column) -> Column:
    """Blank lines and white space at line ends."""
    return by_line(text, lambda x, i: F.when(i % 3 == 0, F.concat(x, F.lit("  \n\n \n\n\n"))).otherwise(F.concat(x, F.lit("\t"))))


SQL_BLANKS = sql_by_line("CASE WHEN (i-1)%3=0 THEN l || '  ' || chr(10) || chr(10) || ' ' || chr(10) || chr(10) || chr(10) ELSE l || chr(9) END")


def with_boilerplate(text: Column) -> Column:
    """Sections between markers, some of them unclosed, and lines that rules remove."""
    return by_line(
        text,
        lambda x, i: F.when(i % 6 == 1, F.concat(F.lit("<<BEGIN>>\n"), x))
        .when(i % 6 == 3, F.concat(x, F.lit("\n<<END>>")))
        .when(i % 4 == 0, F.concat(F.lit("[Read more](/x)\n"), x, F.lit(" You are not logged in")))
        .otherwise(x),
    )


SQL_BOILERPLATE = sql_by_line(
    "CASE WHEN (i-1)%6=1 THEN '<<BEGIN>>' || chr(10) || l WHEN (i-1)%6=3 THEN l || chr(10) || '<<END>>'"
    " WHEN (i-1)%4=0 THEN '[Read more](/x)' || chr(10) || l || ' You are not logged in' ELSE l END"
)


def front_matter(doc_id: Column, source: Column, lang: Column) -> Column:
    """A front matter block whose title has a colon without quotes, as old scrapers wrote it."""
    part = F.when(doc_id % 3 == 0, F.lit("interview-questions/")).otherwise(F.lit("p/"))
    number = doc_id.cast("string")
    return F.concat(
        F.lit("---\noriginal_url: https://www."), source, F.lit(".example.com/"), part, number, F.lit("\nscrape_date: '2025-01-01'\ntitle: Doc "), number, F.lit(": "), lang, F.lit("\n---\n\n")
    )


SQL_FRONT = (
    "('---' || chr(10) || 'original_url: https://www.' || source || '.example.com/' || CASE WHEN doc_id % 3 = 0 THEN 'interview-questions/' ELSE 'p/' END || doc_id || chr(10)"
    " || 'scrape_date: ''2025-01-01''' || chr(10) || 'title: Doc ' || doc_id || ': ' || lang || chr(10) || '---' || chr(10) || chr(10))"
)


def shaped(spark: SparkSession, sf_dir: str, shape) -> DataFrame:
    """``documents`` with ``shape`` applied to their texts."""
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", shape(F.col("text")).alias("text"))


def markdown_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with front matter, headers and boilerplate, as the crawler leaves them."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file"), F.concat(front_matter(F.col("doc_id"), F.col("source"), F.col("lang")), with_headers(F.col("text"))).alias("text"))


#: A rule of every type, for the queries.
RULES = [
    Rule("line_pattern", "links to more", pattern=r"^\[Read more\]\(.*\)$"),
    Rule("section_boundary", "marked sections", start_marker="<<BEGIN>>", end_marker="<<END>>"),
    Rule("regex", "login notes", pattern=r" you are NOT logged in", flags=("IGNORECASE",)),
    Rule("exact_match", "a stray article", pattern=" the ", max_remove=2),
    Rule("repeating_pattern", "commas", pattern=", ", keep_first=True),
]
