"""Queries on tables that the small test data has no rows of, against their SQL."""

import datetime
import itertools
import random
import subprocess
import sys
from pathlib import Path

import pytest
import yaml
from pyspark.sql import functions as F

from millrace.operators import frontmatter, html
from millrace.plans import registry
from millrace.sources import files


@pytest.fixture
def same_as_sql(spark, tmp_path):
    """Asserts that a query gives the rows of its SQL on tables of these rows."""
    import duckdb

    def check(name, **tables):
        con = duckdb.connect()
        for table, (schema, rows) in tables.items():
            path = tmp_path / f"{table}.parquet"
            spark.createDataFrame(rows, schema).write.parquet(str(path))
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/*.parquet')")
        frame = registry.QUERIES[name](spark, str(tmp_path))
        columns = sorted(frame.columns)
        wanted = con.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
        assert sorted(map(repr, wanted)) == sorted(repr(tuple(row)) for row in frame.select(*columns).collect())

    return check


def pages(*rows):
    return "page_id long, url string, html string", [(k, url, html) for k, (url, html) in enumerate(rows)]


#: Two URLs with several pages each, which have links in common; page 0 and 5 are missing in the mirror, odd ones in the list.
REPEATED = pages(*((f"https://www.a.com/{k % 2}", f'<title>T{k}</title><a href="/x">x</a><a href="/{k % 3}">y</a>') for k in range(12)))


def test_pages_of_one_url_are_fetched_apart(same_as_sql):
    same_as_sql("fetch_pages", pages=REPEATED)


def test_export_of_more_than_9999_questions(same_as_sql):
    documents = [(3 * k, "word", "en", "src0", 4) for k in range(10_001)]
    same_as_sql("export_json_document", documents=("doc_id long, text string, lang string, source string, n_chars long", documents), labels=("doc_id long, quality int, toxic int", [(1, 1, 0)]))


def test_pages_of_one_url_are_listed_apart(same_as_sql):
    same_as_sql("scrape_list", pages=REPEATED)


@pytest.mark.parametrize("name", ["html_title", "scrape_list"])
def test_entities_of_titles(name, same_as_sql):
    same_as_sql(name, pages=pages(*((f"https://a.com/{k}", f"<title>{t}</title>") for k, t in enumerate(["&quot;x&quot; &copy;", "a", "&lt;b&gt; &amp;quot;", "c", "&nbsp;&#39;d &middot;"]))))


def test_scraped_titles_have_all_entities_decoded(spark):
    found = html.scrapes(spark.createDataFrame([("https://a.com/", "<title>&quot;x&quot;</title>")], "url string, html string"), "2025-01-01").head()
    assert found.title == '"x"' and "title: '\"x\"'" in found.text


def test_links_of_several_pages_of_one_url_are_distinct(same_as_sql):
    same_as_sql("link_extract", pages=REPEATED)


def test_plain_blocks_are_read_as_yaml_reads_them():
    values = ["a", "a: b", "a #b", "'a''b'", "'a'b'", "''", "'", "yes", "No", "007", "12", "-3", "1.5", "1:30", "2025-01-01", "'2025-01-01'", "null", "~", "[]", "{}", "[a]", "true", "\"x\"", "|", "é ü", "a:", "x ", " x", "", "...", "=", "<<", "https://x/1", "a\tb", "- a", "(a)", ".5", "_1", "0x1f", "9" * 19, "\x85", "\u2028"]
    pieces = [f"{k}: {v}" for k in ("k", "no", "y") for v in values] + ["k:", "l:", "k: ", "- a", "- 5", "- 'x'", "-", "  a: b", "  c: 5", "  no: x", "  d:", "   e: f", "# c", "---", "...", "", "key", "m:\n- a\n- b: c", "n:\n  a: 'b'\n  c: d"]
    draw = random.Random(5)
    blocks = pieces + ["\n".join(x) for x in itertools.product(pieces[-25:], repeat=2)] + ["\n".join(draw.choices(pieces, k=draw.randint(2, 5))) for _ in range(4000)]
    known = 0
    for block in blocks:
        found = frontmatter.plain_record(block)
        if found is not None:
            known += 1
            wanted = yaml.safe_load(block)
            assert found == wanted and repr(found) == repr(wanted) and not isinstance(wanted, datetime.date), block
    assert known > 50


def test_many_blocks_are_read_right(spark):
    block = "\n".join(["title: 'T: 1'", "source_file: src0/1.md", "section_path:", "- T0", "- S7", "section_headers:", "  h1: T0", "  h2: S7", *(f"field_{k}: {k}" for k in range(12))])
    frame = spark.range(0, 40_000, 1, 1).selectExpr("id AS n").withColumn("b", F.concat(F.lit(block + "\nid: "), F.col("n").cast("string")))
    assert frontmatter.with_parsed(frame, F.col("b")).filter("fm['id'] = cast(n AS string) AND fm['section_path'] = '[\"T0\",\"S7\"]'").count() == 40_000


def test_a_task_reads_many_small_files(spark, tmp_path):
    names = [f"{k}.md" for k in range(3_000)]
    for name in names:
        (tmp_path / name).write_text(f"text of {name}")
    found = files.documents(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert {r.file: r.text for r in found.collect()} == {name: f"text of {name}" for name in names}


def test_tasks_that_chunk_load_no_pandas():
    """PySpark loads pandas for the processes of Arrow functions on columns, not for those on batches, which chunk."""
    told = subprocess.run([sys.executable, "-c", "import millrace.operators.chunking, millrace.operators.frontmatter, sys; print('pandas' in sys.modules)"], capture_output=True, text=True, cwd=Path(__file__).parent.parent)
    assert told.stdout.split()[-1] == "False"
