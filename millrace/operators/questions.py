"""Questions from chunks: extraction, sampling, prompts, responses, numbering."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.functions.text import collapse_spaces, stem, strip
from millrace.operators.frontmatter import has_block, split_block, with_front_matter, with_parsed

# Words that make a heading a question, anywhere in it.
KEYWORDS = ["what", "how", "when", "why", "which", "where"]
#: Where questions are looked for.
MARK = "interview-question"

QUESTION = ["question", "chunk_id", "chunk_path", "source_url", "section_path", "confidence", "reviewed", "source_type"]


def is_candidate(path: Column) -> Column:
    return path.contains(MARK)


def asks(text: Column) -> Column:
    hit = text.contains("?")
    for word in KEYWORDS:
        hit = hit | F.lower(text).contains(word)
    return hit


def question_of(original_url: Column, section_path: Column, body: Column, words: Column) -> Column:
    """The first heading, or else the first level-one header of the body, that asks something, in chunks of over 30 words from question pages; else null."""
    heading = F.get(F.filter(section_path, asks), F.lit(0))
    header = strip(F.regexp_extract(body, r"(?dm)^# (.+?)$", 1))
    found = F.coalesce(heading, F.when((header != "") & asks(header), header))
    return F.when(original_url.contains(MARK) & (words > 30), F.regexp_replace(collapse_spaces(found), r"\A`+|`+\z", ""))


def extract(chunks: DataFrame) -> DataFrame:
    """Questions that stand in the chunks themselves; ``chunks`` has chunk_id, chunk_path, original_url, section_path, text and word_count."""
    asked = chunks.filter(is_candidate(F.col("chunk_path"))).withColumn("question", question_of(F.col("original_url"), F.col("section_path"), F.col("text"), F.col("word_count")))
    return asked.filter("question is not null").select(
        "question", "chunk_id", "chunk_path", F.col("original_url").alias("source_url"), "section_path",
        F.lit("extracted").alias("confidence"), F.lit(False).alias("reviewed"), F.lit("interview_question").alias("source_type"),
    )


def sample(chunks: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` chunks that are no question pages, by a seeded hash of their path: a top-n, alike on every run."""
    key = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col("chunk_path")))
    return chunks.filter(~is_candidate(F.col("chunk_path"))).orderBy(key, "chunk_path").limit(n)


def prompt(chunks: DataFrame, questions: int = 3, least_words: int = 20) -> DataFrame:
    """Add ``prompt``; chunks under ``least_words`` words go first, before any paid call."""
    section = F.when(F.size("section_path") > 0, F.array_join("section_path", " > ")).otherwise(F.lit("No section"))
    parts = [
        F.lit(f"Write {questions} questions that the following passage answers best.\n\nSource: "), F.coalesce("original_url", F.lit("Unknown")), F.lit("\nSection: "), section,
        F.lit("\nTitle: "), F.coalesce("title", F.lit("Unknown")), F.lit("\n\nPassage:\n"), F.col("text"),
        F.lit("\n\nThe passage alone must answer each question. Ask as a reader would, of several kinds (facts, steps, ideas, faults), and don't speak of the passage. Reply with a JSON array of strings only."),
    ]
    return chunks.filter(F.col("word_count") >= least_words).withColumn("prompt", F.concat(*parts))


def ask(prompted: DataFrame, provider: Callable[[str], str]) -> DataFrame:
    """Add ``response`` of a language model; ``provider`` runs in the tasks, and a prompt on which it fails gives null."""
    schema = StructType([*prompted.schema.fields, StructField("response", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(text: str) -> str | None:
            try:
                return provider(text)
            except Exception:  # noqa: BLE001  a provider may fail in any way; its row has no questions then
                return None

        for batch in batches:
            yield batch.append_column("response", pa.array(map(one, batch.column("prompt").to_pylist()), pa.string()))

    return prompted.mapInArrow(run, schema)


def stub_provider(text: str) -> str:
    """A provider without a network: one question about the source."""
    return '["What does this source say?"]'


def repaired(response: Column) -> Column:
    """The JSON array in a response: out of its fence, without text around."""
    bare = strip(response)
    fenced = F.get(F.split(bare, "```", -1), F.lit(1))
    opened = F.when(bare.startswith("```"), strip(F.when(fenced.startswith("json"), F.substring(fenced, 5, 2_000_000_000)).otherwise(fenced))).otherwise(bare)
    array = F.regexp_extract(opened, r"(?s)\[.*\]", 0)
    return F.when(array != "", array).otherwise(opened)


def strings_of(response: Column) -> Column:
    """The strings of the JSON array; other elements are left out, and what is no array has none."""
    parsed_ = F.try_parse_json(repaired(response))
    none = F.array().cast("array<string>")
    elements = F.try_variant_get(F.when(F.schema_of_variant(parsed_).startswith("ARRAY"), parsed_), "$", "array<variant>")
    texts = F.filter(elements, lambda v: F.schema_of_variant(v) == "STRING")
    return F.coalesce(F.transform(texts, lambda v: F.variant_get(v, "$", "string")), none)


def generated(answered: DataFrame) -> DataFrame:
    """Questions from responses, in their order."""
    return answered.select("*", F.posexplode(strings_of(F.col("response"))).alias("place", "question")).select(
        "question", "chunk_id", "chunk_path", F.col("original_url").alias("source_url"), "section_path",
        F.lit("auto-generated").alias("confidence"), F.lit(False).alias("reviewed"), F.lit("synthetic").alias("source_type"), "place",
    )


def together(extracted: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Extracted questions, then synthetic ones; ``seq`` keeps the order inside a chunk."""
    first = extracted.withColumn("seq", F.lit(0))
    return first.unionByName(synthetic.withColumn("seq", F.col("place") + 1).drop("place"))


def numbered(questions: DataFrame, model: str, date: str) -> DataFrame:
    """Add ``qa_file`` (numbered from 1 in each chunk), ``generation_model`` (the same for all rows) and ``generation_date``."""
    name = stem(F.substring_index("chunk_path", "/", -1))
    order = Window.partitionBy("chunk_stem").orderBy("seq", "chunk_path", "question")
    out = questions.withColumn("chunk_stem", name).withColumn("number", F.row_number().over(order))
    return out.withColumns({"qa_file": F.format_string("%s_%03d.md", "chunk_stem", "number"), "generation_model": F.lit(model), "generation_date": F.lit(date)})


def qa_documents(numbered_questions: DataFrame) -> DataFrame:
    """(qa_file, text): a document of sorted front matter and the question."""
    text = lambda name, value: (name, "text", value)
    fields = [
        text("chunk_file", F.col("chunk_path")), text("chunk_id", F.coalesce("chunk_id", F.lit("N/A"))), text("confidence", F.coalesce("confidence", F.lit("unknown"))), text("generation_date", F.col("generation_date")),
        text("generation_model", F.col("generation_model")), ("section_path", "list", F.when(F.size("section_path") > 0, F.col("section_path"))), text("source_type", F.coalesce("source_type", F.lit("unknown"))), text("source_url", F.coalesce("source_url", F.lit("N/A"))),
    ]
    return with_front_matter(numbered_questions, fields, "_head", skip_null=True).select("qa_file", F.concat("_head", F.lit("\n"), "question", F.lit("\n")).alias("text"))


def parse_qa(documents: DataFrame, file: str = "qa_file", text: str = "text") -> DataFrame:
    """One row for each QA document, in no order (see ``in_order``); without front matter chunk and type are ``unknown``."""
    block, body = split_block(F.col(text))

    split = documents.select(strip(body).alias("question"), F.when(has_block(F.col(text)), block).alias("block"), F.col(file).alias("qa_file"))
    read = with_parsed(split, F.col("block"), "fm")
    of = lambda key: F.when(F.col("fm").isNull(), F.lit("unknown" if key in ("chunk_file", "source_type") else "")).otherwise(F.coalesce(F.try_element_at("fm", F.lit(key)), F.lit(""))).alias(key)
    fields = [of(k) for k in ("chunk_file", "chunk_id", "source_url", "generation_model", "generation_date", "source_type", "confidence")]
    path = F.from_json(F.try_element_at("fm", F.lit("section_path")), "array<string>").alias("section_path")
    return read.select("question", *fields, path, "qa_file")


def in_order(qa: DataFrame) -> DataFrame:
    """By chunk file, then QA file."""
    return qa.orderBy("chunk_file", "qa_file")


def qa_summary(qa: DataFrame) -> DataFrame:
    """One row: questions, distinct chunks and URLs."""
    return qa.agg(F.count("*").alias("total"), F.count_distinct(F.nullif("chunk_file", F.lit(""))).alias("unique_chunks"), F.count_distinct(F.nullif("source_url", F.lit(""))).alias("unique_urls"))


def by_type(questions: DataFrame) -> DataFrame:
    """(source_type, n); a missing type is ``unknown``."""
    return questions.groupBy(F.coalesce("source_type", F.lit("unknown")).alias("source_type")).agg(F.count("*").alias("n"))
