"""Front matter: splitting, strict and lenient parsing, building and merging.

Nearly all front matter is a few plain fields, lists and one level of nesting.
These are written by expressions and read line by line in an Arrow function; a
row that needs more of YAML goes through a YAML library, and only that row.
"""

from __future__ import annotations

import datetime
import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions.text import joined, let, lines, strip

# Parser and emitter of libyaml where they are there.
LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
DUMPER = getattr(yaml, "CSafeDumper", yaml.SafeDumper)

# What YAML 1.1 takes for something else than text when it is not quoted.
OTHER_TYPES = "|".join([
    "yes|Yes|YES|no|No|NO|true|True|TRUE|false|False|FALSE|on|On|ON|off|Off|OFF",
    "~|null|Null|NULL|<<|=",
    "[-+]?0b[0-1_]+|[-+]?0[0-7_]+|[-+]?(?:0|[1-9][0-9_]*)|[-+]?0x[0-9a-fA-F_]+|[-+]?[1-9][0-9_]*(?::[0-5]?[0-9])+",
    r"[-+]?[0-9][0-9_]*\.[0-9_]*(?:[eE][-+][0-9]+)?|\.[0-9][0-9_]*(?:[eE][-+][0-9]+)?|[-+]?[0-9][0-9_]*(?::[0-5]?[0-9])+\.[0-9_]*|[-+]?\.(?:inf|Inf|INF)|\.(?:nan|NaN|NAN)",
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[Tt]|[ \t]+)[0-9]{1,2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]*)?(?:[ \t]*(?:Z|[-+][0-9]{1,2}(?::[0-9]{2})?))?",
])
#: Characters that stand in a scalar as they are, and those that may begin a plain one.
PRINTED = r"\x20-\x7E\xA1-\u058F\u05D0-\u1FFF\u3001-\uD7FF"
BEGINS = r"A-Za-z0-9_/.(\xC0-\u024F\u0391-\u03FF\u0410-\u044F\u3041-\u9FA5\uAC00-\uD7A3"
#: Columns of a line; longer text with spaces is folded, which is left to the library.
WIDTH = 80
KEY = r"[A-Za-z_][A-Za-z0-9_]*"
#: Stands for YAML's null among texts, none of which holds it.
NULL = "\0"

# The same for reading in Python.
ENTRY, NESTED = re.compile(rf"({KEY}):(?: (.+))?"), re.compile(rf"  ({KEY}): (.+)")
TEXT = re.compile(rf"(?!\.\.\.|(?:{OTHER_TYPES})\Z)(?!.*(?::(?: |\Z)| #| \Z))[{BEGINS}][{PRINTED}]*")
QUOTED, WHOLE = re.compile(rf"'((?:''|(?!')[{PRINTED}])*)'"), re.compile(r"0|[1-9][0-9]{0,17}")
FIXED = {"true": True, "false": False, "null": None}

BLOCK = r"(?s)\A---\n(.*?)\n---\n(.*)\z"


def has_block(text: Column) -> Column:
    return text.rlike(BLOCK)


def split_block(text: Column) -> tuple[Column, Column]:
    """The YAML between the first two ``---`` lines, and the body; without a block an empty string and the text."""
    return F.regexp_extract(text, BLOCK, 1), F.when(has_block(text), F.regexp_extract(text, BLOCK, 2)).otherwise(text)


def split_loosely(text: Column) -> tuple[Column, Column]:
    """Whatever stands between the first two ``---``, wherever they stand, and the stripped rest."""
    parts = F.split(text, "---", 3)
    whole = text.startswith("---") & (F.size(parts) == 3)
    return F.when(whole, parts[1]).otherwise(F.lit("")), F.when(whole, strip(parts[2])).otherwise(text)


def lenient(block: Column) -> Column:
    """``key: value`` lines as a map of strings, one pair of quotes removed, the last of equal keys; comments and empty values are left out.

    Booleans are lower-cased and runs of digits lose leading zeros, as they
    would by way of their types.
    """
    row = F.transform(lines(block), strip)
    told = F.filter(row, lambda x: x.contains(":") & ~x.startswith("#"))
    pair = F.transform(told, lambda x, i: F.struct(strip(F.substring_index(x, ":", 1)).alias("k"), i.alias("i"), strip(F.regexp_replace(x, r"(?s)\A[^:]*:", "")).alias("v")))
    full = F.array_sort(F.filter(pair, lambda p: (p["k"] != "") & (p["v"] != "")))
    typed = lambda v: (
        F.when(F.lower(v).isin("true", "false"), F.lower(v))
        .when(v.rlike(r"\A[0-9]+\z"), F.regexp_replace(v, r"\A0+(?=[0-9])", ""))
        .otherwise(F.regexp_replace(v, r"(?s)\A(?:'(.*)'|\"(.*)\")\z", "$1$2"))
    )
    # Sorted by key and place, the last of equal keys is the one before another key.
    last = let(full, lambda f: F.filter(f, lambda p, i: ~F.coalesce(F.get(f, i + 1)["k"] == p["k"], F.lit(False))))
    in_place = F.array_sort(F.transform(last, lambda p: F.struct(p["i"].alias("i"), p["k"].alias("k"), p["v"].alias("v"))))
    return F.map_from_entries(F.transform(in_place, lambda p: F.struct(p["k"].alias("key"), typed(p["v"]).alias("value"))))


def is_text(value: Column) -> Column:
    """Whether a value is read as text when it stands unquoted after a key or a dash."""
    return value.rlike(rf"\A[{BEGINS}][{PRINTED}]*+\z") & ~value.rlike(rf"\A(?:\.\.\.|(?:{OTHER_TYPES})\z)|:(?: |\z)| #| \z")


def read_scalar(value: Column) -> Column:
    """A scalar as its text, ``NULL`` for YAML's null; null what only a YAML parser can read."""
    quoted = value.rlike(rf"\A'[{PRINTED}]*+'\z") & (F.length(value) > 1)
    inside = F.regexp_replace(value, r"\A'|'\z", "")
    whole = quoted & ~F.replace(inside, F.lit("''"), F.lit("")).contains("'")
    return (
        F.when(is_text(value) | value.rlike(r"\A(?:0|[1-9][0-9]{0,17}|true|false)\z"), value)
        .when(value == "null", F.lit(NULL))
        .when(whole, F.replace(inside, F.lit("''"), F.lit("'")))
    )


def read_text(value: Column) -> Column:
    """As ``read_scalar``, but of texts alone: numbers and the like keep their types in lists and nested maps."""
    return F.when(is_text(value) | value.startswith("'"), read_scalar(value))


def all_known(values: Column) -> Column:
    return ~F.exists(values, lambda x: x.isNull())


def read_entry(entry: Column) -> Column:
    """[key, value] of ``key: scalar``, ``key:`` with a list of texts or with one level of ``key: text``, below it; null for anything else."""

    def listed(below: Column) -> Column:
        return let(F.transform(below, lambda x: read_text(F.substring(x, 3, 2_000_000_000))), lambda t: F.when(all_known(t), F.to_json(t)))

    def nested(below: Column) -> Column:
        names = F.transform(below, lambda x: F.regexp_extract(x, rf"\A  ({KEY}): ", 1))
        texts = F.transform(below, lambda x: read_text(F.regexp_replace(x, rf"\A  {KEY}: ", "")))
        apart = lambda n: F.forall(n, is_text) & (F.size(F.array_distinct(n)) == F.size(n))
        return let(names, lambda n: F.when(apart(n), let(texts, lambda t: F.when(all_known(t), F.to_json(F.map_from_arrays(n, t))))))

    def several(below: Column) -> Column:
        return F.when(F.forall(below, lambda x: x.startswith("- ")), listed(below)).when(F.forall(below, lambda x: x.rlike(rf"\A  {KEY}: ")), nested(below))

    # What is used more than once is made once: nothing else does so inside a lambda.
    def value(rows: Column, head: Column, body: Column) -> Column:
        alone = F.when(body == "", F.lit(NULL)).when(body.isin("[]", "{}"), body).otherwise(read_scalar(body))
        known = F.when(F.size(rows) == 1, alone).when(body == "", let(F.slice(rows, 2, F.size(rows) - 1), several))
        return let(F.when((head != "") & is_text(head), known), lambda v: F.when(v.isNotNull(), F.array(head, v)))

    def first(rows: Column) -> Column:
        line = F.get(rows, F.lit(0))
        head = F.regexp_extract(line, rf"\A({KEY}):(?: |\z)", 1)
        return let(head, lambda h: let(F.substring(line, F.length(h) + 3, F.lit(2_000_000_000)), lambda b: value(rows, h, b)))

    return let(F.split(entry, "\n", -1), first)


def plain_map(block: Column) -> Column:
    """The block as a map of strings, as ``parsed`` gives it, where it is plain enough to be read by expressions; else null."""
    entries = F.transform(F.split(block, r"\n(?=[A-Za-z_])", -1), read_entry)
    names = lambda e: F.transform(e, lambda x: F.get(x, F.lit(0)))
    values = lambda e: F.transform(e, lambda x: F.nullif(F.get(x, F.lit(1)), F.lit(NULL)))
    whole = let(entries, lambda e: F.when(all_known(e) & (F.size(F.array_distinct(names(e))) == F.size(e)), F.map_from_arrays(names(e), values(e))))
    return F.when(block == "", F.create_map().cast("map<string,string>")).otherwise(whole)


def is_broken(block: Column) -> Column:
    """Whether a block of single lines can't be YAML: every line is ``key: value`` and complete, and a plain value holds another ``: ``."""
    bad = lambda x: x.rlike(rf"\A{KEY}: [{BEGINS}][{PRINTED}]*: ") & ~x.contains(" #")
    good = lambda x: x.rlike(rf"\A{KEY}: ") & read_scalar(F.regexp_replace(x, rf"\A{KEY}: ", "")).isNotNull()
    return let(lines(block), lambda rows: F.exists(rows, bad) & F.forall(rows, lambda x: bad(x) | good(x)))


def as_json(value: object) -> object:
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def text_of(value: str) -> str:
    """A text in one line; a ``LookupError`` where only a YAML parser can read it."""
    if TEXT.fullmatch(value):
        return value
    if quoted := QUOTED.fullmatch(value):
        return quoted[1].replace("''", "'")
    raise LookupError


def value_of(value: str) -> object:
    """As ``text_of``, but of whole numbers, booleans, null and empty collections too."""
    if value in FIXED:
        return FIXED[value]
    if WHOLE.fullmatch(value):
        return int(value)
    return [] if value == "[]" else {} if value == "{}" else text_of(value)


def plain_record(block: str) -> dict | None:
    """What YAML reads in a block of plain fields, lists of texts and one level of ``key: text``; None where it may hold more."""
    out: dict = {}
    rows, at = block.split("\n"), 0
    try:
        while at < len(rows):
            entry = ENTRY.fullmatch(rows[at])
            if not entry or entry[1] in out or not TEXT.fullmatch(entry[1]):
                return None
            at, below = at + 1, at + 1
            while at < len(rows) and rows[at].startswith(("- ", "  ")):
                at += 1
            if below == at:
                out[entry[1]] = None if entry[2] is None else value_of(entry[2])
            elif entry[2] is not None:
                return None
            elif rows[below].startswith("- "):
                if not all(x.startswith("- ") for x in rows[below:at]):
                    return None
                out[entry[1]] = [text_of(x[2:]) for x in rows[below:at]]
            else:
                pairs = [NESTED.fullmatch(x) for x in rows[below:at]]
                if not all(p and TEXT.fullmatch(p[1]) for p in pairs):
                    return None
                out[entry[1]] = {p[1]: text_of(p[2]) for p in pairs}
                if len(out[entry[1]]) < len(pairs):
                    return None
    except LookupError:
        return None
    return out


@F.arrow_udf(StringType())
def yaml_json(blocks: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A YAML block as JSON (dates in ISO form); null if it isn't valid YAML, ``{}`` if it is empty."""

    def one(block: str | None) -> str | None:
        if block is None:
            return None
        found = plain_record(block)
        if found is None:
            try:
                found = yaml.load(block, LOADER)
            except yaml.YAMLError:
                return None
        return json.dumps({} if found is None else found, default=as_json, ensure_ascii=False)

    for part in blocks:
        yield pa.array(map(one, part.to_pylist()), pa.string())


@F.arrow_udf(StringType())
def yaml_block(records: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A front matter block with its ``---`` lines from a JSON object, keys in their order; empty for an empty object or null."""

    def one(record: str | None) -> str:
        found = json.loads(record) if record else None
        return f"---\n{yaml.dump(found, Dumper=DUMPER, sort_keys=False, allow_unicode=True, default_flow_style=False).strip()}\n---\n" if found else ""

    for part in records:
        yield pa.array(map(one, part.to_pylist()), pa.string())


def scalar(value: Column, room: Column | int) -> Column:
    """A text as YAML writes it: plain, or in single quotes; null where it takes more than that, or more than ``room`` columns."""
    fits = (F.length(value) <= room) | ~value.contains(" ")
    quotes = value.rlike(rf"\A[{PRINTED}]*+\z") & (value.rlike(rf"\A(?:[#,\[\]{{}}&*!|>'\"%@` ]|\.\.\.|(?:{OTHER_TYPES})?\z)") | (value.rlike(rf"\A[{BEGINS}]") & value.rlike(r":(?: |\z)| #| \z")))
    in_quotes = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(value.isNull(), F.lit("null")).when(fits & is_text(value), value).when(quotes & ((F.length(in_quotes) <= room) | ~value.contains(" ")), in_quotes)


def all_of(parts: Column, by: str) -> Column:
    """The parts as one text; null if one of them is."""
    return let(parts, lambda p: F.when(~F.exists(p, lambda x: x.isNull()), joined(p, by)))


def written_field(name: str, kind: str, value: Column) -> Column:
    """The lines of one field; null where a YAML library is needed."""
    empty = {"list": "[]", "map": "{}"}
    if kind == "number":
        return F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit("null")))
    if kind == "text":
        return F.concat(F.lit(f"{name}: "), scalar(value, WIDTH - len(name) - 2))
    if kind == "list":
        inside = all_of(F.transform(value, lambda x: F.concat(F.lit("- "), scalar(x, WIDTH - 2))), "\n")
    elif kind == "map":
        inside = written_pairs(value, "  ")
    else:
        raise ValueError(f"unknown kind of field {kind!r}")
    return F.when(value.isNull(), F.lit(f"{name}: null")).when(F.size(value) == 0, F.lit(f"{name}: {empty[kind]}")).otherwise(F.concat(F.lit(f"{name}:\n"), inside))


def written_pairs(pairs: Column, indent: str) -> Column:
    """The entries of a map of strings, a line each; null where a key or value takes more."""
    one = lambda e: F.when(e["key"].rlike(rf"\A{KEY}\z") & is_text(e["key"]) & (F.length(e["key"]) < 60), F.concat(F.lit(indent), e["key"], F.lit(": "), scalar(e["value"], WIDTH - len(indent) - 2 - F.length(e["key"]))))
    return all_of(F.transform(F.map_entries(pairs), one), "\n")


def with_front_matter(df: DataFrame, fields: Sequence[tuple[str, str, Column]], name: str = "head", first: Column | None = None, skip_null: bool = False) -> DataFrame:
    """Add ``name``: a front matter block with its ``---`` lines of (key, kind, value) fields; kinds are text, number, list (of texts) and map (of texts).

    Null values are YAML's null, or with ``skip_null`` left out; a block without
    fields is empty. ``first`` is a map of texts whose entries stand before the
    fields; none of its keys may be a field. Blocks are the same as those of
    ``yaml_block``, which writes what expressions can't: line breaks, control
    characters, folded lines and the like.
    """
    parts = [F.when(value.isNull(), F.lit("")).otherwise(written_field(key, kind, value)) if skip_null else written_field(key, kind, value) for key, kind, value in fields]
    record = F.to_json(F.struct(*(value.alias(key) for key, _, value in fields)), {"ignoreNullFields": str(skip_null).lower()})
    if first is not None:
        has = F.size(first) > 0
        parts = [F.when(has, written_pairs(first, "")).otherwise(F.lit("")), *parts]
        record = F.when(has, F.concat(F.rtrim(F.to_json(first), F.lit("}")), F.lit(","), F.substring(record, 2, 2_000_000_000))).otherwise(record)
    plain = all_of(F.filter(F.array(*parts), lambda x: x.isNull() | (x != "")), "\n")
    told = df.withColumn("_plain", in_a_step(plain)).withColumn("_record", in_a_step(F.when(F.col("_plain").isNull(), record)))
    block = F.when(F.col("_plain") == "", F.lit("")).otherwise(F.concat(F.lit("---\n"), F.col("_plain"), F.lit("\n---\n")))
    return told.withColumn(name, F.coalesce(block, yaml_block("_record"))).drop("_plain", "_record")


def parsed(block: Column) -> Column:
    """The block as a map of strings: strict YAML where it is a mapping, else leniently. Nested values are JSON."""
    return F.coalesce(F.from_json(yaml_json(block), "map<string,string>"), lenient(block))


def with_parsed(df: DataFrame, block: Column, name: str = "fm") -> DataFrame:
    """Add ``name``: what ``parsed`` gives, made once."""
    step = df.withColumn("_block", in_a_step(block))
    return step.withColumn(name, in_a_step(parsed(F.col("_block")))).drop("_block")


def in_a_step(value: Column) -> Column:
    """The value, made in a step of its own: Spark neither copies it into later expressions nor takes a filter on it past the step.

    The condition is true of every row, but not known to be.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def merged(original: Column, updates: Column) -> Column:
    """Both maps; of a key in both the value of ``updates``."""
    kept = F.map_filter(original, lambda k, _: ~F.array_contains(F.map_keys(updates), k))
    return F.map_concat(kept, updates)
