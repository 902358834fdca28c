"""Cleaning of documents: rules, white space, reports, warnings, preview, delete lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import SPACE, let, lines, matches_any, strip
from millrace.functions.urls import domain_of
from millrace.operators.frontmatter import has_block, split_block
from millrace.operators.rules import TYPES, Rule, apply_rules


@dataclass(frozen=True)
class RuleSet:
    """The rules of a site, and the names or globs of files to delete."""

    site: str
    rules: tuple[Rule, ...] = ()
    delete_files: tuple[str, ...] = field(default=())

    @classmethod
    def of(cls, given: dict) -> RuleSet:
        return cls(given.get("site") or "", tuple(map(Rule.of, given.get("rules") or ())), tuple(given.get("delete_files") or ()))

    def problems(self) -> list[str]:
        """What is wrong with the set: no site, no rules, an unknown type, a rule without a description."""
        out = [] if self.site else ["no site"]
        out += [] if self.rules else ["no rules"]
        for n, rule in enumerate(self.rules, 1):
            out += [] if rule.type in TYPES else [f"rule {n} has the unknown type {rule.type!r}"]
            out += [] if rule.description else [f"rule {n} has no description"]
        return out


def collapse_blank_lines(text: Column) -> Column:
    """Of consecutive lines of white space keep the first, as it is."""
    blank = lambda x: ~x.rlike(r"(?U)[^\s\x1c-\x1f]")
    return let(lines(text), lambda all_lines: F.array_join(F.filter(all_lines, lambda x, i: ~(blank(x) & (i > 0) & blank(F.get(all_lines, i - 1)))), "\n"))


def normalize_whitespace(text: Column) -> Column:
    """No white space at line ends, two blank lines in a row at most, one line feed at the end; a text of one blank line becomes empty."""
    out = F.regexp_replace(text, rf"(?U)[{SPACE[1:-1]}&&[^\n]]+(?=\n|\z)", "")
    out = F.regexp_replace(F.regexp_replace(out, r"\n{4,}", "\n\n\n"), r"\A\n{3,}", "\n\n")
    return let(out, lambda t: F.when(t == "", F.lit("")).otherwise(F.concat(F.regexp_replace(t, rf"(?U){SPACE}+\z", ""), F.lit("\n"))))


def clean_text(text: Column, rules: Sequence[Rule]) -> Column:
    return normalize_whitespace(apply_rules(text, rules))


def warnings_of(cleaned: Column, original: Column) -> Column:
    """What looks wrong after cleaning: too much removed, headers or front matter gone, very short."""
    share = F.when(F.length(original) > 0, (F.length(original) - F.length(cleaned)) / F.length(original) * 100).otherwise(F.lit(0.0))
    found = F.array(
        F.when(share > 75, F.format_string("Warning: %.1f%% of content removed (>75%%)", share)),
        F.when(original.contains("# ") & ~cleaned.contains("# "), F.lit("Warning: All H1 headers were removed")),
        F.when(original.startswith("---\n") & ~cleaned.startswith("---\n"), F.lit("Warning: YAML frontmatter may have been removed")),
        F.when(F.length(strip(cleaned)) < 100, F.format_string("Warning: Cleaned content is very short (%d chars)", F.length(cleaned))),
    )
    return F.array_compact(found)


def clean(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """Add ``cleaned``: the text with its body cleaned; front matter stays as it is."""
    block, body = split_block(F.col(text))
    whole = F.when(has_block(F.col(text)), F.concat(F.lit("---\n"), block, F.lit("\n---\n"), clean_text(body, rules))).otherwise(clean_text(F.col(text), rules))
    return docs.withColumn("cleaned", whole)


def report(cleaned: DataFrame, text: str = "text") -> DataFrame:
    """Add sizes in code points with front matter, what was removed, and the warnings."""

    def facts(p: Column) -> Column:
        old, new = p["old"], p["new"]
        before, after = F.length(old).cast("long"), F.length(new).cast("long")
        return F.struct(
            before.alias("original_chars"), after.alias("cleaned_chars"), (before - after).alias("removed_chars"),
            F.when(before > 0, (before - after) / before * 100).otherwise(F.lit(0.0)).alias("reduction_percent"),
            (new != old).alias("content_changed"), warnings_of(new, old).alias("warnings"),
        )

    # Both texts are expressions of their own; they are made once for all facts.
    told = cleaned.withColumn("_facts", let(F.struct(F.col(text).alias("old"), F.col("cleaned").alias("new")), facts))
    return told.select(*cleaned.columns, "_facts.*")


def summary(reported: DataFrame) -> DataFrame:
    """One row over a report."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return reported.agg(
        F.count("*").alias("files_processed"), F.count_if("content_changed").alias("files_cleaned"), n("removed_chars").alias("removed_chars"),
        F.coalesce(F.try_divide(F.sum("removed_chars") * 100.0, F.sum("original_chars").cast("double")), F.lit(0.0)).alias("reduction_percent"),
        F.count_if(F.size("warnings") > 0).alias("files_with_warnings"),
    )


def without_deleted(docs: DataFrame, names: Sequence[str], file: str = "file") -> DataFrame:
    """Drop files that the delete list names exactly; globs are for ``without_globbed``."""
    exact = [n for n in names if not set("*?") & set(n)]
    return docs.filter(~F.col(file).isin(exact)) if exact else docs


def without_globbed(docs: DataFrame, names: Sequence[str], file: str = "file") -> DataFrame:
    """Drop files that any name or glob of the delete list matches, after all reports."""
    return docs.filter(~matches_any(F.col(file), list(names))) if names else docs


def preview(docs: DataFrame, rules: Sequence[Rule], key: str = "doc_id", text: str = "text", most: int = 5, context: int = 3, width: int = 100) -> DataFrame:
    """(key, line, place, shown): the first ``most`` lines that differ, index by index, with their context.

    Unlike ``clean`` it cleans the whole text, front matter included.
    """
    both = docs.select(key, lines(F.col(text)).alias("old"), lines(clean_text(F.col(text), rules)).alias("new"))
    shared = F.least(F.size("old"), F.size("new"))
    differing = F.filter(F.sequence(F.lit(0), shared - 1), lambda i: F.get(F.col("old"), i) != F.get(F.col("new"), i))
    first = both.select(key, "old", F.explode(F.slice(differing, 1, most)).alias("line"))
    around = F.sequence(F.greatest(F.lit(0), F.col("line") - context), F.least(F.size("old") - 1, F.col("line") + context))
    shown = first.select(key, "old", "line", F.explode(around).alias("place"))
    mark = F.when(F.col("place") == F.col("line"), F.lit("- ")).otherwise(F.lit("  "))
    return shown.select(key, "line", "place", F.concat(mark, F.left(F.get("old", F.col("place")), F.lit(width))).alias("shown"))


def detected_domain(text: Column) -> Column:
    """The domain of ``original_url`` in the front matter; empty without one."""
    head = F.regexp_extract(text, r"(?s)\A---\n(.*?)---\n", 1)
    url = strip(F.regexp_extract(head, r"(?dm)^original_url:\s*(.+)$", 1))
    return domain_of(F.regexp_replace(url, r"\A(['\"])(.*)\1\z", "$2"))


def rule_set_of(spark: SparkSession, docs: DataFrame, sites: Sequence[str], domain: str = "domain") -> DataFrame:
    """Add ``rule_set``: the site that is named like the domain, else like the domain without its last label; null without one.

    The list of sites is a list of configuration files, so it is small enough to broadcast.
    """
    named = spark.createDataFrame([(s,) for s in sites], "site string")
    short = F.regexp_replace(F.col(domain), r"\.[^.]*\z", "")
    asked = docs.join(F.broadcast(named.select(F.col("site").alias("_exact"))), F.col(domain) == F.col("_exact"), "left")
    asked = asked.join(F.broadcast(named.select(F.col("site").alias("_short"))), short == F.col("_short"), "left")
    return asked.withColumn("rule_set", F.coalesce("_exact", "_short")).drop("_exact", "_short")


def clean_by_site(docs: DataFrame, sets: Mapping[str, RuleSet], domain: str = "domain", text: str = "text") -> DataFrame:
    """Add ``rule_set``, as ``rule_set_of`` finds it among the sites of ``sets``, and ``cleaned``: the text after the rules of its own set; without one the text as it is.

    The sets are branches of one expression, of which a row runs only its own,
    so the pass over the documents is one however many sites there are. Sets with
    equal rules share a branch.
    """
    spark = docs.sparkSession
    found = rule_set_of(spark, docs, list(sets), domain)
    block, body = split_block(F.col(text))
    fenced = has_block(F.col(text))
    head, whole = F.when(fenced, F.concat(F.lit("---\n"), block, F.lit("\n---\n"))).otherwise(F.lit("")), F.when(fenced, body).otherwise(F.col(text))
    sites: dict[tuple[Rule, ...], list[str]] = {}
    for site, one in sets.items():
        sites.setdefault(one.rules, []).append(site)

    def ruled(p: Column) -> Column:
        out = F.when(F.col("rule_set").isNull(), p["body"])
        for rules, names in sites.items():
            out = out.when(F.col("rule_set").isin(names), clean_text(p["body"], rules))
        return F.concat(p["head"], out)

    return found.withColumn("cleaned", let(F.struct(head.alias("head"), whole.alias("body")), ruled))


def last_written(docs: DataFrame, file: str = "file", order: str = "crawl_seq") -> DataFrame:
    """Of the rows with one file name the last written stays."""
    return docs.withColumn("_rank", F.row_number().over(Window.partitionBy(file).orderBy(F.col(order).desc()))).filter("_rank = 1").drop("_rank")
