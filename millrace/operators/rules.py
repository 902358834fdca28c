"""Cleaning rules, compiled into one column expression.

Rules run in their order, each on the result of the one before. Every kind of
rule is an expression of Catalyst; neither a shuffle nor Python is involved.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import joined, let, lines, literal, pattern

LETTERS = {"IGNORECASE": "i", "MULTILINE": "m", "DOTALL": "s", "VERBOSE": "x"}


@dataclass(frozen=True)
class Rule:
    """One rule of a rule set; which fields count depends on ``type``. ``max_remove`` None is the type's default: one for ``exact_match``, all for ``regex``."""

    type: str
    description: str = ""
    pattern: str | None = None
    flags: tuple[str, ...] = ()
    max_remove: int | None = None
    start_marker: str | None = None
    end_marker: str | None = None
    inclusive: bool = True
    keep_first: bool = False
    keep_last: bool = False

    @classmethod
    def of(cls, given: dict) -> Rule:
        known = {f.name for f in fields(cls)}
        return cls(**{k: tuple(v or ()) if k == "flags" else v for k, v in given.items() if k in known})

    def letters(self, allowed: str = "imsx") -> str:
        """The flags for a pattern; unknown ones don't count."""
        return "".join(c for f in self.flags if (c := LETTERS.get(str(f).upper(), "")) and c in allowed)


def exact_match(rule: Rule, text: Column) -> Column:
    """Remove a literal: everywhere at once (-1), or k times the leftmost of what is then left."""
    times = 1 if rule.max_remove is None else rule.max_remove
    if not rule.pattern or times == 0:
        return text
    if times < 0:
        return F.replace(text, F.lit(rule.pattern), F.lit(""))

    def once(t: Column) -> Column:
        at = F.instr(t, rule.pattern)
        return F.when(at > 0, F.concat(t.substr(F.lit(1), at - 1), t.substr(at + len(rule.pattern), F.length(t)))).otherwise(t)

    if times == 1:
        return let(text, once)
    return F.aggregate(F.sequence(F.lit(1), F.lit(times)), text, lambda t, _: once(t))


def regex(rule: Rule, text: Column) -> Column:
    """Remove all matches (0), the first k, or nothing (below 0); matches are those of the text as it was."""
    times = rule.max_remove or 0
    if not rule.pattern or times < 0:
        return text
    found = pattern(rule.pattern, rule.letters())
    return F.regexp_replace(text, found, "") if times == 0 else joined(F.split(text, found, times + 1), "")


def section_boundary(rule: Rule, text: Column) -> Column:
    """Remove from a line that holds the start marker to the next that holds the end marker, or to the end.

    With ``inclusive`` the marker lines go too. A missing marker makes the rule
    do nothing. A section is a regular language: one pattern finds them from
    left to right, in one pass over the text, however many there are.
    """
    if not rule.start_marker or not rule.end_marker or "\n" in rule.start_marker:
        return text
    start, end = literal(rule.start_marker), literal(rule.end_marker)
    first = rf"(?:\A|\n)[^\n]*?{start}[^\n]*+"
    # A marker with a line feed stands in no line, so nothing closes the section.
    last = rf"\n[^\n]*?{end}[^\n]*+" if "\n" not in rule.end_marker else r"(?!)"
    found = rf"({first})(?:(?s:.*?)({last})|(?s:.*)\z)"
    if not rule.inclusive:
        return F.regexp_replace(text, found, "$1$2")
    # Each section goes with the line feed before it; one that begins the text leaves the line feed after it.
    begins = text.rlike(rf"\A[^\n]*{start}")
    out = F.regexp_replace(text, found, "")
    return F.when(begins, F.regexp_replace(out, r"\A\n", "")).otherwise(out)


def line_pattern(rule: Rule, text: Column) -> Column:
    """Drop lines in which the pattern is found; of the flags only IGNORECASE and MULTILINE count."""
    if not rule.pattern:
        return text
    found = pattern(rule.pattern, rule.letters("im"))
    return joined(F.filter(lines(text), lambda x: ~x.rlike(found)))


def repeating_pattern(rule: Rule, text: Column) -> Column:
    """Of a literal that occurs twice or more keep the first, the last or none."""
    if not rule.pattern:
        return text

    def kept(q: Column) -> Column:
        n = F.size(q)
        if rule.keep_first:
            some = F.concat(q[0], F.lit(rule.pattern), joined(F.slice(q, F.lit(2), n), ""))
        elif rule.keep_last:
            some = F.concat(joined(F.slice(q, F.lit(1), n - 1), ""), F.lit(rule.pattern), F.element_at(q, -1))
        else:
            some = joined(q, "")
        return F.when(n > 2, some).otherwise(joined(q, rule.pattern))

    return let(F.split(text, literal(rule.pattern), -1), kept)


#: Rule type to its compiler; more may be added.
TYPES: dict[str, Callable[[Rule, Column], Column]] = {
    "exact_match": exact_match, "regex": regex, "section_boundary": section_boundary, "line_pattern": line_pattern, "repeating_pattern": repeating_pattern,
}


def apply_rules(text: Column, rules: Sequence[Rule]) -> Column:
    """``text`` after all rules; a rule of an unknown type is skipped with a warning."""
    for rule in rules:
        if rule.type not in TYPES:
            warnings.warn(f"unknown rule type {rule.type!r} is skipped", stacklevel=2)
            continue
        text = TYPES[rule.type](rule, text)
    return text
