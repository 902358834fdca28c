"""Text functions with Python's notion of white space, as expressions of Catalyst."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python sees it, for patterns under (?U).
SPACE = r"[\s\x1c-\x1f]"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U){SPACE}+\z", "")


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"(?U)[^\s\x1c-\x1f]")


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def joined(parts: Column, by: str = "\n") -> Column:
    return F.array_join(parts, by)


def prefix_sums(numbers: Column, block: int = 64) -> Column:
    """For every element of an array of ints the sum of those before it.

    A fold that appends copies what it has at every step. So the array is cut
    into blocks, whose sums are summed up first: both folds stay short.
    """

    def summed(xs: Column, start: Column) -> Column:
        grow = lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.array_append(s["all"], s["sum"]).alias("all"))
        return F.aggregate(xs, F.struct(start.cast("int").alias("sum"), F.array().cast("array<int>").alias("all")), grow, lambda s: s["all"])

    def whole(xs: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(xs) - 1, F.lit(0)), F.lit(block)), lambda a: a < F.size(xs))
        blocks = F.transform(starts, lambda a: F.slice(xs, a + 1, F.lit(block)))
        sums = let(blocks, lambda b: F.flatten(F.zip_with(b, summed(F.transform(b, lambda x: F.aggregate(x, F.lit(0), lambda s, y: s + y)), F.lit(0)), summed)))
        return F.when(xs.isNotNull(), sums)

    return let(numbers, whole)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)[^\s\x1c-\x1f]+")).cast("long")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U){SPACE}+", " ")


def literal(text: str) -> str:
    """A pattern that matches ``text`` itself."""
    return "".join(c if c.isalnum() or ord(c) > 127 or c == "\n" else "\\" + c for c in text)


def pattern(regex: str, flags: str = "") -> str:
    """A pattern of Python's dialect for Java: only line feeds end lines, classes are those of Unicode; ``flags`` is a choice of m, s, i and x."""
    return f"(?dU{flags.replace('i', 'iu')}){regex}"


def glob_pattern(glob: str) -> str:
    """A shell glob (``*``, ``?``, ``[seq]``, ``[!seq]``) as an anchored pattern; ``*`` crosses slashes, and an unclosed bracket is itself."""
    out, at = "", 0
    while at < len(glob):
        c = glob[at]
        close = glob.find("]", at + (3 if glob[at + 1 : at + 2] == "!" else 2)) if c == "[" else -1
        if close > 0:
            inside = glob[at + 1 : close]
            negated = inside.startswith("!")
            inside = "".join("\\" + x if x in "\\[]^&" else x for x in inside[negated:])
            out += f"[{'^' * negated}{inside}]"
            at = close
        else:
            out += {"*": ".*", "?": "."}.get(c) or literal(c)
        at += 1
    return rf"(?s)\A{out}\z"


def glob_parts(glob: str) -> tuple[bool, str, str]:
    """Whether a glob begins with ``*``; the literal text that follows; a pattern for the rest, up to the end."""
    rest = glob.lstrip("*")
    plain = re.match(r"[^*?\[]*", rest)[0]
    return rest != glob, plain, glob_pattern(rest[len(plain) :])[len(r"(?s)\A") :]


def globs_pattern(globs: Sequence[str]) -> str:
    """One pattern for all globs, for ``rlike``.

    Globs that begin with literal text are tested once, at the start; those that
    begin with a star share one search. In both their literal beginnings are a
    trie, so a text is compared with the few globs that can match it and not
    with each in turn.
    """
    sides: dict[bool, dict[str, list[str]]] = {False: {}, True: {}}
    for glob in dict.fromkeys(globs):
        anywhere, plain, rest = glob_parts(glob)
        sides[anywhere].setdefault(plain, []).append(rest)
    out = []
    for anywhere, found in sides.items():
        if found:
            out.append((r"(?s:.*)" if anywhere else "") + trie({plain: "|".join(dict.fromkeys(rests)) for plain, rests in found.items()}))
    return rf"(?s)\A(?:{'|'.join(out)})"


def trie(ends: dict[str, str]) -> str:
    """A pattern for any key followed by the pattern that it maps to."""
    heads: dict[str, dict[str, str]] = {}
    for key, end in ends.items():
        if key:
            heads.setdefault(key[0], {})[key[1:]] = end
    parts = []
    for head, rest in heads.items():
        run = head
        while len(rest) == 1 and (key := next(iter(rest))):
            run, rest = run + key[0], {key[1:]: rest[key]}
        parts.append("".join(map(literal, run)) + trie(rest))
    return f"(?:{'|'.join([*parts, *([ends[''] ] if '' in ends else [])])})"


def matches_any(text: Column, globs: Sequence[str]) -> Column:
    """Whether any glob matches the whole text; without globs nothing matches, and a null text is null."""
    return text.rlike(globs_pattern(globs)) if globs else F.lit(False)


def slugify(text: Column, fallback: str = "chunk") -> Column:
    """Lower case, spaces and unsafe characters as single hyphens; ``fallback`` if nothing is left."""
    dashed = F.regexp_replace(F.replace(F.lower(strip(text)), F.lit(" "), F.lit("-")), r"[^a-zA-Z0-9._-]+", "-")
    trimmed = F.regexp_replace(F.regexp_replace(dashed, "-{2,}", "-"), r"\A-+|-+\z", "")
    return F.when(trimmed == "", F.lit(fallback)).otherwise(trimmed)


def breadcrumb(headers: Column, keys: tuple[str, ...] = ("h1", "h2", "h3", "h4", "h5", "h6")) -> Column:
    """The non-empty headers of a map, from the top level down."""
    return F.filter(F.array(*(F.try_element_at(headers, F.lit(k)) for k in keys)), lambda x: x.isNotNull() & (x != ""))


def stem(name: Column) -> Column:
    """A file name without its last suffix."""
    return F.regexp_replace(name, r"(?<=[^/])\.[^./]*\z", "")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
