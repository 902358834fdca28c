"""Row-wise operators on long texts, plain YAML, patterns and places: against plain versions, and in time."""

import fnmatch
import json
import random
import re
import time

import pytest
import yaml
from pyspark.sql import functions as F

from millrace.functions import tables
from millrace.functions import text as T
from millrace.operators import chunking, cleaning, frontmatter, merging, review
from millrace.operators.rules import Rule, apply_rules


@pytest.fixture(scope="module")
def apply(spark):
    def run(expression, values: list, kind: str = "string"):
        frame = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
        return [r.x for r in frame.select("n", expression(F.col("v")).alias("x")).orderBy("n").collect()]

    return run


def test_prefix_sums(apply):
    r = random.Random(3)
    lists = [[r.randint(0, 9) for _ in range(n)] for n in (0, 1, 63, 64, 65, 128, 5000)] + [None]
    wanted = [None if x is None else [sum(x[:k]) for k in range(len(x))] for x in lists]
    assert apply(T.prefix_sums, lists, "array<int>") == wanted


def test_many_sections_take_linear_time(apply):
    """4,000 sections in one text, one that never ends, and markers that are patterns elsewhere."""
    rule = Rule("section_boundary", start_marker="<<(B", end_marker="E)>>")
    text = "\n".join(f"keep {k}\n<<(B {k}\ngone\nE)>> {k}" for k in range(4000))
    apply(lambda c: apply_rules(c, [rule]), ["warm"])
    began = time.perf_counter()
    assert apply(lambda c: apply_rules(c, [rule]), [text]) == ["\n".join(f"keep {k}" for k in range(4000))]
    assert time.perf_counter() - began < 5
    open_ended = "a\n<<(B\n" + "x\n" * 200_000
    assert apply(lambda c: apply_rules(c, [rule]), [open_ended, "<<(B", "<<(B\nE)>>\nc", "a\n<<(B\nE)>>"]) == ["a", "", "c", "a"]
    within = Rule("section_boundary", start_marker="S", end_marker="a\nb", inclusive=False)
    assert apply(lambda c: apply_rules(c, [within]), ["x\nS\na\nb\n"]) == ["x\nS"]


def plain_headers(text: str, most: int = 3) -> list[tuple[int, int, str]]:
    return [(m.start(), len(m[1]), m[2].strip()) for m in re.finditer(rf"^(#{{1,{most}}}) (.+)$", text, re.M)]


def test_headers_and_sections(spark):
    """Positions, and the last header of each level, on random texts and on one of 20,000 headers."""
    r = random.Random(5)
    texts = ["\n".join(r.choice(["# A", "## B ", "### C", "#### D", "#no", "x # y", "", "# ", "word"]) + str(r.randint(0, 9)) for _ in range(r.randint(0, 30))) for _ in range(200)]
    texts.append("\n".join(f"{'#' * (k % 3 + 1)} h{k}\nbody" for k in range(20_000)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    headers = chunking.header_positions(docs)
    found: dict[int, list] = {}
    for x in headers.orderBy("doc_id", "start").collect():
        found.setdefault(x.doc_id, []).append((x.start, x.level, x.title))
    assert [found.get(k, []) for k in range(len(texts))] == list(map(plain_headers, texts))
    starts = [(k, n, at) for k, t in enumerate(texts) for n, at in enumerate(range(0, len(t), 17 if k < 200 else 100))]
    chunks = spark.createDataFrame(starts, "doc_id int, chunk_index int, start int")
    began = time.perf_counter()
    got = {(x.doc_id, x.chunk_index): (x.section_path, x.section_level) for x in chunking.sections(chunks, headers).collect()}
    assert time.perf_counter() - began < 20
    for k, n, at in starts:
        known = {}
        if k == 200 and n % 50:
            continue
        for start, level, title in found.get(k, []):
            if start > at:
                break
            known[level] = title
        assert got[k, n] == ([known[x] for x in sorted(known)], len(known))
    assert len(got) == len(starts)
    repeated = chunking.header_positions(docs.filter("doc_id = 200").unionByName(docs.filter("doc_id = 200")))
    assert repeated.count() == 40_000  # rows that repeat are positioned each by itself


def test_many_globs(apply):
    r = random.Random(7)
    letters = "ab/.*?[]!x^-"
    globs = ["".join(r.choice(letters) for _ in range(r.randint(0, 7))) for _ in range(300)] + ["*", "**", "", "a*", "*a", "*a*b"]
    names = ["".join(r.choice("ab/.x^-[") for _ in range(r.randint(0, 8))) for _ in range(300)]
    for some in [globs[k : k + 6] for k in range(0, len(globs), 6)]:
        # An unclosed bracket is itself; of other brackets Python's own reading counts.
        some = [g for g in some if "[" not in g]
        assert apply(lambda c: T.matches_any(c, some), names) == [any(fnmatch.fnmatchcase(n, g) for g in some) for n in names], some
    assert apply(lambda c: T.matches_any(c, []), ["a"]) == [False]
    urls = [f"https://site{k % 700}.org/path/{k}/index.html" for k in range(60_000)]
    many = [f"https://site{k}.org/path/*9/*" for k in range(500)] + [f"*/{k}/index.html" for k in range(500)]

    def took(patterns: list[str]) -> float:
        began = time.perf_counter()
        apply(lambda c: T.matches_any(c, patterns), urls)
        return time.perf_counter() - began

    took(many[495:505])
    assert took(many) < 5 * took(many[495:505]) + 1
    hit = [u for u, x in zip(urls, apply(lambda c: T.matches_any(c, many), urls)) if x]
    assert hit == [u for u in urls if re.match(r"https://site(\d+)\.org/path/(\d+)/", u) and ((int(re.match(r"https://site(\d+)", u)[1]) < 500 and re.search(r"9/index", u)) or int(u.split("/")[4]) < 500)]


def test_splitting_a_long_text_takes_linear_time():
    """Paragraphs so short that every step but the last goes on by one character, and headers all over."""
    text = ("# h\n\n" + "ab\n\n" * 5 + "c" * 1300 + "\n") * 800
    began = time.perf_counter()
    found = chunking.Splitter().split(text)
    assert time.perf_counter() - began < 15 and len(found) > 800
    part = text[: 4 * 1340]
    assert [x for x in chunking.Splitter().split(part) if x[0] < len(part) - 2600] == [x for x in found if x[0] < len(part) - 2600]


# --- plain YAML ---

VALUES = [
    "plain", "two words", "T: 7", "a:b", "https://x.org/a?b=1#c", "7", "007", "1.5", "1e5", "0x1F", "1_000", "12:30", "2025-01-01", "2025-1-1 10:00:00", "true", "Yes", "no", "null", "~", "=", "<<", "", " lead", "trail ", "it's", "'q'", '"dq"',
    "#no", "a #b", "a# b", "- x", "-x", "?x", ": x", "x:", "a\nb", "tab\there", "é à", "日本 語", "\U0001f600 x", "x" * 100, "word " * 30, "word " * 15, "{a}", "[b", "a, b", "%x", "@y", "`z", "!t", "&a", "*b", "|", ">", "---", "--- a", "...", "....a", ".5", ".x", "+1", "-1", "a\\b",
    "\xa0nb", "\x85", " x", "﻿x", "50%", "$5", "f(x)", "3 apples", "0", "0o7", "08", "NaN", ".nan", "x" * 74 + " yz", "x" * 79, "y", "n", "\x07bell", "a  b", "don't: stop", "'", "''", "a'b: c", "v #", "1:2:3", "１２", "ΑΒΓ", "été:",
]


def test_fields_are_written_as_the_library_writes_them(spark):
    r = random.Random(11)
    rows = [(v, None, [v], {"k": v}) for v in VALUES]
    rows += [(r.choice(VALUES), r.choice([None, 0, -5, 12]), r.choice([None, [], r.sample(VALUES, 3)]), r.choice([None, {}, {r.choice(["k", "key", "yes", "1", "a b", "true", "h1"]): r.choice(VALUES), "z": "v"}])) for _ in range(400)]
    schema = "i int, t string, n int, l array<string>, m map<string,string>"
    frame = spark.createDataFrame([(k, *x) for k, x in enumerate(rows)], schema)
    fields = [("title", "text", F.col("t")), ("count", "number", F.col("n")), ("path", "list", F.col("l")), ("heads", "map", F.col("m")), ("even", "number", F.col("i") % 2 == 0)]
    record = lambda k, x: {"title": x[0], "count": x[1], "path": x[2], "heads": x[3], "even": k % 2 == 0}
    dumped = lambda d: f"---\n{yaml.safe_dump(d, sort_keys=False, allow_unicode=True).strip()}\n---\n"
    got = frontmatter.with_front_matter(frame, fields, "b").collect()
    made = {x.i: x.b for x in got}
    rows = [(x.t, x.n, x.l, x.m) for x in sorted(got, key=lambda x: x.i)]  # Spark has its own order of a map's keys
    # The two dumpers of the library differ on what they escape beyond the first plane, and on odd line breaks.
    odd = lambda x: any(ord(c) > 0xFFFF or c in "\x85\u2028\ufeff" for v in (x[0] or "", *(x[2] or ()), *(x[3] or {}).values()) for c in v)
    for k, x in enumerate(rows):
        assert yaml.safe_load(made[k][4:-5]) == record(k, x)
        assert made[k] == dumped(record(k, x)) or odd(x), x
    short = {x.i: x.b for x in frontmatter.with_front_matter(frame, fields, "b", F.create_map(F.lit("own"), F.col("t")), skip_null=True).collect()}
    for k, x in enumerate(rows[: len(VALUES)]):
        if x[0].isascii():
            assert short[k] == dumped({"own": x[0]} | {a: b for a, b in record(k, x).items() if b is not None})
    # Most of what stands in front matter needs no library.
    plain = frame.select(frontmatter.scalar(F.col("t"), 70).alias("x")).filter("x is not null").count()
    assert plain > 0.6 * len(rows)


def test_plain_blocks_are_read_as_the_library_reads_them(spark, apply):
    r = random.Random(13)
    lines = ["a: 1", "b: x y", "c: 'q: z'", "d: T: 7", "e:", "- i", "- 'j'", "- 5", "  h1: T", "  h2: 'x'", "f: []", "g: {}", "h: null", "i: true", "j: Yes", "k: 2025-01-01", "l: 1.5", "m: \"d\"", "n: a #b", "o: [1, 2]", "p: |", "  text", "", "# note", "q: x:", "a: again", "yes: 1", "r: '", "s: it's", "t : x", "u:v", "w: -1", "x: 007", "y: é", "z: 123456789012345678901"]
    blocks = ["\n".join(r.sample(lines, r.randint(0, 5))) for _ in range(1500)] + ["\n".join(x) for x in ([], ["e:", "- i", "- k"], ["e:", "  h1: T", "  h2: U"], ["a: 1", "b: x"])]

    def strict(block: str):
        try:
            found = yaml.load(block, frontmatter.LOADER)
        except yaml.YAMLError:
            return "broken"
        return {} if found is None else found

    known = apply(frontmatter.plain_map, blocks)
    broken = apply(frontmatter.is_broken, blocks)
    text = lambda v: None if v is None else json.dumps(v, separators=(",", ":"), default=str, ensure_ascii=False) if isinstance(v, (list, dict, bool)) else str(v)
    for block, one, bad in zip(blocks, known, broken):
        wanted = strict(block)
        if one is not None:
            assert isinstance(wanted, dict) and one == {str(k): text(v) for k, v in wanted.items()}, block
        if bad:
            assert wanted == "broken" and one is None, block
    assert sum(x is not None for x in known) > 150 and sum(broken) > 10
    # What expressions can't read goes to the library: all in all nothing changes.
    frame = spark.createDataFrame(list(enumerate(blocks)), "n int, v string")
    whole = [r.fm for r in frontmatter.with_parsed(frame, F.col("v")).orderBy("n").collect()]
    by_library = apply(frontmatter.parsed, blocks)
    assert whole == by_library


def test_lenient_takes_the_last_of_many_keys(apply):
    block = "\n".join(f"k{n % 3000}: {n}" for n in range(6000)) + "\na: 1\nb: 2"
    began = time.perf_counter()
    (found,) = apply(frontmatter.lenient, [block])
    assert time.perf_counter() - began < 10
    assert found == {f"k{n}": str(n + 3000) for n in range(3000)} | {"a": "1", "b": "2"}


def test_url_filter_before_front_matter(spark):
    texts = ["---\noriginal_url: https://x/7\n---\nb", "---\noriginal_url: 'https://x/7'\n---\nb", '---\noriginal_url: "https:\\/\\/x\\/7"\n---\nb', "---\noriginal_url: https://x/8\n---\nhttps://x/7", "---\noriginal_url: https://x/8\n---\nb"]
    chunks = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "chunk_file string, text string")
    all_of = merging.with_url(merging.merge_chunks(chunks), "https://x/7")
    some = merging.with_url(merging.merge_chunks(merging.may_have_url(chunks, "https://x/7")), "https://x/7")
    assert sorted(r.chunk_file for r in some.collect()) == sorted(r.chunk_file for r in all_of.collect()) == ["0", "1", "2"]
    assert merging.may_have_url(chunks, "https://x/7").count() == 4


# --- places ---


def test_places(spark):
    """Skewed values, ties, groups and huge ids; ranges hold about equally many rows."""
    rows = [(10**12 + k if k % 5 else 10**17 + k, k % 3, "g" if k % 4 else "h") for k in range(20_000)]
    frame = spark.createDataFrame(rows, "a long, b int, g string").repartition(7)
    placed = tables.in_order(frame, ["a", "b"]).collect()
    assert [(r.a, r.b) for r in sorted(placed, key=lambda r: r.place)] == sorted((a, b) for a, b, _ in rows) and {r.place for r in placed} == set(range(len(rows)))
    grouped = tables.in_order(frame, ["g", F.col("b").desc()], "g", size="of").collect()
    for g in "gh":
        mine = sorted((r for r in grouped if r.g == g), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(len(mine))) and {r["of"] for r in mine} == {len(mine)} and [r.b for r in mine] == sorted((r.b for r in mine), reverse=True)
    assert tables.in_order(frame.limit(0), ["a"]).count() == 0


def test_question_ids_beyond_any_composite(spark):
    """Ids above 10^12 and nearly all rows in one narrow range."""
    rows = [(10**15 if k == 0 else 10**12 + k // 4, k % 4, "q") for k in range(3000)]
    made = review.question_ids(spark.createDataFrame(rows, "doc_id long, chunk_index int, question string"), ["doc_id", "chunk_index"]).collect()
    in_order = sorted(made, key=lambda r: (r.doc_id, r.chunk_index))
    assert [r.question_id for r in in_order] == [f"q_{k:04d}" for k in range(1, 3001)]
    asked = spark.createDataFrame([(10**13, 0, "q", False), (10**13, 1, "q", False)], "doc_id long, chunk_index int, question string, reviewed boolean")
    decisions = spark.createDataFrame([(10**13, 1, "a", None)], "doc_id long, chunk_index int, decision string, new_text string")
    assert {r.chunk_index: r.status for r in review.decided(asked, decisions, ["doc_id", "chunk_index"]).collect()} == {0: None, 1: "approved"}


# --- dispatch ---


def test_each_document_is_cleaned_by_its_own_rules(spark):
    docs = spark.createDataFrame([(1, "a.com", "x1 y"), (2, "b.com", "x1 y"), (3, "c.org", "x1 y"), (4, None, "x1 y"), (5, "b.com", "---\nt: 1\n---\nx1"), (6, "a.com", None)], "doc_id int, domain string, text string")
    sets = {"a.com": cleaning.RuleSet("a", (Rule("exact_match", pattern="x"),)), "b": cleaning.RuleSet("b", (Rule("regex", pattern="[0-9]"),)), "d": cleaning.RuleSet("d", (Rule("exact_match", pattern="x"),))}
    found = {r.doc_id: (r.rule_set, r.cleaned) for r in cleaning.clean_by_site(docs, sets).collect()}
    assert found == {1: ("a.com", "1 y\n"), 2: ("b", "x y\n"), 3: (None, "x1 y"), 4: (None, "x1 y"), 5: ("b", "---\nt: 1\n---\nx\n"), 6: ("a.com", None)}
