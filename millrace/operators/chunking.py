"""Header-aware chunking.

A splitter walks through one text and looks back for the best break, which no
built-in function expresses, so it is an Arrow function from a text to its
chunks. All else (headers, sections, numbering, metadata) is built in.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import let, prefix_sums, stem, strip, word_count
from millrace.operators.frontmatter import with_front_matter

#: What a splitter gives for each chunk beside its key and number.
FIELDS = [("start", pa.int32()), ("text", pa.string()), ("section_path", pa.list_(pa.string())), ("section_headers", pa.map_(pa.string(), pa.string())), ("total_chunks", pa.int32())]
DDL = "start int, text string, section_path array<string>, section_headers map<string,string>, total_chunks int"
#: Texts of one output batch.
BATCH = 256


def last_between(places: list[int], low: int, high: int) -> int | None:
    """The last of the sorted places that lies in (low, high)."""
    at = bisect_left(places, high) - 1
    return places[at] if at >= 0 and places[at] > low else None


class Splitter:
    """Greedy splitting at headers, paragraphs, sentences, commas and spaces, in this order of preference."""

    def __init__(self, size: int = 1200, overlap: int = 150, max_level: int = 3):
        self.size, self.overlap, self.least, self.max_level = size, overlap, size // 3, max_level
        # A header is tested where it begins; of its text one character is enough.
        self.upper = re.compile(rf"^#{{1,{max_level}}} .", re.M)
        self.lower = re.compile(rf"^#{{{max_level + 1},6}} .", re.M) if max_level < 6 else None
        self.header = re.compile(rf"^(#{{1,{max_level}}}) (.+)$", re.M)

    def point(self, text: str, at: int, low: int, upper: list[int], lower: list[int]) -> tuple[int, bool]:
        """Where to split what starts at ``at``, more than ``low`` characters on, and whether that is a header; ``upper`` and ``lower`` are the places of all headers."""
        end = at + self.size
        if (p := last_between(upper, at + low, end)) is not None:
            return p - at, True
        if low == 0 and (p := last_between(lower, at, end)) is not None:
            return p - at, True
        for mark in ("\n\n", ". ", "! ", "? ", ", ", " "):
            p = text.rfind(mark, at + low, end) - at
            if p > low:
                return p + len(mark), False
        return self.size, False

    def split(self, text: str) -> list[tuple[int, str]]:
        """(start, stripped text) of every chunk.

        Slices after the first that are shorter than a third of the size are
        dropped, as is what has no text; only the last may be short.
        """
        out: list[tuple[int, str]] = []
        at = 0
        if not text.strip():
            return out
        # Headers are found once; a step then takes no longer in a long text.
        upper = [m.start() for m in self.upper.finditer(text)]
        lower = [m.start() for m in self.lower.finditer(text)] if self.lower else []
        while at < len(text):
            if len(text) - at <= self.size:
                if piece := text[at:].strip():
                    out.append((at, piece))
                break
            p, header = self.point(text, at, 0 if out else self.least, upper, lower)
            piece = text[at : at + p].strip()
            if piece and (not out or len(piece) >= self.least):
                out.append((at, piece))
            at = at + p if header or self.overlap <= 0 else max(at + p - self.overlap, at + 1)
        return out

    def chunks(self, text: str) -> list[dict]:
        """Chunks with the last header of each level at or before their start; deeper levels are not cleared."""
        headers = [(m.start(), len(m[1]), m[2]) for m in self.header.finditer(text)]
        out, known, k = [], {}, 0
        for start, piece in self.split(text):
            while k < len(headers) and headers[k][0] <= start:
                known[headers[k][1]] = headers[k][2].strip()
                k += 1
            levels = sorted(known)
            out.append({"start": start, "text": piece, "section_path": [known[x] for x in levels], "section_headers": [(f"h{x}", known[x]) for x in levels]})
        return out


def exploded(docs: DataFrame, key: str, text: str, splitter) -> DataFrame:
    """(key, chunk_index, ``FIELDS``) of the chunks that ``splitter`` makes of every text, in batches of some hundred texts."""
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, chunk_index int, {DDL}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                made = [splitter.chunks(t or "") for t in batch.column(1).to_pylist()]
                rows = [c | {"total_chunks": len(chunks)} for chunks in made for c in chunks]
                source = pa.array([n for n, chunks in enumerate(made) for _ in chunks], pa.int64())
                index = pa.array([k for chunks in made for k in range(len(chunks))], pa.int32())
                columns = [pa.array([c[name] for c in rows], kind) for name, kind in FIELDS]
                yield pa.record_batch([batch.column(0).take(source), index, *columns], names=[key, "chunk_index", *(name for name, _ in FIELDS)])

    return docs.select(key, text).mapInArrow(run, schema)


def smart_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 1200, overlap: int = 150, max_level: int = 3) -> DataFrame:
    """(key, chunk_index, start, text, section_path, section_headers) of every chunk; blank and null texts have none."""
    return exploded(docs, key, text, Splitter(size, overlap, max_level))


def header_positions(docs: DataFrame, key: str = "doc_id", text: str = "text", max_level: int = 3) -> DataFrame:
    """(key, start, level, title) of every header line, fences included; within each row, without a shuffle.

    The text is split before each header, so a header begins where the parts
    before it end: positions are prefix sums over the parts' lengths.
    """
    header = rf"#{{1,{max_level}}} [^\n]"
    parts = F.split(F.col(text), rf"\n(?={header})", -1)
    lined = lambda part, start: F.struct(start.alias("start"), F.regexp_extract(part, rf"\A{header}[^\n]*", 0).alias("line"))
    located = let(parts, lambda p: F.zip_with(p, prefix_sums(F.transform(p, lambda x: F.length(x) + 1)), lined))
    found = docs.select(key, F.explode(F.filter(located, lambda h: h["line"] != "")).alias("h"))
    marks = F.regexp_extract("h.line", r"\A(#+) ", 1)
    return found.select(key, F.col("h.start").alias("start"), F.length(marks).alias("level"), strip(F.ltrim(F.col("h.line"), F.lit("#"))).alias("title"))


def sections(chunks: DataFrame, headers: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, chunk_index, section_path, section_level): the last header of each level at or before a chunk's start.

    Chunks and headers are put in one order by offset and read once: a window
    keeps the latest title of each of the six levels. No header meets a chunk
    that it doesn't belong to, and every chunk gives a row. Keys must be those of
    one text each; chunks or headers that repeat are counted as often.
    ``smart_chunks`` gives the same; this is for chunks from elsewhere.
    """
    both = headers.select(key, F.col("start").alias("_at"), F.lit(0).alias("_chunk"), "level", "title", F.lit(None).cast("int").alias("chunk_index")).unionByName(
        chunks.select(key, F.col("start").alias("_at"), F.lit(1).alias("_chunk"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("string").alias("title"), "chunk_index")
    )
    before = Window.partitionBy(key).orderBy("_at", "_chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = [F.last(F.when(F.col("level") == n, F.col("title")), ignorenulls=True).over(before) for n in range(1, 7)]
    path = both.withColumn("section_path", F.array(*known)).filter("_chunk = 1")
    return path.select(key, "chunk_index", F.array_compact("section_path").alias("section_path")).withColumn("section_level", F.size("section_path"))


def chunk_metadata(chunks: DataFrame, source_file: Column, size: int = 1200, overlap: int = 150, strategy: str = "smart", created_at: str | None = None) -> DataFrame:
    """The chunk table: ``chunks`` with the thirteen fields of its front matter.

    ``chunk_id`` is a hash of file and index, so runs agree; ``created_at`` is given by the caller.
    The splitters know how many chunks a file has; only chunks without ``total_chunks`` are counted by a shuffle.
    """
    names = {"smart": "SmartHeaderTextSplitter", "legacy": "MarkdownHeaderTextSplitter+MarkdownTextSplitter"}
    filed = chunks.withColumn("source_file", source_file)
    return filed.withColumns(
        {
            "chunk_id": F.sha2(F.concat_ws("#", "source_file", F.col("chunk_index").cast("string")), 256),
            "chunk_created_at": F.lit(created_at), **({} if "total_chunks" in chunks.columns else {"total_chunks": F.count("*").over(Window.partitionBy("source_file")).cast("int")}),
            "section_level": F.size("section_path"), "char_count": F.length("text").cast("long"), "word_count": word_count(F.col("text")),
            "splitter": F.lit(names.get(strategy, strategy)), "chunk_size": F.lit(size), "chunk_overlap": F.lit(overlap), "chunk_file": output_name(F.col("source_file"), F.col("chunk_index")),
        }
    )


def output_name(source_file: Column, index: Column) -> Column:
    """``<stem>_<index>.md`` with four digits at least; folders don't count."""
    return F.concat(stem(F.substring_index(source_file, "/", -1)), F.format_string("_%04d.md", index))


def chunk_documents(filed: DataFrame, original: Column | None = None) -> DataFrame:
    """(chunk_file, text): every row of ``chunk_metadata`` as a Markdown document, thirteen fields of front matter and the body.

    ``original`` is a JSON object with the source document's own front matter, whose fields stand first unless a chunk field replaces them.
    """
    text, number = ("chunk_id", "chunk_created_at", "source_file", "splitter"), ("chunk_index", "total_chunks", "section_level", "char_count", "word_count", "chunk_size", "chunk_overlap")
    kinds = dict.fromkeys(text, "text") | dict.fromkeys(number, "number") | {"section_path": "list", "section_headers": "map"}
    fields = [
        "chunk_id", "chunk_created_at", "source_file", "chunk_index", "total_chunks", "section_path", "section_level", "section_headers",
        "char_count", "word_count", "splitter", "chunk_size", "chunk_overlap",
    ]
    known = None if original is None else F.map_filter(F.from_json(original, "map<string,string>"), lambda k, _: ~k.isin(fields))
    headed = with_front_matter(filed, [(name, kinds[name], F.col(name)) for name in fields], "_head", known)
    return headed.select("chunk_file", F.concat("_head", F.lit("\n"), "text", F.lit("\n")).alias("text"))


def header_list(given: str) -> list[tuple[str, str]]:
    """``"#,##"`` as [("#", "h1"), ("##", "h2")]; anything but hashes is an error."""
    marks = [x.strip() for x in given.split(",") if x.strip()]
    if not marks or any(set(x) != {"#"} or len(x) > 6 for x in marks):
        raise ValueError(f"headers must be one to six hashes, separated by commas: {given!r}")
    return [(x, f"h{len(x)}") for x in marks]


class LegacySplitter:
    """Two stages: sections by header lines (outside fences), then recursive splitting at Markdown separators down to the size, with overlap."""

    # Separators of the public Markdown splitter, from coarse to fine.
    SEPARATORS = [r"\n#{1,6} ", r"```\n", r"\n\*\*\*+\n", r"\n---+\n", r"\n___+\n", r"\n\n", r"\n", " ", ""]

    def __init__(self, size: int = 1200, overlap: int = 150, headers: list[tuple[str, str]] | None = None):
        self.size, self.overlap = size, overlap
        self.headers = headers or [("#" * k, f"h{k}") for k in range(1, 7)]

    def sections(self, text: str) -> list[tuple[str, dict[str, str]]]:
        out: list[tuple[list[str], dict[str, str]]] = []
        known: dict[str, tuple[int, str]] = {}
        fenced = ""
        body: list[str] = []

        def close() -> None:
            if body:
                out.append((body.copy(), {k: v for k, (_, v) in known.items()}))
                body.clear()

        for line in text.split("\n"):
            bare = line.strip()
            mark = bare[:3]
            if mark in ("```", "~~~") and (not fenced or mark == fenced):
                fenced = "" if fenced else mark
            hit = None if fenced else next(((h, n) for h, n in sorted(self.headers, key=lambda x: -len(x[0])) if bare == h or bare.startswith(h + " ")), None)
            if hit:
                close()
                level = len(hit[0])
                known = {k: v for k, v in known.items() if v[0] < level}
                known[hit[1]] = (level, bare[level:].strip())
                body.append(bare)
            elif bare:
                body.append(bare)
            elif body and body[-1]:
                body.append("")
        close()
        return [("\n".join(b).strip(), known_then) for b, known_then in out]

    def pieces(self, text: str, separators: list[str]) -> list[str]:
        at = next((n for n, s in enumerate(separators) if s == "" or re.search(s, text)), len(separators) - 1)
        rest = separators[at + 1 :]
        parts = list(text) if separators[at] == "" else [p for p in re.split(f"(?={separators[at]})", text) if p]
        out: list[str] = []
        held: list[str] = []

        def merge() -> None:
            run: list[str] = []
            total = 0
            for p in held:
                if run and total + len(p) > self.size:
                    out.append("".join(run).strip())
                    while run and (total > self.overlap or total + len(p) > self.size):
                        total -= len(run.pop(0))
                run.append(p)
                total += len(p)
            if run:
                out.append("".join(run).strip())
            held.clear()

        for p in parts:
            if len(p) < self.size:
                held.append(p)
                continue
            merge()
            out += self.pieces(p, rest) if rest else [p]
        merge()
        return [p for p in out if p]

    def chunks(self, text: str) -> list[dict]:
        out = []
        for body, known in self.sections(text):
            path = [known[f"h{k}"] for k in range(1, 7) if known.get(f"h{k}")]
            out += [{"start": None, "text": p.strip(), "section_path": path, "section_headers": list(known.items())} for p in self.pieces(body, self.SEPARATORS)]
        return out


def legacy_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 1200, overlap: int = 150, headers: list[tuple[str, str]] | None = None) -> DataFrame:
    """As ``smart_chunks`` by the two-stage splitter; ``start`` is null."""

    return exploded(docs, key, text, LegacySplitter(size, overlap, headers))
