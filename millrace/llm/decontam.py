"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

An alignment of the score Q or more has M matches and at most 2 M - Q errors,
which part its matches into runs. So either t of its matches are followed by the
next word's match, or it matches Q - t words at least: errors are too few to
part more. The first kind meets on pairs of consecutive words, the second on
single words, and both only on rare ones: of those that an item has, so many of
the most frequent (among items) are left out that an alignment must still hold
``need`` of the others. A document meets an item where so many seeds stand
within the length of the longest such alignment. Every meeting is scored by
local alignment of words, which tolerates edits, insertions and paraphrased
parts. Nothing is missed, and what meets depends on the document and the items
alone, not on the rest of the corpus.

Items are the query set: they go to the tasks in blocks of ``BLOCK_WORDS`` words
at most, so memory stays bounded for any number of items, and every block is
held against all documents. Each task joins the seeds of its texts with those of
the block, some of the meetings at a time, so no long document needs more.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces, split_words, spread, unused, written

#: Scores of the alignment, for a match, a mismatch and a word left out on either side.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Contaminated from this share of an item's best possible score.
THRESHOLD = 0.5
#: Words of items that one pass holds in every task: with their index some 90 bytes each, so 90 MB are broadcast at most, unless one item has more.
BLOCK_WORDS = 1 << 20
#: Contaminated rows of 16 bytes that are broadcast to find the clean ones; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 20
#: Hits of seeds that are sorted at once, besides those within the reach of the last.
HITS = 1 << 19
#: Words of text in one alignment, besides the overlap, unless the item is longer.
STRETCH = 1 << 16

TRIM = b".,;:!?\"'()[]{}#*$%&|<>"


def coded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code for every word, A-Z lower-cased and without punctuation at its ends, and the offsets of the texts."""
    flat, offsets = split_words(column)
    known = flat.dictionary_encode()
    codes = np.fromiter((xxhash.xxh3_64_intdigest(w.lower().strip(TRIM)) for w in known.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(known.dictionary))
    return (codes[np.asarray(known.indices)] if len(flat) else np.empty(0, np.uint64)), offsets


class Seeds:
    """Hashes by which texts meet items: so many hits as an item needs, within its reach."""

    def __init__(self, chosen: list[tuple[int, int, np.ndarray]], reach: np.ndarray):
        """``chosen``: an item's number, the hits it needs and the hashes of its seeds."""
        self.need, self.reach = np.ones(len(reach), np.int64), reach
        hashes, items = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for item, need, mine in chosen:
            self.need[item] = need
            hashes.append(np.unique(mine))
            items.append(np.full(len(hashes[-1]), item))
        hashes, items = np.concatenate(hashes), np.concatenate(items)
        order = np.argsort(hashes, kind="stable")
        self.item = items[order]
        self.known, self.first, self.times = np.unique(hashes[order], return_index=True, return_counts=True)
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(self.known >> np.uint64(44)).astype(np.int64)] = True
        self.longest = int(reach[items].max()) if len(items) else 0

    def meetings(self, hashes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(item, text, first, last): the first and the last place of a run of hits that suffice; ``hashes`` stand at the places of words."""
        if not len(self.known):
            return
        near = np.flatnonzero(self.bits[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, hashes[near]), len(self.known) - 1)
        sure = self.known[at] == hashes[near]
        place, which = near[sure], at[sure]
        doc = np.searchsorted(offsets, place, side="right") - 1
        share = (np.cumsum(self.times[which]) - self.times[which]) // HITS
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(share)) + 1, [len(place)]])
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            # Runs that begin here may end as far behind as an alignment is long.
            b = int(np.searchsorted(place, place[b - 1] + self.longest))
            times = self.times[which[a:b]]
            inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            item = self.item[np.repeat(self.first[which[a:b]], times) + inside]
            pos, text = np.repeat(place[a:b], times), np.repeat(doc[a:b], times)
            key = (text - doc[a]) * len(self.reach) + item
            order = np.argsort(key, kind="stable")
            pos, key, item, text = pos[order], key[order], item[order], text[order]
            last = np.arange(len(key)) + self.need[item] - 1
            fits = np.flatnonzero(last < len(key))
            fits = fits[(key[last[fits]] == key[fits]) & (pos[last[fits]] - pos[fits] < self.reach[item[fits]])]
            if len(fits):
                yield item[fits], text[fits], pos[fits], pos[last[fits]]


def paired(codes: np.ndarray) -> np.ndarray:
    """A hash of every word and the next."""
    return spread(codes[:-1] * np.uint64(31) + codes[1:])


class Items:
    """A block of test items with their seeds, for alignments of at least ``threshold`` of the best score."""

    def __init__(self, ids: list[int], texts: pa.Array, threshold: float):
        codes, offsets = coded(texts)
        self.ids, self.threshold, self.words = ids, threshold, [codes[a:b] for a, b in zip(offsets, offsets[1:])]
        # The words of text in the longest alignment; an item without words meets nothing.
        self.reach = np.array([ceil((3 - 2 * threshold) * len(w)) + 1 for w in self.words], np.int64)
        pairs = [paired(w) for w in self.words]
        in_items = [self.held(x) for x in (self.words, pairs)]
        single, double = [], []
        for n, (mine, two) in enumerate(zip(self.words, pairs)):
            size = len(mine)
            if not size:
                continue
            least = max(1.0, MATCH * threshold * size - 1e-9)
            t = min(size - 1, max(1, size // 4))
            if t:
                need = max(1, t // 2)
                double.append((n, need, self.rarest(two, in_items[1], size - 1 - t + need)))
            matches = max(ceil(least / MATCH), ceil(least - t))
            if matches <= size:
                need = max(1, matches // 3)
                single.append((n, need, self.rarest(mine, in_items[0], size - matches + need)))
        self.single, self.double = Seeds(single, self.reach), Seeds(double, self.reach)

    @staticmethod
    def held(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The distinct hashes and in how many items each stands."""
        return np.unique(np.concatenate([np.empty(0, np.uint64), *map(np.unique, hashes)]), return_counts=True)

    @staticmethod
    def rarest(mine: np.ndarray, held: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
        return mine[np.lexsort((mine, held[1][np.searchsorted(held[0], mine)]))[:n]]

    def meetings(self, codes: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """By item: (text, begin, end) of the words that can hold an alignment."""
        found = [[np.empty(0, np.int64)] * 4, *self.single.meetings(codes, offsets)]
        if len(codes) > 1:
            two = paired(codes)
            found += self.double.meetings(two, offsets)
        item, text, begin, end = (np.concatenate(x) for x in zip(*found))
        begin, end = np.maximum(begin - self.reach[item], offsets[text]), np.minimum(end + 1 + self.reach[item], offsets[text + 1])
        order = np.lexsort((begin, text, item))
        item, text, begin, end = item[order], text[order], begin[order], end[order]
        out: dict[int, list[tuple[int, int, int]]] = {}
        if not len(item):
            return out
        # Of one text and item stretches that touch are one. Ends grow with begins but for the two kinds of seeds.
        group = np.flatnonzero(np.concatenate([[True], (np.diff(item) != 0) | (np.diff(text) != 0)]))
        shift = np.repeat(np.arange(len(group)), np.diff(np.concatenate([group, [len(item)]]))) * (offsets[-1] + 1)
        furthest = np.maximum.accumulate(end + shift) - shift
        new = np.flatnonzero(np.concatenate([[True], (np.diff(shift) != 0) | (begin[1:] > furthest[:-1])]))
        for i, d, x, y in zip(item[new].tolist(), text[new].tolist(), begin[new].tolist(), furthest[np.concatenate([new[1:] - 1, [len(item) - 1]])].tolist()):
            if y - x <= STRETCH:
                out.setdefault(i, []).append((d, x, y))
                continue
            # A long stretch is aligned in parts that overlap by the longest alignment, so each alignment is whole in one of them.
            over = int(self.reach[i])
            part = max(STRETCH, over)
            out.setdefault(i, []).extend((d, a, min(y, a + part + over)) for a in range(x, max(x + 1, y - over), part))
        return out


def align(item: np.ndarray, stretches: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """Best local alignment of an item with each stretch: score, and the begin and end of the aligned words in the stretch.

    Rows of the Smith-Waterman table, one item word each, for all stretches at
    once. A cell holds its score above the begin of its alignment, so both move
    together; of equal scores the earlier begin wins.
    """
    width, low = max(map(len, stretches)), 24
    words = np.zeros((len(stretches), width), np.uint64)
    inside = np.zeros(words.shape, bool)
    for row, stretch in enumerate(stretches):
        words[row, : len(stretch)] = stretch
        inside[row, : len(stretch)] = True
    unit = np.int64(1) << low
    column = np.arange(width + 1, dtype=np.int64)
    fresh = (unit - 1 - column)[None, :]  # score 0, to begin at this column
    above = np.repeat(fresh, len(stretches), axis=0)
    best = np.zeros(len(stretches), np.int64)
    end = np.zeros(len(stretches), np.int64)
    for word in item:
        step = np.where((words == word) & inside, MATCH, MISMATCH).astype(np.int64) * unit
        here = np.maximum(above, 0) + GAP * unit
        here[:, 1:] = np.maximum(here[:, 1:], above[:, :-1] + step)
        here = np.maximum(here, fresh)
        # A gap along the stretch: the largest cell to the left, less its distance.
        along = here - GAP * unit * column
        here = np.maximum(here, np.maximum.accumulate(along, axis=1) + GAP * unit * column)
        top = here.argmax(axis=1)
        value = here[np.arange(len(stretches)), top]
        better = (value >> low) > (best >> low)
        best[better], end[better] = value[better], top[better]
        above = here
    return [(int(v >> low), int(unit - 1 - (v & (unit - 1))), int(e)) for v, e in zip(best, end)]


def scored(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, text_hash, item_id, score, begin, end) of every stretch of text and item that meet and reach the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for piece in pieces(batches, "text") if any(map(len, items.words)) else ():
            codes, offsets = coded(piece.column("text"))
            out = []
            for item, rows in items.meetings(codes, offsets).items():
                rows.sort(key=lambda r: r[2] - r[1])
                while rows:
                    # as many stretches as fit a table of bounded size, the longest first
                    take = max(1, (1 << 17) // (rows[-1][2] - rows[-1][1] + 1))
                    part, rows = rows[-take:], rows[:-take]
                    for (doc, a, _), (score, begin, end) in zip(part, align(items.words[item], [codes[a:b] for _, a, b in part])):
                        share = score / (MATCH * len(items.words[item]))
                        if share >= items.threshold:
                            start = a - int(offsets[doc])
                            out.append((doc, items.ids[item], share, start + begin, start + end))
            rows = pa.array([o[0] for o in out], pa.int64())
            yield pa.record_batch(
                [piece.column("doc_id").take(rows), piece.column("text_hash").take(rows), *(pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.int64(), pa.float64(), pa.int64(), pa.int64()), 1))],
                names=["doc_id", "text_hash", "item_id", "score", "begin", "end"],
            )

    return docs.mapInArrow(run, "doc_id long, text_hash long, item_id long, score double, begin long, end long")


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, begin, end): every document and test item that align with at least ``threshold`` of the item's best score.

    ``begin`` and ``end`` are word offsets of the best alignment in the document.
    Null texts have no words and meet nothing; an item without words meets
    nothing, and one of one word meets every document that holds it. A null doc_id or item_id is a value like others, and rows that share
    a doc_id give their best alignment. Without documents or items there are no
    rows.
    """
    best = F.max(F.struct("score", -F.col("begin"), "begin", "end")).alias("best")
    found = alignments(docs, benchmark, doc_id, text, item_id, item_text, threshold)
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.score", "best.begin", "best.end")


def alignments(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, threshold: float) -> DataFrame:
    """(doc_id, text_hash, item_id, score, begin, end) as ``contaminated`` finds them, with the hash of the text they are in."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    asked = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    size = asked.select(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).head()[0] or 0
    blocks = -(-size // BLOCK_WORDS)
    found = []
    for block in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").toArrow()
        items = Items(part.column("item_id").to_pylist(), part.column("text").combine_chunks(), threshold)
        found.append(scored(texts, items))
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id long, text_hash long, item_id long, score double, begin long, end long")
    return reduce(DataFrame.unionByName, found)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that align with no item. A row is known by its id and its text, so each is judged by its own alignments."""
    found = alignments(docs, benchmark, doc_id, text, item_id, item_text, threshold)
    bad = found.select(F.col("doc_id").alias(unused("_bad_id", docs.columns)), F.col("text_hash").alias(unused("_bad_hash", docs.columns))).distinct()
    bad = written(bad)
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad
    hashed = unused("text_hash", docs.columns)
    mine = docs.withColumn(hashed, F.xxhash64(text))
    return mine.join(bad, mine[doc_id].cast("long").eqNullSafe(bad[bad.columns[0]]) & (mine[hashed] == bad[bad.columns[1]]), "left_anti").drop(hashed)
