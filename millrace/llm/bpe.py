"""Byte-level BPE: encoding by corpus-level merge replay, and decoding.

Texts are cut into pre-tokens (words) piece by piece, some MB of text each. A
piece keeps its texts as numbers of its own distinct words and deals these
words, packed, by their hash. A task then has all words of a hash range,
whichever pieces they come from: it lays the bytes of the distinct ones out in
one sequence, builds an inverted index from each mergeable pair to its positions
there, and applies the merges in rank order, each touching only the two
neighbours of its positions. So every distinct word of the corpus is merged once.
Its ids return to the pieces that hold it, where the texts are put together and
decoded from the ids. Texts themselves never travel, and no task holds more than
a piece or a hash range.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bucketed, partitions, pieces, planes, unplanes

#: Bytes of text in a piece, unless one text has more; a larger piece repeats fewer words and takes more memory.
PIECE = 24 << 20
#: Bytes of text that are put together at once.
PART = 2 << 20
#: Bytes of input for each hash range of words; a range then holds about as many words as pieces of that size do.
RANGE = 16 << 20


@lru_cache(maxsize=1)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines; read once in a worker."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def replay(words: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """Ids of every word, by replaying the merges over all words at once.

    A word that is itself a token is that one token. In every word the pair of
    the lowest rank merges first and of equal ranks the leftmost, as if the word
    stood alone. Each single byte must be a token.
    """
    token: list[bytes | None] = []
    for word in words:
        if word in ranks:
            token.append(word)
        else:
            token.extend(word[i : i + 1] for i in range(len(word)))
        token.append(None)  # the end of a word: no pair reaches over it
    n = len(token)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    index: dict[int, list[int]] = {}
    rank_of = ranks.get
    left = token[0] if n else None
    for at in range(n - 1):
        right = token[at + 1]
        if left is not None and right is not None and (rank := rank_of(left + right)) is not None:
            index.setdefault(rank, []).append(at)
        left = right
    queue = list(index)
    heapq.heapify(queue)
    spelled = dict(map(reversed, ranks.items())) if index else {}
    while queue:
        rank = heapq.heappop(queue)
        places = index.pop(rank, None)
        if not places:
            continue
        places.sort()
        whole = spelled[rank]
        for turn, at in enumerate(places):
            left = token[at]
            if left is None or (then := after[at]) >= n or (right := token[then]) is None or len(left) + len(right) != len(whole) or left + right != whole:
                continue
            token[at], token[then] = whole, None
            after[at] = beyond = after[then]
            before[beyond] = at
            after[then] = n  # gone
            lower = False
            if (follower := token[beyond]) is not None and (new := rank_of(whole + follower)) is not None:
                if new in index:
                    index[new].append(at)
                else:
                    index[new] = [at]
                    heapq.heappush(queue, new)
                lower = new < rank
            if (prior := before[at]) >= 0 and (leader := token[prior]) is not None and (new := rank_of(leader + whole)) is not None:
                if new in index:
                    index[new].append(prior)
                else:
                    index[new] = [prior]
                    heapq.heappush(queue, new)
                lower |= new < rank
            if lower:  # a pair of lower rank has come up: it goes before the rest of these
                if rest := places[turn + 1 :]:
                    index.setdefault(rank, []).extend(rest)
                    heapq.heappush(queue, rank)
                break
    out, at = [], 0
    for word in words:
        ids = []
        while token[at] is not None:
            ids.append(ranks[token[at]])
            at = after[at]
        out.append(ids)
        at += 1
    return out


@lru_cache(maxsize=1)
def spellings(path: str) -> tuple[pa.Array, pa.Array]:
    """By id: its decimal digits, and the bytes of its token."""
    spelled = {rank: token for token, rank in load_ranks(path).items()}
    ids = range(max(spelled) + 1)
    return pa.array(map(str, ids), pa.string()), pa.array(map(spelled.get, ids), pa.binary())


def squeezed(x: np.ndarray) -> bytes:
    return zstandard.compress(planes(x.astype(np.uint32)), 6)


def opened(data: bytes) -> np.ndarray:
    return unplanes(zstandard.decompress(data), np.uint32)


#: What travels. Texts of a piece: their doc_ids, words in each and the words' numbers. Words of a piece in one
#: hash range: their lengths, numbers (as steps) and bytes; on the way back their counts of ids, numbers and ids.
CUT = "piece long, bucket int, docs array<long>, counts binary, places binary, words binary"


def cut_texts(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """``CUT`` rows of (doc_id, text) rows."""
    names = [x.split()[0] for x in CUT.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]

    def packed(words: list[str], held: list[tuple[list, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        piece = uuid.uuid4().int >> 65
        # The most frequent words take the smallest numbers, which pack best.
        order = np.argsort(-sum((np.bincount(flat, minlength=len(words)) for _, _, flat in held), np.zeros(len(words), np.int64)), kind="stable")
        number = np.empty(len(words), np.int64)
        number[order] = np.arange(len(words))
        rows = [(piece, None, ids, squeezed(counts), squeezed(number[flat]), None) for ids, counts, flat in held]
        raw = [words[k].encode() for k in order.tolist()]
        bucket = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw)) % np.uint64(buckets)
        by = np.argsort(bucket, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(bucket[by])) + 1).tolist(), len(by)] if len(by) else [0]
        for a, b in zip(cuts, cuts[1:]):
            mine = [raw[k] for k in by[a:b].tolist()]
            rows.append((piece, int(bucket[by[a]]), None, squeezed(np.array([len(w) for w in mine])), squeezed(np.diff(by[a:b], prepend=0)), zstandard.compress(b"".join(mine), 9)))
        for at in range(0, len(rows), 64):
            part = rows[at : at + 64]
            yield pa.record_batch([pa.array([r[k] for r in part], kind) for k, kind in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall

        def fresh() -> tuple[defaultdict, list, int]:
            number: defaultdict = defaultdict()
            number.default_factory = number.__len__  # a new word takes the next number
            return number, [], 0

        number, held, size = fresh()
        for part in pieces(batches, "text", PART):
            found = [np.fromiter(map(number.__getitem__, find(t or "")), np.int32) for t in part.column("text").to_pylist()]
            held.append((part.column("doc_id").to_pylist(), np.array([len(x) for x in found]), np.concatenate(found)))
            size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            if size >= PIECE:
                yield from packed(list(number), held)
                number, held, size = fresh()
        if held:
            yield from packed(list(number), held)

    return docs.mapInArrow(run, CUT)


def merged_words(cut: DataFrame, path: str) -> DataFrame:
    """(piece, counts, places, words): for the words of every piece and hash range their counts of ids, their numbers and their ids."""

    def learn(found: pa.Table) -> pa.Table:
        lengths = [opened(x) for x in found["counts"].to_pylist()]
        sizes = np.array([len(x) for x in lengths])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths), dtype=np.int64)])
        data = b"".join(map(zstandard.decompress, found["words"].to_pylist()))
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        ids = replay(words.dictionary.to_pylist(), load_ranks(path))
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, count.sum())
        start, which, rows, at = np.cumsum(count) - count, np.asarray(words.indices), [], 0
        for size in sizes.tolist():
            mine = which[at : at + size]
            rows.append((squeezed(count[mine]), squeezed(flat[stretched(start[mine], count[mine])])))
            at += size
        return pa.table([found["piece"], pa.array([r[0] for r in rows], pa.binary()), found["places"], pa.array([r[1] for r in rows], pa.binary())], names=["piece", "counts", "places", "words"])

    return cut.filter("bucket is not null").select("bucket", "piece", "counts", "places", "words").groupBy("bucket").applyInArrow(learn, "piece long, counts binary, places binary, words binary")


def stretched(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), then those from start[1] on, and so forth."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def coded(docs: DataFrame, path: str, pattern: str, doc_id: str, text: str, schema: str, finish: Callable[[pa.Array, pa.Array, pa.Array], list[pa.Array]]) -> DataFrame:
    """``schema`` columns of every row: doc_id, and those that ``finish`` makes of (offsets of the texts' ids, all ids)."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = texts.select(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(2 * partitions(docs.sparkSession), ceil(size / RANGE))
    # A table, so that all takers see the same pieces, also after an executor is lost; its texts need no shuffle to meet their words.
    cut = bucketed(cut_texts(texts, pattern, buckets), "piece")
    names = [x.split()[0] for x in schema.split(", ")]

    def put_together(texts: pa.Table, found: pa.Table) -> pa.Table:
        words = [(np.cumsum(opened(r["places"]), dtype=np.int64), opened(r["counts"]), opened(r["words"])) for r in found.to_pylist()]
        place, count, flat = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*words) if words else [()] * 3))
        start_of, count_of = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        start_of[place], count_of[place] = np.cumsum(count) - count, count
        out = []
        for r in texts.to_pylist():
            mine = opened(r["places"])
            count = count_of[mine]
            ids = flat[stretched(start_of[mine], count)]
            ends = np.concatenate([[0], np.cumsum(opened(r["counts"]), dtype=np.int64)])
            offsets = np.concatenate([[0], np.cumsum(count)])[ends]
            out.append(pa.record_batch([pa.array(r["docs"], pa.int64()), *finish(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))], names=names))
        return pa.Table.from_batches(out)

    texts_of = cut.filter("bucket is null").select("piece", "docs", "counts", "places")
    return texts_of.groupBy("piece").cogroup(merged_words(cut, path).groupBy("piece")).applyInArrow(put_together, schema)


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; null is the empty text, which has no ids. Repeated rows give repeated rows, an empty table an empty one."""
    return coded(docs, path, pattern, doc_id, text, "doc_id long, ids array<int>", lambda offsets, ids: [pa.ListArray.from_arrays(offsets, ids)])


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, data binary): the bytes that the ids spell; null ids give empty bytes, an unknown id fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = {rank: token for token, rank in load_ranks(path).items()}
        for batch in batches:
            data = [b"".join(map(spelled.__getitem__, x or ())) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", joined: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, data binary decoded from these ids); ``ids`` is a string of decimal ids joined by commas, or an array<int> without ``joined``. Rows as in ``encode``."""

    def finish(offsets: pa.Array, ids: pa.Array) -> list[pa.Array]:
        digits, spelled = spellings(path)
        listed = lambda values: pa.ListArray.from_arrays(offsets, values)
        written_out = pc.binary_join(listed(digits.take(ids)), ",") if joined else listed(ids)
        return [pa.array(np.diff(offsets), pa.int64()), written_out, pc.binary_join(listed(spelled.take(ids)), b"")]

    return coded(docs, path, pattern, doc_id, text, f"doc_id long, n_tokens long, ids {'string' if joined else 'array<int>'}, data binary", finish)
