"""Substring deduplication: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

Every window of every document is hashed and dealt by the smallest hash of the
short word sequences inside it, so equal windows meet in one task, which finds
the windows that also start in a document with a smaller doc_id. Their starts
return to the documents and merge into maximal removal intervals. Neighbouring
windows mostly share that smallest hash, so they travel and return together.

A short sequence that stands in very many windows would fill one bucket: those
that a sample shows to be so frequent (``HOT_SHARE``) deal nothing, and their
windows are dealt by their own hashes. The sample only balances the buckets.

Windows travel packed: one row holds what a piece of the input (some MB of text)
has in one bucket, some 8 bytes a window. Windows that repeat inside a piece
are settled there, so even a passage in a third of all documents sends one
window a piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import as_bytes, partitions, pieces, planes, split_words, spread, unplanes

#: Odd multipliers of the two polynomials.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: Words in the sequences whose smallest hash deals a window.
DEAL_WORDS = 8
#: Windows that a bucket holds on average, at most.
BUCKET_WINDOWS = 1 << 20

#: A short sequence with a sixteenth of a bucket, and this share of the sampled windows, is hot; so there are 100,000 hot ones at most.
HOT_SHARE = 1e-5
#: Bytes of text that are sampled to find the hot ones, and the share of the input beyond.
SAMPLE_BYTES, SAMPLE_SHARE = 32 << 20, 1 / 2000

#: Bytes of a window's hash that travel. Windows of 100 TB of text, dealt over their buckets by another hash, have two different ones that agree in them once in 100,000 runs.
WIDTH = 10

META = "bucket int, doc_id long, mark long, hashes binary, meta binary"


def rolling(values: np.ndarray, window: int, base: int) -> np.ndarray:
    """Rabin-Karp hash modulo 2**64 of every ``window`` consecutive values, by doubling: a hash of 2k values is that of the first k, shifted, plus that of the next k."""
    if len(values) < window:
        return np.empty(0, np.uint64)
    done, length = None, 0
    power, part, size = base, values, 1
    with np.errstate(over="ignore"):
        while True:
            if window & size:
                if done is None:
                    done, length = part, size
                else:
                    n = len(values) - length - size + 1
                    # the smaller part stands first
                    done = done[:n] * np.uint64(power) + part[length : length + n]
                    length += size
            if size * 2 > window:
                return done[: len(values) - window + 1]
            part = part[: len(part) - size] * np.uint64(power) + part[size:]
            power = power * power % (1 << 64)
            size *= 2


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    part, size = x, 1
    while size * 2 <= width:
        part = np.minimum(part[: len(part) - size], part[size:])
        size *= 2
    n = len(x) - width + 1
    return np.minimum(part[:n], part[width - size : width - size + n])


def pack(doc: np.ndarray, at: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> bytes:
    """Documents and places of windows that stand in document order."""
    first = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1]) if len(doc) else np.empty(0, np.int64)
    docs = doc[first]
    counts = np.diff(np.concatenate([first, [len(doc)]])).astype(np.uint32)
    step = np.diff(at, prepend=0).astype(np.int64)
    step[first] = at[first]
    parts = [planes(np.diff(ids[docs], prepend=0)), planes(marks[docs]), planes(counts), planes(step.astype(np.uint32))]
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(docs), len(doc)], np.int64).tobytes() + b"".join(parts))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, mark and place of each window."""
    data = zstandard.ZstdDecompressor().decompress(data)
    n_docs, n = np.frombuffer(data[:16], np.int64).tolist()
    cuts = np.cumsum([16, 8 * n_docs, 8 * n_docs, 4 * n_docs, 4 * n])
    ids, marks, counts, step = (unplanes(data[a:b], kind) for a, b, kind in zip(cuts, cuts[1:], (np.int64, np.int64, np.uint32, np.uint32)))
    total = np.cumsum(step.astype(np.int64))
    first = np.cumsum(counts) - counts
    at = total - np.repeat(total[first] - step[first], counts)
    return np.repeat(np.cumsum(ids), counts), np.repeat(marks, counts), at.astype(np.int64)


def numbered(texts: DataFrame) -> DataFrame:
    """Add ``mark``, by which rows that share a doc_id but not a text are told apart."""
    return texts.withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))


def marks_of(texts: list[bytes]) -> np.ndarray:
    """The same of each text's bytes."""
    return np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in texts), np.uint64, len(texts)).view(np.int64)


def word_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and the offset of each text's first word."""
    flat, offsets = split_words(column)
    coded = flat.dictionary_encode()
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return (words[np.asarray(coded.indices)] if len(flat) else np.empty(0, np.uint64)), offsets


def places_of(offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and place in it of every window."""
    n = np.maximum(np.diff(offsets) - window + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    return doc, np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)


def deal_keys(values: np.ndarray, window: int) -> np.ndarray:
    """The smallest hash of the short word sequences in every window."""
    deal = min(DEAL_WORDS, window)
    return sliding_least(spread(rolling(values, deal, BASES[1])), window - deal + 1)


def frequent(docs: DataFrame, size: int, buckets: int, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray:
    """The keys, sorted, of which a sample of ``docs``, ``size`` bytes of text, has too many for one of ``buckets``; ``keys_of`` gives those of a piece."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            for found in keys_of(piece):
                keys, n = np.unique(found, return_counts=True)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    share = min(1.0, max(SAMPLE_BYTES / max(size, 1), SAMPLE_SHARE))
    counted = docs.sample(share, 7).mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    total = counted.agg(F.sum("n")).head()[0] or 0
    if not total:
        return np.empty(0, np.uint64)
    hot = counted.filter(F.col("n") >= max(HOT_SHARE, 1 / (16 * buckets)) * total).select("key")
    return np.sort(np.array([r.key for r in hot.collect()], np.int64).view(np.uint64))


def hot_keys(docs: DataFrame, window: int, size: int, buckets: int) -> np.ndarray:
    """The deal keys that too many of the sampled windows have for one of ``buckets``."""

    def keys_of(piece: pa.RecordBatch) -> Iterator[np.ndarray]:
        values, offsets = word_values(piece.column("text"))
        doc, at = places_of(offsets, window)
        if len(doc):
            yield deal_keys(values, window)[at + offsets[doc]]

    return frequent(docs.select("text"), size, buckets, keys_of)


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, mark, starts array<binary>): the starts (packed int32) of windows of ``doc_id, text`` rows that also start in a document with a smaller doc_id."""
    size = docs.select(F.sum(F.octet_length("text"))).head()[0] or 0
    # A word and its space have some 6 bytes; an estimate is enough for the number of buckets.
    windows = max(size // 6, 1)
    buckets = max(4 * partitions(docs.sparkSession), ceil(windows / BUCKET_WINDOWS))
    hot = hot_keys(docs, window, size, buckets)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            values, offsets = word_values(piece.column("text"))
            ids = np.asarray(piece.column("doc_id"))
            marks = marks_of(as_bytes(piece.column("text")))
            doc, at = places_of(offsets, window)
            if not len(doc):
                continue
            place = at + offsets[doc]
            low, high = (spread(rolling(values, window, base)[place]) for base in BASES)
            # Settle what repeats inside the piece: all but the smallest document's windows go, and only that document's travel.
            order = np.argsort(low)
            sorted_low, sorted_high = low[order], high[order]
            new = np.concatenate([[True], (sorted_low[1:] != sorted_low[:-1]) | (sorted_high[1:] != sorted_high[:-1])])
            run = np.cumsum(new) - 1
            least = np.minimum.reduceat(ids[doc[order]], np.flatnonzero(new))
            later = np.empty(len(doc), dtype=bool)
            later[order] = ids[doc[order]] > least[run]
            key = deal_keys(values, window)[place]
            key = np.where(np.isin(key, hot), low, key)
            bucket = (spread(key) % np.uint64(buckets)).astype(np.uint32)
            # The bytes that travel are the first hash's high ones and then those of the other hash.
            wide = np.stack([low, high], axis=1).view(np.uint8).reshape(-1, 16)[:, np.r_[7, 6, 5, 4, 3, 2, 1, 0, 8:16][:WIDTH]]
            yield from local(doc[later], at[later], ids, marks, buckets)
            stay = np.flatnonzero(~later)
            stay = stay[np.argsort(bucket[stay], kind="stable")]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[stay])) + 1, [len(stay)]])
            rows = [(int(bucket[s[0]]), wide[s].tobytes(), pack(doc[s], at[s], ids, marks)) for s in (stay[a:b] for a, b in zip(cuts, cuts[1:])) if len(s)]
            none = pa.nulls(len(rows), pa.int64())
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), none, none, pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=META_NAMES)

    def local(doc: np.ndarray, at: np.ndarray, ids: np.ndarray, marks: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
        if len(doc):
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1, [len(doc)]])
            docs = doc[cuts[:-1]]
            starts = [at[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:])]
            # dealt over the buckets, which pass them on
            to = spread(ids[docs].astype(np.uint64)) % np.uint64(buckets)
            yield pa.record_batch([pa.array(to.astype(np.int32)), pa.array(ids[docs]), pa.array(marks[docs]), pa.nulls(len(docs), pa.binary()), pa.array(starts, pa.binary())], names=META_NAMES)

    def meet(found: pa.Table) -> pa.Table:
        hashes, docs, marks, places, out = [], [], [], [], []
        passed = found.filter(pa.compute.is_null(found["hashes"]))
        for row in found.filter(pa.compute.is_valid(found["hashes"])).select(["hashes", "meta"]).to_pylist():
            raw = np.frombuffer(row["hashes"], np.uint8).reshape(-1, WIDTH)
            full = np.zeros((len(raw), 16), np.uint8)
            full[:, :WIDTH] = raw
            hashes.append(full.view(np.uint64))
            for into, x in zip((docs, marks, places), unpack(row["meta"])):
                into.append(x)
        if hashes:
            key, doc, mark, at = np.concatenate(hashes), np.concatenate(docs), np.concatenate(marks), np.concatenate(places)
            order = np.lexsort((key[:, 1], key[:, 0]))
            key = key[order]
            new = np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])
            least = np.minimum.reduceat(doc[order], np.flatnonzero(new))
            later = order[doc[order] > least[np.cumsum(new) - 1]]
            later = later[np.lexsort((at[later], mark[later], doc[later]))]
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(doc[later]) != 0) | (np.diff(mark[later]) != 0)) + 1, [len(later)]])
            out = [(int(doc[s[0]]), int(mark[s[0]]), at[s].astype(np.int32).tobytes()) for s in (later[a:b] for a, b in zip(cuts, cuts[1:])) if len(s)]
        mine = pa.table({"doc_id": pa.array([x[0] for x in out], pa.int64()), "mark": pa.array([x[1] for x in out], pa.int64()), "starts": pa.array([x[2] for x in out], pa.binary())})
        return pa.concat_tables([mine, passed.select(["doc_id", "mark", "meta"]).rename_columns(["doc_id", "mark", "starts"]).cast(mine.schema)])

    packed = docs.filter("doc_id is not null").mapInArrow(emit, META)
    met = packed.groupBy("bucket").applyInArrow(meet, "doc_id long, mark long, starts binary")
    return met.groupBy("doc_id", "mark").agg(F.collect_list("starts").alias("starts"))


META_NAMES = [x.split()[0] for x in META.split(", ")]


def intervals(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal [begin, end) runs that windows from the given starts cover."""
    starts = np.unique(starts)
    new = np.flatnonzero(np.diff(starts) > window) + 1
    return starts[np.concatenate([[0], new])], starts[np.concatenate([new - 1, [len(starts) - 1]])] + window


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, spans array<struct<begin, end>>, kept): every document without the words that such a window covers.

    ``spans`` are the maximal removed word intervals, ``kept`` is what is left,
    joined by single spaces. Windows are judged on the input. A null text has no
    words. A null doc_id is neither smaller nor larger than another, so such rows
    lose nothing and take nothing from others; neither do rows of one doc_id
    from each other, which are told apart by 64 bits of a hash of their texts. Repeated rows give repeated rows, an empty table an empty one.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<begin:int,end:int>>, kept string"
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            n, gone, spans, kept = [], [], [], []
            for t, starts in zip(piece.column("text").cast(pa.binary()).to_pylist(), piece.column("starts").to_pylist()):
                words, removed = (t or b"").split(), []
                n.append(len(words))
                if starts:
                    begin, end = intervals(np.frombuffer(b"".join(starts), np.int32).astype(np.int64), window)
                    removed = list(zip(begin.tolist(), end.tolist()))
                    edges = [0, *(x for pair in removed for x in pair), len(words)]
                    words = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                gone.append(n[-1] - len(words))
                spans.append([{"begin": a, "end": b} for a, b in removed])
                kept.append(b" ".join(words))
            yield pa.record_batch([piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    starts = repeated_windows(texts, window)
    return numbered(texts).join(starts, ["doc_id", "mark"], "left").select("doc_id", "text", "starts").mapInArrow(cut, schema)
