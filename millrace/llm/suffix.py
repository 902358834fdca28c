"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

No suffix of the whole corpus is ever sorted at once. Suffixes are dealt into
buckets, and one bucket is sorted at a time: by the first ``COVER`` bytes, and
where those tie, by the precomputed ranks of a difference-cover sample of the
bucket's positions. For any two suffixes there is a shift below ``COVER`` that
takes both to sampled positions, so ranks always settle what the bytes leave
open, however long the tie, in memory bounded by the bucket. Neighbours in the
sorted order that agree on ``length`` bytes are repeats.

A bucket takes the suffixes whose first ``length`` bytes have the same *anchor*:
the leftmost place in them with the smallest hash of ``GRAM`` bytes. Equal
strings have equal anchors at equal distances, so they share a bucket, and an
anchor that occurs once in the corpus can't belong to a repeat. A first exchange
therefore counts anchors (one for some 35 bytes, packed), and only the
surroundings of repeated ones reach the buckets. Equal surroundings are compared
byte for byte and only the earliest is sorted.

An anchor that stands in very many different surroundings would fill one bucket.
Those that a sample shows to be so frequent are not counted, and the strings
around them are dealt one by one, by the hash of all their bytes: different
strings part, and equal ones mostly end in the task that reads them. The sample
only balances the buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import as_bytes, keyed_texts, pieces, spread
from millrace.llm.substring import META, META_NAMES, frequent, marks_of, numbered, pack, rolling, sliding_least, unpack

#: Period of the difference cover: suffixes are compared by so many bytes before ranks decide.
COVER = 32
#: Bytes whose hash makes an anchor.
GRAM = 32
#: Least number of buckets, and bytes of text for each beyond.
BUCKETS, BUCKET_BYTES = 256, 8 << 20
#: Windows that are hashed at once.
BLOCK = 1 << 20
#: Surroundings of hot anchors that a task remembers, to settle their repeats itself; those beyond meet in the buckets.
REMEMBERED = 1 << 15

BASE = 0x9E3779B97F4A7C15


def difference_cover(period: int) -> np.ndarray:
    """Residues so that every difference modulo ``period`` occurs between two of them: the first about sqrt(period), and steps of that size."""
    step = ceil(period**0.5)
    return np.unique(np.concatenate([np.arange(step), np.arange(0, period, step)]))


def shifts(period: int) -> np.ndarray:
    """[r, s] to the smallest shift that takes residues r and s into the difference cover together."""
    inside = np.zeros(period, bool)
    inside[difference_cover(period)] = True
    turned = np.stack([np.roll(inside, -k) for k in range(period)])  # [shift, residue]
    return (turned[:, :, None] & turned[:, None, :]).argmax(axis=0)


def words_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number in lexicographic order."""
    x = text.astype(np.uint64)
    for size in (1, 2, 4):
        x = (x[:-size] << np.uint64(8 * size)) | x[size:]
    return x


def dense(keys: list[np.ndarray]) -> np.ndarray:
    """Rank of each row of the keys (first key first), equal rows alike."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), np.int64)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def sort_bucket(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of their suffixes of ``text`` to at least ``depth`` bytes (deeper where cover ranks decide; what ties after that keeps its order).

    ``text`` must reach at least 4 * COVER + depth bytes beyond every start.
    """
    cover = np.flatnonzero(np.isin(np.arange(len(text) - COVER - 8) % COVER, difference_cover(COVER)))
    w = words_of(text)
    prefix = lambda at: [w[at + k] for k in range(0, COVER, 8)]
    both = np.concatenate([cover, starts])
    first = dense(prefix(both))
    name = np.zeros(len(text) + 8 * COVER, np.int64)  # by place; only sampled ones count
    name[cover] = first[: len(cover)] + 1
    reach = COVER
    while reach < depth:  # a sampled place plus COVER is sampled too, so names double their reach
        name[cover] = dense([name[cover], name[cover + reach]]) + 1
        reach *= 2
    lead = first[len(cover) :]
    order = np.argsort(lead, kind="stable")
    group = lead[order]
    at, residue = starts[order], starts[order] % COVER
    table = shifts(COVER)
    # Ranks at the shift of a residue with itself decide wherever all of a tie share their residue.
    cut = np.flatnonzero(np.diff(group, prepend=-1))
    size = np.diff(np.append(cut, len(group)))
    run = np.repeat(np.arange(len(cut)), size)
    mixed = (np.maximum.reduceat(residue, cut) != np.minimum.reduceat(residue, cut))[run] if len(cut) else np.empty(0, bool)
    place = np.zeros(len(group), np.int64)
    own = name[at + table[residue, residue]]
    alone = np.flatnonzero(~mixed)
    place[alone] = own[alone]
    # Elsewhere a suffix's place is the number of those before it, counted for each residue with the shift that suits the pair.
    for r in np.unique(residue[mixed]):
        mine = np.flatnonzero(mixed & (residue == r))
        for s in np.unique(residue[mixed]):
            other = np.flatnonzero(mixed & (residue == s))
            shift = table[r, s]
            code = lambda x: (run[x] << 34) | name[at[x] + shift]
            ranked = np.sort(code(other))
            low = np.searchsorted(ranked, run[mine] << 34)
            place[mine] += np.searchsorted(ranked, code(mine)) - low
    return starts[order[np.lexsort((place, run))]]


def anchors(text: np.ndarray, ends: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of (document, hash, anchor, first and last start) of all runs of windows that share an anchor; ``ends`` are the documents' ends in ``text``."""
    gram = min(GRAM, length)
    for block in range(0, max(len(text) - length + 1, 0), BLOCK):
        part = text[block : block + BLOCK + length - 1]
        hashes = spread(rolling(part.astype(np.uint64) + np.uint64(1), gram, BASE))
        key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        least = (sliding_least(key, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = np.arange(len(least))
        doc = np.searchsorted(ends, start + block, side="right")
        whole = start + block + length <= ends[doc]
        start, anchor, doc = start[whole], least[whole], doc[whole]
        if not len(start):
            continue
        new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(doc) != 0) | (np.diff(start) != 1)]))
        last = np.concatenate([new[1:] - 1, [len(start) - 1]])
        yield doc[new], hashes[anchor[new]], anchor[new] + block, start[new] + block, start[last] + block


def laid_out(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a piece, the documents' begins and ends in them, their ids and marks."""
    texts = as_bytes(piece.column("text"))
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size)
    return np.frombuffer(b"".join(texts), np.uint8), ends - size, ends, np.asarray(piece.column("doc_id")), marks_of(texts)


def by_document(doc: np.ndarray, mark: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(doc_id, mark, bytes of each column) of every document, values in the given order."""
    order = np.lexsort((mark, doc))
    doc, mark = doc[order], mark[order].astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero((np.diff(doc) != 0) | (np.diff(mark) != 0)) + 1, [len(doc)]]) if len(doc) else [0]
    for a, b in zip(cuts, cuts[1:]):
        yield int(doc[a]), int(mark[a]), *(c[order[a:b]].tobytes() for c in columns)


def hot_anchors(texts: DataFrame, length: int, size: int, buckets: int) -> np.ndarray:
    """The hashes, sorted, of anchors that are too frequent in a sample of ``doc_id, text`` for one of ``buckets``."""

    def keys_of(piece: pa.RecordBatch) -> Iterator[np.ndarray]:
        text, _, ends, _, _ = laid_out(piece)
        return (hashes for _, hashes, *_ in anchors(text, ends, length))

    return frequent(texts, size, buckets, keys_of)


def repeated_anchors(texts: DataFrame, length: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """(doc_id, mark, at array<binary>): the places (packed int64) of anchors that occur more than once in the corpus; those of ``hot`` ones, which pass by uncounted, among them."""
    width = 6  # bytes of a hash beside its bucket; a chance agreement only costs work

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            text, begins, ends, ids, marks = laid_out(piece)
            for doc, hashes, anchor, _, _ in anchors(text, ends, length):
                at = anchor - begins[doc]
                known = np.isin(hashes, hot)
                rows = [(int(spread(np.array([one], np.int64).view(np.uint64))[0] % np.uint64(buckets)), one, mark, None, places) for one, mark, places in by_document(ids[doc[known]], marks[doc[known]], at[known])]
                doc, hashes, at = doc[~known], hashes[~known], at[~known]
                bucket = (spread(hashes) % np.uint64(buckets)).astype(np.uint32)
                order = np.argsort(bucket, kind="stable")
                wide = hashes.view(np.uint8).reshape(-1, 8)[:, 8 - width :]
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]]) if len(order) else [0]
                rows += [(int(bucket[s[0]]), None, None, wide[s].tobytes(), pack(doc[s], at[s], ids, marks)) for s in (order[a:b] for a, b in zip(cuts, cuts[1:]))]
                yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=META_NAMES)

    def meet(found: pa.Table) -> pa.Table:
        counted = pa.compute.is_valid(found["hashes"])
        out = [tuple(row.values()) for row in found.filter(pa.compute.invert(counted)).select(["doc_id", "mark", "meta"]).to_pylist()]
        hashes, parts = [], []
        for row in found.filter(counted).select(["hashes", "meta"]).to_pylist():
            full = np.zeros((len(row["hashes"]) // width, 8), np.uint8)
            full[:, 8 - width :] = np.frombuffer(row["hashes"], np.uint8).reshape(-1, width)
            hashes.append(full.view(np.uint64).reshape(-1))
            parts.append(unpack(row["meta"]))
        if hashes:
            key = np.concatenate(hashes)
            doc, mark, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(key)
            same = key[order[1:]] == key[order[:-1]]
            twice = np.zeros(len(key), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            out += by_document(doc[twice], mark[twice], at[twice])
        return pa.table({"doc_id": pa.array([x[0] for x in out], pa.int64()), "mark": pa.array([x[1] for x in out], pa.int64()), "at": pa.array([x[2] for x in out], pa.binary())})

    met = texts.mapInArrow(emit, META).groupBy("bucket").applyInArrow(meet, "doc_id long, mark long, at binary")
    return met.groupBy("doc_id", "mark").agg(F.collect_list("at").alias("at"))


#: Surroundings of anchors on their way to a bucket: their bytes one after another, and for each anchor hash, document, mark, place of its first start, bytes before the anchor and number of starts.
SURROUNDINGS = "bucket int, doc_id long, mark long, text binary, meta binary"
FIELDS = [("hash", np.uint64), ("doc", np.int64), ("mark", np.int64), ("at", np.int64), ("before", np.int64), ("starts", np.int64)]


def earliest(key: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True at the smallest (doc, at) of every key, and wherever that occurs again (repeated rows)."""
    order = np.lexsort((at, doc, key))
    out = np.zeros(len(key), bool)
    if len(key):
        new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
        head = order[new][np.cumsum(new) - 1]
        out[order] = (doc[order] == doc[head]) & (at[order] == at[head])
    return out


def named(data: bytes, begin: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A number for each [begin, end) of ``data``, the same for equal bytes with the anchor at the same place in them."""
    seen: dict[tuple[int, bytes], int] = {}
    return np.fromiter((seen.setdefault((p, data[a:b]), len(seen)) for a, b, p in zip(begin.tolist(), end.tolist(), before.tolist())), np.int64, len(begin))


def surroundings(known: DataFrame, length: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """``SURROUNDINGS`` rows for the repeated anchors of ``doc_id, mark, text, at``; ``hot`` ones have one for every string around them. Of equal surroundings in a piece only the earliest goes on; the others' bytes are repeats and return as they are (``text`` null, ``meta`` packed begin and end)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered: dict[tuple[int, bytes], tuple[int, int]] = {}
        for piece in pieces(batches, "text", 2 << 20):
            text, begins, ends, ids, marks = laid_out(piece)
            wanted = [np.frombuffer(b"".join(x), np.int64) + b for x, b in zip(piece.column("at").to_pylist(), begins)]
            wanted = np.sort(np.concatenate(wanted))
            found = [[] for _ in range(5)]
            for block in anchors(text, ends, length):
                near = np.searchsorted(wanted, block[2])
                hit = wanted[np.minimum(near, len(wanted) - 1)] == block[2]
                for into, column in zip(found, block):
                    into.append(column[hit])
            if not found[0]:
                continue
            data, rows = text.tobytes(), []

            def settled(doc: np.ndarray, low: np.ndarray, high: np.ndarray, again: np.ndarray) -> None:
                doc, low, high = doc[again], low[again], high[again]
                for one, mark, begin, end in by_document(ids[doc], marks[doc], low - begins[doc], high + length - begins[doc]):
                    rows.append((int(spread(np.array([one], np.int64).view(np.uint64))[0] % np.uint64(buckets)), one, mark, None, begin + end))

            def distinct(doc: np.ndarray, hashes: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
                first = earliest(named(data, low, high + length, anchor - low), ids[doc], low - begins[doc])
                settled(doc, low, high, ~first)
                return doc[first], hashes[first], anchor[first], low[first], high[first]

            doc, hashes, anchor, low, high = distinct(*map(np.concatenate, found))
            common = np.isin(hashes, hot)
            if common.any():
                # Of what the task has met before, only an earlier place goes on.
                before = np.zeros(len(doc), bool)
                for k in np.flatnonzero(common).tolist():
                    key, place = (int(anchor[k] - low[k]), data[low[k] : high[k] + length]), (int(ids[doc[k]]), int(low[k] - begins[doc[k]]))
                    if key not in remembered and len(remembered) == REMEMBERED:
                        continue
                    before[k] = remembered.setdefault(key, place) < place
                    remembered[key] = min(remembered[key], place)
                settled(doc, low, high, before)
                # The others become single strings, each under the hash of its bytes.
                one = np.flatnonzero(common & ~before)
                n = high[one] - low[one] + 1
                start = np.repeat(low[one], n) + within(n)
                own = np.fromiter((xxhash.xxh3_64_intdigest(data[a : a + length]) for a in start.tolist()), np.uint64, len(start))
                single = distinct(np.repeat(doc[one], n), own, np.repeat(anchor[one], n), start, start)
                doc, hashes, anchor, low, high = (np.concatenate([x[~common], y]) for x, y in zip((doc, hashes, anchor, low, high), single))
            bucket = (spread(hashes) % np.uint64(buckets)).astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(order)]]) if len(order) else [0]
            pressed = zstandard.ZstdCompressor(level=1)
            for a, b in zip(cuts, cuts[1:]):
                s = order[a:b]
                columns = [hashes[s], ids[doc[s]], marks[doc[s]], low[s] - begins[doc[s]], anchor[s] - low[s], high[s] - low[s] + 1]
                meta = b"".join(c.astype(kind).view(np.uint8).reshape(len(s), -1).T.tobytes() for c, (_, kind) in zip(columns, FIELDS))
                rows.append((int(bucket[a]), None, None, pressed.compress(b"".join([data[i:j] for i, j in zip(low[s].tolist(), (high[s] + length).tolist())])), pressed.compress(meta)))
            yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=[x.split()[0] for x in SURROUNDINGS.split(", ")])

    return known.mapInArrow(emit, SURROUNDINGS)


def repeats_in_bucket(parts: list[tuple[bytes, bytes]], length: int) -> tuple[np.ndarray, ...]:
    """(doc, mark, begin, end) of byte runs that strings of ``length`` bytes with an earlier equal cover, from one bucket's surroundings."""
    opened = zstandard.ZstdDecompressor()
    fields, texts = [[] for _ in FIELDS], []
    for text, meta in parts:
        raw = np.frombuffer(opened.decompress(meta), np.uint8)
        n, cut = len(raw) // sum(np.dtype(k).itemsize for _, k in FIELDS), 0
        for into, (_, kind) in zip(fields, FIELDS):
            size = np.dtype(kind).itemsize * n
            into.append(np.ascontiguousarray(raw[cut : cut + size].reshape(-1, n).T).view(kind).reshape(-1))
            cut += size
        texts.append(opened.decompress(text))
    hashes, doc, mark, at, before, starts = map(np.concatenate, fields)
    data = b"".join(texts)
    size = starts - 1 + length
    begin = np.cumsum(size) - size
    first = earliest(named(data, begin, begin + size, before), doc, at)
    out = [(doc[~first], mark[~first], at[~first], (at + size)[~first])]
    # Only anchors that occur in different surroundings are left to sort.
    keep = np.flatnonzero(first)
    order = np.argsort(hashes[keep], kind="stable")
    keep = keep[order]
    same = hashes[keep[1:]] == hashes[keep[:-1]]
    shared = np.zeros(len(keep), bool)
    shared[1:] |= same
    shared[:-1] |= same
    keep = keep[shared]
    if len(keep):
        # A slot for each: anchors stand on multiples of COVER, so equal strings have equal residues and long ties need one shift.
        left = -(-(length - 1) // COVER) * COVER
        slot = left + -(-(2 * length) // COVER) * COVER
        text = np.zeros(len(keep) * slot + 8 * COVER + length, np.uint8)
        source = np.repeat(begin[keep], size[keep]) + within(size[keep])
        text[np.repeat(np.arange(len(keep)) * slot + left - before[keep], size[keep]) + within(size[keep])] = np.frombuffer(data, np.uint8)[source]
        where = np.repeat(np.arange(len(keep)) * slot + left - before[keep], starts[keep]) + within(starts[keep])
        owner = np.repeat(np.arange(len(keep)), starts[keep])
        back = np.full(len(keep) * slot, -1, np.int64)
        back[where] = owner
        ordered = sort_bucket(text, where, length)
        alike = np.ones(len(ordered) - 1, bool)
        w = words_of(text)
        for k in [*range(0, length - 7, 8), length - 8]:
            alike &= w[ordered[1:] + k] == w[ordered[:-1] + k]
        run = np.cumsum(np.concatenate([[0], ~alike]))
        whose = keep[back[ordered]]
        start = at[whose] + (ordered - (back[ordered] * slot + left - before[whose]))
        later = ~earliest(run, doc[whose], start)
        out.append((doc[whose[later]], mark[whose[later]], start[later], start[later] + length))
    return tuple(np.concatenate(c) for c in zip(*out))


def within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each run of the given sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs that [begin, end) intervals cover."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(begin[1:] > reach[:-1]) + 1
    return begin[np.concatenate([[0], new])], reach[np.concatenate([new - 1, [len(reach) - 1]])]


def runs_of(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs from rows of packed begins followed by as many ends."""
    both = [np.frombuffer(x, np.int64).reshape(2, -1) for x in packed]
    return merged(*np.concatenate(both, axis=1))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans array<struct<begin, end>>, kept binary): every document without the bytes that a string of ``length`` (8 or more) bytes covers which also starts earlier, in a smaller doc_id or before in the same document.

    ``spans`` are the maximal removed runs. Strings are judged on the input and
    never cross documents. A null text is empty. Rows with a null doc_id lose
    nothing and take nothing. Rows that share a doc_id are told apart by their
    texts; of equal strings at one place in both, both count as first. Repeated
    rows give repeated rows, an empty table an empty one.
    """
    if length < 8:
        raise ValueError("length must be 8 or more")
    texts = numbered(keyed_texts(docs, doc_id, text))
    size = docs.select(F.sum(F.octet_length(text))).head()[0] or 0
    buckets = max(BUCKETS, ceil(size / BUCKET_BYTES))
    # Both joins below take the same rows and columns of this side, so Spark shuffles the texts once and reads them twice.
    keyed = texts.filter("doc_id is not null")
    hot = hot_anchors(keyed.select("doc_id", "text"), length, size, buckets)
    repeated = repeated_anchors(keyed.select("doc_id", "text"), length, buckets, hot)
    known = keyed.join(repeated, ["doc_id", "mark"]).select("doc_id", "mark", "text", "at")

    def meet(found: pa.Table) -> pa.Table:
        rows = [(r["doc_id"], r["mark"], r["meta"]) for r in found.select(["doc_id", "mark", "text", "meta"]).filter(pa.compute.is_null(found["text"])).to_pylist()]
        parts = [(r["text"], r["meta"]) for r in found.select(["text", "meta"]).filter(pa.compute.is_valid(found["text"])).to_pylist()]
        if parts:
            doc, mark, begin, end = repeats_in_bucket(parts, length)
            for one, m, b, e in by_document(doc, mark, begin, end):
                b, e = runs_of([b + e])
                rows.append((one, m, b.tobytes() + e.tobytes()))
        return pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "mark": pa.array([r[1] for r in rows], pa.int64()), "runs": pa.array([r[2] for r in rows], pa.binary())})

    found = surroundings(known, length, buckets, hot).groupBy("bucket").applyInArrow(meet, "doc_id long, mark long, runs binary")
    runs = found.groupBy("doc_id", "mark").agg(F.collect_list("runs").alias("runs"))
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            spans, kept, gone, texts = [], [], [], as_bytes(piece.column("text"))
            for t, packed in zip(texts, piece.column("runs").to_pylist()):
                removed = list(zip(*(x.tolist() for x in runs_of(packed)))) if packed else []
                edges = [0, *(x for pair in removed for x in pair), len(t)]
                kept.append(b"".join([t[a:b] for a, b in zip(edges[::2], edges[1::2])]) if removed else t)
                gone.append(len(t) - len(kept[-1]))
                spans.append([{"begin": a, "end": b} for a, b in removed])
            yield pa.record_batch([piece.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    joined = keyed.join(runs, ["doc_id", "mark"], "left").select("doc_id", "text", "runs")
    nameless = texts.filter("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<binary>").alias("runs"))
    return joined.unionByName(nameless).mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<begin:bigint,end:bigint>>, kept binary")
