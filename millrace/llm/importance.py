"""Importance resampling towards a target distribution, over a dictionary of distinct features.

Features are the single words and the pairs of consecutive words of a text, as
strings. Texts are cut piece by piece, some MB each: a piece is a row of its
distinct words and its texts as their numbers. From it its distinct features are
dealt, as strings with their counts, by a hash. So a task has a range of all features of
source and target, whichever pieces they come from: there every distinct string
is counted over both corpora and hashed to its bucket once. Summed up, the
ranges give the counts of all buckets and so their gains; the buckets of its
features return to each piece, where gains meet the feature counts of the
documents. Texts never travel, and no task holds more than a piece or a range.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import chain
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.tables import in_order
from millrace.llm.bpe import opened, squeezed
from millrace.llm.common import as_bytes, bucketed, dropped, partitions, pieces, spread, written

#: Bytes of text in a piece, unless one text has more.
PIECE = 8 << 20
#: Bytes of text that are cut into words at once.
PART = 2 << 20
#: Words of text whose features are counted at once.
PART_WORDS = 1 << 18
#: Bytes of input for each range of features.
RANGE = 16 << 20
#: Feature hashes fall into so many buckets.
BUCKETS = 10_000
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20

#: A-Z in lower case; every other ASCII character but a letter or digit parts words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

#: A piece: its documents, the number of words of each, all their words as numbers, and the words, one a line.
PIECES = "piece long, target boolean, docs array<long>, n_words binary, numbers binary, words binary"
#: The features of a piece in one range: their numbers as steps, their counts, and their strings, one a line.
FEATURES = "range int, piece long, target boolean, places binary, counts binary, strings binary"
#: What a range writes: the buckets of each piece's features, and its counts of all buckets.
FOUND = "piece long, places binary, buckets binary, source binary, target binary"


def names_of(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.split(", ")]


def table_of(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
    return pa.record_batch([pa.array([r[k] for r in rows], kinds[x.split()[1]]) for k, x in enumerate(ddl.split(", "))], names=names_of(ddl))


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``, which have these sizes."""
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[ends])


def pairs_of(flat: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """The places in ``flat``, the words of texts that have ``n_words`` each, from which a pair of one text begins."""
    inside = np.ones(len(flat), bool)
    ends = np.cumsum(n_words)
    inside[ends[n_words > 0] - 1] = False
    return np.flatnonzero(inside)


def parts_of(n_words: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of runs of documents that have some ``PART_WORDS`` words, or one document more."""
    cuts = np.flatnonzero(np.diff(np.cumsum(n_words) // PART_WORDS)) + 1
    edges = [0, *cuts.tolist(), len(n_words)]
    return list(zip(edges, edges[1:]))


def distinct_pairs(flat: np.ndarray, n_words: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of consecutive words, sorted, as numbers below ``known`` squared; of every pair in the texts the place it begins at, and which it is."""
    at = pairs_of(flat, n_words)
    coded = pa.array(flat[at].astype(np.int64) * known + flat[np.minimum(at + 1, len(flat) - 1)]).dictionary_encode()
    pairs = np.asarray(coded.dictionary)
    order = np.argsort(pairs)
    rank = np.empty(len(pairs), np.int32)
    rank[order] = np.arange(len(pairs), dtype=np.int32)
    return pairs[order], at, rank[np.asarray(coded.indices)]


def cut_pieces(batches: Iterator[pa.RecordBatch], target: bool) -> Iterator[pa.RecordBatch]:
    """``PIECES`` rows of (doc_id, text) batches."""

    def piece(held: list[tuple[list, np.ndarray, np.ndarray]], words: list[bytes]) -> pa.RecordBatch:
        flat = np.concatenate([x[2] for x in held])
        # The most frequent words take the smallest numbers, which pack best.
        order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
        number = np.empty(len(words), np.uint32)
        number[order] = np.arange(len(words), dtype=np.uint32)
        listed = zstandard.compress(b"\n".join([words[k] for k in order.tolist()]), 6)
        ids = list(chain.from_iterable(x[0] for x in held))
        return table_of([(uuid.uuid4().int >> 65, target, ids, squeezed(np.concatenate([x[1] for x in held])), squeezed(number[flat]), listed)], PIECES)

    def fresh() -> tuple[defaultdict, list, int]:
        number: defaultdict = defaultdict()
        number.default_factory = number.__len__  # a new word takes the next number
        return number, [], 0

    number, held, size = fresh()
    for part in pieces(batches, "text", PART):
        said = [t.translate(WORD_BYTES).split() for t in as_bytes(part.column("text"))]
        flat = np.fromiter(map(number.__getitem__, chain.from_iterable(said)), np.int32)
        held.append((part.column("doc_id").to_pylist(), np.array([len(x) for x in said], np.int64), flat))
        del said
        size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
        if size >= PIECE:
            yield piece(held, list(number))
            number, held, size = fresh()
    if held:
        yield piece(held, list(number))


def lines_of(data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    return raw.split(b"\n") if raw else []


def dealt_features(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    """``FEATURES`` rows of ``PIECES`` rows. The features of a piece are numbered: first its words, then its distinct pairs."""
    for row in (r for batch in batches for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
        words, flat, n_words = lines_of(row["words"]), opened(row["numbers"]), opened(row["n_words"]).astype(np.int64)
        known = max(len(words), 1)
        pairs, _, which = distinct_pairs(flat, n_words, known)
        counts = np.concatenate([np.bincount(flat, minlength=len(words)), np.bincount(which, minlength=len(pairs))])
        first, second = pairs // known, pairs % known
        single = pa.array(words, pa.binary())
        strings = pa.concat_arrays([single, pc.binary_join_element_wise(single.take(pa.array(first)), single.take(pa.array(second)), b" ")])
        # Equal strings have equal hashes in every piece; they only decide which range a feature goes to.
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        ranged = np.concatenate([hashed, spread(hashed[first] * np.uint64(31) + hashed[second])]) % np.uint64(ranges)
        by = np.argsort(ranged, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(ranged[by])) + 1).tolist(), len(by)] if len(by) else [0]
        rows = []
        for a, b in zip(cuts, cuts[1:]):
            mine = by[a:b]
            data = pc.binary_join(pa.ListArray.from_arrays([0, b - a], strings.take(pa.array(mine))), b"\n")[0].as_py()
            rows.append((int(ranged[mine[0]]), row["piece"], row["target"], squeezed(np.diff(mine, prepend=0)), squeezed(counts[mine]), zstandard.compress(data, 6)))
        del words, flat, which, counts, first, second, single, strings, hashed, ranged, by, pairs
        for k in range(0, len(rows), 64):
            yield table_of(rows[k : k + 64], FEATURES)
        del rows
        pa.default_memory_pool().release_unused()


def hashed_once(found: pa.Table) -> pa.Table:
    """``FOUND`` rows of one range: its distinct strings are counted over both corpora and hashed once."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    pieces_ = []
    for r in found.select(["piece", "target", "places", "counts", "strings"]).to_pylist():
        mine = np.fromiter(map(number.__getitem__, lines_of(r["strings"])), np.int64)
        pieces_.append((r["piece"], r["target"], r["places"], mine, opened(r["counts"]).astype(np.int64)))
    bucket = np.fromiter(map(zlib.crc32, number), np.int64, len(number)) % BUCKETS
    totals = {side: np.zeros(len(bucket), np.int64) for side in (False, True)}
    rows: list[tuple] = []
    for piece, target, places, mine, counts in pieces_:
        totals[target][mine] += counts  # a piece has each string once
        if not target:
            rows.append((piece, places, squeezed(bucket[mine]), None, None))
    in_bucket = [np.bincount(bucket, totals[side], BUCKETS).astype(np.int64).tobytes() for side in (False, True)]
    rows.append((None, None, None, *in_bucket))
    return pa.Table.from_batches([table_of(rows, FOUND)])


def bucket_counts(found: DataFrame) -> DataFrame:
    """(bucket, s, t): the features of source and target in every bucket."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for side in (0, 1):
                for x in batch.column(side).to_pylist():
                    both[side] += np.frombuffer(x, np.int64)
        yield pa.record_batch([pa.array(np.arange(BUCKETS), pa.int32()), pa.array(both[0]), pa.array(both[1])], names=["bucket", "s", "t"])

    each = found.filter("piece is null").select("source", "target").mapInArrow(unpack, "bucket int, s long, t long")
    return each.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))


def gains(counts: DataFrame) -> np.ndarray:
    """By bucket, a thousand times the logarithm of its share of the target over its share of the source, rounded down; ``BUCKETS`` numbers on the driver."""
    of = {r.bucket: (r.s, r.t) for r in counts.collect()}
    s, t = (np.array([of.get(b, (0, 0))[side] for b in range(BUCKETS)], np.float64) for side in (0, 1))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weights(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row: the mean of its features' gains, rounded down; without words 0.

    A null text is empty. Repeated rows, and rows without a doc_id, count and
    are returned like any other. Documents with words no other has take part:
    their features are counted too. An empty target or an empty table of
    documents is a corpus without features. Other columns play no part.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), F.col(target_text).cast("string").alias("text"))
    size = source.select(F.sum(F.octet_length("text"))).head()[0] or 0
    ranges = max(2 * partitions(spark), ceil(size / RANGE))
    # Tables in buckets by piece, so that all readers see the same pieces, also after an executor is lost, and these meet without a shuffle.
    cut = bucketed(source.mapInArrow(partial(cut_pieces, target=False), PIECES).unionByName(wanted.mapInArrow(partial(cut_pieces, target=True), PIECES)), "piece")
    found = bucketed(cut.mapInArrow(partial(dealt_features, ranges=ranges), FEATURES).groupBy("range").applyInArrow(hashed_once, FOUND), "piece")
    gain = gains(bucket_counts(found))

    def joined(texts: pa.Table, buckets: pa.Table) -> pa.Table:
        places = [np.cumsum(opened(x), dtype=np.int64) for x in buckets["places"].to_pylist()]
        gain_of = np.zeros(sum(map(len, places)), np.int64)
        for at, x in zip(places, buckets["buckets"].to_pylist()):
            gain_of[at] = gain[opened(x)]
        n, out = len(gain_of), []
        for r in texts.to_pylist():  # one
            flat, n_words = opened(r["numbers"]).astype(np.int64), opened(r["n_words"]).astype(np.int64)
            known = len(lines_of(r["words"]))
            _, at, which = distinct_pairs(flat, n_words, max(known, 1))
            ends, pair_ends, total = np.cumsum(n_words), np.cumsum(np.maximum(n_words - 1, 0)), []
            # Some documents at a time: the counts of their distinct features, times the gains of these.
            for a, b in parts_of(n_words):
                low, first = ends[a] - n_words[a], pair_ends[a] - max(n_words[a] - 1, 0)
                document = np.repeat(np.arange(b - a), n_words[a:b])
                key = np.concatenate([document * n + flat[low : ends[b - 1]], document[at[first : pair_ends[b - 1]] - low] * n + known + which[first : pair_ends[b - 1]]])
                key, times = np.unique(key, return_counts=True)
                total.append(sums(gain_of[key % max(n, 1)] * times, np.bincount(key // max(n, 1), minlength=b - a)))
            n_features = np.maximum(2 * n_words - 1, 0)
            weight = np.concatenate(total) // np.maximum(n_features, 1)
            out.append(pa.record_batch([pa.array(r["docs"], pa.int64()), pa.array(n_words), pa.array(n_features), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"]))
        return pa.Table.from_batches(out)

    texts = cut.filter("not target").select("piece", "docs", "n_words", "numbers", "words").groupBy("piece")
    weighed = texts.cogroup(found.filter("piece is not null").select("piece", "places", "buckets").groupBy("piece")).applyInArrow(joined, "doc_id long, n_words long, n_features long, weight long")
    return weighed


def luck(doc_id: Column, seed: int) -> Column:
    """A Gumbel variate, a thousandfold and rounded down, from the SHA-256 of seed and doc_id; a null doc_id is the empty string."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; ``rank`` numbers the drawn ones by their score, from 1, and is null for the rest.

    Drawn are ``percent`` of the rows with ``LEAST_WORDS`` words or more, rounded
    down: those of the highest scores, of equal scores the smaller doc_id (null
    first), of equal ids the one with fewer features, then the smaller weight;
    rows alike in all of that may be drawn either way. The order is cut into
    ranges, none of which is the whole. Nulls, empty and repeated rows are as in
    ``weights``.
    """
    scored = weights(docs, target, doc_id, text, target_text).withColumn("score", F.col("weight") + luck(F.col("doc_id"), seed))
    # The eligible come first, so their places are ranks.
    eligible = F.col("n_words") >= LEAST_WORDS
    placed = in_order(scored, [eligible.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "n_features", "weight"])
    drawn = (placed.filter(eligible).count() * percent) // 100
    return placed.withColumn("rank", F.when(eligible & (F.col("place") < drawn), F.col("place") + 1)).drop("place")
