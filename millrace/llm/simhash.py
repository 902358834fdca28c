"""Near-duplicate detection by SimHash fingerprints, linked with pigeonring filtering.

A fingerprint of ``BITS`` bits is cut into ``segments`` that stand in a ring. If
two fingerprints differ in at most ``limit`` bits, there is a segment from which
every chain of consecutive segments stays within its proportional budget: k
segments differ in at most floor(k * limit / segments) bits (the pigeonring
principle). Fingerprints therefore meet on the chain of the first ``CHAIN``
segments, longer chains prune the meetings, and only what is left is compared
in full.

``keep_similar`` is for documents at a similarity, not at a number of bits: what
few differing bits or an equal band of min-hashes brings together is compared by
its whole sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import as_bytes, dropped, partitions, pieces, salted_join, spread, unused, written

BITS = 64
SEED = 42
#: Bands and min-hashes in each: two texts at similarity s share a band with chance 1 - (1 - s^6)^20, 0.998 at 0.8.
BANDS, ROWS = 20, 6
#: Shingles that one comparison takes at once.
AT_ONCE = 1 << 20
#: Bytes of text that one task compares with each other; larger groups are compared in blocks.
BLOCK = 16 << 20
#: Texts of a large group that every block meets first.
LEADERS = 16
#: A value of a start segment is hot from this multiple of the mean on.
HOT = 16


def fingerprint(texts: list[bytes], words: int) -> np.ndarray:
    """Unsigned 64-bit SimHash of each text over its shingles of ``words`` words, repeats included.

    A-Z is lower-cased. A text with fewer words is one shingle; one without
    words has fingerprint zero. A bit is set if it is set in over half of the
    shingles' XXH64.
    """
    out = np.zeros(len(texts), dtype=np.uint64)
    for at, text in enumerate(texts):
        out[at] = simhash_of(shingle_hashes(text, words))
    return out


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every shingle in order, repeats included."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    shingles = map(b" ".join, zip(*(found[k:] for k in range(words)))) if len(found) >= words else [b" ".join(found)]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64)


def simhash_of(hashes: np.ndarray) -> np.uint64:
    counts = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(hashes), 4096):
        counts += np.unpackbits(hashes[part : part + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0]


def fingerprints(rows: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp long) for every row of (doc_id, text_hash, text); a null text has no words, so fingerprint zero. The sign bit of ``fp`` is its 64th bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            found = fingerprint(as_bytes(piece.column("text")), words).view(np.int64)
            yield pa.record_batch([piece.column("doc_id"), piece.column("text_hash"), pa.array(found)], names=["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def segments(limit: int) -> list[int]:
    """Masks of the limit + 1 segments of a fingerprint."""
    edges = [BITS * k // (limit + 1) for k in range(limit + 2)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def ring(limit: int, chain: int) -> list[tuple[int, list[int], list[tuple[int, int]]]]:
    """For every start segment: its number, the masks of the bits on which linked fingerprints may meet, and the (mask, budget) of every longer chain.

    There are limit + 1 segments, so a chain of k segments may differ in k - 1
    bits: its first segment not at all. Each later segment of the chain is
    halved; a chain of k segments with k - 1 differing bits has at least k - 1
    equal ones among its 2 (k - 1) halves. One mask for every way in which the
    first ``chain`` - 1 equal halves can fall covers all cases.
    """
    m = limit + 1
    edges = [BITS * k // m for k in range(m + 1)]
    part = lambda a, b: ((1 << b) - 1) ^ ((1 << a) - 1)
    segment = [part(edges[k], edges[k + 1]) for k in range(m)]
    halves = [(part(edges[k], middle := (edges[k] + edges[k + 1]) // 2), part(middle, edges[k + 1])) for k in range(m)]
    out = []
    for start in range(m):
        turn = [(start + k) % m for k in range(m)]
        flat = [half for k in turn[1:chain] for half in halves[k]]
        masks = []
        for chosen in combinations(range(len(flat)), chain - 1):
            if all(sum(c < 2 * k for c in chosen) >= k for k in range(1, chain)):
                masks.append(segment[start] | sum(flat[c] for c in chosen))
        budgets = [(sum(segment[k] for k in turn[: length]), length - 1) for length in range(2, m + 1)]
        out.append((start, masks, budgets))
    return out


def spanning(found: np.ndarray, budgets: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links that join up all of ``found`` (distinct fingerprints that met) which pass every chain's budget, the last of which is the full check.

    A search through the links: what one fingerprint reaches leaves the pool, so
    a dense group costs its size, and at most one link is given for each member.
    """
    pool, edges = found, []
    while len(pool) > 1:
        queue, pool = [pool[0]], pool[1:]
        while queue and len(pool):
            here = queue.pop()
            near = np.arange(len(pool))
            for mask, budget in budgets:
                near = near[np.bitwise_count((pool[near] ^ here) & np.uint64(mask)) <= budget]
            if len(near):
                reached = pool[near]
                edges += [(int(here), int(x)) for x in reached]
                queue += list(reached)
                pool = np.delete(pool, near)
    return edges


def links(prints: DataFrame, limit: int = 4, chain: int = 3) -> DataFrame:
    """(a, b): enough pairs of distinct fingerprints at ``limit`` or fewer differing bits to connect all that are so linked.

    ``chain`` (2 to limit + 1) sets how many bits fingerprints must share to
    meet: with five segments 2, 3, 4 and 5 make 10, 25, 70 and 210 rows for each
    fingerprint that meet on 19, 26, 32 and 39 bits. The result is the same.
    Where a start segment has one value far too often, a chain longer by two is taken.
    """
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    bits = lambda mask: F.col("fp").bitwiseAND(F.lit(signed(mask)))
    plans = [ring(limit, chain), ring(limit, min(limit + 1, chain + 2))]
    tags = [(start, mask) for plan in plans for start, masks, _ in plan for mask in masks]
    budgets = {start: b for start, _, b in plans[0]}
    # All that may meet from a start has its segment's value there. There are at most 2^13 values of each of five
    # segments, so their counts are few; where one is hot, as in a large group of near copies, longer chains deal it out.
    firsts = F.array(*(F.struct(F.lit(start).alias("start"), bits(edge).alias("value")) for start, edge in enumerate(segments(limit))))
    counted = prints.select(F.inline(firsts)).groupBy("start", "value").agg(F.count("*").alias("n"))
    mean = max(1, prints.count() >> (BITS // (limit + 1)))
    hot = sorted(counted.filter(F.col("n") > HOT * mean).select("start", "value").collect())
    keys = []
    for start, edge in enumerate(segments(limit)):
        mine = [v for s, v in hot if s == start]
        of = lambda plan, first: F.array(*(F.struct(F.lit(n).alias("tag"), bits(mask).alias("value")) for n, (s, mask) in enumerate(tags) if s == start and (n < first) == (plan == 0)))  # noqa: B023,E731
        first = sum(len(masks) for _, masks, _ in plans[0])
        keys.append(F.when(bits(edge).isin(mine), of(1, first)).otherwise(of(0, first)) if mine else of(0, first))
    met = prints.select("fp", F.inline(F.concat(*keys))).repartition(partitions(prints.sparkSession), "tag", "value").sortWithinPartitions("tag", "value", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, np.int64)] * 3

        def link(tag: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            turn = np.flatnonzero((tag[1:] != tag[:-1]) | (value[1:] != value[:-1])) + 1
            begin, end = np.concatenate([[0], turn]), np.concatenate([turn, [len(tag)]])
            edges = []
            for a, b in zip(begin[end - begin > 1], end[end - begin > 1]):
                edges += spanning(fp[a:b].view(np.uint64), budgets[tags[tag[a]][0]])
            both = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.record_batch([pa.array(both.min(axis=1)), pa.array(both.max(axis=1))], names=["a", "b"])

        for batch in batches:
            rows = [np.concatenate([h, np.asarray(batch.column(c), dtype=np.int64)]) for h, c in zip(held, ("tag", "value", "fp"))]
            # The last run may go on in the next batch.
            ends = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1])) if len(rows[0]) else []
            cut = ends[-1] + 1 if len(ends) else 0
            if cut:
                yield link(*(r[:cut] for r in rows))
            held = [r[cut:] for r in rows]
        if len(held[0]) > 1:
            yield link(*held)

    return met.select("tag", "value", "fp").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of the undirected ``edges`` (a, b) reaches.

    Every round a node takes the smallest label of its neighbours and then its
    label's own label, so labels travel twice as far each time. Rounds end when
    nothing changes; each is a written table.
    """
    spark = edges.sparkSession
    both = written(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))))
    labels = written(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")))
    if labels.isEmpty():
        return spark.createDataFrame([], "node long, label long")
    while True:
        near = salted_join(both, labels.select(F.col("node").alias("other"), F.col("label").alias("via")), ["other"]).groupBy("node").agg(F.min("via").alias("via"))
        once = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "via").alias("label"))
        twice = salted_join(once, labels.select(F.col("node").alias("label"), F.col("label").alias("jump")), ["label"], "left")
        after = written(twice.select("node", "was", F.least("label", F.coalesce("jump", "label")).alias("label")))
        dropped(labels)
        if after.filter("label <> was").isEmpty():
            dropped(both)
            return after.select("node", "label")
        labels = after


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, limit: int = 4, chain: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id that is reachable over fingerprints at ``limit`` or fewer differing bits.

    Copies meet in one fingerprint before any links are sought. Null texts and
    texts without words share fingerprint zero. Rows with a null doc_id take
    part; their id is null, and so is a component without any other. Repeated
    rows give repeated rows. An empty table gives an empty one.
    """
    found = judged(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("text_hash"), F.col(text).alias("text")), words, limit, chain)
    return found.select("doc_id", "fp", F.col("row.doc_id").alias("component_id"))


def judged(rows: DataFrame, words: int, limit: int, chain: int) -> DataFrame:
    """(doc_id, fp, row) for every row of (doc_id, text_hash, text): ``row`` is the first (no_id, doc_id, text_hash) of its component, those without an id last."""
    prints = written(fingerprints(rows, words=words))
    first = written(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")))
    found = components(links(first.select("fp"), limit, chain)).select(F.col("node").alias("fp"), "label")
    linked = first.join(found, "fp", "left").select("fp", "first", "label")
    whole = linked.filter("label is not null").groupBy("label").agg(F.min("first").alias("smallest"))
    class_of = salted_join(linked, whole, ["label"], "left").select("fp", F.coalesce("smallest", "first").alias("row"))
    return salted_join(prints, class_of, ["fp"]).select("doc_id", "fp", "row")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, limit: int = 4, chain: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component one row, with all its columns.

    A row is known by its id and its text, so each is judged by its own
    component, whatever other rows have its id or none. The row of the smallest
    doc_id stays, of several with it that of the smallest hash of the text; one
    without an id only if nothing in its component has one.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    kept = judged(rows, words, limit, chain).select(F.col("row.doc_id").alias("kept_id"), F.col("row.text_hash").alias("kept_hash")).distinct()
    return first_of(docs, kept, doc_id, text)


def sketches(rows: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, node, fp, bands) of every row of (doc_id, text_hash, text): ``node`` names the set of its shingles; a text without words has no bands."""
    r = np.random.default_rng(SEED)
    odd = r.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = r.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
    weigh = r.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            nodes, prints, bands = [], [], []
            for text in as_bytes(piece.column("text")):
                hashes = shingle_hashes(text, words)
                whole = np.unique(hashes)
                nodes.append(xxhash.xxh3_64_intdigest(whole.tobytes()))
                prints.append(simhash_of(hashes))
                mixed = spread(whole)[:, None]
                least = [(mixed[k : k + 4096] * odd + plus).min(axis=0) for k in range(0, len(whole), 4096)]
                in_band = (np.minimum.reduce(least).reshape(BANDS, ROWS) * weigh).sum(axis=1, dtype=np.uint64) if least else np.empty(0, np.uint64)
                bands.append(spread(in_band).view(np.int64))
            yield pa.record_batch(
                [piece.column("doc_id"), piece.column("text_hash"), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "node", "fp", "bands"],
            )

    return rows.mapInArrow(run, "doc_id long, text_hash long, node long, fp long, bands array<long>")


def similar_groups(sets: list[np.ndarray], similarity: float) -> list[int]:
    """For each set of shingles the number of its group: sets at ``similarity`` (shared of all) or more are linked, as ``spanning`` does."""
    sizes = np.array([len(s) for s in sets], np.int64)
    group, pool, n = np.full(len(sets), -1, np.int64), np.arange(len(sets)), 0
    while len(pool):
        queue, pool = [pool[0]], pool[1:]
        group[queue[0]] = n
        while queue and len(pool):
            here = queue.pop()
            mine, near = sets[here], pool[(sizes[pool] >= similarity * sizes[here] - 1e-9) & (similarity * sizes[pool] <= sizes[here] + 1e-9)]
            reached = []
            for part in np.split(near, np.flatnonzero(np.diff(np.cumsum(sizes[near]) // AT_ONCE)) + 1):
                full = part[sizes[part] > 0]
                # Only texts without words are as large as one without words, and all of them are alike.
                reached.append(part[sizes[part] == sizes[here]] if not len(mine) else full[:0])
                if len(mine) and len(full):
                    flat = np.concatenate([sets[k] for k in full])
                    hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
                    both = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(sizes[full])[:-1]]))
                    reached.append(full[both * (1 + similarity) >= similarity * (sizes[full] + len(mine)) - 1e-9])
            reached = np.concatenate(reached)
            group[reached] = n
            queue += reached.tolist()
            pool = pool[group[pool] < 0]
        n += 1
    return group.tolist()


def keep_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, limit: int = 4, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` without near copies: one row, with all its columns, of each group linked by texts that share ``similarity`` of their distinct shingles.

    Texts meet if their SimHash fingerprints differ in at most ``limit`` bits or
    if they share a band of min-hashes; what meets, directly or over others, is
    compared exactly, so a chance meeting drops nothing. A task compares
    ``block`` bytes of text or so (see ``classes_of``). Of a group the smallest
    doc_id stays, a null one only if there is no other; of several rows with it
    that of the smallest hash of the text. Null texts and texts without words
    are copies of each other. An empty table stays empty.
    """
    there = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    rows = written(sketches(there, words))
    nodes = written(rows.groupBy("node").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("row")))
    prints = written(nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("n")))
    of = lambda side: prints.select(F.col("fp").alias(side), F.col("first").alias(f"{side}_node"))
    close = salted_join(salted_join(links(prints.select("fp"), limit), of("a"), ["a"]), of("b"), ["b"]).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    same = salted_join(nodes.select("node", "fp"), prints.filter("n > 1").select("fp", "first"), ["fp"]).select(F.col("node").alias("a"), F.col("first").alias("b"))
    listed = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    shared = listed.groupBy("band", "value").agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    banded = salted_join(listed, shared, ["band", "value"]).select(F.col("node").alias("a"), "b")
    # A node's up to 21 meetings all join its smallest one; the others need be linked to that one only, which copies have in common.
    stars = same.unionByName(banded).groupBy("a").agg(F.array_sort(F.collect_set("b")).alias("met"))
    hubs = F.transform("met", lambda b: F.struct(F.when(b == F.col("met")[0], F.col("a")).otherwise(F.col("met")[0]).alias("a"), b.alias("b")))
    met = components(close.unionByName(stars.select(F.inline(hubs))).filter("a <> b").distinct())
    asked = met.join(nodes.select("node", "row.doc_id", "row.text_hash"), "node")
    taken = asked.select("node", "label", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    texts = there.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))).select("node", "label", "text").dropDuplicates(["node"])
    classes = classes_of(written(texts), words, similarity, block)
    kept = nodes.select("node", "row").join(classes, "node", "left").groupBy(F.coalesce("class", "node").alias("class")).agg(F.min("row").alias("row"))
    return first_of(docs, kept.select(F.col("row.doc_id").alias("kept_id"), F.col("row.text_hash").alias("kept_hash")), doc_id, text)


def classes_of(texts: DataFrame, words: int, similarity: float, block: int) -> DataFrame:
    """(node, class): the classes of linked texts among (node, label, text) rows, where only texts of one label can be linked; distinct nodes.

    A label of up to ``block`` bytes is compared in one task. A larger one is
    dealt into blocks. Each block first meets the label's ``LEADERS``, which
    joins up what most of a large group of near copies is: the main class. Texts
    outside it, dealt into blocks again, then meet all blocks of the label. So
    no link is missed, no task holds more than two blocks, and a group of near
    copies costs in proportion to its size.
    """

    def compare(table: pa.Table) -> pa.Table:
        node = np.asarray(table.column("node"), dtype=np.int64)
        group = np.array(similar_groups([np.unique(shingle_hashes(t, words)) for t in as_bytes(table.column("text").combine_chunks())], similarity))
        first = np.full(group.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, group, node)
        return pa.table({"node": node, "class": first[group]})

    made = "node long, class long"
    sizes = texts.groupBy("label").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("size"))
    sized = salted_join(texts, sizes, ["label"])
    large = written(sizes.filter(F.col("size") > block).select("label", F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    small = sized.filter(F.col("size") <= block).select("label", "node", "text").groupBy("label").applyInArrow(compare, made)
    if large.isEmpty():
        return small
    dealt = salted_join(texts, large, ["label"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = written(dealt)
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    place = Window.partitionBy("label").orderBy("node")  # Spark keeps the first rows before the shuffle
    leaders = dealt.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= LEADERS).select("label", "node", "text", every.alias("block"))
    met = dealt.select("label", "node", "text", "block").unionByName(leaders).dropDuplicates(["label", "block", "node"])
    linked = written(met.groupBy("label", "block").applyInArrow(compare, made).filter("node <> class").distinct())
    classes = nodes_of(dealt, components(linked.select(F.col("node").alias("a"), F.col("class").alias("b"))))
    main = classes.groupBy("label", "class").agg(F.count("*").alias("n")).groupBy("label").agg(F.max_by("class", F.struct("n", "class")).alias("main"))
    outside = salted_join(classes, main, ["label"]).filter("class <> main").select("node")
    others = written(dealt.join(outside, "node", "left_semi"))
    counts = others.groupBy("label").agg(F.ceil(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")) / block).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.greatest("parts", F.lit(1))).cast("int")
    asking = salted_join(others, counts, ["label"]).select("label", "node", "text", part.alias("part"), every.alias("block"))
    asked = salted_join(dealt, counts, ["label"]).select("label", "node", "text", F.explode(F.sequence(F.lit(0), F.greatest("parts", F.lit(1)) - 1)).alias("part"), "block")
    more = asking.unionByName(asked).dropDuplicates(["label", "part", "block", "node"]).groupBy("label", "part", "block").applyInArrow(compare, made).filter("node <> class")
    both = linked.unionByName(more).distinct()
    whole = components(both.select(F.col("node").alias("a"), F.col("class").alias("b")))
    return small.unionByName(nodes_of(dealt, whole).select("node", "class"))


def nodes_of(dealt: DataFrame, found: DataFrame) -> DataFrame:
    """(label, node, class) of all nodes; one without a link is a class of its own."""
    return dealt.select("label", "node").join(found.select("node", F.col("label").alias("class")), "node", "left").select("label", "node", F.coalesce("class", "node").alias("class"))


def first_of(docs: DataFrame, kept: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``kept`` (kept_id, kept_hash: id and hash of the text) names, each once."""
    hashed, place = unused("text_hash", docs.columns), unused("place", docs.columns)
    kept = kept.select(F.col("kept_id").alias(unused("_kept_id", docs.columns)), F.col("kept_hash").alias(unused("_kept_hash", docs.columns)))
    mine = docs.withColumn(hashed, F.xxhash64(text))
    mine = mine.join(kept, mine[doc_id].cast("long").eqNullSafe(kept[kept.columns[0]]) & (mine[hashed] == kept[kept.columns[1]]), "left_semi")
    return mine.withColumn(place, F.row_number().over(Window.partitionBy(doc_id, hashed).orderBy(text))).filter(F.col(place) == 1).drop(place, hashed)
