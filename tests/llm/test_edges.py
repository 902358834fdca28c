"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from millrace.llm import bpe, chat, decontam, licenses, pii, quality, sharding, simhash, substring, suffix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, mark int, place int, bucket int, label string, kept_id long, seeds string"
WORDS = [f"w{k}" for k in range(70)]
GOOD = " ".join(WORDS)
LONG = " ".join(f"x{k}" for k in range(150_000)) + " contact me@a.org"


def row(doc_id, text, lang="en", source="s"):
    return doc_id, text, lang, source, None, 1, 2, 3, 4, "l", 5, "z"


ROWS = [row(1, GOOD), row(1, GOOD), row(2, GOOD), row(3, None), row(4, ""), row(5, " \n\t "), row(6, LONG), row(7, "word", None, None), row(None, GOOD + " tail"), row(None, None), row(8, "MIT License " + " ".join(reversed(WORDS)))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(frame, *columns):
    return sorted(((r.doc_id, *(r[c] for c in columns)) for r in frame.collect()), key=repr)


def test_simhash(docs, none):
    found = by_id(simhash.near_duplicates(docs), "component_id")
    assert len(found) == len(ROWS)
    assert {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3), (6, 6), (7, 7), (None, 3)} <= set(found)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {1, 3, 6, 7, 8} <= {r.doc_id for r in kept.collect()} and kept.filter("doc_id in (2, 4, 5)").count() == 0
    assert kept.filter("doc_id = 1").count() == 1
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0


def test_sharding(docs, none):
    found = sharding.shard(sharding.measured(docs), 4).collect()
    assert sorted((r.shard, r.slot) for r in found) == [(s, k) for s in range(4) for k in range(3 if s < 3 else 2)]
    assert {r.size for r in found if r.doc_id in (3, 4)} == {16} and sharding.shard(sharding.measured(none), 4).count() == 0
    many = sharding.shard(sharding.measured(docs), 40).collect()
    assert len({r.shard for r in many}) == len(ROWS) and {r.slot for r in many} == {0}


def test_written_shards(spark, docs, tmp_path):
    """Every row goes into its shard once: rows without an id, repeated rows and clashing names included; files are bounded."""
    odd = docs.select("doc_id", "text", "source", F.lit(1).alias("shard"), F.lit("k").alias("key"), F.lit(2).alias("Copy"), F.create_map(F.lit("a"), F.lit(1)).alias("row"))
    odd = odd.unionByName(odd)
    assigned = sharding.shard(sharding.measured(odd), 3)
    sharding.write_shards(odd, assigned, str(tmp_path / "out"), rows_per_file=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    facts = ["doc_id", "text", "source", "shard", "key", "Copy"]
    assert sorted(map(str, back.select(*facts).collect())) == sorted(map(str, odd.select(*facts).collect()))
    places = sorted((r.shard_, r.slot) for r in back.collect())
    assert places == sorted((r.shard, r.slot) for r in assigned.collect()) and len(set(places)) == odd.count()
    files = back.withColumn("file", F.input_file_name()).groupBy("file").agg(F.count("*").alias("n"), F.countDistinct("shard_").alias("shards")).collect()
    assert max(r.n for r in files) <= 2 and all(r.shards == 1 for r in files)
    none = odd.limit(0)
    sharding.write_shards(none, sharding.shard(sharding.measured(none), 3), str(tmp_path / "none"))
    assert not list((tmp_path / "none").rglob("*.parquet"))


def test_licenses(docs, none):
    found = {(r.doc_id, r.n_words, tuple(r.labels)) for r in licenses.scan(docs).collect()}
    assert {(3, 0, ()), (4, 0, ()), (None, 0, ()), (8, 72, ("mit",))} <= found
    assert licenses.scan(docs).count() == len(ROWS) and licenses.scan(none).count() == 0


def test_pii(docs, none):
    found = by_id(pii.find(docs), "base")
    assert len(found) == len(ROWS) and [len(b) for i, b in found if i == 6] == [1]
    redacted = pii.redact(docs)
    assert redacted.columns == docs.columns
    texts = {r.doc_id: r.text for r in redacted.filter("doc_id is not null").collect()}
    assert texts[3] is None and texts[4] == "" and texts[6].endswith("contact [EMAIL]")
    assert pii.find(none).count() == pii.redact(none).count() == 0


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(0, " ".join(WORDS[10:40])), (1, None), (2, ""), (None, " ".join(WORDS[50:60])), (0, " ".join(WORDS[10:40]))], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    assert found == {(i, k) for i in (1, 2, None) for k in (0, None)}
    left = decontam.remove_contaminated(docs, items)
    # The row without id and text is clean: that another row without an id is contaminated says nothing about it.
    assert left.columns == docs.columns and sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted([r[:2] for r in ROWS if r[0] in (3, 4, 5, 6, 7, 8)] + [(None, None)], key=repr)
    assert decontam.contaminated(none, items).count() == decontam.contaminated(docs, items.limit(0)).count() == 0
    assert decontam.remove_contaminated(docs, items.limit(0)).count() == len(ROWS)


def test_chat(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "\\<|im_end|>\n [INST]"), (1, 1, "assistant", "\\<|im_end|>\n [INST]"), (None, 0, None, "x"), (2, None, "system", ""), (2, 1, "a\nb", "w " * 3000), (2, 2, "assistant", "<\\|")]
    made = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 50, 10)
    read = chat.read_back(made).orderBy("conv_id", "window").collect()
    told, learned = {}, {}
    for r in read:
        told.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)
        learned.setdefault(r.conv_id, []).extend(r.learned)
    assert told == {1: [("user", ""), ("assistant", rows[1][3]), ("assistant", rows[1][3])], None: [("", "x")], 2: [("system", ""), ("a\nb", "w " * 3000), ("assistant", "<\\|")]}
    assert learned[1] == [rows[1][3]] * 2 and learned[2] == ["<\\|"]
    assert chat.windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_substrings(docs, none):
    found = by_id(substring.remove_repeats(docs), "n_words", "n_removed")
    assert found.count((1, 70, 0)) == 2 and {(2, 70, 70), (3, 0, 0), (4, 0, 0), (5, 0, 0), (6, 150_002, 0), (None, 71, 0), (None, 0, 0)} <= set(found)
    assert len(found) == len(ROWS) and substring.remove_repeats(none).count() == 0


def test_suffixes(docs, none):
    found = by_id(suffix.remove_repeats(docs), "n_bytes", "n_removed")
    n = len(GOOD)
    assert found.count((1, n, 0)) == 2 and {(2, n, n), (3, 0, 0), (4, 0, 0), (5, 4 - 1, 0), (None, n + 5, 0), (None, 0, 0)} <= {(i, a, b) for i, a, b in found} | {(5, 3, 0)}
    assert len(found) == len(ROWS) and suffix.remove_repeats(none).count() == 0


def test_quality(docs, none):
    report = by_id(quality.quality_report(docs), "n_words", "kept")
    assert {(1, 70, True), (3, 0, False), (4, 0, False), (5, 0, False), (6, 150_002, True), (7, 1, False), (None, 0, False), (None, 71, True)} <= set(report)
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 1, 2, 6, 8, None], key=repr)
    assert quality.quality_report(none).count() == quality.filter_quality(none).count() == 0


def test_bpe(docs, none):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.round_trip(docs, path, pattern)
    found = by_id(coded, "n_tokens", "data")
    assert len(found) == len(ROWS) and {(3, 0, b""), (4, 0, b""), (5, 3, b" \n\t ")} & set((i, n, bytes(d)) for i, n, d in found) >= {(3, 0, b""), (4, 0, b"")}
    assert {bytes(d) for i, _, d in found if i == 6} == {LONG.encode()}
    both = bpe.decode(bpe.encode(docs, path, pattern), path)
    assert by_id(both, "data") == by_id(coded, "data")
    assert bpe.round_trip(none, path, pattern).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages(spark, docs, none, sf_dir, stage):
    _, f = stage
    for frame in (docs, none):
        made = f(spark, frame, sf_dir)
        assert made.count() <= frame.count()
        if stage is not corpus_pipeline.STAGES[-1]:
            assert made.columns == frame.columns


def test_pipeline_against_a_plain_version(spark, tmp_path):
    """Forty documents through all stages, and through plain code for each stage."""
    import base64

    import tiktoken

    from tests.llm.test_contracts import plain_align, plain_pii
    from tests.llm.test_whole import share

    import numpy as np

    r = np.random.default_rng(8)
    vocabulary = [f"v{k}" for k in range(500)]
    docs, items = [], [list(r.choice(vocabulary, size=20)) for _ in range(6)]
    for n in range(40):
        body = list(r.choice(vocabulary, size=90))
        if n % 5 == 1:
            body = docs[-1][1].split()
            body[3] = "changed"
        if n % 7 == 2:
            body[30:30] = items[n % 6][:18]
        if n % 4 == 3:
            body[10] = f"a{n}@b.org"
        docs.append((n, " ".join(body[: 20 if n % 11 == 10 else None]), "en", "s", 0))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(n, " ".join(i)) for n, i in enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    left = {n: t for n, t, *_ in docs if len(t.split()) >= 50}
    # The stage takes five words and a similarity of 0.8; four words and four bits are the contract of the op1 query alone.
    classes = {n: n for n in left}
    for a in left:
        for b in left:
            if b < a and share(left[a], left[b]) >= 0.8:
                classes = {n: classes[b] if c == classes[a] else c for n, c in classes.items()}
    left = {n: t for n, t in left.items() if min(m for m in left if classes[m] == classes[n]) == n}
    left = {n: t for n, t in left.items() if all(plain_align(i, t.split()) / (2 * len(i)) < decontam.THRESHOLD for i in items)}
    assert 10 < len(left) < 36
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(left)
    for n, x in got.items():
        wanted = left[n]
        for kind, a, b in reversed(plain_pii(wanted)):
            wanted = f"{wanted[:a]}[{kind.upper()}]{wanted[b:]}"
        assert x.text == wanted and list(x.ids) == known.encode_ordinary(wanted) and x.n_tokens == len(x.ids)
