"""What the operators once left out: each test is a case that an earlier shortcut lost."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import decontam, pii, simhash


def shingles(text: str) -> set:
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def share(a: str, b: str) -> float:
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def edited(r, words: list[str], n: int) -> list[str]:
    out = list(words)
    for at in r.choice(len(out), size=n, replace=False):
        out[at] = f"new{int(r.integers(0, 1 << 30))}"
    return out


def test_near_dedup_takes_similarity_of_shingles(spark, sf_dir):
    """Copies with a few words replaced: those at 0.8 or more go, those under it stay. (At 4 words and 4 bits most of the first stayed.)"""
    r = np.random.default_rng(11)
    made = {}
    for n in range(150):
        body = list(r.choice([f"v{k}" for k in range(3000)], size=200))
        made[2 * n], made[2 * n + 1] = " ".join(body), " ".join(edited(r, body, int(r.integers(1, 9))))
    docs = spark.createDataFrame(list(made.items()), "doc_id long, text string").repartition(4)
    kept = {x.doc_id for x in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()}
    near = {n for n in made if n % 2 and share(made[n], made[n - 1]) >= 0.8}
    assert 50 < len(near) < 130
    assert set(made) - kept <= near, "a clean document went"
    assert len(near - kept) >= 0.98 * len(near)


def test_similar_groups_against_all_pairs():
    r = np.random.default_rng(12)
    sets = [np.empty(0, np.uint64)] * 2
    for _ in range(40):
        base = r.integers(0, 1 << 60, size=int(r.integers(1, 60)), dtype=np.uint64)
        sets += [np.unique(np.concatenate([base[int(r.integers(0, 5)) :], r.integers(0, 1 << 60, size=int(r.integers(0, 5)), dtype=np.uint64)])) for _ in range(3)]
    plain = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = set(sets[a].tolist()), set(sets[b].tolist())
            if (not x and not y) or (x | y and len(x & y) / len(x | y) >= 0.8):
                plain = [plain[b] if g == plain[a] else g for g in plain]
    got = simhash.similar_groups(sets, 0.8)
    assert [[a == b for a in got] for b in got] == [[a == b for a in plain] for b in plain]


def test_rows_are_judged_by_id_and_text(spark):
    """Unrelated rows without an id or with one id all stay; only their own copies and alignments remove them."""
    r = np.random.default_rng(13)
    texts = [" ".join(f"t{n}_{k}" for k in r.permutation(60)) for n in range(8)]
    rows = [(None, None), (None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (1, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for keep in (simhash.keep_one, simhash.keep_similar):
        kept = sorted(map(tuple, keep(docs).collect()), key=repr)
        assert kept == sorted([(None, None), (None, texts[0]), (None, texts[1]), (1, texts[2]), (7, texts[3]), (7, texts[4])], key=repr)
    items = spark.createDataFrame([(0, " ".join(texts[1].split()[5:40])), (1, " ".join(texts[3].split()[5:40]))], "item_id long, text string")
    left = sorted(map(tuple, decontam.remove_contaminated(docs, items).collect()), key=repr)
    assert left == sorted([rows[0], rows[1], rows[4], rows[5], rows[7], rows[8]], key=repr)


def test_alignment_does_not_depend_on_the_corpus(spark):
    """One copy with every fourth word changed, one that keeps a common phrase and two words of three, alone and among many that quote the phrase."""
    from tests.llm.test_contracts import plain_align

    r = np.random.default_rng(14)
    item = [f"i{k}" for k in range(24)]
    fourth = [w if k % 4 != 3 else f"x{k}" for k, w in enumerate(item)]
    # The phrase is the only run of four; the rest keeps two words of three.
    third = item[:4] + [w if k % 3 else f"y{k}" for k, w in enumerate(item[4:], 1)]
    fill = lambda: [f"f{k}" for k in r.integers(0, 500, 40)]
    docs = [fill() + fourth + fill(), fill() + third + fill()]
    docs += [fill() + item[:4] + fill() for _ in range(60)]
    for size in (2, len(docs)):
        frame = spark.createDataFrame([(n, " ".join(d)) for n, d in enumerate(docs[:size])], "doc_id long, text string").repartition(3)
        got = {x.doc_id: round(x.score, 9) for x in decontam.contaminated(frame, spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")).collect()}
        assert got == {n: round(plain_align(item, docs[n]) / 48, 9) for n in (0, 1)}
        assert min(got.values()) >= decontam.THRESHOLD


def test_large_groups_are_compared_in_blocks(spark):
    """Groups of near copies far larger than a block, a chain that only texts outside the main class close, and texts that merely meet: classes equal those of all pairs."""
    r = np.random.default_rng(15)
    rows = []
    for label in (1, 2, 3):
        base = [f"b{label}_{k}" for k in range(120)]
        for _ in range(60):
            rows.append((label, " ".join(edited(r, base, int(r.integers(1, 4))))))
        for _ in range(6):  # far from the base, near to its own copy
            other = edited(r, base, 40)
            rows += [(label, " ".join(other)), (label, " ".join(edited(r, other, 1)))]
        step = list(base)  # a chain that leads away from the base
        for k in range(10):
            step = edited(r, step, 2)
            rows.append((label, " ".join(step)))
    rows.append((4, "alone"))
    frame = spark.createDataFrame([(n, label, t) for n, (label, t) in enumerate(rows)], "node long, label long, text string").repartition(3)
    plain = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] == rows[b][0] and plain[a] != plain[b] and rows[a][1] != "alone" and share(rows[a][1], rows[b][1]) >= 0.8:
                plain = [plain[b] if g == plain[a] else g for g in plain]
    for block in (1 << 30, 6000):
        got = {x.node: x["class"] for x in simhash.classes_of(frame, 5, 0.8, block).collect()}
        assert len(got) == len(rows)
        assert [[got[a] == got[b] for a in got] for b in got] == [[plain[a] == plain[b] for a in got] for b in got]
    assert 3 * 3 < len(set(plain)) < len(rows) / 2


def test_hot_segments_take_longer_chains(spark):
    """A ball of fingerprints around one centre: components equal those of all pairs."""
    from tests.llm.test_contracts import plain_components

    r = np.random.default_rng(16)
    prints = {int(r.integers(0, 1 << 63)) for _ in range(200)}
    centre = int(r.integers(0, 1 << 63))
    for _ in range(400):
        x = centre
        for b in r.choice(63, size=int(r.integers(1, 9)), replace=False):
            x ^= 1 << int(b)
        prints.add(x)
    prints = sorted(prints)
    wanted = plain_components(dict(enumerate(prints)), 4)
    label = {x.node: x.label for x in simhash.components(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))).collect()}
    got = [label.get(p, p) for p in prints]
    assert [[a == b for a in got] for b in got] == [[wanted[a] == wanted[b] for a in range(len(prints))] for b in range(len(prints))]


def test_license_blocks_are_runs_of_words(spark):
    """Wrapped notices are found, words scattered over a long line are not; a plain search over all windows agrees."""
    from millrace.llm import licenses

    r = np.random.default_rng(17)
    sets = licenses.template_sets(licenses.TEMPLATES, licenses.THRESHOLD)
    notice = dict((t[:9], t) for _, t in licenses.TEMPLATES)["Permissio"].split()
    wrapped = "intro\n" + " ".join(notice[:10]) + "\n" + " ".join(notice[10:]) + "\nmore"
    scattered = "released early under " + "filler " * 60 + "the end of a license for mit people"
    texts = [wrapped, scattered, None, "", " ".join(["the", "license"] * 3000), "x " * 30_000 + "released under the mit license", "released under the mit license " * 4]
    vocabulary = sorted({w for _, found, _, _ in sets for w in found}) + ["filler", "other"]
    for _ in range(150):
        _, found, _, _ = sets[int(r.integers(len(sets)))]
        body = list(r.choice(vocabulary, size=int(r.integers(5, 60))))
        part = [w for w in r.permutation(found) if r.random() < 0.95]
        for w in part:
            body.insert(int(r.integers(5, 6 + len(part) + len(body) // 6)), w)
        texts.append("\n".join(body))
    got = {x.doc_id: (tuple(x.labels), round(x.score, 6)) for x in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    wanted = {}
    for n, text in enumerate(texts):
        w, base, best, labels = re.findall("[a-z0-9]+", (text or "").lower()), set(), 0.0, set()
        for k in range(len(w)):
            base |= {label for phrase, label in licenses.PHRASES.items() if w[k : k + len(phrase.split())] == phrase.split()}
            for label, found, need, reach in sets:
                if w[k] in found and len(inside := set(w[k : k + reach]) & set(found)) >= need:
                    labels.add(label)
                    best = max(best, len(inside) / len(found))
        wanted[n] = tuple(sorted(labels | base)), round(best, 6)
    assert got == wanted
    assert got[0] == (("mit",), 1.0) and got[1] == ((), 0.0) and sum(bool(x[0]) for x in got.values()) > 20


def test_one_long_turn_leaves_full_windows(spark):
    """Forty turns of 24 tokens and one far longer: windows are as full as turns allow, and none exceeds the budget without need."""
    from millrace.llm import chat

    rows = [(1, k, "assistant" if k % 2 else "user", "w " * (900 if k == 40 else 20)) for k in range(41)]
    rows += [(2, k, "system" if k == 0 else "user", "w " * n) for k, n in enumerate((50, 300, 10, 10, 400, 200, 2000, 5, 5))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for budget, history in ((1024, 256), (200, 60)):
        made = chat.windows(frame, budget, history).orderBy("conv_id", "window").collect()
        # A window over the budget is one turn with its history and the system turn.
        assert all(x.n_tokens <= budget or x.n_turns - x.n_repeated == 1 for x in made)
        mine = [x for x in made if x.conv_id == 1]
        new = [len(x) for x in (r.turns for r in chat.read_back(chat.windows(frame, budget, history)).orderBy("conv_id", "window").collect() if r.conv_id == 1)]
        assert sum(new) == 41
        # All but the last windows before the long turn: one more turn would not fit.
        assert all(x.n_tokens + 24 > budget - history for x in mine[:-2])
        assert len(mine) <= 2 + 40 * 24 // (budget - 2 * 24 - 23)


def test_a_common_phrase_fills_no_bucket(spark):
    """One 8-word phrase, of the lowest hash there is, in different surroundings: its windows are dealt evenly, and repeats are still found."""
    from millrace.llm import substring
    from millrace.llm.common import spread

    phrases = [[f"p{n}_{k}" for k in range(8)] for n in range(400)]
    import pyarrow as pa

    lowest = min(phrases, key=lambda p: substring.deal_keys(substring.word_values(pa.array([" ".join(p)]))[0], 8)[0])
    texts = [" ".join([f"a{n}_{k}" for k in range(60)] + lowest + [f"b{n}_{k}" for k in range(60)]) for n in range(600)]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(700, texts[5])], "doc_id long, text string").repartition(4)
    hot = substring.hot_keys(frame, 50, 1 << 20, 200)
    buckets = np.zeros(200, int)
    for t in texts:
        values, offsets = substring.word_values(pa.array([t]))
        doc, at = substring.places_of(offsets, 50)
        own = spread(substring.rolling(values, 50, substring.BASES[0]))
        key = substring.deal_keys(values, 50)
        np.add.at(buckets, (spread(np.where(np.isin(key, hot), own, key)) % np.uint64(200)).astype(int), 1)
    assert buckets.max() <= 3 * np.median(buckets)
    gone = {x.doc_id: x.n_removed for x in substring.remove_repeats(frame).collect()}
    assert gone.pop(700) == 128 and set(gone.values()) == {0}


def test_a_common_anchor_fills_no_bucket(spark):
    """One 90-byte phrase in 1500 different surroundings: strings around it are dealt evenly, a task settles repeats itself, and just the repeats are found."""
    from millrace.llm import suffix
    from millrace.llm.substring import numbered

    phrase = "".join(f"{k:03d}" for k in range(30))
    r = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    side = lambda: "".join(r.choice(letters, size=120))
    texts = [side() + phrase + side() for _ in range(1500)]
    whole = "".join(r.choice(letters, size=400))
    rows = list(enumerate(texts)) + [(2000, texts[7]), (2001, texts[9][30:260])] + [(3000 + k, whole) for k in range(800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keyed, length, buckets = numbered(frame), 100, 256
    hot = suffix.hot_anchors(frame, length, 1 << 20, buckets)
    assert len(hot)
    repeated = suffix.repeated_anchors(frame, length, buckets, hot)
    known = keyed.join(repeated, ["doc_id", "mark"]).select("doc_id", "mark", "text", "at")
    size = {x.bucket: x.n for x in suffix.surroundings(known, length, buckets, hot).filter("text is not null").groupBy("bucket").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    assert len(size) == buckets and max(size.values()) <= 3 * np.median(list(size.values()))
    gone = {x.doc_id: x.n_removed for x in suffix.remove_repeats(frame).collect()}
    assert gone.pop(2000) == 330 and gone.pop(2001) == 230
    assert {d for d, n in gone.items() if n} == set(range(3001, 3800)) and {gone[d] for d in range(3001, 3800)} == {400}


def test_long_stretches_are_aligned_in_parts(monkeypatch):
    """A text full of an item's words is one stretch; its parts give the best score of the whole, and none is longer than the bound."""
    import pyarrow as pa

    r = np.random.default_rng(5)
    monkeypatch.setattr(decontam, "STRETCH", 64)
    item = [f"w{k}" for k in range(30)]
    items = decontam.Items([1], pa.array([" ".join(item)]), 0.5)
    text = list(r.choice(item, size=900))
    for at in (0, 55, 120, 333, 870):
        placed = text[:at] + item + text[at + 30 :]
        codes, offsets = decontam.coded(pa.array([" ".join(placed)]))
        [stretches] = items.meetings(codes, offsets).values()
        assert len(stretches) > 3 and max(b - a for _, a, b in stretches) <= max(64, items.reach[0]) + items.reach[0]
        assert stretches[0][1] == 0 and stretches[-1][2] == 900
        whole = decontam.align(items.words[0], [codes])[0]
        best = max(((score, -(a + x), a + y) for _, a, b in stretches for score, x, y in decontam.align(items.words[0], [codes[a:b]])))
        assert best == (whole[0], -whole[1], whole[2])


def test_field_spans_overlap_no_base_span(monkeypatch):
    """The search by begin finds the overlaps that a comparison with every base span finds."""
    r = np.random.default_rng(6)
    for _ in range(300):
        base = [("ip", int(a), int(a + n)) for a, n in zip(r.integers(0, 60, 6), r.integers(1, 12, 6))][: int(r.integers(0, 7))]
        more = [("phone", int(a), int(a + n)) for a, n in zip(r.integers(0, 60, 8), r.integers(1, 12, 8))]
        monkeypatch.setattr(pii, "base_spans", lambda text, base=base: base)
        monkeypatch.setattr(pii, "field_spans", lambda text, field, more=more: more)
        kept = [s for s in pii.all_spans("", None)[1] if s[0] == "phone"]
        assert sorted(kept) == sorted(s for s in more if not any(a < s[2] and s[1] < b for _, a, b in base))


def test_numbers_without_end_take_little_memory():
    """Half a MB of phone numbers is one region: some bytes a character, and each number is found."""
    import time
    import tracemalloc

    field = pii.fit(pii.generated(60, 3))
    text = "555-123-4567 " * 40_000
    tracemalloc.start()
    began = time.perf_counter()
    found = pii.field_spans(text, field)
    took, (_, peak) = time.perf_counter() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 60e6 and took < 120
    few = pii.field_spans(text[: 13 * 100], field)
    assert [s for s in found if s[2] < 13 * 90] == [s for s in few if s[2] < 13 * 90]


def test_one_long_document_meets_many_items_in_bounded_memory():
    """100,000 words of a small vocabulary against 2,000 items made of it: hits are sorted some at a time."""
    import tracemalloc

    r = np.random.default_rng(2)
    vocabulary = np.array([f"v{k}" for k in range(3000)])
    texts = pa.array([" ".join(r.choice(vocabulary, 40)) for _ in range(2000)])
    items = decontam.Items(list(range(2000)), texts, 0.5)
    words = r.choice(vocabulary, 100_000)
    words[50_000:50_040] = texts[7].as_py().split()
    codes, offsets = decontam.coded(pa.array([" ".join(words)]))
    tracemalloc.start()
    met = items.meetings(codes, offsets)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 200e6
    assert any(a <= 50_000 and b >= 50_040 for _, a, b in met[7])


def test_the_order_is_measured_on_what_enters_the_cascade(spark, monkeypatch):
    """Texts that the base rejects don't weigh: a rule that rejects only those comes last, and what the report counts costs nothing."""
    from millrace.llm import quality

    seen = []
    plain = quality.cascade
    monkeypatch.setattr(quality, "cascade", lambda sample, rules: seen.append((sample, plain(sample, rules))) or seen[-1][1])
    short = [" ".join(["LOUD"] * 10)] * 50
    long = [" ".join(f"w{k}" for k in range(n, n + 60)) + " # # # # # # # # # # # # # # # #" * (n % 2) for n in range(40)]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(short + long)], "doc_id long, text string")
    report = {r.doc_id: r for r in quality.quality_report(docs).collect()}
    (sample, plan), = seen
    assert len(sample) <= 40 and min(sample.n_words()) >= 50
    assert plan[0][0] == "many_symbols" and dict((name, share) for name, _, share in plan)["shouting"] == 0
    assert all(report[n].base_failed for n in range(50)) and sum(report[n].kept for n in range(50, 90)) == 20
