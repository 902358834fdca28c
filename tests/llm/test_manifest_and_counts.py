"""Resampling, manifests and token counts against their SQL, plain versions and the library; odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import importance, merkle, tokens
from millrace.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_edges import ROWS, SCHEMA

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_merkle_manifest"])
def test_sql(name, same_rows):
    same_rows(QUERIES[name], ORACLE_SQL[name])


# --- importance resampling ---


def plain_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, Counter(w) + Counter(map(" ".join, zip(w, w[1:])))


def plain_resampled(rows, target):
    crc = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = Counter(), Counter()
    for side, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for f, n in plain_features(text)[1].items():
                side[crc(f)] += n
    S, T = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in {*s}}
    out = []
    for doc_id, text in rows:
        w, f = plain_features(text)
        weight = sum(n * gain[crc(x)] for x, n in f.items()) // f.total() if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, f.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)))
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    drawn = 25 * len(able) // 100
    return sorted([(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)] + [(*r[:4], None) for r in out if r[4] < 20], key=repr)


@pytest.mark.parametrize("piece", [importance.PIECE, 1])
def test_resampling_against_a_plain_version(spark, docs, monkeypatch, piece):
    """Also with a piece for each part of the input, so that features meet from many pieces."""
    monkeypatch.setattr(importance, "PIECE", piece)
    monkeypatch.setattr(importance, "PART", min(importance.PART, 40 * piece))
    rows = [r[:2] for r in ROWS] + [(n, " ".join(f"Ünit{n * k % 37} A-b_c 9{k % n}" for k in range(n % 50))) for n in range(20, 120)]
    target = ["Ünit3 a b c", None, "", "w1 w2 w3", "b c b c"]
    made = importance.resampled(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame([(x,) for x in target], "text string"))
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in made.collect()), key=repr) == plain_resampled(rows, target)


def test_resampling_of_nothing(spark, docs):
    none = docs.limit(0)
    assert importance.resampled(none, docs).count() == 0
    made = importance.resampled(docs, none).collect()
    assert len(made) == len(ROWS) and {r.weight for r in made if not r.n_features} == {0}
    # Of the rows with twenty words or more, a quarter.
    assert sorted(r.rank for r in made if r.rank) == list(range(1, 25 * sum(r.n_words >= 20 for r in made) // 100 + 1))


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(importance, "luck", lambda doc_id, seed: F.lit(0).cast("long"))
    rows = [(n, "same " * 30) for n in (9, 4, 7, 2)]
    made = importance.resampled(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("same",)], "text string"), percent=50)
    assert sorted((r.rank, r.doc_id) for r in made.collect() if r.rank) == [(1, 2), (2, 4)]


# --- manifest ---


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    """Rows of doc_id, source, lang, n_chars, text."""

    def leaf(r):
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))

    def tree(nodes):
        proofs = [[] for _ in nodes]
        above = list(range(len(nodes)))  # the node that holds each leaf
        level = nodes
        while len(level) > 1:
            for n, at in enumerate(above):
                first = at // 8 * 8
                run = level[first : first + 8]
                proofs[n].append((run[: at - first], run[at - first + 1 :]))
            level = [sha("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
            above = [at // 8 for at in above]
        return level[0], proofs

    groups = defaultdict(list)
    for r in rows:
        groups[b"" if r[2] is None else b"+" + r[2].encode()].append(r)
    keys = sorted(groups)
    inner = {}
    for key in keys:
        groups[key].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        inner[key] = tree([leaf(r) for r in groups[key]])
    root, outer = tree([inner[key][0] for key in keys])
    out = []
    for key, above in zip(keys, outer):
        subroot, proofs = inner[key]
        for r, steps in zip(groups[key], proofs):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            acc = leaf((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4]))) if bad else leaf(r)
            for left, right in steps + above:
                acc = sha("".join([*left, acc, *right]))
            proof = "".join("".join(left + right) for left, right in steps + above)
            out.append((r[0], leaf(r), subroot, root, sha(proof), acc, acc == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest_rows(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    frame = frame.withColumns({c: F.lit("x") for c in ("place", "of", "run", "steps", "digest", "up")})  # names that the tree uses
    return sorted((tuple(r) for r in merkle.manifest(frame, merkle.tampered(F.col("doc_id"), F.col("text"))).select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 600])
def test_manifest_against_a_plain_version(spark, n):
    """Trees of one to four levels, languages of one row beside one that holds nearly all."""
    rows = [(k * 7 % 601, "s", None if k == 5 else ["en", "é", "z", "日"][k % 4] if k % 11 == 3 else "en", k, None if k % 13 == 12 else f"Text {k} ÉA") for k in range(n)]
    assert manifest_rows(spark, rows) == plain_manifest(rows)


def test_manifest_of_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "", "", 0, ""), (1, "a", "en", 1, "A"), (1, "a", "en", 1, "A"), (1, "a", "en", 1, "B"), (3, "-", "-", -3, "x" * 300_000), (10**15, "a", None, None, "Z")]
    rows += [(k, "s", f"l{k}", 1, "T") for k in range(20)]  # many languages
    made = manifest_rows(spark, rows)
    assert made == plain_manifest(rows) and len(made) == len(rows)


def test_manifest_of_nothing(docs):
    assert merkle.manifest(docs.limit(0)).count() == 0


def test_untouched_rows_verify(docs):
    made = merkle.manifest(docs)
    assert made.count() == len(ROWS) and made.filter("not verified").count() == 0


# --- token counts ---


def plain_counts(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_counts_against_the_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    made = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(docs, PATH).collect()}
    wanted = dict(zip(texts, plain_counts(list(texts.values()))))
    assert made == {k: (len(t.encode()), wanted[k], wanted[k] > 512) for k, t in texts.items()}


def test_every_character_is_cut_as_the_library_cuts_it():
    """Letters, digits and white space of every plane, alone, doubled and beside others."""
    merges = tokens.Merges(PATH)
    texts = ["".join(f"a{chr(c)}b {chr(c)}{chr(c)} {chr(c)}1" for c in range(a, a + 40) if not 0xD800 <= c < 0xE000) for a in [*range(0, 0x3200, 40), *range(0xF900, 0x10900, 40), *range(0x1D400, 0x1D800, 40), *range(0x1F000, 0x1FA00, 40)]]
    assert list(map(merges.text, texts)) == plain_counts(texts)


def test_counts_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(tokens, "LISTED", 50)
    monkeypatch.setattr(tokens, "KNOWN", 8)
    texts = ["", " ", "<|endoftext|>", "a<|endoftext|> b  <|endoftext|><|endoftext", "  \n\n x\t\ty  ", "don't 'S 's", "é日本　x", "a" * 5000, " " * 3000, "ab" * 2000 + "!" * 99, "x \x1c\x1f\x85 y", "\U0001f600" * 70, "one two three " * 300]
    made = tokens.token_counts(spark.createDataFrame([(k, t, "c", 1) for k, t in enumerate(texts)] + [(None, None, None, None)], "doc_id long, text string, n_tokens string, n_bytes int"), PATH, limit=3)
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in made.collect()}
    assert found == {k: (len(t.encode()), n, n > 3) for k, (t, n) in enumerate(zip(texts, plain_counts(texts)))} | {None: (0, 0, False)}


def test_counts_of_tables(docs):
    found = tokens.token_counts(docs, PATH)
    assert found.count() == len(ROWS) and tokens.token_counts(docs.limit(0), PATH).count() == 0
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokens.Merges(public_tokenizers.path("word_bpe_49k.json"))
