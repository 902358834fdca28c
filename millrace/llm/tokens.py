"""Token counts by byte-pair merging with a heap and a linked list.

The symbols of a pre-token are its bytes, held in a doubly linked list. The
adjacent pair of the lowest rank (of equal ranks the leftmost) is popped from a
heap, merged in place, and the two pairs that it forms with its neighbours are
pushed. Every merge takes one symbol away, so a pre-token has as many tokens as
bytes less merges; no identifier is ever looked up.

A text is counted where it is read: nothing is shuffled, and the counts of
frequent pre-tokens are remembered in the worker.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The characters of Unicode's White_Space property, which is what the tokenizer's library means by \s.
WHITE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
# The pre-tokens of byte-level BPE.
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
#: Pre-tokens whose counts a worker remembers, twice over, and the characters of the longest of them.
KNOWN, KNOWN_LENGTH = 1 << 19, 64
#: Characters of text whose pre-tokens are listed at once; those of a longer text are walked one by one.
LISTED = 1 << 20


class Known(dict):
    """Counts by pre-token, made when first asked for. The frequent ones stay: whatever was used since the table was last full outlives the next time."""

    def __init__(self, count: Callable[[bytes], int]):
        super().__init__()
        self.count, self.old = count, {}

    def __missing__(self, word: str) -> int:
        n = self.old.get(word) or self.count(word.encode())
        if len(word) <= KNOWN_LENGTH:
            if len(self) >= KNOWN:
                self.old = dict(self)
                self.clear()
            self[word] = n
        return n


class Merges:
    """What counting needs of a tokenizer file: the rank of every pair of symbols and the symbol it becomes, and the strings that stand for one token each."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model, steps = made["model"], made["pre_tokenizer"] or {}
        plain = steps.get("type") == "ByteLevel" and steps.get("use_regex", True) and not steps.get("add_prefix_space")
        odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
        if model["type"] != "BPE" or not plain or made.get("normalizer") or any(odd):
            raise ValueError(f"{path}: only byte-level BPE without a normalizer is counted here")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in made["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take their surroundings are not counted here")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        number = {c: k for k, c in enumerate(byte_symbols())}
        for a, b in pairs:
            number.setdefault(a + b, len(number))
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            self.pairs[number[a], number[b]] = rank, number[a + b]
        special = sorted((t["content"] for t in made["added_tokens"]), key=lambda x: (-len(x), x))
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pre_token = regex.compile(PRE_TOKEN)
        self.known = Known(self.count)

    def count(self, word: bytes) -> int:
        """Tokens of one pre-token."""
        symbol: list[int] = list(word)
        n, pair_of = len(symbol), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(*pair, at, symbol[at], symbol[at + 1]) for at in range(n - 1) if (pair := pair_of((symbol[at], symbol[at + 1])))]
        heapq.heapify(queue)
        left = n
        while queue:
            _, merged, at, a, b = heapq.heappop(queue)
            # A pair one of whose symbols has been merged meanwhile is no pair any more.
            if symbol[at] != a or (then := after[at]) == n or symbol[then] != b:
                continue
            symbol[at], symbol[then] = merged, -1
            after[at] = beyond = after[then]
            left -= 1
            if beyond < n:
                before[beyond] = at
                if pair := pair_of((merged, symbol[beyond])):
                    heapq.heappush(queue, (*pair, at, merged, symbol[beyond]))
            if (prior := before[at]) >= 0 and (pair := pair_of((symbol[prior], merged))):
                heapq.heappush(queue, (*pair, prior, symbol[prior], merged))
        return left

    def text(self, text: str) -> int:
        """Tokens of a text: those strings that stand for a token count one, what lies between them is cut into pre-tokens."""
        total, at = 0, 0
        for m in self.special.finditer(text) if self.special else ():
            total += self.stretch(text, at, m.start()) + 1
            at = m.end()
        return total + self.stretch(text, at, len(text))

    def stretch(self, text: str, begin: int, end: int) -> int:
        # What follows a stretch must not decide where its last white space is cut.
        part = text if end == len(text) else text[begin:end]
        begin = begin if part is text else 0
        found = self.pre_token.findall(part, begin) if end - begin <= LISTED else map(regex.Match.group, self.pre_token.finditer(part, begin))
        return sum(map(self.known.__getitem__, found))


def byte_symbols() -> list[str]:
    """The character by which byte-level vocabularies write each byte: printable ones themselves, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b if b in printable else spare))
        spare += b not in printable
    return out


@lru_cache(maxsize=1)
def merges_of(path: str) -> Merges:
    return Merges(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row: UTF-8 bytes and tokens of the whole text, and whether these are more than ``limit``.

    ``path`` is a tokenizer file in JSON, which executors must find under the same
    path. Nothing is added before or after a text; strings of the file's own
    added tokens inside a text are one token each, as the library has it. A null
    text is empty and has no tokens; a long text is walked match by match, though
    one pre-token of n bytes needs some 200 n bytes of memory. Rows that
    repeat and null doc_ids give a row each; other columns play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merges_of(path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            n = pa.array([merges.text(t.as_py()) for t in texts], pa.int64())
            yield pa.record_batch([batch.column(0), pc.cast(pc.binary_length(texts), pa.int64()), n, pc.greater(n, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
