"""Quality rules as a short-circuit cascade.

The cost and the selectivity of every rule are estimated on a bounded sample of
the documents (``SAMPLE_ROWS``); the rules then run in the order of rejections
per unit of cost, and each one sees only what all before it have passed. The
verdict is a conjunction, so the order changes the time and never the result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, as_bytes, pieces, split_words

#: Bound of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 2000
#: Longer texts stay out of that sample (not out of the rules), which bounds its bytes on the driver.
SAMPLE_BYTES = 100_000

SYMBOLS = b"#*$%&|<>"


class Texts:
    """A batch of texts; what several rules need is computed once, when first asked for."""

    def __init__(self, column: pa.Array, texts: list[bytes] | None = None):
        self.column, self.texts, self._known = column, as_bytes(column) if texts is None else texts, {}

    def __len__(self) -> int:
        return len(self.texts)

    def only(self, places: np.ndarray) -> Texts:
        """The texts at these places, with every count that is known of them; words and offsets would have to be cut anew."""
        if len(places) == len(self):
            return self
        out = Texts(self.column.take(pa.array(places)), [self.texts[k] for k in places.tolist()])
        out._known = {name: tuple(x[places] for x in known) if isinstance(known, tuple) else known[places] for name, known in self._known.items() if name != "words"}
        return out

    def _once(self, name: str, make: Callable):
        if name not in self._known:
            self._known[name] = make()
        return self._known[name]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Dictionary numbers of all words, offsets of the texts, code points of each text's words."""

        def make():
            flat, offsets = split_words(self.column)
            return np.asarray(flat.dictionary_encode().indices, dtype=np.int64), offsets

        return self._once("words", make)

    def n_words(self) -> np.ndarray:
        return self._once("n_words", lambda: np.diff(self.words()[1]))

    def word_chars(self) -> np.ndarray:
        def make():
            chars = np.asarray(pc.utf8_length(pc.fill_null(self.column, "")), dtype=np.int64)
            return chars - np.array([len(t) - len(t.translate(None, SPACE)) for t in self.texts], dtype=np.int64)

        return self._once("word_chars", make)

    def n_symbols(self) -> np.ndarray:
        return self._once("n_symbols", lambda: np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in self.texts], dtype=np.int64))

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines that hold a word, and those of them that equal an earlier line."""

        def make():
            n, dup = [], []
            for t in self.texts:
                full = [x for x in t.split(b"\n") if x.strip()]
                n.append(len(full))
                dup.append(len(full) - len(set(full)))
            return np.array(n, dtype=np.int64), np.array(dup, dtype=np.int64)

        return self._once("lines", make)

    def n_repeat_words(self) -> np.ndarray:
        """Words inside a 3-word window that occurs at least twice in its text."""

        def make():
            ids, offsets = self.words()
            doc = np.repeat(np.arange(len(self)), np.diff(offsets))
            out = np.zeros(len(self), dtype=np.int64)
            if len(ids) < 3:
                return out
            inside = np.flatnonzero(doc[2:] == doc[:-2])
            # Three dictionary numbers below 2**21 fit one code; the first two are numbered anew where a huge text has more.
            first = (ids[inside] << 21) | ids[inside + 1]
            if ids.max() >= 1 << 21:
                first = np.unique(ids[inside] * (ids.max() + 1) + ids[inside + 1], return_inverse=True)[1]
            code = first * (ids.max() + 1) + ids[inside + 2]
            order = np.lexsort((code, doc[inside]))
            code, where = code[order], inside[order]
            same = (code[1:] == code[:-1]) & (doc[where[1:]] == doc[where[:-1]])
            twice = np.zeros(len(where), dtype=bool)
            twice[1:] |= same
            twice[:-1] |= same
            covered = np.zeros(len(ids), dtype=bool)
            for step in range(3):
                covered[where[twice] + step] = True
            np.add.at(out, doc[covered], 1)
            return out

        return self._once("n_repeat_words", make)

    def n_upper(self) -> np.ndarray:
        """ASCII capitals."""

        def make():
            return np.array([len(t) - len(t.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")) for t in self.texts], dtype=np.int64)

        return self._once("n_upper", make)


def too_short(x: Texts) -> np.ndarray:
    return x.n_words() < 50


def repeats_itself(x: Texts) -> np.ndarray:
    return 100 * x.n_repeat_words() > 50 * x.n_words()


def many_symbols(x: Texts) -> np.ndarray:
    """More than one symbol character for every five words."""
    return 5 * x.n_symbols() > x.n_words()


def repeated_lines(x: Texts) -> np.ndarray:
    """Over half of at least four lines repeat an earlier line."""
    lines, dup = x.lines()
    return (lines >= 4) & (2 * dup > lines)


def shouting(x: Texts) -> np.ndarray:
    """Over half of the characters are capitals."""
    return 2 * x.n_upper() > x.word_chars()


def odd_word_length(x: Texts) -> np.ndarray:
    """The mean word is shorter than 2 or longer than 20 characters."""
    return (x.word_chars() < 2 * x.n_words()) | (x.word_chars() > 20 * x.n_words())


#: A rule maps Texts to True where it rejects. The first two are the base of the contract.
BASE: dict[str, Callable[[Texts], np.ndarray]] = {"too_short": too_short, "repeats_itself": repeats_itself}
RULES: dict[str, Callable[[Texts], np.ndarray]] = BASE | {
    "many_symbols": many_symbols, "repeated_lines": repeated_lines, "shouting": shouting, "odd_word_length": odd_word_length,
}


def sampled(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS, seed: int = 7) -> pa.Array:
    """At most ``rows`` texts, drawn from all partitions."""
    total = docs.count()
    share = min(1.0, 1.2 * rows / max(total, 1))
    found = docs.select(F.col(text).alias("text")).sample(share, seed).filter(F.octet_length("text") <= SAMPLE_BYTES).limit(rows).toArrow()
    return found.column("text").combine_chunks()


def cascade(sample: pa.Array | Texts, rules: dict[str, Callable] = RULES) -> list[tuple[str, float, float]]:
    """(rule, seconds a text, share rejected), ordered by rejections per second.

    Greedy: after a rule is chosen, the others are measured on the texts that it
    leaves, where what it has counted is known and costs nothing, as in
    ``passes``; so is what the caller has counted of given ``Texts``. An empty
    sample keeps the given order.
    """
    texts, left, plan = sample if isinstance(sample, Texts) else Texts(sample), dict(rules), []
    while left:
        seen = {}
        for name, rule in left.items():
            trial = Texts(texts.column, texts.texts)
            trial._known = dict(texts._known)
            began = time.perf_counter()
            rejected = rule(trial)
            cost = (time.perf_counter() - began) / max(len(trial), 1)
            seen[name] = (rejected.mean() / max(cost, 1e-9) if len(trial) else 0.0, cost, rejected, trial)
        name = max(seen, key=lambda k: seen[k][0])
        _, cost, rejected, trial = seen[name]
        plan.append((name, cost, float(rejected.mean()) if len(trial) else 0.0))
        del left[name]
        texts = trial.only(np.flatnonzero(~rejected))
    return plan


def passes(texts: Texts, order: list[str], rules: dict[str, Callable] = RULES) -> tuple[np.ndarray, np.ndarray]:
    """Whether each text passes all rules, and the place in ``order`` of the rule that rejected it (-1: none).

    A rule sees only what all before it passed, and what they or the caller have
    counted is not counted again.
    """
    alive, by = np.arange(len(texts)), np.full(len(texts), -1, dtype=np.int32)
    for place, name in enumerate(order):
        if not len(alive):
            break
        rejected = rules[name](texts)
        by[alive[rejected]] = place
        left = np.flatnonzero(~rejected)
        alive, texts = alive[left], texts.only(left)
    return by < 0, by


def filter_quality(docs: DataFrame, text: str = "text", rules: dict[str, Callable] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that every rule passes, with all their columns, in one scan without a shuffle.

    A null text has no words, so ``too_short`` rejects it. Repeated rows are
    judged one by one. An empty table stays empty.
    """
    order = [name for name, _, _ in cascade(sampled(docs, text, sample_rows), rules)]
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        for batch in batches:
            names = names or batch.schema.names
            # Names may clash among the extra columns; the text goes by its place.
            for piece in pieces([batch], batch.schema.field(place).name):
                kept, _ = passes(Texts(piece.column(place)), order, rules)
                yield piece.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: dict[str, Callable] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row for each document: its counts, ``base_failed``, ``kept`` and ``rejected_by``.

    Counts cover the whole text; null is an empty text, which fails. Only texts
    that the base passes enter the cascade of the further rules. ``rejected_by``
    names the rule that rejected a document first and so depends on the measured
    order; nothing else does.
    """
    further = {k: v for k, v in rules.items() if k not in BASE}
    # All counts are part of the report, so the cascade finds them known; it is estimated on what enters it, as it does.
    counts = lambda x: [x.n_words(), x.word_chars(), x.n_symbols(), x.lines()[1], x.n_repeat_words()]
    entering = Texts(sampled(docs, text, sample_rows))
    counts(entering)
    entering = entering.only(np.flatnonzero(~(too_short(entering) | repeats_itself(entering))))
    order = [name for name, _, _ in cascade(entering, further)]
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            x = Texts(piece.column("text"))
            told = counts(x)
            failed = too_short(x) | repeats_itself(x)
            alive = np.flatnonzero(~failed)
            kept, by = passes(x.only(alive), order, rules)
            verdict, names = np.zeros(len(x), dtype=bool), np.where(failed, "base", None).astype(object)
            verdict[alive[kept]] = True
            for i, place in zip(alive[~kept], by[~kept]):
                names[i] = order[place]
            yield pa.record_batch([piece.column("doc_id"), *map(pa.array, told), pa.array(failed), pa.array(verdict), pa.array(names, pa.string())], names=schema_names)

    schema_names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
