"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds what they miss.

The field scores whole candidate segments of up to ``MAX_TOKENS`` tokens with
features of the full span (shape, checksum, edges, cue words before it) and
label transitions; a dynamic program chooses boundaries and types of a region
jointly. It is trained here, by maximum likelihood, on a bounded sample of
regions of the corpus that the base patterns label and on generated sentences
with loosely written data. Base spans always stay; a span of the field that
overlaps one of them is dropped.
"""

from __future__ import annotations

import random
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

#: Tokens in the longest segment that is scored, white space and signs included; the field adds no longer span.
MAX_TOKENS = 24
#: Most regions of the corpus that training takes.
TRAIN_REGIONS = 300
#: Generated sentences that training takes besides.
GENERATED = 300
#: Code points of context on either side of what may be personal data.
CONTEXT = 40

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# Matches begin at the head of a run of digits, and a run never gives digits back: the next thing must be a dot.
FOUR = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"[0-9][0-9()./\x20+-]{5,}[0-9]")
JOINED_BEFORE, JOINED_AFTER = re.compile(r"[0-9][ ./-]\Z"), re.compile(r"[ ./-][0-9]")
CODED = re.compile(r"(?:[A-Za-z][0-9]+|[0-9]+[A-Za-z])[0-9A-Za-z]*[ -]?\Z")
BRACKETED = re.compile(r"[(\[]\s?at\s?[)\]]")
SPELLED = re.compile(r" at \S++ dot ")
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, begin, end) of the base patterns in code points: by kind in the order of KINDS, then by begin."""
    out = []
    past = 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            # The local part reaches back as far as its characters go, not into the match before.
            begin = m.start()
            while begin > past and LOCAL.match(text, begin - 1, begin):
                begin -= 1
            if begin < m.start():
                out.append(("email", begin, m.end()))
                past = m.end()
    out += [("ip", m.start(), m.end()) for m in FOUR.finditer(text) if octets(m[0])]
    for m in DIGITS.finditer(text):
        digits = only_digits(m[0]) if len(m[0]) < 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(only_digits(m[0])) <= 15]
    return out


# --- features -------------------------------------------------------------

# Words that announce a kind, in the languages of the corpus.
CUES = {
    "email": {"mail", "email", "contact", "contacto", "courriel", "kontakt", "schreiben", "write"},
    "ip": {"ip", "host", "server", "address", "adresse", "servidor", "serveur"},
    "card": {"card", "visa", "payment", "carte", "tarjeta", "karte", "kreditkarte"},
    "phone": {"tel", "phone", "call", "fax", "mobile", "telefon", "telefono", "anruf", "appel"},
}
STRICT_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}")
TRUNK = re.compile(r"0[0-9]{1,4}(?:[ ./-][0-9]{2,8}){1,5}")
SPOKEN_EMAIL = re.compile(r"[\w.+-]+\s?[(\[]\s?at\s?[)\]]\s?[\w-]+(?:(?:\.|\s?[(\[]\s?dot\s?[)\]]\s?)[\w-]+)+|[\w.+-]+ at [\w-]+(?: dot [\w-]+)+")
AREA = re.compile(r"(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}")
GROUPS = re.compile(r"(?:\+?[0-9]{1,3}[ .-])?[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}")
FOURS = re.compile(r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}")
N_FEATURES = 11


def features(kind: str, span: str, left: str, right: str, cues: set[str], goes_on: bool, coded: bool) -> list[float]:
    """Features of a whole span as one kind; ``left`` and ``right`` are the characters at its edges, ``goes_on`` tells of digits beyond one space, dot or hyphen, ``coded`` of a word with letters and digits just before."""
    digits = only_digits(span)
    n = len(digits)
    out = [1.0, float(not (left.isalnum() or left in "_@")), float(not (right.isalnum() or right in "_@")), float(bool(cues & CUES[kind])), float(goes_on), float(coded)]
    if kind == "email":
        strict = bool(STRICT_EMAIL.fullmatch(span))
        out += [float(strict), float(not strict), float(len(span) > 60), float(left in ".+-%"), 0.0]
    elif kind == "ip":
        four = bool(FOUR.fullmatch(span))
        out += [float(four and octets(span)), float(four and not octets(span)), float(not four), float(left == "." or right == "."), 0.0]
    elif kind == "card":
        sized = 13 <= n <= 19
        sure = sized and luhn(digits) and not goes_on
        out += [float(sure), float(sized and not sure), float(not sized), float(bool(FOURS.fullmatch(span)) and sure), float(not sure and any(c in span for c in "+()."))]
    else:
        sized = 9 <= n <= 15
        shaped = bool(AREA.fullmatch(span) or GROUPS.fullmatch(span) or TRUNK.fullmatch(span)) and not goes_on
        out += [float(sized and span[0] == "+"), float(sized and shaped and span[0] != "+"), float(not sized), float(span == digits), float(not shaped and span[0] != "+")]
    return out


class Region:
    """Tokens of a stretch of text, in a few bytes each; candidate segments are made when they are asked for."""

    def __init__(self, text: str, begin: int, end: int):
        self.text, self.at, kinds, loud = text, array("q", [begin]), bytearray(), bytearray()
        for m in TOKEN.finditer(text, begin, end):
            t = m[0]
            first = t[0]
            if "0" <= first <= "9":
                kind = "d"
            elif first.isalpha():
                kind = "a"
            elif first.isspace():
                kind = "n" if "\n" in t else "s"
            else:
                kind = first if first in ".()+-/@" else "?"
            kinds += kind.encode()
            loud.append(kind == "@" or t.lower() == "at")
            self.at.append(m.end())
        self.n, self.kinds, self.loud = len(kinds), kinds.decode(), bytes(loud)

    def segments_from(self, i: int) -> Iterator[tuple[int, int, list[float]]]:
        """(token after the last, label, features) of the candidate segments that begin at token ``i``."""
        text, at, kinds, loud = self.text, self.at, self.kinds, self.loud
        if kinds[i] not in "da+(":
            return
        most = min(self.n, i + MAX_TOKENS)
        line = kinds.find("n", i, most)
        most = most if line < 0 else line
        around = None
        numeric, digits, dots, ats = True, 0, 0, 0
        may_be_email = kinds[i] in "da" and not loud[i] and loud.find(1, i, most) >= 0
        for j in range(i + 1, most + 1):
            k = kinds[j - 1]
            numeric = numeric and k in "ds.()+-/"
            if not (numeric or may_be_email):
                break
            if k == "d":
                digits += at[j] - at[j - 1]
            elif k == ".":
                dots += 1
            ats += loud[j - 1]
            if k not in "da":
                continue
            labels = []
            if ats == 1 and may_be_email and not (numeric or loud[j - 1]):
                span = text[at[i] : at[j]]
                if STRICT_EMAIL.fullmatch(span) or SPOKEN_EMAIL.fullmatch(span):
                    labels.append("email")
            if numeric and k == "d":
                if dots == 3 and kinds[i] == "d":
                    labels.append("ip")
                if 13 <= digits <= 19 and kinds[i] == "d":
                    labels.append("card")
                if 7 <= digits <= 15:
                    labels.append("phone")
            if not labels:
                continue
            if around is None:
                near = (text[at[w] : at[w + 1]].lower() for w in range(max(0, i - 6), i) if kinds[w] == "a")
                around = (
                    text[at[i] - 1] if at[i] else " ", {w for w in near if w.isalpha()},
                    bool(JOINED_BEFORE.search(text, max(0, at[i] - 2), at[i])), bool(CODED.search(text, max(0, at[i] - 8), at[i])),
                )
            left, cues, digit_before, coded = around
            right = text[at[j]] if at[j] < len(text) else " "
            goes_on = digit_before or bool(JOINED_AFTER.match(text, at[j]))
            for label in labels:
                yield j, LABELS.index(label), features(label, text[at[i] : at[j]], left, right, cues, goes_on, coded)

    @property
    def segments(self) -> list[tuple[int, int, int, list[float]]]:
        """(first token, token after the last, label, features) of all candidates."""
        return [(i, *x) for i in range(self.n) for x in self.segments_from(i)]

    def gold(self, spans: list[tuple[str, int, int]]) -> dict[tuple[int, int], int]:
        """Token ranges of given spans; of spans that overlap the first stays."""
        place = {c: k for k, c in enumerate(self.at)}
        out, past = {}, -1
        for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
            if begin in place and end in place and place[begin] >= past:
                out[place[begin], place[end]] = LABELS.index(kind)
                past = place[end]
        return out


class Field:
    """Weights of the semi-Markov field: by label and feature, and by label and label before."""

    def __init__(self):
        self.weights = np.zeros((len(LABELS), N_FEATURES))
        self.turns = np.zeros((len(LABELS), len(LABELS)))

    def lattice(self, region: Region) -> list[list[tuple[int, int, float, list[float] | None]]]:
        """Segments by the token after their last: (first, label, score, features); any single token may be none."""
        by_end: list[list] = [[] for _ in range(region.n + 1)]
        for j in range(1, region.n + 1):
            by_end[j].append((j - 1, 0, float(self.weights[0, 0]), None))
        weights = self.weights.tolist()
        for i, j, label, values in region.segments:
            by_end[j].append((i, label, sum(w * v for w, v in zip(weights[label], values)), values))
        return by_end

    def best(self, region: Region) -> list[tuple[str, int, int]]:
        """The best segmentation's spans, by a dynamic program over ends and labels.

        No segment has more than ``MAX_TOKENS`` tokens, so only the scores of as
        many ends are held; the way back takes two bytes for each token and label.
        """
        m, n, turns, weights, none = len(LABELS), region.n, self.turns.tolist(), self.weights.tolist(), float(self.weights[0, 0])
        width = MAX_TOKENS + 1
        score = [[-1e300] * m for _ in range(width)]
        length, before = bytearray(m * (n + 1)), bytearray(m * (n + 1))
        score[0][0] = 0.0
        for i in range(n):
            prior = score[i % width]
            into: dict[int, tuple[float, int]] = {}

            def reach(j: int, label: int, own: float) -> None:
                if label not in into:
                    row = turns[label]
                    into[label] = max((prior[p] + row[p], -p) for p in range(m))  # noqa: B023
                value, last = into[label]
                there = score[j % width]
                if value + own > there[label]:
                    there[label] = value + own
                    length[m * j + label], before[m * j + label] = j - i, -last  # noqa: B023

            reach(i + 1, 0, none)
            for j, label, values in region.segments_from(i):
                reach(j, label, sum(w * v for w, v in zip(weights[label], values)))
            score[i % width] = [-1e300] * m  # for the end that comes next in this place
        out, j = [], n
        label = max(range(m), key=lambda k: (score[n % width][k], -k))
        while j:
            i, last = j - length[m * j + label], before[m * j + label]
            if label:
                out.append((LABELS[label], region.at[i], region.at[j]))
            j, label = i, last
        return out[::-1]

    def gradient(self, region: Region, gold: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
        """Observed less expected features of one region."""
        lattice, n, m = self.lattice(region), region.n, len(LABELS)
        ahead = np.full((n + 1, m), -1e300)
        ahead[0, 0] = 0.0
        for j in range(1, n + 1):
            for i, label, own, _ in lattice[j]:
                ahead[j, label] = np.logaddexp(ahead[j, label], own + np.logaddexp.reduce(ahead[i] + self.turns[label]))
        behind = np.full((n + 1, m), -1e300)
        behind[n] = 0.0
        total = np.logaddexp.reduce(ahead[n])
        weights, turns = np.zeros_like(self.weights), np.zeros_like(self.turns)
        truth, j, before, kept = {}, 0, 0, set(gold)
        held = {(i, j) for i, j, label, _ in region.segments if gold.get((i, j)) == label}
        while j < n:
            end = next((b for a, b in kept if a == j and (a, b) in held), None)
            label = gold[j, end] if end else 0
            turns[label, before] += 1
            truth[j, end or j + 1] = label
            before, j = label, end or j + 1
        for j in range(n, 0, -1):
            for i, label, own, values in lattice[j]:
                inward = ahead[i] + self.turns[label] + own + behind[j, label]
                share = np.exp(inward - total)
                behind[i] = np.logaddexp(behind[i], self.turns[label] + own + behind[j, label])
                seen = float(truth.get((i, j)) == label) - share.sum()
                turns[label] -= share
                if values is None:
                    weights[0, 0] += seen
                else:
                    weights[label] += seen * np.array(values)
        return weights, turns


def fit(examples: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 5, rate: float = 0.5, decay: float = 0.002, seed: int = 11) -> Field:
    """Maximum likelihood with a quadratic penalty, by AdaGrad."""
    field, order = Field(), random.Random(seed)
    regions = [(region := Region(text, 0, len(text)), region.gold(spans)) for text, spans in examples]
    sums = [np.full_like(field.weights, 1e-6), np.full_like(field.turns, 1e-6)]
    for _ in range(rounds):
        order.shuffle(regions)
        for region, gold in regions:
            for own, up, past in zip((field.weights, field.turns), field.gradient(region, gold), sums):
                up = up - decay * own
                past += up * up
                own += rate * up / np.sqrt(past)
    return field


def generated(n: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Sentences with personal data written in many ways, and with numbers that are none."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("re", "th", "an", "on", "er", "la", "de", "ung", "ci")) for _ in range(r.randint(1, 3)))
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def card() -> str:
        stem = digits(15)
        return next(stem + c for c in "0123456789" if luhn(stem + c))

    def one() -> tuple[str, str | None]:
        kind = r.choice((*KINDS, *KINDS, None))
        if kind == "email":
            name, host, end = word() + r.choice(("", ".", "_")) + word(), word() + r.choice(("", digits(1))), r.choice(("com", "org", "net", "de"))
            return r.choice((f"{name}@{host}.{end}", f"{name}@{host}.example.{end}", f"{word()} (at) {host} (dot) {end}", f"{name} at {host} dot {end}", f"{word()}[at]{host}.{end}", f"{name} (at) {host} (dot) {end}", f"{name} at {word()} dot {host} dot {end}")), kind
        if kind == "ip":
            return ".".join(str(r.randint(0, 255)) for _ in range(4)), kind
        if kind == "card":
            c = card()
            return r.choice((c, " ".join(c[k : k + 4] for k in range(0, 16, 4)), "-".join(c[k : k + 4] for k in range(0, 16, 4)))), kind
        if kind == "phone":
            a, b, c = digits(3), digits(3), digits(4)
            return r.choice((f"+1 ({a}) {b}-{c}", f"+{r.randint(20, 99)} {a} {b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a} {b} {c}", f"0{digits(2)} {digits(6)}", f"0{digits(2)} {digits(5)} {digits(2)}", f"0{digits(3)}/{digits(6)}", "0" + r.choice("1234567") + "".join(f" {digits(2)}" for _ in range(4)))), kind
        spoiled = "".join((c := card())[:-1]) + str((int(c[-1]) + 5) % 10)
        return r.choice((spoiled, digits(r.randint(5, 8)), f"{digits(4)}-{digits(2)}-{digits(2)}", f"{digits(3)}.{r.randint(256, 999)}.{digits(2)}.{digits(1)}", f"{word()} at {word()}", f"{digits(2)} {digits(2)} {digits(2)}", f"{digits(24)}", f"{r.choice(('DE', 'FR', 'GB'))}{digits(2)}" + "".join(f" {digits(4)}" for _ in range(4)) + f" {digits(2)}", f"{digits(2)}.{digits(2)}.{digits(4)}", f"v{digits(1)}.{digits(2)}.{digits(2)}", f"{digits(4)}:{digits(2)}", f"{digits(3)}-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}")), None

    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(r.randint(1, 2)):
            text += " ".join(word() for _ in range(r.randint(1, 5))) + r.choice((" ", " ", ": ", ", "))
            span, kind = one()
            if kind:
                spans.append((kind, len(text), len(text) + len(span)))
            text += span + r.choice((" ", ". ", ", ", "; "))
        out.append((text + word(), spans))
    return out


def train(docs: DataFrame, text: str = "text", regions: int = TRAIN_REGIONS, seed: int = 5) -> Field:
    """Fit the field on at most ``regions`` stretches of the corpus, in an order of their hashes, labelled by the base patterns, and on generated sentences."""
    at = F.regexp_instr(F.col(text), F.lit(r"[0-9][0-9 ().+-]{5}|@")).alias("at")
    near = F.substring(F.col(text), F.greatest(F.col("at") - CONTEXT, F.lit(1)), F.lit(3 * CONTEXT)).alias("near")
    found = docs.select(text, at).filter("at > 0").select(near).orderBy(F.xxhash64("near"), "near").limit(regions).toArrow().column("near").to_pylist()
    return fit([(t, base_spans(t)) for t in found] + generated(GENERATED, seed))


def triggers(text: str) -> Iterator[tuple[int, int]]:
    """Where personal data may stand: all that a candidate segment needs, found by cheap searches."""
    yield from (m.span() for m in NUMBER.finditer(text))
    at = text.find("@")
    while at >= 0:
        yield at, at + 1
        at = text.find("@", at + 1)
    if "at)" in text or "at]" in text or "at )" in text or "at ]" in text:
        yield from (m.span() for m in BRACKETED.finditer(text))
    if " dot " in text:
        yield from (m.span() for m in SPELLED.finditer(text))


def field_spans(text: str, field: Field) -> list[tuple[str, int, int]]:
    """Spans of the field in all regions of a text that may hold personal data."""
    out, regions = [], []
    for start, stop in sorted(triggers(text)):
        start, stop = max(0, start - CONTEXT), min(len(text), stop + CONTEXT)
        # Whole words only, or an edge would look like a span's end. What a region before has taken is not walked again.
        floor = regions[-1][1] if regions else 0
        while start > floor and text[start].isalnum() and text[start - 1].isalnum():
            start -= 1
        stop = max(stop, floor)
        while floor < stop < len(text) and text[stop].isalnum() and text[stop - 1].isalnum():
            stop += 1
        if regions and start <= floor:
            regions[-1][1] = stop
        else:
            regions.append([start, stop])
    for a, b in regions:
        out += field.best(Region(text, a, b))
    return out


def all_spans(text: str, field: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base spans, and all spans: base ones and those of the field that overlap none, by kind and begin."""
    base = base_spans(text)
    # Of the base spans that begin before a span ends, the one that reaches farthest decides whether any overlaps it.
    taken = sorted((a, b) for _, a, b in base)
    begins, ends = [a for a, _ in taken], [0, *accumulate((b for _, b in taken), max)]
    more = [s for s in field_spans(text, field) if ends[bisect_left(begins, s[2])] <= s[1]]
    order = {k: n for n, k in enumerate(KINDS)}
    return base, sorted(base + more, key=lambda s: (order[s[0]], s[1]))


SPANS = "array<struct<kind:string,begin:long,end:long>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))


def listed(spans: list[tuple[str, int, int]]) -> list[dict]:
    return [{"kind": k, "begin": a, "end": b} for k, a, b in spans]


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """(doc_id, base, spans) of every row: arrays of (kind, begin, end) in code points, ordered by kind and begin.

    Whole texts are searched, in one scan without a shuffle. A null text has no
    spans. Repeated rows give repeated rows, an empty table an empty one. Spans
    of the base patterns have any length; those of the field have at most
    ``MAX_TOKENS`` tokens.
    """
    field = field or train(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            both = [all_spans(t or "", field) for t in piece.column("text").to_pylist()]
            yield pa.record_batch([piece.column("doc_id"), *(pa.array([listed(x[k]) for x in both], SPAN_TYPE) for k in (0, 1))], names=["doc_id", "base", "spans"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id long, base {SPANS}, spans {SPANS}")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap become one, of the first one's kind."""
    out, past = [], 0
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= past:
            out += [text[past:begin], f"[{kind.upper()}]"]
        past = max(past, end)
    return "".join(out) + text[past:]


def redact(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """All rows and columns of ``docs``, with personal data in ``text`` masked; a null text stays null."""
    field = field or train(docs, text)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name = batch.schema.field(place).name
            for piece in pieces([batch], name):
                texts = [t if t is None else masked(t, all_spans(t, field)[1]) for t in piece.column(place).to_pylist()]
                yield piece.set_column(place, name, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
