"""Chat formatting with budgeted windows.

Prefix sums of the turns' tokens cut a conversation into turn-aligned spans: each
takes as many turns as the budget holds beside the system turn and the history
that would precede it. A window is one span, preceded by the system turn and by a limited history of the
turns before, both outside the loss mask: every assistant turn is a target
exactly once. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Marks of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# Strings that must not appear inside a turn.
CONTROL = ["<|", "|>", "<s>", "</s>", "[INST]", "[/INST]"]
#: Tokens that the marks of a turn count as.
MARK_TOKENS = 4


def escape(text: Column) -> Column:
    r"""Double every backslash, then put one after the first character of each control string.

    A single backslash (an odd run) after such a character is therefore always
    an inserted one, which makes the escaping reversible. Line feeds inside
    roles become ``<\N>``, see ``escape_role``.
    """
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: Column) -> Column:
    out = text
    for c in reversed(CONTROL):
        out = F.replace(out, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\N>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\N>"), F.lit("\n")))


def word_tokens(text: Column) -> Column:
    """Tokens of a text, counted as its words; callers may pass another count."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + MARK_TOKENS


def windows(turns: DataFrame, budget: int = 1024, history: int = 256, history_turns: int = 2, targets: Sequence[str] = ("assistant",), tokens=word_tokens) -> DataFrame:
    """(conv_id, window, formatted, loss, n_repeated, n_turns, n_tokens) of every window of the ``conv_id, turn, role, text`` rows.

    ``loss`` lists (start, length) of the target texts in code points of
    ``formatted``; ``n_repeated`` is how many turns at the head repeat. A window
    has at most ``budget`` tokens unless the system turn, the history and one
    turn alone exceed it. Null text and null role are empty; a null conv_id is a
    conversation; turns are ordered by turn (null first), role, text, and
    repeated rows are repeated turns. An empty table has no windows.
    """
    conv = Window.partitionBy("key")
    order = conv.orderBy("turn", "role", "text")
    # A structure is never null, so a null conv_id is a key like others, and one dealing of the turns serves all steps.
    clean = turns.select(F.struct("conv_id").alias("key"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    counted = clean.withColumn("tokens", tokens(F.col("text")))
    numbered = counted.withColumn("rn", F.row_number().over(order)).withColumn("before", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ruled = numbered.withColumn("system_rn", F.min(F.when(F.col("role") == "system", F.col("rn"))).over(conv))
    ruled = ruled.withColumn("system_tokens", F.coalesce(F.max(F.when(F.col("rn") == F.col("system_rn"), F.col("tokens"))).over(conv), F.lit(0)))
    # What a window that begins at a turn has room for: the turns before it that may be its history, and the system turn, go off.
    sums, taken = F.lit(0), F.lit(0)
    for back in range(1, history_turns + 1):
        sums = F.coalesce(F.col("before") - F.lag("before", back).over(order), F.lit(0))
        taken = F.when(sums <= history, F.greatest(sums, taken)).otherwise(taken)
    again = F.when(F.coalesce("system_rn", F.lit(1 << 30)) < F.col("rn"), F.col("system_tokens")).otherwise(0)
    roomy = ruled.withColumn("room", (F.lit(budget) - taken - again).cast("long"))
    # The spans of a conversation, from the numbers of its turns alone.
    each = F.array_sort(F.collect_list(F.struct("rn", F.col("tokens").cast("long").alias("tokens"), "room")))
    none = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("used"), F.lit(-1).cast("long").alias("room"))
    step = lambda s, x: F.when(s["used"] + x["tokens"] <= s["room"], F.struct(s["starts"].alias("starts"), (s["used"] + x["tokens"]).alias("used"), s["room"].alias("room"))).otherwise(
        F.struct(F.concat(s["starts"], F.array(x["rn"])).alias("starts"), x["tokens"].alias("used"), x["room"].alias("room"))
    )
    cuts = roomy.groupBy("key").agg(each.alias("each")).select("key", F.aggregate("each", none, step, lambda s: s["starts"]).alias("starts"))
    spanned = roomy.join(cuts.hint("shuffle_merge"), "key").drop("room")
    spanned = spanned.withColumn("window", F.sum(F.array_contains("starts", F.col("rn")).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("starts")
    spanned = spanned.withColumn("last_window", F.max("window").over(conv))
    back = Window.partitionBy("key", "window").orderBy(F.col("rn").desc())
    spanned = spanned.withColumn("from_end", F.row_number().over(back)).withColumn("tail", F.sum("tokens").over(back.rowsBetween(Window.unboundedPreceding, 0)))
    is_system = F.col("rn") == F.coalesce("system_rn", F.lit(-1))
    as_history = (F.col("from_end") <= history_turns) & (F.col("tail") <= history) & (F.col("window") < F.col("last_window")) & ~is_system
    # 0: the system turn again, 1: history, 2: the turn's own place.
    place = lambda window, kind: F.struct(window.cast("long").alias("window"), F.lit(kind).alias("kind"))
    none = F.array().cast("array<struct<window:bigint,kind:int>>")
    places = F.concat(
        F.array(place(F.col("window"), 2)),
        F.when(as_history, F.array(place(F.col("window") + 1, 1))).otherwise(none),
        F.when(is_system & (F.col("window") < F.col("last_window")), F.transform(F.sequence(F.col("window") + 1, F.col("last_window")), lambda w: place(w, 0))).otherwise(none),
    )
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    laid = spanned.select("key", "rn", "tokens", F.col("role").isin(*targets).alias("target"), head.alias("head"), escape(F.col("text")).alias("body"), F.inline(places))
    laid = laid.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    here = Window.partitionBy("key", "window").orderBy("kind", "rn")
    offset = F.coalesce(F.sum(F.length("piece")).over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    laid = laid.withColumn("start", offset + F.length("head"))
    part = F.struct("kind", "rn", "piece", "start", F.length("body").alias("length"), ((F.col("kind") == 2) & F.col("target")).alias("learn"))
    grouped = laid.groupBy("key", "window").agg(
        F.array_sort(F.collect_list(part)).alias("parts"), F.count_if(F.col("kind") < 2).alias("n_repeated"), F.count("*").alias("n_turns"), F.sum("tokens").alias("n_tokens")
    )
    loss = F.transform(F.filter("parts", lambda p: p["learn"]), lambda p: F.struct(p["start"].cast("long").alias("start"), p["length"].cast("long").alias("length")))
    return grouped.select("key.conv_id", "window", F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"), loss.alias("loss"), "n_repeated", "n_turns", "n_tokens")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns array<struct<role, text>>, learned array<string>): the turns that are new in each window, and the texts under its loss mask, both unescaped from the output of ``windows``."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    new = F.slice(pieces, F.col("n_repeated").cast("int") + 1, (F.col("n_turns") - F.col("n_repeated")).cast("int"))
    body = F.transform(new, lambda p: F.substring(p, len(OPEN) + 1, 2_000_000_000))
    parsed = F.transform(
        body,
        lambda b: F.struct(unescape_role(F.substring_index(b, "\n", 1)).alias("role"), unescape(b.substr(F.length(F.substring_index(b, "\n", 1)) + 2, F.length(b))).alias("text")),
    )
    learned = F.transform("loss", lambda s: unescape(F.col("formatted").substr((s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", "window", parsed.alias("turns"), learned.alias("learned"), F.length("formatted").cast("long").alias("chars"))
