"""A Merkle manifest of a table: a tree over each partition, a tree over their roots, and a proof for every row.

Built bottom up: leaves get their places in the order of their partition, and
each level's nodes are grouped by eight into the next, which is written before
the one above it is made. Proved top down: at each level the children join
their parents by (partition, place), prepend what stands around them in their
run to the suffix that the parent inherited, and hand it on. A parent holds the
digests of its own children and nothing else, so no task ever sees more of a
tree than runs of eight, whatever share of all rows one partition has.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.tables import in_order
from millrace.llm.common import ascii_lower, dropped, written

#: Children of a node.
FAN = 8
#: What stands before and after a node in its run, as hex text; a proof has one for each level, from the leaf up.
STEPS = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*values: Column) -> Column:
    """SHA-256 of all fields, as lower-case hex text."""
    return F.sha2(F.concat(*map(field, values)), 256)


def node_digest(run: Column) -> Column:
    return F.sha2(F.array_join(run, ""), 256)


@dataclass
class Tree:
    """Levels from the leaves up, each a written table: ``group, place, of, digest`` and, above the leaves, the ``run`` of children's digests; ``of`` nodes stand at this level of the group."""

    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """(group, top): the node that is left of every group."""
        found = [level.filter("of = 1").select("group", F.col("digest").alias("top")) for level in self.levels]
        whole = found[0]
        for one in found[1:]:
            whole = whole.unionByName(one)
        return whole

    def steps(self, suffixes: DataFrame) -> DataFrame:
        """(group, place, steps, ...): the path of every leaf; ``suffixes`` has for each group the ``steps`` above its top, and columns that are handed down. Levels above the leaves are deleted on the way."""
        more = [c for c in suffixes.columns if c not in ("group", "steps")]
        above = None
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            found = level.filter("of = 1").select("group", "place", *(["run"] if k else [])).join(suffixes, "group")
            if above is not None:
                parents = above.select("group", F.col("place").alias("up"), "run", "steps", *more)
                at = (F.col("place") % FAN).cast("int")
                mine = F.struct(F.array_join(F.slice(F.col("siblings"), 1, at), "").alias("left"), F.array_join(F.slice(F.col("siblings"), at + 2, FAN), "").alias("right"))
                met = level.filter("of > 1").select("group", "place", F.expr(f"place div {FAN}").alias("up"), *(["run"] if k else [])).join(parents.withColumnRenamed("run", "siblings"), ["group", "up"])
                found = found.unionByName(met.select("group", "place", *(["run"] if k else []), F.concat(F.array(mine), "steps").alias("steps"), *more))
            if k:
                found = written(found)
                if above is not None:
                    dropped(above)
                dropped(level)
            above = found
        return above


def grown(leaves: DataFrame) -> Tree:
    """The trees over a written table of ``group, place, of, digest``."""
    levels = [leaves]
    most = leaves.agg(F.max("of")).head()[0] or 0
    while most > 1:
        runs = levels[-1].filter("of > 1").groupBy("group", F.expr(f"place div {FAN}").alias("up"), F.ceil(F.col("of") / FAN).cast("long").alias("of"))
        up = runs.agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "digest"))), lambda x: x["digest"]).alias("run"))
        levels.append(written(up.select("group", F.col("up").alias("place"), "of", node_digest(F.col("run")).alias("digest"), "run")))
        most = ceil(most / FAN)
    return Tree(levels)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(steps, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text with its A-Z lower-cased where 3 divides the CRC-32 of the decimal doc_id, else the text; a null doc_id is left alone."""
    return F.when(F.crc32(doc_id.cast("string")) % 3 == 0, ascii_lower(text)).otherwise(text)


def manifest(docs: DataFrame, changed: Column | None = None, doc_id: str = "doc_id", source: str = "source", lang: str = "lang", n_chars: str = "n_chars", text: str = "text") -> DataFrame:
    """(doc_id, leaf, subroot, root, steps, proof_sha256, folded_root, verified) of every row.

    A leaf is the digest of doc_id, source, lang, n_chars and text; leaves of a
    lang ascend by doc_id (null first), rows of one doc_id by their leaf. ``steps``
    are the digests around the row's path from its run up to the root,
    ``proof_sha256`` the digest of them all. ``folded_root`` is what the row leads
    to when its text is ``changed``, and ``verified`` whether that is the root:
    without ``changed`` every row is. Repeated rows have places of their own and
    so proofs of their own. Nulls, empty and long texts are digested like any
    other value; other columns play no part; an empty table has no root and gives
    no rows. A language that holds most of the rows is dealt over tasks like any
    other, and any number of languages may occur.
    """
    facts = [F.col(doc_id).cast("long"), F.col(source), F.col(lang), F.col(n_chars)]
    altered = F.col(text) if changed is None else changed
    rows = docs.select(
        facts[0].alias("doc_id"), F.when(facts[2].isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), facts[2].cast("string"))).alias("group"), row_digest(*facts, F.col(text)).alias("digest"),
        F.when(~altered.eqNullSafe(F.col(text)), row_digest(*facts, altered)).alias("other"),
    )
    leaves = in_order(rows, ["group", F.col("doc_id").asc_nulls_first(), "digest"], "group", size="of")
    tree = grown(leaves.select("group", "place", "of", "digest"))
    # The roots of the languages are the leaves of one tree more.
    tops = in_order(tree.tops(), ["group"], size="of")
    crown = grown(tops.select(F.lit("").alias("group"), "place", "of", F.col("top").alias("digest")))
    root = F.lit((crown.tops().head() or [None, None])[1]).cast("string")
    above = crown.steps(docs.sparkSession.createDataFrame([("", [])], f"group string, steps {STEPS}"))
    suffixes = written(tops.select("group", "place", F.col("top").alias("subroot")).join(above.select("place", "steps"), "place").drop("place"))
    dropped(tops, above)
    met = leaves.drop("of").join(tree.steps(suffixes), ["group", "place"])
    found = met.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), "steps",
        F.sha2(F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), ""), 256).alias("proof_sha256"), folded(F.coalesce("other", "digest"), F.col("steps")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
