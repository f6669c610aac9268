"""A Merkle tree over a dataset: a root that stands for all rows, and for every row a proof that it is under that root.

Rows are leaves, ordered inside groups; the groups' roots are ordered leaves of one more tree. A leaf's place in its group is
written in digits. The lowest digits name its place inside a block of bounded size: grouping a block's rows by all
digits but the lowest nests runs of siblings into their parent, the next grouping nests these, and so on, all on one
partitioning. Roots of blocks are the leaves of the next, much shorter, sequence. On the way back a block is opened
by nested transforms, each of which adds the siblings it passes to the path it was given, and one explode.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stagetrace.functions.scalar import floor_div
from stagetrace.llm.store import keep
from stagetrace.plans.skew import broadcast_if_small

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
# Digits grouped away inside one block: 2 ** 6 leaves.
DIGITS = 6
# Rows of one sorted range.
RANGE_ROWS = 250_000
_PATH = "array<struct<before: string, after: string>>"
_LONGEST = 63


def field(value: Column) -> Column:
    """A value that cannot be mistaken for another, whatever it holds: ``-`` for NULL, else its bytes, a colon and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*values), 256)


@dataclass
class Tree:
    """The written blocks of all levels, lowest first, and the ``tops``: one ``(g, h)`` per group."""

    blocks: list[DataFrame]
    tops: DataFrame
    fanout: int
    digits: int

    def proofs(self, upper: DataFrame) -> DataFrame:
        """``(item, h, path, more)`` per leaf. ``upper`` has per group the path above its root, and what else its leaves get."""
        paths = upper.select("g", F.lit(0).cast("long").alias("block"), "path", "more")
        for blocks in reversed(self.blocks):
            # a block and the path above it meet in a grouping: one row each
            node, none = blocks.schema["node"].dataType, F.lit(None)
            both = blocks.select("g", "block", "height", "node", none.cast(paths.schema["path"].dataType).alias("path"),
                                 none.cast(paths.schema["more"].dataType).alias("more"))
            both = both.unionByName(paths.select("g", "block", none.cast("int").alias("height"), none.cast(node).alias("node"), "path", "more"))
            whole = both.groupBy("g", "block").agg(*(F.first(c, True).alias(c) for c in ("height", "node", "path", "more")))
            leaves = F.inline(_opened(F.col("node"), F.col("path"), self.digits, self.fanout))
            paths = whole.select("g", "block", "more", leaves)
            at = F.col("block") * (self.fanout ** self.digits) + F.col("place")
            paths = paths.select("g", at.alias("block"), "item", "h", "path", "more")
        return paths.select("item", "h", "path", "more")


def _opened(node: Column, path: Column, depth: int, fanout: int) -> Column:
    """All leaves below ``node`` as an array of ``(item, h, path, place)``; ``path`` leads from ``node`` upwards."""

    def below(node: Column, path: Column, place: Column, depth: int) -> Column:
        if depth == 0:
            return F.array(F.struct(node["item"].alias("item"), node["h"].alias("h"), path.alias("path"), place.alias("place")))
        kids = node["kids"]
        hashes = F.transform(kids, lambda k: k["node"]["h"])

        def one(kid: Column, i: Column) -> Column:
            step = F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("before"),
                            F.array_join(F.slice(hashes, i + 2, F.lit(fanout)), "").alias("after"))
            longer = F.when(F.col("height") >= depth, F.concat(F.array(step), path)).otherwise(path)
            return below(kid["node"], longer, place * fanout + kid["at"], depth - 1)

        return F.flatten(F.transform(kids, one))

    return below(node, path, F.lit(0).cast("long"), depth)


def _nested(nodes: DataFrame, fanout: int, digits: int) -> DataFrame:
    """``(g, block, height, node)`` from ``(g, pos, height, item, h)``: the blocks' rows nested level by level."""
    digit = [F.pmod(floor_div("pos", fanout ** j), F.lit(fanout)).cast("int").alias(f"d{j}") for j in range(digits)]
    block = floor_div("pos", fanout ** digits)
    rows = nodes.select("g", block.alias("block"), "height", *digit, F.struct("item", "h").alias("node"))
    rows = rows.repartition("g", "block")
    for j in range(digits):
        upper = [f"d{i}" for i in range(j + 1, digits)]
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{j}").alias("at"), "node")))
        rows = rows.groupBy("g", "block", "height", *upper).agg(kids.alias("kids"))
        hashes = F.transform("kids", lambda k: k["node"]["h"])
        # a group with few leaves is closed before its block is: from there on nodes only pass through
        h = F.when(F.col("height") > j, F.sha2(F.array_join(hashes, ""), 256)).otherwise(hashes[0])
        rows = rows.select("g", "block", "height", *upper, F.struct(h.alias("h"), "kids").alias("node"))
    return rows


def _placed(nodes: DataFrame, order: list[str], fanout: int) -> DataFrame:
    """``(g, item, h)`` with ``pos``, the place in its group by ``order``, and ``height``, the levels above it."""
    n = nodes.count()
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(n / RANGE_ROWS))
    # equal rows may stand in any order; the number only lets ranges cut between them
    keys = ["g", *order, "_tie"]
    rows = nodes.withColumn("_tie", F.monotonically_increasing_id())
    rows = keep(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                .select("g", "item", "h", F.monotonically_increasing_id().alias("at")), "placed")
    part = F.shiftright("at", 33)
    # one row per range and one more per group; the window of a group spans ranges, not rows
    spans = rows.groupBy(part.alias("p"), F.col("g").alias("sg")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    group = W.partitionBy("sg")
    total = F.sum("n").over(group)
    height = reduce(lambda a, b: a + b, [(F.col("total") > fanout ** j).cast("int") for j in range(_LONGEST) if fanout ** j < 2 ** 63])
    spans = spans.select("p", "sg", "first", F.coalesce(F.sum("n").over(group.orderBy("p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"),
                         total.alias("total")).select("p", "sg", (F.col("base") - F.col("first")).alias("shift"), height.alias("height"))
    spans, _ = broadcast_if_small(spans, derived=True)
    met = rows.withColumn("_p", part).join(spans, (F.col("_p") == F.col("p")) & F.col("g").eqNullSafe(F.col("sg")))
    return met.select("g", (F.col("at") + F.col("shift")).alias("pos"), "height", "item", "h")


def grow(nodes: DataFrame, order: list[str], fanout: int = FANOUT, digits: int = DIGITS) -> Tree:
    """The trees of all groups ``g`` of ``nodes (g, item, h)``, whose leaves ascend by ``order``, and equal ones by nothing."""
    rows = _placed(nodes, order, fanout)
    blocks: list[DataFrame] = []
    while True:
        blocks.append(keep(_nested(rows, fanout, digits), "blocks"))
        roots = blocks[-1].select("g", F.col("block").alias("pos"), (F.col("height") - digits).alias("height"),
                                  F.lit(None).cast("string").alias("item"), F.col("node.h").alias("h"))
        if not roots.filter("height > 0").take(1):
            return Tree(blocks, roots.select("g", "h"), fanout, digits)
        rows = roots


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to when its siblings are those of ``path``."""
    return F.aggregate(path, start, lambda x, s: F.sha2(F.concat(s["before"], x, s["after"]), 256))


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", fields: tuple[str, ...] = FIELDS,
             altered: Mapping[str, Column] | None = None, fanout: int = FANOUT, digits: int = DIGITS) -> DataFrame:
    """``(order, leaf, subroot, root, path, proof_sha256, folded_root, verified)``, one row per row of ``docs``.

    A leaf is the SHA-256 of all ``fields``. Leaves ascend by ``order`` inside their ``group``, NULL first; rows that share it
    ascend by their leaf. Runs of ``fanout`` consecutive nodes become the digest of their hexadecimal digests joined, a last
    run of fewer as well, until one node remains, the ``subroot``; subroots in order of their group, NULL first, give
    the ``root`` likewise. ``path`` holds, level by level, the joined siblings ``before`` and ``after`` a node, and
    ``proof_sha256`` is the digest of all of them. ``folded_root`` is what the path leads to from the row with the
    columns ``altered`` in place of its own, so ``verified`` tells whether the row is still what the root stands for.

    Any column may be NULL; texts may be empty or of any length; equal rows are leaves next to each other; an empty
    table gives no rows. Other columns are not read, whatever their names. No group is gathered: a task holds whole blocks of
    ``fanout ** digits`` leaves, and the rows of a sorted range.
    """
    changed = {c: (altered or {}).get(c, F.col(c)) for c in fields}
    leaf = digest([field(F.col(c)) for c in fields])
    other = digest([field(changed[c]) for c in fields])
    own = F.to_json(F.struct(*(field(F.col(c)) for c in altered))) if altered else F.lit("")
    new = F.to_json(F.struct(*(field(c) for c in altered.values()))) if altered else F.lit("")
    rows = docs.select(F.col(group).alias("g"), F.col(order).alias("key"), leaf.alias("h"), F.when(own != new, other).alias("altered"))
    leaves = keep(rows.select("g", F.struct("key", "altered").alias("item"), "h"), "leaves")
    trees = grow(leaves, ["item.key", "h"], fanout, digits)
    top = grow(trees.tops.select(F.lit("").alias("g"), F.struct("g").alias("item"), "h"), ["item.g"], fanout, digits)
    roots = top.tops.select("g", F.array().cast(_PATH).alias("path"), F.struct(F.col("h").alias("root")).alias("more"))
    groups = top.proofs(roots).select("item.g", "path", F.struct(F.col("h").alias("subroot"), "more.root").alias("more"))
    found = trees.proofs(groups)
    siblings = F.transform("path", lambda s: F.concat(s["before"], s["after"]))
    return found.select(
        F.col("item.key").alias(order), F.col("h").alias("leaf"), "more.subroot", "more.root", "path",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        folded(F.coalesce("item.altered", "h"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
