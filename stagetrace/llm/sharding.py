"""Shards by a hierarchical weighted hash tree.

A document descends from region to rack to shard. At every level each child draws an exponential time from a hash of
the document and the child, divided by the child's weight, and the earliest wins. A child's draw depends on
nothing but itself, so a change of weights moves documents only into or out of subtrees whose weights change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrace.llm.ranks import ranked
from stagetrace.llm.store import keep

OVERHEAD = 8


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. ``shard`` is set on leaves only; an inner node weighs what its children weigh."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(shards: int, per_rack: int = 4, per_region: int = 12) -> Node:
    """Equal shards, ``per_rack`` to a rack and ``per_region`` to a region."""

    def group(ids: list[int], size: int, name: str, below) -> tuple[Node, ...]:
        return tuple(Node(f"{name}{ids[i]}", below(ids[i:i + size])) for i in range(0, len(ids), size))

    leaves = lambda ids: tuple(Node(f"shard{i}", shard=i) for i in ids)
    racks = lambda ids: group(ids, per_rack, "rack", leaves)
    return Node("root", group(list(range(shards)), per_region, "region", racks))


def grown(root: Node, shard: int, weight: float = 1.0) -> Node:
    """One more shard in a region of its own: no other subtree's weight changes, so rows move only into it."""
    leaf = Node(f"shard{shard}", shard=shard, own_weight=weight)
    return Node(root.name, (*root.children, Node(f"region{shard}", (Node(f"rack{shard}", (leaf,)),))))


def descend(root: Node, key: Column) -> Column:
    """The shard of ``key``; NULL keys all take the same way. Children of weight 0 get nothing."""
    if root.shard is not None:
        return F.lit(root.shard)
    children = [c for c in root.children if c.weight > 0]
    if len(children) == 1:
        return descend(children[0], key)

    def draw(c: Node) -> Column:
        unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(c.name)), 11) + 1) / F.lit(float(1 << 53))
        return -F.ln(unit) / F.lit(float(c.weight))

    first = F.array_min(F.array(*(F.struct(draw(c).alias("t"), F.lit(i).alias("i")) for i, c in enumerate(children))))["i"]
    if all(c.shard is not None for c in children):
        return F.element_at(F.array(*(F.lit(c.shard) for c in children)), first + 1)
    # the way is worked out once per level, not once per branch
    return F.transform(F.array(first), lambda at: _branch(at, children, key))[0]


def _branch(at: Column, children: list[Node], key: Column) -> Column:
    out = F.lit(None).cast("int")
    for i, c in reversed(list(enumerate(children))):
        out = F.when(at == i, descend(c, key)).otherwise(out)
    return out


def assign(docs: DataFrame, root: Node, more: Node | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` of all ``docs``, and ``grown_shard`` under the tree ``more``.

    ``doc_id`` and the tree alone decide; documents with equal texts have no tie. ``size`` is the text's bytes in UTF-8 and
    ``OVERHEAD``; a NULL text has none. ``slot`` counts from 0 inside a shard without gaps. Rows that repeat
    an id go to the same shard, each with a slot of its own; rows with a NULL id share a shard.
    """
    key = F.col("doc_id")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), descend(root, key).alias("shard"),
                       (descend(more, key) if more else F.lit(None).cast("int")).alias("grown_shard"))
    return ranked(keep(rows, "sharded"), ["shard"], ["doc_id", "text_crc32"], "slot")
