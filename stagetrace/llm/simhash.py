"""Near duplicates by SimHash, searched in BK-trees.

A BK-tree keeps under every node one child per integer Hamming distance; a search with radius r follows only
the edges whose distance lies within r of the distance to the node. One tree over everything would neither fit
a task nor be cheap to search, so fingerprints are dealt into shards in which near ones must meet, and
every shard has its own tree. Trees are built where their shard lies: a broadcast of them would grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stagetrace.llm.graph import components
from stagetrace.llm.groups import map_arrow, map_groups
from stagetrace.llm.store import keep
from stagetrace.plans.skew import broadcast_if_small

SEED = 42
# Fingerprints that one tree holds; larger shards are divided.
TREE_ROWS = 1000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = 1 << 14


# --- fingerprints


def normal_words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(_LOWER).split()


def shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``size`` words joined by spaces, in blocks; of all words if they are fewer."""
    if not words:
        return
    if len(words) < size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    for at in range(0, n, _STEP):
        to = min(n, at + _STEP)
        yield np.array([digest(joined[a:b - 1], SEED)
                        for a, b in zip(starts[at:to], ends[at + size - 1:to + size - 1], strict=True)], np.uint64)


def simhash(blocks: list[np.ndarray]) -> int:
    """Bits set in over half of the hashes; zero for none."""
    total, n = np.zeros(64, np.int64), 0
    for h in blocks:
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with ``fp`` in place of ``text``: the fingerprint of every whole text as a signed long; NULL or wordless texts have zero."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    columns = [c for c in docs.columns if c != "text"]
    schema = StructType([*docs.select(columns).schema.fields, StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [signed(simhash(list(shingle_hashes(normal_words(t), shingle))))
                   for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(fps, pa.int64())], names=[*columns, "fp"])

    return map_arrow(docs, run, schema)


# --- trees


class BKTree:
    """Items under integer fingerprints; items with one fingerprint share a node."""

    def __init__(self):
        self.root = None

    def add(self, fp: int, item: int) -> None:
        if self.root is None:
            self.root = (fp, [item], {})
            return
        node = self.root
        while True:
            d = (fp ^ node[0]).bit_count()
            if d == 0:
                node[1].append(item)
                return
            child = node[2].get(d)
            if child is None:
                node[2][d] = (fp, [item], {})
                return
            node = child

    def near(self, fp: int, radius: int) -> Iterator[list[int]]:
        """Items of every node at most ``radius`` bits away."""
        stack = [self.root] if self.root else []
        while stack:
            at, items, children = stack.pop()
            d = (fp ^ at).bit_count()
            if d <= radius:
                yield items
            stack += [c for e, c in children.items() if -radius <= e - d <= radius]


class Unions:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _search(radius: int):
    """Links of a spanning forest of every shard: enough for its components, never all pairs."""

    def groups(table: pa.Table, cuts: np.ndarray) -> dict:
        fps, nodes = table.column("fp").to_numpy().view(np.uint64).tolist(), table.column("node").to_numpy().tolist()
        home = table.column("home").to_pylist()
        u, v = [], []
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if last - first < 2:
                continue
            tree, joined = BKTree(), Unions(last - first)
            # rows of the tree come first, then those that only ask
            for i in range(first, last):
                for items in tree.near(fps[i], radius):
                    for j in items:
                        if joined.join(i - first, j - first):
                            u.append(nodes[i])
                            v.append(nodes[j])
                if home[i]:
                    tree.add(fps[i], i)
        return {"u": u, "v": v}

    return groups


def _pieces(rows: DataFrame, columns: list[str], tree_rows: int) -> DataFrame:
    """Shards ``(key, n, node, ...)`` of over ``tree_rows`` rows in pieces: one tree each, which all later pieces ask."""
    k = F.ceil(F.col("n") / tree_rows).cast("int")
    home = F.pmod(F.xxhash64("node", F.lit(1)), k).cast("int")
    return (rows.withColumn("at", home).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("at"))))
            .withColumn("home", F.col("piece") == F.col("at"))
            .select("key", "piece", F.when(F.col("home"), 0).otherwise(1).alias("turn"), "home", *columns))


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of shards with two rows or more, and ``n``."""
    return rows.join(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key")


# --- components within a radius


def shards(prints: DataFrame, radius: int, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Different fingerprints ``(fp)`` dealt so that any two at most ``radius`` bits apart meet.

    The bits form ``radius + 1`` blocks, of which such a pair shares one: a shard is the value of a block. Shards
    that are too large are dealt again in the same way by their other bits, and what is still too large goes
    into pieces.
    """
    parts = radius + 1
    width = 64 // parts

    def dealt(df: DataFrame, bits: int, used: str) -> DataFrame:
        """``rest`` holds the bits that are not equal yet, ``bits`` of them."""
        w = bits // parts
        options = []
        for b in range(parts):
            size = w if b < parts - 1 else bits - w * (parts - 1)
            mask = (1 << size) - 1
            value = F.shiftrightunsigned("rest", w * b).bitwiseAND(F.lit(mask))
            below = F.col("rest").bitwiseAND(F.lit((1 << (w * b)) - 1))
            above = F.shiftrightunsigned("rest", w * b + size) if w * b + size < 64 else F.lit(0).cast("long")
            options.append(F.struct(F.xxhash64(F.lit(used), F.lit(b), value, *([F.col("key")] if used == "2" else [])).alias("key"),
                                    above.bitwiseOR(F.lit(0)).alias("above"), below.alias("below"), F.lit(w * b).alias("shift")))
        out = df.withColumn("o", F.explode(F.array(*options)))
        rest = F.expr("shiftleft(o.above, o.shift) | o.below")
        return out.select(F.col("o.key").alias("key"), "fp", rest.alias("rest"))

    one = _sized(dealt(prints.withColumn("rest", F.col("fp")), 64, "1"))
    fits = one.filter(F.col("n") <= tree_rows).select("key", "n", "fp")
    # the last block may be wider than the others, then fewer bits are left: they count as zeros on both sides
    two = _sized(dealt(one.filter(F.col("n") > tree_rows).drop("n"), 64 - width, "2")).select("key", "n", "fp")
    return _pieces(fits.unionByName(two).withColumn("node", F.col("fp")), ["fp", "node"], tree_rows)


def within_radius(docs: DataFrame, shingle: int = 3, radius: int = 3, tree_rows: int = TREE_ROWS) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs (doc_id, text)``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the smallest ``doc_id``
    reachable. NULL and wordless texts have fingerprint zero and link like any other. A NULL ``doc_id`` gives no
    name to a component: its row gets the smallest other id, or NULL if there is none. Repeated rows stay repeated.
    Equal fingerprints are one node, so a group of copies costs no more than one document.
    """
    found = _labelled(docs.select("doc_id", "text"), shingle, radius, tree_rows)
    return found.select("doc_id", "fp", "component_id")


def _labelled(docs: DataFrame, shingle: int, radius: int, tree_rows: int) -> DataFrame:
    """Columns of ``docs`` but for ``text``, ``fp``, ``component`` (its smallest fingerprint) and ``component_id``."""
    prints = keep(fingerprints(docs, shingle), "prints")
    nodes = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    edges = map_groups(shards(nodes.select("fp"), radius, tree_rows), ["key", "piece"], ["turn", "fp"],
                       _search(radius), "u long, v long")
    links = components(edges)
    named = links.join(nodes, links["node"] == nodes["fp"]).select("fp", "component", "low")
    names = named.groupBy("component").agg(F.min("low").alias("name"))
    linked = named.join(names, "component").select("fp", "component", "name")
    labels = nodes.join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"),
                                                     F.coalesce("name", "low").alias("component_id"))
    return prints.join(labels, "fp")


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 3, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Rows of ``docs`` that stay: of every component of ``within_radius``, one row, that with the smallest ``doc_id``.

    Rows are told apart by their id and a hash of their text, so an id on several texts loses only those texts that
    an earlier row is near to. Of rows with equal id and text one stays, and among equal ids the smallest hash. NULL ids come last.
    NULL and wordless texts have fingerprint zero and are one group. Columns are those of ``docs``, whatever their names.
    """
    of = F.xxhash64("text")
    table = keep(_labelled(docs.select("doc_id", "text", of.alias("of")), shingle, radius, tree_rows), "labelled")
    row = F.struct(F.col("doc_id").isNull().alias("nul"), "doc_id", "of")
    first = table.groupBy("component").agg(F.count("*").alias("n"), F.min(row).alias("first")).filter("n > 1").select("component", "first")
    first, _ = broadcast_if_small(first, derived=True)
    company = keep(table.join(first, "component").select("doc_id", "of", (row == F.col("first")).alias("stays")), "company")
    stays = company.filter("stays").groupBy("doc_id", "of").count().filter("count > 1")

    def named(df: DataFrame) -> DataFrame:
        return broadcast_if_small(df.select(F.col("doc_id").alias("__id"), F.col("of").alias("__of")), derived=True)[0]

    def of_rows(marked: DataFrame, how: str, df: DataFrame) -> DataFrame:
        return df.join(marked, df["doc_id"].eqNullSafe(marked["__id"]) & (F.xxhash64(df["text"]) == marked["__of"]), how)

    left = of_rows(named(company.filter("NOT stays").select("doc_id", "of").distinct()), "left_anti", docs)
    twice = named(stays)
    if not twice.take(1):
        return left
    once = of_rows(twice, "left_semi", left).withColumn("__of", F.xxhash64("text")).dropDuplicates(["doc_id", "__of"])
    return of_rows(twice, "left_anti", left).unionByName(once.drop("__of"))
