"""Near-duplicate vectors by sorted projection passes.

In each pass the vectors of a label are put into the lexicographic order of several random hashes (which of many random
directions a vector points along most, seen from the mean of its label); near vectors share long prefixes, so they stand close in some
pass. How many passes a label takes follows from its size and its spread. Every vector is
compared with a bounded window of its successors, and verified pairs of all passes are united. What a window found
gives components; how many links a vector has is then counted inside its component, in blocks, so dense groups are
neither cut short by the window nor written out pair by pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrace.llm.graph import components
from stagetrace.llm.groups import map_arrow, map_groups
from stagetrace.llm.store import keep
from stagetrace.plans.skew import broadcast_if_small, skewed_join

COSINE = 0.98
# A label takes PASSES at least, and as many that a single pair is lost in all of them with a probability of MISSED.
PASSES, WINDOW, MISSED = 16, 32, 0.002
# Directions that one hash chooses among.
DIRECTIONS = 64
# In units of the typical length of a label's centred vectors, how many bits of each bit of order a pair at distance 1 loses in
# a pass: measured at 200 000 vectors of 64 components with a base cosine of 0, 0.8, 0.9 and 0.95 (0.359 to 0.378).
LOST = 0.4
# Means that may be broadcast, in bytes, and the doubles of random directions that a worker remembers.
MEANS_BYTES, REMEMBERED = 16 << 20, 4 << 20
# Labels whose sums a task holds at once.
OPEN_LABELS = 4096
# Members of a component compared in one block.
BLOCK = 512


# --- vectors


def _raw(values: list | None) -> bytes | None:
    """A vector's components as doubles; None if it cannot be compared."""
    if not values or None in values:
        return None
    x = np.array(values, np.float64)
    return x.tobytes() if np.isfinite(x).all() and x.any() and np.isfinite(x @ x) and x @ x > 0 else None


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for i, values, label in zip(*(b.column(c).to_pylist() for c in ("vec_id", "embedding", "label")), strict=True):
            raw = _raw(values) if i is not None and label is not None else None
            group = None if raw is None else f"{len(raw) // 8} {label}"
            rows.append((i, group, None if raw is None else hashlib.md5(f"{group}\n".encode() + raw).digest(), raw))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.binary(), pa.binary()), strict=True)],
                                         names=["vec_id", "grp", "content", "vec"])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of every row of ``a`` with the same row of ``b``."""
    return np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


# --- how a label's vectors lie


def _units(vecs: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many unit vectors of every label a task saw, and their sum."""
    held: dict[str, list] = {}

    def out() -> pa.RecordBatch:
        rows = [(g, n, x.tobytes()) for g, (n, x) in held.items()]
        held.clear()
        columns = list(zip(*rows, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary()), strict=True)], names=["grp", "n", "sum"])

    for b in batches:
        names, vecs = np.array(b.column("grp").to_pylist(), object), b.column("vec").to_pylist()
        order = np.argsort(names, kind="stable")
        cuts = [0, *(np.flatnonzero(names[order][1:] != names[order][:-1]) + 1).tolist(), len(order)]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if z > a:
                own = held.setdefault(names[order[a]], [0, 0.0])
                own[0] += z - a
                own[1] = own[1] + _units([vecs[i] for i in order[a:z]]).sum(axis=0)
        if len(held) > OPEN_LABELS:
            yield out()
    yield out()


def _means(cosine: float, passes: int, window: int, missed: float):
    def groups(table: pa.Table, cuts: np.ndarray) -> dict:
        n, sums, grp = table.column("n").to_numpy(), table.column("sum").to_pylist(), table.column("grp")
        rows: dict = {"grp": [], "n": [], "mean": [], "passes": []}
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            total = int(n[a:z].sum())
            mean = np.frombuffer(b"".join(sums[a:z]), np.float64).reshape(z - a, -1).sum(axis=0) / total
            rows["grp"].append(grp[a].as_py())
            rows["n"].append(total)
            rows["mean"].append(mean.tobytes())
            rows["passes"].append(passes_for(total, 1 - float(mean @ mean), cosine, passes, window, missed))
        return rows

    return groups


def passes_for(n: int, spread: float, cosine: float, passes: int = PASSES, window: int = WINDOW, missed: float = MISSED) -> int:
    """Passes over ``n`` vectors of a label whose centred unit vectors have the mean square length ``spread``.

    A pass brings a pair together with a probability that falls with the size and with the pair's distance in units of the
    spread. Where pairs at ``cosine`` lie no nearer than others do, chance brings them together.
    """
    if n <= window + 1:
        return 1  # all are compared
    apart = min(2.0, (2 - 2 * cosine) / max(spread, 1e-9)) ** 0.5
    found = (n / window) ** (-LOST * apart)
    return max(passes, ceil(log(missed) / log1p(-min(found, 0.999))))


# --- passes


def _directions(pass_: int, dim: int, hashes: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([pass_, dim])).standard_normal((dim, hashes * min(dim, DIRECTIONS)))


def _order(x: np.ndarray, directions: np.ndarray, hashes: int) -> np.ndarray:
    """The hashes of every row as one number: for each, the direction and the side that a row points along most."""
    along = x @ directions
    k = along.shape[1] // hashes
    out = np.zeros(len(x), np.int64)
    for h in range(hashes):
        part = along[:, h * k:(h + 1) * k]
        most = np.abs(part).argmax(axis=1)
        out = out * (2 * k) + 2 * most + (part[np.arange(len(x)), most] > 0)
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for b in batches:
        if not b.num_rows:
            continue
        vecs, means = b.column("vec").to_pylist(), b.column("mean").to_pylist()
        passes, n = b.column("passes").to_numpy(), b.column("n").to_numpy()
        sizes = np.array([len(v) // 8 for v in vecs])
        # as many hashes as tell 64 times the vectors of a label apart, within 62 bits
        values = np.log2(2.0 * np.minimum(sizes, DIRECTIONS))
        hashes = np.clip(np.ceil(np.log2(64.0 * n) / values), 1, 62 // values).astype(int)
        x: list = [None] * len(vecs)
        for size in np.unique(sizes):
            k = np.flatnonzero(sizes == size)
            for i, row in zip(k.tolist(), _units([vecs[i] for i in k]), strict=True):
                x[i] = row if means[i] is None else row - np.frombuffer(means[i], np.float64)
        for p in range(int(passes.max())):
            rows = np.flatnonzero(passes > p)
            order = np.zeros(len(vecs), np.int64)
            for size, m in {(int(sizes[i]), int(hashes[i])) for i in rows}:
                if (p, size, m) not in known:
                    if sum(v.size for v in known.values()) > REMEMBERED:
                        known.clear()
                    known[p, size, m] = _directions(p, size, m)
                k = rows[(sizes[rows] == size) & (hashes[rows] == m)]
                order[k] = _order(np.stack([x[i] for i in k]), known[p, size, m], m)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), p, np.int32)), b.column("grp").take(at), pa.array(order[rows]),
                                              b.column("node").take(at), b.column("vec").take(at)], names=["pass", "grp", "hash", "node", "vec"])


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the links between rows."""
    up: dict[int, int] = {}

    def root(i: int) -> int:
        while (j := up.get(i, i)) != i:
            up[i] = up.get(j, j)
            i = j
        return i

    out = ([], [])
    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        ra, rb = root(a), root(b)
        if ra != rb:
            up[max(ra, rb)] = min(ra, rb)
            out[0].append(a)
            out[1].append(b)
    return out


def neighbours(keys: list, vecs: list[bytes], nodes: np.ndarray, window: int, cosine: float, fresh: int = 0) -> tuple[list[int], list[int]]:
    """Linked nodes among rows in order, each with its ``window`` successors of equal key; of the first ``fresh`` rows
    with one another nothing, for that was done before."""
    us, vs = [], []
    cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        x = np.frombuffer(b"".join(vecs[a:z]), np.float64).reshape(z - a, -1)
        x = x / np.linalg.norm(x, axis=1)[:, None]
        for step in range(1, min(window, z - a - 1) + 1):
            # a coarse check first; the verdict is that of the vectors as they came
            i = np.flatnonzero(np.einsum("ij,ij->i", x[:-step], x[step:]) >= cosine - 1e-9)
            i = i[i + step + a >= fresh]
            if len(i):
                raw = [np.frombuffer(b"".join(vecs[a + j] for j in k), np.float64).reshape(len(i), -1) for k in (i, i + step)]
                good = i[cosines(*raw) >= cosine]
                us.append(good + a)
                vs.append(good + a + step)
    if not us:
        return [], []
    u, v = _forest(np.concatenate(us), np.concatenate(vs))
    return nodes[u].tolist(), nodes[v].tolist()


SCANNED = "u long, v long, seam long, turn int, pass int, grp string, hash long, node long, vec binary"
_SCANNED = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("seam", pa.int64()), ("turn", pa.int32()), ("pass", pa.int32()),
                      ("grp", pa.string()), ("hash", pa.int64()), ("node", pa.int64()), ("vec", pa.binary())])


def _scan(window: int, cosine: float):
    """Links inside a partition; its first and last rows go out too, to meet those of its neighbours."""

    def edge(rows: pa.Table, seam: int, turn: int) -> pa.RecordBatch:
        n = rows.num_rows
        none = pa.nulls(n, pa.int64())
        columns = [none, none, pa.array([seam] * n, pa.int64()), pa.array([turn] * n, pa.int32()), *(rows.column(c).combine_chunks() for c in ("pass", "grp", "hash", "node", "vec"))]
        return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=_SCANNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tail: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            table, fresh = pa.Table.from_batches([b]), 0
            if tail is None:
                yield edge(table.slice(0, window), part - 1, 1)
            else:
                fresh = tail.num_rows
                table = pa.concat_tables([tail, table]).combine_chunks()
            keys = list(zip(table.column("pass").to_pylist(), table.column("grp").to_pylist(), strict=True))
            u, v = neighbours(keys, table.column("vec").to_pylist(), table.column("node").to_numpy(), window, cosine, fresh)
            n = len(u)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), *(pa.nulls(n, f.type) for f in list(_SCANNED)[2:])], schema=_SCANNED)
            tail = table.slice(max(0, table.num_rows - window)).combine_chunks()
        if tail is not None:
            yield edge(tail, part, 0)

    return run


def _seams(window: int, cosine: float):
    def groups(table: pa.Table, cuts: np.ndarray) -> dict:
        us, vs = [], []
        keys = list(zip(table.column("pass").to_pylist(), table.column("grp").to_pylist(), strict=True))
        vecs, nodes = table.column("vec").to_pylist(), table.column("node").to_numpy()
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            u, v = neighbours(keys[a:z], vecs[a:z], nodes[a:z], window, cosine)
            us += u
            vs += v
        return {"u": us, "v": vs}

    return groups


# --- counts


def _count(cosine: float):
    """Weight of the members that each member of two blocks links to, other than itself."""

    def groups(table: pa.Table, cuts: np.ndarray) -> dict:
        nodes, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        block, vecs = table.column("block").to_numpy(), table.column("vec").to_pylist()
        low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
        out_n, out_w = [], []
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            x = np.frombuffer(b"".join(vecs[a:z]), np.float64).reshape(z - a, -1)
            norm = np.linalg.norm(x, axis=1)
            i, j = (np.flatnonzero(block[a:z] == side[a]) for side in (low, high))
            close = x[i] @ x[j].T / np.outer(norm[i], norm[j])
            link = close >= cosine
            p, q = np.nonzero(np.abs(close - cosine) < 1e-9)  # here the last bits decide, by the formula that links
            link[p, q] = cosines(x[i[p]], x[j[q]]) >= cosine
            w = weight[a:z]
            if low[a] == high[a]:
                np.fill_diagonal(link, False)
                out_n += nodes[a:z][i].tolist()
                out_w += (link @ w[j]).tolist()
            else:
                out_n += nodes[a:z][i].tolist() + nodes[a:z][j].tolist()
                out_w += (link @ w[j]).tolist() + (w[i] @ link).tolist()
        return {"node": out_n, "links": out_w}

    return groups


# --- the operator


def near_vectors(vectors: DataFrame, cosine: float = COSINE, passes: int = PASSES, window: int = WINDOW, block: int = BLOCK,
                 missed: float = MISSED) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors (vec_id, embedding, label)``.

    Rows with equal labels and vectors of equal length are linked at a cosine of ``cosine`` or more, in doubles. Vectors that are
    NULL, empty, zero or hold a NULL or non-finite component, and rows with a NULL label or id, link with nothing. Equal vectors
    of a label are one node that counts as often as it occurs. A pair at ``cosine`` that no chain of links found joins is missed
    with a probability of about ``missed``; a label takes ``passes`` or more for that, the more the larger and the more
    concentrated it is. Rows that share a ``vec_id`` are judged each by its own vector.
    """
    rows = keep(map_arrow(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label")),
                          _prepared, "vec_id long, grp string, content binary, vec binary"), "vectors")
    nodes = keep(rows.filter("content IS NOT NULL").groupBy("content", "grp", "vec")
                 .agg(F.min("vec_id").alias("node"), F.count("*").alias("weight")), "nodes")
    means = keep(map_groups(map_arrow(nodes.select("grp", "vec"), _sums, "grp string, n long, sum binary"), ["grp"], ["n", "sum"],
                            _means(cosine, passes, window, missed), "grp string, n long, mean binary, passes int").filter(F.col("n") > window + 1), "means")
    longest = means.agg(F.max(F.length("mean"))).first()[0] or 1
    few, small = broadcast_if_small(means, max(1, MEANS_BYTES // longest))
    light = nodes.select("grp", "node", "vec")
    placed = light.join(few, "grp", "left") if small else skewed_join(light, means, "grp", "left", hot_rows=1_000_000)
    placed = placed.select("grp", "node", "vec", "mean", F.coalesce("passes", F.lit(1)).alias("passes"), F.coalesce("n", F.lit(1)).alias("n"))
    hashed = map_arrow(placed, _hashed, "pass int, grp string, hash long, node long, vec binary")
    order = ["pass", "grp", "hash", "node"]
    scanned = keep(map_arrow(hashed.repartitionByRange(*order).sortWithinPartitions(*order), _scan(window, cosine), SCANNED), "scanned")
    seams = scanned.filter("seam IS NOT NULL").select("seam", "turn", "pass", "grp", "hash", "node", "vec")
    edges = scanned.filter("u IS NOT NULL").select("u", "v").unionByName(
        map_groups(seams, ["seam"], ["turn", "pass", "grp", "hash", "node"], _seams(window, cosine), "u long, v long"))
    links = components(edges)

    members = links.join(nodes.select("node", "weight", "vec"), "node")
    blocks = links.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    members = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "weight", "vec")
    counted = map_groups(members, ["component", "low", "high"], ["node"], _count(cosine), "node long, links long")
    counts = counted.groupBy("node").agg(F.sum("links").alias("links"))
    known = (nodes.select("content", "node", "weight").join(links, "node", "left").join(counts, "node", "left")
             .select("content", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id")))
    own = rows.select("vec_id", "content").join(known, "content", "left")
    component = F.coalesce("component_id", "vec_id")
    return own.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
