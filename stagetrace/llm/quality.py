"""Quality by a factorisation machine over hashed words, structure statistics and metadata.

Every feature has a weight and a low-rank vector; the vectors' inner products are the weights of all pairs of
features. Their sum over a document takes time linear in its features: half of the squared sum of vectors less
the sum of squares, per dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from stagetrace.llm.groups import arrow_schema, map_arrow
from stagetrace.llm.rules import measure
from stagetrace.llm.words import in_blocks, many_word_hashes

WORDS = 1 << 14
BINS = 16
# Per 16 of their whole, or the length of the number in bits.
STATISTICS = ("words", "chars", "symbols", "dup_lines", "repeats", "word_length", "upper", "digits", "marks", "different", "n_chars")
FEATURES = WORDS + BINS * len(STATISTICS)
RANK = 8
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[48:58] = 1, 2
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 3


@dataclass(frozen=True)
class Machine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, ids: np.ndarray, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-odds of documents whose features are ``ids[first[i]:first[i + 1]]``, one at least each."""
        v = self.vectors[ids] * values[:, None]
        total = np.add.reduceat(v, first[:-1])
        pairs = 0.5 * (total**2 - np.add.reduceat(v**2, first[:-1])).sum(1)
        return self.bias + np.add.reduceat(self.weights[ids] * values, first[:-1]) + pairs


# --- features


def features(texts: list[bytes], n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids and values of all texts on end, and where each text's begin. Every text has all statistics."""
    n = len(texts)
    m = measure(texts)
    words, first = many_word_hashes([t.translate(_LOWER) for t in texts])
    doc = np.repeat(np.arange(n), np.diff(first))
    key = np.unique(doc.astype(np.int64) << 20 | (words & np.uint64(WORDS - 1)).astype(np.int64))
    owner, bucket = key >> 20, key & ((1 << 20) - 1)
    different = np.bincount(owner, minlength=n)
    classes = np.array([np.bincount(_CLASS[np.frombuffer(t, np.uint8)], minlength=4) for t in texts]).reshape(n, 4)
    size = np.maximum(1, np.array([len(t) for t in texts]))

    def bits(x):
        return np.minimum(BINS - 1, np.ceil(np.log2(1.0 + x))).astype(np.int64)

    def share(part, whole, scale=BINS):
        return np.minimum(BINS - 1, np.ceil(scale * part / np.maximum(1, whole))).astype(np.int64)

    stats = [bits(m[:, 0]), bits(m[:, 1]), share(m[:, 2], m[:, 1]), share(m[:, 4], m[:, 3]), share(m[:, 5], m[:, 0]), share(m[:, 1], m[:, 0], 1),
             share(classes[:, 1], size), share(classes[:, 2], size), share(classes[:, 3], size), share(different, m[:, 0]), bits(n_chars)]
    ids = np.concatenate([bucket, *(WORDS + BINS * i + s for i, s in enumerate(stats))])
    owners = np.concatenate([owner, np.tile(np.arange(n), len(stats))])
    values = np.concatenate([1 / np.sqrt(different[owner]), np.full(n * len(stats), 0.5)])
    order = np.argsort(owners, kind="stable")
    return ids[order], values[order], np.searchsorted(owners[order], np.arange(n + 1))


def _of_batch(b: pa.RecordBatch) -> Iterator[tuple[int, int, tuple]]:
    texts = [b"" if t is None else t.encode() for t in b.column("text").to_pylist()]
    n_chars = np.array([max(0, x or 0) for x in b.column("n_chars").to_pylist()], np.float64)
    for a, z in in_blocks(texts):
        yield a, z, features(texts[a:z], n_chars[a:z])


def _inputs(docs: DataFrame, *more: str) -> DataFrame:
    """Text and metadata; where the table has no ``n_chars``, the text's own length."""
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.length("text").cast("long")
    return docs.select(*more, "text", n_chars.alias("n_chars"))


# --- learning


def learn(docs: DataFrame, labels: DataFrame, known: Column, max_rows: int = 6000, epochs: int = 12, rate: float = 0.1, penalty: float = 1e-4) -> Machine:
    """A machine from at most ``max_rows`` labelled documents, those with the smallest hashes of their id.

    ``labels`` has ``doc_id`` and ``quality``; ``known`` selects the documents that may be learned from. Documents without a label
    or with a NULL id or label teach nothing; without any, every score is even. The sample's features, not its
    texts, come to the driver: ``max_rows`` times ``FEATURES`` numbers at most.
    """
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    chosen = (marks.filter(known).groupBy("doc_id").agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64(F.lit("quality sample"), "doc_id"), "doc_id").limit(max_rows))
    rows = F.broadcast(chosen)  # max_rows rows at most
    sample = _inputs(docs, "doc_id").join(rows, "doc_id").dropDuplicates(["doc_id"])
    schema = arrow_schema("doc_id long, quality int, ids binary, vals binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, (ids, values, first) in _of_batch(b):
                parts = list(zip(first[:-1], first[1:], strict=True))
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id")[a:z].cast(pa.int64()), b.column("quality")[a:z].cast(pa.int32()),
                    pa.array([ids[i:j].astype(np.int32).tobytes() for i, j in parts], pa.binary()),
                    pa.array([values[i:j].astype(np.float32).tobytes() for i, j in parts], pa.binary())], schema=schema)

    found = sorted(map_arrow(sample, run, "doc_id long, quality int, ids binary, vals binary").collect(), key=lambda r: r["doc_id"])
    return fit([np.frombuffer(r["ids"], np.int32) for r in found], [np.frombuffer(r["vals"], np.float32) for r in found],
               np.array([r["quality"] for r in found], np.float64), epochs, rate, penalty)


def fit(ids: list[np.ndarray], values: list[np.ndarray], label: np.ndarray, epochs: int, rate: float, penalty: float) -> Machine:
    """Logistic loss by AdaGrad over small batches, in a fixed order."""
    rng = np.random.Generator(np.random.PCG64(5))
    weights, vectors = np.zeros(FEATURES), rng.standard_normal((FEATURES, RANK)) * 0.05
    bias, steps = 0.0, [np.full(FEATURES, 1e-2), np.full((FEATURES, RANK), 1e-2), 1e-2]
    for _ in range(epochs if len(ids) else 0):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), 64):
            k = order[at:at + 64]
            i, x = np.concatenate([ids[j] for j in k]), np.concatenate([values[j] for j in k]).astype(np.float64)
            n = np.array([len(ids[j]) for j in k])
            first = np.append(0, np.cumsum(n))
            machine = Machine(bias, weights, vectors)
            error = np.repeat((1 / (1 + np.exp(-machine.scores(i, x, first))) - label[k]) / len(k), n)
            v = vectors[i]
            total = np.repeat(np.add.reduceat(v * x[:, None], first[:-1]), n, axis=0)
            own, place = np.unique(i, return_inverse=True)
            gw = np.bincount(place, error * x) + penalty * weights[own]
            change = error[:, None] * x[:, None] * (total - v * x[:, None])
            gv = np.stack([np.bincount(place, change[:, f]) for f in range(RANK)], 1) + penalty * vectors[own]
            gb = error[first[:-1]].sum()
            steps[0][own] += gw**2
            steps[1][own] += gv**2
            steps[2] += gb**2
            weights[own] -= rate * gw / np.sqrt(steps[0][own])
            vectors[own] -= rate * gv / np.sqrt(steps[1][own])
            bias -= rate * gb / np.sqrt(steps[2])
    return Machine(bias, weights, vectors)


# --- scoring


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1 from the whole text; it replaces a column by this name.

    A NULL or empty text is scored by its statistics, all of them at their lowest. A NULL or negative ``n_chars`` counts as 0.
    """
    docs = docs.drop("score")
    own = "n_chars" in docs.columns
    rows = docs if own else docs.withColumn("n_chars", F.length("text").cast("long"))
    schema = pa.schema([*arrow_schema(docs.schema), pa.field("score", pa.float64())])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            odds = [machine.scores(*f) for _, _, f in _of_batch(b)]
            p = 1 / (1 + np.exp(-np.clip(np.concatenate(odds) if odds else np.zeros(0), -500, 500)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(p)], schema=schema)

    return map_arrow(rows, run, StructType([*docs.schema.fields, *_parse_datatype_string("score double").fields]))
