"""Best-fit packing of documents into sequences by exact complements.

Only the number of pieces of each length matters for the plan, so it is made on at most ``capacity`` counts whatever
the number of documents. From the longest length down, the gap that a piece leaves is looked up among single lengths, sums
of two and sums of three; combinations that fill it exactly are consumed as often as the counts allow. What
has no complement goes best-fit into the open gaps. Pieces then take their place by their rank among those of equal length.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrace.llm.groups import arrow_schema, map_arrow
from stagetrace.llm.ranks import ranked
from stagetrace.llm.store import keep

CAPACITY = 2048
END = 0
# Bytes of words and ids that a worker remembers, about; longer words than this many characters it does not.
MEMORY, LONGEST = 80 << 20, 64
_ENTRY = 220
# How byte-level BPE splits texts; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# --- tokens


class Words(dict):
    """Ids of a word after ``before``, worked out when it is first met; None for a word that can't stand for itself."""

    def __init__(self, ids, before: str):
        self.ids, self.before, self.room = ids, before, MEMORY

    def __missing__(self, word: str) -> bytes | None:
        found = array("I", self.ids(self.before + word)).tobytes() if word and word == word.strip() else None
        if len(word) <= LONGEST and self.room > 0:  # common words come early, rare ones need no place
            self[word] = found
            self.room -= _ENTRY + 4 * len(word) + len(found or b"")
        return found


class Encoder:
    """Token ids of texts as little-endian bytes, remembered word by word.

    A byte-level BPE never joins what a single space between two visible characters separates, so a text is encoded at its
    spaces. Texts with other white space beside a space, or with a special token, are encoded whole. Words go
    through a faster library with the same vocabulary where the tokenizer's file allows it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ids = _by_ranks(path) or self._ids
        self.first, self.later = Words(ids, ""), Words(ids, " ")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        first, later = self.first, self.later.__getitem__
        for text in texts:
            words = text.split(" ")
            parts = [first[words[0]] if words[0] else b"", *map(later, words[1:])]
            if None in parts or any(s in text for s in self.special):
                yield array("I", self._ids(text)).tobytes()
            else:
                yield b"".join(parts)


def _by_ranks(path: str):
    """A function from text to ids, if the file is a byte-level BPE whose merges have their ids as ranks; else None."""
    with open(path, encoding="utf-8") as f:
        about = json.load(f)
    model, before = about.get("model", {}), about.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
             and about.get("normalizer") is None and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
             and not model.get("ignore_merges"))
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocab = model.get("vocab", {})
    order = [vocab.get("".join(m), -1) for m in merges]
    if not plain or any(a >= b for a, b in zip(order, order[1:], strict=False)) or order[:1] == [-1]:
        return None
    import tiktoken

    # how byte-level vocabularies write bytes: visible ones as they are, the others from 256 on
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
    special = {t["content"] for t in about.get("added_tokens", [])}
    ranks = {bytes(map(byte.__getitem__, t)): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One per worker, so that what it remembers outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int]]:
    """``(piece, start, length)`` of a document; all pieces but the first have ``capacity`` tokens."""
    n = len(ids) // 4
    first = (n - 1) % capacity + 1
    yield 0, 0, first
    for i, start in enumerate(range(first, n, capacity), 1):
        yield i, start, capacity


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document's tokens and the end token; and ``ids`` if asked for."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(tokenizer), np.array([END], "<u4").tobytes()
        for batch in batches:
            ids_, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for at in range(0, len(texts), 256):
                rows = []
                for doc_id, raw in zip(ids_[at:at + 256], encoder.encode([t or "" for t in texts[at:at + 256]]), strict=True):
                    raw += end
                    for piece, start, length in cut(raw, capacity):
                        own = raw[4 * start:4 * (start + length)]
                        rows.append((doc_id, piece, start, length, zlib.crc32(own), *([np.frombuffer(own, "<i4")] if with_ids else [])))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


# --- the plan


class Counts:
    """How many pieces of each length are left, and which lengths have any."""

    def __init__(self, counts: dict[int, int]):
        self.n = dict(counts)
        self.lengths = sorted(k for k, v in counts.items() if v > 0)

    def times(self, lengths: tuple[int, ...]) -> int:
        return min(self.n.get(x, 0) // lengths.count(x) for x in set(lengths))

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.n[x] -= times
            if not self.n[x]:
                self.lengths.pop(bisect_left(self.lengths, x))

    def pairs(self, total: int) -> Iterator[tuple[int, int]]:
        """Two lengths with this sum, the larger first, from the most uneven on."""
        for x in self.lengths[bisect_left(self.lengths, -(-total // 2)):bisect_left(self.lengths, total)][::-1]:
            if self.n.get(total - x, 0) > 0:
                yield x, total - x

    def triples(self, total: int) -> Iterator[tuple[int, int, int]]:
        for x in self.lengths[bisect_left(self.lengths, -(-total // 3)):bisect_left(self.lengths, total - 1)][::-1]:
            for y, z in self.pairs(total - x):
                if y <= x:
                    yield x, y, z


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as ``(lengths, times)``, using each length exactly as often as ``counts`` says."""
    left = Counts(counts)
    done: list[tuple[tuple[int, ...], int]] = []

    def consume(lengths: tuple[int, ...]) -> None:
        times = left.times(lengths)
        if times:
            done.append((lengths, times))
            left.take(lengths, times)

    for x in left.lengths[::-1]:
        gap = capacity - x
        if left.n[x] and not gap:
            consume((x,))
        for some in (lambda: [(gap,)] if gap in left.n else [], lambda: left.pairs(gap), lambda: left.triples(gap)):
            while left.n[x] and gap:
                found = next((c for c in some() if left.times((x, *c))), None)
                if found is None:
                    break
                consume((x, *found))
    return done + best_fit(left.n, capacity)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first into the smallest gap that holds it; equal sequences are handled together."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    gaps: list[int] = []

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(lengths)
        if gap not in open_:
            open_[gap] = []
            insort(gaps, gap)
        open_[gap].append((lengths, times))

    for x in sorted((k for k, v in counts.items() if v > 0), reverse=True):
        n = counts[x]
        while n:
            i = bisect_left(gaps, x)
            if i == len(gaps):
                each = min(capacity // x, n)
                put((x,) * each, n // each)
                n %= each
                continue
            gap = gaps[i]
            lengths, times = open_[gap].pop()
            each = min(gap // x, n)
            used = min(times, n // each)
            if used < times:
                open_[gap].append((lengths, times - used))
            if not open_[gap]:
                del open_[gap]
                gaps.pop(i)
            put((*lengths, *(x,) * each), used)
            n -= used * each
    return [p for some in open_.values() for p in some]


class Places:
    """Sequence and offset of a piece, from its length and its rank among the pieces of that length."""

    def __init__(self, sequences: list[tuple[tuple[int, ...], int]]):
        rows, used, first = [], {}, 0
        for lengths, times in sequences:
            offset = 0
            for x in lengths:
                rows.append((x, used.get(x, 0), first, offset))
                used[x] = used.get(x, 0) + times
                offset += x
            first += times
        self.length, self.rank, self.first, self.offset = (np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)) if rows else (np.zeros(0, np.int64),) * 4
        self.sequences = first

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.int64(1 << 44)
        i = np.searchsorted(self.length * shift + self.rank, length * shift + rank, side="right") - 1
        return self.first[i] + rank - self.rank[i], self.offset[i]


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of all documents, and ``ids`` if asked for.

    A document is its token ids and the end token, a NULL text only the end token. Longer ones than ``capacity`` are cut, the
    first piece then being the shorter one. Rows that repeat an id are packed like any other. Sequences are numbered
    from 0 and filled from 0 without gaps. No documents give no rows.
    """
    table = keep(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    places = Places(plan(counts, capacity))
    rows = ranked(table, ["length"], ["doc_id", "piece", "ids_crc32"])
    schema = ", ".join(f"{n} {t}" for n, t in table.dtypes) + ", sequence_id long, offset long"
    names = [*table.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places.find(b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in table_columns), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=names)

    table_columns = table.columns
    return map_arrow(rows, run, schema)
