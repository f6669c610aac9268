"""Long repeats across documents, found by recompression.

Recompression turns a text into ever fewer symbols: a round names maximal runs of one symbol, then pairs whose
first symbol falls into the left and whose second into the right half of the alphabet. Names are hashes of
what they stand for and halves are hashes of names, so every task gives a pair the same name without asking:
equal substrings get equal symbols wherever their surroundings can't reach. Every symbol here carries
the words that decided it (its context). A window of ``size`` words therefore chooses among the symbols whose
context it holds, and equal windows choose the same one, wherever they stand.

1. The chosen symbols of all documents meet by name; those that two documents share are kept. So do whole
   documents: one that a smaller ``doc_id`` also holds is done with.
2. Only windows that chose a shared symbol are compared, by 96 bits of hashes of all their words.
3. Words covered by a window that a smaller ``doc_id`` also holds are taken out.

Names travel as sorted binary columns of many names per row, for a row per name would cost far more than it holds.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrace.llm.groups import arrow_schema, map_arrow, map_groups
from stagetrace.llm.store import Kept, release
from stagetrace.llm.words import in_blocks, many_word_hashes, mix, piece_hashes, word_hashes

SIZE = 13
ROUNDS = 2
# Names that a task holds before it passes them on, and names that meet in one bucket, on average.
FLUSH, BUCKET = 1 << 18, 1 << 19
_NAME, _ONE, _TWO = 0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93
_ODD = np.uint64(0x2545F4914F6CDD1D)


def _u(x: int) -> np.uint64:
    return np.uint64(x)


# --- recompression of the words of many documents on end


class Symbols:
    """Symbols from left to right: name, words ``start:end`` they stand for, words ``left:right`` that decided them."""

    def __init__(self, name, start, end, left, right):
        self.name, self.start, self.end, self.left, self.right = name, start, end, left, right


def name_runs(words: np.ndarray, new: np.ndarray) -> Symbols:
    """Maximal runs of one word; ``new`` marks the first word of every document."""
    first = new.copy()
    first[1:] |= words[1:] != words[:-1]
    start = np.flatnonzero(first)
    end = np.append(start[1:], len(words))
    n = (end - start).astype(np.uint64)
    name = np.where(n > 1, mix(words[start] * _ODD + n), words[start])
    # that a run goes no further shows in the words beside it
    return Symbols(name, start, end, start - 1, end + 1)


def name_pairs(s: Symbols, new: np.ndarray, turn: int) -> Symbols:
    """Pairs of a left and a right symbol; the halves of the alphabet change with ``turn``."""
    n = len(s.name)
    left = mix(s.name ^ _u(0x9E3779B97F4A7C15 * (turn + 1) & (2**64 - 1))) >> _u(63) == 0
    begins = new[s.start]
    pair = np.zeros(n, bool)
    pair[:-1] = left[:-1] & ~left[1:] & ~begins[1:]
    second = np.zeros(n, bool)
    second[1:] = pair[:-1]
    after = np.append(s.right[1:], s.end[-1:] + 1)
    before = np.append(s.left[:1], s.left[:-1])
    before[begins] = s.start[begins] - 1
    name = s.name.copy()
    i = np.flatnonzero(pair)
    name[i] = mix(s.name[i] * _ODD + mix(s.name[i + 1] + _u(turn + 1)))
    end = s.end.copy()
    end[i] = s.end[i + 1]
    # a left symbol depends on the one after it, a right symbol on the one before
    low = np.where(left, s.left, np.minimum(before, s.left))
    high = np.where(left, np.maximum(after, s.right), s.right)
    stay = ~second
    return Symbols(name[stay], s.start[stay], end[stay], low[stay], high[stay])


def recompress(words: np.ndarray, new: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    """Symbols after every round."""
    out = [name_pairs(name_runs(words, new), new, 0)]
    for turn in range(1, rounds):
        out.append(name_pairs(out[-1], new, turn))
    return out


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of every document begin, and its number; ``first`` has one entry more than documents."""
    n = np.maximum(np.diff(first) - size + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[doc], doc


def window_hashes(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of the words of every window."""
    return mix(piece_hashes(words, at, at + size, _ONE)), _second(piece_hashes(mix(words ^ _u(_TWO)), at, at + size, _TWO))


def _second(h: np.ndarray) -> np.ndarray:
    return (mix(h) >> _u(32)).astype(np.uint32)


def document_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of all words of every document."""
    n = (end - start).astype(np.uint64)
    return mix(piece_hashes(words, start, end, _ONE) + n * _ODD), _second(piece_hashes(mix(words ^ _u(_TWO)), start, end, _TWO) + n)


def window_names(words: np.ndarray, first: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The name that every window chooses: that of the symbol of the highest round that it decides alone,
    the smallest among several; of the whole window if it decides none.

    A name covers all words of the symbol's context, so that few unrelated windows share it.
    """
    none = _u(2**64 - 1)
    chosen = np.full(len(at), none)
    if not len(at):
        return chosen
    new = np.zeros(len(words), bool)
    new[first[:-1][np.diff(first) > 0]] = True
    open_ = np.arange(len(at))
    for level, s in reversed(list(enumerate(recompress(words, new)))):
        left, right = np.maximum(s.left, 0), np.minimum(s.right, len(words))
        name = mix(piece_hashes(words, left, right, _NAME) + _u(level) * _ODD + (right - left).astype(np.uint64))
        name[name == none] = _u(0)
        here = at[open_]
        low = np.searchsorted(s.left, here)
        high = np.searchsorted(s.right, here + size, side="right")
        best = np.full(len(here), none)
        for step in range(int(max(0, (high - low).max(initial=0)))):
            i = low + step
            best = np.where(i < high, np.minimum(best, name[np.minimum(i, len(name) - 1)]), best)
        chosen[open_] = best
        open_ = open_[best == none]
        if not len(open_):
            return chosen
    chosen[open_] = window_hashes(words, at[open_], size)[0]
    return chosen


# --- names that documents share


def _ints(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, in four each and nine for all where they lie close enough; an even length tells eight each."""
    base = values.min()
    if int(values.max()) - int(base) < 1 << 32:
        return b"\0" + base.tobytes() + (values - base).astype(np.uint32).tobytes()
    return values.tobytes()


def _to_ints(raw: bytes) -> np.ndarray:
    if len(raw) % 2:
        return np.frombuffer(raw, np.uint32, -1, 9).astype(np.int64) + np.frombuffer(raw, np.int64, 1, 1)
    return np.frombuffer(raw, np.int64)


def _packed(names: np.ndarray, more: np.ndarray, docs: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows ``(bucket, name, more, doc)`` of different entries, sorted by name inside a bucket."""
    order = np.lexsort((docs, more, names))
    names, more, docs = names[order], more[order], docs[order]
    fresh = np.ones(len(names), bool)
    fresh[1:] = (names[1:] != names[:-1]) | (more[1:] != more[:-1]) | (docs[1:] != docs[:-1])
    names, more, docs = names[fresh], more[fresh], docs[fresh]
    bucket = ((names >> _u(33)) * _u(buckets) >> _u(31)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(bucket[a]), names[a:b].tobytes(), more[a:b].tobytes() if more.any() else b"", _ints(docs[a:b])


def _unpack(name: bytes, more: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = np.frombuffer(name, np.uint64)
    return n, np.frombuffer(more, np.uint32) if more else np.zeros(len(n), np.uint32)


ENTRIES = "bucket long, load long, name binary, more binary, doc binary"
_ENTRIES = pa.schema([("bucket", pa.int64()), ("load", pa.int64()), ("name", pa.binary()), ("more", pa.binary()), ("doc", pa.binary())])


def _gather(entries: Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries ``(kind, name, more, doc)`` of many documents as rows of ``ENTRIES``. Those of kind 1 have buckets of their own, below 0.

    ``load`` tells which rows left together: the entries of a document have one load.
    """
    held, size = ([], []), 0

    def batch():
        rows, load = [], int.from_bytes(os.urandom(8)) >> 1
        for kind, parts in enumerate(held):
            if parts:
                packed = _packed(*(np.concatenate(x) for x in zip(*parts, strict=True)), buckets)
                rows += [(-1 - b if kind else b, load, *rest) for b, *rest in packed]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ENTRIES, strict=True)], schema=_ENTRIES)

    for kind, *e in entries:
        if len(e[0]):
            held[kind].append(e)
            size += len(e[0])
        if size >= FLUSH:
            yield batch()
            held, size = ([], []), 0
    if size:
        yield batch()


def _extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest and largest document of every name of a row, so that a name travels once per row."""
    for b in batches:
        low, high, name, more = [], [], [], []
        for n, m, d in zip(*(b.column(c).to_pylist() for c in ("name", "more", "doc")), strict=True):
            ns, ms = _unpack(n, m)
            docs = _to_ints(d)
            first = np.flatnonzero(np.append(True, (ns[1:] != ns[:-1]) | (ms[1:] != ms[:-1])))
            last = np.append(first[1:], len(ns)) - 1
            name.append(ns[first].tobytes())
            more.append(ms[first].tobytes() if m else b"")
            low.append(_ints(docs[first]))
            high.append(_ints(docs[last] - docs[first]))
        yield pa.RecordBatch.from_arrays([b.column("bucket"), *(pa.array(x, pa.binary()) for x in (name, more, low, high))],
                                         names=["bucket", "name", "more", "low", "span"])


def _meet(table: pa.Table, cuts: np.ndarray) -> dict:
    """Names of a bucket that two documents hold, with the smallest of them."""
    out = {"bucket": [], "shared": [], "shared_more": [], "least": []}
    columns = {c: table.column(c).to_pylist() for c in ("bucket", "name", "more", "low", "span")}
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        parts = [_unpack(columns["name"][i], columns["more"][i]) for i in range(a, b)]
        names, more = (np.concatenate(x) for x in zip(*parts, strict=True))
        low = np.concatenate([_to_ints(x) for x in columns["low"][a:b]])
        high = low + np.concatenate([_to_ints(x) for x in columns["span"][a:b]])
        order = np.lexsort((more, names))
        names, more, low, high = names[order], more[order], low[order], high[order]
        first = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (more[1:] != more[:-1])))
        low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
        keep = low < high
        if keep.any():
            out["bucket"].append(columns["bucket"][a])
            out["shared"].append(names[first][keep].tobytes())
            out["shared_more"].append(more[first][keep].tobytes())
            out["least"].append(_ints(low[keep]))
    return out


def _look_up(later: bool):
    """Which entries of a row are shared; ``later``: held by a smaller document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            loads, names, mores, found = [], [], [], []
            for load, n, m, d, s, sm, least in zip(*(b.column(c).to_pylist() for c in ("load", "name", "more", "doc", "shared", "shared_more", "least")), strict=True):
                ns, ms = _unpack(n, m)
                docs = _to_ints(d)
                ss, sms = _unpack(s, sm)
                # both are sorted by (name, more): equal names have few different mores
                place = np.searchsorted(ss, ns)
                hit = np.zeros(len(ns), bool)
                for _ in range(4):
                    i = np.minimum(place, len(ss) - 1)
                    hit |= (ss[i] == ns) & (sms[i] == ms)
                    place = np.where(hit, i, place + 1)
                if later:
                    hit &= _to_ints(least)[np.minimum(place, len(ss) - 1)] < docs
                if hit.any():
                    loads.append(load)
                    names.append(ns[hit].tobytes())
                    mores.append(ms[hit].tobytes() if later else b"")
                    found.append(_ints(docs[hit]))
            yield pa.RecordBatch.from_arrays([pa.array(loads, pa.int64()), *(pa.array(x, pa.binary()) for x in (names, mores, found))],
                                             names=["load", "name", "more", "doc"])

    return run


def _by_document(table: pa.Table, cuts: np.ndarray) -> dict:
    """The entries of a load, one row per document."""
    out = {"doc_id": [], "name": [], "more": []}
    columns = {c: table.column(c).to_pylist() for c in ("name", "more", "doc")}
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        names, mores = (np.concatenate(x) for x in zip(*(_unpack(columns["name"][i], columns["more"][i]) for i in range(a, z)), strict=True))
        docs = np.concatenate([_to_ints(x) for x in columns["doc"][a:z]])
        order = np.argsort(docs, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(docs[order]) != 0))
        for i, j in zip(first, [*first[1:], len(order)], strict=True):
            out["doc_id"].append(int(docs[order[i]]))
            out["name"].append(names[order[i:j]].tobytes())
            out["more"].append(mores[order[i:j]].tobytes())
    return out


def shared_names(entries: DataFrame, later: bool) -> DataFrame:
    """``(doc_id, names, mores)``: of every document, the entries that another (``later``: a smaller) document holds."""
    met = map_groups(map_arrow(entries, _extremes, "bucket long, name binary, more binary, low binary, span binary"),
                     ["bucket"], [], _meet, "bucket long, shared binary, shared_more binary, least binary")
    found = map_arrow(entries.join(met.hint("merge"), "bucket"), _look_up(later), "load long, name binary, more binary, doc binary")
    found = map_groups(found, ["load"], [], _by_document, "doc_id long, name binary, more binary")
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("name", "more")).alias("found"))


# --- the operator


def _texts(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray]:
    texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
    return texts, batch.column("doc_id").to_numpy()


def _names_of(size: int, buckets: int):
    def entries(batches):
        for batch in batches:
            texts, ids = _texts(batch)
            for a, z in in_blocks(texts):
                words, first = many_word_hashes(texts[a:z])
                at, doc = window_starts(first, size)
                names = window_names(words, first, at, size)
                # neighbouring windows mostly choose the same symbol
                fresh = np.append(True, (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])) if len(at) else np.zeros(0, bool)
                yield 0, names[fresh], np.zeros(fresh.sum(), np.uint32), ids[a:z][doc[fresh]]
                whole = np.flatnonzero(np.diff(first) >= size)
                if len(whole):
                    yield 1, *document_hashes(words, first[whole], first[whole + 1]), ids[a:z][whole]

    return lambda batches: _gather(entries(batches), buckets)


def _own(names: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Names as those of one document."""
    return mix(names ^ mix(doc.astype(np.uint64) * _ODD + _u(1)))


def _windows_of(size: int, buckets: int):
    def entries(batches):
        for batch in batches:
            texts, ids = _texts(batch)
            found = batch.column("found").to_pylist()
            for a, z in in_blocks(texts):
                words, first = many_word_hashes(texts[a:z])
                at, doc = window_starts(first, size)
                shared = [np.frombuffer(b"".join(f["name"] for f in x), np.uint64) for x in found[a:z]]
                wanted = _own(np.concatenate(shared), np.repeat(np.arange(z - a), [len(x) for x in shared]))
                hit = np.isin(_own(window_names(words, first, at, size), doc), wanted)
                if hit.any():
                    yield 0, *window_hashes(words, at[hit], size), ids[a:z][doc[hit]]

    return lambda batches: _gather(entries(batches), buckets)


def covered(words: np.ndarray, found: list, size: int) -> np.ndarray:
    """Which words a repeated window covers."""
    at, _ = window_starts(np.array([0, len(words)]), size)
    one, two = window_hashes(words, at, size)
    names = np.frombuffer(b"".join(f["name"] for f in found), np.uint64)
    mores = np.frombuffer(b"".join(f["more"] for f in found), np.uint32)
    have = set(zip(names.tolist(), mores.tolist(), strict=True))
    k = np.flatnonzero(np.isin(one, names))
    k = np.array([i for i, x in zip(k.tolist(), zip(one[k].tolist(), two[k].tolist(), strict=True), strict=True) if x in have], np.int64)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, at[k], 1)
    np.add.at(change, at[k] + size, -1)
    return np.cumsum(change[:-1]) > 0


def _cut(text: str | None, found: list | None, copy: bool | None, size: int) -> tuple[str | None, int, int, list[tuple[int, int]], str]:
    if text is None:
        return None, 0, 0, [], hashlib.sha256(b"").hexdigest()
    raw = text.encode()
    if not found:
        words = raw.split()
        n = len(words)
        if copy:
            return "", n, n, [(0, n)], hashlib.sha256(b"").hexdigest()
        return text, n, 0, [], hashlib.sha256(b" ".join(words)).hexdigest()
    words, start, end = word_hashes(raw)
    gone = covered(words, found, size)
    kept = b" ".join([raw[a:b] for a, b in zip(start[~gone].tolist(), end[~gone].tolist(), strict=True)])
    edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
    return kept.decode(), len(words), int(gone.sum()), list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)), hashlib.sha256(kept).hexdigest()


CUT = "text string, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept_sha256 string"


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` with words taken out that lie in a window of ``size`` words which a smaller ``doc_id`` also holds.

    Added: ``n_words`` and ``n_removed``, the word ranges ``removed``, and ``kept_sha256`` of the kept words joined by one space;
    columns by these names are replaced. ``text`` becomes those kept words where some were removed and stays as it is
    elsewhere. Windows are judged on the input. A NULL text has no words and stays NULL. A NULL ``doc_id`` is neither
    smaller nor larger than another: its words stay and take nothing from others. Rows with one id are one document.
    Words are compared as they are, by hashes of 64 bits; windows and whole documents by 96.
    """
    spark = docs.sparkSession
    added = ["n_words", "n_removed", "removed", "kept_sha256"]
    docs = docs.drop(*added)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    chars = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # words have four bytes at least, mostly; about every fourth word brings an entry
    buckets = max(16, ceil(chars / 16 / BUCKET))
    names = Kept(map_arrow(keyed, _names_of(size, buckets), ENTRIES), "names")
    # an id of several texts is no copy of one of them: its windows are compared one by one
    several = keyed.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    copies = Kept(shared_names(names.read().filter("bucket < 0"), later=True).select("doc_id").join(several, "doc_id", "left_anti"), "copies")
    shared = Kept(shared_names(names.read().filter("bucket >= 0"), later=False).join(copies.read(), "doc_id", "left_anti"), "shared")
    names.drop()
    release(spark)
    windows = Kept(map_arrow(keyed.join(shared.read(), "doc_id"), _windows_of(size, buckets), ENTRIES), "windows")
    shared.drop()
    release(spark)
    found = Kept(shared_names(windows.read(), later=True), "repeats").read()
    windows.drop()
    release(spark)
    found = found.withColumn("copy", F.lit(False)).unionByName(copies.read().withColumn("copy", F.lit(True)), allowMissingColumns=True)

    out = [c for c in docs.columns if c != "text"]
    found = found.withColumnsRenamed({"doc_id": "__id", "found": "__found", "copy": "__copy"})  # names that no table has
    joined = docs.join(found, docs["doc_id"].cast("long") == F.col("__id"), "left").drop("__id")
    schema = arrow_schema(docs.select(*out).schema)
    cut = arrow_schema(CUT)
    final = pa.schema([*schema, *cut])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_cut(t, f, c, size) for t, f, c in zip(*(b.column(x).to_pylist() for x in ("text", "__found", "__copy")), strict=True)]
            ranges = [[{"start": s, "end": e} for s, e in r[3]] for r in rows]
            columns = [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], ranges, [r[4] for r in rows]]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in out), *(pa.array(c, f.type) for c, f in zip(columns, cut, strict=True))], schema=final)

    from pyspark.sql.types import StructType, _parse_datatype_string
    types = StructType([*docs.select(*out).schema.fields, *_parse_datatype_string(CUT).fields])
    return map_arrow(joined, run, types).select(*docs.columns, *added)
