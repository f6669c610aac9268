"""Personal data in texts: spans of fixed patterns, and those that a tagger learned from such spans adds.

The tagger reads overlapping windows of a text character by character. Spans that a window's edge cuts are left to the
neighbour, which holds them whole; what the windows found is reconciled over the whole text: spans found twice count
once with their mean probability, and of spans that overlap, the set of largest total probability is kept.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stagetrace.llm import tagger
from stagetrace.llm.groups import arrow_schema, map_arrow
from stagetrace.llm.store import keep

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

WINDOW, STEP = 128, 64
# Documents from which the tagger learns, and windows of each kind taken from them, at most.
LEARN_DOCS, LEARN_WINDOWS = 4_000, 400
# Windows without a digit or an at sign, written out or not, hold nothing that any kind can consist of.
_TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]", re.IGNORECASE)
# Least mean probability of a span's tags.
SURE = 0.9
_BATCH = 1024
_TAGS = tagger.Tags(KINDS)
_COLUMNS = [*(StructField(f"n_{k}", LongType()) for k in KINDS), StructField("base_sha256", StringType()), StructField("spans", StringType())]

Span = tuple[int, int, str]


# --- patterns


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    # a local part is all of its characters before the sign, back to the last match: no start is tried twice
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        last = domain.end() if domain else at + 1
        if domain:
            yield start, last, "email"
        at = text.find("@", max(last, at + 1))


def matches(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the patterns, by kind and start, and what has a pattern's shape but fails its check."""
    good, failed = list(_emails(text)), []
    for m in _IP.finditer(text):
        ok = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))
        (good if ok else failed).append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19:
            (good if _luhn(digits) else failed).append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        ok = 9 <= len(_digits(m.group())) <= 15
        (good if ok else failed).append((m.start(), m.end(), "phone"))
    return good, failed


def joined(spans: list[Span]) -> str:
    """``kind:start:end`` by start, then kind, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


# --- learning


def _disjoint(spans: list[Span]) -> list[Span]:
    """Of spans that overlap, the first and longest: every character has one tag."""
    out: list[Span] = []
    for s in sorted(spans, key=lambda s: (s[0], -s[1], KINDS.index(s[2]))):
        if not out or s[0] >= out[-1][1]:
            out.append(s)
    return out


def _pieces(text: str) -> Iterator[tuple[str, str, int, int]]:
    """Windows to learn from as ``(kind, piece, start, end)``: one per labelled span, and ``none`` for others with a trigger.

    A window that holds anything of a pattern's shape that failed its check teaches nothing and is left out.
    """
    good, failed = matches(text)
    spans = _disjoint(good)
    # a label may overlap a failed match: a dialled number is not a card, and no doubt about it
    doubt = [f for f in failed if not any(a < f[1] and f[0] < b for a, b, _ in spans)]
    busy = sorted([*((a, b) for a, b, _ in spans), *((a, b) for a, b, _ in doubt)])
    starts = [a for a, _ in busy]

    def alone(start: int, end: int, n: int) -> bool:
        i = bisect_right(starts, end - 1)
        return sum(b > start for _, b in busy[max(0, i - 2 - n):i]) == n

    for a, b, kind in spans:
        lo, hi = max(0, a - 48), min(len(text), b + 48)
        if b - a <= 64 and alone(lo, hi, 1):
            yield kind, text[lo:hi], a - lo, b - lo
    for lo in range(0, len(text), WINDOW):
        piece = text[lo:lo + WINDOW]
        if _TRIGGER.search(piece) and alone(lo, lo + len(piece), 0):
            yield "none", piece, 0, 0
    if text and alone(0, min(len(text), WINDOW), 0):
        yield "plain", text[:WINDOW], 0, 0


_SPACERS = {"card": ["", " ", " ", "-", "."], "phone": [" ", "-", ".", ""]}


def _varied(kind: str, span: str, rng: np.random.Generator) -> str:
    """Another span of the kind: digits drawn anew, letters mixed, sometimes written in another way."""
    draw = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    if kind == "ip":
        return ".".join(str(rng.integers(0, 256)) for _ in range(4))
    out = "".join(draw(1) if "0" <= c <= "9" else c for c in span)
    way = rng.random()
    if kind == "card" and way < 0.6:
        space, digits = _SPACERS["card"][rng.integers(5)], draw(16 if rng.random() < 0.7 else int(rng.integers(13, 20)))
        return space.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == "phone" and way < 0.6:
        space, area = _SPACERS["phone"][rng.integers(4)], draw(3)
        area = f"({area})" if rng.random() < 0.5 else area
        country = ["", f"+{draw(int(rng.integers(1, 4)))}{space or ' '}", f"00{draw(2)} "][rng.integers(3)]
        return f"{country}{area}{' ' if area[0] == '(' else space or '-'}{draw(3)}{space or '-'}{draw(4)}"
    if kind == "email":
        local, _, domain = out.partition("@")
        if rng.random() < 0.5:  # names of other letters
            mix = lambda s: "".join(chr(97 + rng.integers(26)) if "a" <= c <= "z" else c for c in s)
            local, domain = mix(local), mix(domain.rpartition(".")[0]) + "." + domain.rpartition(".")[2]
        return local + ("@" if way < 0.7 else [" @ ", "(at)", "[at]", " (at) ", " [at] "][rng.integers(5)]) + domain
    return out


def _harmless(rng: np.random.Generator) -> str:
    """Digits that are nobody's: dates, times, versions, amounts, counts, hexadecimal names, numbers too long or too short."""
    draw = lambda lo, hi: "".join(map(str, rng.integers(0, 10, int(rng.integers(lo, hi)))))
    hexes = lambda n: "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, n))
    y, m, d = rng.integers(1800, 2100), rng.integers(1, 13), rng.integers(1, 29)
    return [
        f"{y}-{m:02d}-{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{m}/{d}/{y}", f"{m:02d}:{d:02d}:{d:02d}", f"{m}.{d}.{y % 40}", f"v{m}.{d}",
        f"{draw(1, 4)},{draw(3, 4)}.{draw(2, 3)}", f"{draw(1, 4)}.{draw(1, 8)}", draw(1, 9), draw(22, 40), hexes(32), hexes(40),
        "-".join(hexes(n) for n in (8, 4, 4, 4, 12)), f"{draw(2, 5)}-{draw(2, 5)}", f"@{hexes(6)}", f"{y}-{y + 1}",
    ][rng.integers(16)]


def _example(group: list[tuple[str, int, int]], kind: str, plain: list[str], rng: np.random.Generator) -> tuple[str, list[Span]]:
    """One window to learn from: a labelled one with its span varied, or a harmless one."""
    piece, a, b = group[rng.integers(len(group))]
    if kind == "none" or kind == "plain":
        spans: list[Span] = []
        if rng.random() < 0.6:  # a harmless number between two words
            words = plain[rng.integers(len(plain))].split(" ") if plain else ["", ""]
            words.insert(int(rng.integers(len(words) + 1)), _harmless(rng))
            piece = " ".join(words)
    else:
        new = _varied(kind, piece[a:b], rng) if rng.random() < 0.8 else piece[a:b]
        piece, spans = piece[:a] + new + piece[b:], [(a, a + len(new), kind)]
    if rng.random() < 0.15:
        piece = "".join(u if len(u := c.upper()) == 1 else c for c in piece)
    cut = int(rng.integers(0, 1 + min(40, spans[0][0] if spans else len(piece) // 2)))
    return piece[cut:cut + WINDOW], [(s - cut, e - cut, k) for s, e, k in spans if e - cut <= WINDOW]


def learn(docs: DataFrame, learn_docs: int = LEARN_DOCS, learn_windows: int = LEARN_WINDOWS, steps: int = 450, seed: int = 12) -> dict | None:
    """The tagger's parameters, or None if no document sampled holds a labelled span.

    At most ``learn_docs`` documents, those with the smallest hash of their id, give windows around the spans of the patterns, at most
    ``learn_windows`` of each kind and of none; these alone come to the driver.
    """
    few = docs.select("doc_id", F.xxhash64(F.col("doc_id"), F.lit(seed)).alias("h")).orderBy("h", "doc_id").limit(learn_docs)
    chosen = docs.join(F.broadcast(few.select("doc_id").distinct()), "doc_id", "left_semi").select("text")
    schema = "kind string, piece string, start int, end int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for t in batch.column(0).to_pylist() for r in _pieces(t or "")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    out = arrow_schema(schema)
    found = keep(map_arrow(chosen, run, schema), "pieces").withColumn("h", F.xxhash64("piece", F.lit(seed)))
    groups = {}
    for kind in (*KINDS, "none", "plain"):
        rows = found.filter(F.col("kind") == kind).orderBy("h", "piece", "start").limit(learn_windows).collect()
        groups[kind] = [(r.piece, r.start, r.end) for r in rows]
    labelled = [k for k in KINDS if groups[k]]
    if not labelled:
        return None
    plain = [p for p, _, _ in groups["plain"]]
    kinds = [k for k in (*labelled, *labelled, "none", "none", "plain") if groups[k]]

    def batches(i: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.Generator(np.random.PCG64([seed, i]))
        made = [_example(groups[k], k, plain, rng) for k in (kinds[j % len(kinds)] for j in range(48))]
        width = 96 if i % 3 else WINDOW
        # texts are cut to the width; a span that the cut goes through is tagged as far as it goes
        made = [(t[:width], [(a, min(b, width), k) for a, b, k in s if a < width]) for t, s in made]
        return tagger.symbols([t for t, _ in made], width), np.stack([_TAGS.of(width, s) for _, s in made])

    return tagger.train(_TAGS, batches, steps=steps, seed=seed)


# --- finding


def _fits(kind: str, span: str) -> bool:
    """Whether a decoded span can be of its kind at all."""
    digits = _digits(span)
    if kind == "email":
        return bool(re.fullmatch(r"[^\s@]+\s?(?:@|[\[(]at[\])])\s?[^\s@]+\.[^\s@]*[A-Za-z][^\s@]*", span, re.IGNORECASE))
    if kind == "ip":
        parts = span.split(".")
        return len(parts) == 4 and all(p.isdecimal() and p.isascii() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and bool(re.fullmatch(r"[0-9](?:[ .-]?[0-9])+", span))
    return 7 <= len(digits) <= 15 and bool(re.fullmatch(r"[+(]?[0-9][ ().0-9-]+[0-9]", span))


def window_spans(tags: np.ndarray, sure: np.ndarray, kinds: tuple[str, ...] = KINDS) -> list[tuple[int, int, str, float]]:
    """Runs of one kind in a window's tags, with their mean probability."""
    out = []
    for a in np.flatnonzero(tags % 2 == 1):
        b = a + 1
        while b < len(tags) and tags[b] == tags[a] + 1:
            b += 1
        out.append((int(a), int(b), kinds[(int(tags[a]) - 1) // 2], float(sure[a:b].mean())))
    return out


def reconciled(found: list[tuple[int, int, str, float]]) -> list[Span]:
    """Of spans from all windows of a text the set of largest total probability in which none overlap; found twice counts once."""
    votes: dict[Span, list[float]] = {}
    for a, b, k, p in found:
        votes.setdefault((a, b, k), []).append(p)
    spans = sorted(votes, key=lambda s: (s[1], s[0], KINDS.index(s[2])))
    ends = [s[1] for s in spans]
    best: list[tuple[float, int]] = [(0.0, -1)]  # of the first i spans: total, and the last one taken
    for i, s in enumerate(spans):
        before = bisect_right(ends, s[0], 0, i)
        total = best[before][0] + sum(votes[s]) / len(votes[s])
        best.append((total, i) if total > best[-1][0] else (best[-1][0], best[-1][1]))
    out, i = [], len(spans)
    while i and best[i][1] >= 0:
        s = spans[best[i][1]]
        out.append(s)
        i = bisect_right(ends, s[0], 0, best[i][1])
    return out[::-1]


def _windows(text: str) -> list[int]:
    """Starts of the windows that hold a trigger; every stretch of ``STEP`` characters lies whole in one window."""
    starts: set[int] = set()
    for m in _TRIGGER.finditer(text):
        w = m.start() // STEP
        starts.update((w * STEP, max(0, w - 1) * STEP))
    return sorted(starts)


def found_in(texts: list[str], model: dict | None, sure: float = SURE) -> list[tuple[list[Span], list[Span]]]:
    """Per text the spans of the patterns, and all spans."""
    base = [matches(t)[0] if _TRIGGER.search(t) else [] for t in texts]
    if model is None:
        return [(b, b) for b in base]
    places = [(i, w) for i, t in enumerate(texts) for w in _windows(t)]
    raw: dict[int, list[tuple[int, int, str, float]]] = {}
    for lo in range(0, len(places), _BATCH):
        part = places[lo:lo + _BATCH]
        tags, probable = tagger.decode(model, _TAGS, tagger.symbols([texts[i][w:w + WINDOW] for i, w in part], WINDOW))
        for (i, w), y, p in zip(part, tags, probable, strict=True):
            for a, b, k, q in window_spans(y, p):
                cut = (a == 0 and w > 0) or (b == WINDOW and w + WINDOW < len(texts[i]))
                b = min(b, len(texts[i]) - w)
                if not cut and q >= sure and b > a and _fits(k, texts[i][w + a:w + b]):
                    raw.setdefault(i, []).append((w + a, w + b, k, q))
    out = []
    for i, b in enumerate(base):
        taken = sorted((s, e) for s, e, _ in b)
        free = [x for x in raw.get(i, []) if not any(s < x[1] and x[0] < e for s, e in taken)] if raw.get(i) else []
        out.append((b, b + reconciled(free)))
    return out


def find(docs: DataFrame, model: dict | None, sure: float = SURE, text: str = "text") -> DataFrame:
    """``docs`` with ``n_email, n_ip, n_card, n_phone`` and ``base_sha256`` of the patterns' spans, and ``spans``, those the tagger adds included.

    Offsets are code points of the whole text, ends exclusive. Leftmost matches of each kind that don't overlap count, less
    those that fail their check; spans of the tagger overlap none of them. A NULL or empty text has no spans. Texts of any
    length take time and memory in proportion to it. Repeated rows give equal results, and other columns, those of the
    same names excepted, pass through; an empty table gives no rows.
    """
    rest = [f for f in docs.schema.fields if f.name not in {c.name for c in _COLUMNS}]
    schema = StructType([*rest, *_COLUMNS])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            found = found_in([t or "" for t in table.column(text).to_pylist()], model, sure)
            counts = {k: [sum(s[2] == k for s in b) for b, _ in found] for k in KINDS}
            values = [*(counts[k] for k in KINDS), [hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found], [joined(a) for _, a in found]]
            made = {c: pa.array(v, out.field(c).type) for c, v in zip([c.name for c in _COLUMNS], values, strict=True)}
            yield from pa.table([made[f.name] if f.name in made else table.column(f.name).cast(f.type) for f in out], schema=out).to_batches()

    return map_arrow(docs.select(*(f"`{f.name}`" for f in rest)), run, schema)
