"""Quality rules whose thresholds follow each language and source.

A document's measures go into quantile sketches per language and source. A sketch counts values in buckets of
constant relative width (a value's bit length and its leading bits), so sketches merge by adding counts: those of a small
source give way to their language's, and those of a small language to that of all documents. Thresholds
read from the sketches are joined back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from stagetrace.llm.groups import arrow_schema, map_arrow
from stagetrace.llm.store import keep
from stagetrace.llm.words import SPACE, in_blocks, many_word_hashes, mix
from stagetrace.llm.substrings import window_hashes, window_starts
from stagetrace.plans.skew import broadcast_if_small

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
MIN_WORDS, MAX_REPEAT_PCT = 20, 30
# A sketch keeps this many leading bits of a value: buckets are at most 1/64 of their value wide.
BITS = 7
# Measures per 10 000: numerator, denominator, and whether low values fail too.
RULES = {
    "symbols": ("n_symbols", "n_words", False),
    "dup_lines": ("n_dup_lines", "n_lines", False),
    "repeats": ("n_repeat_words", "n_words", False),
    "word_length": ("word_chars", "n_words", True),
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True


# --- measures


def measure(texts: list[bytes]) -> np.ndarray:
    """A row of ``MEASURES`` for every text."""
    words, first = many_word_hashes(texts)
    out = np.zeros((len(texts), 6), np.int64)
    out[:, 0] = np.diff(first)
    out[:, 5] = repeated_words(words, first)
    for i, t in enumerate(texts):
        data = np.frombuffer(t, np.uint8)
        # every code point has one byte that is no continuation
        out[i, 1] = ((data & 0xC0) != 0x80).sum() - SPACE[data].sum()
        out[i, 2] = _SYMBOL[data].sum()
        lines = [x for x in t.split(b"\n") if x and not x.isspace()]
        out[i, 3] = len(lines)
        out[i, 4] = len(lines) - len(set(lines))
    return out


def repeated_words(words: np.ndarray, first: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Words of every text that lie in a window of ``size`` words found twice or more in that text."""
    at, doc = window_starts(first, size)
    if not len(at):
        return np.zeros(len(first) - 1, np.int64)
    one, two = window_hashes(words, at, size)
    key = mix(one ^ mix((two.astype(np.uint64) << np.uint64(32)) + doc.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    equal = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    change = np.bincount(at[twice], minlength=len(words) + 1) - np.bincount(at[twice] + size, minlength=len(words) + 1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
    return np.diff(inside[first])


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``MEASURES``, which replace columns by these names. NULL texts have no words."""
    docs = docs.drop(*(f.split()[0] for f in MEASURES.split(", ")))
    schema = pa.schema([*arrow_schema(docs.schema), *(added := arrow_schema(MEASURES))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [b"" if t is None else t.encode() for t in b.column("text").to_pylist()]
            found = np.concatenate([measure(texts[a:z]) for a, z in in_blocks(texts)] or [np.zeros((0, 6), np.int64)])
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(found[:, i], f.type) for i, f in enumerate(added))], schema=schema)

    return map_arrow(docs, run, StructType([*docs.schema.fields, *_parse_datatype_string(MEASURES).fields]))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def _value(rule: str) -> Column:
    part, whole, _ = RULES[rule]
    return F.expr(f"IF({whole} = 0, 0L, {part} * 10000 DIV {whole})")


# --- sketches


def _shift(value: Column) -> Column:
    return F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))


def bucket_top(value: Column) -> Column:
    """The largest value of the bucket that ``value`` (not negative) falls into."""
    one = F.lit(1).cast("long")
    return F.call_function("shiftleft", F.call_function("shiftright", value, _shift(value)) + one, _shift(value)) - one


def bucket_width(value: Column) -> Column:
    """How many values share a bucket with ``value``: what a sketch cannot tell apart."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), _shift(value))


def sketches(measures: DataFrame) -> DataFrame:
    """``(lang, source, rule, value, n)``: how many passing documents of a language and source fall into each bucket."""
    values = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), bucket_top(_value(r)).alias("value")) for r in RULES)))
    return (measures.filter(~base_failed()).select("lang", "source", values.alias("v"))
            .groupBy("lang", "source", F.col("v.rule").alias("rule"), F.col("v.value").alias("value"))
            .agg(F.count("*").alias("n")))


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Sketches merged over ``by``: documents, and the values at a tenth, a half and nine tenths of them."""
    merged = sketch.groupBy(*by, "rule", "value").agg(F.sum("n").alias("n"))
    w = W.partitionBy(*by, "rule")
    upto = F.sum("n").over(w.orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = merged.select(*by, "rule", "value", upto.alias("upto"), F.sum("n").over(w).alias("total"))
    at = [F.min(F.when(10 * F.col("upto") >= q * F.col("total"), F.col("value"))).alias(f"q{q}") for q in (1, 5, 9)]
    return ranked.groupBy(*by, "rule").agg(F.max("total").alias("total"), *at)


def informed(sketch: DataFrame, min_rows: int = 100) -> DataFrame:
    """``(lang, source, rule, q)``: the quantiles that speak for every language and source.

    Groups under ``min_rows`` documents take the sketch of their language, and languages under ``min_rows`` that of all. A
    median of 0 tells nothing of the documents that have what a rule measures; then the sketches of the values above 0
    take its place, by the same steps. ``q`` is NULL if no document has a value above 0.
    """
    out = sketch.select("lang", "source", "rule").distinct()
    for p, part in (("all", sketch), ("some", sketch.filter("value > 0"))):
        levels = [("g", ["lang", "source"]), ("l", ["lang"]), ("a", [])]
        for level, by in levels:
            found = quantiles(part, by).select(*(F.col(c).alias(f"__{c}") for c in (*by, "rule")), F.struct("total", "q1", "q5", "q9").alias(f"{p}_{level}"))
            same = F.col("rule") == F.col("__rule")
            for c in by:
                same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
            out = out.join(found, same, "left").drop("__rule", *(f"__{c}" for c in by))
        g, l, a = (F.col(f"{p}_{level}") for level, _ in levels)
        out = out.withColumn(p, F.when(g["total"] >= min_rows, g).when(l["total"] >= min_rows, l).otherwise(a))
    return out.select("lang", "source", "rule", F.when(F.col("all.q5") > 0, F.col("all")).otherwise(F.col("some")).alias("q"))


def thresholds(sketch: DataFrame, spread: int = 6, min_rows: int = 100) -> DataFrame:
    """``(lang, source, rule, low, high)``: a median and ``spread`` times the distance to its tenth or ninth decile.

    The upper threshold uses the distance below the median, so a source of which under half is junk still rejects it; the lower
    one uses the larger of both, for pooled sketches have a mode per source and their medians may lie in the upper one. The medians are those of ``informed``. A distance counts as the width of the median's bucket at least,
    for nearer values the sketch does not tell apart. Where no document has a value above 0, ``high`` is NULL and rejects nothing.
    """
    both = F.element_at(F.create_map(*(F.lit(x) for r, v in RULES.items() for x in (r, v[2]))), F.col("rule"))
    width = bucket_width(F.col("q.q5"))
    high = F.col("q.q5") + spread * F.greatest(F.col("q.q5") - F.col("q.q1"), width)
    low = F.when(both, F.col("q.q5") - spread * F.greatest(F.col("q.q9") - F.col("q.q5"), F.col("q.q5") - F.col("q.q1"), width)).otherwise(F.lit(0))
    return informed(sketch, min_rows).select("lang", "source", "rule", low.alias("low"), high.alias("high"))


# --- the operator


def judged(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """``measures`` with ``base_failed``, ``kept`` and ``broken``, the rules that a document breaks."""
    maps = limits.groupBy("lang", "source").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", F.struct("low", "high")))).alias("__limits"))  # a few rules
    maps, _ = broadcast_if_small(maps.withColumnsRenamed({"lang": "__lang", "source": "__source"}), derived=True)
    joined = measures.join(maps, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    own = {r: (_value(r), F.element_at("__limits", F.lit(r))) for r in RULES}
    broken = F.array_compact(F.array(*(F.when((v > m["high"]) | (v < m["low"]), F.lit(r)) for r, (v, m) in own.items())))
    return (joined.withColumn("base_failed", base_failed()).withColumn("broken", broken)
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
            .select(*measures.columns, "base_failed", "broken", "kept"))


def apply_rules(docs: DataFrame, spread: int = 6, min_rows: int = 100) -> DataFrame:
    """``docs (doc_id, text, lang, source)`` with measures, ``base_failed``, ``broken`` and ``kept``; one row per row.

    NULL languages and sources are groups of their own. A document that fails the base rules is not kept and is in no
    sketch. Columns by the added names are replaced.
    """
    docs = docs.drop("base_failed", "broken", "kept")
    sketch = keep(sketches(measured(docs.select("lang", "source", "text"))), "sketches")
    return judged(measured(docs), thresholds(sketch, spread, min_rows))
