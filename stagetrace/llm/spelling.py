"""Spelling variants: words one edit apart, and the much more frequent form that each leads to.

Near words are found by an index of grams of variable length. A dictionary starts from all grams of ``SHORTEST`` symbols; a gram
that occurs more than ``FREQUENT`` times is pruned in favour of its extensions, round by round, up to half a word. So at a
given place of a word stands exactly one gram, the shortest rare one, and the symbols up to its end decide which.
One edit therefore affects no gram whose symbols lie before it, nor any that starts after it, and of two grams that don't
overlap it affects one at most: the bound for such a pair is 1, so a near word is in the list of one of the two. Each
word merges the lists of the two grams of its own with the fewest words, and every word of them is verified.

Lists hold places: a gram before the edit stands at the same distance from the start in both words, a gram after it at
the same distance from the end. Words are marked at both ends, so that ends can be edited too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrace.llm.store import Kept, keep
from stagetrace.plans.skew import broadcast_if_small

# The pattern of a word's letters, and what is lower-cased.
LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHORTEST = 4
# A gram is extended while more words than this hold it in their index.
FREQUENT = 200
# Longest grams, by the length of the word: the largest of these that fits twice into the marked word.
CAPS = (1, 2, 3, 4, 6, 8, 12)
# Places at either end of a word that are indexed.
PLACES = 4
# Frequent grams that may be broadcast.
DICTIONARY_ROWS = 200_000
_START, _END = "\u0002", "\u0003"


def words(docs: DataFrame, min_length: int = 7, least: int = 2, every: int | None = None) -> DataFrame:
    """``(word, n)``: runs of letters with only A-Z lower-cased, of ``min_length`` code points and ``least`` occurrences at least.

    With ``every``, a run whose CRC-32 of ``<doc_id>:<run>`` it divides loses the code point at that number modulo its length:
    misspellings of a known rate. A NULL text has no words, and a NULL ``doc_id`` misspells none.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS + "{%d,}" % min_length), F.lit(0))).alias("run"))
    low = F.translate("run", UPPER, LOWER)
    if every:
        h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), low))
        runs = runs.select(low.alias("low"), h.alias("h")).withColumn("at", (F.col("h") % F.length("low")).cast("int"))
        shorter = F.concat(F.substring("low", F.lit(1), F.col("at")), F.substring("low", F.col("at") + 2, F.length("low")))
        low = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("low"))
    found = runs.select(low.alias("word")).filter(F.length("word") >= min_length)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _cap(size: Column) -> Column:
    """Longest gram of a marked word of ``size`` symbols."""
    out = F.lit(CAPS[0])
    for c in CAPS[1:]:
        out = F.when(size >= 2 * c, c).otherwise(out)
    return out


def _indexed(vocabulary: DataFrame) -> DataFrame:
    """One row per word, kind of gram and place: ``(word, n, size, cap, own, side, off, at, len)``.

    ``cap`` is that of the word, and also that of words one shorter where it is another one, whose lists it must be in as well.
    ``off`` counts from the start (``side`` 0) or the end (1), ``at`` from the start, ``len`` is the gram's length so far.
    """
    size = F.length("word") + 2
    rows = vocabulary.select("word", "n", size.alias("size"), F.explode(F.array_distinct(F.array(_cap(size), _cap(size - 1)))).alias("cap"))
    rows = rows.withColumn("own", F.col("cap") == _cap(F.col("size")))
    cap = F.col("cap")
    places = [(F.lit(0), F.lit(i), F.lit(i)) for i in range(PLACES)] + [(F.lit(1), cap + i, F.col("size") - cap - i) for i in range(PLACES)]
    each = F.array(*(F.struct(a.alias("side"), b.alias("off"), c.alias("at")) for a, b, c in places))
    rows = rows.select("*", F.inline(each)).withColumn("len", F.least(F.lit(SHORTEST), cap))
    fits = F.when(F.col("side") == 0, F.col("off") < cap).otherwise(F.col("at") >= 0)
    return rows.filter(fits & (F.col("at") + F.col("len") <= F.col("size")))


def _gram() -> Column:
    return F.substring(F.concat(F.lit(_START), "word", F.lit(_END)), F.col("at") + 1, F.col("len"))


def grams(vocabulary: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The variable-length gram of every indexed place, as ``gram``, with ``f``: how many places hold it, 0 if rare.

    Every round counts the grams that still grow and keeps those that are frequent, a dictionary of at most rows / ``frequent``
    entries; it is broadcast when a count shows that it is small, and joined otherwise.
    """
    growing, done = Kept(_indexed(vocabulary), "grams"), []
    while True:
        rows = growing.read().withColumn("gram", _gram())
        counts = rows.groupBy("cap", "gram").agg(F.count("*").alias("f")).filter(F.col("f") > frequent)
        dictionary, _ = broadcast_if_small(counts, DICTIONARY_ROWS, derived=True)
        met = rows.join(dictionary, ["cap", "gram"], "left").withColumn("f", F.coalesce("f", F.lit(0)))
        grows = (F.col("f") > 0) & (F.col("len") < F.col("cap")) & (F.col("at") + F.col("len") < F.col("size"))
        done.append(keep(met.filter(~grows), "ended"))
        longer = Kept(met.filter(grows).select(*growing.schema.names).withColumn("len", F.col("len") + 1), "grams")
        growing.drop()
        growing = longer
        if not growing.read().take(1):
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _probes(index: DataFrame) -> DataFrame:
    """Per word its two grams, one before the other, that the fewest places share: ``(word, n, size, cap, first, second)``."""
    gram = F.struct("off", "at", "len", "gram", "f")
    of = lambda side: F.collect_list(F.when(F.col("side") == side, gram))  # noqa: E731  eight places at most
    own = index.filter("own").groupBy("word").agg(F.first("n").alias("n"), F.first("size").alias("size"), F.first("cap").alias("cap"), of(0).alias("a"), of(1).alias("b"))
    # the places are few, and the first and the last of them never overlap
    pairs = F.flatten(F.transform("a", lambda a: F.transform(
        F.filter("b", lambda b: b["at"] >= a["at"] + a["len"]),
        lambda b: F.struct((a["f"] + b["f"]).alias("f"), (-a["len"] - b["len"]).alias("len"), a.alias("a"), b.alias("b")))))
    best = F.array_min(pairs)
    return own.select("word", "n", "size", "cap", best["a"].alias("first"), best["b"].alias("second"))


def near_pairs(vocabulary: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``(word, n, other, m)``: every two words exactly one inserted, deleted or replaced code point apart, once."""
    index = keep(grams(vocabulary, frequent), "index")
    probes = _probes(index)
    sides = F.array(F.struct(F.lit(0).alias("side"), "first.off", "first.gram"), F.struct(F.lit(1).alias("side"), "second.off", "second.gram"))
    asked = probes.select(
        F.col("word").alias("s"), F.col("n").alias("ns"), F.col("size").alias("ss"), "cap", "first.at", F.col("first.gram").alias("before"), F.inline(sides))
    asked = asked.withColumn("size", F.explode(F.array(F.col("ss"), F.col("ss") + 1)))
    lists = index.select("cap", "side", "off", "gram", "size", F.col("word").alias("t"), F.col("n").alias("nt"))
    met = asked.join(lists, ["cap", "side", "off", "gram", "size"])
    # equal lengths meet from both sides, and a pair that shares the first gram is not taken from the list of the second
    once = (F.col("size") > F.col("ss")) | (F.col("s") < F.col("t"))
    marked = F.concat(F.lit(_START), "t", F.lit(_END))
    twice = (F.col("side") == 1) & (F.substring(marked, F.col("at") + 1, F.length("before")) == F.col("before"))
    return met.filter(once & ~twice & (F.levenshtein("s", "t", 1) == 1)).select(
        F.col("s").alias("word"), F.col("ns").alias("n"), F.col("t").alias("other"), F.col("nt").alias("m"))


def forms(vocabulary: DataFrame, factor: int = 10, frequent: int = FREQUENT) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per row of ``vocabulary (word, n)``, whose words are distinct.

    ``form`` is the near word of largest ``n``, the smallest in code-point order among equals, if that is at least ``factor``
    times the word's own; else NULL, as is ``form_n``. ``root`` is the last of the word's form, its form, and so
    on. Words of any length, without the control characters U+0002 and U+0003, which mark their ends; a NULL word is left
    out; an empty table gives no rows.
    """
    vocabulary = keep(vocabulary.filter("word IS NOT NULL").select("word", "n"), "vocabulary")
    pairs = keep(near_pairs(vocabulary, frequent), "pairs")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("m").alias("n"), F.col("word").alias("other"), F.col("n").alias("m")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    found = vocabulary.join(near, "word", "left")
    strong = -F.col("best.m") >= factor * F.col("n")
    found = keep(found.select(
        "word", F.when(strong, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, -F.col("best.m")).alias("form_n")), "forms")
    steps = found.filter("form IS NOT NULL").select("word", "form")
    # n grows by the factor at every step, so the ways are short; rows that have arrived don't move on
    moving, ended = keep(steps.select("word", F.col("form").alias("root")), "roots"), []
    while moving.take(1):
        on = moving.join(steps.select(F.col("word").alias("root"), F.col("form").alias("_next")), "root", "left")
        on = keep(on.select("word", "root", "_next"), "roots")
        ended.append(on.filter("_next IS NULL").select("word", "root"))
        moving = on.filter("_next IS NOT NULL").select("word", F.col("_next").alias("root"))
    for roots in ended[1:]:
        ended[0] = ended[0].unionByName(roots)
    if ended:
        found = found.join(ended[0], "word", "left")
    else:
        found = found.withColumn("root", F.lit(None).cast("string"))
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
