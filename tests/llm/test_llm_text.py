"""Operators on text against brute force, and their edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stagetrace.llm import language, mixing, packing, quality, rules, sharding, simhash, substrings
from stagetrace.llm.words import many_word_hashes, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, kept string, rank string"
BPE = public_tokenizers.path("byte_bpe_50k.json")


def documents(seed=0, n=120):
    """Prose with copies, near copies, shared passages, runs of one word, NULLs, empty and long texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    say = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, out = say(40), []
    for i in range(n):
        words = say(rng.choice([0, 1, 2, 5, 12, 13, 14, 40, 200]))
        if i % 7 == 3 and out:
            words = out[rng.randrange(len(out))].split()
        if i % 7 == 4 and out:
            words = out[rng.randrange(len(out))].split()
            if words:
                words[rng.randrange(len(words))] = "changed"
        if i % 5 == 2:
            words = say(5) + passage[rng.randint(0, 10):rng.randint(25, 40)] + say(5)
        if i % 11 == 5:
            words = say(3) + ["again"] * rng.randint(10, 40) + say(3)
        out.append(rng.choice([" ", "  ", "\n", " \t"]).join(words))
    rows = [(i, t, rng.choice(["x", "y", None]), rng.choice(["s", "t", None, "u"]), len(t), "a", "b", "c", "d") for i, t in enumerate(out)]
    rows += [(n, None, None, None, None, None, None, None, None), (None, passage and " ".join(passage), "x", "s", None, "", "", "", ""),
             (n + 1, "", "x", "s", 0, "", "", "", ""), (n + 2, " ".join(say(20000)), "y", "s", 1, "", "", "", ""), rows[3], rows[3]]
    return rows


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(documents(), SCHEMA).write.parquet(path, mode="overwrite")
    return spark.read.parquet(path)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return (text or "").encode().split()


def roots(links, nodes):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# --- words


def test_word_hashes_tell_words_apart_and_nothing_else():
    texts = [r[1].encode() for r in documents() if r[1]]
    hashes, first = many_word_hashes(texts)
    words = [w for t in texts for w in t.split()]
    assert len(hashes) == len(words) and list(np.diff(first)) == [len(t.split()) for t in texts]
    assert len(set(zip(words, hashes.tolist(), strict=True))) == len(set(words)) == len(set(hashes.tolist()))


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    raw = b" ab\tcd  " + b"x" * 500 + b" " + b"yz " * 300
    whole = word_hashes(raw)
    monkeypatch.setattr("stagetrace.llm.words.BLOCK", 64)
    assert all(np.array_equal(a, b) for a, b in zip(whole, word_hashes(raw), strict=True))


# --- SimHash


def fingerprint(text, k=3):
    words = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words_of(text)]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("tree_rows", [1000, 3])
def test_components_within_a_radius(spark, docs, tree_rows):
    rows = docs.select("doc_id", "text").collect()
    fps = {(r.doc_id, r.text): fingerprint(r.text) for r in rows}
    nodes = sorted(set(fps.values()))
    comp = roots([(a, b) for i, a in enumerate(nodes) for b in nodes[:i] if (a ^ b).bit_count() <= 3], nodes)
    least = {}
    for (i, _), f in fps.items():
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    expected = sorted(((str(r.doc_id), simhash.signed(f := fps[r.doc_id, r.text]), least.get(comp[f])) for r in rows), key=repr)
    got = simhash.within_radius(docs, tree_rows=tree_rows).collect()
    assert sorted(((str(r.doc_id), r.fp, r.component_id) for r in got), key=repr) == expected


def test_trees_find_what_a_scan_finds():
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = [rng.choice(base) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(400)]
    tree = simhash.BKTree()
    for i, f in enumerate(fps):
        tree.add(f, i)
    for radius in (0, 3, 14):
        for f in fps[:50]:
            assert sorted(i for items in tree.near(f, radius) for i in items) == [i for i, g in enumerate(fps) if (f ^ g).bit_count() <= radius]


def test_shards_of_many_near_fingerprints_find_every_pair(spark):
    """Fingerprints that all agree in most bits: shards are dealt twice and then cut in pieces."""
    rng = random.Random(6)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9))) for _ in range(300)})
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    edges = simhash.map_groups(simhash.shards(df, 3, 8), ["key", "piece"], ["turn", "fp"], simhash._search(3), "u long, v long").collect()
    got = roots([(e.u, e.v) for e in edges], [simhash.signed(f) for f in fps])
    expected = roots([(simhash.signed(a), simhash.signed(b)) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 3], [simhash.signed(f) for f in fps])
    assert got == expected


@pytest.mark.parametrize("tree_rows", [1000, 3])
def test_one_row_of_each_component_stays(spark, docs, tree_rows):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [fingerprint(t) for _, t in rows]
    nodes = sorted(set(fps))
    comp = roots([(a, b) for i, a in enumerate(nodes) for b in nodes[:i] if (a ^ b).bit_count() <= 3], nodes)
    groups = {}
    for (i, _), f in zip(rows, fps, strict=True):
        groups.setdefault(comp[f], []).append(i)
    least = [min(g, key=lambda i: (i is None, i)) for g in groups.values()]
    left = simhash.one_of_each(docs, tree_rows=tree_rows)
    assert left.columns == docs.columns
    left = [(r.doc_id, r.text) for r in left.collect()]
    assert sorted(str(i) for i, _ in left) == sorted(map(str, least)) and set(left) <= set(rows)


def test_rows_that_share_an_id_are_told_apart(spark):
    rng = random.Random(23)
    say = lambda k: ["w%d" % rng.randrange(9000) for _ in range(k)]
    a, b, c, d = (" ".join(say(60)) for _ in range(4))
    same = lambda t: t.upper()
    rows = [(1, a), (2, same(a)), (2, b), (3, c), (3, d), (4, same(c)), (5, same(d)), (3, d), (6, ""), (6, same(a)), (6, None), (None, b), (7, "")]
    df = spark.createDataFrame([(i, t, "x", t) for i, t in rows], "doc_id long, text string, fp string, of string")
    left = simhash.one_of_each(df).select("doc_id", "text").collect()
    empty = [r for r in left if not r.text]
    assert len(empty) == 1 and empty[0].doc_id == 6
    assert sorted(repr(tuple(r)) for r in left if r.text) == sorted(map(repr, [(1, a), (2, b), (3, c), (3, d)]))


# --- substrings


def removed(rows, size=13):
    seen, out = {}, {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words_of(t)
        for s in range(len(w) - size + 1):
            seen.setdefault(tuple(w[s:s + size]), i)
    for i, t in rows:
        w = words_of(t)
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if i is not None and seen[tuple(w[s:s + size])] < i:
                gone[s:s + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode() if any(gone) else t)
    return out


@pytest.mark.parametrize("size", [13, 5])
def test_repeats_are_removed_exactly(docs, size):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = removed(rows, size)
    got = substrings.remove_repeats(docs, size).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.text) for r in got} == expected
    for r in got:
        assert sum(x.end - x.start for x in r.removed) == r.n_removed


def test_equal_windows_choose_equal_names_everywhere():
    rng = random.Random(2)
    common = ["".join(rng.choice("abc") for _ in range(2)) for _ in range(13)]
    names = set()
    for _ in range(50):
        words = [rng.choice(["q", "r", *common]) for _ in range(rng.randint(0, 9))] + common + [rng.choice(["q", *common]) for _ in range(rng.randint(0, 9))]
        h, first = many_word_hashes([" ".join(words).encode()])
        at, _ = substrings.window_starts(first, 13)
        chosen = substrings.window_names(h, first, at, 13)
        names.update(n for s, n in zip(at, chosen, strict=True) if words[s:s + 13] == common)
    assert len(names) == 1


# --- packing


def test_pieces_are_the_tokens_of_the_documents(docs):
    tokenizer = Tokenizer.from_file(BPE)
    got = packing.pack(docs, BPE, with_ids=True).collect()
    rows = docs.collect()
    expected = []
    for r in rows:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 2048 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 2048)]):
            own = ids[start:first if not piece else start + 2048]
            expected.append((str(r.doc_id), piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), own))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got) == sorted(expected)
    by = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by.get(r.sequence_id, 0)
        by[r.sequence_id] = r.offset + r.length
    assert max(by.values()) <= 2048 and sorted(by) == list(range(len(by)))
    assert len(by) <= -(-sum(by.values()) // 2048) * 1.02 + 1


def test_words_one_by_one_give_the_tokens_of_the_text():
    tokenizer, encoder = Tokenizer.from_file(BPE), packing.Encoder(BPE)
    rng = random.Random(1)
    for k in range(3000):
        text = "".join(rng.choice("abXY  \n\t .,!'sdtre019é日٣½ \x1c\x85😀\r") for _ in range(rng.randint(0, 25)))
        text += "<|endoftext|>" * (k % 40 == 0)
        assert np.frombuffer(next(encoder.encode([text])), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plans_use_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    counts = {}
    for _ in range(rng.choice([0, 5, 500, 20000])):
        x = min(capacity, max(1, int(rng.expovariate(5 / capacity))))
        counts[x] = counts.get(x, 0) + 1
    plan = packing.plan(counts, capacity)
    used = {}
    for lengths, times in plan:
        assert sum(lengths) <= capacity and times > 0
        for x in lengths:
            used[x] = used.get(x, 0) + times
    assert used == counts
    total = sum(x * n for x, n in counts.items())
    assert sum(t for _, t in plan) <= -(-total // capacity) * 1.25 + 1


def test_exact_complements_fill_sequences():
    plan = packing.plan({6: 3, 4: 1, 3: 2, 1: 5, 2: 1}, 10)
    assert sum(t for _, t in plan) == 4 and sorted(sum(p) for p, t in plan for _ in range(t)) == [5, 10, 10, 10]


# --- mixing


def test_knapsack_is_as_good_as_trying_all():
    rng = random.Random(3)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 12), rng.randint(1, 4)))
        counts = [rng.randint(1, 4) for _ in lengths]
        budget = rng.randint(0, 40)
        sums = {0}
        for x, c in zip(lengths, counts, strict=True):
            sums = {s + k * x for s in sums for k in range(c + 1)}
        taken = mixing.closest_sum(np.array(lengths), np.array(counts), budget)
        assert all(taken.get(x, 0) <= c for x, c in zip(lengths, counts, strict=True))
        total = sum(x * n for x, n in taken.items())
        if budget:
            assert abs(total - budget) == min(abs(s - budget) for s in sums if s <= 2 * budget)


@pytest.mark.parametrize("longest", [900, 300_000])
def test_bins_are_filled_exactly_at_any_budget(longest):
    """Sums of many short rows beside a long one are met to the word, however large the budget."""
    rng = np.random.default_rng(8)
    size = np.append(rng.integers(1, 900, 4000), longest)
    items = pd.DataFrame({"__h": rng.permutation(len(size)), "size": size})
    of = dict(zip(items["__h"].tolist(), size.tolist(), strict=True))
    for budget in (0.0, 7.0, 70_001.0, 300_000.0, 900_002.0, 1_500_000.4):
        got = mixing.fill(items, budget)
        assert len(set(got.tolist())) == len(got) and sum(of[h] for h in got.tolist()) == round(budget)
    assert not len(mixing.fill(items.iloc[:0], 5.0))


@pytest.mark.parametrize("bin_rows", [4000, 5])
def test_sources_come_near_their_targets(docs, bin_rows):
    rows = mixing.mix(docs, bin_rows=bin_rows).collect()
    assert len(rows) == docs.count() and rows == mixing.mix(docs, bin_rows=bin_rows).collect()
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(words_of(r.text))
    names = sorted((s for s in sizes if s is not None), key=str) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, budget = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = budget / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2 * sizes[s] if full else level * weight[s]
            budget -= target[s]
        open_ -= full or open_
    taken = {}
    for r in rows:
        assert r.size == len(words_of(r.text)) and r.taken == r.times * r.size and r.times <= 2
        assert (r.source_size, pytest.approx(r.target)) == (sizes[r.source], target[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    long = next(r.source for r in docs.collect() if len(words_of(r.text)) == 20000)
    for s in set(names) - {long}:  # where one document is nearly all, no sum comes near
        assert abs(taken[s] - target[s]) <= max(2, 0.1 * target[s])
    again = mixing.mixture(docs, bin_rows=bin_rows)
    assert again.columns == docs.columns and again.count() == sum(r.times for r in rows)


# --- rules


def test_measures_are_those_of_the_definitions(docs):
    for r in rules.measured(docs).collect():
        text = r.text or ""
        words = [w.decode() for w in words_of(text)]
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)} if len(words) < 1000 else set()
        lines = [x for x in text.split("\n") if words_of(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text), len(lines), len(lines) - len(set(lines)), len(inside))


def test_buckets_hold_their_values_and_are_narrow(spark):
    values = [*range(300), *(random.Random(1).getrandbits(k) for k in range(9, 50) for _ in range(3))]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", rules.bucket_top(F.col("v")).alias("top")).collect()
    assert all(r.v <= r.top <= r.v + r.v / 64 for r in got)


def test_thresholds_are_those_of_the_sketches(spark):
    """Medians and deciles worked out plainly: groups, languages for small ones, all for small languages, values above 0 where the median is 0."""
    rng = random.Random(11)
    rows = []
    for lang, source, n, some in (("en", "a", 120, 0.9), ("en", "b", 30, 0.9), ("en", None, 400, 0.3), ("de", "a", 20, 0.0), (None, "c", 150, 0.0)):
        for _ in range(n):
            rows += [(lang, source, r, rng.randrange(1, 9000) if rng.random() < some or r == "word_length" else 0) for r in rules.RULES if r != "repeats"]
            rows.append((lang, source, "repeats", 0))

    def top(v):
        width = 1 << max(v.bit_length() - 7, 0)
        return (v // width + 1) * width - 1

    def deciles(lang, source, rule, above):
        for keep in (lambda r: r[:2] == (lang, source), lambda r: r[0] == lang, lambda r: True):
            v = sorted(top(r[3]) for r in rows if keep(r) and r[2] == rule and r[3] >= above)
            if len(v) >= 100:
                break
        return [v[-(-len(v) * k // 10) - 1] for k in (1, 5, 9)] if v else None

    want = {}
    for lang, source, rule in {r[:3] for r in rows}:
        q = deciles(lang, source, rule, 0)
        q = q if q[1] else deciles(lang, source, rule, 1)
        if q:
            width = 1 << max(q[1].bit_length() - 7, 0)
            low = q[1] - 6 * max(q[2] - q[1], q[1] - q[0], width) if rule == "word_length" else 0
            want[lang, source, rule] = (low, q[1] + 6 * max(q[1] - q[0], width))
        else:
            want[lang, source, rule] = (0, None)
    df = spark.createDataFrame(rows, "lang string, source string, rule string, value long")
    sketch = df.groupBy("lang", "source", "rule", rules.bucket_top(F.col("value")).alias("value")).agg(F.count("*").alias("n"))
    got = {(r.lang, r.source, r.rule): (r.low, r.high) for r in rules.thresholds(sketch).collect()}
    assert got == want and want["en", "a", "repeats"] == (0, None)


def test_thresholds_follow_the_source(spark):
    rng = random.Random(8)
    rows, odd = [], set()
    for i in range(900):
        source = ("plain", "code")[i % 2]
        words = ["w%d" % rng.randrange(5000) for _ in range(60)]
        signs = rng.randint(0, 3) + (40 if source == "code" else 0)
        if i % 50 < 2:
            signs, odd = 45 if source == "plain" else 400, odd | {i}
        rows.append((i, " ".join(words) + " " + "#" * signs, "en", source))
    rows += [(1000, None, None, None), (1001, "few words", "en", "plain"), (1002, " ".join(f"w{i}" for i in range(900, 930)), None, None)]
    got = {r.doc_id: r for r in rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {i for i, r in got.items() if r.base_failed} == {1000, 1001}
    assert {i for i, r in got.items() if not r.kept and not r.base_failed} == odd


# --- sharding


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("té")).alias("text"))
    root = sharding.tree(24)
    rows = sharding.assign(df, root, sharding.grown(root, 24)).collect()
    assert len(rows) == 20000 and {r.size for r in rows} == {8, 11} and {r.text_crc32 for r in rows} == {0, zlib.crc32("té".encode())}
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {24} and abs(len(moved) - 800) < 200
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(24)) and all(sorted(s) == list(range(len(s))) and abs(len(s) - 833) < 170 for s in by.values())


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    leaf = lambda i, w=1.0: sharding.Node(f"shard{i}", shard=i, own_weight=w)
    rack = lambda name, *leaves: sharding.Node(name, leaves)
    before = sharding.Node("root", (rack("a", leaf(0), leaf(1)), rack("b", leaf(2), leaf(3))))
    after = sharding.Node("root", (rack("a", leaf(0), leaf(1)), rack("b", leaf(2, 0.5), leaf(3, 1.5))))
    rows = sharding.assign(spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), before, after).collect()
    moved = {(r.shard, r.grown_shard) for r in rows if r.shard != r.grown_shard}
    assert moved == {(2, 3)}


# --- classifiers


def test_languages_are_told_on_held_out_texts(spark):
    rng = random.Random(5)
    tongues = {"aa": ["".join(rng.choice("abcdef") for _ in range(rng.randint(4, 9))) for _ in range(150)],
               "bb": ["".join(rng.choice("efghij") for _ in range(rng.randint(4, 9))) for _ in range(150)]}
    rows = [(i, " ".join(rng.choice(tongues[t]) for _ in range(60)).upper() + "!!", t) for i in range(120) for t in [("aa", "bb")[i % 2]]]
    rows += [(200, None, "aa"), (201, "", None), (202, "123 !!", "bb"), (203, "x", None), (204, "no label", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = language.learn(df, F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in language.identify(df, model).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == t and got[i].accepted for i, _, t in rows[:120] if i % 3 == 1)
    assert [(got[i].lang_pred, got[i].score, got[i].accepted) for i in (200, 201, 202)] == [("und", 0.0, False)] * 3
    nothing = language.learn(df.limit(0))
    assert {r.lang_pred for r in language.identify(df, nothing).collect()} == {"und"}


def test_encoded_sizes_are_those_of_plain_encoders_at_every_length():
    """A second encoder, one call of the library per piece; no length changes the way a text is encoded."""
    rng = random.Random(15)
    words = {n: ["".join(rng.choice(a) for _ in range(6)) for _ in range(200)] for n, a in (("aa", "abcdef"), ("bb", "efghij"))}
    model = language.Model(("aa", "bb"), tuple(" ".join(words[n]).encode() for n in ("aa", "bb")))
    coder, whole = language.Coder(model), " ".join(rng.choice(words["bb"]) for _ in range(2000))
    for n in (1, 20, 299, 300, 301, 4095, 4096, 4097, len(whole)):
        raw, sizes = language.letters(whole[:n]).encode(), []
        for d in model.dictionaries:
            how = zstandard.ZstdCompressionParameters(**language.SEARCH, window_log=18, chain_log=18, write_content_size=0, write_dict_id=0)
            plain = zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            sizes.append(sum(len(plain.compress(b" " * 64 + raw[at:at + 4096])) for at in range(0, len(raw), 4096)))
        assert coder.sizes(whole[:n]).tolist() == sizes
        assert n < 20 or language.decide(coder, model.languages, whole[:n], 0.01)[0] == "bb"


def test_dictionaries_are_cut_from_whole_texts(spark):
    rows = [(i, "start " * 400 + "word " * 400, "x") for i in range(200)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_chars=100)
    assert b"start" in model.dictionaries[0] and b"word" in model.dictionaries[0]


def test_quality_is_told_on_held_out_texts(spark):
    rng = random.Random(9)
    vocabulary = ["w%d" % i for i in range(500)]
    rows, marks = [], []
    for i in range(300):
        good = i % 3 > 0
        words = [rng.choice(vocabulary) for _ in range(50)]
        rows.append((i, " ".join(words if good else [w + rng.choice(["!!", "***"]) for w in words]), None if i % 9 == 0 else 100))
        marks.append((i, int(good)))
    rows += [(400, None, None), (401, "", 0), (402, "x", -1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    machine = quality.learn(df, spark.createDataFrame([*marks, (None, 1), (5000, None)], "doc_id long, quality int"), F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r.score for r in quality.score(df, machine).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.3) == bool(q) for i, q in marks if i % 5 == 0)
    assert quality.learn(df, spark.createDataFrame([], "doc_id long, quality int"), F.lit(True)).bias == 0


def test_pairs_are_summed_as_if_one_by_one():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.5, rng.standard_normal(quality.FEATURES), rng.standard_normal((quality.FEATURES, quality.RANK)))
    ids, x = rng.choice(quality.FEATURES, 9, replace=False), rng.standard_normal(9)
    slow = m.bias + sum(m.weights[i] * a for i, a in zip(ids, x, strict=True)) + sum(
        m.vectors[ids[a]] @ m.vectors[ids[b]] * x[a] * x[b] for a in range(9) for b in range(a))
    assert m.scores(ids, x, np.array([0, 9]))[0] == pytest.approx(slow)


# --- empty tables


def test_empty_tables_give_empty_results(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    root = sharding.tree(24)
    results = [simhash.within_radius(empty), simhash.one_of_each(empty), language.identify(empty, language.learn(empty)),
               quality.score(empty, quality.learn(empty, labels, F.lit(True))), rules.apply_rules(empty), substrings.remove_repeats(empty),
               packing.pack(empty, BPE), sharding.assign(empty, root, sharding.grown(root, 24)), mixing.mix(empty), mixing.mixture(empty)]
    assert [r.count() for r in results] == [0] * len(results)


def test_added_columns_replace_clashing_ones_and_rows_stay(docs):
    n = docs.count()
    for out in (language.identify(docs, language.learn(docs)), rules.apply_rules(docs), substrings.remove_repeats(docs), mixing.mix(docs)):
        assert len(set(out.columns)) == len(out.columns) and out.count() == n and set(docs.columns) <= set(out.columns)


def test_repeats_among_rows_that_share_an_id(spark):
    """Rows of one id hold different texts: a copy of an earlier text loses its words, the others keep theirs."""
    w, v, short = (" ".join(f"{c}{i}" for i in range(40)) for c in ("w", "v", "s"))
    short = " ".join(short.split()[:5])
    rows = [(1, w), (2, w), (2, v), (2, None), (2, short), (3, v), (4, v), (4, v), (5, short), (None, v), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in substrings.remove_repeats(docs).collect()), key=repr)
    want = [(1, w, 40, 0), (2, "", 40, 40), (2, v, 40, 0), (2, None, 0, 0), (2, short, 5, 0), (3, "", 40, 40), (4, "", 40, 40), (4, "", 40, 40), (5, short, 5, 0),
            (None, v, 40, 0), (None, None, 0, 0)]
    assert got == sorted(want, key=repr)


def test_columns_of_clashing_names_stay(spark):
    schema = "doc_id long, text string, lang string, source string, _lang string, _source string, limits int, size long, times int, target string, _again int"
    rows = [(i, " ".join(f"w{j}" for j in range(30)), "x", "s", "a", "b", 1, 1000 + i, 7, "t", 9) for i in range(5)]
    docs = spark.createDataFrame(rows, schema)
    again = mixing.mixture(docs)
    assert again.columns == docs.columns and set(map(tuple, again.collect())) <= set(rows) and again.count() >= 5
    judged = rules.apply_rules(docs).collect()
    assert len(judged) == 5 and {(r._lang, r._source, r.limits, r.size) for r in judged} == {("a", "b", 1, 1000 + i) for i in range(5)}


def test_remembered_words_are_bounded_in_bytes():
    words = packing.Words(lambda w: [1] * len(w), "")
    for i in range(50_000):
        assert len(words["x" * 20_000 + str(i)]) == 4 * len("x" * 20_000 + str(i))
        if i > 200:
            break
    assert len(words) == 0
    words.room = 10_000
    for i in range(1000):
        assert len(words[f"w{i}"]) == 4 * len(f"w{i}")
    assert len(words) < 60
