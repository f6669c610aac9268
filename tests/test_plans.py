import random

import pytest
from conftest import plain
from pyspark.sql import functions as F

from stagetrace.plans import chunks, dyadic, skew


def test_cover_is_exact(spark):
    n = 37
    spans = [(lo, hi) for lo in range(n + 1) for hi in range(n + 1)]
    df = spark.createDataFrame(spans, "lo int, hi int")
    got = {}
    for r in dyadic.cover(df, "lo", "hi").collect():
        points = range(r["blk"] << r["blk_size"], (r["blk"] + 1) << r["blk_size"])
        got.setdefault((r["lo"], r["hi"]), []).append(points)
    for lo, hi in spans:
        blocks = got.get((lo, hi), [])
        assert sorted(p for b in blocks for p in b) == list(range(lo, hi))
        assert len(blocks) <= 2 * n.bit_length()


def test_blocks_above_a_point(spark):
    points = spark.range(9).withColumnRenamed("id", "k")
    rows = dyadic.above(points, "k", 9).collect()
    assert {(r["k"], r["blk_size"], r["blk"]) for r in rows} == {
        (k, h, k >> h) for k in range(9) for h in range(5)}


def test_ordered_chunks(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(3), i) for i in range(500)]
    df, parts = chunks.ordered_chunks(spark.createDataFrame(rows, "a int, b int"), ["a", "b"], 40)
    got = sorted(df.collect(), key=lambda r: (r["chunk"], r["pos"]))
    assert [(r["a"], r["b"]) for r in got] == sorted(rows)
    sizes = [sum(r["chunk"] == c for r in got) for c in range(parts)]
    assert 13 <= parts == max(r["chunk"] for r in got) + 1 and 0 < min(sizes) <= max(sizes) <= 40


def test_chunks_stay_small_in_few_partitions(spark):
    df = spark.range(5000).select(F.lit(1).alias("a"), (5000 - F.col("id")).alias("b"))
    out, n = chunks.ordered_chunks(df, ["a", "b"], 2, max_parts=3)
    got = sorted(out.collect(), key=lambda r: (r["chunk"], r["pos"]))
    assert [r["b"] for r in got] == list(range(1, 5001)) and 2500 <= n <= 2503
    assert {r["pos"] for r in got} == {0, 1}
    totals = out.groupBy("chunk").count()
    before = {r["chunk"]: r["count"] for r in chunks.before_chunk(totals, [], ["count"], 7).collect()}
    first = {}
    for i, r in enumerate(got):
        first.setdefault(r["chunk"], i)
    assert before == first


def test_before_chunk(spark):
    totals = spark.createDataFrame([(0, 3), (1, 4), (2, 5)], "chunk int, n int")
    assert plain(chunks.before_chunk(totals, [], ["n"])) == [(0, 0), (1, 3), (2, 7)]


def test_split_hot(spark):
    df = spark.createDataFrame([(1,)] * 9 + [(2,)] * 2 + [(None,)] * 9, "k int")
    split = skew.split_hot(df, "k", 5)
    assert plain(split.keys) == [(1,)]
    assert split.hot.count() == 9 and split.cold.count() == 11
    assert skew.split_hot(df, "k", 50).hot is None


@pytest.mark.parametrize("how", ["left_semi", "left_anti", "inner", "left"])
def test_skewed_join_equals_join(spark, how):
    left = spark.createDataFrame(
        [(1, i) for i in range(9)] + [(2, 1), (3, 1), (None, 1)] + [(4, i) for i in range(9)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c")], "k int, w string")
    if how.startswith("left_"):
        right = right.select("k")
    assert plain(skew.skewed_join(left, right, "k", how, 5)) == plain(left.join(right, "k", how))


def test_checked_broadcast(spark):
    few, small = skew.broadcast_if_small(spark.range(5), 5)
    many, large = skew.broadcast_if_small(spark.range(6), 5)
    assert small and not large
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    other = spark.range(9).withColumn("x", F.lit(1))
    assert "strategy=broadcast" in plan(other.join(few, "id"))
    assert "strategy=broadcast" not in plan(other.join(many, "id"))


def test_keys_are_not_counted_when_no_slot_is_full(spark, monkeypatch):
    df = spark.range(300).select((F.col("id") % 100).alias("k"))
    monkeypatch.setattr(skew, "broadcast_if_small", lambda *a, **b: pytest.fail("keys were counted"))
    assert skew.split_hot(df, "k", 50).hot is None
