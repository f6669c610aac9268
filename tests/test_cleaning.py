import contextlib
import io

import pytest
from conftest import at, plain
from pyspark.sql import functions as F

from stagetrace.operators import batches as b
from stagetrace.operators import cleaning as c

FIVE = ["Welcome", "LmiConnected", "LaunchStart", "LaunchEnd", "FulfillmentEnded"]


def rows():
    out = [(i, k, 1, i) for i, k in enumerate(FIVE)]
    out += [(10 + i, k, 2, i) for i, k in enumerate(FIVE + ["Welcome"])]
    out += [(20 + i, k, 3, i) for i, k in enumerate(FIVE[:4])]
    out += [(30 + i, k, 4, i) for i, k in enumerate(FIVE + ["GetHelp"])]
    out += [(40 + i, k, 5, i) for i, k in enumerate(FIVE + [None])]
    out += [(50 + i, k, None, i) for i, k in enumerate(FIVE)]
    return out


@pytest.mark.parametrize("hot_rows", [None, 50_000, 5])
def test_complete_lifecycles(make_events, hot_rows):
    kept = c.complete_lifecycles(make_events(rows()), hot_rows=hot_rows)
    assert kept.columns == make_events(rows()).columns
    assert plain(kept, "id") == sorted(((i,) for i in [*range(5), *range(10, 16)]), key=repr)


def test_entity_counts(make_events):
    assert plain(c.entity_counts(make_events(rows()))) == [(6, 2)]
    assert plain(c.approx_entities(make_events(rows()))) == [(5,)]


def test_distinct_in_order_of_appearance(make_events):
    events = make_events([(1, "Welcome", 9, 5), (2, "Welcome", 3, 6), (3, "LaunchEnd", 9, 7)])
    got = c.distinct_entities(events).orderBy("first_at", "first_id").collect()
    assert [r["fulfillment_id"] for r in got] == [9, 3]


def test_range_boundaries(make_events):
    events = make_events([(1, "Welcome", 1, 0), (2, "Welcome", 1, 10), (3, "GetHelp", 1, 5), (4, "Welcome", 1, 11)])
    assert plain(c.scan_events(events, at(0), at(10)), "id") == [(1,)]
    assert plain(c.scan_events(events, at(0), at(10), boundary="closed"), "id") == [(1,), (2,)]
    assert plain(c.range_count(events, at(0), at(10))) == [(2,)]
    with pytest.raises(ValueError, match="boundary"):
        c.in_range(events, at(0), at(10), "open")


def test_ordered_scan_breaks_ties_by_id(make_events):
    events = make_events([(3, "Welcome", 1, 5), (1, "Welcome", 1, 5), (2, "Welcome", 1, 4)])
    assert [r["id"] for r in c.scan_events(events, at(0), at(9), ordered=True).collect()] == [2, 1, 3]


def test_until_keeps_the_cutoff_itself(make_events):
    events = make_events([(1, "Welcome", 1, 0), (2, "Welcome", 1, 10), (3, "Welcome", 1, 10.5)])
    assert plain(c.until(events, at(10)), "id") == [(1,), (2,)]


def test_filters_reach_the_scan(spark, make_events, tmp_path):
    path = str(tmp_path / "events")
    make_events([(1, "Welcome", 1, 0)]).write.parquet(path)
    found = c.scan_events(spark.read.parquet(path), at(0), at(10)).select("id")
    capture = io.StringIO()
    with contextlib.redirect_stdout(capture):
        found.explain("formatted")
    plan = capture.getvalue()
    assert "GreaterThanOrEqual(created_at" in plan and "LessThan(created_at" in plan and "In(type" in plan
    assert "created_by_id" not in plan.split("ReadSchema:")[1]


def edges(make_events):
    return make_events([
        (1, "Welcome", 1, 0), (2, "Welcome", 1, 1), (3, "Welcome", 1, 1.5), (4, "Welcome", 1, 3)])


def test_half_open_batches(make_events):
    got = b.interval_batches(edges(make_events), at(0), at(3))
    assert plain(got, "id", "slot", "slot_start") == [(1, 0, at(0)), (2, 1, at(1)), (3, 1, at(1))]
    assert plain(b.batch_sizes(got), "slot", "n") == [(0, 1), (1, 2)]


def test_closed_batches_read_edges_twice(make_events):
    got = b.interval_batches(edges(make_events), at(0), at(3), boundary="closed")
    assert plain(got, "id", "slot") == [(1, 0), (2, 0), (2, 1), (3, 1), (4, 2)]


def test_dropped_tail(make_events):
    got = b.interval_batches(edges(make_events), at(0), at(3), boundary="closed", drop_tail=True)
    assert plain(got, "id", "slot") == [(1, 0), (2, 0), (2, 1), (3, 1)]


def test_batches_need_no_shuffle(make_events):
    plan = b.interval_batches(edges(make_events), at(0), at(3))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_sketches_merge_in_any_order(spark, make_events):
    events = make_events([(i, "Welcome", None if i % 50 == 0 else i % 700, i) for i in range(3000)])
    days = c.entity_sketches(events.withColumn("part", F.col("id") % 7), ["part"])
    exact = events.filter("fulfillment_id IS NOT NULL").select("fulfillment_id").distinct().count()
    for sketches in (days, days.orderBy(F.desc("part")).repartition(3), c.entity_sketches(events, [])):
        assert abs(c.merged_entities(sketches).first().found - exact) <= 0.0625 * exact
    few = make_events([(1, "Welcome", 5, 0), (2, "Welcome", 5, 0), (3, "Welcome", 6, 0)])
    assert c.merged_entities(c.entity_sketches(few, ["type"])).first().found == 2
    assert c.merged_entities(c.entity_sketches(few.limit(0), ["type"])).first().found == 0
