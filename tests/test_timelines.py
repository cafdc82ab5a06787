"""The chaining surface on small timelines, with expected values written by hand; ticks as they are."""

import pytest

from pyspark.sql import functions as F

from spanweave import timelines as tl


@pytest.fixture(scope="module")
def make(quick):
    def build(kind, rows, value="value boolean"):
        return kind(quick.createDataFrame([(1, *r) for r in rows], "k long, lo long, hi long" + (f", {value}" if value else "")), ["k"])

    return build


def shown(t, *columns):
    df = t if hasattr(t, "collect") and not isinstance(t, tl.Timeline) else t.df
    columns = columns or (("lo", "hi", "value") if "value" in df.columns else ("lo", "hi"))
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_general_operations(make):
    t = make(tl.Universal, [(0, 4, "x"), (2, 10, "y"), (20, 21, "x")], "type string")
    assert shown(t.filter_by_type("x")) == [(0, 4), (20, 21)] and shown(t.highlight_all()) == [(0, 10), (20, 21)]
    assert shown(t.filter(F.col("hi") - F.col("lo") > 3, (1, 3))) == [(1, 3), (2, 3)] and shown(t.select(3, 20)) == [(3, 4), (3, 10)]
    assert shown(t.unset(3, 5)) == [(0, 3), (2, 3), (5, 10), (20, 21)] and shown(t.shift(-1)) == [(-2, 2), (0, 8), (18, 19)]
    assert shown(t.filter_longer_than(2)) == [(0, 4), (2, 10)] and shown(t.filter_shorter_than(2)) == [(0, 4), (20, 21)] and shown(t.filter_by_duration(1, 3)) == [(0, 4)]
    cover = make(tl.Windows, [(3, 5)], None)
    assert shown(t.filter_by_windows(cover)) == [(3, 4), (3, 5)] and shown(t.filter_by_windows(cover, truncate=False)) == [(0, 4), (2, 10)]
    halves = F.array(F.struct((F.col("lo") - 1).alias("lo"), (F.col("lo") + 1).alias("hi")), F.struct(F.col("hi").alias("lo"), (F.col("hi") + 5).alias("hi")))
    assert shown(t.unsafe_flat_map(halves)) == [(0, 1), (2, 3), (20, 21)] and shown(t.unsafe_map_intervals(F.col("lo") + 3, F.col("hi"))) == [(3, 4), (5, 10)]
    assert shown(t.unsafe_map2(t.filter_by_type("y"), {"pair": F.concat("l_type", "r_type")}), "lo", "hi", "pair") == [(2, 4, "xy"), (2, 10, "yy")]
    assert t.merge(t).df.count() == 6 and t.is_subset_of(t.merge(t)).first()[0] and not t.merge(t).is_subset_of(t).first()[0]
    assert t.inspect("seen").df.count() == 3 and [r["lo"] for r in t.sorted().collect()] == [0, 2, 20] and t.collect((0, 3)).count() == 2


def test_parallel_operations(make):
    t = make(tl.Spans, [(0, 4), (2, 10)], None)
    assert shown(t.count_active((0, 12))) == [(0, 2, 1), (2, 4, 2), (4, 10, 1), (10, 12, 0)] and shown(t.active((0, 12))) == [(0, 10, True), (10, 12, False)]
    assert shown(t.starts()) == [(0, 1), (2, 3)] and shown(t.ends()) == [(4, 5), (10, 11)] and shown(t.extend(1)) == [(0, 6), (2, 12)] and shown(t.shift_endpoints(1, -1)) == [(4, 8)]
    assert shown(t.split(2)) == [(0, 2), (2, 4), (2, 6), (6, 10)]
    valued = make(tl.Universal, [(0, 8, 1), (4, 6, 2)], "v int")
    assert shown(valued.flatten_into_profile(F.col("v"))) == [(0, 4, 1), (4, 6, 2)] and shown(valued.reduce_into_profile(lambda c: F.sum(c("v")))) == [(0, 4, 1), (4, 6, 3), (6, 8, 1)]
    w = make(tl.Booleans, [(0, 3, True), (3, 9, False)])
    assert shown(t.intersect_with(w)) == [(0, 3), (2, 3)]


def test_windows(make):
    a, b = make(tl.Windows, [(0, 4), (8, 12)], None), make(tl.Windows, [(2, 9)], None)
    assert shown(a.union(b)) == [(0, 12)] and shown(a.intersection(b)) == [(2, 4), (8, 9)] and shown(a.minus(b)) == [(0, 2), (9, 12)] and shown(a.complement((0, 10))) == [(4, 8)]
    assert shown(a.starts()) == [(0, 1), (8, 9)] and shown(a.extend(2)) == [(0, 16)] and shown(a.shift_endpoints(1)) == [(2, 6), (10, 14)]


def test_constants(make):
    p = make(tl.Booleans, [(0, 4, True), (4, 8, False), (10, 12, True)])
    q = make(tl.Booleans, [(2, 11, True)])
    assert shown(p.and_(q)) == [(2, 4, True), (4, 8, False), (10, 11, True)] and shown(p.nor(q)) == [(0, 12, False)]
    assert shown(p.nand(q)) == [(2, 4, False), (4, 8, True), (10, 11, False)] and shown(p.xor(q)) == [(2, 4, False), (4, 8, True), (10, 11, False)] and shown(p.add(q)) == [(0, 12, True)]
    assert shown(p.not_()) == [(0, 4, False), (4, 8, True), (10, 12, False)] and shown(p.falsify_shorter_than(2)) == [(0, 4, True), (4, 8, False), (10, 12, False)] and shown(p.falsify_longer_than(1)) == [(0, 8, False), (10, 12, True)]
    assert shown(p.isolate_false()) == [(4, 8, False)] and shown(p.highlight_true()) == [(0, 4), (10, 12)] and shown(p.highlight_false()) == [(4, 8)] and shown(p.split_true(1)) == [(0, 4, True), (10, 12, True)]
    assert shown(p.rising_edges()) == [(1, 8, False), (11, 12, False)] and shown(p.falling_edges())[:3] == [(0, 4, False), (4, 5, True), (5, 8, False)]
    assert shown(q.includes(p)) == [(0, 2), (11, 12)] and shown(p.assign_gaps(q)) == [(0, 4, True), (4, 8, False), (8, 12, True)] and shown(p.set(q)) == [(0, 12, True)]
    assert [r["value"] for r in p.sample(1).collect()] == [True] and p.sample(4).count() == 0
    s = make(tl.Strings, [(0, 2, "Ab"), (2, 4, ""), (4, 6, "ab")], "value string")
    assert shown(s.length()) == [(0, 2, 2), (2, 4, 0), (4, 6, 2)] and shown(s.case_insensitive_equal_to("AB")) == [(0, 2, True), (2, 4, False), (4, 6, True)] and shown(s.is_empty()) == [(0, 2, False), (2, 4, True), (4, 6, False)]
    assert shown(s.highlight_equal_to("ab")) == [(4, 6)] and shown(s.transitions("", "ab").highlight_true()) == [(4, 5)] and shown(s.changes().highlight_true()) == [(2, 3), (4, 5)]


def test_numbers(make):
    n, m = make(tl.Numbers, [(0, 4, 2.0), (4, 8, 5.0)], "value double"), make(tl.Numbers, [(2, 6, 3.0)], "value double")
    assert shown(n.plus(m)) == [(2, 4, 5.0), (4, 6, 8.0)] and shown(n.minus(1)) == [(0, 4, 1.0), (4, 8, 4.0)] and shown(n.times(m)) == [(2, 4, 6.0), (4, 6, 15.0)] and shown(n.div(2)) == [(0, 4, 1.0), (4, 8, 2.5)] and shown(n.pow(2)) == [(0, 4, 4.0), (4, 8, 25.0)]
    assert shown(n.sampled(1)) == [(0, 4, 2.0), (4, 8, 5.0)]
    assert shown(n.negate().abs()) == shown(n) and shown(n.less_than(m)) == [(2, 4, True), (4, 6, False)] and shown(n.greater_than_or_equal_to(5)) == [(0, 4, False), (4, 8, True)]
    assert shown(n.increases().highlight_true()) == [(4, 5)] and shown(n.decreases().highlight_true()) == []
    assert shown(make(tl.Numbers, [(0, 2, 300), (2, 4, -129)], "value long").cast("byte")) == [(0, 2, 44), (2, 4, 127)]
    assert shown(n.binned({0: "low", 5: "high"})) == [(0, 4, "low"), (4, 8, "high")] and shown(n.to_real().to_numbers()) == shown(n)


def test_real(make):
    r = make(tl.Numbers, [(0, 4_000_000, 2.0)], "value double").to_real()
    assert shown(r.plus(1).times(2).minus(r).to_numbers()) == [(0, 4_000_000, 4.0)] and shown(r.less_than(3)) == [(0, 4_000_000, True)] and shown(r.highlight_equal_to(2)) == [(0, 4_000_000)]
    grown = r.to_numbers().integrate()
    assert grown.sample(1_500_000).first()["value"] == 3 and shown(grown.greater_than(2).highlight_true()) == [(2_000_001, 4_000_000)] and shown(grown.rate().to_numbers()) == [(0, 4_000_000, 2.0)]
