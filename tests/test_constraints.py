"""Constraint expressions on small results, with expected values written by hand. Times in µs, ticks twice that, odd after an instant."""

import pytest

from pyspark.sql import functions as F

from spanweave.constraints import evaluate as ev
from spanweave.constraints.dsl import Constraint, Discrete, Interval, Real, Spans, Windows

S = 1_000_000


def co(a, b):
    """[a, b) in seconds."""
    return 2 * a * S, 2 * b * S


def cc(a, b):
    return 2 * a * S, 2 * b * S + 1


@pytest.fixture(scope="module")
def results(quick):
    spark = quick
    rows = spark.createDataFrame([(1,), (2,)], "k long")
    acts = [(1, 10, "A", *cc(2, 5), '{"n": 3, "s": "x"}'), (1, 11, "A", *cc(8, 12), '{"n": 4.0, "s": "y"}'), (1, 20, "B", *cc(4, 9), "{}"), (2, 30, "A", *cc(0, 1), '{"n": 1}')]
    discrete = [(1, "mode", *co(0, 3), '"on"'), (1, "mode", *co(3, 6), '"off"'), (1, "mode", *co(8, 20), '"on"'), (2, "mode", *co(0, 20), '"off"'), (1, "count", *co(0, 10), "1"), (1, "count", *co(10, 20), "2")]
    real = [(1, "power", *co(0, 10), 0, 0.0, 1.0), (1, "power", *cc(10, 20), 10 * S, 10.0, -1.0), (2, "power", *cc(0, 20), 0, 5.0, 0.0)]
    real = spark.createDataFrame(real, "k long, name string, lo long, hi long, t0 long, v0 double, rate double").select("k", "name", "lo", "hi", F.struct("t0", "v0", "rate").alias("value"))
    return ev.Results(["k"], rows, cc(0, 20), spark.createDataFrame(acts, "k long, id long, type string, lo long, hi long, arguments string"), spark.createDataFrame(discrete, "k long, name string, lo long, hi long, value string"), real)


def profile(x, results, k=1):
    return sorted(tuple(r) for r in ev.evaluate(x.node, results).filter(F.col("k") == k).select("lo", "hi", "value").collect())


def true(x, results, k=1):
    return [(lo, hi) for lo, hi, v in profile(x, results, k) if v]


def gaps_and_windows(x, results):
    out = ev.check(x.node, results)
    return sorted((r["k"], sorted(map(tuple, r["windows"])), sorted(r["ids"])) for r in out.violations.collect()), sorted((r["k"], r["lo"], r["hi"]) for r in out.gaps.collect())


def test_logic_with_gaps(results):
    on = Discrete.Resource("mode").equal("on")
    assert profile(on, results) == [(*co(0, 3), True), (*co(3, 6), False), (*co(8, 20), True)]
    assert profile(on.not_(), results) == [(*co(0, 3), False), (*co(3, 6), True), (*co(8, 20), False)]
    late = Discrete.Resource("count").equal(2)
    assert profile(on.and_(late), results) == [(0, 20 * S, False), (20 * S, 40 * S, True)]
    assert profile(on.or_(late), results) == [(*co(0, 3), True), (*co(3, 6), False), (16 * S, 40 * S, True)]
    assert true(late.if_(on), results) == [co(3, 6), co(10, 20)]
    assert profile(on.assign_gaps(False), results) == [(-2 * ev.iv.MAX_US, 0, False), (*co(0, 3), True), (*co(3, 8), False), (*co(8, 20), True), (40 * S, ev.iv.FOREVER[1], False)]


def test_durations_and_places(results):
    on = Discrete.Resource("mode").equal("on")
    assert profile(on.longer_than(4 * S), results) == [(*co(0, 6), False), (*co(8, 20), True)]
    assert profile(on.shorter_than(4 * S), results) == [(*co(0, 3), True), (*co(3, 6), False), (*co(8, 20), False)]
    assert true(on.keep_true_segment(-1), results) == [co(8, 20)] and true(on.keep_true_segment(0), results) == [co(0, 3)]


def test_starts_ends_and_changes(results):
    on = Discrete.Resource("mode").equal("on")
    off = on.not_()
    # the first instants after gaps are unknown
    assert profile(off.starts(), results) == [(*co(0, 3), False), (6 * S, 6 * S + 1, True), (6 * S + 1, 12 * S, False), (*co(8, 20), False)]
    assert profile(on.starts(), results) == [(1, 12 * S, False), (16 * S + 1, 40 * S, False)]
    assert profile(on.ends(), results)[:3] == [(0, 6 * S, False), (6 * S, 6 * S + 1, True), (6 * S + 1, 12 * S, False)]
    assert profile(Discrete.Resource("mode").changes(), results) == [(1, 6 * S, False), (6 * S, 6 * S + 1, True), (6 * S + 1, 12 * S, False), (16 * S + 1, 40 * S, False)]
    assert true(Discrete.Resource("mode").transition("on", "off"), results) == [(6 * S, 6 * S + 1)]
    assert profile(Discrete.Resource("mode").transition("off", "on"), results) == [(1, 12 * S, False), (16 * S + 1, 40 * S, False)]


def test_edges_shift_and_later_segments_win(results):
    on = Discrete.Resource("mode").equal("on").assign_gaps(False)
    assert true(on.shift_by(1 * S, -1 * S), results) == [co(1, 2), co(9, 19)]
    assert true(on.shift_by(-1 * S, 1 * S), results) == [co(0, 4), co(7, 20), (40 * S, 40 * S + 1)] or true(on.shift_by(-1 * S, 1 * S), results) == [co(0, 4), cc(7, 20)]


def test_linear_profiles(results):
    power = Real.Resource("power")
    assert true(power.greater_than(5), results) == [(10 * S + 1, 30 * S)]
    assert true(power.greater_than_or_equal(5), results) == [cc(5, 15)]
    assert true(power.equal(5), results) == [(10 * S, 10 * S + 1), (30 * S, 30 * S + 1)] and true(power.equal(5), results, 2) == [cc(0, 20)]
    assert true(power.less_than(power.times(2).minus(4)), results) == [(8 * S + 1, 32 * S)]
    assert true(power.rate().equal(1), results) == [co(0, 10)]
    assert true(power.is_within(9, 1), results) == [cc(8, 12)]
    assert true(power.changes(), results) == [(1, 40 * S + 1)] and true(power.changes(), results, 2) == []
    assert true(Real.Resource("count").greater_than(1), results) == [co(10, 20)]
    at = Spans.FromInterval(Interval.At(3 * S))
    assert true(power.less_than(power.value_at(at)), results) == [(0, 6 * S), (34 * S + 1, 40 * S + 1)]
    assert true(Discrete.Map({"m": Discrete.Resource("mode"), "c": Discrete.Resource("count")}).equal({"c": 2, "m": "on"}), results) == [co(10, 20)]


def test_spans(results):
    a, b = (Spans.ForEachActivity(t, lambda x: x.span()) for t in "AB")
    assert true(a.windows(), results) == [cc(2, 5), cc(8, 12)] and true(Windows.During("A", "B"), results) == [cc(2, 12)]
    spans = lambda x, k=1: sorted((r["lo"], r["hi"]) for r in ev.evaluate(x.node, results).filter(F.col("k") == k).collect())
    assert spans(a.select_when_true(b.windows())) == [cc(4, 5), cc(8, 9)]
    assert spans(a.starts()) == [(4 * S, 4 * S + 1), (16 * S, 16 * S + 1)] and spans(a.ends()) == [(10 * S, 10 * S + 1), (24 * S, 24 * S + 1)]
    assert spans(a.connect_to(a)) == [cc(5, 8), cc(12, 20)] and spans(a.connect_to(b), 2) == [cc(1, 20)]
    assert spans(a.split(3))[:3] == [co(2, 3), co(3, 4), cc(4, 5)]
    assert true(a.contains(b, count={"min": 1}).not_(), results) == [cc(2, 5), cc(8, 12)]
    # durations count what overlaps
    assert true(a.contains(b, duration={"min": 1 * S + 1}).not_(), results) == [cc(2, 5), cc(8, 12)] and true(a.contains(b, duration={"min": 1 * S}).not_(), results) == []
    assert true(a.accumulated_duration(S).greater_than(4), results) == [(18 * S + 1, ev.iv.FOREVER[1])] or true(a.accumulated_duration(S).greater_than(4), results) == [(18 * S + 1, 40 * S + 1)]


def test_loops_and_violations(results):
    loud = Constraint.ForEachActivity("A", lambda a: a.window().if_(Windows.Value(True)).and_(Real.Resource("power").less_than(a.real_parameter("n"))))
    found, _ = gaps_and_windows(Constraint.ForbiddenActivityOverlap("A", "B"), results)
    assert found == [(1, [cc(4, 5)], [10, 20]), (1, [cc(8, 9)], [11, 20])]
    found, gaps = gaps_and_windows(Discrete.Resource("mode").equal("on"), results)
    assert found == [(1, [co(3, 6)], []), (2, [co(0, 20)], [])] and gaps == [(1, 12 * S, 16 * S), (1, 40 * S, 40 * S + 1), (2, 40 * S, 40 * S + 1)]
    found, _ = gaps_and_windows(loud, results)
    assert {ids[0] for _, _, ids in found} == {10, 11, 30}
    found, _ = gaps_and_windows(Constraint.ForEachActivity("A", lambda a: Windows.Value(False, a.interval()).assign_gaps(True)), results)
    assert found == [(1, [cc(2, 5)], [10]), (1, [cc(8, 12)], [11]), (2, [cc(0, 1)], [30])]


def test_rolling_threshold(results):
    a = Spans.ForEachActivity("A", lambda x: x.span())
    found, _ = gaps_and_windows(Constraint.RollingThreshold(a, 10 * S, 6 * S, "ExcessSpans"), results)
    assert found == [(1, [cc(2, 5), cc(8, 12)], [10, 11])]
    found, _ = gaps_and_windows(Constraint.RollingThreshold(a, 10 * S, 6 * S, "ExcessHull"), results)
    assert found == [(1, [cc(2, 12)], [10, 11])]
    found, _ = gaps_and_windows(Constraint.RollingThreshold(a, 5 * S, 1 * S // 2, "DeficitHull"), results)
    assert [(k, w) for k, w, _ in found][0] == (1, [(24 * S + 1, 40 * S + 1)])


def test_resources_and_errors(results):
    x = Real.Resource("power").plus(Real.Resource("count")).less_than(3)
    assert ev.resources_of(x.node) == {"power", "count"} and "RealProfilePlus" in ev.pretty(x.node)
    with pytest.raises(ValueError):
        ev.evaluate({"kind": "Nonsense"}, results)
    with pytest.raises(Exception, match="gap"):
        ev.evaluate(Discrete.Resource("mode").equal("on").spans().node, results).collect()
