"""Durations, polynomials, effects, streams, event graphs and datasets on a few rows, with expected values written by hand."""

import json
import random

import pytest

from pyspark.sql import functions as F

from spanweave.functions import durations, intervals as iv, json_values
from spanweave.operators import accumulate, event_graphs as eg, linear, parallel, resources as rs, serial
from spanweave.sources import datasets
from spanweave.streaming import segments

S = 1_000_000


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def steps(spark, *pieces, kind="double"):
    return spark.createDataFrame([(1, 2 * a * S, 2 * b * S, v) for a, b, v in pieces], f"k long, lo long, hi long, value {kind}")


def shown(df, *columns):
    return sorted(tuple(r) for r in df.select((F.col("lo") / (2 * S)).alias("lo"), (F.col("hi") / (2 * S)).alias("hi"), *(columns or ("value",))).collect())


def test_durations(quick):
    lit = F.lit
    assert one(quick, *[durations.from_clock(lit(t)) for t in ("01:02:03.5", "-100:00:00", "1:2", "+00:00:00.000001")]) == (3723500000, -360000 * S, None, 1)
    assert one(quick, *[durations.from_iso(lit(t)) for t in ("PT1H2M3.5S", "-PT1S", "P1DT1S", "PT", "P")]) == (3723500000, -S, 86401 * S, None, None)
    assert one(quick, *[durations.from_words(lit(t)) for t in ("1d 2h 3ms", "- 5 minutes 1us", "", "5 apples")]) == (93600003000, -300000001, None, None)
    assert one(quick, durations.to_clock(lit(-3723500000)), durations.to_iso(lit(3723500000)), durations.to_iso(lit(0)), durations.to_words(lit(-93600003001))) == ("-01:02:03.500000", "PT1H2M3.5S", "PT0S", "-1d 2h 3ms 1us")
    assert one(quick, durations.rounded_nearest(lit(2.25), S), durations.rounded_nearest(lit(2.5e-6), S), durations.rounded_up(lit(1.0000001), S), durations.rounded_down(lit(1.9999999), S)) == (2250000, 2, S + 1, 1999999)
    top = lit(iv.MAX_US).cast("long")
    assert one(quick, durations.saturating_add(top, top), durations.saturating_add(-top, -top), durations.divided_by(lit(-7).cast("long"), 2), durations.remainder(lit(-7), 2)) == (iv.MAX_US, -iv.MAX_US, -3, -1)
    assert one(quick, durations.to_doy(durations.from_doy(lit("2024-366T01:02:03.25"))), durations.from_doy(lit("2023-366T00:00:00")), durations.format_as_date(lit("2024-060T00:00:00")), durations.add_time(lit("2023-365T23:59:59"), lit(S))) == ("2024-366T01:02:03.250", None, "2024-02-29", "2024-001T00:00:00.000")
    assert one(quick, durations.is_ymd(lit("2024-02-29T01:02:03")), durations.is_ymd(lit("2024-13-01T00:00:00")), durations.latest_of(lit("2024-001T00:00:00"), lit("2023-300T00:00:00"))) == (True, False, "2024-001T00:00:00")
    assert one(quick, iv.shifted(top * 2, 5), iv.shifted(F.lit(10), -3))[0] == iv.FOREVER[1] and json_values.canonical({"b": 1.0, "a": [1.5, "x"]}) == '{"a":[1.5,"x"],"b":1}'


def test_serial_profiles_against_every_tick(quick):
    """Two random profiles with gaps, tick by tick."""
    rng = random.Random(4)
    make, at = [], []
    for _ in range(2):
        t, rows, held = 0, [], [None] * 60
        while t < 58:
            t2 = min(60, t + rng.randint(1, 9))
            if rng.random() < 0.7:
                v = rng.random() < 0.5
                rows.append((1, t, t2, v))
                held[t:t2] = [v] * (t2 - t)
            t = t2
        make.append(quick.createDataFrame(rows, "k long, lo long, hi long, value boolean"))
        at.append(held)
    a, b = at
    ticks = lambda df: {t: r["value"] for r in df.collect() for t in range(r["lo"], r["hi"])}
    both = {"a": make[0], "b": make[1]}
    wanted = {
        "a AND b": lambda x, y: False if x is False or y is False else None if x is None or y is None else True,
        "a OR b": lambda x, y: True if x or y else None if x is None or y is None else False,
        "coalesce(a, b)": lambda x, y: y if x is None else x,
    }
    for text, f in wanted.items():
        assert ticks(serial.combine(both, ["k"], F.expr(text))) == {t: v for t in range(60) if (v := f(a[t], b[t])) is not None}
    gaps = {t for r in serial.complement(make[0], ["k"], (0, 60)).collect() for t in range(r["lo"], r["hi"])}
    assert gaps == {t for t in range(60) if a[t] is None}
    layers = quick.createDataFrame([(1, s, s + n, i, i) for i, (s, n) in enumerate((rng.randrange(50), rng.randint(1, 10)) for _ in range(25))], "k long, lo long, hi long, value int, seq int")
    top = {}
    for r in sorted(layers.collect(), key=lambda r: r["seq"]):
        top.update((t, r["value"]) for t in range(r["lo"], r["hi"]))
    assert ticks(serial.overlay(layers, ["k"], "seq")) == top
    left, right = (quick.createDataFrame([(1, i, s, s + n) for i, (s, n) in enumerate((rng.randrange(-40, 40), rng.choice([1, 2, 7, 60])) for _ in range(30))], "k long, id long, lo long, hi long") for _ in range(2))
    pairs = sorted((r["l_id"], r["r_id"]) for r in parallel.overlap_join(left, right, ["k"]).collect())
    assert pairs == sorted((x["id"], y["id"]) for x in left.collect() for y in right.collect() if x["lo"] < y["hi"] and y["lo"] < x["hi"])
    counted = {t: r["value"] for r in parallel.count_active(left, ["k"], (-50, 110)).collect() for t in range(r["lo"], r["hi"])}
    assert counted == {t: sum(x["lo"] <= t < x["hi"] for x in left.collect()) for t in range(-50, 110)}
    summed = {t: r["value"] for r in accumulate.reduced(left, ["k"], lambda c: F.max(c("id"))).collect() for t in range(r["lo"], r["hi"])}
    assert summed == {t: max(own) for t in range(-50, 110) if (own := [x["id"] for x in left.collect() if x["lo"] <= t < x["hi"]])}


def test_coalescing_of_overlaps(quick):
    df = quick.createDataFrame([(1, 0, 10, "a"), (1, 4, 6, "b"), (1, 20, 24, "c"), (1, 24, 30, "c")], "k long, lo long, hi long, value string")
    assert sorted(tuple(r)[1:] for r in parallel.flatten_into_profile(df, ["k"]).select("k", "lo", "hi", "value").collect()) == [(0, 4, "a"), (4, 6, "b"), (20, 30, "c")]
    with pytest.raises(Exception, match="both profiles"):
        serial.zip_disjoint(df.filter("lo = 0"), df.filter("lo = 4"), ["k"]).collect()
    with pytest.raises(Exception, match="instant"):
        serial.split(quick.createDataFrame([(1, 0, 1)], "k long, lo long, hi long"), 2, strict=True).collect()


def test_polynomials(quick):
    arr = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    assert one(quick, rs.add(arr(1, 2), arr(3)), rs.multiply(arr(1, 1), arr(1, 0, 2)), rs.derivative(arr(5, 3, 2)), rs.integral(arr(6, 4)), rs.subtract(arr(1), arr(0, 1))) == ([4.0, 2.0], [1.0, 1.0, 2.0, 2.0], [3.0, 4.0], [0.0, 6.0, 2.0], [1.0, -1.0])
    p = rs.polynomial(F.lit(0), arr(1, 2, 3))
    assert one(quick, rs.evaluate(p, F.lit(2 * S)), rs.evaluate(rs.stepped(p, F.lit(S)), F.lit(2 * S)), rs.stepped(p, F.lit(S))["c"]) == (17.0, 17.0, [6.0, 8.0, 3.0])
    assert one(quick, rs.roots_between(arr(6, -5, 1), F.lit(10.0)), rs.roots_between(arr(-6, 11, -6, 1), F.lit(2.5)))[0] == [2.0, 3.0]
    piece = lambda *c: quick.createDataFrame([(1, 0, 20 * S)], "k long, lo long, hi long").withColumn("value", rs.polynomial(F.lit(0), arr(*c)))
    assert shown(rs.compared(piece(6, -5, 1), piece(0), ["k"], "<")) == [(0.0, 2.0, False), (2.0, 3.0, True), (3.0, 10.0, False)]
    top = rs.greatest(piece(0, 1), piece(4), ["k"])
    assert shown(top.withColumn("v", rs.evaluate(F.col("value"), F.shiftright("hi", 1))), "v") == [(0.0, 4.0, 4.0), (4.0, 10.0, 10.0)]
    assert shown(rs.approximate_as_linear(piece(0, 0, 1), ["k"], 5 * S), F.col("value.rate")) == [(0.0, 5.0, 5.0), (5.0, 10.0, 15.0)]
    assert rs.sampled_at(piece(0, 0, 1), ["k"], 4 * S).select("value").collect() == [(0.0,), (16.0,), (64.0,)]
    assert shown(rs.integrated(piece(0, 2), ["k"]), rs.evaluate(F.col("value"), F.lit(3 * S)).alias("v")) == [(0.0, 10.0, 9.0)]


def test_linear_arithmetic(quick):
    line = lambda a, b, t0, v0, r: quick.createDataFrame([(1, 2 * a * S, 2 * b * S)], "k long, lo long, hi long").withColumn("value", linear.line(F.lit(t0 * S), F.lit(float(v0)), F.lit(float(r))))
    at = lambda df, t: df.select(linear.value_at(F.col("value"), F.lit(t * S)).alias("v")).first()["v"]
    two, ramp = line(0, 10, 0, 2, 0), line(0, 10, 0, -4, 1)
    assert at(linear.times(ramp, two, ["k"]), 6) == 4 and at(linear.div(ramp, two, ["k"]), 6) == 1 and at(linear.minus(ramp, two, ["k"]), 6) == 0 and at(linear.power(two, two, ["k"]), 1) == 4
    assert shown(linear.absolute(ramp, ["k"]), F.col("value.rate")) == [(0.0, 4.0, -1.0), (4.0, 10.0, 1.0)]
    with pytest.raises(Exception, match="constant"):
        linear.times(ramp, ramp, ["k"]).collect()
    with pytest.raises(Exception, match="constant"):
        linear.to_numbers(ramp, ["k"]).collect()
    numbers = steps(quick, (0, 2, 3.0), (2, 6, 1.0))
    assert at(accumulate.integrate(numbers, ["k"]).filter("lo > 0"), 4) == 8
    with pytest.raises(Exception, match="gaps"):
        accumulate.integrate(steps(quick, (0, 2, 3.0), (3, 6, 1.0)), ["k"]).collect()
    mean = linear.moving_average(numbers, ["k"], 2 * S)
    assert linear.sampled(mean, ["k"], F.lit(S)).first()["value"] == 2 and linear.sampled(mean, ["k"], F.lit(3 * S)).first()["value"] == 1
    assert shown(linear.transitions(linear.from_numbers(numbers), ["k"], 3.0, 1.0).filter("value")) == [(2.0, 2.0 + 0.5 / S, True)]
    assert shown(linear.step(numbers, ["k"], 4 * S, 7.0, (0, 20 * S)), F.col("value.v0")) == [(0.0, 4.0, 0.0), (4.0, 10.0, 7.0)]


def test_effects(quick):
    make = lambda rows, kind: quick.createDataFrame([(1, t * S, i, op, v) for i, (t, op, v) in enumerate(rows)], f"k long, t long, seq long, op string, value {kind}")
    assert shown(rs.register(make([(1, "set", "a"), (1, "set", "b"), (4, "set", "a")], "string"), ["k"], 9 * S), "value", "conflicted") == [(1.0, 4.0, "b", True), (4.0, 9.0, "a", False)]
    assert shown(rs.counter(make([(1, "+", 2), (3, "+", -1), (3, "+", 1), (5, "+", 4)], "long"), ["k"], 9 * S, 10)) == [(1.0, 5.0, 12), (5.0, 9.0, 16)]
    assert shown(rs.toggled(make([(1, "toggle", None), (2, "on", None), (3, "toggle", None), (4, "toggle", None), (6, "off", None)], "string"), ["k"], 9 * S)) == [(1.0, 3.0, True), (3.0, 4.0, False), (4.0, 6.0, True), (6.0, 9.0, False)]
    assert shown(rs.queue(make([(1, "add", "x"), (2, "add", "y"), (3, "remove", "x")], "string"), ["k"], 9 * S)) == [(1.0, 2.0, ["x"]), (2.0, 3.0, ["x", "y"]), (3.0, 9.0, ["y"])]
    uses = quick.createDataFrame([(1, 2 * S, 8 * S, 3.0), (1, 6 * S, 12 * S, 1.0)], "k long, lo long, hi long, amount double")
    assert shown(rs.reserved(uses, ["k"], 5.0, (0, 20 * S))) == [(0.0, 1.0, 5.0), (1.0, 3.0, 2.0), (3.0, 4.0, 1.0), (4.0, 6.0, 4.0), (6.0, 10.0, 5.0)]
    level = quick.createDataFrame([(1, 0, 5.0, 1.0), (1, 4 * S, 0.0, -3.0)], "k long, t long, add double, add_rate double")
    assert shown(rs.accumulator(level, ["k"], 10 * S), F.col("value.v0"), F.col("value.rate")) == [(0.0, 4.0, 5.0, 1.0), (4.0, 10.0, 9.0, -2.0)]
    ticking = make([(0, "start", None), (3, "pause", None), (5, "restart", None), (6, "countdown", 10.0)], "double")
    assert shown(rs.variable_clock(ticking, ["k"], 9 * S), F.col("value.v0"), F.col("value.rate")) == [(0.0, 3.0, 0.0, 1.0), (3.0, 5.0, 3.0, 0.0), (5.0, 6.0, 0.0, 1.0), (6.0, 9.0, 10.0, -1.0)]
    clamped = rs.clamped_integral(steps(quick, (0, 4, 2.0), (4, 6, -1.0), (6, 9, -5.0)), ["k"], 0.0, 5.0, 1.0)
    assert shown(clamped, F.col("value.v0"), F.col("value.rate"), "overflow", "underflow") == [(0.0, 2.0, 1.0, 2.0, 0.0, 0.0), (2.0, 4.0, 5.0, 0.0, 2.0, 0.0), (4.0, 6.0, 5.0, -1.0, 0.0, 0.0), (6.0, 6.6, 3.0, -5.0, 0.0, 0.0), (6.6, 9.0, 0.0, 0.0, 0.0, 5.0)]
    cond = steps(quick, (0, 2, False), (2, 4, True), (4, 5, True), (6, 7, True), kind="boolean")
    assert sorted(r["t_us"] for r in rs.whenever(cond, ["k"]).collect()) == [2 * S, 6 * S]
    assert shown(rs.choose(cond, steps(quick, (0, 9, 1.0)), steps(quick, (0, 9, 2.0)), ["k"])) == [(0.0, 2.0, 2.0), (2.0, 5.0, 1.0), (6.0, 7.0, 1.0)]
    points = quick.createDataFrame([(1, 0, 0.0), (1, 10 * S, 5.0)], "k long, t long, v double")
    assert linear.sampled(rs.precomputed(points, ["k"], "t", "v"), ["k"], F.lit(4 * S)).first()["value"] == 2 and linear.sampled(rs.precomputed(points, ["k"], "t", "v"), ["k"], F.lit(99 * S)).first()["value"] == 5


def test_event_graphs(quick):
    graph = eg.Seq(eg.Atom("a"), eg.Seq(eg.Par(eg.Seq(eg.Atom("b"), eg.Atom("c")), eg.Atom("d")), eg.Atom("e")))
    rows = eg.flattened(graph)
    assert [(eg.tag_text(t), v) for t, v in rows] == [(".1", "a"), (".2.1.1", "b"), (".2.1.2", "c"), (".2.2.1", "d"), (".3", "e")]
    assert eg.flattened(eg.unflattened(rows)) == rows and eg.flattened(None) == []
    effects = quick.createDataFrame([(1, 0, list(t), v) for t, v in rows] + [(1, 5, [1], "x"), (1, 5, [2], "y")], "k long, t long, tag array<int>, value string")
    assert sorted(map(tuple, eg.conflicting(effects, ["k"]).select("t", "conflicted").collect())) == [(0, True), (5, False)]
    spans = quick.createDataFrame([(1, None, "A", 0, 9), (2, 1, None, 1, 8), (3, 2, "B", 2, None)], "span_id long, parent_id long, type string, start_us long, end_us long")
    from spanweave.scratch import Scratch

    assert sorted((r["span_id"], r["parent_id"], r["finished"]) for r in eg.activity_spans(spans, Scratch(quick)).collect()) == [(1, None, True), (3, 1, False)]


def test_datasets(quick, tmp_path):
    profiles = quick.createDataFrame([(7, 1, "p", "real", 10)], "dataset_id long, id long, name string, type string, duration_us long")
    rows = quick.createDataFrame([(7, 1, 0, '{"initial": 1.5, "rate": 2}', False), (7, 1, 4, None, True), (7, 1, 6, "3.0", False)], "dataset_id long, profile_id long, start_us long, dynamics string, is_gap boolean")
    own = datasets.segments(rows, profiles)
    assert sorted((r["lo"], r["hi"], tuple(r["value"])) for r in datasets.real(own).collect()) == [(0, 8, (0, 1.5, 2.0)), (12, 21, (6, 3.0, 0.0))]
    assert [r["value"] for r in datasets.discrete(own).orderBy("lo").collect()][1] == "3" and datasets.segments(rows, profiles, False, 5).agg(F.max("hi")).first()[0] == 30
    path = str(tmp_path / "segments")
    datasets.written(rows, path)
    datasets.written(rows.withColumn("dataset_id", F.lit(8)), path)
    assert quick.read.parquet(path).count() == 6
    datasets.replaced(rows.limit(1), path)
    datasets.dropped(quick, path, 8)
    assert quick.read.parquet(path).count() == 1
    more = quick.createDataFrame([(7, 1, 0, 5, "a"), (7, 1, 1, 6, "b")], "dataset_id long, profile_id long, seq long, duration_us long, dynamics string")
    assert sorted((r["seq"], r["start_us"]) for r in datasets.extended(profiles.select("dataset_id", F.col("id").alias("profile_id"), "duration_us"), more).collect()) == [(0, 10), (1, 15)]
    (tmp_path / "plan.json").write_text(json.dumps({"id": 3, "name": "n", "activities": [{"id": 1, "type": "A", "start_offset": "00:00:01", "arguments": "{}"}, {"id": 2, "type": "B", "start_offset": "PT2S", "anchor_id": 1}]}))
    assert sorted((r["id"], r["start_us"]) for r in datasets.plan_file(quick, str(tmp_path / "plan.json")).collect()) == [(1, S), (2, 2 * S)]
    runs = quick.createDataFrame([(1, 1, "{}", 7, 5, None), (1, 1, "{}", 7, 6, None), (1, 1, "{}", 7, 8, "bad")], "constraint_id long, revision long, arguments string, dataset_id long, request_id long, errors string")
    assert [r["request_id"] for r in datasets.cached_constraint_runs(runs, 7).collect()] == [6]
    empty = quick.createDataFrame([], "dataset_id long, x string")
    document = json.loads(datasets.results_json({"version": 2}, profiles, empty, empty, empty).first()["document"])
    assert document["version"] == 2 and document["profiles"][0]["name"] == "p"


def test_streams_close_segments(quick, tmp_path):
    schema = "name string, t long, value double, is_end boolean"
    folder = tmp_path / "in"
    folder.mkdir()
    out = str(tmp_path / "out")
    updates = [[("a", 0, 1.0, False), ("b", 2, 5.0, False), ("a", 3, 2.0, False)], [("a", 3, 4.0, False), ("a", 7, 2.0, False)], [("a", 9, 0.0, True), ("b", 9, 0.0, True)]]
    for batch in updates:
        quick.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(folder))
        query = segments.appended(segments.closed_segments(quick.readStream.schema(schema).parquet(str(folder))), out, str(tmp_path / "state"))
        query.processAllAvailable()
        query.stop()
    wanted = [("a", 0, 6, 1.0), ("a", 6, 14, 4.0), ("a", 14, 19, 2.0), ("b", 4, 19, 5.0)]
    assert sorted((r["name"], r["lo"], r["hi"], r["value"]) for r in quick.read.parquet(out).collect()) == wanted
    flat = quick.createDataFrame([("a", 0, 1.0), ("a", 3, 4.0), ("a", 7, 2.0), ("b", 2, 5.0)], "name string, t long, value double")
    assert sorted(map(tuple, segments.closed_in_batch(flat, 9).select("name", "lo", "hi", "value").collect())) == wanted
    with pytest.raises(Exception, match="later"):
        segments.in_order(quick.createDataFrame([("a", 0, 5), ("a", 1, 4)], "name string, seq long, t long")).collect()
