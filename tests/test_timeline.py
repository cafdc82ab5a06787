import random
from itertools import product

import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__
from spanweave.operators import linear, parallel, serial
from spanweave.plans import catalogue


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_coalesce_joins_equal_neighbours_only(spark):
    df = spark.createDataFrame([(1, 0, 4, True), (1, 4, 8, True), (1, 8, 9, False), (1, 10, 12, False), (2, 0, 1, None), (2, 1, 2, None)], "k long, lo long, hi long, value boolean")
    assert [tuple(r) for r in serial.coalesce(df, ["k"], ["value"]).select("k", "lo", "hi", "value").orderBy("k", "lo").collect()] == [(1, 0, 8, True), (1, 8, 9, False), (1, 10, 12, False), (2, 0, 2, None)]


def test_sweep_is_three_valued(spark):
    values = [True, False, None]
    a, b = [], []
    for i, (x, y) in enumerate(product(values, values)):
        a += [(1, 10 * i, 10 * i + 10, x)] * (x is not None)
        b += [(1, 10 * i, 10 * i + 10, y)] * (y is not None)
    schema = "k long, lo long, hi long, value boolean"
    out = serial.sweep({"a": spark.createDataFrame(a, schema), "b": spark.createDataFrame(b, schema)}, ["k"])
    found = {r["lo"] // 10: (r["a"], r["b"]) for r in out.collect()}
    assert all(found.get(i, (None, None)) == xy for i, xy in enumerate(product(values, values)))


def test_range_join_against_all_pairs(spark):
    data = [(k, 7 * i % 50 - 20, 7 * i % 50 - 20 + i % 9) for k in (1, 2) for i in range(40)]
    df = spark.createDataFrame(data, "k long, lo long, hi long")
    wanted = sorted((k, a, b, c, d) for k, a, b in data for j, c, d in data if j == k and a < d and c < b and a < b and c < d)
    assert rows(parallel.range_join(df, df, ["k"], 6), "k", "l_lo", "l_hi", "r_lo", "r_hi") == wanted


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k long, lo long, hi long, value boolean")
    assert serial.coalesce(none, ["k"], ["value"]).count() == 0
    assert serial.complement(none, ["k"], (0, 10)).count() == 0


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() >= 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_overlaps_of_all_lines(spark):
    """Lines other than the first, lines of one order and repeated line numbers overlap too."""
    data = [(1, 5, 1, 0, 10), (1, 5, 2, 0, 8), (1, 5, 2, 0, 8), (1, 6, 3, 9, 20), (1, 4, 7, 30, 40), (2, 6, 1, 0, 40)]
    out = catalogue.overlapping_pairs(spark.createDataFrame(data, "l_suppkey long, l_orderkey long, l_linenumber long, lo long, hi long"))
    wanted = sorted((a[0], a[1], b[1], a[2], b[2], max(a[3], b[3]), min(a[4], b[4])) for i, a in enumerate(data) for j, b in enumerate(data) if a[0] == b[0] and (a[1:3], i) < (b[1:3], j) and a[3] < b[4] and b[3] < a[4])
    assert rows(out, *out.columns) == wanted and len(wanted) == 4


def test_one_sided_operators_see_odd_events(spark, tmp_path):
    from datetime import datetime, timedelta

    at = [datetime(2024, 1, 1) + timedelta(hours=k) for k in range(4)]
    values = [10.0, 50.0, 12.0, 60.0]
    spark.createDataFrame([(k, 1, at[k], values[k]) for k in range(4)], "event_id long, user_id long, ts timestamp, value double").write.parquet(f"{tmp_path}/events.parquet")
    wanted = {"windows_not": [True, False, True, False], "assign_gaps_constant": [False, True, False, True], "profile_at_most": [True, False, True, False], "numbers_times": [20.0, 100.0, 24.0, 120.0]}
    for name, own in wanted.items():
        found = catalogue.QUERIES[f"{name}"](spark, str(tmp_path)).orderBy("lo").collect()
        assert [r["value"] for r in found] == own and all(a["hi"] == b["lo"] for a, b in zip(found, found[1:]))


def test_spans_that_meet_windows_in_any_order(quick):
    """Whole rows, once and none lost, though each reading of the spans gives them in another order; equal rows stay apart."""
    rows = [(k % 3, 10 * k, 10 * k + (40 if k % 2 else 4), k // 2) for k in range(300)] * 2
    spans = quick.createDataFrame(rows, "k long, lo long, hi long, n long").mapInArrow(lambda batches: (b.take(pa.array(random.sample(range(b.num_rows), b.num_rows))) for b in batches), "k long, lo long, hi long, n long")
    windows = quick.createDataFrame([(k, lo, lo + 16) for k in range(2) for lo in range(0, 3000, 64)], "k long, lo long, hi long")
    want = sorted(r for r in rows if r[0] < 2 and any(r[1] < lo + 16 and lo < r[2] for lo in range(0, 3000, 64)))
    assert sorted(tuple(r) for r in parallel.filter_by_windows(spans, windows, ["k"], truncate=False).select("k", "lo", "hi", "n").collect()) == want


def test_lines_that_meet_do_not_jump(quick):
    """From v0 to v1 in three seconds, then level: the rate's rounding is no change at the joint, a real jump is one."""
    v0, v1 = 0.1, 0.3
    pieces = quick.createDataFrame([(1, 0, 6_000_000, v0, (v1 - v0) / 3.0), (1, 6_000_000, 9_000_000, v1, 0.0), (1, 9_000_000, 12_000_000, v1 + 1e-9, 0.0)], "k long, lo long, hi long, v0 double, rate double")
    lines = pieces.select("k", "lo", "hi", linear.line(F.shiftright("lo", 1), F.col("v0"), F.col("rate")).alias("value"))
    assert v0 + (v1 - v0) / 3.0 * 3e6 / 1e6 != v1
    assert sorted(tuple(r) for r in linear.changes(lines, ["k"]).select("lo", "hi", "value").collect()) == [(1, 6_000_000, True), (6_000_000, 9_000_000, False), (9_000_000, 9_000_001, True), (9_000_001, 12_000_000, False)]
    rising, falling = (sorted(r["lo"] for r in f(lines, ["k"]).filter("value").collect()) for f in (linear.increases, linear.decreases))
    assert rising == [1, 9_000_000] and falling == []
