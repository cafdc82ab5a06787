"""Further registered queries: profiles with unknown edges, running totals, linear comparison, sequences of windows, relations, constraint expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.constraints import evaluate
from spanweave.constraints.dsl import Constraint, Discrete
from spanweave.functions import durations, json_values
from spanweave.functions import intervals as iv
from spanweave.operators import accumulate, linear, parallel, resources, sequences, serial
from spanweave.plans.catalogue import AT, BOUNDS, DAY, HIGH_SQL, HOUR, KEY, LINEAR_SQL, QUERIES, SPANS_SQL, SUPPLIER, TYPES_SQL, coalesce_sql, high, profile_sql, query, types
from spanweave.plans.catalogue import linear as lines
from spanweave.relations import anchors, goals, plans, sequence_filters
from spanweave.scratch import Scratch
from spanweave.sources.tables import event_profile, line_spans, read

S = 1_000_000

# --- interval algebra between neighbours


RELATIONS = {
    "compare_starts": ("CASE WHEN lo < lo2 THEN -1 WHEN lo > lo2 THEN 1 ELSE 0 END", lambda lo, hi, lo2, hi2: iv.compare_starts(lo, lo2)),
    "compare_ends": ("CASE WHEN hi < hi2 THEN -1 WHEN hi > hi2 THEN 1 ELSE 0 END", lambda lo, hi, lo2, hi2: iv.compare_ends(hi, hi2)),
    "end_to_start": ("CASE WHEN hi < lo2 THEN -1 WHEN hi > lo2 THEN 1 ELSE 0 END", lambda lo, hi, lo2, hi2: iv.compare_end_to_start(hi, lo2)),
    "same_start": ("lo = lo2", lambda lo, hi, lo2, hi2: iv.same_start(lo, lo2)),
    "same_end": ("hi = hi2", lambda lo, hi, lo2, hi2: iv.same_end(hi, hi2)),
    "overlaps": ("lo < hi2 AND lo2 < hi", lambda lo, hi, lo2, hi2: iv.overlaps(lo, hi, lo2, hi2)),
    "strictly_contains": ("lo <= lo2 AND hi2 <= hi AND (lo, hi) <> (lo2, hi2)", lambda lo, hi, lo2, hi2: iv.strictly_contains(lo, hi, lo2, hi2)),
    "equals": ("lo = lo2 AND hi = hi2", lambda lo, hi, lo2, hi2: iv.equals(lo, hi, lo2, hi2)),
    "starts_before": ("lo < lo2", lambda lo, hi, lo2, hi2: iv.starts_before(lo, lo2) & iv.start_before_start(lo, lo2)),
    "ends_after": ("hi > hi2", lambda lo, hi, lo2, hi2: iv.ends_after(hi, hi2) & ~iv.end_before_end(hi, hi2)),
    "starts_after": ("lo >= hi2", lambda lo, hi, lo2, hi2: iv.starts_after(lo, hi2)),
    "ends_before": ("hi <= lo2", lambda lo, hi, lo2, hi2: iv.ends_before(hi, lo2) & iv.end_before_start(hi, lo2)),
    "starts_strictly_after": ("lo > hi2", lambda lo, hi, lo2, hi2: iv.starts_strictly_after(lo, hi2) & iv.strictly_after(lo, hi2)),
    "ends_strictly_before": ("hi < lo2", lambda lo, hi, lo2, hi2: iv.ends_strictly_before(hi, lo2)),
    "start_before_end": ("lo // 2 < hi2 // 2", lambda lo, hi, lo2, hi2: iv.start_before_end(lo, hi2)),
    "adjacent": ("hi = lo2 OR lo = hi2", lambda lo, hi, lo2, hi2: iv.adjacent(lo, hi, lo2, hi2)),
    "is_met_by": ("lo = hi2", lambda lo, hi, lo2, hi2: iv.is_met_by(lo, hi2)),
    "intersect_lo": ("greatest(lo, lo2)", lambda *x: iv.intersect(*x)[0]),
    "intersect_hi": ("least(hi, hi2)", lambda *x: iv.intersect(*x)[1]),
    "hull_lo": ("least(lo, lo2)", lambda *x: iv.hull(*x)[0]),
    "hull_hi": ("greatest(hi, hi2)", lambda *x: iv.hull(*x)[1]),
    "n_union": ("CASE WHEN lo <= hi2 AND lo2 <= hi THEN 1 ELSE 2 END", lambda *x: F.size(iv.union(*x))),
    "n_minus": ("CASE WHEN lo < least(hi, lo2) THEN 1 ELSE 0 END + CASE WHEN greatest(lo, hi2) < hi THEN 1 ELSE 0 END", lambda *x: F.size(iv.minus(*x))),
    "n_steps": (f"greatest(0, ((hi - 1) // 2 - (lo + 1) // 2) // {HOUR} + 1)", lambda lo, hi, lo2, hi2: F.size(iv.steps(lo, hi, HOUR)).cast("long")),
}


@query("interval_relations", f"""WITH {SPANS_SQL}, n AS (SELECT *, lead(lo) OVER w AS lo2, lead(hi) OVER w AS hi2 FROM (SELECT DISTINCT l_suppkey, lo, hi FROM spans) WINDOW w AS (PARTITION BY l_suppkey ORDER BY lo, hi))
SELECT l_suppkey, lo, hi, {", ".join(f"{sql} AS {name}" for name, (sql, _) in RELATIONS.items())} FROM n WHERE lo2 IS NOT NULL""")
def interval_relations(spark, d):
    w = serial.by_key(SUPPLIER, "lo", "hi")
    n = line_spans(spark, d).select("l_suppkey", "lo", "hi").distinct().withColumns({"lo2": F.lead("lo").over(w), "hi2": F.lead("hi").over(w)}).filter("lo2 IS NOT NULL")
    edges = [F.col(c) for c in ("lo", "hi", "lo2", "hi2")]
    return n.select("l_suppkey", "lo", "hi", *[f(*edges).alias(name) for name, (_, f) in RELATIONS.items()])


# --- profiles with unknown edges


def edge_sql(source: str, head: str) -> str:
    """Segments of source with their first instant's value apart; head sees joined, before and value."""
    return f"""j AS (SELECT *, coalesce(lag(hi) OVER w = lo, false) AS joined, lag(value) OVER w AS before FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY lo)),
pieces AS (SELECT user_id, lo, lo + 1 AS hi, {head} AS value FROM j UNION ALL SELECT user_id, lo + 1, hi, false FROM j WHERE lo + 1 < hi), fine AS (SELECT * FROM pieces WHERE value IS NOT NULL), {coalesce_sql('o', 'fine')}"""


@query("change_profile", f"WITH {TYPES_SQL}, {edge_sql('t', 'CASE WHEN joined THEN before <> value END')} SELECT * FROM o")
def change_profile(spark, d):
    return serial.change_profile(types(spark, d), KEY)


@query("transition_profile", f"""WITH {TYPES_SQL}, {edge_sql('t', "CASE WHEN joined THEN before = 'view' AND value = 'purchase' WHEN value <> 'purchase' THEN false END")} SELECT * FROM o""")
def transition_profile(spark, d):
    return serial.transition_profile(types(spark, d), KEY, "view", "purchase")


@query("detect_edges", f"WITH {HIGH_SQL}, {edge_sql('h', 'CASE WHEN joined THEN NOT value END').replace('lo + 1, hi, false', 'lo + 1, hi - CASE WHEN hi % 2 = 1 THEN 1 ELSE 0 END, false').replace('WHERE lo + 1 < hi)', 'WHERE lo + 1 < hi - CASE WHEN hi % 2 = 1 THEN 1 ELSE 0 END)')} SELECT * FROM o")
def detect_edges(spark, d):
    """Falling edges, unknown where a profile begins and ends."""
    return serial.detect_edges(high(spark, d), KEY, lambda before, after: F.when(before.isNotNull() & after.isNotNull(), before & ~after))


@query("starts", f"WITH {HIGH_SQL}, {edge_sql('h', 'CASE WHEN NOT value THEN false WHEN joined THEN true END')} SELECT * FROM o")
def starts(spark, d):
    return serial.start_points(high(spark, d), KEY)


@query("ends", f"""WITH {HIGH_SQL}, j AS (SELECT *, coalesce(lag(hi) OVER w = lo AND lag(value) OVER w, false) AS ended FROM h WINDOW w AS (PARTITION BY user_id ORDER BY lo)),
pieces AS (SELECT user_id, lo, lo + 1 AS hi, CASE WHEN value AND hi = lo + 1 AND hi % 2 = 1 THEN NULL ELSE ended END AS value FROM j UNION ALL SELECT user_id, lo + 1, hi - CASE WHEN value AND hi % 2 = 1 THEN 1 ELSE 0 END, false FROM j WHERE lo + 1 < hi - CASE WHEN value AND hi % 2 = 1 THEN 1 ELSE 0 END), fine AS (SELECT * FROM pieces WHERE value IS NOT NULL), {coalesce_sql('o', 'fine')} SELECT * FROM o""")
def ends(spark, d):
    return serial.end_points(high(spark, d), KEY)


@query("falling_edges", f"WITH {HIGH_SQL}, e AS (SELECT *, lag(hi) OVER w = lo AND lag(value) OVER w AS down FROM h WINDOW w AS (PARTITION BY user_id ORDER BY lo)) SELECT user_id, lo FROM e WHERE NOT value AND down")
def falling_edges(spark, d):
    return serial.changes(high(spark, d), KEY).filter("before AND NOT after").select("user_id", "lo")


def numbers(spark, d):
    return serial.coalesce(event_profile(spark, d, "value"), KEY)


@query("increases", f"WITH {profile_sql('p', 'value')}, {coalesce_sql('v', 'p')}, e AS (SELECT *, lag(hi) OVER w = lo AND lag(value) OVER w < value AS up FROM v WINDOW w AS (PARTITION BY user_id ORDER BY lo)) SELECT user_id, lo FROM e WHERE up")
def increases(spark, d):
    return serial.changes(numbers(spark, d), KEY).filter("before < after").select("user_id", "lo")


# --- durations, places, conversions


FALSIFY = "SELECT user_id, lo, hi, value AND hi // 2 - lo // 2 {test} AS value FROM h"


def falsified(name: str, test: str, least: int, most: int):
    @query(name, f"WITH {HIGH_SQL}, f AS ({FALSIFY.format(test=test)}), {coalesce_sql('o', 'f')} SELECT * FROM o")
    def run(spark, d):
        return serial.falsify_by_duration(high(spark, d), KEY, least, most)


falsified("falsify_shorter_than", f">= {6 * HOUR}", 6 * HOUR, iv.MAX_US)
falsified("falsify_longer_than", f"<= {6 * HOUR}", 0, 6 * HOUR)
falsified("falsify_by_duration", f"BETWEEN {2 * HOUR} AND {12 * HOUR}", 2 * HOUR, 12 * HOUR)


@query("filter_by_duration", f"WITH {HIGH_SQL} SELECT user_id, lo, hi FROM h WHERE value AND hi // 2 - lo // 2 BETWEEN {2 * HOUR} AND {12 * HOUR}")
def filter_by_duration(spark, d):
    return serial.filter_by_duration(high(spark, d).filter("value"), 2 * HOUR, 12 * HOUR).select("user_id", "lo", "hi")


NTH_SQL = "n AS (SELECT *, row_number() OVER (PARTITION BY user_id, value ORDER BY lo) AS i, row_number() OVER (PARTITION BY user_id, value ORDER BY lo DESC) AS j FROM h)"


@query("keep_true_segment", f"WITH {HIGH_SQL}, {NTH_SQL}, f AS (SELECT user_id, lo, hi, value AND j = 2 AS value FROM n), {coalesce_sql('o', 'f')} SELECT * FROM o")
def keep_true_segment(spark, d):
    return serial.keep_true_segment(high(spark, d), KEY, -2)


@query("remove_true_segment", f"WITH {HIGH_SQL}, {NTH_SQL}, f AS (SELECT user_id, lo, hi, value AND i <> 1 AS value FROM n), {coalesce_sql('o', 'f')} SELECT * FROM o")
def remove_true_segment(spark, d):
    return serial.remove_true_segment(high(spark, d), KEY, 0)


@query("true_points", f"WITH {HIGH_SQL} SELECT user_id, min(lo) AS first, max(hi) AS last FROM h WHERE value GROUP BY user_id")
def true_points(spark, d):
    return serial.true_points(high(spark, d), KEY)


@query("select_bounds", f"WITH {HIGH_SQL} SELECT user_id, greatest(lo, {BOUNDS[0]}) AS lo, least(hi, {BOUNDS[1]}) AS hi, value FROM h WHERE lo < {BOUNDS[1]} AND hi > {BOUNDS[0]}")
def select_bounds(spark, d):
    return serial.clip(high(spark, d), BOUNDS)


@query("unset_interval", f"WITH {HIGH_SQL} SELECT user_id, lo, least(hi, {2 * AT}) AS hi, value FROM h WHERE lo < {2 * AT} UNION ALL SELECT user_id, greatest(lo, {2 * AT + 2 * DAY}), hi, value FROM h WHERE hi > {2 * AT + 2 * DAY}")
def unset_interval(spark, d):
    return serial.unset(high(spark, d), 2 * AT, 2 * AT + 2 * DAY)


@query("shift_profile", f"WITH {HIGH_SQL} SELECT user_id, lo + {2 * HOUR} AS lo, hi + {2 * HOUR} AS hi, value FROM h")
def shift_profile(spark, d):
    return serial.shift(high(spark, d), HOUR)


UNION_SQL = "m AS (SELECT *, max(hi) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM spans), r AS (SELECT *, sum(CASE WHEN before >= lo THEN 0 ELSE 1 END) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM m), u AS (SELECT l_suppkey, min(lo) AS lo, max(hi) AS hi FROM r GROUP BY l_suppkey, run)"
SPAN_BOUNDS = (2 * 757_382_400 * S, 2 * 946_684_800 * S)  # 1994 to 2000
WIDE_SQL = f"c AS (SELECT l_suppkey, greatest(lo, {SPAN_BOUNDS[0]}) AS lo, least(hi, {SPAN_BOUNDS[1]}) AS hi FROM u WHERE lo < {SPAN_BOUNDS[1]} AND hi > {SPAN_BOUNDS[0]}), walls AS (SELECT * FROM c UNION ALL SELECT DISTINCT l_suppkey, {SPAN_BOUNDS[0]}, {SPAN_BOUNDS[0]} FROM u UNION ALL SELECT DISTINCT l_suppkey, {SPAN_BOUNDS[1]}, {SPAN_BOUNDS[1]} FROM u), g AS (SELECT l_suppkey, max(hi) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo, lo AS hi FROM walls)"


@query("windows_from_spans", f"WITH {SPANS_SQL}, {UNION_SQL}, {WIDE_SQL} SELECT l_suppkey, lo, hi, true AS value FROM c UNION ALL SELECT l_suppkey, lo, hi, false FROM g WHERE lo < hi")
def windows_from_spans(spark, d):
    return serial.windows_from_spans(line_spans(spark, d), SUPPLIER, SPAN_BOUNDS)


# --- joins of spans

QUARTERS_SQL = f"quarters AS (SELECT s.l_suppkey, {SPAN_BOUNDS[0]} + k * {180 * DAY} AS lo, {SPAN_BOUNDS[0]} + k * {180 * DAY} + {60 * DAY} AS hi, k FROM (SELECT DISTINCT l_suppkey FROM lineitem) AS s, range(24) AS r(k))"


def quarters(spark, d):
    """A window of thirty days for each supplier and quarter."""
    return read(spark, d, "lineitem").select("l_suppkey").distinct().withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(23).cast("long")))).withColumns({"lo": F.col("k") * 180 * DAY + SPAN_BOUNDS[0], "hi": F.col("k") * 180 * DAY + SPAN_BOUNDS[0] + 60 * DAY})


@query("select_spans_when_true", f"WITH {SPANS_SQL}, {QUARTERS_SQL} SELECT s.l_suppkey, l_orderkey, l_linenumber, greatest(s.lo, q.lo) AS lo, least(s.hi, q.hi) AS hi FROM spans s JOIN quarters q ON s.l_suppkey = q.l_suppkey AND s.lo < q.hi AND q.lo < s.hi")
def select_spans_when_true(spark, d):
    return parallel.select_when_true(line_spans(spark, d), quarters(spark, d).withColumn("value", F.lit(True)), SUPPLIER)


@query("filter_by_windows", f"WITH {SPANS_SQL}, {QUARTERS_SQL} SELECT * FROM spans s WHERE EXISTS (SELECT 1 FROM quarters q WHERE s.l_suppkey = q.l_suppkey AND s.lo < q.hi AND q.lo < s.hi)")
def filter_by_windows(spark, d):
    return parallel.filter_by_windows(line_spans(spark, d), quarters(spark, d), SUPPLIER, truncate=False)


@query("totals_in_windows", f"WITH {SPANS_SQL}, {QUARTERS_SQL} SELECT q.l_suppkey, q.lo, q.hi, count(s.lo) AS n, CAST(coalesce(sum(s.hi // 2 - s.lo // 2), 0) AS BIGINT) AS total_us FROM quarters q LEFT JOIN spans s ON s.l_suppkey = q.l_suppkey AND q.lo <= s.lo AND s.hi <= q.hi GROUP BY 1, 2, 3")
def totals_in_windows(spark, d):
    return accumulate.totals_in(quarters(spark, d), line_spans(spark, d), SUPPLIER)


@query("spans_contains", f"""WITH {SPANS_SQL}, {QUARTERS_SQL}, bad AS (SELECT q.l_suppkey, q.lo, q.hi FROM quarters q LEFT JOIN spans s ON s.l_suppkey = q.l_suppkey AND s.lo < q.hi AND q.lo < s.hi GROUP BY 1, 2, 3 HAVING count(s.lo) FILTER (q.lo <= s.lo AND s.hi <= q.hi) < 1 OR coalesce(sum(least(s.hi, q.hi) // 2 - greatest(s.lo, q.lo) // 2), 0) > {200 * DAY}),
c AS (SELECT l_suppkey, greatest(lo, {SPAN_BOUNDS[0]}) AS lo, least(hi, {SPAN_BOUNDS[1]}) AS hi FROM bad WHERE lo < {SPAN_BOUNDS[1]}), walls AS (SELECT * FROM c UNION ALL SELECT DISTINCT l_suppkey, {SPAN_BOUNDS[0]}, {SPAN_BOUNDS[0]} FROM lineitem UNION ALL SELECT DISTINCT l_suppkey, {SPAN_BOUNDS[1]}, {SPAN_BOUNDS[1]} FROM lineitem), g AS (SELECT l_suppkey, max(hi) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo, lo AS hi FROM walls)
SELECT l_suppkey, lo, hi, false AS value FROM c UNION ALL SELECT l_suppkey, lo, hi, true FROM g WHERE lo < hi""")
def spans_contains(spark, d):
    return parallel.contains_checked(quarters(spark, d), line_spans(spark, d), SUPPLIER, SPAN_BOUNDS, (1, None), (None, 200 * DAY))


@query("connect_to_bounds", f"""WITH c AS (SELECT user_id, event_id, epoch_us(ts) * 2 + 1 AS hi FROM events WHERE event_type = 'click'), p AS (SELECT user_id, epoch_us(ts) * 2 AS lo FROM events WHERE event_type = 'purchase'),
x AS (SELECT c.user_id, c.event_id, c.hi - 1 AS lo, coalesce(min(p.lo) + 1, {BOUNDS[1]}) AS hi FROM c LEFT JOIN p ON p.user_id = c.user_id AND p.lo >= c.hi GROUP BY 1, 2, 3, c.hi) SELECT * FROM x WHERE lo < hi""")
def connect_to_bounds(spark, d):
    e = read(spark, d, "events").withColumn("t", iv.micros("ts"))
    clicks = e.filter("event_type = 'click'").select("user_id", "event_id", (F.col("t") * 2 + 1).alias("hi"))
    to = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("id"), (F.col("t") * 2).alias("lo"))
    return parallel.connect_to(clicks, to, KEY, "id", BOUNDS).select("user_id", "event_id", "lo", "hi")


# --- totals along time

ACTIVE_SQL = "e AS (SELECT l_suppkey, lo AS t, 1 AS d FROM spans UNION ALL SELECT l_suppkey, hi, -1 FROM spans), p AS (SELECT l_suppkey, t, sum(d) AS d FROM e GROUP BY 1, 2 HAVING sum(d) <> 0), a AS (SELECT l_suppkey, t AS lo, lead(t) OVER w AS hi, CAST(sum(d) OVER w AS BIGINT) AS value FROM p WINDOW w AS (PARTITION BY l_suppkey ORDER BY t))"


@query("accumulated_spans", f"WITH {SPANS_SQL}, {ACTIVE_SQL.replace("FROM spans", "FROM spans WHERE hi > lo + 1")}, s AS (SELECT *, coalesce(sum(value * (hi // 2 - lo // 2)) OVER (PARTITION BY l_suppkey ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS total FROM a WHERE hi IS NOT NULL) SELECT l_suppkey, lo, hi, round(total / {HOUR}, 3) AS v0, CAST(value AS DOUBLE) AS hours_an_hour FROM s WHERE value > 0")
def accumulated_spans(spark, d):
    total = accumulate.accumulated_spans(line_spans(spark, d), SUPPLIER, HOUR)
    rate = F.round(F.col("value.rate") * 3600, 6)
    return total.filter("value.rate > 0").select("l_suppkey", "lo", "hi", F.round(linear.value_at(F.col("value"), F.shiftright("lo", 1)), 3).alias("v0"), rate.alias("hours_an_hour"))


@query("accumulated_windows", f"WITH {HIGH_SQL} SELECT user_id, lo, hi, round(coalesce(sum(CASE WHEN value THEN hi // 2 - lo // 2 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {HOUR}, 3) AS v0 FROM h QUALIFY value AND hi > lo + 1")
def accumulated_windows(spark, d):
    total = accumulate.accumulated_windows(high(spark, d), KEY, HOUR).filter("value.rate > 0")
    return total.select("user_id", "lo", "hi", F.round(linear.value_at(F.col("value"), F.shiftright("lo", 1)), 3).alias("v0"))


@query("running_integral", f"WITH {profile_sql('p', 'value')}, {coalesce_sql('v', 'p')} SELECT user_id, lo, hi, round(coalesce(sum(value * (hi // 2 - lo // 2) / {HOUR}) OVER (PARTITION BY user_id ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 3) AS v0, round(value / 3600, 9) AS rate FROM v")
def running_integral(spark, d):
    total = accumulate.integrate(numbers(spark, d), KEY, HOUR)
    return total.select("user_id", "lo", "hi", F.round("value.v0", 3).alias("v0"), F.round("value.rate", 9).alias("rate"))


@query("count_active_in_bounds", f"WITH {SPANS_SQL}, {ACTIVE_SQL}, b AS (SELECT l_suppkey, greatest(lo, {SPAN_BOUNDS[0]}) AS lo, least(hi, {SPAN_BOUNDS[1]}) AS hi, value FROM a WHERE hi > {SPAN_BOUNDS[0]} AND lo < {SPAN_BOUNDS[1]} UNION ALL SELECT l_suppkey, {SPAN_BOUNDS[0]}, least(min(lo), {SPAN_BOUNDS[1]}), 0 FROM a GROUP BY 1 UNION ALL SELECT l_suppkey, greatest(max(lo), {SPAN_BOUNDS[0]}), {SPAN_BOUNDS[1]}, 0 FROM a GROUP BY 1), f AS (SELECT * FROM b WHERE lo < hi), {coalesce_sql('o', 'f', 'l_suppkey')} SELECT * FROM o")
def count_active_in_bounds(spark, d):
    return parallel.count_active(line_spans(spark, d), SUPPLIER, SPAN_BOUNDS)


@query("binned", f"WITH {profile_sql('p', 'value')}, b AS (SELECT user_id, lo, hi, CASE WHEN value >= 60 THEN 'high' WHEN value >= 20 THEN 'middle' WHEN value >= 0 THEN 'low' END AS value FROM p), f AS (SELECT * FROM b WHERE value IS NOT NULL), {coalesce_sql('o', 'f')} SELECT * FROM o")
def binned(spark, d):
    return accumulate.binned(event_profile(spark, d, "value"), KEY, {0: "low", 20: "middle", 60: "high"})


@query("rolling_threshold")
def rolling_threshold(spark, d):
    """Stretches of ranges of thirty days in which a supplier's lines take over five times their length."""
    spans = line_spans(spark, d)
    return accumulate.rolling_threshold(spans, SUPPLIER, 30 * DAY, 150 * DAY, "ExcessHull", SPAN_BOUNDS, "l_orderkey")


# --- linear profiles


def line_profile(spark, d) -> DataFrame:
    return lines(spark, d).select("user_id", "lo", "hi", linear.line(F.shiftright("lo", 1), F.col("v0"), F.col("rate")).alias("value"))


def level(df: DataFrame, value: float) -> DataFrame:
    return serial.constant(df, KEY, linear.line(F.lit(0), F.lit(value), F.lit(0.0)))


CROSS_SQL = f"{LINEAR_SQL}, x AS (SELECT *, CASE WHEN rate <> 0 THEN lo // 2 + CAST(round_even((30 - v0) / rate * 1e6, 0) AS BIGINT) END AS t FROM l)"


def comparison_sql(op: str) -> str:
    before, at, after = ("v0 + rate * (t - 1000000 - lo // 2) / 1e6", "v0 + rate * (t - lo // 2) / 1e6", "v0 + rate * (t + 1000000 - lo // 2) / 1e6")
    test = {"==": ("false", "true", "false"), "!=": ("true", "false", "true")}.get(op) or tuple(f"{x} {op} 30" for x in (before, at, after))
    everywhere = f"v0 {op.replace('==', '=').replace('!=', '<>')} 30"
    return f"""WITH {CROSS_SQL}, c AS (SELECT user_id, lo, hi, {everywhere} AS value FROM x WHERE t IS NULL UNION ALL SELECT user_id, lo, least(hi, 2 * t), {test[0]} FROM x WHERE 2 * t > lo UNION ALL SELECT user_id, greatest(lo, 2 * t), least(hi, 2 * t + 1), {test[1]} FROM x WHERE 2 * t >= lo AND 2 * t < hi UNION ALL SELECT user_id, greatest(lo, 2 * t + 1), hi, {test[2]} FROM x WHERE 2 * t + 1 < hi),
f AS (SELECT * FROM c WHERE lo < hi), {coalesce_sql('o', 'f')} SELECT * FROM o"""


def compared(name: str, op: str):
    @query(name, comparison_sql(op))
    def run(spark, d):
        df = line_profile(spark, d)
        return linear.compare(df, level(df, 30.0), KEY, op)


for _name, _op in {"linear_less_than": "<", "linear_at_most": "<=", "linear_greater_than": ">", "linear_at_least": ">=", "linear_equal": "==", "linear_not_equal": "!="}.items():
    compared(_name, _op)


@query("linear_plus", f"WITH {LINEAR_SQL} SELECT user_id, lo, hi, round(v0 + 2 * v0, 6) AS v0, round(3 * rate, 6) AS rate FROM l")
def linear_plus(spark, d):
    """A profile and twice itself."""
    df = line_profile(spark, d)
    out = linear.plus(df, linear.scaled(df, KEY, 2.0), KEY)
    return out.select("user_id", "lo", "hi", F.round(linear.value_at(F.col("value"), F.shiftright("lo", 1)), 6).alias("v0"), F.round("value.rate", 6).alias("rate"))


@query("linear_changes", f"WITH {LINEAR_SQL}, j AS (SELECT *, coalesce(lag(hi) OVER w = lo, false) AS joined FROM l WINDOW w AS (PARTITION BY user_id ORDER BY lo)), c AS (SELECT user_id, lo, lo + 1 AS hi, CASE WHEN joined THEN rate <> 0 END AS value FROM j UNION ALL SELECT user_id, lo + 1, hi, rate <> 0 FROM j), f AS (SELECT * FROM c WHERE value IS NOT NULL AND lo < hi), {coalesce_sql('o', 'f')} SELECT user_id, min(lo) AS lo, max(hi) AS hi FROM o WHERE value GROUP BY 1")
def linear_changes(spark, d):
    """From when to when a profile that joins its points changes."""
    return linear.changes(line_profile(spark, d), KEY).filter("value").groupBy("user_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


@query("linear_samples", f"WITH {LINEAR_SQL} SELECT user_id, lo // 2 AS t_us, round(v0, 6) AS value FROM l UNION ALL SELECT user_id, hi // 2, round(v0 + rate * (hi // 2 - lo // 2) / 1e6, 6) FROM l")
def linear_samples(spark, d):
    return linear.samples(line_profile(spark, d), KEY).withColumn("value", F.round("value", 6))


# --- sequences of windows

GAPS_SQL = "g AS (SELECT user_id, lo, hi, lo // 2 - lag(hi) OVER w // 2 AS before, lead(lo) OVER w // 2 - hi // 2 AS after FROM h WHERE value WINDOW w AS (PARTITION BY user_id ORDER BY lo))"


def true_windows(spark, d):
    return high(spark, d).filter("value").select("user_id", "lo", "hi")


for _name, _test, _filter in (
    ("max_gap_before", f"before <= {6 * HOUR}", sequences.max_gap_before),
    ("min_gap_after", f"after IS NULL OR after >= {6 * HOUR}", sequences.min_gap_after),
    ("max_gap_after", f"after <= {6 * HOUR}", sequences.max_gap_after),
):
    QUERIES[_name] = lambda spark, d, f=_filter: f(true_windows(spark, d), KEY, 6 * HOUR)
    query(_name, f"WITH {HIGH_SQL}, {GAPS_SQL} SELECT user_id, lo, hi FROM g WHERE {_test}")(QUERIES[_name])


@query("latching", f"WITH {HIGH_SQL}, w AS (SELECT user_id, lo, hi, hi // 2 - lo // 2 AS us FROM h WHERE value), f AS (SELECT user_id, min(lo) AS first_at FROM w WHERE us >= {12 * HOUR} GROUP BY 1) SELECT w.user_id, lo, hi FROM w JOIN f USING (user_id) WHERE lo = first_at OR lo > first_at AND us <= {2 * HOUR}")
def latching(spark, d):
    us = iv.duration_us(F.col("lo"), F.col("hi"))
    return sequences.latching(true_windows(spark, d), KEY, us >= 12 * HOUR, us <= 2 * HOUR)


DAYS_SQL = f"days AS (SELECT user_id, {BOUNDS[0]} + k * {2 * DAY} AS lo, {BOUNDS[0]} + (k + 1) * {2 * DAY} AS hi FROM (SELECT DISTINCT user_id FROM events), range(31) AS r(k))"


def days(spark, d):
    return read(spark, d, "events").select("user_id").distinct().withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(30).cast("long")))).select("user_id", (F.col("k") * 2 * DAY + BOUNDS[0]).alias("lo"), ((F.col("k") + 1) * 2 * DAY + BOUNDS[0]).alias("hi"))


IN_DAYS_SQL = "i AS (SELECT h.user_id, days.lo AS reset, greatest(h.lo, days.lo) AS lo, least(h.hi, days.hi) AS hi FROM h JOIN days ON h.user_id = days.user_id AND h.lo < days.hi AND days.lo < h.hi WHERE value)"


@query("first_within_each", f"WITH {HIGH_SQL}, {DAYS_SQL}, {IN_DAYS_SQL} SELECT user_id, reset, lo, hi FROM i QUALIFY row_number() OVER (PARTITION BY user_id, reset ORDER BY lo) = 1")
def first_within_each(spark, d):
    return sequences.element(sequences.within_each(true_windows(spark, d), days(spark, d), KEY), [*KEY, "reset"], 0)


@query("envelope", f"WITH {HIGH_SQL}, {DAYS_SQL}, {IN_DAYS_SQL} SELECT user_id, min(lo) AS lo, max(hi) AS hi FROM i GROUP BY user_id, reset")
def envelope(spark, d):
    return sequences.envelope(true_windows(spark, d), days(spark, d), KEY)


@query("always_satisfied", f"WITH {HIGH_SQL}, {DAYS_SQL}, {IN_DAYS_SQL} SELECT d.user_id, d.lo, d.hi FROM days d JOIN i ON i.user_id = d.user_id AND i.reset = d.lo GROUP BY 1, 2, 3 HAVING sum(i.hi - i.lo) >= d.hi - d.lo")
def always_satisfied(spark, d):
    return sequences.always_satisfied(days(spark, d), high(spark, d), KEY)


@query("ever_violated", f"WITH {HIGH_SQL}, {DAYS_SQL}, {IN_DAYS_SQL} SELECT user_id, lo, hi FROM days EXCEPT SELECT d.user_id, d.lo, d.hi FROM days d JOIN i ON i.user_id = d.user_id AND i.reset = d.lo GROUP BY 1, 2, 3 HAVING sum(i.hi - i.lo) >= d.hi - d.lo")
def ever_violated(spark, d):
    return sequences.ever_violated(days(spark, d), high(spark, d), KEY)


# --- relations of plans

SNAPSHOTS_SQL = """base AS (SELECT p_partkey AS id, p_size AS v FROM part WHERE p_partkey % 11 <> 0),
mine AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS v FROM part WHERE p_partkey % 7 <> 0),
theirs AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_size + 2 ELSE p_size END AS v FROM part WHERE p_partkey % 13 <> 0),
m AS (SELECT id, CASE WHEN b.id IS NULL AND x.id IS NOT NULL THEN 'add' WHEN b.id IS NOT NULL AND x.id IS NULL THEN 'delete' WHEN b.v IS DISTINCT FROM x.v THEN 'modify' ELSE 'none' END AS supplying,
CASE WHEN b.id IS NULL AND y.id IS NOT NULL THEN 'add' WHEN b.id IS NOT NULL AND y.id IS NULL THEN 'delete' WHEN b.v IS DISTINCT FROM y.v THEN 'modify' ELSE 'none' END AS receiving, x.v IS NOT DISTINCT FROM y.v AS alike, x.v AS sv, y.v AS rv FROM (SELECT id FROM base UNION SELECT id FROM mine UNION SELECT id FROM theirs) LEFT JOIN base b USING (id) LEFT JOIN mine x USING (id) LEFT JOIN theirs y USING (id)),
k AS (SELECT *, CASE WHEN supplying = 'none' OR supplying = receiving AND alike THEN 'none' WHEN receiving = 'none' THEN supplying ELSE 'conflict' END AS change_type FROM m)"""


def snapshots(spark, d):
    part = read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("v"))
    return part.filter("id % 11 <> 0"), part.filter("id % 7 <> 0").withColumn("v", F.expr("CASE WHEN id % 5 = 0 THEN v + 1 ELSE v END")), part.filter("id % 13 <> 0").withColumn("v", F.expr("CASE WHEN id % 3 = 0 THEN v + 2 ELSE v END"))


@query("begin_merge", f"WITH {SNAPSHOTS_SQL} SELECT id, change_type, supplying, receiving FROM k")
def begin_merge(spark, d):
    return plans.begin_merge(*snapshots(spark, d), ["v"])


@query("commit_merge", f"WITH {SNAPSHOTS_SQL}, t AS (SELECT *, change_type IN ('add', 'modify', 'delete') OR change_type = 'conflict' AS taken FROM k) SELECT id, CASE WHEN taken THEN sv ELSE rv END AS v FROM t WHERE CASE WHEN taken THEN sv ELSE rv END IS NOT NULL")
def commit_merge(spark, d):
    """Conflicts go to the supplying plan."""
    base, mine, theirs = snapshots(spark, d)
    merge = plans.with_resolution(plans.begin_merge(base, mine, theirs, ["v"]), all_as="source")
    return plans.commit_merge(theirs, mine, merge)


@query("anchor_dependents", "WITH RECURSIVE t AS (SELECT DISTINCT p_partkey AS root, p_partkey AS id FROM part WHERE p_partkey BETWEEN 1 AND 8 UNION ALL SELECT root, p_partkey FROM part JOIN t ON p_partkey // 2 = t.id AND p_partkey > 1) SELECT root, id FROM t WHERE root <> id")
def anchor_dependents(spark, d):
    """All that hangs on each of the eight activities at the top."""
    parts = read(spark, d, "part").selectExpr("p_partkey AS id", "nullif(p_partkey div 2, p_partkey) AS anchor_id", "true AS anchored_to_start").filter("id > 1 OR anchor_id IS NULL")
    return anchors.dependents(parts, spark.range(1, 9), Scratch(spark))


@query("snapshot_history", "WITH RECURSIVE e AS (SELECT p_partkey AS child, unnest([p_partkey // 2, p_partkey // 3]) AS parent FROM part WHERE p_partkey > 2), t AS (SELECT p_partkey AS start, p_partkey AS id FROM part UNION SELECT start, parent FROM t JOIN e ON e.child = t.id) SELECT start, id FROM t")
def snapshot_history(spark, d):
    """Every snapshot's ancestors in a graph in which each has two parents."""
    part = read(spark, d, "part").select(F.col("p_partkey").alias("child"))
    edges = part.filter("child > 2").select("child", F.explode(F.expr("array(child div 2, child div 3)")).alias("parent"))
    return plans.ancestors(edges, part.select(F.col("child").alias("id")), Scratch(spark))


TYPES_OF_PART = "old AS (SELECT p_type AS name, CAST(min(p_size) AS VARCHAR) AS parameters FROM part WHERE p_partkey % 10 < 8 GROUP BY 1), new AS (SELECT p_type AS name, CAST(min(p_size) AS VARCHAR) AS parameters FROM part WHERE p_partkey % 10 > 1 GROUP BY 1)"


@query("model_compatibility", f"WITH {TYPES_OF_PART} SELECT name, 'removed' AS what FROM old WHERE name NOT IN (SELECT name FROM new) UNION ALL SELECT old.name, 'modified' FROM old JOIN new USING (name) WHERE old.parameters <> new.parameters")
def model_compatibility(spark, d):
    part = read(spark, d, "part")
    model = lambda test: part.filter(test).groupBy(F.col("p_type").alias("name")).agg(F.min("p_size").cast("string").alias("parameters"))
    old, new = model("p_partkey % 10 < 8"), model("p_partkey % 10 > 1")
    return plans.removed_types(old, new).withColumn("what", F.lit("removed")).unionByName(plans.modified_types(old, new).select("name", F.lit("modified").alias("what")))


@query("pruned_changelog", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 11")
def pruned_changelog(spark, d):
    log = read(spark, d, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("revision"))
    return plans.pruned(log).select(F.col("id").alias("user_id"), F.col("revision").alias("event_id"))


@query("tag_ids", "SELECT user_id AS id, list_sort(list_distinct(list(event_id % 13))) AS tag_ids FROM events GROUP BY 1")
def tag_ids(spark, d):
    return plans.tag_ids(read(spark, d, "events").select(F.col("user_id").alias("id"), (F.col("event_id") % 13).alias("tag_id")))


@query("sequence_filter_compiled", "SELECT event_id FROM events WHERE (lower(event_type) = 'purchase' OR contains(lower(event_type), 'sign')) AND NOT (CAST(json_extract_string(props, '$.k') AS BIGINT) BETWEEN 20 AND 60) AND (event_type <> 'purchase' OR CAST(json_extract_string(props, '$.k') AS BIGINT) > 70)")
def sequence_filter_compiled(spark, d):
    rows = read(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("type"), F.col("props").alias("arguments"))
    spec = {
        "dynamic_types": [[{"field": "Type", "operator": "equals", "value": "PURCHASE"}], [{"field": "Type", "operator": "includes", "value": "Sign"}]],
        "others": [{"field": "Parameter", "name": "k", "operator": "is_not_within", "value": [20, 60]}],
        "subfilters": {"purchase": [{"field": "Parameter", "name": "k", "operator": "is_greater_than", "value": 70}]},
    }
    return sequence_filters.sequence_filter(rows, spec).select(F.col("id").alias("event_id"))


@query("where_order_limit", "SELECT event_id, user_id FROM events WHERE (user_id < 10 OR event_type IN ('signup')) AND NOT value < 50 ORDER BY user_id, event_id LIMIT 20 OFFSET 5")
def where_order_limit(spark, d):
    condition = {"_and": [{"_or": [{"user_id": {"_lt": 10}}, {"event_type": {"_in": ["signup"]}}]}, {"_not": {"value": {"_lt": 50}}}]}
    return sequence_filters.where(read(spark, d, "events"), condition, [{"user_id": "asc"}, {"event_id": "asc"}], 20, 5).select("event_id", "user_id")


@query("aggregate_fields", "SELECT count(*) AS count, round(sum(value), 3) AS value_sum, round(avg(value), 6) AS value_avg, min(event_id) AS event_id_min, max(event_id) AS event_id_max FROM events")
def aggregate_fields(spark, d):
    out = sequence_filters.aggregate(read(spark, d, "events"), {"sum": ["value"], "avg": ["value"], "min": ["event_id"], "max": ["event_id"]})
    return out.withColumns({"value_sum": F.round("value_sum", 3), "value_avg": F.round("value_avg", 6)})


# --- times as texts


@query("duration_texts", f"SELECT event_id, epoch_us(ts) % {40 * DAY} AS us FROM events")
def duration_texts(spark, d):
    """Durations written in three ways and read back."""
    us = F.unix_micros(F.col("ts").cast("timestamp")) % (40 * DAY)
    ways = [durations.from_clock(durations.to_clock(us)), durations.from_iso(durations.to_iso(us)), durations.from_words(durations.to_words(us))]
    return read(spark, d, "events").select("event_id", F.when((ways[0] == ways[1]) & (ways[1] == ways[2]), ways[0]).alias("us"))


@query("day_of_year", "SELECT event_id, strftime(ts, '%Y-%jT%H:%M:%S') AS doy, epoch_us(ts) // 1000 AS ms FROM events")
def day_of_year(spark, d):
    text = durations.to_doy(F.col("ts").cast("timestamp"))
    return read(spark, d, "events").select("event_id", F.substring(text, 1, 17).alias("doy"), F.floor(F.unix_micros(durations.from_doy(text)) / 1000).alias("ms"))


# --- resource models


@query("register", "SELECT user_id, t * 2 AS lo, lead(t) OVER (PARTITION BY user_id ORDER BY t) * 2 AS hi, value, conflicted FROM (SELECT user_id, epoch_us(ts) AS t, arg_max(event_type, event_id) AS value, count(DISTINCT event_type) > 1 AS conflicted FROM events GROUP BY 1, 2) QUALIFY hi IS NOT NULL")
def register(spark, d):
    effects = read(spark, d, "events").select("user_id", iv.micros("ts").alias("t"), F.col("event_id").alias("seq"), F.col("event_type").alias("value"))
    last = 2 * 10**15
    return resources.register(effects, KEY, last).filter(F.col("hi") != 2 * last)


@query("counter", f"WITH e AS (SELECT user_id, epoch_us(ts) AS t, sum(event_id % 5) AS n FROM events GROUP BY 1, 2), c AS (SELECT user_id, t * 2 AS lo, coalesce(lead(t) OVER w * 2, {4 * 10**15}) AS hi, CAST(sum(n) OVER w AS BIGINT) AS value FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)), {coalesce_sql('o', 'c')} SELECT * FROM o")
def counter(spark, d):
    effects = read(spark, d, "events").select("user_id", iv.micros("ts").alias("t"), (F.col("event_id") % 5).alias("value"))
    return resources.counter(effects, KEY, 2 * 10**15)


@query("clamped_integral")
def clamped_integral(spark, d):
    return resources.clamped_integral(event_profile(spark, d, "value - 50"), KEY, 0.0, 1e6, 0.0)


# --- constraint expressions over all users at once


def event_results(spark, d) -> evaluate.Results:
    """Events as a discrete resource (type) and a real one (value joined by lines), clicks and purchases as activities of an hour."""
    e = read(spark, d, "events")
    t = iv.micros("ts")
    acts = e.filter("event_type IN ('click', 'purchase')").select("user_id", F.col("event_id").alias("id"), F.col("event_type").alias("type"), (t * 2).alias("lo"), (t * 2 + 2 * HOUR).alias("hi"), F.col("props").alias("arguments"))
    kinds = event_profile(spark, d, "event_type").select("user_id", F.lit("type").alias("name"), "lo", "hi", json_values.text_of(F.col("value"), "string").alias("value"))
    return evaluate.Results(KEY, e.select("user_id").distinct(), BOUNDS, acts, kinds, line_profile(spark, d).withColumn("name", F.lit("value")))


B0, B1 = BOUNDS
TYPE_IN_BOUNDS = f"{TYPES_SQL}, c AS (SELECT user_id, greatest(lo, {B0}) AS lo, least(hi, {B1}) AS hi, value FROM t WHERE lo < {B1} AND hi > {B0})"


@query("constraint_violations", f"""WITH {TYPES_SQL}, b0 AS (SELECT user_id, lo, hi, value <> 'error' AS value FROM t), {coalesce_sql('b', 'b0')}, cl AS (SELECT user_id, greatest(lo, {B0}) AS lo, least(hi, {B1}) AS hi, value FROM b WHERE lo < {B1} AND hi > {B0})
SELECT user_id, lo, hi, 'violation' AS what FROM cl WHERE NOT value UNION ALL SELECT user_id, {B0}, min(lo), 'gap' FROM cl GROUP BY 1 HAVING min(lo) > {B0} UNION ALL SELECT user_id, max(hi), {B1}, 'gap' FROM cl GROUP BY 1 HAVING max(hi) < {B1} UNION ALL SELECT DISTINCT user_id, {B0}, {B1}, 'gap' FROM events WHERE user_id NOT IN (SELECT user_id FROM cl)""")
def constraint_violations(spark, d):
    """No errors: violations, and gaps in the knowledge of it."""
    out = evaluate.check(Discrete.Resource("type").not_equal("error").node, event_results(spark, d))
    found = out.violations.select("user_id", F.explode("windows").alias("w")).select("user_id", "w.lo", "w.hi", F.lit("violation").alias("what"))
    return found.unionByName(out.gaps.withColumn("what", F.lit("gap")))


@query("constraint_for_each_activity", f"""WITH a AS (SELECT user_id, event_id, event_type, epoch_us(ts) * 2 AS lo, epoch_us(ts) * 2 + {2 * HOUR} AS hi FROM events WHERE event_type IN ('click', 'purchase'))
SELECT x.user_id, x.event_id AS first_id, y.event_id AS second_id, greatest(x.lo, y.lo, {B0}) AS lo, least(x.hi, y.hi, {B1}) AS hi FROM a x JOIN a y ON x.user_id = y.user_id AND x.event_type = 'click' AND y.event_type = 'purchase' AND x.lo < y.hi AND y.lo < x.hi WHERE greatest(x.lo, y.lo, {B0}) < least(x.hi, y.hi, {B1})""")
def constraint_for_each_activity(spark, d):
    """No purchase while a click is active: every pair that breaks it, as the loops of the expression find them."""
    out = evaluate.check(Constraint.ForbiddenActivityOverlap("click", "purchase").node, event_results(spark, d))
    # the inner loop's activity comes first
    return out.violations.select("user_id", F.get("ids", 1).alias("first_id"), F.get("ids", 0).alias("second_id"), F.explode("windows").alias("w")).select("user_id", "first_id", "second_id", "w.lo", "w.hi")


# --- goals


@query("goal_cardinality_windows", f"""WITH {DAYS_SQL}, a AS (SELECT user_id, epoch_us(ts) * 2 AS lo, epoch_us(ts) * 2 + 1 AS hi FROM events WHERE event_type = 'view')
SELECT d.user_id, d.lo, d.hi, count(a.lo) AS n, greatest(0, 3 - count(a.lo)) AS missing FROM days d LEFT JOIN a ON a.user_id = d.user_id AND d.lo <= a.lo AND a.hi <= d.hi GROUP BY 1, 2, 3 HAVING count(a.lo) < 3""")
def goal_cardinality_windows(spark, d):
    """Days with fewer than three views."""
    views = read(spark, d, "events").select("user_id", F.col("event_id").alias("id"), F.col("event_type").alias("type"), (iv.micros("ts") * 2).alias("lo"), (iv.micros("ts") * 2 + 1).alias("hi"), F.col("props").alias("arguments"))
    return goals.cardinality(views, KEY, goals.of_type("view"), days(spark, d), least=3).select("user_id", "lo", "hi", "n", "missing")


@query("goal_recurrence_bounds", f"""WITH s AS (SELECT user_id, epoch_us(ts) AS t, 0 AS edge FROM events WHERE event_type = 'click' UNION ALL SELECT DISTINCT user_id, {B0 // 2}, -1 FROM events UNION ALL SELECT DISTINCT user_id, {B1 // 2}, 1 FROM events),
g AS (SELECT user_id, lag(t) OVER w AS after_us, t AS before_us, lag(edge) OVER w <> 0 OR edge <> 0 AS edge FROM s WINDOW w AS (PARTITION BY user_id ORDER BY t, edge))
SELECT user_id, after_us, before_us, CASE WHEN before_us - after_us > {2 * DAY} THEN 'too far' ELSE 'too close' END AS kind FROM g WHERE before_us - after_us > {2 * DAY} OR NOT edge AND before_us - after_us < {HOUR}""")
def goal_recurrence_bounds(spark, d):
    e = read(spark, d, "events")
    acts = e.select("user_id", F.col("event_id").alias("id"), F.col("event_type").alias("type"), (iv.micros("ts") * 2).alias("lo"), (iv.micros("ts") * 2 + 1).alias("hi"), F.col("props").alias("arguments"))
    return goals.recurrence(acts, KEY, goals.of_type("click"), HOUR, 2 * DAY, BOUNDS, e)
