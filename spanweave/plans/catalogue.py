"""The registered queries of the timeline engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.operators import parallel, sequences, serial
from spanweave.relations import anchors, external_events
from spanweave.scratch import Scratch
from spanweave.sources.tables import event_profile, line_spans, read

KEY = ["user_id"]
HOUR, DAY = 3_600_000_000, 86_400_000_000
HIGH, EVEN, ODD = "value > 34", "event_id % 2 = 0", "event_id % 2 = 1"
#: 2024-01-10 and the bounds of January 2024, in µs
AT, BOUNDS = 1704844800000000, (1704067200000000 * 2, 1706745600000000 * 2)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def profile_sql(name: str, value: str, where: str = "true") -> str:
    return f"""{name} AS (SELECT * FROM (SELECT user_id, epoch_us(ts) * 2 AS lo, coalesce(lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) * 2, epoch_us(ts) * 2 + 1) AS hi, {value} AS value FROM events WHERE {where}) WHERE lo < hi)"""


def coalesce_sql(name: str, source: str, key: str = "user_id") -> str:
    return f"""{name}_1 AS (SELECT *, CASE WHEN lag(hi) OVER w = lo AND lag(value) OVER w IS NOT DISTINCT FROM value THEN 0 ELSE 1 END AS new FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY lo, hi)),
{name}_2 AS (SELECT *, sum(new) OVER (PARTITION BY {key} ORDER BY lo, hi) AS run FROM {name}_1),
{name} AS (SELECT {key}, min(lo) AS lo, max(hi) AS hi, any_value(value) AS value FROM {name}_2 GROUP BY {key}, run)"""


ATOMS_SQL = """pts AS (SELECT user_id, lo AS t FROM a UNION SELECT user_id, hi FROM a UNION SELECT user_id, lo FROM b UNION SELECT user_id, hi FROM b),
cut AS (SELECT user_id, t AS lo, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS hi FROM pts),
s AS (SELECT cut.user_id, cut.lo, cut.hi, a.value AS a, b.value AS b FROM cut LEFT JOIN a ON a.user_id = cut.user_id AND a.lo <= cut.lo AND cut.hi <= a.hi LEFT JOIN b ON b.user_id = cut.user_id AND b.lo <= cut.lo AND cut.hi <= b.hi WHERE cut.hi IS NOT NULL)"""


def high(spark, d, where="true"):
    """A boolean profile: whether the value is high."""
    return serial.coalesce(event_profile(spark, d, HIGH, where), KEY, ["value"])


HIGH_SQL = f"{profile_sql('p', HIGH)}, {coalesce_sql('h', 'p')}"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["windows_longer_than"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# --- profiles and scans


@query("profile_segments", f"WITH {profile_sql('p', 'event_type')} SELECT * FROM p")
def profile_segments(spark, d):
    return event_profile(spark, d, "event_type")


@query("resource_profile_end_time", f"WITH {profile_sql('p', 'value')} SELECT user_id, max(hi) // 2 AS end_us, count(*) AS segments FROM p GROUP BY user_id")
def resource_profile_end_time(spark, d):
    return event_profile(spark, d, "value").groupBy("user_id").agg(F.shiftright(F.max("hi"), 1).alias("end_us"), F.count("*").alias("segments"))


@query("resources_at_time", f"WITH {profile_sql('p', 'value')} SELECT user_id, value FROM p WHERE lo <= {AT} * 2 AND {AT} * 2 < hi")
def resources_at_time(spark, d):
    return event_profile(spark, d, "value").filter(iv.contains_point(F.col("lo"), F.col("hi"), F.lit(AT))).select("user_id", "value")


@query("resource_samples", f"WITH {profile_sql('p', 'value')} SELECT user_id, lo // 2 AS t_us, value FROM p UNION ALL SELECT user_id, hi // 2, value FROM p")
def resource_samples(spark, d):
    ends = F.explode(F.array("lo", "hi"))
    return event_profile(spark, d, "value").withColumn("edge", ends).select("user_id", F.shiftright("edge", 1).alias("t_us"), "value")


@query("interval_algebra", f"""WITH {profile_sql('p', 'value')}, n AS (SELECT *, lead(lo) OVER w AS lo2, lead(hi) OVER w AS hi2 FROM p WINDOW w AS (PARTITION BY user_id ORDER BY lo))
SELECT user_id, lo, (hi // 2 - lo // 2) AS duration_us, (hi = lo + 1 AND lo % 2 = 0) AS is_point, greatest(lo, lo2) >= least(hi + 2, hi2) AS apart, hi = lo2 AS meets, hi < lo2 AS before,
least(lo, lo2) AS hull_lo, greatest(hi, hi2) AS hull_hi, (lo <= lo2 AND hi2 <= hi) AS contains FROM n WHERE lo2 IS NOT NULL""")
def interval_algebra(spark, d):
    w = Window.partitionBy("user_id").orderBy("lo")
    lo, hi, lo2, hi2 = (F.col(c) for c in ("lo", "hi", "lo2", "hi2"))
    n = event_profile(spark, d, "value").withColumns({"lo2": F.lead("lo").over(w), "hi2": F.lead("hi").over(w)}).filter("lo2 IS NOT NULL")
    return n.select("user_id", "lo", iv.duration_us(lo, hi).alias("duration_us"), iv.is_point(lo, hi).alias("is_point"), iv.is_empty(F.greatest(lo, lo2), F.least(iv.shifted(hi, 1), hi2)).alias("apart"), iv.meets(hi, lo2).alias("meets"), iv.strictly_before(hi, lo2).alias("before"), F.least(lo, lo2).alias("hull_lo"), F.greatest(hi, hi2).alias("hull_hi"), iv.contains(lo, hi, lo2, hi2).alias("contains"))


# --- boolean profiles with gaps


@query("windows_longer_than", f"WITH {HIGH_SQL} SELECT user_id, lo, hi FROM h WHERE value AND hi // 2 - lo // 2 >= {12 * HOUR}")
def windows_longer_than(spark, d):
    return serial.longer_than(high(spark, d).filter("value"), 12 * HOUR).select("user_id", "lo", "hi")


@query("windows_shorter_than", f"WITH {HIGH_SQL} SELECT user_id, lo, hi FROM h WHERE value AND hi // 2 - lo // 2 <= {2 * HOUR}")
def windows_shorter_than(spark, d):
    return serial.shorter_than(high(spark, d).filter("value"), 2 * HOUR).select("user_id", "lo", "hi")


@query("violations_of_windows", f"WITH {HIGH_SQL} SELECT user_id, list({{'lo': lo, 'hi': hi}} ORDER BY lo) AS windows, count(*) AS n FROM h WHERE NOT value GROUP BY user_id")
def violations_of_windows(spark, d):
    return high(spark, d).filter("NOT value").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("windows"), F.count("*").alias("n"))


def register_combination(name: str, value: str, source: str = HIGH, sql_value: str | None = None) -> None:
    """A query over the profiles a of even events and b of odd ones, from a value that both engines understand. The table is read once."""

    def run(spark, d):
        return serial.valued(serial.sweep_of_parts(two_profiles(spark, d, source), KEY, "side", ["a", "b"]), KEY, F.expr(value))

    QUERIES[name] = run
    SQL[name] = f"WITH {profile_sql('a0', source, EVEN)}, {coalesce_sql('a', 'a0')}, {profile_sql('b0', source, ODD)}, {coalesce_sql('b', 'b0')}, {ATOMS_SQL}, v AS (SELECT user_id, lo, hi, {sql_value or value} AS value FROM s), k AS (SELECT * FROM v WHERE value IS NOT NULL), {coalesce_sql('o', 'k')} SELECT * FROM o"


def two_profiles(spark, d, source: str) -> DataFrame:
    """(user_id, side, lo, hi, value): of even events (a) and of odd ones (b); one shuffle by user serves all that follows."""
    e = read(spark, d, "events").select("user_id", "event_id", iv.micros("ts").alias("t"), F.when(F.expr(EVEN), "a").when(F.expr(ODD), "b").alias("side"), F.expr(source).alias("value")).filter("side IS NOT NULL").repartition("user_id")
    following = F.lead("t").over(Window.partitionBy("user_id", "side").orderBy("t", "event_id"))
    return e.select("user_id", "side", (F.col("t") * 2).alias("lo"), F.coalesce(following * 2, F.col("t") * 2 + 1).alias("hi"), "value").filter("lo < hi")


for _name, _value in {
    "windows_and": "a AND b",
    "windows_or": "a OR b",
    "windows_xor": "a <> b",
    "windows_if": "(NOT a) OR b",
    "windows_add": "CASE WHEN a OR b THEN true ELSE coalesce(a, b) END",
    "windows_minus": "CASE WHEN a AND coalesce(b, false) THEN false ELSE a END",
    "assign_gaps": "coalesce(a, b)",
    "windows_nor": "NOT (a OR b)",
    "windows_nand": "NOT (a AND b)",
    "profile_set": "coalesce(b, a)",
    "select_when_true": "CASE WHEN b THEN a END",
}.items():
    register_combination(_name, _value)
register_combination("profile_equal", "a = b", "event_type")
register_combination("profile_not_equal", "a <> b", "event_type")
register_combination("profile_zip", "concat(a, '/', b)", "event_type", "CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN concat(a, '/', b) END")
register_combination("profile_less_than", "a < b", "value")
register_combination("profile_greater_or_equal", "a >= b", "value")
register_combination("numbers_plus", "round(a + b, 6)", "value")
register_combination("numbers_minus", "round(a - b, 6)", "value")
register_combination("numbers_greatest", "greatest(a, b)", "value", "CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE greatest(a, b) END")


def register_one_sided(name: str, value: str, source: str = HIGH) -> None:
    """A query over the profile a of all events, from a value that needs no other profile."""

    def run(spark, d):
        renamed = event_profile(spark, d, source).withColumnRenamed("value", "a")
        return serial.coalesce(renamed.select("user_id", "lo", "hi", F.expr(value).alias("value")).filter("value IS NOT NULL"), KEY)

    QUERIES[name] = run
    SQL[name] = f"WITH {profile_sql('a0', source)}, {coalesce_sql('a', 'a0')}, v AS (SELECT user_id, lo, hi, {value} AS value FROM (SELECT user_id, lo, hi, value AS a FROM a) AS s), k AS (SELECT * FROM v WHERE value IS NOT NULL), {coalesce_sql('o', 'k')} SELECT * FROM o"


register_one_sided("windows_not", "NOT a")
register_one_sided("assign_gaps_constant", "coalesce(a, false)")
register_one_sided("profile_at_most", "a <= 20", "value")
register_one_sided("numbers_times", "round(2 * a, 6)", "value")
register_one_sided("numbers_div", "round(a / 3, 6)", "value")
register_one_sided("numbers_pow", "round(pow(a, 2), 4)", "value")
register_one_sided("numbers_negate", "-a", "value")
register_one_sided("numbers_abs", "abs(a - 20)", "value")
register_one_sided("numbers_to_long", "CAST(floor(a) AS BIGINT)", "value")
register_one_sided("strings_length", "length(a)", "event_type")
register_one_sided("strings_equal_ignoring_case", "lower(a) = lower('VIEW')", "event_type")
register_one_sided("strings_is_empty", "length(a) = 0", "event_type")


# --- neighbours

TYPES_SQL = f"{profile_sql('p', 'event_type')}, {coalesce_sql('t', 'p')}"
CHANGES_SQL = f"{TYPES_SQL}, ch AS (SELECT user_id, lo, CASE WHEN lag(hi) OVER w = lo THEN lag(value) OVER w END AS before, value AS after FROM t WINDOW w AS (PARTITION BY user_id ORDER BY lo))"


def types(spark, d):
    return serial.coalesce(event_profile(spark, d, "event_type"), KEY, ["value"])


@query("changes", f"WITH {CHANGES_SQL} SELECT * FROM ch WHERE before IS NOT NULL AND after <> before")
def changes(spark, d):
    return serial.changes(types(spark, d), KEY)


@query("transition", f"WITH {CHANGES_SQL} SELECT user_id, lo FROM ch WHERE before = 'view' AND after = 'purchase'")
def transition(spark, d):
    return serial.changes(types(spark, d), KEY).filter("before = 'view' AND after = 'purchase'").select("user_id", "lo")


@query("rising_edges", f"WITH {HIGH_SQL}, e AS (SELECT *, lag(hi) OVER w = lo AND NOT lag(value) OVER w AS up FROM h WINDOW w AS (PARTITION BY user_id ORDER BY lo)) SELECT user_id, lo FROM e WHERE value AND up")
def rising_edges(spark, d):
    return serial.changes(high(spark, d), KEY).filter("after AND NOT before").select("user_id", "lo")


@query("keep_nth_true", f"WITH {HIGH_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lo) AS i, row_number() OVER (PARTITION BY user_id ORDER BY lo DESC) AS j FROM h WHERE value) SELECT user_id, lo, hi, 'third' AS which FROM n WHERE i = 3 UNION ALL SELECT user_id, lo, hi, 'last' FROM n WHERE j = 1")
def keep_nth_true(spark, d):
    h = high(spark, d).filter("value").withColumns({"__third": serial.nth(KEY, 2), "__last": serial.nth(KEY, -1)})
    which = F.explode(F.filter(F.array(F.when(F.col("__third"), "third"), F.when(F.col("__last"), "last")), lambda x: x.isNotNull()))
    return h.filter("__third OR __last").select("user_id", "lo", "hi", which.alias("which"))


@query("min_gap_before", f"WITH {HIGH_SQL}, g AS (SELECT user_id, lo, hi, lo // 2 - lag(hi) OVER (PARTITION BY user_id ORDER BY lo) // 2 AS gap_us FROM h WHERE value) SELECT * FROM g WHERE gap_us IS NULL OR gap_us >= {6 * HOUR}")
def min_gap_before(spark, d):
    h = high(spark, d).filter("value").withColumn("gap_us", sequences.gap_before(KEY))
    return h.filter(F.col("gap_us").isNull() | (F.col("gap_us") >= 6 * HOUR)).select("user_id", "lo", "hi", "gap_us")


COMPLEMENT_SQL = f"""w AS (SELECT user_id, greatest(lo, {BOUNDS[0]}) AS lo, least(hi, {BOUNDS[1]}) AS hi FROM h WHERE value AND lo < {BOUNDS[1]} AND hi > {BOUNDS[0]} UNION ALL SELECT DISTINCT user_id, {BOUNDS[0]}, {BOUNDS[0]} FROM events UNION ALL SELECT DISTINCT user_id, {BOUNDS[1]}, {BOUNDS[1]} FROM events),
g AS (SELECT user_id, max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo, lo AS hi FROM w)"""


@query("complement", f"WITH {HIGH_SQL}, {COMPLEMENT_SQL} SELECT * FROM g WHERE lo < hi")
def complement(spark, d):
    return serial.complement(high(spark, d).filter("value"), KEY, BOUNDS, read(spark, d, "events"))


@query("shift_edges", f"WITH {HIGH_SQL} SELECT user_id, lo + {2 * HOUR} AS lo, hi - {2 * HOUR} AS hi FROM h WHERE value AND lo + {2 * HOUR} < hi - {2 * HOUR}")
def shift_edges(spark, d):
    return serial.shift_edges(high(spark, d).filter("value"), HOUR, -HOUR).select("user_id", "lo", "hi")


# --- parallel spans

SPANS_SQL = "spans AS (SELECT * FROM (SELECT l_suppkey, l_orderkey, l_linenumber, epoch_us(o_orderdate) * 2 AS lo, epoch_us(l_shipdate) * 2 + 1 AS hi FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE lo < hi)"
SUPPLIER = ["l_suppkey"]


@query("split_spans", f"WITH {SPANS_SQL}, s AS (SELECT *, hi // 2 - lo // 2 AS us FROM spans WHERE hi // 2 - lo // 2 >= 3) SELECT l_orderkey, l_linenumber, i AS piece, CASE WHEN i = 0 THEN lo ELSE lo // 2 * 2 + 2 * i * (us // 3) END AS lo, CASE WHEN i = 2 THEN hi ELSE lo // 2 * 2 + 2 * (i + 1) * (us // 3) END AS hi FROM s, (VALUES (0), (1), (2)) AS n(i)")
def split_spans(spark, d):
    return serial.split(serial.longer_than(line_spans(spark, d), 3), 3).select("l_orderkey", "l_linenumber", "piece", "lo", "hi")


@query("spans_to_windows", f"WITH {SPANS_SQL}, m AS (SELECT *, max(hi) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM spans), r AS (SELECT *, sum(CASE WHEN before >= lo THEN 0 ELSE 1 END) OVER (PARTITION BY l_suppkey ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM m) SELECT l_suppkey, min(lo) AS lo, max(hi) AS hi FROM r GROUP BY l_suppkey, run")
def spans_to_windows(spark, d):
    return serial.union_of(line_spans(spark, d), SUPPLIER)


def delta_sql(amount: str) -> str:
    return f"WITH {SPANS_SQL}, e AS (SELECT l_suppkey, lo AS t, {amount} AS d FROM spans UNION ALL SELECT l_suppkey, hi, -({amount}) FROM spans), p AS (SELECT l_suppkey, t, sum(d) AS d FROM e GROUP BY 1, 2 HAVING sum(d) <> 0), o AS (SELECT l_suppkey, t AS lo, lead(t) OVER w AS hi, CAST(sum(d) OVER w AS BIGINT) AS value FROM p WINDOW w AS (PARTITION BY l_suppkey ORDER BY t)) SELECT * FROM o WHERE hi IS NOT NULL"


@query("count_active", delta_sql("1"))
def count_active(spark, d):
    return parallel.delta_sweep(line_spans(spark, d), SUPPLIER, F.lit(1).cast("long"))


@query("reduce_into_profile", delta_sql("l_linenumber"))
def reduce_into_profile(spark, d):
    return parallel.delta_sweep(line_spans(spark, d), SUPPLIER, F.col("l_linenumber").cast("long"))


@query("accumulated_duration", f"WITH {SPANS_SQL} SELECT l_suppkey, CAST(sum(hi // 2 - lo // 2) AS BIGINT) AS total_us, max(hi // 2 - lo // 2) AS longest_us, count(*) AS spans FROM spans GROUP BY 1")
def accumulated_duration(spark, d):
    us = iv.duration_us(F.col("lo"), F.col("hi"))
    return line_spans(spark, d).groupBy("l_suppkey").agg(F.sum(us).alias("total_us"), F.max(us).alias("longest_us"), F.count("*").alias("spans"))


@query("busier_than_average", f"WITH o AS ({delta_sql('1')}) SELECT l_suppkey, lo, hi, value FROM o WHERE value > (SELECT 1.5 * avg(value) FROM o)")
def busier_than_average(spark, d):
    active = count_active(spark, d)
    return active.crossJoin(F.broadcast(active.agg((1.5 * F.avg("value")).alias("__most")))).filter("value > __most").drop("__most")


#: Order and line numbers repeat, so a row's number within them tells its spans apart
NUMBERED_SQL = "num AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_orderkey, l_linenumber ORDER BY lo, hi) AS n FROM spans)"


@query("forbidden_overlap", f"WITH {SPANS_SQL}, {NUMBERED_SQL} SELECT a.l_suppkey, a.l_orderkey AS l_order, b.l_orderkey AS r_order, a.l_linenumber AS l_line, b.l_linenumber AS r_line, greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi FROM num a JOIN num b ON a.l_suppkey = b.l_suppkey AND a.lo < b.hi AND b.lo < a.hi WHERE (a.l_orderkey, a.l_linenumber, a.n) < (b.l_orderkey, b.l_linenumber, b.n)")
def forbidden_overlap(spark, d):
    """Every pair of overlapping spans of a supplier once, those of one order and of repeated line numbers too."""
    return overlapping_pairs(line_spans(spark, d))


def overlapping_pairs(spans: DataFrame) -> DataFrame:
    number = F.row_number().over(Window.partitionBy(*SUPPLIER, "l_orderkey", "l_linenumber").orderBy("lo", "hi"))
    numbered = spans.withColumn("n", number)
    side = lambda p: F.struct(*[f"{p}_{c}" for c in ("l_orderkey", "l_linenumber", "n")])
    pairs = parallel.range_join(numbered, numbered, SUPPLIER, 120 * DAY).filter(side("l") < side("r"))
    return pairs.select("l_suppkey", F.col("l_l_orderkey").alias("l_order"), F.col("r_l_orderkey").alias("r_order"), F.col("l_l_linenumber").alias("l_line"), F.col("r_l_linenumber").alias("r_line"), F.greatest("l_lo", "r_lo").alias("lo"), F.least("l_hi", "r_hi").alias("hi"))


@query("spans_contains_count", f"WITH {SPANS_SQL}, parent AS (SELECT l_orderkey, min(lo) AS lo, min(lo) + {120 * DAY} AS hi FROM spans GROUP BY 1) SELECT p.l_orderkey, count(s.lo) AS children, CAST(coalesce(sum(s.hi // 2 - s.lo // 2), 0) AS BIGINT) AS inside_us FROM parent p LEFT JOIN spans s ON s.l_orderkey = p.l_orderkey AND p.lo <= s.lo AND s.hi <= p.hi GROUP BY 1")
def spans_contains_count(spark, d):
    spans = line_spans(spark, d)
    inside = F.col("hi") <= F.min("lo").over(Window.partitionBy("l_orderkey")) + 120 * DAY
    return spans.withColumn("__in", inside).groupBy("l_orderkey").agg(F.count_if("__in").alias("children"), F.sum(F.when(F.col("__in"), iv.duration_us(F.col("lo"), F.col("hi"))).otherwise(0)).alias("inside_us"))


@query("connect_to", """WITH c AS (SELECT user_id, event_id, epoch_us(ts) * 2 + 1 AS hi FROM events WHERE event_type = 'click'), p AS (SELECT user_id, event_id AS id, epoch_us(ts) * 2 AS lo FROM events WHERE event_type = 'purchase')
SELECT c.user_id, c.event_id, c.hi, arg_min(p.id, (p.lo, p.id)) AS to_id, min(p.lo) AS to_lo FROM c LEFT JOIN p ON p.user_id = c.user_id AND p.lo >= c.hi GROUP BY 1, 2, 3""")
def connect_to(spark, d):
    e = read(spark, d, "events").withColumn("t", iv.micros("ts"))
    clicks = e.filter("event_type = 'click'").select("user_id", "event_id", iv.tick_hi(F.col("t"), True).alias("hi"))
    return parallel.as_of_next(clicks, e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("id"), iv.tick_lo(F.col("t")).alias("lo")), KEY, "id")


# --- relations of plans


#: Sources of a group, a day each and the later ones over the earlier: source k of seven covers days k to k + 3 and is valid from k on
SOURCES_SQL = f"""src AS (SELECT g AS derivation_group, k AS source_key, k AS valid_at, ({AT} + (k - 3) * {DAY}) * 2 AS lo, ({AT} + k * {DAY}) * 2 AS hi FROM range(20) AS a(g), range(7) AS b(k)),
ev AS (SELECT event_id % 500 AS event_key, event_id % 7 AS source_key, user_id % 20 AS derivation_group, epoch_us(ts) * 2 AS lo, event_id FROM events)"""


@query("derived_events", f"""WITH {SOURCES_SQL}, own AS (SELECT ev.*, src.valid_at FROM ev JOIN src USING (source_key, derivation_group) WHERE src.lo <= ev.lo AND ev.lo < src.hi),
fine AS (SELECT * FROM own WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.derivation_group = own.derivation_group AND src.valid_at > own.valid_at AND src.lo <= own.lo AND own.lo < src.hi))
SELECT event_key, derivation_group, source_key, lo, event_id FROM fine QUALIFY row_number() OVER (PARTITION BY event_key, derivation_group ORDER BY valid_at DESC, source_key DESC, lo DESC, event_id DESC) = 1""")
def derived_events(spark, d):
    events = read(spark, d, "events").select((F.col("event_id") % 500).alias("event_key"), (F.col("event_id") % 7).alias("source_key"), (F.col("user_id") % 20).alias("derivation_group"), (iv.micros("ts") * 2).alias("lo"), "event_id")
    k = spark.range(20).select(F.col("id").alias("derivation_group"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(6).cast("long"))).alias("k"))
    sources = k.select("derivation_group", F.col("k").alias("source_key"), F.col("k").alias("valid_at"), ((F.col("k") - 3) * DAY * 2 + 2 * AT).alias("lo"), (F.col("k") * DAY * 2 + 2 * AT).alias("hi"))
    return external_events.derived_events(events, sources)


MERGE_SQL = """WITH base AS (SELECT p_partkey AS id, p_size AS v FROM part WHERE p_partkey % 11 <> 0),
mine AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS v FROM part WHERE p_partkey % 7 <> 0),
theirs AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_size + 2 ELSE p_size END AS v FROM part WHERE p_partkey % 13 <> 0)
SELECT id, base.v AS base, mine.v AS mine, theirs.v AS theirs,
CASE WHEN mine.v IS NOT DISTINCT FROM theirs.v THEN 'same' WHEN mine.v IS NOT DISTINCT FROM base.v THEN 'take theirs' WHEN theirs.v IS NOT DISTINCT FROM base.v THEN 'take mine' ELSE 'conflict' END AS outcome
FROM base FULL JOIN mine USING (id) FULL JOIN theirs USING (id)"""


@query("merge_diff", MERGE_SQL)
def merge_diff(spark, d):
    part = read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("v"))
    base = part.filter("id % 11 <> 0").select("id", F.col("v").alias("base"))
    mine = part.filter("id % 7 <> 0").select("id", F.expr("CASE WHEN id % 5 = 0 THEN v + 1 ELSE v END").alias("mine"))
    theirs = part.filter("id % 13 <> 0").select("id", F.expr("CASE WHEN id % 3 = 0 THEN v + 2 ELSE v END").alias("theirs"))
    outcome = F.expr("CASE WHEN mine <=> theirs THEN 'same' WHEN mine <=> base THEN 'take theirs' WHEN theirs <=> base THEN 'take mine' ELSE 'conflict' END")
    return base.join(mine, "id", "full").join(theirs, "id", "full").withColumn("outcome", outcome)


@query("merge_conflicts", f"SELECT id FROM ({MERGE_SQL}) WHERE outcome = 'conflict'")
def merge_conflicts(spark, d):
    return merge_diff(spark, d).filter("outcome = 'conflict'").select("id")


@query("anchor_net_offset", "WITH RECURSIVE t AS (SELECT p_partkey AS id, p_size AS net, 0 AS depth FROM part WHERE p_partkey // 2 NOT IN (SELECT p_partkey FROM part) OR p_partkey // 2 = p_partkey UNION ALL SELECT p_partkey, net + p_size, depth + 1 FROM part JOIN t ON p_partkey // 2 = t.id AND p_partkey // 2 <> p_partkey) SELECT id, CAST(net AS BIGINT) AS net, CAST(depth AS BIGINT) AS depth FROM t")
def anchor_net_offset(spark, d):
    """Anchors form trees (id div 2 is the parent): offsets add up along them."""
    parts = read(spark, d, "part").selectExpr("p_partkey AS id", "nullif(p_partkey div 2, p_partkey) AS anchor_id", "CAST(p_size AS BIGINT) AS offset_us")
    return anchors.jumped(parts, Scratch(spark)).select("id", F.col("net_us").alias("net"), "depth")


@query("sequence_filter", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE lower(event_type) = 'purchase' AND CAST(json_extract_string(props, '$.k') AS BIGINT) BETWEEN 20 AND 60")
def sequence_filter(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return read(spark, d, "events").filter((F.lower("event_type") == "purchase") & k.between(20, 60)).select("event_id", k.alias("k"))


# --- goals as conflict queries


@query("goal_recurrence", f"WITH g AS (SELECT user_id, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS after_us, epoch_us(ts) AS before_us FROM events WHERE event_type = 'click') SELECT * FROM g WHERE before_us - after_us > {2 * DAY}")
def goal_recurrence(spark, d):
    e = read(spark, d, "events").filter("event_type = 'click'").select("user_id", "event_id", iv.micros("ts").alias("before_us"))
    return e.withColumn("after_us", F.lag("before_us").over(Window.partitionBy("user_id").orderBy("before_us", "event_id"))).filter(F.col("before_us") - F.col("after_us") > 2 * DAY).select("user_id", "after_us", "before_us")


@query("goal_cardinality", "SELECT user_id, count(*) FILTER (event_type = 'purchase') AS found, greatest(0, 20 - count(*) FILTER (event_type = 'purchase')) AS missing FROM events GROUP BY 1")
def goal_cardinality(spark, d):
    return read(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("found")).withColumn("missing", F.greatest(F.lit(0), 20 - F.col("found")))


@query("goal_coexistence", f"WITH e AS (SELECT *, epoch_us(ts) AS t FROM events) SELECT a.user_id, a.event_id FROM e a WHERE a.event_type = 'signup' AND NOT EXISTS (SELECT 1 FROM e b WHERE b.user_id = a.user_id AND b.event_type = 'view' AND b.t >= a.t AND b.t < a.t + {DAY})")
def goal_coexistence(spark, d):
    """Signups that no view follows within a day: the next view is looked up as of the signup, not joined to all views."""
    e = read(spark, d, "events").select("user_id", "event_id", "event_type", (iv.micros("ts") * 2).alias("lo"))
    asked = e.filter("event_type = 'signup'").select("user_id", "event_id", F.col("lo").alias("hi"))
    found = parallel.as_of_next(asked, e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("id"), "lo"), KEY, "id")
    return found.filter(F.col("to_lo").isNull() | (F.col("to_lo") >= F.col("hi") + 2 * DAY)).select("user_id", "event_id")


# --- numbers along time


@query("integrate", f"WITH {profile_sql('p', 'value')} SELECT user_id, round(sum(value * (hi // 2 - lo // 2) / 1e6), 3) AS area FROM p GROUP BY 1")
def integrate(spark, d):
    area = F.col("value") * iv.duration_us(F.col("lo"), F.col("hi")) / 1e6
    return event_profile(spark, d, "value").groupBy("user_id").agg(F.round(F.sum(area), 3).alias("area"))


LINEAR_SQL = f"{profile_sql('p', 'value')}, n AS (SELECT user_id, lo, hi, value AS v0, (lead(value) OVER w - value) / ((hi - lo) / 2e6) AS rate FROM p WINDOW w AS (PARTITION BY user_id ORDER BY lo)), l AS (SELECT * FROM n WHERE rate IS NOT NULL)"


def linear(spark, d):
    """Pieces (user_id, lo, hi, v0, rate per second) that join an event's value to the next one's."""
    w = Window.partitionBy("user_id").orderBy("lo")
    rate = (F.lead("value").over(w) - F.col("value")) / ((F.col("hi") - F.col("lo")) / F.lit(2e6))
    return event_profile(spark, d, "value").select("user_id", "lo", "hi", F.col("value").alias("v0"), rate.alias("rate")).filter("rate IS NOT NULL")


@query("linear_rate", f"WITH {LINEAR_SQL} SELECT user_id, lo, hi, round(rate, 6) AS rate FROM l")
def linear_rate(spark, d):
    return linear(spark, d).select("user_id", "lo", "hi", F.round("rate", 6).alias("rate"))


@query("linear_crossings", f"WITH {LINEAR_SQL}, x AS (SELECT user_id, lo // 2 + CAST(round_even((50 - v0) / rate * 1e6, 0) AS BIGINT) AS t_us, rate > 0 AS rising, hi FROM l WHERE rate <> 0 AND (50 - v0) / rate > 0) SELECT user_id, t_us, rising FROM x WHERE t_us * 2 < hi")
def linear_crossings(spark, d):
    """When a linear profile crosses 50, to the nearest µs."""
    after = (50 - F.col("v0")) / F.col("rate")
    t = F.shiftright("lo", 1) + F.rint(after * 1e6).cast("long")
    return linear(spark, d).filter((F.col("rate") != 0) & (after > 0)).select("user_id", t.alias("t_us"), (F.col("rate") > 0).alias("rising"), "hi").filter("t_us * 2 < hi").drop("hi")


@query("linear_value_at", f"WITH {LINEAR_SQL} SELECT user_id, round(v0 + rate * ({AT} - lo // 2) / 1e6, 6) AS value FROM l WHERE lo <= {AT} * 2 AND {AT} * 2 < hi")
def linear_value_at(spark, d):
    return linear(spark, d).filter(iv.contains_point(F.col("lo"), F.col("hi"), F.lit(AT))).select("user_id", F.round(F.col("v0") + F.col("rate") * (F.lit(AT) - F.shiftright("lo", 1)) / 1e6, 6).alias("value"))
