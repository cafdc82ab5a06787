"""Evaluates constraint expressions, given as JSON trees, to DataFrames.

One expression is one lazy plan over all keys (plans, datasets) at once. A
loop over activities adds a key column that holds the activity's identifier,
so its body is the same plan with one key more; nested loops add one each.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.functions import json_values
from spanweave.operators import accumulate, linear, parallel, serial


@dataclass(frozen=True)
class Results:
    """What a simulation left behind, for all keys.

    key_rows: one row a key. activities: (keys, id, type, lo, hi, arguments as
    JSON text). discrete: (keys, name, lo, hi, value as canonical JSON text).
    real: (keys, name, lo, hi, value as a linear struct). bounds: ticks.
    """

    keys: list[str]
    key_rows: DataFrame
    bounds: tuple[int, int]
    activities: DataFrame | None = None
    discrete: DataFrame | None = None
    real: DataFrame | None = None
    plan_start_us: int = 0


@dataclass(frozen=True)
class Scope:
    """Where an expression is evaluated: results, and the loops around it (alias to key column)."""

    results: Results
    keys: list[str]
    key_rows: DataFrame  # keys, and lo, hi, arguments of each loop's activity under <column>_...
    loops: dict[str, str] = field(default_factory=dict)
    bounds: tuple[int, int] = iv.FOREVER

    def lifted(self, df: DataFrame) -> DataFrame:
        """Rows of the results, for each activity of the loops."""
        return df if not self.loops else df.join(self.key_rows.select(*self.keys), self.results.keys)

    def constant(self, value: Column, interval: tuple | None = None) -> DataFrame:
        low, high = interval or iv.FOREVER
        as_column = lambda x: x if isinstance(x, Column) else F.lit(x).cast("long")
        return self.key_rows.select(*self.keys, as_column(low).alias("lo"), as_column(high).alias("hi"), value.alias("value")).filter("lo < hi")

    def clip(self, df: DataFrame) -> DataFrame:
        return serial.clip(df, self.bounds)

    def activity(self, alias: str) -> tuple[Column, Column]:
        if alias not in self.loops:
            raise KeyError(f"no activity is bound to {alias}")
        c = self.loops[alias]
        return F.col(f"{c}_lo"), F.col(f"{c}_hi")

    def within(self, alias: str, activity_type: str) -> Scope:
        """The scope of a loop over activities of a type."""
        column = f"act_{len(self.loops)}"
        own = self.results.activities.filter(F.col("type") == activity_type).select(*self.results.keys, F.col("id").cast("long").alias(column), F.col("lo").alias(f"{column}_lo"), F.col("hi").alias(f"{column}_hi"), F.col("arguments").alias(f"{column}_arguments"))
        return replace(self, keys=[*self.keys, column], key_rows=self.key_rows.join(own, self.results.keys), loops={**self.loops, alias: column})


KINDS: dict[str, object] = {}


def kind(*names: str):
    def add(f):
        KINDS.update({n: f for n in names})
        return f

    return add


def scope_of(results: Results) -> Scope:
    return Scope(results, list(results.keys), results.key_rows.select(*results.keys).distinct(), {}, results.bounds)


def evaluate(node: dict, results: Results) -> DataFrame:
    """The timeline or violations of an expression."""
    return run(node, scope_of(results))


def run(node: dict, s: Scope):
    if node.get("kind") not in KINDS:
        raise ValueError(f"unknown kind of expression: {node.get('kind')}")
    return KINDS[node["kind"]](node, s)


def resources_of(node) -> set[str]:
    """Names of the resources that an expression reads: one filter prunes all others from the scan."""
    if isinstance(node, list):
        return set().union(*map(resources_of, node))
    if not isinstance(node, dict):
        return set()
    own = {node["name"]} if node.get("kind") in ("DiscreteProfileResource", "RealProfileResource") else set()
    return own.union(*(resources_of(v) for v in node.values()))


def pretty(node, indent: str = "") -> str:
    """An expression as nested lines."""
    if isinstance(node, dict):
        inner = "".join(f"\n{indent}  {k}: {pretty(v, indent + '  ')}" for k, v in node.items() if k != "kind")
        return f"({node.get('kind', '')}{inner})"
    if isinstance(node, list):
        return "".join(f"\n{indent}  - {pretty(v, indent + '  ')}" for v in node)
    return json_values.canonical(node)


# --- what a node's value is


def is_real(node: dict) -> bool:
    k = node["kind"]
    if k in ("AssignGapsExpression",):
        return is_real(node["originalProfile"])
    if k == "ProfileExpressionShiftBy":
        return is_real(node["expression"])
    if k == "ValueAtExpression":
        return is_real(node["profile"])
    return k.startswith("RealProfile") and k not in ("RealProfileLessThan", "RealProfileLessThanOrEqual", "RealProfileGreaterThan", "RealProfileGreaterThanOrEqual")


def is_windows(node: dict) -> bool:
    k = node["kind"]
    if k == "AssignGapsExpression":
        return is_windows(node["originalProfile"])
    if k in ("ProfileExpressionShiftBy", "IntervalsExpressionShiftEdges", "IntervalsExpressionStarts", "IntervalsExpressionEnds"):
        return is_windows(node["expression"])
    return k.startswith("WindowsExpression") or k in ("ExpressionEqual", "ExpressionNotEqual", "DiscreteProfileTransition", "ProfileChanges", "SpansExpressionContains") or (k.startswith("RealProfile") and not is_real(node))


# --- intervals and durations


def duration(node, s: Scope) -> int:
    """µs of a literal, or of an interval that no activity bounds."""
    if isinstance(node, dict):
        low, high = interval(node["interval"], s)
        if isinstance(low, Column):
            raise ValueError("a duration can't depend on an activity here")
        return (high >> 1) - (low >> 1)
    return int(node)


def interval(node: dict, s: Scope) -> tuple:
    """(lo, hi) ticks, as numbers or as columns of the loop's activity."""
    if node["kind"] == "IntervalAlias":
        return s.activity(node["alias"])
    at = lambda t: int(datetime.fromisoformat(t.replace("Z", "+00:00")).timestamp() * 1_000_000) - s.results.plan_start_us if isinstance(t, str) else int(t)
    shut = lambda name: node.get(name, "Inclusive") == "Inclusive"
    low = 2 * at(node["start"]) + (not shut("startInclusivity")) if "start" in node else s.results.bounds[0]
    high = 2 * at(node["end"]) + shut("endInclusivity") if "end" in node else s.results.bounds[1]
    return low, high


def optional_interval(node: dict, s: Scope) -> tuple | None:
    return interval(node["interval"], s) if node.get("interval") else None


# --- profiles


@kind("DiscreteProfileResource")
def _(n, s):
    return s.lifted(s.results.discrete.filter(F.col("name") == n["name"]).drop("name"))


@kind("RealProfileResource")
def _(n, s):
    parts = []
    if s.results.real is not None:
        parts.append(s.results.real.filter(F.col("name") == n["name"]).drop("name"))
    if s.results.discrete is not None:
        parts.append(linear.from_numbers(s.results.discrete.filter(F.col("name") == n["name"]).drop("name")))
    return s.lifted(reduce(DataFrame.unionByName, parts))


@kind("DiscreteProfileValue")
def _(n, s):
    return s.constant(F.lit(json_values.canonical(n["value"])), optional_interval(n, s))


@kind("RealProfileValue")
def _(n, s):
    return s.constant(linear.line(F.lit(0), F.lit(float(n["value"])), F.lit(float(n.get("rate", 0)))), optional_interval(n, s))


@kind("WindowsExpressionValue")
def _(n, s):
    return s.constant(F.lit(bool(n["value"])), optional_interval(n, s))


def argument(n, s) -> Column:
    return F.get_json_object(f"{s.loops[n['alias']]}_arguments", f"$['{n['name']}']")


@kind("DiscreteProfileParameter")
def _(n, s):
    text = argument(n, s)
    known = F.coalesce(text.isin("true", "false", "null") | json_values.number_of(text).isNotNull() | F.substring(text, 1, 1).isin("{", "["), F.lit(False))
    number = json_values.number_of(text)
    return s.constant(F.when(number.isNotNull(), json_values.text_of(number, "double")).when(known, text).otherwise(json_values.text_of(text, "string")))


@kind("RealProfileParameter")
def _(n, s):
    number = json_values.number_of(argument(n, s))
    checked = F.when(number.isNull(), F.raise_error(F.lit("an argument isn't a number")).cast("double")).otherwise(number)
    return s.constant(linear.line(F.lit(0), checked, F.lit(0.0)))


def profile(n: dict, s: Scope) -> tuple[DataFrame, bool]:
    """A profile and whether it is linear."""
    return run(n, s), is_real(n)


def as_linear(n: dict, s: Scope) -> DataFrame:
    df = run(n, s)
    return df if is_real(n) else linear.from_numbers(df)


@kind("StructProfileExpression")
def _(n, s):
    """Objects of several profiles' values, where all are defined."""
    names = sorted(n["expressions"])
    sides = {f"s{k}": text_profile(n["expressions"][name], s) for k, name in enumerate(names)}
    parts = [x for k, name in enumerate(names) for x in (F.lit(("," if k else "{") + json_values.canonical(name) + ":"), F.col(f"s{k}"))]
    return serial.combine(sides, s.keys, F.concat(*parts, F.lit("}")) if parts else F.lit("{}"))


@kind("ListProfileExpression")
def _(n, s):
    sides = {f"s{k}": text_profile(e, s) for k, e in enumerate(n["expressions"])}
    parts = [x for k in range(len(sides)) for x in (F.lit("," if k else "["), F.col(f"s{k}"))]
    return serial.combine(sides, s.keys, F.concat(*parts, F.lit("]")))


def text_profile(n: dict, s: Scope) -> DataFrame:
    """A profile's values as canonical texts."""
    df = run(n, s)
    if is_real(n):
        df, kind_ = linear.to_numbers(df, s.keys), "double"
    else:
        kind_ = "boolean" if is_windows(n) else None
    return df.withColumn("value", json_values.text_of(F.col("value"), kind_)) if kind_ else df


@kind("AssignGapsExpression")
def _(n, s):
    df, real = profile(n["originalProfile"], s)
    default = run(n["defaultProfile"], s)
    out = serial.assign_gaps(df, default, s.keys)
    return linear.coalesce(out, s.keys) if real else out


@kind("ProfileExpressionShiftBy")
def _(n, s):
    by = duration(n["duration"], s)
    # what lies outside the bounds may be shifted into them
    df, real = profile(n["expression"], replace(s, bounds=(s.bounds[0] - 2 * abs(by), s.bounds[1] + 2 * abs(by)) if s.bounds != iv.FOREVER else s.bounds))
    return linear.shift(df, by) if real else serial.shift(df, by)


@kind("ValueAtExpression")
def _(n, s):
    """The profile's value at the start of the first span, throughout."""
    real = is_real(n["profile"])
    at = run(n["timepoint"], s).groupBy(*s.keys).agg(F.min("lo").alias("__t")).withColumn("__t", F.shiftright("__t", 1))
    hit = run(n["profile"], s).join(at, s.keys).filter(iv.contains_point(F.col("lo"), F.col("hi"), F.col("__t")))
    value = linear.line(F.lit(0), linear.value_at(F.col("value"), F.col("__t")), F.lit(0.0)) if real else F.col("value")
    found = hit.select(*s.keys, value.alias("value"), F.lit(True).alias("__found"))
    return s.key_rows.select(*s.keys).join(found, s.keys, "left").withColumn("__ok", F.when(F.col("__found"), F.lit(True)).otherwise(F.raise_error(F.lit("the profile has no value at that time")).cast("boolean"))).filter("__ok").select(*s.keys, F.lit(iv.FOREVER[0]).alias("lo"), F.lit(iv.FOREVER[1]).alias("hi"), "value")


# --- arithmetic and comparison


@kind("RealProfilePlus")
def _(n, s):
    return linear.plus(as_linear(n["left"], s), as_linear(n["right"], s), s.keys)


@kind("RealProfileTimes")
def _(n, s):
    return linear.scaled(as_linear(n["profile"], s), s.keys, float(n["multiplier"]))


@kind("RealProfileRate")
def _(n, s):
    return linear.rate(as_linear(n["profile"], s), s.keys)


@kind("RealProfileAccumulatedDuration")
def _(n, s):
    unit = duration(n["unit"], s)
    df = run(n["intervalsExpression"], s)
    return accumulate.accumulated_windows(df, s.keys, unit) if is_windows(n["intervalsExpression"]) else accumulate.accumulated_spans(df, s.keys, unit, s.key_rows)


@kind("RealProfileLessThan", "RealProfileLessThanOrEqual", "RealProfileGreaterThan", "RealProfileGreaterThanOrEqual")
def _(n, s):
    op = {"RealProfileLessThan": "<", "RealProfileLessThanOrEqual": "<=", "RealProfileGreaterThan": ">", "RealProfileGreaterThanOrEqual": ">="}[n["kind"]]
    return s.clip(linear.compare(as_linear(n["left"], s), as_linear(n["right"], s), s.keys, op))


@kind("ExpressionEqual", "ExpressionNotEqual")
def _(n, s):
    equal = n["kind"] == "ExpressionEqual"
    if is_real(n["left"]) or is_real(n["right"]):
        return s.clip(linear.compare(as_linear(n["left"], s), as_linear(n["right"], s), s.keys, "==" if equal else "!="))
    both = {"a": run(n["left"], s), "b": run(n["right"], s)}
    return s.clip(serial.combine(both, s.keys, F.col("a") == F.col("b") if equal else F.col("a") != F.col("b")))


@kind("DiscreteProfileTransition")
def _(n, s):
    return s.clip(serial.transition_profile(run(n["profile"], s), s.keys, json_values.canonical(n["from"]), json_values.canonical(n["to"])))


@kind("ProfileChanges")
def _(n, s):
    df, real = profile(n["expression"], s)
    return s.clip(linear.changes(df, s.keys) if real else serial.change_profile(df, s.keys))


# --- windows


@kind("WindowsExpressionAnd", "WindowsExpressionOr")
def _(n, s):
    is_and = n["kind"].endswith("And")
    sides = {"start": s.constant(F.lit(is_and), s.bounds)} | {f"s{k}": s.clip(run(e, s)) for k, e in enumerate(n["expressions"])}
    join = Column.__and__ if is_and else Column.__or__
    return serial.combine(sides, s.keys, reduce(join, [F.col(c) for c in sides]))


@kind("WindowsExpressionNot")
def _(n, s):
    return run(n["expression"], s).withColumn("value", ~F.col("value"))


@kind("WindowsExpressionLongerThan", "WindowsExpressionShorterThan")
def _(n, s):
    us = duration(n["duration"], s)
    df = run(n["windowExpression"], s)
    return serial.falsify_by_duration(df, s.keys, us) if n["kind"].endswith("LongerThan") else serial.falsify_by_duration(df, s.keys, 0, us)


@kind("WindowsExpressionKeepTrueSegment")
def _(n, s):
    return serial.keep_true_segment(run(n["expression"], s), s.keys, int(n["index"]))


@kind("WindowsExpressionFromSpans")
def _(n, s):
    return serial.windows_from_spans(run(n["spansExpression"], s), s.keys, iv.FOREVER, s.key_rows)


def true_on(s: Scope, lo: Column, hi: Column) -> DataFrame:
    spans = s.key_rows.select(*s.keys, lo.alias("lo"), hi.alias("hi"))
    return serial.windows_from_spans(spans, s.keys, s.bounds, s.key_rows)


@kind("WindowsExpressionActivityWindow")
def _(n, s):
    return true_on(s, *s.activity(n["alias"]))


@kind("WindowsExpressionStartOf", "WindowsExpressionEndOf")
def _(n, s):
    lo, hi = s.activity(n["alias"])
    edge = lo if n["kind"].endswith("StartOf") else hi
    at = edge - F.pmod(edge, F.lit(2))
    return true_on(s, at, at + 1)


@kind("SpansExpressionContains")
def _(n, s):
    need = n["requirement"]
    ends = lambda name, f: tuple(f(need[name][k]) if need.get(name, {}).get(k) is not None else None for k in ("min", "max"))
    out = parallel.contains_checked(run(n["parents"], s), run(n["children"], s), s.keys, s.bounds, ends("count", int), ends("duration", lambda d: duration(d, s)))
    # a key without parents has none that is at fault
    rest = s.key_rows.select(*s.keys).join(out.select(*s.keys).distinct(), s.keys, "left_anti")
    return out.unionByName(serial.constant(rest, s.keys, F.lit(True), s.bounds))


# --- spans: rows (keys, lo, hi, id) that may overlap


@kind("SpansExpressionActivitySpan")
def _(n, s):
    lo, hi = s.activity(n["alias"])
    return s.key_rows.select(*s.keys, lo.alias("lo"), hi.alias("hi"), F.col(s.loops[n["alias"]]).alias("id"))


@kind("SpansExpressionInterval")
def _(n, s):
    return s.constant(F.lit(None).cast("long"), interval(n["interval"], s)).withColumnRenamed("value", "id")


@kind("SpansExpressionFromWindows")
def _(n, s):
    return serial.spans_from_windows(run(n["windowsExpression"], s), s.keys, s.bounds).withColumn("id", F.lit(None).cast("long"))


@kind("SpansSelectWhenTrue")
def _(n, s):
    return parallel.select_when_true(run(n["spansExpression"], s), run(n["windowsExpression"], s), s.keys)


@kind("SpansExpressionConnectTo")
def _(n, s):
    found = parallel.connect_to(run(n["from"], s), run(n["to"], s), s.keys, "id", s.bounds)
    return found.select(*s.keys, "lo", "hi", "id")


@kind("SpansExpressionSplit")
def _(n, s):
    df = run(n["intervals"], s)
    spans = serial.spans_from_windows(df, s.keys, s.bounds).withColumn("id", F.lit(None).cast("long")) if is_windows(n["intervals"]) else df
    return serial.split(spans, int(n["numberOfSubIntervals"]), True, n["internalStartInclusivity"] == "Inclusive", n["internalEndInclusivity"] == "Inclusive").drop("piece")


@kind("IntervalsExpressionStarts", "IntervalsExpressionEnds")
def _(n, s):
    df, start = run(n["expression"], s), n["kind"].endswith("Starts")
    if is_windows(n["expression"]):
        return serial.end_points_of(df, s.keys, start)
    return serial.spans_at_starts(df) if start else serial.spans_at_ends(df)


@kind("IntervalsExpressionShiftEdges")
def _(n, s):
    a, b = duration(n["fromStart"], s), duration(n["fromEnd"], s)
    by = 2 * max(abs(a), abs(b))
    wide = replace(s, bounds=(s.bounds[0] - by, s.bounds[1] + by))
    df = run(n["expression"], wide)
    if is_windows(n["expression"]):
        return s.clip(serial.shift_window_edges(df, s.keys, a, b))
    return s.clip(serial.shift_edges(df, a, b))


@kind("ForEachActivitySpans")
def _(n, s):
    inner = s.within(n["alias"], n["activityType"])
    df = run(n["expression"], inner)
    return df.select(*s.keys, "lo", "hi", *(["id"] if "id" in df.columns else [F.lit(None).cast("long").alias("id")]))


# --- violations: rows (keys, windows, ids), and gaps apart


@dataclass(frozen=True)
class Violations:
    """violations: (keys, windows: array of (lo, hi), ids); gaps: (keys, lo, hi) at which the constraint has no value."""

    violations: DataFrame
    gaps: DataFrame

    def merged(self, other: Violations) -> Violations:
        return Violations(self.violations.unionByName(other.violations), self.gaps.unionByName(other.gaps).distinct())


WINDOWS = "array<struct<lo:bigint,hi:bigint>>"


@kind("ViolationsOf")
def _(n, s):
    df = run(n["expression"], s)
    one = F.array(F.struct(F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi")))
    found = df.filter(~F.col("value")).select(*s.keys, one.alias("windows"), F.array().cast("array<bigint>").alias("ids"))
    return Violations(found, serial.complement(df, s.keys, s.bounds, s.key_rows))


@kind("ForEachActivityViolations")
def _(n, s):
    inner = s.within(n["alias"], n["activityType"])
    out = run(n["expression"], inner)
    column = inner.keys[-1]
    return Violations(out.violations.withColumn("ids", F.concat("ids", F.array(column))).drop(column), out.gaps.drop(column).distinct())


@kind("RollingThreshold")
def _(n, s):
    spans = run(n["spans"], s)
    found = accumulate.rolling_threshold(spans, s.keys, duration(n["width"], s), duration(n["threshold"], s), n["algorithm"], s.bounds, "id" if "id" in spans.columns else None, s.key_rows)
    return Violations(found.select(*s.keys, F.col("windows").cast(WINDOWS).alias("windows"), "ids"), spans.select(*s.keys, "lo", "hi").limit(0))


def check(node: dict, results: Results) -> Violations:
    """Violations of a constraint; an expression of windows is violated where it is false."""
    return evaluate(node if not is_windows(node) else {"kind": "ViolationsOf", "expression": node}, results)


# --- violations as timelines give them


def violations_on(df: DataFrame, keys: list[str], value) -> DataFrame:
    """Where a step profile equals a value."""
    return as_violations(df.filter(F.col("value") == F.lit(value)), keys)


def violations_on_real(df: DataFrame, keys: list[str], number: float) -> DataFrame:
    """Where a linear profile equals a number."""
    level = serial.constant(df, keys, linear.line(F.lit(0), F.lit(float(number)), F.lit(0.0)))
    return as_violations(linear.highlight_equal(df, level, keys), keys)


def violations_on_all(df: DataFrame, keys: list[str], id_col: str | None = None) -> DataFrame:
    return as_violations(df, keys, id_col)


def violations_inside(windows: DataFrame, keys: list[str]) -> DataFrame:
    return as_violations(serial.union_of(windows, keys), keys)


def violations_outside(windows: DataFrame, keys: list[str], bounds: tuple[int, int], key_rows: DataFrame | None = None) -> DataFrame:
    return as_violations(serial.complement(windows, keys, bounds, key_rows), keys)


def violations_when_simultaneous(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    both = parallel.simultaneous(left, right, keys, left_id, right_id)
    return both.select(*keys, F.array(F.struct("lo", "hi")).cast(WINDOWS).alias("windows"), "ids")


def as_violations(df: DataFrame, keys: list[str], id_col: str | None = None) -> DataFrame:
    ids = F.array(F.col(id_col).cast("long")) if id_col else F.array()
    return df.select(*keys, F.array(F.struct("lo", "hi")).cast(WINDOWS).alias("windows"), ids.cast("array<bigint>").alias("ids"))


def map_ids(violations: DataFrame, change) -> DataFrame:
    return violations.withColumn("ids", F.transform("ids", change))


def with_default_message(violations: DataFrame, message: str) -> DataFrame:
    own = F.col("message") if "message" in violations.columns else F.lit(None).cast("string")
    return violations.withColumn("message", F.coalesce(own, F.lit(message)))


class GeneratorConstraint:
    """A constraint that collects violations step by step; subclasses call violate in generate."""

    def __init__(self):
        self.parts: list[DataFrame] = []

    def violate(self, violations: DataFrame) -> None:
        self.parts.append(violations)

    def generate(self, results: Results) -> None:
        raise NotImplementedError

    def message(self) -> str | None:
        return None

    def run(self, results: Results) -> DataFrame:
        self.parts = []
        self.generate(results)
        out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), self.parts)
        return with_default_message(out, self.message()) if self.message() is not None else out
