"""Scheduling goals as conflict queries over activities (keys, id, type, lo, hi, arguments), and a greedy solver over them."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.functions import json_values
from spanweave.operators import accumulate, parallel, sequences, serial


@dataclass(frozen=True)
class Template:
    """Which activities match: of a type, with arguments that hold a pattern, in ranges of µs."""

    type: str | None = None
    arguments: dict | None = None
    start: tuple[int, int] | None = None
    end: tuple[int, int] | None = None
    duration: tuple[int, int] | None = None

    def test(self) -> Column:
        out = F.lit(True) if self.type is None else F.col("type") == self.type
        if self.arguments is not None:
            out = out & json_values.matches(self.arguments, F.col("arguments"))
        for limits, value in ((self.start, F.shiftright("lo", 1)), (self.end, F.shiftright("hi", 1)), (self.duration, iv.duration_us(F.col("lo"), F.col("hi")))):
            if limits is not None:
                out = out & value.between(*limits)
        return out

    def find(self, plan: DataFrame) -> DataFrame:
        return plan.filter(self.test())


def of_type(name: str) -> Template:
    return Template(type=name)


def recurrence(plan: DataFrame, keys: list[str], template: Template, least_us: int, most_us: int, bounds: tuple[int, int], key_rows: DataFrame) -> DataFrame:
    """(keys, after_us, before_us): stretches from one start to the next, and from the bounds to the first and last, that are longer than the most; starts closer than the least are conflicts too (kind)."""
    starts = template.find(plan).select(*keys, F.shiftright("lo", 1).alias("t"), F.lit(0).alias("edge"))
    ends = F.explode(F.array(*[F.struct(F.lit(b >> 1).alias("t"), F.lit(e).alias("edge")) for b, e in zip(bounds, (-1, 1), strict=True)]))
    edges = key_rows.select(*keys).distinct().select(*keys, ends.alias("b")).select(*keys, "b.t", "b.edge")
    w = Window.partitionBy(*keys).orderBy("t", "edge")
    rows = starts.unionByName(edges).select(*keys, F.lag("t").over(w).alias("after_us"), F.col("t").alias("before_us"), ((F.lag("edge").over(w) != 0) | (F.col("edge") != 0)).alias("edge"))
    gap = F.col("before_us") - F.col("after_us")
    kind = F.when(gap > most_us, "too far").when(~F.col("edge") & (gap < least_us), "too close")
    return rows.withColumn("kind", kind).filter("kind IS NOT NULL").drop("edge")


def cardinality(plan: DataFrame, keys: list[str], template: Template, windows: DataFrame, least: int = 0, most: int | None = None, least_us: int = 0, most_us: int | None = None) -> DataFrame:
    """(keys, lo, hi, n, total_us, missing, missing_us): windows in which too few or too many activities lie, or too little or much of their time."""
    totals = accumulate.totals_in(windows, template.find(plan), keys)
    out = totals.withColumns({"missing": F.greatest(F.lit(0), F.lit(least) - F.col("n")).cast("long"), "missing_us": F.greatest(F.lit(0), F.lit(least_us) - F.col("total_us")).cast("long")})
    bad = (F.col("missing") > 0) | (F.col("missing_us") > 0)
    bad = bad if most is None else bad | (F.col("n") > most)
    return out.filter(bad if most_us is None else bad | (F.col("total_us") > most_us))


def timed(lo: Column, hi: Column, anchor: str, least_us: int, most_us: int | None) -> tuple[Column, Column]:
    """The range of starts that a timing constraint allows: some µs from an anchor's start or end."""
    return sequences.relative(lo, hi, anchor, least_us, most_us)


def coexistence(plan: DataFrame, keys: list[str], anchors: DataFrame, template: Template, anchor: str = "start", least_us: int = 0, most_us: int | None = None) -> DataFrame:
    """Rows of anchors (keys, id, lo, hi) in whose range of starts no activity of the template starts: missing template."""
    low, high = timed(F.col("lo"), F.col("hi"), anchor, least_us, most_us)
    ranges = anchors.select(*keys, F.col("id").alias("anchor_id"), low.alias("lo"), high.alias("hi"))
    starts = template.find(plan).select(*keys, F.col("id").alias("found_id"), F.col("lo"), (F.col("lo") + 1).alias("hi"))
    met = parallel.overlap_join(ranges, starts, keys).select(*keys, F.col("l_anchor_id").alias("anchor_id")).distinct()
    return ranges.join(met, [*keys, "anchor_id"], "left_anti")


def associations(plan: DataFrame, keys: list[str], anchors: DataFrame, template: Template, owned: DataFrame, anchor: str = "start", least_us: int = 0, most_us: int | None = None) -> DataFrame:
    """(keys, anchor_id, found_id) where activities would do, but none of them (id) is owned by the goal: missing association."""
    low, high = timed(F.col("lo"), F.col("hi"), anchor, least_us, most_us)
    ranges = anchors.select(*keys, F.col("id").alias("anchor_id"), low.alias("lo"), high.alias("hi"))
    starts = template.find(plan).select(*keys, F.col("id").alias("found_id"), F.col("lo"), (F.col("lo") + 1).alias("hi"))
    met = parallel.overlap_join(ranges, starts, keys).select(*keys, F.col("l_anchor_id").alias("anchor_id"), F.col("r_found_id").alias("found_id"))
    mine = met.join(owned.select(F.col("id").alias("found_id"), F.lit(True).alias("__own")), "found_id", "left")
    return mine.groupBy(*keys, "anchor_id").agg(F.min("found_id").alias("found_id"), F.max("__own").alias("__own")).filter("__own IS NULL").drop("__own")


def narrowed(windows: DataFrame, profiles: list[DataFrame], keys: list[str]) -> DataFrame:
    """Windows (keys, lo, hi) cut to where all boolean profiles are true: of resource constraints, of global conditions."""
    for p in profiles:
        windows = parallel.select_when_true(windows, p, keys)
    return windows


def schedule_only_when(placements: DataFrame, condition: DataFrame, keys: list[str]) -> DataFrame:
    """Placements (keys, lo, hi, ...) that lie wholly where a condition is true."""
    cover = condition.filter("value").select(*keys, "lo", "hi")
    return sequences.always_satisfied(placements, cover.withColumn("value", F.lit(True)), keys)


def mutex(placements: DataFrame, plan: DataFrame, keys: list[str], types: list[str]) -> DataFrame:
    """Placements that no activity of the types overlaps."""
    busy = plan.filter(F.col("type").isin(types)).select(*keys, "lo", "hi")
    hit = parallel.overlap_join(placements.select(*keys, "lo", "hi"), busy, keys).select(*keys, F.col("l_lo").alias("lo"), F.col("l_hi").alias("hi")).distinct()
    return placements.join(hit, [*keys, "lo", "hi"], "left_anti")


def tightened(start: tuple, end: tuple, duration: tuple) -> dict[str, tuple]:
    """Ranges (least, most; columns or numbers as columns) of one activity's start, end and duration, made consistent."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    (s0, s1), (e0, e1), (d0, d1) = ((lit(a), lit(b)) for a, b in (start, end, duration))
    return {
        "start": (F.greatest(s0, e0 - d1), F.least(s1, e1 - d0)),
        "end": (F.greatest(e0, s0 + d0), F.least(e1, s1 + d1)),
        "duration": (F.greatest(d0, e0 - s1), F.least(d1, e1 - s0)),
    }


def consistent(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, consistent): whether temporal networks (keys, u, v, least, most: least <= v - u <= most) have a solution; a network's edges are one group."""
    schema = ", ".join([*(f"`{k}` {dict(edges.dtypes)[k]}" for k in keys), "consistent boolean"])

    def relaxed(pdf):
        import pandas as pd

        arcs = [(r.u, r.v, r.most) for r in pdf.itertuples()] + [(r.v, r.u, -r.least) for r in pdf.itertuples()]
        far = dict.fromkeys({x for a in arcs for x in a[:2]}, 0)
        fine = False
        for _ in range(len(far) + 1):
            fine = True
            for a, b, w in arcs:
                if far[a] + w < far[b]:
                    far[b], fine = far[a] + w, False
            if fine:
                break
        return pd.DataFrame([(*(pdf[k].iloc[0] for k in keys), fine)], columns=[*keys, "consistent"])

    return edges.groupBy(*keys).applyInPandas(relaxed, schema)


def secant_root(function, low: float, high: float, tolerance: float = 1e-6, steps: int = 100) -> float | None:
    """A root of a function of a number between two bounds, or None: a secant that falls back on halving."""
    a, b, fa, fb = low, high, function(low), function(high)
    if abs(fa) <= tolerance:
        return a
    if abs(fb) <= tolerance:
        return b
    if fa * fb > 0:
        return None
    for _ in range(steps):
        c = b - fb * (b - a) / (fb - fa)
        if not min(a, b) < c < max(a, b):
            c = (a + b) / 2
        fc = function(c)
        if abs(fc) <= tolerance:
            return c
        if fa * fc < 0:
            # the end that stays loses weight, so that it doesn't stay for ever
            fa, b, fb = fa / 2 if fb * fc > 0 else fa, c, fc
        else:
            a, fa, fb = c, fc, fb / 2 if fa * fc > 0 else fb
    return (a + b) / 2


# --- goals that compose, and plans that are edited


@dataclass(frozen=True)
class Goal:
    """placements(plan): activities to add (keys, id, type, lo, hi, arguments), none if it is satisfied."""

    name: str
    placements: object
    priority: int = 0
    only_when: DataFrame | None = None
    rollback: bool = False
    unsatisfied: object = None

    def apply_when(self, windows: DataFrame) -> Goal:
        """The goal where a boolean profile is true only."""
        return replace(self, only_when=windows)

    def should_rollback_if_unsatisfied(self, value: bool = True) -> Goal:
        return replace(self, rollback=value)


def every_goal(name: str, *goals: Goal, priority: int = 0) -> Goal:
    """All of several goals, one after the other."""

    def placements(plan):
        out = None
        for g in goals:
            more = g.placements(plan if out is None else plan.unionByName(out))
            out = more if out is None else out.unionByName(more)
        return out

    return Goal(name, placements, priority)


def first_goal(name: str, *goals: Goal, priority: int = 0) -> Goal:
    """The first of several goals that can be satisfied."""

    def placements(plan):
        for g in goals:
            more = g.placements(plan)
            if g.unsatisfied is None or g.unsatisfied(plan.unionByName(more)).isEmpty():
                return more
        return goals[-1].placements(plan).limit(0)

    return Goal(name, placements, priority)


def solve(plan: DataFrame, goals: list[Goal], keys: list[str], conditions: list[DataFrame] = ()) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The plan with each goal's placements, by priority, and these by goal. Loops over goals, which a user writes; rows stay distributed."""
    added = {}
    for g in sorted(goals, key=lambda g: g.priority):
        new = g.placements(plan)
        for condition in [*conditions, *([g.only_when] if g.only_when is not None else [])]:
            new = schedule_only_when(new, condition, keys)
        after = plan.unionByName(new.select(*plan.columns))
        if g.rollback and g.unsatisfied is not None and not g.unsatisfied(after).isEmpty():
            new = new.limit(0)
            after = plan
        plan, added[g.name] = after, new
    return plan, added


@dataclass
class EditablePlan:
    """A plan whose edits can be rolled back: each version is a DataFrame."""

    activities: DataFrame
    committed: DataFrame = None
    edits: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.committed = self.activities if self.committed is None else self.committed

    def create(self, rows: DataFrame) -> EditablePlan:
        self.activities = self.activities.unionByName(rows.select(*self.activities.columns))
        self.edits.append("create")
        return self

    def delete(self, ids: DataFrame) -> EditablePlan:
        self.activities = self.activities.join(ids.select("id").distinct(), "id", "left_anti").select(*self.activities.columns)
        self.edits.append("delete")
        return self

    def commit(self) -> EditablePlan:
        self.committed, self.edits = self.activities, []
        return self

    def rollback(self) -> EditablePlan:
        self.activities, self.edits = self.committed, []
        return self


def without_output_of(plan: DataFrame, made: DataFrame, goal: str) -> DataFrame:
    """A plan without what a goal made before; made: (goal, id)."""
    return plan.join(made.filter(F.col("goal") == goal).select("id").distinct(), "id", "left_anti").select(*plan.columns)


def recurrence_placements(plan: DataFrame, keys: list[str], template: Template, most_us: int, duration_us: int, bounds: tuple[int, int], key_rows: DataFrame) -> DataFrame:
    """Activities that fill the stretches that are too long, evenly and as few as do."""
    gaps = recurrence(plan, keys, template, 0, most_us, bounds, key_rows).filter("kind = 'too far'")
    gap = F.col("before_us") - F.col("after_us")
    n = F.ceil(gap / most_us) - 1
    at = gaps.withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), n))).withColumn("__t", (F.col("after_us") + F.floor(gap * F.col("__k") / (n + 1))).cast("long"))
    return at.select(*keys, F.xxhash64(*keys, "__t").alias("id"), F.lit(template.type).alias("type"), (F.col("__t") * 2).alias("lo"), (F.col("__t") * 2 + 2 * duration_us + 1).alias("hi"), F.lit("{}").alias("arguments"))


def conjunction(tests: list[Column]) -> Column:
    return reduce(Column.__and__, tests, F.lit(True))


def windows_of(plan: DataFrame, keys: list[str], template: Template) -> DataFrame:
    return serial.union_of(template.find(plan), keys)
