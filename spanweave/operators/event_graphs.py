"""Graphs of concurrent and sequential effects, flattened to rows with causal tags; spans of activities from simulation events.

A graph is None (nothing), an atom (any value in an Atom), or a Seq or Par of
two graphs. Its rows carry a tag, a list of numbers: sequential neighbours
count on at even depths, concurrent branches begin odd ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.scratch import Scratch


@dataclass(frozen=True)
class Atom:
    value: object


@dataclass(frozen=True)
class Seq:
    left: object
    right: object


@dataclass(frozen=True)
class Par:
    left: object
    right: object


def parts(graph, kind) -> list:
    """A chain of one kind as a list."""
    out, todo = [], [graph]
    while todo:
        g = todo.pop()
        if isinstance(g, kind):
            todo += [g.right, g.left]
        elif g is not None:
            out.append(g)
    return out


def flattened(graph, tag: tuple = ()) -> list[tuple[tuple, object]]:
    """(tag, value) of each atom."""
    out = []
    for k, step in enumerate(parts(graph, Seq), 1):
        if isinstance(step, Atom):
            out.append(((*tag, k), step.value))
        else:
            for j, branch in enumerate(parts(step, Par), 1):
                out += flattened(branch, (*tag, k, j))
    return out


def unflattened(rows: list[tuple[tuple, object]]):
    """The graph of (tag, value) rows."""
    steps: dict = {}
    for tag, value in rows:
        steps.setdefault(tag[0], []).append((tag[1:], value))
    out = None
    for k in sorted(steps):
        own = steps[k]
        if own[0][0] == ():
            step = Atom(own[0][1])
        else:
            branches: dict = {}
            for tag, value in own:
                branches.setdefault(tag[0], []).append((tag[1:], value))
            step = None
            for j in sorted(branches):
                branch = unflattened(branches[j])
                step = branch if step is None else Par(step, branch)
        out = step if out is None else Seq(out, step)
    return out


def tag_text(tag: tuple) -> str:
    return "".join(f".{k}" for k in tag)


def conflicting(effects: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, t, conflicted) of effects (keys, t, tag, value) on a register: whether concurrent branches of one instant set different values."""
    step = F.get("tag", 0)
    branch = F.when(F.size("tag") > 1, F.slice("tag", 1, 2)).otherwise(F.array(step))
    sets = effects.groupBy(*keys, "t", step.alias("__step")).agg(F.count_distinct(branch).alias("__b"), F.count_distinct("value").alias("__v"))
    return sets.groupBy(*keys, "t").agg(F.max((F.col("__b") > 1) & (F.col("__v") > 1)).alias("conflicted"))


def next_jobs(jobs: DataFrame, keys: list[str]) -> DataFrame:
    """The jobs (keys, t, ...) of each key's earliest time."""
    first = jobs.groupBy(*keys).agg(F.min("t").alias("t"))
    return jobs.join(first, [*keys, "t"], "left_semi")


def activity_spans(spans: DataFrame, scratch: Scratch) -> DataFrame:
    """Spans (span_id, parent_id, type or NULL for a span that isn't an activity, start_us, end_us) that are activities, with the nearest ancestor that is one, and whether they have finished."""
    inner = spans.filter("type IS NULL").select("span_id", "parent_id")
    now = scratch.save(spans.filter("type IS NOT NULL").withColumn("at", F.col("parent_id")))
    while True:
        up = inner.select(F.col("span_id").alias("at"), F.col("parent_id").alias("__up"), F.lit(True).alias("__inner"))
        step = scratch.save(now.join(up, "at", "left").withColumn("at", F.when(F.col("__inner"), F.col("__up")).otherwise(F.col("at"))).select(*now.columns, F.coalesce("__inner", F.lit(False)).alias("__moved")))
        if step.filter("__moved").isEmpty():
            return step.drop("parent_id", "__moved").withColumnRenamed("at", "parent_id").withColumns({"finished": F.col("end_us").isNotNull(), "duration_us": F.col("end_us") - F.col("start_us")})
        now = step.drop("__moved")
