"""Anchored activities: each starts some µs after its anchor's start or end, or after the plan's start.

Trees are walked by pointer jumping: every round doubles how far each row has
looked, as a written table, so a chain of n anchors takes about log2(n) rounds
of one join, whatever its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.scratch import Scratch


def jumped(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, top, net_us, depth, cyclic) from (id, anchor_id, offset_us): the sum of offsets up to a row without anchor, or that hasn't its anchor in the table.

    Rows on a cycle, or above which there is one, are cyclic; their other columns are null.
    """
    here = rows.select("id", F.col("anchor_id").alias("at"), F.col("offset_us").cast("long").alias("net_us"), F.lit(0).cast("long").alias("depth"))
    known = rows.select(F.col("id").alias("at"), F.lit(True).alias("__known"))
    now = scratch.save(here.join(known, "at", "left").select("id", F.when(F.col("__known"), F.col("at")).alias("at"), F.col("id").alias("top"), "net_us", "depth"))
    left, most = now.filter("at IS NOT NULL").count(), None
    rounds = 0
    most = max(1, now.count().bit_length())
    while left and rounds <= most:
        up = now.select(F.col("id").alias("at"), F.col("at").alias("__at"), F.col("top").alias("__top"), F.col("net_us").alias("__net"), F.col("depth").alias("__depth"))
        step = now.join(up, "at", "left")
        gone = F.col("__top").isNotNull()
        new = scratch.save(step.select("id", F.when(gone, F.col("__at")).alias("at"), F.when(gone, F.col("__top")).otherwise(F.col("top")).alias("top"), F.when(gone, F.col("net_us") + F.col("__net")).otherwise(F.col("net_us")).alias("net_us"), F.when(gone, F.col("depth") + F.col("__depth") + 1).otherwise(F.col("depth")).alias("depth")))
        scratch.drop(now)
        now, rounds = new, rounds + 1
        left = now.filter("at IS NOT NULL").count()
    # what still has a way to go after as many doublings as there are rows goes round in circles
    cyclic = F.col("at").isNotNull()
    unless = lambda c: F.when(~cyclic, F.col(c)).alias(c)
    return now.select("id", unless("top"), unless("net_us"), unless("depth"), cyclic.alias("cyclic"))


def net_offsets(directives: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, top, net_us, depth, cyclic): from the plan's start, where anchors count by their starts."""
    return jumped(directives, scratch)


def reduced_offsets(directives: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, base_id, net_us): from the end of the nearest ancestor by whose end something on the way is anchored, or from the plan's start (base_id NULL)."""
    by_start = directives.withColumns({"anchor_id": F.when(F.col("anchored_to_start"), F.col("anchor_id"))})
    out = jumped(by_start, scratch)
    base = directives.filter("NOT anchored_to_start AND anchor_id IS NOT NULL").select(F.col("id").alias("top"), F.col("anchor_id").alias("base_id"))
    return out.filter("NOT cyclic").join(base, "top", "left").select("id", "base_id", "net_us")


def dependents(directives: DataFrame, roots: DataFrame, scratch: Scratch, through_ends: bool = True) -> DataFrame:
    """(root, id) of all that is anchored to each root (id), directly or not; through_ends False stops at what is anchored to an end."""
    steps = directives.filter("anchor_id IS NOT NULL").select(F.col("anchor_id").alias("at"), F.col("id").alias("child"), "anchored_to_start")
    found = new = scratch.save(roots.select(F.col("id").alias("root"), "id").distinct())
    while not new.isEmpty():
        step = new.join(steps, new["id"] == steps["at"]).select("root", F.col("child").alias("id"), "anchored_to_start")
        step = step if through_ends else step.filter("anchored_to_start")
        new = scratch.save(step.select("root", "id").distinct().join(found, ["root", "id"], "left_anti"))
        found = found.unionByName(new)
    return found.filter("root <> id")


def cycles(directives: DataFrame, scratch: Scratch) -> DataFrame:
    """(id) of activities whose anchors lead round in a circle."""
    return jumped(directives.withColumn("offset_us", F.lit(0)), scratch).filter("cyclic").select("id")


def deleted(directives: DataFrame, ids: DataFrame, strategy: str, scratch: Scratch) -> DataFrame:
    """Directives without some (id). error: refuse if others are anchored to them; cascade: these go too; plan: they are anchored to the plan; anchor: to the deleted one's anchor."""
    gone = ids.select("id").distinct()
    hang = directives.join(gone, "id", "left_anti").join(gone.select(F.col("id").alias("anchor_id")), "anchor_id", "left_semi")
    if strategy == "error":
        if not hang.isEmpty():
            raise ValueError("other activities are anchored to those to delete")
        return directives.join(gone, "id", "left_anti")
    if strategy == "cascade":
        below = dependents(directives, gone, scratch).select("id").distinct()
        return directives.join(gone.unionByName(below).distinct(), "id", "left_anti")
    if strategy == "plan":
        nets = net_offsets(directives, scratch).select("id", "net_us")
        moved = directives.join(gone, "id", "left_anti").join(gone.select(F.col("id").alias("anchor_id"), F.lit(True).alias("__gone")), "anchor_id", "left").join(nets, "id")
        return moved.select(*[F.when(F.col("__gone"), x).otherwise(F.col(c)).alias(c) if (x := {"anchor_id": F.lit(None).cast("long"), "offset_us": F.col("net_us"), "anchored_to_start": F.lit(True)}.get(c)) is not None else F.col(c) for c in directives.columns])
    if strategy == "anchor":
        # within the deleted ones, up to the first that stays
        inside = directives.join(gone, "id", "left_semi")
        way = jumped(inside, scratch).filter("NOT cyclic").select(F.col("id").alias("anchor_id"), "top", "net_us")
        above = inside.select(F.col("id").alias("top"), F.col("anchor_id").alias("__above"), F.col("anchored_to_start").alias("__by_start"))
        moved = directives.join(gone, "id", "left_anti").join(way.join(above, "top"), "anchor_id", "left")
        hit = F.col("top").isNotNull()
        new = {"anchor_id": F.when(hit, F.col("__above")).otherwise(F.col("anchor_id")), "offset_us": F.when(hit, F.col("offset_us") + F.col("net_us")).otherwise(F.col("offset_us")), "anchored_to_start": F.when(hit, F.coalesce("__by_start", F.lit(True))).otherwise(F.col("anchored_to_start"))}
        return moved.select(*[new[c].alias(c) if c in new else F.col(c) for c in directives.columns])
    raise ValueError(f"unknown strategy {strategy}")


def without_early(directives: DataFrame, earliest_us: int, scratch: Scratch) -> DataFrame:
    """Directives without those that start before an instant, and without what is anchored to these."""
    early = net_offsets(directives, scratch).filter(F.col("net_us") < earliest_us).select("id")
    below = dependents(directives, early, scratch).select("id")
    return directives.join(early.unionByName(below).distinct(), "id", "left_anti")


def grounded(directives: DataFrame, durations: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, start_us, end_us) from the plan's start; durations: (id, duration_us). What is anchored to something of unknown duration has no times."""
    joined = directives.join(durations.select("id", "duration_us"), "id", "left")
    ends = joined.select(F.col("id").alias("anchor_id"), F.col("duration_us").alias("__d"))
    # an offset from an end is one from the start, further by the duration; an unknown one is told apart by a flag that adds up
    far = joined.join(ends, "anchor_id", "left").withColumn("__add", F.when(F.col("anchored_to_start") | F.col("anchor_id").isNull(), F.lit(0)).otherwise(F.col("__d")))
    unknown = jumped(far.select("id", "anchor_id", F.col("__add").isNull().cast("long").alias("offset_us")), scratch).select("id", F.col("net_us").alias("__unknown"))
    nets = jumped(far.select("id", "anchor_id", (F.col("offset_us") + F.coalesce("__add", F.lit(0))).alias("offset_us")), scratch)
    start = F.when(F.col("__unknown") == 0, F.col("net_us"))
    return nets.filter("NOT cyclic").join(unknown, "id").join(joined.select("id", "duration_us"), "id").select("id", start.alias("start_us"), (start + F.col("duration_us")).alias("end_us"))
