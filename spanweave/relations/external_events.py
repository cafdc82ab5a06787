"""Events of external sources: of a derivation group, a newer source's range replaces what older ones said of it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.operators import parallel


def later_ranges(sources: DataFrame) -> DataFrame:
    """(source_key, derivation_group, lo, hi): what of each source's range no later source of its group covers."""
    ranges = sources.select("derivation_group", "source_key", "valid_at", "lo", "hi")
    pairs = parallel.overlap_join(ranges, ranges, ["derivation_group"]).filter("r_valid_at > l_valid_at")
    cover = pairs.groupBy("derivation_group", F.col("l_source_key").alias("source_key")).agg(F.array_sort(F.collect_list(F.struct(F.col("r_lo").alias("lo"), F.col("r_hi").alias("hi")))).alias("cover"))

    def cut(left, x):
        return F.flatten(F.transform(left, lambda p: iv.minus(p["lo"], p["hi"], x["lo"], x["hi"])))

    start = F.array(F.struct("lo", "hi"))
    rest = F.when(F.col("cover").isNull(), start).otherwise(F.aggregate("cover", start, cut))
    return ranges.join(cover, ["derivation_group", "source_key"], "left").select("derivation_group", "source_key", F.explode(rest).alias("p")).select("derivation_group", "source_key", "p.lo", "p.hi")


def derived_events(events: DataFrame, sources: DataFrame) -> DataFrame:
    """Events (event_key, source_key, derivation_group, lo, ...) whose start no later source of the group covers; of one key those of the newest source.

    sources: (source_key, derivation_group, valid_at, lo, hi), ranges without their ends.
    """
    own = events.join(sources.select("source_key", "derivation_group", F.col("valid_at").alias("__valid"), F.col("lo").alias("__from"), F.col("hi").alias("__to")), ["source_key", "derivation_group"]).filter("__from <= lo AND lo < __to")
    # events of one key and source may start at several times, of which a later source covers some
    points = own.select("derivation_group", F.col("__valid").alias("valid"), "lo", (F.col("lo") + 1).alias("hi")).distinct()
    ranges = sources.select("derivation_group", F.col("valid_at").alias("valid"), "lo", "hi")
    covered = parallel.overlap_join(points, ranges, ["derivation_group"]).filter("r_valid > l_valid").select("derivation_group", F.col("l_valid").alias("__valid"), F.col("l_lo").alias("lo")).distinct()
    valid = own.join(covered, ["derivation_group", "__valid", "lo"], "left_anti")
    rest = [c for c in valid.columns if c not in ("event_key", "derivation_group")]
    # of one source and key the row that comes last in all columns, so that the choice is the same each time
    newest = F.max_by(F.struct(*rest), F.struct("__valid", "source_key", "lo", *[c for c in rest if c not in ("source_key", "lo") and not c.startswith("__")]))
    return valid.groupBy("event_key", "derivation_group").agg(newest.alias("x")).select("event_key", "derivation_group", "x.*").drop("__valid", "__from", "__to")


@dataclass(frozen=True)
class EventQuery:
    """Which events to read; None: no restriction. sources: (key, derivation group) pairs."""

    derivation_groups: list[str] | None = None
    event_types: list[str] | None = None
    sources: list[tuple[str, str]] | None = None

    def apply(self, events: DataFrame) -> DataFrame:
        if self.derivation_groups is not None:
            events = events.filter(F.col("derivation_group").isin(self.derivation_groups))
        if self.event_types is not None:
            events = events.filter(F.col("event_type").isin(self.event_types))
        if self.sources is not None:
            wanted = events.sparkSession.createDataFrame(self.sources, "source_key string, derivation_group string") if self.sources else None
            events = events.join(F.broadcast(wanted), ["source_key", "derivation_group"], "left_semi") if wanted is not None else events.filter("false")
        return events


def by_type(events: DataFrame, *types: str) -> DataFrame:
    return events.filter(F.col("event_type").isin(*types))


def by_source(events: DataFrame, *sources: tuple[str, str]) -> DataFrame:
    return EventQuery(sources=list(sources)).apply(events)


def by_derivation_group(events: DataFrame, *groups: str) -> DataFrame:
    return events.filter(F.col("derivation_group").isin(*groups))


def of_plan(events: DataFrame, plan_groups: DataFrame, plan_id: int, plan_start_us: int) -> DataFrame:
    """Events of the derivation groups that a plan is associated with, in µs from the plan's start; plan_groups: (plan_id, derivation_group)."""
    own = plan_groups.filter(F.col("plan_id") == plan_id).select("derivation_group")
    return events.join(own, "derivation_group", "left_semi").withColumns({"lo": F.col("lo") - 2 * plan_start_us, "hi": F.col("hi") - 2 * plan_start_us})
