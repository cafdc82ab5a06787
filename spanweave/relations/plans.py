"""Plans and their history as tables: snapshots, three-way merges, presets, changelogs, tags, model compatibility.

Activities are rows (plan_id, id, ...); a change makes new rows, nothing is updated in place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.scratch import Scratch


def payload(columns: list[str]) -> Column:
    return F.struct(*columns)


def changes(before: DataFrame, after: DataFrame, columns: list[str], name: str) -> DataFrame:
    """(id, <name>, <name>_row): none, add, delete or modify of each activity on the way from one snapshot to another."""
    b = before.select("id", payload(columns).alias("__b"))
    a = after.select("id", payload(columns).alias(f"{name}_row"), F.lit(True).alias("__in"))
    joined = b.join(a, "id", "full")
    kind = F.when(F.col("__b").isNull(), "add").when(F.col("__in").isNull(), "delete").when(F.col("__b").eqNullSafe(F.col(f"{name}_row")), "none").otherwise("modify")
    return joined.select("id", kind.alias(name), f"{name}_row")


def begin_merge(base: DataFrame, supplying: DataFrame, receiving: DataFrame, columns: list[str]) -> DataFrame:
    """(id, change_type, supplying, receiving): what merging the supplying plan into the receiving one does to each activity.

    change_type is none, add, modify, delete or conflict; supplying and
    receiving say what either did since the merge base. Changes of both sides
    that end alike are none.
    """
    sides = changes(base, supplying, columns, "supplying").join(changes(base, receiving, columns, "receiving"), "id", "full")
    s, r = F.coalesce("supplying", F.lit("none")), F.coalesce("receiving", F.lit("none"))
    alike = (s == r) & F.col("supplying_row").eqNullSafe(F.col("receiving_row"))
    change = F.when((s == "none") | alike, "none").when(r == "none", s).otherwise("conflict")
    return sides.select("id", change.alias("change_type"), s.alias("supplying"), r.alias("receiving"))


def conflicts(merge: DataFrame) -> DataFrame:
    return merge.filter("change_type = 'conflict'")


def non_conflicting(merge: DataFrame) -> DataFrame:
    return merge.filter("change_type <> 'conflict' AND change_type <> 'none'")


def with_resolution(merge: DataFrame, resolutions: DataFrame | None = None, all_as: str | None = None) -> DataFrame:
    """merge with resolution (none, source, target) of its conflicts, by rows (id, resolution) or all alike."""
    if all_as is not None:
        return merge.withColumn("resolution", F.when(F.col("change_type") == "conflict", F.lit(all_as)))
    return merge.join(resolutions.select("id", "resolution"), "id", "left").withColumn("resolution", F.when(F.col("change_type") == "conflict", F.coalesce("resolution", F.lit("none"))))


def commit_merge(receiving: DataFrame, supplying: DataFrame, resolved: DataFrame) -> DataFrame:
    """The receiving plan's activities after a merge; a conflict without resolution is an error."""
    open_ = (F.col("change_type") == "conflict") & F.coalesce(F.col("resolution"), F.lit("none")).eqNullSafe("none")
    take = F.when(open_, F.raise_error(F.lit("a conflict isn't resolved")).cast("boolean")).otherwise(F.col("change_type").isin("add", "modify", "delete") | (F.col("resolution") == "source"))
    taken = resolved.filter(F.coalesce(take, F.lit(False))).select("id")
    kept = receiving.join(taken, "id", "left_anti")
    return kept.unionByName(supplying.join(taken, "id", "left_semi").withColumn("plan_id", F.lit(None).cast("long")).drop("plan_id") if "plan_id" not in receiving.columns else moved(supplying.join(taken, "id", "left_semi"), receiving))


def moved(rows: DataFrame, into: DataFrame) -> DataFrame:
    """Rows with the plan of another table, which holds one plan."""
    plan = into.agg(F.first("plan_id").alias("plan_id"))
    return rows.drop("plan_id").crossJoin(F.broadcast(plan)).select(*into.columns)


def snapshot(activities: DataFrame, plan_id: int, snapshot_id: int) -> DataFrame:
    """A plan's activities as rows of a snapshot."""
    return activities.filter(F.col("plan_id") == plan_id).drop("plan_id").withColumn("snapshot_id", F.lit(snapshot_id).cast("long"))


def restored(activities: DataFrame, snapshots: DataFrame, plan_id: int, snapshot_id: int) -> DataFrame:
    """All plans' activities, where one plan's are replaced by a snapshot's."""
    back = snapshots.filter(F.col("snapshot_id") == snapshot_id).drop("snapshot_id").withColumn("plan_id", F.lit(plan_id).cast("long"))
    return activities.filter(F.col("plan_id") != plan_id).unionByName(back.select(*activities.columns))


def duplicated(activities: DataFrame, plan_id: int, new_plan_id: int) -> DataFrame:
    return activities.unionByName(activities.filter(F.col("plan_id") == plan_id).withColumn("plan_id", F.lit(new_plan_id).cast(activities.schema["plan_id"].dataType)))


# --- changelogs


def next_revision(changelog: DataFrame) -> DataFrame:
    """(id, revision) that each activity's next change gets, from 0."""
    return changelog.groupBy("id").agg((F.coalesce(F.max("revision"), F.lit(-1)) + 1).alias("revision"))


def pruned(changelog: DataFrame, keep: int = 11) -> DataFrame:
    """The latest revisions of each activity."""
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("revision")))
    return changelog.withColumn("__r", rank).filter(F.col("__r") <= keep).drop("__r")


def restored_revision(activities: DataFrame, changelog: DataFrame, activity_id: int, revision: int) -> DataFrame:
    """Activities, one of which takes its fields from a revision."""
    fields = [c for c in activities.columns if c in changelog.columns and c not in ("plan_id", "id")]
    own = changelog.filter((F.col("id") == activity_id) & (F.col("revision") == revision)).select("id", F.struct(*fields).alias("__then"))
    joined = activities.join(F.broadcast(own), "id", "left")
    return joined.select(*[F.when(F.col("__then").isNotNull(), F.col(f"__then.{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in activities.columns])


def with_preset(activities: DataFrame, presets: DataFrame) -> DataFrame:
    """Arguments (maps) with those of each activity's preset on top; presets: (id, preset_arguments)."""
    joined = activities.join(presets.select("id", "preset_arguments"), "id", "left")
    own = F.when(F.col("preset_arguments").isNull(), F.col("arguments")).otherwise(F.map_concat(F.map_filter("arguments", lambda k, _: ~F.array_contains(F.map_keys("preset_arguments"), k)), F.col("preset_arguments")))
    return joined.withColumn("arguments", own).drop("preset_arguments")


def tag_ids(tags: DataFrame) -> DataFrame:
    """(id, tag_ids) sorted."""
    return tags.groupBy("id").agg(F.array_sort(F.collect_set("tag_id")).alias("tag_ids"))


def tags_json(tags: DataFrame) -> DataFrame:
    """(id, tags): a JSON list of each activity's tags (tag_id, name, color) by identifier."""
    return tags.groupBy("id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("tag_id", "name", "color")))).alias("tags"))


def users_and_roles(users: DataFrame, roles: DataFrame) -> DataFrame:
    """(username, default_role, allowed_roles) of all users, with an empty list where there are none."""
    return users.join(roles, "username", "left").groupBy("username", "default_role").agg(F.array_sort(F.collect_set("allowed_role")).alias("allowed_roles"))


def map_of(rows: DataFrame, keys: list[str], name: str, value: str) -> DataFrame:
    """(keys, map) of name to value."""
    return rows.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, value)))).alias("map"))


# --- history: edges (child, parent), which form a graph without cycles


def reachable(edges: DataFrame, starts: DataFrame, scratch: Scratch) -> DataFrame:
    """(start, id) for every node that can be reached from each start (id), itself included.

    A written table a round, each of which only follows what the last one
    found new; as many rounds as the longest path.
    """
    found = scratch.save(starts.select(F.col("id").alias("start"), "id").distinct())
    new = found
    while not new.isEmpty():
        step = new.join(edges.select(F.col("child").alias("id"), "parent"), "id").select("start", F.col("parent").alias("id")).distinct()
        new = scratch.save(step.join(found, ["start", "id"], "left_anti"))
        found = found.unionByName(new)
    return found


def ancestors(edges: DataFrame, starts: DataFrame, scratch: Scratch) -> DataFrame:
    return reachable(edges, starts, scratch)


def merge_base(edges: DataFrame, first: int, second: int, scratch: Scratch) -> DataFrame:
    """(id) of the latest snapshot that both come from: the largest identifier; no row if there is none."""
    spark = edges.sparkSession
    both = reachable(edges, spark.createDataFrame([(first,), (second,)], "id long"), scratch)
    shared = both.filter(F.col("start") == first).select("id").intersect(both.filter(F.col("start") == second).select("id"))
    return shared.agg(F.max("id").alias("id")).filter("id IS NOT NULL")


# --- compatibility of a plan with another model


def removed_types(old: DataFrame, new: DataFrame) -> DataFrame:
    """(name) of the activity types that the new model lacks."""
    return old.select("name").join(new.select("name"), "name", "left_anti")


def modified_types(old: DataFrame, new: DataFrame) -> DataFrame:
    """(name, old_parameters, new_parameters) of types whose parameters differ."""
    return old.select("name", F.col("parameters").alias("old_parameters")).join(new.select("name", F.col("parameters").alias("new_parameters")), "name").filter(~F.col("old_parameters").eqNullSafe(F.col("new_parameters")))


def impacted(activities: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """Activities of types that are removed or modified."""
    names = removed_types(old, new).unionByName(modified_types(old, new).select("name"))
    return activities.join(names, activities["type"] == names["name"], "left_semi")


# --- views


def simulated_activities(spans: DataFrame, datasets: DataFrame) -> DataFrame:
    """Spans with the directive that caused them and absolute times; datasets: (dataset_id, plan_id, simulation_start)."""
    joined = spans.join(datasets, "dataset_id")
    start = F.unix_micros("simulation_start") + F.col("start_us")
    return joined.select("dataset_id", "plan_id", F.col("span_id").alias("id"), "parent_id", F.get_json_object("attributes", "$.directiveId").cast("long").alias("directive_id"), "type", F.timestamp_micros(start).alias("start_time"), F.timestamp_micros(start + F.col("duration_us")).alias("end_time"), "duration_us")


def extended_directives(activities: DataFrame, presets: DataFrame, net_offsets: DataFrame, plans: DataFrame) -> DataFrame:
    """Directives with their preset and the approximate absolute start; plans: (plan_id, plan_start)."""
    return (
        activities.join(presets.select("id", "preset_id", "preset_name"), "id", "left")
        .join(net_offsets.select("id", "net_us"), "id", "left")
        .join(plans, "plan_id")
        .withColumn("approximate_start_time", F.timestamp_micros(F.unix_micros("plan_start") + F.col("net_us")))
    )


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of each key that comes last, for lookups of cached results."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__r")).select(*keys, "__r.*")


def all_of(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
