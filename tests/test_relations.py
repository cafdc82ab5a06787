"""Plans, anchors, external events, goals and filters on a few rows, with expected values written by hand."""

import pytest

from pyspark.sql import functions as F

from spanweave.relations import anchors, external_events, goals, plans, sequence_filters
from spanweave.scratch import Scratch

ANCHORS = [(1, None, True, 10), (2, 1, True, 5), (3, 2, False, 7), (4, 3, True, 1), (5, 6, True, 1), (6, 5, True, 1), (7, 99, True, 4)]


@pytest.fixture(scope="module")
def directives(quick):
    return quick.createDataFrame(ANCHORS, "id long, anchor_id long, anchored_to_start boolean, offset_us long")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_anchors(quick, directives):
    s = Scratch(quick)
    assert rows(anchors.net_offsets(directives, s).filter("NOT cyclic"), "id", "net_us", "depth") == [(1, 10, 0), (2, 15, 1), (3, 22, 2), (4, 23, 3), (7, 4, 0)]
    assert rows(anchors.cycles(directives, s), "id") == [(5,), (6,)]
    assert sorted(map(tuple, anchors.reduced_offsets(directives.filter("id < 5"), s).select("id", "base_id", "net_us").collect()), key=str) == sorted([(1, None, 10), (2, None, 15), (3, 2, 7), (4, 2, 8)], key=str)
    assert rows(anchors.dependents(directives, quick.createDataFrame([(1,), (3,)], "id long"), s), "root", "id") == [(1, 2), (1, 3), (1, 4), (3, 4)]
    assert rows(anchors.dependents(directives, quick.createDataFrame([(1,)], "id long"), s, through_ends=False), "id") == [(2,)]
    tree = directives.filter("id < 5")
    assert rows(anchors.grounded(tree, quick.createDataFrame([(1, 100), (2, 20), (3, 3)], "id long, duration_us long"), s).fillna(-1), "id", "start_us", "end_us") == [(1, 10, 110), (2, 15, 35), (3, 42, 45), (4, 43, -1)]
    assert rows(anchors.without_early(tree, 12, s), "id") == [] and rows(anchors.without_early(tree, 10, s), "id") == [(1,), (2,), (3,), (4,)]


def test_deleting_anchors(quick, directives):
    s, tree, two = Scratch(quick), directives.filter("id < 5"), quick.createDataFrame([(2,), (3,)], "id long")
    with pytest.raises(ValueError):
        anchors.deleted(tree, two, "error", s)
    assert rows(anchors.deleted(tree, two, "cascade", s), "id") == [(1,)]
    assert rows(anchors.deleted(tree, two, "anchor", s).filter("id = 4"), "anchor_id", "offset_us", "anchored_to_start") == [(1, 13, True)]
    assert rows(anchors.deleted(tree, two, "plan", s).filter("id = 4").withColumn("anchor_id", F.coalesce("anchor_id", F.lit(-1))), "anchor_id", "offset_us") == [(-1, 23)]


def test_merges(quick):
    make = lambda x: quick.createDataFrame(x, "id long, name string")
    base = make([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")])
    supplying = make([(1, "a"), (2, "B"), (4, "D"), (5, "E"), (6, "f")])
    receiving = make([(1, "a"), (2, "b"), (3, "c"), (4, "x"), (5, "E")])
    merge = plans.begin_merge(base, supplying, receiving, ["name"])
    assert rows(merge, "id", "change_type") == [(1, "none"), (2, "modify"), (3, "delete"), (4, "conflict"), (5, "none"), (6, "add")]
    assert rows(plans.conflicts(merge), "id") == [(4,)] and rows(plans.non_conflicting(merge), "id") == [(2,), (3,), (6,)]
    ours, theirs = (plans.with_resolution(merge, all_as=x) for x in ("target", "source"))
    assert rows(plans.commit_merge(receiving, supplying, ours), "id", "name") == [(1, "a"), (2, "B"), (4, "x"), (5, "E"), (6, "f")]
    assert rows(plans.commit_merge(receiving, supplying, theirs), "id", "name") == [(1, "a"), (2, "B"), (4, "D"), (5, "E"), (6, "f")]
    with pytest.raises(Exception, match="resolved"):
        plans.commit_merge(receiving, supplying, plans.with_resolution(merge, make([]).withColumn("resolution", F.lit("source")))).collect()


def test_history_and_snapshots(quick):
    s = Scratch(quick)
    edges = quick.createDataFrame([(4, 2), (4, 3), (3, 1), (2, 1), (5, 3)], "child long, parent long")
    assert rows(plans.ancestors(edges, quick.createDataFrame([(4,)], "id long"), s), "id") == [(1,), (2,), (3,), (4,)]
    assert rows(plans.merge_base(edges, 4, 5, s), "id") == [(3,)] and rows(plans.merge_base(edges, 4, 9, s), "id") == []
    acts = quick.createDataFrame([(1, 10, "a"), (2, 20, "b")], "plan_id long, id long, name string")
    shot = plans.snapshot(acts, 1, 7)
    assert rows(plans.duplicated(acts, 1, 3), "plan_id", "id") == [(1, 10), (2, 20), (3, 10)]
    assert rows(plans.restored(acts.withColumn("name", F.lit("z")), shot, 1, 7), "plan_id", "id", "name") == [(1, 10, "a"), (2, 20, "z")]
    log = quick.createDataFrame([(10, k, f"n{k}") for k in range(14)], "id long, revision long, name string")
    assert rows(plans.next_revision(log), "id", "revision") == [(10, 14)] and len(plans.pruned(log).collect()) == 11
    assert rows(plans.restored_revision(acts, log, 10, 3), "id", "name") == [(10, "n3"), (20, "b")]
    args = quick.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {"a": "5"})], "id long, arguments map<string,string>")
    preset = quick.createDataFrame([(1, {"b": "9", "c": "3"})], "id long, preset_arguments map<string,string>")
    assert {r["id"]: r["arguments"] for r in plans.with_preset(args, preset).collect()} == {1: {"a": "1", "b": "9", "c": "3"}, 2: {"a": "5"}}
    users = plans.users_and_roles(quick.createDataFrame([("u", "r"), ("v", "r")], "username string, default_role string"), quick.createDataFrame([("u", "x"), ("u", "w")], "username string, allowed_role string"))
    assert {r["username"]: r["allowed_roles"] for r in users.collect()} == {"u": ["w", "x"], "v": []}


def test_later_sources_replace_ranges(quick):
    sources = quick.createDataFrame([("s1", "g", 1, 0, 100), ("s2", "g", 2, 50, 80), ("s3", "h", 3, 0, 100)], "source_key string, derivation_group string, valid_at long, lo long, hi long")
    events = quick.createDataFrame([("a", "s1", "g", 10), ("b", "s1", "g", 50), ("c", "s1", "g", 80), ("c", "s2", "g", 79), ("d", "s2", "g", 80), ("a", "s3", "h", 60)], "event_key string, source_key string, derivation_group string, lo long")
    assert rows(external_events.derived_events(events, sources), "event_key", "derivation_group", "source_key", "lo") == [("a", "g", "s1", 10), ("a", "h", "s3", 60), ("c", "g", "s2", 79)]
    # of one key and source an event may be covered and another not
    twice = events.unionByName(quick.createDataFrame([("b", "s1", "g", 90)], events.schema))
    assert rows(external_events.derived_events(twice.filter("event_key = 'b'"), sources), "event_key", "source_key", "lo") == [("b", "s1", 90)]
    assert rows(external_events.later_ranges(sources), "source_key", "lo", "hi") == [("s1", 0, 50), ("s1", 80, 100), ("s2", 50, 80), ("s3", 0, 100)]
    typed = events.withColumn("event_type", F.upper("event_key"))
    assert external_events.EventQuery(["g"], ["A", "C"], [("s1", "g")]).apply(typed).count() == 2 and external_events.EventQuery().apply(typed).count() == 6 and external_events.EventQuery(sources=[]).apply(typed).count() == 0
    assert external_events.by_source(typed, ("s3", "h")).count() == 1 == external_events.by_derivation_group(typed, "h").count() and external_events.by_type(typed, "A", "D").count() == 3


PLAN = [(1, 1, "A", 0, 21, '{"x": {"y": 1}, "l": [1, 2]}'), (1, 2, "A", 100, 121, "{}"), (1, 3, "B", 40, 61, "{}"), (2, 4, "B", 0, 21, "{}")]


def test_goals(quick):
    plan = quick.createDataFrame(PLAN, "k long, id long, type string, lo long, hi long, arguments string")
    keys, bounds = quick.createDataFrame([(1,), (2,)], "k long"), (0, 401)
    assert rows(goals.Template("A", {"x": {"y": 1}, "l": [1]}).find(plan), "id") == [(1,)] and rows(goals.Template("A", {"x": {"y": 1.0}}).find(plan), "id") == []
    assert rows(goals.Template(start=(10, 50), duration=(0, 10)).find(plan), "id") == [(2,), (3,)]
    assert rows(goals.recurrence(plan, ["k"], goals.of_type("A"), 60, 100, bounds, keys), "k", "after_us", "before_us", "kind") == [(1, 0, 50, "too close"), (1, 50, 200, "too far"), (2, 0, 200, "too far")]
    windows = keys.withColumns({"lo": F.lit(0).cast("long"), "hi": F.lit(110).cast("long")})
    assert rows(goals.cardinality(plan, ["k"], goals.of_type("A"), windows, least=1), "k", "n", "missing") == [(2, 0, 1)]
    anchors_ = plan.filter("type = 'A'")
    assert rows(goals.coexistence(plan, ["k"], anchors_, goals.of_type("B"), "end", 0, 15), "anchor_id") == [(2,)]
    owned = quick.createDataFrame([], "id long")
    assert rows(goals.associations(plan, ["k"], anchors_, goals.of_type("B"), owned, "end", 0, 15), "anchor_id", "found_id") == [(1, 3)]
    assert rows(goals.mutex(anchors_, plan.withColumn("lo", F.col("lo") - 30), ["k"], ["B"]), "id") == [(2,)]
    true = quick.createDataFrame([(1, 0, 60, True)], "k long, lo long, hi long, value boolean")
    assert rows(goals.schedule_only_when(anchors_, true, ["k"]), "id") == [(1,)] and rows(goals.narrowed(anchors_, [true], ["k"]), "id", "lo", "hi") == [(1, 0, 21)]
    fill = goals.Goal("fill", lambda p: goals.recurrence_placements(p, ["k"], goals.of_type("A"), 100, 5, bounds, keys), 1)
    solved, added = goals.solve(plan, [fill], ["k"])
    assert goals.recurrence(solved, ["k"], goals.of_type("A"), 0, 100, bounds, keys).count() == 0 and added["fill"].count() == 2
    impossible = goals.Goal("no", fill.placements, 1, rollback=True, unsatisfied=lambda p: p)
    assert goals.solve(plan, [impossible], ["k"])[0].count() == 4
    edit = goals.EditablePlan(plan).create(added["fill"]).delete(plan.filter("id = 1"))
    assert edit.activities.count() == 5 and edit.rollback().activities.count() == 4
    nets = quick.createDataFrame([(1, "a", "b", 1, 2), (1, "b", "c", 1, 2), (1, "a", "c", 5, 9), (2, "a", "b", 1, 2)], "k long, u string, v string, least long, most long")
    assert rows(goals.consistent(nets, ["k"]), "k", "consistent") == [(1, False), (2, True)]
    assert abs(goals.secant_root(lambda x: x**3 - 2, 0, 4) - 2 ** (1 / 3)) < 1e-5 and goals.secant_root(lambda x: x * x + 1, -1, 1) is None
    low, high = goals.tightened((0, 10), (12, 20), (5, 8))["start"]
    assert tuple(quick.range(1).select(low, high).first()) == (4, 10)


def test_sequence_filters(quick):
    acts = quick.createDataFrame([(1, 9, "Turn", 5, '{"deg": 30, "mode": "Fast"}'), (2, 9, "Drive", 7, '{"deg": 5}'), (3, 9, "turnBack", 9, "{}")], "id long, directive_id long, type string, start_us long, arguments string")
    run = lambda spec: [r[0] for r in rows(sequence_filters.sequence_filter(acts, spec), "id")]
    on = lambda **k: {"field": "Parameter", **k}
    assert run({"static_types": ["Drive"], "dynamic_types": [[{"field": "Type", "operator": "includes", "value": "TURN"}]]}) == [1, 2, 3]
    assert run({"others": [on(name="mode", operator="equals", value="fast")]}) == [1] and run({"others": [on(name="deg", operator="is_not_within", value=[0, 10])]}) == [1, 3]
    assert run({"others": [{"field": "Tags", "operator": "equals", "value": "x"}]}) == [] and run({"others": [{"field": "Type", "operator": "includes", "value": ""}]}) == []
    assert run({"subfilters": {"Turn": [on(name="deg", operator="is_less_than", value=10)]}, "time_range": [0, 8]}) == [2]
    assert run({"others": [{"field": "Name", "operator": "does_not_equal", "value": 1}]}) == [2, 3]
    assert rows(sequence_filters.expanded(acts, "{{type}}({{arguments.deg}})@{{id}}", ["type", "id"]), "text") == [("Drive(5)@2",), ("Turn(30)@1",), ("turnBack()@3",)]
    assert rows(sequence_filters.assigned(acts, {"static_types": ["Turn"]}, "s"), "sequence_id", "id") == [("s", 1)]
