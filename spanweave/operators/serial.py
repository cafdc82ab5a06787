"""Operators on serial timelines: rows (keys..., lo, hi, value) that don't overlap within a key.

All are windows or aggregations by key, so one shuffle on the key serves a
chain of them. A gap is a missing row; NULL in a sweep.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.functions.intervals import duration_us


def by_key(keys: list[str], *order: str):
    return Window.partitionBy(*keys).orderBy(*order)


def coalesce(df: DataFrame, keys: list[str], values: list[str] | tuple[str, ...] = ("value",), carry: tuple[str, ...] = ()) -> DataFrame:
    """Joins neighbours that touch and have equal values; columns to carry come from the first of those that join."""
    w = by_key(keys, "lo", "hi")
    same = F.lag("hi").over(w) == F.col("lo")
    for v in values:
        same = same & F.lag(v).over(w).eqNullSafe(F.col(v))
    runs = df.withColumn("__run", F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).over(w))
    return runs.groupBy(*keys, "__run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.first(v).alias(v) for v in values], *[F.min_by(c, "lo").alias(c) for c in carry]).drop("__run")


def coalesce_truncating(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Segments that may overlap as a serial profile: equal ones that touch join, and of different ones the later start cuts the earlier off for good."""
    order = by_key(keys, "lo", "hi", value)
    runs = df.filter("lo < hi").withColumn("__run", F.sum(F.when(F.lag(value).over(order).eqNullSafe(F.col(value)) & (F.row_number().over(order) > 1), 0).otherwise(1)).over(order))
    own = Window.partitionBy(*keys, "__run").orderBy("lo", "hi")
    apart = F.coalesce(F.max("hi").over(own.rowsBetween(Window.unboundedPreceding, -1)) < F.col("lo"), F.lit(True))
    islands = runs.withColumn("__new", apart.cast("int")).withColumn("__island", F.sum("__new").over(own))
    whole = islands.groupBy(*keys, "__run", "__island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first(value).alias(value))
    after = F.lead("lo").over(by_key(keys, "lo", "__run", "__island"))
    return coalesce(whole.withColumn("hi", F.least("hi", after)).filter("lo < hi").drop("__run", "__island"), keys, [value])


def union_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping or touching intervals as one: rows (keys, lo, hi)."""
    before = Window.partitionBy(*keys).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce(F.max("hi").over(before) < F.col("lo"), F.lit(True))
    runs = df.filter("lo < hi").select(*keys, "lo", "hi").withColumn("__new", new.cast("int")).withColumn("__run", F.sum("__new").over(by_key(keys, "lo", "hi").rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "__run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__run")


def edges(df: DataFrame, keys: list[str], side: Column, value: Column) -> DataFrame:
    """(keys, t, side, state) of each segment's two ends: it opens with its value and closes without."""
    opened = F.struct(F.col("lo").alias("t"), F.struct(F.lit(True).alias("open"), value.alias("value")).alias("state"))
    closed = F.struct(F.col("hi").alias("t"), F.struct(F.lit(False).alias("open"), F.when(F.lit(False), value).alias("value")).alias("state"))
    return df.filter("lo < hi").select(*keys, side.alias("side"), F.explode(F.array(opened, closed)).alias("e")).select(*keys, "e.t", "side", "e.state")


def sweep_edges(events: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """Atomic pieces of the sides whose edges these are; an opening beats a closing at one tick."""
    points = events.groupBy(*keys, "t").agg(*[F.max_by(F.when(F.col("side") == n, F.col("state")), F.when(F.col("side") == n, F.col("state.open"))).alias(f"__{n}") for n in names])
    w = by_key(keys, "t")
    held = points.select(*keys, F.col("t").alias("lo"), F.lead("t").over(w).alias("hi"), *[F.last(f"__{n}", ignorenulls=True).over(w).alias(f"__{n}") for n in names])
    return held.filter("hi IS NOT NULL").select(*keys, "lo", "hi", *[F.col(f"__{n}.value").alias(n) for n in names])


def sweep(sides: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Atomic pieces (keys, lo, hi, one column a side) of several serial timelines; NULL where a side has a gap.

    Each segment gives an opening and a closing event; the latest event of a
    side holds until its next. Sides may differ in type.
    """
    kinds = {n: dict(df.dtypes)["value"] for n, df in sides.items()}
    if len(set(kinds.values())) == 1:
        return sweep_edges(reduce(DataFrame.unionByName, (edges(df, keys, F.lit(n), F.col("value")) for n, df in sides.items())), list(sides), keys)
    # values of several types travel in a struct with a field a side
    packed = {n: F.struct(*[(F.col("value") if m == n else F.lit(None).cast(kinds[m])).alias(m) for m in sides]) for n in sides}
    events = reduce(DataFrame.unionByName, (edges(df, keys, F.lit(n), packed[n]) for n, df in sides.items()))
    out = sweep_edges(events, list(sides), keys)
    return out.select(*keys, "lo", "hi", *[F.col(f"{n}.{n}").alias(n) for n in sides])


def sweep_of_parts(df: DataFrame, keys: list[str], side: str, names: list[str]) -> DataFrame:
    """A sweep of the timelines that one table holds, told apart by the column side; the table is read once."""
    return sweep_edges(edges(df, keys, F.col(side), F.col("value")), names, keys)


def combine(sides: dict[str, DataFrame], keys: list[str], value: Column) -> DataFrame:
    """A sweep's value, without gaps, coalesced. The sides needn't be coalesced themselves."""
    return valued(sweep(sides, keys), keys, value)


def valued(swept: DataFrame, keys: list[str], value: Column) -> DataFrame:
    return coalesce(swept.select(*keys, "lo", "hi", value.alias("value")).filter("value IS NOT NULL"), keys, ["value"])


def flat_combine(sides: dict[str, DataFrame], keys: list[str], pieces: Column) -> DataFrame:
    """Like combine, where each atomic piece gives an array of (lo, hi, value), cut off at its ends."""
    cut = sweep(sides, keys).select(*keys, F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.explode(pieces).alias("p"))
    clipped = cut.select(*keys, F.greatest("__lo", "p.lo").alias("lo"), F.least("__hi", "p.hi").alias("hi"), F.col("p.value").alias("value"))
    return coalesce(clipped.filter("lo < hi AND value IS NOT NULL"), keys)


def map_values(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Another value a segment; segments without one become gaps."""
    return coalesce(df.withColumn("value", value).filter("value IS NOT NULL"), keys)


# --- bounds and gaps


def clip(df: DataFrame, bounds: tuple[int, int]) -> DataFrame:
    """What lies within bounds: reaches the scan as a filter on lo and hi."""
    low, high = bounds
    inside = df.filter((F.col("lo") < high) & (F.col("hi") > low) & (F.col("lo") < F.col("hi")))
    return inside.withColumns({"lo": F.greatest("lo", F.lit(low)), "hi": F.least("hi", F.lit(high))})


def constant(key_rows: DataFrame, keys: list[str], value: Column, bounds: tuple[int, int] = iv.FOREVER) -> DataFrame:
    """One segment a key; literal intervals and values."""
    return key_rows.select(*keys).distinct().select(*keys, F.lit(bounds[0]).cast("long").alias("lo"), F.lit(bounds[1]).cast("long").alias("hi"), value.alias("value"))


def complement(df: DataFrame, keys: list[str], bounds: tuple[int, int], key_rows: DataFrame | None = None) -> DataFrame:
    """What intervals, which may overlap, leave of the bounds; all of them for a key of key_rows that has none."""
    low, high = (F.lit(b).cast("long") for b in bounds)
    edges_of_bounds = (df if key_rows is None else key_rows).select(*keys).distinct()
    # an empty interval at either end of the bounds stands for what lies outside
    walls = edges_of_bounds.select(*keys, F.explode(F.array(F.struct(low.alias("lo"), low.alias("hi")), F.struct(high.alias("lo"), high.alias("hi")))).alias("w")).select(*keys, "w.lo", "w.hi")
    rows = clip(df.select(*keys, "lo", "hi"), bounds).unionByName(walls)
    reach = F.max("hi").over(by_key(keys, "lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    return rows.select(*keys, reach.alias("lo"), F.col("lo").alias("hi")).filter("lo < hi")


def unset(df: DataFrame, lo: int, hi: int) -> DataFrame:
    """Without an interval; segments that hold it split."""
    rest = F.explode(iv.minus(F.col("lo"), F.col("hi"), F.lit(lo).cast("long"), F.lit(hi).cast("long")))
    return df.withColumn("__rest", rest).withColumns({"lo": F.col("__rest.lo"), "hi": F.col("__rest.hi")}).drop("__rest")


def overlay(layers: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Segments that may overlap, the one of the highest order on top; what it covers resumes after it. A null value covers too and leaves a gap."""
    ends = layers.filter("lo < hi").select(*keys, F.explode(F.array("lo", "hi")).alias("t")).distinct()
    atoms = ends.select(*keys, F.col("t").alias("a"), F.lead("t").over(by_key(keys, "t")).alias("b")).filter("b IS NOT NULL")
    # each segment meets the atoms that it covers: atoms that begin in it
    held = layers.filter("lo < hi").join(atoms, keys).filter("lo <= a AND b <= hi")
    top = held.groupBy(*keys, F.col("a").alias("lo"), F.col("b").alias("hi")).agg(F.max_by("value", order).alias("value"))
    return coalesce(top.filter("value IS NOT NULL"), keys)


def set_over(df: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new where it is defined, df elsewhere."""
    return combine({"a": df, "b": new}, keys, F.coalesce("b", "a"))


def assign_gaps(df: DataFrame, default: DataFrame, keys: list[str]) -> DataFrame:
    return combine({"a": df, "b": default}, keys, F.coalesce("a", "b"))


def zip_disjoint(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Two profiles of which no more than one is defined at a time; an error otherwise."""
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return combine({"a": left, "b": right}, keys, F.when(both, F.raise_error(F.lit("both profiles are defined at a time")).cast(dict(left.dtypes)["value"])).otherwise(F.coalesce("a", "b")))


# --- durations and places in a sequence


def longer_than(df: DataFrame, us: int) -> DataFrame:
    return df.filter(duration_us(F.col("lo"), F.col("hi")) >= us)


def shorter_than(df: DataFrame, us: int) -> DataFrame:
    return df.filter(duration_us(F.col("lo"), F.col("hi")) <= us)


def filter_by_duration(df: DataFrame, least_us: int = 0, most_us: int = iv.MAX_US) -> DataFrame:
    """Segments (intervals, spans) of a duration in a range; others go."""
    if least_us > most_us:
        raise ValueError("the least duration is above the most")
    return df.filter(duration_us(F.col("lo"), F.col("hi")).between(least_us, most_us))


def falsify_by_duration(df: DataFrame, keys: list[str], least_us: int = 0, most_us: int = iv.MAX_US) -> DataFrame:
    """True segments of a boolean profile become false unless their duration is in a range."""
    if least_us > most_us:
        raise ValueError("the least duration is above the most")
    return coalesce(df.withColumn("value", F.col("value") & duration_us(F.col("lo"), F.col("hi")).between(least_us, most_us)), keys)


def nth(keys: list[str], n: int, among: Column | None = None) -> Column:
    """Whether a row is the n-th of its key from 0, from the end if n is negative; among: of the rows for which it holds."""
    group = [*keys] if among is None else [*keys, among]
    order = F.row_number().over(Window.partitionBy(*group).orderBy("lo" if n >= 0 else F.desc("lo")))
    return order == (n + 1 if n >= 0 else -n)


def keep_nth(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The n-th segment of each key from 0; from the end if n is negative."""
    return df.withColumn("__n", nth(keys, n)).filter("__n").drop("__n")


def keep_true_segment(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """All true segments of a boolean profile but the n-th become false."""
    return coalesce(df.withColumn("value", F.col("value") & nth(keys, n, F.col("value"))), keys)


def remove_true_segment(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The n-th true segment of a boolean profile becomes false."""
    return coalesce(df.withColumn("value", F.col("value") & ~nth(keys, n, F.col("value"))), keys)


def true_points(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, first, last) tick of a boolean profile's true time, last exclusive."""
    return df.filter("value").groupBy(*keys).agg(F.min("lo").alias("first"), F.max("hi").alias("last"))


def true_within(df: DataFrame, keys: list[str], bounds: tuple[int, int], key_rows: DataFrame | None = None) -> DataFrame:
    """True on the true segments that lie wholly in bounds, false elsewhere in them."""
    low, high = bounds
    return windows_from_spans(df.filter("value").filter((F.col("lo") >= low) & (F.col("hi") <= high)), keys, bounds, df if key_rows is None else key_rows)


def uncovered(inner: DataFrame, outer: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, lo, hi) where inner is true and outer isn't: outer includes inner where there is none."""
    pieces = sweep({"a": inner, "b": outer}, keys).filter("a AND NOT coalesce(b, false)")
    return union_of(pieces, keys)


# --- conversions


def windows_from_spans(spans: DataFrame, keys: list[str], bounds: tuple[int, int], key_rows: DataFrame | None = None) -> DataFrame:
    """A boolean profile over the bounds: true on spans, false elsewhere; a key of key_rows without spans is false throughout."""
    true = clip(union_of(spans, keys), bounds).withColumn("value", F.lit(True))
    false = complement(true, keys, bounds, spans if key_rows is None else key_rows).withColumn("value", F.lit(False))
    return true.unionByName(false)


def spans_from_windows(df: DataFrame, keys: list[str], bounds: tuple[int, int]) -> DataFrame:
    """The true segments within bounds; an error if the profile has a gap there."""
    inside = clip(df, bounds)
    w = Window.partitionBy(*keys)
    covered = F.sum(F.col("hi") - F.col("lo")).over(w) == bounds[1] - bounds[0]
    checked = inside.withColumn("__ok", F.when(covered, F.lit(True)).otherwise(F.raise_error(F.lit("windows have a gap within the bounds")).cast("boolean")))
    return checked.filter("__ok AND value").select(*keys, "lo", "hi")


# --- neighbours


def shift(df: DataFrame, by_us: int) -> DataFrame:
    return df.withColumns({"lo": iv.shifted(F.col("lo"), by_us), "hi": iv.shifted(F.col("hi"), by_us)})


def shift_edges(df: DataFrame, start_us: int, end_us: int) -> DataFrame:
    """Spans with their ends moved; those that vanish go."""
    return df.withColumns({"lo": iv.shifted(F.col("lo"), start_us), "hi": iv.shifted(F.col("hi"), end_us)}).filter("lo < hi")


def shift_window_edges(df: DataFrame, keys: list[str], rising_us: int, falling_us: int) -> DataFrame:
    """A boolean profile whose rising and falling edges move; a false segment's ends move by the mirrored pair, and what begins later is on top."""
    ends = lambda a, b: F.when(F.col("value"), F.lit(a).cast("long")).otherwise(F.lit(b).cast("long"))
    moved = df.withColumn("__rank", F.row_number().over(by_key(keys, "lo"))).withColumns({"lo": iv.shifted(F.col("lo"), ends(rising_us, falling_us)), "hi": iv.shifted(F.col("hi"), ends(falling_us, rising_us))})
    return overlay(moved.filter("lo < hi"), keys, "__rank")


def changes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Instants at which a coalesced profile takes another value without a gap: (keys, lo, before, after)."""
    w = by_key(keys, "lo")
    return df.select(*keys, "lo", F.when(F.lag("hi").over(w) == F.col("lo"), F.lag("value").over(w)).alias("before"), F.col("value").alias("after")).filter("before IS NOT NULL AND after != before")


def detect_edges(df: DataFrame, keys: list[str], at_edge, inside: Column | None = None) -> DataFrame:
    """A boolean profile of a coalesced one: at_edge(before, after) at the instant at which a segment begins or ends, inside (false) within.

    Where a gap or the profile's end adjoins, that side is NULL to at_edge, and
    a NULL answer is a gap. A segment's first instant belongs to the segment
    if its start is inclusive; an edge whose instant lies after it is that of
    its neighbour.
    """
    w = by_key(keys, "lo")
    joins_before, joins_after = F.lag("hi").over(w) == F.col("lo"), F.lead("lo").over(w) == F.col("hi")
    rows = df.select(*keys, "lo", "hi", "value", F.when(joins_before, F.lag("value").over(w)).alias("__before"), F.when(joins_after, F.lead("value").over(w)).alias("__after"))
    value, before, after = F.col("value"), F.col("__before"), F.col("__after")
    within = F.lit(False) if inside is None else inside
    # the instant of an edge at tick e: [e, e + 1) if e is even, [e - 1, e) if odd
    first, last = F.pmod(F.col("lo"), F.lit(2)) == 0, F.pmod(F.col("hi"), F.lit(2)) == 1
    point = (F.col("hi") == F.col("lo") + 1) & first
    a, b = F.when(first, F.col("lo") + 1).otherwise(F.col("lo")), F.when(last, F.col("hi") - 1).otherwise(F.col("hi"))
    piece = lambda lo, hi, v: F.struct(lo.alias("lo"), hi.alias("hi"), v.cast("boolean").alias("value"))
    start, end = at_edge(before, value), at_edge(value, after)
    both = F.coalesce(start | end, start, end)  # of an instant either neighbour may tell
    none = F.array().cast("array<struct<lo:bigint,hi:bigint,value:boolean>>")
    pieces = F.when(point, F.array(piece(F.col("lo"), F.col("hi"), both))).otherwise(
        F.concat(F.when(first, F.array(piece(F.col("lo"), a, start))).otherwise(none), F.array(piece(a, b, within)), F.when(last, F.array(piece(b, F.col("hi"), end))).otherwise(none))
    )
    out = rows.select(*keys, F.explode(pieces).alias("p")).select(*keys, "p.lo", "p.hi", "p.value")
    return coalesce(out.filter("lo < hi AND value IS NOT NULL"), keys)


def change_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """True at the instants at which the value changes, false elsewhere; a segment's first instant is unknown after a gap."""
    return edge_profile(df, keys, lambda before, after: after != before)


def transition_profile(df: DataFrame, keys: list[str], old, new) -> DataFrame:
    """True at the instants at which the value goes from old to new, false elsewhere; unknown after a gap if the value is new there."""
    return edge_profile(df, keys, lambda before, after: (before == F.lit(old)) & (after == F.lit(new)))


HEADS = "array<struct<lo:bigint,hi:bigint,value:boolean,top:int>>"


def head_at(edge: Column, value: Column) -> Column:
    """The instant of an edge: that of an exclusive start, or of an inclusive end, is the tick before it."""
    at = edge - F.pmod(edge, F.lit(2))
    return F.struct(at.alias("lo"), (at + 1).alias("hi"), value.cast("boolean").alias("value"), F.lit(1).alias("top"))


def edge_profile(df: DataFrame, keys: list[str], test, body: Column | None = None) -> DataFrame:
    """body (false) within segments, true at the first instants for which test(before, after) holds.

    After a gap before is NULL; an answer of NULL there leaves a gap, unless
    the segment begins with time itself.
    """
    w = by_key(keys, "lo")
    before = F.when(F.lag("hi").over(w) == F.col("lo"), F.lag("value").over(w))
    endless = F.col("lo") <= iv.FOREVER[0]
    rows = df.select(*keys, "lo", "hi", (F.lit(False) if body is None else body).alias("__body"), F.when(endless, F.lit(False)).otherwise(test(before, F.col("value"))).alias("__edge"))
    inner = F.struct("lo", "hi", F.col("__body").alias("value"), F.lit(0).alias("top"))
    head = F.col("__edge") | (F.col("__edge").isNull() & (F.pmod(F.col("lo"), F.lit(2)) == 0))
    layers = F.concat(F.array(inner), F.when(head, F.array(head_at(F.col("lo"), F.col("__edge")))).otherwise(F.array().cast(HEADS)))
    return on_top(rows.select(*keys, F.explode(layers).alias("p")).select(*keys, "p.*"), keys)


def on_top(layers: DataFrame, keys: list[str]) -> DataFrame:
    """Disjoint bodies (top 0) with disjoint heads (top 1) on them; a head without value cuts a gap."""
    event = lambda edge, is_open: F.struct(F.col(edge).alias("t"), F.col("top").alias("top"), F.struct(F.lit(is_open).alias("open"), (F.col("value") if is_open else F.lit(None).cast("boolean")).alias("value")).alias("state"))
    events = layers.select(*keys, F.explode(F.array(event("lo", True), event("hi", False))).alias("e")).select(*keys, "e.*")
    points = events.groupBy(*keys, "t").agg(*[F.max_by(F.when(F.col("top") == k, F.col("state")), F.when(F.col("top") == k, F.col("state.open"))).alias(f"__{k}") for k in (0, 1)])
    w = by_key(keys, "t")
    held = points.select(*keys, F.col("t").alias("lo"), F.lead("t").over(w).alias("hi"), *[F.last(f"__{k}", ignorenulls=True).over(w).alias(f"__{k}") for k in (0, 1)])
    value = F.when(F.col("__1.open"), F.col("__1.value")).otherwise(F.col("__0.value"))
    return coalesce(held.filter("hi IS NOT NULL").select(*keys, "lo", "hi", value.alias("value")).filter("value IS NOT NULL"), keys)


def start_points(df: DataFrame, keys: list[str]) -> DataFrame:
    """A boolean profile that is true at true segments' first instants only; unknown there after a gap."""
    return end_points_of(df, keys, True)


def end_points(df: DataFrame, keys: list[str]) -> DataFrame:
    """A boolean profile that is true at true segments' last instants only; unknown there before a gap."""
    return end_points_of(df, keys, False)


def end_points_of(df: DataFrame, keys: list[str], start: bool) -> DataFrame:
    w = by_key(keys, "lo")
    joins = F.lag("hi").over(w) == F.col("lo") if start else F.lead("lo").over(w) == F.col("hi")
    edge = F.col("lo") if start else F.col("hi")
    endless = edge <= iv.FOREVER[0] if start else edge >= iv.FOREVER[1]
    known = F.when(F.coalesce(joins, F.lit(False)), F.lit(True)).when(endless, F.lit(False))
    rows = df.select(*keys, "lo", "hi", "value", known.alias("__known"))
    inner = F.struct("lo", "hi", F.lit(False).alias("value"), F.lit(0).alias("top"))
    layers = F.when(F.col("value"), F.array(inner, head_at(edge, F.col("__known")))).otherwise(F.array(inner))
    return on_top(rows.select(*keys, F.explode(layers).alias("p")).select(*keys, "p.*"), keys)


def spans_at_starts(df: DataFrame) -> DataFrame:
    """Spans (rows with lo, hi) cut down to their first instant; an exclusive start counts as its instant."""
    lo = F.col("lo") - F.pmod(F.col("lo"), F.lit(2))
    return df.withColumns({"lo": lo, "hi": lo + 1})


def spans_at_ends(df: DataFrame) -> DataFrame:
    lo = F.col("hi") - F.pmod(F.col("hi"), F.lit(2))
    return df.withColumns({"lo": lo, "hi": lo + 1})


def split(df: DataFrame, pieces: int, strict: bool = False, inner_start_inclusive: bool = True, inner_end_inclusive: bool = False) -> DataFrame:
    """Each interval in equal pieces of whole µs, the rest in the last: adds piece (from 0).

    strict: instants, endless intervals and those of fewer µs than pieces are errors.
    """
    if strict:
        us = duration_us(F.col("lo"), F.col("hi"))
        why = F.when(F.col("hi") <= F.col("lo") + 1, "an instant can't be split").when((F.col("lo") <= iv.FOREVER[0]) | (F.col("hi") >= iv.FOREVER[1] - 1), "an endless interval can't be split").when(us < pieces, "an interval is too short to be split")
        df = df.withColumn("lo", F.when(why.isNull() | F.lit(pieces == 1), F.col("lo")).otherwise(F.raise_error(why).cast("long")))
    width = F.floor(duration_us(F.col("lo"), F.col("hi")) / pieces).cast("long")
    cut = df.withColumn("__w", width).withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    at = lambda k: F.shiftright("lo", 1) * 2 + 2 * k * F.col("__w")
    lo = F.when(F.col("piece") == 0, F.col("lo")).otherwise(at(F.col("piece")) + (0 if inner_start_inclusive else 1))
    hi = F.when(F.col("piece") == pieces - 1, F.col("hi")).otherwise(at(F.col("piece") + 1) + (1 if inner_end_inclusive else 0))
    return cut.withColumns({"__lo": lo, "__hi": hi}).drop("lo", "hi", "__w").withColumnsRenamed({"__lo": "lo", "__hi": "hi"})
