"""Operators on parallel timelines: rows with lo and hi that may overlap."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.operators import serial

#: The highest level of bins
LEVELS = 63


def range_join(left: DataFrame, right: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Pairs of overlapping intervals of one key, columns prefixed l_ and r_ (keys as they are).

    Both sides are binned by time and joined by (key, bin), so that a key with
    very many rows spreads over bins; a pair counts in one bin only, that in
    which its overlap begins. For intervals of about one length; a long one
    comes in each bin that it meets.
    """

    def binned(df: DataFrame, prefix: str) -> DataFrame:
        bins = F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))
        return df.filter("lo < hi").select(*keys, F.explode(bins).alias("__bin"), *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys])

    pairs = binned(left, "l_").join(binned(right, "r_"), [*keys, "__bin"])
    first = F.floor(F.greatest("l_lo", "r_lo") / width)
    return pairs.filter((F.col("l_lo") < F.col("r_hi")) & (F.col("r_lo") < F.col("l_hi")) & (F.col("__bin") == first)).drop("__bin")


def level_of(lo: Column, hi: Column) -> Column:
    """The least power of two that is no shorter than an interval; 63, by which all ticks fall in two bins, at most."""
    return F.least(F.lit(LEVELS), F.ceil(F.log2(F.greatest(hi.cast("double") - lo, F.lit(1.0))))).cast("int")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of overlapping intervals of one key, of whatever lengths, columns prefixed l_ and r_ (keys as they are).

    Each interval goes to the two bins or fewer that it meets at the level of
    its own length, and looks up those that it meets at the levels of longer
    ones. Endless intervals are rows like others. Levels that the other side
    lacks are left out, so a side of one length costs two rows an interval.
    """
    present = lambda df: df.filter("lo < hi").select(*keys, level_of(F.col("lo"), F.col("hi")).alias("__level")).distinct()

    def own(df: DataFrame, prefix: str) -> DataFrame:
        return df.filter("lo < hi").withColumn("__level", level_of(F.col("lo"), F.col("hi"))).select(*keys, "__level", *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys])

    def bins(level: Column, lo: Column, hi: Column) -> Column:
        first, last = F.call_function("shiftright", lo, level), F.call_function("shiftright", hi - 1, level)
        return F.explode(F.sequence(first, last))

    def looked_up(df: DataFrame, prefix: str, levels: DataFrame, strictly: bool) -> DataFrame:
        mine = own(df, prefix).withColumnRenamed("__level", "__own")
        above = F.col("__own") < F.col("__level") if strictly else F.col("__own") <= F.col("__level")
        # no more than LEVELS + 1 rows a key on the other side
        return mine.join(levels, keys).filter(above).select("*", bins(F.col("__level"), F.col(f"{prefix}lo"), F.col(f"{prefix}hi")).alias("__bin")).drop("__own")

    def laid(df: DataFrame, prefix: str) -> DataFrame:
        mine = own(df, prefix)
        return mine.select("*", bins(F.col("__level"), F.col(f"{prefix}lo"), F.col(f"{prefix}hi")).alias("__bin"))

    at = [*keys, "__level", "__bin"]
    # the longer one of a pair is laid out, the shorter looks it up; of pairs of one level the left looks up
    up = looked_up(left, "l_", present(right), False).join(laid(right, "r_"), at)
    down = looked_up(right, "r_", present(left), True).join(laid(left, "l_"), at)
    names = [*keys, *[f"l_{c}" for c in left.columns if c not in keys], *[f"r_{c}" for c in right.columns if c not in keys], "__level", "__bin"]
    pairs = up.select(*names).unionByName(down.select(*names))
    first = F.call_function("shiftright", F.greatest("l_lo", "r_lo"), F.col("__level"))
    return pairs.filter((F.col("l_lo") < F.col("r_hi")) & (F.col("r_lo") < F.col("l_hi")) & (F.col("__bin") == first)).drop("__level", "__bin")


def clipped_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with lo and hi of their overlap."""
    return pairs.withColumns({"lo": F.greatest("l_lo", "r_lo"), "hi": F.least("l_hi", "r_hi")})


def delta_sweep(spans: DataFrame, keys: list[str], amount: Column) -> DataFrame:
    """The sum of amount over the spans active at each time: coalesced (keys, lo, hi, value) from the first start to the last end."""
    deltas = F.explode(F.array(F.struct(F.col("lo").alias("t"), F.col("__a").alias("d")), F.struct(F.col("hi").alias("t"), (-F.col("__a")).alias("d"))))
    points = spans.filter("lo < hi").withColumn("__a", amount).select(*keys, deltas.alias("e")).groupBy(*keys, F.col("e.t").alias("t")).agg(F.sum("e.d").alias("d")).filter("d != 0")
    w = Window.partitionBy(*keys).orderBy("t")
    return points.select(*keys, F.col("t").alias("lo"), F.lead("t").over(w).alias("hi"), F.sum("d").over(w).alias("value")).filter("hi IS NOT NULL")


def count_active(spans: DataFrame, keys: list[str], bounds: tuple[int, int], key_rows: DataFrame | None = None) -> DataFrame:
    """How many spans are active at each time within bounds, 0 included; a key of key_rows without spans has 0 throughout."""
    swept = serial.clip(delta_sweep(spans, keys, F.lit(1).cast("long")), bounds)
    rest = serial.complement(swept, keys, bounds, spans if key_rows is None else key_rows).withColumn("value", F.lit(0).cast("long"))
    return serial.coalesce(swept.unionByName(rest), keys)


def active(spans: DataFrame, keys: list[str], bounds: tuple[int, int], key_rows: DataFrame | None = None) -> DataFrame:
    return serial.windows_from_spans(spans, keys, bounds, key_rows)


def as_of_next(left: DataFrame, right: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """Each row of left with the payload and lo of the first row of right that starts at or after its end (to_...; NULL if none)."""
    l = left.select(*keys, F.col("hi").alias("__t"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__l"), F.lit(None).cast("struct<id:bigint,lo:bigint>").alias("__r"))  # noqa: E741
    r = right.select(*keys, F.col("lo").alias("__t"), F.lit(0).alias("__side"), F.lit(None).alias("__l"), F.struct(F.col(payload).cast("long").alias("id"), "lo").alias("__r"))
    # seen from the end, the latest row of right is the first that follows; of rows that start together the smallest payload
    w = Window.partitionBy(*keys).orderBy(F.desc("__t"), "__side", F.desc("__r.id"))
    both = l.unionByName(r.select(*l.columns)).withColumn("__next", F.last("__r", ignorenulls=True).over(w))
    return both.filter("__side = 1").select("__l.*", F.col("__next.id").alias("to_id"), F.col("__next.lo").alias("to_lo"))


def connect_to(left: DataFrame, right: DataFrame, keys: list[str], payload: str, bounds: tuple[int, int] | None = None) -> DataFrame:
    """Rows of left from their end to the start of the next of right, both instants included, or to the end of the bounds; without bounds those that nothing follows go."""
    found = as_of_next(left, right, keys, payload)
    lo = F.col("hi") - F.pmod(F.col("hi"), F.lit(2))
    to = F.col("to_lo") - F.pmod(F.col("to_lo"), F.lit(2)) + 1
    hi = F.coalesce(to, F.lit(bounds[1]).cast("long")) if bounds else to
    return found.withColumns({"lo": lo, "hi": hi}).filter("lo < hi")


def contains_checked(parents: DataFrame, children: DataFrame, keys: list[str], bounds: tuple[int, int], count: tuple[int | None, int | None] = (None, None), duration_us: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """A boolean profile over the bounds that is false on parents with too few or too many children, or too little or much of their time.

    Children count if they lie wholly in the parent; their time counts as far
    as it overlaps the parent, each child's apart.
    """
    rows = parents.select(*keys, "lo", "hi").distinct()
    pairs = overlap_join(rows, children.select(*keys, "lo", "hi"), keys)
    whole = iv.contains(F.col("l_lo"), F.col("l_hi"), F.col("r_lo"), F.col("r_hi"))
    us = iv.duration_us(*iv.intersect(F.col("l_lo"), F.col("l_hi"), F.col("r_lo"), F.col("r_hi")))
    found = pairs.groupBy(*keys, F.col("l_lo").alias("lo"), F.col("l_hi").alias("hi")).agg(F.count_if(whole).alias("n"), F.sum(us).alias("us"))
    joined = rows.join(found, [*keys, "lo", "hi"], "left").withColumns({"n": F.coalesce("n", F.lit(0)), "us": F.coalesce("us", F.lit(0))})
    tests = [F.col(c) < least for c, (least, _) in (("n", count), ("us", duration_us)) if least is not None]
    tests += [F.col(c) > most for c, (_, most) in (("n", count), ("us", duration_us)) if most is not None]
    bad = joined.filter(reduce(Column.__or__, tests)) if tests else joined.limit(0)
    return serial.windows_from_spans(bad, keys, bounds, parents).withColumn("value", ~F.col("value"))


def select_when_true(spans: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """The parts of spans that lie in true windows, with the spans' columns."""
    pairs = clipped_pairs(overlap_join(spans, windows.filter("value").select(*keys, "lo", "hi"), keys))
    return pairs.select(*keys, "lo", "hi", *[F.col(f"l_{c}").alias(c) for c in spans.columns if c not in (*keys, "lo", "hi")])


def filter_by_windows(spans: DataFrame, windows: DataFrame, keys: list[str], truncate: bool = True) -> DataFrame:
    """Rows that meet windows (lo, hi): cut to them, or whole and once."""
    cover = serial.union_of(windows, keys)
    if truncate:
        return select_when_true(spans, cover.withColumn("value", F.lit(True)), keys)
    # whether a row meets one hangs on its key and ends alone; numbers of rows would differ from one reading of spans to the next
    meeting = overlap_join(spans.select(*keys, "lo", "hi").distinct(), cover, keys).select(*keys, F.col("l_lo").alias("lo"), F.col("l_hi").alias("hi")).distinct()
    return spans.join(meeting, [*keys, "lo", "hi"], "left_semi").select(*keys, *[c for c in spans.columns if c not in keys])


def flatten_into_profile(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Segments that may overlap as a serial profile: the later start wins, and what it cuts off doesn't resume."""
    return serial.coalesce_truncating(segments, keys)


def merge(*spans: DataFrame) -> DataFrame:
    """All rows of all."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), spans)


def is_subset(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row, contained: whether each row of left is one of right, as often as it comes."""
    return left.exceptAll(right.select(*left.columns)).agg((F.count(F.lit(1)) == 0).alias("contained"))


def simultaneous(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """(keys, lo, hi, ids) where a row of left and one of right are active together."""
    pairs = clipped_pairs(overlap_join(left, right, keys))
    return pairs.select(*keys, "lo", "hi", F.array(F.col(f"l_{left_id}").cast("long"), F.col(f"r_{right_id}").cast("long")).alias("ids"))
