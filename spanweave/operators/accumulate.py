"""Profiles that add up along time: durations of spans and of true windows, integrals, and their differences over a moving interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.operators import linear, parallel, serial

SECOND = linear.SECOND
ALGORITHMS = ("ExcessSpans", "ExcessHull", "DeficitSpans", "DeficitHull")


def before_this(keys: list[str], order: str = "lo"):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def accumulated_spans(spans: DataFrame, keys: list[str], unit_us: int = SECOND, key_rows: DataFrame | None = None) -> DataFrame:
    """The time of spans so far in units, over all time; spans that overlap count each, instants don't count."""
    real = spans.filter(~iv.is_point(F.col("lo"), F.col("hi")) & (F.col("lo") < F.col("hi")))
    active = parallel.count_active(real, keys, iv.FOREVER, spans if key_rows is None else key_rows)
    ends = lambda c: F.shiftright(c, 1)
    # outside of all spans nothing adds up, so the endless pieces at both ends add no product that overflows
    gain = F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.col("value") * (ends("hi") - ends("lo")) / F.lit(float(unit_us)))
    so_far = F.coalesce(F.sum(gain).over(before_this(keys)), F.lit(0.0))
    t0 = F.when(F.col("value") == 0, F.lit(0)).otherwise(ends("lo"))
    rows = active.withColumn("__v", so_far).select(*keys, "lo", "hi", linear.line(t0, F.col("__v"), F.col("value") * (SECOND / unit_us)).alias("value"))
    return linear.coalesce(rows, keys)


def accumulated_windows(windows: DataFrame, keys: list[str], unit_us: int = SECOND) -> DataFrame:
    """The true time of a boolean profile so far in units; gaps stay gaps."""
    us = iv.duration_us(F.col("lo"), F.col("hi")) / F.lit(float(unit_us))
    so_far = F.coalesce(F.sum(F.when(F.col("value"), us).otherwise(0.0)).over(before_this(keys)), F.lit(0.0))
    rate = F.when(F.col("value") & ~iv.is_point(F.col("lo"), F.col("hi")), F.lit(SECOND / unit_us)).otherwise(F.lit(0.0))
    t0 = F.when(F.col("value"), F.shiftright("lo", 1)).otherwise(F.lit(0))
    rows = windows.withColumn("__v", so_far).select(*keys, "lo", "hi", linear.line(t0, F.col("__v"), rate).alias("value"))
    return linear.coalesce(rows, keys)


def integrate(numbers: DataFrame, keys: list[str], unit_us: int = SECOND) -> DataFrame:
    """The integral so far of a step profile without gaps; a gap is an error."""
    w = serial.by_key(keys, "lo")
    gain = F.col("value") * iv.duration_us(F.col("lo"), F.col("hi")) / F.lit(float(unit_us))
    so_far = F.coalesce(F.sum(gain).over(before_this(keys)), F.lit(0.0))
    whole = F.when(F.lag("hi").over(w) < F.col("lo"), F.raise_error(F.lit("a profile with gaps has no integral")).cast("double")).otherwise(so_far)
    rows = numbers.withColumn("__v", whole).select(*keys, "lo", "hi", linear.line(F.shiftright("lo", 1), F.col("__v"), F.col("value") * (SECOND / unit_us)).alias("value"))
    return linear.coalesce(rows, keys)


def shifted_difference(profile: DataFrame, keys: list[str], range_us: int) -> DataFrame:
    """What a linear profile gains in the range that begins at each time."""
    return linear.minus(linear.shift(profile, -range_us), profile, keys)


def rolling_duration(spans: DataFrame, keys: list[str], range_us: int, unit_us: int = SECOND) -> DataFrame:
    """The time of spans in the range that begins at each time."""
    return shifted_difference(accumulated_spans(spans, keys, unit_us), keys, range_us)


def rolling_true_duration(windows: DataFrame, keys: list[str], range_us: int, unit_us: int = SECOND) -> DataFrame:
    return shifted_difference(accumulated_windows(windows, keys, unit_us), keys, range_us)


def excess(spans: DataFrame, keys: list[str], width_us: int, threshold_us: int, deficit: bool, bounds: tuple[int, int], key_rows: DataFrame) -> DataFrame:
    """(keys, lo, hi): where a range of the width may begin so that spans fill more of it than the threshold, or less."""
    local = shifted_difference(accumulated_spans(spans, keys, threshold_us, key_rows), keys, width_us)
    one = serial.constant(key_rows, keys, linear.line(F.lit(0), F.lit(1.0), F.lit(0.0)))
    found = linear.compare(local, one, keys, "<" if deficit else ">").filter("value").select(*keys, "lo", "hi")
    return serial.clip(found, (bounds[0], bounds[1] - 2 * width_us)) if deficit else found


def rolling_threshold(spans: DataFrame, keys: list[str], width_us: int, threshold_us: int, algorithm: str, bounds: tuple[int, int], id_col: str | None = None, key_rows: DataFrame | None = None) -> DataFrame:
    """(keys, windows, ids): a violation for each stretch in which ranges of the width hold too much of spans, or too little.

    Excess reports the spans that meet the ranges, deficit the time without
    spans; Hull their hull, Spans each. ids: identifiers of the spans, if
    id_col names them.
    """
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm}")
    deficit = algorithm.startswith("Deficit")
    key_rows = (spans if key_rows is None else key_rows).select(*keys).distinct()
    stretches = excess(spans, keys, width_us, threshold_us, deficit, bounds, key_rows)
    reported = serial.complement(spans, keys, bounds, key_rows).withColumn("__id", F.lit(None).cast("long")) if deficit else spans.select(*keys, "lo", "hi", (F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")).alias("__id"))
    wide = stretches.select(*keys, F.col("lo").alias("__at"), "lo", iv.shifted(F.col("hi"), width_us).alias("hi"))
    met = parallel.overlap_join(wide, reported, keys)
    windows = F.array_sort(F.collect_list(F.struct(F.col("r_lo").alias("lo"), F.col("r_hi").alias("hi"))))
    if algorithm.endswith("Hull"):
        windows = F.array(F.struct(F.min("r_lo").alias("lo"), F.max("r_hi").alias("hi")))
    return met.groupBy(*keys, "l___at").agg(windows.alias("windows"), F.array_sort(F.collect_list("r___id")).alias("ids")).drop("l___at")


def reduced(spans: DataFrame, keys: list[str], aggregate) -> DataFrame:
    """A serial profile of aggregate() over the rows that are active at each time; any aggregate of Spark's."""
    ends = spans.filter("lo < hi").select(*keys, F.explode(F.array("lo", "hi")).alias("t")).distinct()
    atoms = ends.select(*keys, F.col("t").alias("lo"), F.lead("t").over(serial.by_key(keys, "t")).alias("hi")).filter("hi IS NOT NULL")
    pairs = parallel.overlap_join(atoms, spans.filter("lo < hi"), keys)
    renamed = pairs.groupBy(*keys, F.col("l_lo").alias("lo"), F.col("l_hi").alias("hi")).agg(aggregate(lambda c: F.col(f"r_{c}")).alias("value"))
    return serial.coalesce(renamed, keys)


def totals_in(windows: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, lo, hi, n, total_us): how many spans lie wholly in each window, and how long they are together."""
    inside = parallel.overlap_join(windows.select(*keys, "lo", "hi"), spans.select(*keys, "lo", "hi"), keys).filter(iv.contains(F.col("l_lo"), F.col("l_hi"), F.col("r_lo"), F.col("r_hi")))
    found = inside.groupBy(*keys, F.col("l_lo").alias("lo"), F.col("l_hi").alias("hi")).agg(F.count(F.lit(1)).alias("n"), F.sum(iv.duration_us(F.col("r_lo"), F.col("r_hi"))).alias("total_us"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return windows.select(*keys, "lo", "hi").distinct().join(found, [*keys, "lo", "hi"], "left").select(*keys, "lo", "hi", zero("n"), zero("total_us"))


def binned(numbers: DataFrame, keys: list[str], thresholds: dict[float, str]) -> DataFrame:
    """The label of the highest threshold at or below each value; none below all of them."""
    label: Column = F.lit(None).cast("string")
    for at in sorted(thresholds):
        label = F.when(F.col("value") >= at, F.lit(thresholds[at])).otherwise(label)
    return serial.map_values(numbers, keys, label)
