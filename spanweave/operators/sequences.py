"""Filters and transforms of the ordered windows (keys..., lo, hi) of each key, as a scheduler's goals use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.operators import parallel, serial


def gap_before(keys: list[str]) -> Column:
    """µs from the end of the window before; NULL for the first."""
    return F.shiftright("lo", 1) - F.shiftright(F.lag("hi").over(serial.by_key(keys, "lo")), 1)


def gap_after(keys: list[str]) -> Column:
    return F.shiftright(F.lead("lo").over(serial.by_key(keys, "lo")), 1) - F.shiftright("hi", 1)


def kept(df: DataFrame, test: Column) -> DataFrame:
    return df.withColumn("__keep", test).filter("__keep").drop("__keep")


def element(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The n-th window from 0 (first), from the end if n is negative (last)."""
    return serial.keep_nth(df, keys, n)


def min_gap_before(df: DataFrame, keys: list[str], us: int) -> DataFrame:
    """Windows that begin that long after the one before, and the first."""
    gap = gap_before(keys)
    return kept(df, gap.isNull() | (gap >= us))


def max_gap_before(df: DataFrame, keys: list[str], us: int) -> DataFrame:
    """Windows that begin no longer than that after the one before; the first isn't one."""
    return kept(df, F.coalesce(gap_before(keys) <= us, F.lit(False)))


def min_gap_after(df: DataFrame, keys: list[str], us: int) -> DataFrame:
    """Windows that end that long before the next one, and the last."""
    gap = gap_after(keys)
    return kept(df, gap.isNull() | (gap >= us))


def max_gap_after(df: DataFrame, keys: list[str], us: int) -> DataFrame:
    """Windows that end no longer than that before the next one; the last isn't one."""
    return kept(df, F.coalesce(gap_after(keys) <= us, F.lit(False)))


def min_duration(df: DataFrame, us: int) -> DataFrame:
    return serial.longer_than(df, us)


def max_duration(df: DataFrame, us: int) -> DataFrame:
    return serial.shorter_than(df, us)


def functional(df: DataFrame, test: Column) -> DataFrame:
    """Windows for which an expression over their columns holds."""
    return df.filter(test)


def always_satisfied(df: DataFrame, expression: DataFrame, keys: list[str]) -> DataFrame:
    """Windows in which a boolean profile is true throughout."""
    return df.join(covered(df, expression.filter("value"), keys).filter("__us >= hi - lo").select(*keys, "lo", "hi"), [*keys, "lo", "hi"], "left_semi")


def ever_violated(df: DataFrame, expression: DataFrame, keys: list[str]) -> DataFrame:
    """Windows in which a boolean profile is false at some time, or undefined."""
    return df.join(covered(df, expression.filter("value"), keys).filter("__us >= hi - lo").select(*keys, "lo", "hi"), [*keys, "lo", "hi"], "left_anti")


def covered(df: DataFrame, cover: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, lo, hi, __us) of windows that meet the cover: the ticks of it in them."""
    pairs = parallel.overlap_join(df.select(*keys, "lo", "hi").distinct(), serial.union_of(cover, keys), keys)
    ticks = F.least("l_hi", "r_hi") - F.greatest("l_lo", "r_lo")
    return pairs.groupBy(*keys, F.col("l_lo").alias("lo"), F.col("l_hi").alias("hi")).agg(F.sum(ticks).alias("__us"))


def latching(df: DataFrame, keys: list[str], first: Column, rest: Column) -> DataFrame:
    """The first window of a key for which first holds, and of those after it the ones for which rest holds."""
    at = F.min(F.when(first, F.col("lo"))).over(Window.partitionBy(*keys))
    return kept(df, (F.col("lo") == at) | ((F.col("lo") > at) & rest))


def within_each(df: DataFrame, resets: DataFrame, keys: list[str]) -> DataFrame:
    """The parts of windows in each reset window, with reset, which tells these apart: filters take [*keys, "reset"] as keys then."""
    pairs = parallel.clipped_pairs(parallel.overlap_join(df.select(*keys, "lo", "hi"), resets.select(*keys, "lo", "hi", F.col("lo").alias("reset")), keys))
    return pairs.select(*keys, F.col("r_reset").alias("reset"), "lo", "hi")


def without_resets(df: DataFrame, keys: list[str]) -> DataFrame:
    return serial.union_of(df.select(*keys, "lo", "hi"), keys)


def after_each(df: DataFrame, keys: list[str], delay_us: int = 0, bounds: tuple[int, int] = iv.FOREVER) -> DataFrame:
    """The gaps that follow windows, moved by a delay."""
    gaps = serial.complement(df, keys, bounds)
    first = F.min("lo").over(Window.partitionBy(*keys))
    after = kept(gaps, (F.col("lo") != bounds[0]) | (first != bounds[0]))
    return serial.clip(serial.shift(after, delay_us), bounds)


def before_each(df: DataFrame, keys: list[str], delay_us: int = 0, bounds: tuple[int, int] = iv.FOREVER) -> DataFrame:
    """The gaps that windows end, moved by a delay."""
    gaps = serial.complement(df, keys, bounds)
    return serial.clip(serial.shift(gaps.filter(F.col("hi") != bounds[1]), delay_us), bounds)


def envelope(df: DataFrame, resets: DataFrame, keys: list[str]) -> DataFrame:
    """The hull of the windows in each reset window."""
    return within_each(df, resets, keys).groupBy(*keys, "reset").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("reset")


def of_each_value(profile: DataFrame, keys: list[str]) -> DataFrame:
    """A window for each segment of a profile, with its value."""
    return profile.select(*keys, "lo", "hi", "value")


def time_range(keys: list[str], bounds: tuple[int, int], key_rows: DataFrame, windows=(), expressions=(), activities=(), filters=(), transforms=()) -> DataFrame:
    """Windows in which all constant windows, boolean profiles and activities hold, filtered and transformed in that order.

    filters and transforms take windows (keys, lo, hi) and give such.
    """
    sides = [serial.windows_from_spans(w, keys, bounds, key_rows) for w in (*windows, *activities)] + [serial.clip(e, bounds) for e in expressions]
    sides = {f"s{k}": s.select(*keys, "lo", "hi", "value") for k, s in enumerate(sides)} or {"s0": serial.constant(key_rows, keys, F.lit(True), bounds)}
    all_of = F.lit(True)
    for name in sides:
        all_of = all_of & F.col(name)
    out = serial.combine(sides, keys, all_of).filter("value").select(*keys, "lo", "hi")
    for change in (*filters, *transforms):
        out = change(out)
    return out


# --- choices among placements


def earliest_end(df: DataFrame, keys: list[str]) -> DataFrame:
    return best(df, keys, F.struct("hi", "lo"), F.min_by)


def latest_start(df: DataFrame, keys: list[str]) -> DataFrame:
    return best(df, keys, F.struct("lo", "hi"), F.max_by)


def best(df: DataFrame, keys: list[str], order: Column, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("__b")).select(*keys, "__b.*")


# --- time expressions


def relative(lo: Column, hi: Column, anchor: str = "start", least_us: int = 0, most_us: int | None = None) -> tuple[Column, Column]:
    """The interval that lies some µs from a start or an end: an instant if most isn't given."""
    edge = F.shiftright(lo if anchor == "start" else hi, 1) * 2
    return edge + 2 * least_us, edge + 2 * (least_us if most_us is None else most_us) + 1


def relative_before(lo: Column) -> tuple[Column, Column]:
    """All time up to a start."""
    return F.lit(iv.FOREVER[0]).cast("long"), lo


def between_expressions(low: tuple[Column, Column], high: tuple[Column, Column]) -> tuple[Column, Column]:
    """From where one time expression begins to where another ends."""
    return low[0], high[1]
