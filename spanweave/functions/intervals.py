"""Intervals as half-open tick ranges: an instant t (µs) is tick 2t, just after it 2t + 1, so that open and closed ends need no flags.

An interval is a pair of Columns lo, hi; it is empty where lo >= hi. Every
function is a Column expression, so it stays in generated code and filters
reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The largest duration in µs, which stands for endless, and its ticks
MAX_US = (1 << 62) - 1
FOREVER = (-2 * MAX_US, 2 * MAX_US + 1)


def tick_lo(start_us: Column, inclusive: bool = True) -> Column:
    return start_us * 2 + (0 if inclusive else 1)


def tick_hi(end_us: Column, inclusive: bool = False) -> Column:
    return end_us * 2 + (1 if inclusive else 0)


def between(start_us: Column, end_us: Column, start_inclusive: bool = True, end_inclusive: bool = True) -> tuple[Column, Column]:
    return tick_lo(start_us, start_inclusive), tick_hi(end_us, end_inclusive)


def at(t_us: Column) -> tuple[Column, Column]:
    return t_us * 2, t_us * 2 + 1


def between_closed_open(start_us: Column, end_us: Column) -> tuple[Column, Column]:
    return start_us * 2, end_us * 2


def micros(ts) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def relative(ts: Column, plan_start: Column) -> Column:
    """µs from the start of a plan to a timestamp."""
    return F.unix_micros(ts.cast("timestamp")) - F.unix_micros(plan_start.cast("timestamp"))


def start_us(lo: Column) -> Column:
    return F.shiftright(lo, 1)


def end_us(hi: Column) -> Column:
    return F.shiftright(hi, 1)


def start_inclusive(lo: Column) -> Column:
    return F.pmod(lo, F.lit(2)) == 0


def end_inclusive(hi: Column) -> Column:
    return F.pmod(hi, F.lit(2)) == 1


def is_empty(lo: Column, hi: Column) -> Column:
    return lo >= hi


def is_point(lo: Column, hi: Column) -> Column:
    return (hi == lo + 1) & (F.pmod(lo, F.lit(2)) == 0)


def duration_us(lo: Column, hi: Column) -> Column:
    return F.when(lo >= hi, F.lit(0)).otherwise(F.shiftright(hi, 1) - F.shiftright(lo, 1)).cast("long")


def intersect(lo: Column, hi: Column, lo2: Column, hi2: Column) -> tuple[Column, Column]:
    return F.greatest(lo, lo2), F.least(hi, hi2)


def hull(lo: Column, hi: Column, lo2: Column, hi2: Column) -> tuple[Column, Column]:
    """The smallest interval that holds both; an empty one adds nothing."""
    first, second = lo >= hi, lo2 >= hi2
    return F.when(first, lo2).when(second, lo).otherwise(F.least(lo, lo2)), F.when(first, hi2).when(second, hi).otherwise(F.greatest(hi, hi2))


def union(lo: Column, hi: Column, lo2: Column, hi2: Column) -> Column:
    """An array of one interval where they overlap or touch, of those that aren't empty otherwise."""
    low, high = hull(lo, hi, lo2, hi2)
    one = (lo >= hi) | (lo2 >= hi2) | ((lo <= hi2) & (lo2 <= hi))
    pair = F.array(F.struct(F.least(lo, lo2).alias("lo"), F.when(lo <= lo2, hi).otherwise(hi2).alias("hi")), F.struct(F.greatest(lo, lo2).alias("lo"), F.when(lo <= lo2, hi2).otherwise(hi).alias("hi")))
    return F.filter(F.when(one, F.array(F.struct(low.alias("lo"), high.alias("hi")))).otherwise(pair), lambda x: x["lo"] < x["hi"])


def minus(lo: Column, hi: Column, lo2: Column, hi2: Column) -> Column:
    """An array of what the second leaves of the first: none, one or two intervals."""
    gone = lo2 >= hi2
    parts = F.array(F.struct(lo.alias("lo"), F.when(gone, hi).otherwise(F.least(hi, lo2)).alias("hi")), F.struct(F.when(gone, hi).otherwise(F.greatest(lo, hi2)).alias("lo"), hi.alias("hi")))
    return F.filter(parts, lambda x: x["lo"] < x["hi"])


def steps(lo: Column, hi: Column, stride_us: Column | int) -> Column:
    """An array of the instants (µs) from the start on, a stride apart, that the interval holds."""
    first = F.shiftright(lo + 1, 1)
    last = F.shiftright(hi - 1, 1)
    return F.when(first <= last, F.sequence(first, last, F.lit(stride_us).cast("long") if isinstance(stride_us, int) else stride_us)).otherwise(F.array().cast("array<long>"))


def shifted(edge: Column, by_us: Column | int) -> Column:
    """An edge moved by some µs, which stays within the largest durations."""
    low, high = (F.lit(x).cast("long") for x in FOREVER)
    by = F.lit(2 * by_us).cast("long") if isinstance(by_us, int) else by_us * 2
    beyond = F.when(edge.isNotNull(), F.when(by > 0, high).otherwise(low))
    return F.greatest(low, F.least(high, F.coalesce(F.try_add(edge, by), beyond)))


def overlaps(lo: Column, hi: Column, lo2: Column, hi2: Column) -> Column:
    return F.greatest(lo, lo2) < F.least(hi, hi2)


def contains(lo: Column, hi: Column, lo2: Column, hi2: Column) -> Column:
    return (lo <= lo2) & (hi2 <= hi)


def strictly_contains(lo: Column, hi: Column, lo2: Column, hi2: Column) -> Column:
    return contains(lo, hi, lo2, hi2) & ((lo != lo2) | (hi != hi2))


def equals(lo: Column, hi: Column, lo2: Column, hi2: Column) -> Column:
    return (lo == lo2) & (hi == hi2)


def contains_point(lo: Column, hi: Column, t_us: Column) -> Column:
    return (lo <= t_us * 2) & (t_us * 2 < hi)


def compare(a: Column, b: Column) -> Column:
    """-1, 0 or 1 as a is below, at or above b: of starts, or of ends."""
    return F.when(a < b, F.lit(-1)).when(a > b, F.lit(1)).otherwise(F.lit(0))


compare_starts = compare_ends = compare


def compare_end_to_start(hi: Column, lo2: Column) -> Column:
    """-1 with a gap between, 0 where they meet, 1 where they overlap."""
    return compare(hi, lo2)


def meets(hi: Column, lo2: Column) -> Column:
    return hi == lo2


def is_met_by(lo: Column, hi2: Column) -> Column:
    return lo == hi2


def adjacent(lo: Column, hi: Column, lo2: Column, hi2: Column) -> Column:
    return meets(hi, lo2) | is_met_by(lo, hi2)


def strictly_before(hi: Column, lo2: Column) -> Column:
    return hi < lo2


def strictly_after(lo: Column, hi2: Column) -> Column:
    return lo > hi2


def same_start(lo: Column, lo2: Column) -> Column:
    return lo == lo2


def same_end(hi: Column, hi2: Column) -> Column:
    return hi == hi2


def strict_lower_bounds_of(lo: Column) -> tuple[Column, Column]:
    """All instants before an interval."""
    return F.lit(FOREVER[0]).cast("long"), lo


def strict_upper_bounds_of(hi: Column) -> tuple[Column, Column]:
    """All instants after an interval."""
    return hi, F.lit(FOREVER[1]).cast("long")


def start_before_start(lo: Column, lo2: Column) -> Column:
    return lo < lo2


def end_before_start(hi: Column, lo2: Column) -> Column:
    return hi <= lo2


def end_before_end(hi: Column, hi2: Column) -> Column:
    return hi < hi2


def start_before_end(lo: Column, hi2: Column) -> Column:
    """Whether the start comes before the end in µs, whatever the ends' inclusion."""
    return F.shiftright(lo, 1) < F.shiftright(hi2, 1)


def starts_before(lo: Column, lo2: Column) -> Column:
    return lo < lo2


def ends_after(hi: Column, hi2: Column) -> Column:
    return hi > hi2


def starts_after(lo: Column, hi2: Column) -> Column:
    return lo >= hi2


def ends_before(hi: Column, lo2: Column) -> Column:
    return hi <= lo2


def starts_strictly_after(lo: Column, hi2: Column) -> Column:
    return lo > hi2


def ends_strictly_before(hi: Column, lo2: Column) -> Column:
    return hi < lo2


#: Closed ranges of whole numbers are intervals of instants: the same functions serve them.
range_subtract, range_intersect, range_is_adjacent, range_envelop, subset_fully_contained = minus, intersect, adjacent, hull, contains
