"""Piecewise linear profiles: serial timelines whose value is a struct (t0 in µs, v0, rate a second).

A piece's value at t is v0 + rate * (t - t0) / 1 s. Pieces are equal when they
agree at 0 and at 60 s, whatever their origin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.operators import serial

SECOND, MINUTE = 1_000_000, 60_000_000
#: Crossings further away than this (s) don't count
FAR = float((1 << 63) - 1) / SECOND
PIECES = "array<struct<lo:bigint,hi:bigint,value:boolean>>"


def line(t0: Column, v0: Column, rate: Column) -> Column:
    return F.struct(t0.cast("long").alias("t0"), v0.cast("double").alias("v0"), rate.cast("double").alias("rate"))


def value_at(value: Column, t_us: Column) -> Column:
    return value["v0"] + value["rate"] * (t_us - value["t0"]) / F.lit(1e6)


def shifted_origin(value: Column, t_us: Column) -> Column:
    return line(t_us, value_at(value, t_us), value["rate"])


def coalesce(df: DataFrame, keys: list[str]) -> DataFrame:
    marks = df.withColumns({"__a": value_at(F.col("value"), F.lit(0)), "__b": value_at(F.col("value"), F.lit(MINUTE))})
    return serial.coalesce(marks, keys, ["__a", "__b"], ("value",)).drop("__a", "__b")


def mapped(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    return coalesce(df.withColumn("value", value).filter("value IS NOT NULL"), keys)


def combined(left: DataFrame, right: DataFrame, keys: list[str], value) -> DataFrame:
    """value(l, r) where both profiles are defined."""
    swept = serial.sweep({"l": left, "r": right}, keys).filter("l IS NOT NULL AND r IS NOT NULL")
    return coalesce(swept.select(*keys, "lo", "hi", value(F.col("l"), F.col("r")).alias("value")), keys)


def from_numbers(df: DataFrame) -> DataFrame:
    """A step profile of numbers as pieces of rate 0; values that aren't numbers are an error."""
    number = F.col("value").try_cast("double") if dict(df.dtypes)["value"] == "string" else F.col("value").cast("double")
    checked = F.when(F.col("value").isNotNull() & number.isNull(), F.raise_error(F.lit("a resource's value isn't a number")).cast("double")).otherwise(number)
    return df.withColumn("value", line(F.shiftright("lo", 1), checked, F.lit(0.0)))


def to_numbers(df: DataFrame, keys: list[str]) -> DataFrame:
    """A step profile from pieces of rate 0; others are an error."""
    return serial.coalesce(df.withColumn("value", when_constant(F.col("value"), F.col("value.v0"))), keys)


def when_constant(value: Column, out: Column, why: str = "a profile isn't piecewise constant") -> Column:
    return F.when(value["rate"] == 0, out).otherwise(F.raise_error(F.lit(why)).cast("double"))


def step(key_rows: DataFrame, keys: list[str], at_us: int, value: float, bounds: tuple[int, int] = iv.FOREVER) -> DataFrame:
    """0 before an instant, the value from it on."""
    pieces = F.array(F.struct(F.lit(bounds[0]).alias("lo"), F.lit(2 * at_us).alias("hi"), F.lit(0.0).alias("v")), F.struct(F.lit(2 * at_us).alias("lo"), F.lit(bounds[1]).alias("hi"), F.lit(float(value)).alias("v")))
    return key_rows.select(*keys).distinct().select(*keys, F.explode(pieces).alias("p")).select(*keys, "p.lo", "p.hi", line(F.lit(0), F.col("p.v"), F.lit(0.0)).alias("value"))


def plus(left: DataFrame, right: DataFrame, keys: list[str], sign: int = 1) -> DataFrame:
    return combined(left, right, keys, lambda l, r: line(l["t0"], l["v0"] + sign * value_at(r, l["t0"]), l["rate"] + sign * r["rate"]))  # noqa: E741


def minus(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return plus(left, right, keys, -1)


def scaled(df: DataFrame, keys: list[str], factor: float) -> DataFrame:
    v = F.col("value")
    return mapped(df, keys, line(v["t0"], v["v0"] * factor, v["rate"] * factor))


def negated(df: DataFrame, keys: list[str]) -> DataFrame:
    return scaled(df, keys, -1.0)


def times(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The product, where one side is constant at each time; an error otherwise."""

    def value(l, r):  # noqa: E741
        by = lambda a, b: line(a["t0"], a["v0"] * b["v0"], a["rate"] * b["v0"])
        bad = F.raise_error(F.lit("one factor must be piecewise constant")).cast("struct<t0:bigint,v0:double,rate:double>")
        return F.when(r["rate"] == 0, by(l, r)).when(l["rate"] == 0, by(r, l)).otherwise(bad)

    return combined(left, right, keys, value)


def div(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The quotient by a piecewise constant divisor; an error otherwise."""

    def value(l, r):  # noqa: E741
        by = when_constant(r, r["v0"], "the divisor must be piecewise constant")
        return line(l["t0"], l["v0"] / by, l["rate"] / by)

    return combined(left, right, keys, value)


def power(left: DataFrame, exponent: DataFrame, keys: list[str]) -> DataFrame:
    """To a piecewise constant exponent: 0 gives 1, 1 the profile, others need a piecewise constant base."""

    def value(l, r):  # noqa: E741
        e = when_constant(r, r["v0"], "the exponent must be piecewise constant")
        return F.when(e == 0, line(l["t0"], F.lit(1.0), F.lit(0.0))).when(e == 1, l).otherwise(line(l["t0"], F.pow(when_constant(l, l["v0"], "the base must be piecewise constant"), e), F.lit(0.0)))

    return combined(left, exponent, keys, value)


def rate(df: DataFrame, keys: list[str], unit_us: int = SECOND) -> DataFrame:
    v = F.col("value")
    return mapped(df, keys, line(v["t0"], v["rate"] * (unit_us / SECOND), F.lit(0.0)))


def root(value: Column) -> Column:
    """When a line is 0, to the nearest µs; NULL if never."""
    return crossing(value, line(value["t0"], F.lit(0.0), F.lit(0.0)))


def crossing(l: Column, r: Column) -> Column:  # noqa: E741
    """When two lines meet, to the nearest µs (halves to even); NULL if they are parallel or meet too far away."""
    seconds = F.when(l["rate"] != r["rate"], (value_at(r, l["t0"]) - l["v0"]) / (l["rate"] - r["rate"]))
    return F.when(F.abs(seconds) <= FAR / 4, l["t0"] + F.rint(seconds * SECOND).cast("long"))


def absolute(df: DataFrame, keys: list[str]) -> DataFrame:
    """Split at its roots and turned upwards."""
    v = F.col("value")
    at = 2 * root(v)
    inside = at.isNotNull() & (at > F.col("lo")) & (at < F.col("hi"))
    up = lambda mid: F.when(value_at(v, F.shiftright(mid, 1)) < 0, line(v["t0"], -v["v0"], -v["rate"])).otherwise(v)
    piece = lambda lo, hi, x: F.struct(lo.alias("lo"), hi.alias("hi"), x.alias("value"))
    # on either side of the root the line has one sign, which a point a second away tells
    before, after = up(at - 2 * SECOND), up(at + 2 * SECOND)
    whole = F.when(at.isNull(), up(F.col("lo"))).when(at <= F.col("lo"), after).otherwise(before)
    parts = F.when(inside, F.array(piece(F.col("lo"), at, before), piece(at, F.col("hi"), after))).otherwise(F.array(piece(F.col("lo"), F.col("hi"), whole)))
    return coalesce(df.select(*keys, F.explode(parts).alias("p")).select(*keys, "p.*"), keys)


def shift(df: DataFrame, by_us: int) -> DataFrame:
    v = F.col("value")
    return serial.shift(df, by_us).withColumn("value", line(v["t0"] + by_us, v["v0"], v["rate"]))


COMPARE = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


def comparison_pieces(l: Column, r: Column, op: str) -> Column:  # noqa: E741
    """(lo, hi, value) over all time. An inequality is told by the values a second before, at and a second after the crossing; equality holds at it."""
    t = crossing(l, r)
    low, high = (F.lit(x).cast("long") for x in iv.FOREVER)
    piece = lambda a, b, v: F.struct(a.alias("lo"), b.alias("hi"), v.alias("value"))
    if op in ("==", "!="):
        same = F.lit(op == "==")
        everywhere = (l["v0"] == value_at(r, l["t0"])) == same
        values = (~same, same, ~same)
    else:
        test = COMPARE[op]
        everywhere = test(l["v0"], value_at(r, l["t0"]))
        values = tuple(test(value_at(l, t + d), value_at(r, t + d)) for d in (-SECOND, 0, SECOND))
    three = F.array(piece(low, 2 * t, values[0]), piece(2 * t, 2 * t + 1, values[1]), piece(2 * t + 1, high, values[2]))
    return F.when(t.isNull(), F.array(piece(low, high, everywhere))).otherwise(three).cast(PIECES)


def compare(left: DataFrame, right: DataFrame, keys: list[str], op: str) -> DataFrame:
    """A boolean profile of left op right, with the crossings as instants of their own; gaps where either side has one."""
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    return serial.flat_combine({"l": left, "r": right}, keys, F.when(both, comparison_pieces(F.col("l"), F.col("r"), op)))


def highlight_equal(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return compare(left, right, keys, "==").filter("value").select(*keys, "lo", "hi")


def jumps(before: Column, after: Column, t: Column) -> Column:
    """Whether two lines are further apart at t than rounding moves lines that meet there: a rate and a value take up to eight roundings of 2**-53."""
    a, b = value_at(before, t), value_at(after, t)
    size = lambda v: F.abs(v["v0"]) + F.abs(v["rate"] * (t - v["t0"]) / F.lit(1e6))
    rounding = (size(before) + size(after)) * F.lit(2.0**-50)
    return (a != b) & ~((F.abs(a - b) <= rounding) & (rounding < float("inf")))


def changes(df: DataFrame, keys: list[str]) -> DataFrame:
    """True while the value changes and at jumps, false elsewhere; a segment's first instant is unknown after a gap."""
    return edges(df, keys, jumps, F.col("value.rate") != 0)


def increases(df: DataFrame, keys: list[str]) -> DataFrame:
    return edges(df, keys, lambda before, after, t: jumps(before, after, t) & (value_at(before, t) < value_at(after, t)), F.col("value.rate") > 0)


def decreases(df: DataFrame, keys: list[str]) -> DataFrame:
    return edges(df, keys, lambda before, after, t: jumps(before, after, t) & (value_at(before, t) > value_at(after, t)), F.col("value.rate") < 0)


def edges(df: DataFrame, keys: list[str], test, body: Column) -> DataFrame:
    return serial.edge_profile(df, keys, lambda before, after: F.when(before.isNotNull(), test(before, after, F.shiftright("lo", 1))), body)


def transitions(df: DataFrame, keys: list[str], old: float, new: float) -> DataFrame:
    """True at the instants at which the value jumps from old to new."""
    t = F.shiftright("lo", 1)
    return serial.edge_profile(df, keys, lambda before, after: (value_at(before, t) == old) & (value_at(after, t) == new))


def sampled(df: DataFrame, keys: list[str], t_us: Column) -> DataFrame:
    """(keys, value) at an instant; no row where the profile has a gap."""
    return df.filter(iv.contains_point(F.col("lo"), F.col("hi"), t_us)).select(*keys, value_at(F.col("value"), t_us).alias("value"))


def samples(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, t_us, value) at both ends of each piece, so that the time of a border comes twice."""
    ends = F.explode(F.array(F.shiftright("lo", 1), F.shiftright("hi", 1)))
    return df.withColumn("t_us", ends).select(*keys, "t_us", value_at(F.col("value"), F.col("t_us")).alias("value"))


def moving_average(df: DataFrame, keys: list[str], interval_us: int) -> DataFrame:
    """Of a step profile of numbers: its mean over the interval that begins at each time."""
    from spanweave.operators import accumulate

    return scaled(accumulate.shifted_difference(accumulate.integrate(df, keys), keys, interval_us), keys, SECOND / interval_us)
