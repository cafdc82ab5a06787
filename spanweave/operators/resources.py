"""Resource models as operators over profiles: polynomials, effects on cells, clocks, reactions.

A polynomial piece is a value of struct (t0 in µs, c: coefficients by power of
seconds since t0). Effects are rows (keys, t in µs, seq, ...) of events.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.operators import linear, parallel, serial

SECOND = 1_000_000


# --- polynomials


def polynomial(t0: Column, c: Column) -> Column:
    return F.struct(t0.cast("long").alias("t0"), c.cast("array<double>").alias("c"))


def evaluate(p: Column, t_us: Column) -> Column:
    x = (t_us - p["t0"]) / F.lit(1e6)
    return F.aggregate(F.reverse(p["c"]), F.lit(0.0), lambda acc, c: acc * x + c)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0.0)) + F.coalesce(y, F.lit(0.0)))


def subtract(a: Column, b: Column) -> Column:
    return add(a, scale(b, -1.0))


def scale(a: Column, k) -> Column:
    return F.transform(a, lambda x: x * k)


def multiply(a: Column, b: Column) -> Column:
    zeros = lambda n: F.transform(F.sequence(F.lit(1), n), lambda _: F.lit(0.0))
    lag = lambda x, i: F.when(i == 0, x).otherwise(F.concat(zeros(F.greatest(i, F.lit(1))), x))
    terms = F.transform(a, lambda x, i: lag(scale(b, x), i))
    return F.aggregate(terms, F.array().cast("array<double>"), add)


def divide(a: Column, scalar) -> Column:
    return F.transform(a, lambda x: x / scalar)


def derivative(a: Column) -> Column:
    return F.slice(F.transform(a, lambda x, i: x * i), 2, F.greatest(F.size(a) - 1, F.lit(0)))


def integral(a: Column, start=0.0) -> Column:
    return F.concat(F.array(F.lit(start) if not isinstance(start, Column) else start), F.transform(a, lambda x, i: x / (i + 1)))


def stepped(p: Column, t_us: Column) -> Column:
    """The same polynomial with another origin: each coefficient by Taylor's formula."""
    x = (t_us - p["t0"]) / F.lit(1e6)
    n = F.size(p["c"])
    # Horner's scheme moves the origin: fold from the highest power, multiplying by (s + x)
    out = F.aggregate(F.reverse(p["c"]), F.array().cast("array<double>"), lambda acc, c: add(add(scale(acc, x), F.concat(F.array(F.lit(0.0)), acc)), F.array(c)))
    return polynomial(t_us, F.when(n == 0, p["c"]).otherwise(F.slice(out, 1, F.greatest(n, F.lit(1)))))


def as_polynomial(df: DataFrame) -> DataFrame:
    """Linear pieces as polynomials."""
    return df.withColumn("value", polynomial(F.col("value.t0"), F.array("value.v0", "value.rate")))


def assume_linear(df: DataFrame) -> DataFrame:
    """Polynomials as linear pieces; a higher power is an error."""
    c = F.col("value.c")
    high = F.exists(F.slice(c, 3, F.greatest(F.size(c) - 2, F.lit(0))), lambda x: x != 0)
    at = lambda k: F.coalesce(F.get(c, k), F.lit(0.0))
    v0 = F.when(high, F.raise_error(F.lit("a polynomial isn't linear")).cast("double")).otherwise(at(0))
    return df.withColumn("value", linear.line(F.col("value.t0"), v0, at(1)))


def combined(left: DataFrame, right: DataFrame, keys: list[str], change) -> DataFrame:
    """change(coefficients, coefficients) where both are defined, with the atomic piece's start as origin."""
    swept = serial.sweep({"l": left, "r": right}, keys).filter("l IS NOT NULL AND r IS NOT NULL")
    t0 = F.shiftright("lo", 1)
    aligned = swept.withColumns({"l": stepped(F.col("l"), t0), "r": stepped(F.col("r"), t0)})
    return aligned.select(*keys, "lo", "hi", polynomial(t0, change(F.col("l.c"), F.col("r.c"))).alias("value"))


def differentiated(df: DataFrame) -> DataFrame:
    return df.withColumn("value", polynomial(F.col("value.t0"), derivative(F.col("value.c"))))


def integrated(df: DataFrame, keys: list[str], start: float = 0.0) -> DataFrame:
    """The running integral over seconds; pieces must follow each other."""
    t0, t1 = F.shiftright("lo", 1), F.shiftright("hi", 1)
    own = df.withColumn("value", stepped(F.col("value"), t0)).withColumn("__i", polynomial(t0, integral(F.col("value.c"))))
    gain = evaluate(F.col("__i"), t1)
    before = F.coalesce(F.sum(gain).over(Window.partitionBy(*keys).orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return own.withColumn("__s", before + start).select(*keys, "lo", "hi", polynomial(t0, integral(F.col("value.c"), F.col("__s"))).alias("value"))


def sampled_at(df: DataFrame, keys: list[str], period_us: int) -> DataFrame:
    """(keys, t_us, value) at multiples of a period."""
    first, last = F.ceil(F.shiftright("lo", 1) / period_us), F.floor((F.shiftright(F.col("hi") - 1, 1)) / period_us)
    at = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<long>"))
    return df.withColumn("__n", F.explode(at)).withColumn("t_us", F.col("__n") * period_us).select(*keys, "t_us", evaluate(F.col("value"), F.col("t_us")).alias("value"))


def approximate_as_linear(df: DataFrame, keys: list[str], period_us: int) -> DataFrame:
    """Secants over pieces of a period (or what is left of one); equal to the profile at their ends."""
    t0, t1 = F.shiftright("lo", 1), F.shiftright("hi", 1)
    cuts = F.sequence(t0, F.greatest(t0, t1 - 1), F.lit(period_us).cast("long"))
    parts = df.withColumn("__a", F.explode(cuts)).withColumn("__b", F.least(F.col("__a") + period_us, t1))
    va, vb = evaluate(F.col("value"), F.col("__a")), evaluate(F.col("value"), F.col("__b"))
    lo = F.when(F.col("__a") == t0, F.col("lo")).otherwise(F.col("__a") * 2)
    hi = F.when(F.col("__b") == t1, F.col("hi")).otherwise(F.col("__b") * 2)
    rate = F.when(F.col("__b") > F.col("__a"), (vb - va) * SECOND / (F.col("__b") - F.col("__a"))).otherwise(F.lit(0.0))
    return parts.select(*keys, lo.alias("lo"), hi.alias("hi"), linear.line(F.col("__a"), va, rate).alias("value"))


ROOTS = "array<double>"


def roots_between(c: Column, seconds: Column) -> Column:
    """Real roots in (0, seconds) of coefficients, sorted: in closed form up to the second power, by Arrow batches beyond."""

    @F.pandas_udf(ROOTS)
    def found(cs: pd.Series, ends: pd.Series) -> pd.Series:
        import numpy as np

        def one(own, end):
            own = np.trim_zeros(np.asarray(own, dtype=float), "b")
            if len(own) < 2:
                return []
            r = np.roots(own[::-1])
            return sorted(x for x in r[np.abs(r.imag) < 1e-9].real.tolist() if 0 < x < end)

        return pd.Series([one(a, b) for a, b in zip(cs, ends, strict=True)])

    at = lambda k: F.coalesce(F.get(c, k), F.lit(0.0))
    low = F.size(F.filter(F.slice(c, 4, F.greatest(F.size(c) - 3, F.lit(0))), lambda x: x != 0)) == 0
    d = at(1) * at(1) - 4 * at(2) * at(0)
    q = -0.5 * (at(1) + F.when(at(1) < 0, -1.0).otherwise(1.0) * F.sqrt(F.greatest(d, F.lit(0.0))))
    two = F.when(at(2) == 0, F.when(at(1) != 0, F.array(-at(0) / at(1))).otherwise(F.array().cast(ROOTS))).when(d < 0, F.array().cast(ROOTS)).otherwise(F.array_distinct(F.array(q / at(2), F.when(q != 0, at(0) / q).otherwise(F.lit(0.0)))))
    closed = F.array_sort(F.filter(two, lambda x: x.isNotNull() & (x > 0) & (x < seconds)))
    return F.when(low, closed).otherwise(found(c, seconds))


def pieces_by_sign(swept: DataFrame, keys: list[str], difference: Column) -> DataFrame:
    """Atomic pieces cut at the difference's roots (to the nearest µs), with sign: that of the difference in the middle."""
    t0, t1 = F.shiftright("lo", 1), F.shiftright("hi", 1)
    with_roots = swept.withColumn("__d", difference).withColumn("__r", roots_between(F.col("__d"), (t1 - t0) / F.lit(1e6)))
    ticks = F.array_distinct(F.concat(F.array("lo"), F.transform("__r", lambda r: (F.shiftright("lo", 1) + F.rint(r * SECOND).cast("long")) * 2), F.array("hi")))
    cut = with_roots.withColumn("__t", ticks).withColumn("__k", F.explode(F.sequence(F.lit(0), F.size("__t") - 2)))
    a, b = F.get("__t", F.col("__k")), F.get("__t", F.col("__k") + 1)
    middle = evaluate(polynomial(t0, F.col("__d")), t0) * 0 + F.aggregate(F.reverse("__d"), F.lit(0.0), lambda acc, c: acc * (((a + b) / 4 - F.shiftright("lo", 1)) / F.lit(1e6)) + c)
    return cut.withColumns({"__a": a, "__b": b, "sign": F.signum(middle)}).filter("__a < __b")


def compared(left: DataFrame, right: DataFrame, keys: list[str], op: str) -> DataFrame:
    """A boolean profile of left op right, by the sign of their difference between its roots."""
    swept = aligned(left, right, keys)
    signs = pieces_by_sign(swept, keys, subtract(F.col("l.c"), F.col("r.c")))
    value = {"<": F.col("sign") < 0, "<=": F.col("sign") <= 0, ">": F.col("sign") > 0, ">=": F.col("sign") >= 0}[op]
    return serial.coalesce(signs.select(*keys, F.col("__a").alias("lo"), F.col("__b").alias("hi"), value.alias("value")), keys)


def aligned(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    swept = serial.sweep({"l": left, "r": right}, keys).filter("l IS NOT NULL AND r IS NOT NULL")
    t0 = F.shiftright("lo", 1)
    return swept.withColumns({"l": stepped(F.col("l"), t0), "r": stepped(F.col("r"), t0)})


def extreme(left: DataFrame, right: DataFrame, keys: list[str], most: bool) -> DataFrame:
    """The pointwise maximum or minimum: pieces of whichever dominates."""
    signs = pieces_by_sign(aligned(left, right, keys), keys, subtract(F.col("l.c"), F.col("r.c")))
    is_left = F.col("sign") >= 0 if most else F.col("sign") <= 0
    return signs.select(*keys, F.col("__a").alias("lo"), F.col("__b").alias("hi"), F.when(is_left, F.col("l")).otherwise(F.col("r")).alias("value"))


def greatest(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return extreme(left, right, keys, True)


def least(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return extreme(left, right, keys, False)


def magnitude(df: DataFrame, keys: list[str]) -> DataFrame:
    return greatest(df, df.withColumn("value", polynomial(F.col("value.t0"), scale(F.col("value.c"), -1.0))), keys)


def clamped(df: DataFrame, low: DataFrame, high: DataFrame, keys: list[str]) -> DataFrame:
    return greatest(least(df, high, keys), low, keys)


def in_unit(df: DataFrame, unit: str, factors: dict[str, float], have: str) -> DataFrame:
    """Linear values in another unit, by factors to a common one; units that don't go together are an error."""
    if unit not in factors or have not in factors:
        raise ValueError(f"units {have} and {unit} don't go together")
    k = factors[have] / factors[unit]
    v = F.col("value")
    return df.withColumn("value", linear.line(v["t0"], v["v0"] * k, v["rate"] * k))


def precomputed(rows: DataFrame, keys: list[str], t: str, v: str) -> DataFrame:
    """Points (keys, t in µs, v) joined by lines, constant before the first and from the last on."""
    w = Window.partitionBy(*keys).orderBy(t)
    after, value_after, before = F.lead(t).over(w), F.lead(v).over(w), F.lag(t).over(w)
    p = rows.select(*keys, F.col(t).alias("__t"), F.col(v).cast("double").alias("__v"), after.alias("__t2"), value_after.cast("double").alias("__v2"), before.isNull().alias("__first"))
    own = F.struct((F.col("__t") * 2).alias("lo"), F.coalesce(F.col("__t2") * 2, F.lit(iv.FOREVER[1])).alias("hi"), linear.line(F.col("__t"), F.col("__v"), F.coalesce((F.col("__v2") - F.col("__v")) * SECOND / (F.col("__t2") - F.col("__t")), F.lit(0.0))).alias("value"))
    head = F.struct(F.lit(iv.FOREVER[0]).alias("lo"), (F.col("__t") * 2).alias("hi"), linear.line(F.col("__t"), F.col("__v"), F.lit(0.0)).alias("value"))
    return p.select(*keys, F.explode(F.when(F.col("__first"), F.array(head, own)).otherwise(F.array(own))).alias("p")).select(*keys, "p.*")


def clamped_integral(df: DataFrame, keys: list[str], low: float, high: float, start: float) -> DataFrame:
    """(keys, lo, hi, value, overflow, underflow) of a step profile of rates a second: its integral, held within bounds; pieces are cut where a bound is met.

    Each piece's state hangs on the one before, so a key's pieces are walked
    in order; memory is a key's pieces.
    """
    schema = ", ".join([*(f"`{k}` {dict(df.dtypes)[k]}" for k in keys), "lo long, hi long, t0 long, v0 double, rate double, overflow double, underflow double"])

    def walk(pdf):
        level, out = start, []
        for row in pdf.sort_values("lo").itertuples(index=False):
            key = [getattr(row, k) for k in keys]
            lo, hi, r = row.lo, row.hi, row.value
            while lo < hi:
                bound = high if r > 0 else low
                stuck = r != 0 and level == bound
                need = None if r == 0 or stuck else (bound - level) / r
                t0, t1 = lo >> 1, hi >> 1
                end = hi if need is None or need * SECOND >= t1 - t0 else max(lo + 1, 2 * (t0 + round(need * SECOND)))
                out.append((*key, lo, end, t0, level, 0.0 if stuck else r, r if stuck and r > 0 else 0.0, -r if stuck and r < 0 else 0.0))
                level = level if r == 0 or stuck else bound if end < hi else min(high, max(low, level + r * (t1 - t0) / SECOND))
                lo = end
        return pd.DataFrame(out, columns=[*keys, "lo", "hi", "t0", "v0", "rate", "overflow", "underflow"])

    out = df.select(*keys, "lo", "hi", F.col("value").cast("double").alias("value")).groupBy(*keys).applyInPandas(walk, schema)
    return out.select(*keys, "lo", "hi", linear.line(F.col("t0"), F.col("v0"), F.col("rate")).alias("value"), "overflow", "underflow")


# --- discrete resources


def lifted(sides: dict[str, DataFrame], keys: list[str], value: Column) -> DataFrame:
    """A function of several resources, where all are defined."""
    swept = serial.sweep(sides, keys)
    return serial.valued(swept.filter(reduce(Column.__and__, [F.col(n).isNotNull() for n in sides])), keys, value)


def reduced(resources: list[DataFrame], keys: list[str], fold) -> DataFrame:
    sides = {f"r{k}": r for k, r in enumerate(resources)}
    return lifted(sides, keys, reduce(fold, [F.col(n) for n in sides]))


def bound(outer: DataFrame, choices: dict, keys: list[str]) -> DataFrame:
    """For each value of the outer resource the resource that it picks."""
    sides = {"__o": outer} | {f"c{k}": r for k, r in enumerate(choices.values())}
    pick = F.lit(None)
    for k, at in enumerate(choices):
        pick = F.when(F.col("__o") == F.lit(at), F.col(f"c{k}")).otherwise(pick)
    return serial.valued(serial.sweep(sides, keys), keys, pick)


def all_true(resources: list[DataFrame], keys: list[str]) -> DataFrame:
    return serial.combine({f"r{k}": r for k, r in enumerate(resources)}, keys, reduce(Column.__and__, [F.col(f"r{k}") for k in range(len(resources))]))


def any_true(resources: list[DataFrame], keys: list[str]) -> DataFrame:
    return serial.combine({f"r{k}": r for k, r in enumerate(resources)}, keys, reduce(Column.__or__, [F.col(f"r{k}") for k in range(len(resources))]))


def choose(condition: DataFrame, yes: DataFrame, no: DataFrame, keys: list[str]) -> DataFrame:
    return serial.combine({"c": condition, "y": yes, "n": no}, keys, F.when(F.col("c"), F.col("y")).when(~F.col("c"), F.col("n")))


def assert_that(df: DataFrame, message: str) -> DataFrame:
    """The boolean profile; an error where it is false."""
    return df.withColumn("value", F.when(F.col("value"), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def is_empty(df: DataFrame, keys: list[str]) -> DataFrame:
    return serial.map_values(df, keys, F.size("value") == 0)


def is_non_empty(df: DataFrame, keys: list[str]) -> DataFrame:
    return serial.map_values(df, keys, F.size("value") > 0)


def contains(df: DataFrame, keys: list[str], item) -> DataFrame:
    return serial.map_values(df, keys, F.array_contains("value", item))


def cached(df: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """A step profile that only takes a segment's value when it differs by more than a tolerance from the value before it."""
    w = serial.by_key(keys, "lo")
    moved_ = F.lag("value").over(w).isNull() | (F.abs(F.col("value") - F.lag("value").over(w)) > tolerance) | (F.lag("hi").over(w) != F.col("lo"))
    marked = df.withColumn("__v", F.when(moved_, F.col("value")))
    return serial.coalesce(marked.withColumn("value", F.last("__v", ignorenulls=True).over(w)).drop("__v"), keys)


def sampled(df: DataFrame, keys: list[str], period_us: int) -> DataFrame:
    """A step profile of the values at multiples of a period, each held until the next."""
    first, last = F.ceil(F.shiftright("lo", 1) / period_us), F.floor(F.shiftright(F.col("hi") - 1, 1) / period_us)
    at = F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<long>")))
    points = df.select(*keys, "value", at.alias("__n")).withColumn("t", F.col("__n") * period_us)
    return serial.coalesce(points.select(*keys, (F.col("t") * 2).alias("lo"), ((F.col("t") + period_us) * 2).alias("hi"), "value"), keys)


# --- effects: rows (keys, t in µs, seq, op, value) on a cell


def held_until_next(states: DataFrame, keys: list[str], end_us: int) -> DataFrame:
    """States (keys, t, value) as a step profile up to an instant."""
    w = serial.by_key(keys, "t")
    return states.select(*keys, (F.col("t") * 2).alias("lo"), F.coalesce(F.lead("t").over(w) * 2, F.lit(2 * end_us)).alias("hi"), "value").filter("lo < hi")


def register(effects: DataFrame, keys: list[str], end_us: int) -> DataFrame:
    """(keys, lo, hi, value, conflicted): the last value set; conflicted where effects of one instant set different ones."""
    states = effects.groupBy(*keys, "t").agg(F.max_by("value", "seq").alias("value"), (F.count_distinct("value") > 1).alias("conflicted"))
    w = serial.by_key(keys, "t")
    return states.select(*keys, (F.col("t") * 2).alias("lo"), F.coalesce(F.lead("t").over(w) * 2, F.lit(2 * end_us)).alias("hi"), "value", "conflicted").filter("lo < hi")


def counter(effects: DataFrame, keys: list[str], end_us: int, start=0) -> DataFrame:
    """Increments (value) that add up, in whatever order."""
    at = effects.groupBy(*keys, "t").agg(F.sum("value").alias("d"))
    total = F.sum("d").over(serial.by_key(keys, "t")) + F.lit(start)
    return serial.coalesce(held_until_next(at.select(*keys, "t", total.alias("value")), keys, end_us), keys)


def toggled(effects: DataFrame, keys: list[str], end_us: int, start: bool = False) -> DataFrame:
    """A switch under effects op: on, off or toggle."""
    w = serial.by_key(keys, "t", "seq")
    fixed = F.last(F.when(F.col("op") != "toggle", F.struct(F.col("op").alias("op"), F.lit(0).alias("z"))), ignorenulls=True).over(w)
    run_ = F.sum((F.col("op") != "toggle").cast("int")).over(w)
    marked = effects.withColumns({"__fixed": F.coalesce(fixed["op"] == "on", F.lit(start)), "__run": run_})
    flips = F.sum((F.col("op") == "toggle").cast("int")).over(Window.partitionBy(*keys, "__run").orderBy("t", "seq"))
    values = marked.withColumn("value", F.col("__fixed") != (flips % 2 == 1))
    last = values.groupBy(*keys, "t").agg(F.max_by("value", "seq").alias("value"))
    return serial.coalesce(held_until_next(last, keys, end_us), keys)


def queue(effects: DataFrame, keys: list[str], end_us: int) -> DataFrame:
    """Lists under effects op: add (value, at the end) or remove (the first equal one); a key's events are folded in order."""
    events = effects.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("t", "seq", "op", "value"))).alias("__e"))
    fold = lambda upto: F.aggregate(F.filter("__e", lambda e: e["t"] <= upto), F.array().cast("array<string>"), lambda acc, e: F.when(e["op"] == "add", F.concat(acc, F.array(e["value"]))).otherwise(F.concat(F.slice(acc, 1, F.greatest(F.array_position(acc, e["value"]).cast("int") - 1, F.lit(0))), F.slice(acc, F.array_position(acc, e["value"]).cast("int") + 1, F.size(acc) + 1))))
    times = events.withColumn("t", F.explode(F.array_distinct(F.transform("__e", lambda e: e["t"]))))
    return held_until_next(times.withColumn("value", fold(F.col("t"))).select(*keys, "t", "value"), keys, end_us)


def reserved(uses: DataFrame, keys: list[str], capacity: float, bounds: tuple[int, int], key_rows: DataFrame | None = None) -> DataFrame:
    """What is left of a capacity while uses (lo, hi, amount) hold some of it."""
    held = parallel.delta_sweep(uses, keys, F.col("amount").cast("double"))
    rest = serial.complement(held, keys, bounds, uses if key_rows is None else key_rows).withColumn("value", F.lit(0.0))
    return serial.coalesce(serial.clip(held, bounds).unionByName(rest).withColumn("value", capacity - F.col("value")), keys)


def accumulator(effects: DataFrame, keys: list[str], end_us: int, level: float = 0.0, rate: float = 0.0) -> DataFrame:
    """A level that grows by a rate: effects (t, add to the level, add to the rate), as linear pieces from each key's first effect on."""
    at = effects.groupBy(*keys, "t").agg(F.sum("add").alias("__add"), F.sum("add_rate").alias("__r"))
    w = serial.by_key(keys, "t")
    rates = at.withColumn("__rate", F.sum("__r").over(w) + rate).withColumn("__dt", (F.coalesce(F.lead("t").over(w), F.lit(end_us)) - F.col("t")) / F.lit(1e6))
    before = F.coalesce(F.sum(F.col("__rate") * F.col("__dt")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    levels = rates.withColumn("__v", F.sum("__add").over(w) + before + level)
    return levels.select(*keys, (F.col("t") * 2).alias("lo"), F.coalesce(F.lead("t").over(w) * 2, F.lit(2 * end_us)).alias("hi"), linear.line(F.col("t"), F.col("__v"), F.col("__rate")).alias("value")).filter("lo < hi")


def clock(restarts: DataFrame, keys: list[str], end_us: int) -> DataFrame:
    """Seconds since the last restart (keys, t)."""
    w = serial.by_key(keys, "t")
    t = restarts.select(*keys, "t").distinct()
    return t.select(*keys, (F.col("t") * 2).alias("lo"), F.coalesce(F.lead("t").over(w) * 2, F.lit(2 * end_us)).alias("hi"), linear.line(F.col("t"), F.lit(0.0), F.lit(1.0)).alias("value")).filter("lo < hi")


#: What effects do to a variable clock: its rate, and its reading where that is set
CLOCK = {"start": (1.0, None), "pause": (0.0, None), "reset": (None, 0.0), "restart": (1.0, 0.0), "countdown": (-1.0, "value")}


def variable_clock(effects: DataFrame, keys: list[str], end_us: int) -> DataFrame:
    """Seconds on a clock under effects op (start, pause, reset, restart, countdown from value), one an instant."""
    rate, reading = F.lit(None).cast("double"), F.lit(None).cast("double")
    for op, (r, v) in CLOCK.items():
        rate = F.when(F.col("op") == op, F.lit(r)).otherwise(rate)
        reading = F.when(F.col("op") == op, F.col("value").cast("double") if v == "value" else F.lit(v)).otherwise(reading)
    w = serial.by_key(keys, "t")
    own = effects.select(*keys, "t", rate.alias("__r"), reading.alias("__v"))
    rates = own.withColumn("__rate", F.coalesce(F.last("__r", ignorenulls=True).over(w), F.lit(0.0))).withColumn("__run", F.sum(F.col("__v").isNotNull().cast("int")).over(w)).withColumn("__end", F.coalesce(F.lead("t").over(w), F.lit(end_us)))
    run_ = Window.partitionBy(*keys, "__run").orderBy("t")
    gain = F.coalesce(F.sum(F.col("__rate") * (F.col("__end") - F.col("t")) / F.lit(1e6)).over(run_.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    value = F.coalesce(F.first("__v").over(run_), F.lit(0.0)) + gain
    return rates.withColumn("__x", value).select(*keys, (F.col("t") * 2).alias("lo"), (F.col("__end") * 2).alias("hi"), linear.line(F.col("t"), F.col("__x"), F.col("__rate")).alias("value")).filter("lo < hi")


# --- reactions


def updates(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, t_us) at which a resource gets another dynamics."""
    return df.select(*keys, F.shiftright("lo", 1).alias("t_us"))


def expiries(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.shiftright("hi", 1).alias("t_us"))


def whenever(condition: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, t_us) at which a boolean resource becomes true, its beginning included."""
    w = serial.by_key(keys, "lo")
    risen = F.col("value") & ~F.coalesce((F.lag("hi").over(w) == F.col("lo")) & F.lag("value").over(w), F.lit(False))
    return condition.withColumn("__up", risen).filter("__up").select(*keys, F.shiftright("lo", 1).alias("t_us"))


def every(key_rows: DataFrame, keys: list[str], period_us: int, start_us: int, end_us: int) -> DataFrame:
    """(keys, t_us) a period apart; for periods that a driver's sequence bounds."""
    return key_rows.select(*keys).distinct().withColumn("t_us", F.explode(F.sequence(F.lit(start_us), F.lit(end_us), F.lit(period_us))))


def forwarded(df: DataFrame) -> DataFrame:
    return df


# --- functions of time


def sampled_function(key_rows: DataFrame, keys: list[str], function, start_us: int, end_us: int, period_us: int) -> DataFrame:
    """Secants of a function of time (Column of seconds to Column), a period apart."""
    cut = key_rows.select(*keys).distinct().withColumn("__a", F.explode(F.sequence(F.lit(start_us), F.lit(end_us - 1), F.lit(period_us)))).withColumn("__b", F.least(F.col("__a") + period_us, F.lit(end_us)))
    va, vb = function(F.col("__a") / F.lit(1e6)), function(F.col("__b") / F.lit(1e6))
    return cut.select(*keys, (F.col("__a") * 2).alias("lo"), (F.col("__b") * 2).alias("hi"), linear.line(F.col("__a"), va, (vb - va) * SECOND / (F.col("__b") - F.col("__a"))).alias("value"))


def taylor(key_rows: DataFrame, keys: list[str], function, slope, start_us: int, end_us: int, period_us: int) -> DataFrame:
    """Tangents of a function at each piece's beginning, given its derivative."""
    cut = key_rows.select(*keys).distinct().withColumn("__a", F.explode(F.sequence(F.lit(start_us), F.lit(end_us - 1), F.lit(period_us))))
    x = F.col("__a") / F.lit(1e6)
    return cut.select(*keys, (F.col("__a") * 2).alias("lo"), (F.least(F.col("__a") + period_us, F.lit(end_us)) * 2).alias("hi"), linear.line(F.col("__a"), function(x), slope(x)).alias("value"))


def slewed(points: DataFrame, keys: list[str], axes: tuple[str, ...], t: str) -> dict[str, DataFrame]:
    """A vector that moves from point to point: one linear profile an axis."""
    return {a: precomputed(points, keys, t, a) for a in axes}
