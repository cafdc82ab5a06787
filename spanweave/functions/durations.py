"""Durations as whole µs, and the texts that stand for durations and times, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanweave.functions.intervals import MAX_US

#: µs of each unit
UNITS = {"us": 1, "ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000, "w": 604_800_000_000, "y": 31_536_000_000_000}


def plus(a: Column, b: Column) -> Column:
    return a + b


def minus(a: Column, b: Column) -> Column:
    return a - b


def times(a: Column, k: Column | int) -> Column:
    return a * k


def divided_by(a: Column, b: Column | int) -> Column:
    """Whole quotient, towards zero."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("long"))


def remainder(a: Column, b: Column | int) -> Column:
    return a % b


def ratio_over(a: Column, b: Column | int) -> Column:
    return a.cast("double") / b


def saturating_add(a: Column, b: Column) -> Column:
    """A sum that stays within the largest durations."""
    low, high = F.lit(-MAX_US).cast("long"), F.lit(MAX_US).cast("long")
    return F.greatest(low, F.least(high, F.coalesce(F.try_add(a, b), F.when(b > 0, high).when(b < 0, low))))


def rounded_nearest(quantity: Column, unit_us: int) -> Column:
    """A number of units as µs: the fraction to the nearest, halves to even."""
    whole = F.when(quantity < 0, F.ceil(quantity)).otherwise(F.floor(quantity))
    return (whole * unit_us + F.rint((quantity - whole) * unit_us)).cast("long")


def rounded_up(quantity: Column, unit_us: int) -> Column:
    whole = F.when(quantity < 0, F.ceil(quantity)).otherwise(F.floor(quantity))
    return (whole * unit_us + F.ceil((quantity - whole) * unit_us)).cast("long")


def rounded_down(quantity: Column, unit_us: int) -> Column:
    whole = F.when(quantity < 0, F.ceil(quantity)).otherwise(F.floor(quantity))
    return (whole * unit_us + F.floor((quantity - whole) * unit_us)).cast("long")


def number(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")).try_cast("long"), F.lit(0).cast("long"))


CLOCK = r"^([+-]?)(\d+):([0-5]?\d):([0-5]?\d)(?:\.(\d{1,6}))?$"


def from_clock(text: Column) -> Column:
    """µs of [+-]hh:mm:ss[.uuuuuu]; NULL for other texts."""
    part = lambda k: F.regexp_extract(text, CLOCK, k)
    us = number(part(2)) * UNITS["h"] + number(part(3)) * UNITS["m"] + number(part(4)) * UNITS["s"] + number(F.rpad(part(5), 6, "0"))
    return F.when(text.rlike(CLOCK), F.when(part(1) == "-", -us).otherwise(us))


def to_clock(us: Column) -> Column:
    """[+-]hh:mm:ss.uuuuuu of µs."""
    a = F.abs(us)
    return F.concat(F.when(us < 0, "-").otherwise("+"), F.format_string("%02d:%02d:%02d.%06d", divided_by(a, UNITS["h"]), divided_by(a, UNITS["m"]) % 60, divided_by(a, UNITS["s"]) % 60, a % UNITS["s"]))


ISO = r"^([+-]?)P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)(?:\.(\d{1,6}))?S)?)?$"


def from_iso(text: Column) -> Column:
    """µs of an ISO 8601 duration of days, hours, minutes and seconds; NULL for other texts."""
    part = lambda k: F.regexp_extract(text, ISO, k)
    us = number(part(2)) * UNITS["d"] + number(part(3)) * UNITS["h"] + number(part(4)) * UNITS["m"] + number(part(5)) * UNITS["s"] + number(F.rpad(part(6), 6, "0"))
    return F.when(text.rlike(ISO) & ~text.rlike("[PT]$"), F.when(part(1) == "-", -us).otherwise(us))


def to_iso(us: Column) -> Column:
    """PT..H..M..S, parts that are 0 left out; PT0S for none."""
    a = F.abs(us)
    h, m, s, f = divided_by(a, UNITS["h"]), divided_by(a, UNITS["m"]) % 60, divided_by(a, UNITS["s"]) % 60, a % UNITS["s"]
    part = lambda n, unit: F.when(n > 0, F.concat(n.cast("string"), F.lit(unit))).otherwise("")
    seconds = F.when((s > 0) | (f > 0), F.concat(s.cast("string"), F.when(f > 0, F.concat(F.lit("."), F.rtrim(F.format_string("%06d", f), F.lit("0")))).otherwise(""), F.lit("S"))).otherwise("")
    return F.when(us == 0, "PT0S").otherwise(F.concat(F.when(us < 0, "-").otherwise(""), F.lit("PT"), part(h, "H"), part(m, "M"), seconds))


#: A duration in words of units, the longest unit first
WORDS = r"^([+-]?)(?:\s*(\d+)\s*(?:years?|yr?))?(?:\s*(\d+)\s*(?:weeks?|w))?(?:\s*(\d+)\s*(?:days?|dy?))?(?:\s*(\d+)\s*(?:hours?|hrs?|h))?(?:\s*(\d+)\s*(?:minutes?|mins?|m))?(?:\s*(\d+)\s*(?:seconds?|secs?|s))?(?:\s*(\d+)\s*(?:milliseconds?|ms))?(?:\s*(\d+)\s*(?:microseconds?|us))?\s*$"


def from_words(text: Column) -> Column:
    """µs of texts like 1y 2d 3h 4m 5s 6ms 7us; NULL for other texts."""
    part = lambda k: number(F.regexp_extract(text, WORDS, k))
    us = sum((part(k) * UNITS[u] for k, u in enumerate(("y", "w", "d", "h", "m", "s", "ms", "us"), 2)), F.lit(0).cast("long"))
    return F.when(text.rlike(WORDS) & text.rlike(r"\d"), F.when(F.regexp_extract(text, WORDS, 1) == "-", -us).otherwise(us))


def to_words(us: Column) -> Column:
    """1y 2d 3h 4m 5s 6ms 7us, parts that are 0 left out; 0s for none."""
    rest, parts = F.abs(us), []
    for unit in ("y", "d", "h", "m", "s", "ms", "us"):
        n = divided_by(rest, UNITS[unit])
        parts.append(F.when(n > 0, F.concat(n.cast("string"), F.lit(unit))))
        rest = rest % UNITS[unit]
    return F.when(us == 0, "0s").otherwise(F.concat(F.when(us < 0, "-").otherwise(""), F.concat_ws(" ", *parts)))


def balanced(us: Column) -> Column:
    """A struct of days, hours, minutes, seconds, milliseconds and microseconds, each below the next unit."""
    a = F.abs(us)
    parts = [("days", "d", None), ("hours", "h", 24), ("minutes", "m", 60), ("seconds", "s", 60), ("milliseconds", "ms", 1000), ("microseconds", "us", 1000)]
    sign = F.when(us < 0, F.lit(-1)).otherwise(F.lit(1))
    return F.struct(sign.alias("sign"), *[(divided_by(a, UNITS[u]) if m is None else divided_by(a, UNITS[u]) % m).alias(n) for n, u, m in parts])


# --- instants

DOY = r"^(\d{4})-(\d{3})T([01]\d|2[0-3]):([0-5]\d):([0-5]\d)(?:\.(\d{1,6}))?Z?$"
YMD = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,6})?Z?$"


def add_to_instant(ts: Column, us: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) + us)


def from_doy(text: Column) -> Column:
    """The timestamp of yyyy-dddThh:mm:ss[.f]; NULL for other texts and days that the year lacks."""
    part = lambda k: F.regexp_extract(text, DOY, k)
    new_year = F.make_date(part(1).try_cast("int"), F.lit(1), F.lit(1))
    day = F.date_add(new_year, (number(part(2)) - 1).cast("int"))
    us = number(part(3)) * UNITS["h"] + number(part(4)) * UNITS["m"] + number(part(5)) * UNITS["s"] + number(F.rpad(part(6), 6, "0"))
    return F.when(text.rlike(DOY) & (F.year(day) == F.year(new_year)) & (number(part(2)) > 0), F.timestamp_micros(F.unix_micros(day.cast("timestamp")) + us))


def to_doy(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-DDD"), F.lit("T"), F.date_format(ts, "HH:mm:ss.SSS"))


def is_doy(text: Column) -> Column:
    return from_doy(text).isNotNull()


def is_ymd(text: Column) -> Column:
    return text.rlike(YMD)


def latest_of(*texts: Column) -> Column:
    """The latest of several day-of-year times, as its text."""
    return F.array_max(F.array(*[F.struct(from_doy(t).alias("at"), t.alias("text")) for t in texts]))["text"]


def add_time(text: Column, us: Column) -> Column:
    """A day-of-year time moved by µs."""
    return to_doy(add_to_instant(from_doy(text), us))


def subtract_time(text: Column, us: Column) -> Column:
    return add_time(text, -us)


def format_as_date(text: Column, form: str = "yyyy-MM-dd") -> Column:
    return F.date_format(from_doy(text), form)


def flatten(values: Column, separator: str = " ") -> Column:
    return F.array_join(values, separator)
