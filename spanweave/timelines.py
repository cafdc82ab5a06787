"""Timelines as objects whose methods chain: lazy like the DataFrames they hold, collected on bounds at the end.

Serial timelines (profiles, windows) don't overlap within a key and are
coalesced; parallel ones (spans, activities, events) may overlap and never
are. The kind decides whether an operation sweeps or joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.functions import intervals as iv
from spanweave.operators import accumulate, linear, parallel, resources, serial


class Timeline:
    """Rows (keys, lo, hi, ...); keys tell timelines apart."""

    serial = False

    def __init__(self, df: DataFrame, keys: list[str]):
        self.df, self.keys = df, list(keys)

    def of(self, df: DataFrame, kind: type | None = None):
        return (kind or type(self))(df, self.keys)

    def collect(self, bounds: tuple[int, int] = iv.FOREVER) -> DataFrame:
        """The rows within bounds, cut to them."""
        return serial.clip(self.df, bounds)

    def sorted(self) -> DataFrame:
        return self.df.orderBy(*self.keys, "lo", "hi")

    def cache(self):
        return self.of(self.df.persist())

    def inspect(self, name: str, *measures: Column):
        """Measures of the rows as they pass, for a listener to read."""
        return self.of(self.df.observe(name, *(measures or (F.count(F.lit(1)).alias("rows"),))))

    def unsafe_operate(self, change, kind: type | None = None):
        """Any change of the DataFrame."""
        return self.of(change(self.df), kind)

    def convert(self, kind: type):
        """As another kind; a serial one coalesces."""
        return self.of(kind.prepared(self.df, self.keys), kind)

    def unsafe_cast(self, kind: type):
        return self.of(self.df, kind)

    @classmethod
    def prepared(cls, df: DataFrame, keys: list[str]) -> DataFrame:
        return df

    # --- filters

    def filter(self, test: Column, bounds: tuple[int, int] | None = None):
        """Rows for which a test of the whole row holds, cut to bounds only after it."""
        out = self.df.filter(test)
        return self.of(serial.clip(out, bounds) if bounds else out)

    def filter_by_duration(self, least_us: int = 0, most_us: int = iv.MAX_US):
        return self.of(serial.filter_by_duration(self.df, least_us, most_us))

    def filter_shorter_than(self, us: int):
        return self.of(serial.shorter_than(self.df, us))

    def filter_longer_than(self, us: int):
        return self.of(serial.longer_than(self.df, us))

    def filter_by_windows(self, windows: Windows, truncate: bool = True):
        return self.of(parallel.filter_by_windows(self.df, windows.df, self.keys, truncate))

    def isolate(self, test: Column) -> Universal:
        return self.of(self.df.filter(test), Universal)

    def highlight(self, test: Column) -> Windows:
        return self.of(serial.union_of(self.df.filter(test), self.keys), Windows)

    def highlight_all(self) -> Windows:
        return self.highlight(F.lit(True))

    def collect_intervals(self) -> DataFrame:
        return self.df.select(*self.keys, "lo", "hi")

    def select(self, low: int, high: int):
        return self.of(serial.clip(self.df, (low, high)))

    def unset(self, low: int, high: int):
        return self.of(serial.unset(self.df, low, high))

    # --- maps

    def shift(self, us: int):
        return self.of(serial.shift(self.df, us))

    def unsafe_map(self, **columns: Column):
        return self.of(self.df.withColumns(columns))

    def unsafe_map_intervals(self, lo: Column, hi: Column):
        return self.of(self.df.withColumns({"lo": lo, "hi": hi}).filter("lo < hi"))

    def unsafe_flat_map(self, pieces: Column, kind: type | None = None):
        """pieces: an array of structs with lo and hi, cut to the row's own interval."""
        out = self.df.withColumn("__p", F.explode(pieces)).select(*self.keys, F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), "__p.*")
        cut = out.withColumns({"lo": F.greatest("lo", "__lo"), "hi": F.least("hi", "__hi")}).filter("lo < hi").drop("__lo", "__hi")
        kind = kind or type(self)
        return self.of(kind.prepared(cut, self.keys), kind)

    def unsafe_map2(self, other: Timeline, columns: dict[str, Column], kind: type | None = None):
        """columns of pairs that overlap (l_..., r_...), on the overlap."""
        pairs = parallel.clipped_pairs(parallel.overlap_join(self.df, other.df, self.keys))
        return self.of(pairs.select(*self.keys, "lo", "hi", *[c.alias(n) for n, c in columns.items()]), kind or Universal)


class Parallel(Timeline):
    def merge(self, *others: Timeline):
        return self.of(parallel.merge(self.df, *[o.df for o in others]))

    def filter_by_type(self, *types: str):
        return self.of(self.df.filter(F.col("type").isin(*types)))

    def filter_by_source(self, *keys: str):
        return self.of(self.df.filter(F.col("source_key").isin(*keys)))

    def filter_by_derivation_group(self, *groups: str):
        return self.of(self.df.filter(F.col("derivation_group").isin(*groups)))

    def map_into_profile(self, value: Column) -> DataFrame:
        """A segment a row, which may overlap."""
        return self.df.select(*self.keys, "lo", "hi", value.alias("value"))

    def flatten_into_profile(self, value: Column) -> Constants:
        return self.of(parallel.flatten_into_profile(self.map_into_profile(value), self.keys), Constants)

    def reduce_into_profile(self, aggregate) -> Constants:
        return self.of(accumulate.reduced(self.df, self.keys, aggregate), Constants)

    def active(self, bounds: tuple[int, int] = iv.FOREVER) -> Booleans:
        return self.of(parallel.active(self.df, self.keys, bounds), Booleans)

    def count_active(self, bounds: tuple[int, int] = iv.FOREVER) -> Numbers:
        return self.of(parallel.count_active(self.df, self.keys, bounds), Numbers)

    def accumulated_duration(self, unit_us: int = accumulate.SECOND) -> Real:
        return self.of(accumulate.accumulated_spans(self.df, self.keys, unit_us), Real)

    def rolling_duration(self, range_us: int, unit_us: int = accumulate.SECOND) -> Real:
        return self.of(accumulate.rolling_duration(self.df, self.keys, range_us, unit_us), Real)

    def starts(self):
        return self.of(serial.spans_at_starts(self.df))

    def ends(self):
        return self.of(serial.spans_at_ends(self.df))

    def shift_endpoints(self, start_us: int, end_us: int | None = None):
        return self.of(serial.shift_edges(self.df, start_us, start_us if end_us is None else end_us))

    def extend(self, us: int):
        return self.shift_endpoints(0, us)

    def split(self, pieces: int):
        return self.of(serial.split(self.df, pieces, strict=True).drop("piece"))

    def connect_to(self, other: Parallel, payload: str, bounds: tuple[int, int] | None = None) -> Universal:
        return self.of(parallel.connect_to(self.df, other.df, self.keys, payload, bounds), Universal)

    def is_subset_of(self, other: Parallel) -> DataFrame:
        return parallel.is_subset(self.df, other.df)


class Universal(Parallel):
    pass


class Spans(Parallel):
    def intersect_with(self, windows: Booleans):
        return self.of(parallel.select_when_true(self.df, windows.df, self.keys))


class Instances(Spans):
    pass


class Directives(Parallel):
    pass


class ExternalEvents(Parallel):
    pass


class Windows(Timeline):
    """A set of times: coalesced intervals without values."""

    serial = True

    @classmethod
    def prepared(cls, df, keys):
        return serial.union_of(df, keys)

    def union(self, *others: Windows) -> Windows:
        rows = [x.collect_intervals() for x in (self, *others)]
        return self.of(serial.union_of(reduce(DataFrame.unionByName, rows), self.keys))

    def intersection(self, other: Windows) -> Windows:
        return self.of(serial.union_of(parallel.clipped_pairs(parallel.overlap_join(self.collect_intervals(), other.collect_intervals(), self.keys)), self.keys))

    def complement(self, bounds: tuple[int, int], key_rows: DataFrame | None = None) -> Windows:
        return self.of(serial.complement(self.df, self.keys, bounds, key_rows))

    def minus(self, other: Windows) -> Windows:
        true = lambda x: x.collect_intervals().withColumn("value", F.lit(True))
        return self.of(serial.uncovered(true(self), true(other), self.keys))

    def starts(self) -> Windows:
        return self.of(serial.union_of(serial.spans_at_starts(self.df), self.keys))

    def ends(self) -> Windows:
        return self.of(serial.union_of(serial.spans_at_ends(self.df), self.keys))

    def shift_endpoints(self, start_us: int, end_us: int | None = None) -> Windows:
        return self.of(serial.union_of(serial.shift_edges(self.df, start_us, start_us if end_us is None else end_us), self.keys))

    def extend(self, us: int) -> Windows:
        return self.shift_endpoints(0, us)


class Constants(Timeline):
    """A step profile of any values."""

    serial = True

    @classmethod
    def prepared(cls, df, keys):
        return serial.coalesce_truncating(df, keys)

    def map_values(self, value: Column, kind: type | None = None):
        return self.of(serial.map_values(self.df, self.keys, value), kind)

    def flat_map_values(self, pieces: Column, kind: type | None = None):
        return self.unsafe_flat_map(pieces, kind)

    def map2_values(self, other: Constants, value: Column, kind: type | None = None):
        """value of a and b where both are defined."""
        both = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), value)
        return self.map2_optional_values(other, both, kind)

    def map2_optional_values(self, other: Constants, value: Column, kind: type | None = None):
        return self.of(serial.combine({"a": self.df, "b": other.df}, self.keys, value), kind)

    def flat_map2_optional_values(self, other: Constants, pieces: Column, kind: type | None = None):
        return self.of(serial.flat_combine({"a": self.df, "b": other.df}, self.keys, pieces), kind)

    def flat_map2_values(self, other: Constants, pieces: Column, kind: type | None = None):
        return self.flat_map2_optional_values(other, F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), pieces), kind)

    def assign_gaps(self, default):
        if isinstance(default, Constants):
            return self.of(serial.assign_gaps(self.df, default.df, self.keys))
        return self.of(serial.assign_gaps(self.df, serial.constant(self.df, self.keys, F.lit(default)), self.keys))

    def set(self, other: Constants):
        return self.of(serial.set_over(self.df, other.df, self.keys))

    def zip(self, other: Constants):
        return self.of(serial.zip_disjoint(self.df, other.df, self.keys))

    def equal_to(self, other) -> Booleans:
        return self.compared(other, lambda a, b: a == b)

    def not_equal_to(self, other) -> Booleans:
        return self.compared(other, lambda a, b: a != b)

    def compared(self, other, test) -> Booleans:
        if isinstance(other, Constants):
            return self.map2_optional_values(other, test(F.col("a"), F.col("b")), Booleans)
        return self.map_values(test(F.col("value"), F.lit(other)), Booleans)

    def isolate_equal_to(self, value) -> Universal:
        return self.isolate(F.col("value") == F.lit(value))

    def highlight_equal_to(self, value) -> Windows:
        return self.highlight(F.col("value") == F.lit(value))

    def split_equal_to(self, value, pieces: int) -> Universal:
        return self.of(serial.split(self.isolate_equal_to(value).df, pieces, strict=True).drop("piece"), Universal)

    def changes(self) -> Booleans:
        return self.of(serial.change_profile(self.df, self.keys), Booleans)

    def transitions(self, old, new) -> Booleans:
        return self.of(serial.transition_profile(self.df, self.keys, old, new), Booleans)

    def detect_edges(self, test) -> Booleans:
        return self.of(serial.detect_edges(self.df, self.keys, test), Booleans)

    def sample(self, t_us: int) -> DataFrame:
        return self.df.filter(iv.contains_point(F.col("lo"), F.col("hi"), F.lit(t_us))).select(*self.keys, "value")


class Booleans(Constants):
    def operate(self, other: Booleans, value: Column) -> Booleans:
        return self.map2_optional_values(other, value)

    def and_(self, other: Booleans) -> Booleans:
        return self.operate(other, F.col("a") & F.col("b"))

    def or_(self, other: Booleans) -> Booleans:
        return self.operate(other, F.col("a") | F.col("b"))

    def xor(self, other: Booleans) -> Booleans:
        return self.operate(other, F.col("a") != F.col("b"))

    def nor(self, other: Booleans) -> Booleans:
        return self.operate(other, ~(F.col("a") | F.col("b")))

    def nand(self, other: Booleans) -> Booleans:
        return self.operate(other, ~(F.col("a") & F.col("b")))

    def add(self, other: Booleans) -> Booleans:
        return self.operate(other, F.coalesce(F.col("a") | F.col("b"), "a", "b"))

    def not_(self) -> Booleans:
        return self.map_values(~F.col("value"))

    def falsify_by_duration(self, least_us: int = 0, most_us: int = iv.MAX_US) -> Booleans:
        return self.of(serial.falsify_by_duration(self.df, self.keys, least_us, most_us))

    def falsify_shorter_than(self, us: int) -> Booleans:
        return self.falsify_by_duration(us)

    def falsify_longer_than(self, us: int) -> Booleans:
        return self.falsify_by_duration(0, us)

    def isolate_true(self) -> Universal:
        return self.isolate(F.col("value"))

    def isolate_false(self) -> Universal:
        return self.isolate(~F.col("value"))

    def highlight_true(self) -> Windows:
        return self.highlight(F.col("value"))

    def highlight_false(self) -> Windows:
        return self.highlight(~F.col("value"))

    def split_true(self, pieces: int) -> Universal:
        return self.split_equal_to(True, pieces)

    def split_false(self, pieces: int) -> Universal:
        return self.split_equal_to(False, pieces)

    def shift_edges(self, rising_us: int, falling_us: int | None = None) -> Booleans:
        return self.of(serial.shift_window_edges(self.df, self.keys, rising_us, rising_us if falling_us is None else falling_us))

    def accumulated_true_duration(self, unit_us: int = accumulate.SECOND) -> Real:
        return self.of(accumulate.accumulated_windows(self.df, self.keys, unit_us), Real)

    def rolling_true_duration(self, range_us: int, unit_us: int = accumulate.SECOND) -> Real:
        return self.of(accumulate.rolling_true_duration(self.df, self.keys, range_us, unit_us), Real)

    def rising_edges(self) -> Booleans:
        return self.transitions(False, True)

    def falling_edges(self) -> Booleans:
        return self.transitions(True, False)

    def includes(self, other: Booleans) -> DataFrame:
        """Times at which the other is true and this isn't: none if it includes it."""
        return serial.uncovered(other.df, self.df, self.keys)


class Numbers(Constants):
    def arithmetic(self, other, change) -> Numbers:
        if isinstance(other, Constants):
            return self.map2_values(other, change(F.col("a"), F.col("b")))
        return self.map_values(change(F.col("value"), F.lit(other)))

    def plus(self, other) -> Numbers:
        return self.arithmetic(other, lambda a, b: a + b)

    def minus(self, other) -> Numbers:
        return self.arithmetic(other, lambda a, b: a - b)

    def times(self, other) -> Numbers:
        return self.arithmetic(other, lambda a, b: a * b)

    def div(self, other) -> Numbers:
        return self.arithmetic(other, lambda a, b: a / b)

    def pow(self, other) -> Numbers:
        return self.arithmetic(other, F.pow)

    def negate(self) -> Numbers:
        return self.map_values(-F.col("value"))

    def abs(self) -> Numbers:
        return self.map_values(F.abs("value"))

    def less_than(self, other) -> Booleans:
        return self.compared(other, lambda a, b: a < b)

    def less_than_or_equal_to(self, other) -> Booleans:
        return self.compared(other, lambda a, b: a <= b)

    def greater_than(self, other) -> Booleans:
        return self.compared(other, lambda a, b: a > b)

    def greater_than_or_equal_to(self, other) -> Booleans:
        return self.compared(other, lambda a, b: a >= b)

    def increases(self) -> Booleans:
        return self.of(serial.edge_profile(self.df, self.keys, lambda before, after: after > before), Booleans)

    def decreases(self) -> Booleans:
        return self.of(serial.edge_profile(self.df, self.keys, lambda before, after: after < before), Booleans)

    def cast(self, kind: str) -> Numbers:
        """double, float, long, int, short or byte; numbers that don't fit wrap around, as machine integers do."""
        bits = {"long": 64, "int": 32, "short": 16, "byte": 8}.get(kind)
        if bits is None or bits == 64:
            return self.map_values(F.col("value").cast(kind))
        whole = F.col("value").cast("long")
        low = F.pmod(whole + (1 << (bits - 1)), F.lit(1 << bits)) - (1 << (bits - 1))
        return self.map_values(low.cast(kind))

    def integrate(self, unit_us: int = accumulate.SECOND) -> Real:
        return self.of(accumulate.integrate(self.df, self.keys, unit_us), Real)

    def to_real(self) -> Real:
        return self.of(linear.from_numbers(self.df), Real)

    def binned(self, thresholds: dict[float, str]) -> Constants:
        return self.of(accumulate.binned(self.df, self.keys, thresholds), Constants)

    def sampled(self, period_us: int) -> Numbers:
        return self.of(resources.sampled(self.df, self.keys, period_us))


class Strings(Constants):
    def length(self) -> Numbers:
        return self.map_values(F.length("value"), Numbers)

    def case_insensitive_equal_to(self, other) -> Booleans:
        return self.compared(other, lambda a, b: F.lower(a) == F.lower(b))

    def case_insensitive_not_equal_to(self, other) -> Booleans:
        return self.compared(other, lambda a, b: F.lower(a) != F.lower(b))

    def is_empty(self) -> Booleans:
        return self.map_values(F.length("value") == 0, Booleans)

    def is_not_empty(self) -> Booleans:
        return self.map_values(F.length("value") > 0, Booleans)


class Real(Timeline):
    """A piecewise linear profile."""

    serial = True

    @classmethod
    def prepared(cls, df, keys):
        return linear.coalesce(df, keys)

    def other(self, x) -> DataFrame:
        return x.df if isinstance(x, Real) else serial.constant(self.df, self.keys, linear.line(F.lit(0), F.lit(float(x)), F.lit(0.0)))

    def plus(self, x) -> Real:
        return self.of(linear.plus(self.df, self.other(x), self.keys))

    def minus(self, x) -> Real:
        return self.of(linear.minus(self.df, self.other(x), self.keys))

    def times(self, x) -> Real:
        return self.of(linear.times(self.df, self.other(x), self.keys))

    def div(self, x) -> Real:
        return self.of(linear.div(self.df, self.other(x), self.keys))

    def pow(self, x) -> Real:
        return self.of(linear.power(self.df, self.other(x), self.keys))

    def negate(self) -> Real:
        return self.of(linear.negated(self.df, self.keys))

    def abs(self) -> Real:
        return self.of(linear.absolute(self.df, self.keys))

    def rate(self, unit_us: int = linear.SECOND) -> Real:
        return self.of(linear.rate(self.df, self.keys, unit_us))

    def shift(self, us: int) -> Real:
        return self.of(linear.shift(self.df, us))

    def shifted_difference(self, range_us: int) -> Real:
        return self.of(accumulate.shifted_difference(self.df, self.keys, range_us))

    def compared(self, x, op: str) -> Booleans:
        return self.of(linear.compare(self.df, self.other(x), self.keys, op), Booleans)

    def equal_to(self, x) -> Booleans:
        return self.compared(x, "==")

    def not_equal_to(self, x) -> Booleans:
        return self.compared(x, "!=")

    def less_than(self, x) -> Booleans:
        return self.compared(x, "<")

    def less_than_or_equal_to(self, x) -> Booleans:
        return self.compared(x, "<=")

    def greater_than(self, x) -> Booleans:
        return self.compared(x, ">")

    def greater_than_or_equal_to(self, x) -> Booleans:
        return self.compared(x, ">=")

    def highlight_equal_to(self, x) -> Windows:
        return self.of(linear.highlight_equal(self.df, self.other(x), self.keys), Windows)

    def changes(self) -> Booleans:
        return self.of(linear.changes(self.df, self.keys), Booleans)

    def increases(self) -> Booleans:
        return self.of(linear.increases(self.df, self.keys), Booleans)

    def decreases(self) -> Booleans:
        return self.of(linear.decreases(self.df, self.keys), Booleans)

    def transitions(self, old: float, new: float) -> Booleans:
        return self.of(linear.transitions(self.df, self.keys, old, new), Booleans)

    def to_numbers(self) -> Numbers:
        return self.of(linear.to_numbers(self.df, self.keys), Numbers)

    def sample(self, t_us: int) -> DataFrame:
        return linear.sampled(self.df, self.keys, F.lit(t_us))
