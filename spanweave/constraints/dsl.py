"""A builder of constraint expressions: objects that hold JSON trees, which evaluate.check runs."""

from __future__ import annotations

from dataclasses import dataclass


def tree(x):
    return x.node if isinstance(x, Expression) else x


@dataclass(frozen=True)
class Expression:
    node: dict


def _(kind: str, **fields) -> dict:
    return {"kind": kind, **{k: [tree(x) for x in v] if isinstance(v, list | tuple) else {a: tree(b) for a, b in v.items()} if isinstance(v, dict) and "kind" not in v else tree(v) for k, v in fields.items() if v is not None}}


class Interval(Expression):
    @staticmethod
    def Between(start=None, end=None, start_inclusivity="Inclusive", end_inclusivity="Inclusive") -> Interval:
        return Interval(_("AbsoluteInterval", start=start, end=end, startInclusivity=start_inclusivity, endInclusivity=end_inclusivity))

    @staticmethod
    def At(time) -> Interval:
        return Interval.Between(time, time)

    @staticmethod
    def Horizon() -> Interval:
        return Interval(_("AbsoluteInterval"))

    def duration(self) -> Expression:
        return Expression(_("IntervalDuration", interval=self))


class Constraint(Expression):
    @staticmethod
    def ForEachActivity(activity_type: str, body, alias: str | None = None) -> Constraint:
        alias = alias or f"activity alias {activity_type}"
        return Constraint(_("ForEachActivityViolations", activityType=activity_type, alias=alias, expression=violations(body(ActivityInstance(activity_type, alias)))))

    @staticmethod
    def ForbiddenActivityOverlap(first: str, second: str) -> Constraint:
        """No activity of one type while one of another is active."""
        return Constraint.ForEachActivity(first, lambda a: Constraint.ForEachActivity(second, lambda b: Windows.And(a.window(), b.window()).not_(), "activity alias 2"), "activity alias 1")

    @staticmethod
    def RollingThreshold(spans: Spans, width, threshold, algorithm: str) -> Constraint:
        return Constraint(_("RollingThreshold", spans=spans, width=width, threshold=threshold, algorithm=algorithm))


def violations(x: Expression) -> Expression:
    return x.violations() if isinstance(x, Windows) else x


class Windows(Expression):
    @staticmethod
    def Value(value: bool, interval: Interval | None = None) -> Windows:
        return Windows(_("WindowsExpressionValue", value=value, interval=interval))

    @staticmethod
    def During(*activity_types: str) -> Windows:
        """Whether an activity of the types is active."""
        return Windows.Or(*[Spans.ForEachActivity(t, lambda a: a.span()).windows() for t in activity_types])

    @staticmethod
    def And(*windows: Windows) -> Windows:
        return Windows(_("WindowsExpressionAnd", expressions=list(windows)))

    @staticmethod
    def Or(*windows: Windows) -> Windows:
        return Windows(_("WindowsExpressionOr", expressions=list(windows)))

    def and_(self, *others: Windows) -> Windows:
        return Windows.And(self, *others)

    def or_(self, *others: Windows) -> Windows:
        return Windows.Or(self, *others)

    def not_(self) -> Windows:
        return Windows(_("WindowsExpressionNot", expression=self))

    def if_(self, condition: Windows) -> Windows:
        return Windows.Or(condition.not_(), self)

    def violations(self) -> Constraint:
        return Constraint(_("ViolationsOf", expression=self))

    def longer_than(self, duration) -> Windows:
        return Windows(_("WindowsExpressionLongerThan", windowExpression=self, duration=duration))

    def shorter_than(self, duration) -> Windows:
        return Windows(_("WindowsExpressionShorterThan", windowExpression=self, duration=duration))

    def shift_by(self, from_start, from_end=None) -> Windows:
        return Windows(_("IntervalsExpressionShiftEdges", expression=self, fromStart=from_start, fromEnd=from_start if from_end is None else from_end))

    def split(self, pieces: int, start_inclusivity="Inclusive", end_inclusivity="Exclusive") -> Spans:
        return Spans(_("SpansExpressionSplit", intervals=self, numberOfSubIntervals=pieces, internalStartInclusivity=start_inclusivity, internalEndInclusivity=end_inclusivity))

    def starts(self) -> Windows:
        return Windows(_("IntervalsExpressionStarts", expression=self))

    def ends(self) -> Windows:
        return Windows(_("IntervalsExpressionEnds", expression=self))

    def spans(self) -> Spans:
        return Spans(_("SpansExpressionFromWindows", windowsExpression=self))

    def assign_gaps(self, default) -> Windows:
        return Windows(_("AssignGapsExpression", originalProfile=self, defaultProfile=default if isinstance(default, Expression) else Windows.Value(default)))

    def accumulated_duration(self, unit) -> Real:
        return Real(_("RealProfileAccumulatedDuration", intervalsExpression=self, unit=unit))

    def keep_true_segment(self, index: int) -> Windows:
        return Windows(_("WindowsExpressionKeepTrueSegment", expression=self, index=index))


class Spans(Expression):
    @staticmethod
    def FromInterval(interval: Interval) -> Spans:
        return Spans(_("SpansExpressionInterval", interval=interval))

    @staticmethod
    def ForEachActivity(activity_type: str, body, alias: str | None = None) -> Spans:
        alias = alias or f"span activity alias {activity_type}"
        return Spans(_("ForEachActivitySpans", activityType=activity_type, alias=alias, expression=body(ActivityInstance(activity_type, alias))))

    split, accumulated_duration = Windows.split, Windows.accumulated_duration

    def starts(self) -> Spans:
        return Spans(Windows.starts(self).node)

    def ends(self) -> Spans:
        return Spans(Windows.ends(self).node)

    def shift_by(self, from_start, from_end=None) -> Spans:
        return Spans(Windows.shift_by(self, from_start, from_end).node)

    def connect_to(self, other: Spans) -> Spans:
        return Spans(_("SpansExpressionConnectTo", **{"from": self, "to": other}))

    def windows(self) -> Windows:
        return Windows(_("WindowsExpressionFromSpans", spansExpression=self))

    def select_when_true(self, windows: Windows) -> Spans:
        return Spans(_("SpansSelectWhenTrue", spansExpression=self, windowsExpression=windows))

    def contains(self, children: Spans, count: dict | None = None, duration: dict | None = None) -> Windows:
        return Windows({"kind": "SpansExpressionContains", "parents": self.node, "children": children.node, "requirement": {"count": count or {}, "duration": {k: tree(v) for k, v in (duration or {}).items()}}})


class Profile(Expression):
    def value_at(self, timepoint: Spans):
        return type(self)(_("ValueAtExpression", profile=self, timepoint=timepoint))

    def equal(self, other) -> Windows:
        return Windows(_("ExpressionEqual", left=self, right=self.wrapped(other)))

    def not_equal(self, other) -> Windows:
        return Windows(_("ExpressionNotEqual", left=self, right=self.wrapped(other)))

    def changes(self) -> Windows:
        return Windows(_("ProfileChanges", expression=self))

    def assign_gaps(self, default):
        return type(self)(_("AssignGapsExpression", originalProfile=self, defaultProfile=self.wrapped(default)))

    def shift_by(self, duration):
        return type(self)(_("ProfileExpressionShiftBy", expression=self, duration=duration))

    @classmethod
    def wrapped(cls, x) -> Expression:
        return x if isinstance(x, Expression) else cls.Value(x)


class Real(Profile):
    @staticmethod
    def Resource(name: str) -> Real:
        return Real(_("RealProfileResource", name=name))

    @staticmethod
    def Value(value: float, rate: float = 0.0, interval: Interval | None = None) -> Real:
        return Real(_("RealProfileValue", value=value, rate=rate, interval=interval))

    def rate(self) -> Real:
        return Real(_("RealProfileRate", profile=self))

    def times(self, factor: float) -> Real:
        return Real(_("RealProfileTimes", profile=self, multiplier=factor))

    def plus(self, other) -> Real:
        return Real(_("RealProfilePlus", left=self, right=Real.wrapped(other)))

    def negate(self) -> Real:
        return self.times(-1)

    def minus(self, other) -> Real:
        return self.plus(Real.wrapped(other).negate())

    def less_than(self, other) -> Windows:
        return Windows(_("RealProfileLessThan", left=self, right=Real.wrapped(other)))

    def less_than_or_equal(self, other) -> Windows:
        return Windows(_("RealProfileLessThanOrEqual", left=self, right=Real.wrapped(other)))

    def greater_than(self, other) -> Windows:
        return Windows(_("RealProfileGreaterThan", left=self, right=Real.wrapped(other)))

    def greater_than_or_equal(self, other) -> Windows:
        return Windows(_("RealProfileGreaterThanOrEqual", left=self, right=Real.wrapped(other)))

    def is_within(self, other, tolerance) -> Windows:
        """Whether it differs from another profile by no more than a tolerance."""
        other = Real.wrapped(other)
        return Windows.And(self.less_than_or_equal(other.plus(tolerance)), self.greater_than_or_equal(other.minus(tolerance)))


class Discrete(Profile):
    @staticmethod
    def Resource(name: str) -> Discrete:
        return Discrete(_("DiscreteProfileResource", name=name))

    @staticmethod
    def Value(value, interval: Interval | None = None) -> Discrete:
        return Discrete({"kind": "DiscreteProfileValue", "value": value, **({"interval": interval.node} if interval else {})})

    @staticmethod
    def Map(expressions: dict) -> Discrete:
        return Discrete({"kind": "StructProfileExpression", "expressions": {k: tree(Discrete.wrapped(v)) for k, v in expressions.items()}})

    @staticmethod
    def List(*expressions) -> Discrete:
        return Discrete({"kind": "ListProfileExpression", "expressions": [tree(Discrete.wrapped(v)) for v in expressions]})

    def transition(self, old, new) -> Windows:
        return Windows({"kind": "DiscreteProfileTransition", "profile": self.node, "from": old, "to": new})


@dataclass(frozen=True)
class ActivityInstance:
    """The activity of a loop."""

    activity_type: str
    alias: str

    def span(self) -> Spans:
        return Spans(_("SpansExpressionActivitySpan", alias=self.alias))

    def window(self) -> Windows:
        return Windows(_("WindowsExpressionActivityWindow", alias=self.alias))

    def start(self) -> Windows:
        return Windows(_("WindowsExpressionStartOf", alias=self.alias))

    def end(self) -> Windows:
        return Windows(_("WindowsExpressionEndOf", alias=self.alias))

    def interval(self) -> Interval:
        return Interval(_("IntervalAlias", alias=self.alias))

    def parameter(self, name: str) -> Discrete:
        return Discrete(_("DiscreteProfileParameter", alias=self.alias, name=name))

    def real_parameter(self, name: str) -> Real:
        return Real(_("RealProfileParameter", alias=self.alias, name=name))
