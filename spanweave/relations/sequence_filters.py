"""Filters of activities for sequences, compiled from JSON to one Column expression that reaches the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that filter fields read; other fields never match
FIELDS = {"Type": "type", "Name": "id", "DirectiveId": "directive_id", "StartOffset": "start_us", "Parameter": None}


def either_case(x: Column) -> Column:
    return F.lower(x.cast("string"))


def test(op: str, value: Column, wanted, is_text: bool) -> Column:
    """value op wanted; texts compare in lower case."""
    if op.startswith("does_not_") or op == "is_not_within":
        positive = {"does_not_equal": "equals", "does_not_include": "includes", "is_not_within": "is_within"}[op]
        return ~F.coalesce(test(positive, value, wanted, is_text), F.lit(False))
    number = value.try_cast("double") if is_text else value.cast("double")
    if op == "equals":
        return either_case(value) == F.lit(str(wanted).lower()) if isinstance(wanted, str) else number == F.lit(wanted)
    if op == "includes":
        if isinstance(wanted, list):
            return either_case(value).isin([str(w).lower() for w in wanted])
        return F.lit(False) if wanted == "" else F.contains(either_case(value), F.lit(str(wanted).lower()))
    if op == "is_greater_than":
        return number > F.lit(wanted)
    if op == "is_less_than":
        return number < F.lit(wanted)
    if op == "is_within":
        low, high = wanted
        return number.between(low, high)
    raise ValueError(f"unknown operator {op}")


def compiled(part: dict) -> Column:
    """One condition: field, operator, value; a parameter by its name in the arguments."""
    name = part["field"]
    if name not in FIELDS:
        return F.lit(False)
    value = F.get_json_object("arguments", f"$['{part['name']}']") if name == "Parameter" else F.col(FIELDS[name])
    return F.coalesce(test(part["operator"], value, part["value"], name in ("Type", "Parameter")), F.lit(part["operator"].startswith("does_not") or part["operator"] == "is_not_within"))


def conjunction(parts: list[dict]) -> Column:
    return reduce(Column.__and__, map(compiled, parts), F.lit(True))


def sequence_filter(activities: DataFrame, spec: dict) -> DataFrame:
    """Activities of the static types or those that a dynamic type filter matches, for which all others hold, and those of their own type.

    spec: static_types, dynamic_types (lists of conditions), others
    (conditions), subfilters (type to conditions), time_range (µs; of starts).
    """
    types = [F.col("type").isin(spec["static_types"])] if spec.get("static_types") else []
    types += [conjunction(own) for own in spec.get("dynamic_types", [])]
    out = reduce(Column.__or__, types) if types else F.lit(True)
    out = out & conjunction(spec.get("others", []))
    for name, own in spec.get("subfilters", {}).items():
        out = out & ((F.col("type") != name) | conjunction(own))
    if "time_range" in spec:
        out = out & F.col("start_us").between(*spec["time_range"])
    return activities.filter(out)


def matching_types(types: DataFrame, parts: list[dict]) -> DataFrame:
    """Activity types (type) that conditions on the type match."""
    return types.filter(conjunction([p for p in parts if p["field"] == "Type"]))


def assigned(activities: DataFrame, spec: dict, sequence_id: str) -> DataFrame:
    """(sequence_id, id): what a filter puts into a sequence."""
    return sequence_filter(activities, spec).select(F.lit(sequence_id).alias("sequence_id"), "id")


def where(df: DataFrame, condition: dict | None = None, order_by: list[dict] = (), limit: int | None = None, offset: int = 0) -> DataFrame:
    """Rows by a nested condition (_and, _or, _not, and column: {_eq, _neq, _gt, _gte, _lt, _lte, _in, _nin, _like, _ilike, _is_null}), in order, cut."""
    ops = {
        "_eq": lambda c, v: c == v, "_neq": lambda c, v: c != v, "_gt": lambda c, v: c > v, "_gte": lambda c, v: c >= v, "_lt": lambda c, v: c < v, "_lte": lambda c, v: c <= v,
        "_in": lambda c, v: c.isin(v), "_nin": lambda c, v: ~c.isin(v), "_like": lambda c, v: c.like(v), "_ilike": lambda c, v: c.ilike(v), "_is_null": lambda c, v: c.isNull() if v else c.isNotNull(),
    }

    def built(x: dict) -> Column:
        out = F.lit(True)
        for k, v in x.items():
            if k == "_and":
                out = out & reduce(Column.__and__, map(built, v), F.lit(True))
            elif k == "_or":
                out = out & reduce(Column.__or__, map(built, v), F.lit(False))
            elif k == "_not":
                out = out & ~built(v)
            else:
                out = out & reduce(Column.__and__, [ops[op](F.col(k), w) for op, w in v.items()], F.lit(True))
        return out

    df = df.filter(built(condition)) if condition else df
    if order_by:
        df = df.orderBy(*[F.col(k).desc() if v.startswith("desc") else F.col(k).asc() for o in order_by for k, v in o.items()])
    df = df.offset(offset) if offset else df
    return df.limit(limit) if limit is not None else df


def aggregate(df: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """One row of count and of sum, avg, min and max of columns (name_op)."""
    of = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}
    return df.agg(F.count(F.lit(1)).alias("count"), *[of[op](c).alias(f"{c}_{op}") for op, cs in fields.items() for c in cs])


def expanded(activities: DataFrame, template: str, columns: list[str]) -> DataFrame:
    """(id, text): a template's {{name}} replaced by columns of the activity, {{arguments.name}} by its arguments."""
    import re

    parts: list[Column] = []
    for k, piece in enumerate(re.split(r"\{\{\s*([\w.]+)\s*\}\}", template)):
        if k % 2 == 0:
            parts.append(F.lit(piece))
        elif piece.startswith("arguments."):
            parts.append(F.coalesce(F.get_json_object("arguments", f"$['{piece[10:]}']"), F.lit("")))
        elif piece in columns:
            parts.append(F.coalesce(F.col(piece).cast("string"), F.lit("")))
        else:
            raise ValueError(f"unknown name in template: {piece}")
    return activities.select("id", F.concat(*parts).alias("text"))
