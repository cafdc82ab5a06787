"""Dynamic values as canonical JSON text: keys sorted, numbers without needless digits, so that equal values are equal texts."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(value) -> str:
    """The text of a Python value; 1, 1.0 and 1.00 are one number."""

    def plain(v):
        if isinstance(v, dict):
            return {k: plain(v[k]) for k in sorted(v)}
        if isinstance(v, list | tuple):
            return [plain(x) for x in v]
        if isinstance(v, float | Decimal) and not isinstance(v, bool):
            return int(v) if v == int(v) and abs(v) < 2**63 else float(v)
        return v

    return json.dumps(plain(value), separators=(",", ":"), ensure_ascii=False)


def text_of(column: Column, kind: str) -> Column:
    """A typed column's canonical text; kind: its Spark type."""
    if kind == "string":
        quoted = F.to_json(F.struct(column.alias("v")))
        return F.when(column.isNotNull(), F.substring(quoted, 6, F.length(quoted) - 6))  # of {"v":...}
    if kind == "boolean":
        return F.when(column, "true").when(~column, "false")
    if kind in ("double", "float") or kind.startswith("decimal"):
        whole = (column == F.floor(column)) & (F.abs(column) < F.lit(2.0**53))
        return F.when(whole, column.cast("long").cast("string")).otherwise(column.cast("double").cast("string"))
    return column.cast("string")


def number_of(text: Column) -> Column:
    return text.try_cast("double")


def at_path(text: Column, path: str) -> Column:
    return F.get_json_object(text, path)


def matches(pattern, argument: Column, path: str = "$") -> Column:
    """Whether a JSON text holds a pattern: null holds for anything, maps need each key of the pattern, lists match a prefix, numbers their digits exactly."""
    if pattern is None:
        return F.lit(True)
    if isinstance(pattern, dict):
        out = F.lit(True)
        for k, v in pattern.items():
            own = f"{path}['{k}']"
            out = out & (F.get_json_object(argument, own).isNotNull() if v is not None else F.lit(True)) & matches(v, argument, own)
        return out
    if isinstance(pattern, list | tuple):
        out = F.lit(True)
        for k, v in enumerate(pattern):
            out = out & matches(v, argument, f"{path}[{k}]")
        return out
    wanted = pattern if isinstance(pattern, str) else json.dumps(pattern)
    return F.coalesce(F.get_json_object(argument, path) == F.lit(wanted), F.lit(False))
