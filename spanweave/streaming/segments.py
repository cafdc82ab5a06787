"""Profiles from a stream of resource updates: each update closes the segment before it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from spanweave.operators import serial

SEGMENTS = "name string, lo long, hi long, value double"
STATE = "t long, value double"


def closed_segments(updates: DataFrame) -> DataFrame:
    """(name, lo, hi, value) from a stream (name, t in µs, value, is_end): the open segment of each resource is its state.

    An update of is_end closes the last one, its end included, and forgets the
    resource. An update before the last one seen is an error, as profiles only
    grow; put withWatermark and a sort before it where late ones may come.
    """

    def step(key, batches, state):
        (name,) = key
        at, value = state.get if state.exists else (None, None)
        out = []
        rows = pd.concat(list(batches)).sort_values(["t", "is_end"], kind="stable")
        for t, v, is_end in zip(rows["t"], rows["value"], rows["is_end"], strict=True):
            if at is not None and t < at:
                raise ValueError(f"an update of {name} at {t} comes after one at {at}")
            if at is not None and (t > at or is_end):
                out.append((name, 2 * at, 2 * t + (1 if is_end else 0), value))
            at, value = (None, None) if is_end else (int(t), float(v))
        if at is None:
            if state.exists:
                state.remove()
        else:
            state.update((at, value))
        yield pd.DataFrame(out, columns=["name", "lo", "hi", "value"])

    return updates.select("name", "t", "value", "is_end").groupBy("name").applyInPandasWithState(step, SEGMENTS, STATE, "append", GroupStateTimeout.NoTimeout)


def closed_in_batch(updates: DataFrame, end_us: int) -> DataFrame:
    """The same of a table (name, t, value), closed at an instant; equal neighbours joined."""
    w = Window.partitionBy("name").orderBy("t")
    pieces = updates.select("name", (F.col("t") * 2).alias("lo"), F.coalesce(F.lead("t").over(w) * 2, F.lit(2 * end_us + 1)).alias("hi"), "value").filter("lo < hi")
    return serial.coalesce(pieces, ["name"])


def in_order(updates: DataFrame) -> DataFrame:
    """Updates (name, seq, t, ...) whose times don't fall; an error otherwise."""
    before = F.lag("t").over(Window.partitionBy("name").orderBy("seq"))
    checked = F.when(before > F.col("t"), F.raise_error(F.lit("an update comes after a later one")).cast("long")).otherwise(F.col("t"))
    return updates.withColumn("t", checked)


def appended(stream: DataFrame, path: str, checkpoint: str, kind: str = "parquet"):
    """A running query that appends a stream's segments by resource to files; stop() cancels it, recentProgress tells how far it is."""
    return stream.writeStream.format(kind).option("path", path).option("checkpointLocation", checkpoint).partitionBy("name").outputMode("append").start()


def upserted(stream: DataFrame, write, checkpoint: str):
    """A running query that hands each batch to write(df, batch number): refreshed views, database sinks."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append").start()


def refreshed(changed_groups: DataFrame, recompute, view_path: str, by: str) -> None:
    """A view's partitions (by) that changes touch, computed anew; others stay."""
    recompute(changed_groups.select(by).distinct()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(view_path)


def windowed(stream: DataFrame, t: str, late: str, length: str, slide: str | None = None, session_gap: str | None = None) -> DataFrame:
    """Counts by name over tumbling, sliding or session windows of event time, with late rows up to a watermark."""
    marked = stream.withWatermark(t, late)
    over = F.session_window(t, session_gap) if session_gap else F.window(t, length, slide or length)
    return marked.groupBy("name", over.alias("window")).agg(F.count(F.lit(1)).alias("n"))
