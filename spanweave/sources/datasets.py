"""Datasets of simulations and external sources as Parquet tables partitioned by dataset_id: scans, writers, JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanweave.functions import durations, json_values
from spanweave.operators import linear

PLAN = "id long, name string, plan_start string, duration string, activities array<struct<id:long,type:string,start_offset:string,arguments:string,anchor_id:long,anchored_to_start:boolean,name:string>>"
LINEAR = "initial double, rate double"


def segments(profile_segments: DataFrame, profiles: DataFrame, close_last: bool = True, offset_us: int = 0) -> DataFrame:
    """(dataset_id, profile_id, name, type, lo, hi, dynamics): each segment up to the next, the last to the profile's end; gaps left out.

    profile_segments: (dataset_id, profile_id, start_us, dynamics, is_gap).
    profiles: (dataset_id, id, name, type, duration_us). close_last: the last
    piece holds its end, as a simulation's does, an external dataset's not.
    """
    own = profiles.select("dataset_id", F.col("id").alias("profile_id"), "name", "type", "duration_us")
    after = F.lead("start_us").over(Window.partitionBy("dataset_id", "profile_id").orderBy("start_us"))
    pieces = profile_segments.withColumn("__next", after).join(own, ["dataset_id", "profile_id"])
    end = F.coalesce(F.col("__next") * 2, F.col("duration_us") * 2 + (1 if close_last else 0))
    rows = pieces.select("dataset_id", "profile_id", "name", "type", (F.col("start_us") * 2 + 2 * offset_us).alias("lo"), (end + 2 * offset_us).alias("hi"), F.when(~F.coalesce("is_gap", F.lit(False)), F.col("dynamics")).alias("dynamics"))
    return rows.filter("dynamics IS NOT NULL AND lo < hi")


def real(rows: DataFrame) -> DataFrame:
    """Segments whose dynamics is {"initial", "rate"} or a number, as linear pieces."""
    parsed = F.from_json("dynamics", LINEAR)
    number = F.col("dynamics").try_cast("double")
    return rows.withColumn("value", linear.line(F.shiftright("lo", 1), F.coalesce(number, parsed["initial"]), F.when(number.isNotNull(), 0.0).otherwise(parsed["rate"]))).drop("dynamics")


def discrete(rows: DataFrame) -> DataFrame:
    """Segments whose dynamics is any JSON text, as a step profile of texts; numbers in one form."""
    number = json_values.number_of(F.col("dynamics"))
    return rows.withColumn("value", F.when(number.isNotNull(), json_values.text_of(number, "double")).otherwise(F.col("dynamics"))).drop("dynamics")


def profiles_of(profiles: DataFrame, dataset_id: int, names: list[str] | None = None) -> DataFrame:
    out = profiles.filter(F.col("dataset_id") == dataset_id)
    return out if names is None else out.filter(F.col("name").isin(names))


def plan_datasets(associations: DataFrame, datasets: DataFrame, plan_id: int, simulation_dataset_id: int | None = None) -> DataFrame:
    """Datasets of a plan with their offset from its start; those of one simulation, and those of none."""
    own = associations.filter(F.col("plan_id") == plan_id)
    if simulation_dataset_id is not None:
        own = own.filter(F.col("simulation_dataset_id").isNull() | (F.col("simulation_dataset_id") == simulation_dataset_id))
    return own.join(datasets, "dataset_id")


def directives(table: DataFrame, plan_id: int, *types: str) -> DataFrame:
    out = table.filter(F.col("plan_id") == plan_id)
    return out.filter(F.col("type").isin(*types)) if types else out


def instances(spans: DataFrame, dataset_id: int, *types: str) -> DataFrame:
    """Simulated activities as spans; a null duration is unfinished and lasts on."""
    own = spans.filter(F.col("dataset_id") == dataset_id)
    own = own.filter(F.col("type").isin(*types)) if types else own
    lo = F.col("start_us") * 2
    return own.withColumns({"lo": lo, "hi": F.when(F.col("duration_us").isNotNull(), lo + F.col("duration_us") * 2 + 1).otherwise(F.lit((1 << 63) - 1))})


def input_directives(snapshots: DataFrame, plan_id: int, revision: int) -> DataFrame:
    return snapshots.filter((F.col("plan_id") == plan_id) & (F.col("revision") == revision))


def events(table: DataFrame, dataset_id: int) -> DataFrame:
    return table.filter(F.col("dataset_id") == dataset_id).orderBy("real_time_us", "transaction_index", "causal_time")


def topics(table: DataFrame, dataset_id: int) -> DataFrame:
    return table.filter(F.col("dataset_id") == dataset_id).select("topic_index", "name", "value_schema")


def cached_simulation(datasets: DataFrame, revisions: dict) -> DataFrame:
    """The latest dataset whose revisions are these; no row if there is none."""
    same = F.lit(True)
    for c, v in revisions.items():
        same = same & F.col(c).eqNullSafe(F.lit(v))
    return datasets.filter(same).orderBy(F.desc("dataset_id")).limit(1)


def cached_constraint_runs(runs: DataFrame, dataset_id: int) -> DataFrame:
    """Of each constraint's invocation the latest run without errors on a dataset."""
    own = runs.filter((F.col("dataset_id") == dataset_id) & F.col("errors").isNull())
    rank = F.row_number().over(Window.partitionBy("constraint_id", "revision", "arguments").orderBy(F.desc("request_id")))
    return own.withColumn("__r", rank).filter("__r = 1").drop("__r")


def plan_file(spark: SparkSession, path: str) -> DataFrame:
    """(plan_id, id, type, start_us, arguments, anchor_id, anchored_to_start) of plans in JSON files."""
    plans = spark.read.schema(PLAN).option("multiLine", True).json(path)
    a = plans.select(F.col("id").alias("plan_id"), F.explode("activities").alias("a")).select("plan_id", "a.*")
    return a.withColumn("start_us", F.coalesce(durations.from_clock(F.col("start_offset")), durations.from_iso(F.col("start_offset")))).drop("start_offset")


def written(df: DataFrame, path: str, mode: str = "append", by: str = "dataset_id") -> None:
    """Rows into the partitions of their datasets: profiles, segments, spans, events, results; a dataset's drop is its folder's."""
    df.write.mode(mode).partitionBy(by).parquet(path)


def replaced(df: DataFrame, path: str, by: str = "dataset_id") -> None:
    """Like written, but the partitions of these datasets are replaced whole."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def dropped(spark: SparkSession, path: str, dataset_id: int, by: str = "dataset_id") -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={dataset_id}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def extended(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New segments (dataset_id, profile_id, seq, duration_us, dynamics) placed after what a profile has (dataset_id, profile_id, duration_us)."""
    before = F.coalesce(F.sum("duration_us").over(Window.partitionBy("dataset_id", "profile_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    have = existing.select("dataset_id", "profile_id", F.col("duration_us").alias("__have"))
    return new.withColumn("start_us", before).join(have, ["dataset_id", "profile_id"], "left").withColumn("start_us", F.col("start_us") + F.coalesce("__have", F.lit(0))).drop("__have")


def results_json(config: dict, profiles: DataFrame, spans: DataFrame, topics_: DataFrame, events_: DataFrame) -> DataFrame:
    """(dataset_id, document): one JSON document a dataset."""

    def listed(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c != "dataset_id"]
        return df.groupBy("dataset_id").agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name))

    out = listed(profiles, "profiles")
    for df, name in ((spans, "spans"), (topics_, "topics"), (events_, "events")):
        out = out.join(listed(df, name), "dataset_id", "full")
    head: list[Column] = [F.lit(v).alias(k) for k, v in config.items()]
    return out.select("dataset_id", F.to_json(F.struct(*head, "profiles", "spans", "topics", "events")).alias("document"))
