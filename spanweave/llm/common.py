"""What the operators of this subpackage share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch, so that a worker holds a few MB of text at a time.
BATCH_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers receive, and lets workers on this machine import this package.

    The bound stays set in the session, since plans read it when they run, long after the operator has returned.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def without(df: DataFrame, *names: str) -> DataFrame:
    """df less its columns that an operator is about to add under these names."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def text_or_empty(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


class WordCache(dict):
    """A dictionary that forgets all once it holds ``limit`` entries."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def room(self, n: int) -> None:
        if len(self) + n > self.limit:
            self.clear()


def chunks(texts: list[str], chars: int = 2_000_000):
    """Runs of texts of about so many characters; a longer text stands alone."""
    run, held = [], 0
    for t in texts:
        if run and held + len(t) > chars:
            yield run
            run, held = [], 0
        run.append(t)
        held += len(t)
    if run:
        yield run
