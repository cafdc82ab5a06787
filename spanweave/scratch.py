"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only where it is unset (tests on one machine) a folder of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spanweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Folders of this process that still hold tables, by session
FOLDERS: list[str] = []


def mark() -> int:
    """A place in the list of folders, for release."""
    return len(FOLDERS)


def release(spark: SparkSession, since: int = 0) -> None:
    """Deletes the tables of all operator runs since a mark: once nothing that reads them will be run again."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in FOLDERS[since:]:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    del FOLDERS[since:]


#: Whether the shuffle files of a query go when the query ends, rather than when the driver happens to collect its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Parquet tables of one operator run under the shared folder.

    A written table survives lost executors, prunes columns when it is read
    again and can be dropped as soon as nothing reads it any more. What was
    shuffled for it is deleted at once, so that the disk holds the files of
    one table's query and not those of all before it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/spanweave-{uuid.uuid4().hex}"
        self.count = 0
        FOLDERS.append(self.folder)

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/t{self.count}"
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before) if before is not None else self.spark.conf.unset(CLEANUP)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
