"""Exact deduplication by content sort.

Sampled splitters range-partition the normalised texts, each partition sorts
its own externally so that equal texts lie next to each other, and a window
over neighbours, which compares whole texts, retains the smallest identifier.
The splitters are (first characters, hash) pairs: a total order of bounded
size that sends equal texts to one partition however long they are.

A text that fills a good part of a partition would make one task long. Those
texts, at most ``HOT_PER_PARTITION`` a partition in number, are found by
counting hashes and are grouped by their whole content with map-side combine
instead; only their digests meet the rows again, by broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanweave.llm.common import table, text_or_empty, without
from spanweave.scratch import Scratch

#: A text with over 1 / (HOT_PER_PARTITION * partitions) of the rows is hot, so there are less than that many.
HOT_PER_PARTITION = 4
#: and has this many rows at least
HOT_ROWS = 256
#: Leading characters in a splitter
SPLITTER_CHARS = 48

ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text):
    """Each run of ASCII white space becomes one space; single spaces stand as they are."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = True) -> DataFrame:
    """The rows of docs with keep_id, group_size, kept and text_sha256.

    Null texts count as empty and equal each other. Null identifiers come
    last; of rows that tie on the smallest one exactly one is kept. An empty
    table gives an empty one. Input columns named like an added one are
    replaced. Whole texts are compared, however long; a text's normal form
    stands once in a row. carry=False returns the identifier and the added columns only.
    """
    spark = docs.sparkSession
    docs = without(docs, *ADDED)
    others = [c for c in docs.columns if c != id_col] if carry else []
    norm = normalised(text_or_empty(text_col))
    rows = docs.select(
        F.col(id_col).alias("__id"),
        norm.alias("__norm"),
        # a text that is its own normal form isn't carried twice
        *([F.struct(*[F.when(F.col(c).eqNullSafe(norm), F.lit(None)).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c) for c in others], F.col(text_col).isNull().alias("__null")).alias("__row")] if others else []),
    ).withColumn("__h", F.xxhash64("__norm"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one pass over the texts gives their number and the hot ones
    counts = Scratch(spark).save(rows.groupBy("__h").count())
    least = max(HOT_ROWS, (counts.agg(F.sum("count")).first()[0] or 0) // (HOT_PER_PARTITION * parts))
    hot = [r["__h"] for r in counts.filter(F.col("count") > least).select("__h").collect()]

    cold = rows.filter(~F.col("__h").isin(hot)) if hot else rows
    same = Window.partitionBy("__splitter", "__h", "__norm")
    near = same.orderBy(F.col("__id").asc_nulls_last())
    whole = near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = (
        cold.withColumn("__splitter", F.substring("__norm", 1, SPLITTER_CHARS))
        .repartitionByRange("__splitter", "__h")
        .withColumns({"keep_id": F.first("__id").over(whole), "group_size": F.count(F.lit(1)).over(whole), "__rank": F.row_number().over(near)})
        .withColumns({"kept": F.col("__rank") == 1, "text_sha256": F.sha2("__norm", 256)})
        .drop("__splitter", "__rank", "__h")
    )
    if hot:
        warm = rows.filter(F.col("__h").isin(hot)).withColumn("text_sha256", F.sha2("__norm", 256))
        groups = warm.groupBy("__norm").agg(F.min("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).select(F.sha2("__norm", 256).alias("text_sha256"), "keep_id", "group_size")
        joined = warm.join(F.broadcast(groups), "text_sha256")
        first = F.col("__id").eqNullSafe(F.col("keep_id"))
        # rows that tie on the smallest identifier are repeated rows: few, or as many as a source repeats one row
        tied = joined.filter(first).withColumn("__rank", F.row_number().over(Window.partitionBy("text_sha256").orderBy(F.lit(0))))
        hot_out = joined.filter(~first).withColumn("kept", F.lit(False)).unionByName(tied.withColumn("kept", F.col("__rank") == 1).drop("__rank"))
        out = out.unionByName(hot_out.drop("__h"))
    back = [F.when(F.col("__row.__null"), F.lit(None)).otherwise(F.coalesce(f"__row.`{c}`", "__norm")).alias(c) if c == text_col else F.col(f"__row.`{c}`").alias(c) for c in others]
    return out.select(F.col("__id").alias(id_col), *back, "keep_id", "group_size", "kept", "text_sha256")


def op7(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), carry=False)


OP7_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
