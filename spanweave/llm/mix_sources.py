"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate follows from its target share and its size.
Each document draws a Poisson count with that mean by inverting the
distribution at a uniform number that a seeded hash of its identifier gives;
the document is exploded by the count and all copies are shuffled globally by
a second hash. No count is capped: the inversion covers all values that a
52-bit uniform number can reach.

Rows without an identifier, or with one that other rows have too, draw by
identifier, content and number among their like, so that they draw apart.
Equal rows among those are aggregated to one row with a count before they
are shuffled, and dealt out again from it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import table, without
from spanweave.scratch import Scratch

ADDED = ("repetition_rate", "copies", "copy_no", "shuffle_key")
#: Target weights of the registered query by rule: src0 to src19 weigh 1, 2, 3, 4, 1, 2, ...; all others together weigh 1.
WEIGHTS = {f"src{i}": 1.0 + i % 4 for i in range(20)}
REST = 1.0
SEED = "mix-1"


#: Standard deviations around the mean beyond which no 52-bit number leads
REACH = 9
#: Rows that one array of numbers is exploded to at a time
DEAL = 4096


def poisson_steps(rate: float) -> tuple[int, list[float]]:
    """A first value, and the distribution function at it and at those that follow, up to where 52 bits can't tell it from 1.

    As many values as some standard deviations, however large the mean.
    """
    low = max(0, int(rate - REACH * math.sqrt(rate) - 60))
    high = int(rate + 40 * math.sqrt(rate) + 60) if not low else int(rate + REACH * math.sqrt(rate) + 60)
    if rate <= 0:
        return 0, [1.0]
    if not low:
        steps, total = [], 0.0
        for k in range(high + 1):
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
            if k > rate and total >= 1 - 2.0**-52:
                break
            steps.append(total)
        return 0, steps or [1.0]
    # far from 0 the terms come from ratios, whose rounding doesn't grow with the mean, and their sum is 1
    at = np.arange(low, high + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(rate / at[1:]))])
    terms = np.exp(logs - logs.max())
    steps = np.cumsum(terms / terms.sum())
    return low, steps[steps < 1 - 2.0**-52].tolist()


def uniform(*parts, digits: int = 13):
    """The first hex digits of an md5 digest as a whole number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, digits), 16, 10).cast("long")


def dealt(rows: DataFrame, count: str, number: str) -> DataFrame:
    """Each row count times, numbered from 1, without an array of more than DEAL numbers."""
    last = F.floor((F.col(count) - 1) / DEAL)
    pieces = rows.withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("__piece") * DEAL + 1
    return pieces.withColumn(number, F.explode(F.sequence(first, F.least(first + (DEAL - 1), F.col(count))))).drop("__piece")


def with_draw_keys(docs: DataFrame, repeated: DataFrame, id_col: str) -> DataFrame:
    """docs with __key, which tells rows apart; repeated: the identifiers that several rows have."""
    unique = docs.filter(F.col(id_col).isNotNull()).join(repeated, id_col, "left_anti").withColumn("__key", F.col(id_col).cast("string"))
    others = docs.join(repeated, id_col, "left_semi").unionByName(docs.filter(F.col(id_col).isNull()))
    content = F.xxhash64(*docs.columns)
    alike = others.groupBy(*docs.columns).agg(F.count(F.lit(1)).alias("__alike"))
    # one row of a group may stand for a third of the table: its pieces are spread before they are dealt out
    pieces = alike.withColumn("__first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__alike"), F.lit(DEAL).cast("long")))).repartition(F.xxhash64(content, "__first"))
    numbered = pieces.withColumn("__n", F.explode(F.sequence(F.col("__first"), F.least(F.col("__first") + (DEAL - 1), F.col("__alike")))))
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), content.cast("string"), F.col("__n").cast("string"))
    return unique.unionByName(numbered.withColumn("__key", key).drop("__alike", "__first", "__n"))


def mix_sources(docs: DataFrame, weights: dict[str, float], rest: float = 0.0, total: int | None = None, key: str = "source", id_col: str = "doc_id", seed: str = SEED) -> DataFrame:
    """Copies of the rows of docs, shuffled, with repetition_rate, copies, copy_no and shuffle_key.

    weights: of the declared values of key, of any sum; rest: that of all
    other values (null too) together. total: rows wanted, as many as docs has
    by default. A declared source without rows leaves its share unused. Rows
    without identifier and rows that repeat one draw each for itself. Whole
    texts of any length are copied; an empty table gives an empty one. Input
    columns named like an added one are replaced; columns must be of types
    that can be grouped. Broadcast and driver hold some numbers a declared
    weight and standard deviation of its rate, nothing else.
    """
    spark = docs.sparkSession
    docs = without(docs, *ADDED)
    known = F.col(key).isin(list(weights))
    # one pass over two columns: rows of each pool, and identifiers that repeat
    slim = Scratch(spark).save(docs.groupBy(F.when(known, F.col(key)).alias("pool"), F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n")))
    sizes = {r["pool"]: r["n"] for r in slim.groupBy("pool").agg(F.sum("n").alias("n")).collect()}
    total = sum(sizes.values()) if total is None else total
    scale = total / ((sum(weights.values()) + rest) or 1.0)
    rates = {s: scale * (rest if s is None else weights[s]) / n for s, n in sizes.items()}
    repeated = slim.filter("id IS NOT NULL").groupBy("id").agg(F.sum("n").alias("n")).filter("n > 1").select(F.col("id").alias(id_col))
    if repeated.isEmpty() and slim.filter("id IS NULL").isEmpty():
        keyed = docs.withColumn("__key", F.col(id_col).cast("string"))
    else:
        keyed = with_draw_keys(docs, repeated, id_col)
    if not rates:
        rates = {None: 0.0}
    pools = spark.createDataFrame([(s, rate, *poisson_steps(rate)) for s, rate in rates.items()], f"__pool {docs.schema[key].dataType.simpleString()}, repetition_rate double, __low long, __steps array<double>")

    u = uniform(F.lit(seed), "__key") / F.lit(2.0**52)
    copies = F.col("__low") + F.size(F.filter("__steps", lambda p: p <= F.col("__u")))
    drawn = keyed.withColumn("__u", u).join(F.broadcast(pools), F.when(known, F.col(key)).eqNullSafe(F.col("__pool")))
    counted = drawn.withColumn("copies", copies.cast("long")).filter("copies > 0").drop("__low", "__steps", "__pool", "__u")
    shuffle_key = uniform(F.lit(seed + "-order"), "__key", F.col("copy_no").cast("string"), digits=15)
    return (
        dealt(counted, "copies", "copy_no")
        .withColumn("shuffle_key", shuffle_key)
        .select(*docs.columns, *ADDED)
        .repartitionByRange("shuffle_key", id_col)
        .sortWithinPartitions("shuffle_key", id_col)
    )


def op4(spark, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), WEIGHTS, REST).withColumn("repetition_rate", F.round("repetition_rate", 9))


OP4_SQL = r"""
WITH d AS (
  SELECT *, CASE WHEN regexp_full_match(source, 'src(1?[0-9])') THEN source END AS pool FROM documents
), w AS (
  SELECT pool, n, CASE WHEN pool IS NULL THEN 1.0 ELSE 1.0 + CAST(substr(pool, 4) AS INT) % 4 END::DOUBLE AS weight
  FROM (SELECT pool, count(*) AS n FROM d GROUP BY pool)
), r AS (
  SELECT pool, (SELECT sum(n) FROM w) / 51.0::DOUBLE * weight / n AS rate FROM w
), s AS (
  SELECT pool, any_value(rate) AS rate, list(p ORDER BY k) AS cdf FROM (
    SELECT pool, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY pool ORDER BY k) AS p
    FROM r, LATERAL unnest(generate_series(0, CAST(rate + 40 * sqrt(rate) + 60 AS BIGINT))) AS g(k)
  ) GROUP BY pool
), c AS (
  SELECT d.* EXCLUDE (pool), rate,
         len(list_filter(cdf, lambda p: p < 1 - 2.0::DOUBLE ** -52 AND p <= CAST(('0x' || substr(md5('mix-1:' || doc_id), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE)) AS copies
  FROM d JOIN s ON d.pool IS NOT DISTINCT FROM s.pool
)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS repetition_rate, copies, copy_no,
       CAST(('0x' || substr(md5('mix-1-order:' || doc_id || ':' || copy_no), 1, 15)) AS BIGINT) AS shuffle_key
FROM c, LATERAL unnest(generate_series(1, copies)) AS g(copy_no)
"""
