"""Nearest neighbours by shifted space-filling curves.

Equal vectors count as one node from the start, which keeps its smallest
identifiers, so that a vector that a third of all rows hold is searched once.
Nodes are projected to a few dimensions, each made even by a sample's
quantiles, and laid along several Hilbert curves, each over another projection
and shifted by another offset. Spark range-partitions every ordering by its
key and cuts it into blocks of about ``BLOCK`` keys, across the borders of
partitions. A query's window is its own block and the two beside it; the
windows of all curves merge, and the best of them are reranked on the original
vectors. Windows compare vectors of one byte a component, so that a curve
moves a fraction of a vector; only what may be among the nearest is compared
exactly.

A window's size doesn't depend on the table, hence cost grows in proportion to
it. Recall does depend on the data: vectors without any structure lie apart on
all curves the more often the more of them there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.llm.common import python_ready, table
from spanweave.scratch import Scratch

NEAREST = 5
#: Curves, dimensions of each and bits of a dimension, and the bounded sample for quantiles
CURVES, DIMENSIONS, BITS, SAMPLE = 10, 10, 6, 4096
#: Keys in a block; a window is three of them
BLOCK = 4096
#: What a block gives a query, and what of all windows is reranked, as multiples of the neighbours wanted
SHARE, RERANK = 3, 10
#: Queries that are compared with a block at a time, and tasks that a node's query rows are dealt over
QUERIES, SALTS = 1024, 16
SEED = 10


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of whole numbers below 2 ** bits, after Skilling's transposition."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


class Curves:
    """Keys of unit vectors on every curve, fitted to a sample of them."""

    def __init__(self, sample: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.axes = rng.standard_normal((CURVES, sample.shape[1], DIMENSIONS))
        self.shifts = rng.random((CURVES, DIMENSIONS)) / 2
        self.marks = [np.quantile(sample @ a, np.linspace(0, 1, 257)[1:-1], axis=0) for a in self.axes]

    def keys(self, unit: np.ndarray) -> list[np.ndarray]:
        out = []
        for axes, shift, marks in zip(self.axes, self.shifts, self.marks, strict=True):
            flat = unit @ axes
            even = np.stack([np.searchsorted(marks[:, d], flat[:, d], side="right") / 256 for d in range(DIMENSIONS)], axis=1)
            out.append(hilbert_keys(np.minimum(((even / 2 + shift) * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS))
        return out


def rows_of(column: pa.Array, dim: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, dim)


def unit_of(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1)[:, None]  # components near the ends of the range must not overflow
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows with rows; each by the same operations in the same order. Powers of two, which round nothing, keep squares in range."""
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None]) for x in (a, b))
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def codes_of(unit: np.ndarray) -> np.ndarray:
    """A byte a component, on a scale of the vector's own largest."""
    return np.rint(unit / np.abs(unit).max(1)[:, None] * 127).astype(np.int8)


def packed(valid: DataFrame) -> DataFrame:
    """(id, query, vector): vectors as little-endian doubles."""

    def run(batches):
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # -0.0 is 0.0
            size = len(flat) // max(1, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in flat.reshape(batch.num_rows, size)], pa.binary())], names=["id", "query", "vector"])

    return valid.select("id", "query", "v").mapInArrow(run, "id long, query boolean, vector binary")


HASHES = ["ha", "hb"]


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(ha, hb, node, vector, query, ids) of each vector: whether a query holds it, and its k + 1 smallest identifiers.

    Rows are aggregated and limited on the map side, so that copies of one vector don't meet.
    """
    own = rows.groupBy(*HASHES).agg(F.first("vector").alias("vector"), F.max("query").alias("query"))
    rank = F.row_number().over(Window.partitionBy(*HASHES).orderBy("id"))
    least = rows.select(*HASHES, "id").distinct().withColumn("r", rank).filter(F.col("r") <= k + 1).groupBy(*HASHES).agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return own.join(least, HASHES).withColumn("node", F.monotonically_increasing_id())


def laid_out(nodes: DataFrame, curves: Curves, dim: int) -> DataFrame:
    """(curve, key, node, query, code) of each node on each curve."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                unit = unit_of(rows_of(batch.column(2), dim))
                code = pa.array([c.tobytes() for c in codes_of(unit)], pa.binary())
                for c, key in enumerate(curves.keys(unit)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, dtype=np.int32)), pa.array(key), batch.column(0), batch.column(1), code], names=["curve", "key", "node", "query", "code"])

    return nodes.select("node", "query", "vector").mapInArrow(run, "curve int, key long, node long, query boolean, code binary")


def in_blocks(ordered: DataFrame, scratch: Scratch) -> DataFrame:
    """ordered (curve, key, node, query, code) with block: consecutive keys of a curve, numbered along it."""
    place = F.monotonically_increasing_id()
    written = scratch.save(ordered.repartitionByRange("curve", "key").sortWithinPartitions("curve", "key", "node").withColumn("place", place))
    placed = written.withColumns({"part": F.shiftright("place", 33), "place": F.col("place").bitwiseAND(F.lit((1 << 33) - 1))})
    parts = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    parts = parts.withColumn("blocks", F.greatest(F.lit(1).cast("long"), F.round(F.col("n") / BLOCK).cast("long")))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("offset", F.coalesce(F.sum("blocks").over(before), F.lit(0).cast("long")))
    # parts has a row a partition and curve: as many as tasks
    return placed.join(F.broadcast(parts), ["curve", "part"]).withColumn("block", F.expr("offset + (place - first) * blocks div n")).select("curve", "block", "node", "query", "code")


def window_candidates(blocks: DataFrame, dim: int, k: int) -> DataFrame:
    """(query, node, near): the best of each query node's window, a few of each block of it."""
    rows = blocks.select("curve", "block", F.lit(1).alias("row"), "node", "code")
    around = F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1))
    asked = blocks.filter("query").select("curve", around.alias("block"), F.lit(0).alias("row"), "node", "code")
    cells = asked.unionByName(rows).repartition("curve", "block").sortWithinPartitions("curve", "block", "row")

    def best(held):
        of = [np.concatenate([h[j] for h in held]) for j in range(3)]
        is_row = of[0] == 1
        queries, nodes = of[1][~is_row], of[1][is_row]
        if not len(queries) or not len(nodes):
            return
        code = of[2].astype(np.float32)
        code /= np.sqrt((code * code).sum(1))[:, None]
        a, b = code[~is_row], code[is_row]
        take = min(SHARE * k, len(nodes))
        for start in range(0, len(queries), QUERIES):
            own = queries[start : start + QUERIES]
            near = a[start : start + QUERIES] @ b.T
            near[own[:, None] == nodes[None, :]] = -2
            at = np.argpartition(-near, take - 1, axis=1)[:, :take]
            value = np.take_along_axis(near, at, 1).ravel()
            fine = value > -2
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, take)[fine]), pa.array(nodes[at.ravel()][fine]), pa.array(value[fine])], names=["query", "node", "near"])

    def run(batches):
        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            curve, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            own = (batch.column(2).to_numpy(), batch.column(3).to_numpy(), rows_of(batch.column(4), dim, np.int8))
            edges = np.flatnonzero((curve[1:] != curve[:-1]) | (block[1:] != block[:-1])) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(curve)], strict=True):
                if (curve[s], block[s]) != key:
                    if held:
                        yield from best(held)
                    key, held = (curve[s], block[s]), []
                held.append(tuple(x[s:e] for x in own))
        if held:
            yield from best(held)

    return cells.mapInArrow(run, "query long, node long, near float")


def with_cosines(pairs: DataFrame, dim: int) -> DataFrame:
    """(query, score, ids) of pairs (query, a, b, ids): the cosine of vectors a and b."""

    def run(batches):
        for batch in batches:
            score = cosines(rows_of(batch.column(1), dim), rows_of(batch.column(2), dim)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), batch.column(3)], names=["query", "score", "ids"])

    return pairs.select("query", "a", "b", "ids").mapInArrow(run, "query long, score double, ids array<long>")


def nearest_neighbours(vectors: DataFrame, query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest cosine found for each row that query selects.

    Nearest first, ties to the smaller identifier, all candidates if there are
    fewer. Vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor do those without identifier; an empty table
    gives an empty one. Vectors are compared with those of their own length,
    by a search for each length. Rows that repeat an identifier with its
    vector count once, one identifier's different vectors are a row each, and
    a query's own identifier isn't its neighbour. Other columns aren't read.
    """
    spark = vectors.sparkSession
    python_ready(spark)
    scratch = Scratch(spark)
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    valid = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(fine).select(F.col(id_col).cast("long").alias("id"), F.coalesce(query, F.lit(False)).alias("query"), v.alias("v"))
    lengths = sorted(r["n"] for r in valid.select(F.size("v").alias("n")).distinct().collect())
    found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    for dim in lengths:
        found = found.unionByName(found_of_length(valid.filter(F.size("v") == dim), dim, k, scratch))
    ranked = found.distinct().withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def found_of_length(valid: DataFrame, dim: int, k: int, scratch: Scratch) -> DataFrame:
    """(query_id, vec_id, score) among rows (id, query, v) with dim components, the k best of each query."""
    sample = [r["v"] for r in valid.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()]
    curves = Curves(unit_of(np.array(sample)))
    rows = packed(valid).withColumns({"ha": F.xxhash64("vector"), "hb": F.xxhash64(F.lit(SEED), "vector")})
    nodes = scratch.save(distinct_vectors(rows, k))
    blocks = in_blocks(laid_out(nodes, curves, dim), scratch)

    near = window_candidates(blocks, dim, k).repartition("query").groupBy("query", "node").agg(F.max("near").alias("near"))
    order = Window.partitionBy("query").orderBy(F.desc("near"), "node")
    best = near.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= RERANK * k).select("query", "node")
    # a node's own rows are each other's neighbours too
    best = scratch.save(best.unionByName(nodes.filter("query").select(F.col("node").alias("query"), "node")))
    pairs = best.join(nodes.select("node", F.col("vector").alias("b"), "ids"), "node").join(nodes.select(F.col("node").alias("query"), F.col("vector").alias("a")), "query")
    entries = F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("score"), i.alias("id")))))
    lists = with_cosines(pairs, dim).groupBy("query").agg(F.slice(F.array_sort(entries), 1, k + 1).alias("entries"))

    salt = lambda x: F.pmod(F.xxhash64(x), F.lit(SALTS)).cast("int")
    asked = rows.filter("query").select("id", *HASHES).distinct().withColumn("salt", salt("id"))
    dealt = nodes.filter("query").select(*HASHES, F.col("node").alias("query")).join(lists, "query").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    others = F.slice(F.filter("entries", lambda e: e["id"] != F.col("id")), 1, k)
    return asked.join(dealt, [*HASHES, "salt"]).select(F.col("id").alias("query_id"), F.explode(others).alias("e")).select("query_id", F.col("e.id").alias("vec_id"), (-F.col("e.score")).alias("score"))


def op10(spark, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS INT) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
