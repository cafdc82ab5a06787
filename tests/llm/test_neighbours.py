import random

from pyspark.sql import functions as F

from spanweave.llm import hilbert_neighbours as h

SCHEMA = "vec_id long, embedding array<double>, score string, rank string"


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5


def found(spark, data, every, k=5):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in data], SCHEMA)
    rows = h.nearest_neighbours(df, F.col("vec_id") % every == 0, k=k).orderBy("query_id", "rank").collect()
    out = {}
    for r in rows:
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append(r["vec_id"])
    return out


def test_ties_go_to_the_smaller_identifier(spark):
    vectors = [(i, [1.0, 0.0, 0.0]) for i in range(40)] + [(i, [0.0, 1.0, float(i % 2)]) for i in range(40, 60)]
    out = found(spark, vectors, 10)
    assert out[0] == [1, 2, 3, 4, 5] and out[10] == [0, 1, 2, 3, 4] == out[30]
    assert out[40] == [42, 44, 46, 48, 50] and out[50] == [40, 42, 44, 46, 48]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 2.0]), (1, [2.0, 4.0]), (1, [2.0, 4.0]), (2, [-1.0, 0.5]), (None, [1.0, 2.0]), (3, None), (4, []), (5, [0.0, -0.0]), (6, [1.0, inf]), (7, [nan, 1.0]), (8, [1.0, None]), (10, [1.0, 2.0, 3.0]), (20, [1e200, 1e200])]
    out = found(spark, vectors, 10)
    assert out == {0: [1, 20, 2], 20: [0, 1, 2]}  # fewer than five, by length; 10 is the only one of its length
    assert found(spark, [], 10) == {} and found(spark, [(0, [1.0])], 10) == {}


def test_one_identifier_with_two_vectors(spark):
    assert found(spark, [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [0.0, 1.0]), (2, [0.5, 0.5])], 5)[0] == [1, 2, 1]


def test_recall_of_windows_that_are_much_smaller_than_the_table(spark, monkeypatch):
    monkeypatch.setattr(h, "BLOCK", 64)
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(60)]
    data = [(i, [x + 0.3 * rng.gauss(0, 1) for x in rng.choice(centres)]) for i in range(3000)]
    own, hits = dict(data), 0
    out = found(spark, data, 100)
    for q in range(0, 3000, 100):
        hits += len(set(out[q]) & set(sorted((i for i in own if i != q), key=lambda i: -cosine(own[q], own[i]))[:5]))
    assert len(out) == 30 and hits / 150 >= 0.9
