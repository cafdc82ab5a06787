import math

from pyspark.sql import functions as F

from spanweave.llm import exact_dedup, mix_sources

SCHEMA = "doc_id long, text string, source string, copies string, shuffle_key string"


def test_steps_equal_the_distribution():
    for rate in (0.3, 5.0, 80.0):
        low, steps = mix_sources.poisson_steps(rate)
        assert low == 0 and all(abs(p - sum(math.exp(j * math.log(rate) - rate - math.lgamma(j + 1)) for j in range(k + 1))) < 1e-12 for k, p in enumerate(steps))
    for rate in (1e4, 4e5, 1e9):
        low, steps = mix_sources.poisson_steps(rate)
        assert low > 0 and len(steps) < 25 * math.sqrt(rate)
        mean = low + sum(1 - p for p in steps)
        assert abs(mean - rate) < 1e-6 * rate and abs(steps[int(rate) - low] - 0.5) < 1 / math.sqrt(rate)


def test_a_rare_source_of_a_high_rate(spark):
    rows = [(k, "t", "many", None, None) for k in range(1000)] + [(5000, "rare text", "rare", None, None)]
    out = mix_sources.mix_sources(spark.createDataFrame(rows, SCHEMA), {"many": 1.0, "rare": 99.0}, total=100_000)
    n = out.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("copy_no").alias("d"), F.max("copies").alias("m")).collect()
    rare = next(r for r in n if r["source"] == "rare")
    assert rare["n"] == rare["d"] == rare["m"] and abs(rare["n"] - 99_000) < 9 * 99_000**0.5


def test_null_and_repeated_identifiers_draw_apart(spark):
    rows = [(None, f"t{k}", "a", "x", None) for k in range(2000)] + [(7, "same", "b", None, None)] * 2000 + [(8 + k % 2, f"u{k}", "c", None, None) for k in range(2000)]
    out = mix_sources.mix_sources(spark.createDataFrame(rows, SCHEMA), {"a": 1.0, "b": 1.0, "c": 1.0}, total=6000)
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert all(abs(n[s] - 2000) < 9 * 2000**0.5 for s in "abc")
    assert out.columns == ["doc_id", "text", "source", "repetition_rate", "copies", "copy_no", "shuffle_key"]
    assert out.select("shuffle_key").distinct().count() > 0.99 * out.count()


def test_dedup_of_clashing_columns_and_long_texts(spark):
    long = "word  " * 100_000
    rows = [(1, long, "a", "b", "c", True), (2, long.replace("  ", "\t"), None, None, None, False), (3, long + "x", "a", "b", "c", True), (None, None, "n", "n", "n", None), (4, "", "e", "e", "e", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, keep_id string, GROUP_SIZE string, text_sha256 string, kept boolean")
    out = {r["doc_id"]: r for r in exact_dedup.exact_dedup(df).collect()}
    assert [(out[k]["keep_id"], out[k]["group_size"], out[k]["kept"]) for k in (1, 2, 3, 4, None)] == [(1, 2, True), (1, 2, False), (3, 1, True), (4, 2, True), (4, 2, False)]
    assert out[1]["text"] == long and out[None]["text"] is None and out[4]["text"] == ""
