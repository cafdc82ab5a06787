"""The chain of stages on small tables, each held against a plain version on its own input."""

import random
import re
from collections import Counter

import tokenizers

import corpus_pipeline
import public_tokenizers
from spanweave.llm import jaccard_join, mix_sources

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_each_stage_against_a_plain_version(spark, tmp_path):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    texts = [" ".join(word() for _ in range(60)) + "." for _ in range(80)]
    texts += [t.replace(" ", "  ", 3) for t in texts[:10]] + [t + " " + word() for t in texts[10:20]] + [t + " you idiot moron." for t in texts[20:50]] + [None, "", ""]
    rows = [(k, t, "en", f"src{k % 5}" if k % 7 else None, len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 0, int("idiot" in (t or ""))) for k, t in enumerate(texts) if k % 2], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = (before.collect(), docs.collect())
        assert name == "packing" or docs.columns == before.columns

    before, after = kept["toxicity"]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == set(range(100, 130))
    before, after = kept["exact_dedup"]
    first = {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or ""), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(first.values())
    before, after = kept["ngram_jaccard"]
    sets, root = {r["doc_id"]: shingles(r["text"]) for r in before}, {r["doc_id"]: r["doc_id"] for r in before}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    assert sorted(r["doc_id"] for r in after) == sorted(set(root.values()))
    before, after = kept["mix_sources"]
    copies = Counter(r["doc_id"] for r in after)
    drawn = mix_sources.mix_sources(spark.createDataFrame(before, SCHEMA), mix_sources.WEIGHTS, mix_sources.REST).collect()
    assert copies == Counter(r["doc_id"] for r in drawn) and all(r["copies"] == copies[r["doc_id"]] for r in drawn)
    before, after = kept["packing"]
    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r["length"] for r in after) == sum(len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in before)


def test_keep_one_of_each(spark):
    base = " ".join(f"w{k}" for k in range(40))
    rows = [(1, base, "x"), (2, base + " more", "y"), (2, base + " more", "z"), (3, None, "n"), (None, base, "q"), (4, "w0", "r"), (5, "", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    for broadcast_rows in (10, 0):
        out = jaccard_join.keep_one_of_each(df, broadcast_rows=broadcast_rows)
        assert out.columns == df.columns and sorted((r["doc_id"] or 0, r["component_id"]) for r in out.collect()) == [(0, "q"), (1, "x"), (3, "n"), (4, "r"), (5, "s")]


def test_groups_of_awkward_rows(spark):
    schema = "doc_id long, text string, n_shingles string, component_id string"
    long = " ".join(f"w{k % 977}x{k // 977}" for k in range(60_000))
    rows = [(1, long, "a", "b"), (2, long + " end", "a", "b"), (2, long + " end", "a", "b"), (3, None, None, None), (4, " \n", None, None), (None, "one two three four", None, None), (7, "ONE two three four", None, None)]
    out = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert out == sorted([(1, 59_997, 1), (2, 59_998, 1), (2, 59_998, 1), (3, 0, 3), (4, 0, 4), (None, 1, 7), (7, 1, 7)], key=str)
    assert jaccard_join.near_duplicates(spark.createDataFrame([], schema)).count() == 0
