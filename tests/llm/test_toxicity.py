import random
import zlib

import numpy as np

from spanweave.llm import toxicity

DOCS = "doc_id long, text string, score string, held_out string"


def corpus(n):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    bad = ["moron", "m-o-r-o-n", "morron", "idiot", "idxiot", "1diot", "i d i o t"]
    return [(k, " ".join(word() for _ in range(30)) + (f" you {rng.choice(bad)}. " if k % 3 == 0 else ". ") + word(), None, None) for k in range(n)]


def test_held_out_rows_are_told_and_not_learnt_from(spark):
    rows = corpus(600)
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(600)], "doc_id long, toxic int")
    sample = toxicity.training_sample(docs, labels)
    out_of_it = {t for k, t, *_ in rows if zlib.crc32(str(k).encode()) % 5 == 0}
    assert not out_of_it & {t for _, t in sample} and len(sample) == 600 - len(out_of_it)
    # labels of the held-out rows change nothing
    turned = spark.createDataFrame([(k, int(k % 3 == 0) ^ (zlib.crc32(str(k).encode()) % 5 == 0)) for k in range(600)], "doc_id long, toxic int")
    assert toxicity.training_sample(docs, turned) == sample
    scored = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, toxicity.train(sample), keep=("doc_id",)).withColumn("held", toxicity.held_out()).collect()}
    assert all(r["held"] == (zlib.crc32(str(k).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for k, r in scored.items())
    held = [r for r in scored.values() if r["held"]]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held]) > 0.9


def test_sample_of_repeated_awkward_and_long_rows(spark):
    rows = [(1, "you idiot", None, None)] * 5000 + [(1, "another text", None, None), (2, None, None, None), (3, "x" * (toxicity.SAMPLE_TEXT + 1), None, None), (4, "kind words", None, None), (None, "no one", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (4, 0), (None, 1), (9, 1), (6, None)], "doc_id long, toxic int")
    sample = toxicity.training_sample(docs, labels)
    fold = {k for k in range(1, 5) if zlib.crc32(str(k).encode()) % 5 != 0}
    assert len(sample) == len(fold - {3}) and all(label == (text in ("you idiot", "another text")) for label, text in sample)
    empty = spark.createDataFrame([], DOCS)
    assert toxicity.training_sample(empty, labels) == [] and toxicity.training_sample(docs, spark.createDataFrame([], labels.schema)) == []
    assert toxicity.score_toxicity(empty, toxicity.train([])).count() == 0


def test_kernel_against_brute_force():
    """Weights by the letters that a subsequence spans."""
    def vector(word):
        w, out = f"<{word}>", {}
        for a in range(len(w)):
            for b in range(a + 1, len(w)):
                for c in range(b + 1, min(len(w), a + toxicity.SPAN)):
                    out[w[a], w[b], w[c]] = out.get((w[a], w[b], w[c]), 0) + toxicity.DECAY ** (c - a + 1)
        return out

    words = ["idiot", "idxiot", "moron", "morronic", "plain", "abcdefghij", "bananana"]
    vectors = [vector(w) for w in words]
    dot = lambda a, b: sum(a[k] * b.get(k, 0) for k in a)
    for k, row in enumerate(toxicity.SubsequenceKernel(words)(words)):
        for j, value in enumerate(row):
            wanted = dot(vectors[k], vectors[j]) / (dot(vectors[k], vectors[k]) * dot(vectors[j], vectors[j])) ** 0.5
            assert abs(value - (wanted**toxicity.POWER if wanted >= toxicity.FLOOR else 0)) < 1e-4


def test_long_words_are_windowed_as_landmarks_too():
    long = "qwertyuiopasdfghjklzxcvbnm" * 2
    docs = [(k % 2, f"word{k} {long if k % 2 else 'plain'} end") for k in range(60)]
    landmarks = toxicity.choose_landmarks([(label, toxicity.sentences(t)) for label, t in docs])
    assert all(len(w) <= toxicity.WINDOW for w in landmarks) and set(landmarks) & set(toxicity.windows(long)[1:])
    assert "".join(w[: toxicity.STEP] for w in toxicity.windows(long)).startswith(long[: 3 * toxicity.STEP])
