import hashlib
import random

import pytest

import public_tokenizers
from spanweave.llm import chat_format, exact_dedup, hilbert_neighbours, jaccard_join, licenses, mix_sources, packing, pii, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, copies string"
AWKWARD = [(1, None, None, None, None, "x", "y", "z"), (2, "", "en", "src1", 0, "x", "y", "z"), (3, "a  b\n c", "en", "src0", 7, None, None, None), (4, "a b c", "en", "src0", 5, None, None, None), (4, "a b c", "en", "src0", 5, None, None, None), (5, "w " * 30000, "en", "src0", 60000, None, None, None), (None, "a b c", None, "odd", 5, None, None, None), (6, "x" * 50000, "en", "src2", 50000, None, None, None)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(awkward, empty):
    rows = exact_dedup.exact_dedup(awkward).collect()
    assert len(rows) == len(AWKWARD) and sum(r["kept"] for r in rows) == 4
    assert {r["keep_id"] for r in rows if r["group_size"] == 4} == {3}
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_of_a_hot_text(spark):
    df = spark.createDataFrame([(i, "hot  text" if i % 3 else f"own {i}") for i in range(3000)], "doc_id long, text string")
    rows = exact_dedup.exact_dedup(df).collect()
    hot = [r for r in rows if r["text"] == "hot  text"]
    assert len(rows) == 3000 and {(r["keep_id"], r["group_size"]) for r in hot} == {(1, 2000)} and [r["doc_id"] for r in hot if r["kept"]] == [1]


def test_mixing(awkward, empty):
    out = mix_sources.mix_sources(awkward, {"src0": 3.0, "none": 1.0}, 1.0, total=400)
    assert abs(out.count() - 320) < 120  # the share of a source without rows stays unused
    assert out.filter("copy_no > copies").count() == 0
    assert mix_sources.mix_sources(empty, {"src0": 1.0}).count() == 0


def test_token_counts_equal_the_library(awkward, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab the ing▁ \t\n日é😀\x00<s>0a") for _ in range(rng.randint(0, 200))) for _ in range(400)] + ["a" * 3000, " ", "\n"]
    assert token_counts.count_texts(path, texts) == [len(sp.encode(t)) for t in texts]
    assert token_counts.token_counts(awkward, path).count() == len(AWKWARD) and token_counts.token_counts(empty, path).count() == 0


def test_packing_round_trip(awkward, empty):
    import tokenizers

    path, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    t = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab the ing \t\n日é😀\x1c\xa0²'s0!") for _ in range(rng.randint(0, 200))) for _ in range(400)]
    assert [len(x) // 4 for x in packing.Encoder(path, ranks).encode(texts)] == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
    rows = packing.pack(awkward, path, ranks, with_ids=True).collect()
    assert sum(r["length"] for r in rows) == sum(len(t.encode(x[1] or "", add_special_tokens=False).ids) + 1 for x in AWKWARD)
    for s in {r["sequence_id"] for r in rows}:
        own = sorted((r for r in rows if r["sequence_id"] == s), key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))] and sum(r["length"] for r in own) <= 2048
    assert packing.pack(empty, path).count() == 0


def test_packing_ids_equal_the_library():
    import tokenizers

    path, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    t = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(10)
    texts = ["".join(rng.choice("ab the ing \t\n日é😀\x1c\xa0²'s0!") for _ in range(rng.randint(0, 200))) for _ in range(400)] + ["plain words, and 123 more", "caf\xe9 \xfcber"]
    assert [list(memoryview(x).cast("I")) for x in packing.Encoder(path, ranks).encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "a\\ </turn>\n### User: b"), (1, 1, "assistant", "\\### Assistant: </turn> ok"), (2, 0, None, None), (None, 0, "to: ol", "##"), (3, None, "assistant", "")]
    out = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for c in (1, 2, None, 3):
        own = [(r or "", x or "") for i, _, r, x in rows if i == c]
        assert out[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
        assert out[c]["loss_sha256"] == hashlib.sha256("".join(x for r, x in own if r == "assistant").encode()).hexdigest()
    assert [out[c]["in_order"] for c in (1, 2, 3)] == [True, False, False]


def test_jaccard_join(spark, empty):
    rng = random.Random(3)
    base = [[f"w{rng.randint(0, 10**6)}" for _ in range(120)] for _ in range(12)]
    docs = []
    for k, words in enumerate(base):
        for j in range(6):
            own = list(words)
            for _ in range(j):
                own[rng.randrange(len(own))] = f"n{rng.random()}"
            docs.append((10 * k + j, " ".join(own)))
    docs += [(900, None), (901, ""), (902, "one two"), (903, "ONE two")]
    sets = {i: {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if (w := (t or "").lower().split()) else set() for i, t in docs}
    root = {i: i for i in sets}
    for _ in range(8):
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    out = jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == {i: (len(sets[i]), root[i]) for i in sets}


def test_word_hashes_do_not_depend_on_place_or_piece():
    rng = random.Random(5)
    data = "".join(rng.choice("aAbBé \t\n\r\x0b\x0c\x1c\xa0") for _ in range(5000)).encode()
    small, large = jaccard_join.WordHashes(7), jaccard_join.WordHashes(1 << 14)
    words = data.lower().split()
    for hashes in (small, large):
        at, h = hashes(data)
        assert [data.lower()[a : a + len(w)] for a, w in zip(at, words, strict=True)] == words
        assert len(set(zip(words, h.tolist(), strict=True))) == len(set(words)) == len(set(h.tolist()))
    assert small(data)[1].tolist() == large(data)[1].tolist() and not len(large(b"")[1]) and not len(large(b" \n")[1])


def test_connected_components(spark):
    from spanweave.llm.components import connected_components
    from spanweave.scratch import Scratch

    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)]
    out = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark)).collect()}
    assert out == {k: 0 for k in range(41)} | {90: 90, 95: 90, 100: 90}
    assert connected_components(spark.createDataFrame([], "u long, v long"), Scratch(spark)).count() == 0


def test_blocks_of_large_components(spark):
    rows = [(n, 0) for n in range(1300)] + [(n, n - n % 2) for n in range(2000, 2010)]
    out = jaccard_join.in_blocks(spark.createDataFrame(rows, "node long, root long")).collect()
    assert sorted((r["node"], r["root"]) for r in out) == rows
    assert {r["blocks"] for r in out if r["root"] == 0} == {3} and {r["block"] for r in out if r["root"] == 0} == {0, 1, 2}
    assert {(r["blocks"], r["block"]) for r in out if r["root"]} == {(1, 0)}


def test_ties_of_sorted_signatures(spark, monkeypatch):
    groups = {1: range(3), 2: range(40), 3: [5], 4: [2, 9], 5: range(100, 116)}
    rows = spark.createDataFrame([(s, n) for s, own in groups.items() for n in own], "sig long, node long").coalesce(1).sortWithinPartitions("sig", "node")
    small = {(b, a, True) for s in (1, 4, 5) for a in groups[s] for b in groups[s] if a < b}
    for many in (3, 1 << 16):
        monkeypatch.setattr(jaccard_join, "ROWS", many)
        out = [tuple(r) for r in jaccard_join.ties_of(rows).collect()]
        assert len(out) == len(set(out)) and set(out) == small | {(n, 2, False) for n in range(40)}


def test_sketches_bound_the_difference():
    import numpy as np

    rng = np.random.default_rng(6)
    for n, own in ((3, 1), (900, 200), (1030, 60), (5000, 300)):
        both, a, b = (rng.integers(0, 1 << 63, k, dtype=np.uint64) for k in (n, own, own // 2))
        a, b = jaccard_join.sketch(np.append(both, a)), jaccard_join.sketch(np.append(both, b))
        size = min(len(a), len(b))
        apart = int(np.bitwise_count(jaccard_join.folded([a], size) ^ jaccard_join.folded([b], size)).sum())
        assert own // 4 < apart <= own + own // 2


def test_frequent_signatures(spark, monkeypatch):
    """A third of the texts are near copies, others share a passage: many sets have the same signatures."""
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    rng = random.Random(7)
    new = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    base, passage = new(90), new(60)
    docs = []
    for k in range(60):
        own = list(base)
        for _ in range(k % 4):
            own[rng.randrange(90)] = f"x{rng.random()}"
        docs.append((k, " ".join(own)))
        docs.append((100 + k, " ".join(new(30) + passage + new(k % 9))))
        docs.append((200 + k, " ".join(passage + new(k % 5))))
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for i, t in docs if (w := t.split())}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for medium in (2048, 8):
        monkeypatch.setattr(jaccard_join, "MEDIUM", medium)
        assert {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(df, words=5, percent=80).collect()} == root


def test_sets_of_a_frequent_signature_stay_apart(spark):
    """More sets than 2,048 that share a signature but are far apart: no ties, so no component of all of them to compare block by block."""
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, 60, dtype=np.uint64) for _ in range(2500)]
    near = np.append(sets[7][1:], np.uint64(5))
    rows = [(1, k, 60, jaccard_join.sketch(x)) for k, x in enumerate([*sets, near])]
    ties = jaccard_join.ties_by_sketch(spark.createDataFrame(rows, "sig long, node long, n long, sketch binary").coalesce(1), 80).collect()
    assert [tuple(r) for r in ties] == [(2500, 7)]


def test_scratch_tables_keep_no_shuffles(spark, monkeypatch):
    """While a table is written, Spark is told to delete what is shuffled for it; then the session's setting is as before."""
    from pyspark.sql.classic.dataframe import DataFrame

    from spanweave import scratch

    before, seen, write = spark.conf.get(scratch.CLEANUP, None), [], DataFrame.write.fget
    monkeypatch.setattr(DataFrame, "write", property(lambda df: (seen.append(spark.conf.get(scratch.CLEANUP)), write(df))[1]))
    assert scratch.Scratch(spark).save(spark.range(1000).repartition(3, "id")).count() == 1000
    assert seen == ["true"] and spark.conf.get(scratch.CLEANUP, None) == before



def test_pii(awkward):
    assert pii.find_pii(awkward).count() == len(AWKWARD)


def test_pii_beyond_the_contexts_of_seeds(spark):
    """A second and a third context, which no entity of fixed form stands in, are reached through discovered tokens."""
    texts = [f"contact p{k}@mail.org today" for k in range(10)] + [f"contact usr{k}x77 today" for k in range(3)]
    texts += [f"badge usr{k}x77 please" for k in range(3) for _ in range(4)] + [f"badge zz{k}q55 please" for k in range(3)]
    texts += [f"locker zz{k}q55 below" for k in range(3) for _ in range(6)] + ["locker kk9w31 below", "nothing abc123 there"]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {t.split()[1] for r in rows if r["n_more"] for t in [texts[r["doc_id"]]]}
    assert found == {f"usr{k}x77" for k in range(3)} | {f"zz{k}q55" for k in range(3)} | {"kk9w31"}


def test_licenses(awkward, empty):
    s = licenses.Scanner()
    assert s.scan("x under the Apache License, Version 2.0")[:6] == (8, 1, 3, 3, "apache", "apache")
    assert "apache-2.0-notice" in s.scan("Licensed under the Apache License, Version 2.0")[5]
    assert licenses.scan_licenses(awkward).count() == len(AWKWARD) and licenses.scan_licenses(empty).count() == 0


def test_licenses_against_all_places():
    """Phrases by slices of words, templates by the automaton from every place rather than from anchors."""
    rng = random.Random(11)
    scanner = licenses.Scanner()
    marked = [m for own in licenses.TEMPLATES.values() for m in ([own] if isinstance(own, str) else own)]
    pieces = list(licenses.PHRASES) + [m.replace("<<optional>>", "").replace("<<end>>", "") for m in marked] + ["some other words", "license"]
    for _ in range(200):
        words = " ".join(w if not w.startswith("<<") and not w.endswith(">>") else "odd" for w in " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 4))).split())
        words = words.split()
        at = {(k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()}
        found = {label for label, automaton, *_ in scanner.templates if any(automaton.match([w.encode() for w in words], k) > k for k in range(len(words)))}
        n, n_base, first, last, base, labels, _ = scanner.scan(" ".join(words))
        places = [k for k, _ in at]
        assert (n, n_base, first, last) == (len(words), len(places), min(places, default=None), max(places, default=None))
        assert base == ",".join(sorted({x for _, x in at})) and labels == ",".join(sorted({x for _, x in at} | found))


def test_versions_of_the_gpl():
    s = licenses.Scanner()
    for version in ("v3", "version 3", "v3 version 3", "Version 3.0"):
        assert "gpl-version-3" in s.scan(f"under the GNU General Public License, {version}")[5].split(",")
    for version in ("version 2", "v2", "", "as published; section 3"):
        assert "gpl-version-3" not in s.scan(f"covered by the GNU General Public License {version}")[5] and s.scan(f"the GNU General Public License {version}")[6] == 0.5


def test_neighbours(spark):
    rng = random.Random(4)
    data = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)] + [(400, None), (450, [0.0] * 8), (500, [float("nan")] * 8), (550, [])]
    out = hilbert_neighbours.nearest_neighbours(spark.createDataFrame(data, "vec_id long, embedding array<double>"), __import__("pyspark").sql.functions.col("vec_id") % 50 == 0).collect()
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
    fine = dict(data[:300])
    for q in range(0, 300, 50):
        wanted = sorted((-cos(fine[q], fine[i]), i) for i in fine if i != q)[:5]
        assert [r["vec_id"] for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])] == [i for _, i in wanted]
    assert len(out) == 30


def test_neighbours_of_repeated_rows(spark):
    rng = random.Random(8)
    data = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
    fine = dict(data)
    wanted = sorted((i for i in fine if i != 50), key=lambda i: (-cos(fine[50], fine[i]), i))[:5]
    df = spark.createDataFrame(data + [(wanted[0], fine[wanted[0]])] * 5, "vec_id long, embedding array<double>")
    out = hilbert_neighbours.nearest_neighbours(df, __import__("pyspark").sql.functions.col("vec_id") == 50).orderBy("rank").collect()
    assert [r["vec_id"] for r in out] == wanted


def test_neighbours_of_each_length(spark):
    rng = random.Random(9)
    data = [(i, [rng.gauss(0, 1) for _ in range(8 if i < 60 else 3)]) for i in range(80)]
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
    fine = dict(data)
    out = hilbert_neighbours.nearest_neighbours(spark.createDataFrame(data, "vec_id long, embedding array<double>"), __import__("pyspark").sql.functions.col("vec_id") % 35 == 0).collect()
    for q in (0, 35, 70):
        wanted = sorted((i for i in fine if i != q and len(fine[i]) == len(fine[q])), key=lambda i: (-cos(fine[q], fine[i]), i))[:5]
        assert [r["vec_id"] for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])] == wanted
    assert len(out) == 15


def test_toxicity(awkward, spark):
    docs = [(k % 2, f"some words here {'you idiot moron' if k % 2 else 'nice day'} number{k} and more") for k in range(200)]
    machine = toxicity.Machine(*toxicity.train(docs))
    bad, good, gapped, none = machine.scores(["what an idiot moron.", "what a nice day.", "you i-d-i-o-t, m.o.r.o.n", ""])
    assert bad > 0.5 > good and gapped > good and 0 <= none < 0.5
    assert toxicity.score_toxicity(awkward, toxicity.train([])).filter("predicted = 0").count() == len(AWKWARD)
