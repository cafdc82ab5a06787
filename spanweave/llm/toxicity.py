"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Two words are alike as far as they share subsequences of three letters; a
subsequence counts less the wider its gaps are, so that "idxiot", "i-d-i-o-t"
and "1diot" stay near "idiot". A sentence is the sum of its words (a
convolution kernel), the Nyström map of the landmark words gives it a vector,
and a linear machine with squared hinge loss separates the sentences. Labels
belong to documents: the sentences of a clean one are all clean, of a toxic
one the machine's own worst sentence is, over a few rounds. A document's
margin is that of its worst sentence; a logistic curve turns it into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations
from sys import intern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import chunks, python_ready, table, text_or_empty, without

#: The bounded sample that the machine learns from: documents a class, characters of text altogether and of one text
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_TEXT = {1: 1500, 0: 3000}, 8_000_000, 400_000
LANDMARKS = {"toxic": 56, "clean": 20}
#: Decay of a subsequence for each letter it spans, the widest span, the kernel value below which words count as unrelated, the
#: power that sharpens it, the value from which two landmarks are one, and slack for subsequences that a word repeats
DECAY, SPAN, FLOOR, POWER, APART, SURE = 0.7, 6, 0.45, 2, 0.75, 0.8
WINDOW, STEP = 24, 12
ROUNDS, REGULAR = 4, 1e-2
CACHE = 500_000
#: Words whose kernel values are worked out at a time in training
WORDS = 20_000
# Digits and signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
#: Four or more single letters with a sign or space between each
SPACED = re.compile(r"(?<![^\W_])(?:[^\W_][^\w\n]{1,2}){3,}[^\W_](?![^\W_])")
ADDED = ("held_out", "score", "predicted")


def letters(words: list[str]) -> list[str]:
    """Words with lookalikes as letters and other signs left out."""
    if not words:
        return []
    line = "\n".join(words)
    plain = re.sub(r"[^\w\n]|_", "", re.sub(r"(?<=[^\W\d_])[013457@$!](?=[^\W_])", lambda m: LOOKALIKES[m[0]], re.sub(r"(?<![^\n])[13457@$](?=[^\W\d_])", lambda m: LOOKALIKES[m[0]], line)))
    return plain.split("\n")


def windows(word: str) -> list[str]:
    """The word, or pieces of WINDOW letters that overlap and cover it."""
    return [word[at : at + WINDOW] for at in range(0, max(1, len(word) - STEP), STEP)] if len(word) > WINDOW else [word]


class SubsequenceKernel:
    """Kernel values of words with landmarks; a mark before and after each word takes part like a letter."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.code_of = np.zeros(0x110000, dtype=np.uint8)
        self.code_of[ord("a") : ord("z") + 1] = np.arange(1, 27)
        self.code_of[ord("0") : ord("9") + 1] = 27
        self.code_of[0xAA:] = 28 + np.arange(0xAA, 0x110000) % 34
        self.code_of[ord("<")], self.code_of[ord(">")] = 62, 63
        self.gaps = [(d1, d2) for d2 in range(2, SPAN) for d1 in range(1, d2)]
        self.row_of = np.zeros(1 << 18, dtype=np.int32)  # 0: in no landmark
        rows = [np.zeros(len(landmarks))]
        for k, word in enumerate(landmarks):
            codes = self.code_of[[ord(c) for c in f"<{word}>"]]
            for a, b, c in combinations(range(len(codes)), 3):
                if c - a < SPAN:
                    code = int(codes[a]) << 12 | int(codes[b]) << 6 | int(codes[c])
                    if not self.row_of[code]:
                        self.row_of[code] = len(rows)
                        rows.append(np.zeros(len(landmarks)))
                    rows[self.row_of[code]][k] += DECAY ** (c - a + 1)
        self.table = np.array(rows, dtype=np.float32)
        self.norms = np.sqrt((self.table.astype(float) ** 2).sum(0)) + 1e-12

    def __call__(self, words: list[str]) -> np.ndarray:
        """One row a word; words over WINDOW letters count by their best-matching window."""
        out = np.zeros((len(words), len(self.landmarks)), dtype=np.float32)
        pieces, owner = [], []
        for k, w in enumerate(words):
            for piece in windows(w):
                pieces.append(f"<{piece}>")
                owner.append(k)
        sizes, owner = np.array([len(p) for p in pieces], dtype=np.int64), np.array(owner, dtype=np.int64)
        for low, high in ((4, 8), (9, 11), (12, 15), (16, WINDOW + 2)):
            which = np.flatnonzero((sizes >= low) & (sizes <= high))
            for start in range(0, len(which), 2000):
                part = which[start : start + 2000]
                np.maximum.at(out, owner[part], self.short([pieces[k] for k in part], high))
        return out

    def short(self, words: list[str], width: int) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)), dtype=np.float32)
        codes = self.code_of[np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)].astype(np.int32)
        squares, all_codes, all_weights = np.zeros(len(words)), [], []
        for d1, d2 in self.gaps:
            if d2 < width:
                a, b, c = codes[:, : width - d2], codes[:, d1 : width - d2 + d1], codes[:, d2:]
                code = (a << 12 | b << 6 | c) * (c > 0) * (b > 0) * (a > 0)
                squares += DECAY ** (2 * d2 + 2) * (code > 0).sum(1)
                all_codes.append(code)
                all_weights.append(np.full(code.shape[1], DECAY ** (d2 + 1), dtype=np.float32))
        code, weight = np.concatenate(all_codes, axis=1), np.concatenate(all_weights)
        rows = self.row_of[code]
        # the part of a word's vector that no landmark has takes its share from every kernel value; repeats only lengthen the vector
        near = np.flatnonzero(((rows > 0) @ weight**2) >= FLOOR**2 * squares * SURE)
        if not len(near):
            return out
        code, rows = code[near], rows[near]
        hit = np.flatnonzero(rows.ravel())
        word = hit // code.shape[1]
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        values = np.add.reduceat(self.table[rows.ravel()[hit]] * weight[hit % code.shape[1]][:, None], starts) / self.norms
        who = word[starts]
        close = np.flatnonzero(values.max(1) >= FLOOR * np.sqrt(squares[near[who]]))
        if not len(close):
            return out
        who, values = who[close], values[close]
        # a subsequence that a word holds twice counts with both weights at once
        code = code[who]
        order = np.argsort(code, axis=1, kind="stable")
        code, weights = np.take_along_axis(code, order, 1), weight[order]
        new = np.ones(code.shape, dtype=bool)
        new[:, 1:] = code[:, 1:] != code[:, :-1]
        first = np.flatnonzero(new.ravel())
        sums = np.add.reduceat(weights.ravel(), first) * (code.ravel()[first] > 0)
        values = values / np.sqrt(np.bincount(first // code.shape[1], sums.astype(float) ** 2, minlength=len(who)))[:, None]
        out[near[who]] = np.where(values >= FLOOR, values**POWER, 0)
        return out


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence in lower case, as they stand; letters set apart come in as a word of their own too."""
    out = []
    for line in text.lower().split("\n"):
        words: list[str] = []
        for w in map(intern, line.split()):
            words.append(w)
            if w[-1] in ".!?":
                out.append(words)
                words = []
        words += [re.sub(r"\W", "", m[0]) for m in SPACED.finditer(line)]
        if words:
            out.append(words)
    return out


def choose_landmarks(docs: list[tuple[int, list[list[str]]]]) -> list[str]:
    """The words that speak most for a toxic document, apart from each other, and the words of clean ones that come near them."""
    counts, totals = (Counter(), Counter()), [0, 0]
    for label, text in docs:
        totals[label] += 1
        distinct = {w for s in text for w in s}
        counts[label].update(w for w in set(letters(list(distinct))) if len(w) >= 3)
    rate = lambda w, k: (counts[k][w] + 0.5) / (totals[k] + 1)
    toxic: list[str] = []
    for w in sorted((w for w in counts[1] if counts[1][w] >= 3), key=lambda w: (-counts[1][w] * np.log(rate(w, 1) / rate(w, 0)), w))[: 8 * LANDMARKS["toxic"]]:
        for piece in windows(w):
            # a word much like one that is there adds nothing
            if len(toxic) < LANDMARKS["toxic"] and (not toxic or SubsequenceKernel(toxic)([piece]).max() < APART**POWER):
                toxic.append(piece)
    # of clean documents the words that come nearest to those
    often = sorted((w for w in counts[0] if counts[0][w] >= 3 and counts[0][w] > 10 * counts[1][w] * totals[0] / totals[1] / 5 and w not in toxic), key=lambda w: (-counts[0][w], w))
    beside = SubsequenceKernel(toxic)
    near = np.concatenate([np.zeros(0)] + [beside(often[k : k + WORDS]).max(1, initial=0) for k in range(0, len(often), WORDS)]) if toxic else np.zeros(len(often))
    clean = [often[k] for k in np.argsort(-near, kind="stable")[: LANDMARKS["clean"]] if near[k] > 0]
    return list(dict.fromkeys(toxic + [piece for w in clean for piece in windows(w)]))


class Machine:
    """A word's weight, hence a sentence's margin and a document's score."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float, slope: np.ndarray, shift: float):
        self.kernel, self.weights, self.bias, self.slope, self.shift = SubsequenceKernel(landmarks), weights, bias, slope, shift
        self.known: dict[str, float] = {}
        self.plain: dict[str, float] = {}
        self.related: set[str] = set()

    def learn_words(self, words: set[str]) -> None:
        """After this the weight of each of the words is known; related holds those that have one."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            self.plain.clear()
            self.related.clear()
            new = words
        new = list(new)
        plain = letters(new)
        unseen = list(set(plain).difference(self.plain))
        self.plain.update(zip(unseen, (self.kernel(unseen) @ self.weights).tolist(), strict=True))
        self.known.update((w, self.plain[p]) for w, p in zip(new, plain, strict=True))
        self.related.update(w for w, p in zip(new, plain, strict=True) if self.plain[p])

    def scores(self, texts: list[str]) -> list[float]:
        words = [t.lower().split() for t in texts]
        spaced = [bool(SPACED.search(t.lower())) for t in texts]
        self.learn_words(set().union(*words))
        rows = []
        for t, w, s in zip(texts, words, spaced, strict=True):
            if not s and self.related.isdisjoint(w):
                rows.append((self.bias, 0.0, 0.0))  # no sentence has a word with a weight
                continue
            parts = sentences(t)
            if s:
                self.learn_words({x for p in parts for x in p}.union(*words))
            rows.append(summary([[self.known[x] for x in p] for p in parts], self.bias))
        return (1 / (1 + np.exp(-np.clip(np.array(rows) @ self.slope + self.shift, -40, 40)))).tolist()


def summary(weights: list[list[float]], bias: float) -> tuple[float, float, float]:
    """Of a document from its words' weights by sentence: the worst sentence's margin, what its words add up to, and that against its length."""
    total, n = sum(x for p in weights for x in p), sum(map(len, weights))
    return bias + max(map(sum, weights), default=0.0), max(-2.0, min(6.0, total)), total / (n + 20) ** 0.5


def train(docs: list[tuple[int, str]]) -> tuple:
    """Arguments of Machine from (label, text) pairs; without both labels a machine that gives the labels' share."""
    split = [(int(label), sentences(text)) for label, text in dict.fromkeys(docs)]
    positives = sum(label for label, _ in split)
    prior = float(np.log((positives + 1) / (len(split) - positives + 2)))
    if not positives or positives == len(split):
        return [], np.zeros(0, dtype=np.float32), 0.0, np.zeros(3), prior
    landmarks = choose_landmarks(split)
    kernel = SubsequenceKernel(landmarks)
    inner = kernel(landmarks).astype(float)
    inner = (inner + inner.T) / 2
    values, vectors = np.linalg.eigh(inner)
    half = vectors * np.where(values > 1e-6, np.maximum(values, 1e-6) ** -0.5, 0) @ vectors.T
    # rows are held of the words that come near a landmark only, which are few
    vocabulary = sorted({w for _, text in split for s in text for w in s})
    place, rows = {}, [np.zeros((0, len(landmarks)), dtype=np.float32)]
    for start in range(0, len(vocabulary), WORDS):
        part = vocabulary[start : start + WORDS]
        values = kernel(letters(part))
        near = np.flatnonzero(values.any(axis=1))
        place.update(zip([part[k] for k in near], range(len(place), len(place) + len(near)), strict=True))
        rows.append(values[near])
    del vocabulary
    words = np.concatenate(rows) @ half
    x, doc, label, times = [], [], [], []
    for k, (y, text) in enumerate(split):
        # sentences without a related word are all the same point
        own = [at for s in text if (at := [place[w] for w in s if w in place])]
        x += [words[at].sum(0) for at in own] + [np.zeros(len(landmarks))]
        doc += [k] * (len(own) + 1)
        times += [1] * len(own) + [max(1, len(text) - len(own))]
        label.append(y)
    x, doc, label, times = np.array(x), np.array(doc), np.array(label), np.array(times, dtype=float)
    starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    toxic = label[doc] == 1
    # in the first round a toxic document's worst sentence is the one nearest to the toxic landmarks
    weight, bias = half @ np.append(np.ones(min(LANDMARKS["toxic"], len(landmarks))), np.zeros(max(0, len(landmarks) - LANDMARKS["toxic"])))[: len(landmarks)], 0.0
    for _ in range(ROUNDS):
        margin = x @ weight + bias
        worst = np.array([s + int(np.argmax(margin[s:e])) for s, e in zip(starts, np.append(starts[1:], len(doc)), strict=True)])
        use = np.concatenate([worst[label == 1], np.flatnonzero(~toxic)])
        y = np.where(toxic[use], 1.0, -1.0)
        cost = np.where(y > 0, times[~toxic].sum() / max(1, (label == 1).sum()) / 4, times[use])
        weight, bias = squared_hinge(x[use], y, cost / cost.sum())
    own = dict(zip(place, (words @ weight).tolist(), strict=True))
    rows = np.array([summary([[own.get(w, 0.0) for w in s] for s in text], bias) for _, text in split])
    slope, shift = logistic(rows, label)
    return landmarks, (half @ weight).astype(np.float32), float(bias), slope, shift


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton's method on the primal problem."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.diag(np.append(np.full(x.shape[1], REGULAR * 0.01), 1e-9))
    for _ in range(30):
        inside = y * (z @ w) < 1
        if not inside.any():
            break
        zi, ci = z[inside], cost[inside]
        new = np.linalg.solve(ridge + (zi * ci[:, None]).T @ zi, (zi * ci[:, None]).T @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def logistic(rows: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    n1, n0 = int(label.sum()), int((1 - label).sum())
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.column_stack([rows, np.ones(len(rows))])
    w = np.zeros(z.shape[1])
    for _ in range(80):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(w)), z.T @ (target - p) - 1e-3 * w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> list[tuple[int, str]]:
    """(label, text) of at most SAMPLE_ROWS identifiers a label and SAMPLE_CHARS characters, in hash order, from the training fold.

    An identifier counts once: with its highest label and one of its texts.
    Texts of over SAMPLE_TEXT characters teach nothing, so that none of them
    takes the others' room.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("__label"))
    wanted = None
    for label, n in SAMPLE_ROWS.items():
        part = known.filter(F.col("__label") == label).orderBy(F.xxhash64(id_col), id_col).limit(n)
        wanted = part if wanted is None else wanted.unionByName(part)
    rows = docs.select(id_col, text_or_empty(text_col).alias("__text")).filter(F.length("__text") <= SAMPLE_TEXT).join(F.broadcast(wanted), id_col)
    chosen = rows.groupBy(id_col, "__label").agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"))
    sizes = chosen.select(id_col, F.length("__text").alias("__n"), F.xxhash64(id_col).alias("__h")).collect()
    total, ids = 0, []
    for r in sorted(sizes, key=lambda r: (r["__h"], r[id_col])):
        total += r["__n"]
        if total > SAMPLE_CHARS:
            break
        ids.append(r[id_col])
    kept = chosen.filter(F.col(id_col).isin(ids)) if len(ids) < len(sizes) else chosen
    return sorted((r["__label"], r["__text"]) for r in kept.collect())


#: A worker process keeps its machine, with the words it knows, from task to task.
_machines: dict[tuple, Machine] = {}


def machine_of(model: tuple) -> Machine:
    key = (tuple(model[0]), model[1].tobytes(), model[2], model[3].tobytes(), model[4])
    if key not in _machines:
        _machines.clear()
        _machines[key] = Machine(*model)
    return _machines[key]


def score_toxicity(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns keep (all, if None) of docs with score (0 to 1) and predicted (score >= 0.5).

    Every whole text is scored, however long, in memory of some times its
    size; null and empty ones get the score of a text without any related
    word. Rows that repeat are scored alike; an empty table gives an empty
    one. Input columns named like an added one are replaced. One pass without
    a shuffle.
    """
    python_ready(docs.sparkSession)
    docs = without(docs, *ADDED)
    docs = docs.select(*(docs.columns if keep is None else keep), text_or_empty(text_col).alias("__text"))
    names = docs.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema[:-1]) + ", score double, predicted int"

    def run(batches):
        machine = machine_of(model)
        for batch in batches:
            score = [s for texts in chunks(batch.column(len(names)).to_pylist()) for s in machine.scores(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32())], names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, schema)


def op1(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(training_sample(docs, table(spark, sf_dir, "labels")))
    return score_toxicity(docs, model, keep=("doc_id",)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
