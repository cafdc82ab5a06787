"""Token counts of a piece vocabulary by rank-synchronous array merging.

A text falls into pre-tokens that no merge crosses (every piece holds the
space mark only in front). The pre-tokens of a batch are one ragged array of
symbols; a round finds each sequence's best-ranked neighbouring pair, leftmost
of equals, and merges it in all sequences at once. When no sequence has a pair
left, the surviving symbols are counted; a character outside the vocabulary
counts once for each of its UTF-8 bytes. Sequences longer than ``LONG``
symbols, which would need as many rounds, merge by a heap instead, in the same
order.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import chunks, python_ready, table, text_or_empty

MARK = "▁"
LONG = 64
#: Counts of pre-tokens that a worker remembers, and symbols merged in one ragged array
CACHE, BATCH_SYMBOLS = 500_000, 400_000
LIMIT = 4096
SCHEMA = "n_bytes long, n_tokens long, over_limit boolean"


class PieceMerger:
    """Counts tokens with the pieces and scores of a sentencepiece BPE model."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        odd = [sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        pieces = {sp.id_to_piece(i): i for i in range(n) if not odd[i]}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds a space mark inside; texts can't be cut into pre-tokens")
        #: by code point; below 0 for characters outside the vocabulary: their UTF-8 bytes
        self.symbol_of = np.full(0x110000, -4, dtype=np.int32)
        self.symbol_of[:0x10000], self.symbol_of[:0x800], self.symbol_of[:0x80] = -3, -2, -1
        for p, i in pieces.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        rank = {i: r for r, i in enumerate(sorted(pieces.values(), key=lambda i: (-sp.get_score(i), i)))}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for p, i in pieces.items():
            for cut in range(1, len(p)):
                left, right = pieces.get(p[:cut]), pieces.get(p[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = (rank[i], i)
        self.bits = 19
        keys = np.array([a * n + b for a, b in self.pairs], dtype=np.uint64)
        while True:  # a table in which few keys share a slot; the rest stand in slots after it
            if len(keys) * 3 < 1 << self.bits:
                break
            self.bits += 1
        self.size = n
        self.keys = np.full((1 << self.bits) + 64, -1, dtype=np.int64)
        self.ranks = np.full((1 << self.bits) + 64, NONE, dtype=np.int64)
        self.made = np.zeros((1 << self.bits) + 64, dtype=np.int32)
        self.probes = 1
        for k, (r, i) in zip(keys, self.pairs.values(), strict=True):
            at = start = (int(k) * FACTOR & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.ranks[at], self.made[at] = int(k), r, i
            self.probes = max(self.probes, at - start + 1)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NONE where there is none. Symbols below 0 are unknown characters."""
        ranks, made = np.full(len(left), NONE, dtype=np.int64), np.zeros(len(left), dtype=np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = left[todo].astype(np.int64) * self.size + right[todo]
        at = (key.astype(np.uint64) * np.uint64(FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)
        for _ in range(self.probes):
            there = self.keys[at]
            hit = there == key
            ranks[todo[hit]], made[todo[hit]] = self.ranks[at[hit]], self.made[at[hit]]
            on = ~hit & (there >= 0)
            if not on.any():
                break
            todo, key, at = todo[on], key[on], at[on] + 1
        return ranks, made

    def ranked(self, sym: np.ndarray, seq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """look_up of the pairs that start at these places; none where a sequence ends."""
        ranks, made = np.full(len(at), NONE, dtype=np.int64), np.zeros(len(at), dtype=np.int32)
        inside = np.flatnonzero(at + 1 < len(sym))
        inside = inside[seq[at[inside]] == seq[at[inside] + 1]]
        ranks[inside], made[inside] = self.look_up(sym[at[inside]], sym[at[inside] + 1])
        return ranks, made

    def count(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token; one without a mark stands for the same with one in front."""
        words = [w if w[:1] == MARK else MARK + w for w in words]
        out = [0] * len(words)
        short, symbols = [], 0
        for k, w in enumerate(words):
            if len(w) > LONG:
                out[k] = self.count_long(w)
                continue
            short.append(k)
            symbols += len(w)
            if symbols > BATCH_SYMBOLS:
                self.fill(out, words, short)
                short, symbols = [], 0
        self.fill(out, words, short)
        return out

    def symbols(self, text: str) -> np.ndarray:
        return self.symbol_of[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]

    def fill(self, out: list[int], words: list[str], which: list[int]) -> None:
        if not which:
            return
        sym = self.symbols("".join(words[k] for k in which))
        lengths = np.array([len(words[k]) for k in which])
        counts = np.zeros(len(which), dtype=np.int64)
        seq = np.repeat(np.arange(len(which)), lengths)
        ranks, made = self.ranked(sym, seq, np.arange(len(sym)))
        while len(sym):
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            best = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.append(starts, len(seq)))
            over = best == NONE
            keep = np.ones(len(sym), dtype=bool)
            if over.any():
                counts[seq[starts[over]]] = np.add.reduceat(np.where(sym < 0, -sym, 1), starts)[over]
                keep = ~np.repeat(over, sizes)
            at = np.flatnonzero((ranks == np.repeat(best, sizes)) & keep)
            first = at[np.append(True, seq[at[1:]] != seq[at[:-1]])] if len(at) else at
            sym[first] = made[first]
            keep[first + 1] = False
            moved = np.cumsum(keep)[first] - 1
            sym, seq, ranks, made = sym[keep], seq[keep], ranks[keep], made[keep]
            # a merge changes the pair that starts at its symbol and the one that ends there
            changed = np.concatenate([moved, moved[moved > 0] - 1])
            ranks[changed], made[changed] = self.ranked(sym, seq, changed)
        for k, n in zip(which, counts.tolist(), strict=True):
            out[k] = n

    def count_long(self, word: str) -> int:
        sym = self.symbols(word).tolist()
        n = len(sym)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(*p, i, sym[i], sym[i + 1]) for i in range(n - 1) if (p := self.pairs.get((sym[i], sym[i + 1])))]
        heap = [(r, i, a, b, m) for r, m, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], alive[j], after[i] = made, False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (p := self.pairs.get((sym[x], sym[y]))):
                    heapq.heappush(heap, (p[0], x, sym[x], sym[y], p[1]))
        return sum(1 if s >= 0 else -s for s, on in zip(sym, alive, strict=True) if on)


NONE = np.iinfo(np.int64).max
FACTOR = 0x9E3779B97F4A7C15
#: Space marks, then anything else.
PRE_TOKEN = re.compile("▁*[^▁]+|▁+")


#: A worker process keeps the merger and the counts it knows from task to task.
_kept: dict[str, tuple[PieceMerger, dict]] = {}


def count_texts(model: str, texts: list[str]) -> list[int]:
    """Tokens of each text; all pre-tokens not known yet are merged in one go."""
    if model not in _kept:
        _kept[model] = PieceMerger(model), {}
    merger, known = _kept[model]
    words = [pre_tokens(t) for t in texts]
    distinct = set().union(*words)
    new = distinct.difference(known)
    if len(known) + len(new) > CACHE:
        known.clear()
        new = distinct
    new = list(new)
    known.update(zip(new, merger.count(new), strict=True))
    return [sum(map(known.__getitem__, w)) for w in words]


def pre_tokens(text: str) -> list[str]:
    """Each begins with its space marks; the model normalises nothing but spaces, and puts one in front of a text."""
    if not text:
        return []
    text = f"{MARK}{text.replace(' ', MARK)}"
    if MARK * 2 in text or text[-1] == MARK:
        return PRE_TOKEN.findall(text)
    return text[1:].split(MARK)  # single spaces: the mark is understood, see PieceMerger.count


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """id_col, n_bytes, n_tokens, over_limit for every row of docs; null and empty texts have 0 bytes and 0 tokens.

    One pass without a shuffle; a worker holds one batch of texts and a cache
    of bounded size. Other columns aren't read.
    """
    python_ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n_bytes, n_tokens = [], []
            for texts in chunks(batch.column(1).to_pylist()):
                n_bytes += [len(t.encode("utf-8", "surrogatepass")) for t in texts]
                n_tokens += count_texts(model, texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")


def op5(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
