"""Harmonic packing of token sequences.

A document's tokens are cut into pieces whose lengths are the capacity, then
halves of it down to ``GRAIN``, then a rest. A piece of length n is of class
floor(capacity / n), and a bin of class k takes k pieces: cut pieces fill
theirs without padding, and rests, shorter than GRAIN, nearly so. Every worker
keeps one open bin a class and fills it on its own, so nothing is shuffled; at
the end of its partition it lays its open bins together, longest first.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import WordCache, chunks, python_ready, table, text_or_empty

CAPACITY, GRAIN, END_ID = 2048, 256, 1
#: Units that a worker remembers
CACHE = 300_000
#: White space (that of all libraries in use and more) with the word that follows: no token of the byte-level vocabulary's pattern crosses from a word to white space.
UNIT = re.compile(r"\s*\S+|\s+")
#: Four control characters are white space to this pattern but not to the vocabulary's; texts with one are encoded whole.
UNSURE = re.compile("[\x1c-\x1f]")
#: Texts whose character classes all versions of Unicode share
PLAIN = re.compile("[\n -~À-ÖØ-öø-ÿ]*")
#: White space of more than one character, where the cut looks ahead
RUNS = re.compile(r"\s\s")
# The byte-level vocabulary's own cut, without and with the looking ahead.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
PATTERN_RUNS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """The ids that the tokenizers library gives, as little-endian bytes.

    Plain texts come from a faster library over the same ranks, if its file is
    given; tests hold the two against each other. Of other texts the library
    encodes unit by unit, remembering units.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = WordCache(CACHE)
        self.fast = None
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = [tiktoken.Encoding(name, pat_str=p, mergeable_ranks=table, special_tokens={}) for name, p in (("single", PATTERN), ("runs", PATTERN_RUNS))]

    def slow(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        rest = []
        for k, t in enumerate(texts):
            if UNSURE.search(t) or any(s in t for s in self.special):
                out[k] = self.slow([t])[0]
            elif self.fast and PLAIN.fullmatch(t):
                out[k] = np.array(self.fast[bool(RUNS.search(t))].encode_ordinary(t), dtype="<u4").tobytes()
            else:
                rest.append(k)
        units = [UNIT.findall(texts[k]) for k in rest]
        new = list(set().union(*units).difference(self.known))
        self.known.room(len(new))
        new = list(set().union(*units).difference(self.known))
        self.known.update(zip(new, self.slow(new), strict=True))
        for k, u in zip(rest, units, strict=True):
            out[k] = b"".join(map(self.known.__getitem__, u))
        return out


#: A worker process keeps its encoder from task to task.
_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, ranks: str | None) -> Encoder:
    if (path, ranks) not in _encoders:
        _encoders[path, ranks] = Encoder(path, ranks)
    return _encoders[path, ranks]


def cuts(n: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Lengths of the pieces of n tokens."""
    out, size = [capacity] * (n // capacity), capacity
    n %= capacity
    while size > grain:
        size //= 2
        if n >= size:
            out.append(size)
            n -= size
    return out + [n] * (n > 0)


class Bins:
    """Open bins by class; a full bin is handed out as (sequence, pieces)."""

    def __init__(self, capacity: int = CAPACITY, first: int = 0):
        self.capacity, self.next, self.open = capacity, first, {}

    def add(self, piece: tuple, n: int) -> Iterator[tuple[int, list]]:
        k = self.capacity // n
        held = self.open.setdefault(k, [])
        held.append((piece, n))
        if len(held) == k:
            yield self.close(self.open.pop(k))

    def close(self, held: list) -> tuple[int, list]:
        self.next += 1
        return self.next - 1, held

    def rest(self) -> Iterator[tuple[int, list]]:
        """Lays the open bins together: first fit, longest first. There is at most one a class."""
        bins: list[tuple[int, list]] = []
        for held in sorted(self.open.values(), key=lambda h: -sum(n for _, n in h)):
            size = sum(n for _, n in held)
            for k, (used, there) in enumerate(bins):
                if used + size <= self.capacity:
                    bins[k] = used + size, there + held
                    break
            else:
                bins.append((size, held))
        self.open = {}
        for _, held in bins:
            yield self.close(held)


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all rows of docs: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Every row's ids, end_id last, lie in its pieces once each; a null or empty
    text is end_id alone, and repeated rows are packed as often as they
    stand. sequence_id is the partition's number times 2^32 plus a count, so
    that a partition done again after a loss gives the same. An empty table
    gives no pieces. Columns other than the two aren't read.
    """
    python_ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = pa.from_numpy_dtype(np.int64) if kind == "bigint" else None
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def run(batches):
        enc, bins, out = encoder(tokenizer, ranks), Bins(capacity, TaskContext.get().partitionId() << 32), []
        end = np.array([end_id], dtype="<u4").tobytes()
        types = [id_type, *[pa.int64()] * 6, *[pa.list_(pa.int32())] * with_ids]

        def rows(sequence, held):
            offset = 0
            for piece, n in held:
                out.append((*piece[:5], sequence, offset, *piece[5:]))
                offset += n

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for batch in batches:
            types[0] = batch.schema.field(0).type
            ids = iter(batch.column(0).to_pylist())
            for texts in chunks(batch.column(1).to_pylist()):
                for data in enc.encode(texts):
                    data += end
                    doc, start, total = next(ids), 0, len(data) // 4
                    for n in cuts(total, capacity):
                        own = data[4 * start : 4 * (start + n)]
                        piece = (doc, start, n, zlib.crc32(own), total, *[np.frombuffer(own, dtype="<u4").astype(np.int32)] * with_ids)
                        for full in bins.add(piece, n):
                            rows(*full)
                        start += n
            if out:
                yield batch_of()
                out.clear()
        for full in bins.rest():
            rows(*full)
        if out:
            yield batch_of()

    schema = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(run, schema)


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
