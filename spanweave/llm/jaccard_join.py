"""N-gram Jaccard self-join by PartEnum signatures, and the groups that its links make.

A document is the set of its word shingles. Sizes fall into bands such that
linked sets lie in one band or in neighbours; within a band the symmetric
difference of linked sets has at most k members. The hashed feature domain is
partitioned into n1 groups of two parts each: k differences leave some group
with one difference at most, hence one of the group's one-part subsets without
any, so linked sets share a signature (band, part, the part's members). With
groups beyond those needed they share as many more, in different groups, which
allows for leaving out signatures that unrelated sets share too. First, those of
fewer than ``FEW`` members; a set with more such groups than allowed for sends
out all its signatures, so that nothing is lost. Second, the most frequent of
those of more than ``SMALL`` sets, which are as many for every set: of two sets
that share one more than these, the rest of both have one in common.

Of up to ``SMALL`` sets that share a signature all pairs are candidates, and
parity sketches, whose distance bounds the symmetric difference from below,
let few pass that aren't linked. Of up to ``MEDIUM`` sets the groups that such
distances make are found at once. More sets than that are tied to the
signature's first one. The components of all these ties are then compared
exactly: in blocks of bounded size, every block against every other of its
component. Equal sets count as one node from the start, so the pairs of a
group of copies are never written, only links that join two groups of a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanweave.llm.common import WordCache, chunks, python_ready, table, text_or_empty, without
from spanweave.llm.components import connected_components
from spanweave.scratch import Scratch

#: Shingle width and the link rule 100 * intersection >= PERCENT * union of the registered query
WORDS, PERCENT = 4, 85
#: Members below which a signature is left out, and spare groups for that, and for signatures of many sets, as shares of the groups needed
FEW, SPARE, SHARED = 1, 0.12, 0.12
#: Sets of a signature whose pairs are candidates one by one, and whose sketches, of no more bytes than the last, are compared in one place
SMALL, MEDIUM, HELD = 16, 1 << 16, 1 << 26
#: Sets in a block, tasks in which a component's nodes learn of its blocks, bits of a parity sketch of up to so many members, bits of the filter that finds candidates' texts again
BLOCK, SALTS, SKETCH, FILTER_BITS = 512, 64, 1024, 1 << 23
#: Bytes that a worker hashes at a time, texts that it remembers, and signature rows that it looks through at a time
PIECE, SENT, ROWS = 1 << 17, 200_000, 1 << 16


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes:
    """64-bit hashes of the words of a buffer, found by prefix sums of a polynomial over its bytes.

    A byte's value is random, an upper-case letter's that of the lower-case one.
    All arithmetic is modulo 2**64, where the odd base has an inverse, so that
    a word hashes alike wherever it stands.
    """

    BASE, MASK = 0x9E6C63D0876A9A47, (1 << 64) - 1

    def __init__(self, piece: int):
        rng = np.random.default_rng(8)
        self.piece, self.value = piece, rng.integers(1, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
        self.value[ord("A") : ord("Z") + 1] = self.value[ord("a") : ord("z") + 1]
        self.space = np.zeros(256, dtype=bool)
        self.space[list(b" \t\n\v\f\r")] = True
        self.power, self.inverse = (np.cumprod(np.append(np.uint64(1), np.full(piece, x, dtype=np.uint64))) for x in (self.BASE, pow(self.BASE, -1, 1 << 64)))

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where each word starts, and its hash; piece by piece, so that long texts take no more memory."""
        codes = np.frombuffer(data, dtype=np.uint8)
        at, sums, scales = [], [], []
        total, scale, unscale, outside = 0, 1, 1, True
        for start in range(0, len(codes), self.piece):
            part = codes[start : start + self.piece]
            space = self.space[part]
            edge = np.flatnonzero(space != np.append(outside, space[:-1]))
            run = np.cumsum(np.append(np.uint64(0), self.value[part] * self.power[: len(part)]))
            at.append(edge + start)
            sums.append(run[edge] * np.uint64(scale) + np.uint64(total))
            scales.append(self.inverse[edge] * np.uint64(unscale))
            total = (total + int(run[-1]) * scale) & self.MASK
            scale, unscale = (scale * int(self.power[-1])) & self.MASK, (unscale * int(self.inverse[-1])) & self.MASK
            outside = bool(space[-1])
        if not outside:
            sums.append(np.array([total], dtype=np.uint64))
        if not sums:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        sums = np.concatenate(sums)
        return np.concatenate(at)[::2], mix((sums[1::2] - sums[::2]) * np.concatenate(scales)[::2])


class Shingler:
    """Sorted 64-bit hashes of a text's distinct shingles; ASCII letters in lower case, words apart by ASCII white space."""

    def __init__(self, words: int):
        self.words, self.word_hashes = words, WordHashes(PIECE)
        self.odd = mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        begins = np.cumsum([0] + [len(d) + 1 for d in data])
        at, h = self.word_hashes(b"\n".join(data))
        first = np.searchsorted(at, begins).tolist()
        rolled = self.rolled(h, self.words)
        return [distinct_sorted(rolled[a : b - self.words + 1] if b - a >= self.words else self.rolled(h[a:b], b - a)) for a, b in pairwise(first)]

    def rolled(self, h: np.ndarray, n: int) -> np.ndarray:
        """A hash of each run of n words; none of no words."""
        size = len(h) - n + 1
        if n == 0 or size <= 0:
            return h[:0]
        total = np.full(size, n, dtype=np.uint64)
        for k in range(n):
            total += h[k : k + size] * self.odd[k]
        return mix(total)


def distinct_sorted(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.append(True, h[1:] != h[:-1])] if len(h) else h


def node_of(s: np.ndarray) -> int:
    """A set's own hash."""
    return int(mix(np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum() + np.uint64(len(s))], dtype=np.uint64)).view(np.int64)[0])


class PartEnum:
    """Signatures of sets under a link rule of percent."""

    def __init__(self, percent: int):
        self.percent, self.bands, self.tops = percent, [], []

    def band(self, size: int) -> int:
        while not self.tops or self.tops[-1] < size:
            low = self.tops[-1] + 1 if self.tops else 1
            self.tops.append(low * 100 // self.percent)
        return int(np.searchsorted(self.tops, size))

    def groups(self, band: int) -> tuple[int, int, int]:
        """Groups of the band's partition and how many of them are spare, of either kind; 0 where linked sets are equal."""
        self.band(self.tops[-1] + 1 if len(self.tops) <= band else 1)
        k = 2 * self.tops[band] * (100 - self.percent) // (100 + self.percent)
        needed = k // 2 + 1
        spare, shared = 1 + int(needed * SPARE), int(needed * SHARED)
        return (needed + spare + shared, spare, shared) if k else (0, 0, 0)

    def shared_allowed(self, size: int, odd: int) -> int:
        """How many signatures of many sets a set may have among those of its odd or its even band."""
        own = self.band(size)
        return self.groups(own if own % 2 == odd else own + 1)[2]

    def signatures(self, s: np.ndarray) -> np.ndarray:
        own = self.band(len(s))
        while len(self.tops) <= own + 1:
            self.band(self.tops[-1] + 1)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(s + np.uint64(0xD6E8FEB86659FD93)))])
        out = []
        for band in (own, own + 1):
            groups, spare, _ = self.groups(band)
            if not groups:
                continue
            parts = 2 * groups
            part = ((s >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            counts = np.bincount(part, minlength=parts)
            ends = np.cumsum(counts)
            inside = sums[ends] - sums[ends - counts]
            seeds = np.arange(parts, dtype=np.uint64) + np.uint64((band + 1) << 32)
            # the lowest bit tells a set's two bands apart
            sig = mix(inside + mix(seeds)) & ~np.uint64(1) | np.uint64(band & 1)
            weak = counts < FEW
            if weak.reshape(groups, 2).any(1).sum() <= spare:
                sig = sig[~weak]
            out.append(sig)
        return np.concatenate(out).view(np.int64) if out else np.zeros(0, dtype=np.int64)


#: A worker process keeps its hashed words from task to task.
_shinglers: dict[int, Shingler] = {}


def shingler(words: int) -> Shingler:
    return _shinglers.setdefault(words, Shingler(words))


def fresh(batch: pa.RecordBatch, sent: WordCache, wanted: np.ndarray | None = None) -> list[str]:
    """Texts of a batch (text, h) whose hash hasn't been seen before, as far as sent remembers, and is wanted."""
    new = []
    hashes = batch.column(1).to_numpy()
    passed = np.arange(len(hashes)) if wanted is None else np.flatnonzero(wanted[hashes % FILTER_BITS])
    for k, h in zip(passed.tolist(), hashes[passed].tolist(), strict=True):
        if h not in sent:
            sent.room(1)
            sent[h] = True
            new.append(k)
    return batch.column(0).take(pa.array(new, pa.int64())).to_pylist()


def node_table(texts: DataFrame, words: int) -> DataFrame:
    """(id, h, node, n, sketch) of each row of texts (id, text, h); an empty set has no node."""
    kind = texts.schema[0].dataType.simpleString()

    def run(batches):
        known = WordCache(SENT // 4)
        for batch in batches:
            hashes = batch.column(2).to_pylist()
            known.room(len(hashes))
            first = {h: k for k, h in enumerate(hashes) if h not in known}
            new = batch.column(1).take(pa.array(list(first.values()), pa.int64())).to_pylist()
            sets = (s for run in chunks(new) for s in shingler(words).sets(run))
            known.update((h, (node_of(s) if len(s) else None, len(s), sketch(s))) for h, s in zip(first, sets, strict=True))
            node, n, bits = zip(*(known[h] for h in hashes), strict=True) if hashes else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(bits, pa.binary())], names=["id", "h", "node", "n", "sketch"])

    return texts.select("id", "text", "h").mapInArrow(run, f"id {kind}, h long, node long, n long, sketch binary")


def signature_rows(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(sig, node) of each set; a task sends a text that it has sent before no second time, as far as it remembers."""

    def run(batches):
        enum, sent = PartEnum(percent), WordCache(SENT)
        for batch in batches:
            for part in chunks(fresh(batch, sent)):
                sets = [s for s in shingler(words).sets(part) if len(s)]
                if sets:
                    sigs = [enum.signatures(s) for s in sets]
                    nodes = np.repeat(np.array([node_of(s) for s in sets], dtype=np.int64), [len(x) for x in sigs])
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(nodes)], names=["sig", "node"])

    return texts.select("text", "h").mapInArrow(run, "sig long, node long")


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """The rows of sorted batches (sig, node), some ten thousand at a time; True with the last."""
    held, n = [], 0
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        n += batch.num_rows
        if n >= ROWS:
            yield *map(np.concatenate, zip(*held, strict=True)), False
            held, n = [], 0
    yield *(map(np.concatenate, zip(*held, strict=True)) if held else (np.zeros(0, dtype=np.int64),) * 2), True


def ties_of(signatures: DataFrame) -> DataFrame:
    """(u, v, pair) of signatures (sig, node), whose rows stand sorted in their partitions.

    All pairs of the sets of a signature or, of more than SMALL sets, each set
    with the signature. What is held of a signature between two looks is no
    more than SMALL rows.
    """

    def run(batches):
        sig, node, large = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), False
        for more_sig, more_node, last in runs_of(batches):
            sig, node = np.concatenate([sig, more_sig]), np.concatenate([node, more_node])
            if not len(sig):
                continue
            new = np.append(True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1]))
            sig, node = sig[new], node[new]
            first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
            size = np.diff(np.append(first, len(sig)))
            is_large = size > SMALL
            is_large[0] |= large
            # the last signature may go on: it waits, a large one with its first set alone
            open_from = len(sig) if last or is_large[-1] else first[-1]
            own_large, own_first = np.repeat(is_large, size), np.repeat(first, size)
            place = np.arange(len(sig)) - own_first
            out = []
            for back in range(1, SMALL):
                k = np.flatnonzero((place >= back) & ~own_large)
                k = k[k < open_from]
                if not len(k):
                    break
                out.append((node[k], node[k - back], np.ones(len(k), dtype=bool)))
            # the first row of a signature that went on has been given out
            k = np.flatnonzero(own_large & (np.arange(len(sig)) >= large))
            out.append((node[k], sig[k], np.zeros(len(k), dtype=bool)))
            u, v, pair = map(np.concatenate, zip(*out, strict=True))
            if len(u):
                once = np.unique(np.column_stack([u, v, pair]), axis=0) if len(u) < ROWS else np.column_stack([u, v, pair])
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(once[:, 0])), pa.array(np.ascontiguousarray(once[:, 1])), pa.array(once[:, 2].astype(bool))], names=["u", "v", "pair"])
            large = bool(is_large[-1])
            keep = slice(first[-1], first[-1] + 1) if large else slice(first[-1], None)
            sig, node = sig[keep], node[keep]

    return signatures.mapInArrow(run, "u long, v long, pair boolean")


def rarest(large: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """The rows of large (node, sig) less each set's most frequent signatures, as many as its band has spare groups for; own: (node, n)."""

    def run(batches):
        enum, known = PartEnum(percent), {}
        for batch in batches:
            odd, n, place, of = (batch.column(k).to_numpy().astype(np.int64) for k in range(2, 6))
            kinds, which = np.unique(2 * n + odd, return_inverse=True)
            allowed = [known[k] if k in known else known.setdefault(k, enum.shared_allowed(k // 2, k % 2)) for k in kinds.tolist()]
            yield batch.select(["sig", "node"]).filter(pa.array(place <= of - np.array(allowed, dtype=np.int64)[which]))

    sets = large.groupBy("sig").agg(F.count(F.lit(1)).alias("sets"))
    rows = large.join(sets, "sig").withColumn("odd", F.col("sig").bitwiseAND(F.lit(1).cast("long")))
    band = Window.partitionBy("node", "odd")
    ranked = rows.withColumns({"place": F.row_number().over(band.orderBy("sets", "sig")).cast("long"), "of": F.count(F.lit(1)).over(band)})
    return ranked.join(own, "node").select("sig", "node", "odd", "n", "place", "of").mapInArrow(run, "sig long, node long")


def ties_by_sketch(rows: DataFrame, percent: int) -> DataFrame:
    """(u, v) ties of sets that share a signature; rows: (sig, node, n, sketch), signature by signature.

    The ties of up to MEDIUM sets join the groups that their sizes and
    sketches allow, without the pairs of a group; more sets than that are tied
    to the first, and no more than MEDIUM rows are held.
    """

    def of_group(held):
        node, n, bits = zip(*held, strict=True)
        n, sk = np.array(n, dtype=np.int64), folded(bits, min(map(len, bits)))
        few = max(1, sk.shape[1] // 4)
        # sets that nothing has reached yet, in order of size; each set that is reached looks among them once
        ahead, size, rest, reached = np.arange(len(n)), n, sk, []
        while len(ahead):
            if reached:
                a = reached.pop()
            else:
                a, ahead, size, rest = ahead[0], ahead[1:], size[1:], rest[1:]
            low, high = np.searchsorted(size, -(-percent * n[a] // 100)), np.searchsorted(size, 100 * n[a] // percent, side="right")
            most = (size[low:high] + n[a]) * (100 - percent) // (100 + percent)
            # a part of the bits bounds the distance from below as all of them do
            k = np.flatnonzero(np.bitwise_count(rest[low:high, :few] ^ sk[a, :few]).sum(1, dtype=np.int64) <= most)
            k = k[np.bitwise_count(rest[k + low] ^ sk[a]).sum(1, dtype=np.int64) <= most[k]] + low
            if len(k):
                reached += ahead[k].tolist()
                yield from ((node[b], node[a]) for b in ahead[k].tolist())
                left = np.ones(len(ahead), dtype=bool)
                left[k] = False
                ahead, size, rest = ahead[left], size[left], rest[left]

    def run(batches):
        key, held, large, room = None, [], False, HELD
        for batch in batches:
            out = []
            for sig, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sig != key:
                    out += of_group(held) if held else []
                    key, held, large, room = sig, [], False, HELD
                if large:
                    out.append((row[0], held[0][0]))
                    continue
                held.append(row)
                room -= len(row[2])
                if len(held) > MEDIUM or room < 0:
                    out += [(r[0], held[0][0]) for r in held[1:]]
                    held, large = held[:1], True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["u", "v"])
        if held and (out := list(of_group(held))):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["u", "v"])

    return rows.mapInArrow(run, "u long, v long")


def set_rows(texts: DataFrame, words: int, wanted: bytes) -> DataFrame:
    """(node, n, members) of the texts whose hashes the filter lets pass."""
    bits = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        there, sent = np.unpackbits(np.frombuffer(bits.value, dtype=np.uint8), bitorder="little").astype(bool), WordCache(SENT)
        for batch in batches:
            for part in chunks(fresh(batch, sent, there)):
                rows = [(node_of(s), len(s), s.tobytes()) for s in shingler(words).sets(part) if len(s)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["node", "n", "members"])

    return texts.select("text", "h").mapInArrow(run, "node long, n long, members binary")


def text_filter(hashes: DataFrame) -> bytes:
    """A bitmap of fixed size in which every h has its bit; others may share one."""
    spots = hashes.select(F.pmod("h", F.lit(FILTER_BITS)).alias("b")).select(F.expr("bitmap_bucket_number(b + 1) AS bucket"), F.expr("bitmap_bit_position(b + 1) AS at"))
    out = bytearray(FILTER_BITS // 8)
    for r in spots.groupBy("bucket").agg(F.expr("bitmap_construct_agg(at) AS bits")).collect():
        start = (r["bucket"] - 1) * len(r["bits"])
        out[start : start + len(r["bits"])] = r["bits"]
    return bytes(out)


def sketch(s: np.ndarray, bits: int = 0) -> bytes:
    """Bit b: whether an odd number of members falls on b; as many bits as members, rounded up to a power of two."""
    bits = bits or max(SKETCH, 1 << (len(s) - 1).bit_length() if len(s) else 0)
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches as rows of so many bytes; what falls on a bit of a shorter one falls on it or on its copies in a longer one."""
    short = (x if len(x) == size else np.bitwise_xor.reduce(np.frombuffer(x, dtype=np.uint64).reshape(-1, size // 8), axis=0).tobytes() for x in sketches)
    return np.frombuffer(b"".join(short), dtype=np.uint64).reshape(len(sketches), size // 8)


def near_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the pairs (u, v, n, m, a, b) whose sizes and sketches a link allows."""

    def run(batches):
        for batch in batches:
            n, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            a, b = (batch.column(k).to_pylist() for k in (4, 5))
            sizes, apart = np.array([min(len(x), len(y)) for x, y in zip(a, b, strict=True)], dtype=np.int64), np.zeros(len(n), dtype=np.int64)
            for size in np.unique(sizes).tolist():
                k = np.flatnonzero(sizes == size)
                apart[k] = np.bitwise_count(folded([a[x] for x in k], size) ^ folded([b[x] for x in k], size)).sum(1, dtype=np.int64)
            fine = pa.array((apart <= (n + m) * (100 - percent) // (100 + percent)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
            yield batch.select(["u", "v"]).filter(fine)

    return pairs.select("u", "v", "n", "m", "a", "b").mapInArrow(run, "u long, v long")


def links_in_cell(rows: list[tuple], across: bool, percent: int) -> list[tuple[int, int]]:
    """Links that join all groups of a cell's sets; across: only between its two blocks. rows: (node, block, n, members)."""
    rows = sorted(rows, key=lambda r: r[2])
    sets = [np.frombuffer(r[3], dtype=np.uint64) for r in rows]
    sizes, blocks, sk = np.array([r[2] for r in rows]), np.array([r[1] for r in rows]), folded([sketch(x, SKETCH) for x in sets], SKETCH // 8)
    root = np.arange(len(rows))
    out = []
    for a in range(len(rows) - 1):
        # partners are no smaller and, by the rule, not much larger
        end = int(np.searchsorted(sizes, sizes[a] * 100 // percent, side="right"))
        if end <= a + 1:
            continue
        most = (sizes[a + 1 : end] + sizes[a]) * (100 - percent) // (100 + percent)
        near = np.bitwise_count(sk[a + 1 : end] ^ sk[a]).sum(1) <= most
        if across:
            near &= blocks[a + 1 : end] != blocks[a]
        for b in (np.flatnonzero(near) + a + 1).tolist():
            if root[a] == root[b]:
                continue
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= percent * (sizes[a] + sizes[b] - both):
                root[root == root[b]] = root[a]
                out.append((rows[a][0], rows[b][0]))
    return out


def links(cells: DataFrame, percent: int) -> DataFrame:
    """(u, v) links of cells (root, i, j, node, block, n, members), whose rows stand together cell by cell."""

    def run(batches):
        key, held = None, []
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    out += links_in_cell(held, key[1] != key[2], percent) if len(held) > 1 else []
                    key, held = row[:3], []
                held.append(row[3:])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["u", "v"])
        if len(held) > 1 and (out := links_in_cell(held, key[1] != key[2], percent)):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["u", "v"])

    return cells.mapInArrow(run, "u long, v long")


def in_blocks(members: DataFrame) -> DataFrame:
    """members (node, root) with the block of each node and its component's number of blocks.

    Only components of several blocks are looked up, each SALTS times, so that
    a hot one's nodes meet it in as many tasks; these rows are no more than
    SALTS / BLOCK of the nodes.
    """
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    large = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).filter("blocks > 1").withColumn("salt", F.explode(salts))
    dealt = members.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS).cast("long")))
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    return dealt.join(large, ["root", "salt"], "left").select("node", "root", blocks.alias("blocks")).withColumn("block", F.pmod(F.xxhash64(F.lit(1), "node"), "blocks"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """id_col, n_shingles, component_id for every row of docs.

    component_id is the smallest identifier that links reach, the row's own
    included; links go by 100 * intersection >= percent * union of the sets of
    words-word shingles (a shorter text is one shingle). Null and empty texts
    have no shingles and no links. Repeated rows get the same group; a null
    identifier only heads a group that has no other. Words, shingles, sets
    and texts are told apart by 64-bit hashes.
    """
    python_ready(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    nodes = scratch.save(node_table(texts, words))

    signatures = signature_rows(texts, words, percent).repartition("sig").sortWithinPartitions("sig", "node")
    ties = scratch.save(ties_of(signatures).distinct())
    own = nodes.filter("node IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("a"))
    other = own.select(F.col("node").alias("v"), F.col("n").alias("m"), F.col("a").alias("b"))
    pairs = ties.filter("pair").join(own.withColumnRenamed("node", "u"), "u").join(other, "v")
    large = rarest(ties.filter("NOT pair").select(F.col("u").alias("node"), F.col("v").alias("sig")), own.select("node", "n"), percent)
    shared = large.join(own, "node").select("sig", "node", "n", "a").repartition("sig").sortWithinPartitions("sig", "n", "node")
    candidates = scratch.save(near_pairs(pairs, percent).unionByName(ties_by_sketch(shared, percent)).distinct())
    members = scratch.save(connected_components(candidates, scratch))

    placed = in_blocks(members)
    cells = (
        set_rows(texts, words, text_filter(nodes.join(members, "node", "left_semi")))
        .dropDuplicates(["node"])
        .join(placed, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block", "n", "members")
        .repartition("root", "i", "j")
        .sortWithinPartitions("root", "i", "j")
    )
    found = scratch.save(links(cells, percent))
    roots = scratch.save(connected_components(found, scratch))
    own = nodes.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"))
    grouped = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = grouped.join(heads, "root").select("node", "component_id")
    return nodes.join(by_node, "node", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, broadcast_rows: int = 2_000_000) -> DataFrame:
    """The rows of docs whose identifier heads its group of near duplicates.

    The identifiers that go are broadcast up to broadcast_rows of them (16 MB)
    and joined by a shuffle beyond that. Rows without identifier stay.
    """
    groups = near_duplicates(docs, id_col, text_col, words, percent)
    gone = Scratch(docs.sparkSession).save(groups.filter(F.col("component_id") != F.col(id_col)).select(id_col).distinct())
    return docs.join(F.broadcast(gone) if gone.count() <= broadcast_rows else gone, id_col, "left_anti").select(*docs.columns)


def op8(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(without(table(spark, sf_dir, "documents"), "lang", "source", "n_chars"))
