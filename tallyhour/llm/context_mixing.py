"""LM scoring by logistic context mixing over the bits of a text.

A text becomes the bytes of its tokens (words with A-Z lower-cased, each followed by a
blank, then one end byte). Every byte is coded as eight binary decisions. Several
predictors look up a decision's zeros and ones, one per context: the last 1 to 5
bytes, and the word so far. Their log odds are combined by weights that
two gates select (decision and longest known context; how often that was seen), and an
adaptive table refines the result. The sum over a text's decisions is its score.

A decision depends on six bytes, its *window*, so everything is counted, learned and
scored over distinct windows with their counts in training texts. The word so far is
cut to the window: of longer words it is the last five bytes. Texts are cut to blocks of
whole documents; a block's distinct windows are dealt to buckets by the last three bytes
before the window's own (a line end there counts as a blank). All windows that share a
context of three bytes or more, or a word of two or more, meet in one bucket, where
counts are exact sums over sorted windows, without slots or a fixed capacity. Shorter
contexts are counted in one table that is broadcast, whose size has a bound in the
alphabet (256**3 rows), not in the corpus. Weights are learned online, one
small step after another over each partition's windows, and averaged over the
partitions by weight, round by round; the refinement table is counted after that. While
learning, a window's own occurrence is taken out of the counts first, as if it were
predicted before it was seen. The costs of a bucket's windows (single precision) return
to the blocks, which add them up over their documents' bytes.

The base score needs the exact training count of every token. A block's distinct tokens go to
buckets of their hash, compressed, and their counts return to the block in the same order, so that
tokens, not their occurrences, are shuffled, and only once.

Defined results: null and empty texts are the end token alone; repeated rows are
scored each, and all learn if they are in the training part; null doc_ids are neither held out
nor learned from; an empty training part gives the base score zero counts (N = V = 0:
log10(0.5 / 0.5) = 0 for every token) and even odds to every bit.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, scratch, ship, slices

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END = b"\n"
_PAD = END * 5
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MULT2 = np.uint64(0xD6E8FEB86659FD93)
#: Slots of each context (log2) in a model that holds hashed tables; ``score`` uses exact counts instead.
#: Contexts: the last 1, 2, 3, 4, 5 bytes, the word so far.
SLOT_BITS = (14, 18, 20, 21, 22, 22)
_BASE = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS])]).astype(np.int64)
PRIOR = 0.3
RATES = (0.05, 0.05, 0.03, 0.02)
STEP = 4096
BUCKETS = 24
REFINED = 0.5
BLOCK_TOKENS = 1_000_000
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words; the end token is not among them."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def stream(words: list[bytes]) -> bytes:
    return b" ".join(words) + b" \n" if words else END


def windows(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(window of every byte, end of each stream): five bytes before and the byte, the newest lowest."""
    b = np.frombuffer(b"".join([_PAD + s for s in streams]), np.uint8)
    v = b.astype(np.uint64)
    w = v[5:].copy()
    for k in range(1, 6):
        w |= v[5 - k:-k] << np.uint64(8 * k)
    sizes = np.array([len(s) for s in streams], np.int64)
    begin = np.cumsum(sizes + 5) - sizes - 5
    keep = np.ones(len(w), bool)
    for k in range(5):  # what comes before a stream is no part of it
        at = begin[1:] - 5 + k
        keep[at] = False
    return w[keep], np.cumsum(sizes)


def pasts(w: np.ndarray) -> list[np.ndarray]:
    """Contexts of windows: the last 1 to 5 bytes; the word so far, led by its length."""
    past = w >> np.uint64(8)
    out = [past & np.uint64((1 << 8 * k) - 1) for k in range(1, 6)]
    word, inside, size = np.zeros(len(w), np.uint64), np.ones(len(w), bool), np.zeros(len(w), np.uint64)
    for k in range(5):
        c = (past >> np.uint64(8 * k)) & np.uint64(255)
        inside &= (c != 32) & (c != 10)
        word = np.where(inside, word | c << np.uint64(8 * k), word)
        size += inside
    out.append(word | size << np.uint64(40))
    return out


def contexts(w: np.ndarray) -> list[np.ndarray]:
    """Hashed contexts of windows, one array per table."""
    mixed = []
    for i, c in enumerate(pasts(w)):
        h = (c + np.uint64(i + 1)) * _MULT
        mixed.append((h ^ (h >> np.uint64(31))) * _MULT2)
    return mixed


def slots(mixed: list[np.ndarray], node: np.ndarray) -> list[np.ndarray]:
    """Slot of every table at the node (the byte's bits so far, led by 1)."""
    step = node * np.uint64(0xA0761D6478BD642F)
    return [((h + step) * _MULT >> np.uint64(64 - b)).astype(np.int64) + base
            for h, b, base in zip(mixed, SLOT_BITS, _BASE)]


def decisions(w: np.ndarray):
    """(nodes, bits) of each of a byte's eight decisions."""
    byte = w & np.uint64(255)
    for b in range(7, -1, -1):
        yield (np.uint64(256) | byte) >> np.uint64(b + 1), ((byte >> np.uint64(b)) & np.uint64(1)).astype(np.float64)


def places(w: np.ndarray) -> np.ndarray:
    """Hash of the three bytes before the windows' own, whose upper bits are the bucket."""
    p = (w >> np.uint64(8)) & np.uint64(0xFFFFFF)
    p = np.where(p >> np.uint64(16) == 10, p & np.uint64(0xFFFF) | np.uint64(32 << 16), p)
    h = (p + np.uint64(1)) * _MULT
    return (h ^ (h >> np.uint64(29))) * _MULT2


def totals(key: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(9, keys): for a context and byte, how often the byte's first 0 to 8 bits follow the context."""
    out = np.zeros((9, len(key)))
    if not len(key):
        return out
    order = np.argsort(key)
    key, n = key[order], n[order].astype(np.float64)
    for level in range(9):
        g = key >> np.uint64(8 - level)
        cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        out[level, order] = np.repeat(np.add.reduceat(n, cut), np.diff(np.append(cut, len(g))))
    return out


_KIND = np.uint64(56)


def short_keys(past: list[np.ndarray], byte: np.ndarray):
    """(predictor, rows, keys) of the contexts whose number has a bound: one or two bytes, words of at most one."""
    every = np.ones(len(byte), bool)
    for kind, (i, rows) in enumerate(((0, every), (1, every), (5, past[5] >> np.uint64(40) <= 1))):
        yield i, rows, np.uint64(kind) << _KIND | past[i][rows] << np.uint64(8) | byte[rows]


class Short:
    """The counts of all short contexts."""

    def __init__(self, key: np.ndarray, n: np.ndarray):
        order = np.argsort(key)
        self.key, self.totals = key[order], totals(key[order], n[order])

    def counts(self, w: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(predictors, 9, windows): ``totals`` of every context of windows that come as whole buckets."""
        past, byte = pasts(w), w & np.uint64(255)
        out = np.empty((len(past), 9, len(w)))
        for i in (2, 3, 4, 5):
            out[i] = totals(past[i] << np.uint64(8) | byte, n)
        for i, rows, key in short_keys(past, byte):
            out[i][:, rows] = self.totals[:, np.searchsorted(self.key, key)]
        return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Mixer:
    """Counts of zeros and ones by slot, gated weights, refinement table (log odds)."""

    n0: np.ndarray | None
    n1: np.ndarray | None
    by_known: np.ndarray
    by_count: np.ndarray
    refine: np.ndarray

    @staticmethod
    def fresh(n0: np.ndarray | None, n1: np.ndarray | None) -> "Mixer":
        k = len(SLOT_BITS)
        return Mixer(n0, n1, np.full((8 * (k + 1), k), 0.3), np.zeros((17, k)), np.zeros((256 * (k + 1), BUCKETS)))

    def look(self, w: np.ndarray, counts: np.ndarray | None = None):
        """Function of (node, bit, level) to (zeros, ones) by predictor, from exact counts or from the tables."""
        if counts is None:
            mixed = contexts(w)
            return lambda node, bit, level: [(self.n0[s].astype(np.float64), self.n1[s].astype(np.float64))
                                             for s in slots(mixed, node)]

        def exact(node, bit, level):
            one = bit > 0
            own, other = counts[:, level + 1], counts[:, level] - counts[:, level + 1]
            return [(np.where(one, o, s), np.where(one, s, o)) for s, o in zip(own, other)]

        return exact

    @staticmethod
    def inputs(pairs, level: int, bit=None):
        """(log odds by predictor, gate of known contexts, gate of counts); ``bit``: take this occurrence out."""
        k, size = len(pairs), len(pairs[0][0])
        x, known, seen = np.empty((size, k)), np.zeros(size, np.int64), np.zeros(size)
        for i, (a, b) in enumerate(pairs):
            if bit is not None:
                a, b = np.maximum(a - (1 - bit), 0), np.maximum(b - bit, 0)
            x[:, i] = np.log((b + PRIOR) / (a + PRIOR))
            if i < 5:
                n = a + b
                some = n > 0.5
                known[some] = i + 1
                seen = np.where(some, n, seen)
        return x, known * 8 + level, np.minimum(np.log2(seen + 1), 16).astype(np.int64), known

    def mix(self, x, g1, g2):
        return ((self.by_known[g1] + self.by_count[g2]) * x).sum(1)

    @staticmethod
    def bucket(z):
        return np.clip(np.rint(z * 1.5 + BUCKETS / 2), 0, BUCKETS - 1).astype(np.int64)

    def costs(self, w: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of the byte of each window."""
        out, look = np.zeros(len(w)), self.look(w, counts)
        for level, (node, bit) in enumerate(decisions(w)):
            x, g1, g2, known = self.inputs(look(node, bit, level), level)
            z = self.mix(x, g1, g2)
            r = self.refine[known * 256 + node.astype(np.int64), self.bucket(z)]
            p = (1 - REFINED) * _sigmoid(z) + REFINED * _sigmoid(z + r)
            out += np.log10(np.where(bit > 0, p, 1 - p))
        return out

    def learn(self, w: np.ndarray, n: np.ndarray, counts: np.ndarray, rate: float) -> None:
        """Online steps over windows ``w`` that occur ``n`` times."""
        k = len(SLOT_BITS)
        for s in range(0, len(w), STEP):
            part, weight = w[s:s + STEP], n[s:s + STEP].astype(np.float64)
            weight = weight / weight.sum() * len(part)
            look = self.look(part, counts[:, :, s:s + STEP])
            for level, (node, bit) in enumerate(decisions(part)):
                x, g1, g2, _ = self.inputs(look(node, bit, level), level, bit)
                err = (bit - _sigmoid(self.mix(x, g1, g2))) * weight
                for g, table in ((g1, self.by_known), (g2, self.by_count)):
                    size = np.bincount(g, weight, len(table)) + 1
                    for i in range(k):
                        table[:, i] += rate * np.bincount(g, err * x[:, i], len(table)) / size

    def refinement(self, w: np.ndarray, n: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ones, all, expected ones) by cell of the refinement table."""
        size = self.refine.size
        ones, every, hoped = np.zeros(size), np.zeros(size), np.zeros(size)
        look = self.look(w, counts)
        for level, (node, bit) in enumerate(decisions(w)):
            x, g1, g2, known = self.inputs(look(node, bit, level), level, bit)
            z = self.mix(x, g1, g2)
            cell = (known * 256 + node.astype(np.int64)) * BUCKETS + self.bucket(z)
            ones += np.bincount(cell, n * bit, size)
            every += np.bincount(cell, n, size)
            hoped += np.bincount(cell, n * _sigmoid(z), size)
        return ones, every, hoped


def _distinct(w: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if n is None:
        w = np.sort(w)
        cut = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.zeros(0, np.int64)
        return w[cut], np.diff(np.append(cut, len(w)))
    order = np.argsort(w)
    w, n = w[order], n[order]
    cut = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.zeros(0, np.int64)
    return w[cut], np.add.reduceat(n, cut) if len(cut) else n


#: Least number of buckets (log2), windows of blocks for which another one is made, and windows
#: of another task.
BUCKET_BITS = 11
BUCKET_WINDOWS = 1 << 20
TASK_WINDOWS = 1_000_000


def _pack(values: np.ndarray | bytes) -> bytes:
    """Compressed bytes, of numbers the first bytes of all before the second: what is staged and shuffled by block is large."""
    raw = values if isinstance(values, bytes) else values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + (pa.Codec("zstd").compress(raw, asbytes=True) if raw else b"")


def _unpack(packed, kind=None):
    """The bytes of ``_pack``, or the numbers of type ``kind``."""
    packed = memoryview(packed)
    size = int.from_bytes(packed[:8], "little")
    raw = pa.Codec("zstd").decompress(packed[8:], size, asbytes=True) if size else b""
    if kind is None:
        return raw
    item = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(item, -1).T).reshape(-1).view(kind)


def _pack_windows(w: np.ndarray, n: np.ndarray) -> bytes:
    return _pack(np.concatenate([w.view(np.uint8).reshape(-1, 8)[:, :6], n.view(np.uint8).reshape(-1, 4)], 1).T.tobytes())


def _unpack_windows(packed) -> tuple[np.ndarray, np.ndarray]:
    b = np.frombuffer(_unpack(packed), np.uint8).reshape(10, -1).T
    w = np.zeros((len(b), 8), np.uint8)
    w[:, :6] = b[:, :6]
    return w.reshape(-1).view(np.uint64), np.ascontiguousarray(b[:, 6:]).reshape(-1).view(np.uint32)


def _zstd(df: DataFrame, name: str) -> DataFrame:
    """``stage`` with smaller files."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary rows of ``values`` up to each of ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32) * np.int32(values.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _of(array: pa.Array, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in array]


def gather_windows(blocks: DataFrame) -> DataFrame:
    """A row per bucket: its distinct windows with training counts, and by block the places of the block's windows."""
    found = blocks.agg(F.coalesce(F.sum("n_windows"), F.lit(0))).first()[0]
    bits = max(BUCKET_BITS, (found // BUCKET_WINDOWS).bit_length())

    def deal(batches):
        for batch in batches:
            for r, block in enumerate(batch.column(0).to_pylist()):
                w, n = (_unpack(batch.column(c)[r].as_buffer(), kind) for c, kind in ((1, np.uint64), (2, np.uint32)))
                bucket = (places(w) >> np.uint64(64 - bits)).astype(np.int32)
                cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                ends = np.append(cut[1:], len(w))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cut]), pa.array(np.full(len(cut), block)),
                                                  pa.array([_pack_windows(w[b:e], n[b:e]) for b, e in zip(cut, ends)], pa.binary())],
                                                 names=["bucket", "block", "windows"])

    def merge(batches):
        bucket, held = None, []

        def emit():
            w = np.concatenate([h[1] for h in held])
            u, at = np.unique(w, return_inverse=True)
            order = np.argsort(places(u), kind="stable")  # the order in the blocks: their places ascend
            rank = np.empty(len(u), np.uint32)
            rank[order] = np.arange(len(u), dtype=np.uint32)
            u, at = u[order], rank[at]
            n = np.bincount(at, np.concatenate([h[2] for h in held]), len(u)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([len(u)], pa.int64()), pa.array([u.tobytes()], pa.binary()),
                 pa.array([n.tobytes()], pa.binary()), pa.array([np.array([h[0] for h in held], np.int64).tobytes()], pa.binary()),
                 pa.array([np.array([len(h[1]) for h in held], np.int64).tobytes()], pa.binary()),
                 pa.array([_pack(np.diff(at, prepend=np.uint32(0)))], pa.binary())], names=["bucket", "m", "windows", "n", "blocks", "sizes", "places"])

        for batch in batches:
            for k, block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if held and k != bucket:
                    yield emit()
                    held = []
                bucket = k
                held.append((block, *_unpack_windows(packed.as_buffer())))
        if held:
            yield emit()

    dealt = (blocks.select("block", "windows", "window_n").mapInArrow(deal, "bucket int, block long, windows binary")
             .repartition("bucket").sortWithinPartitions("bucket", "block"))
    return _zstd(dealt.mapInArrow(merge, "bucket int, m long, windows binary, n binary, blocks binary, sizes binary, places binary"),
                 "mixing-windows")


def _whole(batches, rows: int = 1 << 16):
    """(windows, counts, rows) of whole buckets, about ``rows`` windows at a time; columns: windows, n, others."""
    held, size = [], 0

    def joined():
        return np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), [h[2] for h in held]

    for batch in batches:
        for r, (w, n) in enumerate(zip(_of(batch.column(0), np.uint64), _of(batch.column(1), np.int64))):
            held.append((w, n, batch.slice(r, 1)))
            size += len(w)
            if size >= rows:
                yield joined()
                held, size = [], 0
    if size:
        yield joined()


def count_short(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(keys, training counts) of all short contexts with a byte; at most 256**3 and a few."""

    def run(batches):
        held, size = [], 0

        def emit():
            k, n = _distinct(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], names=["key", "n"])

        for w, n, _ in _whole(batches):
            for _, rows, key in short_keys(pasts(w), w & np.uint64(255)):
                held.append(_distinct(key, n[rows]))
                size += len(held[-1][0])
            if size > 1_000_000:
                yield emit()
                held, size = [], 0
        if held:
            yield emit()

    got = counted.select("windows", "n").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    return got["key"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64)


def fit(gathered: DataFrame) -> tuple[Mixer, Broadcast]:
    """Weights and refinement, and the broadcast counts of short contexts, from the windows of ``gather_windows``."""
    spark = gathered.sparkSession
    found = gathered.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    counted = gathered.select("windows", "n").coalesce(max(4, found // TASK_WINDOWS))
    tables = spark.sparkContext.broadcast(count_short(counted))
    model = Mixer.fresh(None, None)

    def learned(batches):
        """(windows, n, counts) of windows in training texts."""
        short = Short(*tables.value)
        for w, n, _ in _whole(batches):
            counts, some = short.counts(w, n), np.flatnonzero(n)
            if len(some):
                order = some[np.argsort((w[some] * _MULT) >> np.uint64(20))]  # sorted windows would be learned context by context
                yield w[order], n[order], counts[:, :, order]

    # weights: every partition learns on from the same weights; the average by windows goes on
    for rate in RATES:
        start = (model.by_known, model.by_count, model.refine)

        def learn(batches, start=start, rate=rate):
            m, seen = Mixer(None, None, start[0].copy(), start[1].copy(), start[2]), 0
            for w, n, counts in learned(batches):
                m.learn(w, n, counts, rate)
                seen += len(w)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([m.by_known.tobytes()], pa.binary()),
                                                  pa.array([m.by_count.tobytes()], pa.binary())], names=["n", "a", "b"])

        got = counted.mapInArrow(learn, "n double, a binary, b binary").orderBy("n", "a")
        total, a, b = 0.0, np.zeros_like(model.by_known), np.zeros_like(model.by_count)
        for r in got.toLocalIterator():  # a few kB per partition
            total += r["n"]
            a += r["n"] * np.frombuffer(bytes(r["a"])).reshape(a.shape)
            b += r["n"] * np.frombuffer(bytes(r["b"])).reshape(b.shape)
        if total:
            model.by_known, model.by_count = a / total, b / total

    weights = (model.by_known, model.by_count, model.refine)

    def refine(batches):
        m = Mixer(None, None, *weights)
        total = None
        for w, n, counts in learned(batches):
            got = m.refinement(w, n, counts)
            total = got if total is None else tuple(t + g for t, g in zip(total, got))
        if total is not None:
            at = np.flatnonzero(total[1])
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(t[at]) for t in total)], names=["cell", "ones", "every", "hoped"])

    cells = (counted.mapInArrow(refine, "cell long, ones double, every double, hoped double").groupBy("cell")
             .agg(F.sum("ones").alias("ones"), F.sum("every").alias("every"), F.sum("hoped").alias("hoped")).toPandas())
    flat = model.refine.reshape(-1)
    odds = lambda k: np.log((k + 2) / (cells["every"].to_numpy(np.float64) - k + 2))
    flat[cells["cell"].to_numpy(np.int64)] = odds(cells["ones"].to_numpy(np.float64)) - odds(cells["hoped"].to_numpy(np.float64))
    return model, tables


def window_costs(gathered: DataFrame, model: Mixer, tables: Broadcast) -> DataFrame:
    """(block, bucket, costs of the block's windows there, in its order)."""
    weights = (model.by_known, model.by_count, model.refine)

    def run(batches):
        short, m = Short(*tables.value), Mixer(None, None, *weights)
        for w, n, rows in _whole(batches):
            counts = short.counts(w, n)
            cost = np.concatenate([m.costs(w[s:s + (1 << 15)], counts[:, :, s:s + (1 << 15)]) for s in range(0, len(w), 1 << 15)])
            begin = 0
            for row in rows:
                size, at = len(row.column(0)[0].as_buffer()) // 8, np.cumsum(_unpack(row.column(5)[0].as_buffer(), np.uint32), dtype=np.uint32)
                own, ends = cost[begin:begin + size].astype(np.float32), np.cumsum(_of(row.column(4), np.int64)[0])
                begin += size
                blocks = _of(row.column(3), np.int64)[0]
                yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(np.full(len(blocks), row.column(2)[0].as_py(), np.int32)),
                                                  _cut(own[at], ends)], names=["block", "bucket", "costs"])

    return (gathered.select("windows", "n", "bucket", "blocks", "sizes", "places")
            .mapInArrow(run, "block long, bucket int, costs binary"))


class Known:
    """Costs of a block's windows."""

    def __init__(self, w: np.ndarray, cost: np.ndarray):
        order = np.argsort(w)
        self.w, self.cost = w[order], cost[order].astype(np.float64)

    def costs(self, w: np.ndarray) -> np.ndarray:
        return self.cost[np.searchsorted(self.w, w)]


class Scorer:
    """Scores streams, remembering the cost of windows met before in a table of fixed size."""

    SIZE = 21

    def __init__(self, model: Mixer | Known):
        self.model = model
        self.keys = np.full(1 << self.SIZE, -1, np.int64)
        self.cost = np.zeros(1 << self.SIZE)

    def score(self, streams: list[bytes]) -> np.ndarray:
        w, ends = windows(streams)
        at = ((w * _MULT) >> np.uint64(64 - self.SIZE)).astype(np.int64)
        cost = self.cost[at]
        miss = np.flatnonzero(self.keys[at] != w.view(np.int64))
        if len(miss):
            u, inv = np.unique(w[miss], return_inverse=True)
            new = np.concatenate([self.model.costs(u[s:s + (1 << 15)]) for s in range(0, len(u), 1 << 15)])
            cost[miss] = new[inv]
            place = ((u * _MULT) >> np.uint64(64 - self.SIZE)).astype(np.int64)
            self.keys[place], self.cost[place] = u.view(np.int64), new  # the last of equal places stays, key and cost alike
        return np.add.reduceat(cost, np.concatenate([[0], ends[:-1]])) if len(ends) else np.zeros(0)


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks of whole documents: ids, folds, bytes and their number, each one's distinct tokens with their numbers, and the
    block's distinct windows, by place, with how often they occur in training texts."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        state = {}

        def clear():
            state.update(ids=[], held=[], text=[], windows=[], size=[], n=[], which=[], many=[], count=[], total=0)
            state["vocab"] = {END: 0}

        def emit(id_type):
            s = state
            vocab = list(s["vocab"])
            by_hash = np.argsort(np.array([crc32(t) for t in vocab], np.uint32), kind="stable")
            number = np.empty(len(vocab), np.int64)
            number[by_hash] = np.arange(len(vocab))
            w, n = _distinct(np.concatenate([x[0] for x in s["windows"]]), np.concatenate([x[1] for x in s["windows"]]))
            order = np.argsort(places(w), kind="stable")
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(s["ids"])], pa.int32()), pa.array(s["ids"], id_type)),
                 pa.array([np.array(s["held"], np.int8).tobytes()], pa.binary()),
                 pa.array([_pack(b"".join(s["text"]))], pa.binary()),
                 pa.array([len(w)], pa.int64()), pa.array([_pack(w[order])], pa.binary()),
                 pa.array([_pack(n[order].astype(np.uint32))], pa.binary()),
                 pa.array([np.array(s["size"], np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(s["n"], np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(s["count"], np.int64).tobytes()], pa.binary()),
                 pa.array([_pack(number[np.concatenate(s["which"])].astype(np.uint32))], pa.binary()),
                 pa.array([_pack(np.concatenate(s["many"]).astype(np.uint32))], pa.binary()),
                 pa.array([_pack(_join_vocab([vocab[i] for i in by_hash.tolist()]))], pa.binary()),
                 pa.array([len(vocab)], pa.int64())],
                names=["doc_ids", "held", "text", "n_windows", "windows", "window_n", "size", "n", "count", "which", "many", "vocab", "n_vocab"])

        clear()
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                texts = [tokens(t) for t in part.column(2).to_pylist()]
                streams = [stream(t) for t in texts]
                state["text"] += streams
                held = part.column(1).to_pylist()
                for learns in (True, False):
                    some = [x for x, h in zip(streams, held) if (h == 1) == learns]
                    if some:
                        w, n = _distinct(windows(some)[0])
                        state["windows"].append((w, n if learns else np.zeros(len(w), np.int64)))
                state["size"] += [len(x) for x in streams]
                state["ids"] += part.column(0).to_pylist()
                state["held"] += held
                vocab = state["vocab"]
                for t in texts:
                    number = np.array([vocab.setdefault(x, len(vocab)) for x in t] + [0], np.int64)
                    u, c = np.unique(number, return_counts=True)
                    state["n"].append(len(number))
                    state["count"].append(len(u))
                    state["which"].append(u)
                    state["many"].append(c)
                    state["total"] += len(number)
                if state["total"] > BLOCK_TOKENS or sum(state["size"]) > BLOCK_BYTES:
                    yield emit(part.column(0).type)
                    clear()
        if state["ids"]:
            yield emit(batch.column(0).type)

    rows = docs.select("doc_id", F.coalesce((fold("doc_id", 5) != 1).cast("int"), F.lit(-1)).cast("byte").alias("held"), "text")
    schema = (f"doc_ids array<{kind}>, held binary, text binary, n_windows long, windows binary, window_n binary, size binary, n binary, count binary, which binary, "
              "many binary, vocab binary, n_vocab long")
    path = scratch(spark, "mixing-blocks")
    rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema + ", block long").parquet(path)


def score_text(text: bytes, size: np.ndarray, scorer: Scorer) -> np.ndarray:
    """Scores of the streams of ``size`` bytes that make up ``text``, some of them at a time."""
    out, ends, begin = [], np.cumsum(size), 0
    while begin < len(size):
        at = ends[begin] - size[begin]
        end = max(begin + 1, int(np.searchsorted(ends, at + SLICE_BYTES)))
        out.append(scorer.score([text[e - n:e] for e, n in zip(ends[begin:end].tolist(), size[begin:end].tolist())]))
        begin = end
    return np.concatenate(out)


def _join_vocab(tokens: list[bytes]) -> bytes:
    return b"\x00".join([x.replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01") for x in tokens])


def _unpack_vocab(v: bytes) -> list[bytes]:
    return [x.replace(b"\x01\x01", b"\x00").replace(b"\x01\x02", b"\x01") for x in v.split(b"\x00")]


#: Least number of token buckets (log2), and distinct tokens of blocks for which another one is made.
TOKEN_BITS = 8
BUCKET_TOKENS = 1 << 20


def count_tokens(blocks: DataFrame) -> DataFrame:
    """A row per bucket and block: the exact training counts of the block's tokens there, in its order; a bucket's first row
    holds the sum and the number of all its counted tokens.

    A block's tokens are numbered by their hash, so that a bucket's are a run of them. They travel as one
    compressed row for each bucket, and only their counts travel back.
    """
    found = blocks.agg(F.coalesce(F.sum("n_vocab"), F.lit(0))).first()[0]
    bits = max(TOKEN_BITS, (found // BUCKET_TOKENS).bit_length())

    def deal(batches):
        for batch in batches:
            for x in batch.to_pylist():
                vocab = _unpack_vocab(_unpack(x["vocab"]))
                learns = np.repeat(np.frombuffer(x["held"], np.int8) == 1, np.frombuffer(x["count"], np.int64))
                n = np.bincount(_unpack(x["which"], np.uint32)[learns], _unpack(x["many"], np.uint32)[learns], len(vocab)).astype(np.uint32)
                bucket = np.array([crc32(t) for t in vocab], np.int64) >> (32 - bits)
                cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                ends = np.append(cut[1:], len(vocab))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cut]), pa.array(np.full(len(cut), x["block"])),
                     pa.array([_pack(_join_vocab(vocab[b:e])) for b, e in zip(cut.tolist(), ends.tolist())], pa.binary()),
                     pa.array([_pack(n[b:e]) for b, e in zip(cut.tolist(), ends.tolist())], pa.binary())],
                    names=["bucket", "block", "tokens", "n"])

    def merge(batches):
        bucket, held = None, []

        def emit():
            numbers: dict[bytes, int] = {}
            rows = [(block, np.array([numbers.setdefault(t, len(numbers)) for t in _unpack_vocab(_unpack(v))], np.int64), n) for block, v, n in held]
            c = np.zeros(len(numbers), np.int64)
            for _, at, n in rows:
                c[at] += _unpack(n, np.uint32)
            k = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket] * k, pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([_pack(c[r[1]]) for r in rows], pa.binary()),
                 pa.array([int(c.sum())] + [0] * (k - 1), pa.int64()), pa.array([int((c > 0).sum())] + [0] * (k - 1), pa.int64())],
                names=["bucket", "block", "counts", "total", "distinct"])

        for batch in batches:
            for k, block, tokens, n in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if held and k != bucket:
                    yield emit()
                    held = []
                bucket = k
                held.append((block, tokens, n))
        if held:
            yield emit()

    dealt = (blocks.select("block", "held", "count", "which", "many", "vocab").mapInArrow(deal, "bucket long, block long, tokens binary, n binary")
             .repartition("bucket").sortWithinPartitions("bucket", "block"))
    return _zstd(dealt.mapInArrow(merge, "bucket long, block long, counts binary, total long, distinct long"), "mixing-counts")


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every row.

    Rows with crc32(doc_id) mod 5 of 1 are held out; all others with a doc_id are learned from.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = _blocks(docs)
    gathered_windows = gather_windows(blocks)
    priced = (window_costs(gathered_windows, *fit(gathered_windows)).groupBy("block")
              .agg(F.sort_array(F.collect_list(F.struct("bucket", "costs"))).alias("priced"))
              .select("block", F.col("priced.costs").alias("costs")))

    counted = count_tokens(blocks)
    total, distinct = counted.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    gathered = (counted.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "counts"))).alias("known"))
                .select("block", F.col("known.counts").alias("counts")))

    def per_document(batches):
        for batch in batches:
            kinds = batch.schema.field("doc_ids").type.value_type
            for r, x in enumerate(batch.select([n for n in batch.schema.names if n not in ("counts", "costs")]).to_pylist()):
                ids = pa.array(x["doc_ids"], kinds)
                count = np.frombuffer(x["count"], np.int64)
                which, many = _unpack(x["which"], np.uint32).astype(np.int64), _unpack(x["many"], np.uint32).astype(np.int64)
                c = np.concatenate([_unpack(v.as_buffer(), np.int64) for v in batch.column("counts")[r].values]).astype(np.float64)
                logs = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
                at = np.cumsum(count) - count
                held, size = np.frombuffer(x["held"], np.int8), np.frombuffer(x["size"], np.int64)
                cost = np.concatenate(_of(batch.column("costs")[r].values, np.float32))
                s = score_text(_unpack(x["text"]), size, Scorer(Known(_unpack(x["windows"], np.uint64), cost)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(held == 0), pa.array(np.frombuffer(x["n"], np.int64)),
                     pa.array(np.add.reduceat(many * (c[which] > 0), at)), pa.array(np.full(len(count), total, np.int64)),
                     pa.array(np.add.reduceat(many * logs[which], at)), pa.array(s),
                     pa.array(-s / np.log10(2) / size)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    rows = blocks.drop("vocab", "n_vocab", "window_n", "n_windows").join(gathered, "block", "left").join(priced, "block", "left")
    return rows.mapInArrow(per_document, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                         "base_score double, score double, bits_per_byte double")
