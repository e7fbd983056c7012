"""SimHash near-duplicates by anchor-point covering.

64-bit fingerprints are cut into three blocks with a perfect covering code each:
Golay [23,12] (radius 3) on bits 0-22 and 23-45, Hamming [15,11] (radius 1) on
bits 46-60; bits 61-63 stay outside. Two fingerprints within four bits differ, in
at least one of the block pairs (A,B), (B,C), (C,A), by at most one bit in each
block, or by none in the first and two in the second. So for every block pair a
fingerprint is dealt to all anchors (pairs of codewords) within the covering
radius plus that threshold; its nearest anchor is its home. Any linked pair
meets at the home anchor of either one, where exact distances are compared.

Copies are first folded into distinct fingerprints. Before the shuffle, members
of anchors that are nobody's home are left out by a bitmap of home anchors of
fixed size (3 * 2**24 bits). Anchors that are home to very many fingerprints
are salted: homes are split, the others repeated for each part. Links inside a
batch of anchors are contracted to stars, so that a dense group of n near copies
yields about n links, not n**2. Components come from alternating large-star and
small-star rounds, each written in the shared folder.

Defined results: null, empty or blank texts have fingerprint zero and are linked
like others; fewer than ``k`` words make one shingle; rows with equal doc_id are
separate rows, each with the component of its own fingerprint; null doc_ids get the
component of their fingerprint, and a component of null doc_ids only has a null id.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, ship, slices, split_by_keys, stage, strings, text_key, without, words_of

SEED = 42
BITS = 4
SLICE_BYTES = 4 << 20
#: (first bit, length, generator polynomial, covering radius, parity bits) of each block. Fixed values.
BLOCKS = ((0, 23, 0xC75, 3, 11), (23, 23, 0xC75, 3, 11), (46, 15, 0x13, 1, 4))
PAIRS = ((0, 1), (1, 2), (2, 0))
ANCHOR_BITS = 24
#: Anchors that are home to more fingerprints than this, and than 3N / MOST_SALTED, are salted.
HOME_LIMIT = 2000
MOST_SALTED = 50_000
#: Rows of dealt anchors held, and pairs compared, at a time.
CHUNK = 100_000
PAIRS_AT_ONCE = 1 << 18


def fingerprint(text: str, k: int = 4) -> int:
    """Majority bits of XXH64 over all ``k``-word shingles, repeats included."""
    words = words_of(lower_ascii(text))
    if not words:
        return 0
    joined = " ".join(words).encode("utf-8", "surrogatepass")
    sizes = [len(w) for w in words] if len(joined) == len(words) - 1 + sum(map(len, words)) else \
        [len(w.encode("utf-8", "surrogatepass")) for w in words]
    end = np.cumsum(np.array(sizes, np.int64) + 1) - 1
    begin = end - sizes
    if len(words) > k:
        begin, end = begin[:len(words) - k + 1], end[k - 1:]
    else:
        begin, end = begin[:1], end[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, len(begin), 65536):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(begin[i:i + 65536].tolist(), end[i:i + 65536].tolist())],
                     np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(begin)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = 4) -> DataFrame:
    """doc_id, h (hash of the text) and the fingerprint as a signed long, of every row."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                fp = np.array([fingerprint(t, k) for t in strings(part.column(2))], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp.view(np.int64))],
                                                 names=["doc_id", "h", "fp"])

    return docs.select("doc_id", text_key().alias("h"), "text").mapInArrow(run, f"doc_id {kind}, h long, fp long")


class _Code:
    """A cyclic perfect code: for every syndrome the error patterns of weight up to radius + 2."""

    def __init__(self, first: int, n: int, poly: int, radius: int, parity: int):
        self.first, self.n, self.parity = first, n, parity
        power = []
        for i in range(n):
            r = 1 << i
            for j in range(i, parity - 1, -1):
                if r >> j & 1:
                    r ^= poly << (j - parity)
            power.append(r)
        self.tables = [np.array([int(np.bitwise_xor.reduce([power[8 * b + i] for i in range(8)
                                                            if x >> i & 1 and 8 * b + i < n] or [0]))
                                 for x in range(256)], np.int64) for b in range((n + 7) // 8)]
        pat, excess = [], []
        for w in range(radius + 3):
            for c in combinations(range(n), w):
                pat.append(sum(1 << i for i in c))
                excess.append(max(0, w - radius))
        pat, excess = np.array(pat, np.int64), np.array(excess, np.int64)
        syn = self.syndrome(pat)
        order = np.lexsort((pat, excess, syn))
        self.pat = pat[order]
        self.start = np.searchsorted(syn[order], np.arange(1 << parity))
        key = syn[order] * 4 + excess[order]
        #: upto[e][s]: how many patterns of syndrome s exceed the radius by e or less
        self.upto = [np.searchsorted(key, np.arange(1 << parity) * 4 + e, side="right") - self.start for e in range(3)]

    def syndrome(self, v: np.ndarray) -> np.ndarray:
        s = np.zeros(len(v), np.int64)
        for b, t in enumerate(self.tables):
            s ^= t[(v >> (8 * b)) & 255]
        return s

    def part(self, fp: np.ndarray) -> np.ndarray:
        return ((fp >> np.uint64(self.first)) & np.uint64((1 << self.n) - 1)).astype(np.int64)


@lru_cache(maxsize=1)
def codes() -> tuple[_Code, ...]:
    return tuple(_Code(*b) for b in BLOCKS)


def _product(a: _Code, b: _Code, va, vb, sa, sb, a_from, a_to, b_to):
    """(row, message a, message b) for all codewords of the two blocks within the given counts."""
    na, nb = a_to - a_from, b_to
    each = na * nb
    row = np.repeat(np.arange(len(va)), each)
    i = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    wa = va[row] ^ a.pat[a.start[sa[row]] + a_from[row] + i // nb[row]]
    wb = vb[row] ^ b.pat[b.start[sb[row]] + i % nb[row]]
    return row, wa >> a.parity, wb >> b.parity


def home_anchors(fp: np.ndarray) -> list[np.ndarray]:
    """For each block pair the anchor nearest to every fingerprint."""
    out = []
    cs = codes()
    mine = [(c.part(fp),) for c in cs]
    msg = [(v[0] ^ c.pat[c.start[c.syndrome(v[0])]]) >> c.parity for c, v in zip(cs, mine)]
    for p, (x, y) in enumerate(PAIRS):
        out.append((p << ANCHOR_BITS) | (msg[x] << 12) | msg[y])
    return out


def member_anchors(fp: np.ndarray):
    """(row, anchor) of all anchors within covering radius plus threshold, homes included."""
    cs = codes()
    vals = [c.part(fp) for c in cs]
    syn = [c.syndrome(v) for c, v in zip(cs, vals)]
    for p, (x, y) in enumerate(PAIRS):
        a, b = cs[x], cs[y]
        ua, ub = [u[syn[x]] for u in a.upto], [u[syn[y]] for u in b.upto]
        zero = np.zeros(len(fp), np.int64)
        for a_from, a_to, b_to in ((zero, ua[0], ub[2]), (ua[0], ua[1], ub[1])):
            row, ma, mb = _product(a, b, vals[x], vals[y], syn[x], syn[y], a_from, a_to, b_to)
            yield row, (p << ANCHOR_BITS) | (ma << 12) | mb


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links contracted: every end with the smallest end of its component."""
    if not len(a):
        return a, b
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = inv[:len(a)], inv[len(a):]
    lab = np.arange(len(nodes))
    while True:
        m = np.minimum(lab[ia], lab[ib])
        new = lab.copy()
        for at in (lab[ia], lab[ib], ia, ib):
            np.minimum.at(new, at, m)
        new = new[new]
        if np.array_equal(new, lab):
            break
        lab = new
    far = lab != np.arange(len(nodes))
    return nodes[far], nodes[lab[far]]


def _links(g: np.ndarray, home: np.ndarray, fp: np.ndarray, bits: int):
    """Star links between homes and all members of the same group; rows are sorted by group, homes first."""
    cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    size = np.diff(np.concatenate([cut, [len(g)]]))
    homes = np.add.reduceat(home.astype(np.int64), cut)
    out_a, out_b = [], []
    work = homes * size
    small = (homes > 0) & (size > 1) & (work <= PAIRS_AT_ONCE)
    at = np.flatnonzero(small)
    total, begin = np.concatenate([[0], np.cumsum(work[at])]), 0
    while begin < len(at):
        end = begin + max(1, int(np.searchsorted(total, total[begin] + PAIRS_AT_ONCE, side="right")) - begin - 1)
        sel = at[begin:end]
        row = np.repeat(np.arange(len(sel)), work[sel])
        i = np.arange(len(row)) - np.repeat(np.cumsum(work[sel]) - work[sel], work[sel])
        x, y = cut[sel][row] + i // size[sel][row], cut[sel][row] + i % size[sel][row]
        near = (np.bitwise_count(fp[x] ^ fp[y]) <= bits) & (x != y)
        sa, sb = stars(fp[x[near]], fp[y[near]])
        out_a.append(sa)
        out_b.append(sb)
        begin = end
    for k in np.flatnonzero((homes > 0) & (work > PAIRS_AT_ONCE)):
        f = fp[cut[k]:cut[k] + size[k]]
        h = f[:homes[k]]
        for i in range(0, len(h), 64):
            for j in range(0, len(f), PAIRS_AT_ONCE // 64):
                r, c = np.nonzero(np.bitwise_count(h[i:i + 64, None] ^ f[None, j:j + PAIRS_AT_ONCE // 64]) <= bits)
                sa, sb = stars(h[i:i + 64][r], f[j:j + PAIRS_AT_ONCE // 64][c])
                out_a.append(sa)
                out_b.append(sb)
    if not out_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return stars(np.concatenate(out_a), np.concatenate(out_b))


def links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """(u, v) links whose components are those of all pairs of ``fp`` within ``bits`` (four at most)."""
    if not 0 <= bits <= BITS:
        raise ValueError("the anchors cover up to four bits")
    spark = distinct.sparkSession
    ship(spark)

    def homes(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            k = np.concatenate(home_anchors(fp)) if len(fp) else np.zeros(0, np.int64)
            k, n = np.unique(k, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n.astype(np.int64))], names=["anchor", "n"])

    home = stage(distinct.select("fp").mapInArrow(homes, "anchor long, n long"), "simhash-homes")
    total = home.agg(F.sum("n")).first()[0] or 0
    words = (home.groupBy(F.shiftright("anchor", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(anchor % 64 as int)))").alias("b")).toPandas())
    bitmap = np.zeros(len(PAIRS) << (ANCHOR_BITS - 6), np.uint64)  # fixed size
    bitmap[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    limit = max(HOME_LIMIT, total // MOST_SALTED)
    hot = (home.groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") > limit)
           .orderBy("anchor").toPandas())  # at most MOST_SALTED rows, as the counts add up to total
    hot_at = hot["anchor"].to_numpy(np.int64)
    hot_parts = np.minimum(-(-hot["n"].to_numpy(np.int64) // limit), (1 << 20) - 1)
    shared = spark.sparkContext.broadcast((bitmap, hot_at, hot_parts))

    def deal(batches):
        occupied, hot_at, hot_parts = shared.value
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for s in range(0, len(every), 1024):
                fp = every[s:s + 1024]
                at_home = home_anchors(fp)
                for row, anchor in member_anchors(fp):
                    live = (occupied[anchor >> 6] >> (anchor & 63).astype(np.uint64)) & np.uint64(1) == 1
                    row, anchor = row[live], anchor[live]
                    if not len(row):
                        continue
                    is_home = at_home[int(anchor[0] >> ANCHOR_BITS)][row] == anchor
                    parts = np.ones(len(row), np.int64)
                    if len(hot_at):
                        i = np.minimum(np.searchsorted(hot_at, anchor), len(hot_at) - 1)
                        parts = np.where(hot_at[i] == anchor, hot_parts[i], 1)
                    own = (fp[row] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts
                    r = np.repeat(np.arange(len(row)), parts)
                    salt = np.arange(len(r)) - np.repeat(np.cumsum(parts) - parts, parts)
                    member = ~(is_home[r] & (own[r] == salt))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((anchor[r] << 20 | salt) << 1 | member), pa.array(fp[row][r].view(np.int64))],
                        names=["g", "fp"])

    def compare(batches):
        g, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        waiting = []

        def emit(g, fp):
            a, b = _links(g >> 1, (g & 1) == 0, fp, bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"])

        def gathered():
            return (np.concatenate([g, *[w[0] for w in waiting]]), np.concatenate([fp, *[w[1] for w in waiting]]))

        for batch in batches:
            waiting.append((batch.column(0).to_numpy(zero_copy_only=False),
                            batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if sum(len(w[0]) for w in waiting) < CHUNK:
                continue
            g, fp = gathered()
            waiting.clear()
            cut = int(np.searchsorted(g >> 1, g[-1] >> 1))
            if cut:  # the last group may go on in the next batch
                yield emit(g[:cut], fp[:cut])
                g, fp = g[cut:], fp[cut:]
            else:  # one group fills the buffer: its homes stay, the members seen are done
                yield emit(g, fp)
                keep = (g & 1) == 0
                g, fp = g[keep], fp[keep]
        g, fp = gathered()
        if len(g):
            yield emit(g, fp)

    dealt = distinct.select("fp").mapInArrow(deal, "g long, fp long")
    return (dealt.repartition(F.shiftright("g", 1)).sortWithinPartitions("g")
            .mapInArrow(compare, "u long, v long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node with a link (large-star, small-star)."""
    edges = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                  "simhash-edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = stage(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "simhash-round")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def _classes(docs: DataFrame, k: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h, fp of every row; fp and its component's root)."""
    fps = stage(fingerprints(docs, k), "simhash-fps")
    distinct = stage(fps.select("fp").distinct(), "simhash-distinct")
    roots = components(links(distinct, bits))
    member = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return fps, member


def near_duplicates(docs: DataFrame, k: int = 4, bits: int = BITS) -> DataFrame:
    """doc_id, fp (signed long) and component_id (smallest doc_id reachable) of every row."""
    fps, member = _classes(docs, k, bits)
    low = fps.groupBy("fp").agg(F.min("doc_id").alias("low")).join(member, "fp")
    component = low.groupBy("root").agg(F.min("low").alias("component_id"))
    class_of = member.join(component, "root").select("fp", "component_id")
    return fps.join(class_of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, k: int = 4, bits: int = BITS) -> DataFrame:
    """One row of each component, all columns: the smallest doc_id, null ids last, ties by the text's hash."""
    fps, member = _classes(docs, k, bits)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    # repeats are folded and each fingerprint's first row found before components meet
    rows = fps.groupBy("doc_id", "h", "fp").agg(F.count("*").alias("n"))
    first = (rows.groupBy("fp").agg(F.min(rank).alias("low")).join(member, "fp")
             .groupBy("root").agg(F.min("low").alias("first")))
    first_of = member.join(first, "root").select("fp", "first")
    decided = stage(rows.join(first_of, "fp").select(
        "doc_id", "h", "n", (F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.h") == F.col("h"))).alias("stays")),
        "simhash-decided")
    repeated = decided.where("stays and n > 1").select("doc_id", "h")
    if not repeated.limit(1).count():
        return without(docs, decided.where("not stays").select("doc_id", "h"))
    others, some = split_by_keys(docs, repeated)
    key = [some["doc_id"].eqNullSafe(repeated["doc_id"]), F.xxhash64(some["text"]) == repeated["h"]]
    once = some.join(repeated, key, "left_semi").dropDuplicates(["doc_id", "text"])
    rest = others.unionByName(some.join(repeated, key, "left_anti"))
    return without(rest, decided.where("not stays").select("doc_id", "h")).unionByName(once)
