"""Exact top-k by inner product with a pivot-distance index.

Vectors are lifted by one coordinate to equal length (sqrt(M - |x|^2), M the largest
squared norm), queries with zero there, so that a larger inner product is a smaller
distance. Every vector is keyed by its nearest pivot and the distance to it; sorted by
that key, the vectors are stored as annuli: blocks of one pivot with a least and a
greatest distance. By the triangle inequality no vector of an annulus is nearer to a
query than the gap between the query's distance to the pivot and the annulus. Queries
first take the annuli nearest to them, which gives each a k-th best score; then annuli
are expanded in order of their gap, and a query stops at those whose bound cannot
reach its k-th best score any more. Bounds are relaxed by more than the rounding
error and compare with "or equal", so that results, ties included, are exact;
scores are integer products.

Queries are read in blocks of ``QUERY_BLOCK``: a block is broadcast, vectors stay where they are
stored, and tasks over the list of annuli choose the nearest ones of each query.
Equal vectors are folded before: of those only the k + 1 smallest ids can be returned.
Pivots are a sample of at most ``PIVOTS`` vectors; every vector is indexed.

Defined results: vectors that are null or hold null, NaN or infinite components take
no part; shorter vectors count as filled with zeros; rows of one vec_id are one vector, the
least by its components in turn; a query is not its own candidate; null vec_ids take no part.
Scores are 64-bit integers: scaled components of 2**62 or more, or so large that a score
could leave 64 bits, are an error and not left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, ship, stage

PIVOTS = 64
BLOCK_ROWS = 512
MOST_BLOCKS = 65_536
QUERY_BLOCK = 4096
PROBES = 3
_SLACK = 1e-7
_SIGN = np.uint64(1 << 63)


def integer_vectors(rows: DataFrame, scale: float, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id and floor(scale * component) as 64-bit integers, one row for each vec_id.

    Integers are stored with the sign flipped and the high byte first, so that byte order is their order.
    """
    ship(rows.sparkSession)

    def run(batches):
        for batch in batches:
            ids, out = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i is None or v is None or any(x is None for x in v):
                    continue
                x = np.floor(scale * np.array(v, np.float64))
                if not np.isfinite(np.array(v, np.float64)).all():
                    continue
                if (np.abs(x) >= 2.0 ** 62).any():
                    raise OverflowError(f"vector {i} has a scaled component of 2**62 or more")
                ids.append(i)
                out.append((x.astype(np.int64).view(np.uint64) ^ _SIGN).astype(">u8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])

    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col)).mapInArrow(
        run, "vec_id long, v binary").groupBy("vec_id").agg(F.min("v").alias("v"))


def integers(v: bytes) -> np.ndarray:
    return (np.frombuffer(v, ">u8").astype(np.uint64) ^ _SIGN).view(np.int64)


def matrix(vectors: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        x = integers(v)
        out[i, :len(x)] = x
    return out


def lift(m: np.ndarray, top: float) -> np.ndarray:
    f = m.astype(np.float64)
    return np.concatenate([f, np.sqrt(np.maximum(top - (f * f).sum(1), 0))[:, None]], 1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(d, 0))


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; in doubles where those are exact."""
    return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if exact else a @ b.T


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """The k best of each query, in order of query, falling score, rising id."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    first = np.searchsorted(query, query, side="left")
    keep = np.arange(len(query)) - first < k
    return query[keep], ids[keep], score[keep]


class Queries:
    """A block of queries with its distances to the pivots."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, pivots: np.ndarray, top: float, exact: bool, k: int):
        self.ids, self.m, self.top, self.exact, self.k = ids, m, top, exact, k
        f = m.astype(np.float64)
        self.norm = (f * f).sum(1)
        self.to_pivot = distances(np.concatenate([f, np.zeros((len(m), 1))], 1), pivots) if len(m) else np.zeros((0, len(pivots)))

    def bound(self, pivot: int, low: float, high: float) -> np.ndarray:
        """No vector of the annulus has a higher score with the query."""
        d = self.to_pivot[:, pivot]
        gap = np.maximum(np.maximum(d - high, low - d) - _SLACK * (1 + d), 0)
        return ((self.norm + self.top - gap * gap) / 2) + _SLACK * (1 + self.norm + self.top)


def _search(blocks, q: Queries, kth: np.ndarray, allowed: dict[int, np.ndarray] | None):
    """Best k of the given blocks for every query, annuli in order of their best bound."""
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    kth = kth.copy()
    bounds = [q.bound(b["pivot"], b["low"], b["high"]) for b in blocks]
    for i in sorted(range(len(blocks)), key=lambda i: -float(bounds[i].max(initial=-np.inf))):
        b = blocks[i]
        live = allowed[b["block"]] if allowed is not None else np.flatnonzero(bounds[i] >= kth)
        if not len(live):
            continue
        ids = np.frombuffer(b["ids"], np.int64)
        m = np.frombuffer(b["m"], np.int64).reshape(len(ids), -1)
        s = products(q.m[live], m, q.exact)
        ok = (s >= kth[live][:, None]) & (q.ids[live][:, None] != ids[None])
        r, c = np.nonzero(ok)
        found = _best(*(np.concatenate(x) for x in zip(found, (live[r], ids[c], s[r, c]))), q.k)
        n = np.bincount(found[0], minlength=len(q.ids))
        full = np.flatnonzero(n >= q.k)
        last = np.cumsum(n)[full] - 1
        kth[full] = np.maximum(kth[full], found[2][last])
    return found


def build_index(vectors: DataFrame, k: int, pivots: int = PIVOTS):
    """(index of annuli, pivots, largest squared norm, dimension, whether doubles are exact)."""
    spark = vectors.sparkSession
    once = Window.partitionBy("v").orderBy("vec_id")
    rows = stage(vectors.withColumn("_n", F.row_number().over(once)).where(F.col("_n") <= k + 1).drop("_n"),
                 "pivot-vectors")

    def measure(batches):
        for batch in batches:
            n = d = a = 0
            for v in batch.column(1).to_pylist():
                x = integers(v).astype(np.float64)
                n, d, a = max(n, float(x @ x)), max(d, len(x)), max(a, float(np.abs(x).max(initial=0)))
            yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([d], pa.int64()), pa.array([float(a)]),
                                              pa.array([batch.num_rows], pa.int64())], names=["n", "d", "a", "c"])

    top, dim, most, count = rows.mapInArrow(measure, "n double, d long, a double, c long").agg(
        F.max("n"), F.max("d"), F.max("a"), F.sum("c")).first()
    top, dim, count = top or 0.0, max(1, dim or 0), count or 0
    if (most or 0.0) ** 2 * dim >= 2.0 ** 63:
        raise OverflowError("inner products of these vectors can leave 64 bits")
    exact = (most or 0.0) ** 2 * dim < 2.0 ** 52
    n_pivots = int(max(1, min(pivots, count ** 0.5 / 4)))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(n_pivots).collect()
    base = lift(matrix([bytes(r["v"]) for r in picked], dim), top)
    shared = spark.sparkContext.broadcast((base, top, dim))

    def key(batches):
        base, top, dim = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            d = distances(lift(matrix(batch.column(1).to_pylist(), dim), top), base)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int64)), pa.array(d[np.arange(len(near)), near]),
                                              batch.column(0), batch.column(1)], names=["pivot", "r", "vec_id", "v"])

    size = max(BLOCK_ROWS, -(-count // MOST_BLOCKS))

    def pack(batches):
        held, pivot = [], None

        def block(rows):
            r = np.array([x[0] for x in rows])
            m = matrix([x[2] for x in rows], dim)
            return pa.RecordBatch.from_arrays(
                [pa.array([pivot], pa.int64()), pa.array([r.min()]), pa.array([r.max()]),
                 pa.array([np.array([x[1] for x in rows], np.int64).tobytes()], pa.binary()),
                 pa.array([m.tobytes()], pa.binary())], names=["pivot", "low", "high", "ids", "m"])

        for batch in batches:
            for p, r, i, v in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if held and (p != pivot or len(held) >= size):
                    yield block(held)
                    held = []
                pivot = p
                held.append((r, i, v))
        if held:
            yield block(held)

    keyed = stage(rows.mapInArrow(key, "pivot long, r double, vec_id long, v binary"), "pivot-keys")
    index = (keyed.repartitionByRange("pivot", "r", "vec_id").sortWithinPartitions("pivot", "r", "vec_id")
             .mapInArrow(pack, "pivot long, low double, high double, ids binary, m binary")
             .withColumn("block", F.monotonically_increasing_id()))
    return stage(index, "pivot-index"), base, top, dim, exact


def top_k(vectors: DataFrame, queries: DataFrame, k: int, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best candidates of every query."""
    spark = vectors.sparkSession
    index, base, top, dim, exact = build_index(vectors, k, pivots)
    asked = stage(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "pivot-queries")
    n_blocks = -(-asked.count() // QUERY_BLOCK)
    out = scratch(spark, "pivot-found")
    schema = "query_id long, vec_id long, score long"
    cols = ["block", "pivot", "low", "high", "ids", "m"]

    def pass_over(blocks: DataFrame, shared):
        def run(batches):
            q, kth, allowed = shared.value
            for batch in batches:
                found = _search(batch.to_pylist(), q, kth, allowed)
                yield pa.RecordBatch.from_arrays([pa.array(q.ids[found[0]]), pa.array(found[1]), pa.array(found[2])],
                                                 names=["query_id", "vec_id", "score"])
        return blocks.select(cols).mapInArrow(run, schema)

    def nearest(q: Queries) -> dict[int, np.ndarray]:
        """Annulus to those queries (their places) of which it is one of the PROBES nearest."""
        shared = spark.sparkContext.broadcast(q)

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                q, block = shared.value, batch.column(0).to_numpy()
                bounds = np.stack([q.bound(p, low, high) for p, low, high in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))])
                near = np.lexsort((np.broadcast_to(block[:, None], bounds.shape), -bounds), axis=0)[:PROBES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(len(q.ids)), len(near))), pa.array(np.take_along_axis(bounds, near, 0).ravel()),
                     pa.array(block[near].ravel())], names=["query", "bound", "block"])

        each = Window.partitionBy("query").orderBy(F.col("bound").desc(), "block")
        rows = (index.select("block", "pivot", "low", "high").mapInArrow(run, "query long, bound double, block long")
                .withColumn("r", F.row_number().over(each)).where(F.col("r") <= PROBES).select("query", "block").collect())  # PROBES a query
        out: dict[int, list] = {}
        for r in rows:
            out.setdefault(r["block"], []).append(r["query"])
        return {b: np.array(sorted(x), np.int64) for b, x in out.items()}

    def best(df: DataFrame) -> DataFrame:
        w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    for b in range(n_blocks):
        mine = asked.where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_blocks)) == b).orderBy("vec_id").collect()
        q = Queries(np.array([r["vec_id"] for r in mine], np.int64), matrix([bytes(r["v"]) for r in mine], dim), base, top, exact, k)
        # the annuli nearest to each query first: they give its k-th best score
        allowed = nearest(q)
        lowest = np.full(len(mine), -(1 << 63), np.int64)
        probe = spark.sparkContext.broadcast((q, lowest, allowed))
        wanted = spark.createDataFrame([(x,) for x in allowed], "block long")
        first = best(pass_over(index.join(F.broadcast(wanted), "block", "left_semi"), probe)).where(F.col("rank") == k)
        kth = lowest.copy()
        at = {int(x): i for i, x in enumerate(q.ids)}
        for r in first.select("query_id", "score").collect():  # one row per query of the block
            kth[at[r["query_id"]]] = r["score"]
        main = spark.sparkContext.broadcast((q, kth, None))
        best(pass_over(index, main)).select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(out)
    if not n_blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(out)
