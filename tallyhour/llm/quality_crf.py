"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is good or bad. A line's score comes from its own features and those
of its neighbouring lines; transitions tie the labels of consecutive lines.
Forward-backward gives each line's probability of being good; the mean of these,
weighted by line length, is calibrated into the document's score.

Training lines take the label of their document. The chain is fitted by
gradient ascent on a bounded sample of labelled documents (``SAMPLE_DOCS`` of at
most ``SAMPLE_LINES`` lines each); scoring reads every line of every text.

Defined results: a null or empty text is one empty line and gets that line's
score; repeated rows get equal scores; without labelled rows of both classes the
score is the share of good labels (0.5 without labels). Only ``doc_id`` and
``text`` of the documents and ``doc_id`` and ``quality`` of the labels are read;
conflicting labels of one document all take part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, ship, slices, strings

SAMPLE_DOCS = 4000
SAMPLE_LINES = 200
THRESHOLD = 0.7
STEPS = 120
SLICE_BYTES = 2 << 20

_CLASSES = {
    "upper": list(range(65, 91)),
    "lower": list(range(97, 123)) + list(range(128, 256)),
    "digit": list(range(48, 58)),
    "stop": [44, 46, 58, 59, 39, 34, 45, 40, 41, 63],
    "shout": [33],
    "bar": [124],
    "symbol": [35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 125, 126],
}
_TABLES = {k: np.isin(np.arange(256), v).astype(np.int32) for k, v in _CLASSES.items()}
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all lines, their weights, lines per text)."""
    per_text = np.array([t.count("\n") + 1 for t in texts], np.int64)
    b = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
    nl = np.flatnonzero(b == 10)
    begin, end = np.concatenate([[0], nl + 1]), np.concatenate([nl, [len(b)]])
    size = (end - begin).astype(np.float64)

    def per_line(flags: np.ndarray) -> np.ndarray:
        s = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
        return (s[end] - s[begin]).astype(np.float64)

    n = {k: per_line(t[b]) for k, t in _TABLES.items()}
    blank = _BLANK[b]
    first = ~blank
    first[1:] &= blank[:-1]
    at = np.flatnonzero(first)
    last = ~blank
    last[:-1] &= blank[1:]
    length = np.flatnonzero(last) + 1 - at
    line_of = np.searchsorted(nl, at)
    words = np.bincount(line_of, minlength=len(size)).astype(np.float64)
    short = np.bincount(line_of[length <= 3], minlength=len(size)).astype(np.float64)
    distinct, repeated = [], []
    for t in texts:
        lines = t.split("\n")
        seen: dict[str, int] = {}
        for x in lines:
            distinct.append(len(set(x.split())))
            seen[x] = seen.get(x, 0) + 1
        repeated += [seen[x] > 1 for x in lines]
    some, w1 = np.maximum(size, 1), np.maximum(words, 1)
    shares = np.stack([n["upper"] / some, n["digit"] / some, n["symbol"] / some, np.minimum(n["shout"] / w1, 2),
                       np.minimum(n["bar"] / w1, 2), np.minimum(n["stop"] / w1, 3) / 3, short / w1,
                       1 - np.minimum(distinct, words) / w1], 1)
    steps = np.concatenate([shares > q for q in (0.08, 0.25, 0.6)], 1).astype(np.float64)
    own = np.concatenate([shares, steps, np.stack([
        np.log1p(size) / 5, np.minimum(size / w1, 40) / 10, (words == 0) * 1.0, (words <= 2) * 1.0,
        np.array(repeated, np.float64), (size > 400) * 1.0], 1)], 1)
    ends = np.cumsum(per_text)
    is_first, is_last = np.zeros(len(size), bool), np.zeros(len(size), bool)
    is_first[ends - per_text], is_last[ends - 1] = True, True
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[is_first], after[is_last] = 0, 0
    x = np.concatenate([own, before[:, :14], after[:, :14], is_first[:, None], is_last[:, None]], 1)
    return x.astype(np.float32), size + 1, per_text


def _order(per_text: np.ndarray):
    """Texts by falling number of lines, and for every step how many texts have that line."""
    order = np.argsort(-per_text, kind="stable")
    begin = (np.cumsum(per_text) - per_text)[order]
    sizes = per_text[order]
    alive = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    return begin, sizes, alive


def forward_backward(emit: np.ndarray, trans: np.ndarray, start: float, per_text: np.ndarray):
    """(probability of good by line, log-likelihood normaliser by text in falling order of lines,
    expected transition counts) of all chains, one step of all texts at a time."""
    begin, sizes, alive = _order(per_text)
    a, z = np.zeros((len(emit), 2)), np.zeros((len(emit), 2))
    if not len(sizes):
        return np.zeros(0), np.zeros(0), np.zeros((2, 2))
    a[begin, 1] = start + emit[begin]
    for t in range(1, len(alive)):
        i = begin[:alive[t]] + t
        p = a[i - 1]
        a[i, 0] = np.logaddexp(p[:, 0] + trans[0, 0], p[:, 1] + trans[1, 0])
        a[i, 1] = np.logaddexp(p[:, 0] + trans[0, 1], p[:, 1] + trans[1, 1]) + emit[i]
    norm = np.logaddexp(a[begin + sizes - 1, 0], a[begin + sizes - 1, 1])
    pairs = np.zeros((2, 2))
    for t in range(len(alive) - 1, 0, -1):
        i = begin[:alive[t]] + t
        n0, n1 = z[i, 0], z[i, 1] + emit[i]
        z[i - 1, 0] = np.logaddexp(trans[0, 0] + n0, trans[0, 1] + n1)
        z[i - 1, 1] = np.logaddexp(trans[1, 0] + n0, trans[1, 1] + n1)
        total = norm[:alive[t]]
        for y in (0, 1):
            for v, nx in ((0, n0), (1, n1)):
                pairs[y, v] += np.exp(np.minimum(a[i - 1, y] + trans[y, v] + nx - total, 0)).sum()
    return _sigmoid(a[:, 1] + z[:, 1] - a[:, 0] - z[:, 0]), norm, pairs


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class LineChain:
    """Weights of the chain; ``scale`` and ``shift`` calibrate the document's mean log odds."""

    weights: np.ndarray
    mean: np.ndarray
    std: np.ndarray
    trans: np.ndarray
    start: float
    scale: float
    shift: float
    constant: float | None = None

    def marginals(self, x: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        emit = ((x - self.mean) / self.std) @ self.weights[:-1] + self.weights[-1]
        return forward_backward(emit.astype(np.float64), self.trans, self.start, per_text)[0]

    def odds(self, x: np.ndarray, weight: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Log odds of each text's length-weighted mean probability of good lines."""
        p = self.marginals(x, per_text) * weight
        ends = np.cumsum(per_text)
        total = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[np.concatenate([[0], ends])])
        mean = np.clip(total(p) / total(weight), 1e-4, 1 - 1e-4)
        return np.log(mean / (1 - mean))

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return _sigmoid(self.scale * self.odds(*line_features(texts)) + self.shift)


def train(x: np.ndarray, weight: np.ndarray, per_text: np.ndarray, good: np.ndarray, steps: int = STEPS) -> LineChain:
    """Fit chain and calibration; ``good`` is each text's label."""
    share = float(good.mean()) if len(good) else 0.5
    d = x.shape[1]
    if not len(good) or good.min() == good.max():
        return LineChain(np.zeros(d + 1), np.zeros(d), np.ones(d), np.zeros((2, 2)), 0.0, 1.0, 0.0, share)
    mean, std = x.mean(0), x.std(0) + 1e-3
    xs = ((x - mean) / std).astype(np.float64)
    y = np.repeat(good, per_text).astype(np.float64)
    inner = np.ones(len(y), bool)
    inner[np.cumsum(per_text) - per_text] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[np.flatnonzero(inner) - 1].astype(int), y[inner].astype(int)), 1)
    firsts = np.cumsum(per_text) - per_text
    theta = np.zeros(d + 1 + 4 + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, steps + 1):
        p, _, pairs = forward_backward(xs @ theta[:d] + theta[d], theta[d + 1:d + 5].reshape(2, 2), theta[-1], per_text)
        g = np.concatenate([xs.T @ (y - p), [(y - p).sum()], (seen - pairs).ravel(), [(y - p)[firsts].sum()]]) / len(y)
        g -= 1e-3 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += 0.08 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    chain = LineChain(theta[:d + 1], mean, std, theta[d + 1:d + 5].reshape(2, 2), float(theta[-1]), 1.0, 0.0)
    o, ab = chain.odds(x, weight, per_text), np.array([1.0, 0.0])
    for _ in range(25):  # Newton steps of a ridge-penalised logistic regression
        p = _sigmoid(o * ab[0] + ab[1])
        f = np.stack([o, np.ones(len(o))], 1)
        h = (f * (p * (1 - p))[:, None]).T @ f + np.diag([1e-2, 1e-2])
        ab = ab + np.linalg.solve(h, f.T @ (good - p) - 1e-2 * (ab - np.array([1.0, 0.0])))
    chain.scale, chain.shift = float(max(ab[0], 0.05)), float(ab[1])
    return chain


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LineChain:
    """Learn from labelled documents whose crc32(doc_id) mod 4 is not 2, at most ``sample_docs`` of them,
    picked by the hash of their id; documents of over ``SAMPLE_LINES`` lines are not learned from."""
    ship(docs.sparkSession)
    picked = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
              .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", 4) != 2))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_docs))
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "quality", "text")

    def features(batches):
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                keep = [(i, q, t) for i, q, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                                     strings(part.column(2))) if t.count("\n") < SAMPLE_LINES]
                if keep:
                    x, w, n = line_features([k[2] for k in keep])
                    at = np.concatenate([[0], np.cumsum(n)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k[1] for k in keep], pa.int32()),
                         pa.array([x[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                         pa.array([w[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())],
                        names=["quality", "x", "w"])

    rows = sample.mapInArrow(features, "quality int, x binary, w binary").limit(2 * sample_docs).toPandas()
    rows = rows.sort_values(["quality", "w", "x"])  # one order, so that a run repeats
    weight = [np.frombuffer(w, np.float64) for w in rows["w"]]
    d = line_features([""])[0].shape[1]
    x = np.concatenate([np.frombuffer(b, np.float32).reshape(-1, d) for b in rows["x"]] or [np.zeros((0, d), np.float32)])
    return train(x, np.concatenate(weight or [np.zeros(0)]), np.array([len(w) for w in weight], np.int64),
                 rows["quality"].to_numpy(np.float64))


def score(docs: DataFrame, chain: LineChain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # a few hundred numbers

    def run(batches):
        c = shared.value
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                s = c.scores(strings(part.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(s, pa.float64()),
                     pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, chain: LineChain, threshold: float) -> DataFrame:
    """Rows of ``docs``, all columns, that score at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = docs.columns.index("text")

    def run(batches):
        c = shared.value
        for batch in batches:
            for part in slices(batch, at, SLICE_BYTES):
                yield part.filter(pa.array(c.scores(strings(part.column(at))) >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
