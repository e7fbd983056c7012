"""Benchmark decontamination with a distributed positional inverted index.

The training words are stored as postings: the table is cut into shards of whole
documents (about ``SHARD_WORDS`` words, more only for one longer document), and
a shard holds, for every term, the sorted positions at which it occurs. The
index is a Parquet table, one row per shard, so that no term's postings meet in
one task however frequent the term is.

Test windows (``WINDOW`` consecutive words of an item, or all words of a shorter
one) are looked up shard by shard: the postings of the window's rarest term,
moved back by its offset, give candidate places, and the postings of the other
terms, rarer ones first, are intersected with them. With a slop every other term
may lie that many words off its place (proximity); slop 0 is the exact phrase.
Windows never cross documents.

The benchmark is dealt to blocks of bounded size; each block is one broadcast
and one pass over the stored index, so a large benchmark costs passes, not memory.

Defined results: null and empty texts have no words and no hits; repeated rows
are separate documents; items without words match nothing; equal items all
match; null item ids match but are not listed.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, ship, slices, stage, text_key, without

WINDOW = 10
SHARD_WORDS = 1_000_000
SLOP = 2
#: Bytes of test text broadcast at a time.
BLOCK_BYTES = 8 << 20

#: A-Z become a-z; every ASCII byte but letters and digits becomes a blank.
_WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
                    for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class _Numbering(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _shard(ids: pa.Array, numbers: list[list[int]], terms: _Numbering) -> pa.RecordBatch:
    sizes = np.array([len(n) for n in numbers], np.int64)
    flat = np.concatenate([np.array(n, np.int64) for n in numbers] or [np.zeros(0, np.int64)])
    keys = np.sort(flat << 32 | np.arange(len(flat)))
    df = np.bincount(flat, minlength=len(terms)).astype(np.uint32)
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([sizes.tobytes()], pa.binary()),
         pa.array([b" ".join(terms)], pa.binary()), pa.array([df.tobytes()], pa.binary()),
         pa.array([(keys & 0xFFFFFFFF).astype(np.uint32).tobytes()], pa.binary())],
        names=["doc_ids", "sizes", "terms", "df", "positions"])


def build_index(docs: DataFrame) -> DataFrame:
    """Shards of whole documents: ids, words per document, terms, document order positions by term."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        ids, numbers, terms, held = [], [], _Numbering(), 0
        for batch in batches:
            for part in slices(batch, 1, 2 << 20):
                for i, text in enumerate(part.column(1).to_pylist()):
                    w = words(text)
                    if held and held + len(w) > SHARD_WORDS:
                        yield _shard(pa.array(ids, part.column(0).type), numbers, terms)
                        ids, numbers, terms, held = [], [], _Numbering(), 0
                    ids.append(part.column(0)[i].as_py())
                    numbers.append([terms[x] for x in w])
                    held += len(w)
        if ids:
            yield _shard(pa.array(ids, part.column(0).type), numbers, terms)

    schema = f"doc_ids array<{kind}>, sizes binary, terms binary, df binary, positions binary"
    path = scratch(spark, "phrase-index")
    (docs.select("doc_id", "text").mapInArrow(run, schema).write
     .option("compression", "zstd").option("parquet.block.size", str(32 << 20)).parquet(path))
    return spark.read.schema(schema).parquet(path)


class Windows:
    """The test windows of a block of items, with one number per distinct word."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int = WINDOW):
        vocab = _Numbering()
        self.items, rows, owner, lengths = [], [], [], []
        for item, text in items:
            w = [vocab[x] for x in words(text)]
            if not w:
                continue
            n = min(size, len(w))
            for i in range(len(w) - n + 1):
                rows.append(w[i:i + n] + [-1] * (size - n))
                lengths.append(n)
                owner.append(len(self.items))
            self.items.append(item)
        self.vocab = list(vocab)
        self.terms = np.array(rows, np.int64).reshape(-1, size)
        self.length = np.array(lengths, np.int64)
        self.owner = np.array(owner, np.int64)


class Shard:
    """One row of the index, opened."""

    def __init__(self, sizes: bytes, terms: bytes, df: bytes, positions: bytes):
        self.sizes = np.frombuffer(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.df = np.frombuffer(df, np.uint32).astype(np.int64)
        self.at = np.cumsum(self.df) - self.df
        self.positions = np.frombuffer(positions, np.uint32).astype(np.int64)
        self.keys = np.repeat(np.arange(len(self.df)), self.df) << 32 | self.positions
        self.number = {w: i for i, w in enumerate(terms.split(b" "))} if terms else {}

    def has(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether ``term`` occurs at a position from low to high."""
        i = np.searchsorted(self.keys, term << 32 | low)
        ok = i < len(self.keys)
        ok[ok] = self.keys[i[ok]] <= (term << 32 | high)[ok]
        return ok & (low <= high)

    def matches(self, q: Windows, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, first position, document) of every match."""
        none = np.zeros(0, np.int64)
        if not len(q.terms) or not len(self.keys):
            return none, none, none
        known = np.array([self.number.get(w, -1) for w in q.vocab] + [-1], np.int64)
        t = known[q.terms]
        inside = np.arange(q.terms.shape[1]) < q.length[:, None]
        live = np.flatnonzero(((t >= 0) | ~inside).all(1))
        t, inside, length = t[live], inside[live], q.length[live]
        df = np.where(inside, self.df[t], 1 << 40)
        order = np.argsort(df, axis=1, kind="stable")
        first = order[:, 0]
        term = t[np.arange(len(t)), first]
        n = self.df[term]
        out = []
        for a, b in _runs(n, 2 << 20):
            w = np.repeat(np.arange(a, b), n[a:b])
            i = np.arange(len(w)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b])
            p = self.positions[self.at[term[w]] + i]
            doc = np.searchsorted(self.starts, p, side="right") - 1
            low_doc, high_doc = self.starts[doc], self.starts[doc] + self.sizes[doc] - 1
            start = p - first[w]
            ok = (start >= low_doc - slop) & (start + length[w] - 1 <= high_doc + slop)
            w, start, low_doc, high_doc, doc = w[ok], start[ok], low_doc[ok], high_doc[ok], doc[ok]
            for j in range(1, t.shape[1]):
                if not len(w):
                    break
                off = order[w, j]
                check = j < length[w]
                place = start + off
                got = ~check
                c = np.flatnonzero(check)
                got[c] = self.has(t[w[c], off[c]], np.maximum(place[c] - slop, low_doc[c]),
                                  np.minimum(place[c] + slop, high_doc[c]))
                w, start, low_doc, high_doc, doc = w[got], start[got], low_doc[got], high_doc[got], doc[got]
            out.append((live[w], start, doc))
        if not out:
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*out))


def _runs(n: np.ndarray, most: int):
    """Index ranges over which ``n`` adds up to about ``most``."""
    total, begin = np.concatenate([[0], np.cumsum(n)]), 0
    while begin < len(n):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + most, side="right")) - 1)
        yield begin, end
        begin = end


def _merge_spans(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sorted, disjoint [start, end) rows covering the given ones."""
    if not len(start):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    return np.stack([s[new], e[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(e) - 1]])]], 1)


def lookup(index: DataFrame, windows: Windows, slop: int) -> DataFrame:
    """Of every document in the index: its shard's file and row, doc_id, n_words, hit spans, items, items nearby."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast(windows)  # at most BLOCK_BYTES of text
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        q = shared.value
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column(2).slice(r, 1).flatten()
                shard = Shard(*(batch.column(c)[r].as_py() for c in range(3, 7)))
                w, start, doc = shard.matches(q, 0)
                near = shard.matches(q, slop) if slop else (w, start, doc)
                n = len(ids)
                spans, items, close = [b""] * n, [[] for _ in range(n)], [[] for _ in range(n)]
                cut = np.argsort(doc, kind="stable")
                for d, at in _groups(doc, cut):
                    m = _merge_spans(start[at] - shard.starts[d], start[at] + q.length[w[at]] - shard.starts[d])
                    spans[d] = m.tobytes()
                    items[d] = [q.items[o] for o in np.unique(q.owner[w[at]]).tolist()]
                for d, at in _groups(near[2], np.argsort(near[2], kind="stable")):
                    close[d] = [q.items[o] for o in np.unique(q.owner[near[0][at]]).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[r].as_py()] * n, pa.string()),
                     pa.array([batch.column(1)[r].as_py()] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), ids,
                     pa.array(shard.sizes), pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string())),
                     pa.array(close, pa.list_(pa.string()))],
                    names=["file", "row", "nth", "doc_id", "n_words", "spans", "items", "close"])

    rows = index.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), "doc_ids",
                        "sizes", "terms", "df", "positions")
    return rows.mapInArrow(run, f"file string, row long, nth int, doc_id {kind}, n_words long, spans binary, "
                                "items array<string>, close array<string>")


def _groups(key: np.ndarray, order: np.ndarray):
    if not len(key):
        return
    k = key[order]
    cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    for a, b in zip(cut, np.append(cut[1:], len(k))):
        yield int(k[a]), order[a:b]


def _blocks(benchmark: DataFrame):
    """Blocks of items as Windows, each from about BLOCK_BYTES of text."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // BLOCK_BYTES) + 1
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield Windows([(r["item_id"], r["text"]) for r in rows.orderBy("item_id", "text").toLocalIterator()])


def contamination(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and n_near_items (items with a window whose
    words all lie within ``slop`` words of their places) of every document."""
    index = build_index(docs)
    blocks = _blocks(benchmark)
    first, second = next(blocks), next(blocks, None)
    kind = docs.schema["doc_id"].dataType.simpleString()
    every = lookup(index, first, slop)
    rows = every.select("doc_id", "n_words", F.array("spans").alias("spans"), "items", "close")
    if second is not None:
        # one pass at a time; of the passes after the first only documents with a match are kept
        every = stage(every, "phrase-pass")
        for w in chain([second], blocks):
            every = every.unionByName(stage(lookup(index, w, slop).where(F.size("close") > 0), "phrase-pass"))
        rows = (every.groupBy("file", "row", "nth")
                .agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                     F.collect_list("spans").alias("spans"), F.flatten(F.collect_list("items")).alias("items"),
                     F.flatten(F.collect_list("close")).alias("close"))
                .select("doc_id", "n_words", "spans", "items", "close"))

    def digest(batches):
        for batch in batches:
            hit, n_items, sha, near = [], [], [], []
            for spans, items, close in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4))):
                s = np.frombuffer(b"".join(spans), np.int64).reshape(-1, 2)
                m = _merge_spans(s[:, 0], s[:, 1])
                hit.append(int((m[:, 1] - m[:, 0]).sum()))
                names = sorted({i for i in items if i is not None})
                n_items.append(len(names))
                sha.append(hashlib.sha256(",".join(names).encode()).hexdigest())
                near.append(len({i for i in close if i is not None}))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hit, pa.int64()), pa.array(n_items, pa.int64()),
                 pa.array(sha, pa.string()), pa.array([h > 0 for h in hit], pa.bool_()), pa.array(near, pa.int64())],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items"])

    return rows.mapInArrow(digest, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, "
                                   "contaminated boolean, n_near_items long")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, without a hit. Texts are looked up by their own hash, so that
    null and repeated doc_ids are told apart by their texts."""
    keyed = docs.select(text_key().alias("doc_id"), "text")
    hit = contamination(keyed, benchmark, slop=0).where("contaminated").select(F.col("doc_id").alias("h")).distinct()
    bad = docs.select("doc_id", text_key().alias("h")).join(hit, "h", "left_semi").distinct()
    return without(docs, stage(bad, "phrase-bad"))
