"""Token files: binary, Simple-8b coded, in ascending order of documents.

A file is a row of segments, each followed by the 8-byte mark ``SYNC``. A segment
holds whole documents (about ``SEGMENT_IDS`` ids, more only for one longer
document) as little-endian 64-bit words: a header, the documents' ids and lengths,
the word offset of every block of ``BLOCK`` ids, and the coded words. The four high
bits of a coded word are its selector: 1 to 14 pack 60, 30, ... 1 ids of 1, 2, ...
60 bits; 0 is the escape, whose id of over 60 bits is the next word as it is. The
block offsets let all blocks be coded and decoded side by side.

Spark's text writer writes the segments (its line separator is ``SYNC``) through its
commit protocol, so a lost task leaves no half file; Spark's binary file source
reads them from any file system.

Defined results: a null text is empty and becomes the end id alone; documents with
equal ids are ordered by the hash of their text; null ids come first and stay null;
an empty table gives files without segments.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import _byte_chars
from .common import scratch, ship, slices, stage, strings

COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0], np.int64)
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0], np.int64)
BLOCK = 1024
SEGMENT_IDS = 1 << 18
SEGMENTS_PER_FILE = 32
MAGIC = int.from_bytes(b"S8TOKENS", "little")
SYNC = b"\x00S8SYNC\n"
#: Words, and pieces of words, that a worker remembers.
MEMORY = 600_000
SLICE_BYTES = 4 << 20


_BITS = np.array([int(i).bit_length() for i in range(1 << 16)], np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offset of every block) of unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    v = np.zeros(blocks * BLOCK, np.uint64)
    v[:n] = ids
    if n and int(ids.max()) < len(_BITS):
        bits = _BITS[v].reshape(blocks, BLOCK)
    else:
        high = np.frexp(v.astype(np.float64))[1]  # an upper bound of the bit length
        bits = np.where(v < 1 << 52, high, 64 - (v < 1 << 60) * 4).astype(np.uint8).reshape(blocks, BLOCK)
    most = {1: bits}
    for p in (2, 4, 8, 16, 32):  # most[p][i]: widest of p ids from i on; nothing beyond the block
        h = most[p // 2]
        most[p] = h.copy()
        np.maximum(h[:, :-(p // 2)], h[:, p // 2:], out=most[p][:, :-(p // 2)])
    choice = np.zeros((blocks, BLOCK), np.uint8)
    for s in range(14, 0, -1):
        c = int(COUNTS[s])
        p = 1 << (c.bit_length() - 1)
        m = most[p].copy()
        if c > p:
            np.maximum(m[:, :-(c - p)], most[p][:, c - p:], out=m[:, :-(c - p)])
        np.copyto(choice, np.uint8(s), where=m <= np.uint8(WIDTHS[s]))
    choice = choice.ravel()
    step = np.where(choice == 0, 1, COUNTS[choice])
    end = np.minimum((np.arange(blocks) + 1) * BLOCK, n)
    at, live, taken = np.arange(blocks) * BLOCK, np.arange(blocks), []
    while len(live):  # one word of every unfinished block at a time
        taken.append(at[live])
        at[live] += step[at[live]]
        live = live[at[live] < end[live]]
    begin = np.sort(np.concatenate(taken))
    sel = choice[begin]
    place = np.cumsum(1 + (sel == 0)) - (1 + (sel == 0))
    words = np.zeros(int(place[-1] + 1 + (sel[-1] == 0)), np.uint64)
    padded = np.concatenate([v, np.zeros(60, np.uint64)])
    last = (begin // BLOCK + 1) * BLOCK
    for s in range(1, 15):
        k = np.flatnonzero(sel == s)
        if len(k):
            w, first, c = np.zeros(len(k), np.uint64), begin[k], int(COUNTS[s])
            for j in range(c):
                w |= padded[first + j] << np.uint64(j * WIDTHS[s])
            over = np.flatnonzero(first + c > last[k])  # the last word of a block must not take the next one's ids
            if len(over):
                w[over] &= (np.uint64(1) << ((last[k][over] - first[over]) * WIDTHS[s]).astype(np.uint64)) - np.uint64(1)
            words[place[k]] = w | np.uint64(s << 60)
    k = np.flatnonzero(sel == 0)
    words[place[k] + 1] = v[begin[k]]
    return words, place[np.searchsorted(begin, np.arange(blocks) * BLOCK)]


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of coded words."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    sel = (words >> np.uint64(60)).astype(np.int64)
    coded = np.ones(len(words), bool)
    for i in np.flatnonzero(sel == 0).tolist():  # rare: an id of over 60 bits; the word after an escape is no selector
        if coded[i]:
            coded[i + 1] = False
    at = np.flatnonzero(coded)
    sel = sel[at]
    if (sel == 15).any():
        raise ValueError("unknown selector")
    count = np.where(sel == 0, 1, COUNTS[sel])
    block = np.searchsorted(offsets, at, side="right") - 1
    end = np.minimum((block + 1) * BLOCK, n)
    total = np.cumsum(count) - count
    begin = block * BLOCK + total - total[np.searchsorted(at, offsets)][block]
    for s in range(1, 15):
        k = np.flatnonzero(sel == s)
        if len(k):
            mask, c = np.uint64((1 << int(WIDTHS[s])) - 1), int(COUNTS[s])
            whole = begin[k] + c <= end[k]
            w, first = words[at[k[whole]]], begin[k[whole]]
            for j in range(c):
                out[first + j] = (w >> np.uint64(j * WIDTHS[s])) & mask
            part = k[~whole]  # a block's last word may hold fewer
            for j in range(c if len(part) else 0):
                i = begin[part] + j
                ok = i < end[part]
                out[i[ok]] = (words[at[part[ok]]] >> np.uint64(j * WIDTHS[s])) & mask
    k = np.flatnonzero(sel == 0)
    out[begin[k]] = words[at[k] + 1]
    return out


def write_segment(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    words, offsets = pack(ids)
    missing = np.array([d is None for d in doc_ids], np.int64)
    body = np.concatenate([np.array([d or 0 for d in doc_ids], np.int64).view(np.uint64),
                           (np.array(sizes, np.int64) << 1 | missing).astype(np.uint64), offsets.astype(np.uint64), words])
    head = np.array([MAGIC, BLOCK, len(doc_ids), len(ids), len(offsets), len(words), zlib.crc32(body.tobytes()), 0], np.uint64)
    return head.tobytes() + body.tobytes()


def read_segments(content: bytes):
    """(document ids, lengths, ids) of every segment of a file."""
    at = 0
    while at < len(content):
        head = np.frombuffer(content, np.uint64, 8, at).astype(np.int64).tolist()
        if head[0] != MAGIC or head[1] != BLOCK:
            raise ValueError("not a token segment")
        docs, n, blocks, coded, crc = head[2:7]
        body = np.frombuffer(content, np.uint64, 2 * docs + blocks + coded, at + 64)
        at += 64 + body.nbytes
        if zlib.crc32(body.tobytes()) != crc or content[at:at + 8] != SYNC:
            raise ValueError("damaged token segment")
        at += 8
        sizes = body[docs:2 * docs].astype(np.int64)
        names = [None if m else d for d, m in zip(body[:docs].view(np.int64).tolist(), (sizes & 1).tolist())]
        yield names, sizes >> 1, unpack(body[2 * docs + blocks:], body[2 * docs:2 * docs + blocks].astype(np.int64), n)


class WordCoder(dict):
    """Encodes texts with a tokenizers file, word by word: the dictionary of the words met before.

    White space only separates in this vocabulary, so that a text's ids are those of its
    blank-separated words. Plain words (printable Latin-1) are cut into letters, digits
    and signs here and merged by the library's model; all others go through the library whole.
    A word costs one look-up; ``__missing__`` encodes those not met before.
    """

    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    #: The vocabulary's own cut, for lower-cased plain words. Fixed value.
    CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        #: what every special token starts with; words that hold it go through the library whole
        self.marks = {t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.pieces = Pieces(tokenizer.model)

    def __missing__(self, w: str) -> bytes:
        if not self.PLAIN.fullmatch(w) or any(map(w.__contains__, self.marks)):
            ids = array("I", self.tokenizer.encode(w, add_special_tokens=False).ids).tobytes()
        elif w.isalpha():  # one piece
            ids = self.pieces[w.lower()]
        else:
            ids = b"".join(map(self.pieces.__getitem__, self.CUT.findall(w.lower())))
        self[w] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        for memory in (self, self.pieces):
            if len(memory) > MEMORY:
                memory.clear()
        ids_of = self.__getitem__
        return [b"".join(map(ids_of, t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))) for t in texts]


class Pieces(dict):
    """Ids of the letter runs, digits and sign runs met before, merged by the library's model."""

    def __init__(self, model):
        self.model = model
        self.stand_in = {b: c for c, b in _byte_chars().items()}

    def __missing__(self, p: str) -> bytes:
        chars = p if p.isascii() else "".join(map(self.stand_in.__getitem__, p.encode()))
        ids = self[p] = array("I", [t.id for t in self.model.tokenize(chars)]).tobytes()
        return ids


def coder(path: str) -> WordCoder:
    """The worker's coder of this file, kept between tasks."""
    kept = sys.modules[__name__].__dict__.setdefault("_CODERS", {})
    if path not in kept:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        kept[path] = WordCoder(tokenizer)
    return kept[path]


def write(docs: DataFrame, tokenizer_path: str, end_id: int, path: str) -> None:
    """Encode every text, append ``end_id`` and write files in ascending doc_id order below ``path``."""
    ship(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tallyhour.llm import token_files
        c = token_files.coder(tokenizer_path)
        names, sizes, held, total = [], [], [], 0

        def flush():
            ids = np.frombuffer(b"".join(held), "<u4")
            return pa.RecordBatch.from_arrays([pa.array([write_segment(names, sizes, ids)], pa.binary())], names=["segment"])

        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                for name, ids in zip(part.column(0).to_pylist(), c.encode(strings(part.column(1)))):
                    n = len(ids) // 4 + 1
                    if total and total + n > SEGMENT_IDS:
                        yield flush()
                        names, sizes, held, total = [], [], [], 0
                    names.append(name)
                    sizes.append(n)
                    held += [ids, end]
                    total += n
        if names:
            yield flush()

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    (rows.mapInArrow(run, "segment binary").select(F.col("segment").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", SYNC.decode("latin-1"))
     .option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(path))


def read(spark, path: str) -> DataFrame:
    """part and nth file of it, doc_id, nth document of the file, n_tokens, first id in the file, crc32 of the ids."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path)
    name = F.regexp_extract("path", r"part-(\d+)-[^/]*-c(\d+)[^/]*$", 1).cast("long")
    nth = F.regexp_extract("path", r"part-(\d+)-[^/]*-c(\d+)[^/]*$", 2).cast("long")

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                start = done = 0
                for names, sizes, ids in read_segments(batch.column(2)[r].as_py()):
                    low = ids.astype("<u4")
                    ends = np.cumsum(sizes)
                    crc = [zlib.crc32(low[a:b].tobytes()) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                    k = len(names)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(0)[r].as_py()] * k, pa.int64()),
                         pa.array([batch.column(1)[r].as_py()] * k, pa.int64()), pa.array(names, pa.int64()),
                         pa.array(np.arange(done, done + k)), pa.array(sizes), pa.array(ends - sizes + start),
                         pa.array(crc, pa.int64())], names=["part", "file", "doc_id", "nth", "n_tokens", "at", "ids_crc32"])
                    start += int(ends[-1])
                    done += k

    return files.select(name.alias("part"), nth.alias("file"), "content").mapInArrow(
        run, "part long, file long, doc_id long, nth long, n_tokens long, at long, ids_crc32 long")


def running_total(files: DataFrame, size: str, out: str) -> DataFrame:
    """``files`` (part, file, ...) with the sum of ``size`` over all earlier files, by a two-level prefix scan."""
    files = files.withColumn("_group", F.expr("part div 256"))
    inner = Window.partitionBy("_group").orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)  # one row per 256 partitions
    groups = (files.groupBy("_group").agg(F.sum(size).alias("_n"))
              .select("_group", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_base")))
    return (files.withColumn("_in", F.coalesce(F.sum(size).over(inner), F.lit(0))).join(groups, "_group")
            .withColumn(out, F.col("_base") + F.col("_in")).drop("_group", "_base", "_in"))


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files."""
    spark = docs.sparkSession
    path = scratch(spark, "token-files")
    write(docs, tokenizer_path, end_id, path)
    rows = stage(read(spark, path), "token-rows")
    files = running_total(rows.groupBy("part", "file").agg(F.sum("n_tokens").alias("n")), "n", "base")
    return (rows.join(files.select("part", "file", "base"), ["part", "file"])
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))
