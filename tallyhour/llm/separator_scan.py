"""Token counts by a separator scan over flat, unindexed token files.

A flat file is nothing but little-endian unsigned ids of ``id_bytes`` bytes, documents
ending in an end-of-document id. Nothing tells where documents begin, and they may cross the
files. Files are searched in blocks of ``BLOCK_IDS`` ids, all positions of a block at
once. A block yields the lengths between its separators, the first of them only as
far as the block shows; a prefix scan over the blocks (inside each file, then over
the files) tells how many separators and how many open ids come before each block,
which numbers the documents and completes the cut ones.

``write_flat`` makes such files with Spark's text writer, in the order of the table: texts are
not shuffled. A file is one record, a run of documents of about ``RECORD_BYTES`` whose last end id
is the line separator. Files are small however much a task reads, because the binary file source
holds a file in memory twice over, and Spark keeps those of the tasks that ended in the last two
seconds (a Python task's monitor looks no more often whether it is over): what an executor keeps
is what it reads in that time, except that of a task's files only the last counts. Ascending order of doc_id is made
good on the counts, which are narrow: ``token_counts`` numbers the rows of the table in the order
of the files, joins them with the scanned documents, and sums up in order of doc_id.
The table must give the same rows in the same partitions when it is read again, as files do;
rows and scanned documents are counted, and a difference is an error.

Defined results: a document without ids counts 1 (its end id); ids after the last
separator form one document that is not ``closed``; an empty table or file yields
nothing; equal rows are separate documents, equal doc_ids are ordered by the hash of their text.
Null texts are empty; null doc_ids sort first. Texts hold no end id, as ordinary text never
encodes to it. An id that does not fit ``id_bytes`` is an error.
"""

from __future__ import annotations

import base64
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, ship, slices, stage, strings
from .token_files import running_total

BLOCK_IDS = 1 << 20
#: The pattern that cuts text before merging. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SLICE_BYTES = 4 << 20
#: About the bytes of a file, and the most it has (more only for one longer document).
RECORD_BYTES = 4 << 20
FILE_BYTES = 8 << 20


def encoding(path: str):
    """The worker's tiktoken encoding of this rank file, kept between tasks."""
    kept = sys.modules[__name__].__dict__.setdefault("_ENCODINGS", {})
    if path not in kept:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        kept[path] = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return kept[path]


def write_flat(docs: DataFrame, rank_file: str, end_id: int, path: str, id_bytes: int = 4) -> None:
    """Flat files of all documents below ``path``, in the order of the table.

    ``id_bytes``: 4, or 2 for vocabularies of fewer than 65,536 ids.
    """
    ship(docs.sparkSession)
    kind = {2: "<u2", 4: "<u4"}[id_bytes]
    if end_id >> 8 * id_bytes:
        raise ValueError(f"the end id does not fit {id_bytes} bytes")
    record_bytes, file_bytes, end = RECORD_BYTES, FILE_BYTES, np.array([end_id], kind).tobytes()

    def run(batches):
        from tallyhour.llm import separator_scan
        enc = separator_scan.encoding(rank_file)
        if enc.n_vocab > 1 << 8 * id_bytes:
            raise ValueError(f"the vocabulary does not fit {id_bytes} bytes")
        held, size = [], 0

        def emit():
            return pa.RecordBatch.from_arrays([pa.array([end.join(held)], pa.binary())], names=["ids"])

        for batch in batches:
            for part in slices(batch, 0, SLICE_BYTES):
                for t in strings(part.column(0)):
                    ids = np.array(enc.encode_ordinary(t), kind).tobytes()
                    if held and size + len(ids) + id_bytes > file_bytes:
                        yield emit()
                        held, size = [], 0
                    held.append(ids)
                    size += len(ids) + id_bytes
                    if size >= record_bytes:
                        yield emit()
                        held, size = [], 0
        if held:
            yield emit()

    (docs.select("text").mapInArrow(run, "ids binary")
     .select(F.col("ids").cast("string").alias("value")).write.option("encoding", "ISO-8859-1")
     .option("lineSep", end.decode("latin-1")).option("maxRecordsPerFile", 1).text(path))


def scan_block(ids: np.ndarray, end_id: int) -> tuple[np.ndarray, int]:
    """(lengths ended in the block, separators included and the first one open to the left; ids after the last)."""
    at = np.flatnonzero(ids == end_id)
    ends = np.concatenate([[-1], at])
    return np.diff(ends), len(ids) - 1 - int(ends[-1])


def scan(spark: SparkSession, path: str, end_id: int, id_bytes: int = 4) -> DataFrame:
    """ordinal, start, n_tokens and closed of every document of the flat files below ``path``."""
    ship(spark)
    kind = {2: "<u2", 4: "<u4"}[id_bytes]
    name = re.compile(r"part-(\d+)-[^/]*-c(\d+)[^/]*$")
    # names and empty files are dealt with in Python: any expression here would have Spark copy the contents
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def blocks(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                content = batch.column(1)[r].as_buffer()
                if len(content) % id_bytes:
                    raise ValueError("a flat token file holds whole ids")
                if not len(content):
                    continue
                part, file = map(int, name.search(batch.column(0)[r].as_py()).groups())
                ids = np.frombuffer(content, kind)
                found = [scan_block(ids[i:i + BLOCK_IDS], end_id) for i in range(0, len(ids), BLOCK_IDS)]
                k = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * k, pa.int64()), pa.array([file] * k, pa.int64()), pa.array(np.arange(k)),
                     pa.array([len(ids[i:i + BLOCK_IDS]) for i in range(0, len(ids), BLOCK_IDS)], pa.int64()),
                     pa.array([len(n) for n, _ in found], pa.int64()), pa.array([t for _, t in found], pa.int64()),
                     pa.array([n.astype(np.int64).tobytes() for n, _ in found], pa.binary())],
                    names=["part", "file", "block", "n_ids", "n_ends", "tail", "lengths"])

    rows = stage(files.mapInArrow(blocks, "part long, file long, block long, n_ids long, n_ends long, tail long, lengths binary"),
                 "separator-blocks")
    # inside the files: ids and separators before each block, and where the last of them lies
    before = Window.partitionBy("part", "file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("ids_in", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
            .withColumn("ends_in", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
            .withColumn("last_end", F.when(F.col("n_ends") > 0, F.col("ids_in") + F.col("n_ids") - F.col("tail")))
            .withColumn("last_in", F.max("last_end").over(before)))
    per_file = rows.groupBy("part", "file").agg(F.sum("n_ids").alias("f_ids"), F.sum("n_ends").alias("f_ends"),
                                                F.max("last_end").alias("f_last"))
    per_file = stage(running_total(running_total(per_file, "f_ids", "ids_base"), "f_ends", "ends_base"), "separator-files")
    # over the files: the last separator before each, again in two levels
    marked = per_file.withColumn("end_at", F.col("ids_base") + F.col("f_last")).withColumn("grp", F.expr("part div 256"))
    inner = Window.partitionBy("grp").orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)  # one row per 256 partitions
    groups = (marked.groupBy("grp").agg(F.max("end_at").alias("g_end"))
              .select("grp", F.max("g_end").over(outer).alias("g_before")))
    marked = (marked.withColumn("in_before", F.max("end_at").over(inner)).join(groups, "grp")
              .select("part", "file", "ids_base", "ends_base",
                      F.coalesce(F.greatest("in_before", "g_before"), F.lit(0)).alias("end_before")))
    total = per_file.agg(F.sum("f_ids").alias("all_ids")).first()["all_ids"] or 0
    rows = (rows.join(marked, ["part", "file"])
            .select((F.col("ends_base") + F.col("ends_in")).alias("ordinal"),
                    F.coalesce(F.col("ids_base") + F.col("last_in"), F.col("end_before")).alias("start"),
                    (F.col("ids_base") + F.col("ids_in")).alias("at"), "n_ids", "tail", "n_ends", "lengths"))

    def documents(batches):
        for batch in batches:
            for x in batch.to_pylist():
                n = np.frombuffer(x["lengths"], np.int64).copy()
                if len(n):
                    n[0] += x["at"] - x["start"]
                start = x["start"] + np.cumsum(n) - n
                ordinal, closed = x["ordinal"] + np.arange(len(n)), np.ones(len(n), bool)
                end = x["at"] + x["n_ids"]
                if end == total:  # ids after the very last separator
                    last = end - x["tail"] if len(n) else x["start"]
                    if last < end:
                        n, start = np.append(n, end - last), np.append(start, last)
                        ordinal, closed = np.append(ordinal, x["ordinal"] + len(ordinal)), np.append(closed, False)
                yield pa.RecordBatch.from_arrays([pa.array(ordinal, pa.int64()), pa.array(start, pa.int64()),
                                                  pa.array(n, pa.int64()), pa.array(closed, pa.bool_())],
                                                 names=["ordinal", "start", "n_tokens", "closed"])

    return rows.mapInArrow(documents, "ordinal long, start long, n_tokens long, closed boolean")


def ordinals(docs: DataFrame) -> DataFrame:
    """part, doc_id, hash of the text, and place in the order of the files, of every row."""
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stage(docs.select("doc_id", F.xxhash64("text").alias("h"), F.spark_partition_id().cast("long").alias("part"),
                             F.lit(0).cast("long").alias("file"), at.alias("i")),
                 "separator-order")
    parts = running_total(rows.groupBy("part", "file").agg(F.count("*").alias("n")), "n", "base")
    return rows.join(parts.select("part", "base"), "part").select("part", "doc_id", "h", (F.col("base") + F.col("i")).alias("ordinal"))


def in_order(counted: DataFrame) -> DataFrame:
    """doc_id, ordinal, start and n_tokens in ascending order of (doc_id, h, ordinal), by prefix sums inside and over the tasks."""
    kind = counted.schema["doc_id"].dataType.simpleString()

    def run(batches):
        start = i = 0
        for batch in batches:
            n = batch.column(2).to_numpy()
            ends = start + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(ends - n), pa.array(np.arange(i, i + len(n)))],
                names=["doc_id", "part", "n_tokens", "at", "i"])
            start, i = int(ends[-1]) if len(n) else start, i + len(n)

    keys = ["doc_id", "h", "ordinal"]
    rows = (counted.repartitionByRange(*keys).sortWithinPartitions(*keys)
            .select("doc_id", F.spark_partition_id().cast("long").alias("part"), "n_tokens")
            .mapInArrow(run, f"doc_id {kind}, part long, n_tokens long, at long, i long"))
    rows = stage(rows.withColumn("file", F.lit(0).cast("long")), "separator-sums")
    parts = rows.groupBy("part", "file").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t"))
    parts = running_total(running_total(parts, "n", "docs_before"), "t", "ids_before").select("part", "docs_before", "ids_before")
    return rows.join(parts, "part").select("doc_id", (F.col("docs_before") + F.col("i")).alias("ordinal"),
                                           (F.col("ids_before") + F.col("at")).alias("start"), "n_tokens")


def token_counts(docs: DataFrame, rank_file: str, end_id: int, id_bytes: int = 4) -> DataFrame:
    """doc_id, ordinal, start and n_tokens (end id included) of every document in ascending order of doc_id, counted in flat files."""
    spark = docs.sparkSession
    ship(spark)
    path = scratch(spark, "flat-tokens")
    order = stage(ordinals(docs), "separator-rows")
    write_flat(docs, rank_file, end_id, path, id_bytes)
    found = stage(scan(spark, path, end_id, id_bytes), "separator-documents")
    if found.count() != order.count():
        raise RuntimeError("the table gave other rows when it was read again: write it down first")
    return in_order(order.join(found.select("ordinal", "n_tokens"), "ordinal"))
