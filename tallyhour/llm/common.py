"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhour.session import checkpoint_dir

#: Rows handed to Python at a time; texts may be long.
BATCH_ROWS = 512
#: Separators of words in the contracts: space and \x09 to \x0D.
WORD = re.compile("[^\\x20\\x09-\\x0D]+")
_SPACES = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def lower_ascii(text: str) -> str:
    """Lower-case A-Z only."""
    return text.lower() if text.isascii() else text.translate(_UPPER)


def words_of(text: str) -> list[str]:
    """Maximal runs without space or \\x09-\\x0D (``str.split`` knows more separators)."""
    return [w for w in text.translate(_SPACES).split(" ") if w]


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks can import it, and keep
    batches of long texts small in this session, in Arrow and in the Parquet reader."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_tallyhour_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="tallyhour-zip-"), "tallyhour_pkg.zip")
    with zipfile.ZipFile(out, "w") as z:
        for d, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.join("tallyhour", os.path.relpath(full, root)))
    sc.addPyFile(out)
    sc._tallyhour_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(key: str, mod: int) -> Column:
    """crc32 of the key as text, modulo ``mod``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(mod)


#: Key sets of up to this many rows (of two longs) are broadcast.
KEYS_BROADCAST = 200_000
#: Most bits (log2) of the bitmap that tells rows which surely have no key in a set.
KEY_BITS = 26


def text_key() -> Column:
    """With doc_id, what tells rows of documents apart: rows equal in both are repeats of one."""
    return F.xxhash64("text")


def split_by_keys(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that surely have no key in ``keys``, the others) by a bitmap of at most 2**KEY_BITS bits.

    Most rows need not be shuffled to tell that they are not among a few. ``keys`` holds
    distinct (doc_id, h), ``h`` being ``text_key()``.
    """
    bits = min(KEY_BITS, max(16, (16 * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64("doc_id", "h"), F.lit(1 << bits)).alias("place")
    words = (keys.select(place).groupBy(F.shiftright("place", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("b")).toPandas())  # 2**(bits - 6) rows
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    bitmap[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def maybe(place: pd.Series) -> pd.Series:
        at = place.to_numpy(np.int64)
        return pd.Series((shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1)

    hit = maybe(F.pmod(F.xxhash64(F.col("doc_id"), text_key()), F.lit(1 << bits)))
    return docs.where(~hit), docs.where(hit)


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, whose (doc_id, text) is not among the distinct ``keys`` (doc_id, h).

    A few keys (their number is checked) are broadcast; of more keys, a bitmap of bounded size
    tells which rows need the shuffle join.
    """
    pair = keys.select(F.col("doc_id").alias("_key_id"), F.col("h").alias("_key_h"))
    same = lambda df: df["doc_id"].eqNullSafe(pair["_key_id"]) & (F.xxhash64(df["text"]) == pair["_key_h"])
    if keys.limit(KEYS_BROADCAST + 1).count() <= KEYS_BROADCAST:
        return docs.join(F.broadcast(pair), same(docs), "left_anti")
    clear, rest = split_by_keys(docs, keys)
    return clear.unionByName(rest.join(pair, same(rest), "left_anti"))


def slices(batch: pa.RecordBatch, col: int, limit: int):
    """Runs of rows whose column ``col`` holds about ``limit`` bytes (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    a = batch.column(col)
    sizes = pc.fill_null(pc.binary_length(a), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i in range(n):
        if held and held + sizes[i] > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += int(sizes[i]) + 64
    yield batch.slice(begin, n - begin)


def strings(array: pa.Array) -> list[str]:
    """Python strings; null becomes empty."""
    return [x or "" for x in array.to_pylist()]
