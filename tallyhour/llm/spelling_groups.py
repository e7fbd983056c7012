"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

Two words one inserted, deleted or replaced code point apart have letter counts whose
squared distance is at most two, and lengths that differ by at most one. Words are dealt
to blocks of one length and one set of coarse counts (of the letter classes ``CLASSES``,
which one edit also moves by at most one each), large blocks in hashed parts. A block
meets its neighbours: itself, blocks of its length with one class less and another more,
and blocks one letter longer with one class more. For such a pair of blocks one NumPy
product of letter-count matrices gives all squared distances; pairs at most two apart are
compared letter by letter. All words are in Latin-1, so that a block is a matrix of bytes.

Counting folds the words of a task before the shuffle. Links are rows of words, never
all pairs of a group. A word's form has at least twice its count, so following forms
takes fewer than 63 steps, and six rounds of pointer jumping end at every root.

Defined results: a null text has no words; a null doc_id counts as empty in the hashed
key; equal rows are counted as often as they come; ties between forms go to the smallest
word in code-point order; an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, slices, stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Shortest word in code points, and least occurrences in all documents.
MIN_LENGTH = 5
MIN_COUNT = 3
#: Of the hashes of (document, run), one in so many loses a code point.
DROP_ONE_IN = 97
#: A form's count is at least so many times its word's.
DOMINANCE = 2
#: Letter classes of about equal weight; all other letters are a further class. Fixed value.
CLASSES = ("edlvz", "trcbkx", "ahupq", "osmygj")
#: Most words, and about most bytes, of a block.
BLOCK_WORDS = 2048
BLOCK_BYTES = 32 << 10
SLICE_BYTES = 4 << 20
#: Distinct words held by a task before they are handed on.
HELD_WORDS = 300_000
#: Dimension of a Latin-1 byte: a to z, then the accented letters.
_DIMENSION = np.zeros(256, np.int64)
_DIMENSION[ord("a"):ord("z") + 1] = np.arange(26)
_DIMENSION[0xC0:] = 26 + np.arange(64)
DIMENSIONS = 90
#: Words up to this length have exact single-precision distances.
SINGLE = 1024


def runs(doc_id, text: str, drop_one_in: int = DROP_ONE_IN) -> Counter:
    """The counted words of one text whose A-Z are lower-cased already."""
    out = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        if drop_one_in:
            h = zlib.crc32(run.encode(), start)
            if h % drop_one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                drop_one_in: int = DROP_ONE_IN) -> DataFrame:
    """word, n: the words of all documents with their occurrences."""
    ship(docs.sparkSession)

    def run(batches):
        held = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()),
                                               pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                texts = pc.ascii_lower(part.column(1)).to_pylist()
                for doc_id, text in zip(part.column(0).to_pylist(), texts):
                    if not text:
                        continue
                    for word, n in runs(doc_id, text, drop_one_in).items():
                        if len(word) >= min_length:
                            held[word] += n
                if len(held) > HELD_WORDS:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    counted = docs.select(F.col("doc_id"), F.col("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def block_key(word: Column) -> Column:
    """Length and coarse letter counts."""
    size = F.length(word)
    counts = [size - F.length(F.translate(word, c, "")) for c in CLASSES]
    rest = size
    for c in counts:
        rest = rest - c
    return F.array(size, *counts, rest)


def neighbour_keys(key: Column) -> Column:
    """Keys whose blocks a block of this key is compared with; of two different keys only one names the other."""
    n = len(CLASSES) + 1

    def moved(steps: dict) -> Column:
        return F.array(*[key[i] + F.lit(steps.get(i, 0)) for i in range(n + 1)])

    same = [moved({})] + [moved({a: -1, b: 1}) for a in range(1, n + 1) for b in range(a + 1, n + 1)]
    longer = [moved({0: 1, a: 1}) for a in range(1, n + 1)]
    return F.array(*same, *longer)


def blocks(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, part, letters, n) rows of at most about BLOCK_WORDS words, and the number of parts of keys with several."""
    keyed = words.select("word", "n", block_key(F.col("word")).alias("key"))
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.lit(BLOCK_BYTES) / F.col("key")[0])))
    several = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("words"))
               .select("key", F.ceil(F.col("words") / most).cast("int").alias("parts")).where("parts > 1"))
    several = stage(several, "spelling-parts")  # at most one row for BLOCK_WORDS words or BLOCK_BYTES letters
    part = F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1)).cast("long")).cast("int")
    rows = (keyed.join(several, "key", "left").withColumn("part", part)
            .groupBy("key", "part").agg(F.collect_list(F.struct("word", "n")).alias("held")))
    return rows.select("key", "part", F.encode(F.array_join(F.col("held.word"), ""), "ISO-8859-1").alias("letters"),
                       F.col("held.n").alias("n")), several


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """Count matrix (word by letter) of words of one length."""
    words, size = letters.shape
    at = _DIMENSION[letters] + (np.arange(words) * DIMENSIONS)[:, None]
    kind = np.float32 if size < SINGLE else np.float64
    return np.bincount(at.ravel(), minlength=words * DIMENSIONS).reshape(words, DIMENSIONS).astype(kind)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (equally long, or ``b`` one longer) are exactly one edit apart."""
    size = a.shape[1]
    if b.shape[1] == size:
        return (a != b).sum(1) == 1
    other = a != b[:, :size]
    first = np.where(other.any(1), other.argmax(1), size)
    return ((a == b[:, 1:]) | (np.arange(size) < first[:, None])).all(1)


def compare(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks that are one edit apart; ``same``: the block with itself, each pair once."""
    x = letter_counts(a)
    y = x if same else letter_counts(b)
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T)
    i, j = np.nonzero(distance <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    good = one_edit(a[i], b[j])
    return i[good], j[good]


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: each pair of different words one edit apart, once."""
    ship(words.sparkSession)
    rows, several = blocks(words)
    rows = stage(rows, "spelling-blocks")
    parts = several.select(F.col("key").alias("to_key"), F.col("parts").alias("to_parts"))
    dealt = rows.select("key", "part", "letters", "n", F.explode(neighbour_keys(F.col("key"))).alias("to_key"))
    itself = F.col("to_key") == F.col("key")
    first = F.when(itself, F.col("part")).otherwise(0)
    dealt = (dealt.join(parts, "to_key", "left")
             .withColumn("to_part", F.explode(F.sequence(first, F.coalesce("to_parts", F.lit(1)) - 1))))
    other = rows.select(F.col("key").alias("to_key"), F.col("part").alias("to_part"), F.col("letters").alias("to_letters"),
                        F.col("n").alias("to_n"))
    met = dealt.join(other, ["to_key", "to_part"]).select(
        F.col("key")[0].alias("size"), F.col("to_key")[0].alias("to_size"),
        (itself & (F.col("part") == F.col("to_part"))).alias("same"), "letters", "n", "to_letters", "to_n")

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            columns = [batch.column(c) for c in range(7)]
            for r in range(batch.num_rows):
                size, to_size, same = (columns[c][r].as_py() for c in range(3))
                a = np.frombuffer(columns[3][r].as_buffer(), np.uint8).reshape(-1, size)
                b = np.frombuffer(columns[5][r].as_buffer(), np.uint8).reshape(-1, to_size)
                i, j = compare(a, b, same)
                if len(i):
                    out[0] += [x.tobytes().decode("latin-1") for x in a[i]]
                    out[1].append(columns[4][r].values.to_numpy(zero_copy_only=False)[i])
                    out[2] += [x.tobytes().decode("latin-1") for x in b[j]]
                    out[3].append(columns[6][r].values.to_numpy(zero_copy_only=False)[j])
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.string()), pa.array(np.concatenate(out[1]), pa.int64()),
                     pa.array(out[2], pa.string()), pa.array(np.concatenate(out[3]), pa.int64())],
                    names=["a", "n_a", "b", "n_b"])

    return met.mapInArrow(run, "a string, n_a long, b string, n_b long")


def follow(forms: DataFrame) -> DataFrame:
    """word, root of the words that have a form, by pointer jumping over (word, form)."""
    step = stage(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    for _ in range(6):  # 2**6 steps are more than doubling counts of 63 bits can take
        to = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not step.join(to, "root", "left_semi").limit(1).count():
            break
        step = stage(step.join(to, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-forms")
    return step


def group_variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n)."""
    words = stage(words.select("word", "n"), "spelling-words")
    pairs = near_pairs(words)
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = (pairs.select(F.explode(both).alias("link")).select("link.*")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                 F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")))
    holds = -F.col("best.less") >= F.lit(dominance) * F.col("n")
    found = stage(words.join(best, "word", "left").select(
        "word", F.when(holds, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(holds, -F.col("best.less")).alias("form_n")), "spelling-found")
    roots = follow(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                    "form_n")
