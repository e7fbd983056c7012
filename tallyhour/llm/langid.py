"""Language ID with language-bitmask n-gram filters.

Every learned language has a Bloom filter over its typical four-byte windows of
lower-cased text (non-letters become one blank). The filters share slots and
hash functions and are stored bit-sliced: slot ``s`` holds one bit per language,
so that AND-ing the slots of a window's hashes returns all languages containing
it. A text's per-language hit counts, corrected for the filter's rate of false
positives, decide.

Defined results: a null text or one without a letter is ``und`` with score 0; a
text with letters but no known window gets the most frequent learned language
with score 0; ties go to the language first in sort order. With nothing to learn
from, everything is ``und``. Rows are independent, so repeated rows repeat, and
columns other than ``doc_id``, ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, lower_ascii, ship, slices, strings

UND = "und"
#: Documents to learn from, over all languages (the bound of the fitting sample).
SAMPLE_DOCS = 8000
#: A window is typical of a language from this share of its windows on, and from
#: this share of its highest rate in any language on. At most 1/MIN_RATE windows
#: per language can be typical, which bounds what the driver gathers.
MIN_RATE = 2e-5
MIN_RELATIVE = 0.3
HASHES = (0x9E3779B1, 0x85EBCA77)
SLICE_BYTES = 4 << 20

#: A letter is a character of Unicode category L; numerals such as a half or a Roman eight are none.
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def windows(text: str) -> np.ndarray:
    """The four-byte windows of a text as uint32, runs of non-letters counted as one blank."""
    if not text.isascii():
        text = text.lower()
    b = _FOLD[np.frombuffer((" " + text + " ").encode("utf-8", "surrogatepass"), np.uint8)]
    blank = b == 32
    keep = np.ones(len(b), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    b = np.append(b[keep], 32).astype(np.uint32)  # a single letter makes a window, too
    if len(b) < 4:
        return np.zeros(0, np.uint32)
    return b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24


@dataclass
class LanguageFilters:
    """Bit-sliced filters: ``slots[s]`` holds ceil(languages / 8) bytes, bit l of them for language l."""

    langs: list[str]
    prior: int
    shift: int
    slots: np.ndarray
    fp: np.ndarray

    def masks(self, w: np.ndarray) -> np.ndarray:
        """For each window the bytes whose bits name all languages containing it."""
        m = None
        for h in HASHES:
            s = self.slots[(w * np.uint32(h)) >> np.uint32(self.shift)]
            m = s if m is None else m & s
        return m

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, share of windows that the language's filter knows)."""
        if not text or not self.langs or not _LETTER.search(text):
            return UND, 0.0, 0.0
        w = windows(text)
        n = len(w)
        hits = np.zeros(8 * self.slots.shape[1])
        masks = self.masks(w)
        for j in range(masks.shape[1]):
            hits[8 * j:8 * j + 8] = np.bincount(masks[:, j], minlength=256) @ _BITS
        c = np.maximum(hits[:len(self.langs)] - n * self.fp, 0) / (1 - self.fp)
        best = int(np.argmax(c))
        if c[best] <= 0:
            return self.langs[self.prior], 0.0, 0.0
        rest = float(np.delete(c, best).max(initial=0.0))
        return self.langs[best], float(c[best] / (c[best] + rest)), float(min(1.0, c[best] / n))


_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def build_filters(langs: list[str], prior: int, members: list[np.ndarray]) -> LanguageFilters:
    """Filters of about ten slots per member of the largest language."""
    most = max([len(m) for m in members], default=1)
    bits = max(10, int(np.ceil(np.log2(max(1, most) * 10))))
    slots = np.zeros((1 << bits, max(1, (len(langs) + 7) // 8)), np.uint8)
    shift = 32 - bits
    fp = np.zeros(len(langs))
    for l, m in enumerate(members):
        for h in HASHES:
            slots[(m * np.uint32(h)) >> np.uint32(shift), l // 8] |= np.uint8(1 << (l % 8))
        fp[l] = ((slots[:, l // 8] >> (l % 8)) & 1).mean() ** len(HASHES)
    return LanguageFilters(langs, prior, shift, slots, np.minimum(fp, 0.999))


def _count_windows(batches):
    """(lang, window, n) of each slice."""
    for batch in batches:
        for part in slices(batch, 0, SLICE_BYTES):
            texts, langs = strings(part.column(0)), part.column(1).to_pylist()
            by: dict[str, list[np.ndarray]] = {}
            for t, l in zip(texts, langs):
                by.setdefault(l, []).append(windows(t))
            for l, ws in by.items():
                k, n = np.unique(np.concatenate(ws), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([l] * len(k), pa.string()), pa.array(k.astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "window", "n"])


_HASHES = (1 << 63) - 1


def pick(known: DataFrame, counts: dict[str, int], k: int) -> DataFrame:
    """(text, lang) of the ``k`` rows of every language with the least hashes of doc_id and text; equal rows count once.

    Hashes below a limit that about 1.5 k rows of a language pass are told apart before the shuffle, so
    that a language is never sorted as a whole; where copies leave fewer than k, the limit rises.
    """
    rows = known.withColumn("h", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1))
    share = {l: min(1.0, (1.5 * k + 50) / n) for l, n in counts.items()}
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    least: dict[str, int] = {}
    while share:
        limit = F.element_at(F.create_map(*[F.lit(x) for l, s in share.items() for x in (l, min(_HASHES, int(s * _HASHES)))]), F.col("lang"))
        some = rows.select("lang", "h").where(F.col("lang").isin(list(share)) & (F.col("h") <= limit)).distinct()
        got = some.withColumn("place", place).where(F.col("place") <= k).groupBy("lang").agg(
            F.max("h").alias("h"), F.count(F.lit(1)).alias("n")).collect()  # a row for each language
        found = {r["lang"]: r for r in got}
        for l in list(share):
            if share[l] >= 1.0 or l in found and found[l]["n"] >= k:
                if l in found:
                    least[l] = found[l]["h"]
                del share[l]
            else:
                share[l] = min(1.0, share[l] * 8)
    if not least:
        return known.where(F.lit(False)).select("text", "lang")
    limit = F.element_at(F.create_map(*[F.lit(x) for l, h in least.items() for x in (l, h)]), F.col("lang"))
    return rows.where(F.col("lang").isin(list(least)) & (F.col("h") <= limit)).dropDuplicates(["lang", "h"]).select("text", "lang")


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageFilters:
    """Learn from rows outside the held-out quarter (crc32(doc_id) mod 4 is 2) whose lang is set.

    At most ``sample_docs`` documents are learned from, dealt evenly to the
    languages and picked by the hash of their id and text.
    """
    ship(docs.sparkSession)
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 4) != 2))
    per_lang = known.groupBy("lang").count().orderBy("lang").collect()
    langs = [r["lang"] for r in per_lang if r["lang"] != UND]
    if not langs:
        return build_filters([], 0, [])
    counts = {r["lang"]: r["count"] for r in per_lang}
    prior = max(range(len(langs)), key=lambda i: (counts[langs[i]], -i))
    sample = pick(known, {l: counts[l] for l in langs}, max(1, sample_docs // len(langs)))
    n = (sample.mapInArrow(_count_windows, "lang string, window long, n long")
         .groupBy("lang", "window").agg(F.sum("n").alias("n")))
    total = Window.partitionBy("lang")
    typical = n.withColumn("rate", F.col("n") / F.sum("n").over(total)).where(F.col("rate") >= MIN_RATE)
    got = typical.select("lang", "window", "rate").toPandas()
    got["top"] = got.groupby("window")["rate"].transform("max")
    got = got[got["rate"] >= MIN_RELATIVE * got["top"]]
    members = [np.sort(got.loc[got["lang"] == l, "window"].to_numpy()).astype(np.uint32) for l in langs]
    return build_filters(langs, prior, members)


def predict(docs: DataFrame, filters: LanguageFilters) -> DataFrame:
    """doc_id, held_out, lang_pred, score, evidence (share of known windows) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # 2**bits slots: bounded by MIN_RATE

    def run(batches):
        f = shared.value
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                got = [f.predict(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([g[0] for g in got], pa.string()),
                     pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score", "evidence"])

    rows = docs.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, evidence double")


def keep_identified(docs: DataFrame, filters: LanguageFilters, min_evidence: float) -> DataFrame:
    """Rows of ``docs``, all columns, whose language is identified: not ``und``, and at least
    ``min_evidence`` of their windows known to the predicted language."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    at = docs.columns.index("text")

    def run(batches):
        f = shared.value
        for batch in batches:
            for part in slices(batch, at, SLICE_BYTES):
                got = [f.predict(t) for t in part.column(at).to_pylist()]
                yield part.filter(pa.array([g[0] != UND and g[2] >= min_evidence for g in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
