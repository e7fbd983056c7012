"""Alignment of two tokenizers' tokens by sparse matrices of tokens and bytes.

Every text is encoded by A (a byte-level tokenizers file, on a space and the text) and by
B (a sentencepiece file, on the text, before which it puts a space itself). Where both give
back the same bytes, each encoding is a token-byte incidence matrix, kept as compressed
sparse rows (``Rows``). ``product`` multiplies two of them row by row after Gustavson: a row
of the left picks rows of the right, whose entries are added up. A times the transpose of B
gives the overlap links (tokens that share bytes, with how many). Overlap links whose tokens
end at the same byte cut the text into groups; the product of the two group incidence
matrices gives the shared-group links.

``align`` writes each text's links as pair codes, counts the codes of all documents, and sums
the counts up per document. Two tokens that end together are one a suffix of the other's
bytes, so that a tokenizer pair has at most ``Pair.bound`` different codes (under a million here),
however large the corpus: this table alone is collected and broadcast.

A single blank between two characters that are no white space cuts both encodings: A's
pieces begin there, and no piece of B holds a blank after another character. So the matrices of a
text are block diagonal, one block for each such span, and equal blocks are multiplied once: a
worker remembers the links of spans (bounded by ``HELD_BYTES``, the often met half stays) and a text is put together from
its spans. New spans are encoded together, as one chain of bytes. A text with a span that
does not come back byte for byte is taken as one span. A text is never cut elsewhere; a task
holds about a hundred bytes for each byte of its longest span.

Defined results: texts that are null, empty, or that either tokenizer does not give back
byte for byte have no tokens: all counts are zero, the digest is ''. Repeated rows are rows
of their own. An empty table gives no rows. Special tokens' strings are plain text.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _byte_chars
from .common import scratch, ship, slices, strings

SLICE_BYTES = 1 << 20
#: Bytes of remembered spans and what belongs to them, about, before a worker forgets them.
HELD_BYTES = 128 << 20
#: A blank at which both encodings are cut.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Products of rows done at once.
FLOPS = 1 << 22
#: Texts handed to a tokenizer at once hold about so many code points.
ENCODE_CHARS = 1 << 17


class Rows(NamedTuple):
    """Compressed sparse rows: the entries of row i are ``start[i]:start[i + 1]`` of ``column`` and ``value``."""
    start: np.ndarray
    column: np.ndarray
    value: np.ndarray
    columns: int


def incidence(sizes: np.ndarray) -> Rows:
    """Rows that cover ``sizes`` columns each, one after the other (a token and its bytes, a group and its tokens)."""
    start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return Rows(start, np.arange(start[-1]), np.ones(start[-1], np.int64), int(start[-1]))


def transpose(m: Rows) -> Rows:
    """Columns become rows, by a counting sort of the entries."""
    sizes = np.bincount(m.column, minlength=m.columns)
    order = np.argsort(m.column, kind="stable")
    row = np.repeat(np.arange(len(m.start) - 1), np.diff(m.start))
    return Rows(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), row[order], m.value[order], len(m.start) - 1)


def work(left: Rows, right: Rows) -> np.ndarray:
    """Multiplications that each row of the product takes (Gustavson's symbolic pass)."""
    per_entry = np.diff(right.start)[left.column]
    return np.diff(np.concatenate([[0], np.cumsum(per_entry)])[left.start])


def product(left: Rows, right: Rows):
    """Parts (rows, columns, values) of the product, in order, of about FLOPS multiplications each."""
    done = np.concatenate([[0], np.cumsum(work(left, right))])
    begin, last = 0, len(left.start) - 1
    while begin < last:
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + FLOPS, side="right")) - 1)
        a, z = left.start[begin], left.start[end]
        picked = left.column[a:z]
        times = right.start[picked + 1] - right.start[picked]
        total = int(times.sum())
        entry = np.repeat(np.arange(len(picked)), times)
        place = right.start[picked][entry] + np.arange(total) - (np.cumsum(times) - times)[entry]
        row = np.repeat(np.arange(begin, end), np.diff(left.start[begin:end + 1]))[entry]
        key = row * right.columns + right.column[place]
        value = left.value[a:z][entry] * right.value[place]
        if total and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.zeros(0, np.int64)
        key = key[first]
        yield key // max(1, right.columns), key % max(1, right.columns), np.add.reduceat(value, first) if total else value
        begin = end


class Pair:
    """Both tokenizers, the bytes of their tokens, and how their ids are written."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = _byte_chars()
        entries = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(byte[c] for c in entries[i]) if i in entries and all(c in byte for c in entries[i])
                        else entries.get(i, "").encode() for i in range(max(entries) + 1)]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.n_b = len(self.b_bytes)
        #: most pairs of tokens one of which ends with the other; of a byte string, B may have a piece and a byte
        self.bound = int(self.b_sizes.sum() + 2 * self.a_sizes.sum())
        most = max(len(self.a_bytes), self.n_b)
        self.digits = np.array([[int(c) + 48 for c in f"{i:06d}"] for i in range(most)], np.uint8)
        self.width = np.array([len(str(i)) for i in range(most)], np.int64)

    @staticmethod
    def joined(ids: list[list[int]], table: list[bytes]) -> bytes:
        return b"".join(map(table.__getitem__, chain.from_iterable(ids)))

    @staticmethod
    def sizes(ids: list[list[int]], table: np.ndarray) -> np.ndarray:
        """Bytes of every text's tokens."""
        ends = np.cumsum([len(x) for x in ids])
        total = np.concatenate([[0], np.cumsum(table[np.fromiter(chain.from_iterable(ids), np.int64)])])
        return np.diff(total[np.concatenate([[0], ends])])

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of every text by A and by B; both empty where bytes differ."""
        a, b, at = [], [], 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (end == at or held + len(texts[end]) <= ENCODE_CHARS):
                held += len(texts[end])
                end += 1
            part = texts[at:end]
            at = end
            own = [e.ids for e in self.a.encode_batch_fast([" " + t for t in part], add_special_tokens=False)]
            other = self.b.encode(part, num_threads=1)
            if b"".join([b" " + t.encode() for t in part]) == self.joined(own, self.a_bytes) == self.joined(other, self.b_bytes) and (
                    self.sizes(own, self.a_sizes) == self.sizes(other, self.b_sizes)).all() and "" not in part:
                a += own
                b += other
                continue
            for t, x, y in zip(part, own, other):  # rare: some text does not come back
                whole = b" " + t.encode()
                good = (t != "" and b"".join(map(self.a_bytes.__getitem__, x)) == whole
                        and b"".join(map(self.b_bytes.__getitem__, y)) == whole)
                a.append(x if good else [])
                b.append(y if good else [])
        return a, b


def pair(a_path: str, b_path: str) -> Pair:
    """The worker's tokenizers, kept between tasks."""
    kept = sys.modules[__name__].__dict__.setdefault("_PAIRS", {})
    if (a_path, b_path) not in kept:
        kept[a_path, b_path] = Pair(a_path, b_path)
    return kept[a_path, b_path]


class Chain:
    """The tokens of some texts as one chain of bytes."""

    def __init__(self, tokens: Pair, a: list[list[int]], b: list[list[int]]):
        self.tokens = tokens
        self.n_a, self.n_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
        self.a, self.b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a, self.n_a), (b, self.n_b)))
        self.by_a, self.by_b = incidence(tokens.a_sizes[self.a]), incidence(tokens.b_sizes[self.b])

    def overlaps(self):
        """Parts (token of A, token of B, bytes shared) of A times the transpose of B."""
        return product(self.by_a, transpose(self.by_b))

    def ending_together(self) -> tuple[np.ndarray, np.ndarray]:
        """Overlap links whose tokens end at the same byte."""
        out = [(i, j) for i, j, n in self.overlaps() for same in [self.by_a.start[i + 1] == self.by_b.start[j + 1]]
               for i, j in [(i[same], j[same])]]
        return (np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])) if out else \
            (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def groups(self, i: np.ndarray, j: np.ndarray) -> tuple[Rows, Rows]:
        """Group incidence of A's and of B's tokens, from the links that end groups."""
        return (incidence(np.diff(np.concatenate([[0], i + 1]))), incidence(np.diff(np.concatenate([[0], j + 1]))))

    def written(self, i: np.ndarray, j: np.ndarray) -> tuple[bytes, np.ndarray]:
        """`a1,a2|b1;a3|b2,b3` of all groups (each ended by `;`), and where every group ends in it."""
        a_of, b_of = np.diff(np.concatenate([[0], i + 1])), np.diff(np.concatenate([[0], j + 1]))
        n = len(self.a) + len(self.b)
        a_at = np.arange(len(self.a)) + np.repeat(np.cumsum(b_of) - b_of, a_of)
        b_at = np.arange(len(self.b)) + np.repeat(np.cumsum(a_of), b_of)
        ids, mark = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[a_at], ids[b_at] = self.a, self.b
        last = np.cumsum(a_of + b_of) - 1
        mark[last], mark[last - b_of] = ord(";"), ord("|")
        cells = np.concatenate([self.tokens.digits[ids], mark[:, None]], 1)
        width = self.tokens.width[ids]
        text = cells[np.arange(7) >= (6 - width)[:, None]].tobytes()
        return text, np.cumsum(width + 1)[last]


class Spans:
    """Links and groups of spans, each worked out once."""

    def __init__(self, tokens: Pair):
        if any("▁" in p.lstrip("▁") for p in (tokens.b.id_to_piece(i) for i in range(tokens.n_b))):
            raise ValueError("a piece of B goes on after a blank: spans would not be independent")
        self.tokens = tokens
        self.clear()

    def clear(self) -> None:
        #: span -> its number; -1 for what only the cut of a whole text can tell
        self.number: dict[str, int] = {}
        self.whole: dict[str, int] = {}
        self.text: list[bytes] = []
        self.codes: list[bytes] = []
        #: tokens of A, tokens of B, links, shared-group links, whether bytes came back
        self.counts = np.zeros((1024, 5), np.int64)
        self.met = np.zeros(1024, np.int64)
        self.held = 0

    def forget(self) -> None:
        """Keep the spans of plain texts that were met most, up to half of the bytes held."""
        at = np.fromiter(self.number.values(), np.int64, len(self.number))
        names, at = np.array(list(self.number), object)[at >= 0], at[at >= 0]
        cost = np.array([len(self.text[i]) + len(self.codes[i]) + 400 for i in at.tolist()], np.int64)
        order = np.argsort(-self.met[at], kind="stable")
        order = order[np.cumsum(cost[order]) <= HELD_BYTES // 2]
        old = (self.text, self.codes, self.counts, self.met)
        at, names = at[order], names[order]
        self.clear()
        self.text, self.codes = ([column[i] for i in at.tolist()] for column in old[:2])
        self.counts, self.met = (np.concatenate([column[at], np.zeros((1024, *column.shape[1:]), np.int64)]) for column in old[2:])
        self.met //= 2
        self.number.update(zip(names.tolist(), range(len(at))))
        self.held = int(cost[order].sum())

    def learn(self, spans, kept: dict[str, int]) -> None:
        new = [s for s in dict.fromkeys(spans) if s not in kept]
        if kept is self.number:
            for s in new:
                if not s or s[0].isspace() or s[-1].isspace():
                    kept[s] = -1
            new = [s for s in new if s not in kept]
        begin = 0
        while begin < len(new):
            end, size = begin, 0
            while end < len(new) and (end == begin or size + len(new[end]) <= SLICE_BYTES):
                size += len(new[end])
                end += 1
            self._add(new[begin:end], kept)
            begin = end

    def _add(self, new: list[str], kept: dict[str, int]) -> None:
        c = Chain(self.tokens, *self.tokens.encode(new))
        i, j = c.ending_together()
        a_end = np.cumsum(c.n_a)
        links = np.bincount(np.searchsorted(a_end, i, side="right"), minlength=len(new))  # a link ends a group
        group_a, group_b = c.groups(i, j)
        shared = np.concatenate([[0], np.cumsum(work(transpose(group_a), group_b))])
        text, ends = c.written(i, j)
        first = np.concatenate([[0], np.cumsum(links)])
        at = np.concatenate([[0], ends])[first].tolist()
        codes = (c.a[i] * self.tokens.n_b + c.b[j]).astype("<u4").tobytes()
        base = len(self.text)
        while base + len(new) > len(self.counts):
            self.counts, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.counts, self.met))
        self.counts[base:base + len(new)] = np.stack([c.n_a, c.n_b, links, shared[a_end] - shared[a_end - c.n_a], c.n_a > 0], 1)
        self.text += [text[x:y - 1] if y > x else b"" for x, y in zip(at, at[1:])]
        self.codes += [codes[4 * x:4 * y] for x, y in zip(first.tolist(), first[1:].tolist())]
        kept.update(zip(new, range(base, base + len(new))))
        self.held += len(text) + len(codes) + 400 * len(new)

    def of(self, texts: list[str]):
        """(counts, digest, pair codes) of every text."""
        if self.held > HELD_BYTES:
            self.forget()
        rows = [t.split(" ") for t in texts]
        self.learn((s for r in rows for s in r), self.number)
        for k, r in enumerate(rows):
            at = [self.number[s] for s in r]
            if -1 in at:
                spans = CUT.split(texts[k]) if texts[k] else []
                self.learn(spans, self.whole)
                at = [self.whole[s] for s in spans]
            at = np.array(at, np.int64)
            counts = self.counts[at]
            np.add.at(self.met, at, 1)
            if not counts[:, 4].all():  # some span does not come back: the text as one span decides
                self.learn([texts[k]], self.whole)
                at = np.array([self.whole[texts[k]]])
                counts = self.counts[at]
            if not len(at) or not counts[0, 4]:
                yield np.zeros(4, np.int64), "", b""
                continue
            at = at.tolist()
            codes = np.sort(np.frombuffer(b"".join([self.codes[i] for i in at]), "<u4"))
            yield counts[:, :4].sum(0), hashlib.sha256(b";".join([self.text[i] for i in at])).hexdigest(), codes.tobytes()


def spans_of(a_path: str, b_path: str) -> Spans:
    """The worker's memory of spans, kept between tasks."""
    kept = sys.modules[__name__].__dict__.setdefault("_SPANS", {})
    if (a_path, b_path) not in kept:
        kept[a_path, b_path] = Spans(pair(a_path, b_path))
    return kept[a_path, b_path]


def _rows(part: pa.RecordBatch, memory: Spans) -> pa.RecordBatch:
    """Counts, digest and pair codes of the texts of a run."""
    found = list(memory.of(strings(part.column(1))))
    n = np.stack([x[0] for x in found])
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(n[:, 0]), pa.array(n[:, 1]), pa.array(n[:, 2]), pa.array(n[:, 2]), pa.array(n[:, 3]),
         pa.array([x[1] for x in found], pa.string()), pa.array([x[2] for x in found], pa.binary())],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "codes"])


def _links(part: pa.RecordBatch, tokens: Pair, kind: str):
    """Link rows of the texts of a run, in parts."""
    c = Chain(tokens, *tokens.encode(strings(part.column(1))))
    if kind == "overlap":
        parts = c.overlaps()
    else:
        i, j = c.ending_together()
        group_a, group_b = c.groups(i, j)
        parts = product(transpose(group_a), group_b) if kind == "group" else [(i, j, np.ones(len(i), np.int64))]
    a_end, b_begin = np.cumsum(c.n_a), np.cumsum(c.n_b) - c.n_b
    for i, j, n in parts:
        of = np.searchsorted(a_end, i, side="right")
        yield pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(of)), pa.array(i - (a_end - c.n_a)[of]), pa.array(j - b_begin[of]), pa.array(c.a[i]),
             pa.array(c.b[j]), pa.array(n)], names=["doc_id", "a_at", "b_at", "a_id", "b_id", "weight"])


def links(docs: DataFrame, a_path: str, b_path: str, kind: str = "overlap") -> DataFrame:
    """doc_id, a_at, b_at (places of the tokens in their text), a_id, b_id, weight of every link.

    ``kind``: "overlap" (weight: bytes shared), "group" (tokens of one group; a group of p and q
    tokens has p * q of them) or "end" (tokens that end together).
    """
    if kind not in ("overlap", "group", "end"):
        raise ValueError(f"unknown kind of links: {kind}")
    ship(docs.sparkSession)

    def run(batches):
        tokens = pair(a_path, b_path)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                yield from _links(part, tokens, kind)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, a_at long, b_at long, a_id long, b_id long, weight long")


def count_codes(coded: DataFrame) -> DataFrame:
    """code, n: occurrences of every pair code in all texts, folded in every task first."""

    def run(batches):
        code, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), "<u4") for x in batch.column(0)]
            c, k = np.unique(np.concatenate(found), return_counts=True) if found else (code[:0], n[:0])
            both, place = np.unique(np.concatenate([code, c.astype(np.int64)]), return_inverse=True)
            n, code = np.bincount(place, weights=np.concatenate([n, k]), minlength=len(both)).astype(np.int64), both
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

    return coded.select("codes").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and n_shared (shared-group links) of every text."""
    spark = docs.sparkSession
    ship(spark)

    def encode(batches):
        memory = spans_of(a_path, b_path)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                yield _rows(part, memory)

    path = scratch(spark, "alignment")
    schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, codes binary")
    (docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(encode, schema)
     .write.option("compression", "zstd").parquet(path))
    coded = spark.read.schema(schema).parquet(path)
    bound, n_b = _bound(a_path, b_path)
    counts = count_codes(coded).limit(bound + 1).toPandas()  # see the module's docstring
    if len(counts) > bound:
        raise ValueError("more pairs of tokens that end together than the vocabularies allow")
    counts = counts.sort_values("code")
    code, n = counts["code"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    best = np.zeros(n_b, np.int64)
    np.maximum.at(best, code % n_b, n)
    shared = spark.sparkContext.broadcast((code, n, n == best[code % n_b]))

    def add_up(batches):
        code, n, is_best = shared.value
        for batch in batches:
            found = [np.searchsorted(code, np.frombuffer(x.as_buffer(), "<u4")) for x in batch.column(7)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in range(5)]
                + [pa.array([int(is_best[x].sum()) for x in found], pa.int64()), pa.array([int(n[x].sum()) for x in found], pa.int64()),
                   batch.column(6), batch.column(5)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"])

    return coded.mapInArrow(add_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                                    "groups_sha256 string, n_shared long")


def _bound(a_path: str, b_path: str) -> tuple[int, int]:
    tokens = pair(a_path, b_path)
    return tokens.bound, tokens.n_b
