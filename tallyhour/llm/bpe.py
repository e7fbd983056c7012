"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A piece of text is a row of symbols. The leaves of a segment tree hold the merge
rank of every symbol with its right neighbour; the root yields the leftmost
lowest rank. A merge joins the two symbols, updates the two leaves beside it and
their paths to the root (logarithmic), until the root shows no mergeable pair.
Many pieces are merged at once, one tree per row of a matrix, pieces of like
length together; a piece of any length is merged whole.

Texts are cut by the pattern of the vocabulary. Between single blanks the cut is
the same for each blank-led unit alone as for the whole text, so units are looked
up in a bounded memory of units that the task has met before; texts with other runs of
white space are cut whole. Strings of special tokens become their ids, as the
tokenizers library does by default. The vocabulary file is a parameter; workers
read it from their own copy of the tokenizer package.

Defined results: null and empty texts have no tokens and decode to the empty
text; ids that are no valid UTF-8 together decode with replacement characters.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import ship, slices, strings

SLICE_BYTES = 4 << 20
#: Units and pieces that a task remembers.
MEMORY = 400_000
_NONE = np.int64(1) << 62

#: The pattern that cuts text before merging. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_RUN = re.compile(r"\s \s|\s $")


def _byte_chars() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Pair ranks, byte strings and special tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars, vocab = _byte_chars(), spec["model"]["vocab"]
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for s, i in vocab.items():
            self.bytes[i] = bytes(chars[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.of_byte = np.zeros(256, np.int64)
        for c, b in chars.items():
            self.of_byte[b] = vocab[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.rank = np.arange(len(keys))[order]
        self.result = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, or no rank."""
        k = a << 32 | b
        i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[i] == k), self.rank[i], _NONE >> 32)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece."""
        out: list[list[int]] = [[]] * len(pieces)
        by: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by.setdefault(max(1, (len(p) - 1).bit_length()), []).append(i)
        for bits, at in by.items():
            width = 1 << bits
            step = max(1, (1 << 18) // width)
            for s in range(0, len(at), step):
                rows = at[s:s + step]
                for i, ids in zip(rows, self._merge_rows([pieces[i] for i in rows], width, bits)):
                    out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], width: int, bits: int) -> list[list[int]]:
        n = len(pieces)
        size = np.array([len(p) for p in pieces], np.int64)
        sym = np.full((n, width + 1), -1, np.int64)
        flat = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        sym[:, :width][np.arange(width) < size[:, None]] = flat
        nxt = np.broadcast_to(np.minimum(np.arange(1, width + 2), width), (n, width + 1)).copy()
        prv = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
        # a node holds rank << 32 | position: its minimum is the leftmost lowest rank
        tree = np.full((n, 2 * width), _NONE, np.int64)
        tree[:, width:] = self.ranks(sym[:, :width].ravel(), sym[:, 1:].ravel()).reshape(n, width) << 32 | np.arange(width)
        level = width
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            top = tree[live, 1]
            at = top & 0xFFFFFFFF
            right = nxt[live, at]
            after = nxt[live, right]
            sym[live, at] = self.result[top >> 32]
            sym[live, right] = -1
            nxt[live, at] = after
            prv[live, after] = at
            before = prv[live, at]
            has = before >= 0
            new = self.ranks(sym[live, at], sym[live, after])
            self._update(tree, live, at, new << 32 | at, width)
            self._update(tree, live, right, np.full(len(live), _NONE), width)
            if has.any():
                r, b = live[has], before[has]
                self._update(tree, r, b, self.ranks(sym[r, b], sym[r, at[has]]) << 32 | b, width)
            live = live[tree[live, 1] < _NONE]
        keep = sym[:, :width] >= 0
        ids, ends = sym[:, :width][keep].tolist(), np.cumsum(keep.sum(1)).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    @staticmethod
    def _update(tree: np.ndarray, rows: np.ndarray, leaf: np.ndarray, value: np.ndarray, width: int) -> None:
        """Set a leaf of every row and the minima on its path to the root."""
        node = leaf + width
        ok = node < 2 * width
        if not ok.all():
            rows, node, value = rows[ok], node[ok], value[ok]
        tree[rows, node] = value
        while len(node) and node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join([self.bytes[i] for i in ids.tolist()]).decode("utf-8", "replace")


class Coder:
    """Encodes and decodes texts, remembering units (a blank and what follows it) and their pieces.

    ``known`` maps a unit or piece to its decimal ids joined by commas, ``odd`` those
    whose ids decode to other bytes than their own.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.pattern = regex.compile(PATTERN)
        self.decimal = [str(i) for i in range(vocab.size)]
        self.known: dict[str, str] = {}
        self.odd: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        """Units that concatenate to the text and merge independently."""
        if _RUN.search(text):
            return self.pattern.findall(text)
        first, *rest = text.split(" ")
        units = [" " + x for x in rest]
        return [first, *units] if first else units

    def learn(self, units: set[str]) -> None:
        """Merge the units not met before."""
        known, findall = self.known, self.pattern.findall
        if len(known) > MEMORY:
            known.clear()
            self.odd.clear()
        several, missing = [], set()
        for u in units - known.keys():
            pieces = findall(u)
            if len(pieces) > 1:
                several.append((u, pieces))
            missing.update(pieces)
        missing = list(missing - known.keys())
        raw = [p.encode("utf-8", "surrogatepass") for p in missing]
        dec, byt = self.decimal, self.vocab.bytes
        for p, b, ids in zip(missing, raw, self.vocab.merge(raw)):
            known[p] = ",".join([dec[i] for i in ids])
            back = b"".join([byt[i] for i in ids])
            if back != b:
                self.odd[p] = back
        for u, pieces in several:
            known[u] = ",".join([known[p] for p in pieces])
            if self.odd and any(p in self.odd for p in pieces):
                self.odd[u] = b"".join([self.odd.get(p, p.encode("utf-8", "surrogatepass")) for p in pieces])

    def prepare(self, texts: list[str]) -> list[list[str]]:
        """Units of each text, special tokens being units of their own; all are learned."""
        rows = []
        special = self.vocab.special
        for t in texts:
            if special and any(s in t for s in special):
                units = []
                for x in self.vocab.special_cut.split(t):
                    units += [x] if x in special else self.cut(x) if x else []
            else:
                units = self.cut(t) if t else []
            rows.append(units)
        self.learn(set().union(*rows) - special.keys())
        for s, i in special.items():
            self.known[s] = str(i)
        return rows

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        rows = self.prepare(texts)
        return [np.array(",".join([self.known[u] for u in r]).split(",") if r else [], np.int64) for r in rows]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(tokens, sha256 of the decimal ids joined by commas, sha256 of the decoded text) of each text."""
        out = []
        for r in self.prepare(texts):
            ids = ",".join([self.known[u] for u in r])
            # decoding joins the bytes of all tokens; those of a unit were decoded when it was learned
            if self.odd:
                text = b"".join([self.odd.get(u, u.encode("utf-8", "surrogatepass")) for u in r])
            else:
                text = "".join(r).encode("utf-8", "surrogatepass")
            text = text.decode("utf-8", "replace").encode()
            out.append((ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                        hashlib.sha256(text).hexdigest()))
        return out


def coder(path: str) -> Coder:
    """A new coder, so that a task's memory ends with it; only the vocabulary stays in the worker."""
    kept = sys.modules[__name__].__dict__.setdefault("_VOCABULARIES", {})
    if path not in kept:
        kept[path] = Vocabulary(path)
    return Coder(kept[path])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and its token ids (array of int) of every row."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from tallyhour.llm import bpe
        c = bpe.coder(path)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                ids = [i.astype(np.int32) for i in c.encode(strings(part.column(1)))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))],
                                                 names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of its ``ids``."""
    ship(tokens.sparkSession)
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from tallyhour.llm import bpe
        v = bpe.coder(path).vocab
        for batch in batches:
            texts = [v.decode(np.array(i or [], np.int64)) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from tallyhour.llm import bpe
        c = bpe.coder(path)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                got = c.digests(strings(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()),
                     pa.array([g[2] for g in got], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
