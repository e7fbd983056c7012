import hashlib
import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhour.llm import bpe, separator_scan, token_files
from tallyhour.llm.common import scratch
from tallyhour.llm.entry_queries import vocabulary

os.environ["TOKENIZERS_PARALLELISM"] = "false"
TEXTS = ["", "a", " ", "  ", "a  b", "a   b", "a \n b\n\n  c ", "x<|endoftext|>y <|endoftext|> z", "don't I'll  'sx",
         "é ñandú 日本語 😀   x y", "\x1c\x1d a\x85b", "ab " * 50, " lead", " trail ", "A" * 700, "the" * 300 + " " + "x1" * 70,
         "\n a", "a\n b", "a\t b", "tab \t x", "a  ", "\n\n\n a", "Ünïcödé Straße ĲŁ", "<|startoftext|> b", "a\xa0b c", "12 345 6"]


def library(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))
    t.no_truncation()
    t.no_padding()
    return t


# --- BPE -------------------------------------------------------------------

@pytest.fixture(scope="module")
def byte_bpe():
    return bpe.Vocabulary(vocabulary("byte_bpe_50k.json")), library("byte_bpe_50k.json")


def same(byte_bpe, texts):
    v, t = byte_bpe
    c = bpe.Coder(v)
    got, ids = c.digests(texts), c.encode(texts)
    for x, g, i in zip(texts, got, ids):
        e = t.encode(x, add_special_tokens=False).ids
        d = t.decode(e, skip_special_tokens=False)
        assert i.tolist() == e and v.decode(np.array(e, np.int64)) == d, x
        assert g == (len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(d.encode()).hexdigest())


def test_bpe_equals_the_library(byte_bpe):
    same(byte_bpe, TEXTS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abcthe  \n\t'sñé😀0.,!|<>")), max_size=60), max_size=6))
def test_bpe_equals_the_library_on_any_text(byte_bpe, texts):
    same(byte_bpe, texts)


def test_bpe_memory_is_bounded(byte_bpe, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 3)
    c = bpe.Coder(byte_bpe[0])
    for t in TEXTS * 2:
        assert c.encode([t])[0].tolist() == byte_bpe[1].encode(t, add_special_tokens=False).ids


def test_segment_tree_root_yields_leftmost_lowest_rank(byte_bpe):
    v = byte_bpe[0]

    def plain(piece):
        s = [int(v.of_byte[b]) for b in piece]
        while len(s) > 1:
            r = v.ranks(np.array(s[:-1]), np.array(s[1:]))
            i = int(r.argmin())
            if r[i] >= 1 << 30:
                break
            s[i:i + 2] = [int(v.result[r[i]])]
        return s

    rng = np.random.default_rng(4)
    pieces = [bytes(rng.choice(list(b"aeinrsth"), rng.integers(1, 40)).tolist()) for _ in range(200)] + [b"a" * 33, b"ab" * 40]
    assert v.merge(pieces) == [plain(p) for p in pieces]


def test_bpe_on_tables(spark, docs_of, sf_small, byte_bpe):
    path = vocabulary("byte_bpe_50k.json")
    docs = docs_of([(1, None), (2, ""), (None, "x y"), (3, "dup dup"), (3, "dup dup"), (4, "word " * 30_000)])
    back = bpe.decode(bpe.encode(docs, path), path)
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()))
    assert bpe.round_trip(docs.where(F.lit(False)), path).count() == 0
    from tallyhour.llm.entry_queries import op8_bpe_round_trip
    got = {r["doc_id"]: r for r in op8_bpe_round_trip(spark, sf_small).collect()}
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        e = byte_bpe[1].encode(r["text"], add_special_tokens=False).ids
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(e) and g["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
        assert g["ids_sha256"] == hashlib.sha256(",".join(map(str, e)).encode()).hexdigest()


# --- token files -----------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 70_000), st.integers(0, (1 << 64) - 1)), max_size=400),
       st.integers(0, 3))
def test_simple8b_round_trip(ids, copies):
    a = np.array(ids * (1 + 3 * copies), np.uint64)
    words, offsets = token_files.pack(a)
    assert np.array_equal(token_files.unpack(words, offsets, len(a)), a)


def test_simple8b_packs_and_escapes():
    words, offsets = token_files.pack(np.ones(6000, np.uint64))
    assert len(words) == sum(-(-n // 60) for n in (1024,) * 5 + (880,)) and len(offsets) == 6
    edge = np.array([(1 << 60) - 1, 1 << 60, (1 << 64) - 1, 0, 1 << 52, (1 << 53) + 1], np.uint64)
    words, offsets = token_files.pack(edge)
    assert np.array_equal(token_files.unpack(words, offsets, 6), edge)
    assert len(token_files.pack(np.zeros(0, np.uint64))[0]) == 0


def test_segments_detect_damage():
    s = token_files.write_segment([5, None, 7], [2, 0, 3], np.array([1, 2, 3, 4, 5])) + token_files.SYNC
    (names, sizes, ids), = token_files.read_segments(s)
    assert names == [5, None, 7] and sizes.tolist() == [2, 0, 3] and ids.tolist() == [1, 2, 3, 4, 5]
    for i in (0, len(s) // 2, len(s) - 10):
        with pytest.raises(ValueError):
            list(token_files.read_segments(s[:i] + bytes([s[i] ^ 1]) + s[i + 1:]))


def test_word_coder_equals_the_library():
    t = library("word_bpe_49k.json")
    c = token_files.coder(vocabulary("word_bpe_49k.json"))
    for x, ids in zip(TEXTS, c.encode(TEXTS)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, x


def test_word_coder_memory_keeps_pieces_and_is_bounded(monkeypatch):
    t, asked = library("word_bpe_49k.json"), []

    class Model:
        def tokenize(self, p):
            asked.append(p)
            return t.model.tokenize(p)

    c = token_files.WordCoder(t)
    c.pieces.model = Model()
    monkeypatch.setattr(token_files, "MEMORY", 5)
    text = "alpha Alpha ALPHA aLpha alpha! Alpha! alpha? "
    for _ in range(3):  # each time the words are forgotten, their three pieces are not
        assert np.frombuffer(c.encode([text])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == ["!", "?", "alpha"]
    for x in TEXTS * 2:
        assert np.frombuffer(c.encode([x])[0], "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, x
        assert len(c) <= 5 + len(x) + 1 and len(c.pieces) <= 5 + len(x)


def brute_rows(rows, t):
    out, start = [], 0
    for d, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_on_tables(spark, docs_of, sf_small, monkeypatch):
    t = library("word_bpe_49k.json")
    path = vocabulary("word_bpe_49k.json")
    rows = [(None, "first, without id"), (1, None), (2, ""), (3, "same same"), (3, "same same"), (7, 'quotes " " end'),
            (9, "long " * 20_000), (11, "last")]
    docs = docs_of(list(reversed(rows)))
    assert sorted(map(str, map(tuple, token_files.round_trip(docs, path, 1).collect()))) == sorted(map(str, brute_rows(rows, t)))
    assert token_files.round_trip(docs.where(F.lit(False)), path, 1).count() == 0
    from tallyhour.llm.entry_queries import op1_token_files
    monkeypatch.setattr(token_files, "SEGMENTS_PER_FILE", 1)
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 5000)
    table = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect())
    assert sorted(map(tuple, op1_token_files(spark, sf_small).collect())) == brute_rows(table, t)


# --- separator scan --------------------------------------------------------

def test_scan_block():
    n, tail = separator_scan.scan_block(np.array([5, 9, 9, 4, 3]), 9)
    assert n.tolist() == [2, 1] and tail == 2
    n, tail = separator_scan.scan_block(np.array([5, 4]), 9)
    assert n.tolist() == [] and tail == 2


def flat_files(tmp_path, parts, kind="<u4"):
    for i, p in enumerate(parts):
        np.array(p, kind).tofile(tmp_path / f"part-{i:05d}-x-c000.bin")
    return str(tmp_path)


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_documents_may_cross_blocks_and_files(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(separator_scan, "BLOCK_IDS", block)
    rng = np.random.default_rng(block)
    ids = np.where(rng.random(4000) < 0.02, 9, 5)
    ids[300:1500] = 5  # longer than several files
    ids = np.append(ids, [9, 9, 5, 5])
    cuts = sorted(rng.choice(len(ids), 17, replace=False).tolist())
    parts = [ids[a:b] for a, b in zip([0, *cuts], [*cuts, len(ids)])]
    parts.insert(3, [])
    width = 2 if block == 3 else 4
    got = sorted(map(tuple, separator_scan.scan(spark, flat_files(tmp_path, parts, f"<u{width}"), 9, width).collect()))
    want, start = [], 0
    for e in np.flatnonzero(ids == 9).tolist():
        want.append((len(want), start, e + 1 - start, True))
        start = e + 1
    want.append((len(want), start, len(ids) - start, False))
    assert got == want


def test_token_counts_on_tables(spark, docs_of, sf_small):
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    enc = separator_scan.encoding(ranks)
    rows = [(None, "no id"), (1, None), (2, ""), (3, "same"), (3, "same"), (4, "<|endoftext|> is text"), (8, "w " * 30_000)]
    docs = docs_of(list(reversed(rows)))

    def want(rows):
        out, start = [], 0
        for i, (d, t) in enumerate(rows):
            n = len(enc.encode_ordinary(t or "")) + 1
            out.append((d, i, start, n))
            start += n
        return out
    got = sorted(map(tuple, separator_scan.token_counts(docs, ranks, 50256).collect()), key=lambda r: r[1])
    assert got == want(rows)
    assert separator_scan.token_counts(docs.where(F.lit(False)), ranks, 50256).count() == 0
    from tallyhour.llm.entry_queries import op2_separator_scan
    table = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect())
    assert sorted(map(tuple, op2_separator_scan(spark, sf_small).collect())) == want(table)


@pytest.mark.parametrize("width", [2, 4])
def test_long_documents_fill_several_bounded_files(spark, docs_of, tmp_path, monkeypatch, width):
    """Files are bounded by bytes, not documents; counts come back in order of doc_id whatever the table's order."""
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    enc = separator_scan.encoding(ranks)
    monkeypatch.setattr(separator_scan, "RECORD_BYTES", 200)
    monkeypatch.setattr(separator_scan, "FILE_BYTES", 1500)
    monkeypatch.setattr(separator_scan, "BLOCK_IDS", 64)
    rows = [(i * 7 % 101, f"text {i} " * (1 + i % 13) + "\n\x00\xff ÿ" * (i % 3)) for i in range(101)]
    docs = docs_of(rows).repartition(3)
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    separator_scan.write_flat(docs, ranks, 50256, str(tmp_path / "flat"), width)
    files = [f for f in os.listdir(tmp_path / "flat") if f.startswith("part-")]
    assert len(files) > 6 and max(os.path.getsize(tmp_path / "flat" / f) for f in files) <= 1500
    got = sorted(map(tuple, separator_scan.token_counts(docs, ranks, 50256, width).collect()), key=lambda r: r[1])
    want, start = [], 0
    for i, (d, t) in enumerate(sorted(rows)):
        n = len(enc.encode_ordinary(t)) + 1
        want.append((d, i, start, n))
        start += n
    assert got == want


def test_a_task_writes_many_small_files(spark, docs_of, tmp_path):
    """The binary file source holds whole files in memory, so that they must not grow with what a task reads."""
    rows = [(i, "w " * 100_000) for i in range(64)]  # 13 MB of two-byte ids in one task
    flat = str(tmp_path / "flat")
    separator_scan.write_flat(docs_of(rows).coalesce(1), vocabulary("byte_bpe_50k.tiktoken"), 50256, flat, 2)
    sizes = [os.path.getsize(f"{flat}/{f}") for f in os.listdir(flat) if f.startswith("part-")]
    assert sum(sizes) > 12 << 20 and len(sizes) > 2 and max(sizes) <= 8 << 20
    assert separator_scan.scan(spark, flat, 50256, 2).where("closed").count() == 64


def test_a_long_document_has_a_file_of_its_own(spark, docs_of, tmp_path, monkeypatch):
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    monkeypatch.setattr(separator_scan, "RECORD_BYTES", 400)
    monkeypatch.setattr(separator_scan, "FILE_BYTES", 1500)
    rows = [(i, "long one " * 4000 if i == 23 else "a b c " * 6) for i in range(40)]
    flat = str(tmp_path / "flat")
    separator_scan.write_flat(docs_of(rows).coalesce(1), ranks, 50256, flat, 2)
    sizes = sorted(os.path.getsize(f"{flat}/{f}") for f in os.listdir(flat) if f.startswith("part-"))
    enc = separator_scan.encoding(ranks)
    lengths = [len(enc.encode_ordinary(t)) + 1 for _, t in rows]
    assert sizes[-1] == 2 * lengths[23] and sizes[-2] <= 1500
    got = sorted(map(tuple, separator_scan.scan(spark, flat, 50256, 2).select("ordinal", "n_tokens").collect()))
    assert got == list(enumerate(lengths))


def test_ids_that_do_not_fit_are_an_error(spark, docs_of, tmp_path):
    with pytest.raises(ValueError, match="does not fit"):
        separator_scan.write_flat(docs_of([(1, "a")]), vocabulary("byte_bpe_50k.tiktoken"), 1 << 16, str(tmp_path / "x"), 2)


def test_scratch_paths_differ(spark):
    assert scratch(spark, "a") != scratch(spark, "a")
