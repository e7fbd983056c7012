from pyspark.sql import functions as F

from tallyhour.llm import common


def test_without_is_the_same_both_ways(spark, docs_of, monkeypatch):
    rows = [(i, f"text {i % 7}") for i in range(300)] + [(None, "text 1"), (None, None), (5, "text 5"), (5, "another")]
    docs = docs_of(rows)
    keys = docs.where("n_chars = 6 and (doc_id % 3 = 0 or doc_id = 5 or doc_id is null)").select(
        "doc_id", common.text_key().alias("h")).distinct()
    want = sorted(map(str, [r for r in rows if not (len(r[1] or "") == 6 and (r[0] is None or r[0] % 3 == 0 or r[0] == 5))]))
    for limit in (10_000, 3):
        monkeypatch.setattr(common, "KEYS_BROADCAST", limit)
        left = common.without(docs, keys)
        assert left.columns == docs.columns
        assert sorted(str((r["doc_id"], r["text"])) for r in left.collect()) == want
        assert common.without(docs, keys.where(F.lit(False))).count() == len(rows)


def test_words_and_slices():
    import pyarrow as pa
    assert common.words_of(" a\tb\x0bc\x0c\rd\x1ce f ") == ["a", "b", "c", "d\x1ce f"]
    assert common.lower_ascii("ÀÉ AZ") == "ÀÉ az" and common.lower_ascii("AbZ") == "abz"
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 100, None, "", "y" * 100])], names=["t"])
    parts = list(common.slices(batch, 0, 250))
    assert [p.num_rows for p in parts] == [2, 2] or sum(p.num_rows for p in parts) == 4
    assert list(common.slices(batch.slice(0, 0), 0, 10)) == []
