from itertools import product

import numpy as np
from pyspark.sql import functions as F

from tallyhour.llm import quality_crf as q

GOOD = ["The house of the man is on the hill and it was old.", "She went to the sea in the spring.\nIt rained for days."]
BAD = ["BUY!! NOW!! BUY!! NOW!! BUY!! NOW!!", "x*** y### z$$$ q%%% w&&&", "aa | bb | cc | dd | ee | ff", "spam spam spam spam spam spam spam"]


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(2)
    sizes = np.array([3, 1, 5, 2], np.int64)
    emit, trans, start = rng.normal(size=sizes.sum()), rng.normal(size=(2, 2)), 0.7
    p, norm, pairs = q.forward_backward(emit, trans, start, sizes)
    at, want_pairs, z_of = 0, np.zeros((2, 2)), {}
    for d, n in enumerate(sizes):
        total, good = 0.0, np.zeros(n)
        mine = np.zeros((2, 2))
        for y in product((0, 1), repeat=int(n)):
            s = start * y[0] + sum(emit[at + i] * y[i] for i in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:]))
            w = np.exp(s)
            total += w
            good += w * np.array(y)
            for a, b in zip(y, y[1:]):
                mine[a, b] += w
        assert np.allclose(p[at:at + n], good / total)
        want_pairs += mine / total
        z_of[d] = np.log(total)
        at += n
    assert np.allclose(pairs, want_pairs)
    assert np.allclose(norm, [z_of[d] for d in np.argsort(-sizes, kind="stable")])


def test_features_stay_inside_their_text():
    x, w, n = q.line_features(["a b\nC!!", "", "x\n\ny"])
    alone = [q.line_features([t]) for t in ("a b\nC!!", "", "x\n\ny")]
    assert n.tolist() == [2, 1, 3]
    assert np.array_equal(x, np.concatenate([a[0] for a in alone])) and np.array_equal(w, np.concatenate([a[1] for a in alone]))


def tables(spark, docs_of, n=240):
    docs = docs_of([(i, GOOD[i % 2] if i % 3 else BAD[(i // 3) % 4]) for i in range(n)])
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0, "x") for i in range(n)], "doc_id long, quality int, toxic int, text string")
    return docs, labels


def test_learns_and_scores(spark, docs_of):
    docs, labels = tables(spark, docs_of)
    chain = q.fit(docs, labels)
    got = q.score(docs, chain).join(labels, "doc_id")
    assert got.where("quality <> predicted").count() == 0
    assert got.where("predicted <> cast(score >= 0.7 as int)").count() == 0
    odd = docs_of([(1, None), (2, ""), (3, "\n" * 3000), (4, "the sea and the hill " * 20_000), (None, GOOD[0]), (5, GOOD[0]), (5, GOOD[0])])
    s = q.score(odd, chain).collect()
    assert len(s) == 7 and all(0 <= r["score"] <= 1 for r in s)
    assert len({r["score"] for r in s if r["doc_id"] in (5, None)}) == 1
    assert {r["score"] for r in s if r["doc_id"] == 1} == {r["score"] for r in s if r["doc_id"] == 2}
    kept = q.keep_good(odd, chain, 0.7)
    assert kept.columns == odd.columns and kept.where("doc_id = 5").count() == 2


def test_without_labels_or_rows(spark, docs_of):
    docs, labels = tables(spark, docs_of, 40)
    none = q.fit(docs, labels.where(F.lit(False)))
    assert {r["score"] for r in q.score(docs, none).collect()} == {0.5}
    one = q.fit(docs, labels.where("quality = 1"))
    assert {r["score"] for r in q.score(docs, one).collect()} == {1.0}
    assert q.score(docs.where(F.lit(False)), none).count() == 0


def test_held_out_labels_do_not_matter(spark, docs_of):
    from tallyhour.llm.common import fold
    docs, labels = tables(spark, docs_of)
    flipped = labels.withColumn("quality", F.when(fold("doc_id", 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = q.fit(docs, labels), q.fit(docs, flipped)
    assert np.allclose(a.weights, b.weights) and a.shift == b.shift


def test_query_is_right_on_held_out_rows(spark, sf_small):
    from tallyhour.llm.entry_queries import op4_quality_crf
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    got = op4_quality_crf(spark, sf_small)
    assert got.count() == spark.read.parquet(f"{sf_small}/documents.parquet").count()
    both = got.join(labels, "doc_id").where("held_out")
    assert both.where("quality = predicted").count() >= 0.85 * both.count()
