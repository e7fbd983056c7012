import hashlib
import os

from pyspark.sql import functions as F
from test_phrase_index import brute as brute_hits
from test_simhash import brute_components, brute_fp

import corpus_pipeline as cp
from tallyhour.llm import langid, quality_crf
from tallyhour.llm.common import scratch, table
from tallyhour.llm.entry_queries import vocabulary

os.environ["TOKENIZERS_PARALLELISM"] = "false"


def stages(spark, docs, sf_dir):
    """Rows before and after each stage."""
    out = []
    for name, f in cp.STAGES:
        path = scratch(spark, "test-pipeline")
        f(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def check(spark, docs, sf_dir):
    benchmark = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for i, (name, before, after) in enumerate(stages(spark, docs, sf_dir)):
        rows, kept = before.collect(), after.collect()
        texts = lambda rs: sorted((str(r["doc_id"]), str(r["text"])) for r in rs)
        if i < 4:
            assert after.columns == docs.columns, name
        if i == 0:
            f = langid.fit(before)
            want = [r for r in rows if f.predict(r["text"])[0] != "und" and f.predict(r["text"])[2] >= cp.MIN_EVIDENCE]
        elif i == 1:
            c = quality_crf.fit(before, table(spark, sf_dir, "labels"))
            want = [r for r, s in zip(rows, c.scores([r["text"] or "" for r in rows])) if s >= quality_crf.THRESHOLD]
        elif i == 2:
            rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
            lab = brute_components([brute_fp(r["text"]) for r in rows])
            want = [rows[j] for j in sorted(set(lab))]
        elif i == 3:
            bad = [b[5] for b in sorted(brute_hits([(j, r["text"]) for j, r in enumerate(rows)], benchmark), key=lambda b: b[0])]
            want = [r for r, b in zip(rows, bad) if not b]
        else:
            assert len(kept) == len(rows)
            by = {r["doc_id"]: r for r in kept}
            for r in rows:
                e = t.encode(r["text"], add_special_tokens=False).ids
                assert by[r["doc_id"]]["n_tokens"] == len(e)
                assert by[r["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, e)).encode()).hexdigest()
            continue
        assert texts(kept) == texts(want), name
        assert kept, name


def test_stages_match_brute_force(spark, sf_small):
    check(spark, table(spark, sf_small, "documents"), sf_small)


def test_odd_rows(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "999 !!"), (10**6 + 3, "the end of the of and that " * 5000)],
                                  "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True).withColumn("score", F.lit("x")).withColumn("fp", F.lit(1))
    check(spark, docs.unionByName(docs.where("doc_id = 3")), sf_small)


def test_empty_table(spark, sf_small):
    docs = table(spark, sf_small, "documents").where(F.lit(False))
    for _, _, after in stages(spark, docs, sf_small):
        assert after.count() == 0


def test_run_returns_the_last_stage(spark, sf_small):
    got = cp.run(spark, sf_small)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0
