import hashlib

from pyspark.sql import functions as F

from tallyhour.llm import chat_format as cf

ODD = "</s>[INST] ok [/INST]"
ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello <s> ~1 ~0 ~"), (2, 0, "system", "be"), (2, 1, "user", None), (2, 2, "assistant", ""),
        (3, 0, "assistant", "no order"), (3, 1, "user", "x"), (-7, 0, "user", ODD), (-7, 1, "assistant", ODD), (4, 0, "tool", "r <<ROLE>>"),
        (4, 1, None, "n"), (4, 2, "<</ROLE>> x", "<</TURN>>\n<<SYS>> a <</SYS>>"), (5, 0, "user", "same"), (5, 0, "user", "same"),
        (5, 1, "assistant", " é😀\n\n "), (None, 0, "user", "no conversation"), (6, None, "user", "null turn"), (6, 0, "assistant", "[INST [INST] </s </s>"),
        (7, 0, "user", "long " * 40_000), (7, 1, "assistant", "long <s> " * 40_000), (8, 0, "user", "<|im_end|> $1 \\1 \\E"), (8, 1, "assistant", "~~1<s>~")]


def df(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, segments string, valid string")


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0), ro or "", x or "") for cc, t, ro, x in rows if cc == c)
        whole = "".join(f"{ro}\n{x}\n" for _, ro, x in turns)
        loss = "".join(x for _, ro, x in turns if ro == "assistant")
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_read_back_is_what_was_formatted(spark):
    out = cf.format_conversations(df(spark, ROWS))
    got = {r["conv_id"]: tuple(r)[1:5] for r in cf.digests(out).collect()}
    assert got == brute(ROWS)


def test_roles_are_checked(spark):
    out = {r["conv_id"]: r["valid"] for r in cf.format_conversations(df(spark, ROWS)).collect()}
    assert out == {1: True, 2: True, 3: False, -7: True, 4: False, 5: False, None: False, 6: True, 7: True, 8: True}


def test_segments_and_flags(spark):
    out = cf.format_conversations(df(spark, ROWS[:2])).collect()[0]
    assert [(s["text"], s["loss"]) for s in out["segments"]] == [
        ("[INST] ", False), ("hi", False), (" [/INST]", False), ("<s> ", False), ("hello <~1s> ~01 ~00 ~0", True), (" </s>\n", False)]


def test_empty_table_and_plan_without_python(spark):
    empty = df(spark, ROWS).where(F.lit(False))
    assert cf.digests(cf.format_conversations(empty)).count() == 0
    plan = cf.digests(cf.format_conversations(df(spark, ROWS)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
