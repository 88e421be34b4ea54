from pyspark.sql import functions as F

from storepulse.llm import chat

NASTY = ["", None, r"\### Assistant: </turn> ok", "<turn user>\nhi</turn>\n", "\\", "\\\\l", "\\b<>\\g", "<image>", "é🎉\n",
         "</turn>\n<turn assistant>\n"]


def read(spark, frame):
    done = chat.format_conversations(frame)
    back = done.select("*", chat.read_turns(F.col("formatted")).alias("t"),
                       chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned"))
    return {r["conv_id"]: r for r in back.collect()}


def test_any_text_comes_back(spark):
    rows = [(c, t, role, text, "kept out") for c, role in ((1, "assistant"), (2, "user"), (None, None), (4, "a>\n<b\\"))
            for t, text in enumerate(NASTY)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    found = read(spark, frame.withColumn("parts", chat.text_parts(F.col("text"))))
    assert set(found) == {1, 2, None, 4}
    for c, role in ((1, "assistant"), (2, "user"), (None, ""), (4, "a>\n<b\\")):
        assert [(t["role"], t["text"]) for t in found[c]["t"]] == [(role, x or "") for x in NASTY]
        assert found[c]["learned"] == ("".join(x or "" for x in NASTY) if role == "assistant" else "")


def test_ties_nulls_and_repeats_have_one_order(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, None, "user", "z"), (1, 1, "user", "a")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = read(spark, frame.withColumn("parts", chat.text_parts(F.col("text"))))
    assert [t["text"] for t in found[1]["t"]] == ["z", "a", "a", "b"]


def test_parts_become_placeholders_in_order(spark):
    parts = [("text", "see <", None, None, None, None, None), ("image", None, "i.png", 28, 15, None, None),
             ("audio", None, "a.wav", None, None, 2.5, None), ("text", " and ", None, None, None, None, None),
             ("document", None, "d.pdf", None, None, None, 3), ("video", None, "v", None, None, None, None), None]
    frame = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)],
                                  f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = read(spark, frame)[1]
    assert row["formatted"] == ("<turn user>\nsee \\l<image><audio> and <document><other></turn>\n"
                                "<turn assistant>\n</turn>\n")
    assert [(a["turn"], a["ordinal"], a["kind"], a["ref"], a["tokens"]) for a in row["attachments"]] == [
        (0, 0, "image", "i.png", 4), (0, 1, "audio", "a.wav", 63), (0, 2, "document", "d.pdf", 768), (0, 3, "video", "v", 1)]
    assert row["attachment_tokens"] == 836


def test_empty(spark):
    frame = spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    assert chat.format_conversations(frame).count() == 0


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.format_conversations(frame.withColumn("parts", chat.text_parts(F.col("text"))))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
