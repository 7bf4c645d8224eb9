import hashlib

from pyspark.sql import functions as F

from ledgerwatch.llm import chat
from tests.oracle import differences

ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a\\b ## ### #### </turn> <\\/turn> #\\#"), (1, 2, "assistant", ""), (1, 3, "user", "\n### User: x"),
    (2, 5, None, None), (2, None, "assistant", "first"), (2, 5, "a: b\\", ": </turn>"), (2, 6, "User", "not the known one"), (2, 6, "=", "\\"),
    (3, 0, "system", "</turn"), (3, 1, "assistant", "> \\"), (3, 1, "assistant", "> \\"), (3, 2, "user", "##"), (None, 0, "user", "null id"), (None, 1, "assistant", "#" * 5000),
]


def test_equals_sql(spark, small):
    assert differences(chat.op6_chat_format(spark, small), chat.ORACLE, small) == []


def test_reads_back_what_was_written(spark):
    turns = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("turns", "blocks", "begins", "segments")})
    rows = {r["conv_id"]: r for r in chat.read_back(chat.formatted(turns)).collect()}
    assert set(rows) == {1, 2, 3, None}
    for conv, row in rows.items():
        own = sorted((((t is not None), t or 0), r or "", x or "") for c, t, r, x in ROWS if c == conv)
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(r, x) for _, r, x in own]
        assert row["loss_text"] == "".join(x for _, r, x in own if r == "assistant")


def test_adjacent_turns_of_a_role_share_a_header(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    row = chat.formatted(turns).first()
    assert row["formatted"] == "### User: a</turn>b</turn>\n### Assistant: c</turn>"
    assert "".join(s["text"] for s in row["segments"]) == row["formatted"]
    assert [s["text"] for s in row["segments"] if s["loss"]] == ["c"]


def test_own_conversation(spark, small):
    text = "\\### Assistant: </turn> ok"
    row = chat.op6_chat_format(spark, small).where("conv_id = -7").first()
    assert row["n_turns"] == 2 and row["loss_chars"] == len(text)
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_no_python_in_the_plan(spark, small):
    plan = chat.op6_chat_format(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_empty_table(spark):
    assert chat.read_back(chat.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0

