import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from recurwork.llm import chat

BITS = ["<", "s>", "</s>", "[INST]", "[/INST]", "\\", "<\\s>", "[SEP]", "[", "/", "INST]", "a", "é😀", "\n", "<\\", "SEP]", "/s>", "$1", "\\E", "\\Q", "[\\\\/INST]"]
SCHEMA = "conv_id long, turn long, role string, text string"


def told(turns):
    turns = [(r or "", t or "") for r, t in turns]
    learned = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_reads_back_what_was_said(spark):
    r = random.Random(3)
    rows, want = [], {}
    for conv in range(300):
        turns = [(r.choice(["user", "assistant", "assistant", "system", None, "</s>x\n"]), r.choice([None, "", "".join(r.choice(BITS) for _ in range(r.randrange(12)))]))
                 for _ in range(r.randrange(1, 8))]
        rows += [(conv, i, *t) for i, t in enumerate(turns)]
        want[conv] = told(turns)
    r.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit(0)).withColumn("turns", F.lit(1))
    got = {x.conv_id: tuple(x)[1:5] for x in chat.digests(chat.format_conversations(df)).collect()}
    assert got == want


def test_no_mark_inside_a_text_and_nothing_but_texts_under_the_mask(spark):
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (-7, 2, "assistant", "b")]
    r = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    assert r.formatted == r"<s>[INST]user[/INST]<\/s>[\INST] ok [\/INST]</s><s>[INST]assistant[/INST]<\/s>[\INST] ok [\/INST][SEP]b</s>"
    assert [r.formatted[m.start:m.start + m.length] for m in r.loss_mask] == [r"<\/s>[\INST] ok [\/INST]", "b"]


def test_long_conversation_nulls_ties_and_repeats(spark):
    long = [(1, i, "user" if i % 3 else "assistant", "x" * 50) for i in range(400)]
    rows = [*long, (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (None, None, "assistant", "q"), (3, 0, "assistant", "z" * 200_000)]
    got = {x.conv_id: x for x in chat.digests(chat.format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert tuple(got[1])[1:5] == told([r[2:] for r in long])
    assert tuple(got[2])[1:5] == told([("user", "a"), ("user", "a"), ("user", "b")])
    assert got[None].n_turns == 1 and got[3].loss_chars == 200_000
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_spans_over_pieces_of_the_text(spark):
    r = random.Random(8)
    turns = [(1, i, r.choice(["user", "assistant"]), r.choice(["", "é😀", "[SEP]", "x" * r.randrange(9000), "😀é" * r.randrange(3000), "y" * (chat.PIECE - i)])) for i in range(60)]
    f = chat.format_conversations(spark.createDataFrame(turns, SCHEMA))
    assert tuple(chat.digests(f).first())[1:5] == told([t[2:] for t in turns])
    row = f.first()
    assert [re.sub(r"([<\[])\\(\\*)(/?s>|/?INST\]|SEP\])", r"\1\2\3", row.formatted[m.start:m.start + m.length]) for m in row.loss_mask] == [t for _, _, role, t in turns if role == "assistant"]


def test_work_grows_with_the_turns(spark):
    def seconds(n):
        rows = spark.range(n).selectExpr("1L conv_id", "id turn", "IF(id % 3 = 0, 'user', 'assistant') role", "repeat('text ', 10) text")
        begin = time.perf_counter()
        assert chat.digests(chat.format_conversations(rows)).first().n_turns == n
        return time.perf_counter() - begin

    start_up = min(seconds(2) for _ in range(2))
    assert seconds(16_000) - start_up < 10


def test_spark_expressions_only(spark):
    plan = chat.digests(chat.format_conversations(spark.createDataFrame([], SCHEMA)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sql(spark, same_as_sql):
    same_as_sql(spark, "op6_chat_format")
