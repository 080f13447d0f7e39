"""Chat formatting with Spark expressions only.

The turns of a conversation are sorted; where the role changes a run begins.  The
turns of a run are collected as sorted structs and merged by array functions, then the
runs are concatenated.  Borders and offsets come from a window in turn order, so the
work is linear in the turns; window and both groupings share one exchange.  A run is
``<s>[INST]role[/INST]`` + its texts, joined by
``[SEP]``, + ``</s>``.  Control strings inside roles and texts are escaped: a
backslash goes behind their first character, and one more where there are
backslashes already, so :func:`unescaped` gives back every text exactly.

The loss mask is an array of (start, length) spans over the formatted text, in
code points; each assistant text has one span of its own, so none of the marks
between merged turns is under the mask.

:func:`read_back` recovers the turns and the masked texts from the formatted text
and its mask alone.

Null text and null role count as empty.  Turns are ordered by turn, null first,
then role, then text; repeated rows stay.  Rows with a null conv_id form one
conversation.  Other columns are ignored, whatever their names; no rows give no rows.
A conversation is one row of the result, as that is what the result is: its formatted
text must fit in a row (2 GB), and its turns in a task (they are sorted with spill,
then held once as arrays).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks of the template.
OPEN, ROLE, TEXT, NEXT, CLOSE = "<s>", "[INST]", "[/INST]", "[SEP]", "</s>"
LEARNED = "assistant"
SPANS = "array<struct<start:bigint,length:bigint>>"
#: Code points of a piece in which spans are looked up.
PIECE = 4096
#: First character of a mark, backslashes that stand behind it, and the rest of the mark.
MARKS = r"(/?s>|/?INST\]|SEP\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + MARKS, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + MARKS, r"$1$2$3")


def placed_turns(rows: DataFrame) -> DataFrame:
    """Each turn with its place ``n``, its run of adjacent turns of one role, its escaped text and where that starts in the formatted text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.select("*", F.row_number().over(order).alias("n"), F.lag("role").over(order).alias("before"))
    fresh = F.col("before").isNull() | (F.col("before") != F.col("role"))
    opening = F.concat(F.when(F.col("n") > 1, CLOSE).otherwise(""), F.lit(OPEN + ROLE), escaped(F.col("role")), F.lit(TEXT))
    turns = turns.withColumn("said", escaped(F.col("text"))).withColumn("length", F.length("said").cast("long")).withColumn(
        "ahead", F.length(F.when(fresh, opening).otherwise(NEXT)).cast("long"))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return turns.select("conv_id", "n", "role", "said", "length", F.sum(F.when(fresh, 1).otherwise(0)).over(so_far).alias("run"),
                        (F.sum(F.col("ahead") + F.col("length")).over(so_far) - F.col("length")).alias("start"))


def merged_runs(placed: DataFrame) -> DataFrame:
    """``conv_id, run``: the turns of a run collected, sorted and merged into one formatted ``text``, with the ``spans`` to learn."""
    turn = F.struct("n", "role", "said", "start", "length")
    runs = placed.select("conv_id", "run", turn.alias("one")).groupBy("conv_id", "run").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    role = F.get("turns", F.lit(0))["role"]
    text = F.concat(F.lit(OPEN + ROLE), escaped(role), F.lit(TEXT), F.concat_ws(NEXT, F.col("turns.said")), F.lit(CLOSE))
    spans = F.transform("turns", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    return runs.select("conv_id", "run", text.alias("text"), F.when(role == LEARNED, spans).otherwise(F.array().cast(SPANS)).alias("spans"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_mask``."""
    runs = merged_runs(placed_turns(rows)).select("conv_id", F.struct("run", "text", "spans").alias("one"))
    return (runs.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("runs"))
            .select("conv_id", F.concat_ws("", F.col("runs.text")).alias("formatted"), F.flatten("runs.spans").alias("loss_mask")))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often a lambda inside ``use`` is called."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns`` (array of role and text) and ``learned`` (the text under the mask, unescaped)."""
    quoted = {m: rf"\Q{m}\E" for m in (TEXT, NEXT, CLOSE)}
    runs = F.filter(F.split("formatted", quoted[CLOSE]), lambda r: r != "")

    def of_run(run: Column) -> Column:
        halves = F.split(F.substr(run, F.lit(len(OPEN + ROLE) + 1)), quoted[TEXT], 2)
        return once(halves, lambda h: once(unescaped(h[0]), lambda role: F.transform(
            F.split(h[1], quoted[NEXT]), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))))

    # a place in UTF-8 is found by counting from the start, so spans are cut from pieces of PIECE code points
    size = F.lit(PIECE)
    pieces = F.transform(F.sequence(F.lit(0), F.expr(f"length(formatted) div {PIECE}").cast("int")), lambda i: F.substr("formatted", i * size + 1, size))

    def cut(of: Column, m: Column) -> Column:
        first = F.floor(m["start"] / size).cast("int")
        many = F.floor((m["start"] + m["length"]) / size).cast("int") - first + 1
        return unescaped(F.substr(F.concat_ws("", F.slice(of, first + 1, many)), (m["start"] % size + 1).cast("int"), m["length"].cast("int")))

    masked = once(pieces, lambda of: F.transform("loss_mask", lambda m: cut(of, m)))
    return formatted.select("conv_id", F.flatten(F.transform(runs, of_run)).alias("turns"), F.concat_ws("", masked).alias("learned"), "formatted")


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what :func:`read_back` finds."""
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
