"""Chat formatting with a grammar round trip, with DataFrame functions only.

A conversation is rendered as START role \\n text END \\n for every turn. A deterministic parser
reads it back. A turn the parser does not return as it was is rendered again with its control
strings escaped; a conversation that still differs is escaped in full. The escapes are
reversible, so the result always reads back as the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: The escape character; 0 behind it stands for itself, 1 for "<" before "|", 2 for a line end in a role.
MARK = "␛"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit(MARK), F.lit(f"{MARK}0")), F.lit("<|"), F.lit(f"{MARK}1|"))
    return F.replace(out, F.lit("\n"), F.lit(f"{MARK}2")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit(f"{MARK}2"), F.lit("\n")) if role else text
    return F.replace(F.replace(out, F.lit(f"{MARK}1"), F.lit("<")), F.lit(f"{MARK}0"), F.lit(MARK))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def parse(rendered: Column) -> Column:
    """The turns (role, text) of a rendered conversation, in order.

    Grammar: a conversation is turns; a turn is START, a role up to the first line end, a text up
    to the first END, and a line end.
    """
    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        body = F.substring_index(piece.substr(F.length(head) + 2, F.length(piece)), END, 1)
        return F.struct(unescape(head, True).alias("role"), unescape(body).alias("text"))

    pieces = F.split(rendered, r"<\|im_start\|>", -1)
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def format_chats(
    chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    learn_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: conv_id, formatted, n_escaped, turns, loss_spans, identical.

    `turns` is what the parser reads back from `formatted`. `loss_spans` are the (start, length) in
    code points, counted from 0, of the texts of `learn_roles` inside `formatted`, without their
    template; learning is on nothing else. `identical` says that the parsed turns equal the source.

    Turns are ordered by turn, then role and text, null first, so ties and repeated rows have one
    result. A null role or text is empty. Rows without conversation id form one conversation with
    a null id. Other columns are ignored; an empty table gives an empty table. A conversation
    is one output value by definition, so its turns meet in one row.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = chats.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    same = lambda parsed: (F.size(parsed) == 1) & parsed[0]["role"].eqNullSafe(F.col("role")) & parsed[0]["text"].eqNullSafe(F.col("text"))
    rows = (
        rows.withColumn("plain", same(parse(render(F.col("role"), F.col("text")))))
        .withColumns({
            "safe_role": F.when(F.col("plain"), F.col("role")).otherwise(escape(F.col("role"), True)),
            "safe_text": F.when(F.col("plain"), F.col("text")).otherwise(escape(F.col("text"))),
        })
    )
    source = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    convs = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "safe_role", "safe_text", "plain"))).alias("t"))
    convs = convs.withColumn("first", F.array_join(F.transform("t", lambda t: render(t["safe_role"], t["safe_text"])), ""))
    convs = convs.withColumn("whole", parse(F.col("first")) == F.transform("t", source))
    convs = convs.withColumn("parts", F.transform("t", lambda t: F.struct(
        F.when(F.col("whole"), t["safe_role"]).otherwise(escape(t["role"], True)).alias("role"),
        F.when(F.col("whole"), t["safe_text"]).otherwise(escape(t["text"])).alias("text"),
        t["role"].isin(*learn_roles).alias("learn"),
        F.when(F.col("whole"), ~t["plain"]).otherwise(F.lit(True)).alias("escaped"),
    )))
    convs = convs.withColumn("formatted", F.array_join(F.transform("parts", lambda t: render(t["role"], t["text"])), ""))
    head = lambda t: F.length(t["role"]) + F.lit(len(START) + 1)
    spans = F.aggregate(
        "parts", F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + head(t) + F.length(t["text"]) + F.lit(len(END) + 1)).alias("at"),
            F.when(t["learn"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + head(t)).cast("long").alias("start"), F.length(t["text"]).cast("long").alias("length")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    convs = convs.withColumns({"loss_spans": spans, "turns": parse(F.col("formatted"))})
    return convs.select(
        "conv_id", "formatted", F.size(F.filter("parts", lambda t: t["escaped"])).alias("n_escaped"), "turns", "loss_spans",
        (F.col("turns") == F.transform("t", source)).alias("identical"))
