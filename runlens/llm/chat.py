"""Chat formatting: the turns of a conversation as one text with a loss mask.

Turn structs are collected and sorted by turn, adjacent turns of one role are
merged into a block by array aggregation, and blocks are concatenated:

    <|im_start|>role NEWLINE text {<|im_sep|>text} <|im_end|> NEWLINE

Merged turns stay apart by a separator, so every turn can be read back.
Control strings inside texts (these three, ``<s>``, ``</s>``, ``[INST]``,
``[/INST]``, ``<<SYS>>``, ``<</SYS>>``) are escaped: a backslash is doubled,
then the bracket that opens a control string becomes backslash l or backslash
b. The loss mask is a list of spans, by characters and by UTF-8 bytes, one for
each text of a trained role; marks are never under it.

Spark expressions only. Rows are collected by conversation after a partial
aggregation; the output is one text a conversation, so a conversation must fit
into a row.

Defined cases: a null text or role is empty; a null conversation id is a
conversation of its own; turns with equal numbers go by role, then text, null
turn numbers first; repeated rows are turns of their own; an empty table gives
an empty one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
ANGLE = r"<(/?s>|/?SYS>>|\|)"      # what follows the bracket of a control string
SQUARE = r"\[(/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    angle = F.regexp_replace(doubled, ANGLE, r"\\l$1")
    return F.regexp_replace(angle, SQUARE, r"\\b$1")


def unescape(text: Column) -> Column:
    def plain(part: Column) -> Column:
        angle = F.replace(part, F.lit("\\l"), F.lit("<"))
        return F.replace(angle, F.lit("\\b"), F.lit("["))

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return unescape(F.array_join(plain, "\\\\"))


def blocks_of(turns: Column) -> Column:
    """array<struct<role, texts>>: adjacent turns of one role merged."""
    kind = "array<struct<role:string,texts:array<string>>>"

    def add(done: Column, turn: Column) -> Column:
        last = F.element_at(done, -1)
        merged = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        single = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        same = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["role"] == turn["role"])
        return F.when(same, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(merged))) \
            .otherwise(F.concat(done, F.array(single)))

    return F.aggregate(turns, F.array().cast(kind), add)


def pieces_of(blocks: Column, trained: Sequence[str]) -> Column:
    """array<struct<s, loss>> whose texts, joined, are the formatted text."""

    def block(b: Column) -> Column:
        head = F.concat(F.lit(START), escape_role(b["role"]), F.lit("\n"))
        loss = b["role"].isin(list(trained))
        body = F.flatten(F.transform(b["texts"], lambda t, i: F.array(
            F.struct(F.when(i == 0, head).otherwise(F.lit(SEP)).alias("s"), F.lit(False).alias("loss")),
            F.struct(escape(t).alias("s"), loss.alias("loss")))))
        return F.concat(body, F.array(F.struct(F.lit(END).alias("s"), F.lit(False).alias("loss"))))

    return F.flatten(F.transform(blocks, block))


def spans_of(pieces: Column) -> Column:
    """array<struct<start, length, start_byte, bytes>> of the pieces under the mask."""
    span = "struct<start:bigint,length:bigint,start_byte:bigint,bytes:bigint>"
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("byte"),
                    F.array().cast(f"array<{span}>").alias("spans"))

    def add(done: Column, p: Column) -> Column:
        n, b = F.length(p["s"]).cast("long"), F.octet_length(p["s"]).cast("long")
        one = F.struct(done["at"].alias("start"), n.alias("length"), done["byte"].alias("start_byte"), b.alias("bytes"))
        return F.struct((done["at"] + n).alias("at"), (done["byte"] + b).alias("byte"),
                        F.when(p["loss"], F.concat(done["spans"], F.array(one))).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(pieces, zero, add, lambda done: done["spans"])


def formatted(rows: DataFrame, trained: Sequence[str] = ("assistant",), conv_col: str = "conv_id",
              turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id``, ``formatted``, ``loss`` (spans), one row a conversation."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    turns = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return (turns.select("conv_id", pieces_of(blocks_of(F.col("turns")), trained).alias("pieces"))
            .select("conv_id", F.array_join(F.col("pieces.s"), "").alias("formatted"),
                    spans_of(F.col("pieces")).alias("loss")))


def read_back(formatted_col: Column) -> Column:
    """array<struct<role, text>>: all turns of a formatted text."""

    def block(b: Column) -> Column:
        inner = F.substring(b, F.lit(1), F.length(b) - len(END))
        role = F.substring_index(inner, "\n", 1)
        body = F.substring(inner, F.length(role) + 2, F.length(inner))
        return F.transform(F.split(body, r"<\|im_sep\|>", -1),
                           lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")))

    blocks = F.split(formatted_col, r"<\|im_start\|>", -1)
    return F.flatten(F.transform(F.slice(blocks, F.lit(2), F.size(blocks)), block))


def under_loss(formatted_col: Column, loss: Column) -> Column:
    """All text under the mask, unescaped, nothing between the spans."""
    raw = formatted_col.cast("binary")
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(raw, (s["start_byte"] + 1).cast("int"), s["bytes"].cast("int")).cast("string"))), "")
