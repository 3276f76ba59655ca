"""Chat formatting with typed content parts.

A turn is a list of parts. The visitor turns text parts into escaped text and
image, audio and document parts into placeholders, in order; the n-th
placeholder of a conversation belongs to its n-th attachment record, which
keeps the reference and the number of tokens the placeholder stands for. Turns
become ``START role SEP content END``. In texts and roles every ``<``, ``[``
and backslash is followed by a backslash, so no control string, neither of
this template nor of others in use, can occur in them, and the original comes
back by dropping those backslashes. Assistant content is under the loss mask.

Defined cases: a NULL text or role is empty; a NULL turn number comes last;
rows with the same turn number are ordered by role, then content; repeated
rows are turns of their own; a NULL conversation id is one conversation; other
columns are ignored. A conversation is one output string, so it has to fit
into memory; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Placeholders by part type, and the tokens one stands for if the part does not say.
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
TOKENS = {"image": 256, "audio": 128, "document": 512}
TRAINED_ROLE = "assistant"

PART = "struct<type: string, text: string, ref: string, tokens: bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    none = F.lit(None)
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), none.cast("string").alias("ref"), none.cast("bigint").alias("tokens"))
    return F.array(part)


def _by_type(part: Column, values: dict, other: Column) -> Column:
    out = other
    for kind, value in values.items():
        out = F.when(part["type"] == kind, F.lit(value)).otherwise(out)
    return out


def visit(parts: Column) -> tuple[Column, Column]:
    """(content, attachments) of a list of parts; a part of an unknown type is read as text."""
    shown = F.transform(parts, lambda p: _by_type(p, PLACEHOLDERS, escape(F.coalesce(p["text"], F.lit("")))))
    held = F.filter(parts, lambda p: F.coalesce(p["type"].isin(list(PLACEHOLDERS)), F.lit(False)))
    records = F.transform(
        held,
        lambda p: F.struct(
            p["type"].alias("type"),
            p["ref"].alias("ref"),
            F.coalesce(p["tokens"], _by_type(p, TOKENS, F.lit(0)).cast("bigint")).alias("tokens"),
        ),
    )
    return F.array_join(shown, "", ""), records


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation from turns (conv_id, turn, role, parts).

    conv_id, formatted, loss (array of (start, end) in code points, end
    exclusive), attachments (in the order of their placeholders), tokens (sum
    of what the placeholders stand for).
    """
    content, records = visit(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")))
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select(
        "conv_id", F.col("turn").isNull().alias("none"), "turn", role.alias("role"),
        F.concat(F.lit(START), escape(role), F.lit(SEP)).alias("head"), content.alias("content"), records.alias("records"),
    )
    piece = F.concat("head", "content", F.lit(END))
    order = Window.partitionBy("conv_id").orderBy("none", "turn", "role", "content")
    rows = rows.select(
        "conv_id", F.row_number().over(order).alias("at"), piece.alias("piece"), "records", F.length("head").alias("lead"),
        F.length("content").alias("size"), (F.col("role") == TRAINED_ROLE).alias("trained"),
        (F.sum(F.length(piece)).over(order) - F.length(piece)).alias("start"),
    )
    begin = F.col("start") + F.col("lead")
    rows = rows.withColumn(
        "loss", F.when(F.col("trained"), F.struct(begin.alias("start"), (begin + F.col("size")).alias("end")))
    )
    turns_ = F.sort_array(F.collect_list(F.struct("at", "piece", "records", "loss")))
    out = rows.groupBy("conv_id").agg(turns_.alias("t"))
    out = out.select(
        "conv_id",
        F.array_join(F.col("t.piece"), "").alias("formatted"),
        F.filter("t.loss", lambda x: x.isNotNull()).alias("loss"),
        F.flatten("t.records").alias("attachments"),
    )
    return out.withColumn("tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda a, r: a + r["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role and text) and loss_text (array), parsed from the formatted strings alone."""
    quoted = {m: m.replace("|", r"\|") for m in (START, SEP, END)}
    pieces = F.split(F.substr("formatted", F.lit(len(START) + 1)), quoted[START])
    pair = lambda p: F.split(F.regexp_replace(p, f"{quoted[END]}$", ""), quoted[SEP])
    turn = lambda x: F.struct(unescape(x[0]).alias("role"), unescape(x[1]).alias("text"))
    masked = F.transform(
        "loss", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    rows = formatted.withColumn("_pairs", F.transform(pieces, pair))
    return rows.select("conv_id", "formatted", F.transform("_pairs", turn).alias("turns"), masked.alias("loss_text"))


def digests(back: DataFrame) -> DataFrame:
    """The digest columns of what ``read_back`` returns."""
    whole = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    lost = F.array_join("loss_text", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(whole, ""), 256).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
