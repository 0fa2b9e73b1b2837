"""Chat formatting: every reply becomes an example of its own, with all earlier turns as context.

A turn is written `### role: text</turn>` and a line end. Inside roles and texts a backslash is written
as `\\b`, `#` as `\\h` and `<` as `\\l`, in roles also `:` as `\\c`. So no text can hold a control string or
a part of one that begins it, every backslash is followed by a letter that tells what stood there, and the
text can be read back. Lengths and spans count code points.

All of it is DataFrame functions. Turns of one conversation meet in one row, because an example holds
all of them anyway; the expansion itself is a sum over turns and grows with the square of the length of
a conversation, as the examples do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
REPLY = "assistant"
ESCAPES = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")]
ROLE_ESCAPE = (":", "\\c")


def _replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column) -> Column:
    return _replace(text, ESCAPES)


def escape_role(role: Column) -> Column:
    return _replace(escape(role), [ROLE_ESCAPE])


def unescape(text: Column) -> Column:
    """The text as it was; backslashes come last, so that none of them begins another escape."""
    return _replace(text, [(new, old) for old, new in [ROLE_ESCAPE, *reversed(ESCAPES)]])


def expand(turns: DataFrame, *, reply_role: str = REPLY) -> DataFrame:
    """One row per reply: conv_id, example (from 1), formatted, loss_start, loss_chars, is_last.

    Input columns are conv_id, turn, role and text; others are ignored. Turns are ordered by turn, role
    and text, nulls first, and null roles and texts are empty. Only the reply itself is trainable, not
    its end mark. A conversation that does not end with a reply gets a last row without a trainable
    span, so that no turn is lost. `is_last` marks the row that holds all turns. Rows without conv_id
    form one conversation.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = grouped.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(MIDDLE)).alias("head"),
                escape(t["text"]).alias("body"),
                (t["role"] == reply_role).alias("reply"),
            ),
        ).alias("parts"),
    ).select("conv_id", "parts", F.size("parts").alias("n"), F.element_at("parts", -1)["reply"].alias("ends_with_reply"))
    # Each reply, and the last turn in any case, ends an example.
    targets = F.filter(
        F.sequence(F.lit(1), F.col("n")), lambda i: F.element_at("parts", i)["reply"] | (i == F.col("n"))
    )
    exploded = parts.select("*", F.posexplode(targets).alias("position", "end"))
    own = F.element_at("parts", F.col("end"))
    written = F.transform(
        F.slice("parts", F.lit(1), F.col("end") - 1), lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))
    )
    context = exploded.select(
        "conv_id",
        (F.col("position") + 1).cast("long").alias("example"),
        F.array_join(written, "").alias("context"),
        own["head"].alias("head"),
        own["body"].alias("body"),
        own["reply"].alias("reply"),
        (F.col("end") == F.col("n")).alias("is_last"),
    )
    return context.select(
        "conv_id",
        "example",
        F.concat("context", "head", "body", F.lit(CLOSE)).alias("formatted"),
        F.when(F.col("reply"), F.length("context") + F.length("head")).cast("long").alias("loss_start"),
        F.when(F.col("reply"), F.length("body")).otherwise(F.lit(0)).cast("long").alias("loss_chars"),
        "is_last",
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples say: turns, trainable text and size.

    Roles and texts are taken from the written form by its control strings.
    """
    loss = F.when(
        F.col("loss_start").isNotNull(),
        unescape(F.expr("substring(formatted, cast(loss_start + 1 as int), cast(loss_chars as int))")),
    )
    pieces = examples.select(
        "conv_id",
        F.struct("example", loss.alias("loss")).alias("piece"),
        F.when(F.col("is_last"), F.col("formatted")).alias("whole"),
        F.length("formatted").cast("long").alias("chars"),
    )
    gathered = pieces.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("piece")).alias("pieces"),
        F.max("whole").alias("whole"),
        F.sum("chars").alias("formatted_chars"),
    )
    written = F.split("whole", CLOSE)
    turns = F.slice(written, F.lit(1), F.size(written) - 1)
    pattern = "(?s)^### ([^:]*): (.*)$"

    def said(turn: Column) -> Column:
        role, text = (F.regexp_extract(turn, pattern, i) for i in (1, 2))
        return F.concat(unescape(role), F.lit("\n"), unescape(text), F.lit("\n"))

    trained = F.array_join(F.transform("pieces", lambda p: p["loss"]), "")
    return gathered.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(turns, said), ""), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars",
    )
