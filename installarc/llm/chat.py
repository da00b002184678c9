"""Chat formatting: every participant's view of a dialogue. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    """Text that can't be taken for a marker: ``<|`` becomes ``<\\|``, and ``<\\`` becomes ``<\\\\`` so that it can be undone."""
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def perspectives(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    context_roles: Sequence[str] = ("system",),
    part_turns: int = 64,
) -> DataFrame:
    """Each dialogue once for each participant, who is the assistant in it.

    A participant is a role of the dialogue other than ``context_roles``. In a participant's view
    its own turns are the assistant's, those of context roles keep their role, all others are a
    user's with the speaker's name. Returns (conv_id, participant, part, piece, n_turns, text, spans, trained_chars):
    ``spans`` are the [start, end) characters of ``text`` to train on, which are the assistant's
    words with the end marker.

    Long dialogues continue in further rows: ``part`` is turn / ``part_turns`` rounded down, and ``piece``
    counts blocks of ``part_turns`` messages in it (over 0 only if turn numbers repeat), so no row holds more
    messages than that. Text joined in the order of part and piece is the whole dialogue.

    Messages of one turn are in order of role and text; repeated rows stay. A NULL turn comes last (part NULL), a NULL
    role speaks as the user ``unknown`` but is no participant, a NULL text is empty. NULL conv_id is one dialogue. A
    dialogue without participants, and an empty table, give no rows. Other columns are ignored.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    ).withColumn("part", F.floor(F.col("turn") / part_turns))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)))
    pieces = (
        numbered.withColumn("piece", F.floor((F.col("n") - 1) / part_turns))
        .groupBy("conv_id", "part", "piece")
        .agg(F.array_sort(F.collect_list(F.struct("n", "role", "text"))).alias("messages"))
    )
    speakers = (
        rows.filter(F.col("role").isNotNull() & ~F.col("role").isin(*context_roles))
        .groupBy(F.col("conv_id").alias("of"), F.col("role").alias("participant"))
        .agg(F.lit(1).alias("one"))
        .drop("one")
    )

    def rendered(m: Column) -> Column:
        name = F.regexp_replace(escaped(F.coalesce(m["role"], F.lit("unknown"))), "\\s+", "_")
        own = F.coalesce(m["role"] == F.col("participant"), F.lit(False))
        who = (
            F.when(own, "assistant")
            .when(m["role"].isin(*context_roles), name)
            .otherwise(F.concat(F.lit("user name="), name))
        )
        head = F.concat(F.lit(START), who, F.lit("\n"))
        body = F.concat(escaped(F.coalesce(m["text"], F.lit(""))), F.lit(END))
        return F.struct(own.alias("own"), head.alias("head"), body.alias("body"))

    def placed(state: Column, m: Column) -> Column:
        start = state["at"] + F.length(m["head"])
        end = start + F.length(m["body"])
        span = F.when(m["own"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        return F.struct((end + 1).alias("at"), F.concat(state["spans"], F.coalesce(span, _no_spans())).alias("spans"))

    return (
        pieces.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))
        .withColumn("shown", F.transform("messages", rendered))
        .select(
            "conv_id",
            "participant",
            "part",
            "piece",
            F.size("shown").alias("n_turns"),
            F.concat_ws("", F.transform("shown", lambda m: F.concat(m["head"], m["body"], F.lit("\n")))).alias("text"),
            F.aggregate("shown", F.struct(F.lit(0).alias("at"), _no_spans().alias("spans")), placed)["spans"].alias("spans"),
        )
        .withColumn("trained_chars", F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]))
    )


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,end:int>>")
