"""Chat formatting: one rendering of a dialogue per participant.

For every participant the dialogue is rendered with that speaker as the
assistant and all others as named users; only the assistant's words count for
the loss. The result has one row per turn and perspective, with its place in
the rendered dialogue, so that a dialogue of any length is never gathered in
one task. Joining the segments of a (dialogue, perspective) in order of
`start` gives the whole text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.keyed import skew_join

NARRATORS = ("system",)
TURNS_PER_PIECE = 256


def _escaped(text: Column) -> Column:
    """Marks inside a text or name are broken up, so that a text can't end its own turn."""
    return F.replace(text, F.lit("<|im_"), F.lit("<| im_"))


def rotate(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    narrators: Sequence[str] = NARRATORS,
) -> DataFrame:
    """conv, perspective, turn, speaker, segment, start, end, loss_start, loss_end.

    start and end are code points in the rendered dialogue; loss_start and
    loss_end span the assistant's text with its end mark (both equal to end
    elsewhere). Narrators are rendered as system turns and are never a
    perspective; a dialogue with narrators only gives no rows. A null speaker is the
    participant "unknown", a null text is empty, a null turn comes first; turns
    with one number go by speaker and text. Repeated rows stay repeated, a null
    dialogue id is an id. Other columns are not read.
    """
    words = turns.select(
        F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("_conv"),
        F.col(conv).alias("_id"),
        F.col(turn).cast("long").alias("_turn"),
        F.coalesce(F.col(speaker), F.lit("unknown")).alias("_speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    null_key = F.col("_id").isNull().cast("int").alias("_null")
    words = words.withColumn("_null", null_key)
    people = words.where(~F.col("_speaker").isin(*narrators)).select("_conv", "_null", F.col("_speaker").alias("_as")).distinct()
    rows = skew_join(words, people, ["_conv", "_null"], "inner")
    own = F.col("_speaker") == F.col("_as")
    name = _escaped(F.replace(F.col("_speaker"), F.lit("\n"), F.lit(" ")))
    head = (
        F.when(own, F.lit("<|im_start|>assistant\n"))
        .when(F.col("_speaker").isin(*narrators), F.lit("<|im_start|>system\n"))
        .otherwise(F.concat(F.lit("<|im_start|>user name="), name, F.lit("\n")))
    )
    body = F.concat(_escaped(F.col("_text")), F.lit("<|im_end|>"))
    rows = rows.withColumns({"_head": head, "_body": body, "_own": own})
    rows = rows.withColumn("_len", (F.length("_head") + F.length("_body") + 1).cast("long"))
    rows = rows.withColumn("_piece", F.coalesce(F.floor(F.col("_turn") / TURNS_PER_PIECE), F.lit(-(2**62))))

    key = ["_conv", "_null", "_as"]
    sizes = rows.groupBy(*key, "_piece").agg(F.sum("_len").alias("_sum"))
    before = Window.partitionBy(*key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*key, "_piece", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"))
    order = [F.col("_turn").asc_nulls_first(), "_speaker", "_text"]
    inside = Window.partitionBy(*key, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_inside", F.sum("_len").over(inside)).join(sizes, [*key, "_piece"])
    end = F.col("_shift") + F.col("_inside")
    start = end - F.col("_len")
    return rows.select(
        F.col("_id").alias("conv_id"),
        F.col("_as").alias("perspective"),
        F.col("_turn").alias("turn"),
        F.col("_speaker").alias("speaker"),
        F.concat("_head", "_body", F.lit("\n")).alias("segment"),
        start.alias("start"),
        end.alias("end"),
        F.when(F.col("_own"), start + F.length("_head")).otherwise(end).alias("loss_start"),
        F.when(F.col("_own"), end - 1).otherwise(end).alias("loss_end"),
    )
