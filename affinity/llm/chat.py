"""Multi-party perspective rotation of dialogues (DataFrame functions only).

For every participant of a conversation the dialogue is rendered once with
that speaker as ``assistant`` and every other speaker as a named ``user``;
only the assistant's contents are trained on.  One row per conversation,
perspective and turn carries the rendered piece and its byte range, so a very
long conversation is never gathered into one row: byte offsets come from sums
over blocks of turns (one small table) plus a running sum inside a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SYSTEM = "system"
UNKNOWN = "unknown"
#: Turns per block of the offset sums.
BLOCK_TURNS = 256


def _nbytes(c: Column) -> Column:
    return F.octet_length(c).cast("long")


def rotate(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, perspective, turn, speaker, role, name, content, rendered,
    start_byte, end_byte, train_start, train_end, train).

    Input columns: conv_id, turn, role, text; others are ignored.  The
    speaker is the row's role; a null or blank role is speaker ``unknown``.  ``system``
    rows belong to no participant and keep the role ``system``; a
    conversation of system rows only has no perspective and gives no row.
    Null text is empty.  Turns are ordered by (turn, speaker, text), nulls
    first; repeated rows are kept, each with its own range.  Rows whose
    conversation id is null form one conversation.
    """
    m = conversations.select(
        "conv_id", "turn",
        F.coalesce(F.nullif(F.trim("role"), F.lit("")), F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("content"))
    # written once: both sides of the join are then plain exchanges that
    # adaptive execution can split where one conversation holds very many rows
    people = saved(m.where(F.col("speaker") != SYSTEM)
                   .select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective"))
                   .distinct(), "chat_people")
    own = F.col("speaker") == F.col("perspective")
    role = (F.when(F.col("speaker") == SYSTEM, F.lit(SYSTEM))
            .when(own, F.lit("assistant")).otherwise(F.lit("user")))
    header = F.concat(F.lit("<|"), F.col("role"),
                      F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")), F.lit("|>\n"))
    r = (m.join(people, F.col("conv_id").eqNullSafe(F.col("c")))
         .select("conv_id", "perspective", "turn", "speaker", "content", role.alias("role"),
                 F.when(role == "user", F.col("speaker")).alias("name"),
                 F.floor(F.coalesce(F.col("turn"), F.lit(0)) / block_turns).cast("long").alias("block"))
         .withColumn("header", header)
         .withColumn("rendered", F.concat("header", "content", F.lit("<|end|>\n"))))
    keys = ["conv_id", "perspective"]
    sums = r.groupBy(*keys, "block").agg(F.sum(_nbytes(F.col("rendered"))).alias("total"))
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = saved(sums.select(F.col("conv_id").alias("bc"), F.col("perspective").alias("bp"),
                             F.col("block").alias("bb"),
                             F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")), "chat_base")
    inside = (Window.partitionBy(*keys, "block").orderBy("turn", "speaker", "content")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (r.join(base, F.col("conv_id").eqNullSafe(F.col("bc")) & (F.col("perspective") == F.col("bp"))
                  & (F.col("block") == F.col("bb")))
           .withColumn("end_byte", F.col("base") + F.sum(_nbytes(F.col("rendered"))).over(inside))
           .withColumn("start_byte", F.col("end_byte") - _nbytes(F.col("rendered"))))
    train = F.col("role") == "assistant"
    first = F.col("start_byte") + _nbytes(F.col("header"))
    return out.select(
        "conv_id", "perspective", "turn", "speaker", "role", "name", "content", "rendered",
        "start_byte", "end_byte",
        F.when(train, first).alias("train_start"),
        F.when(train, first + _nbytes(F.col("content"))).alias("train_end"),
        train.alias("train"))
