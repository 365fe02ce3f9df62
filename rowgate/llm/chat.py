"""Chat logs: cumulative snapshots collapsed, then rendered turn by turn.

A log that is written again with every turn holds conversations that are
prefixes of longer ones.  Each turn gets a rolling hash of the conversation up
to it, the exclusive-or of 128-bit hashes of (position, role, text), which is
the same for two conversations exactly when their turns so far are.  A
conversation whose whole hash occurs as a shorter prefix of another is dropped by
an anti-join; of equal conversations the one with the smallest id stays.

A conversation of any length is dealt with in blocks of ``BLOCK`` turn numbers:
positions and hashes run within a block, and the blocks' counts and hashes are
carried over, so one huge conversation doesn't end up in one task.  Hashes that
many conversations share are made distinct before they are shuffled.

Rows that repeat (same conv_id, turn, role and text) are one turn; turns with the
same number are ordered by role, then text; null roles and texts are empty; a null
turn comes first; rows without conv_id belong to no conversation and are left out.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowgate.session import run_dir

BLOCK = 1024


def _numbered(turns: DataFrame, block: int) -> DataFrame:
    """Turns with ``position`` from 0, ``h1``, ``h2`` up to and with the turn, and ``n_turns``."""
    rows = (
        turns.where(F.col("conv_id").isNotNull())
        .select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .distinct().withColumn("blk", F.floor(F.col("turn") / block))
    )
    key, of_conv = ["conv_id", "blk"], Window.partitionBy("conv_id").orderBy("blk")
    before = of_conv.rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    local = F.row_number().over(Window.partitionBy(*key).orderBy("turn", "role", "text")) - 1
    placed = rows.withColumn("local", local).join(counts, key).withColumn("position", F.col("base") + F.col("local"))
    hashed = placed.select(*key, "turn", "role", "text", "position", F.xxhash64("position", "role", "text").alias("x1"), F.xxhash64(F.lit("second"), "text", "role", "position").alias("x2"))
    xors = hashed.groupBy(*key).agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.count(F.lit(1)).alias("n"))
    carried = xors.select(*key, *[F.coalesce(F.bit_xor(b).over(before), F.lit(0)).alias(c) for b, c in (("b1", "c1"), ("b2", "c2"))], F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    so_far = Window.partitionBy(*key).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return (
        hashed.withColumns({"p1": F.bit_xor("x1").over(so_far), "p2": F.bit_xor("x2").over(so_far)}).join(carried, key)
        .select("conv_id", "turn", "position", "n_turns", "role", "text", F.col("p1").bitwiseXOR(F.col("c1")).alias("h1"), F.col("p2").bitwiseXOR(F.col("c2")).alias("h2"))
    )


def collapse(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Turns of maximal conversations: conv_id, turn, position, n_turns, role, text and
    ``copies``, the number of equal conversations that it stands for."""
    folder = run_dir(turns.sparkSession, "chat")
    _numbered(turns, block).write.parquet(f"{folder}/turns")
    have = turns.sparkSession.read.parquet(f"{folder}/turns")
    whole = have.where("position = n_turns - 1").groupBy("n_turns", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    shorter = have.where("position < n_turns - 1").select((F.col("position") + 1).alias("n_turns"), "h1", "h2").distinct()
    maximal = whole.join(shorter, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", "copies")
    return have.drop("h1", "h2").join(maximal, "conv_id")


def render(turns: DataFrame, begin: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """Turns with ``rendered``, the piece of the chat template that each is; a
    conversation's pieces in order of position are its rendering."""
    body = F.concat(F.lit(begin), F.col("role"), F.lit("\n"), F.trim("text"), F.lit(end), F.lit("\n"))
    return turns.withColumn("rendered", body)
