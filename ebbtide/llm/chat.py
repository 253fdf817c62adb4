"""Logged conversations: prefixes of longer ones go, the rest is rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ebbtide.llm.common import materialise, table

# The turn marks of the rendered text. A mark inside a turn is broken up.
OPEN, CLOSE, BROKEN = "<|im_start|>", "<|im_end|>", "<| im_"


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|im_"), F.lit(BROKEN))


def _said(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(role), F.lit("\n"), _safe(text), F.lit(CLOSE + "\n"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """Maximal conversations of ``turns`` (conv_id, turn, role, text), rendered.

    A log holds a conversation again after each turn. Every prefix of a conversation gets a
    rolling hash of its turns; a conversation whose whole hash is a proper prefix of another is
    a snapshot and goes, and of equal ones the smallest conv_id stays. One row per maximal
    conversation: conv_id, n_turns, n_copies (equal ones, itself included), rendered.

    Rows that repeat in all four columns count once; turns with one number are ordered by role and text; null
    roles and texts are empty; turns with a null number come first. A turn with a null conv_id is a
    conversation of its own, with that one turn; where only such are equal, conv_id is null. Other
    columns are ignored.
    """
    clean = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).distinct()
    # What tells apart the turns without a conversation; null for all others.
    clean = clean.withColumn("alone", F.when(F.col("conv_id").isNull(), F.struct("turn", "role", "text")))
    order = Window.partitionBy("conv_id", "alone").orderBy("turn", "role", "text")
    rolling = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = clean.withColumn("n", F.row_number().over(order)).withColumn("last_", F.lead(F.lit(False), 1, True).over(order))
    # Each turn is hashed with its place, so the hash of a prefix is the xor over its turns.
    rolled = [F.bit_xor(F.xxhash64(F.lit(seed), "n", "role", "text")).over(rolling).alias(f"h{seed}") for seed in (1, 2)]
    hashes = materialise(placed.select("conv_id", "alone", "n", "last_", *rolled))
    first = F.min(F.struct(F.col("conv_id").isNull().alias("unnamed"), "conv_id", "alone")).alias("first")
    whole = hashes.where("last_").groupBy("n", "h1", "h2").agg(first, F.count(F.lit(1)).alias("n_copies"))
    prefixes = hashes.where("NOT last_").select("n", "h1", "h2").distinct()
    kept = whole.join(prefixes, ["n", "h1", "h2"], "left_anti")
    kept = materialise(kept.select("first.conv_id", "first.alone", F.col("n").cast("long").alias("n_turns"), "n_copies"))

    named = kept.where("conv_id IS NOT NULL").select("conv_id", "n_turns", "n_copies")
    of_kept = clean.drop("alone").join(named.select("conv_id"), "conv_id", "left_semi")
    said = _said(F.col("role"), F.col("text")).alias("said")
    listed = of_kept.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", said))).alias("turns_"))
    rendered = listed.select("conv_id", F.array_join(F.col("turns_.said"), "").alias("rendered"))
    unnamed = kept.where("conv_id IS NULL").select("conv_id", "n_turns", "n_copies", _said(F.col("alone.role"), F.col("alone.text")).alias("rendered"))
    return named.join(rendered, "conv_id").unionByName(unnamed)


def op9_maximal_conversations(spark, folder: str) -> DataFrame:
    """All logged conversations, without those that a longer one begins with."""
    return maximal_conversations(table(spark, folder, "conversations"))


OP9_SQL = """
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), clean AS (
    SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER (ORDER BY turn, role, text) ELSE 0 END AS alone FROM turns
), placed AS (
    SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id, alone) AS k
    FROM clean WINDOW w AS (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text)
), prefixes AS (
    SELECT conv_id, alone, n, k, string_agg(md5(role || chr(1) || text), '' ORDER BY n) OVER (
        PARTITION BY conv_id, alone ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS said
    FROM placed
), whole AS (
    SELECT said, n, min(conv_id) AS conv_id, CASE WHEN min(conv_id) IS NULL THEN min(alone) ELSE 0 END AS alone, count(*) AS n_copies
    FROM prefixes WHERE n = k GROUP BY said, n
), kept AS (
    SELECT * FROM whole w WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.n < p.k AND p.n = w.n AND p.said = w.said)
)
SELECT kept.conv_id, kept.n AS n_turns, kept.n_copies, string_agg(
    '<|im_start|>' || replace(role, '<|im_', '<| im_') || chr(10) || replace(text, '<|im_', '<| im_') || '<|im_end|>' || chr(10), '' ORDER BY placed.n) AS rendered
FROM kept JOIN placed ON kept.conv_id IS NOT DISTINCT FROM placed.conv_id AND kept.alone = placed.alone
GROUP BY kept.conv_id, kept.alone, kept.n, kept.n_copies
"""
