"""Contiguous shards of equal size from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ebbtide.llm.common import materialise, table


def contiguous_shards(rows: DataFrame, order: list[Column], size: Column, shards: int = 8) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (place in the shard, from 0).

    Rows are ordered by ``order`` and cut where the running size passes equal shares of the
    total; a row goes to the shard that holds its middle, so a shard is off its share by at
    most one row at either end. Ties in ``order`` are broken by the input position, which also
    spreads a key with very many rows over several partitions. The ordered partitions are
    written before they are counted; a null size counts as 0. Columns named ``shard`` or
    ``slot`` are replaced. An empty table gives an empty table.
    """
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in ("shard", "slot")]
    named = rows.select(
        F.struct(*kept).alias("row_"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size_"),
        F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.monotonically_increasing_id().alias("tie")).alias("key_"),
    )
    ranged = named.repartitionByRange("key_").sortWithinPartitions("key_")
    # The high bits of the number are the partition, the low 33 the place in it.
    numbered = ranged.select("row_", "size_", F.monotonically_increasing_id().alias("id_"))
    place = numbered.select("row_", "size_", F.shiftright("id_", 33).alias("part_"), F.col("id_").bitwiseAND((1 << 33) - 1).alias("at_"))
    written = materialise(place)
    earlier = Window.partitionBy("part_").orderBy("at_").rowsBetween(Window.unboundedPreceding, -1)
    placed = written.withColumn("before_", F.coalesce(F.sum("size_").over(earlier), F.lit(0)))

    # One row per partition: where it starts in the whole table.
    ahead = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    parts = written.groupBy("part_").agg(F.sum("size_").alias("bytes_"), F.count(F.lit(1)).alias("rows_"))
    starts = parts.select(
        "part_",
        F.coalesce(F.sum("bytes_").over(ahead), F.lit(0)).alias("bytes_ahead_"),
        F.coalesce(F.sum("rows_").over(ahead), F.lit(0)).alias("rows_ahead_"),
        F.sum("bytes_").over(Window.partitionBy()).alias("total_"),
    )
    # As many rows as the ordering had partitions: bounded by the session, not by the table.
    there = placed.join(F.broadcast(starts), "part_")
    middle = 2 * (F.col("bytes_ahead_") + F.col("before_")) + F.col("size_")
    cut = there.select(
        "row_",
        F.least(F.floor(middle * shards / F.greatest(2 * F.col("total_"), F.lit(1))), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("rows_ahead_") + F.col("at_")).alias("n_"),
    )
    first = cut.groupBy("shard").agg(F.min("n_").alias("first_"))
    return cut.join(F.broadcast(first), "shard").select("row_.*", "shard", (F.col("n_") - F.col("first_")).alias("slot"))


def op8_contiguous_shards(spark, folder: str) -> DataFrame:
    """All documents in ascending doc_id order, cut into 8 shards of near equal bytes."""
    text = F.coalesce("text", F.lit(""))
    light = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = contiguous_shards(light, [F.col("doc_id"), F.col("text_crc32")], F.col("size"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
