"""Contiguous shards of nearly equal bytes.

Rows are put in key order by a range partitioning of three narrow columns; the texts
are measured where they are read and never shuffled.  Each range is summed, the sums
become prefix totals, and the total is cut at equal targets: a row belongs to the
shard in whose stretch of bytes it starts.  A shard is therefore at most one row
larger or smaller than its share.

Defined results: a null text counts as empty; rows with a null key come first; equal
keys are ordered by checksum, size and place of reading, so repeated rows stay side by
side; an empty table gives no rows; with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.frames import named, shuffle_width
from keelson.session import materialize


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32``: UTF-8 bytes plus one for the separator, and a checksum."""
    body = F.coalesce(F.col("body"), F.lit("")).cast("binary")
    return docs.select(*named(key=key, body=text)).select(
        "key", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))


def byte_shards(rows: DataFrame, shards: int, ranges: int | None = None) -> DataFrame:
    """Adds ``shard``, ``slot`` (place in the shard) and ``start`` (bytes before) to ``key, size, ...``.

    ``ranges`` is the number of range partitions, by default that of shuffles.
    """
    spark = rows.sparkSession
    order = ["key", "text_crc32", "size", "read_at"]
    placed = materialize(
        rows.withColumn("read_at", F.monotonically_increasing_id())
        .repartitionByRange(ranges or shuffle_width(spark), *order)
        .withColumn("range", F.spark_partition_id()), "ranges")
    # One row per range: their number is the number of partitions, whatever the input.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    totals = totals.select(
        "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"))
    within = Window.partitionBy("range").orderBy(*order)
    running = placed.select(
        "*", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.row_number().over(within).alias("nth"))
    numbered = running.join(F.broadcast(totals), "range").select(
        "key", "size", "text_crc32", (F.col("bytes_before") + F.col("upto") - F.col("size")).alias("start"),
        (F.col("rows_before") + F.col("nth") - 1).alias("row"), "all_bytes")
    numbered = numbered.withColumn(
        "shard", F.expr(f"cast(cast(start as decimal(20, 0)) * {int(shards)} div all_bytes as int)"))
    firsts = numbered.groupBy("shard").agg(F.min("row").alias("first_row"))  # one row per shard
    return numbered.join(F.broadcast(firsts), "shard").select(
        "key", "size", "text_crc32", "start", "shard", (F.col("row") - F.col("first_row")).alias("slot"))
