"""Sharding by global byte-size prefix sums: per-partition totals, then cuts at equal targets.

Order: (md5 of the text, size, id), so equal texts stand side by side. Rows are range-partitioned in that order, each
partition's bytes and rows are totalled, the few totals are summed up to offsets, and a running sum inside each
partition gives every row its global byte offset. A row belongs to the shard in whose equal byte range it starts.
Equal texts follow one another, and a cut goes through a group of them as through any other rows, so the sizes hold
however large a group is.

Only DataFrame functions; nothing is collected. Broadcast sides hold a row for each partition or shard.

Defined cases: a null text has no bytes and CRC 0, like the empty text, and shares its group; ties (repeated rows)
are interchangeable; an empty table gives no rows; a row larger than a shard (a very long text) leaves the shards it
covers empty; extra columns are kept, but columns named ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomewright.llm.common import discard, materialize, read, shuffle_partitions

SHARDS = 8
_KEY = ["__tw_key", "__tw_size"]


def shard_by_bytes(rows: DataFrame, key: str, size: str, order: str, *, shards: int = SHARDS) -> DataFrame:
    """rows with ``shard`` (0 to shards - 1) and ``slot`` (place in its shard, gapless from 0).

    key: what equal rows share (a digest of the text), size: its bytes, order: a tie-break inside a group."""
    spark = rows.sparkSession
    own = [c for c in rows.columns if c not in ("shard", "slot")]
    parts = shuffle_partitions(spark)
    narrow = rows.withColumns({"__tw_key": F.col(key), "__tw_size": F.col(size).cast("long"), "__tw_order": F.col(order)})
    sort = [*_KEY, "__tw_order"]
    sizes = materialize(narrow, "sizes")
    dealt = materialize(sizes.repartitionByRange(parts, *sort).withColumn("__tw_part", F.spark_partition_id()), "dealt")
    totals = dealt.groupBy("__tw_part").agg(F.sum("__tw_size").alias("b"), F.count("*").alias("n"))
    before = Window.orderBy("__tw_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each partition
    offsets = totals.select(
        "__tw_part",
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("__tw_b"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__tw_n"),
        F.sum("b").over(Window.partitionBy()).alias("__tw_total"),
    )
    inside = Window.partitionBy("__tw_part").orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        dealt.withColumns({"__tw_run": F.sum("__tw_size").over(inside), "__tw_row": F.row_number().over(inside)})
        .join(F.broadcast(offsets), "__tw_part")
        .withColumns({"__tw_start": F.col("__tw_b") + F.col("__tw_run") - F.col("__tw_size"), "__tw_at": F.col("__tw_n") + F.col("__tw_row") - 1})
        .withColumn("__tw_shard", F.least(F.expr(f"(__tw_start * {shards}L) div __tw_total"), F.lit(shards - 1).cast("long")))
    )
    placed = materialize(placed, "placed")
    discard(sizes, dealt)
    starts = placed.groupBy("__tw_shard").agg(F.min("__tw_at").alias("__tw_first"))
    return placed.join(F.broadcast(starts), "__tw_shard").select(*own, F.col("__tw_shard").cast("int").alias("shard"), (F.col("__tw_at") - F.col("__tw_first")).alias("slot"))


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("digest")
    )
    return shard_by_bytes(rows, "digest", "size", "doc_id").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
