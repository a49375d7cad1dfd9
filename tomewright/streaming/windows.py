"""Extension, not part of the catalogue's own operators: event streams with windows, sessions and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(events: DataFrame, time: str, late: str) -> DataFrame:
    """With a time of the session's zone and, on a stream, a watermark."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, late) if events.isStreaming else timed


def windowed_counts(events: DataFrame, time: str, kind: str, value: str, *, size: str = "5 minutes", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """start, kind, n, total of tumbling or sliding windows; on a stream, rows later than the watermark are dropped."""
    marked = _timed(events, time, late)
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return marked.groupBy(window.alias("w"), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")


def sessions(events: DataFrame, time: str, user: str, *, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    marked = _timed(events, time, late)
    return marked.groupBy(F.session_window(time, gap).alias("w"), user).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), user, "n")


def once(events: DataFrame, keys: list[str], time: str, late: str = "10 minutes") -> DataFrame:
    """Each key once; a stream keeps state only as long as the watermark."""
    return _timed(events, time, late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def apply_changes(stream: DataFrame, merge, checkpoint: str):
    """Starts a query that hands each micro-batch to ``merge(batch, id)``, once for each id after a restart."""
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
