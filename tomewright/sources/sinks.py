"""Sinks: ordered JSON lines, CSV, partitioned entities, upserts, tombstones, quarantine and protected rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewright.sources.records import exists


def write_json_lines(rows: DataFrame, path: str, key: str, columns: list[str]) -> None:
    """Fixed column order, nulls kept, sorted by key over the part files in name order."""
    rows.select(*columns).orderBy(key).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(rows: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    rows.select(*columns).orderBy(*order).write.mode("overwrite").csv(path, header=True)


def write_entities(rows: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Entities in folders by a hash of the key and sorted by it, so that a lookup reads one folder and few row groups."""
    rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).repartition("bucket").sortWithinPartitions(key).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_entity(spark, path: str, key: str, value, buckets: int = 64) -> DataFrame:
    rows = spark.read.parquet(path)
    wanted = F.lit(value).cast(rows.schema[key].dataType)
    folder = F.pmod(F.xxhash64(wanted), F.lit(buckets)).cast("int")
    return rows.where((F.col("bucket") == folder) & (F.col(key) == wanted)).drop("bucket")


def append_new(rows: DataFrame, path: str, key: str) -> None:
    """Only keys that aren't there yet."""
    spark = rows.sparkSession
    new = rows.join(spark.read.parquet(path).select(key), key, "left_anti") if exists(spark, path) else rows
    new.write.mode("append").parquet(path)


def upserted(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """current with the rows of changes put over those of equal keys. Changes are unique on the keys."""
    return current.join(changes.select(*keys), keys, "left_anti").unionByName(changes.select(*current.columns))


def tombstoned(current: DataFrame, gone: DataFrame, keys: list[str], at: str) -> DataFrame:
    """current with column ``at`` filled from gone (keys and ``at``) where it names the row and none was set."""
    other = gone.select(*keys, F.col(at).alias("_at"))
    return current.join(other, keys, "left").withColumn(at, F.coalesce(at, "_at")).select(*current.columns)


def split_quarantine(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected ones with their reason and raw content."""
    marked = rows.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL").select("reason", F.to_json(F.struct(*rows.columns)).alias("raw"))


def protected(new: DataFrame, stored: DataFrame, key: str, stored_hash: str, recomputed: Column, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows that may be written, and keys whose stored row was edited by hand (its hash isn't that of its content)."""
    edited = stored.where(~F.col(stored_hash).eqNullSafe(recomputed)).select(key)
    return (new if force else new.join(edited, key, "left_anti")), edited


def stale(targets: DataFrame, sources: DataFrame, key: str, versions: list[str]) -> DataFrame:
    """Sources whose key and versions no target has: what an incremental run must do."""
    return sources.join(targets.select(key, *versions), [key, *versions], "left_anti")


def pretty_json(rows: DataFrame, key: str, most: int = 10_000) -> str:
    """A small table as indented JSON with a newline at its end, in order of the key. A table of more rows is refused; it is written
    as lines."""
    import json

    found = rows.orderBy(key).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rows: write them as lines")
    return json.dumps([json.loads(r[0]) for r in found], indent=2, ensure_ascii=False) + "\n"


def with_replaced(rows: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """rows with one column taken from changes where they name the key; all else stays as it is."""
    new = changes.select(key, F.col(column).alias("__new"), F.lit(True).alias("__changed"))
    return rows.join(new, key, "left").withColumn(column, F.when(F.col("__changed"), F.col("__new")).otherwise(F.col(column))).select(*rows.columns)


def published(tables: DataFrame, name: str, raw: str) -> tuple[DataFrame, DataFrame]:
    """Index (name, version, sha256) of rule tables with an envelope, and the names of those without."""
    version = F.get_json_object(raw, "$.meta.version")
    fine = version.isNotNull() & F.get_json_object(raw, "$.data").isNotNull()
    index = tables.where(fine).select(name, version.alias("version"), F.sha2(F.col(raw).cast("binary"), 256).alias("sha256"))
    return index, tables.where(~F.coalesce(fine, F.lit(False))).select(name)


def favourites_document(rows: DataFrame, owner: str) -> DataFrame:
    """owner, document: stored lists (owner, list, name, place, id) as one JSON text with lists and ids in order."""
    lists = rows.groupBy(owner, "list", "name").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "id"))), lambda x: x["id"]).alias("ids"))
    made = lists.groupBy(owner).agg(F.array_sort(F.collect_list(F.struct(F.col("list").alias("id"), "name", "ids"))).alias("lists"))
    return made.select(owner, F.to_json(F.struct(F.lit(1).alias("version"), "lists")).alias("document"))

