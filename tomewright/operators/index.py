"""Unique-entity index: folding of per-class lists, sharing, exclusives, identities and list statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomewright.operators.ordering import numbered


def class_levels(entries: DataFrame) -> DataFrame:
    """id, class_id, level: the lowest level where a list names an entity twice."""
    return entries.groupBy("id", "class_id").agg(F.min("level").alias("level"))


def majority(entries: DataFrame, key: str, value: str) -> DataFrame:
    """key, value, n_values: the most frequent value, the first in order among equals."""
    counts = entries.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.count("*").alias("n_values"))


def unique_index(entries: DataFrame) -> DataFrame:
    """One row for each entity. Rows are dealt once, by id; every step below keeps that distribution."""
    dealt = entries.repartition("id")
    levels = class_levels(dealt).groupBy("id").agg(
        F.count("*").alias("nb_classes"),
        F.min("level").alias("level_min"),
        F.max("level").alias("level_max"),
        F.array_sort(F.collect_list(F.struct("class_id", "level"))).alias("classes"),
    )
    lists = dealt.groupBy("id").agg(F.array_sort(F.collect_set("school")).alias("schools"), F.array_sort(F.collect_set("source")).alias("sources"))
    return levels.join(lists, "id").join(majority(dealt, "id", "url").select("id", "url"), "id", "left").withColumn("shared", F.col("nb_classes") > 1)


def exclusive_by_class(entries: DataFrame, roster: DataFrame) -> DataFrame:
    """class_id, name, n_exclusive: entities that only this class has; classes without any keep a zero row."""
    alone = class_levels(entries).groupBy("id").agg(F.count("*").alias("n"), F.min("class_id").alias("class_id")).where("n = 1")
    counts = alone.groupBy("class_id").agg(F.count("*").alias("n_exclusive"))
    return roster.join(counts, "class_id", "left").select("class_id", "name", F.coalesce("n_exclusive", F.lit(0)).alias("n_exclusive"))


def share_distribution(entries: DataFrame) -> DataFrame:
    return class_levels(entries).groupBy("id").agg(F.count("*").alias("nb_classes")).groupBy("nb_classes").agg(F.count("*").alias("n"))


def top_shared(entries: DataFrame, n: int = 25) -> DataFrame:
    return class_levels(entries).groupBy("id").agg(F.count("*").alias("nb_classes")).orderBy(F.desc("nb_classes"), "id").limit(n)


def divergent_levels(entries: DataFrame) -> DataFrame:
    return class_levels(entries).groupBy("id").agg(F.min("level").alias("level_min"), F.max("level").alias("level_max")).where("level_min <> level_max")


def fold_identities(entries: DataFrame) -> DataFrame:
    """The two sums that a fold must keep: pairs against class counts, shared and exclusive against all."""
    per_id = class_levels(entries).groupBy("id").agg(F.count("*").alias("n"))
    return per_id.agg(F.sum("n").alias("pairs"), F.count("*").alias("uniques"), F.count_if(F.col("n") > 1).alias("n_shared"), F.count_if(F.col("n") == 1).alias("n_exclusive")).withColumn("holds", F.col("n_shared") + F.col("n_exclusive") == F.col("uniques"))


def bijection_violations(rows: DataFrame, left: str, right: str) -> DataFrame:
    """side, key, n: values of one column that meet several of the other."""
    one = lambda a, b, side: rows.groupBy(a).agg(F.count_distinct(b).alias("n")).where("n > 1").select(F.lit(side).alias("side"), F.col(a).cast("string").alias("key"), "n")
    return one(left, right, "left").unionByName(one(right, left, "right"))


def list_stats(entries: DataFrame) -> DataFrame:
    return entries.groupBy("class_id").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        F.count_distinct("school").alias("n_schools"),
        F.count_if(F.col("school").isNull()).alias("n_no_school"),
        *[F.count_if(F.col("level") == k).alias(f"level_{k}") for k in range(10)],
    )


def coverage(rows: DataFrame, columns: list[str]) -> DataFrame:
    """field, filled, share (percent of all rows); a value is filled unless null or empty. One pass, then unpivoted."""
    filled = rows.agg(F.count("*").alias("total"), *[F.count_if(F.col(c).isNotNull() & (F.length(F.col(c).cast("string")) > 0)).alias(c) for c in columns])
    long = filled.unpivot("total", columns, "field", "filled")
    return long.select("field", "filled", F.round(F.lit(100.0) * F.col("filled") / F.col("total"), 2).alias("share"))


def length_stats(rows: DataFrame, text: str) -> DataFrame:
    n = F.char_length(text)
    return rows.agg(F.min(n).cast("long").alias("shortest"), F.floor(F.median(n)).cast("long").alias("median"), F.max(n).cast("long").alias("longest"))


def level_bands(entries: DataFrame, bands: DataFrame) -> DataFrame:
    """Observed level range of each class against the band (class_id, low, high) that it should keep."""
    seen = entries.groupBy("class_id").agg(F.min("level").alias("lowest"), F.max("level").alias("highest"), F.count("*").alias("n"))
    return seen.join(bands, "class_id").withColumn("inside", (F.col("lowest") >= F.col("low")) & (F.col("highest") <= F.col("high")))


def duplicate_levels(entries: DataFrame) -> DataFrame:
    return entries.groupBy("class_id", "id", "level").agg(F.count("*").alias("n")).where("n > 1")


def in_class_conflicts(entries: DataFrame) -> DataFrame:
    """Entities that one list names at several levels, with the level that is kept."""
    return entries.groupBy("id", "class_id").agg(F.min("level").alias("kept"), F.max("level").alias("dropped"), F.count_distinct("level").alias("n")).where("n > 1")


def partition_check(entries: DataFrame, all_ids: DataFrame) -> DataFrame:
    """Counts that show whether shared and exclusive entities split the index: overlap, missing, outside."""
    per_id = class_levels(entries).groupBy("id").agg(F.count("*").alias("n"))
    both = per_id.join(all_ids.select(F.col("id").alias("known")).distinct(), F.col("id") == F.col("known"), "full_outer")
    return both.agg(
        F.count_if(F.col("n") > 1).alias("n_shared"),
        F.count_if(F.col("n") == 1).alias("n_exclusive"),
        F.count_if(F.col("n").isNull()).alias("n_missing"),
        F.count_if(F.col("known").isNull()).alias("n_outside"),
    )


def dense_codes(rows: DataFrame, column: str) -> DataFrame:
    """value, code: distinct values in order, numbered from 0. A vocabulary is small: its window sees distinct values only."""
    values = rows.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    return numbered(values, ["value"], "code").select("value", F.col("code").cast("long").alias("code"))


def volumetry(entries: DataFrame) -> DataFrame:
    return entries.agg(F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids")).withColumn("ratio", F.round(F.col("n_rows") / F.col("n_ids"), 4))


def strata(entries: DataFrame) -> DataFrame:
    """school, level, n: entities by the school and level of their lowest list row."""
    base = entries.groupBy("id").agg(F.min(F.struct(F.col("level"), F.coalesce("school", F.lit("-")).alias("school"))).alias("b"))
    return base.groupBy(F.col("b.school").alias("school"), F.col("b.level").alias("level")).agg(F.count("*").alias("n"))
