"""Joins that reconcile sources: agreement in three values, orphans, set comparison, merges and differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def agreement(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Left rows with the other side's value and ``agree``: true, false, or null where a side doesn't say. Nothing is corrected."""
    other = right.select(*keys, F.col(value).alias(f"other_{value}"))
    return left.join(other, keys, "left").withColumn("agree", F.col(value) == F.col(f"other_{value}"))


def spread(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose contributing rows give several values."""
    return rows.groupBy(*keys).agg(F.count_distinct(value).alias("n_values"), F.min(value).alias("least"), F.max(value).alias("most")).where("n_values > 1")


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """side, key: keys that only one side has. One full outer join instead of two anti joins."""
    a, b = left.select(F.col(key).alias("a")).distinct(), right.select(F.col(key).alias("b")).distinct()
    joined = a.join(b, F.col("a") == F.col("b"), "full_outer").where("a IS NULL OR b IS NULL")
    return joined.select(F.when(F.col("b").isNull(), "left").otherwise("right").alias("side"), F.coalesce("a", "b").alias("key"))


def with_status(docs: DataFrame, extra: DataFrame, key: str, valid: Column) -> DataFrame:
    """Left join with status ``ok``, ``missing`` or ``invalid``; an invalid payload is emptied."""
    payload = [c for c in extra.columns if c != key]
    marked = extra.select(key, F.struct(*payload).alias("payload"), F.coalesce(valid, F.lit(False)).alias("is_valid"))
    joined = docs.join(marked, key, "left")
    status = F.when(F.col("is_valid").isNull(), "missing").when(~F.col("is_valid"), "invalid").otherwise("ok")
    return joined.withColumn("status", status).withColumn("payload", F.when(F.col("is_valid"), F.col("payload"))).drop("is_valid")


def compare_classes(class_levels: DataFrame, classes: list) -> DataFrame:
    """id, n_holders, part (shared / exclusive / partial), gap of levels (null below two)."""
    held = class_levels.where(F.col("class_id").isin(*classes)).groupBy("id").agg(F.count("*").alias("n_holders"), (F.max("level") - F.min("level")).alias("gap"))
    part = F.when(F.col("n_holders") == len(classes), "shared").when(F.col("n_holders") == 1, "exclusive").otherwise("partial")
    return held.select("id", "n_holders", part.alias("part"), F.when(F.col("n_holders") > 1, F.col("gap")).alias("gap"))


def verdict_diff(old: DataFrame, new: DataFrame, keys: list[str], gained: list[str], lost: str) -> DataFrame:
    """keys, old, new, kind: regression (gained to lost), relaxation (lost to gained), change, noise (only the reasons differ), coverage."""
    a = old.select(*keys, F.col("status").alias("old"), F.col("reasons").alias("old_reasons"))
    b = new.select(*keys, F.col("status").alias("new"), F.col("reasons").alias("new_reasons"))
    kind = (
        F.when(F.col("old").isNull() | F.col("new").isNull(), "coverage")
        .when(F.col("old").isin(*gained) & (F.col("new") == lost), "regression")
        .when((F.col("old") == lost) & F.col("new").isin(*gained), "relaxation")
        .when(F.col("old") != F.col("new"), "change")
        .when(~F.col("old_reasons").eqNullSafe(F.col("new_reasons")), "noise")
        .otherwise("same")
    )
    return a.join(b, keys, "full_outer").select(*keys, "old", "new", kind.alias("kind"))


def merge_two_sides(local: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    """Rows (key, name, modified, created, deleted) of two replicas: the later edit names the row, the older creation
    date stays, and a deletion at or after the other side's edit deletes. Ties keep the local name."""
    side = lambda df, p: df.select(F.col(key), *[F.col(c).alias(f"{p}_{c}") for c in ("name", "modified", "created", "deleted")])
    both = side(local, "l").join(side(remote, "r"), key, "full_outer")
    newer = F.col("r_modified").isNotNull() & (F.col("l_modified").isNull() | (F.col("r_modified") > F.col("l_modified")))
    gone = lambda p, o: F.coalesce(F.col(f"{p}_deleted") >= F.coalesce(F.col(f"{o}_modified"), F.col(f"{p}_deleted")), F.lit(False))
    return both.where(~gone("l", "r") & ~gone("r", "l")).select(
        key,
        F.when(newer, F.col("r_name")).otherwise(F.col("l_name")).alias("name"),
        F.greatest("l_modified", "r_modified").alias("modified"),
        F.least("l_created", "r_created").alias("created"),
    )


def sheet_merge(local: DataFrame, remote: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """key, outcome of a three-way merge on document digests: same, write_local, write_remote, delete_local, delete_remote, conflict."""
    one = lambda df, c: df.select(key, F.col("digest").alias(c))
    joined = one(local, "l").join(one(remote, "r"), key, "full_outer").join(one(base, "b"), key, "left")
    l_, r, b = F.col("l"), F.col("r"), F.col("b")
    outcome = (
        F.when(l_.eqNullSafe(r), "same")
        .when(b.isNull() & r.isNull(), "write_remote")
        .when(b.isNull() & l_.isNull(), "write_local")
        .when(r.isNull() & (l_ == b), "delete_local")
        .when(l_.isNull() & (r == b), "delete_remote")
        .when(l_ == b, "write_local")
        .when(r == b, "write_remote")
        .otherwise("conflict")
    )
    return joined.select(key, outcome.alias("outcome"))


def changes(base: DataFrame, current: DataFrame, key: str, digest: str) -> DataFrame:
    """key, change: delete, insert or update between two states."""
    a, b = base.select(key, F.col(digest).alias("was")), current.select(key, F.col(digest).alias("now"))
    kind = F.when(F.col("now").isNull(), "delete").when(F.col("was").isNull(), "insert").otherwise("update")
    return a.join(b, key, "full_outer").where(~F.col("was").eqNullSafe(F.col("now"))).select(key, kind.alias("change"))


def set_differences(sets: dict[str, DataFrame], column: str) -> DataFrame:
    """left, right, value: what one named set has and another hasn't, over all ordered pairs. One pass over the tagged union."""
    tagged = None
    for name, df in sets.items():
        one = df.select(F.lit(name).alias("name"), F.col(column).cast("string").alias("value")).distinct()
        tagged = one if tagged is None else tagged.unionByName(one)
    held = tagged.groupBy("value").agg(F.collect_set("name").alias("names"))
    names = F.array(*[F.lit(n) for n in sets])
    return held.select("value", F.explode("names").alias("left"), "names").select("left", F.explode(F.array_except(names, "names")).alias("right"), "value")
