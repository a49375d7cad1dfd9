"""Orders, ranks, stable names and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomewright.sources.shared import materialize


def nulls_last(column: str, descending: bool, tie: str) -> list[Column]:
    """Nulls last in both directions; the tie-break always ascends."""
    c = F.col(column)
    return [c.desc_nulls_last() if descending else c.asc_nulls_last(), F.col(tie).asc()]


def by_french_name(column: str = "name") -> Column:
    return F.collate(F.col(column), "fr")


def ranked(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows with their place from 1. The limit comes first, so the window sees n rows."""
    return rows.orderBy(*order).limit(n).withColumn("place", F.row_number().over(Window.orderBy(*order)))


def numbered(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """rows with their place from 0 in the order of ``by``. Rows are dealt by range; each partition numbers its own, and the
    sizes of the partitions before it, a row for each of them, are added."""
    dealt = materialize(rows.repartitionByRange(*by).withColumn("__part", F.spark_partition_id()), "dealt")
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("n"))
    before = sizes.select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*by))
    return dealt.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + inside - 1).drop("__part", "__before")


def numbered_within(rows: DataFrame, group: list[str], by: list[str], name: str) -> DataFrame:
    """rows with their place from 0 in their group; one group may hold most rows."""
    placed = materialize(numbered(rows, [*group, *by], name), "placed")
    first = placed.groupBy(*group).agg(F.min(name).alias("__first"))
    return placed.join(first, group).withColumn(name, F.col(name) - F.col("__first")).drop("__first")


def stable_slugs(rows: DataFrame, base: str, name: str, position: str) -> DataFrame:
    """name, slug: the first name with a base slug owns it, later ones get -2, -3, ... in order of first position."""
    first = rows.groupBy(base, name).agg(F.min(position).alias("at"))
    placed = numbered_within(first, [base], ["at", name], "n")
    return placed.select(name, F.when(F.col("n") == 0, F.col(base)).otherwise(F.concat(base, F.lit("-"), (F.col("n") + 1).cast("string"))).alias("slug"))


def top_per_group(rows: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= n)


def quotas(strata: DataFrame, keys: list[str], size: str, target: int, floor: int = 2) -> DataFrame:
    """keys, quota: the rounded share of each stratum (half to even), at least ``floor`` where it has so many, then one by one
    taken from the strata that have most above their share, or given to those with most below it (the larger, or smaller,
    key first), until the target is met.

    One by one is the same as all single steps in order of what a stratum would be off before each, so the steps are rows.
    Strata are few (a row for each kind), so the windows run over that small table."""
    everything = Window.partitionBy()
    share = F.lit(float(target)) * F.col(size) / F.sum(size).over(everything)
    base = strata.withColumn("ideal", share).withColumn("least", F.least(F.col(size), F.lit(floor)))
    base = base.withColumn("start", F.least(F.col(size), F.greatest(F.lit(floor), F.bround("ideal"))).cast("long"))
    base = base.withColumn("over", F.sum("start").over(everything) - F.lit(target))
    room = F.when(F.col("over") > 0, F.least(F.col("start") - F.col("least"), F.col("over"))).otherwise(F.least(F.col(size) - F.col("start"), -F.col("over")))
    steps = base.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), room))).where(F.col("step") < room)
    off = F.col("start") - F.col("ideal") - F.signum("over") * F.col("step")
    taken = F.row_number().over(Window.orderBy(F.desc(off), *[F.desc(k) for k in keys]))
    given = F.row_number().over(Window.orderBy(F.asc(off), *[F.asc(k) for k in keys]))
    steps = steps.withColumn("place", F.when(F.col("over") > 0, taken).otherwise(given)).where(F.col("place") <= F.abs("over"))
    moved = steps.groupBy(*keys).agg(F.sum(-F.signum("over")).cast("long").alias("moved"))
    return base.join(moved, keys, "left").select(*keys, (F.col("start") + F.coalesce("moved", F.lit(0))).alias("quota"))


def stratified_sample(rows: DataFrame, stratum: list[str], quota: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows of each stratum with the lowest seeded hashes, as many as its quota (columns stratum, quota). A stratum's rows are
    cut in each partition first, so none is sorted in one task."""
    drawn = rows.withColumn("__draw", F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))).join(quota, stratum)
    near = F.row_number().over(Window.partitionBy(*stratum, "__near").orderBy("__draw", key))
    dealt = drawn.withColumn("__near", F.substring("__draw", 1, 1))  # hashes are even, so a sixteenth of a stratum each
    counts = dealt.groupBy(*stratum, "__near").agg(F.count("*").alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(*stratum).orderBy("__near").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    placed = dealt.withColumn("__place", near).join(before, [*stratum, "__near"])
    return placed.where(F.col("__before") + F.col("__place") <= F.col("quota")).drop("__draw", "__near", "__place", "__before", "quota")


def seeded_places(strata: list[tuple], seed: int) -> list[tuple]:
    """(stratum, place) drawn without replacement for (stratum, size, quota), strata in order, by one sequential generator: the
    places that ``random.sample`` takes of sorted members. Only sizes are needed, no members."""
    import random

    own = random.Random(seed)
    return [(s, p) for s, size, quota in sorted(strata) for p in sorted(own.sample(range(size), min(quota, size)))]


def seeded_draw(rows: DataFrame, stratum: str, quota: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows of each stratum (quota: stratum, quota) as a sequential generator draws them from the members in order of their key.

    The generator runs over the sizes of the strata, a row for each; rows meet the drawn places by their rank, which is
    counted in partitions, so no stratum is gathered. The draw itself is as large as the quotas."""
    spark = rows.sparkSession
    sizes = rows.groupBy(stratum).agg(F.count("*").alias("n")).join(quota, stratum).select(stratum, "n", "quota").collect()
    kind = rows.schema[stratum].dataType.simpleString()
    drawn = spark.createDataFrame(seeded_places([tuple(r) for r in sizes], seed), f"{stratum} {kind}, __at long")
    ranked_ = numbered_within(rows, [stratum], [key], "__at")
    return ranked_.join(F.broadcast(drawn), [stratum, "__at"]).drop("__at")


def cover(rows: DataFrame, key: str, flags: list[str]) -> list:
    """Keys picked one after another, each the one with most flags that none has yet (the smallest among equals), until none
    adds one. Only one row for each set of flags is needed, and there are at most 2 ** len(flags) of them."""
    sets = rows.select(key, F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in flags])).alias("has"))
    few = sets.groupBy("has").agg(F.min(key).alias("key")).collect()
    missing, picked = set(flags), []
    while missing:
        best = max(few, key=lambda r: len(missing & set(r["has"])), default=None)
        gain = len(missing & set(best["has"])) if best else 0
        if not gain:
            break
        key_ = min(r["key"] for r in few if len(missing & set(r["has"])) == gain)
        picked.append(key_)
        missing -= set(next(r["has"] for r in few if r["key"] == key_))
    return picked


def picked_by_rules(rows: DataFrame, key: str, rules: list[tuple[Column, int]]) -> DataFrame:
    """key, rule: ordered rules each take the first keys that hold and that no rule before took, at most so many. A row counts
    for its first rule that has room, so each rule looks at what is left; rules are few."""
    out, left = None, rows
    for n, (condition, most) in enumerate(rules):
        took = materialize(left.where(condition).select(key).orderBy(key).limit(most).withColumn("rule", F.lit(n)), "took")
        out = took if out is None else out.unionByName(took)
        left = left.join(took.select(key), key, "left_anti")
    return out
