"""Facets: include / exclude / require predicates, counts that ignore their own facet, axis histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tri_mode(values: Column, include: list = (), exclude: list = (), require: list = ()) -> Column:
    """Any of include, none of exclude, all of require; an empty list asks for nothing."""
    array = lambda xs: F.array(*[F.lit(x) for x in xs])
    out = F.lit(True)
    if include:
        out &= F.coalesce(F.arrays_overlap(values, array(include)), F.lit(False))
    if exclude:
        out &= ~F.coalesce(F.arrays_overlap(values, array(exclude)), F.lit(False))
    if require:
        out &= F.coalesce(F.size(F.array_except(array(require), values)) == 0, F.lit(False))
    return out


def scalar_in(value: Column, wanted: list) -> Column:
    """A null value is never kept once the facet is active."""
    return value.isin(*wanted) if wanted else F.lit(True)


def contains_all(values: Column, wanted: list) -> Column:
    return tri_mode(values, require=wanted)


def level_of_class(levels: Column, class_id, wanted: list[int] = ()) -> Column:
    """The class has the entity, at one of the levels if any are asked for. levels: map of class to level."""
    level = F.try_element_at(levels, F.lit(class_id))
    return level.isNotNull() & (level.isin(*wanted) if wanted else F.lit(True))


def level_of_any(levels: Column, classes: list, wanted: list[int] = ()) -> Column:
    return reduce(lambda a, b: a | b, [level_of_class(levels, c, wanted) for c in classes])


def lowest_level(levels: Column) -> Column:
    return F.array_min(F.map_values(levels))


def level_map(class_levels: DataFrame) -> DataFrame:
    """id, levels (map of class to level) from (id, class_id, level) rows, unique on the pair."""
    return class_levels.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("class_id", "level")))).alias("levels"))


def cost_cap(cost: Column, cap: float | None) -> Column:
    return F.lit(True) if cap is None else cost <= cap


def text_contains(text: Column, query: str) -> Column:
    """Case-insensitive, accents as they are; a blank query keeps all."""
    q = query.strip().lower()
    return F.contains(F.lower(text), F.lit(q)) if q else F.lit(True)


def _option(name: str):
    return lambda value: F.struct(F.lit(name).alias("facet"), value.cast("string").alias("value"))


def counts_sideways(rows: DataFrame, facets: dict[str, tuple[Column, Column]]) -> DataFrame:
    """facet, value, n: for each facet the rows that all other facets keep. facets: name to (predicate, array of values).

    One scan: each row is exploded into the facets for which it counts, and a single aggregation follows."""
    names = list(facets)
    options = []
    for name in names:
        others = reduce(lambda a, b: a & b, [facets[o][0] for o in names if o != name], F.lit(True))
        options.append(F.when(others, F.transform(F.array_distinct(facets[name][1]), _option(name))))
    made = F.flatten(F.array_compact(F.array(*options)))
    return rows.select(F.explode(made).alias("o")).select("o.facet", "o.value").where("value IS NOT NULL").groupBy("facet", "value").agg(F.count("*").alias("n"))


def histogram(rows: DataFrame, value: Column, null_bucket: bool = True) -> DataFrame:
    """value, n, share (percent, two digits)."""
    counted = rows.select(value.cast("string").alias("value"))
    counts = (counted if null_bucket else counted.where("value IS NOT NULL")).groupBy("value").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def histogram_of_values(rows: DataFrame, values: Column) -> DataFrame:
    """Each distinct value of an array counts once for a row; rows without values form the null bucket."""
    return rows.select(F.explode_outer(F.array_distinct(values)).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def discriminates(slices: DataFrame) -> DataFrame:
    """Whether an axis tells rows apart: two slices that aren't null, and one smaller than all. slices: value, n, with the null
    bucket, so that they add up to all rows."""
    real = F.col("value").isNotNull()
    return slices.agg(((F.count_if(real) >= 2) & (F.min(F.when(real, F.col("n"))) < F.sum("n"))).alias("discriminates"))
