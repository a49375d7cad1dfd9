"""Projections of characters, coverage reports, sampled comparisons and constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Abilities and what they are called by in rules.
ABILITIES = {"force": "For", "dexterite": "Dex", "constitution": "Con", "intelligence": "Int", "sagesse": "Sag", "charisme": "Cha"}


def character_key(class_: Column, level: Column, race: Column) -> Column:
    return F.concat_ws("|", class_, level.cast("string"), F.coalesce(race, F.lit("")))


def abbreviated(abilities: Column) -> Column:
    """Map of full ability names to values, by their short names; null where none is given."""
    short = F.create_map(*[F.lit(x) for kv in ABILITIES.items() for x in kv])
    return F.when(F.size(abilities) > 0, F.transform_keys(abilities, lambda k, v: F.coalesce(F.try_element_at(short, k), k)))


def known_from_slots(slots: DataFrame, owners: DataFrame, owner: str, feat: str) -> DataFrame:
    """owner, known: the feats of filled slots in order; an owner without any has an empty set, never null."""
    filled = slots.where(F.col(feat).isNotNull()).groupBy(owner).agg(F.array_sort(F.collect_set(feat)).alias("known"))
    return owners.select(owner).join(filled, owner, "left").select(owner, F.coalesce("known", F.array().cast("array<string>")).alias("known"))


def search_text(*parts: Column) -> Column:
    """Parts with single spaces between, a blank for each that is missing."""
    return F.array_join(F.array(*[F.coalesce(p, F.lit("")) for p in parts]), " ")


def nested_counts(rows: DataFrame, key: str, values: str) -> DataFrame:
    """label, records, blocks: how often each label stands in the arrays; the row without a label counts all."""
    each = rows.select(F.col(key).alias("r"), F.explode(values).alias("label"))
    return each.rollup("label").agg(F.count_distinct("r").alias("records"), F.count("*").alias("blocks"))


def list_coverage(rows: DataFrame, key: str, column: str, by: str = r"\|") -> DataFrame:
    """value, n: distinct keys for each value of a joined column, blanks dropped."""
    values = F.filter(F.transform(F.split(column, by), lambda v: F.trim(v)), lambda v: v != "")
    return rows.select(key, F.explode(F.array_distinct(values)).alias("value")).groupBy("value").agg(F.count_distinct(key).alias("n"))


def marker_levels(features: DataFrame, owner: str, level: str, text: str, marker: str) -> DataFrame:
    """owner, levels: where a feature has the marker, in order, each once."""
    return features.where(F.col(text).rlike(marker)).groupBy(owner).agg(F.array_sort(F.collect_set(level)).alias("levels"))


def alias_report(entities: DataFrame, aliases: DataFrame, key: str, level: str, low: int) -> DataFrame:
    """One row: covered, total, low_covered, low_total (entities up to a level)."""
    told = entities.join(aliases.select(key).distinct().withColumn("__a", F.lit(True)), key, "left")
    is_low, has = F.coalesce(F.col(level) <= low, F.lit(False)), F.coalesce("__a", F.lit(False))
    return told.agg(F.count_if(has).alias("covered"), F.count("*").alias("total"), F.count_if(has & is_low).alias("low_covered"), F.count_if(is_low).alias("low_total"))


def without_alias(entities: DataFrame, aliases: DataFrame, key: str, level: str, name: str, n: int) -> DataFrame:
    """The first entities without an alias: by level (none last), then name."""
    missing = entities.join(aliases.select(key).distinct(), key, "left_anti")
    return missing.orderBy(F.coalesce(level, F.lit(99)), name, key).limit(n).select(key, level, name)


def sampled_differences(left: DataFrame, right: DataFrame, key: str, value: str, n: int, seed: int) -> DataFrame:
    """key, same: for the n ids with the lowest seeded hashes, whether both maps have the same entries."""
    entries = lambda c: F.array_sort(F.map_entries(c))
    some = left.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), key).limit(n)
    return some.select(key, F.col(value).alias("a")).join(right.select(key, F.col(value).alias("b")), key, "left").select(key, entries("a").eqNullSafe(entries("b")).alias("same"))


def agreed_exceptions(lines: DataFrame, document: str, position: str, text: str, heading: str) -> DataFrame:
    """document, id: ids in bullets below headings that match; a heading holds up to the next one of its document."""
    is_heading = F.col(text).rlike(r"^#+\s")
    marked = lines.withColumn("__h", F.when(is_heading, F.col(text)))
    under = F.last("__h", True).over(Window.partitionBy(document).orderBy(position).rowsBetween(Window.unboundedPreceding, 0))
    bullets = marked.withColumn("__under", under).where(F.col("__under").rlike(heading)).withColumn("id", F.regexp_extract(text, r"^\s*[-*]\s+`?([\w-]+)`?", 1))
    return bullets.where("id <> ''").select(document, "id").distinct()


def constraint_problems(raw: Column, classes: list[str], class_: Column) -> Column:
    """Names of what a stored character breaks: class not listed, abilities that aren't six numbers, feats that aren't texts."""
    doc = F.try_parse_json(raw)
    abilities = F.get_json_object(raw, "$.abilities")
    keys = F.array_sort(F.json_object_keys(abilities))
    numbers = F.from_json(abilities, "map<string,double>")
    six = keys.eqNullSafe(F.array(*[F.lit(a) for a in sorted(ABILITIES)])) & F.forall(F.map_values(numbers), lambda v: v.isNotNull())
    texts = F.schema_of_variant(F.try_variant_get(doc, "$.feats", "variant")).isin("ARRAY<STRING>", "ARRAY<VOID>")
    return F.array_compact(F.array(F.when(~F.coalesce(class_.isin(*classes), F.lit(False)), "class"), F.when(~F.coalesce(six, F.lit(False)), "abilities"), F.when(~F.coalesce(texts, F.lit(False)), "feats")))
