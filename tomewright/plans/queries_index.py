"""Queries over the unique-entity index, lists and strata, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tomewright.operators import index, ordering
from tomewright.sources.tables import ENTRIES_SQL, ROSTER_SQL, SPELLS_SQL, entries, load, roster, spells

LEVELS_SQL = "cl AS (SELECT id, class_id, min(level) AS level FROM entries GROUP BY id, class_id)"
PER_ID_SQL = "per AS (SELECT id, count(*) AS n, min(level) AS lo, max(level) AS hi, min(class_id) AS c FROM cl GROUP BY id)"
BASE_SQL = f"WITH {ENTRIES_SQL}, {LEVELS_SQL}, {PER_ID_SQL}"


def unique_index_fold(spark, d):
    made = index.unique_index(entries(spark, d))
    return made.select(
        "id", "nb_classes", "level_min", "level_max", "shared", "url",
        F.array_join(F.transform("classes", lambda c: F.concat_ws(":", c["class_id"].cast("string"), c["level"].cast("string"))), "|").alias("classes"),
        F.array_join("schools", "|").alias("schools"), F.array_join("sources", "|").alias("sources"),
    )


def bands(spark):
    return spark.range(25).select(F.col("id").cast("int").alias("class_id"), F.lit(0).alias("low"), F.when(F.col("id") % 2 == 0, 9).otherwise(8).alias("high"))


def coverage(spark, d):
    return index.coverage(spells(spark, d).select("id", "name", "school", "level"), ["id", "name", "school", "level"])


def stable_slug(spark, d):
    names = load(spark, d, "supplier").select(F.concat(F.lit("s-"), F.substring("s_name", -1, 1)).alias("base"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("position"))
    return ordering.stable_slugs(names, "base", "name", "position")


def quota_allocation(spark, d):
    return ordering.quotas(index.strata(entries(spark, d)), ["school", "level"], "n", 300)


def stratified_sample(spark, d):
    rows = entries(spark, d)
    base = rows.groupBy("id").agg(F.min(F.struct(F.col("level"), F.coalesce("school", F.lit("-")).alias("school"))).alias("b")).select("id", "b.school", "b.level")
    quota = ordering.quotas(index.strata(rows), ["school", "level"], "n", 300)
    return ordering.stratified_sample(base, ["school", "level"], quota, "id", 17)


def level_runs(spark, d):
    from tomewright.functions.text import runs_of

    return entries(spark, d).groupBy("class_id", "school").agg(F.collect_set("level").alias("l")).select("class_id", "school", runs_of(F.col("l")).alias("levels"))


def fixture_selection(spark, d):
    """Keys that together show all cases, and keys by ordered rules."""
    p = spells(spark, d)
    flags = {"no_level": F.col("level").isNull(), "top": F.col("level") == 9, "no_school": F.col("school").isNull(), "cheap": F.col("cost") < 910, "hot": F.array_contains("tags", "hot"), "large": F.array_contains("tags", "LARGE")}
    picked = ordering.cover(p.select("id", *[c.alias(n) for n, c in flags.items()]), "id", list(flags))
    ruled = ordering.picked_by_rules(p, "id", [(F.col("level") == 9, 3), (F.col("school").isNull(), 4), (F.col("level") >= 8, 3), (F.lit(True), 5)])
    return ruled.select("id", F.col("rule").cast("int").alias("rule")).unionByName(spark.createDataFrame([(int(k), 9) for k in picked], "id long, rule int"))


QUERIES = {
    "unique_index_fold": unique_index_fold,
    "share_distribution": lambda s, d: index.share_distribution(entries(s, d)),
    "top_shared": lambda s, d: index.top_shared(entries(s, d)),
    "divergent_levels": lambda s, d: index.divergent_levels(entries(s, d)),
    "exclusive_by_class": lambda s, d: index.exclusive_by_class(entries(s, d), roster(s, d)),
    "fold_identities": lambda s, d: index.fold_identities(entries(s, d)),
    "bijection_violations": lambda s, d: index.bijection_violations(load(s, d, "customer"), "c_mktsegment", "c_nationkey"),
    "majority_url": lambda s, d: index.majority(entries(s, d), "id", "url"),
    "list_stats": lambda s, d: index.list_stats(entries(s, d)),
    "coverage": coverage,
    "length_stats": lambda s, d: index.length_stats(load(s, d, "documents"), "text"),
    "level_bands": lambda s, d: index.level_bands(entries(s, d), bands(s)),
    "duplicate_levels": lambda s, d: index.duplicate_levels(entries(s, d)),
    "in_class_conflicts": lambda s, d: index.in_class_conflicts(entries(s, d)),
    "partition_check": lambda s, d: index.partition_check(entries(s, d), load(s, d, "orders").select(F.col("o_orderkey").alias("id"))),
    "dense_codes": lambda s, d: index.dense_codes(load(s, d, "part"), "p_type"),
    "volumetry": lambda s, d: index.volumetry(entries(s, d)),
    "strata": lambda s, d: index.strata(entries(s, d)),
    "stable_slug": stable_slug,
    "quota_allocation": quota_allocation,
    "stratified_sample": stratified_sample,
    "fixture_selection": fixture_selection,
    "level_runs": level_runs,
}

_QUOTA_SQL = """b AS (SELECT id, level, coalesce(school, '-') AS school FROM entries QUALIFY row_number() OVER (PARTITION BY id ORDER BY level, coalesce(school, '-')) = 1), s AS (SELECT school, level, count(*) AS n FROM b GROUP BY ALL),
i AS (SELECT *, 300.0::DOUBLE * n / (sum(n) OVER ())::BIGINT AS ideal FROM s), j AS (SELECT *, least(n, greatest(2, round_even(ideal, 0)))::BIGINT AS start FROM i), k AS (SELECT *, (sum(start) OVER ())::BIGINT - 300 AS over FROM j),
u AS (SELECT school, level, over, start - ideal - sign(over) * step AS off FROM k, unnest(range(0, CASE WHEN over > 0 THEN start - least(n, 2) ELSE n - start END)) AS t(step)),
m AS (SELECT school, level, -sign(over) AS move, CASE WHEN over > 0 THEN row_number() OVER (ORDER BY off DESC, school DESC, level DESC) ELSE row_number() OVER (ORDER BY off, school, level) END AS place, over FROM u),
q AS (SELECT school, level, (any_value(start) + coalesce(sum(move) FILTER (place <= abs(m.over)), 0))::BIGINT AS quota FROM k LEFT JOIN m USING (school, level) GROUP BY school, level)"""
ORACLES = {
    "quota_allocation": f"WITH {ENTRIES_SQL}, {_QUOTA_SQL} SELECT school, level, quota FROM q",
    "stratified_sample": f"WITH {ENTRIES_SQL}, {_QUOTA_SQL} SELECT id, b.school, b.level FROM b JOIN q ON q.school = b.school AND q.level = b.level QUALIFY row_number() OVER (PARTITION BY b.school, b.level ORDER BY md5('17|' || id::VARCHAR), id) <= quota",
    "unique_index_fold": f"""{BASE_SQL},
u AS (SELECT id, url, count(*) AS n FROM entries GROUP BY id, url),
m AS (SELECT id, url FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, url) = 1),
s AS (SELECT id, coalesce(string_agg(DISTINCT school, '|' ORDER BY school), '') AS schools, string_agg(DISTINCT source, '|' ORDER BY source) AS sources FROM entries GROUP BY id),
c AS (SELECT id, string_agg(class_id::VARCHAR || ':' || level::VARCHAR, '|' ORDER BY class_id) AS classes FROM cl GROUP BY id)
SELECT id, n AS nb_classes, lo AS level_min, hi AS level_max, n > 1 AS shared, url, classes, schools, sources FROM per JOIN m USING (id) JOIN s USING (id) JOIN c USING (id)""",
    "share_distribution": f"{BASE_SQL} SELECT n AS nb_classes, count(*) AS n FROM per GROUP BY 1",
    "top_shared": f"{BASE_SQL} SELECT id, n AS nb_classes FROM per ORDER BY n DESC, id LIMIT 25",
    "divergent_levels": f"{BASE_SQL} SELECT id, lo AS level_min, hi AS level_max FROM per WHERE lo <> hi",
    "exclusive_by_class": f"{BASE_SQL}, {ROSTER_SQL} SELECT r.class_id, r.name, count(p.id) AS n_exclusive FROM roster AS r LEFT JOIN (SELECT * FROM per WHERE n = 1) AS p ON p.c = r.class_id GROUP BY 1, 2",
    "fold_identities": f"{BASE_SQL} SELECT sum(n)::BIGINT AS pairs, count(*) AS uniques, count(*) FILTER (n > 1) AS n_shared, count(*) FILTER (n = 1) AS n_exclusive, count(*) FILTER (n > 1) + count(*) FILTER (n = 1) = count(*) AS holds FROM per",
    "bijection_violations": "SELECT 'left' AS side, c_mktsegment AS key, count(DISTINCT c_nationkey) AS n FROM customer GROUP BY 2 HAVING count(DISTINCT c_nationkey) > 1 UNION ALL SELECT 'right', c_nationkey::VARCHAR, count(DISTINCT c_mktsegment) FROM customer GROUP BY 2 HAVING count(DISTINCT c_mktsegment) > 1",
    "majority_url": f"WITH {ENTRIES_SQL}, u AS (SELECT id, url, count(*) AS n FROM entries GROUP BY id, url) SELECT id, url, count(*) OVER (PARTITION BY id) AS n_values FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, url) = 1",
    "list_stats": f"WITH {ENTRIES_SQL} SELECT class_id, count(*) AS n_rows, count(DISTINCT id) AS n_ids, count(DISTINCT school) AS n_schools, count(*) FILTER (school IS NULL) AS n_no_school, {', '.join(f'count(*) FILTER (level = {k}) AS level_{k}' for k in range(10))} FROM entries GROUP BY class_id",
    "coverage": f"WITH {SPELLS_SQL}, t AS (SELECT count(*) AS n, count(id) AS a, count(name) FILTER (name <> '') AS b, count(school) FILTER (school <> '') AS c, count(level) AS d FROM spells) "
    + " UNION ALL ".join(f"SELECT '{f}' AS field, {x} AS filled, round(100.0::DOUBLE * {x} / n, 2) AS share FROM t" for f, x in (("id", "a"), ("name", "b"), ("school", "c"), ("level", "d"))),
    "length_stats": "SELECT min(length(text)) AS shortest, floor(median(length(text)))::BIGINT AS median, max(length(text)) AS longest FROM documents",
    "level_bands": f"WITH {ENTRIES_SQL} SELECT class_id, min(level) AS lowest, max(level) AS highest, count(*) AS n, 0 AS low, CASE WHEN class_id % 2 = 0 THEN 9 ELSE 8 END AS high, max(level) <= CASE WHEN class_id % 2 = 0 THEN 9 ELSE 8 END AS inside FROM entries GROUP BY class_id",
    "duplicate_levels": f"WITH {ENTRIES_SQL} SELECT class_id, id, level, count(*) AS n FROM entries GROUP BY ALL HAVING count(*) > 1",
    "in_class_conflicts": f"WITH {ENTRIES_SQL} SELECT id, class_id, min(level) AS kept, max(level) AS dropped, count(DISTINCT level) AS n FROM entries GROUP BY id, class_id HAVING count(DISTINCT level) > 1",
    "partition_check": f"{BASE_SQL} SELECT count(*) FILTER (n > 1) AS n_shared, count(*) FILTER (n = 1) AS n_exclusive, count(*) FILTER (n IS NULL) AS n_missing, count(*) FILTER (o IS NULL) AS n_outside FROM per FULL JOIN (SELECT DISTINCT o_orderkey AS o FROM orders) ON o = id",
    "dense_codes": "SELECT p_type AS value, row_number() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)",
    "volumetry": f"WITH {ENTRIES_SQL} SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, round(count(*)::DOUBLE / count(DISTINCT id), 4) AS ratio FROM entries",
    "strata": f"WITH {ENTRIES_SQL}, b AS (SELECT level, coalesce(school, '-') AS school FROM entries QUALIFY row_number() OVER (PARTITION BY id ORDER BY level, coalesce(school, '-')) = 1) SELECT school, level, count(*) AS n FROM b GROUP BY ALL",
    "stable_slug": "WITH b AS (SELECT DISTINCT s_name AS name, 's-' || right(s_name, 1) AS base, min(s_suppkey) AS pos FROM supplier GROUP BY ALL), r AS (SELECT name, base, row_number() OVER (PARTITION BY base ORDER BY pos, name) AS n FROM b) SELECT name, CASE WHEN n = 1 THEN base ELSE base || '-' || n::VARCHAR END AS slug FROM r",
    "level_runs": f"""WITH {ENTRIES_SQL}, v AS (SELECT DISTINCT class_id, school, level FROM entries),
g AS (SELECT *, level - row_number() OVER (PARTITION BY class_id, school ORDER BY level) AS g FROM v),
r AS (SELECT class_id, school, min(level) AS a, max(level) AS b, count(*) AS n, string_agg(level::VARCHAR, ',' ORDER BY level) AS s FROM g GROUP BY class_id, school, g)
SELECT class_id, school, string_agg(CASE WHEN n >= 3 THEN a::VARCHAR || '-' || b::VARCHAR ELSE s END, ',' ORDER BY a) AS levels FROM r GROUP BY class_id, school""",
}
