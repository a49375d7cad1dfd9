"""Faceted filters, counts that ignore their own facet, histograms and orders, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tomewright.operators import facets, index, ordering
from tomewright.plans.spec import QuerySpec
from tomewright.sources.tables import ENTRIES_SQL, SPELLS_SQL, entries, spells

INCLUDE, EXCLUDE, REQUIRE = ["LARGE", "PROMO", "SMALL"], ["small", "hot"], ["LARGE"]
SCHOOLS, LEVELS = ["Brand#11", "Brand#12", "Brand#23"], [1, 2, 3]
_MAP_SQL = f"WITH {ENTRIES_SQL}, cl AS (SELECT id, class_id, min(level) AS level FROM entries GROUP BY id, class_id)"


def levels(spark, d):
    return facets.level_map(index.class_levels(entries(spark, d)))


def sideways(spark, d):
    rows = spells(spark, d)
    return facets.counts_sideways(rows, {
        "school": (facets.scalar_in(F.col("school"), SCHOOLS), F.array("school")),
        "tags": (facets.tri_mode(F.col("tags"), include=INCLUDE), F.col("tags")),
        "level": (F.col("level").isin(*LEVELS), F.array(F.col("level").cast("string"))),
    })


def sorted_nulls_last(spark, d):
    return ordering.ranked(spells(spark, d).select("id", "school", "level"), ordering.nulls_last("level", True, "id"), 40)


def composite(spark, d):
    """A query string through the parser to search, filters, order and page."""
    spec = QuerySpec.parse("q=r&school=Brand%2311,Brand%2312&tags=LARGE,PROMO,SMALL,-hot&niv=0-5&tri=-cost&page=2", page_size=4)
    return spec.apply(spells(spark, d)).select("id", "name", "cost")


QUERIES = {
    "facet_tri_mode": lambda s, d: spells(s, d).where(facets.tri_mode(F.col("tags"), INCLUDE, EXCLUDE, REQUIRE)).select("id"),
    "facet_include": lambda s, d: spells(s, d).where(facets.tri_mode(F.col("tags"), include=INCLUDE)).select("id"),
    "facet_scalar_in": lambda s, d: spells(s, d).where(facets.scalar_in(F.col("school"), SCHOOLS)).select("id", "school"),
    "facet_contains_all": lambda s, d: spells(s, d).where(facets.contains_all(F.col("tags"), ["LARGE", "red"])).select("id"),
    "level_filter_class": lambda s, d: levels(s, d).where(facets.level_of_class(F.col("levels"), 3, LEVELS)).select("id"),
    "level_filter_union": lambda s, d: levels(s, d).where(facets.level_of_any(F.col("levels"), [3, 5], LEVELS)).select("id"),
    "level_filter_min": lambda s, d: levels(s, d).select("id", facets.lowest_level(F.col("levels")).alias("level")).where(F.col("level").isin(*LEVELS)),
    "absolute_exclusives": lambda s, d: levels(s, d).where(F.map_keys("levels") == F.array(F.lit(3))).select("id"),
    "cost_cap": lambda s, d: spells(s, d).where(facets.cost_cap(F.col("cost"), 950.0)).select("id", "cost"),
    "text_contains": lambda s, d: spells(s, d).where(facets.text_contains(F.col("name"), " RING ")).select("id", "name"),
    "facet_counts_sideways": sideways,
    "axis_level_multi": lambda s, d: facets.histogram_of_values(levels(s, d), F.map_values("levels")),
    "axis_level_min": lambda s, d: facets.histogram(levels(s, d), facets.lowest_level(F.col("levels"))),
    "axis_with_null_bucket": lambda s, d: facets.histogram(spells(s, d), F.col("school")),
    "axis_component": lambda s, d: facets.histogram_of_values(spells(s, d), F.col("components")),
    "axis_discriminates": lambda s, d: facets.discriminates(facets.histogram(spells(s, d), F.col("school"))),
    "sort_nulls_last": sorted_nulls_last,
    "sort_default": lambda s, d: ordering.ranked(spells(s, d).select("id", "name", "level"), ordering.nulls_last("level", False, "name") + [F.col("id")], 50),
    "composite_query": composite,
    "top_cost_per_school": lambda s, d: ordering.top_per_group(spells(s, d).select("id", "school", "cost"), "school", [F.desc("cost"), F.col("id")], 3),
}

_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_in = lambda xs: "(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in xs) + ")"
ORACLES = {
    "facet_tri_mode": f"WITH {SPELLS_SQL} SELECT id FROM spells WHERE list_has_any(tags, {_list(INCLUDE)}) AND NOT list_has_any(tags, {_list(EXCLUDE)}) AND list_has_all(tags, {_list(REQUIRE)})",
    "facet_include": f"WITH {SPELLS_SQL} SELECT id FROM spells WHERE list_has_any(tags, {_list(INCLUDE)})",
    "facet_scalar_in": f"WITH {SPELLS_SQL} SELECT id, school FROM spells WHERE school IN {_in(SCHOOLS)}",
    "facet_contains_all": f"WITH {SPELLS_SQL} SELECT id FROM spells WHERE list_has_all(tags, ['LARGE', 'red'])",
    "level_filter_class": f"{_MAP_SQL} SELECT id FROM cl WHERE class_id = 3 AND level IN {_in(LEVELS)}",
    "level_filter_union": f"{_MAP_SQL} SELECT DISTINCT id FROM cl WHERE class_id IN (3, 5) AND level IN {_in(LEVELS)}",
    "level_filter_min": f"{_MAP_SQL} SELECT id, min(level) AS level FROM cl GROUP BY id HAVING min(level) IN {_in(LEVELS)}",
    "absolute_exclusives": f"{_MAP_SQL} SELECT id FROM cl GROUP BY id HAVING count(*) = 1 AND min(class_id) = 3",
    "cost_cap": f"WITH {SPELLS_SQL} SELECT id, cost FROM spells WHERE cost <= 950",
    "text_contains": f"WITH {SPELLS_SQL} SELECT id, name FROM spells WHERE contains(lower(name), 'ring')",
    "facet_counts_sideways": f"""WITH {SPELLS_SQL}, p AS (SELECT *, coalesce(school IN {_in(SCHOOLS)}, false) AS ps, list_has_any(tags, {_list(INCLUDE)}) AS pt, coalesce(level IN {_in(LEVELS)}, false) AS pl FROM spells)
SELECT 'school' AS facet, school AS value, count(*) AS n FROM p WHERE pt AND pl AND school IS NOT NULL GROUP BY 2
UNION ALL SELECT 'tags', t, count(*) FROM p, unnest(tags) AS u(t) WHERE ps AND pl GROUP BY 2
UNION ALL SELECT 'level', level::VARCHAR, count(*) FROM p WHERE ps AND pt AND level IS NOT NULL GROUP BY 2""",
    "axis_level_multi": f"{_MAP_SQL} SELECT level AS value, count(*) AS n FROM (SELECT DISTINCT id, level FROM cl) GROUP BY 1",
    "axis_level_min": f"{_MAP_SQL}, m AS (SELECT id, min(level)::VARCHAR AS value FROM cl GROUP BY id), g AS (SELECT value, count(*) AS n FROM m GROUP BY 1) SELECT value, n, round(100.0::DOUBLE * n / (SELECT count(*) FROM m), 2) AS share FROM g",
    "axis_with_null_bucket": f"WITH {SPELLS_SQL}, g AS (SELECT school AS value, count(*) AS n FROM spells GROUP BY 1) SELECT value, n, round(100.0::DOUBLE * n / (SELECT count(*) FROM spells), 2) AS share FROM g",
    "axis_component": f"WITH {SPELLS_SQL} SELECT c AS value, count(*) AS n FROM (SELECT id, unnest(list_distinct(components)) AS c FROM spells) GROUP BY 1",
    "axis_discriminates": f"WITH {SPELLS_SQL}, g AS (SELECT school, count(*) AS n FROM spells WHERE school IS NOT NULL GROUP BY 1) SELECT count(*) >= 2 AND min(n) < (SELECT count(*) FROM spells) AS discriminates FROM g",
    "sort_nulls_last": f"WITH {SPELLS_SQL} SELECT id, school, level, row_number() OVER (ORDER BY level DESC NULLS LAST, id)::INT AS place FROM spells ORDER BY place LIMIT 40",
    "sort_default": f"WITH {SPELLS_SQL} SELECT id, name, level, row_number() OVER (ORDER BY level NULLS LAST, name, id)::INT AS place FROM spells ORDER BY place LIMIT 50",
    "composite_query": f"WITH {SPELLS_SQL} SELECT id, name, cost FROM spells WHERE contains(lower(name), 'r') AND school IN ('Brand#11', 'Brand#12') AND list_has_any(tags, ['LARGE', 'PROMO', 'SMALL']) AND NOT list_has_any(tags, ['hot']) AND level BETWEEN 0 AND 5 ORDER BY cost DESC NULLS LAST, name, id LIMIT 4 OFFSET 4",
    "top_cost_per_school": f"WITH {SPELLS_SQL} SELECT id, school, cost, row_number() OVER (PARTITION BY school ORDER BY cost DESC, id)::INT AS place FROM spells QUALIFY place <= 3",
}
