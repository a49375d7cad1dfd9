"""Projections of characters, coverage reports, sampled comparisons and constraints over whole tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tomewright.operators import eligibility, reports
from tomewright.plans.queries_rules import VOCABULARY, pick
from tomewright.sources.tables import SPELLS_SQL, load, spells

_join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), "|")


def profiles(spark, d):
    c = load(spark, d, "customer")
    k = F.col("c_custkey")
    slots = c.select("c_custkey", F.explode(F.array(F.when(k % 3 != 0, F.col("c_mktsegment")), F.when(k % 2 == 0, F.lit("b")), F.when(k % 4 == 0, F.lit("b")))).alias("feat"))
    abilities = F.when(k % 5 == 0, F.create_map().cast("map<string,bigint>")).otherwise(F.create_map(F.lit("force"), k, F.lit("sagesse"), k % 20))
    short = reports.abbreviated(abilities)
    named = c.select("c_custkey", reports.character_key(F.lower("c_mktsegment"), F.col("c_nationkey"), F.when(k % 2 == 0, "elfe")).alias("key"), F.try_element_at(short, F.lit("For")).alias("strength"), F.try_element_at(short, F.lit("Sag")).alias("wisdom"), reports.search_text(F.col("c_name"), F.when(k % 3 == 0, "x"), F.lit("z")).alias("text"))
    return named.join(reports.known_from_slots(slots, c, "c_custkey", "feat").select("c_custkey", _join("known").alias("known")), "c_custkey")


def attributions(spark, d):
    """Classes that texts name, or whose capacities they name."""
    key = pick(["le guerrier fort", "rage du barbare", "ecole de magie", "guerriers", "pretre, magicien"], F.col("p_partkey"))
    return load(spark, d, "part").select("p_partkey", _join(eligibility.implied_classes(key, VOCABULARY)).alias("classes"))


def exceptions(spark, d):
    """A report for each order: headings and bullets are its lines."""
    text = F.when(F.col("l_linenumber") == 1, "## Échecs de lecture").when(F.col("l_linenumber") == 4, "## Autres").when(F.col("l_linenumber") % 3 == 0, "prose - x").otherwise(F.concat(F.lit("- `id-"), F.col("l_partkey").cast("string"), F.lit("` raison")))
    lines = load(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey")).select("l_orderkey", "l_linenumber", text.alias("text"))
    return reports.agreed_exceptions(lines, "l_orderkey", "l_linenumber", "text", "checs")


def constraints(spark, d):
    k = F.col("c_custkey")
    six = '"charisme": 1, "constitution": 2, "dexterite": 3, "force": 4, "intelligence": 5, "sagesse": '
    raw = F.concat(F.lit('{"abilities": {' + six), F.when(k % 3 == 0, '"x"').otherwise("6"), F.when(k % 7 == 0, ', "luck": 1').otherwise(""), F.lit('}, "feats": '), pick(['["a", "b"]', "[]", "[1]", '"a"'], k), F.lit("}"))
    return load(spark, d, "customer").select("c_custkey", _join(reports.constraint_problems(raw, ["MACHINERY", "BUILDING"], F.col("c_mktsegment"))).alias("problems"))


def samples(spark, d):
    p = load(spark, d, "part")
    levels = lambda m: F.create_map(F.lit("b"), F.col("p_size") % m, F.lit("a"), F.lit(1))
    return reports.sampled_differences(p.select("p_partkey", levels(10).alias("m")), p.where("p_partkey % 9 <> 0").select("p_partkey", levels(9).alias("m")), "p_partkey", "m", 20, 5)


def _aliases(spark, d):
    return spells(spark, d).where("id % 3 = 0 OR level = 1").select("id")


QUERIES = {
    "character_profiles": profiles,
    "nested_counts": lambda s, d: reports.nested_counts(spells(s, d), "id", "tags"),
    "list_coverage": lambda s, d: reports.list_coverage(spells(s, d).select("id", F.concat_ws("| ", "tags", F.lit(""), F.lit("x")).alias("t")), "id", "t"),
    "class_attributions": attributions,
    "marker_levels": lambda s, d: reports.marker_levels(load(s, d, "part").withColumn("level", F.col("p_size") % 20), "p_brand", "level", "p_name", "^(red|old) ").select("p_brand", _join("levels").alias("levels")),
    "alias_report": lambda s, d: reports.alias_report(spells(s, d), _aliases(s, d), "id", "level", 2),
    "without_alias": lambda s, d: reports.without_alias(spells(s, d), _aliases(s, d), "id", "level", "name", 30),
    "sampled_differences": samples,
    "agreed_exceptions": exceptions,
    "stored_constraints": constraints,
}

_ALIAS_SQL = f"WITH {SPELLS_SQL}, a AS (SELECT id FROM spells WHERE id % 3 = 0 OR level = 1)"
ORACLES = {
    "character_profiles": """SELECT c_custkey, lower(c_mktsegment) || '|' || c_nationkey::VARCHAR || '|' || CASE WHEN c_custkey % 2 = 0 THEN 'elfe' ELSE '' END AS key, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS strength, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 20 END AS wisdom,
  c_name || ' ' || CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE '' END || ' z' AS text, concat_ws('|', CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END, CASE WHEN c_custkey % 2 = 0 THEN 'b' END) AS known FROM customer""",
    "nested_counts": f"WITH {SPELLS_SQL}, t AS (SELECT id, unnest(tags) AS label FROM spells) SELECT label, count(DISTINCT id) AS records, count(*) AS blocks FROM t GROUP BY ROLLUP (label)",
    "list_coverage": f"WITH {SPELLS_SQL}, t AS (SELECT id, unnest(list_append(tags, 'x')) AS value FROM spells) SELECT value, count(DISTINCT id) AS n FROM t GROUP BY 1",
    "class_attributions": "SELECT p_partkey, ['guerrier', 'barbare', 'magicien', '', 'magicien|pretre'][p_partkey % 5 + 1] AS classes FROM part",
    "marker_levels": "WITH t AS (SELECT DISTINCT p_brand, p_size % 20 AS l FROM part WHERE starts_with(p_name, 'red ') OR starts_with(p_name, 'old ')) SELECT p_brand, string_agg(l::VARCHAR, '|' ORDER BY l) AS levels FROM t GROUP BY 1",
    "alias_report": f"{_ALIAS_SQL} SELECT count(*) FILTER (id IN (SELECT id FROM a)) AS covered, count(*) AS total, count(*) FILTER (id IN (SELECT id FROM a) AND level <= 2) AS low_covered, count(*) FILTER (level <= 2) AS low_total FROM spells",
    "without_alias": f"{_ALIAS_SQL} SELECT id, level, name FROM spells WHERE id NOT IN (SELECT id FROM a) ORDER BY coalesce(level, 99), name, id LIMIT 30",
    "sampled_differences": "SELECT p_partkey, p_partkey % 9 <> 0 AND p_size % 10 = p_size % 9 AS same FROM part ORDER BY md5('5|' || p_partkey::VARCHAR), p_partkey LIMIT 20",
    "agreed_exceptions": """WITH l AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p FROM lineitem GROUP BY ALL), h AS (SELECT *, max(CASE WHEN l_linenumber IN (1, 4) THEN l_linenumber END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS under FROM l)
SELECT DISTINCT l_orderkey, 'id-' || p::VARCHAR AS id FROM h WHERE under = 1 AND l_linenumber NOT IN (1, 4) AND l_linenumber % 3 <> 0""",
    "stored_constraints": """SELECT c_custkey, concat_ws('|', CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'BUILDING') THEN 'class' END, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 7 = 0 THEN 'abilities' END, CASE WHEN c_custkey % 4 >= 2 THEN 'feats' END) AS problems FROM customer""",
}
