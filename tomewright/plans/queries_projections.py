"""The published index of feats and its checks, characters from sheets and new profiles, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tomewright.functions import text
from tomewright.operators import eligibility, ordering, projections
from tomewright.plans.queries_rules import VOCABULARY, pick, sql_pick
from tomewright.sources.tables import load

SEED = 42


def _feats(spark, d):
    p, k = load(spark, d, "part"), F.col("p_partkey")
    name = F.concat(F.col("p_name"), F.lit(" n"), k.cast("string"), F.when(k % 9 == 0, "*").otherwise(""))
    return p.select(k, name.alias("name"), F.when(F.col("p_size") % 4 != 0, F.col("p_type")).alias("effect"), F.col("p_brand").alias("activation"), F.split("p_name", " ").alias("targets"), F.when(k % 3 != 0, F.array(F.lower("p_type"))).alias("contexts"), "p_size")


def _index(spark, d):
    return projections.feat_index(_feats(spark, d), "name", {"ep": "effect", "ac": "activation"}, {"cb": "targets", "cx": "contexts"}, {"vb": "p_size"})


_join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), "|")


def feat_index(spark, d):
    index, _ = _index(spark, d)
    return index.select("i", "id", "n", "nf", "r", "ep", "ac", _join("cb").alias("cb"), _join("cx").alias("cx"), "vb")


def index_violations(spark, d):
    """The index as it was damaged by hand: places, folded names, codes."""
    index, codes = _index(spark, d)
    k = F.regexp_extract("id", r"n(\d+)$", 1).cast("long")
    damaged = index.withColumns({"i": F.when(k % 50 == 1, F.lit(-1)).otherwise(F.col("i")), "nf": F.when(k % 40 == 2, F.upper("nf")).otherwise(F.col("nf")), "ac": F.when(k % 30 == 3, F.lit(999)).otherwise(F.col("ac"))})
    return projections.index_violations(damaged, codes, ["ep", "ac"], ["cb", "cx"]).where("check <> 'repeated_i'")


def sheet_characters(spark, d):
    """Sheets of customers: classes from their segment, abilities and feats from their numbers."""
    c = load(spark, d, "customer")
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    entry = F.struct(F.concat(F.lit(" "), F.initcap("c_mktsegment")).alias("name"), F.when(k % 7 != 0, n % 20 + 1).alias("level"))
    sheets = c.select(
        k, F.when(k % 5 != 0, F.array(entry)).otherwise(F.array().cast(f"array<struct<name:string,level:{dict(c.dtypes)['c_nationkey']}>>")).alias("classes"), F.when(k % 3 != 0, F.lit(" Nain ")).otherwise(" ").alias("race"), F.lit("").alias("size"),
        F.when(k % 2 == 0, F.lit("loyal")).alias("alignment"), F.lit(None).cast("string").alias("deity"), F.create_map(F.lit("force"), F.when(n % 2 == 0, n + 8), F.lit("sagesse"), F.when(n % 3 == 0, n)).alias("abilities"),
        F.array(F.col("c_name"), F.concat("c_name", F.lit("*")), F.lit("Épée")).alias("feats"),
    )
    x = projections.sheet_character()
    abilities = F.array_join(F.transform(F.map_entries(x["abilities"]), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), "|")
    return sheets.select("c_custkey", x["class"].alias("class"), x["level"].cast("int").alias("level"), x["race"].alias("race"), x["size"].alias("size"), abilities.alias("abilities"), F.array_join(x["known"], "|").alias("known"), x["alignment"].alias("alignment"))


def new_profiles(spark, d):
    s = load(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 20 + 1).cast("int").alias("level"), (F.col("s_nationkey") == 3).alias("human"))
    made = projections.profiles(s, "s_suppkey", F.col("human"), F.array(F.lit(2), F.lit(6), F.lit(10)))
    return made.select("s_suppkey", F.array_join(F.transform("slots", lambda x: F.concat_ws(":", x["source"], x["level"].cast("string"), F.coalesce(x["feat"], F.lit("-")))), "|").alias("slots"))


def class_mentions(spark, d):
    """Texts of parts that lean on a class, grant its ability, or neither, by their words."""
    p, k = load(spark, d, "part"), F.col("p_partkey")
    told = F.when(k % 4 == 0, F.concat(F.lit("sa liste de "), F.col("p_type"))).when(k % 4 == 1, F.concat(F.lit("Niveaux de "), F.substring_index("p_name", " ", 1))).when(k % 4 == 2, F.concat(F.lit("comme avec la capacité, niveau de "), F.col("p_type"))).otherwise(F.col("p_name"))
    return p.select("p_partkey", F.array_join(projections.class_mentions([told, F.col("p_name")], ["small", "large", "red", "blue", "old"]), "|").alias("classes"))


def seeded_draw(spark, d):
    """A draw of parts from each brand by the sequential generator; equal to sampling the sorted members of each in turn."""
    p = load(spark, d, "part").select("p_partkey", "p_brand")
    quota = p.groupBy("p_brand").agg(F.ceil(F.count("*") / 10).cast("int").alias("quota"))
    return ordering.seeded_draw(p, "p_brand", quota, "p_partkey", SEED).select("p_partkey", "p_brand")


SCHOOLS = ["Abjuration", "Divination", "Enchantement", "Évocation", "Illusion", "Invocation", "Nécromancie", "Transmutation", "universelle"]
SAVES, UNITS = ["Volonté", "Vigueur", "Réflexes, 1/2", "aucun", "voir"], ["minutes", "rounds", "heure", "action simple", "fois"]


def canonical_rows(spark, d):
    """Schools, saves, times, components and descriptors of texts that hold each row's own name, type and brand."""
    p, k = load(spark, d, "part"), F.col("p_partkey")
    school = F.concat(pick(SCHOOLS, k), F.lit(" ("), F.col("p_name"), F.lit(") ["), F.col("p_type"), F.lit(", "), F.col("p_brand"), F.lit("]"))
    save, time = F.concat(pick(SAVES, k), F.lit(", "), F.col("p_name")), F.concat(F.col("p_size").cast("string"), F.lit(" "), pick(UNITS, k))
    parts = F.concat(F.when(F.col("p_size") % 2 == 0, F.lit("V, ")).otherwise(F.lit("")), F.lit("g, M ("), F.col("p_name"), F.lit(")"), F.when(k % 3 == 0, F.lit(", DF")).otherwise(F.lit("")))
    split = text.split_school(school)
    return p.select(
        "p_partkey", text.school(school).alias("school"), text.sampling_school(school).alias("group"), text.save_family(save).alias("save"), text.casting_family(time).alias("time"), F.array_join(text.components(parts), "|").alias("components"),
        split["school"].alias("plain"), F.array_join(split["descriptors"], "|").alias("descriptors"),
    )


def class_texts(spark, d):
    """Classes that texts around each row's own name speak of."""
    k = F.col("p_partkey")
    key = F.concat_ws(" ", pick(["le guerrier", "rage et", "ecole de", "guerriers", "un"], k), F.col("p_name"), pick(["pretre", "ou", "magicien", "magiciens"], F.col("p_size")))
    return load(spark, d, "part").select("p_partkey", F.array_join(eligibility.implied_classes(key, VOCABULARY), "|").alias("classes"))


QUERIES = {"canonical_rows": canonical_rows, "class_texts": class_texts, "feat_index": feat_index, "index_violations": index_violations, "sheet_characters": sheet_characters, "new_profiles": new_profiles, "class_mentions": class_mentions, "seeded_draw": seeded_draw}

_FEATS_SQL = """f AS (SELECT p_partkey AS k, p_name || ' n' || p_partkey::VARCHAR || CASE WHEN p_partkey % 9 = 0 THEN '*' ELSE '' END AS n, replace(lower(p_name), ' ', '-') || '-n' || p_partkey::VARCHAR AS id, CASE WHEN p_size % 4 <> 0 THEN p_type END AS ep, p_brand AS ac,
  string_split(p_name, ' ') AS cb, CASE WHEN p_partkey % 3 <> 0 THEN [lower(p_type)] ELSE [] END AS cx, p_size FROM part),
e AS (SELECT ep AS v, dense_rank() OVER (ORDER BY ep) - 1 AS code FROM (SELECT DISTINCT ep FROM f WHERE ep IS NOT NULL)), a AS (SELECT ac AS v, dense_rank() OVER (ORDER BY ac) - 1 AS code FROM (SELECT DISTINCT ac FROM f)),
t AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT unnest(cb) AS v FROM f)), x AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT unnest(cx) AS v FROM f))"""
_WORD = "regexp_matches(x, '(^|[^a-z0-9]){}($|[^a-z0-9])')"
ORACLES = {
    "canonical_rows": f"""WITH r AS (SELECT p_partkey, {sql_pick(SCHOOLS, "p_partkey")} || ' (' || p_name || ') [' || p_type || ', ' || p_brand || ']' AS s, {sql_pick(SAVES, "p_partkey")} || ', ' || p_name AS v, p_size::VARCHAR || ' ' || {sql_pick(UNITS, "p_partkey")} AS t,
  CASE WHEN p_size % 2 = 0 THEN 'V, ' ELSE '' END || 'g, M (' || p_name || ')' || CASE WHEN p_partkey % 3 = 0 THEN ', DF' ELSE '' END AS c FROM part),
h AS (SELECT *, trim(split_part(s, '(', 1)) AS h, translate(lower(v), 'éô', 'eo') AS f FROM r)
SELECT p_partkey, CASE WHEN h LIKE 'univers%' THEN 'universel' ELSE translate(lower(h), 'éô', 'eo') END AS school, CASE WHEN h LIKE 'univers%' THEN 'Universelle' ELSE h END AS "group",
  CASE WHEN f LIKE 'aucun%' THEN 'aucun' WHEN contains(f, 'volonte') THEN 'volonte' WHEN contains(f, 'vigueur') THEN 'vigueur' WHEN contains(f, 'reflexes') THEN 'reflexes' ELSE 'special' END AS save,
  CASE WHEN contains(t, 'action simple') THEN 'action_simple' WHEN contains(t, 'round') THEN 'round' WHEN contains(t, 'minute') THEN 'minute' WHEN contains(t, 'heure') THEN 'heure' ELSE 'special' END AS time,
  concat_ws('|', CASE WHEN contains(c, 'DF') THEN 'FD' END, 'G', 'M', CASE WHEN starts_with(c, 'V') THEN 'V' END) AS components, trim(regexp_replace(s, '\\[[^\\]]*\\]', '')) AS plain, replace(regexp_extract(s, '\\[([^\\]]*)\\]', 1), ', ', '|') AS descriptors FROM h""",
    "class_texts": f"""WITH r AS (SELECT p_partkey, {sql_pick(["le guerrier", "rage et", "ecole de", "guerriers", "un"], "p_partkey")} || ' ' || p_name || ' ' || {sql_pick(["pretre", "ou", "magicien", "magiciens"], "p_size")} AS x FROM part)
SELECT p_partkey, concat_ws('|', CASE WHEN contains(x, 'rage') OR {_WORD.format("barbare")} THEN 'barbare' END, CASE WHEN {_WORD.format("guerrier")} THEN 'guerrier' END, CASE WHEN contains(x, 'ecole') OR {_WORD.format("magicien")} THEN 'magicien' END, CASE WHEN {_WORD.format("pretre")} THEN 'pretre' END) AS classes FROM r""",
    "feat_index": f"""WITH {_FEATS_SQL}
SELECT (row_number() OVER (ORDER BY id) - 1)::INT AS i, id, n, lower(n) AS nf, n LIKE '%*' AS r, e.code::INT AS ep, a.code::INT AS ac, (SELECT string_agg(code::VARCHAR, '|' ORDER BY code) FROM t WHERE list_contains(f.cb, v)) AS cb,
  coalesce((SELECT string_agg(code::VARCHAR, '|' ORDER BY code) FROM x WHERE list_contains(f.cx, v)), '') AS cx, p_size AS vb FROM f LEFT JOIN e ON f.ep = e.v LEFT JOIN a ON f.ac = a.v""",
    "index_violations": f"""WITH {_FEATS_SQL} SELECT 'sparse' AS "check", id FROM f WHERE k % 50 = 1 UNION ALL SELECT 'folded', id FROM f WHERE k % 40 = 2 UNION ALL SELECT 'code', id FROM f WHERE k % 30 = 3
UNION ALL SELECT 'orphan_code', 'ac:' || v FROM a WHERE v NOT IN (SELECT ac FROM f WHERE k % 30 <> 3)""",
    "sheet_characters": """WITH s AS (SELECT *, c_custkey AS k, c_nationkey AS n, c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AS there FROM customer)
SELECT c_custkey, CASE WHEN there THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS class, CASE WHEN there THEN n % 20 + 1 END::INT AS level, CASE WHEN there AND k % 3 <> 0 THEN 'Nain' END AS race, NULL AS size,
  CASE WHEN there AND (n % 2 = 0 OR n % 3 = 0) THEN concat_ws('|', CASE WHEN n % 2 = 0 THEN 'For=' || (n + 8)::VARCHAR END, CASE WHEN n % 3 = 0 THEN 'Sag=' || n::VARCHAR END) END AS abilities, CASE WHEN there THEN lower(c_name) || '|epee' END AS known, CASE WHEN there AND k % 2 = 0 THEN 'loyal' END AS alignment FROM s""",
    "new_profiles": """WITH s AS (SELECT s_suppkey, s_suppkey % 20 + 1 AS level, s_nationkey = 3 AS human FROM supplier)
SELECT s_suppkey, concat_ws('|', array_to_string(['general:' || l::VARCHAR || ':-' FOR l IN range(1, level + 1) IF l % 2 = 1], '|'), CASE WHEN human THEN 'racial:1:-' END, nullif(array_to_string(['class:' || l::VARCHAR || ':-' FOR l IN [2, 6, 10] IF l <= level], '|'), '')) AS slots FROM s""",
    "class_mentions": """WITH c AS (SELECT p_partkey, p_name, lower(p_type) AS t, string_split(p_name, ' ')[1] AS w, p_partkey % 4 AS m FROM part)
SELECT p_partkey, CASE WHEN m = 0 AND t IN ('small', 'large', 'red', 'blue', 'old') THEN t WHEN m = 1 AND w IN ('small', 'large', 'red', 'blue', 'old') THEN w END AS classes FROM c""",
}
