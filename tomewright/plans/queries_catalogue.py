"""Catalogue assembly, record contracts, stores, page parts and selections over whole tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tomewright.functions import text
from tomewright.operators import catalogue, facets, html, index, ordering, reconcile
from tomewright.plans.queries_rules import pick, sql_pick
from tomewright.sources.shared import spread
from tomewright.sources.tables import ENTRIES_SQL, SPELLS_SQL, entries, load, spells

_join = lambda c, by="|": F.array_join(F.transform(c, lambda x: x.cast("string")), by)


def repairs(spark, d):
    """Records after import: broken ones dropped or repaired, supplements joined."""
    p = load(spark, d, "part")
    k = F.col("p_partkey")
    rows = p.select("p_partkey", F.concat("p_name", F.when(k % 3 == 0, "*").otherwise("")).alias("name"), F.when(k % 10 == 0, catalogue.IMPORT_ERROR).otherwise(pick(["-", "For 13", ""], k)).alias("conditions"), F.when(k % 4 == 0, catalogue.IMPORT_ERROR).otherwise("benefit").alias("benefit"))
    scraped = p.where("startswith(p_name, 'red') OR startswith(p_name, 'old')").select(F.concat("p_name", F.lit(" **")).alias("name"), F.concat(F.lit("from "), "p_name").alias("text")).distinct()
    additions = p.where("startswith(p_name, 'large')").select(F.col("p_name").alias("name"), F.array(F.lit("Dex 15"), F.lit("BBA +1")).alias("additions")).distinct()
    fixed = catalogue.valid_rows(catalogue.repaired(rows, "name", "benefit", scraped), ["conditions", "benefit"])
    return catalogue.supplemented(fixed, "name", "conditions", additions).select("p_partkey", "benefit", "effective", _join("added").alias("added"))


def abbreviations(spark, d):
    """Levels that pages give by abbreviation, brought to classes. Abbreviations are return flags and statuses of lines."""
    classes = spark.createDataFrame([(1, "Aa/Bb", "ab"), (2, "Cc", "c"), (3, "Dd", "d")], "class_id int, label string, slug string")
    known = spark.createDataFrame([("A", "a"), ("AF", "c"), ("N", "c"), ("RF", "d")], "abbreviation string, slug string")
    combined = spark.createDataFrame([("Aa/Bb", "AO", 0), ("Aa/Bb", "NF", 1)], "label string, abbreviation string, place int")
    line = load(spark, d, "lineitem")
    levels = line.select(F.col("l_orderkey").alias("id"), F.concat("l_returnflag", "l_linestatus").alias("abbreviation"), (F.floor("l_quantity").cast("int") % 10).alias("level"))
    once = levels.groupBy("id", "abbreviation").agg(F.min("level").alias("level"))
    return catalogue.page_levels(catalogue.bridge(classes, known, combined), once)


def stray_abbreviations(spark, d):
    known = spark.createDataFrame([("AF",), ("AO",), ("NF",)], "abbreviation string")
    out = spark.createDataFrame([("RF",)], "abbreviation string")
    levels = load(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("abbreviation"))
    return catalogue.unknown_abbreviations(levels, known, out)


def registry(spark, d):
    n = load(spark, d, "nation")
    names = n.select(F.concat(F.lit("Clàsse "), "n_nationkey").alias("name"), "n_nationkey")
    lists = n.where("n_nationkey % 3 = 0").select(F.concat(F.lit("classe-"), "n_nationkey").alias("name"), F.concat(F.lit("L"), (F.col("n_nationkey") % 6).cast("string")).alias("spell_list"))
    casters = n.where("n_nationkey % 5 <> 4").select(F.concat(F.lit("CLASSE "), "n_nationkey").alias("name"), (F.col("n_nationkey") % 2 == 0).alias("caster"))
    return catalogue.registry(names, lists, casters)


def flags(spark, d):
    c = load(spark, d, "customer")
    return catalogue.flag_differences(c.where("c_custkey % 7 <> 0").select("c_custkey", (F.col("c_nationkey") % 2 == 0).alias("f")), c.where("c_custkey % 5 <> 0").select("c_custkey", (F.col("c_nationkey") % 3 == 0).alias("f")), "c_custkey", "f")


def slots(spark, d):
    """Wanted assignments against slots, and what a slot of a category may take."""
    c = load(spark, d, "customer")
    held = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("slot"), F.when(F.col("c_custkey") % 2 == 0, (F.col("c_custkey") % 500).cast("string")).alias("feat"))
    wanted = c.select(F.col("c_custkey").alias("slot"), ((F.col("c_custkey") * 7) % 1000).cast("string").alias("feat"))
    return catalogue.assignment_problems(held, wanted).groupBy("problem").agg(F.count("*").alias("n"))


def slot_candidates(spark, d):
    p = load(spark, d, "part")
    verdicts = p.select("p_partkey", pick(["eligible", "ineligible", "manual_check"], F.col("p_size")).alias("status"))
    categories = p.select("p_partkey", F.array(F.lower("p_type"), F.col("p_brand")).alias("categories"))
    return catalogue.slot_candidates(verdicts, categories, "p_partkey", "large")


def hits(spark, d):
    ranked = spells(spark, d).select((F.col("id") * 2).alias("id"), F.col("cost").alias("score"))
    return catalogue.kept_hits(ranked, spells(spark, d), "id", facets.tri_mode(F.col("tags"), include=["LARGE"]))


KEYS = ["id", "nom", "niveau"]


def contracts(spark, d):
    """Records as JSON texts, some with wrong keys, order, ids or file names."""
    p = load(spark, d, "part").withColumn("k", F.col("p_partkey"))
    id_ = F.concat(text.slug(F.col("p_name")), F.when(F.col("k") % 6 == 0, "-2").when(F.col("k") % 7 == 0, "x").otherwise(""))
    pair = lambda n, v: F.concat(F.lit(f'"{n}": '), v)
    q = lambda v: F.concat(F.lit('"'), v, F.lit('"'))
    a, b, c, e = pair("id", q(id_)), pair("nom", q(F.col("p_name"))), pair("niveau", F.col("p_size").cast("string")), pair("extra", F.lit("1"))
    body = F.when(F.col("k") % 5 == 1, F.concat_ws(", ", b, a, c)).when(F.col("k") % 5 == 2, F.concat_ws(", ", a, b)).when(F.col("k") % 5 == 3, F.concat_ws(", ", a, b, c, e)).otherwise(F.concat_ws(", ", a, b, c))
    raw = F.when(F.col("k") % 11 == 0, "{oops").otherwise(F.concat(F.lit("{"), body, F.lit("}")))
    rows = p.select(raw.alias("raw"), F.concat(id_, F.when(F.col("k") % 9 == 0, ".txt").otherwise(".json")).alias("file"))
    return catalogue.record_contract(rows, "raw", "id", "nom", KEYS, "file").groupBy("code").agg(F.count("*").alias("n"))


SPEC = {"id": ("STRING", True, None), "level": ("BIGINT", True, None), "kind": ("STRING", False, ["a", "b"]), "deep.flag": ("BOOLEAN", True, None), "rate": ("DOUBLE", False, None)}


def schema(spark, d):
    k = F.col("c_custkey")
    parts = [
        F.when(k % 3 != 0, F.concat(F.lit('"id": "'), k.cast("string"), F.lit('"'))), F.concat(F.lit('"level": '), F.when(k % 4 == 0, F.lit('"x"')).otherwise(k.cast("string"))), F.concat(F.lit('"kind": "'), pick(["a", "b", "c"], k), F.lit('"')),
        F.when(k % 5 != 0, F.lit('"deep": {"flag": true}')), F.concat(F.lit('"rate": '), pick(["1.5", "null", "true"], k)), F.when(k % 7 == 0, F.lit('"more": [{"secret": 1}]')),
    ]
    raw = F.when(k % 13 == 0, "{").otherwise(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")))
    return load(spark, d, "customer").select("c_custkey", _join(catalogue.schema_errors(raw, SPEC), "; ").alias("errors"), _join(catalogue.forbidden_keys(raw, ["secret", "more", "absent"])).alias("forbidden"))


def stores(spark, d):
    """Stored documents of favourites: their state, the good lists, the active list, migrated values, merges."""
    k = F.col("c_custkey")
    doc = F.concat(F.lit('{"version": '), (k % 3).cast("string"), F.lit(', "lists": [{"id": "a", "name": "A", "ids": ["1", "2"]}, {"name": "B", "ids": []}'), F.when(k % 2 == 0, "").otherwise(', {"id": "c", "ids": ["3"]}'), F.lit("]}"))
    plain = F.lit('{"version": 1, "lists": [{"id": "z", "ids": []}]}')
    raw = F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, "{broken").when(k % 7 == 2, plain).otherwise(doc)
    good = catalogue.good_lists(raw)
    merged = catalogue.merged_ids(F.array(F.lit("1"), k.cast("string")), F.array(F.lit("2"), F.lit("1"), F.lit("2")))
    toggle = catalogue.toggled(F.array(F.lit("1"), F.lit("4")), (k % 5).cast("string"))
    return load(spark, d, "customer").select(
        "c_custkey", catalogue.store_state(raw, 1).alias("state"), F.coalesce(F.size(good), F.lit(-1)).alias("good"), catalogue.active_list(pick(["c", "q"], k), good).alias("active"),
        catalogue.migrated((k % 4).cast("int"), k, {0: lambda x: x + 1, 1: lambda x: x * 2}).cast("long").alias("value"), _join(merged["ids"]).alias("merged"), merged["n_new"].alias("n_new"), _join(toggle).alias("toggled"),
    )


def flat_state(spark, d):
    return catalogue.flattened(spells(spark, d).select("id", "tags"), "id", "tags").select("id", F.col("place").cast("int").alias("place"), "value")


def causes(spark, d):
    return catalogue.divergence_causes(load(spark, d, "orders").select("o_orderstatus", "o_orderpriority"), ["o_orderstatus", "o_orderpriority"], 7)


def usage(spark, d):
    calls = load(spark, d, "events").select(F.when(F.col("event_type").isin("error", "view"), F.col("event_type")).alias("reason"), F.floor("value").cast("long").alias("tokens_in"), F.floor(F.col("value") * 2).cast("long").alias("tokens_out"))
    return catalogue.usage(calls, "reason", ["tokens_in", "tokens_out"])


def batch_check(spark, d):
    p = load(spark, d, "part").select("p_partkey", "p_name", "p_type")
    k = F.col("p_partkey")
    answers = p.where("p_partkey % 6 <> 0").select((k + F.when(k % 10 == 7, 10**7).otherwise(0)).alias("p_partkey"), pick(["a", "b", "zz"], k).alias("tag"), F.when(k % 4 == 0, "").when(k % 4 == 1, "nothing").otherwise(F.upper(F.substring("p_name", 1, 4))).alias("quote"), k.alias("position"))
    again = answers.select("p_partkey", F.lit("b").alias("tag"), F.lit("again").alias("quote"), (F.col("position") + 10**8).alias("position"))
    return catalogue.batch_check(p, answers.unionByName(again), "p_partkey", "tag", "quote", "p_name", ["a", "b"])


def compared(spark, d):
    """Compared classes, widest gap first, and by the level of one class."""
    made = reconcile.compare_classes(index.class_levels(entries(spark, d)), [1, 2, 3])
    return ordering.ranked(made, [F.desc(F.coalesce("gap", F.lit(-1))), F.col("id")], 60).select("id", "gap", "part", "place")


def suggested_axis(spark, d):
    """The first axis in a fixed order that tells rows apart."""
    rows = spells(spark, d)
    axes = {"one": F.lit("x"), "school": F.col("school"), "level": F.col("level").cast("string")}
    made = None
    for k, (name, value) in enumerate(axes.items()):
        row = facets.discriminates(facets.histogram(rows, value)).select(F.lit(k).alias("place"), F.lit(name).alias("axis"), "discriminates")
        made = row if made is None else made.unionByName(row)
    return made.where("discriminates").agg(F.min_by("axis", "place").alias("axis"))


def inverse_index(spark, d):
    made = catalogue.inverse(spells(spark, d).where("school IS NOT NULL"), "school", F.col("tags"))
    return made.select("value", _join("keys").alias("keys"))


def page_entries(spark, d):
    """List items of pages: levels and schools are carried on from the headings above them."""
    key = F.col("c_custkey").cast("string")
    page = F.concat(
        F.lit("<h2>Niveau "), (F.col("c_nationkey") % 9).cast("string"), F.lit("</h2><h3>"), F.col("c_mktsegment"), F.lit("</h3><ul><li><a href='/x"), key, F.lit("'>"), F.col("c_name"),
        F.lit("</a> <sup>A</sup><sup>B</sup> : blurb &amp; <i>more</i></li><li>plain</li></ul><h2>Rien</h2><li class='z'><a href=\"/y\"><b>Deux</b></a></li>"),
    )
    made = html.list_entries(spread(load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_name"), "c_custkey").select("c_custkey", page.alias("page")), "c_custkey", "page")
    return made.select("c_custkey", F.col("place").cast("int").alias("place"), "level", "school", "name", "url", _join("sources").alias("sources"), "blurb", "reason")


def page_parts(spark, d):
    k = F.col("p_partkey")
    lines = F.concat(F.lit("intro\nConditions. "), F.col("p_name"), F.lit("\nAvantage. du "), F.col("p_type"), F.lit("\nsuite\nConditions. encore"))
    value = F.concat(F.col("p_name"), F.lit("\n"), F.repeat(F.lit("x"), (k % 300).cast("int")))
    box = F.concat(F.lit("<div id=a>no</div><div class='box'> in <b>"), F.col("p_name"), F.lit("</b></div><div>z</div>"))
    cut, found = html.last_value_and_prose(value), html.rubrics(lines, ["Conditions", "Avantage"])
    bonus = html.traits(F.concat(F.lit("+2 Force, "), F.when(k % 2 == 0, "–2 en Charisme").otherwise("rien")))
    formula = html.skill_formula(F.concat((k % 9).cast("string"), F.lit(" + mod. d’Int par niveau")))
    return load(spark, d, "part").select(
        "p_partkey", cut["value"].alias("value"), F.coalesce(F.char_length(cut["prose"]), F.lit(0)).alias("prose"), F.try_element_at(found, F.lit("Conditions")).alias("conditions"), F.try_element_at(found, F.lit("Avantage")).alias("benefit"), F.try_element_at(found, F.lit("")).alias("intro"),
        html.stripped(html.inner_html(box, "div", "box")).alias("box"), _join(html.category_names(F.concat(F.lower("p_type"), F.lit(", combat et "), F.col("p_brand"), F.lit("/combat")))).alias("categories"),
        F.array_join(F.transform(bonus, lambda t: F.concat(t["ability"], F.lit("="), t["bonus"].cast("string"))), "|").alias("traits"), formula["points"].alias("points"), formula["ability"].alias("ability"),
    )


def level_labels(spark, d):
    return catalogue.clusters(load(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("l"), F.lit(1).alias("n")), "l", "n", 0.72)


QUERIES = {
    "record_repairs": repairs,
    "abbreviation_levels": abbreviations,
    "stray_abbreviations": stray_abbreviations,
    "class_registry": registry,
    "classes_by_list": lambda s, d: catalogue.classes_by_list(registry(s, d)).select("spell_list", _join("classes").alias("classes")),
    "flag_differences": flags,
    "slot_problems": slots,
    "slot_candidates": slot_candidates,
    "filtered_hits": hits,
    "record_contracts": contracts,
    "schema_errors": schema,
    "favourite_stores": stores,
    "flat_state": flat_state,
    "divergence_causes": causes,
    "call_usage": usage,
    "batch_check": batch_check,
    "compared_by_gap": compared,
    "suggested_axis": suggested_axis,
    "inverse_index": inverse_index,
    "page_entries": page_entries,
    "page_parts": page_parts,
    "label_clusters": level_labels,
}

_REGISTRY_SQL = """r AS (SELECT 'Clàsse ' || n_nationkey::VARCHAR AS name, n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'L' || (n_nationkey % 6)::VARCHAR END AS spell_list, CASE WHEN n_nationkey % 5 <> 4 THEN n_nationkey % 2 = 0 END AS caster FROM nation)"""
_ID = "replace(p_name, ' ', '-') || CASE WHEN p_partkey % 6 = 0 THEN '-2' WHEN p_partkey % 7 = 0 THEN 'x' ELSE '' END"
ORACLES = {
    "record_repairs": """WITH r AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 4 <> 0 THEN 'benefit' WHEN starts_with(p_name, 'red') OR starts_with(p_name, 'old') THEN 'from ' || p_name END AS benefit, ['-', 'For 13', ''][p_partkey % 3 + 1] AS c FROM part WHERE p_partkey % 10 <> 0)
SELECT p_partkey, benefit, CASE WHEN starts_with(p_name, 'large') THEN CASE WHEN c = 'For 13' THEN 'For 13, ' ELSE '' END || 'Dex 15, BBA +1' ELSE c END AS effective, CASE WHEN starts_with(p_name, 'large') THEN 'Dex 15|BBA +1' ELSE '' END AS added FROM r WHERE benefit IS NOT NULL""",
    "abbreviation_levels": """WITH b(class_id, a, place) AS (VALUES (1, 'AO', 0), (1, 'NF', 1), (2, 'AF', 0), (2, 'N', 1), (3, 'RF', 0)), l AS (SELECT l_orderkey AS id, l_returnflag || l_linestatus AS a, min(floor(l_quantity)::INT % 10) AS level FROM lineitem GROUP BY ALL)
SELECT class_id, id, arg_min(level, place) AS level, count(DISTINCT level) > 1 AS spread FROM l JOIN b USING (a) GROUP BY class_id, id""",
    "stray_abbreviations": "SELECT l_returnflag || l_linestatus AS abbreviation, count(*) AS n, CASE WHEN l_returnflag || l_linestatus = 'RF' THEN 'out' ELSE 'unknown' END AS scope FROM lineitem WHERE l_returnflag || l_linestatus NOT IN ('AF', 'AO', 'NF') GROUP BY ALL",
    "class_registry": f"WITH {_REGISTRY_SQL} SELECT *, CASE WHEN caster IS NULL THEN 'caster unknown' WHEN caster AND spell_list IS NULL THEN 'caster without list' WHEN NOT caster AND spell_list IS NOT NULL THEN 'list without caster' END AS curate FROM r",
    "classes_by_list": f"WITH {_REGISTRY_SQL} SELECT spell_list, string_agg(name, '|' ORDER BY name) AS classes FROM r WHERE spell_list IS NOT NULL GROUP BY 1",
    "flag_differences": "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'not curated' WHEN c_custkey % 5 = 0 THEN 'not drafted' ELSE 'differs' END AS problem FROM customer WHERE NOT (c_custkey % 7 = 0 AND c_custkey % 5 = 0) AND (c_custkey % 7 = 0 OR c_custkey % 5 = 0 OR (c_nationkey % 2 = 0) <> (c_nationkey % 3 = 0))",
    "slot_problems": """WITH s AS (SELECT c_custkey AS slot, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 500)::VARCHAR END AS feat FROM customer WHERE c_custkey % 3 <> 0)
SELECT CASE WHEN c_custkey % 3 = 0 THEN 'unknown' WHEN c_custkey % 2 = 0 THEN 'occupied' WHEN ((c_custkey * 7) % 1000)::VARCHAR IN (SELECT feat FROM s WHERE feat IS NOT NULL) THEN 'duplicate' END AS problem, count(*) AS n FROM customer GROUP BY 1""",
    "slot_candidates": "SELECT p_partkey, ['eligible', 'ineligible', 'manual_check'][p_size % 3 + 1] AS status FROM part WHERE p_size % 3 <> 1 AND p_type = 'LARGE'",
    "filtered_hits": f"WITH {SPELLS_SQL} SELECT id * 2 AS id, cost AS score FROM spells WHERE id * 2 IN (SELECT id FROM spells WHERE list_contains(tags, 'LARGE'))",
    "record_contracts": """WITH p AS (SELECT p_partkey AS k FROM part), c AS (SELECT 'unreadable' AS code FROM p WHERE k % 11 = 0 UNION ALL SELECT 'key_order' FROM p WHERE k % 11 <> 0 AND k % 5 = 1 UNION ALL SELECT 'missing_key' FROM p WHERE k % 11 <> 0 AND k % 5 = 2
UNION ALL SELECT 'extra_key' FROM p WHERE k % 11 <> 0 AND k % 5 = 3 UNION ALL SELECT 'id' FROM p WHERE k % 11 <> 0 AND k % 6 <> 0 AND k % 7 = 0 UNION ALL SELECT 'file_name' FROM p WHERE k % 11 <> 0 AND k % 9 = 0) SELECT code, count(*) AS n FROM c GROUP BY 1""",
    "schema_errors": """SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN '$: unreadable' ELSE concat_ws('; ', CASE WHEN c_custkey % 5 = 0 THEN 'deep.flag: missing' END, CASE WHEN c_custkey % 3 = 0 THEN 'id: missing' END, CASE WHEN c_custkey % 3 = 2 THEN 'kind: value' END, CASE WHEN c_custkey % 4 = 0 THEN 'level: type' END, CASE WHEN c_custkey % 3 = 2 THEN 'rate: type' END) END AS errors,
  CASE WHEN c_custkey % 13 <> 0 AND c_custkey % 7 = 0 THEN 'secret|more' ELSE '' END AS forbidden FROM customer""",
    "favourite_stores": """WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN 'absent' WHEN c_custkey % 7 = 1 THEN 'unreadable' WHEN c_custkey % 7 = 2 THEN 'ok' WHEN c_custkey % 3 <> 1 THEN 'version' ELSE 'lists' END AS state FROM customer)
SELECT k AS c_custkey, state, (CASE WHEN state IN ('absent', 'unreadable') THEN -1 WHEN state = 'ok' THEN 1 WHEN k % 2 = 0 THEN 1 ELSE 2 END)::INT AS good, CASE WHEN state IN ('absent', 'unreadable') THEN NULL WHEN state = 'ok' THEN 'z' WHEN k % 2 = 0 THEN 'a' ELSE 'a' END AS active,
  CASE k % 4 WHEN 0 THEN (k + 1) * 2 WHEN 1 THEN k * 2 WHEN 2 THEN k END::BIGINT AS value, CASE WHEN k = 1 THEN '1|2' WHEN k = 2 THEN '1|2' ELSE '1|' || k::VARCHAR || '|2' END AS merged, CASE WHEN k = 2 THEN 0 ELSE 1 END AS n_new,
  CASE k % 5 WHEN 1 THEN '4' WHEN 4 THEN '1' ELSE '1|4|' || (k % 5)::VARCHAR END AS toggled FROM c""",
    "flat_state": f"WITH {SPELLS_SQL} SELECT id, (generate_subscripts(t, 1) - 1)::INT AS place, unnest(t) AS value FROM (SELECT p_partkey AS id, [p_type, string_split(p_name, ' ')[1]] AS t FROM part)",
    "divergence_causes": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT 7",
    "call_usage": """WITH c AS (SELECT CASE WHEN event_type IN ('error', 'view') THEN event_type ELSE 'written' END AS reason, floor(value)::BIGINT AS a, floor(value * 2)::BIGINT AS b FROM events)
SELECT coalesce(reason, 'all') AS reason, count(*) AS calls, sum(a)::BIGINT AS tokens_in, sum(b)::BIGINT AS tokens_out FROM c GROUP BY ROLLUP (reason)""",
    "batch_check": """SELECT p_partkey, CASE WHEN p_partkey % 6 <> 0 AND p_partkey % 10 <> 7 THEN ['a', 'b', NULL][p_partkey % 3 + 1] END AS tag, p_partkey % 6 = 0 OR p_partkey % 10 = 7 OR p_partkey % 4 < 2 AS redo FROM part""",
    "compared_by_gap": f"WITH {ENTRIES_SQL}, cl AS (SELECT id, class_id, min(level) AS level FROM entries GROUP BY id, class_id), g AS (SELECT id, CASE count(*) WHEN 3 THEN 'shared' WHEN 1 THEN 'exclusive' ELSE 'partial' END AS part, CASE WHEN count(*) > 1 THEN max(level) - min(level) END AS gap FROM cl WHERE class_id IN (1, 2, 3) GROUP BY id) SELECT id, gap, part, row_number() OVER (ORDER BY coalesce(gap, -1) DESC, id)::INT AS place FROM g QUALIFY place <= 60",
    "suggested_axis": f"""WITH {SPELLS_SQL}, a AS (SELECT 0 AS place, 'one' AS axis, 'x' AS value FROM spells UNION ALL SELECT 1, 'school', school FROM spells UNION ALL SELECT 2, 'level', level::VARCHAR FROM spells),
g AS (SELECT place, axis, value, count(*) AS n FROM a WHERE value IS NOT NULL GROUP BY ALL), d AS (SELECT place, axis FROM g GROUP BY ALL HAVING count(*) >= 2 AND min(n) < (SELECT count(*) FROM spells)) SELECT min_by(axis, place) AS axis FROM d""",
    "inverse_index": f"WITH {SPELLS_SQL}, t AS (SELECT DISTINCT school, unnest(tags) AS value FROM spells WHERE school IS NOT NULL) SELECT value, string_agg(school, '|' ORDER BY school) AS keys FROM t GROUP BY value",
    "page_entries": """SELECT c_custkey, 2 AS place, c_nationkey % 9 AS level, c_mktsegment AS school, c_name AS name, '/x' || c_custkey::VARCHAR AS url, 'A|B' AS sources, 'blurb & more' AS blurb, NULL AS reason FROM customer
UNION ALL SELECT c_custkey, 3, c_nationkey % 9, c_mktsegment, NULL, NULL, '', 'plain', 'no link' FROM customer UNION ALL SELECT c_custkey, 5, NULL, NULL, 'Deux', '/y', '', NULL, 'no level' FROM customer""",
    "page_parts": """SELECT p_partkey, CASE WHEN p_partkey % 300 >= 200 OR p_partkey % 300 = 0 THEN p_name ELSE p_name || chr(10) || repeat('x', (p_partkey % 300)::INT) END AS value, (CASE WHEN p_partkey % 300 >= 200 THEN p_partkey % 300 ELSE 0 END)::INT AS prose,
  p_name AS conditions, 'du ' || p_type || chr(10) || 'suite' AS benefit, 'intro' AS intro, 'in ' || p_name AS box, lower(p_type) || '|combat|' || p_brand AS categories, 'Force=2' || CASE WHEN p_partkey % 2 = 0 THEN '|Charisme=-2' ELSE '' END AS traits, (p_partkey % 9)::INT AS points, 'Int' AS ability FROM part""",
}
