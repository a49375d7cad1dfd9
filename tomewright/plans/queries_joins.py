"""Queries over reconciliation, merges, text, quality, rules, sheets, graphs, search and pages, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tomewright.functions import text
from tomewright.operators import acquisition, graph, html, index, quality, reconcile, rules, search, sheet
from tomewright.sources.tables import ENTRIES_SQL, SPELLS_SQL, entries, load, spells

CL_SQL = f"WITH {ENTRIES_SQL}, cl AS (SELECT id, class_id, min(level) AS level FROM entries GROUP BY id, class_id)"


def page_levels(spark, d):
    part = load(spark, d, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 7 != 0, F.col("p_size") % 10).alias("level"))
    return part


def reconcile_levels(spark, d):
    lines = load(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.min(F.floor("l_quantity").cast("int") % 10).alias("level"))
    return reconcile.agreement(lines, page_levels(spark, d), ["id"], "level").select("id", "level", "other_level", F.coalesce(F.col("agree").cast("string"), F.lit("null")).alias("agree"))


def view_status(spark, d):
    labels = load(spark, d, "labels")
    docs = load(spark, d, "documents").select("doc_id", "lang")
    made = reconcile.with_status(docs, labels, "doc_id", ~((F.col("toxic") == 1) & (F.col("quality") == 1)))
    return made.select("doc_id", "lang", "status", F.col("payload.quality").alias("quality"))


def _verdicts(spark, d, shift):
    status = F.element_at(F.array(F.lit("eligible"), F.lit("manual_check"), F.lit("ineligible")), ((F.col("o_orderkey") + shift * (F.col("o_orderkey") % 5 == 0).cast("int")) % 3 + 1).cast("int"))
    rows = load(spark, d, "orders").where(F.col("o_orderkey") % 11 != shift)
    return rows.select("o_custkey", "o_orderkey", status.alias("status"), F.concat(F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 7 == shift, "*").otherwise("")).alias("reasons"))


def verdict_diff(spark, d):
    return reconcile.verdict_diff(_verdicts(spark, d, 0), _verdicts(spark, d, 1), ["o_custkey", "o_orderkey"], ["eligible", "manual_check"], "ineligible").groupBy("kind").agg(F.count("*").alias("n"))


def _replica(spark, d, side):
    o = load(spark, d, "orders").where(F.col("o_orderkey") % 3 != side)
    shifted = F.timestamp_add("DAY", F.lit(1 - 2 * side) * (F.col("o_custkey") % 4).cast("int"), F.col("o_orderdate"))
    return o.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("ab"[side]), F.col("o_orderpriority")).alias("name"), shifted.alias("modified"), F.col("o_orderdate").alias("created"), F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 2 == side), F.timestamp_add("DAY", F.lit(1), F.col("o_orderdate"))).alias("deleted"))


def favourites_merge(spark, d):
    return reconcile.merge_two_sides(_replica(spark, d, 0), _replica(spark, d, 1), "id").select("id", "name", F.unix_seconds(F.col("modified").cast("timestamp")).alias("modified"), F.unix_seconds(F.col("created").cast("timestamp")).alias("created"))


def _digests(spark, d, every):
    return load(spark, d, "customer").where(F.col("c_custkey") % every != 1).select(F.col("c_custkey").alias("id"), F.concat("c_mktsegment", F.when(F.col("c_custkey") % every == 2, F.lit(every)).otherwise(0).cast("string")).alias("digest"))


def sheet_merge(spark, d):
    return reconcile.sheet_merge(_digests(spark, d, 7), _digests(spark, d, 5), _digests(spark, d, 9), "id")


def registry_differences(spark, d):
    c, s = load(spark, d, "customer"), load(spark, d, "supplier")
    return reconcile.set_differences({"rich": c.where("c_acctbal > 9500").select(F.col("c_nationkey").alias("k")), "supply": s.select(F.col("s_nationkey").alias("k")), "poor": c.where("c_acctbal < -900").select(F.col("c_nationkey").alias("k"))}, "k")


def evidence(spark, d):
    return quality.evidence(load(spark, d, "documents").select("doc_id", "text"), load(spark, d, "benchmark").select("item_id", F.col("text").alias("quote")), "text", "quote")


def record_verdict(spark, d):
    rules_ = {
        "no_school": F.col("school").isNull(),
        "no_level": F.col("level").isNull(),
        "odd_school": quality.outside(F.col("school"), [f"Brand#{a}{b}" for a in range(1, 5) for b in range(1, 6)]),
        "odd_tag": quality.any_outside(F.col("components"), ["LARGE", "SMALL", "MEDIUM", "ECONOMY", "PROMO", "STANDARD", "STEEL", "BRASS", "COPPER", "NICKEL"]),
    }
    return quality.record_verdict(spells(spark, d), "id", rules_)


def anomalies(spark, d):
    o = load(spark, d, "orders")
    checks = {"A1": ("blocking", F.col("o_totalprice") < 0), "A2": ("warning", F.col("o_totalprice") > 300000), "A3": ("info", F.col("o_orderpriority") == "1-URGENT")}
    return quality.anomalies(o, "o_orderkey", checks)


def families(spark, d):
    p = load(spark, d, "part")
    return p.select(F.col("p_partkey").alias("id"), text.family(F.col("p_type"), {"promo": "offer", "standard": "plain", "economy": "plain"}, "other").alias("family"), text.slug(F.concat("p_name", F.lit(" É "), "p_brand")).alias("slug"), text.bag_key(F.col("p_type"), ["large"]).alias("key"))


def text_parses(spark, d):
    c = load(spark, d, "customer")
    raw = F.concat_ws(", ", F.concat(F.lit("Bard "), (F.col("c_custkey") % 10).cast("string")), F.concat(F.lit("Pal "), (F.col("c_nationkey") % 10).cast("string")), F.lit("Bard 9"))
    levels = text.parse_levels(raw)
    parts = text.split_top_level(F.concat("c_name", F.lit(", x (a, b); "), "c_mktsegment", F.lit(",")))
    says = F.when(F.col("c_custkey") % 4 == 0, "oui").when(F.col("c_custkey") % 4 == 1, "Non (voir texte)").when(F.col("c_custkey") % 4 == 2, "oui ou non").otherwise("-")
    return c.select(
        "c_custkey", F.try_element_at(levels, F.lit("bard")).alias("bard"), F.try_element_at(levels, F.lit("pal")).alias("pal"), F.array_join(parts, "|").alias("parts"),
        F.coalesce(text.tri_state(says).cast("string"), F.lit("null")).alias("says"), text.metres(F.concat((F.col("c_nationkey")).cast("string"), F.lit(",5 m"))).alias("metres"),
    )


def kleene(spark, d):
    p = spells(spark, d)
    a, b, c = F.col("level") > 4, F.col("school") == "Brand#11", F.col("cost") > 950
    show = lambda x: F.coalesce(x.cast("string"), F.lit("null"))
    return p.select("id", show(rules.kleene_any([a, b, c])).alias("any"), show(rules.kleene_all(F.array(a, b, c))).alias("all"), rules.verdict(rules.kleene_all([a, b, c])).alias("verdict"))


def progression(spark, d):
    p = load(spark, d, "part")
    kind = F.element_at(F.array(F.lit("fast"), F.lit("medium"), F.lit("slow")), (F.col("p_partkey") % 3 + 1).cast("int"))
    bonus = rules.attack_bonus(F.col("p_size"), kind)
    size = F.element_at(F.array(*[F.lit(s) for s in rules.SIZES]), (F.col("p_partkey") % 6 + 1).cast("int"))
    return p.select(
        F.col("p_partkey").alias("id"), bonus.alias("bonus"), F.array_join(F.transform(sheet.attack_series(bonus), lambda x: x.cast("string")), "/").alias("series"),
        rules.ability_modifier(F.col("p_size")).alias("modifier"),
        rules.skill_budget(F.lit(2), F.when(F.col("p_size") % 7 != 0, F.col("p_size")), (F.col("p_size") % 20 + 1), F.col("p_size") % 2 == 0).alias("skills"),
        rules.compare_size(size, F.lit("M"), F.lit("min")).alias("large_enough"),
    )


POSITION = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _bonuses(spark, d):
    return load(spark, d, "lineitem").select(F.col("l_orderkey").alias("owner"), F.col("l_returnflag").alias("kind"), (F.floor("l_quantity").cast("int") - 25).alias("value"), *POSITION)


def bonus_stacking(spark, d):
    rules_ = spark.createDataFrame([("A", True), ("R", False)], "kind string, cumulative boolean")
    return sheet.stacked_totals(_bonuses(spark, d), rules_, "owner", "kind", "value", POSITION)


def range_modifier(spark, d):
    ranges = spark.createDataFrame([(0, 5, -2), (6, 12, 0), (13, 30, 3), (31, 45, 5)], "low int, high int, modifier int")
    return sheet.range_lookup(load(spark, d, "part").select("p_partkey", "p_size"), ranges, "p_size")


def slot_allocation(spark, d):
    p = load(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 20 + 1).cast("int").alias("level"), (F.col("s_nationkey") == 3).alias("human"))
    return sheet.feat_slots(p, "s_suppkey", "level", F.col("human"), F.array(F.lit(2), F.lit(6), F.lit(10))).groupBy("s_suppkey", "source").agg(F.count("*").alias("n"), F.max("level").cast("int").alias("last"))


def _edges(spark, d):
    """Each part needs its half and its third, but for one in eleven; reach stays near n times log n squared."""
    p = load(spark, d, "part").select(F.col("p_partkey").alias("dst"))
    both = p.select(F.explode(F.array(*[F.floor(F.col("dst") / k).cast("long") for k in (2, 3)])).alias("src"), "dst")
    return both.where("src > 0 AND src % 11 <> 5 AND dst % 11 <> 5").distinct()


def _nodes(spark, d):
    return load(spark, d, "part").select(F.col("p_partkey").alias("node"))


def adjacency(spark, d):
    even = _nodes(spark, d).where("node % 2 = 0")
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), "|")
    return graph.adjacency(_edges(spark, d), even).select("node", join("parents").alias("parents"), join("children").alias("children"))


def _requirements(spark, d):
    """Half or third: alternatives of one part for even nodes, parts of their own for odd ones; the half comes first."""
    half = F.col("src") == F.floor(F.col("dst") / 2)
    part = F.when(F.col("dst") % 2 == 0, F.lit(0).cast("long")).otherwise(F.col("src"))
    return _edges(spark, d).select(F.col("dst").alias("node"), part.alias("part"), F.when(half, 0).otherwise(1).alias("place"), F.col("src").alias("prerequisite"))


def cheapest_cost(spark, d):
    return acquisition.costs(_requirements(spark, d), _nodes(spark, d)).select("node", "cost")


def graph_catalogue(spark, d):
    groups = _requirements(spark, d).where("node % 2 = 0").drop("place")
    return graph.catalogue_of(_edges(spark, d), groups)


EDGES_SQL = "e AS (SELECT DISTINCT p_partkey // k AS src, p_partkey AS dst FROM part, unnest([2, 3]) AS u(k) WHERE p_partkey // k > 0 AND (p_partkey // k) % 11 <> 5 AND p_partkey % 11 <> 5)"
REACH_SQL = f"WITH RECURSIVE {EDGES_SQL}, reach AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM reach AS r JOIN e ON e.src = r.dst)"


def search_names(spark, d):
    made = search.token_index(load(spark, d, "part"), "p_partkey", "p_name")
    hits = search.ranked(made, "p_partkey", ["blu", "bolts"], 100)
    aliases = spark.createDataFrame([("douze", 5), ("douze", 12), ("autre", 7)], "alias string, p_partkey long")
    return search.alias_then_ranked(hits, aliases, "p_partkey", "douze").select("p_partkey", F.when(F.col("score") < float("inf"), F.round("score", 4)).alias("score"))


def html_text(spark, d):
    return html.page_texts(load(spark, d, "pages"), "page_id", "html")


def html_parts(spark, d):
    h = F.col("html")
    return load(spark, d, "pages").select("page_id", F.element_at(F.array_append(html.headings(h), F.lit("")), 1).alias("title"), F.size(html.links(h)).cast("long").alias("n_links"), F.coalesce(html.page_gate(h, 2000, ["<article", "<h1"]), F.lit("ok")).alias("gate"))


QUERIES = {
    "reconcile_levels": reconcile_levels,
    "level_spread": lambda s, d: reconcile.spread(entries(s, d), ["id", "class_id"], "level"),
    "orphans": lambda s, d: reconcile.orphans(load(s, d, "orders").select(F.col("o_orderkey").alias("k")), load(s, d, "lineitem").select(F.col("l_orderkey").alias("k")), "k"),
    "view_status": view_status,
    "class_compare": lambda s, d: reconcile.compare_classes(index.class_levels(entries(s, d)), [1, 2, 3]),
    "verdict_diff": verdict_diff,
    "favourites_merge": favourites_merge,
    "sheet_merge": sheet_merge,
    "registry_differences": registry_differences,
    "changes": lambda s, d: reconcile.changes(_digests(s, d, 7), _digests(s, d, 5), "id", "digest"),
    "evidence_contains": evidence,
    "record_verdict": record_verdict,
    "error_summary": lambda s, d: quality.error_summary(record_verdict(s, d), "id"),
    "anomalies": anomalies,
    "anomaly_verdict": lambda s, d: quality.verdict(anomalies(s, d)),
    "corpus_fingerprint": lambda s, d: quality.fingerprint_by_bucket(load(s, d, "part"), ["p_partkey", "p_name", "p_type"]),
    "text_hash": lambda s, d: load(s, d, "documents").select("doc_id", quality.text_hash(F.col("text")).alias("digest")),
    "families": families,
    "text_parses": text_parses,
    "kleene_logic": kleene,
    "progression": progression,
    "bonus_stacking": bonus_stacking,
    "range_modifier": range_modifier,
    "slot_allocation": slot_allocation,
    "closure_leverage": lambda s, d: graph.leverage(_edges(s, d), _nodes(s, d)),
    "hub_paths": lambda s, d: graph.hubs(_edges(s, d)),
    "waves": lambda s, d: graph.waves(_edges(s, d), _nodes(s, d), 6),
    "isolated_nodes": lambda s, d: graph.isolated(_nodes(s, d), _edges(s, d)),
    "requirement_cost": lambda s, d: graph.requirement_cost(_edges(s, d), _nodes(s, d)),
    "hub_sizes": lambda s, d: graph.hub_sizes(graph.hubs(_edges(s, d))),
    "adjacency": adjacency,
    "cheapest_cost": cheapest_cost,
    "graph_catalogue": graph_catalogue,
    "alias_then_fuzzy": search_names,
    "html_text": html_text,
    "html_parts": html_parts,
}

_STATUS_SQL = "['eligible', 'manual_check', 'ineligible'][(o_orderkey + {k} * (o_orderkey % 5 = 0)::INT) % 3 + 1]"
_DIG_SQL = "{n} AS (SELECT c_custkey AS id, c_mktsegment || (CASE WHEN c_custkey % {k} = 2 THEN {k} ELSE 0 END)::VARCHAR AS digest FROM customer WHERE c_custkey % {k} <> 1)"
ORACLES = {
    "reconcile_levels": """WITH l AS (SELECT l_partkey AS id, min(floor(l_quantity)::INT % 10) AS level FROM lineitem GROUP BY 1), p AS (SELECT p_partkey AS id, CASE WHEN p_size % 7 <> 0 THEN p_size % 10 END AS o FROM part)
SELECT id, level, o AS other_level, coalesce((level = o)::VARCHAR, 'null') AS agree FROM l LEFT JOIN p USING (id)""",
    "level_spread": f"WITH {ENTRIES_SQL} SELECT id, class_id, count(DISTINCT level) AS n_values, min(level) AS least, max(level) AS most FROM entries GROUP BY id, class_id HAVING count(DISTINCT level) > 1",
    "orphans": "SELECT 'left' AS side, o_orderkey AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT DISTINCT 'right', l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)",
    "view_status": "SELECT d.doc_id, lang, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN toxic = 1 AND quality = 1 THEN 'invalid' ELSE 'ok' END AS status, CASE WHEN NOT (toxic = 1 AND quality = 1) THEN quality END AS quality FROM documents AS d LEFT JOIN labels AS l ON l.doc_id = d.doc_id",
    "class_compare": f"{CL_SQL} SELECT id, count(*) AS n_holders, CASE count(*) WHEN 3 THEN 'shared' WHEN 1 THEN 'exclusive' ELSE 'partial' END AS part, CASE WHEN count(*) > 1 THEN max(level) - min(level) END AS gap FROM cl WHERE class_id IN (1, 2, 3) GROUP BY id",
    "verdict_diff": f"""WITH a AS (SELECT o_orderkey AS k, {_STATUS_SQL.format(k=0)} AS s, o_orderpriority || CASE WHEN o_orderkey % 7 = 0 THEN '*' ELSE '' END AS r FROM orders WHERE o_orderkey % 11 <> 0),
b AS (SELECT o_orderkey AS k, {_STATUS_SQL.format(k=1)} AS s, o_orderpriority || CASE WHEN o_orderkey % 7 = 1 THEN '*' ELSE '' END AS r FROM orders WHERE o_orderkey % 11 <> 1)
SELECT CASE WHEN a.k IS NULL OR b.k IS NULL THEN 'coverage' WHEN a.s <> 'ineligible' AND b.s = 'ineligible' THEN 'regression' WHEN a.s = 'ineligible' AND b.s <> 'ineligible' THEN 'relaxation' WHEN a.s <> b.s THEN 'change' WHEN a.r <> b.r THEN 'noise' ELSE 'same' END AS kind, count(*) AS n FROM a FULL JOIN b ON a.k = b.k GROUP BY 1""",
    "favourites_merge": "WITH " + ", ".join(
        f"""{n} AS (SELECT o_orderkey AS id, '{n}' || o_orderpriority AS name, o_orderdate + to_days({1 - 2 * k} * (o_custkey % 4)::INT) AS m, o_orderdate AS c, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = {k} THEN o_orderdate + INTERVAL 1 DAY END AS d FROM orders WHERE o_orderkey % 3 <> {k})""" for k, n in enumerate("ab")
    ) + """ SELECT id, CASE WHEN b.m IS NOT NULL AND (a.m IS NULL OR b.m > a.m) THEN b.name ELSE a.name END AS name, epoch(greatest(a.m, b.m))::BIGINT AS modified, epoch(least(a.c, b.c))::BIGINT AS created
FROM a FULL JOIN b USING (id) WHERE NOT coalesce(a.d >= coalesce(b.m, a.d), false) AND NOT coalesce(b.d >= coalesce(a.m, b.d), false)""",
    "sheet_merge": f"""WITH {_DIG_SQL.format(n='l', k=7)}, {_DIG_SQL.format(n='r', k=5)}, {_DIG_SQL.format(n='b', k=9)}, j AS (SELECT coalesce(l.id, r.id) AS id, l.digest AS l, r.digest AS r FROM l FULL JOIN r ON l.id = r.id)
SELECT j.id, CASE WHEN l IS NOT DISTINCT FROM r THEN 'same' WHEN digest IS NULL AND r IS NULL THEN 'write_remote' WHEN digest IS NULL AND l IS NULL THEN 'write_local' WHEN r IS NULL AND l = digest THEN 'delete_local' WHEN l IS NULL AND r = digest THEN 'delete_remote' WHEN l = digest THEN 'write_local' WHEN r = digest THEN 'write_remote' ELSE 'conflict' END AS outcome FROM j LEFT JOIN b ON b.id = j.id""",
    "registry_differences": """WITH t AS (SELECT 'rich' AS n, c_nationkey::VARCHAR AS v FROM customer WHERE c_acctbal > 9500 UNION SELECT 'supply', s_nationkey::VARCHAR FROM supplier UNION SELECT 'poor', c_nationkey::VARCHAR FROM customer WHERE c_acctbal < -900),
n AS (SELECT unnest(['rich', 'supply', 'poor']) AS n) SELECT t.n AS left, n.n AS right, t.v AS value FROM t, n WHERE (n.n, t.v) NOT IN (SELECT n, v FROM t)""",
    "changes": f"WITH {_DIG_SQL.format(n='a', k=7)}, {_DIG_SQL.format(n='b', k=5)} SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'delete' WHEN a.id IS NULL THEN 'insert' ELSE 'update' END AS change FROM a FULL JOIN b ON a.id = b.id WHERE a.digest IS DISTINCT FROM b.digest",
    "evidence_contains": "SELECT doc_id, item_id FROM documents AS d, benchmark AS b WHERE contains(d.text, b.text)",
    "record_verdict": f"""WITH {SPELLS_SQL}, e AS (SELECT id, list_filter([CASE WHEN school IS NULL THEN 'no_school' END, CASE WHEN level IS NULL THEN 'no_level' END, CASE WHEN NOT regexp_matches(school, '^Brand#[1-4][1-5]$') THEN 'odd_school' END,
  CASE WHEN NOT list_has_all(['LARGE', 'SMALL', 'MEDIUM', 'ECONOMY', 'PROMO', 'STANDARD', 'STEEL', 'BRASS', 'COPPER', 'NICKEL'], components) THEN 'odd_tag' END], lambda x: x IS NOT NULL) AS e FROM spells) SELECT id, array_to_string(e, '|') AS errors, len(e) = 0 AS ok FROM e""",
    "anomalies": "SELECT 'A1' AS \"check\", 'blocking' AS severity, o_orderkey AS id FROM orders WHERE o_totalprice < 0 UNION ALL SELECT 'A2', 'warning', o_orderkey FROM orders WHERE o_totalprice > 300000 UNION ALL SELECT 'A3', 'info', o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'",
    "anomaly_verdict": "SELECT coalesce(bool_or(o_totalprice < 0), false) AS failed, sum((o_totalprice < 0)::INT + (o_totalprice > 300000)::INT + (o_orderpriority = '1-URGENT')::INT)::BIGINT AS n FROM orders",
    "corpus_fingerprint": "WITH h AS (SELECT md5(p_partkey::VARCHAR || chr(9) || p_name || chr(9) || p_type) AS d FROM part) SELECT ('0x' || d[1:2])::INT AS bucket, count(*) AS n, md5(" + " || ',' || ".join(f"sum(('0x' || d[{a}:{a + 7}])::BIGINT)::BIGINT::VARCHAR" for a in (1, 9, 17, 25)) + ") AS digest FROM h GROUP BY 1",
    "text_hash": "SELECT doc_id, sha256(text) AS digest FROM documents",
    "families": """WITH p AS (SELECT p_partkey AS id, lower(p_type) AS t, lower(p_name || ' e ' || p_brand) AS s FROM part)
SELECT id, CASE WHEN t LIKE 'promo%' THEN 'offer' WHEN t LIKE 'standard%' OR t LIKE 'economy%' THEN 'plain' ELSE 'other' END AS family, trim(regexp_replace(s, '[^a-z0-9]+', '-', 'g'), '-') AS slug,
  coalesce(nullif(array_to_string(list_sort(list_transform(list_filter(string_split(t, ' '), lambda w: w <> 'large'), lambda w: CASE WHEN length(w) > 4 AND w LIKE '%s' AND w NOT LIKE '%ss' THEN left(w, -1) ELSE w END)), '_'), ''), replace(t, ' ', '_')) AS key FROM p""",
    "text_parses": "SELECT c_custkey, (c_custkey % 10)::INT AS bard, c_nationkey % 10 AS pal, c_name || '|x (a, b)|' || c_mktsegment AS parts, ['true', 'false', 'null', 'null'][c_custkey % 4 + 1] AS says, c_nationkey + 0.5::DOUBLE AS metres FROM customer",
    "kleene_logic": f"""WITH {SPELLS_SQL}, k AS (SELECT id, level > 4 AS a, school = 'Brand#11' AS b, cost > 950 AS c FROM spells)
SELECT id, coalesce((a OR b OR c)::VARCHAR, 'null') AS any, coalesce((a AND b AND c)::VARCHAR, 'null') AS all, CASE WHEN (a AND b AND c) IS NULL THEN 'manual_check' WHEN a AND b AND c THEN 'eligible' ELSE 'ineligible' END AS verdict FROM k""",
    "progression": """WITH p AS (SELECT p_partkey AS id, p_size AS z, CASE p_partkey % 3 WHEN 0 THEN p_size WHEN 1 THEN p_size * 3 // 4 ELSE p_size // 2 END AS b, p_partkey % 6 >= 2 AS g FROM part)
SELECT id, b AS bonus, CASE WHEN b >= 1 THEN array_to_string([b - 5 * i FOR i IN range(0, (b - 1) // 5 + 1)], '/') ELSE b::VARCHAR END AS series, floor((z - 10) / 2.0)::INT AS modifier,
  CASE WHEN z % 7 <> 0 THEN (greatest(2 + floor((z - 10) / 2.0)::INT, 1) + (z % 2 = 0)::INT) * (z % 20 + 1) END AS skills, g AS large_enough FROM p""",
    "bonus_stacking": """WITH b AS (SELECT l_orderkey AS owner, l_returnflag AS kind, floor(l_quantity)::INT - 25 AS value, row_number() OVER (PARTITION BY l_orderkey, l_returnflag, floor(l_quantity)::INT < 25 ORDER BY abs(floor(l_quantity)::INT - 25) DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n FROM lineitem),
m AS (SELECT *, kind <> 'R' OR n = 1 AS counts FROM b) SELECT owner, sum(value) FILTER (counts)::BIGINT AS total, count(*) FILTER (counts) AS n_counted, count(*) FILTER (NOT counts) AS n_lost, count(*) FILTER (kind NOT IN ('A', 'R')) AS n_flagged FROM m GROUP BY owner""",
    "range_modifier": "WITH r(low, high, modifier) AS (VALUES (0, 5, -2), (6, 12, 0), (13, 30, 3), (31, 45, 5)) SELECT p_partkey, p_size, modifier FROM part LEFT JOIN r ON p_size BETWEEN low AND high",
    "slot_allocation": """WITH s AS (SELECT s_suppkey, (s_suppkey % 20 + 1)::INT AS level, s_nationkey = 3 AS human FROM supplier),
a AS (SELECT s_suppkey, 'general' AS source, l FROM s, unnest(range(1, level + 1, 2)) AS u(l) UNION ALL SELECT s_suppkey, 'racial', 1 FROM s WHERE human UNION ALL SELECT s_suppkey, 'class', l FROM s, unnest([2, 6, 10]) AS u(l) WHERE l <= level)
SELECT s_suppkey, source, count(*) AS n, max(l)::INT AS last FROM a GROUP BY 1, 2""",
    "closure_leverage": f"{REACH_SQL} SELECT p_partkey AS node, count(dst) AS leverage FROM part LEFT JOIN reach ON src = p_partkey GROUP BY 1",
    "hub_paths": f"""{REACH_SQL}, r AS (SELECT src, count(*) AS n FROM reach WHERE src NOT IN (SELECT dst FROM e) GROUP BY src)
SELECT dst AS node, src AS hub FROM reach JOIN r USING (src) QUALIFY row_number() OVER (PARTITION BY dst ORDER BY n DESC, src DESC) = 1 UNION ALL SELECT src, src FROM r""",
    # sets of nodes in order of their keys, each from those of its half and third
    "cheapest_cost": """WITH RECURSIVE most AS (SELECT max(p_partkey) AS last FROM part), r(k, sets) AS (
  SELECT 0::BIGINT, []::BIGINT[][] UNION ALL
  SELECT k + 1, list_append(sets, list_distinct(list_concat([k + 1], CASE WHEN (k + 1) % 2 = 1 THEN list_concat(coalesce(a, []), coalesce(b, [])) WHEN a IS NULL THEN coalesce(b, []) WHEN len(b) < len(a) THEN b ELSE a END)))
  FROM (SELECT k, sets, CASE WHEN (k + 1) // 2 > 0 AND (k + 1) // 2 % 11 <> 5 AND (k + 1) % 11 <> 5 THEN sets[(k + 1) // 2] END AS a, CASE WHEN (k + 1) // 3 > 0 AND (k + 1) // 3 % 11 <> 5 AND (k + 1) % 11 <> 5 THEN sets[(k + 1) // 3] END AS b FROM r, most WHERE k < last))
SELECT p_partkey AS node, CASE WHEN p_partkey = 0 THEN 1 ELSE len(sets[p_partkey]) END::INT AS cost FROM part, (SELECT sets FROM r ORDER BY k DESC LIMIT 1)""",
    "waves": f"""WITH RECURSIVE {EDGES_SQL}, longest AS (SELECT p_partkey AS node, 1 AS w FROM part WHERE p_partkey NOT IN (SELECT dst FROM e) UNION SELECT e.dst, w + 1 FROM longest JOIN e ON e.src = node)
SELECT node, max(w) AS wave FROM longest GROUP BY 1 HAVING max(w) <= 6""",
    "isolated_nodes": f"WITH {EDGES_SQL} SELECT p_partkey AS node FROM part WHERE p_partkey NOT IN (SELECT src FROM e) AND p_partkey NOT IN (SELECT dst FROM e)",
    "requirement_cost": f"{REACH_SQL} SELECT p_partkey AS node, count(src) + 1 AS cost FROM part LEFT JOIN reach ON dst = p_partkey GROUP BY 1",
    "hub_sizes": f"""{REACH_SQL}, r AS (SELECT src, count(*) AS n FROM reach WHERE src NOT IN (SELECT dst FROM e) GROUP BY src),
h AS (SELECT dst AS node, src AS hub FROM reach JOIN r USING (src) QUALIFY row_number() OVER (PARTITION BY dst ORDER BY n DESC, src DESC) = 1 UNION ALL SELECT src, src FROM r) SELECT hub, count(*) AS n FROM h GROUP BY hub""",
    "adjacency": f"""WITH {EDGES_SQL}, x AS (SELECT * FROM e WHERE src % 2 = 0 AND dst % 2 = 0), p AS (SELECT dst AS node, string_agg(src::VARCHAR, '|' ORDER BY src) AS parents FROM x GROUP BY 1), c AS (SELECT src AS node, string_agg(dst::VARCHAR, '|' ORDER BY dst) AS children FROM x GROUP BY 1)
SELECT node, coalesce(parents, '') AS parents, coalesce(children, '') AS children FROM p FULL JOIN c USING (node)""",
    "graph_catalogue": f"WITH {EDGES_SQL} SELECT dst AS node, CASE WHEN dst % 2 = 0 THEN 'g0' ELSE 'e' || src::VARCHAR END AS part, src AS prerequisite FROM e",
    "alias_then_fuzzy": """WITH t AS (SELECT DISTINCT p_partkey, length(p_name) AS len, unnest(string_split(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g'), ' ')) AS t FROM part),
p AS (SELECT p_partkey, max(len) AS len, max(CASE WHEN t = 'blu' THEN 3 WHEN starts_with(t, 'blu') THEN 2 ELSE 0 END) AS a, max(CASE WHEN t = 'bolts' THEN 3 WHEN starts_with(t, 'bolts') THEN 2 WHEN levenshtein(t, 'bolts') <= 1 THEN 1 ELSE 0 END) AS b FROM t GROUP BY 1),
h AS (SELECT p_partkey, round((a + b) / sqrt(len), 6) AS score FROM p WHERE a > 0 AND b > 0 ORDER BY score DESC, p_partkey LIMIT 100)
SELECT p_partkey, round(score, 4) AS score FROM h WHERE p_partkey NOT IN (5, 12) UNION ALL SELECT unnest([5, 12]), NULL""",
    "html_parts": r"""SELECT page_id, coalesce(trim(regexp_replace(regexp_replace(regexp_extract_all(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)[1], '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), '') AS title,
  len(list_distinct(list_transform(regexp_extract_all(html, '(?i)<a\s[^>]*href=["'']([^"''#]+)', 1), lambda x: replace(x, '&amp;', '&'))))::BIGINT AS n_links,
  CASE WHEN strlen(html) < 2000 THEN 'short' WHEN NOT contains(html, '<article') THEN 'without <article' WHEN NOT contains(html, '<h1') THEN 'without <h1' ELSE 'ok' END AS gate FROM pages""",
}
ORACLES["error_summary"] = ORACLES["record_verdict"].replace("SELECT id, array_to_string(e, '|') AS errors, len(e) = 0 AS ok FROM e", "SELECT c AS code, count(*) AS occurrences, count(DISTINCT id) AS records FROM (SELECT id, unnest(e) AS c FROM e) GROUP BY 1")
