"""Canonical texts, eligibility and sheet arithmetic over whole tables, each with its SQL.

The synthetic tables hold no rule texts, so each row builds one from its columns; the SQL doesn't parse them but says from the
same columns what they mean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tomewright.functions import text
from tomewright.operators import eligibility, rules, sheet
from tomewright.sources.tables import load


def pick(values: list, by: Column) -> Column:
    """The value at a place that counts on round the list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))


def sql_list(values: list) -> str:
    one = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return "[" + ", ".join(map(one, values)) + "]"


def sql_pick(values: list, by: str) -> str:
    return f"({sql_list(values)})[({by}) % {len(values)} + 1]"


# canonical texts


def fold_keys(spark, d):
    t = F.col("text")
    return load(spark, d, "documents").select("doc_id", *[F.md5(f(t).cast("binary")).alias(n) for n, f in (("normal", text.normal), ("search", text.search_key), ("citation", text.citation_key), ("label", text.label_key))])


# raw text, school, sampling school, save, casting time, components, descriptors, name without stars
FORMS = [
    ("Évocation (froid) [Bien, feu]", "evocation", "Évocation", "special", "special", "", "Évocation (froid)", "Bien|feu"),
    ("universelle", "universel", "Universelle", "special", "special", "", "universelle", ""),
    ("Nécromancie ; ", "", "Nécromancie ;", "special", "special", "", "Nécromancie", ""),
    ("Volonté, annule (M, inoffensif)", "", "Volonté, annule", "volonte", "special", "", "Volonté, annule (M, inoffensif)", ""),
    ("Aucun", "", "Aucun", "aucun", "special", "", "Aucun", ""),
    ("1 action complexe ; voir", "", "1 action complexe ; voir", "special", "action_complexe", "", "1 action complexe ; voir", ""),
    ("10 minutes", "", "10 minutes", "special", "minute", "", "10 minutes", ""),
    ("V, g, M (une fiole d'eau), DF", "", "V, g, m", "special", "special", "FD|G|M|V", "V, g, M (une fiole d'eau), DF", ""),
    ("", None, None, None, None, "", None, ""),
    (None, None, None, None, None, "", None, ""),
]
_KNOWN = [0, 1, 8, 9]


def canonical_forms(spark, d):
    p = load(spark, d, "part")
    raw = pick([f[0] for f in FORMS], F.col("p_partkey"))
    known = F.when((F.col("p_partkey") % len(FORMS)).isin(*_KNOWN), raw)
    split = text.split_school(raw)
    return p.select(
        "p_partkey", text.school(known).alias("school"), text.sampling_school(raw).alias("group"), text.save_family(raw).alias("save"), text.casting_family(raw).alias("time"),
        F.array_join(text.components(raw), "|").alias("components"), split["school"].alias("plain"), F.array_join(split["descriptors"], "|").alias("descriptors"),
        text.feat_name(F.concat(F.lit(" "), F.col("p_name"), F.lit(" ** "))).alias("name"),
    )


CATEGORIES = {"combat": ["LARGE", "gear"], "magic": ["promo", "bolt"], "skill": ["économy"], "none": ["zzz"]}
STRONG, EXCLUDING, WEAK = ["large"], ["red", "blue"], ["bolt", "ring"]
EXACT_KINDS, PREFIX_KINDS = {"trait": ["large ring", "small ring"], "mythic": ["red bolt"]}, {"anatomy": ["large", "old"], "deity": ["blue"]}


def keyword_tags(spark, d):
    p = load(spark, d, "part")
    x = F.concat_ws(" ", "p_name", "p_type")
    graded = text.graded(x, STRONG, EXCLUDING, WEAK)
    near = text.affinity(F.concat(F.lit("plus courant chez les "), F.col("p_name"), pick(["", ", et autres", " comme eux"], F.col("p_partkey")), F.lit(".")), r"chez (.+?)\.")
    return p.select(
        "p_partkey", F.array_join(text.categories(x, CATEGORIES), "|").alias("categories"), graded["holds"].alias("holds"), graded["unsure"].alias("unsure"), F.array_join(graded["matched"], "|").alias("matched"),
        text.ordered_rules(F.col("p_name"), EXACT_KINDS, PREFIX_KINDS, "other").alias("kind"), near["phrase"].alias("phrase"), near["simple"].alias("simple"),
    )


def answers(spark, d):
    """Answers of a model around a record: the object in them, labels a line, and formatted figures."""
    c = load(spark, d, "customer")
    key, name = F.col("c_custkey"), F.col("c_mktsegment")
    body = F.concat(F.lit('{"k": '), key.cast("string"), F.lit("}"))
    answer = F.when(key % 4 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(key % 4 == 1, F.concat(F.lit("Here: "), body, F.lit(" done"))).when(key % 4 == 2, F.lit("{broken}")).otherwise("no object")
    lines = F.concat_ws("\n", F.concat(F.lit("- "), name), F.lit("two words"), F.concat(name, F.lit(":")), F.lit("* b."), F.lit(""), F.concat(F.lit("* "), F.col("c_name")))
    href = F.concat(pick(["http://a/", "//b/", "/c/", "d"], key), key.cast("string"))
    return c.select(
        "c_custkey", text.json_object(answer).alias("object"), F.array_join(text.answer_labels(lines), "|").alias("labels"), text.absolute_url(href, "https://site", "https://site/wiki/").alias("url"),
        text.percent(F.col("c_nationkey"), F.lit(24)).alias("percent"), text.share_label(F.col("c_nationkey"), F.lit(2400)).alias("share"), text.labelled(F.lower("c_mktsegment"), {"machinery": "Machines"}).alias("label"),
        F.array_join(text.in_order(F.array(name, F.lit("X"), F.lit("BUILDING")), ["AUTOMOBILE", "BUILDING", "MACHINERY"]), "|").alias("chosen"),
        text.file_name(F.concat(F.lit(" Ma "), name, F.lit("!")), F.lit("2024-02-03").cast("date"), "liste").alias("file"),
    )


# eligibility

VOCABULARY = eligibility.Vocabulary(
    classes=["barbare", "guerrier", "magicien", "pretre"],
    races=["elfe", "nain", "humain"],
    abilities={"rage": ["barbare"], "ecole": ["magicien"]},
    gates=[("suivant de dahak", "deity", [], True), ("vision", "anatomy", ["vision"], True), ("vision dans le noir", "racial_trait", ["vision dans le noir"], True), ("panache", "no_class_levels", ["guerrier"], True), ("loyal", "alignment", ["loyal"], True), ("lancer des sorts", "spellcasting", [], True), ("arc long", "proficiency", ["arc long", "martiale"], True)],
    fragments=["monture"],
)
FIRST = ["", "For 13 ou Dex 15", "BBA +6", "5 rangs en Perception", "taille M ou plus", "Elfe"]
SECOND = ["", "suivant de Dahak", "capacité de classe rage ou monture", "NLS 3", "guerrier de niveau 4", "aucun niveau dans une classe dotée de panache", "vision dans le noir", "red bolt*", "mystère", "Loyal", "arc long"]


def conditions(key: Column, size: Column) -> Column:
    level = F.concat(F.lit("niveau "), (size % 20 + 1).cast("string"), F.when(size % 9 == 0, " uniquement").otherwise(""))
    return F.array_join(F.filter(F.array(F.when(key % 4 != 0, level).otherwise(""), pick(FIRST, key), pick(SECOND, key)), lambda p: p != ""), ", ")


def feats(spark, d):
    p = load(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_type", conditions(F.col("p_partkey"), F.col("p_size")).alias("conditions"))
    return p, load(spark, d, "part").select("p_name").distinct()


FEATS_SQL = f"""f AS (SELECT p_partkey, p_name, p_size, p_type, CASE WHEN p_partkey % 4 <> 0 THEN CASE WHEN p_size % 9 = 0 THEN 'level_exact' ELSE 'level' END END AS k1, p_size % 20 + 1 AS need,
  p_partkey % {len(FIRST)} AS a, p_partkey % {len(SECOND)} AS b FROM part)"""


def requirement_kinds(spark, d):
    """Options by kind and whether they are a fragment, imply classes, or are gated."""
    rows, names = feats(spark, d)
    parsed = eligibility.catalogue(rows, "p_partkey", "conditions", names, VOCABULARY)
    o = parsed.select("p_partkey", F.explode(F.flatten("parts")).alias("o"))
    return o.groupBy("o.kind", "o.fragment", F.array_join("o.implied", "|").alias("implied"), F.array_join(F.transform("o.gates", lambda g: g["keyword"]), "|").alias("gates")).agg(F.count("*").alias("n"), F.sum("o.value").cast("long").alias("total"))


def characters(spark, d):
    """Distinct characters with how many customers each stands for."""
    c = load(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("people"))
    n, seg = F.col("c_nationkey"), F.col("c_mktsegment")
    of = lambda **by: F.try_element_at(F.create_map(*[F.lit(x) for kv in by.items() for x in kv]), seg)
    race = F.when(n % 4 == 0, "elfe").when(n % 4 == 1, "nain").when(n % 4 == 2, "humain")
    return c.select(
        "people", "c_nationkey", of(MACHINERY="guerrier", BUILDING="magicien", AUTOMOBILE="barbare", FURNITURE="pretre", HOUSEHOLD="inconnu").alias("class"), (n % 20 + 1).alias("level"),
        of(MACHINERY="fast", BUILDING="slow", AUTOMOBILE="fast", FURNITURE="medium").alias("progression"), F.when(seg != "HOUSEHOLD", seg.isin("BUILDING", "FURNITURE")).alias("caster"),
        race.alias("race"), F.lit(None).cast("string").alias("size"), F.when(n % 4 == 1, "P").when(race.isNotNull(), "M").alias("race_size"), F.when(race.isNotNull(), race == "elfe").alias("race_magic"),
        F.when(race.isNotNull(), F.when(race == "humain", "curieux").otherwise("voit: vision dans le noir")).alias("race_traits"),
        F.when(n % 5 != 0, F.create_map(F.lit("For"), n, F.lit("Dex"), F.lit(10) + n % 7)).alias("abilities"), F.when(n % 3 == 0, F.create_map(F.lit("perception"), n % 8)).alias("ranks"),
        F.when(n % 6 != 0, F.array(F.lit("red bolt"), F.lit("x"))).alias("known"), F.when(n % 7 != 0, F.when(n % 2 == 0, "loyal bon").otherwise("chaotique")).alias("alignment"), F.when(n % 8 != 0, F.when(n % 2 == 0, "dahak").otherwise("autre")).alias("deity"),
        F.when(seg != "HOUSEHOLD", F.lit(True)).alias("weapons_simple"), F.when(seg != "HOUSEHOLD", seg == "MACHINERY").alias("weapons_martial"), F.when(seg != "HOUSEHOLD", F.array(F.lit("dague"))).alias("weapons"), F.when(seg != "HOUSEHOLD", seg == "MACHINERY").alias("shields"),
        F.when(race == "elfe", F.array(F.lit("arc long"))).alias("race_weapons"), F.lit(None).cast("string").alias("race_martial"),
    )


CHARACTERS_SQL = """c AS (SELECT c_nationkey AS n, c_mktsegment AS seg, count(*) AS people FROM customer GROUP BY ALL),
ch AS (SELECT people, n, n % 20 + 1 AS level, CASE seg WHEN 'MACHINERY' THEN 'guerrier' WHEN 'BUILDING' THEN 'magicien' WHEN 'AUTOMOBILE' THEN 'barbare' WHEN 'FURNITURE' THEN 'pretre' ELSE 'inconnu' END AS class,
  CASE WHEN seg IN ('MACHINERY', 'AUTOMOBILE') THEN n % 20 + 1 WHEN seg = 'BUILDING' THEN (n % 20 + 1) // 2 WHEN seg = 'FURNITURE' THEN (n % 20 + 1) * 3 // 4 END AS bba,
  CASE n % 4 WHEN 0 THEN 'elfe' WHEN 1 THEN 'nain' WHEN 2 THEN 'humain' END AS race, seg <> 'HOUSEHOLD' AND seg NOT IN ('BUILDING', 'FURNITURE') AND n % 4 <> 0 AS no_magic,
  CASE WHEN n % 5 <> 0 THEN n END AS str, CASE WHEN n % 5 <> 0 THEN 10 + n % 7 END AS dex, CASE WHEN n % 3 = 0 THEN n % 8 ELSE n % 20 + 1 END AS rank FROM c)"""
# what each part says of a character: true, false or null
_FIRST_SQL = "CASE f.a WHEN 0 THEN true WHEN 1 THEN str >= 13 OR dex >= 15 WHEN 2 THEN bba >= 6 WHEN 3 THEN rank >= 5 WHEN 4 THEN CASE WHEN race IS NOT NULL THEN race <> 'nain' END ELSE race = 'elfe' END"
_SECOND_SQL = """CASE f.b WHEN 0 THEN true WHEN 1 THEN CASE WHEN n % 8 <> 0 THEN n % 2 = 0 END WHEN 2 THEN CASE WHEN class <> 'barbare' THEN false END WHEN 3 THEN CASE WHEN no_magic THEN false END
  WHEN 4 THEN class = 'guerrier' AND level >= 4 WHEN 5 THEN class <> 'guerrier' WHEN 6 THEN CASE WHEN race IS NOT NULL THEN race <> 'humain' END WHEN 7 THEN CASE WHEN n % 6 <> 0 THEN true END
  WHEN 8 THEN NULL WHEN 9 THEN CASE WHEN n % 7 <> 0 THEN n % 2 = 0 END ELSE CASE WHEN race = 'elfe' THEN true WHEN class <> 'inconnu' THEN class = 'guerrier' END END"""
PAIRS_SQL = f"""p AS (SELECT people, f.*, ch.*, CASE k1 WHEN 'level' THEN level >= need WHEN 'level_exact' THEN level = need ELSE true END AS ok1, {_FIRST_SQL} AS ok2, {_SECOND_SQL} AS ok3,
  CASE WHEN k1 IS NOT NULL THEN 'niveau ' || need::VARCHAR || CASE k1 WHEN 'level_exact' THEN ' uniquement' ELSE '' END END AS t1, nullif({sql_pick(FIRST, 'f.p_partkey')}, '') AS t2, nullif({sql_pick(SECOND, 'f.p_partkey')}, '') AS t3 FROM f, ch),
v AS (SELECT *, CASE WHEN (ok1 AND ok2 AND ok3) IS NULL THEN 'manual_check' WHEN ok1 AND ok2 AND ok3 THEN 'eligible' ELSE 'ineligible' END AS status,
  CASE WHEN NOT ok1 THEN t1 WHEN NOT ok2 THEN t2 WHEN NOT ok3 THEN t3 ELSE concat_ws(' ; ', CASE WHEN ok1 IS NULL THEN t1 END, CASE WHEN ok2 IS NULL THEN t2 END, CASE WHEN ok3 IS NULL THEN t3 END) END AS reasons FROM p)"""


def parsed_forms(spark, d):
    """Distinct condition texts, parsed, with how many parts have each."""
    rows, names = feats(spark, d)
    forms = rows.groupBy("conditions").agg(F.count("*").alias("entries"))
    return eligibility.catalogue(forms, "conditions", "conditions", names, VOCABULARY)


def eligibility_matrix(spark, d):
    """Every part against every customer: both sides go in as their distinct forms, counts are multiplied."""
    made = eligibility.evaluate(parsed_forms(spark, d), characters(spark, d))
    return made.groupBy("status", "reasons").agg(F.sum(F.col("people") * F.col("entries")).alias("n"))


def entry_gates(spark, d):
    """The gates of the entries themselves: magic, reserved classes, creatures they are made for."""
    rows, names = feats(spark, d)
    own = rows.select("conditions", (F.col("p_size") % 3 == 0).alias("magic"), F.when(F.col("p_size") % 4 == 0, F.array(F.lit("magicien"), F.lit("pretre"))).alias("reserved"), F.when(F.col("p_size") % 5 == 0, F.array(F.lit("Elfes"))).otherwise(F.array().cast("array<string>")).alias("creatures"))
    forms = own.groupBy("conditions", "magic", "reserved", "creatures").agg(F.count("*").alias("entries")).withColumn("form", F.xxhash64("conditions", "magic", "reserved", "creatures"))
    parsed = eligibility.catalogue(forms, "form", "conditions", names, VOCABULARY)
    made = eligibility.evaluate(parsed, characters(spark, d), magic="magic", classes="reserved", affinity="creatures")
    return made.groupBy("status", F.when(F.col("reasons").isin("magic", "class", "affinity"), F.col("reasons")).alias("gate")).agg(F.sum(F.col("people") * F.col("entries")).alias("n"))


def prerequisite_edges(spark, d):
    rows, names = feats(spark, d)
    some = rows.withColumn("conditions", F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("red bolt ou old gear, "), F.col("conditions"))).otherwise(F.col("conditions")))
    parsed = eligibility.catalogue(some, "p_partkey", "conditions", names, VOCABULARY)
    all_, pure = eligibility.prerequisites(parsed, "p_partkey"), eligibility.contract_edges(parsed, "p_partkey")
    return all_.groupBy("p_partkey", "prerequisite").agg(F.bool_or("choice").alias("choice")).join(pure.groupBy("p_partkey", "prerequisite").agg(F.count("*").alias("n_contract")), ["p_partkey", "prerequisite"])


# sheets

SPEEDS = {"lourde": {"9 m": "6 m (4 c)", "6 m": "4,5 m (3 c)"}, "legere": {"9 m": "9 m (6 c)"}}
BODY = ["Moyenne", "Petit", "Très  grand", "TP", "???", "Colossale"]
MODIFIERS = [0, 1, -2, 2, None, -8]


def sheet_defence(spark, d):
    p = load(spark, d, "part").select("p_partkey", "p_size", pick(BODY, F.col("p_partkey")).alias("body"), (F.col("p_size") - 10).alias("x"))
    k, x, body = F.col("p_partkey"), F.col("x"), F.col("body")
    worn = lambda m: F.struct((k % m != 0).alias("worn"), F.when(k % (m + 4) != 0, k % m).alias("bonus"))
    bonuses = F.array(F.struct(F.lit("esquive").alias("kind"), F.lit(1).alias("value")), F.struct(F.lit("armure_naturelle").alias("kind"), F.lit(2).alias("value")))
    armour = sheet.armour_variants(sheet.armour_contributions(worn(3), worn(5), x, F.when(k % 2 == 0, F.lit(4)), body), bonuses)
    base = pick([9.0, 6.0, 7.5], k)
    return p.select(
        "p_partkey", armour["total"].alias("armour"), armour["touch"].alias("touch"), armour["surprised"].alias("surprised"), sheet.saving_throw(F.when(k % 7 != 0, k % 9), x, F.lit(2)).cast("int").alias("save"),
        sheet.speed(base, pick(["lourde", "", "legere", None], k), SPEEDS).alias("speed"), sheet.manoeuvre_bonus(F.lit(5), x, x + 3, body).cast("int").alias("manoeuvre"), sheet.manoeuvre_defence(F.lit(5), x, x + 3, body).cast("int").alias("defence"), sheet.effective(F.col("p_size"), F.lit(None)).cast("int").alias("initiative"),
    )


def sheet_attacks(spark, d):
    p = load(spark, d, "part").withColumn("body", pick(BODY, F.col("p_partkey")))
    k, x = F.col("p_partkey"), F.col("p_size") - 10
    ability = F.when(k % 3 != 0, "force")
    series = sheet.attack_totals(F.col("p_size") % 20, ability, x, F.col("body"), F.lit(1))
    return p.select(
        "p_partkey", F.array_join(F.transform(series, lambda a: a.cast("string")), "/", "null").alias("series"), sheet.damage_bonus(ability, F.when(k % 5 != 0, x), F.lit(2)).cast("int").alias("damage"),
        sheet.skill_total(F.when(k % 4 != 0, k % 6), x, k % 2 == 0, F.lit(1), k % 5 == 0, F.lit(-3)).cast("int").alias("skill"), sheet.spell_difficulty(F.col("p_size") % 10, F.when(k % 6 != 0, x), F.lit(None).cast("int")).cast("int").alias("difficulty"),
        sheet.caster_level(F.when(k % 9 == 0, F.lit(3)), F.slice(F.array(k % 4, k % 5), 1, (k % 3).cast("int"))).cast("int").alias("caster_level"),
    )


def _held(spark, d):
    return load(spark, d, "orders").select(F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("class")).distinct()


def class_skills(spark, d):
    """Owners are customers, their classes the priorities of their orders, of which the table lacks one."""
    grants = load(spark, d, "orders").where("o_orderpriority <> '5-LOW'").select(F.col("o_orderpriority").alias("class"), F.col("o_orderstatus").alias("skill")).where("NOT (class = '1-URGENT' AND skill = 'P')").distinct().where("skill <> 'O' OR class = '2-HIGH'")
    skills = _held(spark, d).select("owner").distinct().withColumn("skill", F.explode(F.array(*[F.lit(s) for s in ("F", "O", "P", "X")])))
    made = sheet.class_skill_answers(skills, _held(spark, d), grants)
    entered = skills.select("owner", "skill", (F.col("owner") % 2 == 0).alias("class_skill"))
    return made.join(sheet.class_skill_suggestions(made, entered), ["owner", "skill"], "left").select("owner", "skill", "granted", "suggested")


def casting(spark, d):
    """Slots by level: what classes give, what the ability adds, whether spells are known."""
    table = spark.createDataFrame([("1-URGENT", True), ("2-HIGH", True), ("3-MEDIUM", False)], "class string, has_slots boolean")
    bonus = spark.createDataFrame([(m, m // 2) for m in range(8)], "modifier int, slots int")
    rows = sheet.caster_state(_held(spark, d), table, "class")
    rows = sheet.bonus_slots(rows.withColumn("modifier", (F.col("owner") % 10).cast("int")), bonus, "modifier").withColumn("level", (F.char_length("class") % 3).cast("int"))
    slots = rows.select("owner", "level", F.when(F.col("state") != "unknown", F.when(F.col("state") == "caster", 2).otherwise(0)).alias("base"), F.col("slots").alias("bonus"))
    known = sheet.known_spells(rows.withColumn("known", F.when(F.col("state") == "caster", 3)), "owner", "level", "known")
    flags = rows.groupBy("owner").agg(F.count_if(F.col("state") == "unknown").alias("unknown"), F.bool_or("missing").alias("missing"))
    return sheet.slot_totals(slots, "owner").join(known, ["owner", "level"]).join(flags, "owner")


def requirement_functions(spark, d):
    """Single rules: skill ranks, class-skill bonus, sizes."""
    p = load(spark, d, "part")
    ranks = F.when(F.col("p_size") % 3 != 0, F.create_map(F.lit("escalade"), F.col("p_size") % 5))
    return p.select("p_partkey", rules.skill_rank(ranks, F.when(F.col("p_size") % 2 == 0, "escalade").otherwise("natation"), F.col("p_size")).alias("rank"), sheet.size_modifier(pick(BODY, F.col("p_partkey"))).alias("modifier"), sheet.size_key(pick(BODY, F.col("p_partkey"))).alias("size"))


QUERIES = {
    "fold_keys": fold_keys,
    "canonical_forms": canonical_forms,
    "keyword_tags": keyword_tags,
    "model_answers": answers,
    "requirement_kinds": requirement_kinds,
    "eligibility_matrix": eligibility_matrix,
    "entry_gates": entry_gates,
    "prerequisite_edges": prerequisite_edges,
    "sheet_defence": sheet_defence,
    "sheet_attacks": sheet_attacks,
    "class_skills": class_skills,
    "casting": casting,
    "requirement_functions": requirement_functions,
}

_FORM = lambda k: sql_pick([f[k] for f in FORMS], "p_partkey")
ORACLES = {
    "fold_keys": r"""WITH t AS (SELECT doc_id, text, lower(strip_accents(text)) AS p FROM documents)
SELECT doc_id, md5(trim(p)) AS normal, md5(trim(regexp_replace(replace(replace(replace(lower(strip_accents(replace(replace(replace(replace(text, 'œ', 'oe'), 'Œ', 'oe'), 'æ', 'ae'), 'Æ', 'ae'))), '''', ' '), '’', ' '), 'ʼ', ' '), '\s+', ' ', 'g'))) AS search,
  md5(trim(regexp_replace(regexp_replace(regexp_replace(p, '[’‘]', '''', 'g'), '[“”]', '"', 'g'), '\s+', ' ', 'g'))) AS citation,
  md5(trim(regexp_replace(trim(regexp_replace(regexp_replace(p, '[’‘ʼ]', '''', 'g'), '\s+', ' ', 'g')), ':+$', ''))) AS label FROM t""",
    "canonical_forms": f"""SELECT p_partkey, CASE WHEN p_partkey % {len(FORMS)} IN (0, 1) THEN {_FORM(1)} END AS school, {_FORM(2)} AS "group", {_FORM(3)} AS save, {_FORM(4)} AS time, {_FORM(5)} AS components, {_FORM(6)} AS plain, {_FORM(7)} AS descriptors, p_name AS name FROM part""",
    "keyword_tags": """WITH p AS (SELECT p_partkey, p_name, lower(p_name || ' ' || p_type) AS x FROM part), m AS (SELECT *, contains(x, 'large') AS s, contains(x, 'red') OR contains(x, 'blue') AS e, contains(x, 'bolt') OR contains(x, 'ring') AS w FROM p)
SELECT p_partkey, concat_ws('|', CASE WHEN contains(x, 'large') OR contains(x, 'gear') THEN 'combat' END, CASE WHEN contains(x, 'promo') OR contains(x, 'bolt') THEN 'magic' END, CASE WHEN contains(x, 'economy') THEN 'skill' END) AS categories, s AS holds, NOT s AND NOT e AND w AS unsure,
  CASE WHEN s THEN 'large' WHEN NOT e AND w THEN concat_ws('|', CASE WHEN contains(x, 'bolt') THEN 'bolt' END, CASE WHEN contains(x, 'ring') THEN 'ring' END) ELSE '' END AS matched,
  CASE WHEN p_name IN ('large ring', 'small ring') THEN 'trait' WHEN p_name = 'red bolt' THEN 'mythic' WHEN starts_with(p_name, 'large') OR starts_with(p_name, 'old') THEN 'anatomy' WHEN starts_with(p_name, 'blue') THEN 'deity' ELSE 'other' END AS kind,
  'les ' || p_name || ['', ', et autres', ' comme eux'][p_partkey % 3 + 1] AS phrase, p_partkey % 3 = 0 AS simple FROM m""",
    "model_answers": """SELECT c_custkey, CASE WHEN c_custkey % 4 < 2 THEN '{"k": ' || c_custkey::VARCHAR || '}' END AS object, c_mktsegment || '|b|' || c_name AS labels,
  ['http://a/', 'https://b/', 'https://site/c/', 'https://site/wiki/d'][c_custkey % 4 + 1] || c_custkey::VARCHAR AS url, format('{:.1f} %', 100.0::DOUBLE * c_nationkey / 24) AS percent,
  CASE WHEN c_nationkey = 0 THEN '0 %' WHEN c_nationkey < 24 THEN '< 1 %' ELSE '1 %' END AS share, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Machines' ELSE lower(c_mktsegment) END AS label,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AUTOMOBILE|BUILDING' WHEN 'MACHINERY' THEN 'BUILDING|MACHINERY' ELSE 'BUILDING' END AS chosen, 'ma-' || lower(c_mktsegment) || '-2024-02-03.json' AS file FROM customer""",
    "requirement_kinds": f"""WITH {FEATS_SQL}, o AS (SELECT k1 AS kind, false AS fragment, '' AS implied, '' AS gates, need AS value FROM f WHERE k1 IS NOT NULL
UNION ALL SELECT 'ability', false, '', '', v FROM f, unnest([13, 15]) AS u(v) WHERE a = 1 UNION ALL SELECT 'attack', false, '', '', 6 FROM f WHERE a = 2 UNION ALL SELECT 'skill', false, '', '', 5 FROM f WHERE a = 3
UNION ALL SELECT 'size', false, '', '', NULL FROM f WHERE a = 4 UNION ALL SELECT 'race', false, '', '', NULL FROM f WHERE a = 5
UNION ALL SELECT 'class_feature', false, '', 'suivant de dahak', NULL FROM f WHERE b = 1 UNION ALL SELECT 'class_feature', false, 'barbare', '', NULL FROM f WHERE b = 2 UNION ALL SELECT 'unparsed', true, '', '', NULL FROM f WHERE b = 2
UNION ALL SELECT 'caster_level', false, '', '', 3 FROM f WHERE b = 3 UNION ALL SELECT 'class_level', false, '', '', 4 FROM f WHERE b = 4 UNION ALL SELECT 'class_feature', false, '', 'aucun niveau dans une classe dotee de panache', NULL FROM f WHERE b = 5
UNION ALL SELECT 'unparsed', false, '', 'vision dans le noir', NULL FROM f WHERE b = 6 UNION ALL SELECT 'entry', false, '', '', NULL FROM f WHERE b = 7 UNION ALL SELECT 'unparsed', false, '', '', NULL FROM f WHERE b = 8
UNION ALL SELECT 'unparsed', false, '', 'loyal', NULL FROM f WHERE b = 9 UNION ALL SELECT 'unparsed', false, '', 'arc long', NULL FROM f WHERE b = 10)
SELECT kind, fragment, implied, gates, count(*) AS n, sum(value)::BIGINT AS total FROM o GROUP BY ALL""",
    "eligibility_matrix": f"WITH {FEATS_SQL}, {CHARACTERS_SQL}, {PAIRS_SQL} SELECT status, reasons, sum(people)::BIGINT AS n FROM v GROUP BY ALL",
    "entry_gates": f"""WITH {FEATS_SQL}, {CHARACTERS_SQL}, {PAIRS_SQL}, g AS (SELECT people, status, CASE WHEN status = 'ineligible' THEN NULL WHEN p_size % 3 = 0 AND a <> 5 AND no_magic THEN 'magic'
  WHEN p_size % 4 = 0 AND class NOT IN ('magicien', 'pretre') THEN 'class' WHEN p_size % 5 = 0 AND a <> 5 AND race IS DISTINCT FROM 'elfe' THEN 'affinity' END AS gate FROM v)
SELECT CASE WHEN gate IS NOT NULL THEN 'ineligible' ELSE status END AS status, gate, sum(people)::BIGINT AS n FROM g GROUP BY ALL""",
    "prerequisite_edges": f"""SELECT p_partkey, u.x AS prerequisite, bool_or(choice) AS choice, count(DISTINCT choice) AS n_contract FROM (SELECT p_partkey, unnest(['red bolt', 'old gear']) AS x, true AS choice FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT p_partkey, 'red bolt', false FROM part WHERE p_partkey % {len(SECOND)} = 7) AS u WHERE x IN (SELECT p_name FROM part) GROUP BY ALL""",
    "sheet_defence": f"""WITH p AS (SELECT p_partkey, p_partkey AS k, p_size, p_size - 10 AS x, {sql_pick(MODIFIERS, 'p_partkey')} AS m, p_partkey % 6 = 3 AS small FROM part),
c AS (SELECT *, CASE WHEN k % 3 = 0 THEN 0 WHEN k % 7 <> 0 THEN k % 3 END AS a, CASE WHEN k % 5 = 0 THEN 0 WHEN k % 9 <> 0 THEN k % 5 END AS s, CASE WHEN k % 2 = 0 THEN least(x, 4) ELSE x END AS dx FROM p),
t AS (SELECT *, 10 + a + s + dx + m + 3 AS whole FROM c)
SELECT p_partkey, whole::INT AS armour, (whole - a - s - 2)::INT AS touch, (whole - dx - 1)::INT AS surprised, (CASE WHEN k % 7 <> 0 THEN k % 9 END + x + 2)::INT AS save,
  CASE WHEN k % 4 IN (1, 3) THEN [9.0, 6.0, 7.5][k % 3 + 1] WHEN k % 4 = 0 THEN [6.0, 4.5, NULL][k % 3 + 1] ELSE [9.0, NULL, NULL][k % 3 + 1] END::DOUBLE AS speed,
  (5 + CASE WHEN small THEN x + 3 ELSE x END - m)::INT AS manoeuvre, (15 + 2 * x + 3 - m)::INT AS defence, p_size AS initiative FROM t""",
    "sheet_attacks": f"""WITH p AS (SELECT p_partkey, p_partkey AS k, p_size, p_size - 10 AS x, {sql_pick(MODIFIERS, 'p_partkey')} AS m, p_size % 20 AS b FROM part)
SELECT p_partkey, array_to_string([coalesce((v + CASE WHEN k % 3 <> 0 THEN x ELSE 0 END + m + 1)::VARCHAR, 'null') FOR v IN CASE WHEN b >= 1 THEN [b - 5 * i FOR i IN range(0, (b - 1) // 5 + 1)] ELSE [b] END], '/') AS series,
  (CASE WHEN k % 3 = 0 THEN 0 WHEN k % 5 <> 0 THEN x END + 2)::INT AS damage, (CASE WHEN k % 4 <> 0 THEN k % 6 END + x + CASE WHEN k % 2 = 0 AND k % 6 > 0 THEN 3 ELSE 0 END + 1 + CASE WHEN k % 5 = 0 THEN -3 ELSE 0 END)::INT AS skill,
  (10 + p_size % 10 + CASE WHEN k % 6 <> 0 THEN x END)::INT AS difficulty, (CASE WHEN k % 9 = 0 THEN 3 WHEN k % 3 = 1 THEN k % 4 END)::INT AS caster_level FROM p""",
    "class_skills": """WITH h AS (SELECT DISTINCT o_custkey AS owner, o_orderpriority AS class FROM orders), g AS (SELECT DISTINCT o_orderpriority AS class, o_orderstatus AS skill FROM orders WHERE o_orderpriority <> '5-LOW' AND NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AND (o_orderstatus <> 'O' OR o_orderpriority = '2-HIGH')),
s AS (SELECT DISTINCT owner, unnest(['F', 'O', 'P', 'X']) AS skill FROM h), a AS (SELECT owner, skill, CASE WHEN EXISTS (SELECT 1 FROM h JOIN g USING (class) WHERE h.owner = s.owner AND g.skill = s.skill) THEN true WHEN EXISTS (SELECT 1 FROM h WHERE h.owner = s.owner AND class NOT IN (SELECT class FROM g)) THEN NULL ELSE false END AS granted FROM s)
SELECT owner, skill, granted, CASE WHEN granted <> (owner % 2 = 0) THEN granted END AS suggested FROM a""",
    "casting": """WITH h AS (SELECT DISTINCT o_custkey AS owner, o_orderpriority AS class, (o_custkey % 10)::INT AS m, (length(o_orderpriority) % 3)::INT AS level FROM orders),
r AS (SELECT *, CASE WHEN class IN ('1-URGENT', '2-HIGH') THEN 2 WHEN class = '3-MEDIUM' THEN 0 END AS base, CASE WHEN m < 8 THEN m // 2 END AS bonus FROM h),
v AS (SELECT owner, bool_or(base IS NULL) AS void, count(*) FILTER (base IS NULL) AS unknown, bool_or(m >= 8) AS missing FROM r GROUP BY owner)
SELECT owner, level, CASE WHEN NOT void THEN sum(base) + coalesce(sum(bonus), 0) END::BIGINT AS total, (3 * count(*) FILTER (base = 2))::BIGINT AS known_, bool_or(coalesce(base = 2, false)) AS available, unknown, missing FROM r JOIN v USING (owner) GROUP BY owner, level, void, unknown, missing""".replace("(3 * count(*) FILTER (base = 2))::BIGINT AS known_", "sum(CASE WHEN base = 2 THEN 3 END)::BIGINT AS known"),
    "requirement_functions": f"""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size WHEN p_size % 2 = 0 THEN p_size % 5 END AS rank, {sql_pick(MODIFIERS, 'p_partkey')} AS modifier, {sql_pick(['moyenne', 'petit', 'tres grand', 'tp', '???', 'colossale'], 'p_partkey')} AS size FROM part""",
}
