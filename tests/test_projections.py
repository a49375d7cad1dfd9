"""Published indexes and their checks, characters from sheets, and the rules of curators' drafts."""

from pyspark.sql import functions as F

from tests.test_functions import one
from tomewright.operators import projections


def test_feat_index(spark):
    schema = "name string, effect string, targets array<string>, score int"
    rows = spark.createDataFrame([("Esquive*", "armure", ["soi", "allié"], 1), ("Attaque en puissance", None, [], None), ("Œil d’aigle", "vision", None, 3), ("Zèle", "armure", ["allié", None], 4)], schema)
    index, codes = projections.feat_index(rows, "name", {"ep": "effect"}, {"cb": "targets"}, {"vb": "score"})
    got = [r.asDict() for r in index.orderBy("i").collect()]
    assert list(got[0]) == ["i", "id", "s", "n", "nf", "r", "ep", "cb", "vb"]
    assert [(r["i"], r["id"], r["n"], r["nf"], r["r"], r["ep"], r["cb"], r["vb"]) for r in got] == [
        (0, "attaque-en-puissance", "Attaque en puissance", "attaque en puissance", False, None, [], None), (1, "esquive", "Esquive*", "esquive*", True, 0, [0, 1], 1),
        (2, "oeil-d-aigle", "Œil d’aigle", "oeil d aigle", False, 1, [], 3), (3, "zele", "Zèle", "zele", False, 0, [0], 4),
    ]
    assert sorted(tuple(r) for r in codes.collect()) == [("cb", "allié", 0), ("cb", "soi", 1), ("ep", "armure", 0), ("ep", "vision", 1)]
    assert projections.index_violations(index, codes, ["ep"], ["cb"]).count() == 0
    broken = index.withColumns({"i": F.when(F.col("id") == "zele", 9).otherwise(F.col("i")), "nf": F.when(F.col("id") == "esquive", F.lit("x")).otherwise(F.col("nf")), "ep": F.when(F.col("id") == "oeil-d-aigle", 7).otherwise(F.col("ep")), "n": F.when(F.col("id") == "esquive", F.lit("a\r")).otherwise(F.col("n"))})
    broken = broken.unionByName(broken.where("i = 0"))
    found = sorted(tuple(r) for r in projections.index_violations(broken, codes, ["ep"], ["cb"]).collect())
    assert found == [("code", "oeil-d-aigle"), ("folded", "esquive"), ("orphan_code", "ep:vision"), ("repeated_i", "0"), ("repeated_id", "attaque-en-puissance"), ("repeated_s", "attaque-en-puissance"), ("sparse", "zele"), ("text", "esquive")]


def test_code_tables_hold_no_values_of_all_rows(spark, monkeypatch):
    """Values repeated in a row, and in rows of one key, have one code; nothing is aggregated by key and value before rows are dealt."""
    plans, write = {}, projections.materialize
    monkeypatch.setattr(projections, "materialize", lambda df, name: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or write(df, name))
    rows = spark.createDataFrame([("a", ["y", "x", "y", None]), ("a", ["x", "z"]), ("b", None), ("c", ["z", "z"])], "id string, v array<string>")
    codes, own = projections.code_tables(rows, "id", {"t": F.col("v")})
    assert sorted(tuple(r) for r in codes.collect()) == [("t", "x", 0), ("t", "y", 1), ("t", "z", 2)]
    assert {r["id"]: r["codes"] for r in own.collect()} == {"a": {"t": [0, 1, 2]}, "c": {"t": [2]}}
    assert "Aggregate" not in plans["values"] and "RepartitionByExpression" in plans["values"]


def test_props_and_names(spark):
    rows = spark.createDataFrame([("Esquive*", "src", "c"), ("Zèle", None, "d")], "name string, source string, conditions string")
    details = spark.createDataFrame([("Esquive*", "page", None)], "name string, description string, special string")
    got = {r["id"]: r.asDict() for r in projections.feat_props(rows, details, "name", ["source", "conditions"], ["description", "special"]).collect()}
    assert got == {"esquive": {"id": "esquive", "slug": "esquive", "name": "Esquive*", "source": "src", "conditions": "c", "description": "page", "special": None}, "zele": {"id": "zele", "slug": "zele", "name": "Zèle", "source": None, "conditions": "d", "description": None, "special": None}}
    conditions = spark.createDataFrame([("zele", 1), ("nobody", 2)], "slug string, x int")
    assert [tuple(r) for r in projections.by_name(conditions, rows.select("name"), "slug", "name").collect()] == [("zele", 1, "Zèle")]


def test_characters(spark):
    schema = "id int, classes array<struct<name:string,level:int>>, race string, size string, alignment string, deity string, abilities map<string,int>, feats array<string>"
    rows = [(1, [(" Guerrier ", 5), ("Mage", 1)], " Nain", "", None, "Torag ", {"force": 14, "charisme": 8, "autre": 3}, ["Esquive*", "Épée ", "esquive", " "]), (2, [], "Elfe", None, None, None, {}, None), (3, [("Mage", None)], None, None, None, None, None, None), (4, [("Mage", 2)], "  ", None, None, None, None, None)]
    got = {r["id"]: r["c"] for r in spark.createDataFrame(rows, schema).select("id", projections.sheet_character().alias("c")).collect()}
    assert got[1].asDict() == {"class": "Guerrier", "level": 5, "race": "Nain", "size": None, "abilities": {"For": 14, "Cha": 8}, "known": ["epee", "esquive"], "alignment": None, "deity": "Torag"}
    assert got[2] is None and got[3] is None
    assert got[4].asDict() == {"class": "Mage", "level": 2, "race": None, "size": None, "abilities": None, "known": [], "alignment": None, "deity": None}
    made = projections.profiles(spark.createDataFrame([("a", 3, True), ("b", 0, False)], "id string, level int, human boolean"), "id", F.col("human"), F.array(F.lit(2), F.lit(6)))
    slots = {r["id"]: [(s["source"], s["level"], s["feat"]) for s in r["slots"]] for r in made.collect()}
    assert slots == {"a": [("general", 1, None), ("general", 3, None), ("racial", 1, None), ("class", 2, None)], "b": []}


def test_drafts(spark):
    mention = lambda *t: one(spark, projections.class_mentions([F.lit(x).cast("string") for x in t], ["druide", "magicien"]))
    assert mention("ajoute à sa liste de druide", None) == ["druide"] and mention("niveaux de magicien", "niveau de druide") == ["druide", "magicien"]
    assert mention("comme avec la capacité pacte, niveau de magicien") is None and mention("sa liste de druides") is None and mention("", None) is None
    rules = [("rage de berserk", ["barbare"]), ("^canalisation", ["pretre", "paladin"])]
    decide = lambda t, auto=(), keys=(), named=(): tuple(one(spark, projections.attribution(F.lit(t), rules, *(F.array(*[F.lit(x) for x in v]).cast("array<string>") for v in (auto, keys, named)))))
    assert decide("Rage de berserk et sorts") == ("mapped", ["barbare"]) and decide("Canalisation d’énergie") == ("mapped", ["pretre", "paladin"])
    assert decide("lancer des sorts", ["mage"], ["x"]) == ("no_single_class", [])
    assert decide("autre", ["mage"], ["ki"]) == decide("autre", ["mage"], ["sorts"], ["mage"]) == ("mapped", ["mage"])
    assert decide("autre", ["mage"], ["sorts"]) == decide("autre", ["mage"]) == decide("autre", [], ["ki"]) == ("no_single_class", [])
    guess = one(spark, projections.caster_guess(F.create_map(F.lit("1"), F.array(F.lit("Sorts connus"), F.lit("Mystère")), F.lit("2"), F.array(F.lit("rage")))))
    assert guess["caster"] and guess["evidence"] == ["sorts connus", "mystere"]
    assert not one(spark, projections.caster_guess(F.create_map(F.lit("1"), F.array(F.lit("rage")))))["caster"]


def test_reviews_and_conventions(spark):
    review = spark.createDataFrame([("a", ["x", "y"]), ("b", ["z"]), ("c", ["q"])], "name string, fragments array<string>")
    curated = spark.createDataFrame([("a", ["x"], []), ("b", [], [("z", "known")]), ("d", ["w"], [("v", "odd")])], "name string, added array<string>, ignored array<struct<fragment:string,reason:string>>")
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    assert sorted(tuple(r) for r in projections.review_gaps(review, curated, names, "name", ["known"]).collect()) == [("not_curated", "c"), ("not_in_catalogue", "d"), ("not_reviewed", "d"), ("reason", "d"), ("undecided", "a")]
    records = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, None)], "id int, cache string")
    files = spark.createDataFrame([("p1",)], "path string")
    got = lambda f: sorted(tuple(r) for r in projections.cache_references(records, f, "id", "cache").collect())
    assert got(files) == [(2, "blocking", "missing"), (3, "warning", "unnamed")]
    assert got(files.limit(0)) == [(1, "warning", "missing"), (2, "warning", "missing"), (3, "warning", "unnamed")]
    levels = spark.createDataFrame([(1, "Bard"), (1, "Shm"), (2, "Shm"), (2, "Foo")], "id int, abbreviation string")
    assert sorted(tuple(r) for r in projections.convention_findings(levels, ["Bard"], ["Shm"]).collect()) == [("Foo", "warning", 1), ("Shm", "info", 2)]
    index = spark.createDataFrame([(1, None, ["x"]), (2, "s", ["x"]), (3, None, ["x", "y"]), (4, None, [])], "id int, school string, classes array<string>")
    assert [r["id"] for r in projections.without_school(index, "id", ["x"]).collect()] == [1]
