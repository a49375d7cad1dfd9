"""Pinned vectors, truth tables and small graphs."""

import itertools

import pytest
from pyspark.sql import functions as F

from tomewright.functions import text
from tomewright.operators import graph, html, ordering, quality, rules, search, sheet
from tomewright.plans.spec import QuerySpec, parse_levels, parse_tags


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "expected"),
    [("Éclair", "eclair"), ("Cœur d’acier", "coeur d acier"), ("  Deux   mots ", "deux mots"), ("ÀÉÎÕÜ", "aeiou"), ("Œuf æ", "oeuf ae"), (None, None)],
)
def test_fold(spark, given, expected):
    df = spark.createDataFrame([(given,)], "t string")
    assert df.select(text.fold_nfkd("t").alias("x")).first()["x"] == expected


def test_text_functions(spark):
    lit = F.lit
    assert one(spark, text.slug(lit("  Boule de Feu (majeure)!"))) == "boule-de-feu-majeure"
    assert one(spark, text.slug_or(lit("!!"), "don")) == "don"
    assert one(spark, text.split_top_level(lit("a, b (c, d); e,"))) == ["a", "b (c, d)", "e"]
    assert one(spark, text.split_alternatives(lit("For 13 ou Dex 15"))) == ["For 13", "Dex 15"]
    assert one(spark, text.parse_levels(lit("Bard 2, Pal 1, Bard 5"))) == {"bard": 2, "pal": 1}
    assert one(spark, text.tri_state(lit("oui et non"))) is None
    assert one(spark, text.metres(lit("9,5 m"))) == 9.5
    assert one(spark, text.runs_of(F.array(lit(5), lit(0), lit(1), lit(2), lit(7), lit(8)))) == "0-2,5,7,8"
    assert [one(spark, text.signed_integer(lit(x))) for x in ("+4", "–2", "7", "x")] == [4, -2, 7, None]


def test_kleene(spark):
    values = {True: F.lit(True), False: F.lit(False), None: F.lit(None).cast("boolean")}
    for a, b in itertools.product(values, repeat=2):
        some = True if True in (a, b) else None if None in (a, b) else False
        every = False if False in (a, b) else None if None in (a, b) else True
        assert one(spark, rules.kleene_any([values[a], values[b]])) is some
        assert one(spark, rules.kleene_any(F.array(values[a], values[b]))) is some
        assert one(spark, rules.kleene_all([values[a], values[b]])) is every
        assert one(spark, rules.kleene_all(F.array(values[a], values[b]))) is every
    assert [one(spark, rules.verdict(values[v])) for v in values] == ["eligible", "ineligible", "manual_check"]


def test_rules(spark):
    assert [one(spark, rules.ability_modifier(F.lit(s))) for s in (9, 10, 11, 20)] == [-1, 0, 0, 5]
    assert one(spark, sheet.attack_series(F.lit(11))) == [11, 6, 1]
    assert one(spark, rules.compare_size(F.lit("xx"), F.lit("M"), F.lit("min"))) is None
    assert one(spark, rules.skill_rank(F.lit(None).cast("map<string,int>"), F.lit("a"), F.lit(4))) == 4


def test_graph_with_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src long, dst long")
    assert {r["node"]: r["leverage"] for r in graph.leverage(edges).collect()} == {1: 4, 2: 4, 3: 4}
    nodes = spark.createDataFrame([(k,) for k in range(1, 6)], "node long")
    assert [r["node"] for r in graph.isolated(nodes, edges).collect()] == [5]
    assert {r["node"]: r["wave"] for r in graph.waves(edges, nodes, 4).collect()} == {5: 1}


def test_search_empty_query(spark):
    rows = spark.createDataFrame([(1, "Boule de feu"), (2, "Boules")], "id long, name string")
    index = search.token_index(rows, "id", "name")
    assert search.ranked(index, "id", ["de"]) is None
    assert search.ranked(index, "id", ["zzz"]).count() == 0
    assert [r["id"] for r in search.ranked(index, "id", ["boule"]).collect()] == [1, 2]
    accepted, refused = search.build_aliases(spark.createDataFrame([("feu", 1), ("boules", 1), ("x", 9)], "alias string, id long"), rows.select("id", F.lower("name").alias("folded")), "id")
    assert accepted.count() == 1 and {r["reason"] for r in refused.collect()} == {"unknown", "real_name"}


def test_html():
    page = "<h1>T</h1><script>x</script><p>a&nbsp;b<br>c</p><table><caption>C</caption><tr><td>1</td></tr><tr><td></td></tr></table>"
    assert html.visible_text(page) == "T\na b\nc\nC\n1" or html.visible_text(page).startswith("T\na b\nc")
    assert html.visible_text(None) is None


def test_html_udfs(spark):
    df = spark.createDataFrame([("<b>École</b> évocation <b>Niveau</b> Bard 2<table><tr><td>1</td></tr></table>",), (None,)], "h string")
    got = df.select(html.labelled_values("h").alias("v"), html.tables("h").alias("t"), html.links(F.col("h")).alias("l")).collect()
    assert got[0]["v"]["École"] == "évocation" and got[0]["t"][0]["rows"] == [["1"]] and got[1]["v"] is None


def test_spec_round_trip():
    spec = QuerySpec.parse("Q=feu&school=a,b&niv=1-3,5,x&tags=x,-y,!z,x&tri=-cost&cout=12.5&page=3&junk=1")
    assert spec.levels == (1, 2, 3, 5) and spec.tags == {"x": "include", "y": "exclude", "z": "require"} and spec.descending
    assert QuerySpec.parse(spec.format()) == spec
    assert QuerySpec().format() == "" and QuerySpec().most_restrictive() is None
    assert spec.cycle_tag("x").tags["x"] == "exclude" and "z" not in spec.cycle_tag("z").tags
    assert spec.toggle_sort("cost").sort is None and spec.toggle_sort("name").sort == "name"
    assert parse_levels("") == () and parse_tags(",,") == {}


def test_quotas(spark):
    strata = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1)], "k string, n long")
    got = {r["k"]: r["quota"] for r in ordering.quotas(strata, ["k"], "n", 20).collect()}
    assert sum(got.values()) == 20 and got["c"] == 1 and got["b"] >= 2


def test_require_empty(spark):
    assert quality.require_empty(spark.range(0), "must be empty").count() == 0
    with pytest.raises(Exception, match="must be empty"):
        quality.require_empty(spark.range(2), "must be empty").collect()


def test_closure_by_levels_and_by_rounds(spark, monkeypatch):
    """Against plain search: ways of different lengths to a node, edges that repeat, cycles, no edges. Without cycles nothing is
    compared with all pairs that were found before."""
    import random

    rng = random.Random(7)
    straight = [(a, b) for a in range(14) for b in range(a + 1, 14) if rng.random() < 0.25] * 2
    for pairs, acyclic in ((straight, True), ([*straight, (9, 2), (20, 20)], False), ([], True)):
        reach = set(pairs)
        while more := {(a, d) for a, b in reach for c, d in pairs if b == c} - reach:
            reach |= more
        roots = {a for a, _ in pairs} - {b for _, b in pairs}
        edges = spark.createDataFrame(pairs, "src long, dst long")
        with monkeypatch.context() as m:
            if acyclic:
                m.setattr(graph, "_by_rounds", None)
            for roots_only, few in ((False, 100_000), (True, 1)):
                m.setattr(graph, "FEW", few)
                got = [tuple(r) for r in graph.closure(edges, roots_only).collect()]
                assert len(got) == len(set(got)) and set(got) == {p for p in reach if not roots_only or p[0] in roots}


def test_totals_of_bonuses_are_not_dealt_by_kind(spark):
    """A few kinds hold all rows, so a join by kind would put them into as many tasks. Ties, signs and kinds without a rule."""
    rows = [(1, "a", 3), (1, "a", 3), (1, "a", -2), (1, "b", 5), (1, "b", 5), (1, "b", -1), (1, "b", -4), (1, "c", 2), (2, "b", 0), (2, None, 7)]
    told = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "owner long, kind string, value int, at int")
    made = sheet.stacked_totals(told, spark.createDataFrame([("a", True), ("b", False)], "kind string, cumulative boolean"), "owner", "kind", "value", ["at"])
    assert sorted(tuple(r) for r in made.collect()) == [(1, 7, 6, 2, 1), (2, 7, 2, 0, 1)]
    marked = sheet.stack_bonuses(told, spark.createDataFrame([("a", True), ("b", False)], "kind string, cumulative boolean"), "owner", "kind", "value", ["at"])
    for df in (made, marked):
        assert "hashpartitioning(kind#" not in df._jdf.queryExecution().toString()
