"""Element trees, page documents, list items and rule tables, with nested and broken markup."""

import pytest
from pyspark.sql import functions as F

from tests.test_functions import one
from tomewright.functions import markup, text
from tomewright.operators import html, pages, rule_tables

PAGE = """<html><body><h1 class="pagetitle">Boule de feu¶</h1><div id="PageContentDiv"><div class="navmenudroite">Réservé à <i>X</i></div><a href="z"><img title="Source : Livre A"></a>
<b>École</b> Évocation [feu, Bien] ; <b>Niveau</b> Bard 2, magus 1 Ens/Mag 1, bizarre<br/>
<b>Portée</b> longue <i>(30 m)</i><br><b>Truc :</b> machin<br><b>Durée</b> instantanée<br><b>Durée</b> autre<br><br>Une <b>grosse</b> boule &amp; du feu.<div>Bloc <p>un</p></div>
<h2>Version mythique¶</h2>Plus fort<p>encore</p><h3>Notes</h3>rien<script>x()</script>
<div class="box"><div class="voiraussi">Sorts qui fonctionnent comme celui-ci</div><h1 class="separator">Petite boule</h1><b>École</b> Illusion<br>petit<h2>Mythique</h2>mini
<h1>Autre</h1>avant<div class="box">dedans <div>x</div></div>perdu</div><h4>Suite</h4>après
<div class="box"><h1>Cousin</h1>lié<h1>Cousin</h1></div><div id="PageAttachmentsDiv"><img title="Source: non">non</div></div></body></html>"""


def parts(source):
    return [(n.tag, source[n.start : n.stop]) for n in markup.tree(source).walk() if n.tag]


def test_trees():
    nested = "<div class='box'>a<div>b</div>c</div>d"
    assert parts(nested) == [("div", "<div class='box'>a<div>b</div>c</div>"), ("div", "<div>b</div>")]
    assert parts("<p>a<p>b<div>c</p>d</div>") == [("p", "<p>a"), ("p", "<p>b"), ("div", "<div>c</p>d</div>")]
    assert parts("<ul><li>a<ul><li>b</ul>c<li>d</ul>") == [("ul", "<ul><li>a<ul><li>b</ul>c<li>d</ul>"), ("li", "<li>a<ul><li>b</ul>c"), ("ul", "<ul><li>b</ul>"), ("li", "<li>b"), ("li", "<li>d")]
    assert parts("x</b><i>y<br>z") == [("i", "<i>y<br>z"), ("br", "<br>")]
    root = markup.tree("a &amp; b&nbsp;c &#233;<br>\n d<script>no()</script><p>e</p>f")
    assert markup.clean(root.raw_text()) == "a & b c é\nd\ne\nf"
    assert [n.text for n in root.children if not n.tag][:1] == ["a & b\xa0c é"]
    assert markup.clean(markup.tree("<div>" * 5000 + "deep" + "</div>" * 5000).raw_text()) == "deep"
    assert markup.tree("").children == [] and markup.tree("<div id=a class='b c'>").first("#a").classes == ["b", "c"]


def test_grids():
    source = "<table><tr><th rowspan=2>a<th colspan=2>b<tr><td>c<td>d<tr><td><table><tr><td>in</table><td colspan='x'>e</table>"
    table = markup.tree(source).first("table")
    assert [[t for t, _ in row] for row in markup.grid(table)] == [["a", "b", "b"], ["a", "c", "d"], ["in", "e"]]
    assert [[o for _, o in row] for row in markup.grid(table)] == [[0, 0, 1], [2, 0, 0], [0, 0]]
    far = markup.tree("<table><tr><td>a<td rowspan=3>b<tr><td>c<tr></table>").first("table")
    assert markup.grid(far) == [[("a", 0), ("b", 0)], [("c", 0), ("b", 2)], [("", 0), ("b", 2)]]


def test_documents(spark):
    prose = "mot " * 60
    late = f'<div id="PageContentDiv"><b>Portée</b> courte<br><b>Durée</b> 1 round\n{prose}<i>fin</i><br>suite</div>'
    short = '<div id="PageContentDiv"><b>Durée</b> oui\n(inoffensif)<br>texte</div>'
    bare = '<div id="PageContentDiv">Sans <b>étiquette</b> connue<h2>Titre</h2></div>'
    rows = [(1, "Boule de Feu", PAGE), (2, "Rien", "<p>no</p>"), (3, "Null", None), (4, "Tard", late), (5, "Court", short), (6, "Nu", bare), (7, "Autre nom", PAGE)]
    df = spark.createDataFrame(rows, "id int, name string, html string").withColumn("url", F.concat(F.lit("u"), F.col("id").cast("string")))
    got = {r["id"]: r.asDict(True) for r in pages.documents(df, "id", "html", name="name", url="url").collect()}
    d = got[1]["document"]
    assert list(d) == ["id", "name", "url", "school", "descriptors", "levels", "casting_time", "components", "range", "target", "duration", "save", "resistance", "description", "description_html", "mythic", "variants", "sources", "others", "classes", "meta"]
    assert (d["id"], d["name"], d["url"], d["school"], d["descriptors"], d["levels"], d["range"], d["duration"], d["save"]) == ("boule-de-feu", "Boule de feu", "u1", "Évocation", ["feu", "Bien"], {"Bard": 2, "magus": 1, "Ens/Mag": 1}, "longue (30 m)", "instantanée", None)
    assert d["description"] == "Une grosse boule & du feu.\nBloc\nun" and d["description_html"].endswith("<div>Bloc <p>un</p></div>")
    assert d["mythic"] == {"description": "Plus fort\nencore", "description_html": "Plus fort<p>encore</p>"}
    assert d["others"] == {"deity_restriction": "Réservé à X", "Truc": "machin", "section:Notes": "rien", "section:Suite": "après", "related": "Cousin", "unparsed_levels": "bizarre"}
    assert d["sources"] == ["Livre A"]
    assert [(v["name"], v["id"], v["school"], v["description"], v["mythic"] and v["mythic"]["description"]) for v in d["variants"]] == [("Petite boule", "petite-boule", "Illusion", "petit", "mini"), ("Autre", "autre", None, "avant", None)]
    assert got[1]["diagnostics"] == {"unknown_labels": ["Truc"], "rejected_levels": ["bizarre"], "unknown_sections": ["Notes", "Suite"]}
    assert got[2]["document"] is None and got[3]["document"] is None
    assert (got[4]["document"]["duration"], got[4]["document"]["description"]) == ("1 round", f"{prose}fin\nsuite")
    assert (got[5]["document"]["duration"], got[5]["document"]["description"]) == ("oui (inoffensif)", "texte")
    assert (got[6]["document"]["description"], got[6]["document"]["others"]) == ("Sans étiquette connue", {"section:Titre": None})
    assert got[7]["document"]["name"] == "Autre nom" and got[7]["document"]["id"] == "autre-nom"
    assert pages.documents(df.limit(0), "id", "html").count() == 0


def test_level_maps(spark):
    level = lambda x: tuple(one(spark, text.level_map(F.lit(x).cast("string"))))
    assert level("Bard 2, Cham 2;, Pal 1 (feu)") == ({"Bard": 2, "Cham": 2, "Pal": 1}, [])
    assert level("magus 1 Ens/Mag 1, Bard 3, Bard 4") == ({"magus": 1, "Ens/Mag": 1, "Bard": 3}, [])
    assert level("rien, Prê 1") == ({"Prê": 1}, ["rien"])
    assert level(None) == level("") == ({}, [])


def test_list_items(spark):
    source = "<h2>Niveau 3</h2><ul><li><a href='/a'>A</a> : bla <ul><li><a href='/b'>B</a></li></ul> fin</li><li>rien</li></ul><h3>École</h3><li><a href='/c'>C</a>"
    rows = html.list_entries(spark.createDataFrame([(1, source), (2, None)], "id int, html string"), "id", "html").orderBy("place").collect()
    assert [(r["level"], r["school"], r["name"], r["blurb"], r["reason"]) for r in rows] == [(3, None, "A", "bla B fin", None), (3, None, None, "rien", "no link"), (3, "École", "C", None, None)]
    boxed = spark.createDataFrame([("<div>no</div><div class='box'>a<div>b</div>c</div>",), ("<p>",), (None,)], "h string")
    assert [r[0] for r in boxed.select(html.inner_html(F.col("h"), "div", "box")).collect()] == ["a<div>b</div>c", None, None]


PROGRESSION = """<table width=100%><tr><td><table class=tablo><tr><th rowspan=2>Niveau<th rowspan=2>BBA<th rowspan=2>Réflexes<th rowspan=2>Vigueur<th rowspan=2>Volonté<th rowspan=2>Spécial<th rowspan=2>Déplacement
<th colspan=3>Sorts par jour<th colspan=2>Étranges<tr><th>0<th>1er<th>?<th>x<th>2<tr><td>1<td>+0<td>+2<td>–1<td><td>Rage, course<td>9 m<td>3<td>—<td>z<td>1<td>1
<tr><td>2<td>+6/+1<td>+0<td>+3<td>+x<td>-<td>12 m<td>0<td>2<td><td><td></tr><tr><td>Notes<td colspan=11>rien</table></table>"""


def test_progressions(spark):
    df = spark.createDataFrame([("a", PROGRESSION), ("b", "<table><tr><th>Niveau<th>BBA<tr><td>1<td>+1</table>"), ("c", "<table><tr><td>x</table>"), ("d", None)], "id string, html string")
    grid = rule_tables.cells(df, "id", "html")
    rows = {(r["id"], r["level"]): r.asDict(True) for r in rule_tables.progression(grid, "id").collect()}
    assert set(rows) == {("a", 1), ("a", 2), ("b", 1)}
    first, second = rows["a", 1], rows["a", 2]
    assert (first["attack"], first["reflex"], first["fortitude"], first["will"], first["features"], first["extra"]) == (0, 2, -1, None, ["Rage", "course"], {"Déplacement": "9 m"})
    assert first["slots"] == {"per_day": {0: 3, 1: None}, "known": {}} and second["slots"]["per_day"] == {0: 0, 1: 2}
    assert (second["attack"], second["series"], second["will"], second["features"]) == (6, ["+6", "+1"], None, [])
    gaps = sorted(tuple(r) for r in rule_tables.progression_gaps(grid, "id").collect())
    assert gaps == sorted([("a", "column", "Déplacement"), ("a", "group", "Étranges"), ("a", "inner", "?"), ("a", "inner", "x"), *(("b", "missing", k) for k in rule_tables.BASE[2:])])


def test_universal_tables(spark):
    levels = "".join(f"<td>{x}" for x in ["—", "1", "", "", "", "", "", "", "", "-"])
    table = f"<table><caption>Modificateurs et sorts en bonus</caption><tr><th rowspan=2>Valeur<th rowspan=2>Mod<th colspan=10>Sorts<tr>{'<th>n' * 10}<tr><td>1<td>–5<td colspan=10>impossible<tr><td>12–13<td>+1{levels}<tr><td>x<td>?</table>"
    armour = "<table><tr><th>Armure<th>Prix</tr><tr><td colspan=9>ARMURES LÉGÈRES (a)</td></tr><tr><td>↓ Cuir<td>10 po<td>+2<td>+6<td>0<td>10 %<td>9 m<td>6 m<td>7 kg</tr><tr><td colspan=9>BOUCLIERS<tr><td>Écu<td>20 po<td>+2<td><td>–2<td>—<td>-<td>0<td>22 kg<tr><td>court<td>x</table>"
    df = spark.createDataFrame([(1, table), (2, armour)], "id int, html string")
    grid = rule_tables.cells(df, "id", "html")
    assert sorted(tuple(r) for r in rule_tables.ability_modifiers(grid, "id", "sorts en bonus").collect()) == [(1, 1, 1, -5), (1, 12, 13, 1)]
    assert {r["modifier"]: r["slots"] for r in rule_tables.bonus_slots(grid, "id", "sorts en bonus").collect()} == {-5: dict.fromkeys(range(10)), 1: {**dict.fromkeys(range(10)), 1: 1}}
    rows = [r.asDict() for r in rule_tables.armours(grid.where("id = 2"), "id").orderBy("place").collect()]
    assert [(r["name"], r["category"], r["dexterity"], r["checks"], r["failure"], r["speed_9"], r["speed_6"], r["weight"]) for r in rows] == [("Cuir", "legere", "+6", "0", "10 %", "9 m", "6 m", "7 kg"), ("Écu", "bouclier", None, "–2", None, None, "0", "22 kg")]
    combat = "<b>Bonus d’esquive.</b> Les <a href='x'>bonus</a> se cumulent entre eux. <b>Bonus de Force.</b> rien<br><b>Bonus d'armure.</b> ils ne se cumulent pas<b>Bonus d’esquive.</b> encore"
    got = one(spark, rule_tables.bonus_types(F.lit(combat)))
    assert [(b["key"], b["cumulative"]) for b in got] == [("esquive", True), ("force", None), ("armure", False)] and got[0]["note"] == "Les bonus se cumulent entre eux."


@pytest.mark.parametrize("source", ["", "<", "<a", "</", "&", "<!-- x", "<![CDATA[x", "<div <p>", "\x00", "<td><li></td></li>"])
def test_broken_markup(source):
    root = markup.tree(source)
    assert root.stop == len(source) and all(0 <= n.start <= n.stop <= len(source) for n in root.walk())


@pytest.mark.parametrize(("closed", "want"), [(False, "a & b < é &am &"), (True, "a & b &lt é &am &amp")])
def test_references_without_semicolon(spark, closed, want):
    df = spark.createDataFrame([(1, "<article><h1>a &amp; b &lt &#233; &am &amp</h1><p>x</p></article>")], "id int, html string")
    made = pages.documents(df, "id", "html", layout=pages.Layout(content="article", without="", title="h1", labels={}, closed=closed))
    assert made.first()["document"]["name"] == want


def test_pages_of_one_split_are_read_by_several_tasks(spark):
    """A file of one split leaves all pages to one task unless they are dealt first; results don't depend on batches."""
    table = "<table><tr><td>a<td>b</table>"
    df = spark.createDataFrame([(i, table if i % 3 else None) for i in range(60)], "id long, html string").coalesce(1)
    grid = rule_tables.cells(df, "id", "html")
    assert len(grid.inputFiles()) > 4
    assert sorted((r["id"], r["col"], r["text"]) for r in grid.collect()) == [(i, k, x) for i in range(60) if i % 3 for k, x in enumerate("ab")]


def test_feat_pages(spark):
    source = """<div id="PageContentDiv"><a href="x"><img title="Source : Livre"></a>Un <b>grand</b> don.<p>Suite <b>Note.</b> prose</p><b>Catégorie.</b> combat, Style et <a href="Pathfinder-RPG.dons%20de.ashx#COMBAT">monstre</a>.<br>
    <b>Conditions.</b> For 13.<b>Avantage.</b> fort<table><caption>T</caption><tr><td>1<td>2<tr><td>3</table> et <b>gras</b> suite<br><b>Rareté</b> : rare<b>Spécial.</b> un<b>Avantage.</b> encore<a href="Pathfinder-RPG.NLS.ashx">NLS</a><a href="Pathfinder-RPG.NLS.ashx">NLS</a><a href="">rien</a></div>"""
    df = spark.createDataFrame([(1, source), (2, "<div id='PageContentDiv'>nu</div>"), (3, None)], "id int, html string")
    got = {r["id"]: r.asDict(True) for r in pages.feat_documents(df, "id", "html").collect()}
    d = got[1]
    assert (d["sources"], d["category"], d["categories"]) == (["Livre"], "combat, Style et monstre.", ["combat", "monstre", "style"])
    assert d["description"] == "Un grand don.\nSuite Note. prose" and d["conditions"] == "For 13."
    assert (d["benefit"], d["special"], d["normal"], d["others"]) == ("fort et\n\nencoreNLSNLSrien", "un", None, {"gras": "suite", "Rareté": "rare"})
    assert [(x["text"], x["target"], x["anchor"]) for x in d["links"]] == [("", "x", None), ("monstre", "dons de", "COMBAT"), ("NLS", "NLS", None)]
    assert d["text"] == "Un grand don.\nSuite Note. prose\n\nCatégorie. combat, Style et monstre.\n\nConditions. For 13.\n\nAvantage. fort et\n\nencoreNLSNLSrien\n\nSpécial. un\n\ngras. suite\n\nRareté. rare\n\nTableau — T\n1 | 2\n3"
    assert (got[2]["description"], got[2]["text"], got[2]["categories"], got[2]["links"]) == ("nu", "nu", [], []) and got[3]["description"] is None
    rows = spark.createDataFrame([(1, "<table><tr><th>x</th></tr><tr><td><a href='/a'>Don <i>un</i> *</a></td><td><a href='/b'>b</a></td></tr><tr><td>no</td></tr></table>")], "id int, html string")
    assert [tuple(r) for r in pages.row_links(rows, "id", "html", "https://s").collect()] == [(1, 1, "Don un", "https://s/a")]


def test_page_texts_in_pieces(spark, monkeypatch):
    """Both texts come from one pass, in pieces of a batch; no page is lost, alone, null or empty."""
    monkeypatch.setattr(html, "PIECE", 20)
    pages = [(1, "<nav>n</nav><p>one</p>two"), (2, None), (3, ""), (4, "<p>" + "x " * 40 + "</p>"), (5, "<header>h</header>y"), (None, "z")]
    df = spark.createDataFrame(pages, "page_id int, html string")
    got = {r["page_id"]: (r["text"], r["main"]) for r in html.page_texts(df.coalesce(1), "page_id", "html").collect()}
    assert got == {k: (html.visible_text(x), html.visible_text(x, html.MARGINS)) for k, x in pages}
    assert got[1] == ("n\none\ntwo", "one\ntwo") and got[2] == (None, None)
