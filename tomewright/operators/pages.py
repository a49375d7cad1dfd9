"""Pages to documents. A table function reads each page once and yields the nodes of its content in order; labels, values, regions,
boxes and variants are then windows and aggregations over these rows, dealt by page once.

The head of a block is a run of bold labels with their values; what follows the last known label's value is description, until
a heading or a box. A heading about the mythic form opens a region of its own, other headings open sections, boxes hold
variants (blocks of their own) or name related entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomewright.functions import markup, text
from tomewright.sources.shared import discard, materialize, spread

# Labels of the head, in label form, and the names of their fields.
LABELS = {
    "ecole": "school", "niveau": "levels", "temps d'incantation": "casting_time", "composantes": "components", "portee": "range", "cible": "target", "cibles": "target", "effet": "target", "zone": "target",
    "zone d'effet": "target", "cible ou cibles": "target", "cible ou zone d'effet": "target", "cible, effet ou zone d'effet": "target", "cible ou effet": "target", "cible et zone d'effet": "target",
    "zone d'effet ou cible": "target", "duree": "duration", "jet de sauvegarde": "save", "resistance a la magie": "resistance",
}
FIELDS = ["casting_time", "components", "range", "target", "duration", "save", "resistance"]
# Elements that end a value, headings, the sign of an anchor, the words for related forms.
CUTS = ["br", "hr", "h1", "h2", "h3", "h4", "h5", "h6", "div", "table", "ul", "ol", "p"]
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
ANCHOR = "¶"
WORKS_LIKE = "sorts qui .*fonctionnent comme"
MYTHIC = "mythique"
SOURCE = r"(?i)^\s*source\s*:\s*"
PROSE = 200


@dataclass(frozen=True)
class Layout:
    """Where things stand on a page: selectors (``tag``, ``#id``, ``.class``, ``tag.class``) and the labels of the head. closed:
    whether references in its text end with a semicolon (see ``markup.tree``)."""

    content: str = "#PageContentDiv"
    without: str = "#PageAttachmentsDiv"
    title: str = "h1.pagetitle"
    box: str = "div.box"
    note: str = "div.voiraussi"
    aside: str = "div.navmenudroite"
    labels: dict[str, str] = field(default_factory=lambda: dict(LABELS))
    closed: bool = False


NODE = "box int, place int, tag string, aside boolean, holds int, titles array<string>, raw string, html string"


@F.udtf(returnType=NODE)
class _PageNodes:
    """The nodes of a page's content (box 0), of each box in it (from 1), each box's note (place -1) and the page's title (box -1).
    holds numbers the boxes of the content; a box inside a box has -1."""

    def eval(self, html: str, content: str, without: str, title: str, box: str, note: str, aside: str, closed: bool) -> Iterator[tuple]:
        if html is None:
            return
        root = markup.tree(html, closed)
        head, body = root.first(title), root.first(content)
        if head is not None:
            yield -1, 0, head.tag, False, None, [], head.raw_text(), html[head.start : head.stop]
        if body is None:
            return
        boxes = 0
        for place, node in enumerate(body.children):
            if without and markup.matches(node, without):
                continue
            holds = None
            if markup.matches(node, box):
                boxes += 1
                holds = boxes
            yield self._row(html, 0, place, node, markup.matches(node, aside), holds)
            if holds:
                found = node.first(note)
                if found is not None:
                    yield holds, -1, found.tag, False, None, [], found.raw_text(), ""
                for k, inner in enumerate(node.children):
                    yield self._row(html, holds, k, inner, False, -1 if markup.matches(inner, box) else None)

    @staticmethod
    def _row(html: str, box: int, place: int, node: markup.Node, aside: bool, holds: int | None) -> tuple:
        images = [n for n in (node, *node.walk()) if n.tag == "img"]
        return box, place, node.tag or None, aside, holds, [n.attributes.get("title", "") for n in images], node.raw_text(), html[node.start : node.stop]


def page_nodes(pages: DataFrame, key: str, html: str, layout: Layout) -> DataFrame:
    parts = (layout.content, layout.without, layout.title, layout.box, layout.note, layout.aside, layout.closed)
    return pages.select(key, F.col(html).alias("__page")).lateralJoin(_PageNodes(F.col("__page").outer(), *(F.lit(p) for p in parts))).drop("__page")


def clean(raw: Column) -> Column:
    """Lines as the markup breaks them, white space collapsed, without empty ones."""
    lines = F.transform(F.split(F.replace(raw, F.lit(" "), F.lit(" ")), f"{markup.BREAK}+"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def heading(raw: Column) -> Column:
    return F.trim(F.replace(clean(raw), F.lit(ANCHOR), F.lit("")))


def _value(raw: Column) -> Column:
    return F.trim(F.regexp_replace(clean(raw), r"[ ; ]+$", ""))


def _in_order(value: Column, order: str, test: Column) -> Column:
    """Values of the rows that pass, in order, as an array."""
    by = lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)
    return F.transform(F.array_sort(F.collect_list(F.when(test, F.struct(F.col(order).alias("o"), value.alias("v")))), by), lambda x: x["v"])


def _label_of(raw: Column, labels: dict[str, str]) -> Column:
    if not labels:
        return F.lit(None).cast("string")
    name = text.label_key(clean(raw))
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), name)


def blocks(nodes: DataFrame, key: str, labels: dict[str, str]) -> DataFrame:
    """A row for each block (key, box, n): its heading, fields, other labels, description, mythic part, sections and the boxes
    that follow its head. n counts the headings of a box; the page itself is block (0, 0)."""
    group = [key, "box", "n"]
    inside = Window.partitionBy(key, "box").orderBy("place")
    whole, upto = Window.partitionBy(*group), Window.partitionBy(*group).orderBy("place")
    is_ = lambda *tags: F.coalesce(F.col("tag").isin(*tags), F.lit(False))
    logo = is_("a") & F.exists("titles", lambda t: t.rlike(SOURCE))
    rows = nodes.where("box >= 0 AND place >= 0").withColumn("n", F.when(F.col("box") > 0, F.count_if(is_("h1")).over(inside)).otherwise(0).cast("int"))
    rows = rows.where("box = 0 OR n > 0").withColumn("logo", logo)
    title = rows.where(is_("h1") & (F.col("box") > 0)).select(*group, heading(F.col("raw")).alias("heading"))
    found = rows.where(F.col("box") == 0).groupBy(key).agg(F.flatten(_in_order(F.col("titles"), "place", F.lit(True))).alias("t"), F.min_by(F.when(F.col("aside"), clean(F.col("raw"))), F.when(F.col("aside"), F.col("place"))).alias("restriction"))
    sources = F.array_distinct(F.filter(F.transform(F.filter("t", lambda t: t.rlike(SOURCE)), lambda t: F.trim(F.regexp_replace(t, SOURCE, ""))), lambda t: t != ""))
    facts = found.select(key, F.lit(0).alias("box"), F.lit(0).alias("n"), sources.alias("sources"), "restriction")
    useful = rows.where(~is_("script", "style") & ~F.col("aside") & ((F.col("box") > 0) | ~F.col("logo")) & ~(is_("h1") & (F.col("box") > 0)))
    # the head: each bold label, whose value reaches to the next label or cut
    useful = useful.withColumn("field", F.when(is_("b"), _label_of(F.col("raw"), labels)))
    useful = useful.withColumns({"label_at": F.last(F.when(is_("b"), F.col("place")), True).over(upto), "stop_at": F.last(F.when(is_("b", *CUTS), F.col("place")), True).over(upto), "last_known": F.max(F.when(F.col("field").isNotNull(), F.col("place"))).over(whole)})
    useful = useful.withColumn("is_value", F.coalesce(F.col("stop_at") == F.col("label_at"), F.lit(False)) & ~is_("b"))
    useful = useful.withColumns({
        "final": F.coalesce(F.col("is_value") & (F.col("label_at") == F.col("last_known")), F.lit(False)),
        "end_at": F.min(F.when(is_("b", *CUTS) & (F.col("place") > F.col("last_known")), F.col("place"))).over(whole),
    })
    # prose after a line feed in the last value belongs to the description, where it is long enough
    useful = useful.withColumn("feed_at", F.min(F.when(F.col("final") & F.col("tag").isNull() & F.contains("raw", F.lit("\n")), F.col("place"))).over(whole))
    after = lambda c: F.when(F.col("place") == F.col("feed_at"), F.substr(c, F.instr(c, "\n") + 1)).otherwise(c)
    rest_of = F.collect_list(F.when(F.col("final") & (F.col("place") >= F.col("feed_at")), after(F.col("raw")))).over(upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    useful = useful.withColumn("split_at", F.when(F.char_length(clean(F.array_join(rest_of, ""))) >= PROSE, F.col("feed_at")))
    useful = materialize(useful, "useful")
    before = F.when(F.col("place") == F.col("split_at"), F.substring_index("raw", "\n", 1)).when(F.col("final") & (F.col("place") > F.col("split_at")), F.lit("")).otherwise(F.col("raw"))
    named = useful.where("label_at <= last_known").groupBy(*group, "label_at").agg(
        F.max(F.when(is_("b"), F.col("field"))).alias("field"), F.max(F.when(is_("b"), clean(F.col("raw")))).alias("label"), _value(F.array_join(_in_order(before, "place", F.col("is_value")), "")).alias("value")
    )
    short = F.regexp_replace(F.col("label"), r"[ :.]+$", "")
    named = named.withColumns({"key": F.coalesce("field", F.coalesce(F.nullif(F.trim(short), F.lit("")), "label")), "known": F.col("field").isNotNull()})
    named = named.groupBy(*group, "known", "key").agg(F.min("label_at").alias("at"), F.min_by("value", "label_at").alias("value"))
    heads = named.groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("known"), F.struct("key", "value")))).alias("fields"),
        _in_order(F.struct("key", F.nullif(F.col("value"), F.lit("")).alias("value")), "at", ~F.col("known")).alias("others"),
    )
    # the rest, by region: the last heading or box above a node
    rest = useful.where("last_known IS NULL OR place >= end_at OR (final AND place >= split_at)")
    rest = rest.withColumns({"raw": F.when(F.col("place") == F.col("split_at"), after(F.col("raw"))).otherwise(F.col("raw")), "html": F.when(F.col("place") == F.col("split_at"), after(F.col("html"))).otherwise(F.col("html"))})
    mythic = is_("h2", "h3") & F.contains(text.label_key(heading(F.col("raw"))), F.lit(MYTHIC))
    marker = F.when(F.col("holds").isNotNull(), F.struct(F.lit("box").alias("kind"), F.col("place").alias("at"))).when(mythic, F.struct(F.lit("mythic").alias("kind"), F.col("place").alias("at"))).when(is_(*HEADINGS), F.struct(F.lit("section").alias("kind"), F.col("place").alias("at")))
    rest = rest.withColumn("marker", marker).withColumn("region", F.last("marker", True).over(upto))
    body, shown = F.col("marker").isNull(), F.col("marker").isNull() & ~F.col("logo")
    in_ = lambda kind: F.col("region.kind").isNull() if kind is None else F.coalesce(F.col("region.kind") == kind, F.lit(False))
    joined = lambda c, test: F.array_join(_in_order(F.col(c), "place", test), "")
    regions = rest.groupBy(*group).agg(
        *(f.alias(n) for k, kind in (("plain", None), ("mythic", "mythic")) for n, f in ((f"{k}_text", clean(joined("raw", shown & in_(kind)))), (f"{k}_html", F.trim(F.regexp_replace(joined("html", shown & in_(kind)), r"^\s+|\s+$", ""))))),
        _in_order(F.col("holds"), "place", F.col("holds").isNotNull()).alias("boxes"),
    )
    sections = rest.where(in_("section")).groupBy(*group, F.col("region.at").alias("at")).agg(F.max(F.when(~body, heading(F.col("raw")))).alias("title"), clean(joined("raw", body)).alias("text"))
    sections = sections.groupBy(*group).agg(_in_order(F.struct("title", F.nullif(F.col("text"), F.lit("")).alias("text")), "at", F.lit(True)).alias("sections"))
    out = rows.select(*group).distinct()
    for other in (title, facts, heads, regions, sections):
        out = out.join(other, group, "left")
    bare = lambda c: F.coalesce(F.col(c), F.lit(""))
    part = lambda k: F.when(bare(f"{k}_text") != "", F.struct(F.col(f"{k}_text").alias("description"), F.col(f"{k}_html").alias("description_html")))
    return out.select(*group, "heading", "sources", "restriction", "fields", "others", part("plain").alias("body"), part("mythic").alias("mythic"), "sections", "boxes")


def _record(fields: str = "fields") -> list[Column]:
    """The columns that pages and variants share."""
    of = lambda name: F.nullif(F.try_element_at(F.col(fields), F.lit(name)), F.lit(""))
    school, levels = text.split_school(of("school")), text.level_map(of("levels"))
    none = F.array().cast("array<string>")
    return [
        F.nullif(school["school"], F.lit("")).alias("school"), F.coalesce(school["descriptors"], none).alias("descriptors"), levels["levels"].alias("levels"), levels["rejects"].alias("rejects"), *(of(f).alias(f) for f in FIELDS),
        F.coalesce(F.col("body.description"), F.lit("")).alias("description"), F.coalesce(F.col("body.description_html"), F.lit("")).alias("description_html"), "mythic",
    ]


SHARED = ["school", "descriptors", "levels", *FIELDS, "description", "description_html", "mythic"]


def documents(pages: DataFrame, key: str, html: str, *, name: str | None = None, url: str | None = None, layout: Layout = Layout()) -> DataFrame:  # noqa: B008
    """key, document (a struct with all its keys, nulls kept) and diagnostics (unknown labels, rejected levels, unknown sections).

    name: the column of names that pages are known by; the title on the page takes its place only where both have one slug. A page
    without content has a null document; a null page is one."""
    named, address = (F.col(name) if name else F.lit(None).cast("string")), (F.col(url) if url else F.lit(None).cast("string"))
    known = pages.select(key, named.alias("__name"), address.alias("__url"))
    nodes = materialize(page_nodes(pages, key, html, layout).repartition(key), "nodes")
    made = materialize(blocks(nodes, key, layout.labels), "blocks")
    notes = nodes.where("box > 0 AND place = -1").select(key, "box", text.label_key(clean(F.col("raw"))).rlike(WORKS_LIKE).alias("alike"))
    titles = nodes.where("box = -1").select(key, heading(F.col("raw")).alias("__title"))
    boxed = made.where("box > 0").join(notes, [key, "box"], "left").withColumn("alike", F.coalesce("alike", F.lit(False)))
    one = boxed.select(key, "box", "n", "alike", "heading", *_record())
    variant = F.struct(F.col("heading").alias("name"), text.slug(F.col("heading")).alias("id"), *SHARED)
    asked = made.where("box = 0").select(key, F.explode("boxes").alias("box"))
    per = one.join(asked, [key, "box"], "left_semi").withColumn("at", F.struct("box", "n")).groupBy(key).agg(_in_order(variant, "at", F.col("alike")).alias("variants"), F.array_distinct(F.filter(_in_order(F.col("heading"), "at", ~F.col("alike")), lambda h: h != "")).alias("related"))
    page = made.where("box = 0").select(key, "sources", "restriction", "others", "sections", *_record())
    page = page.join(per, key, "left").join(titles, key, "left")
    lists = {"variants": per.schema["variants"].dataType, "related": per.schema["related"].dataType}
    page = page.select("*", *(F.coalesce(c, F.array().cast(t)).alias(f"__{c}") for c, t in lists.items())).drop(*lists).withColumnsRenamed({f"__{c}": c for c in lists})
    found = known.join(page, key, "left")
    pair = lambda k, v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    extra = F.coalesce(F.transform("others", lambda o: F.struct(o["key"].alias("k"), o["value"].alias("v"))), F.array().cast("array<struct<k:string,v:string>>"))
    parts = F.coalesce(F.transform(F.filter("sections", lambda s: s["title"] != ""), lambda s: F.struct(F.concat(F.lit("section:"), s["title"]).alias("k"), s["text"].alias("v"))), F.array().cast("array<struct<k:string,v:string>>"))
    listed = lambda k, c: F.when(F.size(c) > 0, F.array(pair(k, F.array_join(c, " ; ")))).otherwise(F.array().cast("array<struct<k:string,v:string>>"))
    all_ = F.concat(F.when(F.col("restriction").isNotNull(), F.array(pair("deity_restriction", F.col("restriction")))).otherwise(F.array().cast("array<struct<k:string,v:string>>")), extra, parts, listed("related", "related"), listed("unparsed_levels", "rejects"))
    names = F.transform(all_, lambda p: p["k"])
    others = F.map_from_entries(F.filter(all_, lambda p, i: F.array_position(names, p["k"]) == i + 1))
    own = F.when((F.col("__title") != "") & (F.col("__name").isNull() | (text.slug(F.col("__title")) == text.slug(F.col("__name")))), F.col("__title")).otherwise(F.col("__name"))
    there = F.col("rejects").isNotNull()
    document = F.struct(text.slug(F.coalesce("__name", own)).alias("id"), own.alias("name"), F.col("__url").alias("url"), *SHARED, "variants", "sources", others.alias("others"), F.array().cast("array<string>").alias("classes"), F.struct(F.col("__url").alias("url"), F.lit("1").alias("parser_version")).alias("meta"))
    seen = F.struct(F.transform("others", lambda o: o["key"]).alias("unknown_labels"), F.col("rejects").alias("rejected_levels"), F.transform("sections", lambda s: s["title"]).alias("unknown_sections"))
    out = materialize(found.select(key, F.when(there, document).alias("document"), F.when(there, seen).alias("diagnostics")), "documents")
    discard(nodes, made)
    return out


# pages of feats

# Rubrics, in label form, with the fields that they fill; those that end the description.
RUBRICS = {
    "categorie": "category", "categories": "category", "condition": "conditions", "conditions": "conditions", "conditions requises": "conditions", "condition requise": "conditions", "prerequis": "conditions",
    "avantage": "benefit", "avantages": "benefit", "special": "special", "speciale": "special", "normal": "normal",
}
# Fixed value: a rubric is a short bold text of letters, with or without a point or colon.
RUBRIC = r"^([A-Za-zÀ-ÿ][A-Za-zÀ-ÿ'’ ]{1,38}?)\s*[:.]?$"
MECHANICAL = ["category", "conditions", "benefit"]
TITLES = {"category": "Catégorie", "conditions": "Conditions", "benefit": "Avantage", "special": "Spécial", "normal": "Normal"}


@F.udtf(returnType="place int, bold boolean, raw string, source string, links array<struct<text:string,href:string>>")
class _Runs:
    """The content of a page as runs of text and bold texts in order, tables left out; its last row has what its links are."""

    def eval(self, html: str, content: str) -> Iterator[tuple]:
        if html is None:
            return
        root = markup.tree(html)
        body = root.first(content) or root
        links = [(markup.clean(n.raw_text()), n.attributes.get("href", "")) for n in body.walk() if n.tag == "a"]
        place, text_, stack = 0, [], list(reversed(body.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                text_.append(node)
            elif not node.tag:
                text_.append(node.text)
            elif node.tag == "br":
                text_.append(markup.BREAK)
            elif node.tag in ("b", "strong"):
                yield place, False, "".join(text_), None, []
                yield place + 1, True, node.raw_text(), None, []
                place, text_ = place + 2, []
            elif node.tag == "img" and node.attributes.get("title"):
                yield place, False, "".join(text_), node.attributes["title"], []
                place, text_ = place + 1, []
            elif node.tag not in ("table", "script", "style"):
                if node.tag in markup.BREAKS:
                    text_.append(markup.BREAK)
                    stack.append(markup.BREAK)
                stack.extend(reversed(node.children))
        yield place, False, "".join(text_), None, links


def wiki_links(links: Column, prefix: str = "", ending: str = "") -> Column:
    """Array of struct (text, target, anchor) of links inside a wiki: decoded, without prefix and ending, each once in order; those
    that lead nowhere are left out."""
    made = F.transform(links, lambda x: F.struct(x["text"].alias("text"), F.trim(F.regexp_replace(F.regexp_replace(F.try_url_decode(F.replace(F.substring_index(x["href"], "#", 1), F.lit("+"), F.lit("%2B"))), f"^{prefix}", ""), f"(?i){ending}$", "")).alias("target"), F.nullif(F.when(F.contains(x["href"], F.lit("#")), F.substr(x["href"], F.instr(x["href"], "#") + 1)), F.lit("")).alias("anchor")))
    return F.array_distinct(F.filter(made, lambda x: (F.coalesce(x["target"], F.lit("")) != "") | x["anchor"].isNotNull()))


def feat_documents(pages: DataFrame, key: str, html: str, *, content: str = "#PageContentDiv", prefix: str = r"Pathfinder-RPG\.", ending: str = r"\.ashx") -> DataFrame:
    """key and a feat page's record: sources, category and categories, description, conditions, benefit, special, normal, others (map
    of unknown rubrics), tables, links, and all of it as one text. A rubric is a short bold label; a repeated one goes on;
    bold words of the description, before the first rubric that ends it, are prose."""
    from tomewright.operators.html import category_names, tables

    pages = spread(pages.select(key, html), key)
    runs = pages.select(key, F.col(html).alias("__page")).lateralJoin(_Runs(F.col("__page").outer(), F.lit(content))).drop("__page")
    runs = materialize(runs, "runs")
    own, upto = Window.partitionBy(key), Window.partitionBy(key).orderBy("place")
    label = F.trim(F.regexp_replace(clean(F.col("raw")), r"\s+", " "))
    marks = F.col("bold") & label.rlike(RUBRIC)
    name = F.regexp_replace(F.regexp_extract(label, RUBRIC, 1), r"^[\s'’]+|[\s'’]+$", "")
    field = F.try_element_at(F.create_map(*[F.lit(x) for kv in RUBRICS.items() for x in kv]), text.label_key(name))
    rows = runs.withColumns({"name": F.when(marks, name), "field": F.when(marks, field)})
    rows = rows.withColumn("from", F.min(F.when(F.col("field").isin(*MECHANICAL), F.col("place"))).over(own))
    opens = F.col("name").isNotNull() & (F.col("place") >= F.col("from"))
    rows = rows.withColumns({"opens": F.coalesce(opens, F.lit(False)), "at": F.max(F.when(opens, F.col("place"))).over(upto)})
    pieces = rows.groupBy(key, "at").agg(F.max(F.when(F.col("opens"), F.col("field"))).alias("field"), F.max(F.when(F.col("opens"), F.col("name"))).alias("name"), clean(F.array_join(_in_order(F.col("raw"), "place", ~F.col("opens")), "")).alias("text"))
    pieces = pieces.withColumn("text", F.when(F.col("at").isNotNull(), F.regexp_replace("text", r"^[:.]\s*", "")).otherwise(F.col("text"))).where("text <> ''")
    pieces = pieces.withColumn("k", F.when(F.col("at").isNull(), "description").otherwise(F.coalesce("field", "name"))).withColumn("known", F.col("at").isNull() | F.col("field").isNotNull())
    pieces = pieces.groupBy(key, "k", "known").agg(F.min("at").alias("at"), F.array_join(_in_order(F.col("text"), "at", F.lit(True)), "\n\n").alias("text"))
    told = pieces.groupBy(key).agg(F.map_from_entries(F.collect_list(F.when(F.col("known"), F.struct("k", "text")))).alias("known"), _in_order(F.struct("k", "text"), "at", ~F.col("known")).alias("others"))
    facts = runs.groupBy(key).agg(_in_order(F.trim(F.regexp_replace("source", SOURCE, "")), "place", F.col("source").rlike(SOURCE)).alias("sources"), F.max_by("links", F.when(F.size("links") > 0, F.col("place"))).alias("links"))
    found = pages.select(key, tables(html).alias("tables")).join(facts, key, "left").join(told, key, "left")
    of = lambda f: F.try_element_at("known", F.lit(f))
    names = F.coalesce(F.array_sort(F.array_distinct(F.transform(category_names(F.lower(of("category"))), lambda c: F.regexp_replace(c, r"^[\s.;]+|[\s.;]+$", "")))), F.array().cast("array<string>"))
    drawn = F.transform("tables", lambda t: F.concat_ws("\n", F.when(t["caption"] != "", F.concat(F.lit("Tableau — "), t["caption"])), F.array_join(F.transform(t["rows"], lambda r: F.array_join(r, " | ")), "\n")))
    titled = [F.concat(F.lit(f"{title}. "), of(f)) for f, title in TITLES.items()]
    whole = F.concat_ws("\n\n", of("description"), *titled, F.nullif(F.array_join(F.transform(F.coalesce("others", F.array().cast("array<struct<k:string,text:string>>")), lambda o: F.concat(o["k"], F.lit(". "), o["text"])), "\n\n"), F.lit("")), F.nullif(F.array_join(drawn, "\n\n"), F.lit("")))
    out = found.select(key, F.coalesce("sources", F.array().cast("array<string>")).alias("sources"), of("category").alias("category"), names.alias("categories"), of("description").alias("description"), *(of(f).alias(f) for f in ("conditions", "benefit", "special", "normal")), F.map_from_entries("others").alias("others"), "tables", wiki_links(F.coalesce("links", F.array().cast("array<struct<text:string,href:string>>")), prefix, ending).alias("links"), whole.alias("text"))
    out = materialize(out, "feats")
    discard(runs)
    return out


def row_links(pages: DataFrame, key: str, html: str, base: str) -> DataFrame:
    """key, place, name, url of the first link in the first cell of each table row; a name loses the stars at its end."""
    row = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    rows = pages.select(key, F.posexplode(row).alias("place", "row")).withColumn("cell", F.regexp_extract("row", r"(?is)^.*?<td\b[^>]*>(.*?)(?:</td>|$)", 1))
    link = r"(?is)<a\b[^>]*href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    name = text.feat_name(F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("cell", link, 2), "<[^>]+>", ""), r"\s+", " ")))
    return rows.where(F.col("cell").rlike(link)).select(key, "place", name.alias("name"), F.concat(F.lit(base), F.regexp_extract("cell", link, 1)).alias("url"))
