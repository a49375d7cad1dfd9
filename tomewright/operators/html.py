"""HTML pages to text, headings, links, tables and labelled values. Pages are parsed one by one in Arrow batches with
the standard library's event parser; what can be a plain expression is one."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewright.functions import markup

# Elements that start a new line, and elements whose content isn't visible.
BLOCKS = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 table tr section article header footer nav aside main blockquote pre dl dt dd figure".split())
HIDDEN = frozenset("script style head template noscript".split())
MARGINS = HIDDEN | {"nav", "header", "footer", "aside"}
# Characters of pages after which their texts go on.
PIECE = 4_000_000


class _Text(HTMLParser):
    def __init__(self, skip: frozenset[str] = HIDDEN):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skip, self.depth = skip, 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.skip
        if tag in BLOCKS:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self.depth = max(0, self.depth - (tag in self.skip))
        if tag in BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def visible_text(html: str | None, skip: frozenset[str] = HIDDEN) -> str | None:
    """Visible text with a line for each block, spaces collapsed, no empty lines."""
    if html is None:
        return None
    parser = _Text(skip)
    parser.feed(html)
    parser.close()
    lines = (" ".join(line.replace("\xa0", " ").split()) for line in "".join(parser.parts).split("\n"))
    return "\n".join(line for line in lines if line)


@F.pandas_udf(T.StringType())
def html_text(html: pd.Series) -> pd.Series:
    return html.map(visible_text, na_action="ignore")


@F.pandas_udf(T.StringType())
def main_text(html: pd.Series) -> pd.Series:
    """Visible text without navigation, headers and footers."""
    return html.map(lambda x: visible_text(x, MARGINS), na_action="ignore")


def page_texts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, text and main (see ``html_text`` and ``main_text``) of every page. Both are made in one pass over a batch of pages, which goes on in
    pieces of about ``PIECE`` characters, so a worker holds the batch as it came and a piece of it, however large pages are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, texts, mains = 0, 0, [], []
            for i in range(batch.num_rows):
                page = batch.column(1)[i].as_py()
                texts.append(visible_text(page))
                mains.append(visible_text(page, MARGINS))
                held += len(page or "")
                if held >= PIECE or i + 1 == batch.num_rows:
                    made = [pa.array(x, pa.string()) for x in (texts, mains)]
                    yield pa.RecordBatch.from_arrays([batch.column(0)[start : i + 1], *made], [key, "text", "main"])
                    start, held, texts, mains = i + 1, 0, [], []

    kept = pages.select(key, html)
    return kept.mapInArrow(run, T.StructType([kept.schema[key], T.StructField("text", T.StringType()), T.StructField("main", T.StringType())]))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("caption", T.StringType()), T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType())))])))
def tables(html: pd.Series) -> pd.Series:
    """Tables in order, rows without any text dropped."""

    def one(x: str | None) -> list[dict] | None:
        if x is None:
            return None
        flat = lambda text: " ".join(text.split())
        out = []
        for table in (n for n in markup.tree(x).walk() if n.tag == "table"):
            caption = next((flat(markup.clean(n.raw_text())) for n in table.children if n.tag == "caption"), "")
            rows = [[flat(text) for text, origin in row if origin == markup.OWN] for row in markup.grid(table)]
            out.append({"caption": caption, "rows": [r for r in rows if any(r)]})
        return out

    return html.map(one)


class _Pairs(HTMLParser):
    """Values after bold labels, up to the next label or block end."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, list[str]]] = []
        self.bold = False

    def handle_starttag(self, tag, attrs):
        if tag in ("b", "strong"):
            self.bold = True
            self.found.append(("", []))

    def handle_endtag(self, tag):
        if tag in ("b", "strong"):
            self.bold = False

    def handle_data(self, data):
        if self.found:
            label, value = self.found[-1]
            if self.bold:
                self.found[-1] = (label + data, value)
            else:
                value.append(data)


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def labelled_values(html: pd.Series) -> pd.Series:
    """Label to value; of a repeated label the first counts."""

    def one(x: str | None) -> dict[str, str] | None:
        if x is None:
            return None
        parser = _Pairs()
        parser.feed(x)
        out: dict[str, str] = {}
        for label, value in parser.found:
            out.setdefault(label.strip().rstrip(":").strip(), " ".join("".join(value).split()).lstrip(": "))
        return out

    return html.map(one)


def headings(html: Column, level: int = 1) -> Column:
    """Inner texts of headings of a level, tags dropped; native."""
    inner = F.regexp_extract_all(html, F.lit(rf"(?is)<h{level}[^>]*>(.*?)</h{level}>"), F.lit(1))
    return F.transform(inner, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", " "), r"\s+", " ")))


def links(html: Column) -> Column:
    """Distinct link targets in order, without fragments; native."""
    found = F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*href=[\"']([^\"'#]+)"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: F.replace(x, F.lit("&amp;"), F.lit("&"))))


def page_gate(html: Column, least_bytes: int, markers: list[str]) -> Column:
    """Why a fetched page isn't usable, or null."""
    out = F.when(html.isNull(), "absent").when(F.octet_length(html) < least_bytes, "short")
    for m in markers:
        out = out.when(~F.contains(html, F.lit(m)), f"without {m}")
    return out


def stripped(x: Column) -> Column:
    """Text without tags, entities of spaces and ampersands decoded, spaces collapsed; native."""
    plain = F.replace(F.replace(F.regexp_replace(x, "<[^>]+>", " "), F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def inner_html(html: Column, tag: str, marker: str) -> Column:
    """What stands inside the first element of the tag with the marker (a pattern) among its attributes, verbatim, up to its own end
    tag, whatever it holds; null where there is none or it is empty."""
    wanted = re.compile(marker)

    @F.pandas_udf(T.StringType())
    def inner(pages: pd.Series) -> pd.Series:
        def one(x: str | None) -> str | None:
            if x is None:
                return None
            found = next((n for n in markup.tree(x).walk() if n.tag == tag and wanted.search(x[n.start : n.inner_start])), None)
            return x[found.inner_start : found.inner_stop] or None if found else None

        return pages.map(one)

    return inner(html)


@F.pandas_udf(T.ArrayType(T.StringType()))
def list_tokens(html: pd.Series) -> pd.Series:
    """Headings of second and third rank and list items in order, verbatim; items inside items belong to the outer one."""

    def one(x: str | None) -> list[str] | None:
        if x is None:
            return None
        out, stack = [], list(reversed(markup.tree(x).children))
        while stack:
            node = stack.pop()
            if node.tag in ("h2", "h3", "li"):
                out.append(x[node.start : node.stop])
                if node.tag == "li":
                    continue
            stack.extend(reversed(node.children))
        return out

    return html.map(one)


def list_entries(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, place, level, school, name, url, sources, blurb, reason: the list items of a page in order. The last heading of
    second rank gives the level (its number), the last of third rank the school; an item without a link or level has a reason.
    Headings and items are read in one pass and carried on inside the page; an item inside another is part of that."""
    rows = pages.select(key, F.posexplode(list_tokens(html)).alias("place", "token")).withColumn("kind", F.lower(F.regexp_extract("token", r"^<(\w+)", 1)))
    inner = stripped(F.col("token"))
    level = F.nullif(F.regexp_extract(inner, r"(\d+)", 1), F.lit("")).cast("int")
    rows = rows.withColumns({"h2": F.when(F.col("kind") == "h2", F.struct(level.alias("v"))), "h3": F.when(F.col("kind") == "h2", F.struct(F.lit(None).cast("string").alias("v"))).when(F.col("kind") == "h3", F.struct(inner.alias("v")))})
    before = Window.partitionBy(key).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"level": F.last("h2", True).over(before)["v"], "school": F.last("h3", True).over(before)["v"]}).where("kind = 'li'")
    link = r"(?is)<a\b[^>]*href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    name, url = F.nullif(stripped(F.regexp_extract("token", link, 2)), F.lit("")), F.nullif(F.regexp_extract("token", link, 1), F.lit(""))
    tags = F.transform(F.regexp_extract_all("token", F.lit(r"(?is)<sup\b[^>]*>(.*?)</sup>"), F.lit(1)), stripped)
    rest = F.regexp_replace(F.regexp_replace("token", r"(?is)<sup\b[^>]*>.*?</sup>", ""), r"(?is)^(.*?)<a\b.*?</a>", "$1")
    blurb = F.nullif(F.regexp_replace(stripped(rest), r"^[\s:;,.–—-]+", ""), F.lit(""))
    reason = F.when(name.isNull(), "no link").when(F.col("level").isNull(), "no level")
    return rows.select(key, "place", "level", "school", name.alias("name"), url.alias("url"), tags.alias("sources"), blurb.alias("blurb"), reason.alias("reason"))


def last_value_and_prose(text: Column, least: int = 200) -> Column:
    """struct (value, prose): the text up to the first line break that at least so many characters follow, and these."""
    cut = F.regexp_extract(text, rf"(?s)^(.*?)\n(.{{{least},}})$", 1)
    prose = F.nullif(F.regexp_extract(text, rf"(?s)^(.*?)\n(.{{{least},}})$", 2), F.lit(""))
    return F.struct(F.regexp_replace(F.when(prose.isNotNull(), cut).otherwise(text), r"^\s+|\s+$", "").alias("value"), F.regexp_replace(prose, r"^\s+|\s+$", "").alias("prose"))


def rubrics(text: Column, known: list[str]) -> Column:
    """Map of known headings (``Heading. text``, one a line) to their texts; ``""`` is what stands before the first."""
    names = "|".join(known)
    marked = F.concat(F.lit("\u0001"), F.regexp_replace(text, rf"(?m)^({names})\.\s*", "\u0001$1\u0002"))
    parts = F.filter(F.split(marked, "\u0001"), lambda p: F.trim(p) != "")
    pair = lambda p: F.struct(F.when(F.contains(p, F.lit("\u0002")), F.substring_index(p, "\u0002", 1)).otherwise("").alias("k"), F.regexp_replace(F.substring_index(p, "\u0002", -1), r"^\s+|\s+$", "").alias("v"))
    pairs = F.transform(parts, pair)
    keys = F.transform(pairs, lambda x: x["k"])
    return F.map_from_entries(F.filter(pairs, lambda x, i: F.array_position(keys, x["k"]) == i + 1))


def category_names(text: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(F.split(text, r"[,;/]|\set\s"), lambda p: F.trim(p)), lambda p: p != ""))


def skill_formula(text: Column) -> Column:
    """struct (points, ability) of ``2 + mod. d'Int``."""
    return F.struct(F.nullif(F.regexp_extract(text, r"(\d+)\s*\+", 1), F.lit("")).cast("int").alias("points"), F.nullif(F.regexp_extract(text, r"(?i)\b(For|Dex|Con|Int|Sag|Cha)\b", 1), F.lit("")).alias("ability"))


def traits(text: Column) -> Column:
    """Array of struct (ability, bonus) of ``+2 Force, -2 Charisme``; other parts are left out."""
    found = F.regexp_extract_all(text, F.lit(r"([+–−-]\d+)\s+(?:en |de |à la )?(\p{L}+)"), F.lit(0))
    return F.transform(found, lambda m: F.struct(F.regexp_extract(m, r"(\p{L}+)$", 1).alias("ability"), F.regexp_replace(F.regexp_extract(m, r"^([+–−-]\d+)", 1), "[–−]", "-").cast("int").alias("bonus")))
