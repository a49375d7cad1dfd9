"""Rule tables on pages to typed rows. A function over batches puts every cell into all places of the grid that it spans; what the columns
mean, and which of them nobody knows, is worked out from the head rows in Spark. Blank cells are null, never zero."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomewright.functions import markup, text
from tomewright.sources.shared import materialize, spread

# Columns of a progression, headings of groups, categories of armours, signs of an empty cell.
BASE = ["niveau", "bba", "reflexes", "vigueur", "volonte", "special"]
GROUPS = {"sorts par jour": "per_day", "sorts connus": "known"}
CATEGORIES = {"ARMURES LÉGÈRES": "legere", "ARMURES INTERMÉDIAIRES": "intermediaire", "ARMURES LOURDES": "lourde", "BOUCLIERS": "bouclier", "SUPPLÉMENTS": "supplement"}
BLANK = ["", "-", "—"]
BONUS_ENTRY = r"(?s)<b>(Bonus (?:d['’]|de |des )[^.<]+)\.</b>\s*([^<]*(?:<a[^>]*>[^<]*</a>[^<]*)*)"
SPELL_LEVELS = 10


CELLS = "tbl int, caption string, row int, col int, text string, origin int"
#: A batch of cells is passed on beyond this size.
BATCH = 20_000


def _places(html: str) -> Iterator[tuple]:
    """Every place of the grids of a page's tables, with where its text comes from (``markup.OWN``, ``LEFT`` or ``ABOVE``)."""
    for k, table in enumerate(n for n in markup.tree(html).walk() if n.tag == "table"):
        caption = next((markup.clean(n.raw_text()) for n in table.children if n.tag == "caption"), "")
        for i, row in enumerate(markup.grid(table)):
            for j, (cell, origin) in enumerate(row):
                yield k, caption, i, j, cell, origin


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32()]
    names = ["tbl", "caption", "row", "col", "text", "origin"]
    for batch in batches:
        at, out, last = [], [], batch.num_rows - 1
        for k, page in enumerate(batch.column(1).to_pylist()):
            if page is not None:
                out.extend(_places(page))
                at.extend([k] * (len(out) - len(at)))
            if out and (len(out) >= BATCH or k == last):
                values = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *values], [batch.schema.names[0], *names])
                at, out = [], []


def cells(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, tbl, caption, row, col, text, origin; pages are dealt over the cores before they are read, cells written once."""
    pages = spread(pages.select(key, html), key)
    return materialize(pages.mapInArrow(_cells, f"`{key}` {pages.schema[key].dataType.simpleString()}, {CELLS}"), "cells")


def signed(x: Column) -> Column:
    """``+2``, ``-1``, ``–1`` or ``3`` as an integer, else null."""
    plain = F.regexp_replace(F.trim(x), "[–−]", "-")
    return F.when(plain.rlike(r"^[+-]?\d+$"), F.regexp_replace(plain, r"^\+", "").cast("int"))


def filled(x: Column) -> Column:
    return F.when(~F.trim(x).isin(*BLANK), F.trim(x))


def progression_columns(grid: DataFrame, key: str) -> DataFrame:
    """Cells of each page's first progression table (one with a level and an attack column before any group), with the label of
    their column, ``base`` (whether the table's own columns have it), ``group`` and ``sub`` (the group and its inner label)."""
    table, column = Window.partitionBy(key, "tbl"), Window.partitionBy(key, "tbl", "col")
    at_row = lambda r, v=F.col("text"): F.when(F.col("row") == r, v)
    # dealt by page once, which serves all windows
    rows = grid.repartition(key).withColumns({
        "head": F.max(at_row(0)).over(column), "inner": F.max(at_row(1)).over(column),
        "group_at": F.min(F.when((F.col("row") == 0) & (F.col("origin") == markup.LEFT), F.col("col") - 1)).over(table),
        "two": F.coalesce(F.max(F.when((F.col("row") == 1) & (F.col("origin") == markup.ABOVE), True)).over(table), F.lit(False)),
    })
    rows = rows.withColumns({"base": F.col("group_at").isNull() | (F.col("col") < F.col("group_at")), "label": text.label_key(F.col("head"))})
    rows = rows.withColumn("first_col", F.min(F.when(F.col("base") & F.col("label").isin(*BASE), F.col("col"))).over(Window.partitionBy(key, "tbl", "label")))
    fits = F.bool_or(F.col("base") & (F.col("label") == "niveau")).over(table) & F.bool_or(F.col("base") & (F.col("label") == "bba")).over(table)
    rows = rows.withColumn("fits", fits).where("fits")
    rows = rows.withColumn("of", F.min("tbl").over(Window.partitionBy(key))).where("tbl = of")
    grouped = ~F.col("base") & F.col("two")
    return rows.select(
        key, "row", "col", "text", (F.col("row") >= F.when(F.col("two") & F.col("group_at").isNotNull(), 2).otherwise(1)).alias("data"), "head", "label",
        (F.coalesce(F.col("first_col") == F.col("col"), F.lit(False)) & F.col("base")).alias("known"), "base", F.when(grouped, F.col("label")).alias("group"), F.when(grouped, F.col("inner")).alias("sub"),
    )


def _as_map(value: Column, by: Column, test: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.collect_list(F.when(test, F.struct(by.alias("k"), value.alias("v"))))))


def progression(grid: DataFrame, key: str) -> DataFrame:
    """key, level, attack, series, reflex, fortitude, will, features (in order), extra (other columns by head), slots (spells of each
    level by kind; null where a cell is blank)."""
    c = progression_columns(grid, key).where("data")
    of = lambda name: F.max(F.when(F.col("known") & (F.col("label") == name), F.col("text")))
    spell = F.nullif(F.regexp_extract(text.label_key(F.col("sub")), r"^(\d+)", 1), F.lit("")).cast("int")
    kind = F.try_element_at(F.create_map(*[F.lit(x) for kv in GROUPS.items() for x in kv]), F.col("group"))
    c = c.withColumns({"spell": spell, "kind": kind})
    rows = c.groupBy(key, "row").agg(
        F.max(F.when(F.col("col") == 0, F.col("text"))).alias("first"), *(of(n).alias(n) for n in BASE[1:]), _as_map(F.col("text"), F.col("head"), F.col("base") & ~F.col("known")).alias("extra"),
        *(_as_map(signed(F.col("text")), F.col("spell"), (F.col("kind") == k) & F.col("spell").isNotNull()).alias(k) for k in GROUPS.values()),
    ).where("first RLIKE '^[0-9]+$'")
    listed = lambda x, sep: F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), sep), lambda p: F.trim(p)), lambda p: p != "")
    series = listed(F.col("bba"), "/")
    return rows.select(
        key, F.col("first").cast("int").alias("level"), signed(F.get(series, F.lit(0))).alias("attack"), series.alias("series"), signed(F.col("reflexes")).alias("reflex"), signed(F.col("vigueur")).alias("fortitude"),
        signed(F.col("volonte")).alias("will"), F.filter(listed(F.col("special"), ","), lambda p: ~p.isin("-", "—")).alias("features"), "extra", F.struct(*GROUPS.values()).alias("slots"),
    )


def progression_gaps(grid: DataFrame, key: str) -> DataFrame:
    """key, kind, label: base columns that a page's table lacks, and heads, groups and inner labels that nobody knows."""
    c = progression_columns(grid, key)
    heads = c.where("row = 0").select(key, "head", "label", "known", "base", "group", "sub")
    lacking = heads.groupBy(key).agg(F.array_except(F.array(*[F.lit(b) for b in BASE]), F.collect_set(F.when(F.col("known"), F.col("label")))).alias("x")).select(key, F.lit("missing").alias("kind"), F.explode("x").alias("label"))
    extra = heads.where("base AND NOT known").select(key, F.lit("column").alias("kind"), F.col("head").alias("label"))
    groups = heads.where(F.col("group").isNotNull() & ~F.col("group").isin(*GROUPS)).select(key, F.lit("group").alias("kind"), F.col("head").alias("label"))
    subs = heads.where("group IS NOT NULL").where(~text.label_key(F.col("sub")).rlike(r"^\d")).select(key, F.lit("inner").alias("kind"), F.col("sub").alias("label"))
    return lacking.unionByName(extra).unionByName(groups).unionByName(subs).distinct()


def _captioned(grid: DataFrame, caption: str) -> DataFrame:
    return grid.where(F.contains("caption", F.lit(caption)))


def _rows(grid: DataFrame, key: str, width: int) -> DataFrame:
    """A row for each line of a table: the texts of its first places, and where the third has its text from."""
    at = lambda k, c="text": F.max(F.when(F.col("col") == k, F.col(c)))
    return grid.groupBy(key, "tbl", "row").agg(F.array(*(at(k) for k in range(width))).alias("c"), F.count("*").alias("n"), F.count_if((F.col("col") > 2) & (F.col("origin") == markup.LEFT)).alias("spanned"), F.count_if((F.col("col") > 0) & (F.col("origin") != markup.LEFT)).alias("own"))


def ability_modifiers(grid: DataFrame, key: str, caption: str, heads: int = 2) -> DataFrame:
    """key, low, high, modifier of lines ``12–13 | +1``; nothing is made up beyond them."""
    rows = _rows(_captioned(grid, caption).where(F.col("row") >= heads), key, 2)
    bounds = F.transform(F.split(F.col("c")[0], "–"), lambda x: F.trim(x).try_cast("int"))
    return rows.select(key, bounds[0].alias("low"), F.element_at(bounds, -1).alias("high"), signed(F.col("c")[1]).alias("modifier")).where("low IS NOT NULL AND high IS NOT NULL AND modifier IS NOT NULL")


def bonus_slots(grid: DataFrame, key: str, caption: str, heads: int = 2) -> DataFrame:
    """key, modifier, slots: bonus spells by spell level; one cell over all levels means none at all."""
    rows = _rows(_captioned(grid, caption).where(F.col("row") >= heads), key, 2 + SPELL_LEVELS)
    value = lambda k: F.when(F.col("spanned") < SPELL_LEVELS - 1, signed(F.col("c")[2 + k]))
    slots = F.map_from_arrays(F.array(*(F.lit(k) for k in range(SPELL_LEVELS))), F.array(*(value(k) for k in range(SPELL_LEVELS))))
    return rows.select(key, signed(F.col("c")[1]).alias("modifier"), slots.alias("slots")).where("modifier IS NOT NULL")


def armours(grid: DataFrame, key: str, categories: dict[str, str] | None = None) -> DataFrame:
    """key, place, name, category and what an armour's line holds, as it is written. A line of one cell names the category of
    those below it."""
    categories = CATEGORIES if categories is None else categories
    rows = _rows(grid, key, 9)
    found = F.coalesce(*(F.when(F.contains(F.col("c")[0], F.lit(k)), F.lit(v)) for k, v in categories.items()))
    before = Window.partitionBy(key, "tbl").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("category", F.last(F.when((F.col("own") == 0) & (F.col("n") > 1), found), True).over(before)).where("own > 0 AND n >= 9 AND category IS NOT NULL")
    names = ["armour", "dexterity", "checks", "failure", "speed_9", "speed_6"]
    return rows.select(key, F.col("row").alias("place"), F.trim(F.regexp_replace(F.col("c")[0], "^↓+", "")).alias("name"), "category", F.col("c")[1].alias("price"), *(filled(F.col("c")[k + 2]).alias(n) for k, n in enumerate(names)), F.col("c")[8].alias("weight"))


def bonus_types(html: Column) -> Column:
    """Array of struct (key, label, note, cumulative) of the entries ``<b>Bonus de X.</b> note`` in order, of a repeated label the
    first; cumulative is null where the note doesn't say."""
    strip = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", " "), r"\s+", " "))
    labels, notes = (F.regexp_extract_all(html, F.lit(BONUS_ENTRY), F.lit(k)) for k in (1, 2))
    says = lambda n: F.when(F.contains(n, F.lit("se cumulent entre eux")) | (F.contains(n, F.lit("se cumulent")) & ~F.contains(n, F.lit("ne se cumulent"))), True).when(F.contains(n, F.lit("ne se cumulent")), False)
    made = F.zip_with(F.transform(labels, strip), F.transform(notes, strip), lambda a, n: F.struct(text.slug(F.regexp_replace(a, "^Bonus (?:d['’]|de |des )", "")).alias("key"), a.alias("label"), n.alias("note"), says(n).alias("cumulative")))
    names = F.transform(made, lambda x: x["label"])
    return F.filter(made, lambda x, i: F.array_position(names, x["label"]) == i + 1)
