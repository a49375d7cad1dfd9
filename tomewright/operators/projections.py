"""Named projections of records, the checks of what they publish, and the rules that curators' tables are drafted by."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewright.functions.text import feat_name, let, normal, search_key, slug
from tomewright.operators.ordering import numbered
from tomewright.operators.sheet import feat_slots
from tomewright.sources.shared import materialize, spread

# the published index of feats


def code_tables(rows: DataFrame, key: str, tables: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Dictionaries (table, value, code): the sorted distinct values of each, from 0; and key, codes: a map of table to the sorted
    codes of a row. tables: name to an array of values; null values have no code.

    A row's values are made distinct in the row and its codes where they are collected, so no task holds the values of all its rows."""
    told = F.array(*[F.struct(F.lit(t).alias("table"), F.array_distinct(F.coalesce(v, F.array().cast("array<string>"))).alias("values")) for t, v in tables.items()])
    dealt = spread(rows.select(key, told.alias("told")), key)
    long = materialize(dealt.select(key, F.inline("told")).select(key, "table", F.explode("values").alias("value")).where("value IS NOT NULL"), "values")
    values = long.select("table", "value").distinct()
    first = numbered(values, ["table", "value"], "at")
    codes = first.join(first.groupBy("table").agg(F.min("at").alias("low")), "table").select("table", "value", (F.col("at") - F.col("low")).cast("int").alias("code"))
    codes = materialize(codes, "codes")
    own = long.join(codes, ["table", "value"]).groupBy(key, "table").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return codes, own.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("table", "codes"))).alias("codes"))


def feat_index(rows: DataFrame, name: str, one: dict[str, str], several: dict[str, str], plain: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The published index of feats, a row for each with all its keys (i, id, s, n, nf, r and those asked for), and the dictionaries
    of its codes.

    i counts from 0 in order of the slug; nf is the folded name; r says whether it can be taken again (a star at its end). one and
    several: short keys to columns with one value (a code or null) or an array (sorted codes, an empty list for none); plain:
    short keys to columns taken as they are."""
    known = rows.withColumns({"__slug": slug(feat_name(F.col(name))), "__n": F.col(name)})
    tables = {k: F.when(F.col(c).isNotNull(), F.array(F.col(c))) for k, c in one.items()} | {k: F.col(c) for k, c in several.items()}
    codes, own = code_tables(known, "__slug", tables)
    placed = numbered(known, ["__slug"], "i").join(own, "__slug", "left")
    of = lambda k: F.coalesce(F.try_element_at("codes", F.lit(k)), F.array().cast("array<int>"))
    index = placed.select(
        F.col("i").cast("int").alias("i"), F.col("__slug").alias("id"), F.col("__slug").alias("s"), F.col("__n").alias("n"), search_key(F.col("__n")).alias("nf"), F.endswith(F.rtrim("__n"), F.lit("*")).alias("r"),
        *(F.get(of(k), F.lit(0)).alias(k) for k in one), *(of(k).alias(k) for k in several), *(F.col(c).alias(k) for k, c in plain.items()),
    )
    return index, codes


def feat_props(rows: DataFrame, details: DataFrame, key: str, fields: list[str], more: list[str]) -> DataFrame:
    """id, slug, name, the record's fields and the details of its page where there are any; all keys are there for each."""
    found = details.groupBy(key).agg(*(F.first(c).alias(f"__{c}") for c in more))
    joined = rows.join(found, key, "left")
    return joined.select(slug(feat_name(F.col(key))).alias("id"), slug(feat_name(F.col(key))).alias("slug"), F.col(key).alias("name"), *fields, *(F.col(f"__{c}").alias(c) for c in more))


def index_violations(index: DataFrame, codes: DataFrame, one: list[str], several: list[str]) -> DataFrame:
    """check, id of what a published index breaks: repeated ids or slugs, places that aren't 0, 1, 2, ..., folded names that aren't
    those of the names, codes out of their dictionary, dictionary values that no row has, and line ends or replacement characters."""
    of = lambda check, rows, id_: rows.select(F.lit(check).alias("check"), id_.cast("string").alias("id"))
    repeated = [of(f"repeated_{c}", index.groupBy(c).count().where("count > 1"), F.col(c)) for c in ("id", "s", "i")]
    bounds = index.agg(F.count("*").alias("__rows"))  # one row
    sparse = index.crossJoin(F.broadcast(bounds)).where((F.col("i") < 0) | (F.col("i") >= F.col("__rows")))
    used = index.select("id", F.inline(F.array(*[F.struct(F.lit(k).alias("table"), (F.array(F.col(k)) if k in one else F.col(k)).alias("codes")) for k in [*one, *several]]))).select("id", "table", F.explode("codes").alias("code")).where("code IS NOT NULL")
    unknown = used.join(codes.select("table", "code"), ["table", "code"], "left_anti")
    orphan = codes.join(used.select("table", "code").distinct(), ["table", "code"], "left_anti")
    broken = F.col("n").contains("\r") | F.col("n").contains("�")
    parts = [*repeated, of("sparse", sparse, F.col("id")), of("folded", index.where(~F.col("nf").eqNullSafe(search_key(F.col("n")))), F.col("id")), of("code", unknown, F.col("id")), of("orphan_code", orphan, F.concat_ws(":", "table", "value")), of("text", index.where(broken), F.col("id"))]
    return reduce(DataFrame.unionByName, parts).distinct()


def by_name(conditions: DataFrame, names: DataFrame, slug_column: str, name: str) -> DataFrame:
    """conditions with the exact name that their slug stands for; slugs without a name are dropped. Of names with one slug the last
    in order counts."""
    known = names.select(slug(F.col(name)).alias(slug_column), F.col(name)).groupBy(slug_column).agg(F.max(name).alias(name))
    return conditions.join(known, slug_column)


# characters

# Short names of abilities, in order.
ABILITIES = {"force": "For", "dexterite": "Dex", "constitution": "Con", "intelligence": "Int", "sagesse": "Sag", "charisme": "Cha"}


def sheet_character() -> Column:
    """A sheet (classes: array of name and level; race, size, alignment, deity; abilities: map; feats: array of names) as a
    character of the engine. What isn't there stays null and is never guessed; without a class and its level there is no
    character, which isn't a refusal. Feats are a list even where there are none."""
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    first = F.get(F.col("classes"), F.lit(0))
    known = [F.struct(F.lit(short).alias("k"), F.try_element_at("abilities", F.lit(long)).alias("v")) for long, short in ABILITIES.items()]
    defined = F.filter(F.array(*known), lambda x: x["v"].isNotNull())
    feats = F.array_distinct(F.filter(F.transform(F.coalesce("feats", F.array().cast("array<string>")), lambda x: normal(feat_name(x))), lambda x: x != ""))
    made = F.struct(
        filled(first["name"]).alias("class"), first["level"].alias("level"), filled(F.col("race")).alias("race"), filled(F.col("size")).alias("size"), F.when(F.size(defined) > 0, F.map_from_entries(defined)).alias("abilities"),
        F.array_sort(feats).alias("known"), filled(F.col("alignment")).alias("alignment"), filled(F.col("deity")).alias("deity"),
    )
    return F.when(filled(first["name"]).isNotNull() & first["level"].isNotNull(), made)


def profiles(rows: DataFrame, key: str, race_bonus: Column, bonus_levels: Column) -> DataFrame:
    """rows (key, level and what else a profile has) with their feat slots in order (source, level, no feat yet)."""
    slots = feat_slots(rows, key, "level", race_bonus, bonus_levels)
    order = F.when(F.col("source") == "general", 0).when(F.col("source") == "racial", 1).otherwise(2)
    listed = slots.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "level", "source"))).alias("s"))
    made = F.transform("s", lambda x: F.struct(x["source"].alias("source"), x["level"].alias("level"), F.lit(None).cast("string").alias("feat")))
    return rows.join(listed, key, "left").withColumn("slots", F.coalesce(made, F.array().cast("array<struct<source:string,level:int,feat:string>>"))).drop("s")


# drafts of curated tables

# Patterns that give a class's ability away or only name it, and keywords of casters.
GRANTING = ["comme un pouvoir magique", "comme des pouvoirs magiques", "comme avec la capacite", "son niveau de personnage comme niveau de", "niveau de personnage comme niveau"]
MENTIONS = [r"liste de sorts (?:du|de la|de l.|d.|de) {c}\b", r"\bsa liste de {c}\b", r"\bses listes? de sorts? de {c}\b", r"\bniveaux? de {c}\b", r"\bniveau effectif de {c}\b"]
CASTER_WORDS = [
    "sorts connus", "emplacements de sorts", "sorts par jour", "lanceur de sorts", "liste de sorts", "niveau de lanceur de sorts", "orientation arcane", "domaine", "mystere", "ecole de predilection",
    "sort de mystere", "tours de magie", "oraisons", "oraison", "pouvoir de lignage", "pacte magique", "ecole de magie", "incantation spontanee",
]


def class_mentions(texts: list[Column], classes: list[str]) -> Column:
    """Sorted classes that a text leans on, null where it grants the ability instead of asking for it, names none, or is empty."""

    def found(key: Column) -> Column:
        named = [F.when(reduce(lambda a, b: a | b, (key.rlike(p.replace("{c}", rf"\Q{c}\E")) for p in MENTIONS)), F.lit(c)) for c in classes]
        hits = F.array_sort(F.array_compact(F.array(*named)))
        grants = reduce(lambda a, b: a | b, (F.contains(key, F.lit(g)) for g in GRANTING))
        return F.when((F.trim(key) != "") & ~grants & (F.size(hits) > 0), hits)

    return let(normal(F.concat_ws(" ", *texts)), found)


def attribution(text: Column, rules: list[tuple[str, list[str]]], drafted: Column, keywords: Column, named: Column, generic: str = "sort") -> Column:
    """struct (outcome, classes): the classes of the first rule (a pattern) that the text meets; a text that only speaks of the
    generic ability has no single class; else the drafted ones, where a class is named or a keyword other than the generic one
    was found."""
    none = F.array().cast("array<string>")
    outcome = lambda kind, classes: F.struct(F.lit(kind).alias("outcome"), classes.alias("classes"))

    def decide(key: Column) -> Column:
        own = F.when(F.lit(False), outcome("mapped", none))
        for pattern, classes in rules:
            own = own.when(key.rlike(pattern), outcome("mapped", F.array(*[F.lit(c) for c in classes])))
        clear = (F.size(drafted) > 0) & ((F.size(named) > 0) | ((F.size(keywords) > 0) & (keywords != F.array(F.lit(f"{generic}s")))))
        return own.when(F.contains(key, F.lit(generic)), outcome("no_single_class", none)).when(F.coalesce(clear, F.lit(False)), outcome("mapped", drafted)).otherwise(outcome("no_single_class", none))

    return let(F.regexp_replace(normal(text), "[’‘ʼ]", "'"), decide)


def caster_guess(features: Column) -> Column:
    """struct (caster, evidence) from a map of level to names of abilities: which keywords of casters their texts hold."""
    whole = normal(F.array_join(F.flatten(F.map_values(features)), " "))
    return let(whole, lambda key: let(F.filter(F.array(*[F.lit(w) for w in CASTER_WORDS]), lambda w: F.contains(key, w)), lambda e: F.struct((F.size(e) > 0).alias("caster"), e.alias("evidence"))))


def review_gaps(review: DataFrame, curated: DataFrame, names: DataFrame, key: str, reasons: list[str]) -> DataFrame:
    """problem, key: records of a review (key, fragments) that aren't curated (key, added, ignored: array of fragment and reason) or
    only in part, curated ones that aren't in the catalogue or no longer in the review, and reasons that aren't known."""
    r, c = review.select(key, F.size(F.array_distinct("fragments")).alias("asked")), curated.select(key, F.size("added").alias("added"), F.size(F.array_distinct(F.transform("ignored", lambda x: x["fragment"]))).alias("ignored"))
    both = r.join(c, key)
    of = lambda problem, rows: rows.select(F.lit(problem).alias("problem"), key)
    odd = curated.where(F.exists("ignored", lambda x: ~x["reason"].isin(*reasons)))
    parts = [of("not_curated", r.join(c, key, "left_anti")), of("not_reviewed", c.join(r, key, "left_anti")), of("not_in_catalogue", c.join(names.select(key).distinct(), key, "left_anti")), of("undecided", both.where("added + ignored < asked")), of("reason", odd)]
    return reduce(DataFrame.unionByName, parts)


def cache_references(records: DataFrame, files: DataFrame, key: str, path: str) -> DataFrame:
    """key, severity, problem of records whose stored page can't be found. Where no page is stored at all this is expected and only a
    warning; a missing file among others is blocking; a record that names none is a warning."""
    there = files.select(F.col("path").alias(path)).distinct()
    any_ = F.broadcast(files.limit(1).agg((F.count("*") > 0).alias("stored")))
    lost = records.where(F.col(path).isNotNull()).join(there, path, "left_anti").crossJoin(any_)
    return lost.select(key, F.when(F.col("stored"), "blocking").otherwise("warning").alias("severity"), F.lit("missing").alias("problem")).unionByName(records.where(F.col(path).isNull()).select(key, F.lit("warning").alias("severity"), F.lit("unnamed").alias("problem")))


def convention_findings(levels: DataFrame, listed: list[str], tolerated: list[str]) -> DataFrame:
    """abbreviation, severity, n: those outside the list, in how many records; agreed exceptions are only reported."""
    rare = levels.where(~F.col("abbreviation").isin(*listed)).groupBy("abbreviation").agg(F.count_distinct("id").alias("n"))
    return rare.select("abbreviation", F.when(F.col("abbreviation").isin(*tolerated), "info").otherwise("warning").alias("severity"), "n")


def without_school(index: DataFrame, key: str, exempt: list[str]) -> DataFrame:
    """Keys without a school whose classes (an array) are all exempt from having one."""
    return index.where(F.col("school").isNull() & (F.size("classes") > 0) & F.forall("classes", lambda c: c.isin(*exempt))).select(key)
