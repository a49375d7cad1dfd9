"""Catalogue assembly: repairs, supplements, registries, abbreviations, record contracts, stores and verdict groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewright.functions.text import feat_name, slug, with_additions
from tomewright.operators.ordering import numbered
from tomewright.sources.shared import discard, materialize

# What a failed import leaves in a cell.
IMPORT_ERROR = "#ERROR!"


def valid_rows(rows: DataFrame, columns: list[str], marker: str = IMPORT_ERROR) -> DataFrame:
    """Rows without the marker in the columns; nulls stay."""
    out = rows
    for c in columns:
        out = out.where(~F.col(c).eqNullSafe(marker))
    return out


def repaired(rows: DataFrame, name: str, column: str, scraped: DataFrame, marker: str = IMPORT_ERROR) -> DataFrame:
    """rows whose marked cells have the text that was scraped for the name without stars (scraped: name, text); the marker
    stays where there is none."""
    found = scraped.where(F.trim("text") != "").groupBy(feat_name(F.col("name")).alias("__n")).agg(F.max("text").alias("__t"))
    joined = rows.join(found, feat_name(F.col(name)) == F.col("__n"), "left")
    return joined.withColumn(column, F.when(F.col(column) == marker, F.coalesce("__t", column)).otherwise(F.col(column))).drop("__n", "__t")


def supplemented(rows: DataFrame, name: str, conditions: str, additions: DataFrame) -> DataFrame:
    """rows with ``effective``: the conditions with what was added for the name (additions: name, additions), and these."""
    joined = rows.join(additions.select(F.col("name").alias("__n"), F.col("additions").alias("__a")), feat_name(F.col(name)) == F.col("__n"), "left")
    return joined.withColumn("effective", with_additions(F.col(conditions), F.col("__a"))).withColumn("added", F.coalesce("__a", F.array().cast("array<string>"))).drop("__n", "__a")


def bridge(classes: DataFrame, abbreviations: DataFrame, combined: DataFrame) -> DataFrame:
    """class_id, abbreviation, place: what stands for a class on a page. A class whose label is combined has the label's
    abbreviations in their order; others all that name their slug, the longest first. classes (class_id, label, slug),
    abbreviations (abbreviation, slug), combined (label, abbreviation, place)."""
    by_label = classes.join(combined, "label").select("class_id", "abbreviation", "place")
    rest = classes.join(combined.select("label").distinct(), "label", "left_anti").join(abbreviations, "slug")
    ranked = rest.groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct((-F.char_length("abbreviation")).alias("n"), "abbreviation"))).alias("a"))
    return by_label.unionByName(ranked.select("class_id", F.posexplode("a").alias("place", "s")).select("class_id", F.col("s.abbreviation").alias("abbreviation"), "place"))


def page_levels(bridged: DataFrame, levels: DataFrame) -> DataFrame:
    """class_id, id, level, spread: the level that a page gives a class: that of its first abbreviation there; spread where its
    abbreviations differ. levels (id, abbreviation, level)."""
    met = levels.join(bridged, "abbreviation")
    return met.groupBy("class_id", "id").agg(F.min_by("level", "place").alias("level"), (F.count_distinct("level") > 1).alias("spread"))


def unknown_abbreviations(levels: DataFrame, abbreviations: DataFrame, out_of_scope: DataFrame) -> DataFrame:
    """abbreviation, n, scope: those that no class has, out (known not to matter) or unknown."""
    alone = levels.join(abbreviations.select("abbreviation"), "abbreviation", "left_anti").groupBy("abbreviation").agg(F.count("*").alias("n"))
    return alone.join(out_of_scope.select("abbreviation", F.lit("out").alias("scope")), "abbreviation", "left").withColumn("scope", F.coalesce("scope", F.lit("unknown")))


def registry(classes: DataFrame, lists: DataFrame, casters: DataFrame) -> DataFrame:
    """Classes (name) with their spell list (lists: name, spell_list) and caster flag (casters: name, caster), joined by folded
    slug; curate says what is to be looked at."""
    key = lambda df, c: df.withColumn("__k", slug(F.col(c)))
    joined = key(classes, "name").join(key(lists, "name").select("__k", "spell_list"), "__k", "left").join(key(casters, "name").select("__k", "caster"), "__k", "left").drop("__k")
    reason = F.when(F.col("caster").isNull(), "caster unknown").when(F.col("caster") & F.col("spell_list").isNull(), "caster without list").when(~F.col("caster") & F.col("spell_list").isNotNull(), "list without caster")
    return joined.withColumn("curate", reason)


def classes_by_list(registered: DataFrame) -> DataFrame:
    """spell_list, classes in order."""
    return registered.where("spell_list IS NOT NULL").groupBy("spell_list").agg(F.array_sort(F.collect_list("name")).alias("classes"))


def flag_differences(curated: DataFrame, drafted: DataFrame, key: str, flag: str) -> DataFrame:
    """key, problem: missing in one of both, or different flags."""
    j = curated.select(F.col(key), F.col(flag).alias("a"), F.lit(1).alias("__a")).join(drafted.select(F.col(key), F.col(flag).alias("b"), F.lit(1).alias("__b")), key, "full")
    problem = F.when(F.col("__a").isNull(), "not curated").when(F.col("__b").isNull(), "not drafted").when(~F.col("a").eqNullSafe(F.col("b")), "differs")
    return j.select(key, problem.alias("problem")).where("problem IS NOT NULL")


def inverse(rows: DataFrame, key: str, values: Column) -> DataFrame:
    """value, keys in order, of an array column."""
    return rows.select(key, F.explode(F.array_distinct(values)).alias("value")).groupBy("value").agg(F.array_sort(F.collect_set(key)).alias("keys"))


def slot_candidates(verdicts: DataFrame, categories: DataFrame, name: str, restriction: str | None) -> DataFrame:
    """Verdicts that a slot may take: eligible or to be checked, and of its category where it is restricted."""
    open_ = verdicts.where(F.col("status").isin("eligible", "manual_check"))
    return open_ if restriction is None else open_.join(categories.where(F.array_contains("categories", restriction)).select(name), name, "left_semi")


def assignment_problems(slots: DataFrame, wanted: DataFrame) -> DataFrame:
    """slot, feat, problem of wanted (slot, feat) against slots (slot, feat or null): unknown, occupied, or held already."""
    held = slots.where("feat IS NOT NULL").select(F.col("feat")).distinct().withColumn("held", F.lit(True))
    j = wanted.join(slots.select("slot", F.col("feat").alias("now"), F.lit(True).alias("known")), "slot", "left").join(held, "feat", "left")
    problem = F.when(F.col("known").isNull(), "unknown").when(F.col("now").isNotNull(), "occupied").when(F.col("held"), "duplicate")
    return j.select("slot", "feat", problem.alias("problem"))


def kept_hits(hits: DataFrame, rows: DataFrame, key: str, predicate: Column) -> DataFrame:
    """Ranked hits whose entity a filter keeps, in their order; unknown ids are dropped."""
    return hits.join(rows.where(predicate).select(key), key, "left_semi")


def record_contract(rows: DataFrame, raw: str, key: str, name: str, keys: list[str], file: str | None = None) -> DataFrame:
    """key, code: what a JSON record breaks: its keys or their order, an id that its name doesn't give (a number behind is
    allowed), a file that isn't named after it."""
    own = F.json_object_keys(raw)
    wanted = F.array(*[F.lit(k) for k in keys])
    base = slug(F.get_json_object(raw, f"$.{name}"))
    id_ = F.get_json_object(raw, f"$.{key}")
    stem = F.regexp_replace(id_, r"-\d+$", "")
    codes = [
        F.when(own.isNull(), "unreadable"),
        F.when(F.size(F.array_except(wanted, own)) > 0, "missing_key"),
        F.when(F.size(F.array_except(own, wanted)) > 0, "extra_key"),
        F.when((F.size(F.array_except(wanted, own)) == 0) & (F.size(F.array_except(own, wanted)) == 0) & (own != wanted), "key_order"),
        F.when((id_ != base) & (stem != base), "id"),
    ]
    if file:
        codes.append(F.when(F.col(file) != F.concat(id_, F.lit(".json")), "file_name"))
    return rows.select(F.coalesce(id_, F.lit("?")).alias(key), F.explode(F.array_compact(F.array(*codes))).alias("code"))


def schema_errors(raw: Column, spec: dict[str, tuple[str, bool, list[str] | None]]) -> Column:
    """Sorted ``path: problem`` of a JSON text against path to (kind, required, closed list): missing, type, or value. Kinds are
    those of variants: STRING, BIGINT, DOUBLE, BOOLEAN, ARRAY, OBJECT. An unreadable text is one error."""
    doc = F.try_parse_json(raw)
    found = []
    for path, (kind, required, allowed) in spec.items():
        at = F.try_variant_get(doc, f"$.{path}", "variant")
        null = at.isNull() | F.is_variant_null(at)
        own = F.regexp_extract(F.schema_of_variant(at), r"^(\w+)", 1)
        fits = own.isin("BIGINT", "DOUBLE", "DECIMAL") if kind == "DOUBLE" else own == kind
        value = F.lit(False) if allowed is None else ~F.try_variant_get(doc, f"$.{path}", "string").isin(*allowed)
        wrong = F.when(~fits, "type").when(value, "value")
        found.append(F.when(null, "missing" if required else None).otherwise(wrong))
    named = F.array_compact(F.array(*[F.when(e.isNotNull(), F.concat(F.lit(f"{p}: "), e)) for p, e in zip(spec, found, strict=True)]))
    return F.when(doc.isNull(), F.array(F.lit("$: unreadable"))).otherwise(F.array_sort(named))


def forbidden_keys(raw: Column, keys: list[str]) -> Column:
    """Which of the keys a JSON text has anywhere, at any depth."""
    return F.filter(F.array(*[F.lit(k) for k in keys]), lambda k: F.regexp_like(raw, F.concat(F.lit('"\\Q'), k, F.lit('\\E"\\s*:'))))


def store_state(raw: Column, version: int) -> Column:
    """absent, unreadable, version (another one), lists (some list is broken) or ok, of a stored favourites document."""
    own = F.get_json_object(raw, "$.version").try_cast("int")
    lists = F.from_json(F.get_json_object(raw, "$.lists"), "array<struct<id:string,name:string,ids:array<string>>>")
    broken = lists.isNull() | F.exists(lists, lambda x: x["id"].isNull() | x["ids"].isNull())
    return F.when(raw.isNull() | (F.trim(raw) == ""), "absent").when(F.json_object_keys(raw).isNull(), "unreadable").when(~own.eqNullSafe(version), "version").when(broken, "lists").otherwise("ok")


def good_lists(raw: Column) -> Column:
    """The lists of a document that aren't broken."""
    lists = F.from_json(F.get_json_object(raw, "$.lists"), "array<struct<id:string,name:string,ids:array<string>>>")
    return F.filter(lists, lambda x: x["id"].isNotNull() & x["ids"].isNotNull())


def active_list(active: Column, lists: Column) -> Column:
    """The active id if a list has it, else the first list's."""
    ids = F.transform(lists, lambda x: x["id"])
    return F.when(F.array_contains(ids, active), active).otherwise(F.try_element_at(ids, F.lit(1)))


def migrated(version: Column, value: Column, steps: dict[int, object]) -> Column:
    """The value through the steps (version to a function of a column) from its own version on; null for a later one."""
    out = value
    for k in sorted(steps):
        out = F.when(version <= k, steps[k](out)).otherwise(out)
    return F.when(version <= max(steps) + 1, out)


def merged_ids(own: Column, other: Column) -> Column:
    """struct (ids, n_new): own ids in order, then the others' new ones, each once."""
    new = F.array_except(other, own)
    return F.struct(F.array_distinct(F.concat(own, new)).alias("ids"), F.size(new).alias("n_new"))


def toggled(ids: Column, id_: Column) -> Column:
    return F.when(F.array_contains(ids, id_), F.array_remove(ids, id_)).otherwise(F.array_append(ids, id_))


def flattened(rows: DataFrame, owner: str, values: str) -> DataFrame:
    """owner, place, value of an array column: state as rows."""
    return rows.select(owner, F.posexplode(values).alias("place", "value"))


def divergence_causes(pairs: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The most frequent causes: keys, n; ties by key."""
    return pairs.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys).limit(n)


def usage(calls: DataFrame, reason: str, tokens: list[str]) -> DataFrame:
    """Of calls: reason (null: written), calls, and sums of the token columns; one row more for all."""
    return calls.rollup(F.coalesce(reason, F.lit("written")).alias("reason")).agg(F.count("*").alias("calls"), *[F.sum(t).cast("long").alias(t) for t in tokens]).withColumn("reason", F.coalesce("reason", F.lit("all")))


def batch_check(expected: DataFrame, answers: DataFrame, name: str, value: str, citation: str, source: str, vocabulary: list[str]) -> DataFrame:
    """name, value, redo: the first answer of each expected name; unknown and repeated names are ignored, a value outside
    the vocabulary is nothing, and a missing citation or one that the source doesn't hold asks for another go. answers have a
    ``position``."""
    from tomewright.functions.text import citation_key

    first = answers.groupBy(name).agg(F.min_by(F.struct(value, citation), "position").alias("a"))
    j = expected.join(first, name, "left")
    held = F.contains(citation_key(F.col(source)), citation_key(F.col(f"a.{citation}")))
    return j.select(name, F.when(F.col(f"a.{value}").isin(*vocabulary), F.col(f"a.{value}")).alias(value), (~F.coalesce(held & (F.trim(f"a.{citation}") != ""), F.lit(False))).alias("redo"))


def _letters(label: Column) -> Column:
    """The letters of a label, each with how often it has come up: what two labels share of these bounds what they can match."""
    chars = F.split(label, "(?<=.)(?=.)")
    return F.transform(chars, lambda c, i: F.concat(c, F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x == c)).cast("string")))


def alike_pairs(rows: DataFrame, ratio: float) -> DataFrame:
    """a, b, ratio of labels (__l, __place) that are alike enough, the earlier one first.

    Twice the matching characters over both lengths is at most the same of the letters that they share. So of two alike labels,
    the rarest letters (a share of them that follows from the ratio) have one in common, and their lengths are near; only such
    pairs are compared. Nothing that could be alike is left out."""
    import difflib

    import pandas as pd

    least = ratio / (2 - ratio)
    marked = rows.select("__l", "__place", F.char_length("__l").alias("__size"), _letters(F.col("__l")).alias("x"))
    common = marked.select(F.explode("x").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    rare = marked.select("__l", "__place", "__size", F.explode("x").alias("t")).join(common, "t")
    rare = rare.groupBy("__l", "__place", "__size").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "t"))), lambda x: x["t"]).alias("x"))
    kept = F.col("__size") - F.ceil(F.col("__size") * least - 1e-9) + 1
    keyed = materialize(rare.select("__l", "__place", "__size", F.explode(F.slice("x", 1, kept.cast("int"))).alias("t")), "letters")
    a, b = keyed.alias("a"), keyed.alias("b")
    near = F.expr(f"a.t = b.t AND a.__place < b.__place AND least(a.__size, b.__size) >= {least} * greatest(a.__size, b.__size) - 1e-9")
    pairs = a.join(b, near).select(F.col("a.__l").alias("a"), F.col("b.__l").alias("b")).distinct()

    def compare(batches):
        matcher = difflib.SequenceMatcher()
        for batch in batches:
            out = []
            for b_, group in batch.groupby("b", sort=False)["a"]:
                matcher.set_seq2(b_)
                for a_ in group:
                    matcher.set_seq1(a_)
                    if matcher.real_quick_ratio() >= ratio and matcher.quick_ratio() >= ratio and matcher.ratio() >= ratio:
                        out.append((a_, b_, matcher.ratio()))
            yield pd.DataFrame(out, columns=["a", "b", "ratio"])

    found = materialize(pairs.mapInPandas(compare, "a string, b string, ratio double"), "alike")
    discard(keyed)
    return found


def clusters(labels: DataFrame, label: str, n: str, ratio: float) -> DataFrame:
    """label, head: labels one after another, the most frequent first (ties by label), join the head before them that is most
    alike (the larger one among equals), if one is alike enough, or become a head.

    Worked in rounds: a label is a head once all alike labels before it are settled and none of them is one, and joins as soon as
    one is. What alike labels are is worked out once, on distinct labels."""
    rows = labels.groupBy(F.col(label).alias("__l")).agg(F.sum(n).alias("__n")).where("__l IS NOT NULL")
    placed = materialize(numbered(rows.select("__l", (-F.col("__n")).alias("__less")), ["__less", "__l"], "__place"), "placed")
    edges = alike_pairs(placed.where("__l <> ''"), ratio)
    state = materialize(placed.select("__l", F.lit(None).cast("boolean").alias("head")).join(edges.select(F.col("b").alias("__l")).distinct().withColumn("later", F.lit(True)), "__l", "left").select("__l", F.when(F.col("later").isNull(), True).alias("head")), "state")
    while not state.where("head IS NULL").isEmpty():
        open_ = state.where("head IS NULL").select(F.col("__l").alias("b"))
        told = edges.join(open_, "b").join(state.select(F.col("__l").alias("a"), "head"), "a").groupBy("b").agg(F.bool_or(F.coalesce("head", F.lit(False))).alias("joins"), F.bool_or(F.col("head").isNull()).alias("waits"))
        now = told.select(F.col("b").alias("__l"), F.when(F.col("joins"), False).when(~F.col("waits"), True).alias("new"))
        new = materialize(state.join(now, "__l", "left").select("__l", F.coalesce("head", "new").alias("head")), "state")
        discard(state)
        state = new
    heads = state.where("head").select(F.col("__l").alias("a"))
    best = edges.join(heads, "a").groupBy(F.col("b").alias("__l")).agg(F.max(F.struct("ratio", "a")).alias("best"))
    return state.join(best, "__l", "left").select(F.col("__l").alias("label"), F.when(F.col("head"), F.col("__l")).otherwise(F.col("best.a")).alias("head"))
