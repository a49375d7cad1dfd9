"""Contracts of JSON tables: schemas compiled to expressions, drift between two states by path, and audits that say what they ran."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tomewright.functions.text import let
from tomewright.sources.shared import discard, materialize

# The keywords of schema documents that are understood, and those that say nothing about a value.
RULES = {
    "type", "enum", "const", "properties", "required", "additionalProperties", "items", "minItems", "maxItems", "uniqueItems", "minLength", "maxLength", "pattern", "minimum", "maximum",
    "exclusiveMinimum", "exclusiveMaximum", "minProperties", "maxProperties", "allOf", "anyOf", "oneOf", "not", "if", "then", "else", "$ref",
}
NOTES = {"$schema", "$id", "$defs", "definitions", "title", "description", "default", "examples", "$comment"}
NUMBERS = ["BIGINT", "DOUBLE", "FLOAT", "DECIMAL"]


def _nothing() -> Column:
    return F.array().cast("array<string>")


def _json(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


@dataclass(frozen=True)
class _Place:
    """A value inside a variant: the variant that is at hand and its type, the steps from it to the value, and what to call the place. A
    deeper value is one more step from the same variant, not an expression inside an expression; only elements of arrays and
    fields that a schema doesn't name need a lambda."""

    base: Column
    described: Column
    path: Column
    steps: str = "$"
    below: str = ""

    def field(self, name: str) -> _Place:
        return replace(self, steps=f'{self.steps}["{name}"]', below=f"{self.below}/{name}")

    def get(self, kind: str = "variant") -> Column:
        return self.base if (kind, self.steps) == ("variant", "$") else F.try_variant_get(self.base, self.steps, kind)

    def type(self) -> Column:
        return self.described if self.steps == "$" else F.schema_of_variant(self.get())

    def named(self, end: str) -> Column:
        return F.concat(self.path, F.lit(self.below + end))


@dataclass(frozen=True)
class _Found:
    """What is broken where ``test`` is true: a text, an array of texts (null ones are none), or what is found inside. ``other``
    holds where it isn't true."""

    test: Column
    text: Column | None = None
    texts: Column | None = None
    inside: tuple[_Found, ...] = ()
    other: tuple[_Found, ...] = ()

    def true(self) -> Column:
        return F.coalesce(self.test, F.lit(False))


def _texts(found: Iterable[_Found]) -> Column:
    """All texts in one array, with nulls for what isn't broken."""
    found = list(found)
    plain = [F.when(x.test, x.text) for x in found if x.text is not None]
    arrays = [F.when(x.test, _texts(x.inside) if x.texts is None else x.texts).otherwise(_texts(x.other) if x.other else _nothing()) for x in found if x.text is None]
    arrays = [F.array(*plain)] * bool(plain) + arrays
    return arrays[0] if len(arrays) == 1 else F.flatten(F.array(*arrays)) if arrays else _nothing()


def _fine(found: Iterable[_Found]) -> Column:
    """Whether nothing is broken, without the texts."""
    tests = []
    for x in found:
        if x.text is not None:
            tests.append(~x.true())
        elif x.texts is not None:
            tests.append(~x.true() | (F.size(F.array_compact(x.texts)) == 0))
        else:
            tests.append(F.when(x.true(), _fine(x.inside)).otherwise(_fine(x.other)))
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


class _Compiler:
    """Turns a schema document into an expression over a variant; every part of the document is written out once for each place
    that it applies to, so a schema that refers to itself is refused."""

    def __init__(self, document: dict):
        self.document = document

    def resolve(self, ref: str) -> dict:
        if not ref.startswith("#"):
            raise ValueError(f"a reference out of the document: {ref}")
        steps = [s.replace("~1", "/").replace("~0", "~") for s in ref[1:].split("/")[1:]]
        return reduce(lambda at, s: at[int(s)] if isinstance(at, list) else at[s], steps, self.document)

    def errors(self, schema: dict | bool, values: Column, inside: tuple[str, ...] = ()) -> Column:
        """For each of an array of ``_value`` an array of ``path: rule`` for what it breaks."""
        return F.transform(values, lambda x: F.when(x["v"].isNotNull(), _texts(self.found(schema, _Place(x["v"], x["type"], x["path"]), inside))))

    def found(self, schema: dict | bool, at: _Place, inside: tuple[str, ...]) -> list[_Found]:
        """What a value (not a missing one) breaks."""
        if isinstance(schema, bool):
            return [] if schema else [_Found(F.lit(True), at.named(": false"))]
        unknown = set(schema) - RULES - NOTES
        if unknown:
            raise ValueError(f"keywords of a schema that aren't known: {sorted(unknown)}")
        found: list[_Found] = []
        of_object: list[_Found] = []
        v, kind = at.get(), F.regexp_extract(at.type(), r"^(\w+)", 1)
        text, number = at.get("string"), at.get("double")
        elements, fields = at.get("array<variant>"), at.get("map<string,variant>")
        is_object, is_array, is_text, is_number = F.startswith(at.type(), F.lit("OBJECT")), F.startswith(at.type(), F.lit("ARRAY")), kind == "STRING", kind.isin(*NUMBERS)
        kinds = {"object": is_object, "array": is_array, "string": is_text, "number": is_number, "integer": (kind == "BIGINT") | (is_number & (number == F.floor(number))), "boolean": kind == "BOOLEAN", "null": kind == "VOID"}

        def broken(rule: str, test: Column) -> None:
            found.append(_Found(test, at.named(f": {rule}")))

        def fine(sub: dict | bool) -> Column:
            return _fine(self.found(sub, at, inside))

        for rule, limit in schema.items():
            if rule == "type":
                allowed = [limit] if isinstance(limit, str) else limit
                broken("type", ~reduce(lambda a, b: a | b, (kinds[k] for k in allowed)))
            elif rule in ("enum", "const"):
                broken(rule, ~F.to_json(v).isin(*[_json(x) for x in (limit if rule == "enum" else [limit])]))
            elif rule == "required":
                of_object += [_Found(at.field(name).get().isNull(), at.named(f"/{name}: required")) for name in limit]
            elif rule == "properties":
                for name, sub in limit.items():
                    child = at.field(name)
                    of_object.append(_Found(child.get().isNotNull(), inside=tuple(self.found(sub, child, inside))))
            elif rule == "additionalProperties":
                known = F.array(*[F.lit(k) for k in schema.get("properties", {})]).cast("array<string>")
                others = F.filter(F.map_entries(fields), lambda e: ~F.array_contains(known, e["key"]))
                if limit is False:
                    of_object.append(_Found(F.lit(True), texts=F.transform(others, lambda e: F.concat(at.named("/"), e["key"], F.lit(": additionalProperties")))))
                elif limit is not True:
                    of_object.append(_Found(F.lit(True), texts=F.flatten(self.errors(limit, F.transform(others, lambda e: _value(e["value"], F.concat(at.named("/"), e["key"]))), inside))))
            elif rule == "items":
                found.append(_Found(is_array, texts=F.flatten(self.errors(limit, F.transform(elements, lambda x, i: _value(x, F.concat(at.named("/"), i.cast("string")))), inside))))
            elif rule == "uniqueItems":
                if limit:
                    broken(rule, is_array & (F.size(F.array_distinct(F.transform(elements, lambda x: F.to_json(x)))) < F.size(elements)))
            elif rule == "pattern":
                broken(rule, is_text & ~text.rlike(limit))
            elif rule in ("minItems", "maxItems", "minLength", "maxLength", "minProperties", "maxProperties"):
                own, size = (is_array, F.size(elements)) if "Items" in rule else (is_text, F.char_length(text)) if "Length" in rule else (is_object, F.size(fields))
                broken(rule, own & (size < limit if rule.startswith("min") else size > limit))
            elif rule in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
                tests = {"minimum": number < limit, "maximum": number > limit, "exclusiveMinimum": number <= limit, "exclusiveMaximum": number >= limit}
                broken(rule, tests[rule] & is_number)
            elif rule == "allOf":
                for sub in limit:
                    found += self.found(sub, at, inside)
            elif rule == "anyOf":
                broken(rule, ~reduce(lambda a, b: a | b, map(fine, limit)))
            elif rule == "oneOf":
                broken(rule, reduce(lambda a, b: a + b, (fine(sub).cast("int") for sub in limit)) != 1)
            elif rule == "not":
                broken(rule, fine(limit))
            elif rule == "if":
                then, other = schema.get("then", True), schema.get("else", True)
                found.append(_Found(fine(limit), inside=tuple(self.found(then, at, inside)), other=tuple(self.found(other, at, inside))))
            elif rule == "$ref":
                if limit in inside:
                    raise ValueError(f"a schema that refers to itself: {limit}")
                found += self.found(self.resolve(limit), at, (*inside, limit))
        if of_object:
            found.append(_Found(is_object, inside=tuple(of_object)))
        return found


def _value(v: Column, path: Column) -> Column:
    return F.struct(v.alias("v"), F.schema_of_variant(v).alias("type"), path.alias("path"))


def schema_errors(raw: Column, schema: dict) -> Column:
    """Sorted ``path: rule`` of what a JSON text breaks of a schema document, paths with the places of array elements; ``: json``
    where it can't be read. Properties, items, closed lists, bounds, patterns, combinations, conditions, references inside
    the document; a keyword that isn't known and a schema that refers to itself are errors of the schema."""
    found = _Compiler(schema).errors(schema, F.transform(F.array(F.try_parse_json(raw)), lambda v: _value(v, F.lit(""))))
    return let(F.element_at(found, 1), lambda x: F.when(x.isNull(), F.array(F.lit(": json"))).otherwise(F.array_sort(F.array_distinct(F.array_compact(x)))))


# drift


def flattened(files: DataFrame, name: str, raw: str) -> DataFrame:
    """name, path, place, value: every leaf of JSON texts (empty objects and arrays are leaves). place orders paths as they
    are read: array elements by number. One round for each level of nesting; texts that can't be read are left out."""
    kind = F.regexp_extract(F.schema_of_variant("v"), r"^(\w+)", 1)
    level = files.select(name, F.lit("").alias("path"), F.lit("").alias("place"), F.try_parse_json(raw).alias("v")).where("v IS NOT NULL")
    leaves = []
    while True:
        level = materialize(level.select(name, "path", "place", F.to_json("v").alias("j"), kind.alias("kind")), "level")
        inner = level.where("kind IN ('OBJECT', 'ARRAY') AND j NOT IN ('{}', '[]')").withColumn("v", F.parse_json("j"))
        leaves.append(level.where("NOT (kind IN ('OBJECT', 'ARRAY') AND j NOT IN ('{}', '[]'))").select(name, "path", "place", F.col("j").alias("value")))
        if inner.isEmpty():
            return reduce(DataFrame.unionByName, leaves)
        of_object = inner.where("kind = 'OBJECT'").select(name, "path", "place", F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("k", "v")).select(name, F.concat("path", F.lit("/"), "k").alias("path"), F.concat("place", F.lit("/"), "k").alias("place"), "v")
        of_array = inner.where("kind = 'ARRAY'").select(name, "path", "place", F.posexplode(F.try_variant_get("v", "$", "array<variant>")).alias("k", "v")).select(name, F.concat_ws("/", "path", F.col("k").cast("string")).alias("path"), F.concat_ws("/", "place", F.lpad(F.col("k").cast("string"), 10, "0")).alias("place"), "v")
        level = of_object.unionByName(of_array)


def drift(expected: DataFrame, obtained: DataFrame, name: str, raw: str, most: int = 5) -> DataFrame:
    """name, state (missing, extra or different), bytes_expected, bytes_obtained, n_paths, paths: files of two states that aren't
    equal byte by byte. Of different JSON files the paths that differ are counted and the first ones named, each with
    both values; a file that isn't JSON on both sides has none. Only files that differ are read into paths."""
    side = lambda df, c: df.select(name, F.col(raw).alias(c))
    both = side(expected, "was").join(side(obtained, "now"), name, "full_outer").where("NOT (was <=> now)")
    both = materialize(both, "both")
    state = F.when(F.col("now").isNull(), "missing").when(F.col("was").isNull(), "extra").otherwise("different")
    pairs = both.where("was IS NOT NULL AND now IS NOT NULL")
    readable = pairs.where(F.try_parse_json("was").isNotNull() & F.try_parse_json("now").isNotNull())
    a, b = (flattened(readable, name, c) for c in ("was", "now"))
    a, b = a.withColumnRenamed("value", "a"), b.withColumnRenamed("value", "b")
    differing = a.join(b, [name, "path", "place"], "full_outer").where("NOT (a <=> b)")
    told = F.concat(F.col("path"), F.lit(": "), F.coalesce("a", F.lit("-")), F.lit(" > "), F.coalesce("b", F.lit("-")))
    # the first paths by rank, so that a file with very many differences isn't gathered
    rank = F.row_number().over(Window.partitionBy(name).orderBy("place"))
    counts = differing.groupBy(name).agg(F.count("*").alias("n_paths"))
    first = differing.withColumn("rank", rank).where(F.col("rank") <= most).groupBy(name).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", told.alias("t")))), lambda x: x["t"]).alias("paths"))
    out = both.select(name, state.alias("state"), F.octet_length("was").cast("long").alias("bytes_expected"), F.octet_length("now").cast("long").alias("bytes_obtained"))
    out = out.join(counts, name, "left").join(first, name, "left").withColumns({"n_paths": F.coalesce("n_paths", F.lit(0)), "paths": F.coalesce("paths", _nothing())})
    return out


# audits


@dataclass(frozen=True)
class Check:
    """A named check: rows of a table on which ``test`` is true are findings, with an id and a detail."""

    name: str
    table: str
    severity: str  # blocking, warning or info
    test: Column
    id: Column
    detail: Column | None = None


class CheckNotRun(RuntimeError):
    """A check that was asked for has no result."""


def audit(spark: SparkSession, tables: dict[str, DataFrame], checks: list[Check], required: list[str]) -> tuple[DataFrame, DataFrame]:
    """A report (check, severity, seen, findings, state) with a row for each check, also one without findings, and the findings
    (check, severity, id, detail).

    All checks of a table run in one scan; how many rows each looked at and found is observed as it runs. A required check
    without a result fails the run, and so does a repeated name."""
    names = [c.name for c in checks]
    if len(set(names)) != len(names):
        raise ValueError("two checks of one name")
    report, found = [], []
    for table in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == table]
        seen = Observation()
        hit = lambda c: F.coalesce(c.test, F.lit(False))
        rows = tables[table].observe(seen, F.count(F.lit(1)).alias("seen"), *[F.count_if(hit(c)).alias(f"c{i}") for i, c in enumerate(own)])
        each = [F.when(hit(c), F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), c.id.cast("string").alias("id"), (c.detail if c.detail is not None else F.lit("")).cast("string").alias("detail"))) for c in own]
        found.append(materialize(rows.select(F.explode(F.array_compact(F.array(*each))).alias("f")).select("f.*"), "findings"))
        got = seen.get
        report += [(c.name, c.severity, got["seen"], got[f"c{i}"], "findings" if got[f"c{i}"] else "ok") for i, c in enumerate(own)]
    missing = [n for n in required if n not in {r[0] for r in report}]
    if missing:
        discard(*found)
        raise CheckNotRun(f"checks that did not run: {missing}")
    made = spark.createDataFrame(report, "check string, severity string, seen long, findings long, state string")
    return made, reduce(DataFrame.unionByName, found)


def audit_verdict(report: DataFrame) -> DataFrame:
    """verdict (FAIL where a blocking check found something, else PASS) and what each severity found."""
    of = lambda s: F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("findings"))), F.lit(0)).alias(s)
    return report.agg(F.when(F.max(F.when((F.col("severity") == "blocking") & (F.col("findings") > 0), 1)) == 1, "FAIL").otherwise("PASS").alias("verdict"), *map(of, ("blocking", "warning", "info")), F.count("*").alias("checks"))
