"""Schemas against a small validator, drift against recursion, and audits with a guard."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tomewright.operators import contracts

SCHEMA = {
    "$defs": {"name": {"type": "string", "minLength": 2, "pattern": "^[a-z]"}, "pair": {"type": "object", "required": ["k"], "properties": {"k": {"$ref": "#/$defs/name"}, "v": {"type": ["number", "null"], "minimum": 0, "exclusiveMaximum": 5}}, "additionalProperties": False}},
    "type": "object",
    "required": ["id", "pairs"],
    "properties": {
        "id": {"type": "integer"}, "pairs": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {"$ref": "#/$defs/pair"}}, "kind": {"enum": ["a", "b", 1, None]}, "flag": {"const": True},
        "any": {"anyOf": [{"type": "string"}, {"type": "array", "items": {"type": "integer"}}]}, "one": {"oneOf": [{"minimum": 2}, {"maximum": 4}]}, "no": {"not": {"type": "string"}}, "a b.c": {"type": "boolean"},
    },
    "additionalProperties": {"type": "string"},
    "if": {"properties": {"kind": {"const": "a"}}, "required": ["kind"]},
    "then": {"required": ["flag"]},
    "else": {"maxProperties": 5},
    "allOf": [{"minProperties": 2}],
}


def valid(schema, v, path=""):
    """Errors of a value by the meaning of the keywords."""
    out, number = [], isinstance(v, (int, float)) and not isinstance(v, bool)
    if "$ref" in schema:
        out += valid(SCHEMA["$defs"][schema["$ref"].split("/")[-1]], v, path)
    is_ = {"object": isinstance(v, dict), "array": isinstance(v, list), "string": isinstance(v, str), "number": number, "integer": number and v == int(v), "boolean": isinstance(v, bool), "null": v is None}
    same = lambda a, b: json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True)
    bad = lambda rule: out.append(f"{path}: {rule}")
    if "type" in schema and not any(is_[t] for t in ([schema["type"]] if isinstance(schema["type"], str) else schema["type"])):
        bad("type")
    if "enum" in schema and not any(same(v, x) for x in schema["enum"]):
        bad("enum")
    if "const" in schema and not same(v, schema["const"]):
        bad("const")
    if isinstance(v, dict):
        out += [f"{path}/{k}: required" for k in schema.get("required", []) if k not in v]
        for k, x in v.items():
            if k in schema.get("properties", {}):
                out += valid(schema["properties"][k], x, f"{path}/{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}/{k}: additionalProperties")
            elif isinstance(schema.get("additionalProperties"), dict):
                out += valid(schema["additionalProperties"], x, f"{path}/{k}")
        for rule, test in (("minProperties", lambda n: len(v) < n), ("maxProperties", lambda n: len(v) > n)):
            if rule in schema and test(schema[rule]):
                bad(rule)
    if isinstance(v, list):
        for i, x in enumerate(v):
            out += valid(schema.get("items", {}), x, f"{path}/{i}")
        for rule, test in (("minItems", lambda n: len(v) < n), ("maxItems", lambda n: len(v) > n), ("uniqueItems", lambda _: len({json.dumps(x, sort_keys=True) for x in v}) < len(v))):
            if rule in schema and test(schema[rule]):
                bad(rule)
    if isinstance(v, str):
        for rule, test in (("minLength", lambda n: len(v) < n), ("pattern", lambda p: not re.search(p, v))):
            if rule in schema and test(schema[rule]):
                bad(rule)
    if number:
        for rule, test in (("minimum", lambda n: v < n), ("maximum", lambda n: v > n), ("exclusiveMaximum", lambda n: v >= n)):
            if rule in schema and test(schema[rule]):
                bad(rule)
    for sub in schema.get("allOf", []):
        out += valid(sub, v, path)
    if "anyOf" in schema and all(valid(s, v, path) for s in schema["anyOf"]):
        bad("anyOf")
    if "oneOf" in schema and sum(not valid(s, v, path) for s in schema["oneOf"]) != 1:
        bad("oneOf")
    if "not" in schema and not valid(schema["not"], v, path):
        bad("not")
    if "if" in schema:
        out += valid(schema["then" if not valid(schema["if"], v, path) else "else"], v, path)
    return out


def anything(rng, depth=0):
    return rng.choice([lambda: rng.randint(-1, 6), lambda: 2.5, lambda: rng.choice(["", "a", "ab", "Xy", "zz"]), lambda: None, lambda: rng.random() < 0.5, lambda: [anything(rng, depth + 1) for _ in range(rng.randint(0, 4))] if depth < 2 else 3, lambda: {rng.choice("kvz"): anything(rng, depth + 1) for _ in range(2)} if depth < 2 else "q"])()


def test_schemas(spark):
    rng = random.Random(41)
    docs = []
    for _ in range(250):
        doc = {k: anything(rng) for k in ("id", "kind", "flag", "any", "one", "no", "a b.c", "other") if rng.random() < 0.5}
        if rng.random() < 0.8:
            doc["pairs"] = [{"k": rng.choice(["ab", "a", "B2", 3]), **({"v": rng.choice([0, 4.5, 5, None, "x"])} if rng.random() < 0.6 else {}), **({"w": 1} if rng.random() < 0.1 else {})} for _ in range(rng.randint(0, 4))]
        docs.append(doc if rng.random() < 0.95 else anything(rng))
    docs += [{"id": 1, "pairs": [{"k": "ab"}], "kind": "b"}, {"id": 2.0, "pairs": [{"k": "ab", "v": 1}, {"k": "ab"}], "kind": "a", "flag": True, "one": 1, "any": [1]}]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(900, "{broken"), (901, None)]
    got = {r["i"]: r["e"] for r in spark.createDataFrame(rows, "i int, raw string").select("i", contracts.schema_errors(F.col("raw"), SCHEMA).alias("e")).collect()}
    for i, d in enumerate(docs):
        assert got[i] == sorted(set(valid(SCHEMA, d))), d
    assert got[900] == got[901] == [": json"]
    assert got[250] == got[251] == []


def test_schema_documents():
    with pytest.raises(ValueError, match="aren't known"):
        contracts.schema_errors(F.lit("{}"), {"typ": "object"})
    with pytest.raises(ValueError, match="refers to itself"):
        contracts.schema_errors(F.lit("{}"), {"$defs": {"x": {"properties": {"y": {"$ref": "#/$defs/x"}}}}, "$ref": "#/$defs/x"})


def leaves(v, path="", place=()):
    if isinstance(v, dict) and v:
        return [x for k, w in v.items() for x in leaves(w, f"{path}/{k}", (*place, k))]
    if isinstance(v, list) and v:
        return [x for i, w in enumerate(v) for x in leaves(w, f"{path}/{i}", (*place, f"{i:010d}"))]
    return [(path, place, json.dumps(v, separators=(",", ":")))]


def test_drift(spark):
    base = {"a": 1, "rows": [{"s": f"n{i}", "x": [i, {}]} for i in range(12)], "z": {"deep": {"er": [[]]}}}
    other = json.loads(json.dumps(base))
    for i in (2, 10, 11, 3, 4, 5):
        other["rows"][i]["s"] = "changed"
    other["new"], other["z"]["deep"] = None, []
    dump = json.dumps
    expected = [("same", dump(base)), ("index", dump(base)), ("gone", "{}"), ("text", "not json"), ("spaces", '{"a": 1}')]
    obtained = [("same", dump(base)), ("index", dump(other)), ("more", "[]"), ("text", "not json!"), ("spaces", '{"a":1}')]
    got = {r["name"]: r for r in contracts.drift(*(spark.createDataFrame(x, "name string, raw string") for x in (expected, obtained)), "name", "raw").collect()}
    assert {n: r["state"] for n, r in got.items()} == {"index": "different", "gone": "missing", "more": "extra", "text": "different", "spaces": "different"}
    a, b = ({(p, q): v for p, q, v in leaves(x)} for x in (base, other))
    want = sorted(((q, p) for p, q in a.keys() | b.keys() if a.get((p, q)) != b.get((p, q))))
    assert got["index"]["n_paths"] == len(want)
    assert got["index"]["paths"] == [f"{p}: {a.get((p, q), '-')} > {b.get((p, q), '-')}" for q, p in want[:5]]
    assert got["index"]["paths"][0] == "/new: - > null" and got["index"]["paths"][1].startswith("/rows/2/s")
    assert [(got[n]["n_paths"], got[n]["paths"]) for n in ("text", "spaces", "gone")] == [(0, [])] * 3
    assert (got["spaces"]["bytes_expected"], got["spaces"]["bytes_obtained"], got["gone"]["bytes_obtained"]) == (8, 7, None)


def test_audit(spark):
    tables = {"t": spark.range(10).withColumn("x", F.when(F.col("id") % 3 == 0, F.col("id"))), "u": spark.range(0)}
    checks = [
        contracts.Check("odd", "t", "warning", F.col("id") % 2 == 1, F.col("id")),
        contracts.Check("filled", "t", "blocking", F.col("x") > 100, F.col("id"), F.col("x")),
        contracts.Check("nothing", "u", "blocking", F.lit(True), F.col("id")),
        contracts.Check("threes", "t", "info", F.col("x") >= 3, F.col("id"), F.concat(F.lit("x="), F.col("x"))),
    ]
    report, found = contracts.audit(spark, tables, checks, ["odd", "filled", "nothing"])
    assert {tuple(r) for r in report.collect()} == {("odd", "warning", 10, 5, "findings"), ("filled", "blocking", 10, 0, "ok"), ("nothing", "blocking", 0, 0, "ok"), ("threes", "info", 10, 3, "findings")}
    assert sorted(tuple(r) for r in found.where("check = 'threes'").collect()) == [("threes", "info", "3", "x=3"), ("threes", "info", "6", "x=6"), ("threes", "info", "9", "x=9")]
    assert tuple(contracts.audit_verdict(report).first()) == ("PASS", 0, 5, 3, 4)
    with pytest.raises(contracts.CheckNotRun, match="left_out"):
        contracts.audit(spark, tables, checks, ["odd", "left_out"])
    with pytest.raises(ValueError, match="one name"):
        contracts.audit(spark, tables, [checks[0], checks[0]], [])


def test_schema_expression_is_small(spark):
    """A named field is a step from the variant at hand: lambdas are nested once for each array, not once for each value."""
    schema = {"type": "integer"}
    for name in "edcba":
        schema = {"type": "object", "properties": {name: schema}, "required": [name]}
    rows = [(1, '{"a":{"b":{"c":{"d":{"e":1}}}}}'), (2, '{"a":{"b":{"c":{"d":{"e":"x"}}}}}'), (3, '{"a":{"b":{"c":{"d":{}}}}}'), (4, '{"a":{"b":null}}'), (5, "{")]
    errors = contracts.schema_errors(F.col("raw"), schema)
    got = {r["i"]: r["e"] for r in spark.createDataFrame(rows, "i int, raw string").select("i", errors.alias("e")).collect()}
    assert got == {1: [], 2: ["/a/b/c/d/e: type"], 3: ["/a/b/c/d/e: required"], 4: ["/a/b: type"], 5: [": json"]}
    assert str(errors).count("transform(") <= 4
