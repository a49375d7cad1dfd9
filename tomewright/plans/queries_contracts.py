"""Schemas, drift and an audit over whole tables, each with its SQL. JSON texts are built from the rows of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tomewright.operators import contracts, quality
from tomewright.sources.tables import load

# an order with its lines; the number of a line's note is there above 25 pieces only
ORDER_SCHEMA = {
    "$defs": {
        "line": {
            "type": "object",
            "required": ["n", "quantity"],
            "properties": {"n": {"type": "integer", "minimum": 1}, "quantity": {"type": "number", "maximum": 45}, "flag": {"enum": ["A", "N"]}, "note": {"type": "string"}},
            "if": {"properties": {"flag": {"const": "A"}}},
            "then": {"required": ["note"]},
        },
    },
    "type": "object",
    "required": ["id", "lines"],
    "properties": {"id": {"type": "integer"}, "status": {"enum": ["F", "O"]}, "urgent": {"type": "boolean"}, "lines": {"type": "array", "maxItems": 6, "items": {"$ref": "#/$defs/line"}}},
    "additionalProperties": False,
}


def schema_trees(spark, d):
    lines = load(spark, d, "lineitem").select("l_orderkey", F.struct(F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("double").alias("quantity"), F.col("l_returnflag").alias("flag"), F.when(F.col("l_quantity") > 25, F.lit("many")).alias("note"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s")).alias("line"))
    lines = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    k = F.col("o_orderkey")
    raw = F.to_json(F.struct(k.alias("id"), F.col("o_orderstatus").alias("status"), F.when(k % 5 != 0, F.when(k % 7 == 0, F.lit("yes")).otherwise((k % 2 == 0).cast("string"))).alias("urgent"), F.when(k % 11 == 0, F.lit(1)).alias("extra"), F.transform("lines", lambda x: x.dropFields("p", "s")).alias("lines")))
    raw = F.regexp_replace(raw, '"urgent":"(true|false)"', '"urgent":$1')
    orders = load(spark, d, "orders").join(lines, k == F.col("l_orderkey")).select("o_orderkey", raw.alias("raw"))
    errors = contracts.schema_errors(F.col("raw"), ORDER_SCHEMA)
    return orders.select("o_orderkey", F.array_join(errors, "|").alias("errors"))


def _states(spark, d):
    """Part records as they were published, and as they come out now: some gone, new, respelt, or with other values."""
    p = load(spark, d, "part")
    k = F.col("p_partkey")
    record = lambda name, tags, more: F.to_json(F.struct(k.alias("id"), name.alias("name"), F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("facts"), tags.alias("tags"), more.alias("more")))
    tags, none = F.split("p_type", " "), F.lit(None).cast("string")
    was = p.where(k % 13 != 0).select(F.concat(F.lit("p"), k.cast("string")).alias("name"), record(F.col("p_name"), tags, none).alias("raw"))
    changed = F.when(k % 10 == 3, F.array_append(tags, F.lit("new"))).when(k % 10 == 4, F.transform(tags, F.upper)).otherwise(tags)
    now = record(F.when(k % 10 == 5, F.upper("p_name")).otherwise(F.col("p_name")), changed, F.when(k % 10 == 6, F.lit("x")))
    now = F.when(k % 10 == 7, F.concat(now, F.lit(" "))).otherwise(now)
    return was, p.where(k % 17 != 0).select(F.concat(F.lit("p"), k.cast("string")).alias("name"), now.alias("raw"))


def published_drift(spark, d):
    was, now = _states(spark, d)
    found = contracts.drift(was, now, "name", "raw")
    return found.select("name", "state", (F.col("bytes_obtained") - F.col("bytes_expected")).alias("grown"), "n_paths", F.array_join("paths", "|").alias("paths"))


# name, table, severity, test, id: what a row must not be. Plain predicates, which both engines read alike.
AUDIT = [
    ("order_without_customer", "orders", "blocking", "o_custkey IS NULL", "o_orderkey"), ("order_status", "orders", "blocking", "o_orderstatus NOT IN ('F', 'O', 'P')", "o_orderkey"),
    ("order_open_status", "orders", "info", "o_orderstatus = 'P'", "o_orderkey"), ("order_price", "orders", "blocking", "o_totalprice <= 0", "o_orderkey"),
    ("order_cheap", "orders", "warning", "o_totalprice < 2000", "o_orderkey"), ("order_priority", "orders", "warning", "o_orderpriority NOT LIKE '%-%'", "o_orderkey"),
    ("line_number", "lineitem", "blocking", "l_linenumber < 1", "l_orderkey"), ("line_many", "lineitem", "info", "l_linenumber > 6", "l_orderkey"), ("line_quantity", "lineitem", "blocking", "l_quantity <= 0", "l_orderkey"),
    ("line_large", "lineitem", "warning", "l_quantity > 49", "l_orderkey"), ("line_discount", "lineitem", "blocking", "l_discount < 0 OR l_discount > 1", "l_orderkey"), ("line_flag", "lineitem", "warning", "l_returnflag = 'R'", "l_orderkey"),
    ("part_name", "part", "blocking", "p_name IS NULL OR p_name = ''", "p_partkey"), ("part_size", "part", "blocking", "p_size < 1", "p_partkey"), ("part_huge", "part", "info", "p_size = 50", "p_partkey"),
    ("part_price", "part", "warning", "p_retailprice < 950", "p_partkey"), ("supplier_nation", "supplier", "blocking", "s_nationkey NOT BETWEEN 0 AND 24", "s_suppkey"), ("supplier_debt", "supplier", "info", "s_acctbal < 0", "s_suppkey"),
    ("customer_nation", "customer", "blocking", "c_nationkey NOT BETWEEN 0 AND 24", "c_custkey"), ("customer_debt", "customer", "info", "c_acctbal < 0", "c_custkey"),
    ("customer_segment", "customer", "warning", "c_mktsegment = 'MACHINERY'", "c_custkey"), ("nation_name", "nation", "blocking", "n_name = ''", "n_nationkey"),
]


def audit_report(spark, d):
    """22 named checks over six tables: what each looked at and found, also where it found nothing."""
    tables = {t: load(spark, d, t) for t in dict.fromkeys(c[1] for c in AUDIT)}
    checks = [contracts.Check(name, table, severity, F.expr(test), F.col(key)) for name, table, severity, test, key in AUDIT]
    report, found = contracts.audit(spark, tables, checks, [c[0] for c in AUDIT])
    last = found.groupBy("check").agg(F.max(F.col("id").cast("long")).alias("last"))
    return report.join(last, "check", "left")


# code, what a record must not be, and whether nothing after it can be judged: an unreadable record has no other error, one
# without its source none that compare it with that
RULES = [
    ("unreadable", "p_partkey % 41 = 0", True), ("encoding", "p_partkey % 43 = 0", True), ("schema", "p_size > 48", False), ("vocabulary", "p_type = 'PROMO'", False), ("file_name", "p_partkey % 7 = 0", False), ("not_indexed", "p_name LIKE 'old%'", False),
    ("no_source", "p_brand = 'Brand#13'", True), ("source_text", "p_size = 1", True), ("evidence_absent", "p_name LIKE '%ring'", False), ("evidence_for_null", "p_size % 10 = 3", False), ("evidence_missing", "p_size % 10 = 4", False), ("drift", "p_retailprice < 1000", False),
]


def staged_verdicts(spark, d):
    """Twelve codes in order; evaluation of a record ends with the first that leaves nothing to judge."""
    return quality.staged_verdict(load(spark, d, "part"), "p_partkey", [(code, F.expr(test), stops) for code, test, stops in RULES])


QUERIES = {"staged_verdicts": staged_verdicts, "schema_trees": schema_trees, "published_drift": published_drift, "audit_report": audit_report}

_LAST = "CASE " + " ".join(f"WHEN {test} THEN {i}" for i, (_, test, stops) in enumerate(RULES) if stops) + f" ELSE {len(RULES)} END"
ORACLES = {
    "staged_verdicts": f"WITH r AS (SELECT p_partkey, {_LAST} AS last, p_name, p_size, p_type, p_brand, p_retailprice FROM part), e AS (SELECT p_partkey, concat_ws('|', "
    + ", ".join(f"CASE WHEN {test} AND last >= {i} THEN '{code}' END" for i, (code, test, _) in enumerate(RULES))
    + ") AS errors FROM r) SELECT p_partkey, errors, errors = '' AS ok FROM e",
    "schema_trees": """WITH l AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_returnflag, l_partkey, l_suppkey) - 1 AS i, l_linenumber AS n, l_quantity AS q, l_returnflag AS f FROM lineitem),
e AS (SELECT o_orderkey AS k, '/status: enum' AS e FROM orders WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL SELECT o_orderkey, '/urgent: type' FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 = 0
UNION ALL SELECT o_orderkey, '/extra: additionalProperties' FROM orders WHERE o_orderkey % 11 = 0 UNION ALL SELECT k, '/lines: maxItems' FROM l GROUP BY k HAVING count(*) > 6
UNION ALL SELECT k, '/lines/' || i::VARCHAR || '/quantity: maximum' FROM l WHERE q > 45 UNION ALL SELECT k, '/lines/' || i::VARCHAR || '/flag: enum' FROM l WHERE f NOT IN ('A', 'N')
UNION ALL SELECT k, '/lines/' || i::VARCHAR || '/note: required' FROM l WHERE f = 'A' AND q <= 25 UNION ALL SELECT k, '/lines/' || i::VARCHAR || '/n: minimum' FROM l WHERE n < 1)
SELECT o_orderkey, coalesce((SELECT string_agg(e, '|' ORDER BY e) FROM e WHERE e.k = o_orderkey), '') AS errors FROM orders WHERE o_orderkey IN (SELECT k FROM l)""",
    "published_drift": """WITH p AS (SELECT *, p_partkey AS k, string_split(p_type, ' ') AS t FROM part), d AS (SELECT *, k % 13 <> 0 AS old, k % 17 <> 0 AS new FROM p),
x AS (SELECT *, CASE k % 10 WHEN 3 THEN ['/tags/' || len(t)::VARCHAR || ': - > "new"'] WHEN 4 THEN [CASE WHEN upper(t[i]) <> t[i] THEN '/tags/' || (i - 1)::VARCHAR || ': "' || t[i] || '" > "' || upper(t[i]) || '"' END FOR i IN range(1, len(t) + 1)]
  WHEN 5 THEN [CASE WHEN upper(p_name) <> p_name THEN '/name: "' || p_name || '" > "' || upper(p_name) || '"' END] WHEN 6 THEN ['/more: - > "x"'] ELSE [] END AS paths FROM d WHERE old OR new),
y AS (SELECT *, list_filter(paths, lambda s: s IS NOT NULL) AS kept FROM x)
SELECT 'p' || k::VARCHAR AS name, CASE WHEN NOT new THEN 'missing' WHEN NOT old THEN 'extra' ELSE 'different' END AS state, CASE WHEN old AND new THEN (CASE k % 10 WHEN 3 THEN 6 WHEN 6 THEN 11 WHEN 7 THEN 1 WHEN 5 THEN strlen(upper(p_name)) - strlen(p_name) ELSE 0 END) END::BIGINT AS grown,
  CASE WHEN old AND new THEN len(kept) ELSE 0 END::BIGINT AS n_paths, CASE WHEN old AND new THEN array_to_string(kept[1:5], '|') ELSE '' END AS paths FROM y WHERE NOT (old AND new) OR len(kept) > 0 OR k % 10 = 7""",
    "audit_report": " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", '{severity}' AS severity, count(*) AS seen, count(*) FILTER ({test}) AS findings, CASE WHEN count(*) FILTER ({test}) > 0 THEN 'findings' ELSE 'ok' END AS state, max({key}) FILTER ({test})::BIGINT AS last FROM {table}"""
        for name, table, severity, test, key in AUDIT
    ),
}
