"""Queries over labels, vocabularies, wire records, lists and incremental runs, and the streaming extension in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tomewright.functions import text
from tomewright.operators import index, ordering, quality, reconcile
from tomewright.sources import sinks
from tomewright.sources.tables import ENTRIES_SQL, SPELLS_SQL, entries, load, spells
from tomewright.streaming import windows


def label_groups(spark, d):
    """Labels by folded key: occurrences, the most frequent raw form, up to five ids. The five smallest ids are kept
    by rank, so no group is gathered."""
    words = load(spark, d, "part").select("p_partkey", F.explode(F.split("p_type", " ")).alias("raw"))
    words = words.withColumn("raw", F.when(F.col("p_partkey") % 3 == 0, F.initcap("raw")).otherwise(F.col("raw"))).withColumn("key", text.slug(F.col("raw"), "_"))
    forms = words.groupBy("key", "raw").agg(F.count("*").alias("n"))
    best = forms.groupBy("key").agg(F.sum("n").alias("n"), F.min_by("raw", F.struct(-F.col("n"), F.col("raw"))).alias("form"))
    few = ordering.top_per_group(words.select("key", "p_partkey").distinct(), "key", [F.col("p_partkey")], 5)
    return best.join(few.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p_partkey")), lambda x: x.cast("string")), "|").alias("ids")), "key")


GROUPS = {"plain": "(?i)standard|medium", "size": "(?i)small|large|medium", "cheap": "(?i)econ|promo", "none": "zzz"}


def concept_coverage(spark, d):
    """Rows per pattern group, groups of at least ten: all patterns in one scan and one aggregation."""
    p = load(spark, d, "part")
    hit = F.array_compact(F.array(*[F.when(F.col("p_type").rlike(rx), F.lit(n)) for n, rx in GROUPS.items()]))
    return p.select(F.explode(hit).alias("concept")).groupBy("concept").agg(F.count("*").alias("n")).where("n >= 10")


def multi_source_search(spark, d):
    """Hits by source, at most three of each, sources in a fixed order."""
    out = None
    for k, (table, column) in enumerate((("nation", "n_name"), ("supplier", "s_name"), ("customer", "c_name"))):
        named = load(spark, d, table).select(F.lit(k).alias("source"), F.col(column).alias("name"))
        hits = ordering.ranked(named.where(F.contains("name", F.lit("1"))) if k else named, [F.col("name")], 3)
        out = hits if out is None else out.unionByName(hits)
    return out


def vocabulary_repair(spark, d):
    """Values that match a closed list but for case and spaces get its form, others null."""
    p = load(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" "), F.upper("p_brand"))).otherwise(F.concat("p_brand", F.lit("x"))).alias("raw"))
    known = load(spark, d, "part").select(F.col("p_brand").alias("value")).distinct()
    known = known.withColumn("k", F.lower(F.trim("value"))).groupBy("k").agg(F.min("value").alias("value"), F.count("*").alias("c")).where("c = 1")
    return p.join(known, F.lower(F.trim("raw")) == F.col("k"), "left").select("p_partkey", "value")


def source_text(spark, d):
    """Canonical text of a record: filled fields in a frozen order as ``field: value``, and its hash."""
    p = spells(spark, d)
    fields = F.array(*[F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in ("name", "school", "level")])
    return p.select("id", F.array_join(F.array_compact(fields), "\n").alias("t")).select("id", F.char_length("t").alias("n"), quality.text_hash(F.col("t")).alias("digest"))


def wire_codes(spark, d):
    """Records with dictionary codes and what these decode to; a code outside the dictionary decodes to nothing."""
    p = load(spark, d, "part").select("p_partkey", "p_type")
    codes = index.dense_codes(p, "p_type")
    wire = p.join(codes, p.p_type == codes.value).select("p_partkey", F.when(F.col("p_partkey") % 10 != 9, F.col("code")).otherwise(F.col("code") + 100).alias("code"))
    return wire.join(codes, "code", "left").select("p_partkey", "code", F.col("value").alias("decoded"))


def cost_estimate(spark, d):
    n = F.sum(F.char_length("text"))
    return load(spark, d, "documents").groupBy("lang").agg(F.ceil(n / F.lit(3.6)).cast("long").alias("tokens"))


def state_rows(spark, d):
    """Children of a parent in order of position, each once at its first position."""
    lines = load(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.min("l_linenumber").alias("pos"))
    return lines.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "l_suppkey"))), lambda x: x["l_suppkey"].cast("string")), "|").alias("state"))


def incremental_todo(spark, d):
    digest = F.md5(F.col("p_name"))
    now = load(spark, d, "part").select("p_partkey", digest.alias("h"), F.lit(2).alias("v"))
    then = now.where("p_partkey % 3 <> 0").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.lit("old")).otherwise(F.col("h")).alias("h"), "v")
    return sinks.stale(then, now, "p_partkey", ["h", "v"]).select("p_partkey")


def disagreements(spark, d):
    """Entities with the classes that don't agree with the page level, sorted."""
    levels = index.class_levels(entries(spark, d))
    page = load(spark, d, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 7 != 0, F.col("p_size") % 10).alias("level"))
    bad = reconcile.agreement(levels, page, ["id"], "level").where("agree = false")
    return bad.groupBy("id").agg(F.count("*").alias("n"), F.min("class_id").alias("first_class"), F.max(F.abs(F.col("level") - F.col("other_level"))).alias("widest"))


def grouping_sets(spark, d):
    """All axes in one pass (extension)."""
    load(spark, d, "part").createOrReplaceTempView("tw_part")
    return spark.sql("SELECT p_brand AS brand, p_size % 10 AS level, count(*) AS n FROM tw_part GROUP BY GROUPING SETS ((p_brand), (p_size % 10), ())")


def event_windows(spark, d):
    made = windows.windowed_counts(load(spark, d, "events"), "ts", "event_type", "value", size="1 hour")
    return made.select(F.unix_seconds("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def event_sessions(spark, d):
    made = windows.sessions(load(spark, d, "events"), "ts", "user_id", gap="30 minutes")
    return made.groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.max("n").alias("longest"))


QUERIES = {
    "label_groups": label_groups,
    "concept_coverage": concept_coverage,
    "multi_source_search": multi_source_search,
    "vocabulary_repair": vocabulary_repair,
    "source_text": source_text,
    "wire_codes": wire_codes,
    "cost_estimate": cost_estimate,
    "state_rows": state_rows,
    "incremental_todo": incremental_todo,
    "disagreements": disagreements,
    "ext_grouping_sets": grouping_sets,
    "ext_event_windows": event_windows,
    "ext_event_sessions": event_sessions,
}

ORACLES = {
    "label_groups": """WITH w AS (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS r FROM part), x AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN upper(left(r, 1)) || lower(r[2:]) ELSE r END AS raw, lower(r) AS key FROM w),
f AS (SELECT key, raw, count(*) AS n FROM x GROUP BY ALL), b AS (SELECT key, sum(n) OVER (PARTITION BY key)::BIGINT AS n, raw AS form FROM f QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, raw) = 1),
i AS (SELECT DISTINCT key, p_partkey FROM x), t AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY key ORDER BY p_partkey) <= 5)
SELECT b.key, n, form, ids FROM b JOIN (SELECT key, string_agg(p_partkey::VARCHAR, '|' ORDER BY p_partkey) AS ids FROM t GROUP BY key) AS s ON s.key = b.key""",
    "concept_coverage": " UNION ALL ".join(f"SELECT '{n}' AS concept, count(*) AS n FROM part WHERE regexp_matches(p_type, '{rx}') HAVING count(*) >= 10" for n, rx in GROUPS.items()),
    "multi_source_search": """SELECT 0 AS source, n_name AS name, row_number() OVER (ORDER BY n_name)::INT AS place FROM nation QUALIFY place <= 3
UNION ALL SELECT 1, s_name, row_number() OVER (ORDER BY s_name)::INT AS place FROM supplier WHERE contains(s_name, '1') QUALIFY place <= 3
UNION ALL SELECT 2, c_name, row_number() OVER (ORDER BY c_name)::INT AS place FROM customer WHERE contains(c_name, '1') QUALIFY place <= 3""",
    "vocabulary_repair": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS value FROM part",
    "source_text": f"""WITH {SPELLS_SQL}, t AS (SELECT id, concat_ws(chr(10), 'name: ' || nullif(name, ''), 'school: ' || nullif(school, ''), 'level: ' || level::VARCHAR) AS t FROM spells) SELECT id, length(t)::INT AS n, sha256(t) AS digest FROM t""",
    "wire_codes": "WITH c AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM part)) SELECT p_partkey, code + CASE WHEN p_partkey % 10 = 9 THEN 100 ELSE 0 END AS code, CASE WHEN p_partkey % 10 <> 9 THEN p_type END AS decoded FROM part JOIN c USING (p_type)",
    "cost_estimate": "SELECT lang, ceil(sum(length(text)) / 3.6::DOUBLE)::BIGINT AS tokens FROM documents GROUP BY lang",
    "state_rows": "WITH c AS (SELECT l_orderkey, l_suppkey, min(l_linenumber) AS pos FROM lineitem GROUP BY ALL) SELECT l_orderkey, string_agg(l_suppkey::VARCHAR, '|' ORDER BY pos, l_suppkey) AS state FROM c GROUP BY 1",
    "incremental_todo": "SELECT p_partkey FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 5 = 0",
    "disagreements": f"""WITH {ENTRIES_SQL}, cl AS (SELECT id, class_id, min(level) AS level FROM entries GROUP BY id, class_id), p AS (SELECT p_partkey AS id, CASE WHEN p_size % 7 <> 0 THEN p_size % 10 END AS o FROM part)
SELECT id, count(*) AS n, min(class_id) AS first_class, max(abs(level - o)) AS widest FROM cl JOIN p USING (id) WHERE level <> o GROUP BY id""",
    "ext_grouping_sets": "SELECT p_brand AS brand, p_size % 10 AS level, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_size % 10), ())",
    "ext_event_windows": "SELECT epoch(date_trunc('hour', ts))::BIGINT AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "ext_event_sessions": """WITH g AS (SELECT user_id, ts, ts >= lag(ts) OVER w + INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, sum(new::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g), c AS (SELECT user_id, s, count(*) AS n FROM s GROUP BY ALL) SELECT user_id, count(*) AS n_sessions, max(n) AS longest FROM c GROUP BY user_id""",
}
