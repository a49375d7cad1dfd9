"""What characters can acquire: waves, exact costs and the graph of each character, over whole tables.

Entries are parts named ``don <key>``, whose conditions also ask for other parts; characters are the distinct forms of customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tomewright.operators import acquisition, eligibility
from tomewright.plans.queries_rules import CHARACTERS_SQL, FEATS_SQL, PAIRS_SQL, VOCABULARY, characters, conditions
from tomewright.sources.shared import discard, materialize
from tomewright.sources.tables import load

SLOTS = 3


def _inputs(spark, d):
    """The parsed catalogue, and characters with a key and what they know."""
    k = F.col("p_partkey")
    don = lambda n: F.concat(F.lit("don "), n.cast("long").cast("string"))
    half, third, fifth = don(F.floor(k / 2)), don(F.floor(k / 3)), don(F.floor(k / 5))
    asks = [F.when((k >= 12) & (k % 3 == 1), half).when((k >= 12) & (k % 3 == 2), F.concat(half, F.lit(" ou "), third)), F.when((k >= 12) & (k % 7 == 3), F.concat(fifth, F.lit(" ou mystère")))]
    parts = F.array_compact(F.array(F.nullif(conditions(k, F.col("p_size")), F.lit("")), *asks))
    rows = load(spark, d, "part").select("p_partkey", don(k).alias("name"), F.array_join(parts, ", ").alias("conditions"))
    parsed = materialize(eligibility.catalogue(rows, "name", "conditions", rows.select("name"), VOCABULARY), "parsed")
    n = F.col("c_nationkey")
    who = characters(spark, d).withColumn("owner", F.concat_ws("/", "class", n.cast("string"))).withColumn("known", F.when(n % 6 != 0, F.array(don(n), don(2 * n + 1))))
    return parsed, materialize(who, "who")


def character_waves(spark, d):
    """Every part that a customer's form can come to hold in three rounds."""
    parsed, who = _inputs(spark, d)
    out = acquisition.waves(parsed, who, "name", "owner", SLOTS)
    return out.select("owner", "name", "wave", "status", "reasons")


def _costs(spark, d):
    parsed, who = _inputs(spark, d)
    waves = acquisition.waves(parsed, who, "name", "owner", SLOTS)
    held = who.select("owner", F.explode("known").alias("node"))
    asked = materialize(eligibility.requirements(parsed, "name"), "requirements")
    return parsed, who, waves, asked, acquisition.costs(asked, waves.select("owner", F.col("name").alias("node")), acquired=held, owner="owner")


def character_costs(spark, d):
    """How many entries each of them takes, those on the way included."""
    parsed, who, waves, asked, costs = _costs(spark, d)
    discard(parsed, who, waves, asked)
    return costs.select("owner", F.col("node").alias("name"), "cost", F.array_join("takes", "|").alias("takes"))


def character_graphs(spark, d):
    """The graph of each form as one JSON document."""
    parsed, who, waves, asked, costs = _costs(spark, d)
    facts = load(spark, d, "part").select(F.concat(F.lit("don "), F.col("p_partkey").cast("string")).alias("node"), F.col("p_name").alias("label"), F.col("p_brand").alias("source"))
    made = acquisition.documents(asked, waves, costs, who, "owner", "name", facts)
    discard(parsed, who, waves, asked)
    return made


QUERIES = {"character_waves": character_waves, "character_costs": character_costs, "character_graphs": character_graphs}

_WAVE_SQL = """SELECT owner, k, {wave} AS wave, s FROM b WHERE NOT list_contains(known, k) AND {rest}
  (d1 IS NULL OR list_contains(known, d1) OR list_contains(known, d2){before})"""


def _wave_sql(wave: int) -> str:
    earlier = [f"w{i}" for i in range(1, wave)]
    rest = "".join(f" (owner, k) NOT IN (SELECT owner, k FROM {w}) AND" for w in earlier)
    before = "".join(f" OR (owner, d1) IN (SELECT owner, k FROM {w}) OR (owner, d2) IN (SELECT owner, k FROM {w})" for w in earlier)
    return _WAVE_SQL.format(wave=wave, rest=rest, before=before)


# the pairs of the matrix with the entries that each part asks for; 'red bolt*' names no entry here, so it is open
ORACLES = {
    "character_waves": f"""WITH {FEATS_SQL}, {CHARACTERS_SQL}, {PAIRS_SQL},
x AS (SELECT class || '/' || n::VARCHAR AS owner, p_partkey AS k, n, ok1, ok2, CASE WHEN b <> 7 THEN ok3 END AS ok3, t1, t2, t3,
  CASE WHEN p_partkey >= 12 AND p_partkey % 3 > 0 THEN p_partkey // 2 END AS d1, CASE WHEN p_partkey >= 12 AND p_partkey % 3 = 2 THEN p_partkey // 3 END AS d2, CASE WHEN p_partkey >= 12 AND p_partkey % 7 = 3 THEN p_partkey // 5 END AS d5,
  CASE WHEN n % 6 <> 0 THEN [n, 2 * n + 1] ELSE [] END AS known FROM p),
b AS (SELECT *, ok1 AND ok2 AND ok3 AS s FROM x WHERE (ok1 AND ok2 AND ok3) IS NOT FALSE),
w1 AS ({_wave_sql(1)}), w2 AS ({_wave_sql(2)}), w3 AS ({_wave_sql(3)}),
w AS (SELECT owner, k, wave FROM w1 UNION ALL SELECT owner, k, wave FROM w2 UNION ALL SELECT owner, k, wave FROM w3),
r AS (SELECT w.owner, w.k, w.wave, concat_ws(' ; ', CASE WHEN ok1 IS NULL THEN t1 END, CASE WHEN ok2 IS NULL THEN t2 END, CASE WHEN ok3 IS NULL THEN t3 END,
  CASE WHEN d5 IS NOT NULL AND NOT list_contains(known, d5) AND h.k IS NULL THEN 'don ' || d5::VARCHAR || ' ou mystère' END) AS reasons
  FROM w JOIN b USING (owner, k) LEFT JOIN w AS h ON h.owner = w.owner AND h.k = d5 AND h.wave < w.wave)
SELECT owner, 'don ' || k::VARCHAR AS name, wave::INT AS wave, CASE WHEN reasons = '' THEN 'eligible' ELSE 'manual_check' END AS status, reasons FROM r"""
}
