"""Ranked search over a stored index of all parts: every kind of part is looked for by misspelt and shortened words."""

from __future__ import annotations

from pyspark.sql import functions as F

from tomewright.operators import search
from tomewright.sources.shared import shared_folder
from tomewright.sources.tables import load

BOOSTS = {"name": 6.0, "kind": 1.0}


def _queries(spark, d):
    """The distinct pairs of a name's words and a type, each with a letter less at one end."""
    p = load(spark, d, "part").select("p_type", F.substring_index("p_name", " ", 1).alias("word")).distinct()
    return p.select(F.concat_ws("/", "word", "p_type").alias("query"), F.concat_ws(" ", F.expr("substring(word, 1, char_length(word) - 1)"), F.expr("substring(p_type, 2)")).alias("text"))


def stored_search(spark, d):
    """What each query finds: how many parts, their scores in sum and at most."""
    index = search.Index(load(spark, d, "part"), "p_partkey", {"name": "p_name", "kind": "p_type"}, shared_folder(spark))
    words = search.terms_of(_queries(spark, d), "query", "text")
    hits = search.scored(index, words, BOOSTS)
    return hits.groupBy("query").agg(F.count("*").alias("hits"), F.round(F.sum("score"), 3).alias("total"), F.round(F.max("score"), 6).alias("best"))


QUERIES = {"stored_search": stored_search}

_FOLD = "lower(translate({}, 'éÉ', 'ee'))"
ORACLES = {
    "stored_search": f"""WITH docs AS (SELECT p_partkey AS k, f, list_filter(string_split_regex({_FOLD.format("t")}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM (SELECT p_partkey, 'name' AS f, p_name AS t FROM part UNION ALL SELECT p_partkey, 'kind', p_type FROM part)),
mean AS (SELECT f, avg(len(w)) AS mean FROM docs GROUP BY f), post AS (SELECT f, k, len(w) AS len, t, count(*) AS tf FROM (SELECT f, k, w, unnest(w) AS t FROM docs) GROUP BY f, k, w, t),
df AS (SELECT f, t, count(*) AS df FROM post GROUP BY f, t), tok AS (SELECT DISTINCT t FROM df),
q AS (SELECT DISTINCT p_type, string_split(p_name, ' ')[1] AS word FROM part),
w AS (SELECT DISTINCT word || '/' || p_type AS query, unnest(list_filter(string_split_regex({_FOLD.format("word[1:length(word) - 1] || ' ' || p_type[2:]")}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')) AS word FROM q),
ask AS (SELECT DISTINCT word FROM w),
st AS (SELECT word, t, CASE WHEN t = word THEN 1.0 WHEN starts_with(t, word) THEN 0.375 * length(t) / (length(t) + 0.3 * (length(t) - length(word))) ELSE 0.45 * length(t) / (length(t) + levenshtein(word, t)) END::DOUBLE AS weight
  FROM ask, tok WHERE starts_with(t, word) OR levenshtein(word, t) <= least(6, floor(length(word) * 0.15 + 0.5))),
n AS (SELECT count(*)::DOUBLE AS n FROM part),
fac AS (SELECT query, f, t, sum(weight * CASE f WHEN 'name' THEN 6.0 ELSE 1.0 END::DOUBLE * ln(1 + (n - df + 0.5) / (df + 0.5))) AS factor FROM w JOIN st USING (word) JOIN df USING (t), n GROUP BY query, f, t),
s AS (SELECT query, k, sum(factor * (0.5 + tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.3 + 0.7::DOUBLE * len / mean)))) AS score FROM fac JOIN post USING (f, t) JOIN mean USING (f) GROUP BY query, k)
SELECT query, count(*) AS hits, round(sum(score), 3) AS total, round(max(score), 6) AS best FROM s GROUP BY query""",
}
