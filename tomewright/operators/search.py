"""Search: token index, exact aliases before ranked hits, prefixes and near spellings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomewright.functions.text import fold_latin, spaces

# Words that a query drops.
STOP_WORDS = ["de", "la", "le", "les", "des", "du", "un", "une", "et", "en"]
FUZZY = 0.15


def token_index(rows: DataFrame, key: str, text: str) -> DataFrame:
    """token, key, length (letters of the text): a row for each distinct token of a row."""
    words = F.split(F.regexp_replace(fold_latin(F.col(text)), r"[^a-z0-9]+", " "), " ")
    made = rows.select(key, F.char_length(text).alias("length"), F.explode(words).alias("token"))
    return made.where((F.col("token") != "") & ~F.col("token").isin(*STOP_WORDS)).distinct()


def ranked(index: DataFrame, key: str, query: list[str], limit: int = 50) -> DataFrame | None:
    """key, score: rows where every query word matches a token exactly (3), as a prefix (2) or within 15 % of its
    letters (1). None for an empty query (show everything); no rows for one without a match.

    Query words are few, so they become one literal array: the index is scanned once and summed by key."""
    words = [w for w in query if w and w not in STOP_WORDS]
    if not words:
        return None
    points = []
    for w in words:
        near = F.levenshtein(F.col("token"), F.lit(w)) <= round(FUZZY * len(w))
        points.append(F.when(F.col("token") == w, 3).when(F.startswith(F.col("token"), F.lit(w)), 2).when(near, 1).otherwise(0))
    scored = index.select(key, "length", *[p.alias(f"p{i}") for i, p in enumerate(points)]).where(" OR ".join(f"p{i} > 0" for i in range(len(words))))
    best = scored.groupBy(key).agg(F.max("length").alias("length"), *[F.max(f"p{i}").alias(f"p{i}") for i in range(len(words))])
    best = best.where(" AND ".join(f"p{i} > 0" for i in range(len(words))))
    score = F.round(sum(F.col(f"p{i}") for i in range(len(words))) / F.sqrt("length"), 6)
    return best.select(key, score.alias("score")).orderBy(F.desc("score"), key).limit(limit)


def alias_then_ranked(hits: DataFrame, aliases: DataFrame, key: str, folded: str) -> DataFrame:
    """Exact alias hits (columns alias, key) with an infinite score before ranked ones; each key once."""
    exact = aliases.where(F.col("alias") == folded).select(key, F.lit(float("inf")).alias("score"))
    return exact.unionByName(hits).groupBy(key).agg(F.max("score").alias("score"))


def build_aliases(pairs: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Accepted (alias, key) and refused (alias, key, reason): unknown key, alias that is a real name, repeated pair.

    known: (key, folded name)."""
    once = pairs.groupBy("alias", key).agg(F.count("*").alias("n"))
    ids, names = known.select(F.col(key).alias("k")).distinct(), known.select(F.col("folded").alias("real")).distinct()
    marked = once.join(ids, F.col(key) == F.col("k"), "left").join(names, F.col("alias") == F.col("real"), "left")
    reason = F.when(F.col("k").isNull(), "unknown").when(F.col("real").isNotNull(), "real_name").when(F.col("n") > 1, "repeated")
    marked = marked.withColumn("reason", reason)
    return marked.where("reason IS NULL OR reason = 'repeated'").select("alias", key), marked.where("reason IS NOT NULL").select("alias", key, "reason")


# ranked search over a stored index: public BM25+ scoring with boosts, prefixes and near spellings

# Fixed values of the scoring: saturation, length, floor; weights of prefix and near matches.
BM25_K, BM25_B, BM25_D = 1.2, 0.7, 0.5
PREFIX_WEIGHT, NEAR_WEIGHT = 0.375, 0.45
NEAR_MOST = 6


def deletions(token: Column, most: Column) -> Column:
    """The token without none, one, ... up to ``most`` of its letters, each form once: two words within so many edits share one."""
    shorter = lambda forms: F.flatten(F.transform(forms, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(w), F.lit(1))), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))))
    step = lambda forms, _: F.array_distinct(F.concat(forms, shorter(forms)))
    rounds = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rounds, F.array(token), step)


def near_limit(token: Column, fuzzy: float = FUZZY) -> Column:
    """How many edits a query word of this length allows."""
    return F.least(F.lit(NEAR_MOST), F.round(F.char_length(token) * F.lit(fuzzy))).cast("int")


class Index:
    """A stored inverted index over fields of a table: ``postings`` (token, field, key, tf, length), ``tokens`` (token, letters),
    ``matches`` (field, token, df), and how many rows and words each field has. Written once, read by every search."""

    def __init__(self, rows: DataFrame, key: str, fields: dict[str, str], folder: str):
        """fields: names and their columns. A field's words are folded; words without meaning are dropped."""
        words = lambda c: F.filter(F.split(F.regexp_replace(fold_latin(F.col(c)), r"[^\p{L}\p{N}]+", " "), " "), lambda w: (w != "") & ~w.isin(*STOP_WORDS))
        told = F.array(*[F.struct(F.lit(n).alias("field"), words(c).alias("words")) for n, c in fields.items()])
        each = rows.select(F.col(key).alias("key"), F.inline(told)).where("words IS NOT NULL")
        lengths = each.groupBy("field").agg(F.count("*").alias("rows"), F.avg(F.size("words")).alias("mean"))
        posted = each.select("key", "field", F.size("words").alias("length"), F.explode("words").alias("token")).groupBy("token", "field", "key", "length").agg(F.count("*").alias("tf"))
        posted.repartition("token").sortWithinPartitions("token").write.mode("overwrite").parquet(f"{folder}/postings")
        spark = rows.sparkSession
        self.postings = spark.read.parquet(f"{folder}/postings")
        self.postings.groupBy("field", "token").agg(F.count("*").alias("df")).write.mode("overwrite").parquet(f"{folder}/matches")
        self.matches = spark.read.parquet(f"{folder}/matches")
        self.fields = {r["field"]: (r["rows"], r["mean"]) for r in lengths.collect()}
        self.count = rows.count()


def terms_of(queries: DataFrame, query: str, text: str) -> DataFrame:
    """query, word: the distinct words of each query, folded like the index's."""
    words = F.array_distinct(F.filter(F.split(F.regexp_replace(fold_latin(F.col(text)), r"[^\p{L}\p{N}]+", " "), " "), lambda w: (w != "") & ~w.isin(*STOP_WORDS)))
    return queries.select(F.col(query).alias("query"), F.explode(words).alias("word"))


def expanded(index: Index, words: DataFrame, fuzzy: float = FUZZY) -> DataFrame:
    """word, token, weight: the tokens that a query word stands for. The word itself weighs 1, a token that it begins and a near
    spelling less, by how far they are. Prefixes meet on the tokens' first letters, near spellings on shared deletions; no
    word is held against all tokens."""
    tokens = index.matches.select("token").distinct()
    asked = words.select("word").distinct()
    exact = asked.join(tokens, F.col("word") == F.col("token")).select("word", "token", F.lit(1.0).alias("weight"))
    # every prefix of a token that some query word could be: only lengths that words have
    lengths = F.array_sort(F.collect_set(F.char_length("word")))
    asked_lengths = asked.agg(lengths.alias("lengths"))  # one row, at most as many numbers as a word has letters
    starts = tokens.crossJoin(F.broadcast(asked_lengths)).select("token", F.explode(F.filter("lengths", lambda n: n < F.char_length("token"))).alias("n")).select("token", F.substr("token", F.lit(1), F.col("n")).alias("word"))
    begun = asked.join(starts, "word").select("word", "token", (PREFIX_WEIGHT * F.char_length("token") / (F.char_length("token") + 0.3 * (F.char_length("token") - F.char_length("word")))).alias("weight"))
    # tokens may lose as many letters as any word that could be near them allows
    far = near_limit(F.col("word"), fuzzy)
    own = asked.withColumn("far", far).where("far > 0")
    most = F.least(F.lit(NEAR_MOST), F.floor((F.char_length("token") + NEAR_MOST) * fuzzy + 0.5)).cast("int")
    left = own.select("word", "far", F.explode(deletions(F.col("word"), F.col("far"))).alias("form"))
    right = tokens.select("token", F.explode(deletions(F.col("token"), most)).alias("form"))
    near = left.join(right, "form").select("word", "far", "token").distinct().withColumn("edits", F.levenshtein("word", "token"))
    near = near.where("edits <= far AND edits > 0").select("word", "token", (NEAR_WEIGHT * F.char_length("token") / (F.char_length("token") + F.col("edits"))).alias("weight"))
    near = near.join(begun.select("word", "token"), ["word", "token"], "left_anti")  # what a word begins counts as begun
    return exact.unionByName(begun).unionByName(near)


def scored(index: Index, words: DataFrame, boosts: dict[str, float], fuzzy: float = FUZZY) -> DataFrame:
    """query, key, score: rows that hold any word of a query, by BM25+ over all fields: idf of the token in the field, saturated
    count, length against the field's mean; times the boost of the field and the weight of the match."""
    stands = expanded(index, words, fuzzy).join(index.matches, "token")
    n = F.lit(float(index.count))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    mean = F.try_element_at(F.create_map(*[F.lit(x) for f, (_, m) in index.fields.items() for x in (f, float(m))]), F.col("field"))
    boost = F.try_element_at(F.create_map(*[F.lit(x) for f in index.fields for x in (f, float(boosts.get(f, 1.0)))]), F.col("field"))
    stands = stands.withColumn("factor", F.col("weight") * boost * idf).select("word", "token", "field", "factor")
    asked = words.join(stands, "word").groupBy("query", "token", "field").agg(F.sum("factor").alias("factor"))
    saturated = BM25_D + F.col("tf") * (BM25_K + 1) / (F.col("tf") + BM25_K * (1 - BM25_B + BM25_B * F.col("length") / mean))
    return asked.join(index.postings, ["token", "field"]).groupBy("query", "key").agg(F.sum(F.col("factor") * saturated).alias("score"))


def searched(index: Index, queries: DataFrame, query: str, text: str, boosts: dict[str, float], limit: int = 50, aliases: DataFrame | None = None) -> DataFrame:
    """query, place, key, score, via: the best rows of each query, names that an alias (alias, key: folded) stands for exactly before
    all others. Equal scores go by key. A query without words has no rows."""
    words = terms_of(queries, query, text)
    hits = scored(index, words, boosts).withColumn("via", F.lit("name"))
    if aliases is not None:
        whole = queries.select(F.col(query).alias("query"), spaces(fold_latin(F.col(text))).alias("alias"))
        named = aliases.join(whole, "alias").select("query", F.col("key"), F.lit(float("inf")).alias("score"), F.lit("alias").alias("via")).distinct()
        hits = named.unionByName(hits.join(named, ["query", "key"], "left_anti"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    return hits.withColumn("place", place).where(F.col("place") <= limit).select("query", "place", "key", "score", "via")
