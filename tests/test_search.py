"""Ranked search over a stored index against a plain scoring of every token."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_functions import one
from tomewright.operators import search

WORD = re.compile(r"[^\W_]+")


def folded(x):
    return [w for w in WORD.findall((x or "").lower().replace("é", "e")) if w not in search.STOP_WORDS]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(rows, queries, boosts, limit):
    """Every query word against every token of every row."""
    texts = {f: [(k, folded(v[f])) for k, v in rows if v[f] is not None] for f in boosts}
    out = []
    for q, text in queries:
        scores = Counter()
        for word in dict.fromkeys(folded(text)):
            far = min(6, math.floor(len(word) * 0.15 + 0.5))
            for f, docs in texts.items():
                mean = sum(len(w) for _, w in docs) / len(docs)
                for token in {t for _, w in docs for t in w}:
                    n, d = len(token), edits(word, token)
                    if token == word:
                        weight = 1.0
                    elif token.startswith(word):
                        weight = 0.375 * n / (n + 0.3 * (n - len(word)))
                    elif d <= far:
                        weight = 0.45 * n / (n + d)
                    else:
                        continue
                    df = sum(token in w for _, w in docs)
                    idf = math.log(1 + (len(rows) - df + 0.5) / (df + 0.5))
                    for k, w in docs:
                        tf = w.count(token)
                        if tf:
                            scores[k] += weight * boosts[f] * idf * (0.5 + tf * 2.2 / (tf + 1.2 * (0.3 + 0.7 * len(w) / mean)))
        out += [(q, i + 1, k, pytest.approx(s)) for i, (k, s) in enumerate(sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:limit])]
    return out


def test_stored_search(spark, tmp_path):
    rng = random.Random(51)
    stems = ["boule", "boules", "feu", "feux", "projectile", "projectiles", "magique", "magie", "invisibilite", "mur", "le", "de", "éclair", "eclairs", "communication", "communications"]
    rows = [(i, {"n": " ".join(rng.choice(stems) for _ in range(rng.randint(1, 5))), "t": None if i % 7 == 0 else " ".join(rng.choice(stems) for _ in range(rng.randint(0, 12)))}) for i in range(60)]
    df = spark.createDataFrame([(k, v["n"], v["t"]) for k, v in rows], "k int, n string, t string")
    index = search.Index(df, "k", {"n": "n", "t": "t"}, str(tmp_path))
    queries = [(1, "boule"), (2, "Bou"), (3, "projectlie magiqe"), (4, "éclair de feu"), (5, "le de"), (6, ""), (7, "invisibilté"), (8, "zzz"), (9, "communicatoin comunications"), (10, "mur mur")]
    asked = spark.createDataFrame(queries, "q int, text string")
    boosts = {"n": 6.0, "t": 1.0}
    got = search.searched(index, asked, "q", "text", boosts, limit=12).orderBy("query", "place").collect()
    want = brute(rows, queries, boosts, 12)
    assert [(r["query"], r["place"]) for r in got] == [w[:2] for w in want]
    assert [r["score"] for r in got] == [w[3] for w in want]
    assert {r["query"] for r in got} == {1, 2, 3, 4, 7, 9, 10}
    aliases = spark.createDataFrame([("fireball", 7), ("fireball", 3), ("boule", 59)], "alias string, key int")
    named = search.searched(index, spark.createDataFrame([(1, " Fireball "), (2, "boule")], "q int, text string"), "q", "text", boosts, 3, aliases).orderBy("query", "place").collect()
    assert [(r["query"], r["key"], r["via"]) for r in named[:3]] == [(1, 3, "alias"), (1, 7, "alias"), (2, 59, "alias")] and named[3]["via"] == "name"


def test_deletions(spark):
    """Words within so many edits share a form; others are told apart by the distance."""
    forms = lambda w, k: set(one(spark, search.deletions(F.lit(w), F.lit(k))))
    assert forms("abc", 0) == {"abc"} and forms("abc", 1) == {"abc", "bc", "ac", "ab"} and forms("ab", 2) == {"ab", "a", "b", ""}
    rng = random.Random(52)
    for _ in range(8):
        a = "".join(rng.choice("abc") for _ in range(6))
        b = list(a)
        for _ in range(2):
            b[rng.randrange(len(b))] = rng.choice("abcd")
        assert edits(a, "".join(b)) > 2 or forms(a, 2) & forms("".join(b), 2)
