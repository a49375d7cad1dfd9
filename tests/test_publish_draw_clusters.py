"""Publishing with failing tasks, the sequential draw, and greedy clusters against their sequential rules."""

import difflib
import json
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tomewright.operators import catalogue, ordering
from tomewright.sources import publish


def test_publish(spark, tmp_path):
    folder, schema = str(tmp_path / "out"), "id long, name string"
    rows = spark.range(40).select("id", F.concat(F.lit("é"), F.col("id").cast("string")).alias("name")).repartition(4)
    assert publish.manifest(folder) is None and publish.published(spark, folder, schema).count() == 0
    publish.publish(rows.limit(7), folder, "id")
    first = publish.manifest(folder)
    reader = publish.published(spark, folder, schema)
    assert first["rows"] == reader.count() == 7

    # a task fails in the middle: readers still see the state before, and nothing of the run stays
    broken = rows.withColumn("name", F.when(F.col("id") == 33, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        publish.publish(broken, folder, "id")
    assert publish.manifest(folder) == first and publish.superseded(folder) == []

    # a replacement character is found when the parts are read back
    with pytest.raises(Exception, match="replacement character"):
        publish.publish(rows.withColumn("name", F.when(F.col("id") == 5, F.lit("a�")).otherwise(F.col("name"))), folder, "id")
    assert publish.manifest(folder) == first and publish.superseded(folder) == []

    publish.publish(rows, folder, "id")
    now = publish.manifest(folder)
    assert now["rows"] == publish.published(spark, folder, schema).count() == 40 and len(publish.superseded(folder)) == 1
    assert reader.count() == 7  # a reader of the state before keeps it
    lines = [json.loads(x) for p, _, _ in now["parts"] for x in (Path(folder) / p).read_text("utf-8").splitlines()]
    assert [x["id"] for x in lines] == list(range(40)) and list(lines[0]) == ["id", "name"]
    publish.publish(rows.limit(0), folder, "id")
    assert publish.manifest(folder)["rows"] == 0 and publish.published(spark, folder, schema).count() == 0


def test_verification():
    part = publish.Part("f", 1, "0")
    for content, rows in ((b'{"a":1}\n', 2), (b'{"a":\xff}\n', 1), (b"{\n", 1), (b"\xef\xbb\xbf{}\n", 1)):
        import hashlib

        own = publish.Part("f", rows, hashlib.sha256(content).hexdigest())
        with pytest.raises(publish.NotVerified):
            publish.verified(content, own)
    with pytest.raises(publish.NotVerified, match="not what was written"):
        publish.verified(b"{}\n", part)


def test_seeded_draw(spark):
    """Equal to one generator that samples the sorted members of each stratum in turn."""
    rng = random.Random(61)
    members = {s: [f"{s}{rng.randint(0, 10**6)}" for _ in range(n)] for s, n in (("b", 50), ("a", 3), ("c", 400), ("d", 1))}
    quota = {"a": 5, "b": 7, "c": 20, "d": 1}
    rows = spark.createDataFrame([(s, m) for s, own in members.items() for m in own], "s string, m string").repartition(3)
    for seed in (0, 42, 20260730):
        own, want = random.Random(seed), {}
        for s in sorted(members):
            want[s] = sorted(own.sample(sorted(members[s]), min(quota[s], len(members[s]))))
        got = ordering.seeded_draw(rows, "s", spark.createDataFrame(list(quota.items()), "s string, quota int"), "m", seed).collect()
        assert {s: sorted(r["m"] for r in got if r["s"] == s) for s in members} == want
    assert ordering.seeded_places([("x", 10, 3)], 1) == [("x", p) for p in sorted(random.Random(1).sample(range(10), 3))]


def sequential(counts, ratio):
    heads, out = [], {}
    for label in sorted(counts, key=lambda c: (-counts[c], c)):
        best = difflib.get_close_matches(label, heads, n=1, cutoff=ratio)
        out[label] = best[0] if best else label
        if not best:
            heads.append(label)
    return out


def test_clusters(spark):
    """Labels of all first letters, close to each other and not, with ties."""
    rng = random.Random(62)
    stems = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 14))) for _ in range(120)]
    labels = Counter()
    for _ in range(900):
        word = list(rng.choice(stems))
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(word) + 1)
            word[k : k + rng.randint(0, 1)] = rng.choice("abcdefghilmnoprstu ")
        labels["".join(word)] += rng.randint(1, 3)
    labels |= Counter({"a": 2, "aa": 1, "ab": 1, "é": 1, "": 4})
    df = spark.createDataFrame([(w, n) for w, n in labels.items()] + [(None, 1)], "l string, n int")
    got = {r["label"]: r["head"] for r in catalogue.clusters(df, "l", "n", 0.72).collect()}
    assert got == sequential(labels, 0.72)
    assert len(set(got.values())) < len(got) and any(w[:1] != h[:1] for w, h in got.items())
