"""Sources, sinks and the streaming extension."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewright.sources import records, sinks
from tomewright.streaming import windows

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("level", T.IntegerType())])


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "a", "level": 1}\n\n{"id": "b", "level": null}\n')
    rows = records.json_lines(spark, str(tmp_path), SCHEMA).collect()
    assert sorted((r["id"], r["level"], r["_file"]) for r in rows) == [("a", 1, "a.jsonl"), ("b", None, "a.jsonl")]
    (tmp_path / "b.jsonl").write_text('{"id": }\n')
    good, bad = records.json_lines_checked(spark, str(tmp_path), SCHEMA)
    assert good.count() == 2 and bad.collect()[0]["_file"] == "b.jsonl"
    with pytest.raises(Exception):  # noqa: B017
        records.json_lines(spark, str(tmp_path), SCHEMA).collect()
    assert records.optional(spark, str(tmp_path / "none"), spark.read.text) is None


def test_alias_lines_and_raw_files(spark, tmp_path):
    (tmp_path / "t.tsv").write_bytes("# note\nfeu\tboule\n\nbad line\nx\t\n".encode())
    good, bad = records.alias_lines(spark, str(tmp_path / "t.tsv"))
    assert [(r["alias"], r["id"]) for r in good.collect()] == [("feu", "boule")] and bad.count() == 2
    for name, body in (("ok", b"x"), ("bom", b"\xef\xbb\xbfx"), ("bad", b"\xff"), ("rep", "a�".encode())):
        (tmp_path / f"{name}.html").write_bytes(body)
    got = {r["path"].rsplit("/", 1)[1]: r["problem"] for r in records.raw_files(spark, str(tmp_path / "*.html")).collect()}
    assert got == {"ok.html": None, "bom.html": "bom", "bad.html": "encoding", "rep.html": "replacement"}


def test_keys(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, p int, v string")
    kept, dropped = records.first_by_key(rows, "k", ["p"])
    assert sorted(r["v"] for r in kept.collect()) == ["x", "z"] and [r["v"] for r in dropped.collect()] == ["y"]
    assert sorted(r["v"] for r in records.last_by_key(rows, "k", "p").collect()) == ["y", "z"]
    with pytest.raises(ValueError):
        records.vocabulary(spark, ["a", "a"])


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b", None), (1, "a", "x")], "id long, name string, gone string")
    sinks.write_json_lines(rows, str(tmp_path / "j"), "id", ["id", "name", "gone"])
    lines = [x for p in sorted((tmp_path / "j").glob("part-*")) for x in p.read_text().splitlines()]
    assert [json.loads(x) for x in lines] == [{"id": 1, "name": "a", "gone": "x"}, {"id": 2, "name": "b", "gone": None}]
    sinks.write_entities(rows, str(tmp_path / "e"), "id", 4)
    assert sinks.read_entity(spark, str(tmp_path / "e"), "id", 2, 4).collect()[0]["name"] == "b"
    sinks.append_new(rows, str(tmp_path / "n"), "id")
    sinks.append_new(rows, str(tmp_path / "n"), "id")
    assert spark.read.parquet(str(tmp_path / "n")).count() == 2
    new = spark.createDataFrame([(2, "B", None), (3, "c", None)], rows.schema)
    assert sorted(r["name"] for r in sinks.upserted(rows, new, ["id"]).collect()) == ["B", "a", "c"]
    marked = sinks.tombstoned(rows, spark.createDataFrame([(2, "now"), (1, "now")], "id long, gone string"), ["id"], "gone")
    assert {r["id"]: r["gone"] for r in marked.collect()} == {1: "x", 2: "now"}
    good, bad = sinks.split_quarantine(rows, F.when(F.col("gone").isNull(), "open"))
    assert good.count() == 1 and json.loads(bad.collect()[0]["raw"])["id"] == 2
    may, edited = sinks.protected(rows, rows.withColumn("h", F.when(F.col("id") == 1, F.md5("name"))), "id", "h", F.md5("name"))
    assert [r["id"] for r in may.collect()] == [1] and [r["id"] for r in edited.collect()] == [2]
    assert [r["id"] for r in sinks.stale(rows.where("id = 1"), rows, "id", ["name"]).collect()] == [2]


def test_streaming(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    seen = []
    query = windows.apply_changes(windows.once(stream, ["event_id"], "ts"), lambda batch, i: seen.append(batch.count()), str(tmp_path / "c"))
    query.awaitTermination()
    assert sum(seen) == events.select("event_id").distinct().count()
    assert windows.windowed_counts(events, "ts", "event_type", "value").agg(F.sum("n")).first()[0] == events.count()
    assert windows.sessions(events, "ts", "user_id").agg(F.sum("n")).first()[0] == events.count()
