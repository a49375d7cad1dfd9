"""The pipeline against its stages by brute force, and the registered SQL."""

import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.test_operators import PATTERN, brute_components, brute_hits, brute_line_dedup
from tomewright.llm import bpe, langid
from tomewright.llm.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def rows(spark, sf):
    return {t: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").collect()] for t in ("documents", "benchmark")}


def expected(rows, langs):
    """id to (text, language) of what stays, stage by stage by brute force; langs: predicted language and score by text."""
    docs = [(r[0], r[1]) for r in sorted(rows["documents"]) if r[1] and langs[r[1]][0] != "und" and langs[r[1]][1] >= 0.5]
    lang = {i: langs[t][0] for i, t in docs}
    docs = {i: t for (i, before), t in zip(docs, brute_line_dedup(docs), strict=True) if t or not before}
    parts = brute_components(list(docs.items()), 5, 80)
    docs = {i: t for i, t in docs.items() if parts[i][1] == i}
    hits = brute_hits(list(docs.items()), rows["benchmark"])
    return {i: (t, lang[i]) for i, t in docs.items() if not hits[i][1]}


def test_pipeline(spark, sf, rows):
    import corpus_pipeline

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out()))
    texts = [r[1] for r in rows["documents"]]
    want = expected(rows, dict(zip(texts, zip(*model.predict(texts), strict=True), strict=True)))
    ranks = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN).ranks
    theirs = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(got) == set(want) and len(got) > 50
    for i, (t, lang) in want.items():
        assert got[i]["ids"] == theirs.encode_ordinary(t) and got[i]["n_tokens"] == len(got[i]["ids"]) and got[i]["lang"] == lang
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_pipeline_edge_cases(spark, sf, tmp_path):
    """Nulls, empty and very long texts, repeated rows, clashing columns, and empty tables go through all stages."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [(None, None, None, None, None), (None, "the word of the day and more", None, None, None), (10**6, "", "en", "s", 0), (10**6 + 1, "the and of " * 40_000, "en", "s", 1), (10**6 + 2, "1 2 3", "en", "s", 5)]
    more = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.limit(5))
    for name, table in (("odd", more), ("empty", docs.limit(0))):
        table.withColumns({"ids": F.lit("clash"), "component": F.lit(1), "h": F.lit("clash")}).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/odd")
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert None in ids and 10**6 + 1 in ids and not {10**6, 10**6 + 2} & set(ids) and "h" in got.columns
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(ORACLES[name])
    columns = sorted(d[0] for d in cur.description)
    want = sorted(map(repr, cur.df()[columns].itertuples(index=False, name=None)))
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == columns
    assert sorted(map(repr, df.select(columns).toPandas().itertuples(index=False, name=None))) == want
