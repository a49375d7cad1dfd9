"""Approximate nearest neighbours with a permutation index.

Pivots: up to ``PIVOTS`` distinct vectors from a bounded sample (lowest hashes). Every vector is represented by all pivots in
order of nearness, and posted once, in the inverted file of its nearest pivot. A query reads the files of its ``ASKED``
nearest pivots only. There the footrule distance between the two orders ranks what was posted, and what lies within the
query's radius is compared by exact cosine on the original vectors in double precision. The radius is the footrule distance
within which so much of a bounded sample lies (``SAMPLE`` vectors, sent to the tasks with the pivots) as ``BASE`` vectors and
``SHARE`` of all are of the table; one law for every size.

All vectors are indexed. Equal vectors are one entry with its k + 1 smallest ids, which is all that ties can ask for, and
equal queries are searched once, so copies cost nothing however many they are. A file with more than ``BLOCK`` entries, or
queries, is dealt into parts by a hash of them, and each two parts meet in a task of their own. A query that finds fewer than
k others is asked of all files without a radius.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, neither do null ids; a
vector shorter than the longest is as one with zeros at its end; rows that share an id are one candidate with the best
score, and the query's own id is never its neighbour; ties go to the smaller id; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomewright.llm.common import discard, materialize, read

PIVOTS, ASKED = 256, 192
SAMPLE = 2048
SHARE, BASE = 0.02, 400
BLOCK = 8192


def valid(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """id and v (array of double) of the rows that take part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    return rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).where(F.exists("v", lambda x: x != 0))


def matrix(column: pa.Array | list, width: int) -> np.ndarray:
    """Rows of doubles, with zeros where one is shorter."""
    rows = column.to_pylist() if isinstance(column, (pa.Array, pa.ChunkedArray)) else column
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def orders(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivots of each row, nearest first."""
    return np.argsort(-(unit(x) @ pivots.T), axis=1, kind="stable").astype(np.int16)


def places(order: np.ndarray) -> np.ndarray:
    """The place of each pivot in each order."""
    out = np.empty_like(order)
    out[np.arange(len(order))[:, None], order] = np.arange(order.shape[1], dtype=order.dtype)
    return out


def footrule(place: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The footrule distance of one order to others, all by places."""
    return np.abs(others - place).sum(axis=1, dtype=np.int32)


class Index:
    """Pivots, and the orders of a sample that radii are taken from."""

    def __init__(self, pivots: np.ndarray, sample: np.ndarray, share: float):
        self.pivots, self.share = pivots, share
        self.sample = places(orders(sample, pivots)) if len(sample) else np.zeros((0, len(pivots)), np.int16)

    def radius(self, place: np.ndarray) -> int:
        found = np.sort(footrule(place, self.sample))
        return int(found[min(len(found) - 1, int(self.share * len(found)))]) if self.share < 1 and len(found) else np.iinfo(np.int32).max


def entries(rows: DataFrame, k: int) -> DataFrame:
    """h, v, ids: distinct vectors with their k + 1 smallest ids."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.xxhash64("v").alias("h"), "v", "ids")


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def posted(vectors: DataFrame, index, width: int, files: int) -> DataFrame:
    """vectors with p: the file of the nearest pivot, or a row for each of the nearest ``files`` files, and r: the radius of
    those that ask several."""
    own = vectors.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                whole = orders(matrix(part.column("v"), width), index.value.pivots)
                radii = np.array([index.value.radius(p) if files > 1 else 0 for p in places(whole)], np.int32)
                o = whole[:, :files]
                at = np.repeat(np.arange(len(o)), o.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(o.ravel().astype(np.int32)), pa.array(radii[at]), *(c.take(pa.array(at)) for c in part.columns)], ["p", "r", *own])

    return vectors.mapInArrow(run, "p int, r int, " + ", ".join(f"{n} {k}" for n, k in vectors.dtypes))


def nearest(files: DataFrame, asking: DataFrame, index, width: int, n: int, everything: bool = False) -> DataFrame:
    """q, id, score: the n nearest ids of each query in the files that it asks."""
    parts = lambda rows, name: rows.groupBy("p").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    sizes = F.broadcast(parts(files, "a").join(parts(asking, "b"), "p"))  # a row for each pivot
    own = lambda name: F.pmod(F.xxhash64("h", F.lit("part")), F.col(name)).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    left = asking.join(sizes, "p").select("p", own("b").alias("y"), every("a").alias("x"), F.col("h").alias("q"), "r", "v")
    right = files.join(sizes, "p").select("p", every("b").alias("y"), own("a").alias("x"), "v", "ids")

    def run(ask: pd.DataFrame, file: pd.DataFrame) -> pd.DataFrame:
        queries, ids, scores = [], [], []
        if len(ask) and len(file):
            own = index.value
            x, y = matrix(list(file["v"]), width), matrix(list(ask["v"]), width)
            held, asked = places(orders(x, own.pivots)), places(orders(y, own.pivots))
            members = file["ids"].to_numpy()
            for q, v, r, place in zip(ask["q"].to_numpy(), y, ask["r"].to_numpy(), asked, strict=True):
                near = np.arange(len(x)) if everything else np.flatnonzero(footrule(place, held) <= r)
                if not len(near):
                    continue
                score = cosine(v, x[near])
                if len(near) > n:
                    keep = score >= np.partition(score, -n)[-n]
                    near, score = near[keep], score[keep]
                for i, s in zip(near, score, strict=True):
                    ids += list(members[i])
                    scores += [s] * len(members[i])
                    queries += [q] * len(members[i])
        return pd.DataFrame({"q": np.array(queries, np.int64), "id": np.array(ids, np.int64), "score": np.array(scores, np.float64)})

    found = left.groupBy("p", "x", "y").cogroup(right.groupBy("p", "x", "y")).applyInPandas(run, "q long, id long, score double")
    scored = found.groupBy("q", "id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    return scored.withColumn("place", place).where(F.col("place") <= n).drop("place")


def search(vectors: DataFrame, queries: DataFrame, *, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS, asked: int = ASKED, share: float = SHARE, base: int = BASE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query."""
    spark = vectors.sparkSession
    held = materialize(entries(valid(vectors, vec_id, vector), k), "entries")
    owners = materialize(valid(queries, vec_id, vector).select("id", F.xxhash64("v").alias("q"), "v"), "queries")
    asking = materialize(owners.groupBy("v").agg(F.first("q").alias("h")).select("h", "v"), "asking")
    size = held.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("w")).first()
    width = max(size["w"] or 1, asking.agg(F.max(F.size("v"))).first()[0] or 1)
    sample = matrix([r["v"] for r in held.select("h", "v").orderBy(F.xxhash64("h"), "h").limit(SAMPLE).collect()], width)
    index = spark.sparkContext.broadcast(Index(unit(sample[:pivots]) if len(sample) else sample, sample, min(1.0, share + base / max(1, size["n"]))))
    files = materialize(posted(held.select("h", "v", "ids"), index, width, 1), "files")
    found = materialize(nearest(files, posted(asking, index, width, asked), index, width, k + 1), "found")
    enough = found.groupBy("q").count().where(F.col("count") >= min(k + 1, size["n"])).select(F.col("q").alias("h"))
    short = materialize(asking.join(enough, "h", "left_anti"), "short")
    if size["n"] and not short.isEmpty():
        more = nearest(files, posted(short, index, width, pivots), index, width, k + 1, everything=True)
        before, found = found, materialize(found.join(short.select(F.col("h").alias("q")), "q", "left_anti").unionByName(more), "found")
        discard(before)
    discard(held, asking, files, short)
    met = owners.select(F.col("id").alias("query_id"), "q").join(found, "q").where("id != query_id")
    once = met.groupBy("query_id", F.col("id").alias("vec_id")).agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 50 = 0"))
