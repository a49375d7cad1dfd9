"""Toxicity by maximum-scoring segments of token log-odds.

Tokens: lower-cased runs of letters, digits and non-ASCII characters. The log-odds of a token between toxic and clean
training documents has a hierarchical Dirichlet prior: a token leans on the tokens that share its first six bytes (five,
four, if it isn't longer), these on those that share one byte less, and the last ones on the corpus. Every token
that a labelled training document holds has its value; others take that of their longest known prefix. A value is a bound,
``SURE`` errors nearer to zero than the log-odds; no count stands in the error with less than ``LEAST``, or a sure prefix (which
leaves nearly nothing of the prior to the other side) would make a token's error boundless and its value zero.

Every token adds its log-odds less ``DRIFT``. One scan over a text, linear in its length, finds all maximal-scoring
segments (Ruzzo and Tompa): each kept segment links to the nearest earlier one whose sum to the left is smaller, so none is
passed twice. Under clean text the best of n starts exceeds s with probability 1 - exp(-K n exp(-lambda s)); lambda
solves E[exp(lambda s)] = 1 over the tokens of clean texts, repeats counted. Segments with a probability below ``LEVEL`` are
significant passages; a document's two figures, the surprise of its best segment and that of all significant ones,
are turned into a probability by a logistic fit.

Counting reads every labelled training row, scoring every row, whole texts. lambda, K and the logistic fit come from a bounded
sample of the labelled training documents (``SAMPLE``, by hash of the id), each valued without its own counts, so that a
document doesn't vouch for itself.

The values are sent to the tasks as arrays over 64-bit hashes of tokens (n tokens share one with a chance of about
n * n / 4e19). Beyond ``ENTRIES`` of them the texts are read once for each block of hashes, and the values found are kept
between; no value is left out.

Defined cases: null or empty text has no tokens and scores as a text without a segment; a very long text is scanned
whole; labels that are null are ignored, of several labels of one id the largest holds; without toxic or without clean
labels every score is the share of toxic labels (0 with none); repeated rows get equal results; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import discard, materialize, read, text_bytes
from tomewright.llm.decontaminate import words

PREFIXES = (4, 5, 6)
PRIOR = 4.0
SURE = 1.5
LEAST = 0.5
ENTRIES = 4_000_000
DRIFT = 1.0
CLIP = 8.0
LEVEL = 0.01
SAMPLE = 20_000
FLUSH = 200_000
KEPT = 300_000
BINS = 4096


def _hash(key: bytes, level: int) -> int:
    h = xxhash.xxh3_64_intdigest(key, level)
    return h - (1 << 64) if h >> 63 else h


def hashes(token: bytes) -> tuple[int, ...]:
    """Of the token, and of its prefixes from the longest on; 0 where it is too short for one."""
    return (_hash(token, 0), *(_hash(token[:s], s) if len(token) > s else 0 for s in reversed(PREFIXES)))


def bags(docs: DataFrame) -> DataFrame:
    """doc_id and the compressed distinct tokens of each text: what has to meet the labels, instead of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            made = [pack(b" ".join(sorted(set(words(body))))) if body else None for body in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "bag"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, bag binary").where("bag IS NOT NULL")


def token_counts(labelled: DataFrame) -> DataFrame:
    """Of rows (bag, toxic): the hashes of each token and its prefixes, and in how many toxic and clean rows it stands (a
    token that one text repeats counts once). Over all rows; summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, list[int]] = defaultdict(lambda: [0, 0])
        unpack = zstandard.ZstdDecompressor().decompress

        def rows() -> pa.RecordBatch:
            keys = np.array([hashes(w) for w in found], np.int64).reshape(-1, 4)
            counts = np.array(list(found.values()), np.int64).reshape(-1, 2)
            found.clear()
            return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in keys.T), *(pa.array(np.ascontiguousarray(c)) for c in counts.T)], ["h", "p6", "p5", "p4", "c", "t"])

        for batch in batches:
            for bag, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in unpack(bag).split():
                    found[w][toxic] += 1
                if len(found) >= FLUSH:
                    yield rows()
        yield rows()

    return labelled.select("bag", "toxic").mapInArrow(run, "h long, p6 long, p5 long, p4 long, c long, t long").groupBy("h", "p6", "p5", "p4").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def entries(counts: DataFrame, rate: float) -> DataFrame:
    """h, t, c, up of all tokens and prefixes: in how many toxic and clean documents, and the rate it leans on."""
    up, out, above = F.lit(rate), None, None
    for size in PREFIXES:
        key = f"p{size}"
        level = counts.where(F.col(key) != 0).groupBy(F.col(key).alias("h"), *([F.col(f"p{above}").alias("key")] if above else [])).agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        if above:
            level = level.join(rates, "key").drop("key")
        else:
            level = level.withColumn("up", up)
        level = level.select("h", "t", "c", "up")
        own = (F.col("t") + PRIOR * F.col("up")) / (F.col("t") + F.col("c") + PRIOR)
        rates = level.select(F.col("h").alias("key"), own.alias("up"))
        out, every = (level, rates) if out is None else (out.unionByName(level), every.unionByName(rates))
        above = size
    parent = F.when(F.col("p6") != 0, F.col("p6")).when(F.col("p5") != 0, F.col("p5")).otherwise(F.col("p4"))
    tokens = counts.select("h", "t", "c", parent.alias("key")).join(every, "key", "left").select("h", "t", "c", F.coalesce("up", up).alias("up"))
    return out.unionByName(tokens)


class Table:
    """Values of tokens from the entries of one block of hashes."""

    def __init__(self, h: np.ndarray, t: np.ndarray, c: np.ndarray, up: np.ndarray, base: float):
        order = np.argsort(h)
        self.h, self.t, self.c, self.up = h[order], t[order].astype(np.int32), c[order].astype(np.int32), up[order].astype(np.float32)
        self.base = base
        self.cache: dict[bytes, tuple[float, int]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}

    def find(self, tokens: list[bytes], without: int | None = None) -> list[tuple[float, int]]:
        """(log-odds, level) of each token: level 0 for the token's own, 1 to 3 for its prefixes, 4 where none is here.
        without: the label (0 or 1) of a document that holds the tokens once and isn't to count."""
        keys = np.array([hashes(w) for w in tokens], np.int64).reshape(-1, 4)
        value, level = np.zeros(len(keys)), np.full(len(keys), 4)
        for k in (3, 2, 1, 0):
            at = np.minimum(np.searchsorted(self.h, keys[:, k]), max(0, len(self.h) - 1))
            ok = (self.h[at] == keys[:, k]) & (keys[:, k] != 0) if len(self.h) else np.zeros(len(keys), bool)
            t, c, up = (x[at[ok]].astype(float) for x in (self.t, self.c, self.up))
            if without is not None:
                t, c = np.maximum(t - without, 0), np.maximum(c - (1 - without), 0)
                known = t + c > 0
                ok[np.flatnonzero(ok)[~known]] = False
                t, c, up = t[known], c[known], up[known]
            a, b = t + PRIOR * up, c + PRIOR * (1 - up)
            v = np.log(a / b) - self.base
            value[ok], level[ok] = np.clip(np.sign(v) * np.maximum(np.abs(v) - SURE * np.sqrt(1 / np.maximum(a, LEAST) + 1 / np.maximum(b, LEAST)), 0), -CLIP, CLIP), k
        return list(zip(value.tolist(), level.tolist(), strict=True))

    def alone(self, tokens: list[bytes], without: int) -> list[tuple[float, int]]:
        once = list(dict.fromkeys(tokens))
        of = dict(zip(once, self.find(once, without), strict=True))
        return [of[w] for w in tokens]

    def values(self, texts: list[list[bytes]]) -> list[list[tuple[float, int]]]:
        if len(self.cache) > KEPT:
            self.cache.clear()
        cache = self.cache
        new = [w for w in {w for t in texts for w in t} if w not in cache]
        cache.update(zip(new, self.find(new), strict=True))
        return [[cache[w] for w in t] for t in texts]


def segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) in one scan."""
    sums = np.cumsum(s, dtype=float)
    at = np.flatnonzero(np.asarray(s) > 0)
    starts, ends, left, right, link = [], [], [], [], []
    for i, low, total in zip(at.tolist(), (sums[at] - np.asarray(s, float)[at]).tolist(), sums[at].tolist(), strict=True):
        start, j = i, len(left) - 1
        while j >= 0 and left[j] >= low:
            j = link[j]
        while j >= 0 and right[j] < total:
            start, low, above = starts[j], left[j], link[j]
            del starts[j:], ends[j:], left[j:], right[j:], link[j:]
            j = above
        starts.append(start)
        ends.append(i + 1)
        left.append(low)
        right.append(total)
        link.append(j)
    return [(a, b, r - q) for a, b, q, r in zip(starts, ends, left, right, strict=True)]


def karlin(histogram: np.ndarray) -> tuple[float, float]:
    """lambda and K of clean text from counts of token scores in BINS over (-CLIP - 1, CLIP + 1): lambda by bisection, K
    by the mean-loss approximation lambda * |E s|."""
    s = (np.arange(BINS) + 0.5) * (2 * CLIP + 2) / BINS - CLIP - 1
    p = histogram / max(1, histogram.sum())
    mean = float(s @ p)
    if mean >= 0 or not (p[s > 0] > 0).any():
        return 1.0, 0.1
    low, high = 1e-6, 1.0
    while p @ np.exp(high * s) < 1 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if p @ np.exp(mid * s) < 1 else (low, mid)
    return low, max(1e-6, min(1.0, low * abs(mean)))


class Calibration:
    def __init__(self, rate: float, k: float):
        self.rate, self.k = rate, k

    def surprise(self, score: float, tokens: int) -> float:
        """-log10 of the probability that clean text of so many tokens holds a segment with this score."""
        expected = math.log(self.k * max(1, tokens)) - self.rate * score
        log_p = expected if expected < -20 else math.log(-math.expm1(-math.exp(min(expected, 700))))
        return -log_p / math.log(10)

    def figures(self, s: np.ndarray) -> tuple[float, float, list[tuple[int, int, float]]]:
        """The surprise of the best segment, that of all significant ones, and these."""
        found = segments(s)
        graded = [(self.surprise(x[2], len(s)), x) for x in found]
        strong = [(g, x) for g, x in graded if g >= -math.log10(LEVEL)]
        return max((g for g, _ in graded), default=0.0), sum(g for g, _ in strong), [x for _, x in strong]


def _inputs(best: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(best), np.log1p(best), np.log1p(total)], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def truth(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of the labels that may be learnt."""
    return labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))


class Tables:
    """The table of each block of hashes, sent to the tasks when it is asked for; a single one is sent once."""

    def __init__(self, found: DataFrame, base: float, bound: int):
        self.found, self.base, self.single = found, base, None
        self.blocks = max(1, -(-found.count() // bound))

    def __getitem__(self, b: int):
        if self.single is None or self.blocks > 1:
            rows = self.found.where(F.pmod("h", F.lit(self.blocks)) == b).select("h", F.col("t").cast("int"), F.col("c").cast("int"), F.col("up").cast("float"))
            got = rows.toArrow()
            self.single = rows.sparkSession.sparkContext.broadcast(Table(*(got.column(c).to_numpy() for c in ("h", "t", "c", "up")), self.base))
        return self.single


def valued(docs: DataFrame, tables: Tables, finish: Callable, schema: str) -> DataFrame:
    """Rows that ``finish`` makes of each batch and its texts' scores (log-odds less DRIFT of every token). Where docs has
    a column ``toxic``, documents are valued without their own counts. Each block of hashes is one pass."""
    own, blocks = docs.columns, tables.blocks
    between = ", ".join([*(f"`{n}` {k}" for n, k in docs.dtypes), "scores binary, levels binary"])
    at, label = own.index("text"), own.index("toxic") if "toxic" in own else None
    for b in range(blocks):
        sent = tables[b]

        def run(batches: Iterator[pa.RecordBatch], sent=sent, b=b) -> Iterator[pa.RecordBatch]:
            look = sent.value
            for batch in batches:
                bodies = text_bytes(batch.column(at))
                scores, levels = [], []
                for start in range(0, len(bodies), 64):
                    texts = [words(x) if x else [] for x in bodies[start : start + 64]]
                    if label is None:
                        made = look.values(texts)
                    else:
                        made = [look.alone(w, y) for w, y in zip(texts, batch.column(label)[start : start + 64].to_pylist(), strict=True)]
                    for i, m in enumerate(made, start):
                        value, level = np.array(m, np.float32).reshape(-1, 2).T
                        value = value - np.float32(DRIFT)
                        if b:
                            old, old_level = (np.frombuffer(batch.column(len(own) + k)[i].as_py(), np.float32) for k in (0, 1))
                            value, level = np.where(level < old_level, value, old), np.minimum(level, old_level)
                        scores.append(value)
                        levels.append(level)
                if b + 1 == blocks:
                    yield finish(batch, scores)
                else:
                    yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], *(pa.array([x.tobytes() for x in c], pa.binary()) for c in (scores, levels))], [*own, "scores", "levels"])

        before, docs = docs, docs.mapInArrow(run, schema if b + 1 == blocks else between)
        if b + 1 < blocks:
            docs = materialize(docs, "values")
            if b:
                discard(before)
    return docs


def score(docs: DataFrame, labels: DataFrame, *, bound: int = ENTRIES) -> DataFrame:
    """doc_id, held_out, score, predicted, and the significant passages (token spans with their scores)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = materialize(truth(labels), "truth")
    learning = docs.where(~held_out())
    rows = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    counts = materialize(token_counts(bags(learning).hint("merge").join(known, "doc_id")), "counts")
    sums = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    toxic, clean = sums["t"] or 0, sums["c"] or 0
    base = math.log((toxic + 0.5) / (clean + 0.5))
    found = materialize(entries(counts, 1 / (1 + math.exp(-base))), "entries")
    discard(counts)
    tables = Tables(found, base, bound)
    fraction = min(1.0, SAMPLE / max(1, sum(rows.values())))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(fraction * (1 << 30))))
    keep = lambda batch, scores: pa.RecordBatch.from_arrays([batch.column(1), pa.array([x.tobytes() for x in scores], pa.binary())], ["toxic", "scores"])
    sample = materialize(valued(learning.join(F.broadcast(chosen), "doc_id").select("text", "toxic"), tables, keep, "toxic int, scores binary"), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            s = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32)
            total += np.bincount(np.clip((s + CLIP + 1) * (BINS / (2 * CLIP + 2)), 0, BINS - 1).astype(int), minlength=BINS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bin", "n"])

    histogram = np.zeros(BINS)
    for r in sample.where("toxic = 0").select("scores").mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        histogram[r["bin"]] = r["n"]
    calibration = Calibration(*karlin(histogram))

    def grade(batch: pa.RecordBatch, scores: list[np.ndarray]) -> pa.RecordBatch:
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        out = [calibration.figures(s) for s in scores]
        passages = [[{"start": a, "end": b, "score": s} for a, b, s in x[2]] for x in out]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.float64()), pa.array([x[1] for x in out], pa.float64()), pa.array(passages, spans)], ["doc_id", "held_out", "best", "total", "passages"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [calibration.figures(np.frombuffer(s, np.float32))[:2] for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[k] for x in out], pa.float64()) for k in (0, 1))], ["toxic", "best", "total"])

    if not rows.get(0) or not rows.get(1):
        made = F.lit(float(rows.get(1, 0) > 0))
    else:
        got = sample.mapInArrow(learn, "toxic int, best double, total double").toPandas()
        w = logistic(_inputs(got["best"].to_numpy(), got["total"].to_numpy()), got["toxic"].to_numpy(float)) if len(got) else np.zeros(3)
        made = 1 / (1 + F.exp(-(F.lit(float(w[0])) + F.lit(float(w[1])) * F.log1p("best") + F.lit(float(w[2])) * F.log1p("total"))))
    discard(sample)
    schema = "doc_id long, held_out boolean, best double, total double, passages array<struct<start: long, end: long, score: double>>"
    figures = valued(docs.select("doc_id", held_out().alias("held_out"), "text"), tables, grade, schema)
    return figures.withColumn("score", made).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).withColumn("n_passages", F.size("passages").cast("long")).drop("passages")
