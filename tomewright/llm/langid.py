"""Language identification by hierarchical discrimination: the language family first, then one-versus-one linear
support vector machines between the languages of that family.

Features: hashed counts of byte pairs and triples of the whole lower-cased text, letters and single spaces only,
under a square root and scaled to length one. Families come from the data: average linkage over the languages' mean
vectors, merged while two groups are at least as close as an average pair of languages.

Fitting uses a bounded sample of labelled rows: at most ``SAMPLE`` rows over all languages, chosen by a hash of id and text
in equal shares. Everything else reads every row.

Defined cases: null text, or text without a letter, is ``und`` with score 0; rows without text, letter or language
don't train; with no language learned every row is ``und``; with one, every text with a letter has it, with score 1;
a null id trains (it is not held out); a very long text is read whole, in pieces; of languages with equal duels and margins
the first by name wins; repeated rows get equal results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import read

SAMPLE = 3000
WIDTH = 2048
PIECE = 1 << 20
UNKNOWN = "und"

_KEEP = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def features(text: str) -> np.ndarray:
    """Unit vector of 2 * WIDTH hashed pair and triple counts."""
    body = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_KEEP).split()) + b" "
    counts = np.zeros(2 * WIDTH)
    for start in range(0, max(1, len(body) - 2), PIECE):
        a = np.frombuffer(body[start : start + PIECE + 2], np.uint8).astype(np.uint32)
        pairs = a[:-1] * np.uint32(263) + a[1:]
        triples = pairs[:-1] * np.uint32(263) + a[2:]
        counts[:WIDTH] += np.bincount((pairs[: PIECE] * np.uint32(2654435761)) >> np.uint32(21), minlength=WIDTH)
        counts[WIDTH:] += np.bincount((triples * np.uint32(2246822519)) >> np.uint32(21), minlength=WIDTH)
    out = np.sqrt(counts)
    norm = np.linalg.norm(out)
    return (out / norm if norm else out).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def svm(x: np.ndarray, y: np.ndarray, *, penalty: float = 1e-4, epochs: int = 12, batch: int = 32, seed: int = 7) -> np.ndarray:
    """Weights (the last is the bias) of a linear support vector machine: averaged stochastic subgradients of the hinge loss."""
    rng = np.random.default_rng(seed)
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    mean, step = np.zeros_like(w), 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for start in range(0, len(y), batch):
            k = order[start : start + batch]
            step += 1
            rate = 1 / (penalty * (step + 200))
            wrong = y[k] * (x[k] @ w) < 1
            w *= 1 - rate * penalty
            w += rate / len(k) * ((weight[k] * y[k] * wrong) @ x[k])
            if epoch >= epochs // 2:
                mean += w
    return (mean / np.linalg.norm(mean) * np.linalg.norm(w) if mean.any() else w).astype(np.float32)


def families(centres: dict[str, np.ndarray]) -> list[list[str]]:
    names = sorted(centres)
    near = {frozenset(p): float(centres[p[0]] @ centres[p[1]]) for p in combinations(names, 2)}
    if not near:
        return [[n] for n in names]
    least, groups = float(np.mean(list(near.values()))), [[n] for n in names]
    link = lambda a, b: float(np.mean([near[frozenset((p, q))] for p in a for q in b]))
    while len(groups) > 1:
        best, a, b = max((link(a, b), a, b) for a, b in combinations(groups, 2))
        if best < least:
            break
        groups = [g for g in groups if g is not a and g is not b] + [sorted(a + b)]
    return sorted(groups)


class Duel:
    """One-versus-one machines between groups; most duels won, then the largest summed margin, then the order."""

    def __init__(self, names: list, x: np.ndarray, owner: np.ndarray):
        self.names, self.pairs = names, list(combinations(range(len(names)), 2))
        rows = []
        for a, b in self.pairs:
            k = (owner == a) | (owner == b)
            rows.append(svm(x[k], np.where(owner[k] == a, 1.0, -1.0)))
        self.weights = np.array(rows, np.float32)

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winner of each row, and its least margin in its own duels."""
        if not self.pairs:
            return np.zeros(len(x), int), np.full(len(x), np.inf)
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        won, total = np.zeros((len(x), len(self.names))), np.zeros((len(x), len(self.names)))
        least = np.full((len(x), len(self.names)), np.inf)
        for k, (a, b) in enumerate(self.pairs):
            m = margins[:, k]
            won[:, a] += m >= 0
            won[:, b] += m < 0
            total[:, a] += m
            total[:, b] -= m
            least[:, a], least[:, b] = np.minimum(least[:, a], m), np.minimum(least[:, b], -m)
        best = np.argmax(won + 0.5 * np.tanh(total / 1e3), axis=1)
        return best, least[np.arange(len(x)), best]


class Model:
    def __init__(self, x: np.ndarray, langs: list[str]):
        names = sorted(set(langs))
        langs_a = np.array(langs, object)
        centres = {}
        for n in names:
            c = x[langs_a == n].mean(axis=0)
            centres[n] = c / (np.linalg.norm(c) or 1)
        self.groups = families(centres)
        home = {n: i for i, g in enumerate(self.groups) for n in g}
        self.family = Duel([tuple(g) for g in self.groups], x, np.array([home[n] for n in langs], int)) if names else None
        self.inside = []
        for g in self.groups:
            k = np.isin(langs_a, g)
            self.inside.append(Duel(g, x[k], np.array([g.index(n) for n in langs_a[k]], int)))

    def predict(self, texts: list[str | None], piece: int = 256) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        told = [i for i, t in enumerate(texts) if has_letter(t)] if self.family else []
        for start in range(0, len(told), piece):
            rows = told[start : start + piece]
            x = np.array([features(texts[i]) for i in rows])
            groups, sure = self.family.decide(x)
            for g in np.unique(groups):
                k = np.flatnonzero(groups == g)
                best, margin = self.inside[g].decide(x[k])
                score = 1 / (1 + np.exp(-2 * np.minimum(sure[k], margin)))
                for i, b, s in zip(k, best, score, strict=True):
                    langs[rows[i]], scores[rows[i]] = self.groups[g][b], float(s)
        return langs, scores


def fit(rows: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """From labelled rows. The sample's rows are turned into features on the executors."""
    known = rows.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model(np.zeros((0, 2 * WIDTH), np.float32), [])
    share = max(2, sample // len(counts))
    place = F.pmod(F.xxhash64("id", "text", F.lit("language")), F.lit(1 << 30))
    chosen = known.withColumn("place", place).where(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, int(min(1.0, 1.1 * share / n) * (1 << 30)))])[F.col("lang")] >= F.col("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(p, n, features(t).astype(np.float16).tobytes()) for p, n, t in zip(*(batch.column(c).to_pylist() for c in ("place", "lang", "text")), strict=True) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in kept], k) for i, k in enumerate((pa.int64(), pa.string(), pa.binary()))], ["place", "lang", "x"])

    found = sorted((r["lang"], r["place"], bytes(r["x"])) for r in chosen.select("place", "lang", "text").mapInArrow(run, "place long, lang string, x binary").collect())
    taken: dict[str, int] = {}
    langs, x = [], []
    for n, _, v in found:
        taken[n] = taken.get(n, 0) + 1
        if taken[n] <= share:
            langs.append(n)
            x.append(np.frombuffer(v, np.float16).astype(np.float32))
    return Model(np.array(x, np.float32).reshape(-1, 2 * WIDTH), langs)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = sent.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), text).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs, fit(docs.where(~held_out())))


def stage(docs: DataFrame) -> DataFrame:
    """The rows whose language is determined, with it in ``lang``. Rejected are rows without a letter, and rows whose
    language loses one of its own duels (a score below one half)."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs.where(~held_out())))
    place = docs.columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = sent.value.predict(batch.column("text").to_pylist())
            told = batch.set_column(place, batch.schema.field(place), pa.array(langs, batch.schema.field(place).type))
            yield told.filter(pa.array([n != UNKNOWN and s >= 0.5 for n, s in zip(langs, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
