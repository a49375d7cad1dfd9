"""Ranked lexical search over inverted treaps.

Every document's words are counted; of each word that a query holds, the documents are posted with the impact that the word has on
their scores. Postings are dealt in blocks of documents, in which each word has a treap: a search tree by document and a heap by
impact, so that the root of a subtree has its highest impact. A query walks the treaps of its words together. It keeps ranges of
documents with one subtree for each word; the sum of the roots' impacts bounds every score in the range. The ranges with the
highest bounds are opened first, at the document of their heaviest root: this document is scored, and each treap is split
there by a search for it. A range goes as soon as its bound can't enter the best k found so far in the task.

Queries are taken in blocks of at most ``BLOCK_WORDS`` words, so the vocabulary that is broadcast is bounded; every block is run
against all documents. A task returns at most k rows for each query, and a window keeps the best k of them.

Defined cases: a null text has no words, and documents without words don't count; queries without words find nothing; each row of
the queries is a query, also where ids repeat or are null; each row of the documents is a document, so repeated ids can fill several ranks;
documents with a null id count in the statistics and aren't returned; ties go by ascending id; very long texts count whole;
an empty table on either side gives no rows; extra columns are never read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomewright.llm.common import discard, materialize, read, text_bytes
from tomewright.llm.decontaminate import words

K = 20
BLOCK_WORDS = 1_000_000
BLOCK_DOCS = 16_384
#: Ranges that are opened at once.
STEP = 64
POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"


def postings(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """doc_id, n (words), and of the words in the vocabulary their numbers and counts. Documents without words are left out."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        for batch in batches:
            ids, sizes, ends, terms, counts = [], [], [0], [], []
            for i, body in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                w = words(body) if body else None
                if not w:
                    continue
                found = Counter(map(get, w))
                found.pop(None, None)
                ids.append(i)
                sizes.append(len(w))
                terms += found.keys()
                counts += found.values()
                ends.append(len(terms))
            lists = (pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (terms, counts))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(doc_id).cast("long"), text).mapInArrow(run, POSTINGS)


class Treaps:
    """The treaps of one block of documents, which are numbered in order of their ids. Node -1 stands for none."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, terms: int):
        place = np.lexsort((doc, term))
        self.ids, self.terms = ids, terms
        self.doc = np.append(doc[place], len(ids)).astype(np.int32)
        self.impact = np.append(impact[place], 0)
        # equal impacts are put in a scrambled order, so that the trees stay shallow
        rank = ((self.impact[:-1] << 20) | ((place * 0x9E3779B1 >> 7) & 0xFFFFF)).tolist()
        left, right, self.root = [-1] * (len(rank) + 1), [-1] * (len(rank) + 1), np.full(terms, -1, np.int32)
        bounds = np.searchsorted(term[place], np.arange(terms + 1)).tolist()
        for t in np.flatnonzero(np.diff(bounds)).tolist():
            spine: list[int] = []  # the rightmost path
            for k in range(bounds[t], bounds[t + 1]):
                below = -1
                while spine and rank[spine[-1]] < rank[k]:
                    below = spine.pop()
                left[k] = below
                if spine:
                    right[spine[-1]] = k
                spine.append(k)
            self.root[t] = spine[0]
        self.left, self.right = np.array(left, np.int32), np.array(right, np.int32)

    def split(self, node: np.ndarray, low: np.ndarray, at: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of treaps over the documents between low and high: the impacts of document ``at`` and the roots of both sides."""
        value, below, above = np.zeros(len(node), np.int64), np.full(len(node), -1, np.int32), np.full(len(node), -1, np.int32)
        todo = np.flatnonzero(node >= 0)
        here = node[todo]
        while len(todo):
            d, target = self.doc[here], at[todo]
            less, more = d < target, d > target
            take = less & (below[todo] < 0) & (d > low[todo])
            below[todo[take]] = here[take]
            take = more & (above[todo] < 0) & (d < high[todo])
            above[todo[take]] = here[take]
            same = ~(less | more)
            if same.any():
                hit, k = todo[same], here[same]
                value[hit] = self.impact[k]
                below[hit] = np.where(below[hit] < 0, self._inside(self.left[k], low[hit], self.right, np.less_equal), below[hit])
                above[hit] = np.where(above[hit] < 0, self._inside(self.right[k], high[hit], self.left, np.greater_equal), above[hit])
            here = np.where(less, self.right[here], np.where(more, self.left[here], -1))
            on = here >= 0
            todo, here = todo[on], here[on]
        return value, below, above

    def _inside(self, node: np.ndarray, limit: np.ndarray, child: np.ndarray, outside) -> np.ndarray:
        """The first nodes on the way down that lie inside the limit."""
        node = node.copy()
        todo = np.flatnonzero((node >= 0) & outside(self.doc[node], limit))
        while len(todo):
            node[todo] = child[node[todo]]
            todo = todo[(node[todo] >= 0) & outside(self.doc[node[todo]], limit[todo])]
        return node

    def search(self, terms: np.ndarray, times: np.ndarray, best: Best) -> None:
        """Puts the block's documents that belong there into best."""
        roots = self.root[terms]
        there = roots >= 0
        times, width = times[there], int(there.sum())
        if not width:
            return
        nodes, low, high = roots[there][None, :], np.array([-1], np.int32), np.array([len(self.ids)], np.int32)
        bound = (self.impact[nodes] * times).sum(1)
        while True:
            # ranges of equal bound stay only where an id is left that wins the tie
            keep = (bound > best.least) | ((bound == best.least) & (bound > 0) & (self.ids[np.minimum(low + 1, len(self.ids) - 1)] < best.last))
            if not keep.all():
                nodes, low, high, bound = nodes[keep], low[keep], high[keep], bound[keep]
            if not len(bound):
                return
            if len(bound) > STEP:
                order = np.argpartition(bound, len(bound) - STEP)
                rest, now = order[:-STEP], order[-STEP:]
            else:
                rest, now = np.empty(0, np.int64), np.arange(len(bound))
            own, own_low, own_high = nodes[now], low[now], high[now]
            at = self.doc[own[np.arange(len(now)), (self.impact[own] * times).argmax(1)]]
            value, below, above = self.split(own.ravel(), np.repeat(own_low, width), np.repeat(at, width), np.repeat(own_high, width))
            scores = (value.reshape(-1, width) * times).sum(1)
            best.add(scores, self.ids[at])
            made = np.concatenate((below, above)).reshape(-1, width)
            made_bound = (self.impact[made] * times).sum(1)
            nodes, low, high = np.concatenate((nodes[rest], made)), np.concatenate((low[rest], own_low, at)), np.concatenate((high[rest], at, own_high))
            bound = np.concatenate((bound[rest], made_bound))


class Best:
    """The best k of what was added, by score and then by smaller id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)
        self.least, self.last = 0, np.iinfo(np.int64).min

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores > self.least) | ((scores == self.least) & (ids < self.last))
        if not good.any():
            return
        scores, ids = np.concatenate((self.scores, scores[good])), np.concatenate((self.ids, ids[good]))
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least, self.last = int(self.scores[-1]), int(self.ids[-1])


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """What a word adds to a score: its weight times its saturated count, in whole numbers."""
    m = 100 - 25 + (25 * n * n_docs) // n_words
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def top(posted: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int, n_words: int, k: int, block_docs: int) -> DataFrame:
    """query (its number), doc_id, score: the best k of each task, from treaps of its documents."""
    sent = posted.sparkSession.sparkContext.broadcast((queries, weights))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, block_docs):
                held.append(batch.slice(start, block_docs))
                rows += held[-1].num_rows
                if rows >= block_docs:
                    yield pa.Table.from_batches(held)
                    held, rows = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, own = sent.value
        best = [Best(k) for _ in asked]
        for table in blocks(batches):
            table = table.combine_chunks().sort_by("doc_id")
            lists = table.column("terms").combine_chunks()
            doc = np.repeat(np.arange(len(table)), lists.value_lengths().to_numpy(zero_copy_only=False))
            term, tf = lists.flatten().to_numpy(), table.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
            impact = impacts(own[term], tf, table.column("n").to_numpy()[doc], n_docs, n_words)
            some = impact > 0
            treaps = Treaps(table.column("doc_id").to_numpy(), doc[some], term[some], impact[some], len(own))
            for (terms, times), found in zip(asked, best, strict=True):
                treaps.search(terms, times, found)
        sizes = [len(b.ids) for b in best]
        columns = [np.repeat(np.arange(len(best)), sizes), *(np.concatenate([getattr(b, c) for b in best] or [np.empty(0, np.int64)]) for c in ("ids", "scores"))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "doc_id", "score"])

    return posted.where("doc_id IS NOT NULL").mapInArrow(run, "query long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, *, k: int = K, doc_id: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text", block_words: int = BLOCK_WORDS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest scores above 0 for each query."""
    spark = docs.sparkSession
    items = queries.select(F.col(query_id).alias("id"), F.col(query_text).alias("text")).where(F.col("text").isNotNull())
    total = items.select(F.sum(F.size(F.split("text", "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"))).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_words))
    out = None
    for b in range(blocks):
        own = [(r["id"], Counter(words(r["text"].encode()))) for r in (items if blocks == 1 else items.where(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == b)).collect()]
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for _, c in own for w in c))}
        posted = materialize(postings(docs, vocabulary, doc_id, text), "postings")
        n_docs, n_words = posted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = dict(posted.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow().to_pandas().itertuples(index=False, name=None))
        weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        asked = [(np.array([vocabulary[w] for w in c], np.int64), np.array(list(c.values()), np.int64)) for _, c in own]
        found = top(posted, asked, weights, n_docs, n_words, k, block_docs)
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc_id"))
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(own)], f"query long, item_id {items.schema['id'].dataType.simpleString()}")
        ranked = found.withColumn("rank", place).where(F.col("rank") <= k).join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        if blocks > 1:
            ranked = materialize(ranked, f"ranked{b}")
            discard(posted)
        out = ranked if out is None else out.unionByName(ranked)
    return out


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL
), sizes AS (SELECT doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sizes),
q AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM benchmark WHERE text IS NOT NULL
  ) GROUP BY ALL
), tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
weights AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
scored AS (
  SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN weights USING (t) JOIN sizes USING (doc_id), total GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
