"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training token windows.

Words: A-Z lower-cased, then runs of letters a-z, digits and non-ASCII characters. A window is ``n`` consecutive
words of an item; an item with fewer words (but some) is one window. Every word of a document inside an occurrence
of a window is hit.

Size bound of the broadcast: the words of the benchmark are counted first. Up to ``block_words`` words make one
block; a larger benchmark is split by a hash of its items into as many blocks as needed. Each block is broadcast
and scanned alone, with the hits written out between blocks, so the result is the same and memory is bounded.

Defined cases: null or empty text has no words and no hits; repeated rows are handled one by one; items that are
null or have no words have no windows; an item with a null id hits words but can't be named; an empty benchmark
hits nothing; extra columns are kept and never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewright.llm.common import materialize, read, text_bytes

N = 10
BLOCK_WORDS = 4_000_000

_WORD_BYTES = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_TABLE = bytes(b if b in _WORD_BYTES else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SPANS = "__tw_spans"
ITEMS = "__tw_items"
WORDS = "__tw_words"


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class WindowSet:
    """Windows of one block of items, with a vocabulary that rules out most positions before any window is built."""

    def __init__(self, items: list[tuple[int | None, str]], n: int):
        self.windows: dict[bytes, set[int | None]] = {}
        lengths = set()
        for item_id, text in items:
            w = words(text.encode())
            if not w:
                continue
            size = min(n, len(w))
            lengths.add(size)
            for i in range(len(w) - size + 1):
                self.windows.setdefault(b" ".join(w[i : i + size]), set()).add(item_id)
        self.lengths = sorted(lengths)
        self.vocabulary = dict.fromkeys((w for x in self.windows for w in x.split()), 1)

    def scan(self, w: list[bytes]) -> tuple[list[int], set[int | None]]:
        """Half-open word spans [start, end, start, end, ...] of all occurrences, and the items they belong to."""
        spans: list[int] = []
        items: set[int | None] = set()
        if not self.lengths or len(w) < self.lengths[0]:
            return spans, items
        get = self.vocabulary.get
        known = np.array([get(x, 0) for x in w], dtype=np.int8)
        breaks = np.concatenate(([-1], np.flatnonzero(known == 0), [len(w)]))
        for k in np.flatnonzero(np.diff(breaks) > self.lengths[0]):
            start, end = int(breaks[k]) + 1, int(breaks[k + 1])
            for size in self.lengths:
                for i in range(start, end - size + 1):
                    found = self.windows.get(b" ".join(w[i : i + size]))
                    if found:
                        items |= found
                        spans += (i, i + size)
        return spans, items


def union_of(spans: list[int]) -> list[int]:
    """The spans merged into disjoint ones in order."""
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (start, end)
    return out


def find(docs: DataFrame, benchmark: DataFrame, *, n: int = N, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with ``__tw_words`` (word count), ``__tw_spans`` (disjoint word spans hit) and ``__tw_items`` (item ids)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    total = items.select(F.sum(F.size(F.split("text", "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"))).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_words))
    schema = T.StructType([*docs.schema.fields, T.StructField(WORDS, T.LongType()), T.StructField(SPANS, T.ArrayType(T.IntegerType())), T.StructField(ITEMS, T.ArrayType(T.LongType()))])
    out = docs
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == b)
        windows = spark.sparkContext.broadcast(WindowSet([(r["id"], r["text"]) for r in part.collect()], n))
        first = b == 0

        def scan(batches: Iterator[pa.RecordBatch], windows=windows, first=first) -> Iterator[pa.RecordBatch]:
            look = windows.value.scan
            for batch in batches:
                counts, spans, found = [], [], []
                before = None if first else (batch.column(SPANS).to_pylist(), batch.column(ITEMS).to_pylist())
                for k, body in enumerate(text_bytes(batch.column(text))):
                    w = words(body) if body else []
                    hit, ids = look(w)
                    if before:
                        hit, ids = hit + before[0][k], ids | set(before[1][k])
                    counts.append(len(w))
                    spans.append(union_of(hit) if hit else hit)
                    found.append(sorted(x for x in ids if x is not None))
                own = batch.columns[: len(batch.columns) - (0 if first else 3)]
                names = batch.schema.names[: len(own)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.int64()))], [*names, WORDS, SPANS, ITEMS])

        out = out.mapInArrow(scan, schema)
        if b + 1 < blocks:
            out = materialize(out, f"block{b}")
    return out


def without_spans(body: bytes, spans: list[int]) -> bytes:
    """The text without the words in the spans and what stands between them; the space around a cut stays once."""
    at = [m.span() for m in _WORD.finditer(body)]
    out, pos = [], 0
    for start, end in zip(spans[::2], spans[1::2], strict=True):
        out.append(body[pos : at[start][0]])
        pos = at[end - 1][1]
    return b"".join([*out, body[pos:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", text: str = "text", **options) -> DataFrame:
    """Drops the documents that hold a window (``remove="documents"``), or cuts the hit words out of their texts
    (``remove="spans"``). Keeps the columns of ``docs`` and every clean document."""
    found = find(docs, benchmark, text=text, **options)
    if remove == "documents":
        return found.where(F.size(SPANS) == 0).drop(WORDS, SPANS, ITEMS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, spans = text_bytes(batch.column(text)), batch.column(SPANS).to_pylist()
            new = [without_spans(b, s).decode() if s else b and b.decode() if b is not None else None for b, s in zip(bodies, spans, strict=True)]
            new = ["" if b == b"" else x for b, x in zip(bodies, new, strict=True)]
            k = batch.schema.get_field_index(text)
            columns = list(batch.columns[:-3])
            columns[k] = pc.cast(pa.array(new, pa.string()), batch.column(text).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-3])

    return found.mapInArrow(cut, docs.schema)


def op10_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, read(spark, sf_dir, "benchmark"))
    ends_less_starts = F.transform(SPANS, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long"))
    n_hit = F.aggregate(ends_less_starts, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return found.select(
        "doc_id",
        F.col(WORDS).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform(ITEMS, lambda x: x.cast("string"))), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(SPANS) > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH tok AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g, least(10, len(w)) AS size
  FROM tok, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM win),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), occ AS (
  SELECT d.doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM doc AS d, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)
), hit AS (SELECT o.doc_id, o.i, o.size, win.item_id FROM occ AS o JOIN win ON win.g = o.g AND win.size = o.size),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + size)) AS u(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(t.s, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc AS d LEFT JOIN covered AS c USING (doc_id) LEFT JOIN items AS t USING (doc_id)
"""
