"""Byte-level BPE encoding and decoding with given ranks.

A text is split by the vocabulary's pattern; each match is merged alone. Merging keeps the parts of a match in a
linked list by position and a queue over merge ranks: a bucket of positions for each rank, and a bitmap in three
levels of 64-bit words over the ranks, where find-first-set gives the lowest rank that is waiting. Entries that a
neighbouring merge made stale are skipped when they come up. So a match of n bytes costs O(n log n), however long.
Merged matches of at most ``KEPT_CHARS`` characters are kept in two dictionaries of bounded size: when the young one is full
it becomes the old one, and what is met again moves back (results don't depend on it).

Defined cases: null text is encoded like the empty text (no ids); special tokens are ordinary text; texts above
``STREAM_CHARS`` are matched one by one instead of all at once; repeated rows are encoded one by one; an empty table gives
no rows; extra columns are kept, but one named like an output column is replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tomewright.llm.common import read

KEPT, KEPT_CHARS = 400_000, 64
#: In the pipeline, where executors have the stages before behind them.
STAGE_KEPT = 150_000
STREAM_CHARS = 2_000_000
STEP = 256


class RankQueue:
    """Positions by merge rank; pop gives the lowest rank's lowest position."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.middle = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        k = rank >> 6
        if not self.low[k]:
            self.middle[k >> 6] |= 1 << (k & 63)
            self.top |= 1 << (k >> 6)
        self.low[k] |= 1 << (rank & 63)

    def pop(self) -> tuple[int, int]:
        m = (self.top & -self.top).bit_length() - 1
        word = self.middle[m]
        k = m << 6 | (word & -word).bit_length() - 1
        word = self.low[k]
        rank = k << 6 | (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        word &= word - 1
        self.low[k] = word
        if not word:
            self.middle[m] &= self.middle[m] - 1
            if not self.middle[m]:
                self.top &= self.top - 1
        return rank, bucket[0]


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, kept: int = KEPT):
        self.ranks, self.pattern, self.kept = ranks, pattern, kept
        self._prepare()

    def _prepare(self) -> None:
        self.tokens = {v: k for k, v in self.ranks.items()}
        self.numerals = {v: str(v) for v in self.tokens}
        self.longest = max(map(len, self.ranks), default=0)
        self.queue = RankQueue(max(self.tokens, default=0))
        self.split = regex.compile(self.pattern)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "pattern": self.pattern, "kept": self.kept}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._prepare()

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one match."""
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return (whole,)
        n, longest = len(piece), self.longest
        push, pop, queue = self.queue.push, self.queue.pop, self.queue
        after = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n))  # where the part to the left starts
        waits: list[int | None] = [get(piece[i : i + 2]) for i in range(n - 1)]
        for i, rank in enumerate(waits):
            if rank is not None:
                push(rank, i)
        waits.append(None)
        while queue.top:
            rank, i = pop()
            if waits[i] != rank:
                continue
            j = after[i]
            end = after[i] = after[j]
            before[end] = i
            waits[i] = waits[j] = None
            if end < n and after[end] - i <= longest:
                new = waits[i] = get(piece[i : after[end]])
                if new is not None:
                    push(new, i)
            p = before[i]
            if p >= 0:
                new = waits[p] = get(piece[p:end]) if end - p <= longest else None
                if new is not None:
                    push(new, p)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        cache, old, out = self.cache, self.old, []
        for piece in self.split.findall(text) if len(text) <= STREAM_CHARS else (m[0] for m in self.split.finditer(text)):
            ids = cache.get(piece)
            if ids is None:
                if len(cache) >= self.kept:
                    self.old, self.cache = cache, {}
                    cache, old = self.cache, cache
                ids = old.get(piece)
                if ids is None:
                    ids = self.merge(piece.encode())
                if len(piece) <= KEPT_CHARS:
                    cache[piece] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def codec(path: str, pattern: str, kept: int = KEPT) -> Codec:
    """From a file of lines ``base64 rank``, read on the driver; a vocabulary is small and sent to the executors."""
    with open(path, "rb") as f:
        return Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}, pattern, kept)


def encode(docs: DataFrame, path: str, pattern: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with an array of ids in column ``ids``."""
    own = docs.drop(ids)
    sent = docs.sparkSession.sparkContext.broadcast(codec(path, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sent.value.encode(t or "") for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.list_(pa.int32()))], [*batch.schema.names, ids])

    return own.mapInArrow(run, T.StructType([*own.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, path: str, pattern: str, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """rows with the bytes of their ids, as UTF-8 text where valid, in column ``text``."""
    own = rows.drop(text)
    sent = rows.sparkSession.sparkContext.broadcast(codec(path, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if x is None else sent.value.decode(x).decode("utf-8", "replace") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*batch.schema.names, text])

    return own.mapInArrow(run, T.StructType([*own.schema.fields, T.StructField(text, T.StringType())]))


def round_trip_digests(docs: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes in one pass: doc_id, n_tokens, and the digests of the ids and of the decoded bytes."""
    sent = docs.sparkSession.sparkContext.broadcast(codec(path, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            counts, ids_digests, text_digests = [], [], []
            for t in batch.column(1).to_pylist():
                ids = own.encode(t or "")
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(" ".join(map(own.numerals.__getitem__, ids)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(text_digests)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def stage(docs: DataFrame) -> DataFrame:
    """docs without their texts, with the ids of these (``ids``), their number and the digest of what they decode to."""
    import public_tokenizers

    own = codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, STAGE_KEPT)
    sent = docs.sparkSession.sparkContext.broadcast(own)
    kept = [c for c in docs.columns if c not in ("text", "ids", "n_tokens", "decoded_sha256")]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, STEP):
                batch = whole.slice(start, STEP)
                made, digests = [], []
                for t in batch.column("text").to_pylist():
                    made.append(np.array(sent.value.encode(t or ""), np.int32))
                    digests.append(hashlib.sha256(sent.value.decode(made[-1].tolist())).hexdigest())
                sizes = np.array([len(x) for x in made])
                ids = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), np.concatenate(made))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), ids, pa.array(sizes), pa.array(digests)], schema.names)

    return docs.mapInArrow(run, schema)
