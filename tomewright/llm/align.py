"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes, and links between tokens.

Tokenizer A is byte-level BPE (a ``tokenizers`` JSON file), B is a sentencepiece model with byte fallback. Both see the
same bytes: a space and the text. The texts of an Arrow batch are joined into one run of bytes with an offset for each
document. The ends of all A tokens and of all B tokens are counted once with ``bincount``; bytes where both end cut the
tokens into groups, bytes where either ends cut the links, because two runs of intervals over the same bytes overlap in
exactly one pair for each piece between two ends. Prefix sums taken at the documents' offsets give each document its
own counts. A batch is worked on in runs of at most ``RUN_CHARS`` characters, or one document where it alone is longer.

How often an id pair is linked is counted over the whole corpus, by documents. Up to ``LOOKUP_ROWS`` distinct pairs the
counts are a sorted table that is broadcast; beyond, the pairs of each document join them. The results are the same.

Defined cases: a null or empty text, and a text whose joined token bytes aren't a space and the text, has no tokens
(zeros, and an empty digest); their strings inside texts make no special tokens; a very long text is aligned whole; each
repeated row is a document of its own and counts; an empty table gives no rows; a null id is kept; extra columns are
kept, but those named like an output column are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tomewright.llm.common import materialize, read

RUN_CHARS = 250_000
LOOKUP_ROWS = 4_000_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes are themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class TokenizerPair:
    """Both tokenizers, built in each worker from the bytes of their files."""

    def __init__(self, a_file: bytes, b_file: bytes, pattern: str | None = None):
        self.state = (a_file, b_file, pattern)
        self._prepare()

    def __getstate__(self) -> tuple:
        return self.state

    def __setstate__(self, state: tuple) -> None:
        self.state = state
        self._prepare()

    def _prepare(self) -> None:
        a_file, b_file, pattern = self.state
        given = json.loads(a_file)["model"]
        alphabet = byte_alphabet()
        entries = {i: bytes(alphabet[c] for c in t) for t, i in given["vocab"].items() if all(c in alphabet for c in t)}
        self.a_bytes = [entries.get(i, b"") for i in range(max(given["vocab"].values()) + 1)]
        # where ids follow the order of merges, merging by the lowest id is merging by the first rule: the fast library applies
        merges = [m.split(" ") if isinstance(m, str) else m for m in given["merges"]]
        made = [given["vocab"]["".join(m)] for m in merges]
        ordered = made == sorted(made) and (not made or made[0] >= 256)
        self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks={entries[i]: i for i in [*range(256), *made]}, special_tokens={}) if pattern and ordered else None
        self.slow = None if self.fast else Tokenizer.from_str(a_file.decode())
        if self.slow:
            self.slow.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytewise = [re.fullmatch("<0x([0-9A-F]{2})>", p) for p in pieces]
        self.b_bytes = [bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for p, m in zip(pieces, bytewise, strict=True)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int32)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int32)
        va, vb = len(self.a_bytes), len(self.b_bytes)
        #: What a token adds to the written groups: A inside a group, A at its end, B inside, B at its end.
        self.written = [f"{i}," for i in range(va)] + [f"{i}|" for i in range(va)] + [f"{i}," for i in range(vb)] + [f"{i};" for i in range(vb)]

    def encode(self, text: str | None) -> tuple[list[int], list[int], int]:
        """The ids of a text by A and by B, and how many bytes they cover; none unless both give back its bytes."""
        if not text:
            return [], [], 0
        spaced = " " + text
        a = self.fast.encode_ordinary(spaced) if self.fast else self.slow.encode(spaced, add_special_tokens=False).ids
        b = self.b.encode(text)
        body = spaced.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != body or b"".join(map(self.b_bytes.__getitem__, b)) != body:
            return [], [], 0
        return a, b, len(body)

    def align(self, texts: list[str | None]) -> dict:
        """Arrays over all texts of a run. ``x_at`` are the documents' offsets into the arrays of kind x."""
        found = [self.encode(t) for t in texts]
        at = lambda sizes: np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))
        a_at, b_at, byte_at = at([len(f[0]) for f in found]), at([len(f[1]) for f in found]), at([f[2] for f in found])
        a = np.fromiter((i for f in found for i in f[0]), np.int64, a_at[-1])
        b = np.fromiter((i for f in found for i in f[1]), np.int64, b_at[-1])
        del found
        a_end, b_end = np.cumsum(self.a_sizes[a], dtype=np.int64), np.cumsum(self.b_sizes[b], dtype=np.int64)
        a_here = np.bincount(a_end, minlength=byte_at[-1] + 1).astype(np.int32)
        b_here = np.bincount(b_end, minlength=byte_at[-1] + 1).astype(np.int32)
        cut = a_here & b_here
        cuts, a_ends, b_ends = np.cumsum(cut, dtype=np.int32), np.cumsum(a_here, dtype=np.int32), np.cumsum(b_here, dtype=np.int32)
        group_at = cuts[byte_at]
        link_end = np.flatnonzero(a_here | b_here)
        link_at = np.searchsorted(link_end, byte_at, "right")
        return {
            "a": a, "b": b, "a_at": a_at, "b_at": b_at, "a_group": cuts[a_end - 1], "b_group": cuts[b_end - 1], "a_last": cut[a_end], "b_last": cut[b_end],
            "group_at": group_at, "link_at": link_at, "link_a": a[a_ends[link_end - 1]], "link_b": b[b_ends[link_end - 1]],
        }

    def digests(self, r: dict) -> list[str]:
        """Of each document, the digest of its written groups."""
        groups = int(r["group_at"][-1])
        b_before = np.concatenate(([0], np.cumsum(np.bincount(r["b_group"], minlength=groups))))
        a_before = np.concatenate(([0], np.cumsum(np.bincount(r["a_group"], minlength=groups))))
        va, vb = len(self.a_bytes), len(self.b_bytes)
        codes = np.empty(len(r["a"]) + len(r["b"]), np.int64)
        codes[np.arange(len(r["a"])) + b_before[r["a_group"]]] = r["a"] + va * r["a_last"]
        codes[np.arange(len(r["b"])) + a_before[r["b_group"] + 1]] = r["b"] + 2 * va + vb * r["b_last"]
        at, get, out = r["a_at"] + r["b_at"], self.written.__getitem__, []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            out.append(hashlib.sha256("".join(map(get, codes[lo:hi].tolist()))[:-1].encode()).hexdigest() if hi > lo else "")
        return out

    def pairs(self, r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs (a * size of B + b) of each document with their numbers of links, and the documents' offsets."""
        n = len(r["link_at"]) - 1
        space = len(self.a_bytes) * len(self.b_bytes)
        doc = np.repeat(np.arange(n), np.diff(r["link_at"]))
        keys, times = np.unique(doc * space + r["link_a"] * len(self.b_bytes) + r["link_b"], return_counts=True)
        return keys % space, times, np.searchsorted(keys, np.arange(n + 1) * space)


def tokenizer_pair(a_path: str, b_path: str, pattern: str | None) -> TokenizerPair:
    """From two files, read on the driver; vocabularies are small and sent to the executors."""
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        return TokenizerPair(a.read(), b.read(), pattern)


def runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Cuts a batch into runs of rows of bounded length."""
    start = size = 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if k > start and size + n > RUN_CHARS:
            yield start, k
            start, size = k, 0
        size += n
    yield start, len(texts)


def _lists(at: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(at.astype(np.int32), pa.array(values, kind))


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str | None = None, *, text: str = "text", digest: bool = False, pairs: bool = False, groups: bool = True) -> DataFrame:
    """docs with n_a, n_b, n_groups, n_links and, as asked, the groups (arrays ``a_ids``, ``b_ids``, and in ``a_ends`` and
    ``b_ends`` how many of them each group has reached), ``groups_sha256``, ``pairs`` with ``times``.

    pattern: how A splits text, for the library that is used where A's ids follow its merges; without it the file's own
    rules split."""
    spark = docs.sparkSession
    own = tokenizer_pair(a_path, b_path, pattern)
    sent = spark.sparkContext.broadcast(own)
    wide = len(own.a_bytes) * len(own.b_bytes) >= 1 << 31
    code, code_type = (T.LongType(), pa.int64()) if wide else (T.IntegerType(), pa.int32())
    ints = T.ArrayType(T.IntegerType())
    fields = [T.StructField(c, T.LongType()) for c in COUNTS]
    fields += [T.StructField("groups_sha256", T.StringType())] * digest
    fields += [T.StructField("pairs", T.ArrayType(code)), T.StructField("times", ints)] if pairs else []
    fields += [T.StructField(c, ints) for c in ("a_ids", "b_ids", "a_ends", "b_ends")] if groups else []
    rows = docs.drop(*(f.name for f in fields))
    at, names = rows.columns.index(text), [*rows.columns, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = sent.value
        for whole in batches:
            for start, end in runs(whole.column(at).to_pylist()):
                batch = whole.slice(start, end - start)
                r = pair.align(batch.column(at).to_pylist())
                made = [pa.array(np.diff(r[k]).astype(np.int64)) for k in ("a_at", "b_at", "group_at", "link_at")]
                if digest:
                    made.append(pa.array(pair.digests(r), pa.string()))
                if pairs:
                    codes, times, offsets = pair.pairs(r)
                    made += [_lists(offsets, codes, code_type), _lists(offsets, times, pa.int32())]
                if groups:
                    ends = [np.flatnonzero(r[f"{x}_last"]) + 1 - np.repeat(r[f"{x}_at"][:-1], np.diff(r["group_at"])) for x in "ab"]
                    made += [_lists(r["a_at"], r["a"], pa.int32()), _lists(r["b_at"], r["b"], pa.int32()), *(_lists(r["group_at"], e, pa.int32()) for e in ends)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *fields]))


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (whether n is the highest of the pair's A id)."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    highest = F.max("n").over(Window.partitionBy(F.expr(f"pair div {size_b}")))  # an A id has at most size_b pairs
    return counted.select("pair", "n", (F.col("n") == highest).alias("best"))


def with_links(aligned: DataFrame, counts: DataFrame, *, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """aligned with n_best (links whose pair is the best of its A id) and count_sum (counts of all links), without pairs."""
    spark = aligned.sparkSession
    rest = [c for c in aligned.columns if c not in ("pairs", "times", "n_best", "count_sum")]
    if counts.count() > lookup_rows:
        keyed = aligned.drop("n_best", "count_sum").withColumn("__tw_row", F.expr("uuid()"))
        keyed = materialize(keyed, "keyed")
        links = keyed.select("__tw_row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("__tw_row", "x.pairs", "x.times")
        joined = links.join(counts, F.col("pairs") == F.col("pair"))
        sums = joined.groupBy("__tw_row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
        return keyed.join(sums, "__tw_row", "left").select(*rest, zero("n_best"), zero("count_sum"))
    table = counts.orderBy("pair").toArrow()
    sent = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))
    schema = T.StructType([*(aligned.schema[c] for c in rest), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = sent.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            places = np.searchsorted(known, lists.flatten().to_numpy())
            sums = [np.concatenate(([0], np.cumsum(v * times, dtype=np.int64))) for v in (best[places], n[places])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *(pa.array(s[at[1:]] - s[at[:-1]]) for s in sums)], schema.names)

    return aligned.mapInArrow(run, schema)


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    own = align(docs, a, b, public_tokenizers.PATTERN, digest=True, pairs=True, groups=False).drop("text")
    aligned = materialize(own, "aligned")
    counts = materialize(pair_counts(aligned, sentencepiece.SentencePieceProcessor(model_file=b).get_piece_size()), "pair_counts")
    return with_links(aligned, counts).select("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")
