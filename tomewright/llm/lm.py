"""LM scoring with a causal self-attention model on subword ids, trained in numpy.

Words (A-Z lower-cased, split at ASCII white space) are joined by single spaces, with one before, and encoded once by a
byte-level BPE vocabulary; a text is its ids and one end. All later passes read the ids.

The model is one causal attention layer with relative positions. A position's key is made of its own and the previous
id, so that attention finds earlier places after the same id. What attention gives goes with the position's own
embedding through a hidden layer; the next id's class comes from a two-level softmax (``GROUPS`` groups of ``MEMBERS``
classes), and the id from its class. The most frequent ids are classes of their own; the rare ones share ``TAILS``
classes by their counts. Probabilities of all ids sum to one, and a text's score is the sum over its ids.

Texts are cut into windows of ``WINDOW`` ids. Each repeats the last ``OVERLAP`` ids of the one before as context, so
every id is scored once, in batches of windows with one causal mask; the first window of a text has nothing before it.

Learning reads every id of every training document: word counts, id counts and counts of classes after ids are sums
over all of them. The counts give the embeddings and output weights they start from (a weighted decomposition of log
probabilities) and the groups. Then texts are dealt to shards of about ``SHARD_IDS`` ids by their hash, so there are as many as
the corpus asks for; gradient steps go over all windows of a shard in order of the hash, and the shards' weights are
averaged by ids seen, piece by piece, over at most ``FAN`` of them at a time. The same texts give the same model however
the table is cut.

A word is known by a 64-bit hash of its ids (encoding is reversible); two of n words share one with a chance of about
n * n / 4e19. The words that are broadcast are those of the highest counts, at most ``WORDS``; counts of all other
words are joined by shuffle, so base scores and known words cover all. Vocabulary and weights have a fixed size.

Defined cases: null text is the empty text (only an end); very long texts are windows like all others; a null id is not
held out; repeated rows are scored alike; an empty training set gives N = V = 0, base scores of 0 for each token and an
untrained model; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import discard, materialize, read, text_bytes

WORDS = 262_144
WINDOW, OVERLAP = 24, 8
SCORED = WINDOW - OVERLAP
EMBED, WIDTH, HIDDEN = 16, 8, 16
GROUPS, MEMBERS, TAILS = 16, 32, 16
CLASSES = GROUPS * MEMBERS
OWN = 2048
ROWS = OWN + TAILS
BATCH, SCORE_BATCH = 192, 512
LEAN = 4.0
FAN, PIECE = 64, 8192
SHARD_IDS, STEP_IDS = 16_000_000, 500_000
RATE = 0.06
SLICE = 1_000_000
KEPT = 700_000
#: Ranges of words (a power of two up to 65 536) whose counts are added up together.
RANGES = 4096
_LN10 = math.log(10)
_OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def words_of(body: bytes | None) -> list[bytes]:
    return body.lower().split() if body else []


class _Places(dict):
    """Places of words in order of appearance; ``new`` lists those that were not there before."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n


class _Grown:
    """An array that grows at its end, in room that is doubled when it is used up."""

    def __init__(self, kind: type):
        self.room, self.size = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        size = self.size + len(more)
        if size > len(self.room):
            self.room = np.concatenate([self.room[: self.size], np.zeros(2 * size - self.size, self.room.dtype)])
        self.room[self.size : size] = more
        self.size = size


class Subwords:
    """Ids of texts by given ranks; the end of a text has the id after the last."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.end = max(ranks.values(), default=-1) + 1
        if self.end > 0xFFFF:
            raise ValueError("ids are kept in two bytes: at most 65535 of them and the end")
        self.encoding = None
        self.starts = np.zeros(self.end + 1, bool)  # ids that begin a word
        for token, i in ranks.items():
            self.starts[i] = token[:1] == b" "

    def __getstate__(self) -> dict:
        return self.__dict__ | {"encoding": None}

    def clear(self) -> None:
        """Forgets all words, as is to be done whenever ``KEPT`` are held."""
        if self.encoding is None:
            self.encoding = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.place = _Places()
        self.begin, self.size, self.hashes, self.bank = _Grown(np.int64), _Grown(np.int64), _Grown(np.int64), _Grown(np.uint16)

    def _encode(self, words: list[bytes]) -> np.ndarray:
        text = (b" " + b" ".join(words)).decode("utf-8", "replace")
        if _OTHER_SPACE.search(text):
            return np.array([i for w in words for i in self.encoding.encode_ordinary(" " + w.decode("utf-8", "replace"))])
        return np.array(self.encoding.encode_ordinary(text))

    def __call__(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts' words, each with a space before, and an end after each text; and their offsets. Words are
        kept in a dictionary, with their hashes; new ones are encoded together; ``k`` holds the places of the texts' words in it, -1 for ends."""
        if self.encoding is None:
            self.clear()
        k = np.fromiter(map(self.place.__getitem__, itertools.chain.from_iterable(texts)), np.int64)
        self.k = k = np.insert(k, np.cumsum([len(t) for t in texts]), -1)
        new, self.place.new = self.place.new, []
        if new:
            ids = self._encode(new)
            begin = np.flatnonzero(self.starts[ids])
            self.begin.add(begin + self.bank.size)
            self.size.add(np.diff(np.append(begin, len(ids))))
            self.hashes.add(word_hashes(ids, self.starts, self.end))
            self.bank.add(ids)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        size, begin = self.size.room[k], self.begin.room[k]
        size[ends], begin[ends] = 1, 0  # an id for each end, which is set below
        at = np.concatenate(([0], np.cumsum(size)))
        out = self.bank.room[np.repeat(begin - at[:-1], size) + np.arange(at[-1])]
        out[at[ends]] = self.end
        return out, np.concatenate(([0], at[ends + 1]))


def subwords(path: str, pattern: str) -> Subwords:
    with open(path, "rb") as f:
        return Subwords({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)


def word_hashes(ids: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    """A hash for each word of the ids of texts that follow one another; ends are no words."""
    ids = ids[ids != end]
    first = np.flatnonzero(starts[ids])
    if not len(first):
        return np.zeros(0, np.int64)
    place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    x = np.add.reduceat(x ^ (x >> np.uint64(31)), first)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def encoded(docs: DataFrame, tokens: Subwords) -> DataFrame:
    """One row for each document (key, doc_id, held_out, ids of two bytes each) and, in the same pass, rows of sums over
    training documents: words and counts (eight and four bytes each) of some documents, and the counts of all ids."""
    sent = docs.sparkSession.sparkContext.broadcast(tokens)
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    names = ["key", "doc_id", "held_out", "ids", "words", "times", "totals"]

    def rows(**columns: pa.Array) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds, strict=True)], names)

    packed = lambda a, kind: pa.array([a.astype(kind).tobytes()], pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, key = sent.value, TaskContext.get().partitionId() << 40
        total, times = np.zeros(own.end + 1, np.int64), np.zeros(0, np.int64)
        if own.encoding is None:  # a worker keeps the words of the tasks before
            own.clear()

        def summed() -> pa.RecordBatch:
            some = np.flatnonzero(times)
            words, n = own.hashes.room[some], times[some]
            part = words & (RANGES - 1)
            order = np.argsort(part.astype(np.uint16), kind="stable")
            words, n, part = words[order], n[order].astype(np.int32), part[order]
            cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            lists = lambda a: pa.array([a[i:j].tobytes() for i, j in itertools.pairwise(cuts.tolist())], pa.binary())
            return rows(key=pa.array(part[cuts[:-1]]), words=lists(words), times=lists(n))

        for batch in batches:
            held, bodies = batch.column(1).to_numpy(zero_copy_only=False).astype(bool), text_bytes(batch.column(2))
            cuts = np.searchsorted(np.cumsum([len(b or b"") for b in bodies]), np.arange(SLICE, sum(len(b or b"") for b in bodies), SLICE)).tolist()
            for i, j in itertools.pairwise(sorted({0, *cuts, len(bodies)})):
                if len(own.place) >= KEPT:
                    if times.any():
                        yield summed()
                    own.clear()
                    times = np.zeros(0, np.int64)
                texts = [words_of(b) for b in bodies[i:j]]
                flat, offsets = own(texts)
                total += np.bincount(flat[np.repeat(~held[i:j], np.diff(offsets))], minlength=len(total))
                learnt = own.k[np.repeat(~held[i:j], [len(t) + 1 for t in texts])]
                more = np.bincount(learnt[learnt >= 0], minlength=len(own.place))
                more[: len(times)] += times
                times = more
                ids = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(offsets * 2), pa.py_buffer(flat)]).cast(pa.binary())
                yield rows(key=pa.array(np.arange(key, key + j - i)), doc_id=batch.column(0)[i:j], held_out=batch.column(1)[i:j], ids=ids)
                key += j - i
        if times.any():
            yield summed()
        if total.any():
            yield rows(totals=packed(total, np.int64))

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "key long, doc_id long, held_out boolean, ids binary, words binary, times binary, totals binary")


def merged(rows: DataFrame) -> DataFrame:
    """word, n: the sums of packed counts. All rows of a range of words (``key``) meet in one partition, where they are added up as
    they come; what is held at once are the distinct words of its ranges."""

    def add(words: list[np.ndarray], times: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        w, n = np.concatenate(words), np.concatenate(times)
        order = np.argsort(w)
        w, n = w[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        return [w[first]], [np.add.reduceat(n, first)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, times, fresh = [], [], 0
        for batch in batches:
            for w, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words.append(np.frombuffer(w, np.int64))
                times.append(np.frombuffer(n, np.int32).astype(np.int64))
                fresh += len(words[-1])
                if fresh > max(SLICE, 2 * len(words[0])):
                    words, times = add(words, times)
                    fresh = 0
        if words:
            (w,), (n,) = add(words, times)
            for i in range(0, len(w), SLICE):
                yield pa.RecordBatch.from_arrays([pa.array(w[i : i + SLICE]), pa.array(n[i : i + SLICE])], ["word", "n"])

    return rows.repartition("key").mapInArrow(run, "word long, n long")


def unpacked(rows: DataFrame) -> DataFrame:
    """key, word, n: a row for each of the packed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, words, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, times = np.frombuffer(words, np.int64), np.frombuffer(times, np.int32)
                for i in range(0, len(words), SLICE):
                    part = words[i : i + SLICE]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), key or 0)), pa.array(part), pa.array(times[i : i + SLICE].astype(np.int64))], ["key", "word", "n"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for part in run(batches):
            waiting.append(part)
            n += part.num_rows
            if n >= 50_000:
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting, n = [], 0
        if n:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]

    return rows.mapInArrow(joined, "key long, word long, n long")


def id_counts(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of the packed counts of all ids: a vector of fixed size for each task, summed in groups of FAN."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["totals"])

    while rows.count() > FAN:
        rows = materialize(rows.repartition(max(1, rows.count() // FAN)).mapInArrow(add, "totals binary"), "totals")
    return sum((np.frombuffer(bytes(r["totals"]), np.int64) for r in rows.collect()), np.zeros(size, np.int64))


class Places:
    """Places of hashes in a sorted list, by their leading bits: most hashes meet at most one of the list."""

    def __init__(self, known: np.ndarray, bits: int = 20):
        self.known, self.shift = known, np.uint64(64 - bits)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(self._lead(known), minlength=1 << bits))))

    def _lead(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes.view(np.uint64) ^ np.uint64(1 << 63)) >> self.shift).astype(np.int64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 where the list doesn't have it."""
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.known):
            return out
        lead = self._lead(hashes)
        at, stop = self.first[lead], self.first[lead + 1]
        todo = np.arange(len(hashes))
        while len(todo):
            on = at < stop
            todo, at, stop = todo[on], at[on], stop[on]
            hit = self.known[at] == hashes[todo]
            out[todo[hit]] = at[hit]
            rest = ~hit
            todo, at, stop = todo[rest], at[rest] + 1, stop[rest]
        return out


def most_frequent(counts: DataFrame, most: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order, and counts, of all words from the lowest count on that leaves at most ``most`` of them (counts are
    cut at eighths of a power of two)."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = {r["s"]: r["c"] for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("c")).collect()}
    total, least = 0, None
    for s in sorted(sizes, reverse=True):
        total += sizes[s]
        if total > most:
            break
        least = s
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    got = counts.where(step >= least).select("word", "n").toArrow()
    word, n = got.column("word").to_numpy(), got.column("n").to_numpy()
    order = np.argsort(word)
    return word[order], n[order]


class Layout:
    """Class, share in the class, and embedding row of every id, and the group and place of every class."""

    def __init__(self, counts: np.ndarray, tokens: Subwords):
        order = np.argsort(-counts, kind="stable")
        size, heads = len(counts), CLASSES - TAILS
        own = np.empty(size, np.int64)
        own[order] = np.arange(size)
        plain = np.ones(size, bool)
        for token, i in tokens.ranks.items():
            plain[i] = max(token) < 128
        band = np.clip(np.log2(np.maximum(own, heads) / heads).astype(int), 0, TAILS // 4 - 1)
        tail = band * 4 + tokens.starts * 2 + plain
        self.kind = np.where(own < heads, own, heads + tail).astype(np.int32)
        mass = np.bincount(self.kind, counts + 0.5, CLASSES)
        self.log_share = (np.log(counts + 0.5) - np.log(mass[self.kind])).astype(np.float32)
        self.row = np.where(own < OWN, own, OWN + tail).astype(np.int32)
        self.mass = mass
        self.place_classes(np.arange(CLASSES))

    def place_classes(self, order: np.ndarray) -> None:
        """Classes in this order fill the groups."""
        at = np.empty(CLASSES, np.int64)
        at[order] = np.arange(CLASSES)
        self.order, self.leaf = order, at[self.kind].astype(np.int32)


def pair_counts(rows: DataFrame, layout: Layout, end: int) -> np.ndarray:
    """How often each class follows each embedding row, over all texts; the table has a fixed size."""
    sent = rows.sparkSession.sparkContext.broadcast(layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = sent.value, np.zeros(ROWS * CLASSES, np.int64)
        for batch in batches:
            for flat, offsets in slices(batch.column(0)):
                before = np.empty_like(flat)
                before[1:] = flat[:-1]
                before[offsets[:-1]] = end
                total += np.bincount(own.row[before].astype(np.int64) * CLASSES + own.kind[flat], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["cell", "n"])

    out = np.zeros(ROWS * CLASSES, np.int64)
    got = rows.select("ids").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(ROWS, CLASSES)


def slices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of a binary column of ids: the ids of about SLICE at a time, whole texts, and the offsets of the texts."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    flat = np.frombuffer(column.buffers()[2], np.uint16, offset=0) if len(column) else np.zeros(0, np.uint16)
    offsets, start = offsets // 2, 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE, "right")) - 1)
        yield flat[offsets[start] : offsets[stop]].astype(np.int32), offsets[start : stop + 1] - offsets[start]
        start = stop


def bisected(vectors: np.ndarray, items: np.ndarray, size: int) -> list[np.ndarray]:
    """Items in groups of the same size: halved along the leading direction again and again."""
    if len(items) <= size:
        return [items]
    own = vectors[items] - vectors[items].mean(axis=0)
    order = np.argsort(own @ np.linalg.eigh(own.T @ own)[1][:, -1], kind="stable")
    half = len(items) // 2
    return [*bisected(vectors, items[order[:half]], size), *bisected(vectors, items[order[half:]], size)]


def _exp(z: np.ndarray, *parts: np.ndarray) -> None:
    """exp in place. Where numbers are large, each row (of each part that is normalised by itself) is first taken less its largest,
    so nothing overflows and ratios stay."""
    if z.max() > 60:
        for part in parts or (z,):
            part -= part.max(axis=-1, keepdims=True)
    np.exp(z, out=z)


class Model:
    """One layer of causal self-attention and a two-level softmax. Set up from the counts of classes after rows."""

    def __init__(self, layout: Layout, pairs: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        made = lambda *shape: (rng.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)
        self.layout = layout
        used = np.bincount(layout.kind, minlength=CLASSES) > 0
        share = np.where(used, layout.mass + 0.5, 1e-30)
        share /= share.sum()
        weight = np.sqrt(pairs.sum(axis=1) + 1e-3)[:, None]
        chance = (pairs + LEAN * share) / (pairs.sum(axis=1, keepdims=True) + LEAN)
        lift = weight * np.log(chance / share)
        axes = np.linalg.eigh(lift.T @ lift)[1][:, -8:]
        layout.place_classes(np.concatenate(bisected(lift.T @ (lift @ axes) / np.sqrt(share)[:, None] * share[:, None], np.arange(CLASSES), MEMBERS)))
        share, used = share[layout.order].reshape(GROUPS, MEMBERS), used[layout.order].reshape(GROUPS, MEMBERS)
        chance = chance[:, layout.order].reshape(ROWS, GROUPS, MEMBERS)
        by_group = chance.sum(axis=2)
        inside = np.log(chance / by_group[:, :, None]) - np.log(share / share.sum(axis=1, keepdims=True))
        table = np.concatenate([np.log(by_group) - np.log(share.sum(axis=1)), (inside * used).reshape(ROWS, CLASSES)], axis=1)
        scale = np.concatenate([np.ones(GROUPS), np.sqrt(share.ravel() + 1e-6)])  # a rare class matters less
        value, axes = np.linalg.eigh((weight * table * scale).T @ (weight * table * scale))
        axes = axes[:, -EMBED:] / scale[:, None]
        embed = table * scale @ (axes * scale[:, None])
        norm = np.sqrt((embed * embed).mean(axis=0)) + 1e-6
        embed, axes = embed / norm, axes * norm
        blank = np.concatenate([~used.any(axis=1), ~used.ravel()])
        direct = np.concatenate([np.log(by_group), np.log(chance / by_group[:, :, None]).reshape(ROWS, CLASSES)], axis=1)
        direct[:, blank] = -1e4
        # a line for each row and group: the groups after the row, and the group's members after the row
        self.direct = np.concatenate([np.repeat(direct[:, :GROUPS], GROUPS, axis=0), direct[:, GROUPS:].reshape(-1, MEMBERS)], axis=1).astype(np.float32)
        self.p = {
            "embed": embed.astype(np.float32),
            "q": made(EMBED, WIDTH), "k": np.concatenate([0.3 * made(EMBED, WIDTH), np.zeros((EMBED, WIDTH), np.float32)]), "v": made(EMBED, WIDTH),
            "far": np.linspace(0, -2, WINDOW).astype(np.float32),
            "mix": np.concatenate([made(EMBED + WIDTH, HIDDEN), np.zeros((1, HIDDEN), np.float32)]),
            "group": 0.02 * made(HIDDEN + 1, GROUPS), "inside": 0.02 * np.stack([made(HIDDEN + 1, MEMBERS) for _ in range(GROUPS)]),
        }
        self.p["k"][EMBED:] = self.p["q"]  # a query starts out near the places after its own id
        self.speed = None
        self.distance = OVERLAP + np.arange(SCORED)[:, None] - np.arange(WINDOW)[None, :]
        self.near = np.clip(self.distance, 0, WINDOW - 1)
        self.later = np.where(self.distance >= 0, 0, -1e4)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"speed": None}

    def _firsts(self) -> dict[str, np.ndarray]:
        """What a place's own embedding is multiplied by for keys (its own and the next place's), values, queries and the hidden layer."""
        p = self.p
        return {"k": p["k"][:EMBED], "next": p["k"][EMBED:], "v": p["v"], "q": p["q"] * np.float32(1 / math.sqrt(WIDTH)), "mix": p["mix"][:EMBED]}

    def looks(self) -> dict[str, np.ndarray]:
        """These products for each embedding row, made once for the batches of a model that doesn't change."""
        return {name: self.p["embed"] @ w for name, w in self._firsts().items()}

    def run(
        self, x: np.ndarray, starts: np.ndarray, before: np.ndarray, first: np.ndarray, y: np.ndarray, used: np.ndarray | None = None, looks: dict[str, np.ndarray] | None = None, told: bool = True
    ) -> tuple:
        """Log probabilities of y, the ids after the last SCORED places of each window. x holds OVERLAP ids and then
        SCORED for each window, so windows overlap in it; starts: places of x that don't follow the one before them, the last of them 0, and the
        ids before those; first: windows with nothing before their own places. With ``used``, also the gradients of the mean loss over the used targets,
        and the loss itself if it is to be ``told``."""
        p, lay, n, N = self.p, self.layout, len(first), len(y)
        kind, inner = p["embed"].dtype, starts[:-1]
        r, outside = lay.row.take(x), p["embed"].take(lay.row.take(before), 0)
        if looks is None:
            e, by = p["embed"].take(r, 0), self._firsts()
            k, past, v, q, hidden = e @ by["k"], e @ by["next"], e @ by["v"], e[OVERLAP:] @ by["q"], e[OVERLAP:] @ by["mix"]
        else:
            k, past, v, q, hidden = (looks[c].take(at, 0) for c, at in (("k", r), ("next", r), ("v", r), ("q", r[OVERLAP:]), ("mix", r[OVERLAP:])))
        alone = k[starts]
        k[1:] += past[:-1]
        k[starts] = alone + outside @ p["k"][EMBED:]
        windows = lambda a: np.ndarray((n, WINDOW, WIDTH), kind, a, strides=(SCORED * a.strides[0], *a.strides))
        kw, vw, q = windows(k), windows(v), q.reshape(n, SCORED, WIDTH)
        a = q @ kw.transpose(0, 2, 1)
        a += p["far"][self.near] + self.later.astype(kind)
        a[first, :, :OVERLAP] = -1e4  # what stands before is another text
        _exp(a)
        inverse = 1 / (a.reshape(N, WINDOW) @ np.ones((WINDOW, 1), kind))
        seen = (a @ vw).reshape(N, WIDTH)
        seen *= inverse
        hidden += seen @ p["mix"][EMBED:-1]
        by_window = hidden.reshape(n, SCORED * HIDDEN)
        by_window += p["mix"][-1:].repeat(SCORED, 0).ravel()
        # from here on in order of the targets' groups
        leaf = lay.leaf.take(y)
        group = leaf // MEMBERS
        order = np.argsort(group.astype(np.uint8), kind="stable")
        back = np.empty(N, np.int64)
        back[order] = np.arange(N)
        leaf, group, last, hidden = leaf.take(order), group.take(order), r[OVERLAP:].take(order), hidden.take(order, 0)
        ends = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
        spans = [(g, i, j) for g, (i, j) in enumerate(itertools.pairwise(ends)) if i < j]
        f = np.empty((N, HIDDEN + 1), kind)
        np.maximum(hidden, 0, out=f[:, :HIDDEN])
        f[:, HIDDEN] = 1
        z, heads = np.empty((N, GROUPS + MEMBERS), kind), np.empty((GROUPS, HIDDEN + 1, GROUPS + MEMBERS), kind)
        heads[:, :, :GROUPS], heads[:, :, GROUPS:] = p["group"], p["inside"]
        for g, i, j in spans:
            np.matmul(f[i:j], heads[g], out=z[i:j])
        z += self.direct.take(last * GROUPS + group, 0)
        _exp(z, z[:, :GROUPS], z[:, GROUPS:])
        parts = z.reshape(N, -1, GROUPS)  # the groups, and the members in parts as long
        sums = (parts.reshape(-1, GROUPS) @ np.ones(GROUPS, kind)).reshape(N, -1)
        by_group, inside = sums[:, 0], sums[:, 1:] @ np.ones(MEMBERS // GROUPS, kind)
        cells, at = z.reshape(-1), np.arange(0, z.size, z.shape[1])
        at_group, at_leaf = at + group, at + (GROUPS + leaf % MEMBERS)
        log = None
        if told:
            log = np.log(np.maximum(cells.take(at_group) * cells.take(at_leaf) / (by_group * inside), 1e-30)).take(back)
            log += lay.log_share.take(y)
        if used is None:
            return log, None
        w = used.astype(kind) / max(1, used.sum())
        loss = -float(log @ w) if told else None
        w = w.take(order)
        sums[:, 0], sums[:, 1:] = w / by_group, (w / inside)[:, None]
        parts *= sums[:, :, None]
        cells[at_group] -= w
        cells[at_leaf] -= w
        by_head = np.zeros_like(heads)
        ds = np.empty((N, HIDDEN), kind)
        for g, i, j in spans:
            np.matmul(z[i:j], heads[g, :HIDDEN].T, out=ds[i:j])
            np.matmul(f[i:j].T, z[i:j], out=by_head[g])
        ds *= hidden > 0
        df = ds.take(back, 0)
        do = df @ p["mix"][EMBED:-1].T
        do *= inverse
        dot = (do * seen) @ np.ones(WIDTH, kind)
        do = do.reshape(n, SCORED, WIDTH)
        da = do @ vw.transpose(0, 2, 1)
        da -= dot.reshape(n, SCORED, 1)
        da *= a
        far = np.bincount(self.near.ravel(), (np.ones(n, kind) @ da.reshape(n, -1)).ravel(), WINDOW)
        dq = (da @ kw).reshape(N, WIDTH)
        both = np.empty((n, WINDOW, 2 * WIDTH), kind)  # of keys and of values
        np.matmul(da.transpose(0, 2, 1), q, out=both[:, :, :WIDTH])
        np.matmul(a.transpose(0, 2, 1), do, out=both[:, :, WIDTH:])
        both = self._places(both, len(x))
        if looks is not None:
            e = p["embed"].take(r, 0)
        outside[:-1] -= e[inner - 1]
        own = e.T @ both
        grad = {
            "group": by_head[:, :, :GROUPS].sum(axis=0), "inside": by_head[:, :, GROUPS:], "far": far,
            "mix": np.concatenate([e[OVERLAP:].T @ df, seen.T @ df, (np.ones(N, kind) @ df)[None]]),
            "q": e[OVERLAP:].T @ dq * np.float32(1 / math.sqrt(WIDTH)), "v": own[:, WIDTH:],
            "k": np.concatenate([own[:, :WIDTH], e[:-1].T @ both[1:, :WIDTH] + outside.T @ both[starts, :WIDTH]]),
        }
        return loss, grad

    def _places(self, by_window: np.ndarray, size: int) -> np.ndarray:
        """Sums over the windows that hold a place."""
        n, _, width = by_window.shape
        out = np.zeros((size, width), by_window.dtype)
        out[OVERLAP:].reshape(n, SCORED, width)[:] = by_window[:, OVERLAP:]
        out[: n * SCORED].reshape(n, SCORED, width)[:, :OVERLAP] += by_window[:, :OVERLAP]
        return out

    def step(self, *windows: np.ndarray, rate: float = RATE) -> None:
        """One Adagrad step."""
        _, grad = self.run(*windows, told=False)
        self.speed = self.speed or {k: np.full_like(v, 1e-4) for k, v in self.p.items()}
        for k, v in grad.items():
            v = v.astype(np.float32)
            self.speed[k] += v * v
            v *= rate
            v /= np.sqrt(self.speed[k])
            self.p[k] -= v

    def pack(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()]).astype(np.float32)

    def unpack(self, flat: np.ndarray) -> None:
        start = 0
        for k, v in self.p.items():
            self.p[k] = flat[start : start + v.size].reshape(v.shape).astype(np.float32)
            start += v.size


def windows(flat: np.ndarray, offsets: np.ndarray, end: int, batch: int = BATCH) -> Iterator[tuple[np.ndarray, ...]]:
    """x, starts and the ids before them, first, y and used (see ``Model.run``) of batches of windows over texts that follow
    one another."""
    size = np.diff(offsets)
    blocks = -(-size // SCORED)
    start = np.concatenate(([0], np.cumsum(blocks)))
    n = int(start[-1])
    blank = blocks * SCORED - size  # places behind the texts
    y, used, first = np.full(n * SCORED, end, np.int32), np.ones(n * SCORED, bool), np.zeros(n, bool)
    used[np.repeat(start[1:] * SCORED - np.cumsum(blank), blank) + np.arange(blank.sum())] = False
    y[used], first[start[:-1]] = flat, True
    x = np.full(OVERLAP + n * SCORED, end, np.int32)
    x[OVERLAP + 1 :] = y[:-1]
    x[OVERLAP:][start[:-1] * SCORED] = end
    for b in range(0, n, batch):
        c = min(n, b + batch)
        own, places = slice(b * SCORED, c * SCORED), slice(b * SCORED, c * SCORED + OVERLAP)
        starts = np.append(OVERLAP + SCORED * np.flatnonzero(first[b:c]), 0)
        before = np.full(len(starts), end)
        before[-1] = x[b * SCORED - 1] if b else end
        yield x[places], starts, before, first[b:c], y[own], used[own]


def sharded(rows: DataFrame, total: int) -> DataFrame:
    """shard, ids: texts dealt to shards of about ``SHARD_IDS`` ids by a hash of their ids, in order of the shard, the hash and
    the ids. How the table was cut before doesn't matter; how many shards there are follows from the size of the corpus."""
    mark = F.xxhash64("ids")
    dealt = rows.select("ids", mark.alias("mark"), F.pmod(mark, F.lit(max(1, -(-total // SHARD_IDS)))).cast("int").alias("shard"))
    return dealt.repartition("shard").sortWithinPartitions("shard", "mark", "ids").select("shard", "ids")


def in_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """shard, ids and offsets of about ``STEP_IDS`` ids of whole texts at a time; where they end depends on the shard alone, not on
    the batches that it comes in."""
    shard, waiting, n = None, [], 0

    def joined() -> tuple[int, np.ndarray, np.ndarray]:
        flat = np.frombuffer(b"".join(waiting), np.uint16).astype(np.int32)
        return shard, flat, np.concatenate(([0], np.cumsum([len(w) // 2 for w in waiting])))

    for batch in batches:
        for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if waiting and (own != shard or n >= STEP_IDS):
                yield joined()
                waiting, n = [], 0
            shard = own
            waiting.append(ids)
            n += len(ids) // 2
    if waiting:
        yield joined()


def train(rows: DataFrame, model: Model, end: int, total: int) -> Model:
    """Steps over all windows of each shard, averaged over all shards by ids seen. The result doesn't depend on how the rows lie
    in partitions, only on the texts."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        start, at, seen = own.pack(), None, 0

        def weights() -> pa.RecordBatch:
            made = own.pack()
            parts = [made[i : i + PIECE].tobytes() for i in range(0, len(made), PIECE)]
            own.unpack(start)  # the next shard starts where this one did, and a worker may serve another task
            own.speed = None
            n = len(parts)
            return pa.RecordBatch.from_arrays([pa.array([at] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([float(seen)] * n), pa.array(parts, pa.binary())], ["task", "piece", "seen", "weights"])

        for shard, flat, offsets in in_steps(batches):
            if at is not None and shard != at:
                yield weights()
                seen = 0
            at = shard
            for w in windows(flat, offsets, end):
                own.step(*w)
            seen += len(flat)
        if at is not None:
            yield weights()

    def pooled(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("task")
        share = (part.seen / part.seen.sum()).to_numpy()
        total = sum(s * np.frombuffer(w, np.float32).astype(np.float64) for s, w in zip(share, part.weights, strict=True))
        return pd.DataFrame({"task": [int(part.task.min()) // FAN], "piece": [part.piece.iloc[0]], "seen": [part.seen.sum()], "weights": [total.astype(np.float32).tobytes()]})

    schema = "task long, piece int, seen double, weights binary"
    made = materialize(sharded(rows, total).mapInArrow(run, schema), "weights")
    while True:
        before, made = made, materialize(made.groupBy(F.expr(f"task div {FAN}").alias("g"), "piece").applyInPandas(pooled, schema), "mean")
        discard(before)
        if not made.agg(F.max("task")).first()[0]:
            break
    got = made.orderBy("piece").collect()
    discard(made)
    if got:
        model.unpack(np.concatenate([np.frombuffer(bytes(r["weights"]), np.float32) for r in got]))
    return model


def logs(model: Model, flat: np.ndarray, offsets: np.ndarray, end: int) -> np.ndarray:
    """The log probability of every id of the texts."""
    looks = model.looks()
    made = [model.run(*w[:-1], looks=looks)[0][w[-1]] for w in windows(flat, offsets, end, SCORE_BATCH)]
    return np.concatenate(made) if made else np.zeros(0, np.float32)


def op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return score(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def score(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    tokens = subwords(path, pattern)
    made = materialize(encoded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text"), tokens), "encoded")
    rows = made.where("ids IS NOT NULL").select("key", "doc_id", "held_out", "ids")
    training = rows.where("NOT held_out")
    counts = materialize(merged(made.where("words IS NOT NULL").select("key", "words", "times")), "counts")
    ids = id_counts(made.where("totals IS NOT NULL").select("totals"), tokens.end + 1)
    documents = int(ids[tokens.end])
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = (sums["n"] or 0) + documents, sums["v"] + (documents > 0)
    layout = Layout(ids, tokens)
    model = Model(layout, pair_counts(training, layout, tokens.end))
    if documents:
        model = train(training, model, tokens.end, int(ids.sum()))
    return _scored(rows, counts, most_frequent(counts), model, tokens, total, distinct, documents)


def _scored(rows: DataFrame, counts: DataFrame, frequent: tuple[np.ndarray, np.ndarray], model: Model, tokens: Subwords, total: int, distinct: int, documents: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast((model, frequent, tokens.starts, tokens.end))
    unit = math.log10(total + distinct + 1)
    names = ["key", "doc_id", "held_out", "n_tokens", "known", "logs", "score", "words", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (known, times), starts, end = sent.value
        log_times, find = np.log10(times + 1.0), Places(known)
        for batch in batches:
            at = 0
            for flat, offsets in slices(batch.column(3)):
                n = len(offsets) - 1
                score = np.add.reduceat(logs(own, flat, offsets, end).astype(np.float64), offsets[:-1]) / _LN10
                words = np.add.reduceat((starts[flat] & (flat != end)).astype(np.int64), offsets[:-1])
                doc = np.repeat(np.arange(n), words)
                hashes = word_hashes(flat, starts, end)
                place = find(hashes)
                found = place >= 0
                rare, rare_doc = hashes[~found], doc[~found]
                by = np.lexsort((rare, rare_doc))
                rare, rare_doc = rare[by], rare_doc[by]
                cuts = np.flatnonzero(np.concatenate(([True], (rare[1:] != rare[:-1]) | (rare_doc[1:] != rare_doc[:-1])))) if len(rare) else np.zeros(0, np.int64)
                ends = np.searchsorted(rare_doc[cuts], np.arange(n + 1))
                packed = lambda a, ends=ends, n=n: pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends * a.itemsize), pa.py_buffer(np.ascontiguousarray(a))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[at : at + n], batch.column(1)[at : at + n], batch.column(2)[at : at + n], pa.array(words + 1), pa.array(np.bincount(doc[found], minlength=n)), pa.array(np.bincount(doc[found], log_times[place[found]], n).astype(np.float64)), pa.array(score), packed(rare[cuts]), packed(np.diff(np.append(cuts, len(rare))).astype(np.int32))], names
                )
                at += n

    made = materialize(rows.mapInArrow(run, "key long, doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, words binary, times binary"), "scored")
    rest = unpacked(made.select("key", "words", "times")).join(counts.select("word", F.col("n").alias("c")), "word")
    rest = rest.groupBy("key").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("more_logs"))
    ends = math.log10(documents + 1)
    known = F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(int(documents > 0))
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + F.lit(ends) - F.col("n_tokens") * F.lit(unit)
    return made.join(rest, "key", "left").select("doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
