"""MinHash near-duplicates with an LSH forest.

A document's set holds its distinct shingles of ``width`` words (A-Z lower-cased, split at ASCII white space). Equal
sets become one representative, the smallest id. Each of ``TREES`` trees orders all representatives by its own
``DEPTH`` MinHash values; the orders are dealt by range, with the id as the last key, so no group of copies meets in
one task. In an order, a document's depth is the longest prefix that it shares with a neighbour, so dense regions look
deeper than sparse ones; the documents within ``REACH`` places that share at least half of that depth are candidates.
What the ends of partitions share, past short and empty ones, is looked at on its own. A pair whose sizes allow the similarity and whose
sketches don't rule it out (``SLACK``, over five standard deviations) is kept.

``REACH`` doesn't bound what is found: where more documents share ``CROWD`` values in an order than it covers, and they
aren't one component by then, all their pairs between components are compared on the full sets. Such a crowd is dealt
into parts, and each two parts meet in a task of their own. So every pair that shares ``CROWD`` values in one of the
orders is linked if it is similar enough, however many others do.

Links are confirmed on the full sets. Since only components are asked for, the first ``FIRST`` trees are looked at
first, and the others only for pairs between what these joined. Of each lot, pairs are confirmed in rounds: each
component's best pair to another component, and, once what lies between components isn't more than the documents that
have candidates, or a round leaves over half of it, all of it. A pair within one component isn't needed any more, all
others are confirmed. Components come from alternating stars on DataFrames.

Sets are compared by 48 bits of a 64-bit hash of each shingle, sizes count 64-bit hashes: of two sets of n shingles, one that
isn't common counts as common with a chance of about n * n / 3e14.

Defined cases: null or empty text has the empty set and no link; with fewer words than ``width`` the whole sequence is
the only shingle; a null id takes no part and is kept; rows with one id are one document, linked by any of its texts;
a very long text is its whole set; an empty table gives no rows; extra columns are ignored (``drop_near_duplicates`` keeps
them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import discard, materialize, read, shuffle_partitions, text_bytes
from tomewright.llm.components import components

TREES, DEPTH = 16, 8
FIRST = 2
REACH = 4
CROWD = 4
#: Rows and shingles of one part of a crowd.
PART_ROWS, PART_SHINGLES = 1024, 2_000_000
SKETCH = 64
SLACK = 0.3
PIECE = 2048
KEPT = 500_000
ROUNDS = 4

_MULTIPLIERS = np.random.default_rng(20240229).integers(0, 1 << 63, (2, TREES * DEPTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    def __init__(self, width: int):
        self.width = width
        self.cache: dict[bytes, int] = {}

    def __getstate__(self) -> dict:
        return {"width": self.width}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)

    def __call__(self, body: bytes | None) -> np.ndarray:
        """The sorted 64-bit hashes of the set."""
        words = body.lower().split() if body else []
        if not words:
            return np.zeros(0, np.uint64)
        cache = self.cache
        if len(cache) > KEPT:
            cache.clear()
        hashes = []
        for w in words:
            h = cache.get(w)
            if h is None:
                h = cache[w] = xxhash.xxh3_64_intdigest(w)
            hashes.append(h)
        h = np.array(hashes, np.uint64)
        width = min(self.width, len(h))
        out = np.full(len(h) - width + 1, width, np.uint64)
        for j in range(width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - width + 1 + j]
            out ^= out >> np.uint64(29)
        return np.unique(out * np.uint64(0xBF58476D1CE4E5B9))


def signature(shingles: np.ndarray) -> np.ndarray:
    """TREES * DEPTH MinHash values of 32 bits."""
    a, b = _MULTIPLIERS
    out = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    x = shingles ^ (shingles >> np.uint64(31))
    for start in range(0, len(x), PIECE):
        block = x[start : start + PIECE, None] * a
        block += b
        np.minimum(out, block.min(axis=0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def sketch(values: np.ndarray) -> bytes:
    """Four bits of SKETCH of the values, taken from all trees."""
    v = values[:: len(values) // SKETCH].astype(np.uint8) & 15
    return (v[::2] << 4 | v[1::2]).tobytes()


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The similarity that sketches (rows of bytes) speak for."""
    x = a ^ b
    same = ((x & 15) == 0).sum(axis=1) + ((x & 240) == 0).sum(axis=1)
    return (same / SKETCH - 1 / 16) * (16 / 15)


def pairs(tree: np.ndarray, key: np.ndarray, size: np.ndarray, marks: np.ndarray, doc: np.ndarray, comp: np.ndarray, least: float, across: int | None = None, upper: tuple[int, int] | None = None) -> np.ndarray:
    """Candidates (lower id, higher id, agreement, their components) among rows in order, of different components;
    with ``across`` only those over that place, with ``upper`` only those whose later row has a place in that range."""
    n = len(doc)
    depth = np.zeros(n, np.int64)
    shared = []
    for j in range(1, min(REACH, n - 1) + 1):
        lcp = np.cumprod(key[:-j] == key[j:], axis=1).sum(axis=1) * (tree[:-j] == tree[j:])
        shared.append(lcp)
        if j == 1:
            depth[:-1] = lcp
            depth[1:] = np.maximum(depth[1:], lcp)
    out = [np.zeros((5, 0), np.int64)]
    for j, lcp in enumerate(shared, 1):
        ok = (lcp > 0) & ((2 * lcp >= np.minimum(depth[:-j], depth[j:])) | (lcp >= CROWD)) & (comp[:-j] != comp[j:])
        small, large = np.minimum(size[:-j], size[j:]), np.maximum(size[:-j], size[j:])
        i = np.flatnonzero(ok & (small >= least * large))
        if across is not None:
            i = i[(i < across) & (i + j >= across)]
        if upper is not None:
            i = i[(i + j >= upper[0]) & (i + j < upper[1])]
        near = agreement(marks[i], marks[i + j])
        i, near = i[near >= least - SLACK], near[near >= least - SLACK]
        first = np.where(doc[i] < doc[i + j], i, i + j)
        last = 2 * i + j - first
        out.append(np.stack([doc[first], doc[last], (near * 1000).astype(np.int64), comp[first], comp[last]]))
    return np.concatenate(out, axis=1)


def _matrix(column: list[bytes], kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), width)


_PAIR = "a long, b long, near long, ca long, cb long"
_ROW = "tree int, key binary, size long, marks binary, id long, comp long"
_NAMES = ["kind", "place", *[x.split()[0] for x in _PAIR.split(", ")], *[x.split()[0] for x in _ROW.split(", ")]]


def _pairs_of(rows: dict[str, list], least: float, across: int | None = None, upper: tuple[int, int] | None = None) -> np.ndarray:
    return pairs(np.array(rows["tree"]), _matrix(rows["key"], np.uint16, DEPTH), np.array(rows["size"]), _matrix(rows["marks"], np.uint8, SKETCH // 2), np.array(rows["id"]), np.array(rows["comp"]), least, across, upper)


def candidates(signed: DataFrame, least: float, trees: range) -> DataFrame:
    """a < b, near (agreement in thousandths), ca, cb from (id, size, values, comp): candidates of these trees that
    stand in different components so far."""
    spark = signed.sparkSession

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, values, comps = (c.to_pylist() for c in batch.columns)
            if not ids:
                continue
            v = _matrix(values, np.uint32, TREES * DEPTH)
            marks = [sketch(x) for x in v]
            raw = v.astype(np.uint16).byteswap().reshape(len(ids), TREES, DEPTH)[:, trees.start : trees.stop].tobytes()
            width, n = 2 * DEPTH, len(trees)
            long = lambda x: pa.array(np.repeat(np.array(x, np.int64), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(trees.start, trees.stop, dtype=np.int32), len(ids))), pa.array([raw[i : i + width] for i in range(0, len(raw), width)], pa.binary()), long(sizes), pa.array([m for m in marks for _ in trees], pa.binary()), long(ids), long(comps)],
                ["tree", "key", "size", "marks", "id", "comp"],
            )

    order = ["tree", "key", "size", "id"]
    rows = signed.select("id", "size", "values", "comp").mapInArrow(spread, _ROW)
    rows = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)

    kinds = (pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    columns = ("tree", "key", "size", "marks", "id", "comp")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slides over the rows: of what went before, only rows that are in reach of later ones are kept."""
        place, kept, done, first = TaskContext.get().partitionId(), {c: [] for c in columns}, 0, None

        def rows(found: np.ndarray) -> pa.RecordBatch:
            m = found.shape[1]
            return pa.RecordBatch.from_arrays([pa.array([0] * m, pa.int32()), pa.array([place] * m, pa.int32()), *(pa.array(x) for x in found), *(pa.nulls(m, k) for k in kinds)], _NAMES)

        for batch in batches:
            for c, own in kept.items():
                own += batch.column(c).to_pylist()
            n = len(kept["id"])
            if first is None and n >= REACH:
                first = {c: own[:REACH] for c, own in kept.items()}
            if n - 1 > done:
                yield rows(_pairs_of(kept, least, upper=(done, n - 1)))
                drop = max(0, n - 2 - REACH)
                done, kept = n - 1 - drop, {c: own[drop:] for c, own in kept.items()}
        n = len(kept["id"])
        if not n:
            return
        yield rows(_pairs_of(kept, least, upper=(done, n)))
        first = first or kept
        ends = [(1, first, i) for i in range(min(REACH, len(first["id"])))] + [(2, kept, i) for i in range(max(0, n - REACH), n)]
        yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in ends], pa.int32()), pa.array([place] * len(ends), pa.int32()), *(pa.nulls(len(ends), pa.int64()) for _ in range(5)), *(pa.array([rows_[c][i] for _, rows_, i in ends], k) for c, k in zip(columns, kinds, strict=True))], _NAMES)

    found = materialize(rows.mapInArrow(look, f"kind int, place int, {_PAIR}, {_ROW}"), "found")

    def join_ends(rows: pd.DataFrame) -> pd.DataFrame:
        rows = pd.concat([rows[rows.kind == k].sort_values(["tree", "key", "size", "id"]) for k in (2, 1)])
        kept = {c: list(rows[c]) for c in columns}
        return pd.DataFrame(_pairs_of(kept, least, int((rows.kind == 2).sum())).T, columns=["a", "b", "near", "ca", "cb"])

    # the last rows of a partition meet the first ones of all partitions in reach, past empty and short ones
    sizes = sorted((r["place"], r["count"]) for r in found.where("kind = 1").groupBy("place").count().collect())
    meets = []
    for k, (p, _) in enumerate(sizes):
        between = 0
        for q, n in sizes[k + 1 :]:
            meets.append((p, q))
            between += n
            if between >= REACH:
                break
    after = F.broadcast(spark.createDataFrame(meets, "place int, target int"))
    lasts = found.where("kind = 2").join(after, "place").drop("place").withColumnRenamed("target", "place")
    ends = lasts.unionByName(found.where("kind = 1")).groupBy("place").applyInPandas(join_ends, _PAIR)
    each = found.where("kind = 0").select("a", "b", "near", "ca", "cb").unionByName(ends).groupBy("a", "b")
    out = materialize(each.agg(F.max("near").alias("near"), F.min("ca").alias("ca"), F.min("cb").alias("cb")), "pairs")
    discard(found)
    return out


def _pack(shingles: np.ndarray) -> bytes:
    """The set by the lower 48 bits of its hashes."""
    return shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def confirm(links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The components (ca, cb) of the pairs whose sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                common = len(np.intersect1d(_unpack(x), _unpack(y)))
                ok.append(100 * common >= percent * ((len(x) + len(y)) // 6 - common))
            yield batch.select(["ca", "cb"]).filter(pa.array(ok, pa.bool_()))

    return links.join(left, "a").join(right, "b").select("ca", "cb", "x", "y").mapInArrow(run, "ca long, cb long")


def links_between(sets: list[np.ndarray], comp: list[int], side: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Links that join the components as all similar pairs of sets would; with ``side`` only pairs of different sides.
    Sets with the most common shingles come first, so that a hub joins its copies before these meet each other."""
    _, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    size = np.array([len(s) for s in sets])
    ends = np.cumsum(size)
    order = np.argsort(-np.add.reduceat(counts[places], ends - size) / size, kind="stable")
    own = [places[ends[i] - size[i] : ends[i]] for i in order]
    size, label = size[order], np.unique(np.array(comp)[order], return_inverse=True)[1]
    side = side[order] if side is not None else None
    flags, out = np.zeros(len(counts), bool), []
    for i in range(len(own) - 1):
        small, large = np.minimum(size[i], size[i + 1 :]), np.maximum(size[i], size[i + 1 :])
        ok = (label[i + 1 :] != label[i]) & (100 * small >= percent * large)
        if side is not None:
            ok &= side[i + 1 :] != side[i]
        js = np.flatnonzero(ok) + i + 1
        if not len(js):
            continue
        flags[own[i]] = True
        common = np.add.reduceat(flags[np.concatenate([own[j] for j in js])].astype(np.int64), np.cumsum(size[js]) - size[js])
        flags[own[i]] = False
        for j in js[100 * common >= percent * (size[i] + size[js] - common)]:
            if label[j] != label[i]:
                out.append((comp[order[i]], comp[order[j]]))
                label[label == label[j]] = label[i]
    return out


def crowd_links(signed: DataFrame, rows: DataFrame, shingler: Shingler, percent: int) -> DataFrame | None:
    """ca, cb: confirmed links between the components in crowds; None without a crowd of several components. signed
    has (id, size, values, comp), rows (id, text)."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(2).to_pylist(), np.uint32, TREES * DEPTH).reshape(-1, TREES, DEPTH)
            g = np.tile(np.arange(TREES, dtype=np.int64), (len(v), 1))
            for j in range(CROWD):
                g = g << 16 | (v[:, :, j] & 0xFFFF)
            each = lambda c: pa.array(np.repeat(c.to_numpy(), TREES))
            yield pa.RecordBatch.from_arrays([pa.array(g.ravel()), *(each(batch.column(k)) for k in (0, 1, 3))], ["g", "id", "size", "comp"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_pack(shingler(b)) for b in text_bytes(batch.column(1))], pa.binary())], ["id", "shingles"])

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        side = rows["part"].to_numpy()
        found = links_between([_unpack(x) for x in rows["shingles"]], rows["comp"].tolist(), side if side.min() != side.max() else None, percent)
        return pd.DataFrame(found, columns=["ca", "cb"], dtype="int64")

    prefixes = signed.select("id", "size", "values", "comp").mapInArrow(spread, "g long, id long, size long, comp long")
    parts = F.greatest(F.ceil(F.count("*") / PART_ROWS), F.ceil(F.sum("size") / PART_SHINGLES)).cast("int").alias("parts")
    crowds = prefixes.groupBy("g").agg(F.count("*").alias("n"), parts, F.min("comp").alias("low"), F.max("comp").alias("high"))
    crowds = materialize(crowds.where((F.col("n") > REACH + 1) & (F.col("low") != F.col("high"))).select("g", "parts"), "crowds")
    members = materialize(prefixes.join(crowds, "g").select("g", "parts", "id", "comp").distinct(), "members")
    discard(crowds)
    if members.isEmpty():
        discard(members)
        return None
    sets = materialize(rows.join(members.select("id").distinct(), "id").select("id", "text").mapInArrow(pack, "id long, shingles binary").where("octet_length(shingles) > 0"), "sets")
    dealt = members.withColumn("part", F.expr("CAST(pmod(xxhash64(id, g), parts) AS int)")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    dealt = dealt.join(sets, "id").select("g", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "comp", "shingles")
    out = materialize(dealt.groupBy("g", "p", "q").applyInPandas(meet, "ca long, cb long").distinct(), "crowd_links")
    discard(members, sets)
    return out


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles, component: a row for each row of docs (component null for a null id)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    shingler = Shingler(width)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, high, low, values = [], [], [], []
            for i, body in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                s = shingler(body)
                sizes.append(len(s))
                whole = xxhash.xxh3_128_digest(s.tobytes())
                high.append(int.from_bytes(whole[:8], "big", signed=True))
                low.append(int.from_bytes(whole[8:], "big", signed=True))
                values.append(signature(s).tobytes() if len(s) and i is not None else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(values, pa.binary())], ["id", "size", "high", "low", "values"])

    signed = materialize(rows.mapInArrow(sign, "id long, size long, high long, low long, values binary"), "signed")
    alike = materialize(signed.where("values IS NOT NULL").groupBy("high", "low").agg(F.min("id").alias("id"), F.first("size").alias("size"), F.first("values").alias("values")), "alike")
    written, alike = alike, alike.withColumn("comp", F.col("id"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_pack(shingler(b)) for b in text_bytes(batch.column(1))], pa.binary())], ["id", "shingles"])

    for trees in (range(FIRST), range(FIRST, TREES)):
        found = candidates(alike, percent / 100, trees)
        nodes = materialize(found.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "nodes")
        sets = materialize(rows.join(nodes, "id").select("id", "text").mapInArrow(pack, "id long, shingles binary"), "sets")
        rounds, before = linked(found, sets, percent, nodes.count()), written
        for joined in rounds:
            alike = alike.join(joined, alike["comp"] == joined["node"], "left").withColumn("comp", F.coalesce("component", "comp")).drop("node", "component")
        written = alike = materialize(alike, "alike")
        discard(before, found, nodes, sets, *rounds)
    links = crowd_links(alike, rows, shingler, percent)
    if links is not None:
        joined = components(links, "ca", "cb")
        before, alike = written, alike.join(joined, alike["comp"] == joined["node"], "left").withColumn("comp", F.coalesce("component", "comp")).drop("node", "component")
        written = alike = materialize(alike, "alike")
        discard(before, links, joined)
    settled = alike.select("high", "low", "comp")
    # rows that share an id are one document: what their texts belong to is one component
    of_id = signed.where("values IS NOT NULL").select("id", "high", "low").join(settled, ["high", "low"]).select("id", "comp").distinct()
    several = of_id.groupBy("id").agg(F.min("comp").alias("ca"), F.max("comp").alias("cb")).where("ca != cb").select("id", "ca")
    shared = materialize(of_id.join(several, "id").where("comp != ca").select("ca", F.col("comp").alias("cb")).distinct(), "shared")
    if not shared.isEmpty():
        joined = components(shared, "ca", "cb")
        settled = settled.join(joined, settled["comp"] == joined["node"], "left").withColumn("comp", F.coalesce("component", "comp")).drop("node", "component")
    out = signed.select("id", "size", "high", "low").join(settled, ["high", "low"], "left").select("id", F.col("size").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("comp", "id")).alias("component"))
    out = materialize(out, "components")
    discard(signed, written)
    return out


def linked(found: DataFrame, sets: DataFrame, percent: int, nodes: int) -> list[DataFrame]:
    """What the confirmed ones of the candidate pairs join, round by round: (node, component) over the components
    before the round."""
    left, out, were = found, [], None
    for last in [*[False] * ROUNDS, True]:
        n, before = left.count(), left
        if not n:
            break
        stuck, were = were is not None and 2 * n > were, n
        if last or stuck or n <= nodes:
            picked = left.select("a", "b", "ca", "cb")
            last = True
        else:
            best = F.max_by(F.struct("a", "b", "ca", "cb"), F.struct("near", F.xxhash64("a", "b"))).alias("p")
            ends = left.select(F.col("ca").alias("c"), "*").unionByName(left.select(F.col("cb").alias("c"), "*"))
            picked = materialize(ends.groupBy("c").agg(best).select("p.*").distinct(), "picked")
        sure = confirm(picked, sets, percent)
        joined = components(sure, "ca", "cb")
        out.append(joined)
        if last:
            break
        of = lambda c, joined=joined: joined.select(F.col("node").alias(c), F.col("component").alias(f"new_{c}"))
        left = left.join(picked.select("a", "b"), ["a", "b"], "left_anti").join(of("ca"), "ca", "left").join(of("cb"), "cb", "left")
        left = left.select("a", "b", "near", F.coalesce("new_ca", "ca").alias("ca"), F.coalesce("new_cb", "cb").alias("cb"))
        left = materialize(left.where("ca != cb"), "open")
        discard(picked, *([before] if before is not found else []))
    return out


def op1_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), width=2, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the documents that a smaller id of their component stands for; of rows that share an id one stays, that
    with the first text in order (a null text comes last). Rows with a null id stay."""
    found = near_duplicates(docs, width=width, percent=percent, doc_id=doc_id, text=text)
    gone = materialize(found.where("id != component").select(F.col("id").alias("__tw_gone")).distinct(), "gone")
    left = docs.join(gone, F.col(doc_id).cast("long") == F.col("__tw_gone"), "left_anti")
    # ids that come up again are looked for without the texts; only their rows are brought together
    again = materialize(docs.where(F.col(doc_id).isNotNull()).groupBy(doc_id).count().where("count > 1").select(F.col(doc_id).alias("__tw_again")), "again")
    if again.isEmpty():
        return left
    of = F.col(doc_id) == F.col("__tw_again")
    one = left.join(again, of, "left_semi").groupBy(F.col(doc_id).alias("__tw_id")).agg(F.min_by(F.struct(*docs.columns), F.struct(F.col(text).isNull(), text)).alias("__tw_row"))
    return left.join(again, of, "left_anti").unionByName(one.select(*(F.col("__tw_row")[c].alias(c) for c in docs.columns)))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS g FROM w, unnest(range(1, greatest(len(w), 2))) AS u(i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT g, count(*) AS df FROM s GROUP BY g),
r AS (SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS pos FROM s JOIN k USING (g)),
f AS (SELECT doc_id, g, n FROM r JOIN n USING (doc_id) WHERE pos <= n - ceil(0.8 * n) + 1),
p AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb FROM f AS x JOIN f AS y ON x.g = y.g AND x.doc_id < y.doc_id AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)),
c AS (SELECT a, b, na, nb, count(*) AS i FROM p JOIN s AS x ON x.doc_id = a JOIN s AS y ON y.doc_id = b AND y.g = x.g GROUP BY ALL),
e AS (SELECT a, b FROM c WHERE 100 * i >= 80 * (na + nb - i)),
sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, sym.b FROM reach JOIN sym ON sym.a = reach.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)
"""
