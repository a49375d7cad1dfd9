"""Line dedup by chunks of lines with content-defined boundaries.

A rolling hash goes over the hashes of each two neighbouring lines (lines without a word are passed over), which are the
smallest chunk; a line of at least ``LINE_WORDS`` words is a chunk by itself, however many sentences it has. The bytes of every
repeated hash are compared with those of its first occurrence (lowest id, then place). Copies that follow each other join to a
longer chunk where their first occurrences do so too, or where the lines that they have together stand in a row at one of
these; so a chunk's boundaries are set by its content and don't move with what stands around a passage. Where two chunks meet
in a line but don't join, that line belongs to the longer one, and what is left of the other must still be two lines. Two
chunks of two lines that overlap so are no copy of anything: both stay. The lines of the copies are removed, with the lines
without a word between them; the first occurrence of every chunk stays, and so does a short line that stands alone.

Hashes are counted with partial sums, the join on the hash has two plain shuffled sides that adaptive execution
can split where one chunk holds a large part of all rows, and texts are shuffled twice: once to bring candidates
to their first occurrence, once to bring the decisions back to the documents.

Defined cases: null text stays null, the empty text is one empty line and stays; a document whose lines all go has the
empty text; a very long text is lines like all others, a very long line one line; rows with equal id and text are one
document for the count and all get its result; a null id comes first; an empty table gives no rows; extra columns are
kept; ``n_chars``, where the table has it, is counted anew for changed texts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewright.llm.common import discard, materialize, read, text_bytes

LINE_WORDS = 50


def keys(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first line, last line) of what is hashed, in order: each long line, and each two neighbouring lines that have words,
    unless both are hashed alone."""
    told = [i for i, line in enumerate(lines) if line and not line.isspace()]
    alone = {i for i in told if len(lines[i]) >= 2 * LINE_WORDS - 1 and len(lines[i].split()) >= LINE_WORDS}
    out = []
    for a, b in itertools.zip_longest(told, told[1:]):
        if a in alone:
            out.append((a, a))
        if b is not None and (a not in alone or b not in alone):
            out.append((a, b))
    return out


def rolled(lines: list[bytes], spans: list[tuple[int, int]]) -> list[int]:
    """The rolling hash over the line hashes of each span."""
    own = {i: xxhash.xxh3_64_intdigest(lines[i]) for i in {i for s in spans for i in s}}
    return [_signed((own[a] * 0x9E3779B97F4A7C15 + own[b] + (a == b)) & 0xFFFFFFFFFFFFFFFF) for a, b in spans]


def piece(lines: list[bytes], span: tuple[int, int]) -> bytes:
    a, b = span
    return lines[a] if a == b else lines[a] + b"\n" + lines[b]


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("mark"), F.col(text).alias("text"))


def occurrences(keyed: DataFrame) -> DataFrame:
    """id, mark, place (in the text's keys), h: a row for each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, places, hashes = [], [], [], []
            for i, m, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), strict=True):
                lines = body.split(b"\n") if body else []
                found = rolled(lines, keys(lines))
                ids += [i] * len(found)
                marks += [m] * len(found)
                places += range(len(found))
                hashes += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(places, pa.int32()), pa.array(hashes, pa.int64())], ["id", "mark", "place", "h"])

    return keyed.mapInArrow(run, "id long, mark long, place int, h long")


def copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, mark, places: the keys of each document that are byte-equal to an earlier occurrence (``place``), each with whether it
    joins the next key (``joined``)."""
    keyed = _keyed(docs, doc_id, text)
    found = materialize(occurrences(keyed), "chunks")
    at = F.struct("id", "mark", "place")
    repeated = materialize(found.groupBy("h").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first != last").select("h", "first"), "repeated")
    flagged = found.join(repeated, "h").select("id", "mark", "place", "h", F.expr("id <=> first.id AND mark = first.mark AND place = first.place").alias("first"))
    wanted = materialize(flagged.groupBy("id", "mark").agg(F.array_sort(F.collect_set(F.struct("place", "h", "first"))).alias("wanted")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, m, body, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                lines = body.split(b"\n")
                own = keys(lines)
                out += [(i, m, r["place"], r["h"], r["first"], piece(lines, own[r["place"]])) for r in rows]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "mark", "place", "h", "first", "piece"])

    k, w = keyed.alias("k"), wanted.hint("merge").alias("w")  # the same plan at every size
    bodies = k.join(w, F.expr("k.id <=> w.id AND k.mark = w.mark")).select("k.id", "k.mark", "k.text", "w.wanted").mapInArrow(run, "id long, mark long, place int, h long, first boolean, piece binary")
    bodies = materialize(bodies, "bodies")
    discard(repeated, wanted)
    firsts = materialize(bodies.where("first").select("h", F.col("piece").alias("kept"), F.struct("id", "mark", "place").alias("source")).dropDuplicates(["h"]), "firsts")
    same = bodies.where("NOT first").join(firsts, "h").where("piece = kept").select("id", "mark", "place", "h", "source").distinct()
    # where the first occurrences of neighbours aren't neighbours, one of them may still stand beside a copy of the other
    after = Window.partitionBy("id", "mark").orderBy("place")
    same = same.withColumn("next", F.when(F.lead("place").over(after) == F.col("place") + 1, F.lead(F.struct("h", "source")).over(after)))
    follows = F.expr("next.source.id <=> source.id AND next.source.mark = source.mark AND next.source.place = source.place + 1")
    same = materialize(same.withColumn("follows", F.coalesce(follows, F.lit(False))), "same")
    open_ = same.where("next IS NOT NULL AND NOT follows")
    right = open_.select("id", "mark", "place", F.struct(F.col("source.id").alias("i"), F.col("source.mark").alias("m"), (F.col("source.place") + 1).alias("p"), F.col("next.h").alias("h")).alias("k"))
    left = open_.select("id", "mark", "place", F.struct(F.col("next.source.id").alias("i"), F.col("next.source.mark").alias("m"), (F.col("next.source.place") - 1).alias("p"), F.col("h").alias("h")).alias("k"))
    o, f = right.unionByName(left).alias("o"), found.alias("f")
    beside = o.join(f, F.expr("o.k.h = f.h AND o.k.m = f.mark AND o.k.p = f.place AND o.k.i <=> f.id")).select("o.id", "o.mark", "o.place").distinct().alias("b")
    s = same.alias("s")
    joined = s.join(beside, F.expr("s.id <=> b.id AND s.mark = b.mark AND s.place = b.place"), "left").select("s.id", "s.mark", F.struct("s.place", (F.col("follows") | F.col("b.mark").isNotNull()).alias("joined")).alias("x"))
    out = materialize(joined.groupBy("id", "mark").agg(F.array_sort(F.collect_list("x")).alias("places")), "copies")
    discard(bodies, firsts, found, same)
    return out


def chunks(own: list[tuple[int, int]], copied: list[tuple[int, bool]]) -> set[int]:
    """The lines that go. own: the keys of a document; copied: places of copied keys, and whether each joins the next."""
    gone = {own[p][0] for p, _ in copied if own[p][0] == own[p][1]}
    told = {line: k for k, line in enumerate(sorted({i for key in own for i in key}))}
    runs: list[list[int]] = []  # first and last line, by their place among lines with words
    on = -1
    for p, joined in copied:
        a, b = told[own[p][0]], told[own[p][1]]
        if p == on:
            runs[-1][1] = b
        else:
            runs.append([a, b])
        on = p + 1 if joined else -1
    sizes = [b - a + 1 for a, b in runs]
    stay = set()
    cut = [list(r) for r in runs]
    for k in range(1, len(runs)):
        if runs[k][0] == runs[k - 1][1]:
            if sizes[k] <= 2 and sizes[k - 1] <= 2:
                stay |= {k - 1, k}
            elif sizes[k] > sizes[k - 1]:
                cut[k - 1][1] -= 1
            else:
                cut[k][0] += 1
    lines = sorted(told)
    for k, (a, b) in enumerate(cut):
        if k not in stay and b > a:
            gone.update(lines[a : b + 1])
    return gone


def removed(body: bytes, copied: list[tuple[int, bool]]) -> list[tuple[int, int, int]]:
    """The chunks that the copied keys make up: (first line, line after the last, words). Lines without a word between
    two removed lines belong to them."""
    lines = body.split(b"\n")
    gone = sorted(chunks(keys(lines), copied))
    runs: list[list[int]] = []
    for i in gone:
        n = len(lines[i].split())
        if runs and not any(x and not x.isspace() for x in lines[runs[-1][1] : i]):
            runs[-1][1], runs[-1][2] = i + 1, runs[-1][2] + n
        else:
            runs.append([i, i + 1, n])
    return [tuple(r) for r in runs]


def line_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", found: str | None = None) -> DataFrame:
    """docs with the repeated chunks of lines taken out of the texts; ``found`` names a column for what was removed,
    an array of (first line, line after the last, words)."""
    rows = docs.withColumns({"__tw_id": F.col(doc_id).cast("long"), "__tw_mark": F.coalesce(F.xxhash64(text), F.lit(0))})
    gone = copies(docs, doc_id=doc_id, text=text).select(F.col("id").alias("__tw_i"), F.col("mark").alias("__tw_m"), F.col("places").alias("__tw_places"))
    joined = rows.join(gone.hint("merge"), F.expr("__tw_id <=> __tw_i AND __tw_mark = __tw_m"), "left").drop("__tw_id", "__tw_mark", "__tw_i", "__tw_m")
    at, counted = docs.columns.index(text), docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    span = T.StructType([T.StructField(n, T.LongType()) for n in ("first_line", "end_line", "words")])
    schema = T.StructType([*docs.schema.fields, *([T.StructField(found, T.ArrayType(span))] if found else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(len(docs_columns)).to_pylist()
            columns = list(batch.columns[:-1])
            texts, cuts = columns[at].to_pylist(), [[] for _ in places]
            numbers = columns[counted].to_pylist() if counted is not None else None
            for k, own in enumerate(places):
                if not own:
                    continue
                body = texts[k].encode()
                cuts[k] = removed(body, [(x["place"], x["joined"]) for x in own])
                if cuts[k]:
                    drop = {i for a, b, _ in cuts[k] for i in range(a, b)}
                    texts[k] = "\n".join(x for i, x in enumerate(texts[k].split("\n")) if i not in drop)
                    if numbers is not None:
                        numbers[k] = len(texts[k])
            columns[at] = pa.array(texts, columns[at].type)
            if numbers is not None:
                columns[counted] = pa.array(numbers, columns[counted].type)
            if found:
                columns.append(pa.array([[{"first_line": a, "end_line": b, "words": n} for a, b, n in c] for c in cuts], pa.list_(pa.struct([(n, pa.int64()) for n in ("first_line", "end_line", "words")]))))
            yield pa.RecordBatch.from_arrays(columns, [*docs_columns, *([found] if found else [])])

    docs_columns = docs.columns
    return joined.mapInArrow(run, schema)


def stage(docs: DataFrame) -> DataFrame:
    """docs with the repeated chunks taken out; documents of which nothing is left go, documents that were empty stay."""
    out = line_dedup(docs, found="__tw_found")
    return out.where(F.coalesce(F.col("text") != "", F.lit(True)) | (F.size("__tw_found") == 0)).drop("__tw_found")


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, lines and words removed, and the digest of the text that stays."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup(docs, found="__tw_found")
    total = lambda f: F.aggregate("__tw_found", F.lit(0).cast("long"), f)
    return out.select(
        "doc_id",
        total(lambda acc, x: acc + x["end_line"] - x["first_line"]).alias("n_lines_removed"),
        total(lambda acc, x: acc + x["words"]).alias("n_words_removed"),
        F.char_length("text").cast("long").alias("n_chars_kept"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )
