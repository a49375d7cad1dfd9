"""Document fingerprints by a homomorphic multiset hash: wide vectors hashed from paragraphs, summed modulo powers of two.

A paragraph is what stands between line feeds. Its vector has ``DIGEST_LANES`` lanes of 32 bits that are drawn from its
SHA-256, and ``SKETCH_LANES`` lanes that count, over the pairs of neighbouring words (parted by spaces) inside it, how many pairs have that bit set
in their hash. The fingerprint of a document is the sum of its paragraphs' vectors, each lane modulo 2^32. So it does not
depend on the order of paragraphs, and paragraphs are inserted and deleted by adding and subtracting their sums
(``plus``); nothing else of the document is read again. Equal lanes of the first kind mean equal multisets of
paragraphs (up to collisions of 512 bits). The second kind is a sketch of the multiset of word pairs: with n pairs, 2 x lane - n
is a sum of random signs, so the cosine of two such vectors estimates the cosine of the two multisets, with a standard
error near 0.09 for 128 lanes.

Only DataFrame functions. Two lanes of counts share one long while they are summed. Documents are keyed by (id, hash of the text).

Defined cases: a null text is the empty text, which has one empty paragraph; a text without line feed is one paragraph;
rows with equal id and text are one document in the order of ids, and each keeps its own row; texts of one id follow each
other by their hashes; a null id stands last; the only document of a table is its own next one; an empty table gives no rows; a very
long text is summed whole; extra columns don't matter, none is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomewright.llm.common import discard, materialize, read, shuffle_partitions

DIGEST_LANES, SKETCH_LANES = 16, 128
_PACKED = SKETCH_LANES // 2
_LOW = 0xFFFFFFFF


def summed(paragraphs: DataFrame, keys: list[str], paragraph: str = "paragraph", sign: str | None = None) -> DataFrame:
    """keys and the sums of the vectors of their paragraphs; a negative sign takes a paragraph away."""
    rows = paragraphs.select(*keys, (F.col(sign) if sign else F.lit(1)).cast("long").alias("__w"), F.sha2(F.col(paragraph).cast("binary"), 256).alias("__p"), F.split(paragraph, " ").alias("__words"))
    pairs = F.arrays_zip(F.concat(F.array(F.lit("")), "__words").alias("a"), F.col("__words").alias("b"))
    each = rows.select(*keys, "__w", "__p", F.posexplode(pairs).alias("__at", "__x"))
    hashes = [F.xxhash64("__x.a", "__x.b", F.lit(k)).alias(f"__h{k}") for k in range(SKETCH_LANES // 64)]
    each = each.select(*keys, "__w", F.when(F.col("__at") == 0, F.col("__p")).alias("__p"), *hashes)
    lanes = lambda k: F.when(F.col("__p").isNotNull(), F.col("__w") * F.xxhash64("__p", F.lit(k)).bitwiseAND(F.lit(_LOW)))
    bits = lambda k: F.col("__w") * F.shiftright(f"__h{k // 32}", k % 32).bitwiseAND(F.lit(0x100000001))
    totals = [*(F.sum(lanes(k)) for k in range(DIGEST_LANES)), *(F.sum(bits(k)) for k in range(_PACKED)), F.sum("__w")]
    return each.groupBy(*keys).agg(F.array(*totals).alias("sums"))


def plus(a: Column, b: Column) -> Column:
    """The sums of two sets of paragraphs together."""
    return F.zip_with(a, b, lambda x, y: x + y)


def narrow(sums: Column) -> Column:
    """Sums in about half of the space, for shuffles and files: lanes of digests as ints, counts as shorts. Sums with a count beyond
    a short stay as they are."""
    digest, centred, pairs = vectors(sums)
    counts = F.transform(centred, lambda x: F.shiftright(x + pairs, 1))
    signed = lambda x: F.shiftright(F.shiftleft(x, 32), 32)
    fits = (F.array_max(counts) < 1 << 15) & (F.array_min(counts) >= 0)
    few = F.struct(F.transform(digest, lambda x: signed(x).cast("int")).alias("digest"), F.transform(counts, lambda x: x.cast("short")).alias("counts"), pairs.alias("pairs"))
    return F.struct(F.when(fits, few).alias("few"), F.when(~fits, sums).alias("many"))


def widened(x: Column) -> Column:
    """The sums that ``narrow`` was made of, lanes of digests modulo 2^32."""
    few = x["few"]
    low, high = F.slice(few["counts"], 1, _PACKED), F.slice(few["counts"], _PACKED + 1, _PACKED)
    packed = F.zip_with(low, high, lambda a, b: a.cast("long") + F.shiftleft(b.cast("long"), 32))
    return F.coalesce(x["many"], F.concat(F.transform(few["digest"], lambda d: d.cast("long").bitwiseAND(F.lit(_LOW))), packed, F.array(few["pairs"])))


def vectors(sums: Column) -> tuple[Column, Column, Column]:
    """Of sums, the lanes of both kinds as arrays: those of digests modulo 2^32, and the centred counts 2 x lane - pairs; and the pairs."""
    pairs = F.element_at(sums, -1)
    signed = lambda x: F.shiftright(F.shiftleft(x, 32), 32)  # noqa: E731  the lower lane, which may have become negative on the way
    packed = F.slice(sums, DIGEST_LANES + 1, _PACKED)
    low, high = F.transform(packed, signed), F.transform(packed, lambda x: F.shiftright(x - signed(x), 32))
    return F.transform(F.slice(sums, 1, DIGEST_LANES), lambda x: x.bitwiseAND(F.lit(_LOW))), F.transform(F.concat(low, high), lambda x: 2 * x - pairs), pairs


def written(sums: Column) -> Column:
    """A fingerprint as text: lanes in hexadecimal, digest lanes first."""
    digest, sketch, pairs = vectors(sums)
    counts = F.transform(sketch, lambda x: F.hex(F.floor((x + pairs) / 2)))
    return F.concat(F.array_join(F.transform(digest, lambda x: F.lpad(F.hex(x), 8, "0")), ""), F.lit(":"), F.array_join(counts, "."))


def likeness(a: Column, b: Column) -> Column:
    """Of two sums, the cosine of their sketches, cut off at 0; 1 for equal fingerprints."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    (digest, x, _), (other, y, _) = vectors(a), vectors(b)
    size = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    cosine = F.when(size > 0, dot(x, y) / size).otherwise(F.lit(0.0))
    return F.when((digest == other) & (x == y), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys and the sums of each document (see ``vectors`` and ``written``)."""
    return summed(docs.select(*keys, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("paragraph")), keys)


def following(ids: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Of distinct keys, each with the next one in the order in columns ``next_<key>``; after the last comes the first.

    Rows are dealt by range of the order; only the first row of each partition is taken elsewhere, one row each."""
    spark = ids.sparkSession
    dealt = materialize(ids.select(*keys).repartitionByRange(shuffle_partitions(spark), *order).withColumn("__part", F.spark_partition_id()), "dealt")
    here = F.struct(*keys)
    inside = Window.partitionBy("__part").orderBy(*order)
    rows = dealt.withColumns({"__next": F.lead(here).over(inside), "__place": F.row_number().over(inside)})
    heads = rows.where("__place = 1").select("__part", here.alias("__head"))
    by_part = Window.orderBy("__part")  # over one row for each partition
    whole = Window.partitionBy()
    heads = heads.select("__part", F.coalesce(F.lead("__head").over(by_part), F.min_by("__head", "__part").over(whole)).alias("__head"))
    out = rows.join(F.broadcast(heads), "__part").withColumn("__next", F.coalesce("__next", "__head"))
    out = materialize(out.select(*keys, *(F.col(f"__next.{c}").alias(f"next_{c}") for c in keys)), "following")
    discard(dealt)
    return out


def with_edits(docs: DataFrame) -> DataFrame:
    """Of distinct documents (doc_id, text): doc_id, n_chars, rows (how often it stands there), edited_sha256, and the sums of the text
    (``own``), of its edited text (``edited``) and of the next document (``next``). A text is edited by putting the beginning of the
    next one in place of its last third.

    Only the paragraphs that the edit touches are summed again: the edited fingerprint is the text's, less those from the cut
    on, plus those that stand there then."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.coalesce("doc_id", F.lit(-1 << 63)).alias("id"), F.xxhash64(text, F.col("doc_id").isNull()).alias("mark"))
    key = ["id", "mark"]
    size, third = F.char_length("text"), F.expr("cast(char_length(text) div 3 as int)")
    sizes = materialize(rows.groupBy(*key).agg(F.first("doc_id").alias("doc_id"), F.first(size).alias("n"), F.first(third).alias("third"), F.count("*").alias("rows")), "sizes")
    nexts = following(sizes, key, [F.col("id").desc(), F.col("mark").desc()])
    texts = rows.select(*key, "text").dropDuplicates(key)
    # the pieces that edited texts take from their next documents come from where these are
    wanted = sizes.join(nexts, key).select(F.col("next_id").alias("id"), F.col("next_mark").alias("mark"), F.col("id").alias("to_id"), F.col("mark").alias("to_mark"), "doc_id", "n", "third", "rows")
    given = texts.join(wanted, key).select(F.col("to_id").alias("id"), F.col("to_mark").alias("mark"), "doc_id", "n", "third", "rows", F.expr("substring(text, 1, third)").alias("put"), F.col("id").alias("next_id"), F.col("mark").alias("next_mark"))
    both = texts.join(given, key).withColumn("head", F.expr("substring(text, 1, n - third)"))
    both = both.withColumns({"cut": F.substring_index("head", "\n", -1), "edit": F.unhex(F.sha2(F.concat("head", "put").cast("binary"), 256))})  # cut: the paragraph in which the edit begins
    gone = F.concat("cut", F.expr("substring(text, n - third + 1, third)"))
    part = lambda side, w, t: F.struct(F.lit(side).alias("side"), F.lit(w).alias("w"), t.alias("t"))
    parts = F.array(part(0, 1, F.col("text")), part(1, -1, gone), part(1, 1, F.concat("cut", "put")))
    facts = [*key, "doc_id", "n", "rows", "next_id", "next_mark", "edit"]
    paragraphs = both.select(*facts, F.inline(parts)).select(*facts, "side", "w", F.explode(F.split("t", "\n")).alias("paragraph"))
    sums = summed(paragraphs, [*facts, "side"], sign="w")
    change = F.lead("sums").over(Window.partitionBy(*key).orderBy("side"))
    own = sums.withColumn("change", change).where("side = 0").select(*facts, F.col("sums").alias("own"), plus(F.col("sums"), F.col("change")).alias("edited"))
    own = materialize(own.withColumns({"own": narrow(F.col("own")), "edited": narrow(F.col("edited"))}), "sums")
    discard(sizes, nexts)
    after = own.select(F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("own").alias("next"))
    met = own.drop("id", "mark").join(after, ["next_id", "next_mark"])
    return met.select("doc_id", F.col("n").cast("long").alias("n_chars"), "rows", F.lower(F.hex("edit")).alias("edited_sha256"), *(widened(F.col(c)).alias(c) for c in ("own", "edited", "next")))


def op11_fingerprints(spark, sf_dir: str) -> DataFrame:
    own, edited, after = F.col("own"), F.col("edited"), F.col("next")
    return (
        with_edits(read(spark, sf_dir, "documents"))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            written(own).alias("fingerprint"),
            written(edited).alias("edited_fingerprint"),
            likeness(own, edited).alias("near_edited"),
            likeness(own, after).alias("near_next"),
            F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("row"),
        )
        .drop("row")
    )
