"""Data-quality checks as long anomaly tables, fingerprints and record verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewright.functions.text import let

#: Quotes that are searched for at once.
SHORT_QUOTES = 200_000


def anomalies(rows: DataFrame, key: str, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """check, severity, id: a row for each check whose condition holds. checks: name to (severity, condition).

    All checks share one scan; a row is exploded into what it fails."""
    failed = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"))) for name, (severity, cond) in checks.items()]))
    return rows.select(F.col(key).alias("id"), F.explode(failed).alias("f")).select("f.check", "f.severity", "id")


def verdict(found: DataFrame, blocking: str = "blocking") -> DataFrame:
    return found.agg(F.coalesce(F.bool_or(F.col("severity") == blocking), F.lit(False)).alias("failed"), F.count("*").alias("n"))


def record_verdict(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """key, errors (codes joined in rule order), ok."""
    errors = F.array_compact(F.array(*[F.when(cond, F.lit(code)) for code, cond in rules.items()]))
    return rows.select(key, errors.alias("e")).select(key, F.array_join("e", "|").alias("errors"), (F.size("e") == 0).alias("ok"))


def staged_verdict(rows: DataFrame, key: str, rules: list[tuple[str, Column, bool]]) -> DataFrame:
    """key, errors (codes joined in rule order), ok. rules: (code, condition, whether nothing after it can be judged): a record
    that can't be read has no other errors, one without its source none that need it."""
    told = F.array(*[F.struct(F.lit(code).alias("code"), F.coalesce(cond, F.lit(False)).alias("hit"), F.lit(stops).alias("stops")) for code, cond, stops in rules])
    last = let(F.transform(told, lambda x: x["hit"] & x["stops"]), lambda s: F.coalesce(F.nullif(F.array_position(s, True), F.lit(0)), F.lit(len(rules))))
    hits = let(F.struct(told.alias("t"), last.alias("last")), lambda x: F.transform(F.filter(x["t"], lambda r, i: r["hit"] & (i < x["last"])), lambda r: r["code"]))
    return rows.select(key, hits.alias("e")).select(key, F.array_join("e", "|").alias("errors"), (F.size("e") == 0).alias("ok"))


def error_summary(verdicts: DataFrame, key: str) -> DataFrame:
    """code, occurrences, records of the errors in ``record_verdict`` rows."""
    long = verdicts.where("NOT ok").select(key, F.explode(F.split("errors", "\\|")).alias("code"))
    return long.groupBy("code").agg(F.count("*").alias("occurrences"), F.count_distinct(key).alias("records"))


def outside(value: Column, vocabulary: list[str]) -> Column:
    """A value that isn't null and not in the closed list."""
    return value.isNotNull() & ~value.isin(*vocabulary)


def any_outside(values: Column, vocabulary: list[str]) -> Column:
    return F.size(F.array_except(values, F.array(*[F.lit(v) for v in vocabulary]))) > 0


def text_hash(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def canonical_json(columns: list[str]) -> Column:
    """Compact JSON with sorted keys and explicit nulls."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def canonical_hash(columns: list[str]) -> Column:
    return text_hash(canonical_json(columns))


def fingerprint_by_bucket(rows: DataFrame, columns: list[str], buckets: int = 256) -> DataFrame:
    """bucket, n, digest: a fingerprint of a set of rows of any size. A row's digest decides its bucket; a bucket's digest
    is the sum of its rows' digests, so rows are never gathered and their order doesn't matter."""
    row = F.md5(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    part = lambda a: F.conv(F.substring("d", a, 8), 16, 10).cast("long")
    parts = rows.select(row.alias("d")).select(F.conv(F.substring("d", 1, 2), 16, 10).cast("int").alias("bucket"), *[part(a).alias(f"p{a}") for a in (1, 9, 17, 25)])
    sums = parts.groupBy((F.col("bucket") % buckets).alias("bucket")).agg(F.count("*").alias("n"), *[F.sum(f"p{a}").alias(f"p{a}") for a in (1, 9, 17, 25)])
    return sums.select("bucket", "n", F.md5(F.concat_ws(",", "p1", "p9", "p17", "p25")).alias("digest"))


def require_empty(rows: DataFrame, message: str) -> DataFrame:
    """Fails the job when rows exist; passes an empty table on."""
    return rows.where(F.assert_true(F.lit(False), F.lit(message)).isNull())


def _short_quotes(docs: DataFrame, quotes: DataFrame, block: int = SHORT_QUOTES) -> DataFrame:
    """__d, __q of texts (__d, text) and quotes (__q, quote) that they hold anywhere. Quotes are counted, and searched for in
    blocks of so many: one automaton for each block, broadcast and run over all texts once."""
    import ahocorasick
    import pyarrow as pa

    spark = docs.sparkSession
    count = quotes.count()
    found = []
    for b in range(max(1, -(-count // block))):
        part = quotes if count <= block else quotes.where(F.pmod("__q", F.lit(-(-count // block))) == b)
        told: dict[str, list[int]] = {}
        for key, quote in part.collect():
            told.setdefault(quote, []).append(key)
        everywhere = told.pop("", [])  # the empty quote stands in every text
        automaton = ahocorasick.Automaton()
        for quote, own in told.items():
            automaton.add_word(quote, own)
        automaton.make_automaton()
        sent = spark.sparkContext.broadcast((automaton, everywhere, bool(told)))

        def scan(batches, sent=sent):
            for batch in batches:
                automaton_, always, some = sent.value
                ids, hits = [], []
                for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    held = set(always)
                    if some:
                        for _, own in automaton_.iter(text):
                            held.update(own)
                    ids += [d] * len(held)
                    hits += held
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hits, pa.int64())], ["__d", "__q"])

        found.append(docs.mapInArrow(scan, "__d long, __q long"))
    return reduce(DataFrame.unionByName, found)


def evidence(docs: DataFrame, quotes: DataFrame, text: str, quote: str, words: int = 4) -> DataFrame:
    """All pairs of a text and a quote that it holds word for word (letter case counts). Of equal rows one counts.

    A quote's first and last word may be the end and start of longer ones in the text, the words between them stand whole. Quotes
    of at least ``words`` + 2 words meet texts by a hash of their second to next words; only (text, hash) goes through
    that join, then each text is fetched once for each of its candidates and confirmed by containment. Shorter quotes
    meet by the hash of their inner words, as many as there are. Quotes without inner words are looked for all at once by an
    automaton of bounded size, in blocks."""
    tokens = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    own = [c for c in docs.columns if c != text]
    q = quotes.where(F.col(quote).isNotNull()).distinct().withColumn("__q", F.xxhash64(*quotes.columns)).withColumn("__w", F.split(quote, r"\s+"))
    q = q.withColumn("__n", F.least(F.greatest(F.size("__w") - 2, F.lit(0)), F.lit(words)))
    hashed = q.where("__n > 0").withColumn("__g", F.xxhash64("__n", F.array_join(F.slice("__w", 2, F.col("__n")), " ")))
    sizes = [r["__n"] for r in hashed.select("__n").distinct().collect()]  # at most ``words`` of them
    d = docs.where(F.col(text).isNotNull()).distinct().withColumn("__d", F.xxhash64(*docs.columns))
    gram = lambda w, i, n: F.xxhash64(F.lit(n), F.array_join(F.slice(w, i, n), " "))
    grams_of = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size("__w") - n + 1, F.lit(1))), lambda i: gram(F.col("__w"), i, n))
    every = [F.when(F.size("__w") >= n, grams_of(n)) for n in sizes] or [F.array().cast("array<bigint>")]
    grams = d.select("__d", tokens(F.col(text)).alias("__w")).select("__d", F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*every))))).alias("__g"))
    met = grams.join(hashed.select("__g", "__q"), "__g").select("__d", "__q").distinct()
    found = met.join(d, "__d").join(q.drop("__w", "__n"), "__q").where(F.contains(F.col(text), F.col(quote)))
    bare = q.where("__n = 0")
    few = _short_quotes(d.select("__d", text), bare.select("__q", quote)).join(d, "__d").join(bare.drop("__w", "__n"), "__q")
    columns = [*own, *[c for c in quotes.columns if c != quote]]
    return reduce(DataFrame.unionByName, [found.select(*columns), few.select(*columns)]).distinct()
