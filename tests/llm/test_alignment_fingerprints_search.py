"""Token alignment, fingerprints and ranked search against brute force, on small fixtures."""

import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tomewright.llm import align, decontaminate, fingerprint, lexical

DOC = "doc_id long, text string"
A, B, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOC)


def prose(rng, n, alphabet="abcdefghijklmnop"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 8))) for _ in range(n))


# token alignment


def brute_alignment(texts):
    """Byte ranges of every token, groups by a walk over both lists, links by comparing all pairs of a document."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet, found = align.byte_alphabet(), []
    for t in texts:
        spans = ([], [])
        if t:
            made = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
            pieces = [(i, b.id_to_piece(i)) for i in b.encode(t)]
            pieces = [(i, bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()) for i, p in pieces]
            if b"".join(x for _, x in made) == b"".join(x for _, x in pieces) == (" " + t).encode():
                for k, own in enumerate((made, pieces)):
                    ends = list(itertools.accumulate(len(x) for _, x in own))
                    spans[k].extend((i, e - len(x), e) for (i, x), e in zip(own, ends, strict=True))
        found.append(spans)
    links = [[(x[0], y[0]) for x in s[0] for y in s[1] if x[1] < y[2] and y[1] < x[2]] for s in found]
    counts = Counter(p for own in links for p in set(own))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    out = []
    for (xs, ys), own in zip(found, links, strict=True):
        cuts = sorted({x[2] for x in xs} & {y[2] for y in ys})
        groups = [([x[0] for x in xs if lo < x[2] <= hi], [y[0] for y in ys if lo < y[2] <= hi]) for lo, hi in itertools.pairwise([0, *cuts])]
        written = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((len(xs), len(ys), len(groups), len(own), sum(counts[p] == best[p[0]] for p in own), sum(counts[p] for p in own), hashlib.sha256(written.encode()).hexdigest() if xs else ""))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    out = [None, "", " ", "  two  spaces ", "a", "naïve café — “déjà vu”", "日本語のテキスト", "emoji 👩‍👩‍👧 ▁ sign", "tab\tand\r\nlines\n\n", "<|endoftext|> </s> <s> <0x41>", "zero\x00byte", "ﬁ ligature", "é", "x" * 3000, "1234567890 " * 30]
    out += [prose(rng, rng.randint(1, 60)) for _ in range(30)]
    return [*out, out[20], out[20], prose(rng, 300)]


@pytest.mark.parametrize("lookup_rows", [4_000_000, 10])
@pytest.mark.parametrize("pattern", [PATTERN, None])
def test_alignment(spark, texts, lookup_rows, pattern, monkeypatch):
    monkeypatch.setattr(align, "RUN_CHARS", 500)
    df = docs_of(spark, texts).withColumns({"n_a": F.lit("clash"), "pairs": F.lit(1), "link": F.lit("kept")})
    aligned = align.align(df, A, B, pattern, digest=True, pairs=True).persist()
    counts = align.pair_counts(aligned, 32_000)
    got = align.with_links(aligned, counts, lookup_rows=lookup_rows)
    assert set(df.columns) - {"pairs"} <= set(got.columns)
    rows = {r["doc_id"]: r for r in got.collect()}
    want = brute_alignment(texts)
    assert [tuple(rows[i][c] for c in (*align.COUNTS, "n_best", "count_sum", "groups_sha256")) for i in range(len(texts))] == want
    for r in rows.values():  # the groups themselves
        starts = [0, *r["a_ends"][:-1]], [0, *r["b_ends"][:-1]]
        written = ";".join(",".join(map(str, r["a_ids"][s:e])) + "|" + ",".join(map(str, r["b_ids"][p:q])) for s, e, p, q in zip(starts[0], r["a_ends"], starts[1], r["b_ends"], strict=False))
        assert (hashlib.sha256(written.encode()).hexdigest() if r["n_a"] else "") == r["groups_sha256"]
    assert align.align(df.limit(0), A, B, pattern).count() == 0
    aligned.unpersist()


def test_alignment_of_a_long_text(spark):
    text = prose(random.Random(22), 60_000) + "é" * 5000
    row = align.align(docs_of(spark, [text]), A, B, PATTERN, digest=True, groups=False).first()
    ids = Tokenizer.from_file(A).encode(" " + text, add_special_tokens=False).ids
    assert row["n_a"] == len(ids) and row["n_links"] >= row["n_groups"] > 1000


# fingerprints


def prints(spark, texts):
    rows = fingerprint.fingerprints(docs_of(spark, texts), ["doc_id"])
    return {r["doc_id"]: r["f"] for r in rows.select("doc_id", fingerprint.written(F.col("sums")).alias("f")).collect()}


def test_fingerprints_are_multiset_hashes(spark):
    rng = random.Random(23)
    paragraphs = [prose(rng, rng.randint(1, 30)) for _ in range(20)] + [""] * 2
    orders = [rng.sample(paragraphs, len(paragraphs)) for _ in range(3)]
    texts = ["\n".join(p) for p in orders] + ["\n".join(paragraphs[:-1]), "\n".join([*paragraphs, paragraphs[0]]), None, "", "\n", "a b", "b a", "a\nb"]
    got = prints(spark, texts)
    assert got[0] == got[1] == got[2] and got[5] == got[6]
    assert len({got[i] for i in (0, 3, 4, 5, 7, 8, 9, 10)}) == 8


def test_fingerprints_insert_and_delete(spark):
    """Sums with paragraphs taken out and put in equal those of the new text, also where counts pass zero on the way."""
    rng = random.Random(24)
    old, out, put = ([prose(rng, rng.randint(1, 200)) for _ in range(k)] for k in (6, 4, 3))
    rows = [(0, p, 1) for p in [*old, *out]] + [(0, p, -1) for p in out] + [(0, p, 1) for p in put]
    schema = "doc_id long, paragraph string, w int"
    changes = spark.createDataFrame(rows[10:], schema)
    base = fingerprint.summed(spark.createDataFrame(rows[:10], schema), ["doc_id"], sign="w")
    both = base.join(fingerprint.summed(changes, ["doc_id"], sign="w").withColumnRenamed("sums", "change"), "doc_id")
    new = fingerprint.plus(F.col("sums"), F.col("change"))
    assert both.select(fingerprint.written(new)).first()[0] == prints(spark, ["\n".join([*put, *old])])[0]


def test_fingerprints_narrow(spark):
    texts = ["", "a", "ab cd\nef gh ij", "one two three " * 9, "x y " * 40_000]
    rows = fingerprint.fingerprints(docs_of(spark, texts), ["doc_id"]).withColumn("narrow", fingerprint.narrow(F.col("sums")))
    rows = rows.withColumn("back", fingerprint.widened(F.col("narrow"))).select("doc_id", (F.col("narrow.many").isNull()).alias("few"), *(fingerprint.written(F.col(c)).alias(f"{c}_text") for c in ("sums", "back")), *(F.to_json(F.array(*fingerprint.vectors(F.col(c))[:2])).alias(f"{c}_vectors") for c in ("sums", "back")))
    got = {r["doc_id"]: r for r in rows.collect()}
    assert [got[k]["few"] for k in sorted(got)] == [True, True, True, True, False]  # counts beyond a short keep their width
    assert all(r["sums_text"] == r["back_text"] and r["sums_vectors"] == r["back_vectors"] for r in got.values())


def test_fingerprint_query(spark, tmp_path):
    rng = random.Random(25)
    shared = "\n".join(prose(rng, 40) for _ in range(6))
    rows = [(i * 3 - 4, "\n".join(prose(rng, rng.randint(1, 40)) for _ in range(rng.randint(1, 12)))) for i in range(25)]
    rows += [(200, shared), (199, shared), (300, None), (301, ""), (302, "ab"), (303, "é\n\né" * 5), (400, "x y"), (400, "x y"), (400, "other text\nof one id"), (None, "no id"), (500, "w " * 40_000)]
    spark.createDataFrame(rows, DOC).withColumn("mark", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    got = fingerprint.op11_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    distinct = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts, ids = [t for _, t in distinct], [i for i, _ in distinct]
    same_id = [k for k, i in enumerate(ids) if i == 400]
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    own = prints(spark, texts)
    edits = {}
    for k, t in enumerate(texts):
        n, after = len(t), texts[(k + 1) % len(texts)]
        edits[k] = t[: n - n // 3] + after[: n // 3]
    edited = prints(spark, [edits[k] for k in range(len(texts))])
    for k, i in enumerate(ids):
        if k in same_id or k + 1 in same_id:
            continue  # texts of one id follow each other by their hashes
        (r,) = by[i]
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (len(texts[k]), own[k], edited[k])
        assert r["edited_sha256"] == hashlib.sha256(edits[k].encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        pairs = [Counter(p for line in t.split("\n") for p in itertools.pairwise(["", *line.split(" "), None])) for t in (texts[k], edits[k], texts[(k + 1) % len(texts)])]
        for name, other in (("near_edited", pairs[1]), ("near_next", pairs[2])):
            dot = sum(n * other[p] for p, n in pairs[0].items())
            exact = dot / (sum(n * n for n in pairs[0].values()) * sum(n * n for n in other.values())) ** 0.5
            assert abs(r[name] - exact) < 0.45 and (exact < 1 - 1e-12 or r[name] > 1 - 1e-12)
    assert {r["n_chars"] for r in by[400]} == {3, 20} and len({r["fingerprint"] for r in by[400]}) == 2
    assert by[200][0]["fingerprint"] == by[199][0]["fingerprint"] and by[200][0]["near_next"] == 1
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert fingerprint.op11_fingerprints(spark, f"{tmp_path}/none").count() == 0
    spark.createDataFrame([(7, "only one document")], DOC).write.parquet(f"{tmp_path}/one/documents.parquet")
    assert fingerprint.op11_fingerprints(spark, f"{tmp_path}/one").first()["near_next"] == 1


# ranked search


def brute_search(texts, items, k=20):
    docs = [(i, Counter(decontaminate.words(t.encode()))) for i, t in texts if t is not None]
    docs = [(i, c) for i, c in docs if c]
    total = sum(sum(c.values()) for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    out = []
    for item, t in items:
        asked, found = Counter(decontaminate.words((t or "").encode())), []
        for i, c in docs:
            m = 75 + (25 * sum(c.values()) * len(docs)) // total
            score = sum(n * math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 12 * m)) for w, n in asked.items() if w in c)
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, rank + 1, i, -score) for rank, (score, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block_words", "block_docs", "k"), [(1_000_000, 16_384, 20), (60, 7, 3)])
def test_ranked_search(spark, block_words, block_docs, k):
    rng = random.Random(26)
    vocabulary = prose(rng, 400).split()
    weighted = [vocabulary[min(399, int(rng.paretovariate(0.6)) - 1)] for _ in range(20_000)]
    texts = [(i, " ".join(rng.choice(weighted) for _ in range(rng.randint(1, 120)))) for i in rng.sample(range(5000), 300)]
    texts += [(6000 + i, "Copied WORDS, " + " ".join(vocabulary[:30])) for i in range(90)]
    texts += [(7000, None), (7001, ""), (7002, "...!"), (None, " ".join(vocabulary[:9])), (7003, "é É ÄB äb"), (7004, "rare " * 5000), (7005, "rare"), (7005, "rare"), (-5, "rare")]
    items = [(i, " ".join(rng.choice(weighted) for _ in range(rng.randint(1, 40)))) for i in range(25)]
    items += [(30, " ".join(vocabulary[:30])), (31, None), (32, "?!"), (33, "nowhere"), (34, "Rare rare É"), (None, vocabulary[3]), (35, items[0][1])]
    df = spark.createDataFrame(texts, DOC).withColumns({"item_id": F.lit("clash"), "n": F.lit(1), "terms": F.lit("x")}).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(df, bench, k=k, block_words=block_words, block_docs=block_docs)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(texts, items, k)
    assert lexical.search(df.limit(0), bench).count() == lexical.search(df, bench.limit(0)).count() == 0


def test_treaps_are_search_trees_and_heaps():
    rng = np.random.default_rng(27)
    doc, impact = np.sort(rng.choice(100_000, 20_000, replace=False)), rng.integers(1, 40, 20_000)
    treap = lexical.Treaps(np.arange(100_000), doc, np.zeros(20_000, np.int64), impact, 1)
    depth, level, seen = 0, treap.root, 0
    while len(level):
        for child, sign in ((treap.left, -1), (treap.right, 1)):
            there = child[level] >= 0
            below = child[level][there]
            assert (treap.impact[below] <= treap.impact[level[there]]).all()
            assert (sign * (treap.doc[below] - treap.doc[level[there]]) > 0).all()
        seen += len(level)
        level = np.concatenate((treap.left[level], treap.right[level]))
        level, depth = level[level >= 0], depth + 1
    assert seen == 20_000 and depth < 80


def test_search_opens_few_ranges():
    """With strong impacts in few documents, most ranges are never opened."""
    rng = np.random.default_rng(28)
    n = 20_000
    term = np.repeat(np.arange(4), n)
    impact = rng.pareto(1.1, 4 * n).astype(np.int64) + 1
    treap = lexical.Treaps(np.arange(n), np.tile(np.arange(n), 4), term, impact, 4)
    opened = []
    split, treap.split = treap.split, lambda *a: opened.append(len(a[0]) // 4) or split(*a)
    best = lexical.Best(20)
    treap.search(np.arange(4), np.ones(4, np.int64), best)
    total = np.bincount(np.tile(np.arange(n), 4), impact).astype(np.int64)
    order = np.lexsort((np.arange(n), -total))[:20]
    assert list(best.ids) == list(order) and list(best.scores) == list(total[order])
    assert sum(opened) < n / 5
