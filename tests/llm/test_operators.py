"""The ten operators against brute force, round trips and held-out accuracy, on small fixtures."""

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tomewright.llm import ann, bpe, chat, decontaminate, langid, linededup, lm, neardup, shard, toxicity
from tomewright.llm.components import components

DOC = "doc_id long, text string"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def docs_of(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], DOC)


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]


# near duplicates


def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(spark, vocabulary):
    rng = random.Random(5)
    texts = [None, "", " \t ", "one", "ONE", "two words", "İ́ x" * 3]
    for _ in range(12):
        base = prose(rng, vocabulary, 120).split()
        for _ in range(rng.choice([1, 1, 2, 6])):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own).upper() if rng.random() < 0.2 else " ".join(own))
    texts += [texts[10]] * 40 + ["w " * 30_000]
    got = neardup.near_duplicates(docs_of(spark, texts), width=2, percent=80)
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in got.collect()} == brute_components(list(enumerate(texts)), 2, 80)


def test_near_duplicates_repeated_ids(spark):
    """Rows that share an id are one document, linked by any of its texts."""
    a, b, c = "one two three four five", "six seven eight nine ten", "x y z"
    rows = [(3, a), (5, a), (5, b), (9, b), (11, c), (12, c), (12, c), (13, None), (13, c)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, DOC), width=2)
    assert {r["id"]: r["component"] for r in got.collect()} == {3: 3, 5: 3, 9: 3, 11: 11, 12: 11, 13: 11}


def test_near_duplicates_over_many_partitions(spark, vocabulary):
    """More partitions than rows leave some empty, and most short."""
    rng = random.Random(21)
    texts = []
    for _ in range(6):
        base = prose(rng, vocabulary, 60).split()
        for k in range(3):
            own = list(base)
            own[k] = f"y{k}"
            texts.append(" ".join(own))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        got = neardup.near_duplicates(docs_of(spark, texts), width=2)
        assert {r["id"]: (r["n_shingles"], r["component"]) for r in got.collect()} == brute_components(list(enumerate(texts)), 2, 80)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_near_duplicates_group_of_copies(spark, vocabulary):
    """Many near copies of one text form one component."""
    rng = random.Random(6)
    base = prose(rng, vocabulary, 150).split()
    texts = []
    for i in range(400):
        own = list(base)
        own[i % 150] = f"x{i}"
        texts.append(" ".join(own))
    got = neardup.near_duplicates(docs_of(spark, texts), width=2)
    assert {r["component"] for r in got.collect()} == {0}


@pytest.mark.parametrize("part", [1024, 100])
def test_near_duplicates_hub(spark, vocabulary, monkeypatch, part):
    """Variants that only their original links are all found, also where a crowd is dealt into parts."""
    monkeypatch.setattr(neardup, "PART_ROWS", part)
    rng = random.Random(14)
    base = rng.sample(vocabulary, 150)
    texts = []
    for i in range(600):
        own = list(base)
        for k in rng.sample(range(1, 149, 2), 7):
            own[k] = f"x{i}k{k}"
        texts.append(" ".join(own))
    texts.insert(300, " ".join(base))
    got = neardup.near_duplicates(docs_of(spark, texts), width=2)
    assert {r["component"] for r in got.collect()} == {0}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 9), min_size=1), st.integers(0, 5), st.integers(0, 1)), min_size=2, max_size=12), st.booleans())
def test_links_between(rows, sided):
    """The links join what all similar pairs join."""
    sets, comp, side = ([r[k] for r in rows] for k in range(3))

    def joined(links):
        of = {c: c for c in comp}
        for a, b in links:
            of = {c: of[a] if x == of[b] else x for c, x in of.items()}
        return {frozenset(c for c in of if of[c] == x) for x in of.values()}

    want = [(comp[i], comp[j]) for i, j in itertools.combinations(range(len(rows)), 2) if 100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j]) and not (sided and side[i] == side[j])]
    got = neardup.links_between([np.array(sorted(s), np.uint64) for s in sets], comp, np.array(side) if sided else None, 60)
    assert joined(got) == joined(want)


def test_drop_near_duplicates(spark):
    rows = [(1, "a b c d e f g", 7), (2, "a b c d e f g", 8), (None, "a b c d e f g", 9), (3, None, 1), (1, "a b c d e f g", 7), (4, "z y x w v u", 1), (4, "k l m n o p", 2), (4, "z y x w v u", 3), (5, None, 1), (5, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component int")
    kept = neardup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect() if r["doc_id"] not in (3, 5)) == [(0, "a b c d e f g"), (1, "a b c d e f g"), (4, "k l m n o p")]
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] in (3, 5)) == [3, 5]
    assert neardup.drop_near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 100), (300, 300), (7, 500)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 500: 1, 100: 100, 200: 100}


# language model


def small_model(counts, tokens, pairs=None):
    layout = lm.Layout(np.array(counts), tokens)
    return lm.Model(layout, np.zeros((lm.ROWS, lm.CLASSES), np.int64) if pairs is None else pairs)


def test_lm_gradients():
    tokens = lm.subwords(PATH, PATTERN)
    model = small_model(np.ones(tokens.end + 1, np.int64), tokens)
    rng = np.random.default_rng(0)
    ids, offsets = rng.integers(0, 60, 190), np.array([0, 70, 71, 190])
    (batch,) = lm.windows(ids, offsets, tokens.end)
    assert batch[5].sum() == len(ids) and (batch[4][batch[5]] == ids).all()
    model.p = {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in model.p.items()}
    model.direct = model.direct.astype(np.float64)
    _, grad = model.run(*batch)
    for name, g in grad.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        out = []
        for step in (1e-5, -2e-5):
            model.p[name][at] += step
            out.append(model.run(*batch)[0])
        assert (out[0] - out[1]) / 2e-5 == pytest.approx(g[at], rel=1e-3), name
        model.p[name][at] += 1e-5


def test_lm_looks_are_made_once():
    """Products of the embedding rows that are made once for all batches give the same logs and gradients; a step asks for no logs."""
    tokens = lm.subwords(PATH, PATTERN)
    model = small_model(np.ones(tokens.end + 1, np.int64), tokens)
    rng = np.random.default_rng(6)
    model.p = {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in model.p.items()}
    (batch,) = lm.windows(rng.integers(0, 60, 190), np.array([0, 70, 71, 190]), tokens.end)
    looks = model.looks()
    assert model.run(*batch[:-1], looks=looks)[0] == pytest.approx(model.run(*batch[:-1])[0], rel=1e-12)
    (_, want), (loss, got) = model.run(*batch), model.run(*batch, looks=looks, told=False)
    assert loss is None and all(got[k] == pytest.approx(v, rel=1e-9, abs=1e-12) for k, v in want.items())


def test_encoded_words_and_hashes_are_kept():
    """Texts encoded one after another have the ids of texts encoded alone, and each kept word has the hash of its ids."""
    tokens, other = lm.subwords(PATH, PATTERN), lm.subwords(PATH, PATTERN)
    for texts in ([[], []], [[b"one", b"two", b"one"], []], [[b"w%d" % i for i in range(3000)]], [[b"two", b"new"]]):
        flat, offsets = tokens(texts)
        other.clear()
        want, ends = other(texts)
        assert flat.tolist() == want.tolist() and offsets.tolist() == ends.tolist() and flat[offsets[1:] - 1].tolist() == [tokens.end] * len(texts)
        hashes = tokens.hashes.room[tokens.k[tokens.k >= 0]]
        assert hashes.tolist() == lm.word_hashes(flat, tokens.starts, tokens.end).tolist()


def test_lm_context():
    """A window sees what stands before it in its own text, and nothing of other texts."""
    tokens = lm.subwords(PATH, PATTERN)
    model = small_model(np.ones(tokens.end + 1, np.int64), tokens)
    model.p = {k: v + np.float32(0.3) * np.random.default_rng(1).standard_normal(v.shape).astype(np.float32) for k, v in model.p.items()}
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 60, 100), rng.integers(0, 60, 75)
    of = lambda *texts: lm.logs(model, np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts]))), tokens.end)
    assert of(a, b) == pytest.approx(np.concatenate([of(a), of(b)]), rel=1e-4)
    changed = a.copy()
    changed[40] = 59 - a[40]
    assert of(changed)[:40] == pytest.approx(of(a)[:40], rel=1e-5) and abs(of(changed)[45] - of(a)[45]) > 1e-7


def test_lm_scores(spark, vocabulary):
    rng = random.Random(8)
    texts = [prose(rng, vocabulary[:60], rng.randint(1, 80)) for _ in range(150)] + [None, "", "Ünseen  WORDS\x0bhere", "a\u00a0b \u2003c", "a " * 5000]
    texts += [texts[0]]
    docs = docs_of(spark, texts).withColumns({"score": F.lit("clash"), "key": F.lit(1), "ids": F.lit("clash")})
    got = {r["doc_id"]: r for r in lm.score(docs, PATH, PATTERN).collect()}
    train, n = Counter(), 0
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update((t or "").encode().lower().split())
            n += 1
    total, distinct = sum(train.values()) + n, len(train) + 1
    for i, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        base = sum(np.log10((train[k] + 1) / (total + distinct + 1)) for k in w) + np.log10((n + 1) / (total + distinct + 1))
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w) + 1, sum(train[k] > 0 for k in w) + 1, total)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and np.isfinite(r["score"]) and r["score"] < 0
    assert got[0]["score"] == pytest.approx(got[len(texts) - 1]["score"], rel=1e-5)
    assert lm.score(docs.limit(0), PATH, PATTERN).count() == 0


def test_lm_rare_words_by_shuffle(spark, vocabulary, monkeypatch):
    """Base scores are the same whether words are broadcast or joined."""
    rng = random.Random(18)
    docs = docs_of(spark, [prose(rng, vocabulary, 40) for _ in range(60)])
    of = lambda: {r["doc_id"]: (r["n_known"], round(r["base_score"], 8)) for r in lm.score(docs, PATH, PATTERN).collect()}
    want = of()
    monkeypatch.setattr(lm, "WORDS", 5)
    monkeypatch.setattr(lm.most_frequent, "__defaults__", (5,))
    assert of() == want


def test_lm_is_a_distribution():
    """With a small vocabulary, the probabilities of all ids sum to one."""
    tokens = lm.Subwords({b" a": 0, b" b": 1, b"c": 2, b"d": 3, b" e": 4}, PATTERN)
    model = small_model(np.array([5, 3, 2, 1, 4, 2]) * 10**6, tokens)
    model.p = {k: v + np.float32(0.3) * np.random.default_rng(3).standard_normal(v.shape).astype(np.float32) for k, v in model.p.items()}
    (batch,) = lm.windows(np.arange(32) % 6, np.array([0, 32]), tokens.end)
    each = np.array([np.exp(model.run(*batch[:4], np.full(32, i))[0]) for i in range(6)])
    assert each.sum(axis=0) == pytest.approx(np.ones(32), abs=1e-5)


def test_lm_scores_do_not_depend_on_partitions(spark, vocabulary, monkeypatch):
    """The same texts, cut and dealt otherwise, in one shard and in several, get the same scores."""
    rng = random.Random(18)
    df = docs_of(spark, [prose(rng, vocabulary[:300], rng.randint(1, 90)) for _ in range(120)] + [None, ""])
    for ids in (16_000_000, 9_000):
        monkeypatch.setattr(lm, "SHARD_IDS", ids)
        one, many = ({r["doc_id"]: r for r in lm.score(df.repartition(n), PATH, PATTERN).collect()} for n in (1, 7))
        assert {i: r["score"] for i, r in one.items()} == pytest.approx({i: r["score"] for i, r in many.items()}, rel=1e-6)
        assert {i: r["base_score"] for i, r in one.items()} == pytest.approx({i: r["base_score"] for i, r in many.items()}, rel=1e-12)


def test_attention_by_plain_loops(vocabulary):
    """The window's log probabilities, one place after another with explicit sums."""
    tokens = lm.Subwords({b" a": 0, b" b": 1, b"c": 2, b"d": 3, b" e": 4}, PATTERN)
    model = small_model(np.array([5, 3, 2, 1, 4, 2]) * 10**6, tokens)
    rng = np.random.default_rng(4)
    model.p = {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in model.p.items()}
    model.direct = model.direct.astype(np.float64)
    p, lay, ids, end = model.p, model.layout, rng.integers(0, 5, 40), tokens.end
    before = np.concatenate(([end], ids[:-1]))  # what each place has seen last
    want = []
    for i, target in enumerate(ids):
        start = max(0, i // lm.SCORED * lm.SCORED - lm.OVERLAP)
        e = lambda j: p["embed"][lay.row[before[j]]]
        pair = lambda j: np.concatenate([e(j), p["embed"][lay.row[before[j - 1] if j else end]]])
        q = e(i) @ p["q"] / np.sqrt(lm.WIDTH)
        weights = np.array([np.exp(q @ (pair(j) @ p["k"]) + p["far"][i - j]) for j in range(start, i + 1)])
        seen = sum(w * (e(j) @ p["v"]) for w, j in zip(weights, range(start, i + 1), strict=True)) / weights.sum()
        hidden = np.append(np.maximum(np.concatenate([e(i), seen, [1]]) @ p["mix"], 0), 1)
        leaf = lay.leaf[target]
        group, member = divmod(leaf, lm.MEMBERS)
        direct = model.direct[lay.row[before[i]] * lm.GROUPS + group]
        zg, zi = hidden @ p["group"] + direct[: lm.GROUPS], hidden @ p["inside"][group] + direct[lm.GROUPS :]
        want.append(zg[group] - np.log(np.exp(zg).sum()) + zi[member] - np.log(np.exp(zi).sum()) + lay.log_share[target])
    assert lm.logs(model, ids, np.array([0, 40]), end) == pytest.approx(np.array(want), rel=1e-5)


def test_places():
    rng = np.random.default_rng(5)
    known = np.unique(rng.integers(-(2**63), 2**63 - 1, 3000))
    known = np.unique(np.concatenate([known, known[:500] + 1, [-(2**63), 2**63 - 1, 0]]))
    asked = np.concatenate([rng.permutation(known), rng.integers(-(2**63), 2**63 - 1, 2000), known + 7])
    place = dict(zip(known.tolist(), range(len(known)), strict=True))
    for bits in (4, 20):
        assert lm.Places(known, bits)(asked).tolist() == [place.get(h, -1) for h in asked.tolist()]
    assert lm.Places(known[:0])(asked[:3]).tolist() == [-1] * 3


def test_word_hashes():
    tokens = lm.subwords(PATH, PATTERN)
    flat, offsets = tokens([[b"one", b"two", b"one"], [], ["é\u00a0".encode(), b"onetwo", b"two"]])
    h = lm.word_hashes(flat, tokens.starts, tokens.end)
    assert len(h) == 6 and h[0] == h[2] and h[1] == h[5] and len(set(h.tolist())) == 4
    assert offsets[-1] == len(flat) and (flat[offsets[1:] - 1] == tokens.end).all()


# language identification


def test_language_id(spark):
    rng = random.Random(1)
    makers = {"aa": ["the", "and", "thing", "with"], "ab": ["thee", "ande", "wuth", "thong"], "ba": ["que", "los", "ción", "por"], "bb": ["les", "que", "eau", "pour"]}
    rows = [(i, " ".join(rng.choice(makers[n]) for _ in range(30)), n) for i, n in enumerate(rng.choice(list(makers)) for _ in range(400))]
    rows += [(900, None, "aa"), (901, "123 !!", "aa"), (902, "the thing", None), (903, "", "ba"), (None, "los que por", "ba")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in langid.predict(df, langid.fit(df.where(~langid.held_out()))).collect()}
    truth = {i: n for i, _, n in rows}
    held = [i for i in range(400) if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(400))
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in held]) > 0.95
    assert [got[i]["lang_pred"] for i in (900, 901, 903)] == ["und"] * 3 and got[902]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.predict(df, langid.fit(df.limit(0))).where("lang_pred != 'und'").count() == 0
    kept = langid.stage(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3


# sharding


def test_sharding(spark):
    rng = random.Random(2)
    texts = ["x" * rng.randint(0, 300) + str(i) for i in range(500)] + ["same text"] * 30 + [None, "", "é" * 2000] + ["big copy " * 10] * 300
    rows = docs_of(spark, texts).withColumn("size", F.octet_length(F.coalesce("text", F.lit(""))) + 1).withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary"))).withColumn("b", F.lit("clash"))
    got = shard.shard_by_bytes(rows, "digest", "size", "doc_id").collect()
    order = sorted(((hashlib.md5((t or "").encode()).hexdigest(), len((t or "").encode()) + 1, i) for i, t in enumerate(texts)))
    whole, start, want, slots = sum(o[1] for o in order), 0, {}, Counter()
    for _, size, i in order:
        k = min(7, start * 8 // whole)
        want[i] = (k, slots[k])
        slots[k] += 1
        start += size
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want
    assert "b" in rows.columns and got[0]["b"] == "clash"
    clash = shard.shard_by_bytes(rows.withColumns({"shard": F.lit("x"), "slot": F.lit("y")}), "digest", "size", "doc_id")
    assert sorted(clash.columns) == sorted([*rows.columns, "shard", "slot"]) and {r["doc_id"]: (r["shard"], r["slot"]) for r in clash.collect()} == want
    assert shard.shard_by_bytes(rows.limit(0), "digest", "size", "doc_id").count() == 0


# byte-level BPE


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_bpe_any_text(text):
    own = test_bpe_any_text.__dict__.setdefault("codec", bpe.codec(PATH, PATTERN))
    theirs = test_bpe_any_text.__dict__.setdefault("reference", tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={}))
    ids = own.encode(text)
    assert ids == theirs.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_bpe_long_pieces(codec, reference):
    rng = random.Random(4)
    for text in ("a" * 20_000, "".join(rng.choice("abcde") for _ in range(20_000)), "é" * 5000, "<|endoftext|>", " \n\n \t x"):
        assert codec.encode(text) == reference.encode_ordinary(text)


def test_bpe_columns(spark, codec, reference):
    texts = [None, "", "Hello  world 123", "naïve ☃"]
    df = docs_of(spark, texts).withColumn("ids", F.lit("clash"))
    coded = bpe.encode(df, PATH, PATTERN)
    back = {r["doc_id"]: r for r in bpe.decode(coded, PATH, PATTERN).collect()}
    assert [back[i]["text"] for i in range(4)] == ["", *texts[1:]]
    for r in bpe.round_trip_digests(df, PATH, PATTERN).collect():
        t = texts[r["doc_id"]] or ""
        ids = reference.encode_ordinary(t)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


# chat


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "a<<SAYS>>"]), st.text(alphabet="<>/[]sINSTYROLEA\\ \né", max_size=30)), max_size=6))
def test_chat_round_trip(turns):
    made = [chat.segment(r, x) for r, x in turns]
    assert chat.parse("".join(s for s, _, _ in made)) == turns
    assert [chat.unescape(s[a:b]) for (s, a, b), (r, _) in zip(made, turns, strict=True) if r == "assistant"] == [x for r, x in turns if r == "assistant"]


def test_chat_digests(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 1, "assistant", "b"), (2, 0, "user", chat.PROBE), (2, 2, "user", "x"), (3, 0, None, "r"), (None, 0, "user", "n"), (1, 1, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("position", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat.digests(chat.segments(df)).collect()}
    assert {k: (r["n_turns"], r["loss_chars"], r["valid"]) for k, r in got.items()} == {1: (3, 0, False), 2: (3, 1, False), 3: (1, 0, False), None: (1, 0, False)}
    assert got[2]["turns_sha256"] == hashlib.sha256(f"user\n{chat.PROBE}\nassistant\nb\nuser\nx\n".encode()).hexdigest()
    whole = {r["conv_id"]: r["formatted"] for r in chat.conversations(df).collect()}
    assert chat.parse(whole[2]) == [("user", chat.PROBE), ("assistant", "b"), ("user", "x")] and len(whole[2]) == got[2]["formatted_chars"]
    assert chat.digests(chat.segments(df.limit(0))).count() == 0


# nearest neighbours


def brute_neighbours(rows, k=5):
    """id to [(id, score)] for the ids that 50 divides."""
    width = max((len(v) for _, v in rows), default=0)
    x = np.array([list(v) + [0.0] * (width - len(v)) for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q, (i, _) in enumerate(rows):
        if i % 50 == 0:
            best = out.setdefault(i, {})
            for (j, _), s in zip(rows, x @ x[q], strict=True):
                if j != i:
                    best[j] = max(best.get(j, -2), s)
    return {q: sorted(best.items(), key=lambda r: (-round(r[1], 12), r[0]))[:k] for q, best in out.items()}


@pytest.mark.parametrize("block", [8192, 8])
def test_nearest_neighbours(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((60, 16))
    x = (centres[rng.integers(0, 60, 3000)] + 0.6 * rng.standard_normal((3000, 16))).astype(np.float32)
    x[200:260] = x[50]
    rows = [(int(i), [float(v) for v in x[i]]) for i in range(3000)]
    rows += [(50, [float(v) for v in x[77]]), (51, rows[51][1]), (51, rows[51][1]), (6000, rows[9][1][:7]), (6001, rows[9][1][:7])]
    bad = [(5000, None), (5050, [0.0] * 16), (5150, [float("nan")] * 16), (5200, [None, *[1.0] * 15]), (5250, []), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumns({"rank": F.lit("clash"), "h": F.lit(1)})
    got = {}
    for r in ann.search(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = brute_neighbours(rows)
    assert set(got) == set(want)
    hit = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q].values()}) for q in want)
    assert hit >= 0.9 * 5 * len(got)
    assert all(sorted(found) == [1, 2, 3, 4, 5] for found in got.values())
    exact = {(q, i): s for q, best in brute_neighbours(rows, len(rows)).items() for i, s in best}
    assert all(score == pytest.approx(exact[q, i], abs=1e-9) for q, found in got.items() for i, score in found.values())
    assert got[6000][1] == (6001, pytest.approx(1.0))


def test_nearest_neighbours_small(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0]), (3, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(df, df.where("vec_id % 50 = 0")).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 3, 1.0), (2, 1, 0.0), (3, 2, -1.0)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


# toxicity


def brute_segments(s):
    """Ruzzo and Tompa by recursion: the best segment, then left and right of it."""
    best = max(((sum(s[a:b]), -a, -b) for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    a, b = -best[1], -best[2]
    return [*brute_segments(s[:a]), (a, b), *[(x + b, y + b) for x, y in brute_segments(s[b:])]]


def test_passages():
    rng = random.Random(9)
    for _ in range(60):
        values = [rng.choice([-3, -1, -0.5, 1.25, 2.5, 4]) + rng.random() * 1e-3 for _ in range(rng.randint(0, 14))]
        assert [(a, b) for a, b, _ in toxicity.segments(np.array(values))] == brute_segments(values)


def test_passages_are_linear():
    """Positive tokens among neutral ones keep very many segments open."""
    took = []
    for n in (50_000, 400_000):
        values = np.where(np.arange(n) % 3 == 0, 1.0, -1.0)
        start = time.perf_counter()
        assert len(toxicity.segments(values)) == -(-n // 3)
        took.append(time.perf_counter() - start)
    assert took[1] < 40 * max(took[0], 0.02)


def test_sure_tokens_stay_sure():
    """A token that only toxic rows hold counts more, not less, the surer its prefix says the same."""
    keys = toxicity.hashes(b"stupid")
    for up in (0.5, 0.9, 0.999, 0.999999):
        table = toxicity.Table(np.array([keys[0]]), np.array([500]), np.array([0]), np.array([up]), -2.0)
        assert table.find([b"stupid"])[0][0] > 5
        clean = toxicity.Table(np.array([keys[0]]), np.array([0]), np.array([500]), np.array([1 - up]), 2.0)
        assert clean.find([b"stupid"])[0][0] < -5


def test_toxicity(spark, vocabulary):
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(600):
        w = prose(rng, vocabulary[:500], 60).split()
        toxic = int(rng.random() < 0.3)
        if toxic:
            k = rng.randrange(50)
            w[k : k + 4] = [rng.choice(["vile", "nasty", f"zzq{rng.randint(0, 99)}x", "grr"]) for _ in range(4)]
        rows.append((i, " ".join(w)))
        labels.append((i, 0, toxic))
    rows += [(700, None), (701, "")]
    rows += [(702, " ".join(vocabulary[:500]) * 40), rows[3]]
    labels += [(700, 0, 0), (5, 0, None), (999, 0, 1), (None, 0, 1), labels[3]]
    docs, marks = spark.createDataFrame(rows, DOC).withColumn("toxic", F.lit("clash")), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, marks).collect()}
    blocks = {r["doc_id"]: r for r in toxicity.score(docs, marks, bound=300).collect()}
    assert all(blocks[i]["score"] == pytest.approx(r["score"], abs=1e-6) for i, r in got.items())
    assert toxicity.score(docs.limit(0), marks).count() == 0
    truth = {i: t for i, _, t in labels[:600]}
    held = [i for i in truth if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in truth)
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.9
    assert got[700]["score"] == got[701]["score"] < 0.5 and all(0 <= r["score"] <= 1 for r in got.values())
    empty = toxicity.score(spark.createDataFrame(rows, DOC), spark.createDataFrame(labels[:0], "doc_id long, quality int, toxic int"))
    assert {r["score"] for r in empty.collect()} == {0.0}


# line dedup


def brute_line_dedup(rows):
    """What stays of (id, text) rows in order of ids. Every key (a line of 50 words, or two neighbouring lines of which not both
    have so many) has a first place; copies of it join where they stand in a row at the first place of one of them."""
    space, first, keyed = " \t\r\x0b\x0c", {}, []
    for d, (_, body) in enumerate(rows):
        lines = body.split("\n") if body is not None else []
        told = [k for k, line in enumerate(lines) if line.strip(space)]
        long = {k for k in told if len(lines[k].split()) >= 50}
        own = sorted([(k, k) for k in long] + [(a, b) for a, b in itertools.pairwise(told) if a not in long or b not in long])
        keyed.append([(own_, tuple(lines[k] for k in sorted(set(own_)))) for own_ in own])
        for p, (_, content) in enumerate(keyed[-1]):
            first.setdefault(content, (d, p))
    at = lambda d, p: keyed[d][p][1] if 0 <= p < len(keyed[d]) else None
    out = []
    for d, (_, body) in enumerate(rows):
        if body is None:
            out.append(None)
            continue
        lines, keys = body.split("\n"), keyed[d]
        told = [k for k, line in enumerate(lines) if line.strip(space)]
        copied = [p for p, (_, c) in enumerate(keys) if first[c] != (d, p)]
        gone, runs = {k[0] for p, (k, _) in enumerate(keys) if p in copied and k[0] == k[1]}, []
        for p in copied:
            (a, b), c = keys[p]
            if p and p - 1 in copied:
                was = keys[p - 1][1]
                (sd, sp), (td, tp) = first[was], first[c]
                if at(sd, sp + 1) == c or at(td, tp - 1) == was:
                    runs[-1][1] = told.index(b)
                    continue
            runs.append([told.index(a), told.index(b)])
        sizes = [b - a + 1 for a, b in runs]
        for k, (a, b) in enumerate(runs):
            keep = False
            for j, mine in ((k - 1, 0), (k + 1, 1)):
                if 0 <= j < len(runs) and runs[j][1 - mine] == runs[k][mine]:
                    keep |= sizes[j] == sizes[k] == 2 or max(sizes[j], sizes[k]) <= 2
                    if sizes[j] > sizes[k] or (sizes[j] == sizes[k] and j < k):
                        a, b = (a + 1, b) if mine == 0 else (a, b - 1)
            if not keep and b > a:
                gone |= set(told[a : b + 1])
        for a, b in itertools.pairwise(told):
            if a in gone and b in gone:
                gone |= set(range(a, b))
        out.append("\n".join(line for k, line in enumerate(lines) if k not in gone))
    return out


def test_line_dedup(spark, vocabulary):
    rng = random.Random(11)
    shared = "\n".join(prose(rng, vocabulary, 18) for _ in range(5))
    long_line = f"{prose(rng, vocabulary, 30)}. {prose(rng, vocabulary, 30)}."
    texts = []
    for i in range(40):
        lines = [prose(rng, vocabulary, rng.randint(3, 45)) for _ in range(rng.randint(1, 9))]
        if i % 4 == 0:
            lines.insert(rng.randrange(len(lines) + 1), shared)
        if i % 5 == 0:
            lines.append(long_line)
        lines.append("All rights reserved.")
        texts.append("\n".join(lines))
    texts += [None, "", "\n\n", texts[3], texts[3], "short\nlines", "x\nshort\n \n\nlines\ny", "\n".join(["again"] * 9), "w " * 50_000 + ".\n" + "v\n" * 3000]
    df = docs_of(spark, texts).withColumns({"n_chars": F.char_length("text").cast("long"), "id": F.lit("clash"), "h": F.lit(1)})
    out = linededup.line_dedup(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    want = brute_line_dedup(list(enumerate(texts)))
    assert [got[i]["text"] for i in range(len(texts))] == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values() if r["text"] is not None)
    assert sum(long_line in (r["text"] or "") for r in got.values()) == 1 and want[46] == "x\ny"
    # a line that stands alone stays, with what surrounds it
    assert all("All rights reserved." in got[i]["text"] for i in range(40) if i % 4 and i % 5)
    kept = {r["doc_id"] for r in linededup.stage(df).collect()}
    assert kept == {i for i, t in enumerate(texts) if want[i] != "" or t == ""}
    assert linededup.line_dedup(df.limit(0)).count() == 0


def test_line_dedup_repeated_rows(spark):
    """Rows with equal id and text are one document, and get one result."""
    rows = [(1, "a b\nc d"), (1, "a b\nc d"), (2, "a b\nc d\ne"), (None, "a b\nc d\nf")]
    got = sorted(r["text"] for r in linededup.line_dedup(spark.createDataFrame(rows, DOC)).collect())
    assert got == ["", "", "a b\nc d\nf", "e"]


def test_line_dedup_keeps_what_stands_once(spark, vocabulary):
    """Lines that come up in other pairs only are no copy; long lines are alike with one sentence and with two; a passage goes
    beside a line that is shared with another one."""
    rng = random.Random(16)
    one, two = prose(rng, vocabulary, 60) + ".", f"{prose(rng, vocabulary, 30)}. {prose(rng, vocabulary, 30)}."
    short, split = prose(rng, vocabulary, 12) + ".", f"{prose(rng, vocabulary, 6)}. {prose(rng, vocabulary, 6)}."
    p, q = ([prose(rng, vocabulary, 15) for _ in range(4)] for _ in range(2))
    rows = [(3, "A\nB"), (4, "B\nC"), (5, "A\nB\nC"), (10, f"a1\n{one}\na2\n{two}\na3\n{short}\na4\n{split}"), (11, f"b1\n{one}\nb2\n{two}\nb3\n{short}\nb4\n{split}")]
    rows += [(20, "\n".join(["c1", *p, "shared", "c2"])), (21, "\n".join(["d1", "shared", *q, "d2"])), (22, "\n".join(["e1", *p, "shared", *q, "e2"])), (23, "\n".join(["c1", *p, "e3"])), (24, "\n".join(["e1", *p, "shared", "e4"]))]
    got = {r["doc_id"]: r["text"] for r in linededup.line_dedup(spark.createDataFrame(rows, DOC)).collect()}
    assert [got[i] for i, _ in rows] == brute_line_dedup(rows)
    assert got[5] == "A\nB\nC" and got[11] == f"b1\nb2\nb3\n{short}\nb4\n{split}"
    assert got[22] == "e1\ne2" and got[23] == "e3" and got[24] == "e4"


def test_line_dedup_random(spark):
    rng = random.Random(17)
    long = [" ".join(f"w{k}{i}" for i in range(50 + k)) for k in range(2)]
    pool = [*"abcdefg", "", " ", *long]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9)))) for i in range(150)]
    got = {r["doc_id"]: r["text"] for r in linededup.line_dedup(spark.createDataFrame(rows, DOC)).collect()}
    assert [got[i] for i, _ in rows] == brute_line_dedup(rows)


def test_line_dedup_passages_of_short_lines(spark, vocabulary):
    """Passages of 51 words and more in 2 to 8 short lines go from each copy whatever stands around them."""
    rng = random.Random(15)
    texts, kept, n = [], [], itertools.count()
    own = lambda: "\n".join(f"own{next(n)} {prose(rng, vocabulary, rng.randint(2, 20))}" for _ in range(rng.randint(1, 3)))
    for lines in range(2, 9):
        passage = [f"p{lines}l{k} " + prose(rng, vocabulary, -(-51 // lines)) for k in range(lines)]
        for copy in range(12):
            between = "\n\n" if copy % 3 == 2 else "\n"
            above, below = own(), own()
            texts.append("\n".join([above, between.join(passage), below]))
            kept.append("\n".join([above, below]) if copy else texts[-1])
    got = {r["doc_id"]: r["text"] for r in linededup.line_dedup(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == kept


# decontamination


def brute_hits(texts, items, n=10):
    windows = {}
    for item, t in items:
        w = decontaminate.words((t or "").encode())
        k = min(n, len(w))
        for j in range(len(w) - k + 1) if w else ():
            windows.setdefault(tuple(w[j : j + k]), set()).add(item)
    out = {}
    for i, t in texts:
        w, hit, found = decontaminate.words((t or "").encode()), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in windows:
                    hit |= set(range(j, j + k))
                    found |= windows[tuple(w[j : j + k])]
        out[i] = (len(w), len(hit), sorted(x for x in found if x is not None))
    return out


@pytest.mark.parametrize("block", [4_000_000, 60])
def test_decontamination(spark, vocabulary, block):
    rng = random.Random(13)
    items = [(i, prose(rng, vocabulary, rng.randint(11, 40))) for i in range(8)] + [(20, "short  ITEM!"), (21, None), (22, "..."), (None, prose(rng, vocabulary, 12))]
    texts = []
    for i in range(30):
        w = prose(rng, vocabulary, 60)
        texts.append((i, w + " " + items[i % 8][1].upper().replace(" ", ", ") + " " + w if i % 3 == 0 else w))
    texts += [(50, None), (51, ""), (52, "a Short-item; b"), (53, items[-1][1]), (54, "ab " * 30_000), (52, "a Short-item; b")]
    df = spark.createDataFrame(texts, DOC).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find(df, bench, block_words=block).collect()
    want = brute_hits(texts, items)
    for r in got:
        spans = r[decontaminate.SPANS]
        assert (r[decontaminate.WORDS], sum(spans[1::2]) - sum(spans[::2]), r[decontaminate.ITEMS]) == want[r["doc_id"]]
    kept = decontaminate.decontaminate(df, bench, block_words=block)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i, x in want.items() if not x[1]}
    cut = decontaminate.decontaminate(df, bench, remove="spans", block_words=block)
    for r in cut.collect():
        assert len(decontaminate.words((r["text"] or "").encode())) == want[r["doc_id"]][0] - want[r["doc_id"]][1]
    assert decontaminate.find(df, bench.limit(0)).where(F.size(decontaminate.SPANS) > 0).count() == 0
