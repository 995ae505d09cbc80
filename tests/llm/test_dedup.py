"""Substring, suffix and near-duplicate operators against brute force."""

import random

import numpy as np
import pytest
from brute import classes, fingerprint, shingles, substrings, suffixes
from pyspark.sql import functions as F

from folioflow.llm import simhash, substrings as by_words, suffixes as by_bytes

VOCABULARY = ["alpha", "béta", "gamma", "δ", "e", "zeta", "eta!", "THETA", "i", "kappa", "漢字", "mu"]


def corpus(seed=3, n=60):
    """Prose from few words with shared passages, copies, near copies, runs of one letter, nulls and empties."""
    rng = random.Random(seed)
    prose = lambda k: " ".join(rng.choice(VOCABULARY) + str(rng.randint(0, 40)) for _ in range(k))
    shared = [prose(30), prose(18), "a" * 260, "ab " * 90]
    rows = []
    for i in range(n):
        kind = i % 6
        text = prose(rng.randint(1, 60))
        if kind == 1:
            text = prose(5) + " " + rng.choice(shared) + "\n" + prose(9)
        elif kind == 2 and rows:
            text = rng.choice(rows)[1]
        elif kind == 3 and rows:
            w = (rng.choice(rows)[1] or "x").split(" ")
            w[rng.randrange(len(w))] = "edit"
            text = " ".join(w)
        elif kind == 4:
            text = rng.choice(shared)[: rng.randint(80, 260)] + rng.choice(shared)
        rows.append((i * 7 % n, text))
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "one word"), (n + 4, shared[0] * 3)]


@pytest.fixture
def docs(spark):
    rows = corpus()
    return rows, spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, h string")


def test_word_windows(docs):
    rows, df = docs
    assert {r[0]: tuple(r)[1:] for r in by_words.removed(df).collect()} == substrings(rows)


def test_byte_windows(docs):
    rows, df = docs
    assert {r[0]: tuple(r)[1:] for r in by_bytes.removed(df).collect()} == suffixes(rows)


def test_hot_anchors_are_dealt_by_window(docs, monkeypatch):
    rows, df = docs
    monkeypatch.setattr(by_bytes, "HOT", 1)
    assert {r[0]: tuple(r)[1:] for r in by_bytes.removed(df).collect()} == suffixes(rows)


def test_kept_texts(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j k l m"), (2, "x a b c d e f g h i j k l m y")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in by_words.removed(df, texts=True).collect()} == {1: "a b c d e f g h i j k l m", 2: "x y"}


def test_merged_order_has_equal_windows_together():
    rng = np.random.default_rng(1)
    bodies = [bytes(rng.integers(97, 99, rng.integers(100, 180), dtype=np.uint8)) for _ in range(30)] + [b"a" * 150, b"ab" * 80]
    bodies += [b[3:] + b"z" * 3 for b in bodies[:10]]
    windows = np.array([len(b) - 99 for b in bodies])
    docs, starts = np.arange(len(bodies)) // 3, np.arange(len(bodies)) % 3 * 1000
    first = {}
    for i, b in enumerate(bodies):
        for k in range(windows[i]):
            key = b[k : k + 100]
            first[key] = min(first.get(key, (1 << 60, 0)), (docs[i], starts[i] + k))
    want = {(i, k) for i, b in enumerate(bodies) for k in range(windows[i]) if first[b[k : k + 100]] != (docs[i], starts[i] + k)}
    assert set(zip(*(x.tolist() for x in by_bytes.repeated_windows(bodies, windows, docs, starts)))) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert by_words.removed(df).count() == by_bytes.removed(df).count() == simhash.near_duplicates(df).count() == simhash.one_of_each(df).count() == 0


def test_keys_may_be_null_or_repeat(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (9, text)], "doc_id long, text string")
    assert sorted((r[0] or -1, r[2]) for r in by_words.removed(df).collect()) == [(-1, 0), (5, 0), (5, 0), (9, 40)]
    assert sorted((r[0] or -1, r[2] > 0) for r in by_bytes.removed(df).collect()) == [(-1, False), (5, False), (5, False), (9, True)]
    assert sorted(r["doc_id"] or -1 for r in simhash.one_of_each(df).collect()) == [-1, 5, 5]


def test_fingerprints_and_components(docs):
    rows, df = docs
    prints = {i: fingerprint(t) for i, t in rows}
    keys = sorted(prints)
    least = classes(keys, [(a, b) for a in keys for b in keys if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    assert got == {i: (prints[i], least[i]) for i in keys}


@pytest.mark.parametrize("max_shard", [20_000, 2])
def test_links_join_all_within_the_radius(spark, max_shard):
    rng = random.Random(4)
    codes = {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
    for c in list(codes):
        for _ in range(3):
            codes.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    codes = sorted(codes)
    least = classes(codes, [(a, b) for a in codes for b in codes if a < b and (a ^ b).bit_count() <= 3])
    signed = lambda c: c - (1 << 64) if c >> 63 else c
    df = spark.createDataFrame([(signed(c),) for c in codes], "fp long")
    roots = dict(simhash.components(simhash.link(df, 3, max_shard)).collect())
    groups = lambda of: {frozenset(c for c in codes if of(c) == of(d)) for d in codes}
    assert groups(lambda c: roots.get(signed(c), signed(c))) == groups(least.get)


def test_tree_finds_all_within():
    rng = random.Random(6)
    codes = list({rng.getrandbits(12) for _ in range(300)})
    tree = simhash.BKTree()
    for c in codes:
        tree.add(c)
    for q in codes[:40]:
        assert {codes[i] for i in tree.within(q, 3)} == {c for c in codes if (c ^ q).bit_count() <= 3}


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(70)] + [(1000, 1001 + i) for i in range(50)] + [(5000, 5000)]
    got = dict(simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {i: 0 for i in range(71)} | {i: 1000 for i in range(1000, 1051)}


def test_one_of_each_resembling(docs):
    rows, df = docs
    sets = {i: set(shingles(t, 5)) for i, t in rows}
    keys = [i for i in sets if sets[i]]
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    least = classes(keys, [(a, b) for a in keys for b in keys if a < b and alike(a, b)])
    want = {i for i in sets if least.get(i, i) == i}
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    assert {r["doc_id"] for r in got.select(F.col("doc_id")).collect()} == want


@pytest.mark.parametrize("max_meet", [4096, 2, 7])
def test_shards_of_many_classes(spark, max_meet):
    """One passage in all texts, beside chains of near copies and texts of their own: few shards hold everything."""
    rng = random.Random(11)
    prose = lambda k: [f"{rng.getrandbits(30):x}" for _ in range(k)]
    passage = prose(80)
    rows = []
    for i in range(12):
        words = passage + prose(20)
        for _ in range(5):
            rows.append((len(rows), " ".join(words)))
            words = words[:-2] + prose(2) if i % 2 else words[2:] + prose(1)
    rows += [(len(rows) + i, " ".join(prose(8) + passage[i:])) for i in range(0, 60, 3)]
    sets = {i: set(shingles(t, 5)) for i, t in rows}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    least = classes(list(sets), [(a, b) for a in sets for b in sets if a < b and alike(a, b)])
    assert 3 < len(set(least.values())) < len(rows)
    got = simhash.resembling(spark.createDataFrame(rows, "doc_id long, text string"), max_meet=max_meet)
    assert dict(got.collect()) == least


def test_clashing_columns(spark):
    rows = [(1, "a b c d e f", "x", 5), (2, "a b c d e f", "y", 6), (3, None, "z", 7), (4, "", None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fingerprint int")
    assert sorted(tuple(r) for r in simhash.one_of_each(df).collect()) == [rows[0], *rows[2:]]
    assert len(simhash.near_duplicates(df).collect()) == 4


def test_long_texts_are_compared_exactly(spark):
    rng = random.Random(9)
    rows, want = [], set()
    for k in range(20):
        words = [f"{rng.getrandbits(40):x}" for _ in range(5004)]
        # 4,000 of 5,000 shingles, or one less
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[: 4004 - k % 2]))]
        want |= {2 * k, *([2 * k + 1] if k % 2 else [])}
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in got.select("doc_id").collect()} == want
