"""BPE against the reference library, exact round trips, quality rules, classifier."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import WORD, quality as plain_quality
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from folioflow.llm import bpe, classifier, quality
from folioflow.llm.common import slices, utf8

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_50k.tiktoken")
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})
CODER = bpe.Encoder(PATH)
TEXTS = ["", None, " ", "  a", "a  ", "\n\nx", "it's we'll they're 's ' s''s", "x" * 700 + "'re" * 200, "日本語 123 ４５ ½", "a　b  c\x1cd", "😀" * 50, "é" * 300]


def encode(texts):
    ids, at, first = CODER.encode(*utf8(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def test_encodes_as_the_library():
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("aAstrevlmd'' \t\n 19é²!.#　\x1c漢😀") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert encode(texts) == [LIBRARY.encode_ordinary(t or "") for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=5))
def test_encodes_any_text(texts):
    got = encode(texts)
    assert got == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [CODER.decode(np.array(g, np.int64)).decode() for g in got] == texts


@pytest.mark.parametrize("n", [1, 255, 256, 257, 70_000])
def test_scan_equals_a_loop(n):
    kinds = np.random.default_rng(n).integers(0, 10, n).astype(np.uint8)
    state, want = bpe.FREE, []
    for k in kinds:
        want.append(state)
        state = bpe._step(state, int(k))[0]
    assert bpe.states_before(kinds).tolist() == want


def test_round_trip_in_frames(spark):
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    coded = bpe.encode_texts(df, PATH, check=True)
    assert coded.columns == ["doc_id", "text", "ids", "id_offsets", "round_trip"]
    for r in bpe.decode_texts(coded, PATH).collect():
        assert r["decoded"] == (r["text"] or "").encode() and r["round_trip"]
        assert all((r["text"] or "").encode()[a:].startswith(CODER.decode(np.array([i]))) for i, a in zip(r["ids"], r["id_offsets"]))


def test_base_counts():
    rng = random.Random(9)
    texts = ["", None, "\n", "a\na\n a\na\r\n", "x\x0by\x0cz", "a b c d e a b c d e", "# $ % | <>&*"] + [" ".join(rng.choice("ab\n#") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    rules = quality.Rules(P.path("piece_bpe_32k.model"))
    got = []
    for _, data, offsets in slices(pa.record_batch({"text": pa.array(texts)}), limit=500):
        found = rules(data, offsets)
        got += zip(*(found[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))
    assert got == [plain_quality(t) for t in texts]


def test_fertility_measures():
    rules = quality.Rules(P.path("piece_bpe_32k.model"))
    text = "The quick brown fox jumps over the lazy dog. " * 3 + "naïve \U0001f9ff"
    found = rules(*utf8(pa.array([text])))
    ids = [i for w in WORD.findall(text) for i in rules.model.encode(w)]
    assert found["chars_per_token"][0] == pytest.approx(sum(map(len, WORD.findall(text))) / len(ids))
    assert found["byte_share"][0] == pytest.approx(np.mean([rules.is_byte[i] for i in ids])) and found["byte_share"][0] > 0


def test_verdicts(spark):
    prose = " ".join(f"{a} {b} went home and slept" for a, b in zip(["Anna", "Bert", "Carl", "Dora", "Emil", "Fred"], ["who", "then", "soon", "later", "now", "once"]))
    noise = " ".join("".join(chr(0x13000 + (i * 37 + j * 101) % 900) for j in range(4)) for i in range(60)) + " abc" * 1
    df = spark.createDataFrame([(1, prose + " in the old house by the river"), (2, None), (3, "too short"), (4, "same words again here now " * 20), (5, "q9 " + "x7z 0f8 11e 93k 4bq 8vw p2x zz1 k0k 7j7 " * 1 + noise)], "doc_id long, text string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.judge(df, P.path("piece_bpe_32k.model")).collect()}
    assert got[1] == (False, True) and got[2] == got[3] == got[4] == (True, False)
    assert {r["script"] for r in quality.judge(df.where("doc_id = 2"), P.path("piece_bpe_32k.model")).collect()} == {"none"}


def test_held_out_accuracy():
    rng = random.Random(8)
    good = lambda: " ".join(rng.choice(["river", "house", "the", "and", "went", "slowly"]) for _ in range(30))
    bad = lambda: " ".join(rng.choice(["CLICK!!", "win$$$", "###", "free***"]) for _ in range(30))
    texts = [good() if i % 3 else bad() for i in range(300)]
    labels = np.array([int(bool(i % 3)) for i in range(300)])
    rows = [classifier.packed(np.frombuffer(t.encode(), np.uint8)) for t in texts[:200]]
    weights, bias = classifier.train(rows, labels[:200])
    again, _ = classifier.train(rows, labels[:200])
    assert np.array_equal(weights, again)
    right = 0
    for t, y in zip(texts[200:], labels[200:]):
        f, _ = classifier.features(*utf8(pa.array([t])))
        right += (weights[f].mean() + bias > 0) == bool(y)
    assert right >= 98


def test_scores_without_labels(spark):
    weights, bias = classifier.train([], np.array([], np.int64))
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    assert {r["score"] for r in classifier.score(df, weights, bias).collect()} == {0.5}


def test_sample_leaves_out_held_out_and_contradictory_rows(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 1), (1, 0), (2, 0), (3, None), (4, 7), (5, 1)], "doc_id long, quality int")
    rows, y = classifier.labelled_sample(docs.union(docs), labels.union(spark.createDataFrame([(77, 1)], labels.schema)), lambda key: key == 5, max_rows=2)
    assert (rows, y.tolist()) == ([classifier.packed(np.frombuffer(t, np.uint8)) for t in (b"t0", b"t2")], [1, 0])


def test_long_texts_are_counted_whole_in_pieces(monkeypatch):
    rng = random.Random(5)
    text = " ".join("é" * rng.randint(0, 2) + f"w{rng.randint(0, 300)}" for _ in range(9000)) + " same same " + "x" * 5000
    data = np.frombuffer(text.encode(), np.uint8)
    want, _ = classifier.features(data, np.array([0, len(data)]))
    at, counts = np.unique(want, return_counts=True)
    for piece in (1 << 20, 4000, 50):
        monkeypatch.setattr(classifier, "PIECE", piece)
        got, share = classifier.unpacked(classifier.packed(data))
        assert got.tolist() == at.tolist() and np.array_equal(share, (counts / len(want)).astype(np.float32))


def test_scores_keep_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", "s", 7, "m")], "doc_id long, text string, score string, label int, mean string")
    weights, bias = classifier.train([], np.array([], np.int64))
    out = classifier.score(df, weights, bias)
    assert out.columns == ["doc_id", "text", "label", "mean", "score"] and out.first()["score"] == 0.5 and out.first()["mean"] == "m"
    assert classifier.score(df.limit(0), weights, bias).count() == 0
    assert classifier.labelled_sample(df.limit(0), df.select("doc_id", F.lit(1).alias("quality")), lambda key: F.lit(False))[0] == []


def test_encoding_keeps_what_it_does_not_make(spark):
    names = "doc_id long, text string, ids string, n_tokens string, ids_sha256 int, round_trip int, id_offsets string, decoded_sha256 int"
    df = spark.createDataFrame([(1, "a b", "i", "n", 7, 8, "o", 9), (1, "a b", "i", "n", 7, 8, "o", 9), (2, None, None, None, None, None, None, None), (3, "", "x", "y", 1, 1, "z", 1)], names)
    plain = bpe.encode_texts(df, PATH, places=False).where("doc_id = 1").collect()
    assert len(plain) == 2 and {(r["n_tokens"], r["ids_sha256"], r["round_trip"], r["id_offsets"], tuple(r["ids"])) for r in plain} == {("n", 7, 8, "o", tuple(LIBRARY.encode_ordinary("a b")))}
    told = bpe.encode_texts(df, PATH, digests=True)
    assert {(r["doc_id"], r["ids"], r["n_tokens"]) for r in told.collect()} == {(1, "i", 2), (2, None, 0), (3, "x", 0)}
    for more in ({}, {"digests": True}, {"check": True}):
        assert bpe.encode_texts(df.limit(0), PATH, **more).count() == 0
    assert bpe.decode_texts(bpe.encode_texts(df, PATH), PATH).where("decoded = encode(coalesce(text, ''), 'utf-8')").count() == 4


def test_judging_odd_tables(spark):
    vocabulary = P.path("piece_bpe_32k.model")
    rows = [(1, "one two three four five six seven eight nine ten eleven", 5, "k", "g"), (1, "one two three four five six seven eight nine ten eleven", 5, "k", "g"), (None, None, None, None, None), (3, "", 0, "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang int, kept string, __x string")
    got = quality.judge(df, vocabulary)
    assert got.columns[:4] == ["doc_id", "text", "lang", "__x"] and sorted(r["kept"] for r in got.collect()) == [False, False, True, True]
    assert quality.judge(df.limit(0), vocabulary).count() == 0
    # A dozen words in byte fallback: bands widen for short texts, but not so far.
    garbled = " ".join("ab" + "".join(chr(0x1FAE0 + (i * 5 + j * 3) % 8) for j in range(3)) for i in range(12))
    found = quality.judge(spark.createDataFrame([(1, garbled), (2, " ".join("ab" + chr(97 + i) * 2 for i in range(12)))], "doc_id long, text string"), vocabulary).collect()
    assert {r["doc_id"]: (r["base_failed"], r["kept"]) for r in found} == {1: (False, False), 2: (False, True)}


def test_scripts_by_code_point():
    from folioflow.llm.quality import SCRIPTS, scripts

    for text, want in {"Ḁḃ": "latin", "ἀβ": "cyrillic_greek", "😀🎉 ok": "latin", "😀": "none", "𠀀漢": "cjk", "ไทย": "other", "𐌰𐌱": "other", "“—” 1": "none", "été": "latin", "мир": "cyrillic_greek"}.items():
        data, offsets = utf8(pa.array([text]))
        assert SCRIPTS[scripts(data, offsets)[0]] == want, text
