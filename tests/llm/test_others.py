"""Search, pseudonyms, mixing, secrets and the pipeline."""

import random
import re

import duckdb
import numpy as np
import pytest
from brute import classes, shingles
from pyspark.sql import functions as F

from folioflow.llm import ann, bpe, mixing, pii, queries, secrets

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
DATA = "/root/testdata/sf0.001"


def test_search_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 16))
    x = (centres[rng.integers(0, 12, 1500)] + 0.6 * rng.standard_normal((1500, 16))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [1.0] * 3), (None, [1.0] * 16), (5080, [None] + [1.0] * 15), (5100, [float("inf")] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 1500, 20))
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        score = x.astype(np.float64) @ x[q].astype(np.float64)
        for _, i, s in found:
            assert s == pytest.approx(score[i], rel=1e-12) and i != q
        score[q] = -np.inf
        hits += len({i for _, i, _ in found} & set(np.lexsort((np.arange(1500), -score))[:20].tolist()))
    assert hits >= 0.9 * 20 * len(got)


def test_search_with_few_candidates_and_ties(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (7, [1.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 7), (0, 2, 20), (0, 3, 3), (20, 1, 0), (20, 2, 7), (20, 3, 3)]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_search_counts_repeated_ids_once(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((60, 8)).astype(np.float32)
    rows = [(i, v.tolist(), 1.0) for i, v in enumerate(x)]
    longer = [(7, (x[7] + 100).tolist(), 0.0), (40, (x[40] + 100).tolist(), 0.0)]  # the least vector of an id counts
    df = spark.createDataFrame(rows * 3 + longer, "vec_id long, embedding array<float>, score double")
    want = []
    for q in (0, 20, 40):
        score = x.astype(np.float64) @ x[q].astype(np.float64)
        want += [(q, r + 1, i) for r, i in enumerate([i for i in np.lexsort((np.arange(60), -score)).tolist() if i != q][:20])]
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want] and len(set(got) & set(want)) >= 0.9 * len(want)
    assert len({(q, i) for q, _, i in got}) == len(got)


def test_search_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_BYTES", 8 * 16 * 300)
    monkeypatch.setattr(ann, "QUERY_BYTES", 8 * 16 * 20)
    test_search_recall_and_scores(spark)


def test_probing_retrieves_every_code_within():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 2**63, (400, 2), dtype=np.uint64)
    near = codes[:100].copy()
    for i in range(100):
        near[i, i % 2] ^= np.uint64(((1 << (i % 20)) - 1) << 7)
    codes = np.concatenate([codes, near])
    index = ann.MultiIndex(codes, 8)
    for flips in (0, 1, 2, 8):
        for i in range(30):
            at = index.probe(index.values[i], flips)
            parts = np.bitwise_count(index.values ^ index.values[i]).min(1)
            assert at.tolist() == np.flatnonzero(parts <= flips).tolist()
            true = np.bitwise_count(codes ^ codes[i]).sum(1)
            assert set(np.flatnonzero(true <= index.m * (flips + 1) - 1)) <= set(at.tolist())


# --- pseudonyms ------------------------------------------------------------------


def luhn(number):
    return sum(d if i % 2 == 0 else (2 * d - 9 * (d > 4)) for i, d in enumerate(map(int, reversed(number)))) % 10 == 0


def replaced(spark, texts, **more):
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, n_card int")
    return {r["doc_id"]: r for r in pii.pseudonymise(df, **{"key": "k", **more}).collect()}


def test_pseudonyms_keep_form_and_validity(spark):
    rng = random.Random(1)
    cards = []
    while len(cards) < 60:
        n = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        if luhn(n):
            cards.append(n)
    ips = [".".join(str(rng.randint(0, 255)) for _ in range(4)) for _ in range(60)]
    phones = [f"+1 ({rng.randint(0, 999):03}) 555-{rng.randint(0, 9999):04}" for _ in range(60)]
    texts = [f"é {c}, {i}: {p}. mail{k}@x-y.example.com 2024-02-29 31.12.1999 123-45-678{k % 9 + 1}" for k, (c, i, p) in enumerate(zip(cards, ips, phones))]
    got = replaced(spark, texts)
    form = lambda t: re.sub(r"[a-z]", "a", re.sub(r"\d", "9", t))
    ip_form = lambda t: form(re.sub(r"\d+\.\d+\.\d+\.\d+", "", t))
    seen = []
    for k, t in enumerate(texts):
        new = got[k]["text"]
        assert new != t and ip_form(new) == ip_form(t)
        assert luhn(re.search(r"\d{16}", new)[0])
        assert all(int(x) < 256 for x in re.search(r"\d+\.\d+\.\d+\.\d+", new)[0].split("."))
        assert [got[k][f"n_{x}"] for x in pii.KINDS] == [1, 1, 2, 1, 1, 1]
        seen.append(re.search(r"\d{16}", new)[0])
    assert len(set(seen)) == len(set(cards))
    assert {t: r["text"] for t, r in zip(texts, got.values())} == {t: r["text"] for t, r in zip(texts, replaced(spark, texts).values())}
    assert replaced(spark, texts[:1], key="other")[0]["text"] != got[0]["text"]


def test_equal_values_stay_linked(spark):
    got = replaced(spark, ["4845168114407329 x 1.2.3.4", "y 4845168114407329", "4845-1681-1440-7329 and 1.2.3.4"])
    card = [re.sub(r"\D", "", re.search(r"\d{4}-?\d{4}-?\d{4}-?\d{4}", r["text"])[0]) for r in got.values()]
    ip = [re.search(r"\d+\.\d+\.\d+\.\d+", got[i]["text"])[0] for i in (0, 2)]
    assert len(set(card)) == 1 and len(set(ip)) == 1


@pytest.mark.parametrize(
    "forms",
    [
        ["+49 30 1234567", "+49301234567", "+49 (30) 1234567", "+49-30-123-4567"],
        ["+1 555 123 4567", "(555) 123-4567", "555-123-4567", "555.123.4567", "+1 (555) 123-4567", "+15551234567"],
        ["+358 40 123 4567", "+358401234567"],
        ["2024-02-29", "2024/02/29", "29.02.2024", "29/02/2024", "02/29/2024"],
        ["4845168114407329", "4845 1681 1440 7329", "4845-1681-1440-7329"],
    ],
)
def test_a_value_has_one_pseudonym_in_all_its_forms(spark, forms):
    got = replaced(spark, forms)
    new = [got[i]["text"] for i in range(len(forms))]
    assert all(re.sub(r"\d", "9", n) == re.sub(r"\d", "9", f) and n != f for n, f in zip(new, forms))
    if forms[0][4:5] == "-":  # dates: the day is the same
        from datetime import datetime

        patterns = ["%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%d/%m/%Y", "%m/%d/%Y"]
        assert len({datetime.strptime(n, p) for n, p in zip(new[:3], patterns)}) == 1
    else:
        assert len({re.sub(r"\D", "", n)[-10:] for n in new}) == 1


def test_emails_are_linked_in_any_case(spark):
    got = replaced(spark, ["Bob.Smith7@x.org", "bob.smith7@x.org", "BOB.SMITH7@x.org"])
    new = [got[i]["text"] for i in range(3)]
    assert len({n.lower() for n in new}) == 1 and new[0][0].isupper() and new[0][1].islower() and new[2].split("@")[0].isupper()


def test_pseudonyms_need_a_key(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="folioflow.pii.key"):
        pii.pseudonymise(df)
    assert pii.pseudonymise(df.limit(0), key="k").count() == 0


@pytest.mark.parametrize("text", ["4845168114407328", "300.1.2.3", "1.2.3.4.5", "2023-02-29", "000-12-3456", "x@y", "12", "", None, "1,234,567", "v1.2.3", "a" * 50_000])
def test_what_is_not_valid_stays(spark, text):
    r = replaced(spark, [text])[0]
    assert r["text"] == text and not any(r[f"n_{k}"] for k in pii.KINDS)


def test_permutations_are_bijections(spark):
    n = spark.range(300).select(pii.permute_number("k", "t", F.col("id"), 15, 20).alias("x"))
    assert {r["x"] for r in n.collect()} == set(range(300))
    t = spark.range(1000).select(pii.permute_text("k", "t", F.lpad(F.col("id").cast("string"), 3, "0")).alias("x"))
    assert {r["x"] for r in t.collect()} == {f"{i:03}" for i in range(1000)}


# --- mixing ------------------------------------------------------------------------


def plain_targets(sizes, cap=3):
    """Share by weight, clamp what is above, share the rest again."""
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, fixed, out = sum(sizes.values()), {}, {}
    while True:
        left = {s: weight[s] for s in sizes if s not in fixed}
        rest = total - sum(fixed.values())
        out = fixed | {s: rest * w / sum(left.values()) for s, w in left.items()}
        above = {s: cap * sizes[s] for s in left if out[s] > cap * sizes[s]}
        if not above:
            return out
        fixed |= above


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(0, 80)) if i % 11 else None, rng.choice(["a", "b", "b", "b", "b", "b", "b", "ä", None, "z" if i < 9 else "c"])) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in mixing.mix(df).collect()}
    sizes, taken = {}, {}
    for i, t, s in rows:
        assert got[i]["size"] == len((t or "").split()) and got[i]["taken"] <= 3 * got[i]["size"]
        sizes[s] = sizes.get(s, 0) + got[i]["size"]
        taken[s] = taken.get(s, 0) + got[i]["taken"]
    want = plain_targets(sizes)
    for i, _, s in rows:
        assert got[i]["source_size"] == sizes[s] and got[i]["target"] == pytest.approx(want[s])
    assert all(abs(taken[s] - want[s]) <= 0.51 for s in sizes)
    assert {i: r["taken"] for i, r in got.items()} == {r["doc_id"]: r["taken"] for r in mixing.mix(df.repartition(7)).collect()}
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_levels_and_ties(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DIGITS", 1)
    monkeypatch.setattr(mixing, "LEVELS", 2)
    rng = random.Random(8)
    rows = [(i % 700, " ".join(["w"] * rng.randint(0, 9)), "hot" if i % 3 else f"s{i % 40}") for i in range(2100)] + [(None, "a b c", "hot"), (5000, None, None), (5001, "", "none")]
    rows += [(9000, "x y", "tied")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size = lambda s: sum(len((t or "").split()) for _, t, x in rows if x == s)
    want = plain_targets({s: size(s) for s in {r[2] for r in rows}})
    taken = dict.fromkeys(want, 0)
    by_row = {}
    for r in mixing.mix(df.withColumn("__size", F.lit(1)).withColumn("doc_id", F.struct("doc_id", "source"))).collect():
        taken[r["doc_id"]["source"]] += r["taken"]
        by_row.setdefault((*r["doc_id"], r["size"]), set()).add(r["taken"])
    assert all(abs(taken[s] - t) <= (26 if s == "tied" else 3) for s, t in want.items()) and all(len(x) == 1 for x in by_row.values())


def test_repeated_rows(spark):
    rows = [(1, "a b", "s", 0, 5), (2, "c d e f g h", "t", 0, 6), (3, None, "t", 0, 7), (None, "x y z", None, 0, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, __turn int")
    out = mixing.repeated(df)
    assert out.columns == df.columns
    copies = {r["doc_id"]: r["taken"] // max(r["size"], 1) for r in mixing.mix(df).collect()}
    got = [tuple(r) for r in out.collect()]
    assert all(abs(got.count(x) - copies[x[0]]) <= 1 and got.count(x) <= 3 for x in rows) and set(got) <= set(rows) and rows[2] not in got
    assert mixing.repeated(df.limit(0)).count() == 0


# --- secrets -----------------------------------------------------------------------


def plain_base(text):
    found = []
    for kind, pattern, group, least in (("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)):
        found += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text or "", re.A) if len(m[group]) >= least]
    return sorted(found, key=lambda x: (x[0], ["assign", "access", "hex"].index(x[2])))


def test_base_spans():
    rng = random.Random(3)
    bits = ["token", "=", " ", "api_key", "PASSWORD", ":", '"', "AKIA", "ABCDEFGHIJKLMN", "deadbeef", "0123456789", "é", "secret=", "x.y", "aKiA", "\n"]
    texts = ["", None, "token=secret=abcdefghijkl", "token=token : abcdefghijklmnop", "ſecret=abcdefghijklmnop"] + ["".join(rng.choice(bits) for _ in range(14)) for _ in range(4000)]
    for t in texts:
        assert [x for x in secrets.spans(t) if x[2] != "random"] == plain_base(t), t


def test_randomness():
    rng = random.Random(4)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    found = sum(any(k == "random" for *_, k in secrets.spans("see " + "".join(rng.choice(alphabet) for _ in range(32)) + " here")) for _ in range(200))
    assert found >= 190
    for plain in ("internationalisation-of-something", "this_is_a_long_identifier_name_2", "http/www/example/com/index/html", "aaaaaaaaaaaaaaaaaaaaaaaaA1", "abcdefghijklmnopqrstuvwxyzABCDEF", "a" * 100_000):
        assert not [x for x in secrets.spans(plain) if x[2] == "random"], plain


@pytest.mark.parametrize("before", ["client_key=", "sig=", "AccountKey=", "my_dir/", "a-b/c_d/"])
@pytest.mark.parametrize("more", ["", "+/", "-_"])
def test_random_values_behind_names_and_paths(before, more):
    rng = random.Random(5)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + more
    hits = 0
    for _ in range(100):
        key = "".join(rng.choice(alphabet) for _ in range(40))
        text = f"see {before}{key} here"
        hits += any(k == "random" and text[a:b].endswith(key[-20:]) for a, b, k in secrets.spans(text))
    assert hits >= 90


def test_scan_of_a_table(spark):
    rows = [(1, "token=abcdefghijklmnop", "mine"), (2, None, None), (3, "", "x"), (1, "token=abcdefghijklmnop", "mine")]
    df = spark.createDataFrame(rows, "doc_id long, text string, secrets string")
    got = sorted((r["doc_id"], [tuple(x) for x in r["secrets"]]) for r in secrets.scan(df).collect())
    assert got == [(1, [(0, 22, "assign")]), (1, [(0, 22, "assign")]), (2, []), (3, [])]
    assert secrets.scan(df.limit(0)).count() == 0 and secrets.scan(df).columns == ["doc_id", "text", "secrets"]


def test_encoded_prose_is_no_secret():
    import base64

    rng = random.Random(6)
    words = "the river was slow and the old house by its bank stood empty since last winter when they all went away".split()
    texts = [base64.b64encode(" ".join(rng.choice(words) for _ in range(40)).encode()).decode() for _ in range(100)]
    assert sum(any(k == "random" for *_, k in secrets.spans("x " + t + " y")) for t in texts) <= 5


def test_long_texts_are_scanned_in_time():
    import time

    rng = random.Random(7)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(60_000)]
    began = time.perf_counter()
    found = secrets.spans(" ".join(k if i % 2 else "token=" + k for i, k in enumerate(keys)))
    assert len(found) > 55_000 and time.perf_counter() - began < 10


# --- registered queries and the pipeline ---------------------------------------------


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    got = queries.queries()[name](spark, DATA).toPandas()
    want = con.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.itertuples(index=False, name=None)) == sorted(want[got.columns].itertuples(index=False, name=None))


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = p.quality_stage(spark, docs, DATA)
    assert kept.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    sets = {i: set(shingles(t, 5)) for i, t in texts.items()}
    one = p.near_duplicate_stage(spark, kept, DATA)
    left = {r["doc_id"] for r in one.collect()}
    close = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    least = classes(list(texts), [(a, b) for a in texts for b in texts if a < b and close(a, b)])
    assert left == {i for i in texts if least[i] == i}
    hidden = p.pii_stage(spark, one, DATA)
    mixed = {r["doc_id"]: r for r in mixing.mix(hidden).collect()}
    out = p.run(spark, DATA).collect()
    copies = {i: (2 * r["taken"] + r["size"]) // (2 * r["size"]) for i, r in mixed.items()}
    assert sorted(r["doc_id"] for r in out) == sorted(i for i, n in copies.items() for _ in range(n))
    new = {r["doc_id"]: r["text"] for r in hidden.collect()}
    for r in out:
        assert r["round_trip"] and r["n_tokens"] == len(r["ids"])
    assert {r["doc_id"]: LIBRARY.decode(r["ids"]) for r in out} == {i: new[i] for i, n in copies.items() if n}


ODD = "doc_id long, text string, lang string, source string, n_chars long, script string, n_words int, n_email string, __key int, size string, kept int, ids string"


def test_pipeline_stages_handle_odd_rows(spark):
    import corpus_pipeline as p

    good = "Anna went home and Bert slept while Carl read an old book by the river with Dora and Emil at noon"
    more = ["mine", 77, "many", 5, "big", 0, "i"]
    rows = [(1, good + " mail bob@x.org", "en", "a", 9, *more), (1, good + " mail bob@x.org", "en", "a", 9, *more), (7, good + " mail bob@x.org", None, None, None, *more), (None, good + " 4845168114407329", "en", None, 1, *more)]
    rows += [(3, None, None, None, None, *[None] * 7), (4, "", "en", "b", 0, *more), (5, " \n ", "en", "b", 0, *more), (8, (good + " and on ") * 1 + " ".join(f"w{i} x{i}" for i in range(30_000)), "en", "c", 0, *more)]
    docs = spark.createDataFrame(rows, ODD)
    kept = p.quality_stage(spark, docs, DATA)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert set(got) <= set(rows) and sorted(str(r[0]) for r in got if r[0] != 8) == ["1", "1", "7", "None"]
    one = p.near_duplicate_stage(spark, docs, DATA)
    assert one.columns == docs.columns and sorted(str(r["doc_id"]) for r in one.collect()) == ["1", "1", "3", "4", "5", "8", "None"]
    hidden = p.pii_stage(spark, docs, DATA)
    assert hidden.columns == docs.columns
    for r in hidden.collect():
        assert "bob@x.org" not in (r["text"] or "") and "4845168114407329" not in (r["text"] or "") and r["n_email"] in ("many", None)
    mixed = p.mixing_stage(spark, docs, DATA)
    assert mixed.columns == docs.columns and {tuple(r) for r in mixed.collect()} <= set(rows)
    coded = p.tokenise_stage(spark, docs, DATA).collect()
    assert len(coded) == len(rows) and all(r["round_trip"] for r in coded)
    empty = docs.limit(0)
    for _, stage in p.STAGES:
        out = stage(spark, empty, DATA)
        assert out.count() == 0


def test_running_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from folioflow.llm import common

    monkeypatch.setattr(common, "_own_dir", None)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(cluster)


def test_tables_are_written_without_leaving_shuffles(spark):
    from folioflow.llm import common

    df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    written = common.cut(df, "test")
    assert written.count() == 7 and spark.conf.get(common._CLEANUP, None) in (None, "false")
    common.release(written)
    with pytest.raises(Exception):  # noqa: B017
        written.collect()
