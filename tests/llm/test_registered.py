"""Every registered query over whole tables, against plain versions of its own."""

import hashlib
import math
import re
from datetime import date, timedelta
from zlib import crc32

import duckdb
import numpy as np
import pytest
from brute import classes, fingerprint, quality as plain_counts, sha

from folioflow.llm import bpe, classifier, common, pii, quality, queries, secrets

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
DATA = "/root/testdata/sf0.001"
M = (1 << 64) - 1


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    read = lambda name: con.sql(f"SELECT * FROM '{DATA}/{name}.parquet'").fetchall()
    return {"documents": [r[:3] for r in read("documents")], "embeddings": read("embeddings"), "labels": read("labels")}


def result(spark, name):
    return queries.queries()[name](spark, DATA).collect()


def test_op1(spark, tables):
    ids = np.array([r[0] for r in tables["embeddings"]])
    x = np.array([r[1] for r in tables["embeddings"]], np.float64)
    got = {}
    for r in result(spark, "op1_ann"):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == sorted(i for i in ids.tolist() if i % 20 == 0)
    hits = 0
    for q, found in got.items():
        found.sort()
        score = dict(zip(ids.tolist(), (x @ x[ids == q][0]).tolist()))
        del score[q]
        best = sorted(score, key=lambda i: (-score[i], i))[:20]
        assert [f[0] for f in found] == list(range(1, 21)) and [f[1] for f in found] == sorted((f[1] for f in found), key=lambda i: (-score[i], i))
        assert all(s == pytest.approx(score[i], rel=1e-9) for _, i, s in found)
        hits += len({f[1] for f in found} & set(best))
    assert hits >= 0.9 * 20 * len(got)


def test_op2(spark, tables):
    path = P.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(path), special_tokens={})
    want = {}
    for i, text, _ in tables["documents"]:
        ids = library.encode_ordinary(text or "")
        want[i] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode()))
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in result(spark, "op2_bpe")} == want


# --- pseudonyms: a plain Feistel network -----------------------------------------


def digest(tag, i, half):
    return hashlib.sha256(f"{queries.DEMO_KEY}:{tag}:{i}:{half}".encode()).hexdigest()


def moved_number(tag, value, left, right):
    a, b = divmod(value, right)
    for i in range(pii.ROUNDS):
        if i % 2:
            b = (b + int(digest(tag, i, a)[:13], 16)) % right
        else:
            a = (a + int(digest(tag, i, b)[:13], 16)) % left
    return a * right + b


def moved_text(tag, value):
    def shifted(half, by):
        out = ""
        for i, c in enumerate(half):
            first, n = (48, 10) if c.isdigit() else (97, 26) if c.islower() else (65, 26) if c.isupper() else (ord(c), 1)
            out += chr(first + (ord(c) - first + int(by[2 * i : 2 * i + 2], 16)) % n)
        return out

    tag, a, b = f"{tag}{len(value)}", value[: len(value) // 2], value[len(value) // 2 :]
    for i in range(pii.ROUNDS):
        if i % 2:
            b = shifted(b, digest(tag, i, a))
        else:
            a = shifted(a, digest(tag, i, b))
    return a + b


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))


def refilled(form, digits):
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in form)


def day_of(m):
    y = (m[:4], m[5:7], m[8:]) if m[:4].isdigit() else (m[6:], m[3:5], m[:2])
    for form, (year, month, day) in (("ymd" if m[:4].isdigit() else "dmy", y), ("mdy", (m[6:], m[:2], m[3:5]))):
        if form == "mdy" and ("/" not in m or m[:4].isdigit()):
            continue
        try:
            if 1600 <= (found := date(int(year), int(month), int(day))).year <= 2299:
                return form, found
            return None
        except ValueError:
            continue
    return None


def plain_pseudonym(m):
    """(kind, replacement) of a candidate, or None."""
    number = re.sub("[^0-9]", "", m)
    if "@" in m:
        local, at, rest = m.partition("@")
        new = moved_text("email", local.lower())
        return "email", "".join(n.upper() if c.isupper() else n for n, c in zip(new, local)) + at + rest
    if re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", m):
        octets = list(map(int, m.split(".")))
        if max(octets) > 255:
            return None
        new = moved_number("ipv4", int.from_bytes(bytes(octets)), 65536, 65536)
        return "ipv4", ".".join(map(str, new.to_bytes(4)))
    if re.fullmatch(r"\d{4}[-/]\d{2}[-/]\d{2}|\d{2}[./]\d{2}[./]\d{4}", m):
        if not (found := day_of(m)):
            return None
        start = date(1600, 1, 1)
        new = start + timedelta(days=moved_number("date", (found[1] - start).days, *pii.DAY_PARTS))
        y, mo, d = f"{new.year:04}", f"{new.month:02}", f"{new.day:02}"
        return "date", refilled(m, {"ymd": y + mo + d, "dmy": d + mo + y, "mdy": mo + d + y}[found[0]])
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", m):
        a, g, s = int(m[:3]), int(m[4:6]), int(m[7:])
        if a in (0, 666) or a >= 900 or not g or not s:
            return None
        v = moved_number("ssn", ((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1, 898 * 99, 9999)
        area = v // (99 * 9999) + 1
        return "ssn", f"{area + (area >= 666):03}-{v // 9999 % 99 + 1:02}-{v % 9999 + 1:04}"
    if re.fullmatch(r"\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}", m):
        if not 13 <= len(number) <= 19 or luhn(number) % 10:
            return None
        body = moved_text("card", number[:-1])
        return "card", refilled(m, body + str(-luhn(body + "0") % 10))
    if 7 <= len(number) <= 15:
        code = re.match(pii.COUNTRY, number)[0] if m[0] == "+" else ""
        return "phone", refilled(m, code + moved_text("phone", number[len(code) :]))
    return None


def test_op4(spark, tables):
    pattern = re.compile(pii.CANDIDATE.replace("(?<s>", "(?P<s>").replace(r"\k<s>", "(?P=s)"), re.A)
    want, changed = {}, 0
    for i, text, _ in tables["documents"]:
        counts = dict.fromkeys(pii.KINDS, 0)

        def new(m):
            if not (found := plain_pseudonym(m[0])):
                return m[0]
            counts[found[0]] += 1
            return found[1]

        want[i] = (text and pattern.sub(new, text), *counts.values())
        changed += want[i][0] != text
    assert changed > 5
    assert {r["doc_id"]: (r["text"], *[r[f"n_{k}"] for k in pii.KINDS]) for r in result(spark, "op4_pii")} == want


@pytest.mark.parametrize("text", ["a 29.02.2024 b 02/29/2024 31/12/1999 2023-02-29", "Bob.X9@ex-a.org", "999-12-3456 665-01-0001 899-99-9999", "10.0.0.1 256.1.1.1", "+49 30 123 4567 (555) 123-4567 +15551234567", "4845 1681 1440 7329 4845168114407328"])
def test_op4_forms(spark, text):
    pattern = re.compile(pii.CANDIDATE.replace("(?<s>", "(?P<s>").replace(r"\k<s>", "(?P=s)"), re.A)
    want = pattern.sub(lambda m: (plain_pseudonym(m[0]) or (0, m[0]))[1], text)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.pseudonymise(df, key=queries.DEMO_KEY).first()["text"] == want != text


# --- quality ----------------------------------------------------------------------


def middle(values):
    return sorted(values)[math.ceil(len(values) / 2) - 1]


def script_of(text):
    def of(c):
        p = ord(c)
        if c.isascii():
            return 0 if c.isalpha() else None
        if 0xC0 <= p < 0x280 or 0x1E00 <= p < 0x1F00:
            return 0
        if 0x340 <= p < 0x500 or 0x1F00 <= p < 0x2000:
            return 1
        if 0x3000 <= p < 0xE000 or 0x20000 <= p:
            return 2
        if 0x500 <= p < 0x2000 or 0x10000 <= p < 0x1F000:
            return 3
        return None

    counts = [sum(of(c) == k for c in set(text) for _ in range(text.count(c))) for k in range(4)]
    return quality.SCRIPTS[counts.index(max(counts)) if max(counts) else 4]


def plain_verdicts(documents):
    rules = quality.Rules(P.path("piece_bpe_32k.model"))
    rows = {}
    for i, text, lang in documents:
        n_words, word_chars, n_symbols, n_dup, n_repeat = counts = plain_counts(text)
        ids = [t for w in re.findall(common.WORD, text or "") for t in rules.model.encode(w)]
        share = np.unique(ids, return_counts=True)[1] / max(len(ids), 1)
        entropy = -(share * np.log2(share)).sum() / np.log2(len(ids)) if len(ids) > 1 else 1.0
        failed = n_words < 10 or 100 * n_repeat > 20 * n_words
        rows[i] = dict(counts=counts, failed=failed, n=len(ids), chars=word_chars / max(len(ids), 1), entropy=entropy, bytes_=float(np.mean(rules.is_byte[ids])) if ids else 0.0, script=script_of(text or ""), group=(script_of(text or ""), lang))
    seen = {(r["group"], r["n"], r["chars"], r["entropy"]) for r in rows.values() if not r["failed"] and r["n"] > 1}
    by_length = {}
    for _, n, _, e in seen:
        by_length.setdefault(int(math.log2(n)), []).append(e)
    points = np.interp(np.arange(quality.LENGTHS + 2), sorted(by_length), [middle(by_length[k]) for k in sorted(by_length)])

    def usual(n):
        x = max(math.log2(max(n, 1)) - 0.5, 0)
        return points[int(x)] + (x - int(x)) * (points[int(x) + 1] - points[int(x)])

    wide = lambda n: [math.sqrt(1 + k / max(n, 1)) for k in quality.SHORT]
    limits = {}
    for g in {s[0] for s in seen}:
        own = [s[1:] for s in seen if s[0] == g]
        if len(own) >= quality.MIN_GROUP:
            c, e = middle([x[1] for x in own]), middle([x[2] - usual(x[0]) for x in own])
            off = [(abs(x[1] - c) / wide(x[0])[0], abs(x[2] - usual(x[0]) - e) / wide(x[0])[1]) for x in own]
            limits[g] = c, e, *[max(1.4826 * middle([o[k] for o in off]), quality.LEAST[k]) for k in (0, 1)]
    for r in rows.values():
        n, low_ = max(r["n"], 1), False
        if r["group"] in limits:
            c, e, sc, se = limits[r["group"]]
            z = (r["chars"] - c) / wide(n)[0] / sc, (r["entropy"] - usual(n) - e) / wide(n)[1] / se
            low_ = min(*z, sum(z) / 2**0.5) < -quality.LIMIT
        low, high, most, least = quality.BANDS[r["script"]]
        slack = n**-0.5
        good = low <= r["chars"] * (1 + 4 * slack) and r["chars"] <= high * (1 + 4 * slack) and r["bytes_"] <= most + (1 - most) * 2 * slack and r["entropy"] >= least * min(1, 10 / math.log2(max(n, 2))) * (1 - slack)
        r["kept"] = not r["failed"] and good and not low_
    return rows


def test_op6(spark, tables):
    want = plain_verdicts(tables["documents"])
    got = {r["doc_id"]: r for r in result(spark, "op6_quality")}
    assert got.keys() == want.keys()
    for i, w in want.items():
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == w["counts"], i
        assert (r["base_failed"], r["kept"], r["script"]) == (w["failed"], w["kept"], w["script"]), (i, w)
        if w["n"]:
            assert (r["chars_per_token"], r["token_entropy"]) == (pytest.approx(w["chars"]), pytest.approx(w["entropy"]))
    assert any(not w["failed"] and not w["kept"] for w in want.values())


def test_op7(spark, tables):
    prints = {i: fingerprint(t) for i, t, _ in tables["documents"]}
    keys = sorted(prints)
    least = classes(keys, [(a, b) for a in keys for b in keys if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in result(spark, "op7_simhash")} == {i: (f"{prints[i]:016x}", least[i]) for i in keys}


# --- classifier: features one by one ------------------------------------------------


def mix(h):
    h ^= h >> 32
    h = h * int(common._MIX) & M
    return h ^ h >> 29


def factors(n, seed):
    return [int(x) for x in np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]


def plain_features(text, cache):
    gold, values = int(common._GOLD), [int(v) for v in common._BYTE_VALUES]

    def of_word(w):
        if w not in cache:
            total, power = len(w.encode()) * int(common._MIX), 1
            for b in w.encode():
                power = power * gold & M
                total += values[b] * power
            grams, padded = [], f" {w} "
            for n in classifier.GRAMS:
                f = factors(n, n)
                points = [mix(ord(c) + 1) for c in padded]
                grams += [mix(sum(points[k + j] * f[j] for j in range(n)) & M) for k in range(len(padded) - n + 1)]
            cache[w] = mix(total & M), grams
        return cache[w]

    words = re.findall(common.WORD, text or "")
    pair = factors(2, 1)
    out = []
    for k, w in enumerate(words):
        h, grams = of_word(w)
        out += [h, *grams]
        if k:
            before = of_word(words[k - 1])[0]
            out += [mix((before * pair[0] + h * pair[1]) & M), mix(11 + (before == h))]
    return [x >> (64 - classifier.BUCKET_BITS) for x in out]


def test_op9(spark, tables):
    held = lambda i: crc32(str(i).encode()) % 3 == 1
    texts = {i: t for i, t, _ in tables["documents"]}
    labels = {r[0]: r[1] for r in tables["labels"] if not held(r[0]) and r[0] in texts}
    keys = sorted(labels)
    assert 0 < len(keys) <= classifier.MAX_ROWS
    weights, bias = classifier.train([classifier.packed(np.frombuffer((texts[k] or "").encode(), np.uint8)) for k in keys], np.array([labels[k] for k in keys]))
    cache = {}
    got = {r["doc_id"]: r for r in result(spark, "op9_classifier")}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        f = plain_features(text, cache)
        z = (float(np.mean(weights[f], dtype=np.float64)) if f else 0.0) + bias
        assert got[i]["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6) and got[i]["held_out"] == held(i) and got[i]["predicted"] == (got[i]["score"] >= 0.5)


def test_op10(spark, tables):
    forms = (("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16))
    got = {r["doc_id"]: r for r in result(spark, "op10_secrets")}
    some = 0
    for i, text, _ in tables["documents"]:
        found = [(m.start(), k, f"{name}:{m.start()}:{m.end()}", name) for k, (name, pattern, group, least) in enumerate(forms) for m in re.finditer(pattern, text or "", re.A) if len(m[group]) >= least]
        found.sort()
        some += len(found)
        more = [(a, 3, f"random:{a}:{b}", "random") for a, b, k in secrets.spans(text) if k == "random"]
        r = got[i]
        assert [r[f"n_{name}"] for name, *_ in forms] == [sum(x[3] == name for x in found) for name, *_ in forms]
        assert r["base_sha256"] == sha(",".join(x[2] for x in found).encode()) and r["spans"] == ",".join(x[2] for x in sorted(found + more))
        assert not any(a < y and x < b for a, _, s, _ in more for b in [int(s.split(":")[2])] for x, y in [tuple(map(int, f[2].split(":")[1:])) for f in found])
    assert some and got.keys() == {i for i, *_ in tables["documents"]}
