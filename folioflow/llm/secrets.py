"""Secret scans: three fixed forms, and a battery of randomness tests.

Fixed forms: assignments to a secret's name, access keys, long hexadecimal
runs. The battery looks at every other run of 20 or more base64-like
characters that holds at least two kinds of character. A run that fits no
alphabet is split at an inner '=' (name=value) and, where a part mixes '_' or '-'
with '/' or '+', at either pair: of both splits, all parts of 20 or more are
tested. A run's encoding (hex, base32, base62, base64) fixes an alphabet. Three
tests ask whether the run may be drawn uniformly from it: chi-squared over the
alphabet, runs above and below its middle, serial correlation at lag 1; it is
dropped where the least of their p-values, times three, is under ALPHA.

What is left is a discovery if written text would hardly give it. The same
statistics have p-values under a written-text null as well: so even a use of the
alphabet (few coincidences, the lower tail of chi-squared) and so many changes
of character class (the upper tail of the runs). Fisher's rule combines them. Both nulls know the run's
length: short runs prove little and get large p-values. Benjamini and Hochberg's
step-up at rate FDR over the runs of each length class of a document, all of
them counted, decides.

Edge cases: null and empty texts have no spans; repeated rows are scanned
alike; texts of any length are read whole, in time near their length; other
columns pass through unless they bear a result's name; an empty table gives no
rows. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX, MIN_RANDOM = 12, 18, 16, 20
ALPHA, FDR = 0.01, 0.005

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RANDOM)
#: Between inner '=' (padding stays), and clear of either pair that only one of the base64 alphabets has.
VALUE = re.compile(r"[^=]+(?:=+$)?")
FOREIGN = (re.compile(r"[^/+]+"), re.compile(r"[^_-]+"))
NAMES = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)

#: Alphabets by encoding, smallest first.
ALPHABETS = {
    "hex_lower": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64_url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_INDEX = {k: {c: i for i, c in enumerate(a)} for k, a in ALPHABETS.items()}
# Fixed values of the written-text null: the chance that two, and that three, letters of Latin-script prose agree, and that the class changes after a character.
AGREE_2, AGREE_3, CHANGE = 0.065, 0.0053, 0.15
_CLASS = str.maketrans({c: k for k, cs in {"a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0": "0123456789", "-": "+/-_="}.items() for c in cs})


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


@lru_cache(1 << 16)
def _upper_poisson(k: int, mean: float) -> float:
    """P(at least k) of a Poisson variable, at least by a Chernoff bound where terms underflow."""
    if k <= mean:
        return 1.0
    term = math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) if mean > 0 else 0.0
    total, i = 0.0, k
    while term > 1e-18 * (total + 1e-300) and i < k + 1000:
        total += term
        i += 1
        term *= mean / i
    return min(1.0, total)


def _upper_chi2(x: float, k: int) -> float:
    """Upper tail by the cube-root normal approximation."""
    return _upper_normal(((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k)))


@lru_cache(1 << 16)
def _upper_binomial(k: int, n: int, p: float) -> float:
    """P(at least k) of n draws."""
    if n > 2000:
        return _upper_normal((k - 0.5 - n * p) / math.sqrt(n * p * (1 - p)))
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    return min(1.0, math.fsum(math.exp(log(i)) for i in range(k, n + 1)))


def encoding(run: str) -> str | None:
    body = run.rstrip("=")
    have = set(body)
    return next((k for k, a in _INDEX.items() if have <= a.keys()), None)


def coincidences(run: str) -> int:
    """Pairs of equal characters: chi-squared over the alphabet is a line in their number."""
    return sum(c * (c - 1) // 2 for c in Counter(run).values())


def battery(run: str) -> tuple[float, float, float]:
    """p-values of the three tests of uniform draws from the run's alphabet (1 where a test has no power)."""
    name = encoding(run)
    if name is None:
        return 0.0, 0.0, 0.0
    at, size = _INDEX[name], len(ALPHABETS[name])
    x = [at[c] for c in run.rstrip("=")]
    n = len(x)
    pairs = coincidences(run.rstrip("="))
    # Where cells are sparse, the number of coincidences is nearly Poisson.
    chi = _upper_chi2(size / n * (2 * pairs + n) - n, size - 1) if n >= 5 * size else _upper_poisson(pairs, n * (n - 1) / 2 / size)
    high = [v >= size / 2 for v in x]
    n1 = sum(high)
    n0 = n - n1
    runs_p = 1.0
    if n0 and n1:
        mean = 2 * n0 * n1 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs_p = 2 * _upper_normal(abs(1 + sum(a != b for a, b in zip(high, high[1:])) - mean) / math.sqrt(var)) if var > 0 else 1.0
    elif n > 12:
        runs_p = 2.0 ** max(1 - n, -1000)
    middle = sum(x) / n
    c = [v - middle for v in x]
    r = sum(a * b for a, b in zip(c, c[1:])) / max(sum(a * a for a in c), 1e-9)
    return chi, runs_p, 2 * _upper_normal(abs(r) * math.sqrt(n))


def written(run: str) -> float:
    """p-value of the written-text null: that prose or a name uses the alphabet so evenly and changes class so often."""
    body = run.rstrip("=")
    n = len(body)
    two = n * (n - 1) / 2
    spread = math.sqrt(two * AGREE_2 * (1 - AGREE_2) + n * (n - 1) * (n - 2) * (AGREE_3 - AGREE_2**2))
    even = max(_upper_normal((two * AGREE_2 - coincidences(body)) / spread), 1e-300)
    classes = body.translate(_CLASS)
    changes = max(_upper_binomial(sum(a != b for a, b in zip(classes, classes[1:])), n - 1, CHANGE), 1e-300)
    half = -math.log(even) - math.log(changes)  # Fisher: twice this is chi-squared on 4
    return math.exp(-half) * (1 + half)


def parts(run: str) -> list[tuple[int, int]]:
    """Spans of the parts of a run to test: itself if an alphabet has all of it."""
    if encoding(run):
        return [(0, len(run))]
    found = set()
    for m in VALUE.finditer(run):
        splits = [VALUE] if encoding(m[0]) else FOREIGN
        found |= {(m.start() + x.start(), m.start() + x.end()) for split in splits for x in split.finditer(m[0])}
    return sorted(x for x in found if x[1] - x[0] >= MIN_RANDOM)


def _clear(found: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that meet none of those taken, which don't overlap one another; both sorted."""
    out, i = [], 0
    for a, b in found:
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if i == len(taken) or taken[i][0] >= b:
            out.append((a, b))
    return out


def _joined(spans_: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, with those that overlap joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans_):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def random_runs(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs that the battery and the false-discovery control leave, clear of the spans taken."""
    seen = [(m.start() + a, m.start() + b) for m in RUN.finditer(text) for a, b in parts(m[0])]
    classes: dict[int, list[tuple[float, int, int]]] = {}
    for a, b in _clear(seen, _joined(taken)):
        run = text[a:b]
        if len(set(run.translate(_CLASS))) > 1 and encoding(run):
            classes.setdefault(len(run).bit_length(), []).append((written(run), a, b))
    out = []
    for runs in classes.values():
        runs.sort()
        last = max((i for i, (p, *_) in enumerate(runs, 1) if p <= FDR * i / len(runs)), default=0)
        out += [(a, b) for _, a, b in runs[:last] if 3 * min(battery(text[a:b])) >= ALPHA]
    # Of parts that overlap, the longest stays.
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(out, key=lambda x: (x[0] - x[1], x[0])):
        i = bisect_left(starts, b)
        if i == 0 or ends[i - 1] <= a:
            starts.insert(i, a)
            ends.insert(i, b)
    return list(zip(starts, ends))


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """All spans of a text as (start, end, kind), by start and then kind."""
    if not text:
        return []
    found = []
    if NAMES.search(text):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    found += [(a, b, "random") for a, b in random_runs(text, [x[:2] for x in found])]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _line(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """docs (all columns, or those named in keep) with secrets: array of (start, end, kind)."""
    kept = [f for f in docs.schema.fields if f.name != "secrets" and (keep is None or f.name in keep)]
    schema = T.StructType([*kept, *T.StructType.fromDDL("secrets array<struct<start:long,end:long,kind:string>>").fields])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            found = pa.array([[dict(start=a, end=b, kind=k) for a, b, k in spans(t.as_py())] for t in texts], kind)
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(f.name)) for f in kept], found], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def digest(found: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(_line([x for x in found if x[2] != "random"]).encode()).hexdigest()
