"""Quality rules: simple counts, and tokeniser fertility with bands by script.

Each distinct word of a slice is split once by a public subword vocabulary with
byte fallback. A document's characters per token, share of byte-fallback tokens
and token entropy (bits over the logarithm of its tokens, 0 to 1) must lie in
the band of its main script, wide enough for any plain prose of that script and
wider the fewer its tokens are,
and within robust limits of its group (script and, where there is such a
column, lang). The limits come from all documents that pass the base rules,
equal measures counted once: medians and absolute deviations of characters per
token and of entropy less its median at that length. Deviations are taken over
their usual size at a text's length, so limits widen as texts get shorter. A
document goes if either measure, or both together, lie over LIMIT deviations
low. Groups of under MIN_GROUP different documents have the bands only.

Edge cases: null and empty texts have no words, no measures (null) and fail the
base rules; repeated rows are judged each on their own; texts of any length are
judged whole; an empty table gives no rows; other columns pass through unless
they bear a result's name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import SEPARATOR, cut, distinct_slices, mixed, run_starts, slices, window_hashes, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 10, 20, 5
CACHE_WORDS = 150_000
#: script -> (least and most characters per token, most byte-fallback share, least relative entropy)
BANDS = {"latin": (1.15, 8.0, 0.10, 0.35), "cyrillic_greek": (0.9, 8.0, 0.25, 0.35), "cjk": (0.3, 4.0, 0.75, 0.35), "other": (0.25, 8.0, 0.95, 0.30), "none": (0.8, 8.0, 0.50, 0.30)}
SCRIPTS = tuple(BANDS)
#: Deviations below a group's median at which a text goes, and different documents that a group's limits take.
LIMIT, MIN_GROUP = 2.75, 30
#: A measure's deviation grows as sqrt(1 + this / tokens): characters per token, entropy. Least deviations of long texts, for groups of near copies.
SHORT, LEAST = (4800.0, 30.0), (0.01, 0.015)
#: Powers of two of a text's tokens by which entropy is centred.
LENGTHS = 48

RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, script string, chars_per_token double, byte_share double, token_entropy double, kept boolean"


@lru_cache(1)
def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def scripts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of the script with most letters in each row, seen from lead bytes alone."""
    letter = np.zeros(256, np.uint8)
    letter[:] = 9
    letter[0x41:0x5B] = letter[0x61:0x7B] = 0
    letter[0xC3:0xCA] = 0  # U+00C0..U+027F
    letter[0xCD:0xD4] = 1  # U+0340..U+053F: Greek, Cyrillic
    letter[0xD4:0xE0] = 3
    letter[0xE0:0xE3] = 3
    letter[0xE2] = 9  # punctuation and symbols
    letter[0xE3:0xEE] = 2  # kana, Han, Hangul
    kind = letter[data]
    # Two lead bytes tell by the byte after them: U+1E00..U+1FFF, and beyond U+FFFF ideographs, symbols (no letters) or other scripts.
    for lead, following in ((0xE1, ((0xB8, 0xBC, 0), (0xBC, 0xC0, 1))), (0xF0, ((0x90, 0x9F, 3), (0x9F, 0xA0, 9), (0xA0, 0xC0, 2)))):
        at = np.flatnonzero(data == lead)
        after = data[np.minimum(at + 1, len(data) - 1)]
        for low, high, script in following:
            kind[at[(after >= low) & (after < high)]] = script
    counts = np.empty((4, len(offsets) - 1), np.int64)
    for i in range(4):
        counts[i] = np.diff(np.append(0, np.cumsum(kind == i))[offsets])
    return np.where(counts.max(0) > 0, counts.argmax(0), 4)


class Rules:
    def __init__(self, vocabulary: str):
        self.model = _model(vocabulary)
        self.is_byte = np.array([self.model.is_byte(i) or self.model.is_unknown(i) for i in range(self.model.vocab_size())])
        self.cache: dict[bytes, bytes] = {}

    def tokens(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each word, as unsigned 32-bit integers."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        found = list(map(self.cache.get, pieces))
        if None in found:
            new = [p for p, t in zip(pieces, found) if t is None]
            fresh = dict(zip(new, (np.array(x, "<u4").tobytes() for x in self.model.encode([p.decode("utf-8") for p in new], num_threads=1))))
            found = [fresh[p] if t is None else t for p, t in zip(pieces, found)]
            self.cache.update((p, t) for p, t in fresh.items() if len(p) <= 64)
        return found

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        n = len(offsets) - 1
        starts, ends, first = words(data, offsets)
        n_words = np.diff(first)
        rows = np.repeat(np.arange(n), n_words)
        plain = np.append(0, np.cumsum(~SEPARATOR[data]))
        word_chars = np.diff(np.append(0, np.cumsum(~SEPARATOR[data] & ((data & 0xC0) != 0x80)))[offsets])
        n_symbols = np.diff(np.append(0, np.cumsum(SYMBOLS[data]))[offsets])
        of, where = distinct_slices(data, starts, ends)
        out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": _dup_lines(data, offsets, plain), "n_repeat_words": _repeated(of, rows, n)}
        out["base_failed"] = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEATED_PERCENT * n_words)
        raw = data.tobytes()
        found = self.tokens([raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())])
        flat = np.frombuffer(b"".join(found), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        each = sizes[of]
        to = np.cumsum(each)
        ids = flat[np.repeat(run_starts(sizes)[of] - (to - each), each) + np.arange(to[-1] if len(to) else 0)]
        token_rows = np.repeat(rows, each)
        n_tokens = np.bincount(token_rows, minlength=n)
        byte_share = np.bincount(token_rows, self.is_byte[ids], minlength=n) / np.maximum(n_tokens, 1)
        pairs, counts = np.unique(token_rows * len(self.is_byte) + ids, return_counts=True)
        pair_rows = pairs // len(self.is_byte)
        share = counts / n_tokens[pair_rows]
        bits = np.bincount(pair_rows, -share * np.log2(share), minlength=n)
        entropy = np.where(n_tokens > 1, bits / np.log2(np.maximum(n_tokens, 2)), 1.0)
        chars = word_chars / np.maximum(n_tokens, 1)
        script = scripts(data, offsets)
        low, high, most, least = np.array(list(BANDS.values()))[script].T
        # Bands widen as tokens get fewer. Entropy falls short of 1 as texts outgrow the vocabulary's common part.
        slack = 1 / np.sqrt(np.maximum(n_tokens, 1))
        floor = least * np.minimum(1.0, 10 / np.log2(np.maximum(n_tokens, 2))) * (1 - slack)
        good = (chars * (1 + 4 * slack) >= low) & (chars <= high * (1 + 4 * slack)) & (byte_share <= most + (1 - most) * 2 * slack) & (entropy >= floor)
        out["script"] = np.array(SCRIPTS, object)[script]
        out["__tokens"] = n_tokens
        known = n_tokens > 0
        out |= {"chars_per_token": np.where(known, chars, np.nan), "byte_share": np.where(known, byte_share, np.nan), "token_entropy": np.where(known, entropy, np.nan)}
        out["kept"] = ~out["base_failed"] & good
        return out


def _dup_lines(data: np.ndarray, offsets: np.ndarray, plain: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], breaks + 1]))
    starts = np.unique(starts[starts < len(data)])
    following = np.append(starts[1:], len(data))
    ends = np.where((data[following - 1] == 0x0A) if len(starts) else False, following - 1, following)
    worded = plain[ends] > plain[starts]
    starts, ends = starts[worded], ends[worded]
    rows = np.searchsorted(offsets, starts, "right") - 1
    of, where = distinct_slices(data, starts, ends)
    keys = np.unique(rows * max(len(where), 1) + of)
    return np.bincount(rows, minlength=n) - np.bincount(keys // max(len(where), 1), minlength=n)


def _repeated(of: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    m = len(of) - WINDOW + 1
    if m <= 0:
        return np.zeros(n, np.int64)
    inside = rows[:m] == rows[WINDOW - 1 :]
    keys = window_hashes(mixed(of.astype(np.uint64) + np.uint64(1)), WINDOW) + mixed(rows[:m].astype(np.uint64) + np.uint64(7))
    _, inverse, counts = np.unique(keys[inside], return_inverse=True, return_counts=True)
    at = np.flatnonzero(inside)[counts[inverse] > 1]
    cover = np.zeros(len(of) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return np.bincount(rows[np.cumsum(cover[:-1]) > 0], minlength=n)


def _deviation(column: str) -> Column:
    """The robust standard deviation about zero."""
    return 1.4826 * F.percentile_approx(F.abs(F.col(column)), 0.5, 10_000)


def _limited(measured: DataFrame) -> DataFrame:
    """measured with __low: whether a row lies below the robust limits of its __group."""
    n = F.col("__tokens")
    seen = measured.where("NOT base_failed AND __tokens > 1").select("__group", "__tokens", "chars_per_token", "token_entropy").distinct()
    at = {r[0]: r[1] for r in seen.groupBy(F.floor(F.log2(n)).cast("int")).agg(F.percentile_approx("token_entropy", 0.5, 10_000)).collect()}
    middle = np.interp(np.arange(LENGTHS + 2), sorted(at), [at[k] for k in sorted(at)]) if at else np.zeros(LENGTHS + 2)
    x = F.greatest(F.log2(F.greatest(n, F.lit(1))) - 0.5, F.lit(0.0))
    i = F.least(F.floor(x), F.lit(LENGTHS)).cast("int")
    points = F.array(*map(F.lit, middle.tolist()))
    usual = F.get(points, i) + (x - i) * (F.get(points, i + 1) - F.get(points, i))
    wide = [F.sqrt(1 + F.lit(k) / F.greatest(n, F.lit(1))) for k in SHORT]
    seen = seen.withColumn("over", F.col("token_entropy") - usual)
    centres = seen.groupBy("__group").agg(F.percentile_approx("chars_per_token", 0.5, 10_000).alias("__chars"), F.percentile_approx("over", 0.5, 10_000).alias("__over"), F.count("*").alias("__n")).where(F.col("__n") >= MIN_GROUP)
    off = seen.join(F.broadcast(centres), "__group").select("__group", ((F.col("chars_per_token") - F.col("__chars")) / wide[0]).alias("c"), ((F.col("over") - F.col("__over")) / wide[1]).alias("e"))
    spread = off.groupBy("__group").agg(F.greatest(_deviation("c"), F.lit(LEAST[0])).alias("__c"), F.greatest(_deviation("e"), F.lit(LEAST[1])).alias("__e"))
    joined = measured.join(F.broadcast(centres.join(spread, "__group")), "__group", "left")
    c = (F.col("chars_per_token") - F.col("__chars")) / wide[0] / F.col("__c")
    e = (F.col("token_entropy") - usual - F.col("__over")) / wide[1] / F.col("__e")
    return joined.withColumn("__low", F.coalesce(F.least(c, e, (c + e) / 2**0.5) < -LIMIT, F.lit(False)))


def judge(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] | None = None, lang: str = "lang") -> DataFrame:
    """docs (all columns, or those named in keep) with each row's counts, measures and verdict.

    lang: a column of strings that groups are taken by as well, if there is one of that name."""
    result = T.StructType.fromDDL(RESULT)
    own = {f.name for f in result.fields}
    kept = [f for f in docs.schema.fields if f.name not in own and (keep is None or f.name in keep)]
    extra = T.StructType.fromDDL("__tokens long, __group string").fields
    schema = T.StructType([*kept, *result.fields, *extra])
    by_lang = any(f.name == lang and f.dataType == T.StringType() for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Rules(vocabulary)
        for batch in batches:
            for rows, data, offsets in slices(batch, text, 1 << 20):
                found = rules(data, offsets)
                langs = rows.column(rows.schema.get_field_index(lang)).to_pylist() if by_lang else [None] * rows.num_rows
                found["__group"] = np.array([f"{s} {x or ''}" for s, x in zip(found["script"], langs)], object)
                columns = [rows.column(rows.schema.get_field_index(f.name)) for f in kept]
                for f in [*result.fields, *extra]:
                    columns.append(pa.array(found[f.name], from_pandas=True))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    measured = _limited(cut(docs.mapInArrow(run, schema), "measures"))
    return measured.withColumn("kept", F.col("kept") & ~F.col("__low")).select(*[F.col(f"`{f.name}`") for f in [*kept, *result.fields]])
