"""Substring dedup by seed and extend, over words.

Seeds: documents join on winnowed anchors (the least-hash 4-gram of each window
of 13 words). Under each anchor the earliest run is the hub; every other run is
laid beside it at the anchor and the match is extended word by word both ways.
What is matched over at least a window is a maximal repeat and goes, where the
hub's document is smaller. Windows that the hub doesn't match can only equal
those of third runs under the same anchor; they are told apart one by one, by
anchor and hash. So links grow with the runs, never with pairs of them.

Edge cases: null and empty texts have no words; texts under 13 words lose
nothing; repeats within one document alone stay; rows without a key lose
nothing and remove nothing; keys are unique (rows repeated with key and text get
equal results); very long texts are handled whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import repeats
from .anchors import covered
from .common import cut, release, slices, spaced, word_hashes, words

WINDOW, SEED_WORDS = 13, 4


def _items(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, first = words(data, offsets)
    h = word_hashes(data, starts, ends)
    return h, first, repeats.doubled(h, SEED_WORDS)


def _bodies(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    text, at, to = spaced(data, *words(data, offsets)[:2])
    first = words(data, offsets)[2]
    raw = text.tobytes()
    return [raw[at[i] : to[j]] for i, j in zip((first[row] + starts).tolist(), (first[row] + starts + sizes + WINDOW - 2).tolist())]


def extended(mine: list[bytes], seed: int, hub: list[bytes], hub_seed: int) -> tuple[int, int]:
    """The match around two words, as a range of mine."""
    left = 0
    while left < min(seed, hub_seed) and mine[seed - left - 1] == hub[hub_seed - left - 1]:
        left += 1
    right = 0
    while right < min(len(mine) - seed, len(hub) - hub_seed) and mine[seed + right] == hub[hub_seed + right]:
        right += 1
    return seed - left, seed + right


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each run and its hub: the windows to remove (w null), and those the hub leaves open (w: a window's hash)."""
    for batch in batches:
        out: list[tuple[int, int, int, int, int | None]] = []
        for x in batch.to_pylist():
            tokens, hub = x["body"].split(b" "), x["hub"]["body"].split(b" ")
            a, b = extended(tokens, x["a"], hub, x["hub"]["a"])
            n = b - a - WINDOW + 1
            if n > 0 and x["hub"]["doc"] < x["doc"]:
                out.append((x["h"], x["doc"], x["s"] + a, n, None))
            if x["contents"] > 2:
                for i in range(x["n"]):
                    if not (n > 0 and a <= i < a + n):
                        w = int.from_bytes(hashlib.blake2b(b" ".join(tokens[i : i + WINDOW]), digest_size=8).digest(), "little", signed=True)
                        out.append((x["h"], x["doc"], x["s"] + i, 1, w))
        columns = list(zip(*out)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["h", "doc", "s", "n", "w"])


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc, s, n): runs of n windows from word s whose words also start a window in a smaller document. docs: doc, text."""
    known = docs.where("doc IS NOT NULL")
    later, open_runs = repeats.split_known(repeats.suspects(repeats.records(known, _items, WINDOW, SEED_WORDS), across=True), across=True)
    bodies = cut(repeats.with_contents(known, open_runs, _bodies), "seeds")
    hubs = cut(bodies.groupBy("h").agg(F.min(F.struct("doc", "s", "a", "body")).alias("hub")), "hubs")
    beside = bodies.join(hubs, "h").where("doc != hub.doc OR s != hub.s")
    found = cut(beside.mapInArrow(_extend, "h long, doc long, s long, n int, w long"), "matches")
    release(bodies, hubs)
    rest = found.where("w IS NOT NULL")
    firsts = cut(rest.groupBy("h", "w").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("h", "w", "low"), "firsts")
    thirds = rest.join(firsts, ["h", "w"]).where("doc > low")
    return later.unionByName(found.where("w IS NULL").select("doc", "s", "n")).unionByName(thirds.select("doc", "s", "n"))


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", *, texts: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row; with texts, also kept: the words left, joined by blanks."""
    plain = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    ranged = repeats.with_ranges(plain, repeated_ranges(plain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                starts, ends, first = words(data, offsets)
                row, s, n = repeats.range_lists(rows.column(2))
                gone = covered(first[row] + s, n, WINDOW, len(starts))
                keep = ~gone
                left, at, to = spaced(data, starts[keep], ends[keep])
                upto = np.append(0, np.cumsum(keep))[first]
                raw = left.tobytes()
                kept = [raw[at[a] : to[b - 1]] if b > a else b"" for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]
                columns = [rows.column(0), pa.array(np.diff(first)), pa.array(np.diff(first) - np.diff(upto)), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                if texts:
                    columns.append(pa.array([x.decode("utf-8") for x in kept], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[key, "n_words", "n_removed", "kept_sha256", "kept"][: len(columns)])

    return ranged.mapInArrow(run, f"`{key}` long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)


#: The same result from documents, in DuckDB's SQL.
SQL = r"""WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM split)),
firsts AS (SELECT h, min(doc_id) AS low FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM windows JOIN firsts USING (h), range(13) r(j) WHERE doc_id > low),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM split),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT s.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256 FROM split s LEFT JOIN kept k USING (doc_id)"""
