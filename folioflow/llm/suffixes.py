"""Suffix-array dedup by merging Burrows-Wheeler transforms.

Windows of 100 bytes that start earlier elsewhere go. What runs of anchors leave
open (repeats.py) is settled on the bytes themselves. A chunk of run contents is
split into shards; each shard's rotations are sorted to 100 bytes, and its
transform holds the symbol before each. The alphabet is 25-byte blocks, so 100
bytes are four symbols and one step back is 25 bytes. The shards are never
sorted together: an interleave (which shard gives the next row) starts as their
concatenation, and each refinement deals the rows, in order, to the bucket of
the symbol before them. After t refinements the interleave is right for 25 t
bytes, and a row begins a new class where its symbol or the class it came from
changed: its common prefix with the row before is then under 25 t bytes. After
four, the classes are the repeated intervals of 100 bytes.

Runs travel by anchor, so equal windows meet in one chunk. No task could hold the
runs of an anchor with over HOT contents together: there the same refinement is
done by joins. A class is named by what makes it (the symbol and the class 25
bytes on, as 128 bits of hashes) rather than by its rank, four refinements give
the repeated intervals, and first occurrences are pre-aggregated.

Edge cases: null and empty texts have no bytes; texts under 100 bytes lose
nothing; rows without a key lose nothing and remove nothing; keys are unique
(rows repeated with key and text get equal results); very long texts are cut
into runs piece by piece; kept bytes need not be whole characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import repeats
from .anchors import covered
from .common import _BYTE_VALUES, cut, mixed, slices

WINDOW, GRAM = 100, 32
SYMBOL, ROUNDS = 25, 4
SHARDS = 4
#: Bytes of run contents in a chunk, and contents of an anchor that travel together.
CHUNK, HOT = 1 << 18, 2000


def _items(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = mixed(_BYTE_VALUES[data])
    return h, offsets, repeats.doubled(h, GRAM)


def _bodies(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip((offsets[row] + starts).tolist(), (offsets[row] + starts + sizes + WINDOW - 1).tolist())]


def _ranked(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


class Shard:
    """The rotations of some texts, sorted to 100 bytes by an arbitrary but fixed order of symbols, and their transform."""

    def __init__(self, symbol: np.ndarray, ahead: np.ndarray, back: np.ndarray):
        """symbol: the block that starts at each place; ahead, back: the place one block on and back, around its text."""
        size = np.int64(len(symbol) + 1)
        local, _ = np.unique(symbol, return_inverse=True)
        rank = np.searchsorted(local, symbol)
        two = _ranked(rank * size + rank[ahead])
        self.rows = np.argsort(two * size + two[ahead[ahead]], kind="stable")
        self.transform = symbol[back[self.rows]]


def merge_shards(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each row of the merged order, its class: equal numbers for equal 100 bytes), by refining the interleave."""
    order = np.repeat(np.arange(len(shards)), [len(s.rows) for s in shards])
    classes = np.zeros(len(order), np.int64)
    for _ in range(ROUNDS):
        symbols = np.empty(len(order), np.int64)
        for i, s in enumerate(shards):
            symbols[order == i] = s.transform
        to = np.argsort(symbols, kind="stable")
        symbols, came = symbols[to], classes[to]
        order = order[to]
        new = np.ones(len(order), bool)
        new[1:] = (symbols[1:] != symbols[:-1]) | (came[1:] != came[:-1])
        classes = np.cumsum(new)
    return order, classes


def repeated_windows(bodies: list[bytes], windows: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(body, window) of every window whose bytes start earlier, by (document, start), in another window of the bodies."""
    sizes = np.array([len(b) for b in bodies])
    data = np.frombuffer(b"".join(b + b[: SYMBOL - 1] for b in bodies), np.uint8)
    at = np.cumsum(sizes + SYMBOL - 1) - sizes - SYMBOL + 1  # of each body in data
    to = np.cumsum(sizes)
    first = to - sizes  # of each body among all places
    body = np.repeat(np.arange(len(bodies)), sizes)
    inside = np.arange(to[-1]) - first[body]
    symbol = _ranked(repeats.doubled(mixed(_BYTE_VALUES[data]), SYMBOL)[at[body] + inside]).astype(np.int64)
    ahead = first[body] + (inside + SYMBOL) % sizes[body]
    back = first[body] + (inside - SYMBOL) % sizes[body]
    # Shards of whole bodies, about equal in bytes.
    edges = np.unique(np.searchsorted(to, np.linspace(0, to[-1], SHARDS + 1)[1:-1]) + 1)
    edges = np.concatenate([[0], edges[edges < len(bodies)], [len(bodies)]])
    shards, bases = [], []
    for a, b in zip(edges, edges[1:]):
        lo, hi = first[a], to[b - 1]
        shards.append(Shard(symbol[lo:hi], ahead[lo:hi] - lo, back[lo:hi] - lo))
        bases.append(lo)
    order, classes = merge_shards(shards)
    place = np.empty(len(order), np.int64)
    for i, s in enumerate(shards):
        place[order == i] = s.rows + bases[i]
    opens = inside[place] < windows[body[place]]
    place, classes = place[opens], classes[opens]
    # Of each class the earliest window stays.
    doc, start = docs[body[place]], starts[body[place]] + inside[place]
    by = np.lexsort((start, doc, classes))
    place, classes, doc, start = place[by], classes[by], doc[by], start[by]
    head = np.ones(len(place), bool)
    head[1:] = classes[1:] != classes[:-1]
    lead = np.maximum.accumulate(np.where(head, np.arange(len(place)), 0))
    gone = (doc != doc[lead]) | (start != start[lead])
    return body[place[gone]], inside[place[gone]]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key: chunks of whole keys give the windows to remove."""
    held: list[tuple] = []
    size, last = 0, None

    def out() -> pa.RecordBatch:
        found = np.empty(0, np.int64), np.empty(0, np.int64)
        docs, starts = (np.array([x[i] for x in held], np.int64) for i in (1, 2))
        if len(held) > 1:
            found = repeated_windows([x[4] for x in held], np.array([x[3] for x in held]), docs, starts)
        held.clear()
        body, window = found
        return pa.RecordBatch.from_arrays([pa.array(docs[body]), pa.array(starts[body] + window), pa.array(np.ones(len(body), np.int32))], names=["doc", "s", "n"])

    for batch in batches:
        for x in zip(*(c.to_pylist() for c in batch.columns)):
            if size > CHUNK and x[0] != last:
                yield out()
                size = 0
            held.append(x)
            size += len(x[4])
            last = x[0]
    if held:
        yield out()


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc, s, n): runs of n windows from byte s that start earlier elsewhere. docs: doc, text."""
    known = docs.where("doc IS NOT NULL")
    later, open_runs = repeats.split_known(repeats.suspects(repeats.records(known, _items, WINDOW, GRAM), across=False), across=False)
    bodies = cut(repeats.with_contents(known, open_runs, _bodies), "bodies")
    cool = bodies.where(F.col("contents") <= HOT).select(F.col("h").alias("key"), "doc", "s", "n", "body")
    each = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    hot = bodies.where(F.col("contents") > HOT).withColumn("i", each).select("h", "doc", (F.col("s") + F.col("i")).alias("s"), F.lit(1).alias("n"), F.substring("body", F.col("i") + 1, F.lit(WINDOW)).alias("body"))
    classes = [F.lit(1).cast("long"), F.lit(2).cast("long")]
    for i in reversed(range(ROUNDS)):
        classes = [F.xxhash64(F.substring("body", i * SYMBOL + 1, SYMBOL), c) for c in classes]
    hot = hot.select("doc", "s", "n", "h", classes[0].alias("k1"), classes[1].alias("k2"))
    heads = cut(hot.groupBy("h", "k1", "k2").agg(F.min(F.struct("doc", "s")).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times"), "heads")
    doubles = hot.join(heads, ["h", "k1", "k2"]).where(F.struct("doc", "s") > F.col("first")).select("doc", "s", "n")
    dealt = cool.repartition("key").sortWithinPartitions("key", "doc", "s")
    found = dealt.mapInArrow(_settle, "doc long, s long, n int")
    return later.unionByName(doubles).unionByName(found)


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", *, texts: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of every row; with texts, also kept: the bytes left."""
    plain = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    ranged = repeats.with_ranges(plain, repeated_ranges(plain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                row, s, n = repeats.range_lists(rows.column(2))
                gone = covered(offsets[row] + s, n, WINDOW, len(data))
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                edges = offsets[:-1][offsets[:-1] < len(data)]
                begins[edges] = gone[edges]
                count = lambda mask: np.diff(np.append(0, np.cumsum(mask))[offsets])
                left, upto = data[~gone].tobytes(), np.append(0, np.cumsum(~gone))[offsets].tolist()
                kept = [left[a:b] for a, b in zip(upto, upto[1:])]
                columns = [rows.column(0), pa.array(np.diff(offsets)), pa.array(count(gone)), pa.array(count(begins)), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                if texts:
                    columns.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: len(columns)])

    return ranged.mapInArrow(run, f"`{key}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts)


#: The same result from documents, in DuckDB's SQL.
SQL = r"""WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
pieces AS (SELECT doc_id, n, o, x[2 * o + 1:2 * o + 698] AS piece FROM (SELECT *, unnest(range(0, n - 99, 250)) AS o FROM texts)),
windows AS (SELECT doc_id, o + j AS i, md5_number(piece[2 * j + 1:2 * j + 200]) AS h FROM pieces, range(250) r(j) WHERE o + j <= n - 100),
firsts AS (SELECT h, min((doc_id, i)) AS first FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM windows JOIN firsts USING (h) WHERE (doc_id, i) > first),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, count_if(step IS NULL OR step > 100) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM gone) GROUP BY doc_id, run),
edges AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs),
cuts AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, string_agg(x[2 * before + 1:2 * a], '' ORDER BY a) AS head, max(b) AS tail FROM edges JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || x[2 * coalesce(tail, 0) + 1:])) AS kept_sha256 FROM texts t LEFT JOIN cuts USING (doc_id)"""
