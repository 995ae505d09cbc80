"""Plumbing of the two operators that remove repeated windows.

Both cut a document's windows into runs of one anchor (anchors.py). A run whose
anchor occurs once is done. A run whose whole content came earlier is removed
whole. What is left, the first runs of each content under an anchor with
several contents, is where one passage ends inside a run: few rows, and the
only ones whose content travels. They go to the operator's own method.

Rows that share an anchor never meet in one task: counts are pre-aggregated and
written, so that every join has an exchange on both sides, which adaptive skew
joins can split where an anchor or a content is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .anchors import runs
from .common import cut, mixed, release, slices

GOLD = np.uint64(0x9E3779B97F4A7C15)

#: (bytes, offsets) -> (item hashes, each row's first item: n + 1 values, hashes of the k-grams)
Items = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def doubled(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each k consecutive items, from those of powers of two."""
    powers, n = {1: h}, 1
    while n * 2 <= k:
        powers[2 * n] = mixed(powers[n][:-n] * GOLD + powers[n][n:]) if len(powers[n]) > n else powers[n][:0]
        n *= 2
    out, have, rest = powers[n], n, k - n
    while rest:
        n = 1 << (rest.bit_length() - 1)
        m = min(len(out), len(powers[n]) - have)
        out = mixed(out[: max(m, 0)] * GOLD + powers[n][have : have + max(m, 0)] + np.uint64(1))
        have, rest = have + n, rest - n
    return out


INVERSE = np.uint64(pow(int(GOLD), -1, 1 << 64))


def contents(h: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of the items starts .. starts + sizes - 1, for each slice: a difference of prefix sums, moved to power 0."""
    if not len(starts):
        return np.empty(0, np.uint64)
    n = len(h)
    powers = np.full(n, GOLD, np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    powers *= h
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum(powers, out=upto[1:])
    back = np.full(int(starts[-1]) + 1, INVERSE, np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    return mixed((upto[starts + sizes] - upto[starts]) * back[starts] + sizes.astype(np.uint64))


def records(docs: DataFrame, items: Items, window: int, k: int) -> DataFrame:
    """(h, ch, doc, s, n, a): every run of every document: anchor, content, first window, windows, and the anchor's place in the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text", 1 << 19):
                h, first, grams = items(data, offsets)
                row, start, n, at = runs(grams, first, window, k)
                ids = rows.column(rows.schema.get_field_index("doc")).to_numpy(zero_copy_only=False)
                columns = [grams[at].view(np.int64), contents(h, start, n + window - 1).view(np.int64), ids[row].astype(np.int64), (start - first[row]).astype(np.int64), n.astype(np.int32), (at - start).astype(np.int16)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "ch", "doc", "s", "n", "a"])

    return docs.mapInArrow(run, "h long, ch long, doc long, s long, n int, a short")


def suspects(found: DataFrame, across: bool) -> DataFrame:
    """The runs whose anchor occurs again (across: in another document), as a table."""
    again = found.groupBy("h").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high") if across else found.groupBy("h").agg(F.count("*").alias("runs")).where("runs > 1")
    anchors = cut(again.select("h"), "anchors")
    kept = cut(found.join(anchors, "h"), "suspects")
    release(anchors)
    return kept


def split_known(found: DataFrame, across: bool) -> tuple[DataFrame, DataFrame]:
    """(runs whose whole content came earlier, first runs of contents under anchors that have several), as tables.

    found is a table that suspects() wrote, and isn't kept."""
    place = F.struct("doc") if across else F.struct("doc", "s")
    firsts = cut(found.groupBy("h", "ch").agg(F.min(place).alias("first")), "contents")
    several = cut(firsts.groupBy("h").agg(F.count("*").alias("contents")).where("contents > 1"), "several")
    marked = cut(found.join(firsts, ["h", "ch"]).select("h", "doc", "s", "n", "a", (place > F.col("first")).alias("later")), "runs")
    release(found, firsts)
    return marked.where("later").select("doc", "s", "n"), marked.where("NOT later").join(several, "h").select("h", "doc", "s", "n", "a", "contents")


def by_document(ranges: DataFrame, *more: str) -> DataFrame:
    """One row a document with its ranges; a document has no more of them than windows."""
    return ranges.groupBy("doc").agg(F.collect_list(F.struct("s", "n", *more)).alias("ranges"))


def with_contents(docs: DataFrame, open_runs: DataFrame, cutter: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[bytes]]) -> DataFrame:
    """open_runs with column body: cutter(one text's bytes, its offsets, starts, windows) gives the bytes of each run."""
    wanted = docs.join(by_document(open_runs, "h", "contents", "a"), "doc").select("doc", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text", 1 << 20):
                lists = rows.column(2)
                counts = np.diff(lists.offsets.to_numpy())
                s, n, h, c, a = (lists.flatten().field(i) for i in range(5))
                starts, sizes = s.to_numpy(), n.to_numpy().astype(np.int64)
                row = np.repeat(np.arange(rows.num_rows), counts)
                body = cutter(data, offsets, row, starts, sizes)
                yield pa.RecordBatch.from_arrays([h, rows.column(0).take(pa.array(row)), s, n, a, c, pa.array(body, pa.binary())], names=["h", "doc", "s", "n", "a", "contents", "body"])

    return wanted.mapInArrow(run, "h long, doc long, s long, n int, a short, contents long, body binary")


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """docs with column ranges: what to remove of each (null: nothing)."""
    return docs.join(by_document(ranges), "doc", "left").select("doc", "text", "ranges")


def range_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, windows) of every range of a column of lists."""
    counts = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
    if column.null_count:
        counts = np.where(np.asarray(column.is_null()), 0, counts)
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), counts), flat.field(0).to_numpy(), flat.field(1).to_numpy().astype(np.int64)
