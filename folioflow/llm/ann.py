"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes by learned rotations: an extra component turns largest
inner product into smallest angle, and orthogonal rotations, each fitted by
iterative quantisation on a bounded sample, give the code's bits. A code is split
into m substrings of b bits (2 ** b is about a block's rows), and a block of rows
has an index of each. A query probes, in every index, the values within t bits of
its own. By pigeonhole that retrieves every code within m * (t + 1) - 1 bits, and
farther ones as well, where one substring is near. t is the least under which
probing retrieves the share PROBED of the sample's true neighbours; a query that
retrieves fewer than k rows probes on with t + 1, and so on. Nothing is compared
but what probing retrieved: codes within the radius that holds the share WITHIN
of the sample's neighbours (all retrieved ones, if under k are) are reranked by
the inner product of the original vectors in double precision.

Rows are dealt to blocks by a hash of their id, queries to blocks of queries, and
each pair of blocks is one task, bounded in bytes. A row is copied once for every
block of queries, a query once for every block of rows.

Edge cases: vectors that are null, zero, of another length than most, or that
hold null or non-finite components take no part, nor do rows without an id; rows
that repeat an id count once, as candidate and as query, with their least vector;
with k or fewer candidates all are returned; equal scores go to the smaller id;
rows with the query's own id are no candidates; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import cut

#: Rows that rotations and radius are learned from, at most.
SAMPLE = 8000
#: 64-bit words of a code.
CODES = 8
#: Shares of the sample's true neighbours that probing must retrieve, and that must lie within the radius.
PROBED, WITHIN = 0.97, 0.985
#: Bytes of a block of rows, and of queries, in double precision; bits of a substring.
BLOCK_BYTES, QUERY_BYTES = 1 << 26, 1 << 25
LEAST_BITS, MOST_BITS = 6, 16
SEED = 20240613


def valid(vector: Column) -> Column:
    """Whether a vector has no null and no non-finite component and isn't zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 1), np.float32)


class Codes:
    """Learned binary codes for rows and for queries."""

    def __init__(self, sample: np.ndarray, longest: float, seed: int = SEED, words: int = CODES):
        rng = np.random.default_rng(seed)
        self.longest = longest
        x = self._lifted(sample)
        d = x.shape[1]
        bits = 64 * words
        self.rotations = []
        while sum(r.shape[1] for r in self.rotations) < bits:
            r = np.linalg.qr(rng.standard_normal((d, d)))[0]
            for _ in range(12 if len(x) > d else 0):
                u, _, v = np.linalg.svd(np.where(x @ r >= 0, 1.0, -1.0).T @ x)
                r = (u @ v).T
            self.rotations.append(r)
        self.rotation = np.concatenate(self.rotations, 1)[:, :bits]

    def _lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64) / self.longest
        return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))], 1)

    def _packed(self, lifted: np.ndarray) -> np.ndarray:
        return np.packbits(lifted @ self.rotation >= 0, axis=1).view(np.uint64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self._packed(self._lifted(x))

    def queries(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        return self._packed(np.concatenate([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))], 1))


class MultiIndex:
    """Indexes of the substrings of a block's codes."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.codes, self.bits = codes, bits
        self.values = substrings(codes, bits)
        self.m = self.values.shape[1]
        size = 1 << bits
        keyed = self.values + np.arange(self.m) * size  # one index of all substrings, by (substring, value)
        flat = keyed.T.reshape(-1)
        self.rows = np.argsort(flat, kind="stable") % max(len(codes), 1)
        self.starts = np.append(0, np.cumsum(np.bincount(flat, minlength=self.m * size)))
        self.balls = balls(bits)

    def probe(self, values: np.ndarray, flips: int) -> np.ndarray:
        """Rows with a substring within so many bits of the query's: among them every code within m * (flips + 1) - 1."""
        at = ((values[:, None] ^ self.balls[flips]) + (np.arange(self.m) << self.bits)[:, None]).reshape(-1)
        first, n = self.starts[at], self.starts[at + 1] - self.starts[at]
        to = np.cumsum(n)
        hit = np.zeros(len(self.codes), bool)
        hit[self.rows[np.repeat(first - (to - n), n) + np.arange(to[-1])]] = True
        return np.flatnonzero(hit)


def substrings(codes: np.ndarray, bits: int) -> np.ndarray:
    """Values of the substrings of each code; bits that are left over are in none."""
    each = np.unpackbits(codes.view(np.uint8), axis=1)
    m = each.shape[1] // bits
    return each[:, : m * bits].reshape(len(codes), m, bits).astype(np.int64) @ (1 << np.arange(bits))


def balls(bits: int) -> list[np.ndarray]:
    """Values of at most 0, 1, 2 ... set bits."""
    weight = np.bitwise_count(np.arange(1 << bits, dtype=np.int64))
    return [np.flatnonzero(weight <= t) for t in range(bits + 1)]


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, codes: Codes, plan: tuple[int, int, int], k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query (query id repeated, ids, scores) of its k best rows among those that probing retrieves."""
    bits, least_flips, radius = plan
    index, query_codes = MultiIndex(codes.rows(x), bits), codes.queries(q)
    asked = substrings(query_codes, bits)
    wide, own = x.astype(np.float64), q.astype(np.float64)
    out = []
    for i in range(len(q)):
        for flips in range(least_flips, bits + 1):
            at = index.probe(asked[i], flips)
            at = at[ids[at] != query_ids[i]]
            if len(at) >= k:
                break
        near = np.bitwise_count(index.codes[at] ^ query_codes[i]).sum(1) <= radius
        if np.count_nonzero(near) >= k:
            at = at[near]
        score = (wide[at] * own[i]).sum(1)
        if len(at) > k:
            keep = score >= np.partition(score, len(at) - k)[len(at) - k]
            at, score = at[keep], score[keep]
        best = np.lexsort((ids[at], -score))[:k]
        out.append((np.full(len(best), query_ids[i]), ids[at[best]], score[best]))
    return out


def calibrated(codes: Codes, sample: np.ndarray, k: int, bits: int, seed: int = SEED) -> tuple[int, int, int]:
    """(bits, flips, radius) by the true neighbours of 200 of the sample's rows: a larger table's are nearer."""
    rng = np.random.default_rng(seed)
    chosen = rng.choice(len(sample), min(200, len(sample)), replace=False)
    k = min(k, len(sample) - 1)
    if k < 1:
        return bits, 0, 64 * CODES
    x = sample.astype(np.float64)
    score = x[chosen] @ x.T
    score[np.arange(len(chosen)), chosen] = -np.inf
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    asked, rows = codes.queries(x[chosen]), codes.rows(x)
    far = np.bitwise_count(asked[:, None] ^ rows[best]).sum(2)
    nearest_part = np.bitwise_count(substrings(asked, bits)[:, None] ^ substrings(rows, bits)[best]).min(2)
    flips = next(t for t in range(bits + 1) if (nearest_part <= t).mean() >= PROBED)
    return bits, flips, int(np.quantile(far, WITHIN)) + 1


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, key, score) of the k rows of largest inner product to each row of which is_query holds."""
    spark = vectors.sparkSession
    clean = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where(F.col("id").isNotNull() & valid(F.col("v")))
    result = f"query_id long, rank int, {key} long, score double"
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    stats = clean.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(norm).alias("longest"), F.count_if("q").alias("queries")).orderBy(F.desc("n"), "d").first()
    if stats is None or not stats["queries"]:
        return spark.createDataFrame([], result)
    rows = clean.where(F.size("v") == stats["d"]).groupBy("id").agg(F.min("v").alias("v"), F.bool_or("q").alias("q"))
    rows = cut(rows, "vectors")
    sample = matrix(rows.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(SAMPLE).select("v").toArrow()["v"])
    codes = Codes(sample, stats["longest"])
    blocks = max(-(-stats["n"] * 8 * stats["d"] // BLOCK_BYTES), min(16, -(-stats["n"] // 4096)))
    query_blocks = -(-stats["queries"] * 8 * stats["d"] // QUERY_BYTES)
    plan = calibrated(codes, sample, k, min(MOST_BITS, max(LEAST_BITS, (stats["n"] // blocks).bit_length())))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = rows.select("id", "v", F.lit(False).alias("q"), deal(blocks).alias("block")).withColumn("query_block", every(query_blocks))
    asked = rows.where("q").select("id", "v", "q", deal(query_blocks).alias("query_block")).withColumn("block", every(blocks))

    def search(group: pa.Table) -> pa.Table:
        asks = np.array(group["q"].to_pylist(), bool)
        ids, x = group["id"].to_numpy(), matrix(group["v"])
        found = search_block(ids[~asks], x[~asks], ids[asks], x[asks], codes, plan, k) if asks.any() and not asks.all() else []
        columns = [np.concatenate([f[i] for f in found]) if found else np.empty(0, t) for i, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.table([pa.array(c) for c in columns], names=["query_id", "id", "score"])

    near = index.unionByName(asked).groupBy("query_block", "block").applyInArrow(search, "query_id long, id long, score double")
    # The best k of every block hold the best k of all.
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
