"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words, word pairs
(and whether a pair's words are the same) and character n-grams (words between
blanks, so n-grams see a word's edges); a softmax over two outputs gives the probability of label 1. Vectors and outputs are trained
by plain numpy stochastic gradient descent on a bounded, seeded sample of the
labelled rows (max_rows, documented; a model that stops improving long before
needs no more). The softmax of an average is linear in the features, so scoring
needs one number a bucket: the difference of the outputs at its vector.

Features are counted on the executors, long texts piece by piece; the driver gets
each chosen row's packed counts, at most 2 ** BUCKET_BITS of them, and no text.

Edge cases: null and empty texts have no features and get the score of the
bias; a label other than 0 and 1, or a row whose label occurs twice
differently, is not learned from; without any labelled rows, or with one class
only, scores are the (smoothed) share of label 1, 0.5 if there is none;
repeated rows get equal scores; an empty table gives no rows; other columns pass
through unless they bear the result's name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import mixed, slices, spaced, window_hashes, word_hashes, words

BUCKET_BITS = 18
GRAMS = (2, 3, 4)
DIMENSION = 16
EPOCHS, RATE, SEED = 6, 4.0, 20240611
#: At most so many labelled rows are learned from.
MAX_ROWS = 6000
#: Bytes of text whose features are held at once (a single longer word is held whole).
PIECE = 1 << 20


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every feature of every row, its row), rows in order within each n."""
    starts, ends, first = words(data, offsets)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    shift = np.uint64(64 - BUCKET_BITS)
    own = word_hashes(data, starts, ends)
    pairs = np.flatnonzero(rows[1:] == rows[:-1])
    again = own[pairs] == own[pairs + 1]
    found = [own, window_hashes(own, 2)[pairs] if len(pairs) else own[:0], mixed(again.astype(np.uint64) + np.uint64(11))]
    found, owners = [(h >> shift).astype(np.int64) for h in found], [rows, rows[pairs], rows[pairs]]
    text, starts, ends = spaced(data, starts, ends)
    text = np.concatenate([np.array([0x20], np.uint8), text])
    lead = (text & 0xC0) != 0x80
    points = text.astype(np.uint64) if lead.all() else np.frombuffer(text.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
    blank = points == 0x20
    upto = np.cumsum(blank)
    word = np.minimum(upto - 1, len(rows) - 1)  # a blank belongs to the word after it
    values = mixed(points + np.uint64(1))
    for n in GRAMS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        # blanks inside a window other than at its ends: none
        inner = upto[n - 2 : n - 2 + m] - upto[:m]
        good = np.flatnonzero(inner == 0)
        owner = rows[word[good + 1]] if n > 2 else rows[word[good]]
        found.append((window_hashes(values, n, n)[good] >> shift).astype(np.int64))
        owners.append(owner)
    return np.concatenate(found), np.concatenate(owners)


def portions(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """features() of some rows, or those of one long row in pieces cut between words."""
    if len(offsets) != 2 or len(data) <= PIECE:
        yield features(data, offsets)
        return
    starts, ends, _ = words(data, offsets)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), PIECE)), len(starts)))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        piece = data[starts[i] : ends[j - 1]]
        yield features(piece, np.array([0, len(piece)]))
        if j < len(starts):  # the pair of words across the cut
            both = word_hashes(data, starts[j - 1 : j + 1], ends[j - 1 : j + 1])
            pair = np.append(window_hashes(both, 2), mixed(np.array([int(both[0] == both[1]) + 11], np.uint64)))
            yield (pair >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.zeros(2, np.int64)


def packed(data: np.ndarray) -> bytes:
    """Counts of all features of one text: distances between its buckets and their counts, compressed."""
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for buckets, _ in portions(data, np.array([0, len(data)])):
        counts += np.bincount(buckets, minlength=len(counts))
    at = np.flatnonzero(counts)
    return zlib.compress(np.stack([np.diff(at, prepend=0), counts[at]]).astype("<u4").tobytes(), 1)


def unpacked(row: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, each one's share of the text's features)"""
    steps, counts = np.frombuffer(zlib.decompress(row), "<u4").reshape(2, -1)
    return np.cumsum(steps), (counts / max(int(counts.sum(dtype=np.int64)), 1)).astype(np.float32)


def train(rows: list[bytes], labels: np.ndarray, *, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, float]:
    """(score of each bucket, bias): the log-odds of label 1 are their average over a text's features, plus the bias.

    rows: the texts' packed features."""
    size = 1 << BUCKET_BITS
    ones = int(labels.sum())
    if not 0 < ones < len(labels):
        return np.zeros(size, np.float32), float(np.log((ones + 0.5) / (len(labels) - ones + 0.5)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (size, DIMENSION)).astype(np.float32)
    outputs = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (2, DIMENSION)).astype(np.float32)
    bias = np.log(np.array([len(labels) - ones, ones], np.float32) / len(labels))
    steps, done = epochs * len(labels), 0
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            at, share = unpacked(rows[i])
            lr = np.float32(rate * (1 - done / steps))
            done += 1
            if not len(at):
                continue
            held = vectors[at]
            mean = share @ held
            z = outputs @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[i])] -= 1
            # Sharing a step by document frequency keeps frequent features from swinging.
            gradient = p @ outputs
            outputs -= lr * 0.1 * np.outer(p, mean)
            bias -= lr * 0.01 * p
            vectors[at] = held - np.outer(lr * share, gradient)
    return vectors @ (outputs[1] - outputs[0]), float(bias[1] - bias[0])


def labelled_sample(docs: DataFrame, labels: DataFrame, held_out, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS) -> tuple[list[bytes], np.ndarray]:
    """Packed features and labels of at most max_rows labelled rows that aren't held out, by a seeded hash of the key."""
    clear = labels.groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_label"), F.max(label).alias("_most")).where("_label = _most AND _label IN (0, 1)").where(~held_out(F.col("_key")))
    # Keys that no document has would take places of the sample.
    clear = clear.join(docs.select(F.col(key).alias("_key")).where("_key IS NOT NULL"), "_key", "left_semi")
    chosen = clear.orderBy(F.xxhash64(F.lit(SEED), "_key"), "_key").limit(max_rows).select("_key", F.col("_label").cast("int").alias("_label"))
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("_id") == F.col("_key")).select("_key", "_label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text", PIECE):
                found = [packed(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(found, pa.binary())], names=["_key", "_label", "_counts"])

    kind = dict(rows.dtypes)["_key"]
    # Of rows that repeat a key one is learned from, so the bound holds for rows too.
    counted = rows.mapInArrow(run, f"_key {kind}, _label int, _counts binary").groupBy("_key").agg(F.min("_label").alias("_label"), F.min("_counts").alias("_counts"))
    found = counted.toArrow().sort_by("_key")
    return found["_counts"].to_pylist(), np.array(found["_label"].to_pylist(), np.int64)


def score(docs: DataFrame, weights: np.ndarray, bias: float, text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """docs (all columns, or those named in keep) with score, the probability of label 1."""
    kept = [f for f in docs.schema.fields if f.name != "score" and (keep is None or f.name in keep)]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, text, PIECE):
                n = len(offsets) - 1
                total, number = np.zeros(n), np.zeros(n)
                for buckets, owners in portions(data, offsets):
                    total += np.bincount(owners, weights[buckets], minlength=n)
                    number += np.bincount(owners, minlength=n)
                mean = total / np.maximum(number, 1)
                found = pa.array(1 / (1 + np.exp(-np.clip(mean + bias, -500, 500))))
                yield pa.RecordBatch.from_arrays([*[rows.column(rows.schema.get_field_index(f.name)) for f in kept], found], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
