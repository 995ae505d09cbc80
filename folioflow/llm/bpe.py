"""Byte-level BPE: vectorised pre-tokenisation, cached merging, decoding.

Pre-tokenisation runs no regex. Each code point gets a class (with one code
point of look-ahead folded in: the last blank of a run, the first letter of a
two-letter contraction). A class is a function from scanner state to scanner
state; functions compose associatively, so the state before every code point
comes from a blocked prefix scan over the finite set of composed functions.
A token starts where (state before, class) says so.

Edge cases: null and empty texts give no ids; repeated texts give equal ids;
very long texts are one slice; other columns pass through untouched.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import distinct_slices, run_starts, slices

#: Entries of a worker's token cache; it is emptied when full.
CACHE_WORDS = 200_000

# Scanner states. FREE: the next code point starts a token. TICK: a token that
# is one apostrophe so far. PAIR: a contraction that lacks its second letter.
# BLANK: a token that is one space so far.
FREE, LETTER, NUMBER, OTHER, TICK, PAIR, SPACES, BLANK = range(8)
# Classes. SHORT: letters that end a contraction alone. DOUBLE: r, v or l that
# starts one of two letters. W_MORE: white space before white space or the end.
# W_BLANK, W_LAST: the last white space before something else, a space or not.
C_LETTER, C_SHORT, C_DOUBLE, C_NUMBER, C_OTHER, C_TICK, C_MORE, C_BLANK, C_LAST, C_EDGE = range(10)
# Unicode White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _step(state: int, kind: int) -> tuple[int, bool]:
    """(next state, whether a token starts here)"""
    if kind == C_EDGE:
        return FREE, True
    if kind == C_MORE:
        return SPACES, state != SPACES
    if kind == C_BLANK:
        return BLANK, True
    if kind == C_LAST:
        return FREE, True
    if state == PAIR:
        return FREE, False
    if state == TICK and kind == C_SHORT:
        return FREE, False
    if state == TICK and kind == C_DOUBLE:
        return PAIR, False
    if kind in (C_LETTER, C_SHORT, C_DOUBLE):
        return LETTER, state not in (LETTER, BLANK)
    if kind == C_NUMBER:
        return NUMBER, state not in (NUMBER, BLANK)
    if kind == C_TICK and state not in (OTHER, TICK, BLANK):
        return TICK, True
    return OTHER, state not in (OTHER, TICK, BLANK)


@lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every function that classes compose to: the class's function, the composition table, the images, and the starts by (state, class)."""
    steps = [[_step(s, c) for s in range(8)] for c in range(10)]
    found = [tuple(range(8))]
    index = {found[0]: 0}

    def number(f: tuple[int, ...]) -> int:
        if f not in index:
            index[f] = len(found)
            found.append(f)
        return index[f]

    of_class = [number(tuple(x[0] for x in row)) for row in steps]
    at = 0
    while at < len(found):
        f = found[at]
        for c in of_class:
            number(tuple(found[c][s] for s in f))
        at += 1
    n = len(found)
    images = np.array(found, np.uint8)
    compose = np.empty((n, n), np.uint16)
    for a in range(n):
        for b in range(n):
            compose[a, b] = index[tuple(found[b][s] for s in found[a])]
    starts = np.array([[steps[c][s][1] for c in range(10)] for s in range(8)])
    return np.array(of_class, np.uint16), compose, images, starts


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    """Class of each code point, without look-ahead (white space as C_MORE)."""
    kinds = np.full(sys.maxunicode + 1, C_OTHER, np.uint8)
    kinds[:] = [{"L": C_LETTER, "N": C_NUMBER}.get(unicodedata.category(chr(i))[0], C_OTHER) for i in range(sys.maxunicode + 1)]
    kinds[WHITE_SPACE] = C_MORE
    kinds[ord("'")] = C_TICK
    kinds[[ord(c) for c in "stmd"]] = C_SHORT
    return kinds


def states_before(kinds: np.ndarray, block: int = 256) -> np.ndarray:
    """The scanner's state before each item, by a blocked scan of composed functions."""
    of_class, compose, images, _ = automaton()
    n = len(kinds)
    if not n:
        return np.empty(0, np.uint8)
    blocks = -(-n // block)
    f = np.zeros(blocks * block, np.uint16)  # function 0 is the identity
    f[:n] = of_class[kinds]
    f = np.ascontiguousarray(f.reshape(blocks, block).T)
    for i in range(1, block):
        f[i] = compose[f[i - 1], f[i]]
    carry = np.empty(blocks, np.uint8)
    if blocks > block:
        carry = _scan_totals(f[-1])
    else:
        state = FREE
        for j in range(blocks):
            carry[j] = state
            state = images[f[-1, j], state]
    out = np.empty_like(f, dtype=np.uint8)
    out[0] = carry
    out[1:] = images[f[:-1], carry]
    return out.T.reshape(-1)[:n]


def _scan_totals(totals: np.ndarray) -> np.ndarray:
    """State before each block: an inclusive doubling scan over the blocks' functions."""
    _, compose, images, _ = automaton()
    f, step = totals.copy(), 1
    while step < len(f):
        f[step:] = compose[f[:-step], f[step:]]
        step *= 2
    return np.append(np.uint8(FREE), images[f[:-1], FREE])


def token_starts(text_bytes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets at which the pre-tokens of all rows start."""
    if not len(text_bytes):
        return np.empty(0, np.int64)
    lead = (text_bytes & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    if len(at) == len(text_bytes):
        points = text_bytes.astype(np.uint32)
    else:
        points = np.frombuffer(text_bytes.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kinds = code_point_classes()[points]
    edge = np.zeros(len(points) + 1, bool)
    edge[np.searchsorted(at, offsets)] = True  # rows start here, or all text ends
    after = np.append(kinds[1:], np.uint8(C_MORE))
    following = np.append(points[1:], np.uint32(0))
    last = edge[1:]
    white = kinds == C_MORE
    ends_run = white & ~last & (after != C_MORE)
    kinds[ends_run] = np.where(points[ends_run] == 0x20, C_BLANK, C_LAST)
    double = (((points == ord("r")) | (points == ord("v"))) & (following == ord("e"))) | ((points == ord("l")) & (following == ord("l")))
    kinds[double & ~last] = C_DOUBLE
    # A row's first code point is seen from FREE: its edge is an item of its own.
    rows = np.flatnonzero(edge[:-1])
    items = np.insert(kinds, rows, C_EDGE)
    where = np.delete(np.arange(len(items)), rows + np.arange(len(rows)))
    state = states_before(items)[where]
    return at[automaton()[3][state, kinds]]


@lru_cache(2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PairTable:
    """Ranks of adjacent token pairs, looked up for whole arrays at once."""

    NONE = np.int64(1 << 40)

    def __init__(self, table: dict[bytes, int]):
        self.table = table
        self.of_byte = np.array([table[bytes([i])] for i in range(256)], np.int64)
        found = [(table[p[:i]] << 32 | table[p[i:]], r) for p, r in table.items() if len(p) > 1 for i in range(1, len(p)) if p[:i] in table and p[i:] in table]
        keys, values = (np.array(x, np.int64) for x in zip(*sorted(found)))
        self.keys, self.values = np.append(keys, np.int64(1 << 62)), np.append(values, self.NONE)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], self.NONE)


def merge_many(pieces: list[bytes], pairs: PairTable) -> list[bytes]:
    """Ids of each pre-token, as little-endian unsigned 32-bit integers: in every round each one joins its leftmost pair of least rank, until none is known."""
    out = [b""] * len(pieces)
    open_ = []
    for i, p in enumerate(pieces):
        if (whole := pairs.table.get(p)) is not None:
            out[i] = whole.to_bytes(4, "little")
        elif len(p) > 64:
            out[i] = _merge_long(p, pairs.table)
        else:
            open_.append(i)
    if not open_:
        return out
    which = np.array(open_)
    sizes = np.array([len(pieces[i]) for i in open_])
    ids = pairs.of_byte[np.frombuffer(b"".join(pieces[i] for i in open_), np.uint8)]
    ends = np.cumsum(sizes)
    rank = np.append(pairs(ids[:-1], ids[1:]), pairs.NONE)
    rank[ends - 1] = pairs.NONE
    while len(which):
        starts = ends - sizes
        least = np.minimum.reduceat(rank, starts)
        done = least == pairs.NONE
        if done.any():
            flat = ids.astype("<u4").tobytes()
            for i, a, b in zip(which[done].tolist(), (4 * starts[done]).tolist(), (4 * ends[done]).tolist()):
                out[i] = flat[a:b]
            keep = np.repeat(~done, sizes)
            ids, rank = ids[keep], rank[keep]
            which, sizes, least = which[~done], sizes[~done], least[~done]
            ends = np.cumsum(sizes)
            starts = ends - sizes
            if not len(which):
                break
        hits = np.flatnonzero(rank == np.repeat(least, sizes))
        at = hits[np.searchsorted(hits, starts)]  # the leftmost in each
        ids[at] = least
        rank[at] = rank[at + 1]
        gone = np.ones(len(ids), bool)
        gone[at + 1] = False
        last = at + 2 >= ends
        ids, rank = ids[gone], rank[gone]
        at -= np.arange(len(at))
        sizes = sizes - 1
        ends = np.cumsum(sizes)
        right = at[~last]
        rank[right] = pairs(ids[right], ids[right + 1])
        rank[at[last]] = pairs.NONE
        left = at[at > ends - sizes]
        rank[left - 1] = pairs(ids[left - 1], ids[left])
    return out


def _merge_long(piece: bytes, table: dict[bytes, int]) -> bytes:
    """The same for one long pre-token, over a linked list and a heap: n log n."""
    import heapq

    n = len(piece)
    end = list(range(1, n + 1))
    back = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := table.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, to = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != to:
            continue
        j = end[i]
        alive[j], end[i] = False, to
        if to < n:
            back[to] = i
            if (r := table.get(piece[i : end[to]])) is not None:
                heapq.heappush(heap, (r, i, end[to]))
        if (p := back[i]) >= 0 and (r := table.get(piece[p:to])) is not None:
            heapq.heappush(heap, (r, p, to))
    return np.array([table[piece[i : end[i]]] for i in range(n) if alive[i]], "<u4").tobytes()


class Encoder:
    """Ids of many texts at once; keeps a cache of merged pre-tokens."""

    def __init__(self, path: str):
        self.ranks = ranks(path)
        self.pairs = PairTable(self.ranks)
        size = max(self.ranks.values()) + 1
        pieces: list[bytes] = [b""] * size
        for piece, i in self.ranks.items():
            pieces[i] = piece
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.cache: dict[bytes, bytes] = {}

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, each id's byte offset in data, each row's first id: n + 1 values)"""
        starts = token_starts(data, offsets)
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        of, where = distinct_slices(data, starts, np.append(starts[1:], len(data)))
        raw, cache = data.tobytes(), self.cache
        pieces = [raw[a:b] for a, b in zip(starts[where].tolist(), np.append(starts, len(data))[where + 1].tolist())]
        found = list(map(cache.get, pieces))
        if None in found:
            new = [p for p, t in zip(pieces, found) if t is None]
            fresh = dict(zip(new, merge_many(new, self.pairs)))
            found = [fresh[p] if t is None else t for p, t in zip(pieces, found)]
            cache.update((p, t) for p, t in fresh.items() if len(p) <= 64)
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at, each = run_starts(sizes)[of], sizes[of]
        to = np.cumsum(each)
        ids = flat[np.repeat(at - (to - each), each) + np.arange(to[-1] if len(to) else 0)]
        sizes = self.lengths[ids]
        to = np.cumsum(sizes) - sizes
        return ids, to, np.searchsorted(to, offsets)

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.lengths[ids]
        if not len(ids):
            return b""
        to = np.cumsum(sizes)
        return self.bytes[np.repeat(self.starts[ids] - (to - sizes), sizes) + np.arange(to[-1])].tobytes()


def encode_texts(docs: DataFrame, vocabulary: str, text: str = "text", *, digests: bool = False, places: bool = True, check: bool = False) -> DataFrame:
    """docs with its texts' ids (column ids) and, with places, the ids' byte offsets (id_offsets); with check,
    round_trip: whether the ids decode to the text's bytes. With digests, n_tokens, ids_sha256 and
    decoded_sha256 stand in place of the text. vocabulary is a rank file's path on every executor."""
    from pyspark.sql import types as T

    more = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>" + ", id_offsets array<long>" * places + ", round_trip boolean" * check
    made = T.StructType.fromDDL(more)
    kept = [f for f in docs.schema.fields if f.name not in made.names and not (digests and f.name == text)]
    schema = T.StructType([*kept, *made.fields])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(vocabulary)
        for batch in batches:
            for rows, data, offsets in slices(batch, text, 1 << 20):
                ids, at, first = coder.encode(data, offsets)
                columns = [rows.column(rows.schema.get_field_index(n)) for n in names]
                parts = [ids[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                if digests:
                    columns += [
                        pa.array(np.diff(first), pa.int64()),
                        pa.array([hashlib.sha256(p.astype("<u4", copy=False).tobytes()).hexdigest() for p in parts]),
                        pa.array([hashlib.sha256(coder.decode(p)).hexdigest() for p in parts]),
                    ]
                else:
                    columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32))))
                    if places:
                        base = np.repeat(offsets[:-1], np.diff(first))
                        columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(at - base, pa.int64())))
                    if check:
                        raw = data.tobytes()
                        columns.append(pa.array([coder.decode(p) == raw[a:b] for p, a, b in zip(parts, offsets[:-1].tolist(), offsets[1:].tolist())]))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def decode_texts(docs: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """docs with column decoded: the bytes that its ids stand for (binary; null ids give no bytes)."""
    from pyspark.sql import types as T

    schema = T.StructType([*[f for f in docs.schema.fields if f.name != "decoded"], T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(vocabulary)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            decoded = pa.array([coder.decode(np.array(x or [], np.int64)) for x in lists], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(f.name)) for f in schema.fields[:-1]], decoded], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
