"""SimHash near-duplicates with BK-trees.

fingerprints(): one pass over whole texts; a bit is the majority of the
shingles' XXH64 bits. link(): distinct fingerprints go to shards by pigeonhole:
of radius + 1 blocks of the 64 bits, two fingerprints within the radius share
one, so a shard is a block and its value. A shard holds a BK-tree (children
keyed by integer Hamming distance to the parent); each fingerprint follows only
the edges within the radius of its own distance and joins what it finds, and
only the joins that unite two parts leave the shard, so a shard emits fewer
links than it has fingerprints. Shards of over max_shard fingerprints are cut
again by a second block of the other bits, exactly by the same argument, and
what is still larger meets chunk by chunk. A shard's tree travels to the task that holds the shard's queries; it isn't
broadcast, as its size has no fixed bound. components(): label exchange over
the links, with lineage cut each round.

Edge cases: null, empty and blank texts have fingerprint zero and link like any
other; equal texts share a fingerprint and so a component; repeated keys and
null keys are rows of their own (a null key never names a component unless all
its rows have null keys); other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import cut, mixed, release, slices, spaced, window_hashes, word_hashes, words

SHINGLE, RADIUS, SEED = 3, 3, 42
MAX_SHARD = 20_000


def text_fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE, fold: bool = True) -> np.ndarray:
    """The unsigned 64-bit SimHash of each row."""
    n = len(offsets) - 1
    if fold:
        data = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    starts, ends, first = words(data, offsets)
    out = np.zeros(n, np.uint64)
    if not len(starts):
        return out
    text, starts, ends = spaced(data, starts, ends)
    counts = np.diff(first)
    shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    to = np.cumsum(shingles)
    begin = np.repeat(first[:-1] - (to - shingles), shingles) + np.arange(to[-1])
    last = np.minimum(begin + shingle, np.repeat(first[1:], shingles)) - 1
    raw, f = text.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((f(raw[a:b], SEED) for a, b in zip(starts[begin].tolist(), ends[last].tolist())), np.uint64, len(begin))
    some = np.flatnonzero(shingles)
    at = (to - shingles)[some]
    half = shingles[some] // 2
    for bit in range(64):
        ones = np.add.reduceat((h >> np.uint64(bit)).astype(np.uint8) & np.uint8(1), at, dtype=np.int64)
        out[some] |= (ones > half).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """docs (all columns, or those named in keep) with fingerprint: the SimHash's bits as a long."""
    kept = [f for f in docs.schema.fields if f.name != "fingerprint" and (keep is None or f.name in keep)]
    schema = T.StructType([*kept, T.StructField("fingerprint", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, text):
                found = pa.array(text_fingerprints(data, offsets, shingle).view(np.int64))
                yield pa.RecordBatch.from_arrays([*[rows.column(rows.schema.get_field_index(f.name)) for f in kept], found], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


class BKTree:
    """A BK-tree over 64-bit codes; node 0 is the root."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, code: int) -> None:
        self.codes.append(code)
        self.children.append({})
        if len(self.codes) == 1:
            return
        at = 0
        while True:
            d = (code ^ self.codes[at]).bit_count()
            child = self.children[at].get(d)
            if child is None:
                self.children[at][d] = len(self.codes) - 1
                return
            at = child

    def within(self, code: int, radius: int) -> list[int]:
        """Nodes within the radius, following only edges that can lead there."""
        found, open_ = [], [0] if self.codes else []
        while open_:
            at = open_.pop()
            d = (code ^ self.codes[at]).bit_count()
            if d <= radius:
                found.append(at)
            for edge, child in self.children[at].items():
                if d - radius <= edge <= d + radius:
                    open_.append(child)
        return found


def shard_links(codes: list[int], radius: int, first: int | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the codes (distinct) within the radius of one another.

    first: so many codes are one chunk, the rest another, and only pairs across them count."""
    tree, parent, links = BKTree(), list(range(len(codes))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, code in enumerate(codes):
        if first is not None and i < first:
            tree.add(code)
            continue
        for j in tree.within(code, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                links.append((code, codes[j]))
        if first is None:
            tree.add(code)
    return links


def _blocks(bits: range, parts: int) -> list[range]:
    edges = [bits.start + len(bits) * i // parts for i in range(parts + 1)]
    return [range(a, b) for a, b in zip(edges, edges[1:])]


def _value(code: Column, bits: range) -> Column:
    return F.shiftrightunsigned(code, bits.start).bitwiseAND(F.lit((1 << len(bits)) - 1)) if len(bits) < 64 else code


def _second(radius: int, block: range) -> list[Column]:
    """Values of radius + 1 blocks of the bits outside block, tagged by number."""
    out = []
    others = [i for i in range(64) if i not in block]
    for k, part in enumerate(_blocks(range(len(others)), radius + 1)):
        low, high = others[part.start], others[part.stop - 1]
        if high - low + 1 == len(part):
            value = _value(F.col("fp"), range(low, high + 1))
        else:  # the part runs around the block
            left = [i for i in others[part.start : part.stop] if i < block.start]
            value = F.shiftleft(_value(F.col("fp"), range(left[0], left[-1] + 1)), len(part) - len(left)).bitwiseOR(_value(F.col("fp"), range(block.stop, high + 1)))
        out.append(F.struct(F.lit(k + 1).alias("part"), value.alias("more")))
    return out


def link(distinct: DataFrame, radius: int = RADIUS, max_shard: int = MAX_SHARD) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that join all those within the radius."""
    blocks = _blocks(range(64), radius + 1)
    sharded = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("block"), _value(F.col("fp"), b).alias("value")) for i, b in enumerate(blocks)])).alias("s")).select("fp", "s.*")
    counted = sharded.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1")
    shared = sharded.join(counted, ["block", "value"])
    second = F.when(F.lit(False), F.array(F.struct(F.lit(0).alias("part"), F.lit(0).cast("long").alias("more"))))
    for i, b in enumerate(blocks):
        second = second.when((F.col("n") > max_shard) & (F.col("block") == i), F.array(*_second(radius, b)))
    placed = shared.withColumn("t", F.explode(second.otherwise(F.array(F.struct(F.lit(0).alias("part"), F.lit(0).cast("long").alias("more"))))))
    by = ["block", "value", "part", "more"]
    keyed = placed.select("block", "value", "t.part", "t.more", "fp", "n")
    alone = [F.lit(0).alias(c) for c in ("one", "other", "chunk")]
    # What a second cut leaves large meets chunk by chunk.
    large = keyed.where(F.col("n") > max_shard)
    left = large.groupBy(by).agg(F.count("*").alias("m"))
    chunks = F.ceil(2 * F.col("m") / max_shard).cast("int")
    chunk = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    pairs = F.when(F.col("m") <= max_shard, F.array(F.struct(*alone))).otherwise(F.transform(F.sequence(F.lit(0), chunks - 1), lambda x: F.struct(F.least(x, chunk).alias("one"), F.greatest(x, chunk).alias("other"), chunk.alias("chunk"))))
    meeting = large.join(left, by).select(*by, F.explode(pairs).alias("p"), "fp").select(*by, "p.*", "fp")
    keyed = keyed.where(F.col("n") <= max_shard).select(*by, *alone, "fp").unionByName(meeting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, codes, lower = None, [], 0
        links: list[tuple[int, int]] = []

        def out() -> pa.RecordBatch:
            pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            links.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *key, chunk, fp in zip(*columns):
                if key != now:
                    if len(codes) > 1:
                        links += shard_links(codes, radius, lower if now[-2] != now[-1] else None)
                    now, codes, lower = key, [], 0
                codes.append(fp & 0xFFFFFFFFFFFFFFFF)
                lower += chunk == key[-2]
            if len(links) > 50_000:
                yield out()
        if len(codes) > 1:
            links += shard_links(codes, radius, lower if now[-2] != now[-1] else None)
        yield out()

    by = [*by, "one", "other"]
    shards = keyed.repartition(*by).sortWithinPartitions(*by, "chunk", "fp")
    return shards.mapInArrow(run, "a long, b long")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every linked node: alternating large and small stars until only stars are left.

    Each round at least points nodes at smaller neighbours; the number of rounds
    grows with the logarithm of the largest component's breadth. rounds is a
    guard that raises, not a cut."""
    edges = cut(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        # Settled: every node has one edge, to a node that has none of its own.
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v"), F.col("v")).distinct())
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        # Large star: a node's larger neighbours point at the least of its neighbourhood.
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: a node and its smaller neighbours point at the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        old, edges = edges, cut(small, "edges")
        release(old)
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", *, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(key, fingerprint, component_id): the least key reachable through links, itself included."""
    prints = cut(fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), keep=("key",), shingle=shingle), "fingerprints")
    distinct = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("key").alias("least"))
    roots = components(link(distinct.select("fp"), radius))
    member = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(ids, "root").select("fp", "component_id")
    return prints.join(named, F.col("fingerprint") == F.col("fp")).select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


#: Of stage near-dedup: words of a shingle, least resemblance, keys of a text and least hashes of a key, bits that a BK-tree query reaches, nodes that meet in one task.
STAGE_SHINGLE, RESEMBLANCE, KEYS, LEAST, REACH, MAX_MEET = 5, 0.8, 24, 3, 26, 512
_TURNS = np.random.default_rng(20240617).integers(0, 2**63, (KEYS, LEAST), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_sketches(data: np.ndarray, offsets: np.ndarray, shingle: int = STAGE_SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Of each row's set of shingles: SimHash, a hash of the whole set, its size, the first 32 bits of all its hashes, and KEYS keys: each a hash of its least hashes under LEAST turns.

    A row under a shingle long is one shingle of all its words; a row without words has size 0."""
    n = len(offsets) - 1
    data = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    starts, ends, first = words(data, offsets)
    own, counts = word_hashes(data, starts, ends), np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    rows = np.repeat(np.arange(n), counts)
    m = max(len(own) - shingle + 1, 0)
    inside = np.flatnonzero(rows[:m] == rows[shingle - 1 :][:m]) if m else np.empty(0, np.int64)
    h = window_hashes(own, shingle)[inside] if m else np.empty(0, np.uint64)
    row = rows[inside]
    if len(short):
        whole = [mixed(window_hashes(own[first[i] : first[i + 1]], int(counts[i]), 97))[0] for i in short]
        h, row = np.append(h, np.array(whole, np.uint64)), np.append(row, short)
    by = np.lexsort((h, row))
    h, row = h[by], row[by]
    if len(h):
        one = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))
        h, row = h[one], row[one]
    sizes = np.bincount(row, minlength=n)
    some = np.flatnonzero(sizes)
    at = (np.cumsum(sizes) - sizes)[some]
    prints, sets, least = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros((KEYS, n), np.uint64)
    if len(some):
        half = sizes[some] // 2
        for bit in range(64):
            ones = np.add.reduceat((h >> np.uint64(bit)).astype(np.uint8) & np.uint8(1), at, dtype=np.int64)
            prints[some] |= (ones > half).astype(np.uint64) << np.uint64(bit)
        sets[some] = np.add.reduceat(mixed(h + np.uint64(3)), at)
        for i, turns in enumerate(_TURNS):
            for turn in turns:
                least[i, some] = mixed(least[i, some] + np.minimum.reduceat(h * turn, at))
    ends_ = np.cumsum(sizes)
    short_ = (h >> np.uint64(32)).astype(np.uint32)
    sketches = [short_[b - s : b].tobytes() for b, s in zip(ends_.tolist(), sizes.tolist())]
    return prints, sets, sizes, sketches, least


def resemble(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of sizes a and b with so many common shingles have the least resemblance."""
    return common >= RESEMBLANCE * (a + b - common)


class _Postings:
    """Which members hold each shingle hash: common counts of one member with all before it, in one pass."""

    def __init__(self, sketches: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sketches])
        owner = np.repeat(np.arange(len(sketches)), self.sizes)
        number = np.unique(np.concatenate(sketches), return_inverse=True)[1]
        self.ends = np.cumsum(self.sizes)
        self.number = number
        order = np.argsort(number, kind="stable")
        self.members = owner[order]
        self.first = np.searchsorted(number[order], np.arange(int(number.max()) + 2))

    def common(self, i: int) -> np.ndarray:
        mine = self.number[self.ends[i] - self.sizes[i] : self.ends[i]]
        n = self.first[mine + 1] - self.first[mine]
        to = np.cumsum(n)
        held = self.members[np.repeat(self.first[mine] - (to - n), n) + np.arange(to[-1])]
        return np.bincount(held, minlength=len(self.sizes))


def _alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of hashes have the least resemblance."""
    return min(len(a), len(b)) >= RESEMBLANCE * max(len(a), len(b)) and bool(resemble(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)))


def _hashes(sketch: bytes) -> np.ndarray:
    return np.unique(np.frombuffer(sketch, np.uint32))


def _shard_forest(members: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int]]:
    """Links between the classes of members (class, chunk, print, hashes) that unite all who resemble one another within the tree's reach.

    Only members of other classes are compared; where the first few of them don't
    unite with a member, its common counts with all come from postings at once.
    Of two chunks, only pairs across them are looked at."""
    chunks = {m[1] for m in members}
    size: dict[int, int] = {}
    for m in members:
        size[m[0]] = size.get(m[0], 0) + 1
    # The largest class, or the first chunk, only goes into the tree: the others find it there.
    members = sorted(members, key=lambda m: (m[1], -size[m[0]], m[0]))
    still = members[0][1] if len(chunks) > 1 else members[0][0]
    tree, links = BKTree(), []
    sketches = [_hashes(m[3]) for m in members]
    sizes = np.array([len(x) for x in sketches])
    names, part = np.unique([m[0] for m in members], return_inverse=True)
    postings: _Postings | None = None

    def unite(i: int, j: int) -> None:
        links.append((members[i][0], members[j][0]))
        part[part == part[i]] = part[j]

    for i, (name, chunk, code, _) in enumerate(members):
        code &= 0xFFFFFFFFFFFFFFFF
        if (chunk if len(chunks) > 1 else name) == still:
            tree.add(code)
            continue
        near = np.array(tree.within(code, REACH), np.int64)
        if len(chunks) == 1:
            tree.add(code)
        near = near[(part[near] != part[i]) & (sizes[near] >= RESEMBLANCE * sizes[i]) & (sizes[i] >= RESEMBLANCE * sizes[near])]
        for _ in range(3):
            if not len(near):
                break
            j, near = int(near[0]), near[1:]
            if _alike(sketches[i], sketches[j]):
                unite(i, j)
                near = near[part[near] != part[i]]
        if not len(near):
            continue
        postings = postings or _Postings(sketches)
        common = postings.common(i)[near]
        for j in near[resemble(common, sizes[i], sizes[near])].tolist():
            if part[j] != part[i]:
                unite(i, j)
    return links


def _sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, st, fp, size, turns, sketch) of rows with words and a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                prints, sets, sizes, sketches, least = text_sketches(data, offsets)
                turns = pa.ListArray.from_arrays(pa.array(np.arange(0, KEYS * len(sizes) + 1, KEYS), pa.int32()), pa.array(np.ascontiguousarray(least.T).reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array(sets.view(np.int64)), pa.array(prints.view(np.int64)), pa.array(sizes), turns, pa.array(sketches, pa.binary())], names=["key", "st", "fp", "size", "turns", "sketch"])

    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key IS NOT NULL")
    return found.mapInArrow(run, "key long, st long, fp long, size long, turns array<long>, sketch binary").where("size > 0")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, both sketches) those that resemble."""
    for batch in batches:
        good = [_alike(_hashes(x), _hashes(y)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard: the links of each shard's forest."""
    now, members = None, []
    links: list[tuple[int, int]] = []
    for batch in batches:
        for *shard, name, chunk, fp, sketch in zip(*(c.to_pylist() for c in batch.columns)):
            if shard != now:
                links += _shard_forest(members) if len(members) > 1 else []
                now, members = shard, []
            members.append((name, chunk, fp, sketch))
    links += _shard_forest(members) if len(members) > 1 else []
    pairs = np.array(links, np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def resembling(docs: DataFrame, key: str = "doc_id", text: str = "text", max_meet: int = MAX_MEET) -> DataFrame:
    """(key, component_id) of rows that resemble another row (five words, 0.8 or more): the least key reachable.

    Equal sets of shingles are one node. A node goes to KEYS shards, by keys of
    LEAST least hashes each: two texts at 0.8 share none with
    (1 - 0.8 ** LEAST) ** KEYS, 1e-7, while those that only share a passage
    rarely meet. First every node is held against its shards' hubs (the least
    node), as a join: one row a node and shard, so large groups of copies unite
    without meeting. Shards that still hold several classes go to a task each:
    a BK-tree over the SimHashes finds whom to compare (at 0.8, fingerprints lie
    10 bits apart, with a deviation of 3; REACH is 5 deviations on). Whole sets
    of shingle hashes (32 bits each) decide, everywhere and whatever their size.
    Shards of over max_meet nodes are cut into chunks, and each pair of chunks is
    a task: the result is the same. Rows without words and rows without a key
    resemble nothing."""
    found = cut(_sketched(docs, key, text).withColumn("row", F.monotonically_increasing_id()), "sketches")
    nodes = cut(found.groupBy("st").agg(F.min("key").alias("least"), F.min("row").alias("row"), *[F.any_value(c).alias(c) for c in ("size", "turns")]), "nodes")
    by = ["turn", "value"]
    sharded = nodes.select("st", "size", "row", F.posexplode("turns").alias("turn", "value"))
    groups = sharded.groupBy(by).agg(F.count("*").alias("n"), F.min(F.struct("st", "size")).alias("hub")).where("n > 1")
    members = cut(sharded.join(groups, by).select(*by, "st", "size", "row", "n", "hub"), "shards")
    # Only nodes that meet another carry their sets of hashes on.
    sketches = cut(found.select("row", "fp", "sketch").join(members.groupBy("row").agg(F.min("st").alias("st")), "row").select("st", "fp", "sketch"), "sets")
    beside = members.where((F.col("st") != F.col("hub.st")) & (F.col("size") >= RESEMBLANCE * F.col("hub.size")) & (F.col("hub.size") >= RESEMBLANCE * F.col("size"))).select(F.col("st").alias("a"), F.col("hub.st").alias("b")).distinct()
    own, its = sketches.select(F.col("st").alias("a"), F.col("sketch").alias("own")), sketches.select(F.col("st").alias("b"), F.col("sketch").alias("its"))
    classes = components(beside.join(own, "a").join(its, "b").select("a", "b", "own", "its").mapInArrow(_verified, "a long, b long"))
    # Shards of two are settled by their hub.
    classed = cut(members.where("n > 2").join(classes.toDF("st", "root"), "st", "left").select(*by, "st", "n", F.coalesce("root", "st").alias("class")), "classes")
    mixed_ = cut(classed.groupBy(by).agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select(by), "mixed")
    chunks = F.ceil(2 * F.col("n") / max_meet).cast("int")
    chunk = F.pmod(F.xxhash64("st"), chunks).cast("int")
    meetings = F.when(F.col("n") <= max_meet, F.array(F.struct(F.lit(0).alias("one"), F.lit(0).alias("other"), F.lit(0).alias("chunk")))).otherwise(
        F.transform(F.sequence(F.lit(0), chunks - 1), lambda x: F.struct(F.least(x, chunk).alias("one"), F.greatest(x, chunk).alias("other"), chunk.alias("chunk")))
    )
    dealt = classed.join(mixed_, by).select("st", *by, "class", F.explode(meetings).alias("m")).select("st", *by, "m.*", "class")
    by = [*by, "one", "other"]
    dealt = dealt.join(sketches, "st").select(*by, "class", "chunk", "fp", "sketch")
    more = components(dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(_forests, "a long, b long"))
    named = nodes.select("st", "least").join(classes.toDF("st", "root"), "st", "left").withColumn("class", F.coalesce("root", "st")).drop("root")
    named = cut(named.join(more.toDF("class", "root"), "class", "left").select("st", "least", F.coalesce("root", "class").alias("root")), "named")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    rows = cut(found.select("key", "st"), "keys")
    release(found, nodes, members, sketches, classed, mixed_)
    return rows.join(named.join(ids, "root").select("st", "component_id"), "st").select(F.col("key").alias(key), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows that resemble a row of smaller key through links; rows without key or words stay,
    and so do all rows that share the least key."""
    gone = resembling(docs, key, text).where(F.col("component_id") < F.col(key)).select(F.col(key).alias("__gone")).distinct()
    return docs.join(gone, F.col(key) == F.col("__gone"), "left_anti")
