"""Problem 7: near-duplicate records, by size-banded tiles with hashed bitmap signatures.

Every text becomes the set of its three consecutive letters and digits, each held exactly in 63 bits. Texts with equal sets form
a class and are compared once. Two sets of Jaccard similarity t or more share one of their rarest elements: in an order by global
frequency the larger one has it among its first n - ceil(t n) + 1 elements, the smaller one among its first
n - ceil(2 t n / (1 + t)) + 1. So classes meet in the postings of such an element, cut into tiles by size band; only tiles whose
sizes can reach t are compared. Inside, the places of the element in both orders bound the overlap (at the first element that a pair
shares, only what follows it can be shared too; a pair that fails there shares too little), and a bitmap of hashed elements bounds it
from above: of |A| elements at least popcount(bits of A not in B) are missing in B. Survivors go through an exact intersection of sorted arrays. Nothing is capped, no
link is lost; postings of frequent elements are split over slices (each indexed row in one slice, each probing row in all).

The frequencies only set an order, so they come from a table of 2^18 counters over all texts (4 MB at most), the one thing that
is broadcast. groups() gives one row per key with its class and group; pairs() lists all pairs, those inside a class of copies by slices of
SLICE members, so that no task makes all pairs of a class. Null keys and null, empty or short texts take no part; repeated keys count once (text of the least order column).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import letters, units, written

COUNTERS = 18  # bits
BITMAP = 8  # words of 64 bits
HOT = 20_000  # postings of one element before it is split
SLICE = 2_000  # members of a class of copies that one task pairs with all
CELLS = 400_000  # pairs that a tile looks at at a time
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, k: int = 3) -> np.ndarray:
    """Sorted distinct k-grams (k = 3) of the letters and digits, each as one exact integer."""
    c = np.frombuffer(letters(text).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    if len(c) < k:
        return np.empty(0, np.int64)
    return np.unique(c[:-2] << 42 | c[1:-1] << 21 | c[2:])


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of integers."""
    h = x.astype(np.uint64) * _MIX
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def bitmap(x: np.ndarray) -> np.ndarray:
    """Signature of BITMAP words."""
    h = mixed(x) % np.uint64(64 * BITMAP)
    out = np.zeros(BITMAP, np.uint64)
    np.bitwise_or.at(out, (h >> np.uint64(6)).astype(np.int64), np.uint64(1) << (h & np.uint64(63)))
    return out


def _lists(batch: pa.RecordBatch, name: str) -> Iterator[np.ndarray]:
    col = batch.column(name)
    flat, at = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
    for i in range(len(col)):
        yield flat[at[i] : at[i + 1]]


def sets(df: DataFrame, key: str, text: str, least_units: int) -> DataFrame:
    """_k, keys, sig of every text of at least least_units units."""
    import hashlib

    schema = pa.schema([("_k", pa.string()), ("keys", pa.list_(pa.int64())), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, s) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if units(t) >= least_units and len(s := shingles(t))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), pa.array([s for _, s in rows], pa.list_(pa.int64())), pa.array([hashlib.md5(s.tobytes()).digest() for _, s in rows], pa.binary())], schema=schema)

    return df.select(F.col(key).cast("string").alias("_k"), F.col(text).alias("_t")).mapInArrow(run, "_k string, keys array<bigint>, sig binary")


def frequencies(classes: DataFrame) -> np.ndarray:
    """Counters of hashed elements over all classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTERS, np.int64)
        for b in batches:
            flat = b.column(0).flatten().to_numpy(zero_copy_only=False)
            total += np.bincount((mixed(flat) >> np.uint64(64 - COUNTERS)).astype(np.int64), minlength=1 << COUNTERS)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "n"])

    got = classes.select("keys").mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()  # at most 2^COUNTERS rows
    out = np.zeros(1 << COUNTERS, np.int64)
    out[got["slot"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    return out


def _postings(classes: DataFrame, counts, num: int, den: int) -> DataFrame:
    """(token, slice, n, place, indexed, did, bits) for threshold num / den."""
    schema = pa.schema([("token", pa.int64()), ("slice", pa.int32()), ("n", pa.int32()), ("place", pa.int32()), ("indexed", pa.bool_()), ("did", pa.int64()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counts.value
        for b in batches:
            cols: list[list[np.ndarray]] = [[] for _ in schema]
            for did, x in zip(b.column("did").to_pylist(), _lists(b, "keys")):
                n = len(x)
                f = c[(mixed(x) >> np.uint64(64 - COUNTERS)).astype(np.int64)]
                probe, index = n - -(-num * n // den) + 1, n - -(-2 * num * n // (num + den)) + 1
                order = np.lexsort((x, f))[:probe]
                parts = np.maximum(1, -(-f[order] // HOT))
                place = np.repeat(np.arange(probe), parts)
                part = np.arange(len(place)) - np.repeat(np.cumsum(parts) - parts, parts)
                mine = (place < index) & (did % parts[place] == part)
                for col, v in zip(cols, (x[order][place], part, np.full(len(place), n), place, mine, np.full(len(place), did), np.tile(bitmap(x), len(place)))):
                    col.append(v)
            if cols[0]:
                token, part, n, place, mine, did, bits = map(np.concatenate, cols)
                words = pa.BinaryArray.from_buffers(pa.binary(), len(token), [None, pa.py_buffer(np.arange(len(token) + 1, dtype=np.int32) * (8 * BITMAP)), pa.py_buffer(bits)])
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(part.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(mine), pa.array(did), words], schema=schema)

    return classes.select("did", "keys").mapInArrow(run, "token bigint, slice int, n int, place int, indexed boolean, did bigint, bits binary")


def _tiles(element: np.ndarray, n: np.ndarray, place: np.ndarray, indexed: np.ndarray, did: np.ndarray, bits: np.ndarray, num: int, den: int, out: list) -> None:
    """Compares the postings of elements (numbered from 0). Bands of sizes [2^k, 2^(k+1)) are tiles; a probing band meets the indexed bands that can reach the threshold, each probing row only the stretch of its element's rows whose sizes can."""
    key = element << 32 | n
    order = np.argsort(key, kind="stable")
    key, n, place, indexed, did, bits = key[order], n[order], place[order], indexed[order], did[order], bits[order]
    band = np.frexp(n.astype(np.float64))[1]
    index = np.flatnonzero(indexed)
    for bp in np.unique(band):
        probe = np.flatnonzero(band == bp)
        least = -(-num * int(n[probe].min()) // den)
        for bi in np.unique(band[index]):
            if bi > bp or (1 << int(bi)) - 1 < least:
                continue
            tile = index[band[index] == bi]
            lo = np.searchsorted(key[tile], key[probe] - n[probe] - (-num * n[probe] // den), "left")
            many = np.searchsorted(key[tile], key[probe], "right") - lo
            cuts = np.searchsorted(np.cumsum(many), np.arange(CELLS, int(many.sum()) + CELLS, CELLS), "right")
            for x, y in zip([0, *cuts], [*cuts, len(probe)]):
                c = many[x:y]
                if not c.sum():
                    continue
                a = np.repeat(probe[x:y], c)
                b = tile[np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + np.repeat(lo[x:y], c)]
                na, nb = n[a], n[b]
                shared = -(-num * (na + nb) // (num + den))  # what a pair must share
                fit = ((nb < na) | (did[b] < did[a])) & (np.minimum(na - place[a], nb - place[b]) >= shared)
                a, b, na, nb, shared = a[fit], b[fit], na[fit], nb[fit], shared[fit]
                if not len(a):
                    continue
                both = np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64)
                bound = np.minimum(na - np.bitwise_count(bits[a]).sum(1, dtype=np.int64), nb - np.bitwise_count(bits[b]).sum(1, dtype=np.int64)) + both
                ok = bound >= shared
                if ok.any():
                    out.append((did[b[ok]], did[a[ok]]))


def _candidates(postings: DataFrame, num: int, den: int) -> DataFrame:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            token, part = t.column("token").to_numpy(), t.column("slice").to_numpy()
            edge = np.flatnonzero((np.diff(token) != 0) | (np.diff(part) != 0)) + 1
            if not last and not len(edge):
                return  # one element only, so far
            n, place, did = t.column("n").to_numpy().astype(np.int64), t.column("place").to_numpy().astype(np.int64), t.column("did").to_numpy()
            indexed = t.column("indexed").to_numpy(zero_copy_only=False)
            bits = np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint64).reshape(-1, BITMAP)
            end = len(token) if last else int(edge[-1])
            number = np.searchsorted(edge, np.arange(end), "right").astype(np.int64)
            out: list = []
            _tiles(number, n[:end], place[:end], indexed[:end], did[:end], bits[:end], num, den, out)
            held[:] = [] if last else t.slice(end).combine_chunks().to_batches()
            if out:
                pairs = np.unique(np.stack([np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

        for b in batches:
            if b.num_rows:
                held.append(b)
                if sum(x.num_rows for x in held) >= 50_000:
                    yield from flush(False)
        if held:
            yield from flush(True)

    ordered = postings.repartition("token", "slice").sortWithinPartitions("token", "slice")
    return ordered.mapInArrow(run, "a bigint, b bigint").distinct()


def _verified(cands: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Exact similarity of the candidates by intersection of sorted arrays."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, b, x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), _lists(batch, "ka"), _lists(batch, "kb")):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both * den >= num * (len(x) + len(y) - both):
                    rows.append((a, b, both / (len(x) + len(y) - both)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    one = classes.select(F.col("did").alias("a"), F.col("keys").alias("ka"))
    two = classes.select(F.col("did").alias("b"), F.col("keys").alias("kb"))
    return cands.join(one, "a").join(two, "b").select("a", "b", "ka", "kb").mapInArrow(run, "a bigint, b bigint, similarity double")


class NearDuplicates:
    """The similarity join of one collection. links: pairs of classes (a, b, similarity); members: _k with its class did."""

    def __init__(self, df: DataFrame, key: str, text: str, order: str | None = None, threshold: tuple[int, int] = (1, 2), least_units: int = 30):
        self.key, (num, den) = key, threshold
        spark = df.sparkSession
        by = F.struct(F.col(order), F.col(text)) if order else F.struct(F.col(text))
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        # an explicit number of partitions is kept by the aggregation and by adaptive execution: the Python work behind it is spread
        once = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).repartition(parts, key).groupBy(key).agg(F.min(by).alias("_m")).select(key, F.col(f"_m.{text}").alias(text)).where(F.char_length(text) >= least_units)  # a unit has a character at least
        rows = written(sets(once, key, text, least_units))
        self.classes = written(rows.groupBy("sig").agg(F.first("keys").alias("keys")).withColumn("did", F.monotonically_increasing_id()))
        self.members = rows.select("_k", "sig").join(self.classes.select("sig", "did"), "sig").select("_k", "did")
        counts = spark.sparkContext.broadcast(frequencies(self.classes))
        found = _candidates(_postings(self.classes, counts, num, den), num, den)
        self.links = written(_verified(found, self.classes, num, den))

    def pairs(self) -> DataFrame:
        """id_a < id_b, similarity of all pairs of different keys."""
        m = self.members
        a, b = m.select(F.col("_k").alias("ka"), F.col("did").alias("a")), m.select(F.col("_k").alias("kb"), F.col("did").alias("b"))
        across = self.links.join(a, "a").join(b, "b").select("ka", "kb", "similarity")
        many = m.groupBy("did").agg(F.count("*").alias("n")).where("n > 1").select("did", F.ceil(F.col("n") / SLICE).cast("int").alias("parts"))
        own = m.join(many, "did")
        one = own.select("did", F.col("_k").alias("ka"), F.pmod(F.xxhash64("_k"), F.col("parts")).cast("int").alias("part"))
        two = own.select("did", F.col("_k").alias("kb"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        within = one.join(two, ["did", "part"]).where("ka < kb").select("ka", "kb", F.lit(1.0).alias("similarity"))
        return across.unionByName(within).select(F.least("ka", "kb").alias("id_a"), F.greatest("ka", "kb").alias("id_b"), "similarity")

    def groups(self) -> DataFrame:
        """One row per key that took part: its group (the least class id reachable over links), the size of its copy class and its number of linked classes."""
        best = components(self.links.select("a", "b"))
        degree = self.links.select(F.explode(F.array("a", "b")).alias("did")).groupBy("did").agg(F.count("*").alias("links"))
        size = self.members.groupBy("did").agg(F.count("*").alias("copies"), F.min("_k").alias("first"))
        cls = size.join(degree, "did", "left").join(best, "did", "left").withColumn("root", F.coalesce("root", "did"))
        named = cls.groupBy("root").agg(F.min("first").alias("group_id"))
        return self.members.join(cls.join(named, "root").select("did", "group_id", "copies", F.coalesce("links", F.lit(0)).alias("links")), "did").select(F.col("_k").alias(self.key), "group_id", "copies", "links")


def components(edges: DataFrame) -> DataFrame:
    """did -> root, the least id of its component. Alternating large-star and small-star steps until nothing changes; every step is written to the shared folder."""
    star = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    last = None
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        star = written(down.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct())
        now = tuple(star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    return star.select(F.col("u").alias("did"), F.col("v").alias("root")).unionByName(star.select(F.col("v").alias("did"), F.col("v").alias("root")).distinct())
