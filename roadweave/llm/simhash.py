"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are made in one narrow pass. Equal fingerprints collapse by an aggregate; only distinct ones are searched.

Search. Two fingerprints that differ in at most k bits agree on at least m - k of m bit segments. Each distinct
fingerprint is dealt once per choice of m - k segments, keyed by the bits it has there, so linked ones meet in a task.
m is the smallest for which a key is expected to hold few fingerprints, and keys that hold many all the same are dealt
again by the bits that they leave free. Inside a task the fingerprints of a key stand in Gray order, where neighbours share
long bit patterns. A tree of nodes over that order factors the shared bits (mask and pattern) upwards; two nodes whose
shared patterns already differ in more than k bits are dropped as a pair with all that lies below them. A task returns a
spanning star of what it linked, never all pairs, and connected components join the stars.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, mix64, slices, stored
from .components import components

SEED = 42
#: Bits of each byte value, lowest first.
BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float32)
#: A key with more distinct fingerprints than this is dealt again.
HOT_KEY = 50_000
FAN = 8
#: Pairs of nodes that are held at a time.
PAIRS = 1 << 19


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of `size` words, or of all words if there are fewer; A-Z are lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    return np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in runs), np.uint64, max(1, len(words) - size + 1))


def fingerprints(hashes: list[np.ndarray]) -> np.ndarray:
    """One fingerprint of each array of hashes: a bit is set if more than half of the hashes have it; zero if there are none."""
    n = np.array([len(x) for x in hashes])
    out = np.zeros(len(hashes), np.uint64)
    for start in range(0, len(hashes), 512):
        some = hashes[start : start + 512]
        octets = np.concatenate([np.empty(0, np.uint64), *some]).astype("<u8").view(np.uint8).reshape(-1, 8)
        owner = np.repeat(np.arange(len(some)), n[start : start + 512]) * 256
        for k in range(8):
            held = np.bincount(owner + octets[:, k], minlength=256 * len(some)).reshape(-1, 256).astype(np.float32) @ BITS
            on = 2 * held > n[start : start + 512, None]
            out[start : start + 512] |= np.packbits(on, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * k)
    return out


def other_words(hashes: list[np.ndarray], more: int) -> list[np.ndarray]:
    """Further fingerprints of the same shingles, by scrambled hashes."""
    return [fingerprints([mix64(x ^ np.uint64(i)) for x in hashes]) for i in range(1, more + 1)]


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, out: str = "simhash") -> DataFrame:
    """docs with the 64-bit fingerprint of each text as a (signed) long. No words, or null text: zero. The text column is dropped."""
    rest = [c for c in docs.columns if c not in (text, out)]
    base = docs.select(*(F.col(f"`{c}`") for c in [*rest, text]))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != text), f"`{out}` bigint"])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                hashes = [shingle_hashes(x, shingle) for x in part[text].to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in rest), pa.array(fingerprints(hashes).view(np.int64))], names=[*rest, out])

    return base.mapInArrow(lean(run), schema)


def masks(m: int, k: int, free: int = (1 << 64) - 1) -> list[int]:
    """The choices of m - k out of m segments of the bits in `free`, as masks."""
    bits = [i for i in range(64) if free >> i & 1]
    cuts = [len(bits) * i // m for i in range(m + 1)]
    parts = [sum(1 << i for i in bits[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(x) for x in combinations(parts, m - k)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def n_segments(n: int, k: int) -> int:
    """The fewest segments for which a key is expected to hold at most one of n random fingerprints."""
    m = k + 1
    while n >> (64 * (m - k) // m) and m < k + 6 and comb(m + 1, k) <= 84:
        m += 1
    return m


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a bit pattern in the reflected Gray code."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class GrayIndex:
    """Nodes over fingerprints in Gray order within each run (rows of one key). Level 0 is the rows; FAN nodes make one of the next.

    label: components of the rows, if pairs inside one aren't wanted; a node knows its smallest and largest.
    """

    def __init__(self, run: np.ndarray, x: np.ndarray, label: np.ndarray | None = None):
        full = np.uint64((1 << 64) - 1)
        self.levels = [(x, np.full(len(x), full), run, run)]
        self.labels = None if label is None else [(label, label)]
        while len(self.levels[-1][0]) > FAN:
            pattern, mask, first, last = self.levels[-1]
            at = np.arange(0, len(pattern), FAN)
            every, some = np.bitwise_and.reduceat(pattern, at), np.bitwise_or.reduceat(pattern, at)
            shared = np.bitwise_and.reduceat(mask, at) & ~(every ^ some)
            self.levels.append((every & shared, shared, first[at], np.maximum.reduceat(last, at)))
            if self.labels:
                low, high = self.labels[-1]
                self.labels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    def links(self, k: int):
        """Blocks of pairs of rows (a < b) of one run that differ in at most k bits: every such pair once."""
        top = len(self.levels) - 1
        a, b = np.triu_indices(len(self.levels[top][0]))
        todo = [(top, a, b, False)]
        while todo:
            level, a, b, is_near = todo.pop()
            if is_near:  # a block of pairs of nodes is opened only when its turn comes, so that few exist at a time
                left = np.repeat(a * FAN, FAN * FAN) + np.tile(np.repeat(np.arange(FAN), FAN), len(a))
                right = np.repeat(b * FAN, FAN * FAN) + np.tile(np.arange(FAN), FAN * len(a))
                fit = (left <= right) & (right < len(self.levels[level - 1][0]))
                todo.append((level - 1, left[fit], right[fit], False))
                continue
            if len(a) > PAIRS:
                half = len(a) // 2
                todo += [(level, a[half:], b[half:], False), (level, a[:half], b[:half], False)]
                continue
            pattern, mask, first, last = self.levels[level]
            near = (first[b] <= last[a]) & (first[a] <= last[b]) & (np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= k)
            if self.labels:
                low, high = self.labels[level]
                near &= (low[a] != high[b]) | (high[a] != low[b])  # all four equal: one component
            a, b = a[near], b[near]
            if level == 0:
                apart = a != b
                yield a[apart], b[apart]
                continue
            step = PAIRS // FAN**2
            todo += [(level, a[at : at + step], b[at : at + step], True) for at in range(0, len(a), step)]


def spanning(n: int, blocks) -> np.ndarray:
    """Of each of n rows, the smallest row that the blocks of links connect it with."""
    label = np.arange(n)
    for a, b in blocks:
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b, low, high = a[apart], b[apart], np.minimum(x, y)[apart], np.maximum(x, y)[apart]
            np.minimum.at(label, high, low)
            while (label != label[label]).any():
                label = label[label]
    return label


def _linked(batches, k: int, rows: int = 1 << 16):
    """batches: table, bits and simhash, ordered by table and bits. Yields the stars of the links of each key."""
    names = ["part", "bits", "simhash"]

    def stars(t, key, x):
        run = np.concatenate([[0], np.cumsum((t[1:] != t[:-1]) | (key[1:] != key[:-1]))]) if len(t) else np.empty(0, np.int64)
        size = np.bincount(run) if len(run) else run
        some = size[run] > 1
        if not some.any():
            return None
        run, x = run[some], x[some]
        order = np.lexsort((gray_rank(x), run))
        run, x = run[order], x[order]
        root = spanning(len(x), GrayIndex(run, x).links(k))
        own = root != np.arange(len(x))
        return pa.RecordBatch.from_arrays([pa.array(x[own].view(np.int64)), pa.array(x[root[own]].view(np.int64))], names=["u", "v"])

    def chunks():
        held = [np.empty(0, np.int64)] * len(names)
        for batch in batches:
            held = [np.concatenate([h, batch[c].to_numpy()]) for h, c in zip(held, names, strict=True)]
            if len(held[0]) >= rows:
                t, key = held[:2]
                new = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1]))
                if len(new):
                    cut = new[-1] + 1
                    yield [h[:cut] for h in held]
                    held = [h[cut:] for h in held]
        yield held

    for t, key, x in chunks():
        if len(t) and (found := stars(t, key, np.ascontiguousarray(x).view(np.uint64))) is not None and len(found):
            yield found


def links(distinct: DataFrame, k: int = 2, hot_key: int = HOT_KEY) -> DataFrame:
    """(u, v): stars that connect the distinct fingerprints (column simhash) just as all links of at most k bits do. A key of more than hot_key fingerprints is dealt again."""
    m = n_segments(distinct.count(), k)
    every = masks(m, k)
    whole = ["simhash"]

    def deal(choices, first: int):
        return F.explode(F.array(*(F.struct(F.lit(first + i).alias("part"), F.col("simhash").bitwiseAND(F.lit(signed(x))).alias("bits")) for i, x in enumerate(choices)))).alias("d")

    dealt = distinct.select(*whole, deal(every, 0)).select(*whole, "d.part", "d.bits")
    hot = dealt.groupBy("part", "bits").count().where(F.col("count") > hot_key).select("part", "bits").withColumn("hot", F.lit(True))
    hot = stored(hot, "simhash-hot")
    if not hot.isEmpty():
        marked = stored(dealt.join(hot, ["part", "bits"], "left"), "simhash-dealt")
        again = []
        for i, x in enumerate(every):
            free = ((1 << 64) - 1) & ~x
            # all bits of the first key stay in the second, beside the chosen ones of the rest
            again.append(marked.where(f"hot and part = {i}").select(*whole, deal([x | y for y in masks(min(k + 3, max(k + 1, free.bit_count() // 4)), k, free)], 1000 * (i + 1))).select(*whole, "d.part", "d.bits"))
        dealt = marked.where("hot is null").select(*whole, "part", "bits")
        for x in again:
            dealt = dealt.unionByName(x)
    return dealt.repartition("part", "bits").sortWithinPartitions("part", "bits").mapInArrow(lean(lambda batches: _linked(batches, k)), "u bigint, v bigint")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, k: int = 2) -> DataFrame:
    """Of each row of docs: its id, simhash (long), component: the smallest id reachable over fingerprints of at most k differing bits.

    Null and empty texts have fingerprint zero, which links like any other. Repeated rows give repeated results. A null id
    has a component like any other row, but is never one's name (null only if a component has no other ids).
    """
    prints = stored(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), "text", shingle), "simhash")
    nodes = stored(prints.groupBy("simhash").agg(F.min("id").alias("least")), "simhash-nodes")
    roots = components(links(nodes.select("simhash"), k))
    named = nodes.join(roots, nodes["simhash"] == roots["node"], "left").select("simhash", "least", F.coalesce("root", "simhash").alias("root"))
    named = stored(named, "simhash-roots")
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    of = named.join(names, "root").select("simhash", "component")
    return prints.join(of, "simhash", "left").select(F.col("id").alias(id_col), "simhash", "component")
