"""Near copies by exact similarity: SimHash fingerprints find the candidates, the shingles of both texts decide.

Texts of equal shingle sets collapse to one node with four 64-bit fingerprints, 256 bits. A node is dealt once a key: a
choice of some of these bits and their values. The more nodes there are, the more bits a key has, so that a key holds about a
thousand nodes at any size, and the more keys there are, so that a pair at the stated similarity still shares one with a
probability of Deal.recall. Inside a task the Gray-order index finds the rows of a key that differ in few bits.

A family of n near copies has n * n / 2 such pairs; what is wanted are its connections. So
1. candidates are gathered as clusters. A linear pass, in a few keys, joins each row with its neighbour in Gray order and the key's
   first node, if they differ in few bits; a pass over all keys joins what is near and not in one cluster yet, for the tree
   drops groups of rows of one cluster as it drops those that differ in too many bits. Tasks give spanning stars of what they joined.
2. Clusters are checked on the shingles, in blocks of a bounded number of shingles: each pair of a block that differs in few bits is compared, unless
   what was found before connects it. A cluster of several blocks has a few of its nodes in all of them. What then is in two
   components and two blocks meets in a second round: all parts of the largest component the rest, or every two blocks.
So every candidate pair of two components is held against its shingles, and no table has a row for each pair.
A key with very many nodes is split over tasks: if most are of one cluster, these are split and the rest meets all parts;
else every two blocks meet in a task. No pair is left out at any size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, lean, maybe_in, mix64, slices, stored
from .components import components
from .simhash import HOT_KEY, GrayIndex, fingerprints, gray_rank, other_words, shingle_hashes, spanning

WORDS = ["w0", "w1", "w2", "w3"]
BITS = 64 * len(WORDS)


@dataclass(frozen=True)
class Deal:
    """similarity: Jaccard similarity of pairs to find. recall: share of them that meet in a key, by calculation. per_key: nodes that
    a key is expected to hold at most. deviations: of the differing bits of such pairs, up to which a pair is a candidate.
    linear: keys of the first pass. hot_key: nodes of a key beyond which it is split. block: shingles that a task compares at once. pivots: nodes
    of a cluster, about, that are in all of its blocks."""

    similarity: float = 0.8
    recall: float = 0.998
    per_key: int = 1024
    deviations: float = 2.6
    linear: int = 6
    hot_key: int = HOT_KEY
    block: int = 1 << 19
    pivots: int = 8

    @property
    def differ(self) -> float:
        """The share of bits in which a pair at the similarity is expected to differ: the angle between two sets of one size."""
        return math.acos(2 * self.similarity / (1 + self.similarity)) / math.pi

    def limit(self, bits: int) -> int:
        return math.ceil(bits * self.differ + self.deviations * math.sqrt(bits * self.differ * (1 - self.differ)))

    def bits(self, n: int) -> int:
        return min(32, max(8, math.ceil(math.log2(max(1, n) / self.per_key))))

    def keys(self, bits: int) -> int:
        """The fewest keys of so many bits of which a pair, whose differing bits follow a binomial distribution, shares one with probability `recall`."""
        d = self.differ
        chance = [math.comb(BITS, x) * d**x * (1 - d) ** (BITS - x) for x in range(BITS + 1)]
        apart = [1 - math.comb(BITS - x, bits) / math.comb(BITS, bits) for x in range(BITS + 1)]
        meets = lambda keys: 1 - sum(c * a**keys for c, a in zip(chance, apart, strict=True)) >= self.recall
        low, high = 0, 1
        while not meets(high):
            low, high = high, 2 * high
        while high - low > 1:
            half = (low + high) // 2
            low, high = (low, half) if meets(half) else (half, high)
        return high


def with_prints(docs: DataFrame, shingle: int) -> DataFrame:
    """docs (id, key, text) as id, key, node (a hash of the set of shingles), the words of its fingerprint and its shingles (32 bits of their hashes), sorted, each once."""
    schema = docs.select("id").schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                hashes = [shingle_hashes(x, shingle) for x in part["text"].to_pylist()]
                sets = [np.unique(x) for x in hashes]
                # repeated shingles count once, as they do in the similarity
                words = [fingerprints(sets), *other_words(sets, len(WORDS) - 1)]
                node = np.fromiter((xxhash.xxh64_intdigest(x.tobytes(), 7) for x in sets), np.uint64, len(sets))
                short = [np.unique(x.astype(np.uint32)) for x in sets]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in short])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.uint32), *short]).view(np.int32)))
                yield pa.RecordBatch.from_arrays([part["id"], part["key"], *(pa.array(x.view(np.int64)) for x in (node, *words)), lists], names=["id", "key", "node", *WORDS, "shingles"])

    return docs.select("id", "key", "text").mapInArrow(lean(run), f"id {schema}, key bigint, node bigint, {', '.join(f'{w} bigint' for w in WORDS)}, shingles array<int>")


def places_of(bits: int, keys: int, seed: int = 42) -> np.ndarray:
    """The bits of each key (keys x bits). A shuffle of the 256 bits is cut into keys, then the next."""
    rng = np.random.default_rng(seed)
    shuffles = [rng.permutation(BITS) for _ in range(-(-keys // (BITS // bits)))]
    return np.concatenate([x[: BITS // bits * bits].reshape(-1, bits) for x in shuffles])[:keys]


def keys_of(words: list[np.ndarray], bits: int, keys: int) -> np.ndarray:
    """One row of keys (number of the key << 32 | its bits) for each fingerprint."""
    width = 8 if bits <= 8 else 16 if bits <= 16 else 32
    places = np.full((keys, width), BITS)
    places[:, width - bits :] = places_of(bits, keys)
    flat = np.unpackbits(np.stack(words, axis=1).astype("<u8").view(np.uint8).reshape(-1, 8 * len(words)), axis=1)
    flat = np.concatenate([flat, np.zeros((len(flat), 1), np.uint8)], axis=1)
    cut = np.ascontiguousarray(np.packbits(flat[:, places.ravel()], axis=1)).view(f">u{width // 8}").astype(np.int64)
    return cut + (np.arange(keys) << 32)


#: Keys that are split (ascending), into how many blocks, the component that most of their nodes are in, and whether there is one.
NOT_HOT = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool))


def _dealt(batches, bits: int, keys: int, hot: tuple, linear: bool):
    """Rows of nodes (COLUMNS) once a key; of a hot key as often as its blocks demand."""
    hot_key, hot_blocks, hot_label, hot_most = hot
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            node, *words, label = (part[c].to_numpy().view(np.uint64) for c in COLUMNS)
            key = keys_of(words, bits, keys).ravel()
            row = np.repeat(np.arange(len(node)), keys)
            block = np.zeros(len(key), np.int32)
            if len(hot_key):
                place = np.minimum(np.searchsorted(hot_key, key), len(hot_key) - 1)
                is_hot = hot_key[place] == key
                n = np.where(is_hot, hot_blocks[place], 1)
                own = (mix64(node[row] ^ np.uint64(99)) % n.astype(np.uint64)).astype(np.int64)
                alone = linear | (is_hot & hot_most[place] & (label[row] == hot_label[place]))  # its like needn't meet
                times = np.where(alone, 1, n)
                paired = is_hot & ~hot_most[place] & (not linear)
                again = np.repeat(np.arange(len(key)), times)
                other = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
                a, n = own[again], n[again]
                block = np.where(alone[again], a, np.where(paired[again], np.minimum(a, other) * n + np.maximum(a, other), other)).astype(np.int32)
                key, row = key[again], row[again]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(block), *(pa.array(x[row].view(np.int64)) for x in (node, *words, label))], names=DEALT)


COLUMNS = ["node", *WORDS, "label"]
DEALT = ["key", "block", *COLUMNS]
DEALT_SCHEMA = "key bigint, block int, " + ", ".join(f"{c} bigint" for c in COLUMNS)


def differing(words: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return sum(np.bitwise_count(w[a] ^ w[b]).astype(np.int64) for w in words)


def neighbour_pairs(run: np.ndarray, node: np.ndarray, words: list[np.ndarray], label: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in Gray order within each run: the pairs of neighbours, and of each row and its run's first (by a scramble), that may be near."""
    order = np.lexsort((mix64(node), run))
    head = order[np.concatenate([[0], np.flatnonzero(np.diff(run[order])) + 1])]
    rows = np.arange(len(run))
    a, b = np.concatenate([rows[1:], rows]), np.concatenate([rows[:-1], head[run]])
    fit = (run[a] == run[b]) & (label[a] != label[b])
    a, b = a[fit], b[fit]
    near = differing(words, a, b) <= limit
    return a[near], b[near]


def rarer(run: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Of each row the number of rows in its run that have its label."""
    order = np.lexsort((label, run))
    new = np.concatenate([[True], (run[order][1:] != run[order][:-1]) | (label[order][1:] != label[order][:-1])])
    group = np.cumsum(new) - 1
    out = np.empty(len(run), np.int64)
    out[order] = np.bincount(group)[group]
    return out


def near_pairs(run: np.ndarray, words: list[np.ndarray], label: np.ndarray, deal: Deal):
    """Blocks of pairs of rows in Gray order within each run that may be near and have different labels."""
    limit = deal.limit(BITS)
    for a, b in GrayIndex(run, words[0], label).links(deal.limit(64)):
        near = (label[a] != label[b]) & (differing(words, a, b) <= limit)
        yield a[near], b[near]


def _groups(batches, columns: list[str], rows: int, size: str | None = None):
    """Columns of whole groups (rows with the same first two columns, which follow each other), of at least `rows` rows if there are more. size: a column
    whose sum counts instead of the rows."""
    held, n = [], 0

    def whole(final: bool):
        nonlocal held, n
        table = pa.Table.from_batches(held)
        key, block = (table[c].to_numpy() for c in columns[:2])
        new = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
        cut = len(key) if final else int(new[-1]) if len(new) else 0
        rest = table.slice(cut)
        held, n = rest.to_batches(), len(rest) if size is None else int(np.sum(rest[size].to_numpy()))
        return table.slice(0, cut)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows if size is None else int(np.sum(batch[size].to_numpy()))
        if n >= rows:
            found = whole(False)
            if len(found):
                yield found
    if held:
        yield whole(True)


def _candidates(batches, deal: Deal, linear: bool):
    """batches of dealt rows, ordered by key and block. Yields u, v: stars that connect what may be near and has different labels."""
    for table in _groups(batches, DEALT, 1 << 14):
        key, block, *rest = (table[c].to_numpy() for c in DEALT)
        if len(key) < 2:
            continue
        run = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (block[1:] != block[:-1]))])
        some = np.bincount(run)[run] > 1
        if not some.any():
            continue
        run, (node, *words, label) = run[some], [np.ascontiguousarray(x[some]).view(np.uint64) for x in rest]
        run = np.unique(run, return_inverse=True)[1]
        together = np.where(rarer(run, label) > 8, label, 0)  # rows of one cluster lie together, so that the tree can drop them as a whole
        order = np.lexsort((gray_rank(words[0]), together, run))
        run, node, words, label = run[order], node[order], [w[order] for w in words], label[order]
        root = spanning(len(run), [neighbour_pairs(run, node, words, label, deal.limit(BITS))] if linear else near_pairs(run, words, label, deal))
        own = np.flatnonzero(root != np.arange(len(root)))
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array(node[own].view(np.int64)), pa.array(node[root[own]].view(np.int64))], names=["u", "v"])


def _hot_keys(nodes: DataFrame, n: int, bits: int, keys: int, deal: Deal, linear: bool) -> tuple:
    """The keys of more than hot_key nodes, or a 4096th of all if that is more: so there are 4096 a key number at most."""
    least = max(deal.hot_key, n // 4096)
    if n <= least:
        return NOT_HOT
    spark = nodes.sparkSession
    of = lambda batch: keys_of([batch[c].to_numpy().view(np.uint64) for c in WORDS], bits, keys)

    def counted(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                key, times = np.unique(of(batch.slice(at, 4096)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(times)], names=["key", "n"])

    found = nodes.mapInArrow(lean(counted), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > least).toArrow()
    order = np.argsort(found["key"].to_numpy())
    key, times = found["key"].to_numpy()[order], found["n"].to_numpy()[order]
    if not len(key):
        return NOT_HOT
    blocks, label, most = -(-2 * times // least), np.zeros(len(key), np.uint64), np.zeros(len(key), bool)
    if linear:
        return key, blocks, label, most
    shared = spark.sparkContext.broadcast(key)

    def labelled(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                each = of(part)
                hot = np.isin(each, shared.value)
                both = np.stack([each[hot], np.repeat(part["label"].to_numpy(), keys)[hot.ravel()]])
                pairs, times = np.unique(both, axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(times)], names=["key", "label", "n"])

    by = nodes.mapInArrow(lean(labelled), "key bigint, label bigint, n bigint").groupBy("key", "label").agg(F.sum("n").alias("n"))
    top = by.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top")).select("key", "top.*").toArrow()  # a row for each hot key
    at = np.searchsorted(key, top["key"].to_numpy())
    label[at] = top["label"].to_numpy().view(np.uint64)
    most[at] = times[at] - top["n"].to_numpy() <= least
    return key, blocks, label, most


def candidates(nodes: DataFrame, deal: Deal = Deal(), linear: bool = False) -> DataFrame:
    """(u, v): stars that connect nodes (COLUMNS; label: their cluster so far) which may be near.

    Runs a job when called: the nodes are counted, and if they are many the keys that hold very many of them.
    """
    n = nodes.count()
    bits = deal.bits(n)
    keys = min(deal.linear, deal.keys(bits)) if linear else deal.keys(bits)
    shared = nodes.sparkSession.sparkContext.broadcast(_hot_keys(nodes, n, bits, keys, deal, linear))
    dealt = nodes.select(*COLUMNS).mapInArrow(lean(lambda batches: _dealt(batches, bits, keys, shared.value, linear)), DEALT_SCHEMA)
    return dealt.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(lean(lambda batches: _candidates(batches, deal, linear)), "u bigint, v bigint").distinct()


def similar(words: list[np.ndarray], label: np.ndarray, flat: np.ndarray, ends: np.ndarray, limit: int, similarity: float) -> np.ndarray:
    """Of each row the row that links connect it with, among rows of one label from the start. Rows are linked if they differ in at most `limit` bits and
    their sets of shingles (flat, cut at ends) have that Jaccard similarity; pairs that are connected already aren't compared."""
    root = np.unique(label, return_index=True, return_inverse=True)
    root = root[1][root[2]]
    number = np.unique(flat, return_inverse=True)[1]
    size, held = np.diff(ends), np.zeros(int(number.max()) + 1 if len(number) else 1, bool)
    for u in range(len(root) - 1):
        rest = np.arange(u + 1, len(root))
        rest = rest[root[rest] != root[u]]
        rest = rest[differing(words, np.full(len(rest), u), rest) <= limit] if len(rest) else rest
        if not len(rest):
            continue
        own = number[ends[u] : ends[u + 1]]
        held[own] = True
        n = size[rest]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        shared = np.bincount(np.repeat(np.arange(len(rest)), n), held[number[np.repeat(ends[rest], n) + inner]], minlength=len(rest))
        held[own] = False
        found = rest[shared >= similarity * (size[u] + n - shared) - 1e-9]
        if len(found):
            joined = np.unique(np.append(root[found], root[u]))
            root[np.isin(root, joined)] = joined[0]
    return root


MEMBER = ["cluster", "block", "node", *WORDS, "label", "size", "shingles"]


def _compared(batches, deal: Deal):
    """batches of MEMBER, ordered by cluster and block. Yields u, v: stars that connect what the shingles confirm and isn't connected by its label."""
    for table in _groups(batches, MEMBER, deal.block, "size"):
        cluster, block = (table[c].to_numpy() for c in MEMBER[:2])
        node, *words, label = (np.ascontiguousarray(table[c].to_numpy()).view(np.uint64) for c in MEMBER[2:8])
        lists = table["shingles"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        flat, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(table["size"].to_numpy())])
        cut = np.concatenate([[0], np.flatnonzero((cluster[1:] != cluster[:-1]) | (block[1:] != block[:-1])) + 1, [len(cluster)]])
        u, v = [], []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            root = similar([w[a:b] for w in words], label[a:b], flat[ends[a] : ends[b]], ends[a : b + 1] - ends[a], deal.limit(BITS), deal.similarity)
            own = np.flatnonzero(root != np.arange(b - a))
            u.append(node[a:b][own])
            v.append(node[a:b][root[own]])
        if sum(map(len, u)):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)], names=["u", "v"])


def _links(members: DataFrame, deal: Deal) -> DataFrame:
    """Stars that connect nodes of one cluster and block (MEMBER)."""
    return members.select(*MEMBER).repartition("cluster", "block").sortWithinPartitions("cluster", "block").mapInArrow(lean(lambda batches: _compared(batches, deal)), "u bigint, v bigint").distinct()


def confirmed(members: DataFrame, deal: Deal) -> list[DataFrame]:
    """Stored stars (u, v) that connect just what all links do. members: cluster, node, WORDS, size and shingles of every node that is in a cluster."""
    totals = stored(members.groupBy("cluster").agg(F.sum("size").alias("total"), F.count("*").alias("nodes")), "near-clusters")
    blocks = F.ceil(F.col("total") / F.lit(deal.block)).cast("int")
    scramble = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "node"), n)
    counted = members.join(totals.withColumn("blocks", F.greatest(blocks, F.lit(1))), "cluster").withColumn("own", scramble(5, F.col("blocks")).cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    is_pivot = scramble(6, F.lit(1 << 30)) * F.col("nodes") < F.lit(deal.pivots << 30)
    once = counted.withColumn("block", F.explode(F.when((F.col("blocks") > 1) & is_pivot, everywhere).otherwise(F.array("own"))))
    first = stored(_links(once.withColumn("label", F.col("node")), deal), "near-sure")
    large = counted.where("blocks > 1")
    if totals.where(blocks > 1).isEmpty():
        return [first]
    roots = stored(components(first), "near-components")
    named = stored(large.drop("shingles").join(roots, "node", "left").select("cluster", "node", "size", "blocks", F.coalesce("root", "node").alias("label")), "near-labelled")
    by = named.groupBy("cluster", "label").agg(F.sum("size").alias("of"))
    top = by.groupBy("cluster").agg(F.max(F.struct("of", "label")).alias("top"), F.sum("of").alias("all"), F.count("*").alias("labels")).where("labels > 1")
    top = stored(top.select("cluster", F.col("top.label").alias("main"), (F.col("all") - F.col("top.of") <= deal.block).alias("mostly")), "near-main")
    again = large.join(named.select("node", "label"), "node").join(top, "cluster")
    # of a cluster that is mostly one component its parts meet the rest; of any other every two blocks meet
    n, other = F.col("blocks"), F.col("other")
    again = again.withColumn("other", F.explode(F.when(F.col("mostly") & (F.col("label") == F.col("main")), F.array("own")).otherwise(everywhere)))
    again = again.withColumn("block", F.when(F.col("mostly"), other).otherwise(F.least("own", other) * n + F.greatest("own", other)).cast("int"))
    second = stored(_links(again, deal), "near-sure")
    for x in (roots, named, top):
        discard(x)
    return [first, second]


def _labelled(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """nodes (node, WORDS) with the label of the component that roots give them."""
    found = nodes.select("node", *WORDS).join(roots, "node", "left")
    return stored(found.select("node", *WORDS, F.coalesce("root", "node").alias("label")), "near-labelled")


def near_copy_classes(docs: DataFrame, id_col: str, text: str, shingle: int, deal: Deal) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(id, key, node) of each row of docs, key being a hash of its text; of each node its root and rep: the row of it with the smallest id (no id last), then key; and the stored tables behind both."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("key"), F.col(f"`{text}`").alias("text"))
    prints = stored(with_prints(rows, shingle), "near-prints")
    rep = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    nodes = stored(prints.groupBy("node").agg(F.min(rep).alias("rep"), *(F.first(w).alias(w) for w in WORDS)), "near-nodes")
    alone = nodes.select("node", *WORDS, F.col("node").alias("label"))
    linear = stored(components(candidates(alone, deal, linear=True)), "near-components")
    labelled = _labelled(nodes, linear)
    across = stored(candidates(labelled, deal), "near-stars")
    clusters = stored(components(linear.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(across)), "near-components")
    of = clusters.select("node", F.col("root").alias("cluster"))
    # one row of a node brings its shingles; nodes that are in no cluster are passed over before anything is shuffled
    lead = maybe_in(prints.select("node", "id", "key", *WORDS, "shingles"), "node", of).where("maybe").join(nodes.select("node", "rep").join(of, "node"), "node")
    lead = lead.where(F.col("id").eqNullSafe(F.col("rep.id")) & (F.col("key") == F.col("rep.key")))
    members = stored(lead.dropDuplicates(["node"]).select("cluster", "node", *WORDS, F.size("shingles").cast("bigint").alias("size"), "shingles"), "near-shingles")
    sure = confirmed(members, deal)
    every = sure[0] if len(sure) == 1 else sure[0].unionByName(sure[1])
    roots = stored(components(every), "near-components")
    named = stored(nodes.join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root")), "near-roots")
    for x in (linear, labelled, across, clusters, members, nodes, roots, *sure):
        discard(x)
    return prints.select("id", "key", "node"), named, [prints, named]


def near_copy_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, deal: Deal = Deal()) -> DataFrame:
    """Of each row of docs: its id and component: the smallest id reachable over pairs of at least deal.similarity, or of equal shingle sets.

    Texts without words are equal to each other. Repeated rows give repeated results. A null id has a component like any
    other row, but is never one's name (null only if a component has no other ids). No rows: no result.
    """
    rows, named, _ = near_copy_classes(docs, id_col, text, shingle, deal)
    names = named.groupBy("root").agg(F.min("rep").alias("best"))
    of = named.join(names, "root").select("node", F.col("best.id").alias("component"))
    return rows.join(of, "node", "left").select(F.col("id").alias(id_col), "component")


def keep_one_of_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, deal: Deal = Deal()) -> DataFrame:
    """One row of docs for each component, with all its columns: the one with the smallest id (rows without an id last), then by a hash of the text.

    Ids needn't be unique or set. Of rows that agree in id and text one stays.
    """
    rows, named, used = near_copy_classes(docs, id_col, text, shingle, deal)
    best = named.groupBy("root").agg(F.min("rep").alias("best")).select(F.col("best.id").alias("_id"), F.col("best.key").alias("_key"))
    best = stored(best, "near-best")
    on = [F.col("id").eqNullSafe(F.col("_id")), F.col("key") == F.col("_key")]
    again = stored(rows.groupBy("id", "key").count().where("count > 1").join(best, on, "left_semi").select("id", "key"), "near-again")
    for x in used:
        discard(x)
    keyed = docs.withColumns({"_near_id": F.col(f"`{id_col}`"), "_near_key": F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))})
    is_best = [F.col("_near_id").eqNullSafe(F.col("_id")), F.col("_near_key") == F.col("_key")]
    kept = keyed.join(best, is_best, "left_semi")
    if not again.isEmpty():
        repeats = [F.col("_near_id").eqNullSafe(F.col("id_")), F.col("_near_key") == F.col("key_")]
        times = again.select(F.col("id").alias("id_"), F.col("key").alias("key_"))
        kept = kept.join(times, repeats, "left_anti").unionByName(kept.join(times, repeats, "left_semi").dropDuplicates(["_near_id", "_near_key"]))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
