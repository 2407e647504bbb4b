"""How filters of documents interact: what each removes, repeats, loses, in every order of applying them.

Five conditions are told once for each document, by scanning the bytes behind an Arrow column: a table of byte classes gives
spaces, capitals, symbols and continuation bytes, their prefix sums give counts, prefix sums of weighted bytes give a hash of
every word, and the sorted hashes, whose words are then compared byte by byte, give the distinct words. What a document fails
is a mask of five bits. Only masks, ids and digests are shuffled, never texts; counts of the 32 masks of a part hold all that any order
of the filters can do, so the 120 orders are one product of matrices a part.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, mix64, per_process, slices, stored

FILTERS = "ABCDE"
SPACE, CAPITAL, SYMBOL, INNER = 1, 2, 4, 8

#: Bytes that a step scans at once; a longer text is cut between words.
STEP = 1 << 20
#: An odd factor, so that its powers have inverses among 64-bit numbers.
FACTOR = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Limits:
    """A fails below `words` words; B where distinct words are under `distinct` per cent of words; C where A-Z are over `capitals` per
    cent of code points; D with any of `symbols`; E where a smaller id has the same text."""

    words: int = 200
    distinct: int = 50
    capitals: int = 2
    symbols: str = "#$%&*|"


def classes(symbols: str) -> np.ndarray:
    """Class bits of each byte."""
    byte = np.arange(256)
    out = np.where((byte == 32) | ((byte >= 9) & (byte <= 13)), SPACE, 0) | np.where((byte >= ord("A")) & (byte <= ord("Z")), CAPITAL, 0) | np.where((byte & 0xC0) == 0x80, INNER, 0)
    out[np.frombuffer(symbols.encode("ascii"), np.uint8)] |= SYMBOL
    return out.astype(np.uint8)


def powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, and powers of the factor and of its inverse."""
    return mix64(np.arange(1, 257, dtype=np.uint64)), powers(FACTOR, STEP), powers(pow(FACTOR, -1, 1 << 64), STEP)


def word_spans(kind: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word; texts begin at starts."""
    full = (kind & SPACE) == 0
    edge = np.zeros(len(kind) + 1, bool)
    edge[starts] = True
    edge[-1] = True
    first, last = full.copy(), full.copy()
    first[1:] &= ~full[:-1] | edge[1:-1]
    last[:-1] &= ~full[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word from one prefix sum over all bytes: its share of the sum, moved to the power nought."""
    number, up, down = per_process("filter-audit", _tables)
    if len(data) > len(up):  # one word longer than a step
        up, down = powers(FACTOR, len(data)), powers(pow(FACTOR, -1, 1 << 64), len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(number[data] * up[: len(data)], out=total[1:])
    return mix64((total[end] - total[begin]) * down[begin])


def first_of_each(data: np.ndarray, key: np.ndarray, owner: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of one word of each run of equal keys, and owners for which a run held different words, whose words the keys can't tell."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    a, b = order[:-1][same], order[1:][same]
    alike = (owner[a] == owner[b]) & (length[a] == length[b])
    x, y = a[alike], b[alike]
    size = length[x]
    pair = np.repeat(np.arange(len(x)), size)
    inner = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
    other = data[begin[x][pair] + inner] != data[begin[y][pair] + inner]
    wrong = np.unique(np.concatenate([owner[a[~alike]], owner[b[~alike]], owner[x[pair[other]]]]))
    return order[np.concatenate([[True], ~same])] if len(order) else order, wrong


def _steps(kind: np.ndarray, step: int):
    """(from, to) of pieces of one text of about step bytes, cut after a space; a longer word stays whole."""
    at = 0
    while at < len(kind):
        to = min(len(kind), at + step)
        if to < len(kind):
            back = np.flatnonzero(kind[at:to] & SPACE)
            if len(back):
                to = at + int(back[-1]) + 1
            else:
                while to < len(kind) and not kind[to - 1] & SPACE:
                    ahead = np.flatnonzero(kind[to : to + step] & SPACE)
                    to = to + int(ahead[0]) + 1 if len(ahead) else min(len(kind), to + step)
        yield at, to
        at = to


def count_words(data: np.ndarray, kind: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int = STEP, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Words and distinct words of texts that lie in data one after another. bits: of the hashes that are used (fewer, in tests, meet more often)."""
    n = len(starts)
    pieces = [(int(starts[0]), int(starts[-1] + lengths[-1]))] if n > 1 or n and lengths[0] <= step else list(_steps(kind, step)) if n else []
    words, found = np.zeros(n, np.int64), []
    filled = np.flatnonzero(lengths)
    for lo, hi in pieces:
        begin, end = word_spans(kind[lo:hi], (starts[filled] - lo)[starts[filled] >= lo])
        owner = filled[np.searchsorted(starts[filled], begin + lo, side="right") - 1] if len(begin) else begin
        words += np.bincount(owner, minlength=n)
        key = word_hashes(data[lo:hi], begin, end)
        key = mix64(key ^ mix64(owner.astype(np.uint64) + np.uint64(1))) >> np.uint64(64 - bits)
        begin, length = begin + lo, end - begin
        kept, wrong = first_of_each(data, key, owner, begin, length)
        found.append((key[kept], owner[kept], begin[kept], length[kept], wrong))
    if not found:
        return words, words.copy()
    key, owner, begin, length, wrong = (np.concatenate(x) for x in zip(*found, strict=True))
    if len(found) > 1:
        kept, more = first_of_each(data, key, owner, begin, length)
        owner, wrong = owner[kept], np.union1d(wrong, more)
    distinct = np.bincount(owner, minlength=n)
    for i in wrong:
        distinct[i] = len(set(data[starts[i] : starts[i] + lengths[i]].tobytes().split()))
    return words, distinct


def counts(column: pa.Array, limits: Limits) -> tuple[np.ndarray, ...]:
    """Words, distinct words, capitals, symbols and code points of each text, and its SHA-256."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, buffer = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = (np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8))[ends[0] : ends[-1]]
    ends = ends - ends[0]
    starts, lengths = ends[:-1], np.diff(ends)
    kind = classes(limits.symbols)[data]

    def of(bit: int) -> np.ndarray:
        if len(starts) == 1:  # a long text needs no prefix sums
            return np.array([np.count_nonzero(kind & bit)])
        places = np.cumsum((kind & bit) != 0, dtype=np.int32)
        before = np.concatenate([np.zeros(1, np.int32), places])
        return (before[ends[1:]] - before[ends[:-1]]).astype(np.int64)

    words, distinct = count_words(data, kind, starts, lengths)
    digest = pa.array([hashlib.sha256(data[a:b]).digest() for a, b in zip(starts, ends[1:], strict=True)], pa.binary())
    return words, distinct, of(CAPITAL), of(SYMBOL), lengths - of(INNER), digest


def _judged(docs: DataFrame, limits: Limits) -> DataFrame:
    """_id, _part, _digest and _mask (filters A to D) of each document; docs: _id, _part, _text."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "_text", STEP):
                words, distinct, capitals, symbols, points, digest = counts(batch["_text"], limits)
                fails = (words < limits.words, 100 * distinct < limits.distinct * words, 100 * capitals > limits.capitals * points, symbols > 0)
                mask = sum(f.astype(np.int32) << i for i, f in enumerate(fails))
                yield pa.RecordBatch.from_arrays([batch["_id"], batch["_part"], digest, pa.array(mask.astype(np.int32))], names=["_id", "_part", "_digest", "_mask"])

    kind = dict(docs.dtypes)["_id"]
    return docs.mapInArrow(lean(run), f"_id {kind}, _part string, _digest binary, _mask int")


def masks(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part that fail just the filters in the mask (bit 0 is A).

    A text that a smaller id has too fails E, by SHA-256, wherever it is; the first of a group passes, and so do rows that repeat
    the first one's id, and rows without an id. A null text is empty, a null part an empty string. A document is good or toxic if
    any of its labels has quality 1 or toxic 1. Joins are by digest and by id with one row a key on the other side, so
    that adaptive execution splits a hot digest. Runs one job when called: the scan of the texts.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"), F.col(text).alias("_text"))
    judged = stored(_judged(rows, limits), "filter-audit")
    first = judged.groupBy("_digest").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    marked = judged.join(first, "_digest", "left").select("_id", "_part", (F.col("_mask") + F.when(F.col("_id") > F.col("_first"), 1 << 4).otherwise(0)).alias("_mask"))
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    flags = labels.groupBy(F.col(id_col).alias("_id")).agg(is_one("quality").alias("_good"), is_one("toxic").alias("_toxic")).where("_id is not null and _good + _toxic > 0")
    both = marked.join(flags, "_id", "left")
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("bigint")
    return both.groupBy(F.col("_part").alias("part"), F.col("_mask").alias("mask")).agg(F.count("*").alias("n"), total("_good").alias("good"), total("_toxic").alias("toxic"))


def order_table() -> dict[str, np.ndarray]:
    """For each step of each order (rows) and each mask (columns) whether its documents are kept, removed there, or fail but are gone; the step's filter."""
    mask, out = np.arange(1 << len(FILTERS)), {"kept": [], "removed": [], "redundant": [], "filter": []}
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for f in order:
            here, gone = (mask >> f) & 1 == 1, (mask & before) != 0
            before |= 1 << f
            for name, x in (("kept", (mask & before) == 0), ("removed", here & ~gone), ("redundant", here & gone), ("filter", f)):
                out[name].append(x)
    return {k: np.array(v).astype(np.int64) for k, v in out.items()}


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row for each part, order of the five filters and step: what is kept and removed, with each filter's Shapley share.

    The share counts a document once for each order in which the filter is the one that removes it: a document that fails m
    filters is each one's in 120 / m orders. No documents, no rows.
    """
    name = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    listed = masks(docs, labels, limits, id_col, text, part).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("of"))  # at most 32 a part

    def run(batches):
        table = order_table()
        orders = ["".join(FILTERS[f] for f in o) for o in itertools.permutations(range(len(FILTERS)))]
        steps, size = len(orders) * len(FILTERS), 1 << len(FILTERS)
        share = np.array([[(m >> f & 1) * (len(orders) // max(1, bin(m).count("1"))) for m in range(size)] for f in range(len(FILTERS))])
        alone = np.array([[int(m == 1 << f) for m in range(size)] for f in range(len(FILTERS))])
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                found, row = batch["of"].flatten(), pc.list_parent_indices(batch["of"]).to_numpy()
                hist = np.zeros((3, batch.num_rows, size), np.int64)
                for i, c in enumerate(("n", "good", "toxic")):
                    hist[i, row, found.field("mask").to_numpy()] = found.field(c).to_numpy()
                n, good, toxic = hist
                of_filter = lambda x: (n @ x.T)[:, table["filter"]]
                wide = [n @ table["kept"].T, n @ table["removed"].T, n @ table["redundant"].T, of_filter(alone), good @ table["removed"].T, toxic @ table["removed"].T, of_filter(share)]
                order = pa.array(np.repeat(np.array(orders, object), len(FILTERS)).tolist() * batch.num_rows, pa.string())
                step = pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders) * batch.num_rows))
                yield pa.RecordBatch.from_arrays([batch["part"].take(pa.array(np.repeat(np.arange(batch.num_rows), steps))), order, step, *(pa.array(x.ravel()) for x in wide)], names=name)

    return listed.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in name[3:]))
