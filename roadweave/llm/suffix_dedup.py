"""Removal of long repeated byte strings by column-wise construction of a collection's suffix order.

A byte is removed if it lies in a string of `length` bytes that starts anywhere else as well. To find such strings, suffix
order and common prefixes of many pieces of text are built column by column: each round puts one more symbol in front of
every piece, and from the order and common prefixes of the last round follow those of the next by a stable sort on the new
symbols and range minima. A place whose common prefix with a neighbour reaches `length` is the start of a repeated string.

Whole documents can't be the columns: the longest would set the number of rounds and every round would rewrite the state
of all of them. So pieces are cut where equal strings must agree. Of the hashes of its k-byte grams, each window of
`length` bytes picks the smallest, leftmost one, its anchor. Equal windows have equal anchors at equal distances, so a piece
is what the windows of one anchor cover (at most 2 * length bytes), pieces of equal anchor hashes are one small collection
with their anchors in one column, and the rounds are at most 2 * length. Which anchors occur twice is found by
aggregates over 8-byte rows; text is dealt out only for those. Equal pieces are counted before they are gathered, so a
passage in a third of all documents is one piece.

A window that is equal to one at most `length` bytes before it, as in a run of one character or line, is repeated for
certain. Its text alone says so; it has no part in the pieces, since the first of its equals has.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, maybe_in, mix64, slices, stored

LENGTH, GRAM = 200, 32
#: Pieces whose columns one step inside a task holds together, about.
PIECES = 8192
#: Occurrences of an anchor hash that may meet in one task, about 40 MB of pieces; beyond, windows are counted one by one, by aggregates.
HOT_ANCHOR = 100_000


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the `gram` bytes (a power of two) from each place on."""
    h = mix64(data.astype(np.uint64) + np.uint64(1))
    step = 1
    while step < gram:
        h = mix64(h[: len(h) - step] * np.uint64(0x9E3779B97F4A7C15) + h[step:])
        step *= 2
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[: len(x) - done], x[done:])
        done *= 2
    if done < width:
        x = np.minimum(x[: len(x) - (width - done)], x[width - done :])
    return x


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Places of the anchors of a text's windows, their hashes, and the first and last window start of each; and the spans (begin, end) of windows
    that are equal to one at most `length` bytes before, with those, which need no anchor."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), [])
    h = gram_hashes(data, gram)
    width = length - gram + 1
    chosen = np.empty(n, np.int64)
    block = 1 << 19
    for at in range(0, n, block):
        part = h[at : at + block + width - 1]
        # the upper bits of the hash with the place below them: the leftmost of equal minima
        packed = (part & ~np.uint64((1 << 20) - 1)) | np.arange(len(part), dtype=np.uint64)
        chosen[at : at + block] = at + (sliding_min(packed, width) & np.uint64((1 << 20) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:] - 1, [n - 1]])
    place = chosen[first]
    name = h[place]
    # anchors whose hash is also that of the one before them: a run of one period, perhaps
    step = np.diff(place, prepend=-length - 1)
    step[1:][name[1:] != name[:-1]] = 0
    step[:1] = 0
    spans = []
    if len(place) and ((step > 0) & (step <= length)).any():
        change = np.flatnonzero(np.diff(np.where(step <= length, step, 0), prepend=0))
        keep = np.ones(len(place), bool)
        for a, b in zip(change.tolist(), [*change[1:].tolist(), len(place)], strict=True):
            p = int(step[a])
            if not 0 < p <= length:
                continue
            begin, end = max(int(first[a]), p), int(last[b - 1])
            if begin > end:
                continue
            bad = np.cumsum(np.concatenate([[0], data[begin : end + length] != data[begin - p : end + length - p]]))
            equal = bad[length:] == bad[: end - begin + 1]  # of each window from begin on
            for i, j in spans_of(equal):
                spans.append((begin + i - p, begin + j + length))
            for k in range(a, b):
                other = np.flatnonzero(~equal[max(0, first[k] - begin) : last[k] - begin + 1])
                if first[k] >= begin and not len(other):
                    keep[k] = False
                elif first[k] >= begin:
                    first[k], last[k] = first[k] + other[0], first[k] + other[-1]
        place, name, first, last = place[keep], name[keep], first[keep], last[keep]
    return place, name, first, last, spans


def repeated_starts(group: np.ndarray, texts: list[bytes], at: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """Of each piece, which of its windows (by start) are equal to a window of another piece of its group at the same distance from the anchor.

    group: number of each piece's collection, ascending. at: place of the anchor in each piece. Columns are inserted from
    the right; `order` holds the pieces that have begun, by group and suffix; `lcp[i]` is the common prefix of order[i - 1]
    and order[i], 0 where groups meet.
    """
    size = np.array([len(x) for x in texts])
    flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    start = np.cumsum(size) - size
    windows = size - length + 1
    found = np.zeros(int(windows.sum()), bool)
    found_at = np.cumsum(windows) - windows
    end, begin = size - at, -at  # columns of a piece: begin <= c < end
    order, lcp = np.empty(0, np.int64), np.empty(0, np.int64)
    by_end = np.argsort(-end, kind="stable")
    entered = 0
    for c in range(int(end.max()) - 1, int(begin.min()) - 1, -1):
        live = begin[order] <= c
        if not live.all():  # ended pieces leave; what follows them takes the smaller common prefix
            kept = np.flatnonzero(live)
            lcp = np.minimum.reduceat(lcp[: kept[-1] + 1], np.concatenate([[0], kept[:-1] + 1])) if len(kept) else lcp[:0]
            order = order[kept]
        new = entered
        while entered < len(by_end) and end[by_end[entered]] > c:
            entered += 1
        if entered > new:  # pieces begin with an empty suffix, which stands before all others of the group
            fresh = by_end[new:entered]
            key = np.concatenate([2 * group[fresh], 2 * group[order] + 1])
            place = np.argsort(key, kind="stable")
            order = np.concatenate([fresh, order])[place]
            lcp = np.concatenate([np.zeros(len(fresh), np.int64), lcp])[place]
            is_fresh = place < len(fresh)
            lcp[1:][is_fresh[:-1]] = 0  # nothing in common with an empty suffix
            lcp[:1] = 0
        symbol = flat[start[order] + at[order] + c]
        key = group[order] * 256 + symbol
        place = np.argsort(key, kind="stable")
        before, after = place[:-1], place[1:]
        same = key[before] == key[after]
        lcp_new = np.zeros(len(order), np.int64)
        gap = after - before
        near = same & (gap == 1)
        lcp_new[1:][near] = lcp[after[near]] + 1
        far = np.flatnonzero(same & (gap > 1))
        if len(far):
            bounds = np.stack([before[far] + 1, after[far] + 1], axis=1)
            lcp_new[1:][far] = range_min(lcp, bounds) + 1
        order, lcp = order[place], lcp_new
        long_ = lcp >= length
        hit = long_.copy()
        hit[:-1] |= long_[1:]
        rows = order[hit]
        t = c + at[rows]
        ok = t < windows[rows]
        found[found_at[rows[ok]] + t[ok]] = True
    return np.split(found, found_at[1:])


def range_min(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minimum of x over each half-open range, by doubling."""
    out = np.empty(len(bounds), x.dtype)
    width = bounds[:, 1] - bounds[:, 0]
    level, step = x, 1
    todo = np.arange(len(bounds))
    while len(todo):
        now = width[todo] < 2 * step
        if now.any():
            i = todo[now]
            out[i] = np.minimum(level[bounds[i, 0]], level[bounds[i, 1] - step])
            todo = todo[~now]
        if len(todo):
            level = np.minimum(level[: len(level) - step], level[step:])
            step *= 2
    return out


def spans_of(starts: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of true places."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], starts.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def _anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = [anchors(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8), length, gram)[:2] for text in part["text"].to_pylist()]
                ends = pa.array(np.concatenate([[0], np.cumsum([len(x[0]) for x in found])]).astype(np.int32))
                hashes = np.concatenate([np.empty(0, np.uint64), *(x[1] for x in found)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([part["kid"], part["key"], pa.ListArray.from_arrays(ends, pa.array(hashes))], names=["kid", "key", "hashes"])

    return docs.select("kid", "key", "text").mapInArrow(lean(run), "kid bigint, key bigint, hashes array<bigint>")


def _packed(docs: DataFrame) -> DataFrame:
    """Texts as they are shuffled: compressed."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch, "text"):
                data = [packer.compress((x or "").encode("utf-8", "surrogatepass")) for x in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in part.schema.names if c != "text"), pa.array(data, pa.binary())], names=[*(c for c in part.schema.names if c != "text"), "packed"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"), "packed binary"])
    return docs.select(*(c for c in docs.columns if c != "text"), "text").mapInArrow(lean(run), schema)


PIECE = "kid bigint, key bigint, hash bigint, hot boolean, first bigint, at bigint, piece binary"


#: Bytes of pieces that leave a task's step together, about.
PIECE_BYTES = 4 << 20


def _pieces(batches, length: int, gram: int):
    """The pieces of the anchors that occur twice. first: start of the piece in its text; at: place of the anchor in the piece."""
    unpacker = zstandard.ZstdDecompressor()
    names = ["kid", "key", "hash", "hot", "first", "at", "piece"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
    out, size = [], 0

    def made():
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*out, strict=True)) or [()] * 7, kinds, strict=True)], names=names)

    for batch in batches:
        for i in range(batch.num_rows):
            kid, key, packed, mine = (batch[c][i].as_py() for c in ("kid", "key", "packed", "anchors"))
            data = unpacker.decompress(packed)
            hot = {x["place"]: x["hot"] for x in mine}
            for k, (place, h, first, last) in enumerate(zip(*(x.tolist() for x in anchors(np.frombuffer(data, np.uint8), length, gram)[:4]), strict=True)):
                if k in hot:
                    out.append((kid, key, h - (1 << 64) if h >> 63 else h, hot[k], first, place - first, data[first : last + length]))
                    size += len(out[-1][-1])
                    if size >= PIECE_BYTES:
                        yield made()
                        out.clear()
                        size = 0
    if out:
        yield made()


def _columns(batches, length: int):
    """batches: pieces by hash. Yields kid, key, begin, end (bytes) of the repeated strings in each."""

    def solve(groups: list[list[tuple]]):
        distinct: dict[tuple, int] = {}
        rows = [(g, r, distinct.setdefault((g, r[4], r[5]), len(distinct))) for g, group in enumerate(groups) for r in group]
        copies = np.bincount([x[2] for x in rows], minlength=len(distinct))
        collections = np.array([x[0] for x in distinct])
        single = np.bincount(collections, copies == 1)[collections] == 0  # all pieces of the group have copies
        found = [np.ones(len(x[2]) - length + 1, bool) for x in distinct]
        open_ = np.flatnonzero(~single)
        if len(open_):
            keys = list(distinct)
            for i, starts in zip(open_.tolist(), repeated_starts(collections[open_], [keys[i][2] for i in open_], np.array([keys[i][1] for i in open_]), length), strict=True):
                if copies[i] == 1:
                    found[i] = starts
        spans = [spans_of(x) for x in found]
        out = [(r[1], r[2], r[3] + a, r[3] + b + length) for _, r, i in rows for a, b in spans[i]]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(4)], names=["kid", "key", "begin", "end"])

    held: list[list[tuple]] = []
    n = 0
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("hash", "kid", "key", "first", "at", "piece")), strict=True):
            if held and row[0] == held[-1][0][0]:
                held[-1].append(row)
            else:
                if n >= PIECES:
                    yield solve(held)
                    held, n = [], 0
                held.append([row])
            n += 1
    if held:
        yield solve(held)


def _each_window(batches, length: int):
    for batch in batches:
        for start in range(0, batch.num_rows, 128):
            out = [[], [], [], [], []]
            for same, also, at, piece in zip(*(batch.slice(start, 128)[c].to_pylist() for c in ("same", "also", "at", "piece")), strict=True):
                for t in range(len(piece) - length + 1):
                    for to, x in zip(out, (same, also, t, *_digest(piece[t : t + length], at - t)), strict=True):
                        to.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["same", "also", "t", "w1", "w2"])


def _digest(data: bytes, at: int) -> tuple[int, int]:
    """128 bits of a string and the place of its anchor, as two signed integers."""
    x = xxhash.xxh3_128_intdigest(data, at)
    return (x >> 64) - (1 << 63), (x & (1 << 64) - 1) - (1 << 63)


def _hot_spans(pieces: DataFrame, length: int) -> DataFrame:
    """What _columns finds, by aggregates alone: for anchors so frequent that their pieces shouldn't meet in one task."""

    def digests(batches):
        for batch in batches:
            both = [_digest(x, y) for x, y in zip(batch["piece"].to_pylist(), batch["at"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("kid", "key", "first", "at", "piece")), *(pa.array([x[i] for x in both], pa.int64()) for i in range(2))], names=["kid", "key", "first", "at", "piece", "same", "also"])

    named = stored(pieces.mapInArrow(lean(digests), "kid bigint, key bigint, first bigint, at bigint, piece binary, same bigint, also bigint"), "suffix-hot")
    distinct = named.groupBy("same", "also").agg(F.count("*").alias("n"), F.first("at").alias("at"), F.first("piece").alias("piece"))
    distinct = stored(distinct, "suffix-hot-distinct")
    whole = distinct.where("n > 1").select("same", "also", F.lit(0).cast("bigint").alias("begin"), (F.octet_length("piece") - length).cast("bigint").alias("end"))
    each = distinct.mapInArrow(lean(lambda batches: _each_window(batches, length)), "same bigint, also bigint, t bigint, w1 bigint, w2 bigint")
    again = each.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    marks = whole.unionByName(each.join(again, ["w1", "w2"], "left_semi").select("same", "also", F.col("t").alias("begin"), F.col("t").alias("end")))
    marks = marks.groupBy("same", "also").agg(F.collect_set(F.struct("begin", "end")).alias("marks"))
    of = named.select("kid", "key", "first", "same", "also").join(marks, ["same", "also"]).select("kid", "key", "first", F.explode("marks").alias("m"))
    return of.select("kid", "key", (F.col("first") + F.col("m.begin")).alias("begin"), (F.col("first") + F.col("m.end") + length).alias("end"))


def repeated_spans(docs: DataFrame, packed: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_anchor: int = HOT_ANCHOR) -> DataFrame:
    """docs: kid, key (together a name of the text), text. packed: the same with compressed texts. Returns kid, key, spans: array of (begin, end) in bytes, unmerged."""
    found = stored(_anchor_rows(docs, length, gram), "suffix-anchors")
    each = found.select("kid", "key", F.posexplode("hashes").alias("place", "hash"))
    twice = stored(each.groupBy("hash").count().where("count > 1").select("hash", (F.col("count") > hot_anchor).alias("hot")), "suffix-twice")
    # place: number of the anchor in its text
    mine = maybe_in(each, "hash", twice).where("maybe").join(twice, "hash").groupBy("kid", "key").agg(F.collect_set(F.struct("place", "hot")).alias("anchors"))
    pieces = packed.join(mine, ["kid", "key"]).select("kid", "key", "packed", "anchors").mapInArrow(lean(lambda batches: _pieces(batches, length, gram)), PIECE)
    cool = pieces.where("not hot").select("hash", "kid", "key", "first", "at", "piece").repartition("hash").sortWithinPartitions("hash")
    spans = cool.mapInArrow(lean(lambda batches: _columns(batches, length)), "kid bigint, key bigint, begin bigint, end bigint")
    if not twice.where("hot").isEmpty():
        spans = spans.unionByName(_hot_spans(pieces.where("hot"), length))
    return spans.groupBy("kid", "key").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, keep_text: bool = True, hot_anchor: int = HOT_ANCHOR, gram: int = GRAM) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and with the text that is left if keep_text (else without the text column).

    A byte goes if it lies in a string of `length` bytes that starts anywhere else too, in its own document or another;
    strings are judged on the input. Null text counts as empty. Rows that repeat count as documents each, so all of a
    repeated text of `length` bytes or more goes. Ids needn't be unique or set. A UTF-8 character that a cut leaves in part is
    left out of the text that is kept, but counts in the digest's bytes as it stands.
    """
    added = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}
    rest = [c for c in docs.columns if c not in added and c != text]
    hidden = {c: f"_{i}" for i, c in enumerate(rest)}  # an input column may be called like one of these
    base = docs.select(*(F.col(f"`{c}`").alias(x) for c, x in hidden.items()), F.col(f"`{text}`").alias("text"), F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(-1)).alias("kid"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("key"))
    packed = _packed(base)
    spans = repeated_spans(base, packed, length, gram, hot_anchor)
    rows = packed.join(spans, ["kid", "key"], "left")
    names = [*rest, *([text] if keep_text else []), *added]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in rest), *([f"`{text}` string"] if keep_text else []), *(f"{k} {v}" for k, v in added.items())])

    def run(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts, out = [], [[], [], [], []]
                for data, found in zip(part["packed"].to_pylist(), part["spans"].to_pylist(), strict=True):
                    data = unpacker.decompress(data)
                    own = anchors(np.frombuffer(data, np.uint8), length, gram)[4]
                    cut = merged([*((x["begin"], x["end"]) for x in found or ()), *own])
                    kept, at = [], 0
                    for a, b in cut:
                        kept.append(data[at:a])
                        at = b
                    kept = b"".join([*kept, data[at:]])
                    if keep_text:
                        texts.append(kept.decode("utf-8", "ignore" if cut else "surrogatepass"))
                    for to, x in zip(out, (len(data), len(data) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()), strict=True):
                        to.append(x)
                yield pa.RecordBatch.from_arrays([*(part[x] for x in hidden.values()), *([pa.array(texts, pa.string())] if keep_text else []), *(pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))], names=names)

    return rows.mapInArrow(lean(run), schema)
