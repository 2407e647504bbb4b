"""Hard negatives by a pivot table: rows of another label whose score with an anchor comes close to that of a positive.

A score is the integer inner product of two vectors whose components were scaled and rounded down. Each row gets one more
component, the root of what its squared length lacks of the largest one, and an anchor gets a zero there: then the squared
distance of anchor and row is a constant of the anchor less twice their score, and the triangle inequality holds for it. The
distances of all rows to a few pivots are stored. From them follow, for an anchor and a row, the least and the greatest
distance that all pivots allow, and so a bracket of the score; only pairs whose bracket meets a range that is asked for are scored exactly.

Rows lie in cells around centres that a bounded sample gives, and the same brackets, from the least and greatest pivot
distances of a cell, leave out whole cells. Positives and negatives are the same search: the best k rows of each range of scores
of an anchor, among rows of its label or of all others. A cell's rows, in chunks of a bounded number, meet the anchors that
look there, in lots of a bounded number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ann import cell_centres, matrix, nearest_centre
from .common import discard, lean, mix64, stored

#: Rounded components beyond this take no part: scores of up to 256 of them, and a hundredfold, fit a long.
MOST = 1 << 24
#: Rows and anchors of which a task brackets all pairs in one step.
ROWS, ANCHORS = 2048, 256
LEAST, GREATEST = -(1 << 62), 1 << 62
#: Shares of the distances, and of the largest squared length, by which a bracket is widened, for numbers that are rounded.
SLACK, PAD = 1e-6, 1e-12


@dataclass(frozen=True)
class Settings:
    """fit_rows: the sample (smallest hashes of the ids) that gives pivots, cells and the first bounds of positives. cell_rows: rows for which
    there is a cell, up to one for 16 rows of the sample. chunk_rows, lot_rows: rows and anchors that a task holds."""

    fit_rows: int = 4096
    pivots: int = 16
    cell_rows: int = 1024
    chunk_rows: int = 32_768
    lot_rows: int = 8192
    seed: int = 12


def spread(points: np.ndarray, n: int) -> np.ndarray:
    """Up to n different points, each the one farthest from those before."""
    chosen, far = [0], ((points - points[0]) ** 2).sum(1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Rows with the component that brings each squared length to top."""
    return np.concatenate([x, np.sqrt(np.maximum(0, top - (x * x).sum(1)))[:, None]], axis=1)


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T))


def greatest_scores(length: np.ndarray, top: float, own: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """anchors x groups: no row can score more whose pivot distances lie within low and high (groups x pivots). own: the anchors' distances; length: their squared lengths."""
    least = np.zeros((len(own), len(low)))
    for p in range(own.shape[1]):
        a = own[:, p, None]
        np.maximum(least, np.maximum(low[None, :, p] - a, a - high[None, :, p]) - SLACK * (a + high[None, :, p]), out=least)
    return (length[:, None] + top - least**2) / 2 + PAD * (1 + top)


def brackets(length: np.ndarray, top: float, own: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest scores (anchors x rows) that the pivot distances of rows allow."""
    far, near = np.full((len(own), len(rows)), np.inf), np.zeros((len(own), len(rows)))
    for p in range(own.shape[1]):
        both = own[:, p, None] + rows[None, :, p]
        np.minimum(far, both * (1 + SLACK), out=far)
        np.maximum(near, np.abs(own[:, p, None] - rows[None, :, p]) - SLACK * both, out=near)
    return (length[:, None] + top - far**2) / 2 - PAD * (1 + top), (length[:, None] + top - near**2) / 2 + PAD * (1 + top)


def scores(a: np.ndarray, x: np.ndarray, top: float) -> np.ndarray:
    """Exact inner products: sums of whole numbers below 2^53 are exact as doubles."""
    return np.rint(a.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if top < 1 << 52 else a @ x.T


def best_of(k: int, want: np.ndarray, id_: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Indices of the k best of each want: highest score, then smallest id."""
    order = np.lexsort((id_, -score, want))
    rank = np.arange(len(order)) - np.searchsorted(want[order], want[order])
    return order[rank < k]


def _scan(rows: pa.Table, asks: pa.Table, pivots: np.ndarray, top: float, same: bool, k: int) -> pa.Table:
    """The best k rows of one chunk for each range of the anchors that look there."""
    rows, asks = rows.combine_chunks(), asks.combine_chunks()
    out = {c: [] for c in ("anchor", "want", "id", "score")}
    if len(rows) and len(asks):
        dim = pivots.shape[1] - 1
        ids, label, x = rows["id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["q"].combine_chunks(), dim).astype(np.int64)
        table = matrix(rows["far"].combine_chunks(), len(pivots)).astype(np.float64)
        for first in range(0, len(asks), ANCHORS):
            mine = asks.slice(first, ANCHORS).combine_chunks()
            ask_id, ask_label, a = mine["id"].to_numpy(), mine["label"].to_numpy(), matrix(mine["q"].combine_chunks(), dim).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum([len(v) for v in mine["low"].to_pylist()])])
            low, high = mine["low"].combine_chunks().flatten().to_numpy().copy(), mine["high"].combine_chunks().flatten().to_numpy()
            length = (a * a).sum(1).astype(np.float64)
            own = to_pivots(np.concatenate([a.astype(np.float64), np.zeros((len(a), 1))], axis=1), pivots)
            want, found_id, found = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
            for at in range(0, len(ids), ROWS):
                part = slice(at, at + ROWS)
                least, most = brackets(length, top, own, table[part])
                may = (ask_label[:, None] == label[part][None, :]) == same
                may &= ask_id[:, None] != ids[part][None, :]
                may &= most >= np.minimum.reduceat(low, ends[:-1])[:, None]
                may &= least <= np.maximum.reduceat(high, ends[:-1])[:, None]
                some = np.flatnonzero(may.any(0))
                if not len(some):
                    continue
                asker, row = np.nonzero(may[:, some])
                exact = scores(a, x[part][some], top)[asker, row]
                id_ = ids[part][some][row]
                # each pair counts for those of the anchor's ranges that its score meets
                for nth in range(int(np.diff(ends).max())):
                    mark = ends[asker] + nth
                    inside = mark < ends[asker + 1]
                    mark = np.minimum(mark, len(low) - 1)
                    inside &= (exact >= low[mark]) & (exact <= high[mark])
                    want, found_id, found = np.concatenate([want, mark[inside]]), np.concatenate([found_id, id_[inside]]), np.concatenate([found, exact[inside]])
                kept = best_of(k, want, found_id, found)
                want, found_id, found = want[kept], found_id[kept], found[kept]
                full = np.flatnonzero(np.bincount(want, minlength=len(low)) == k)
                last = np.searchsorted(want, full, side="right") - 1
                low[full] = np.maximum(low[full], found[last])
            asker = np.searchsorted(ends, want, side="right") - 1
            for to, y in zip(out.values(), (ask_id[asker], want - ends[asker], found_id, found), strict=True):
                to.append(y)
    return pa.table({c: pa.array(np.concatenate(y) if y else np.empty(0, np.int64), pa.int64()) for c, y in out.items()})


def _best_in_ranges(index: DataFrame, asks: DataFrame, cells: tuple, shared, same: bool, k: int, settings: Settings) -> DataFrame:
    """(anchor, want, id, score): of each of an anchor's ranges (low, high) the best k rows of a chunk. asks: id, label, q, low, high."""
    low_far, high_far, chunks = cells
    spark = index.sparkSession
    chunked = spark.sparkContext.broadcast((low_far, high_far, chunks))
    kept = ["id", "label", "q", "low", "high"]
    schema = "id bigint, label bigint, q array<int>, low array<bigint>, high array<bigint>, cell int, chunk int"

    def look(batches):
        pivots, top = shared.value[:2]
        low_far, high_far, chunks = chunked.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                a = matrix(batch["q"], pivots.shape[1] - 1).astype(np.float64)
                own = to_pivots(np.concatenate([a, np.zeros((len(a), 1))], axis=1), pivots)
                least = np.array([min(v, default=GREATEST) for v in batch["low"].to_pylist()], np.float64)
                may = (greatest_scores((a * a).sum(1), top, own, low_far, high_far) >= least[:, None]) & (chunks > 0)
                asker, cell = np.nonzero(may)
                each = np.repeat(np.arange(len(asker)), chunks[cell])
                chunk = np.arange(len(each)) - np.repeat(np.cumsum(chunks[cell]) - chunks[cell], chunks[cell])
                out = batch.select(kept).take(pa.array(asker[each]))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cell[each].astype(np.int32)), pa.array(chunk.astype(np.int32))], names=[*kept, "cell", "chunk"])

    asked = stored(asks.select(*kept).where(F.size("low") > 0).mapInArrow(lean(look), schema), "negatives-asks")
    lots = np.zeros(len(chunks), np.int64)
    for r in asked.where("chunk = 0").groupBy("cell").count().collect():  # a row a cell, at most fit_rows / 16
        lots[r["cell"]] = -(-r["count"] // settings.lot_rows)
    dealt = spark.sparkContext.broadcast((chunks, lots))

    def deal(batches):
        chunks, lots = dealt.value
        for batch in batches:
            cell, ids = batch["cell"].to_numpy(), batch["id"].to_numpy().view(np.uint64)
            times = lots[cell]
            row = np.repeat(np.arange(len(cell)), times)
            lot = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            chunk = (mix64(ids + np.uint64(1)) % np.maximum(1, chunks[cell]).astype(np.uint64)).astype(np.int32)[row]
            out = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(chunk), pa.array(lot.astype(np.int32))], names=[*out.schema.names, "chunk", "lot"])

    rows = index.select("id", "label", "q", "far", "cell").mapInArrow(lean(deal), "id bigint, label bigint, q array<int>, far array<float>, cell int, chunk int, lot int")
    lot = F.pmod(F.xxhash64("id"), F.element_at(F.array(*(F.lit(int(n)) for n in np.maximum(1, lots))), F.col("cell") + 1)).cast("int")
    keys = ("cell", "chunk", "lot")
    both = rows.groupBy(*keys).cogroup(asked.withColumn("lot", lot).groupBy(*keys))
    return both.applyInArrow(lambda a, b: _scan(a, b, *shared.value[:2], same, k), "anchor bigint, want bigint, id bigint, score bigint")


def usable(vector: str, scale: int) -> Column:
    """Whether a vector is set, has components, and all of them are finite numbers that fit once scaled."""
    x = F.col(vector)
    fits = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * scale) <= MOST))
    return x.isNotNull() & (F.size(x) > 0) & F.coalesce(fits, F.lit(False))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor, its best positives, and their best negatives.

    Scores are inner products of floor(scale * x). An anchor's positives are the `positives` best other rows of its label; of each, the
    best `negatives` rows of another label come whose score lies from low to high per cent of the positive's (nothing, if that is
    negative). Ties go to the smaller id. Rows without id, label (a whole number) or vector, with null or non-finite components or with one beyond
    MOST once scaled, take no part, nor do those of another length than most (of equally frequent lengths the smallest
    counts). Zero vectors take part. Rows that repeat an id count once: the one of the smallest label, then vector. No rows or no anchors: no
    result. Runs jobs when called: lengths, the stored rows and index, the sample, and the positives.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("x", scale))
    rows = rows.withColumn("q", F.transform("x", lambda v: F.floor(v.cast("double") * scale).cast("int"))).drop("x")
    none = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    dims = rows.groupBy(F.size("q").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return none
    dim = dims["dim"]
    one = rows.where(F.size("q") == dim).groupBy("id").agg(F.min(F.struct("label", "q")).alias("one"), F.max("asks").alias("asks"))
    base = stored(one.select("id", "one.label", "one.q", "asks"), "negatives-rows")
    square = F.aggregate("q", F.lit(0).cast("bigint"), lambda s, v: s + v.cast("bigint") * v.cast("bigint"))
    size, top = base.agg(F.count("*"), F.max(square)).first()
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < min(1.0, (2 * settings.fit_rows + 64) / size) * (1 << 30)
    sample = base.where(chance).orderBy(F.xxhash64("id"), "id").limit(settings.fit_rows).select("id", "label", "q").toArrow()  # at most fit_rows rows
    top = float(top)
    known = matrix(sample["q"].combine_chunks(), dim).astype(np.float64)
    high_up = lifted(known, top)
    pivots = spread(high_up, settings.pivots)
    centres = cell_centres(high_up, max(1, min(len(known) // 16, size // settings.cell_rows)), settings.seed)
    shared = spark.sparkContext.broadcast((pivots, top, centres, sample["id"].to_numpy(), sample["label"].to_numpy(), known))

    def encode(batches):
        pivots, top, centres = shared.value[:3]
        for batch in batches:
            x = lifted(matrix(batch["q"], pivots.shape[1] - 1).astype(np.float64), top)
            far = to_pivots(x, pivots).astype(np.float32)
            cell = nearest_centre(x, centres)[0].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(far) + 1, dtype=np.int32) * far.shape[1]), pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(cell)], names=[*batch.schema.names, "far", "cell"])

    index = stored(base.mapInArrow(lean(encode), "id bigint, label bigint, q array<int>, asks boolean, far array<float>, cell int"), "negatives-index")
    discard(base)
    ends = [f(F.element_at("far", p + 1)).alias(f"{name}{p}") for name, f in (("low", F.min), ("high", F.max)) for p in range(len(pivots))]
    low_far, high_far, chunks = np.zeros((len(centres), len(pivots))), np.zeros((len(centres), len(pivots))), np.zeros(len(centres), np.int64)
    for r in index.groupBy("cell").agg(F.count("*").alias("n"), *ends).collect():  # a row a cell, at most fit_rows / 16
        chunks[r["cell"]] = -(-r["n"] // settings.chunk_rows)
        low_far[r["cell"]], high_far[r["cell"]] = [r[f"low{p}"] for p in range(len(pivots))], [r[f"high{p}"] for p in range(len(pivots))]
    cells = low_far, high_far, chunks

    def first_bound(batches):
        """The range of an anchor's positives: from the score that enough rows of the sample reach."""
        known_id, known_label, known = shared.value[3:]
        for whole in batches:
            for at in range(0, whole.num_rows, ANCHORS):
                batch = whole.slice(at, ANCHORS)
                a = matrix(batch["q"], known.shape[1]).astype(np.float64)
                near = np.where((batch["label"].to_numpy()[:, None] == known_label) & (batch["id"].to_numpy()[:, None] != known_id), a @ known.T, -np.inf)
                bound = np.partition(near, -positives, axis=1)[:, -positives] if len(known) >= positives else np.full(len(a), -np.inf)
                bound = np.where(np.isfinite(bound), np.floor(np.maximum(bound, LEAST) - PAD * (1 + top)), LEAST).astype(np.int64)
                lists = lambda x: pa.array([[v] for v in x.tolist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], batch["q"], lists(bound), lists(np.full(len(a), GREATEST))], names=["id", "label", "q", "low", "high"])

    anchors = index.where("asks").select("id", "label", "q")
    asks = anchors.mapInArrow(lean(first_bound), "id bigint, label bigint, q array<int>, low array<bigint>, high array<bigint>")
    found = _best_in_ranges(index, asks, cells, shared, True, positives, settings)
    rank = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    found = found.withColumn("n", rank).where(F.col("n") <= positives)
    goals = stored(found.groupBy(F.col("anchor").alias("id")).agg(F.sort_array(F.collect_list(F.struct("n", F.col("id").alias("goal"), "score"))).alias("goals")), "negatives-positives")
    share = lambda g, p: g["score"].cast("decimal(20,0)") * F.lit(p).cast("decimal(10,0)") / F.lit(100).cast("decimal(3,0)")
    lows, highs = F.transform("goals", lambda g: F.ceil(share(g, low)).cast("bigint")), F.transform("goals", lambda g: F.floor(share(g, high)).cast("bigint"))
    ranges = goals.select("id", lows.alias("low"), highs.alias("high"))
    second = anchors.join(ranges, "id")
    near = _best_in_ranges(index, second, cells, shared, False, negatives, settings)
    ordered = Window.partitionBy("anchor", "want").orderBy(F.desc("score"), "id")
    near = near.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= negatives)
    listed = goals.select(F.col("id").alias("anchor"), F.posexplode("goals").alias("want", "g"))
    out = near.join(listed, ["anchor", "want"])
    return out.select(F.col("anchor").alias("anchor_id"), F.col("g.goal").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("g.score").alias("positive_score"), F.col("score").alias("negative_score"))
