"""Nearest neighbours with randomly rotated one-bit codes.

Vectors are centred, rotated by a random orthogonal matrix and kept as the signs of their coordinates (packed bits), with
two scalars: the length of the centred vector and the inner product of its direction with that of its code. From the bits
follows an unbiased estimate of a query's inner product with a vector, and a bound of its error that fails with small
probability. A vector is reranked, with exact distances in double precision, only if its lowest possible distance is within
the best k that the query is sure of.

Vectors are also dealt to cells around centres that a bounded sample gives. A cell's rows, in chunks of a bounded number,
meet the queries that look there, in lots of a bounded number too, in one job: what is read and moved doesn't depend on the
number of queries but by the lots. A query looks at the cells that may hold one of its nearest by the cells' radii, nearest
centres first, Settings.probes at most; None is all of them, and exact but for the error bound. Each task returns a query's
best k. Codes and vectors travel together: at 64 dimensions a code leaves so many vectors to rerank that fetching them
again would cost more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lean, mix64, stored

#: Vectors that a task looks at in one step, and pairs it reranks in one step.
ROWS, PAIRS = 2048, 1 << 16


@dataclass(frozen=True)
class Settings:
    """fit_rows: the sample (smallest hashes of the ids) that gives the cells, the centre and each query's first bound. epsilon: width of
    the error bound; at 3 about one vector in 500 falls outside. cell_rows: vectors for which there is a cell, up to one for 16 rows of the
    sample. probes: cells that a query looks at, at most; None: all that may matter. chunk_rows, lot_rows: vectors and queries that a task holds."""

    fit_rows: int = 8192
    epsilon: float = 3.0
    cell_rows: int = 4096
    probes: int | None = 64
    chunk_rows: int = 65_536
    lot_rows: int = 32_768
    seed: int = 20


def usable(vector: str) -> Column:
    """Whether a vector is set, not zero, and all its components are finite numbers."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Coder:
    def __init__(self, centre: np.ndarray, seed: int):
        self.centre, self.dim = centre, len(centre)
        q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((self.dim, self.dim)))
        self.rotation = q * np.sign(np.diag(r))

    def rotated(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) @ self.rotation

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed signs, length, and inner product of direction and code (1 for the centre itself)."""
        turned = self.rotated(x.astype(np.float64))
        length = np.sqrt((turned**2).sum(1))
        with np.errstate(invalid="ignore", divide="ignore"):
            own = np.where(length > 0, np.abs(turned).sum(1) / (np.sqrt(self.dim) * length), 1.0)
        return np.packbits(turned > 0, axis=1), length, own


def lower_bounds(coder: Coder, bits: np.ndarray, length: np.ndarray, own: np.ndarray, turned: np.ndarray, epsilon: float) -> np.ndarray:
    """Lowest squared distances (vectors x queries) that the codes leave open."""
    sign = (np.unpackbits(bits, axis=1, count=coder.dim).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(coder.dim))
    size = np.sqrt((turned**2).sum(1))
    inner = (sign @ turned.T.astype(np.float32)) / own[:, None]
    error = np.sqrt(np.maximum(0, 1 - own**2) / own**2) * (epsilon / np.sqrt(max(1, coder.dim - 1)))
    return length[:, None] ** 2 + size[None, :] ** 2 - 2 * length[:, None] * (inner + error[:, None] * size[None, :])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, components added in order."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += (a[:, i].astype(np.float64) - b[:, i]) ** 2
    return np.sqrt(out)


class Best:
    """The k nearest found of each query: smallest distance, then smallest id."""

    def __init__(self, n: int, k: int):
        self.k, self.query, self.id, self.score = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.limit = np.full(n, np.inf)

    def add(self, query, id_, score):
        query, id_, score = (np.concatenate(x) for x in ((self.query, query), (self.id, id_), (self.score, score)))
        order = np.lexsort((id_, score, query))
        query, id_, score = query[order], id_[order], score[order]
        first = np.searchsorted(query, query)
        rank = np.arange(len(query)) - first
        keep = rank < self.k
        self.query, self.id, self.score = query[keep], id_[keep], score[keep]
        last = rank[keep] == self.k - 1
        self.limit[self.query[last]] = np.minimum(self.limit[self.query[last]], self.score[last])


def cell_centres(sample: np.ndarray, n: int, seed: int, rounds: int = 12) -> np.ndarray:
    """n centres of the sample by Lloyd's rounds from random rows."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), n, replace=False)]
    for _ in range(rounds if n > 1 else 1):
        own = nearest_centre(sample, centres)[0]
        count = np.bincount(own, minlength=n)
        sums = np.stack([np.bincount(own, sample[:, i], minlength=n) for i in range(sample.shape[1])], axis=1)
        centres = np.where(count[:, None] > 0, sums / np.maximum(1, count)[:, None], centres)
    return centres


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of each row, and the distance."""
    own = np.concatenate([((centres**2).sum(1) - 2 * x[at : at + 4096] @ centres.T).argmin(1) for at in range(0, len(x), 4096)]) if len(x) else np.empty(0, np.int64)
    return own, np.sqrt(((x - centres[own]) ** 2).sum(1))


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, id, score): of each row that is a query the k nearest other rows, nearest first, ties to the smaller id.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do those without an id or of
    another length than most (of equally frequent lengths the smallest counts). Rows that share a query's id are the query's
    own and no candidates; rows that repeat otherwise are candidates each. No usable rows: no result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(F.col("id").isNotNull() & usable("x"))
    dims = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = dims["dim"]
    rows = rows.where(F.size("x") == dim)
    sample = rows.select("id", "x").orderBy(F.xxhash64("id"), "id").limit(settings.fit_rows).toArrow()  # at most fit_rows rows
    known_id, known = sample["id"].to_numpy(), matrix(sample["x"].combine_chunks(), dim)
    coder = Coder(known.mean(0), settings.seed)
    centres = cell_centres(known, max(1, min(len(known) // 16, -(-dims["count"] // settings.cell_rows))), settings.seed)
    # only plain arrays are broadcast: executors have no copy of this module's classes
    shared = spark.sparkContext.broadcast((coder.centre, centres, known_id, known))
    seed = settings.seed

    def encode(batches):
        coder, centres = Coder(shared.value[0], seed), shared.value[1]
        for batch in batches:
            x = matrix(batch["x"], dim)
            bits, length, own = coder.code(x)
            cell, far = nearest_centre(x, centres)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["x"], batch["asks"], pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length), pa.array(own), pa.array(cell.astype(np.int32)), pa.array(far)], names=["id", "x", "asks", "bits", "length", "own", "cell", "far"])

    index = stored(rows.mapInArrow(lean(encode), "id bigint, x array<double>, asks boolean, bits binary, length double, own double, cell int, far double"), "ann-index")
    cells = index.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).orderBy("cell").collect()  # a row a cell, at most fit_rows / 16
    radius, chunks = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for c in cells:
        radius[c["cell"]], chunks[c["cell"]] = c["radius"], -(-c["n"] // settings.chunk_rows)

    def ask(batches):
        _, centres, known_id, known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, x = part["id"].to_numpy(), matrix(part["x"], dim)
                far = np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + (known**2).sum(1)[None, :] - 2 * x @ known.T))
                far = np.where(ids[:, None] == known_id[None, :], np.inf, far)
                # with fewer than k others in the sample there is no bound
                limit = np.partition(far, k - 1, axis=1)[:, k - 1] * (1 + 1e-6) + 1e-6 if far.shape[1] >= k else np.full(len(ids), np.inf)
                to = np.sqrt(((x[:, None, :] - centres[None, :, :]) ** 2).sum(2))
                order = np.argsort(to, axis=1, kind="stable")
                may = (np.take_along_axis(to - radius[None, :], order, 1) <= limit[:, None]) & (chunks[order] > 0)
                may &= np.cumsum(may, axis=1) <= (settings.probes or len(centres))
                q, c = np.nonzero(may)
                cell = order[q, c]
                each = np.repeat(np.arange(len(q)), chunks[cell])
                chunk = np.arange(len(each)) - np.repeat(np.cumsum(chunks[cell]) - chunks[cell], chunks[cell])
                yield pa.RecordBatch.from_arrays([part["id"].take(pa.array(q[each])), part["x"].take(pa.array(q[each])), pa.array(limit[q[each]]), pa.array(cell[each].astype(np.int32)), pa.array(chunk.astype(np.int32))], names=["id", "x", "bound", "cell", "chunk"])

    queries = index.where("asks").select("id", "x").distinct().mapInArrow(lean(ask), "id bigint, x array<double>, bound double, cell int, chunk int")
    queries = stored(queries, "ann-queries")
    asked = {r["cell"]: -(-r["n"] // settings.lot_rows) for r in queries.where("chunk = 0").groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row a cell
    lots = spark.sparkContext.broadcast(np.array([asked.get(c, 0) for c in range(len(centres))]))

    def dealt(batches):
        for batch in batches:
            cell, ids = batch["cell"].to_numpy(), batch["id"].to_numpy().view(np.uint64)
            times = lots.value[cell]
            row = np.repeat(np.arange(len(cell)), times)
            lot = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            chunk = (mix64(ids + np.uint64(1)) % np.maximum(1, chunks[cell]).astype(np.uint64)).astype(np.int32)[row]
            out = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(chunk), pa.array(lot.astype(np.int32))], names=[*out.schema.names, "chunk", "lot"])

    codes = index.select("id", "x", "bits", "length", "own", "cell").mapInArrow(lean(dealt), "id bigint, x array<double>, bits binary, length double, own double, cell int, chunk int, lot int")
    lot = F.pmod(F.xxhash64("id"), F.element_at(F.array(*(F.lit(int(x)) for x in np.maximum(1, lots.value))), F.col("cell") + 1)).cast("int")
    found = codes.groupBy("cell", "chunk", "lot").cogroup(queries.withColumn("lot", lot).groupBy("cell", "chunk", "lot")).applyInArrow(lambda a, b: _scan(a, b, Coder(shared.value[0], seed), k, settings.epsilon), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scan(codes: pa.Table, queries: pa.Table, coder: Coder, k: int, epsilon: float) -> pa.Table:
    """The best k of one chunk for each of the queries that look there."""
    codes, queries = codes.combine_chunks(), queries.combine_chunks()
    out = {c: [] for c in ("query_id", "vec_id", "score")}
    if len(codes) and len(queries):
        order = np.argsort(queries["id"].to_numpy(), kind="stable")
        ask_id, ask = queries["id"].to_numpy()[order], matrix(queries["x"].combine_chunks(), coder.dim)[order]
        bound, turned = queries["bound"].to_numpy()[order], coder.rotated(ask)
        ids, x = codes["id"].to_numpy(), matrix(codes["x"].combine_chunks(), coder.dim)
        length, own = codes["length"].to_numpy(), codes["own"].to_numpy()
        bits = np.frombuffer(b"".join(codes["bits"].to_pylist()), np.uint8).reshape(len(codes), -1)
        for first in range(0, len(ask_id), 512):
            mine = slice(first, first + 512)
            best = Best(len(ask_id[mine]), k)
            best.limit = bound[mine].copy()
            for at in range(0, len(ids), ROWS):
                part = slice(at, at + ROWS)
                low = lower_bounds(coder, bits[part], length[part], own[part], turned[mine], epsilon)
                near, query = np.nonzero((low <= best.limit**2 * (1 + 1e-6) + 1e-9) & (ids[part][:, None] != ask_id[mine][None, :]))
                for step in range(0, len(near), PAIRS):
                    c, q = near[step : step + PAIRS], query[step : step + PAIRS]
                    score = distances(x[part][c], ask[mine][q])
                    keep = score <= best.limit[q]
                    best.add(q[keep], ids[part][c[keep]], score[keep])
            for to, y in zip(out.values(), (ask_id[mine][best.query], best.id, best.score), strict=True):
                to.append(y)
    return pa.table({c: np.concatenate(y) if y else np.empty(0, np.float64 if c == "score" else np.int64) for c, y in out.items()})
