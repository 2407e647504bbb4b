"""Language of a text by a bidirectional gated recurrent network over its bytes.

Two recurrent passes, one from the left and one from the right, read windows of a text's UTF-8 bytes; each position gets a
distribution over the languages from both states, and a document's distribution is the mean over all its positions. The
network is trained on the driver, in numpy, by backpropagation through time, from windows of a bounded sample of labelled
documents (Settings: docs and windows). Prediction is one pass over the texts without a shuffle; windows of many texts run
side by side, so that a step of the network is a product of matrices.

State is laid out as units x windows. A window shorter than Settings.width is filled with a byte number 256 whose inputs are
zero: the state stays zero there, so a pass from the right starts at the true end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lean, slices

#: The number that stands where a window has no byte.
PAD = 256

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """docs: documents that are learnt from, at most, in equal parts of each language; windows: windows of each, at most. languages: the
    most frequent ones that are learnt, at most. units: of each direction. width: bytes of a window. batch, rounds, rate: of the training."""

    docs: int = 2048
    windows: int = 8
    languages: int = 256
    units: int = 8
    width: int = 64
    batch: int = 512
    rounds: int = 5
    rate: float = 0.015
    seed: int = 7


def start(languages: int, settings: Settings) -> list[np.ndarray]:
    """Weights before training: inputs (3 units x 257) and recurrence (3 units x units) of either direction, output and its bias.

    Rows of inputs and recurrence: reset gate, update gate, candidate.
    """
    rng, n = np.random.default_rng(settings.seed), settings.units
    own = lambda *shape: (rng.standard_normal(shape) / np.sqrt(n)).astype(np.float32)
    inputs = [own(3 * n, PAD + 1) for _ in range(2)]
    for x in inputs:
        x[:, PAD] = 0
    return [inputs[0], own(3 * n, n), inputs[1], own(3 * n, n), own(languages, 2 * n), np.zeros((languages, 1), np.float32)]


def step(inputs: np.ndarray, again: np.ndarray, byte: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """Next state, and what its gradient needs: reset gate, update gate, candidate and its recurrent part."""
    n = len(h)
    a, g = again @ h, np.take(inputs, byte, axis=1, mode="clip")
    gates = a[: 2 * n]
    gates += g[: 2 * n]
    gates *= 0.5
    np.tanh(gates, out=gates)
    gates += 1
    gates *= 0.5
    r, z, part = gates[:n], gates[n:], a[2 * n :]
    c = r * part
    c += g[2 * n :]
    np.tanh(c, out=c)
    new = h - c
    new *= z
    new += c
    return new, r, z, c, part


def softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(0)
    np.exp(x, out=x)
    x /= x.sum(0)
    return x


def gradients(weights: list[np.ndarray], bytes_: np.ndarray, lang: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy of all positions of windows (width x windows) and its gradient, through all steps of both passes."""
    out, bias = weights[4:]
    width, count = bytes_.shape
    n = weights[1].shape[1]
    kept, states = [], []
    for way, order in enumerate((range(width), range(width - 1, -1, -1))):
        h, mine, seen = np.zeros((n, count), np.float32), {}, np.empty((width, n, count), np.float32)
        for t in order:
            before = h
            h, *rest = step(weights[2 * way], weights[2 * way + 1], bytes_[t], h)
            mine[t], seen[t] = (before, *rest), h
        kept.append(mine)
        states.append(seen)
    flat = np.concatenate([s.transpose(1, 0, 2).reshape(n, -1) for s in states])
    real = (bytes_ != PAD).ravel()
    p = softmax(out @ flat + bias)
    at = np.tile(lang, width), np.arange(width * count)
    loss = -float(np.log(np.maximum(p[at], 1e-30))[real].mean())
    p[at] -= 1
    p *= real / real.sum()
    to_states = (out.T @ p).reshape(2 * n, width, count)
    grads = [np.zeros_like(w) for w in weights]
    grads[4], grads[5] = p @ flat.T, p.sum(1, keepdims=True)
    for way, order in enumerate((range(width - 1, -1, -1), range(width))):
        again = weights[2 * way + 1]
        carried, to_inputs = np.zeros((n, count), np.float32), np.empty((3 * n, width, count), np.float32)
        for t in order:
            before, r, z, c, part = kept[way][t]
            d = to_states[way * n : way * n + n, t] + carried
            to_c = d * (1 - z) * (1 - c * c)
            to_z = d * (before - c) * z * (1 - z)
            to_r = to_c * part * r * (1 - r)
            to_inputs[:n, t], to_inputs[n : 2 * n, t], to_inputs[2 * n :, t] = to_r, to_z, to_c
            to_again = np.concatenate([to_r, to_z, to_c * r])
            grads[2 * way + 1] += to_again @ before.T
            carried = d * z + again.T @ to_again
        each = bytes_.ravel()
        grads[2 * way] += np.stack([np.bincount(each, row.ravel(), minlength=PAD + 1) for row in to_inputs]).astype(np.float32)
        grads[2 * way][:, PAD] = 0
    return loss, grads


def trained(bytes_: np.ndarray, lang: np.ndarray, languages: int, settings: Settings = Settings()) -> list[np.ndarray]:
    """Weights learnt from windows (windows x width) and the number of each one's language, by Adam over shuffled batches."""
    weights, rng = start(languages, settings), np.random.default_rng(settings.seed)
    first, second, n = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(settings.rounds):
        order = rng.permutation(len(lang))
        for at in range(0, len(order), settings.batch):
            some, n = order[at : at + settings.batch], n + 1
            for w, m, v, g in zip(weights, first, second, gradients(weights, np.ascontiguousarray(bytes_[some].T), lang[some])[1], strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= settings.rate * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-8)
    return weights


def position_sums(weights: list[np.ndarray], bytes_: np.ndarray) -> np.ndarray:
    """Sum over the positions of each window (width x windows) of their distributions: languages x windows."""
    out, bias = weights[4:]
    width, count = bytes_.shape
    n = weights[1].shape[1]
    left, h = np.empty((width, len(out), count), np.float32), np.zeros((n, count), np.float32)
    for t in range(width):
        h = step(weights[0], weights[1], bytes_[t], h)[0]
        np.matmul(out[:, :n], h, out=left[t])
    total, h = np.zeros((len(out), count), np.float32), np.zeros((n, count), np.float32)
    for t in range(width - 1, -1, -1):
        h = step(weights[2], weights[3], bytes_[t], h)[0]
        x = out[:, n:] @ h
        x += left[t]
        x += bias
        x = softmax(x)
        x *= bytes_[t] != PAD
        total += x
    return total


def windows(data: np.ndarray, begin: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    place = begin[:, None] + np.arange(width)
    inside = np.arange(width) < length[:, None]
    return np.where(inside, data[np.minimum(place, max(0, len(data) - 1))], PAD).astype(np.int16)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes behind a column of texts, and where each begins and how long it is; a null has no bytes."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8), ends[:-1], np.diff(ends)


def _sample(known: DataFrame, settings: Settings) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and the number of each window's language. known: _id, _text, _lang.

    Of each language the documents with the smallest hashes of their ids; first by a threshold that follows from the
    language's count, so that the exact choice sorts a bounded number of rows. Of a document, windows at hashed places.
    """
    counts = known.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(settings.languages).collect()
    if not counts:
        return [], np.empty((0, settings.width), np.int16), np.empty(0, np.int64)
    each = max(1, settings.docs // len(counts))
    chance = F.lit(0.0)
    for row in counts:
        chance = F.when(F.col("_lang") == row["_lang"], F.lit(min(1.0, (2 * each + 64) / row["count"]))).otherwise(chance)
    hashed = F.xxhash64(F.lit(settings.seed), "_id")
    some = known.withColumn("_hash", hashed).where(F.pmod("_hash", F.lit(1 << 30)) < chance * (1 << 30))
    order = Window.partitionBy("_lang").orderBy("_hash", "_id", "_text")
    some = some.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= each).drop("_n")
    width, most = settings.width, settings.windows

    def cut_some(batches):
        for batch in batches:
            data, starts, lengths = texts_of(batch["_text"])
            hashes = batch["_hash"].to_numpy().view(np.uint64)
            for i, (begin, length) in enumerate(zip(starts, lengths, strict=True)):
                room = max(1, int(length) - width + 1)
                places = np.unique(np.random.default_rng(hashes[i]).integers(0, room, min(most, -(-int(length) // width))))
                got = windows(data, begin + places, np.minimum(width, length - places), width).astype("<i2")
                names = pa.array([batch["_lang"][i].as_py()] * len(got), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array([hashes[i].astype(np.int64)] * len(got), pa.int64()), pa.array(places, pa.int64()), pa.array([w.tobytes() for w in got], pa.binary())], names=["lang", "hash", "place", "window"])

    found = some.select("_text", "_lang", "_hash").mapInArrow(lean(cut_some), "lang string, hash bigint, place bigint, window binary").toArrow()  # docs x windows rows at most
    found = found.sort_by([("lang", "ascending"), ("hash", "ascending"), ("place", "ascending"), ("window", "ascending")])
    names = sorted(row["_lang"] for row in counts)
    lang = pc.index_in(found["lang"].combine_chunks(), pa.array(names, pa.string())).to_numpy()
    return names, np.frombuffer(b"".join(found["window"].to_pylist()), "<i2").reshape(-1, width), lang.astype(np.int64)


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings(), prefix: str = "") -> DataFrame:
    """docs with {prefix}lang_pred and {prefix}score, the mean probability of that language over all positions (six decimals).

    Learnt from rows where `learn` is true and id, text and language are set and the text has a letter; ids, languages and
    other columns are no inputs of a prediction. A text that is null or has no letter is `und` with score 0, and so is every text
    if there is nothing to learn from. One language only: all others get it, with score 1. Repeated rows are judged alike, and
    each counts when learning. Equal probabilities go to the language that sorts first. Columns of docs with one of the new
    names are replaced; others stay. Runs jobs when called: the counts of the languages and the sample.
    """
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    known = docs.where(F.coalesce(learn, F.lit(False)) & letters & F.col(id_col).isNotNull() & F.col(lang).isNotNull())
    names, sample, of = _sample(known.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang")), settings)
    pred, score = f"{prefix}lang_pred", f"{prefix}score"
    kept = docs.drop(pred, score)
    if not names:
        return kept.withColumns({pred: F.lit(UNKNOWN), score: F.lit(0.0)})
    weights = trained(sample, of, len(names), settings)
    shared = docs.sparkSession.sparkContext.broadcast((names, weights))
    abreast = max(256, min(4096, 16384 // len(names)))
    width, carried = settings.width, kept.columns

    def predict(batches):
        names, weights = shared.value
        for whole in batches:
            for batch in slices(whole, text):
                data, starts, lengths = texts_of(batch[text])
                lengths = np.where(batch["_letters"].to_numpy(zero_copy_only=False), lengths, 0)
                sums = np.zeros((len(lengths), len(names)))
                for owner, some in _abreast(data, starts, lengths, width, abreast):
                    each = position_sums(weights, np.ascontiguousarray(some.T))
                    for k in range(len(names)):
                        sums[:, k] += np.bincount(owner, each[k], minlength=len(lengths))
                best = sums.argmax(1)
                mean = np.round(sums[np.arange(len(best)), best] / np.maximum(1, lengths), 6)
                called = pa.array([names[b] if n else UNKNOWN for b, n in zip(best, lengths, strict=True)], pa.string())
                own = [batch[c] for c in carried]
                yield pa.RecordBatch.from_arrays([*own, called, pa.array(np.minimum(1.0, mean))], names=[*carried, pred, score])

    schema = ", ".join(f"`{c}` {kind}" for c, kind in [*kept.dtypes, (pred, "string"), (score, "double")])
    return kept.withColumn("_letters", letters).mapInArrow(lean(predict), schema)


def _abreast(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, most: int):
    """Windows of all texts, `most` at a time; of a long text never more than that exist at once."""
    count = -(-lengths // width)
    ends = np.cumsum(count)
    for at in range(0, int(ends[-1]) if len(ends) else 0, most):
        nth = np.arange(at, min(at + most, ends[-1]))
        owner = np.searchsorted(ends, nth, side="right")
        nth = nth - (ends[owner] - count[owner])
        yield owner, windows(data, starts[owner] + nth * width, np.minimum(width, lengths[owner] - nth * width), width)
