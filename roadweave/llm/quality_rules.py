"""Quality rules with compression bands.

A document's zstandard ratio (bytes over compressed bytes) says how repetitive it is. Prose of a given length has ratios
in a narrow band; spam loops and symbol junk lie above it, random or encoded bytes below. Both the whole document and each
of its fixed chunks are compressed, so that a looping passage inside a long, otherwise ordinary document still shows.

The bands are those of the corpus itself. A first pass counts, over all documents that the base rules keep, the ratios of
different texts by length, and those of different chunks; the counts are summed by Spark and have some thousand cells,
whatever the corpus. Of each length the median and the spread of the quartiles make the band, smoothed over neighbouring
lengths. A second pass judges. Both are narrow but for 24 bytes a document or chunk in the first, and memory is bounded by
a slice of texts (common.SLICE_BYTES) or the longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, slices, split_words

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class CompressionBands:
    """Length-specific limits of the ratio. Lengths are told apart by `steps` an octave, from `least_bytes` on; shorter texts have no band.

    width, chunk_width: half of a band, in deviations (the distance of the quartiles over 1.349, in logarithms, and least_deviation
    at least). reach: lengths to either side whose ratios count as well. least_texts: different texts (or chunks) of a length and its
    neighbours from which on the corpus decides; with fewer `outer` does, (from this many bytes, lowest, highest ratio), ascending.
    chunk_bytes: length of the fixed chunks; one under least_bytes at the end is not judged. bad_chunks: share of chunks out of
    their band from which a document is rejected.
    """

    steps: int = 4
    least_bytes: int = 200
    width: float = 3.5
    chunk_width: float = 5.0
    least_deviation: float = 0.03
    reach: int = 1
    least_texts: int = 50
    outer: tuple[tuple[int, float, float], ...] = ((200, 1.08, 3.2), (400, 1.15, 3.5), (1000, 1.25, 4.0), (4000, 1.4, 5.0), (16000, 1.5, 6.0))
    chunk_bytes: int = 4096
    bad_chunks: float = 0.2
    level: int = 3


#: Kinds of limits; lengths beyond the last step count as it; steps of ln(ratio) in which ratios are counted.
WHOLE, CHUNK = 0, 1
LAST_STEP, BINS = 160, 256


@dataclass
class Limits:
    """Lowest and highest ln(ratio) by kind and length step."""

    low: np.ndarray
    high: np.ndarray

    def broken(self, bands: CompressionBands, kind: int, n_bytes: np.ndarray, log_ratio: np.ndarray) -> np.ndarray:
        step = length_step(bands, n_bytes)
        return (n_bytes >= bands.least_bytes) & ((log_ratio < self.low[kind, step]) | (log_ratio > self.high[kind, step]))


def length_step(bands: CompressionBands, n_bytes: np.ndarray) -> np.ndarray:
    return np.minimum(LAST_STEP - 1, (bands.steps * np.log2(np.maximum(1, n_bytes))).astype(np.int64))


def limits_of(bands: CompressionBands, kind: np.ndarray, step: np.ndarray, log_bin: np.ndarray, n: np.ndarray) -> Limits:
    """Limits from counts of ln(ratio) in steps of 1 / BINS."""
    low, high = np.empty((2, LAST_STEP)), np.empty((2, LAST_STEP))
    for k, width in ((WHOLE, bands.width), (CHUNK, bands.chunk_width)):
        for at in range(LAST_STEP):
            start = 2 ** (at / bands.steps)
            fixed = [(a, b) for size, a, b in bands.outer if start >= size] or [bands.outer[0][1:]]
            low[k, at], high[k, at] = np.log(fixed[-1][0]), np.log(fixed[-1][1])
            near = (kind == k) & (np.abs(step - at) <= bands.reach)
            if n[near].sum() >= bands.least_texts:
                order = np.argsort(log_bin[near])
                x, total = log_bin[near][order] / BINS, np.cumsum(n[near][order])
                first, middle, third = x[np.searchsorted(total, np.array([0.25, 0.5, 0.75]) * total[-1])]
                half = width * max(bands.least_deviation, (third - first) / 1.349)
                low[k, at], high[k, at] = middle - half, middle + half
    return Limits(low, high)


def n_repeat_words(rows: np.ndarray, ids: np.ndarray, n_ids: int, n_rows: int) -> np.ndarray:
    """Of each row, the words that lie in a window of three words which the row holds twice or more."""
    hit = np.zeros(len(ids), bool)
    if len(ids) > 2:
        at = np.flatnonzero(rows[:-2] == rows[2:])
        a, b, c = ids[at], ids[at + 1], ids[at + 2]
        if n_ids < 1 << 21:
            key = (a << 42) | (b << 21) | c
        else:
            pair = np.unique(a * n_ids + b, return_inverse=True)[1]
            key = np.unique(pair.astype(np.int64) * n_ids + c, return_inverse=True)[1]
        order = np.lexsort((key, rows[at]))
        same = (key[order][1:] == key[order][:-1]) & (rows[at][order][1:] == rows[at][order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for k in range(3):
            hit[at[twice] + k] = True
    return np.bincount(rows[hit], minlength=n_rows)


def n_dup_lines(text: str) -> int:
    seen: set[str] = set()
    twice = 0
    for line in text.split("\n"):
        if line in seen:
            twice += 1
        elif line.strip(WHITE):
            seen.add(line)
    return twice


@dataclass
class Ratios:
    """Of each text its bytes and ln(ratio) (0 if empty), and of each chunk of the texts that have several its text, bytes and ln(ratio); hashes if asked for."""

    n_bytes: np.ndarray
    log_ratio: np.ndarray
    chunk_text: np.ndarray
    chunk_bytes: np.ndarray
    chunk_log: np.ndarray
    hashes: np.ndarray
    chunk_hashes: np.ndarray


def ratios_of(texts: list[str], bands: CompressionBands, hashed: bool = False) -> Ratios:
    packer = zstandard.ZstdCompressor(level=bands.level)
    size, packed, hashes, chunks = [], [], [], []
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        size.append(len(data))
        packed.append(len(packer.compress(data)) if data else 1)
        if hashed:
            hashes.append(xxhash.xxh64_intdigest(data))
        if len(data) > bands.chunk_bytes:
            for at in range(0, len(data), bands.chunk_bytes):
                part = data[at : at + bands.chunk_bytes]
                chunks.append((i, len(part), len(packer.compress(part)), xxhash.xxh64_intdigest(part) if hashed else 0))
    size, packed = np.array(size, np.int64), np.array(packed, np.int64)
    text, bytes_, small, name = (np.array([x[k] for x in chunks], np.uint64 if k == 3 else np.int64) for k in range(4))
    return Ratios(size, np.log(np.maximum(1, size) / packed) * (size > 0), text, bytes_, np.log(bytes_ / small) if len(chunks) else np.empty(0), np.array(hashes, np.uint64), name)


def base_counts(batch: pa.RecordBatch, column: str) -> dict[str, np.ndarray]:
    """The counts of the base rules and what they say."""
    texts = pc.fill_null(batch[column], "")
    n = len(texts)
    rows, words = split_words(texts)
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_words = np.bincount(rows, minlength=n)
    repeats = n_repeat_words(rows, ids, len(coded.dictionary), n)
    return {
        "n_words": n_words, "word_chars": np.bincount(rows, pc.utf8_length(words).to_numpy(zero_copy_only=False), minlength=n).astype(np.int64),
        "n_repeat_words": repeats, "base_failed": (n_words < 50) | (100 * repeats > 50 * n_words),
    }


def judge(batch: pa.RecordBatch, column: str, bands: CompressionBands, limits: Limits) -> dict[str, np.ndarray | list]:
    out = base_counts(batch, column)
    texts = [x or "" for x in batch[column].to_pylist()]
    r = ratios_of(texts, bands)
    n = len(texts)
    bad = np.bincount(r.chunk_text, limits.broken(bands, CHUNK, r.chunk_bytes, r.chunk_log), minlength=n).astype(np.int64)
    chunks = np.maximum(np.bincount(r.chunk_text, minlength=n), (r.n_bytes > 0).astype(np.int64))
    whole = limits.broken(bands, WHOLE, r.n_bytes, r.log_ratio)
    bad = np.where(r.n_bytes > bands.chunk_bytes, bad, whole)
    fits = ~whole & ((bad == 0) | (bad < bands.bad_chunks * chunks))
    return out | {
        "n_symbols": [sum(map(x.count, SYMBOLS)) for x in texts], "n_dup_lines": [n_dup_lines(x) for x in texts],
        "zstd_ratio": np.where(r.n_bytes > 0, np.exp(r.log_ratio), 0.0), "n_chunks": chunks, "n_bad_chunks": bad, "kept": ~out["base_failed"] & fits,
    }


def _counted(batches, column: str, bands: CompressionBands):
    """Length step and ln(ratio) in steps of each text that the base rules keep and of its chunks, with a hash that tells equal ones."""
    for batch in batches:
        for part in slices(batch, column):
            failed = base_counts(part, column)["base_failed"]
            r = ratios_of([x or "" for x in part[column].to_pylist()], bands, hashed=True)
            keep, chunk = ~failed & (r.n_bytes >= bands.least_bytes), ~failed[r.chunk_text] & (r.chunk_bytes >= bands.least_bytes)
            kind = np.concatenate([np.full(keep.sum(), WHOLE), np.full(chunk.sum(), CHUNK)])
            step = length_step(bands, np.concatenate([r.n_bytes[keep], r.chunk_bytes[chunk]]))
            log_bin = np.round(BINS * np.concatenate([r.log_ratio[keep], r.chunk_log[chunk]])).astype(np.int32)
            names = np.concatenate([r.hashes[keep], r.chunk_hashes[chunk]]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kind * LAST_STEP + step, pa.int32()), pa.array(log_bin), pa.array(names)], names=["cell", "bin", "hash"])


def learned_limits(docs: DataFrame, text: str = "text", bands: CompressionBands = CompressionBands()) -> Limits:
    """The limits that the different texts of docs give."""
    each = docs.select(F.col(f"`{text}`")).mapInArrow(lean(lambda batches: _counted(batches, text, bands)), "cell int, bin int, hash bigint")
    found = each.distinct().groupBy("cell", "bin").agg(F.count("*").alias("n")).toArrow()  # lengths by ratios: bounded by both steps
    cell, log_bin, n = (found[c].to_numpy() for c in ("cell", "bin", "n"))
    return limits_of(bands, cell // LAST_STEP, cell % LAST_STEP, log_bin, n)


ADDED = {
    "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint",
    "base_failed": "boolean", "zstd_ratio": "double", "n_chunks": "bigint", "n_bad_chunks": "bigint", "kept": "boolean",
}


def judge_quality(docs: DataFrame, text: str = "text", bands: CompressionBands = CompressionBands(), prefix: str = "", limits: Limits | None = None) -> DataFrame:
    """docs with the columns ADDED (each name after `prefix`), one row for each of its rows; an input column of such a name is replaced.

    limits: learnt before, from other documents; else from these. Null text counts as empty: no words, so base_failed. A text
    under bands.least_bytes is never rejected by its ratio. Repeated rows are judged alike, and count once in what is learnt.
    No rows give no rows.
    """
    names = {f"{prefix}{k}": v for k, v in ADDED.items()}
    base = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in names))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema), *(f"`{k}` {v}" for k, v in names.items())])
    limits = limits or learned_limits(base, text, bands)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                found = judge(part, text, bands, limits)
                kinds = {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(found[k], kinds[v]) for k, v in ADDED.items())], names=[*part.schema.names, *names])

    return base.mapInArrow(lean(run), schema)
