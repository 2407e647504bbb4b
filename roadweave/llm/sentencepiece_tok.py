"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is read here (no protobuf library needed). From it come the normaliser, the metaspace marker, the
unigram scores or, for a BPE model, the merges in the order of the piece scores, and byte fallback. Texts are cut where a
run of markers begins. No piece of a vocabulary that is cut at white space reaches over such a place (checked when the
model is read), so a text's ids are those of its chunks in turn. Only the distinct chunks of a slice of texts are
encoded, decoded and compared with the sentencepiece library, in multithreaded batches.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, per_process, slices

MARK = "▁"
#: Piece types and model types of the format. Fixed values.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SLICE = 2 << 20
ENCODE_AT_ONCE = 20_000
#: Distinct chunks that a Python worker remembers, about 150 MB with what the two libraries hold.
MEMO_CHUNKS = 250_000


def _fields(data: bytes):
    """(field number, value) of a protobuf message: int, or bytes of 4, 8 or a stated length."""
    i = 0

    def varint():
        nonlocal i
        out = shift = 0
        while True:
            b = data[i]
            i += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while i < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield key >> 3, data[i : i + n]
        i += n


@dataclass
class SentencePieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> SentencePieceModel:
        out = cls()
        for number, value in _fields(data):
            if number == 1:
                x = dict(_fields(value))
                out.pieces.append((x.get(1, b"").decode("utf-8"), struct.unpack("<f", x[2])[0] if 2 in x else 0.0, x.get(3, NORMAL)))
            elif number == 2:
                x = dict(_fields(value))
                out.model_type, out.byte_fallback = x.get(3, UNIGRAM), bool(x.get(35, 0))
            elif number == 3:
                x = dict(_fields(value))
                out.charsmap, out.add_dummy_prefix = x.get(2, b""), bool(x.get(3, 1))
                out.remove_extra_whitespaces, out.escape_whitespaces = bool(x.get(4, 1)), bool(x.get(5, 1))
        if not out.escape_whitespaces:
            raise ValueError("models that don't escape white space are not supported")
        return out

    @property
    def unk_id(self) -> int:
        return next(i for i, x in enumerate(self.pieces) if x[2] == UNKNOWN)

    def splits_at_marks(self) -> bool:
        """Whether no piece has a marker after another character."""
        return not any(MARK in text.lstrip(MARK) for text, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED))

    def merges(self) -> list[tuple[str, str]]:
        """Pairs that make a piece, best piece first; of one piece's pairs, that of the earliest pieces first."""
        ids = {text: i for i, (text, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)}
        found = [(-score, i, ids[text[:k]], ids[text[k:]]) for i, (text, score, kind) in enumerate(self.pieces) if kind == NORMAL for k in range(1, len(text)) if text[:k] in ids and text[k:] in ids]
        return [(self.pieces[a][0], self.pieces[b][0]) for _, _, a, b in sorted(found)]

    def tokenizer(self, cache: int = 10_000):
        """A tokenizer of single chunks: markers are in place already, and nothing is added."""
        from tokenizers import Tokenizer, decoders, models, normalizers

        if self.model_type == BPE:
            model = models.BPE(vocab={x[0]: i for i, x in enumerate(self.pieces)}, merges=self.merges(), unk_token=self.pieces[self.unk_id][0], fuse_unk=True, byte_fallback=self.byte_fallback, cache_capacity=cache)
        elif self.model_type == UNIGRAM:
            model = models.Unigram([x[:2] for x in self.pieces], self.unk_id, self.byte_fallback)
        else:
            raise ValueError(f"model type {self.model_type} is not supported")
        out = Tokenizer(model)
        if self.charsmap:
            out.normalizer = normalizers.Precompiled(self.charsmap)
        out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        return out

    def marked(self, text: str) -> str:
        """The text with white space as the model sees it."""
        if self.remove_extra_whitespaces:
            text = re.sub(" +", " ", text.strip(" "))
        return (MARK if self.add_dummy_prefix and text else "") + text.replace(" ", MARK)


class Chunks(dict):
    """Numbers chunks as they are first looked up."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


class Codec:
    """Encodes slices of texts. A chunk that was met before is not encoded again, until there are MEMO_CHUNKS of them.

    Chunks are kept without their first marker, which every chunk has: that of the prefix, or a blank's.
    """

    def __init__(self, data: bytes, threads: int):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        import sentencepiece

        self.model, self.threads = SentencePieceModel.parse(data), threads
        if not (self.model.splits_at_marks() and self.model.add_dummy_prefix):
            raise ValueError("the model has pieces that reach over white space, or no prefix")
        self.tokenizer = self.model.tokenizer()
        self.other = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.forget()

    def forget(self) -> None:
        self.numbers = Chunks()
        self.ids, self.size, self.back, self.same = array("i"), array("i"), bytearray(), bytearray()

    def look_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The chunk of each place, and the number of places of each text."""
        at, n = array("q"), []
        number = self.numbers.__getitem__
        for text in texts:
            if not text:
                n.append(0)
                continue
            if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
                found = [x[1:] for x in CHUNK.findall(self.model.marked(text))]
            else:
                found = text.split(" ")
            at.extend(map(number, found))
            n.append(len(found))
        return np.frombuffer(at, np.int64), np.array(n, np.int64)

    def add(self) -> None:
        """Encodes the chunks that are new, decodes them and asks the other library."""
        new = list(islice(self.numbers, len(self.size), None))
        for start in range(0, len(new), ENCODE_AT_ONCE):
            some = new[start : start + ENCODE_AT_ONCE]
            plain = [x.replace(MARK, " ") for x in some]
            found = [x.ids for x in self.tokenizer.encode_batch_fast([MARK + x for x in some], add_special_tokens=False)]
            others = self.other.encode(plain, num_threads=self.threads)  # which adds the prefix itself, but not to an empty text
            self.same.extend(y == x if z else len(x) == 1 and self.other.id_to_piece(x[0]) == MARK for x, y, z in zip(found, others, plain, strict=True))
            decoded_ = self.tokenizer.decode_batch(found, skip_special_tokens=False)
            self.back.extend(x == " " + y for x, y in zip(decoded_, plain, strict=True))
            self.size.extend(map(len, found))
            self.ids.extend(chain.from_iterable(found))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids in a row, ids of each text, and of each text: does it decode to itself, has the other library the same ids."""
        if len(self.numbers) > MEMO_CHUNKS:
            self.forget()
        at, n = self.look_up(texts)
        self.add()
        size = np.array(self.size, np.int64)
        starts, lengths = np.cumsum(size) - size, size[at]
        ends = np.cumsum(lengths)
        ids = np.array(self.ids, np.int32)
        flat = ids[np.repeat(starts[at] - (ends - lengths), lengths) + np.arange(ends[-1])] if len(at) else np.empty(0, np.int32)
        text_of = np.repeat(np.arange(len(texts)), n)
        count = lambda x: np.bincount(text_of, x, minlength=len(texts)).astype(np.int64)
        fails = [count(np.frombuffer(bytes(x), np.uint8)[at] == 0) == 0 for x in (self.back, self.same)]
        plain = [MARK not in x and not (self.model.remove_extra_whitespaces and x != re.sub(" +", " ", x.strip(" "))) for x in texts]
        return flat, count(lengths), fails[0] & np.array(plain, bool), fails[1]


def read_model(spark, path: str = DEFAULT_MODEL) -> bytes:
    """The model's bytes: a small file of the driver's, or one that Spark reads."""
    if "://" not in path:
        with open(path, "rb") as file:
            return file.read()
    return bytes(spark.read.format("binaryFile").load(path).first()["content"])


def encoded(docs: DataFrame, text: str = "text", model: str = DEFAULT_MODEL, threads: int = 2, keep_text: bool = False) -> DataFrame:
    """docs with token_ids (array<int>), n_tokens, decodes (the ids give the text back) and parity (the sentencepiece library gives the same ids).

    Null or empty text: no tokens, both true. A text that holds the marker itself doesn't decode, as in the other library.
    Input columns of those names are replaced. No shuffle; memory is bounded by a slice of texts or the longest text.
    The model's bytes (under 10 MB, checked) travel as a broadcast.
    """
    spark = docs.sparkSession
    data = read_model(spark, model)
    if len(data) > 10 << 20:
        raise ValueError(f"{model} is larger than a model is expected to be")
    shared = spark.sparkContext.broadcast(data)
    added = {"token_ids": "array<int>", "n_tokens": "bigint", "decodes": "boolean", "parity": "boolean"}
    rest = [c for c in docs.columns if c not in added and (keep_text or c != text)]
    base = docs.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*rest, text])))
    schema = ", ".join([*(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in rest), *(f"{k} {v}" for k, v in added.items())])

    def run(batches):
        codec = per_process(("sentencepiece", model, len(shared.value), threads), lambda: Codec(shared.value, threads))
        for batch in batches:
            for part in slices(batch, text, SLICE):
                ids, n, back, same = codec.encode([x or "" for x in part[text].to_pylist()])
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in rest), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(n), pa.array(back), pa.array(same)], names=[*rest, *added])

    return base.mapInArrow(lean(run), schema)


def decoded(tokens: DataFrame, ids: str = "token_ids", out: str = "text", model: str = DEFAULT_MODEL) -> DataFrame:
    """tokens with the text of their ids; null ids give null."""
    data = read_model(tokens.sparkSession, model)
    shared = tokens.sparkSession.sparkContext.broadcast(data)
    rest = [c for c in tokens.columns if c != out]
    base = tokens.select(*(F.col(f"`{c}`") for c in rest))
    schema = ", ".join([*(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in rest), f"`{out}` string"])

    def run(batches):
        model_ = SentencePieceModel.parse(shared.value)
        tokenizer, cut = model_.tokenizer(), int(model_.add_dummy_prefix)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lists = part[ids].to_pylist()
                texts = tokenizer.decode_batch([x or [] for x in lists], skip_special_tokens=False)
                texts = [None if x is None else y[cut:] if y.startswith(" ") else y for x, y in zip(lists, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*rest, out])

    return base.mapInArrow(lean(run), schema)
