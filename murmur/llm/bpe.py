"""Byte-level BPE by a rank file: encoding with token offsets, and decoding."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from murmur.llm.boundaries import pre_tokens, rank_file_classes
from murmur.llm.common import held, prepare
from murmur.llm.merging import Memo, merged_slices

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Characters that are worked on at a time, besides the rest of the last text.
STRIP = 1 << 19
ENCODED = "struct<ids:array<int>,starts:array<int>>"
CODED = "struct<ids:array<int>,starts:array<int>,decoded:binary>"


class Coder:
    """Ids of texts and bytes of ids by one rank file; one for each Python worker and file."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.width = np.array([len(t) for t in tokens], np.int32)
        self.place = np.r_[0, np.cumsum(self.width)]
        self.letters = np.frombuffer(b"".join(tokens), np.uint8)
        self.memo = Memo(self._ids)

    def _ids(self, piece: bytes) -> bytes:
        rank = self.ranks.get(piece)
        if rank is not None:
            return np.int32(rank).tobytes()
        return np.array([self.ranks[part] for part in merged_slices(piece, self.ranks)], np.int32).tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, the byte of its text at which each begins, and each text's first id (and the end)."""
        data, at, first = pre_tokens(texts, rank_file_classes())
        at = at.tolist()
        found = list(map(self.memo.__getitem__, [data[i:j] for i, j in zip(at, at[1:])]))
        ids = np.frombuffer(b"".join(found), np.int32)
        ends = np.r_[0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) >> 2)][first]
        byte = np.r_[0, np.cumsum(self.width[ids], dtype=np.int64)]
        return ids, (byte[:-1] - np.repeat(byte[ends[:-1]], np.diff(ends))).astype(np.int32), ends

    def decode(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Each text's bytes: its tokens' letters gathered to their offsets."""
        width = self.width[ids]
        total = np.r_[0, np.cumsum(width, dtype=np.int64)]
        text = total[ends]
        place = self.place[ids] - starts - np.repeat(text[:-1], np.diff(ends))
        data = self.letters[np.arange(total[-1]) + np.repeat(place, width)].tobytes()
        return [data[i:j] for i, j in zip(text.tolist(), text[1:].tolist())]


def strips(texts: list, size) -> Iterator[list]:
    """Runs of texts of about STRIP, one text at least."""
    part, total = [], 0
    for text in texts:
        part.append(text)
        total += size(text)
        if total >= STRIP:
            yield part
            part, total = [], 0
    if part:
        yield part


def encode(spark: SparkSession, text: Column, path: str = RANKS) -> Column:
    """ids and starts of a text: token ids, and the UTF-8 byte at which each token begins.

    Null and empty texts have empty lists; a text of any length is encoded whole. The result
    depends on nothing but the text, so repeated rows are alike.
    """
    prepare(spark)

    @F.arrow_udf(ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held(Coder, path)
        for batch in batches:
            ids, starts, ends, _ = _coded(own, batch, False)
            yield pa.StructArray.from_arrays([_lists(ends, ids), _lists(ends, starts)], ["ids", "starts"])
    return run(text)


def _coded(own: Coder, batch: pa.Array, back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Ids, starts, list ends and, if asked for, decoded texts of a batch."""
    ids, starts, ends, texts = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], []
    for part in strips([t or "" for t in batch.to_pylist()], len):
        i, s, e = own.encode(part)
        ids.append(i)
        starts.append(s)
        ends.append(e[1:] + ends[-1][-1])
        if back:
            texts += own.decode(i, s, e)
    return np.concatenate(ids), np.concatenate(starts), np.concatenate(ends), texts


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, pa.int32()))


def code(spark: SparkSession, text: Column, path: str = RANKS) -> Column:
    """`encode`'s ids and starts and `decode`'s bytes of them, made in one worker without a transfer between."""
    prepare(spark)

    @F.arrow_udf(CODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held(Coder, path)
        for batch in batches:
            ids, starts, ends, texts = _coded(own, batch, True)
            yield pa.StructArray.from_arrays([_lists(ends, ids), _lists(ends, starts), pa.array(texts, pa.binary())],
                                             ["ids", "starts", "decoded"])
    return run(text)


def decode(spark: SparkSession, encoded: Column, path: str = RANKS) -> Column:
    """The bytes of `encode`'s ids, put together by their offsets."""
    prepare(spark)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held(Coder, path)
        for batch in batches:
            ids, starts = batch.field("ids"), batch.field("starts")
            offsets = ids.offsets.to_numpy().astype(np.int64)
            flat, begin, base = ids.values.to_numpy(), starts.values.to_numpy(), starts.offsets.to_numpy().astype(np.int64)
            out = []
            for part in strips(list(range(len(batch))), lambda r: 4 * int(offsets[r + 1] - offsets[r])):
                a, b = part[0], part[-1] + 1
                out += own.decode(flat[offsets[a]:offsets[b]], begin[base[a]:base[b]], offsets[a:b + 1] - offsets[a])
            yield pa.array(out, pa.binary())
    return run(encoded)
