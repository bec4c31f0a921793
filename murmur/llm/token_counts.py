"""Tokens of texts counted, without ids: initial symbols less merges."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from murmur.llm.boundaries import json_classes, pre_tokens
from murmur.llm.bpe import strips
from murmur.llm.common import held, prepare
from murmur.llm.merging import Memo, count_merges

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, for
    the characters from 256 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Counter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        self.symbols = [ids[s] for s in byte_symbols()]
        self.base = max(ids.values()) + 1
        self.ranks = {ids[a] * self.base + ids[b]: rank for rank, (a, b) in enumerate(spec["model"]["merges"])}
        self.merged = [ids[a + b] for a, b in spec["model"]["merges"]]
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.memo = Memo(self._count)

    def _count(self, piece: bytes) -> int:
        return len(piece) - count_merges([self.symbols[b] for b in piece], self.ranks, self.merged, self.base)

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text. A special token's string is one token and parts the text."""
        parts, owner = texts, None
        extra = np.zeros(len(texts), np.int64)
        if self.special and any("<|" in t and self.special.search(t) for t in texts):
            cut = [self.special.split(t) for t in texts]
            owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
            parts = [p for c in cut for p in c]
            extra += [len(c) - 1 for c in cut]
        data, at, first = pre_tokens(parts, json_classes())
        at = at.tolist()
        n = np.fromiter(map(self.memo.__getitem__, [data[i:j] for i, j in zip(at, at[1:])]), np.int64, len(at) - 1)
        each = np.diff(np.r_[0, np.cumsum(n)][first])
        return extra + (each if owner is None else np.bincount(owner, each, len(texts)).astype(np.int64))


def count_tokens(spark: SparkSession, text: Column, path: str = VOCABULARY) -> Column:
    """The number of tokens of a text; null and empty texts have none.

    Each pre-token's adjacent pairs wait in a heap by rank over a linked list of symbols;
    its count is its bytes less the merges. Any length of text is counted whole.
    """
    prepare(spark)

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held(Counter, path)
        for batch in batches:
            counts = [own.count(part) for part in strips([t or "" for t in batch.to_pylist()], len)]
            yield pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())
    return run(text)
