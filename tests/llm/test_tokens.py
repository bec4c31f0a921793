"""Encoders, counters and files against the libraries themselves, decoding by round trip."""

import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
import tiktoken
from tokenizers import Tokenizer

from murmur.llm import bpe, merging, sequences, token_counts
from murmur.llm.boundaries import json_classes, rank_file_classes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
CODER = bpe.Coder(bpe.RANKS)


@pytest.fixture(scope="module")
def library():
    ranks = CODER.ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_byte_bpe_is_the_librarys(answer, corpus, rows, library):
    found = {r["doc_id"]: r for r in answer("op4_byte_bpe", corpus)}
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        assert found[i] == {"doc_id": i, "n_tokens": len(ids), "ids_sha256": sha(",".join(map(str, ids)).encode()),
                            "decoded_sha256": sha((text or "").encode())}


def test_offsets_cut_the_text_into_its_tokens(library):
    texts = ["naïve   it's 漢字 \U0001F600", "", "x"]
    ids, starts, ends = CODER.encode(texts)
    for n, text in enumerate(texts):
        own, at = ids[ends[n]:ends[n + 1]], starts[ends[n]:ends[n + 1]].tolist()
        data = text.encode()
        assert [library.decode_single_token_bytes(int(i)) for i in own] == [data[a:b] for a, b in zip(at, at[1:] + [len(data)])]


def test_separate_operators_round_trip(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("text", bpe.encode(spark, F.col("text")).alias("e"))
    both = frame.select("text", "e", bpe.decode(spark, F.col("e")).alias("back")).collect()
    assert len(both) == len(rows) and all(bytes(r["back"]) == (r["text"] or "").encode() and
                                          len(r["e"]["ids"]) == len(r["e"]["starts"]) for r in both)


def test_random_texts_and_scan_lanes(library):
    rng = random.Random(11)
    alphabet = list("ab'  \n\t'srtevlmdRL12.!?,é漢ñ١ \u0085\x1c") + ["'s", "'re", "'ll", "'ve"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(4000)]
    ids, _, ends = CODER.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode_ordinary(t) for t in texts]


def test_long_pieces_merge_alike():
    ranks = CODER.ranks
    rng = random.Random(3)
    for n in (97, 300, 2000):
        piece = bytes(rng.choices(b"aetion", k=n))
        by_heap = merging.merged_slices(piece, ranks)
        longest, merging.SEARCHED = merging.SEARCHED, 10**6
        try:
            assert merging.merged_slices(piece, ranks) == by_heap
        finally:
            merging.SEARCHED = longest


def test_memo_forgets_and_stays_right():
    memo = merging.Memo(lambda k: len(k), entries=3, longest=4)
    for _ in range(3):
        for key in ("a", "bb", "ccc", "dddd", "eeeee", "a", "f"):
            assert memo[key] == len(key)
    assert len(memo) <= 3 and len(memo.old) <= 3 and "eeeee" not in memo


def test_both_libraries_class_characters_alike():
    assert (rank_file_classes() == json_classes()).all()


def test_counts_are_the_librarys(answer, corpus, rows):
    library = Tokenizer.from_file(token_counts.VOCABULARY)
    found = {r["doc_id"]: r for r in answer("op8_token_counts", corpus)}
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert found[i] == {"doc_id": i, "n_bytes": len((text or "").encode()), "n_tokens": n, "over_limit": n > 1024}


def test_sequences_are_the_librarys(answer, corpus, rows):
    library = Tokenizer.from_file(sequences.VOCABULARY)
    found = {r["doc_id"]: r for r in answer("op6_arrow_sequences", corpus)}
    start = 0
    for i, text in sorted(rows):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        assert found[i] == {"doc_id": i, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}
        start += len(ids)


def test_sequences_are_views_with_masks(spark, corpus, rows):
    manifest = sequences.write_sequences(spark.read.parquet(f"{corpus}/documents.parquet"), length=64, parts=3)
    library = Tokenizer.from_file(sequences.VOCABULARY)
    stream = [i for _, t in sorted(rows) for i in library.encode(t or "", add_special_tokens=False).ids + [1]]
    read, real = [], 0
    for row in manifest.orderBy("part").collect():
        file = sequences.open_file(row["sequences"])
        n = -(-row["n_tokens"] // 64)
        assert sum(file.get_batch(b).num_rows for b in range(file.num_record_batches)) == n
        for k in range(n):
            ids, mask = sequences.sequence(file, k)
            assert len(ids) == len(mask) == 64 and mask[:int(mask.sum())].all()
            assert not ids.flags.owndata and not mask.flags.owndata
            read += ids[mask.view(bool)].tolist()
            real += int(mask.sum())
        assert real <= len(stream)
    assert read == stream


def test_words_are_looked_up_once_for_many_texts():
    class Counted(merging.Memo):
        asked = 0

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)
    coder, library = sequences.WordEncoder(sequences.VOCABULARY), Tokenizer.from_file(sequences.VOCABULARY)
    coder.pieces, coder.words = Counted(coder._piece, 5), Counted(coder._word, 5)
    rng = random.Random(2)
    words = ["alpha", "It's", "x1", "Größe.", "漢字", "\xa0", "ΑΣ", "<|endoftext|>", "e\u0301", "''s", "#$%", "\0", "z" * 300]
    texts = [None, "", " \t\x0b ", *["\n".join(rng.choices(words, k=200)) for _ in range(50)], None, "  alpha", "alpha\r"]
    for kind in (pa.string(), pa.large_string()):
        Counted.asked = 0
        ids, ends = coder.encode(pa.array(["left out", *texts], kind).slice(1))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == want
        assert Counted.asked <= sum(map(len, words[:-1])) + 2 * len(words)
    ids, ends = coder.encode(pa.array([None, ""], pa.string()))
    assert len(ids) == 0 and ends.tolist() == [0, 0]


def test_batches_are_gathered_by_bytes():
    batches = [pa.record_batch({"doc_id": range(n, n + k), "text": ["x" * 100] * k}) for n, k in ((0, 3), (3, 0), (3, 4), (7, 1), (8, 2))]
    for size, parts in ((1, [3, 4, 1, 2]), (500, [7, 3]), (1 << 20, [10])):
        found = list(sequences.gathered(iter(batches), size))
        assert [b.num_rows for b in found] == parts
        assert [i for b in found for i in b.column("doc_id").to_pylist()] == list(range(10))
    assert list(sequences.gathered(iter(batches[1:2]), 1)) == []
