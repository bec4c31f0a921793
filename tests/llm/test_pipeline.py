"""The pipeline against the same steps in plain Python."""

import hashlib
import re

import corpus_pipeline
import tiktoken
import public_tokenizers
from murmur.llm import bpe
from test_near import plain_groups, plain_print


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def test_stages_against_plain_python(spark, answer, corpus, rows):
    kept = {r["doc_id"] for r in answer("op1_tokeniser_fertility", corpus) if r["kept"]}
    texts = {i: t for i, t in rows if i in kept}
    key = lambda line: lowered(line.strip(" \t\n\x0b\x0c\r"))
    owner = {}
    for i in sorted(texts):
        for line in texts[i].split("\n"):
            owner.setdefault(key(line), i)
    texts = {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or owner[key(x)] == i) for i, t in texts.items()}
    ids = sorted(texts)
    texts = {ids[g]: texts[ids[g]] for g in plain_groups([plain_print(texts[i]) for i in ids], 3)}
    from conftest import ITEMS
    windows = set()
    for _, item in ITEMS:
        w = words(item)
        n = min(10, len(w))
        windows |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    sizes = {len(w) for w in windows}
    texts = {i: t for i, t in texts.items() if not any(
        tuple(w[k:k + n]) in windows for w in [words(t)] for n in sizes for k in range(len(w) - n + 1))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.Coder(bpe.RANKS).ranks, special_tokens={})
    expected = {i: (len(e), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts.items() for e in [library.encode_ordinary(t)]}
    found = {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, corpus).collect()}
    assert found == expected and len(found) > 3


def test_stages_keep_the_columns(spark, corpus, blank, odd):
    for folder in (corpus, blank, odd):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.schema.names == docs.schema.names
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            out.count()
        corpus_pipeline.run(spark, folder).count()
