"""Encoders, counts and record files against the public libraries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import bpe, records, token_counts
from mercato.llm.queries import tokenizer_file

PARTS = [" ", "  ", "\n", " \n", "\t", "\r\n", "　", "\xa0", "\x1c", "\x00", "a", "b", "T", "word", "ing", "the", "'s", "'ll", "é", "É",
         "é", "1", "!", "%%%", "_", "½", "²", "ß", "Σ", "İ", "日本", "𐍈", "▁", "<s>", "</s>", "<0x0A>", "<|endoftext|>",
         "<|startoftext|>", "aaaa", "Hello", "naïve", "."]


def fuzz(seed, n=400):
    rnd = random.Random(seed)
    return ["", " ", "  ", " a", "a ", "\n"] + ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    texts = fuzz(7) + ["The quick brown fox, " * 3000, "x" * 20_000]
    return [(i, t) for i, t in enumerate(texts)] + [(9_000, None), (None, "no id"), (5, "twice"), (5, "twice")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash")).repartition(3)


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file(name))


def test_bpe_digests(docs, rows):
    lib = library("word_bpe_49k.json")
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = bpe.encoding_digests(docs, tokenizer_file("word_bpe_49k.json")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_bpe_ids_decode_again(docs):
    coder = bpe.coder(tokenizer_file("word_bpe_49k.json"))
    for r in bpe.encoded(docs, tokenizer_file("word_bpe_49k.json")).collect():
        assert coder.decode(r["ids"]) == r["decoded"]


def test_bpe_one_block_of_overlapping_pairs():
    lib, coder = library("word_bpe_49k.json"), bpe.PairIndexBPE(tokenizer_file("word_bpe_49k.json"))
    for t in ["aaaaa", "aaaaaa", "ababab", "mississippi mississippi", "zzzz zz z"]:
        ids, _ = next(coder.encode([t]))
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


def test_bpe_learns_and_keeps_few_pieces_at_a_time():
    """A worker of the pipeline holds the pieces of a few texts and two short generations, with the same ids."""
    path = tokenizer_file("word_bpe_49k.json")
    texts = [" ".join(f"w{i * 7 + k}x é{k}ł {k}" for k in range(20)) for i in range(40)] + ["", "<|endoftext|> a b"]
    want = list(bpe.PairIndexBPE(path).encode(texts))
    bpe._CODERS.clear()
    coder, learnt = bpe.coder(path, kept_pieces=100, texts=4), []
    coder.pieces.learn = lambda pieces: learnt.append(len(pieces)) or coder.learn(pieces)
    got = []
    for x in coder.encode(texts):
        got.append(x)
        assert max(len(coder.pieces), len(coder.pieces.old)) <= 100 + 4 * 60
    assert got == want
    assert max(learnt) <= 4 * 60
    assert coder.lib.get_vocab_size() == 0  # the library's own copy of the vocabulary is not kept
    bpe._CODERS.clear()


def test_token_counts(docs, rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    want = [(i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t in rows]
    got = token_counts.token_counts(docs, tokenizer_file("piece_bpe_32k.model")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_every_prefix_has_its_count(spark):
    import sentencepiece

    model = tokenizer_file("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = fuzz(11, 120)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in token_counts.prefix_tables(df, model).collect():
        t = texts[r["doc_id"]]
        assert r["counts"] == [len(sp.encode(t[:k])) for k in range(len(t) + 1)]
    for budget in (0, 3, 10):
        for r in token_counts.truncated(df, model, budget).collect():
            t = texts[r["doc_id"]]
            fit = max(k for k in range(len(t) + 1) if len(sp.encode(t[:k])) <= budget)
            assert (r["text"], r["n_tokens"]) == (t[:fit], len(sp.encode(t[:fit])))


def test_records(spark, docs, rows):
    lib = library("byte_bpe_50k.json")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for i, t in order:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = records.record_digests(docs, tokenizer_file("byte_bpe_50k.json")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_record_files(spark, rows, tmp_path):
    lib = library("byte_bpe_50k.json")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = records.write_records(df, tokenizer_file("byte_bpe_50k.json"), f"file://{tmp_path}/out", docs_per_shard=100)
    shards = manifest.orderBy("shard").collect()
    assert len(shards) > 2 and sum(s["n_records"] for s in shards) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(records.NULL_ID if i is None else i, set()).add(tuple(lib.encode(t or "", add_special_tokens=False).ids) + (0,))
    for s in shards:  # a shuffled read by the index
        for k in random.Random(1).sample(range(s["n_records"]), 5):
            doc, ids = records.read_record(s["path"], k)
            assert tuple(ids.tolist()) in texts[doc]
    whole = records.read_records(manifest).orderBy("start").collect()
    assert [len(r["ids"]) for r in whole][:-1] == [b["start"] - a["start"] for a, b in zip(whole, whole[1:])]
    path = shards[1]["path"].removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[40] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        records.read_records(manifest).collect()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encoding_digests(none, tokenizer_file("word_bpe_49k.json")).collect() == []
    assert token_counts.token_counts(none, tokenizer_file("piece_bpe_32k.model")).collect() == []
    assert records.record_digests(none, tokenizer_file("byte_bpe_50k.json")).collect() == []
