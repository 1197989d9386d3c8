"""The segment tree encoder against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from mercato.llm import byte_bpe
from mercato.llm.queries import tokenizer_file

PARTS = [" ", "  ", "\n", " \n", "\t", "\r\n", "　", "\xa0", "\x85", "\x1c", "\x00", "a", "b", "T", "word", "ing", "'s", "'ll", "'LL", "é", "É",
         "1", "½", "²", "!", "%%%", "_", "ß", "İ", "日本", "𐍈", "\U000323b0", "<|endoftext|>", "aaaa", "Hello", "ʼn", "."]


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.SegmentTreeBPE(tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def fuzz(seed, n):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def test_texts_as_the_library_does(coder, library):
    texts = fuzz(3, 800) + ["", "x" * 60_000, " " * 999, "ab" * 3_000, "The quick brown fox, " * 500]
    ids = list(coder.encode(texts))
    assert ids == [library.encode_ordinary(t) for t in texts]
    assert [coder.decode(i) for i in ids] == [t.encode() for t in texts]


def test_characters_of_all_scripts(coder, library):
    texts = [f"a{c}{c}' {c}1{c}  {c}" for c in map(chr, range(0x80, 0x110000, 211)) if not 0xD800 <= ord(c) < 0xE000]
    assert list(coder.encode(texts)) == [library.encode_ordinary(t) for t in texts]


def test_trees_side_by_side_equal_single_trees(coder):
    rnd = random.Random(9)
    pieces = [bytes(rnd.choice(b"abcdest \xc3\xa9\xff") for _ in range(rnd.randint(1, 64))) for _ in range(500)] + [b"aaaaaaa"] * 2
    for width in (1, 2, 8, 64):
        some = [p for p in pieces if len(p) <= width]
        assert coder.merge_many(some, width) == [coder.merge(p) for p in some]


def test_digests(spark, coder, library):
    rows = list(enumerate(fuzz(4, 300))) + [(9_000, None), (None, "no id"), (5, "twice"), (5, "twice"), (7, "y" * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' AS n_tokens").repartition(3)
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode_bytes(ids)).hexdigest()))
    file = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    got = byte_bpe.encoding_digests(docs, file, public_tokenizers.PATTERN)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    for r in byte_bpe.encoded(docs, file, public_tokenizers.PATTERN).collect():
        assert coder.decode(r["ids"]) == bytes(r["decoded"])
    assert byte_bpe.encoding_digests(docs.limit(0), file, public_tokenizers.PATTERN).collect() == []


def test_pieces_kept_are_bounded(coder, monkeypatch):
    small = byte_bpe.PieceCache(coder.learn, 50)
    for k in range(20):
        small.values_of([[f"w{k}x{j}" for j in range(100)]])
    assert len(small) <= 200 and len(small.old) <= 200


def test_wide_ids_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.PairRanks({b"a": 0, b"b": 1 << 16})
    assert byte_bpe.PairRanks({b"a": 0, b"b": 1, b"ab": 2})(np.array([0, 1]), np.array([1, 0])).tolist() == [2, -1]
