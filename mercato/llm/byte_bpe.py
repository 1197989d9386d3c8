"""Byte-level BPE encoding and decoding by a segment tree over byte positions.

The leaves of a piece's tree are its byte positions. A leaf holds the rank of the
pair of tokens that starts there, with the position behind it, and each inner
node the least of its two: the root is the leftmost pair of minimum rank.
Merging it writes three leaves (the pair's second token goes; the pairs before
and after the new token are ranked anew by the live neighbours), each with one
logarithmic walk to the root, until no pair has a rank.

Vocabularies are files of base64 tokens with their ranks, as the tiktoken library
reads them; a rank is the token's id. Each match of the pattern is encoded
by itself, and one that is a token is that token. What counts as letter, number
and white space depends on the Unicode version, so the pattern's classes are
asked from the public encoder.

The new pieces of a block of texts are merged side by side, each in a tree of
its own, one merge of every tree at a time in array operations; a piece of more than
``TOGETHER`` bytes is merged alone, in time n log n however long it is.

On Spark this is one pass without a shuffle, and a text is encoded whole however
long it is. What a worker has encoded it keeps, up to a bounded number of pieces.
A null or empty text has no tokens and decodes to no bytes; rows that repeat
give a row each, a null id stays null, other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import PieceCache, strings

NONE, NONE_32 = 1 << 62, np.int32((1 << 31) - 1)  # above every key: no pair here
LATIN_END = 0x250  # texts of characters below it are cut by short classes
TOGETHER = 64  # bytes of a piece: longer ones are merged one at a time
KEPT_PIECES = 300_000
TEXTS = 256  # of which new pieces are learnt together


class PairRanks:
    """Rank of two tokens put together, for many pairs at once: an open hash table in arrays."""

    EMPTY = np.uint32(0xFFFFFFFF)

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids of more than 16 bits")
        pairs = [(ranks[t[:k]] << 16 | ranks[t[k:]], r)
                 for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        keys, values = (np.array(x, np.uint32) for x in zip(*pairs)) if pairs else (np.zeros(0, np.uint32),) * 2
        self.bits = max(int(4 * len(keys)).bit_length(), 4)
        self.keys, self.values = np.full(1 << self.bits, self.EMPTY), np.zeros(1 << self.bits, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while left.size:  # of the keys that want one empty slot the last written has it, the others move on
            free = self.keys[slot] == self.EMPTY
            self.keys[slot[free]] = keys[left[free]]
            done = self.keys[slot] == keys[left]
            self.values[slot[done]] = values[left[done]]
            left, slot = left[~done], (slot[~done] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Ranks, -1 where the pair has none."""
        keys = (first.astype(np.uint32) << np.uint32(16)) | second.astype(np.uint32)
        out, left, slot = np.full(len(keys), -1, np.int32), np.arange(len(keys)), self._slot(keys)
        while left.size:
            there = self.keys[slot]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            on = ~hit & (there != self.EMPTY)
            left, slot = left[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out


class SegmentTreeBPE:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            self.tokens[r] = t
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pair = PairRanks(self.ranks)
        self.pattern = pattern
        self.latin = self.cut_below(LATIN_END)
        self.every = None  # made when a text asks for it
        self.pieces = PieceCache(self.learn, KEPT_PIECES)

    # -- pieces ----------------------------------------------------------
    def cut_below(self, end: int):
        """Finds the pattern's matches in texts of characters below ``end``, classed as the public encoder has them."""
        import tiktoken

        every = "".join(map(chr, [*range(min(end, 0xD800)), *range(0xE000, end)]))
        bytewise = {bytes([b]): b for b in range(256)}
        own = {}
        for name in (r"\p{L}", r"\p{N}", r"\s"):
            probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=bytewise, special_tokens={})
            own[name] = "".join(f"{re.escape(a)}-{re.escape(b)}" for a, b in spans(bytes(probe.encode_ordinary(every)).decode()))
        cut = self.pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{''.join(own.values())}]").replace(r"\S", f"[^{own[r'\s']}]")
        for name, ranges in own.items():
            cut = cut.replace(name, f"[{ranges}]")
        return re.compile(cut).findall

    def split(self, text: str) -> list[str]:
        if text.isascii() or max(text) < chr(LATIN_END):
            return self.latin(text)
        if self.every is None:
            self.every = self.cut_below(sys.maxunicode + 1)
        return self.every(text)

    # -- the trees -------------------------------------------------------
    def merge(self, piece: bytes) -> bytes:
        """Token ids of one piece of any length."""
        n, ranks, tokens = len(piece), self.ranks.get, self.tokens
        width = 1 << max(n - 2, 0).bit_length()
        shift = width.bit_length()
        mask = (1 << shift) - 1
        ids = self.single[list(piece)].tolist()
        tree = [NONE] * (2 * width)
        for i in range(n - 1):
            r = ranks(piece[i : i + 2])
            if r is not None:
                tree[width + i] = r << shift | i
        for v in range(width - 1, 0, -1):
            tree[v] = min(tree[2 * v], tree[2 * v + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := tree[1]) != NONE:
            at, merged = root & mask, root >> shift
            gone, prv = after[at], before[at]
            nxt = after[gone]
            ids[at], ids[gone], after[at] = merged, -1, nxt
            changed = [(gone, None)]
            if nxt < n:
                before[nxt] = at
                changed.append((at, ranks(tokens[merged] + tokens[ids[nxt]])))
            else:
                changed.append((at, None))
            if prv >= 0:
                changed.append((prv, ranks(tokens[ids[prv]] + tokens[merged])))
            for leaf, rank in changed:
                if leaf >= n - 1:
                    continue  # no pair starts at the last byte
                v = width + leaf
                tree[v] = NONE if rank is None else rank << shift | leaf
                while v > 1:
                    v >>= 1
                    least = min(tree[2 * v], tree[2 * v + 1])
                    if tree[v] == least:
                        break
                    tree[v] = least
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def merge_many(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Token ids of pieces of at most ``width`` bytes: a tree of ``width`` leaves each, all trees a merge at a time."""
        m, depth = len(pieces), width.bit_length() - 1
        n = np.fromiter(map(len, pieces), np.int64, m)
        place = np.arange(width)
        ids = np.zeros((m, width), np.int32)
        ids[place < n[:, None]] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        tree = np.full((m, 2 * width), NONE_32, np.int32)
        begins = place[:-1] < n[:, None] - 1
        ranks = self.pair(ids[:, :-1][begins], ids[:, 1:][begins])
        tree[:, width:-1][begins] = np.where(ranks < 0, NONE_32, ranks << depth | np.nonzero(begins)[1])
        for d in range(depth - 1, -1, -1):
            v = 1 << d
            np.minimum(tree[:, 2 * v : 4 * v : 2], tree[:, 2 * v + 1 : 4 * v : 2], out=tree[:, v : 2 * v])
        # one row after the other, so that places are offsets; a piece's ends are marked by -1
        live = np.ones((m, width), bool)
        live &= place < n[:, None]
        after, before = np.where(place < n[:, None] - 1, place + 1, -1), np.broadcast_to(place - 1, (m, width)).copy()
        ids_, live_, after_, before_, tree_ = (x.reshape(-1) for x in (ids, live, after, before, tree))
        row = np.arange(m)
        while row.size:
            root = tree[row, 1]
            row, root = row[root != NONE_32], root[root != NONE_32]
            at, merged, base = (root & (width - 1)).astype(np.int64), root >> depth, row * width
            gone = after_[base + at]
            nxt, prv = after_[base + gone], before_[base + at]
            ids_[base + at], live_[base + gone], after_[base + at] = merged, False, nxt
            more, less = nxt >= 0, prv >= 0
            before_[(base + nxt)[more]] = at[more]
            rank = self.pair(np.concatenate([merged[more], ids_[(base + prv)[less]]]),
                             np.concatenate([ids_[(base + nxt)[more]], merged[less]]))
            leaf = np.concatenate([at[more], prv[less], at[~more], gone])
            key = np.full(len(leaf), NONE_32, np.int32)
            key[: len(rank)] = np.where(rank < 0, NONE_32, rank << depth | leaf[: len(rank)])
            top = np.concatenate([row[more], row[less], row[~more], row]) * (2 * width)
            v = leaf + width
            tree_[top + v] = key
            for _ in range(depth):
                v >>= 1
                tree_[top + v] = np.minimum(tree_[top + 2 * v], tree_[top + 2 * v + 1])
        cut = np.cumsum(live.sum(1)) * 4
        data = ids[live].astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *cut[:-1].tolist()], cut.tolist())]

    def learn(self, pieces: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        data = [p.encode() for p in pieces]
        for k, d in enumerate(data):
            if (whole := self.ranks.get(d)) is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(d) > TOGETHER:
                out[k] = self.merge(d)
            else:
                by_width.setdefault(1 << (len(d) - 1).bit_length(), []).append(k)
        for width, which in by_width.items():
            for k, ids in zip(which, self.merge_many([data[k] for k in which], width)):
                out[k] = ids
        return out

    # -- texts -----------------------------------------------------------
    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        for lo in range(0, len(texts), TEXTS):
            for found in self.pieces.values_of(list(map(self.split, texts[lo : lo + TEXTS]))):
                yield np.frombuffer(b"".join(found), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def spans(characters: str) -> Iterator[tuple[str, str]]:
    """First and last of each stretch of consecutive characters."""
    codes = np.unique(np.fromiter(map(ord, characters), np.int64, len(characters)))
    cut = np.flatnonzero(np.diff(codes) > 1)
    for a, b in zip(codes[[0, *(cut + 1)]].tolist(), codes[[*cut, -1]].tolist()):
        yield chr(a), chr(b)


_CODERS: dict[tuple[str, str], SegmentTreeBPE] = {}


def coder(path: str, pattern: str) -> SegmentTreeBPE:
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = SegmentTreeBPE(path, pattern)
    return _CODERS[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, ids, decoded (bytes) of every text."""

    def run(batches):
        c = coder(path, pattern)
        for b in batches:
            ids = list(c.encode(strings(b.column(1))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int64())), pa.array(map(c.decode, ids), pa.binary())],
                ["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "doc_id long, ids array<long>, decoded binary")


def encoding_digests(docs: DataFrame, path: str, pattern: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256 of every text."""

    def run(batches):
        c = coder(path, pattern)
        for b in batches:
            n, x, y = [], [], []
            for ids in c.encode(strings(b.column(1))):
                n.append(len(ids))
                x.append(hashlib.sha256(",".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
                y.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(x, pa.string()), pa.array(y, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
