"""BPE encoding and decoding by a pair occurrence index.

The distinct pre-tokens of a block of documents are laid out as one chain of
symbols. An index maps each mergeable pair's rank to all positions where the
pair stands. Active ranks are applied in ascending order: every position of
the rank is merged, and only the two pairs beside each merge enter the index
anew. A pair that holds a merge's result always has a larger rank (checked when
the file is loaded), so one ascending sweep gives each pre-token what merging it
alone would give.

Covers tokenizer files of byte-level BPE with an end-of-word suffix, NFC,
white space collapsed and lower case (the kind of ``word_bpe_49k.json``), added
tokens found in the raw text first. Pieces between white space are independent
of each other; their results are cached in a worker, bounded.

A null or empty text has no ids and decodes to the empty text. Ids are joined
on decoding as the library does without a decoder: token strings, one space
between.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import PieceCache, give_back

#: Below this all characters are Latin: composed already, and told apart by category here.
LATIN_END = 0x250
#: Pieces whose ids a worker keeps, about 200 bytes each, in two generations.
KEPT_PIECES = 600_000
TEXTS = 2_000  # of which new pieces are learnt together
WHITE = "\t\n\x0b\x0c\r \x85\xa0"  # fixed values: white space below LATIN_END


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b if b in shown else next(extra)) for b in range(256)]


def latin(first: str) -> str:
    """The characters below LATIN_END of a Unicode category, for a pattern's class."""
    return "".join(re.escape(chr(i)) for i in range(LATIN_END) if unicodedata.category(chr(i))[0] == first)


class PairIndexBPE:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.token = {i: t for t, i in self.vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token.update((i, t) for t, i in self.added.items())
        self.added_at = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        #: The end of a word counts as a symbol that no merge knows.
        self.base = max(self.token) + 2
        self.edge = self.base - 1
        self.left, self.right, self.made, self.rank = [], [], [], {}
        born: dict[int, int] = {}
        for r, (a, b) in enumerate(tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]):
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if max(born.get(x, -1), born.get(y, -1)) >= r:
                raise ValueError("merges are not in the order of their making")
            born.setdefault(z, r)
            self.left.append(x)
            self.right.append(y)
            self.made.append(z)
            self.rank[x * self.base + y] = r
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], np.fromiter(self.rank.values(), np.int64, len(keys))[order]
        symbols = byte_symbols()
        self.inner = np.array([self.vocab[s] for s in symbols])
        self.last = np.array([self.vocab[s + self.suffix] for s in symbols])
        letters, numbers = latin("L"), latin("N")
        self.latin = re.compile(f"'(?:[stmd]|re|ve|ll)|[{letters}]+|[{numbers}]|[^{WHITE}{letters}{numbers}]+").findall
        self.white = re.compile(r"[^\s\x1c-\x1f]*(?:[\x1c-\x1f]+[^\s\x1c-\x1f]*)*").findall
        # asked only for its normalizer and pre-tokenizer: without the vocabulary, which it would hold twice
        self.lib = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}))
        self.back = {ord(s): b for b, s in enumerate(symbols)}
        self.pieces = PieceCache(self.learn, KEPT_PIECES)
        self.texts = TEXTS

    # -- pre-tokens ------------------------------------------------------
    def split(self, segment: str) -> list[str]:
        if any(c in segment for c in "\x1c\x1d\x1e\x1f"):  # not white space to the tokenizer
            return [p for p in self.white(segment) if p]
        return segment.split()

    def words(self, piece: str) -> list[bytes]:
        """Pre-tokens of a piece without white space, as UTF-8."""
        if piece.isascii() or max(piece) < chr(LATIN_END):
            return [w.encode() for w in self.latin(piece.lower())]
        text = self.lib.normalizer.normalize_str(piece)
        mapped = [w for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(text)]
        return [bytes(self.back[ord(c)] for c in w) for w in mapped]

    # -- the index -------------------------------------------------------
    def apply_ranks(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each pre-token, unsigned 32-bit, little endian.

        The symbols of all pre-tokens stand in one chain, an edge after each. The
        index has all positions of each rank; a rank's positions merge together,
        and the pairs beside what they made enter the index.
        """
        if not words:
            return []
        size = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(size + 1) - size
        inside = np.ones(int(begin[-1] + size[-1] + 1), bool)
        inside[0] = inside[begin + size] = False
        sym = np.full(len(inside), self.edge, np.int64)
        sym[inside] = self.inner[np.frombuffer(b"".join(words), np.uint8)]
        ends = begin + size - 1
        sym[ends] = self.last[np.frombuffer(bytes(w[-1] for w in words), np.uint8)]
        nxt, prv = np.arange(1, len(sym) + 1), np.arange(-1, len(sym) - 1)
        where: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray, ranks: np.ndarray) -> None:
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cut = np.flatnonzero(np.diff(ranks, prepend=-1)).tolist()
            for r, lo, hi in zip(ranks[cut].tolist(), cut, [*cut[1:], len(at)]):
                if r in where:
                    where[r].append(at[lo:hi])
                else:
                    where[r] = [at[lo:hi]]
                    heappush(active, r)

        enter(np.arange(1, len(sym) - 1), self.ranks_of(sym[1:-1] * self.base + sym[2:]))
        while active:
            r = heappop(active)
            a, b, z = self.left[r], self.right[r], self.made[r]
            at = np.unique(np.concatenate(where.pop(r)))  # some may be gone by now
            at = at[sym[at] == a]
            q = nxt[at]
            at, q = at[sym[q] == b], q[sym[q] == b]
            if a == b:  # of symbols in a row every second one merges with the one after it, from the left
                at, q = self.every_second(at, q)
            if not len(at):
                continue
            after = nxt[q]
            sym[at], sym[q] = z, -1
            nxt[at], prv[after] = after, at
            before = prv[at]
            places = np.concatenate([before, at])
            enter(places, self.ranks_of(np.concatenate([sym[before] * self.base + z, z * self.base + sym[after]])))
        stays = inside & (sym >= 0)
        data = sym[stays].astype("<u4").tobytes()
        cut = np.concatenate([[0], np.cumsum(np.add.reduceat(stays, begin, dtype=np.int64) * 4)]).tolist()
        return [data[x:y] for x, y in zip(cut, cut[1:])]

    def ranks_of(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for none."""
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.key_ranks[place], -1)

    @staticmethod
    def every_second(at: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chained = np.flatnonzero(np.concatenate([[False], q[:-1] == at[1:]])) if len(at) else at
        if not len(chained):
            return at, q
        first = np.ones(len(at), bool)
        first[chained] = False
        place = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        return at[place % 2 == 0], q[place % 2 == 0]

    def learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, unsigned 32-bit, little endian; pre-tokens that several pieces share are merged once."""
        cut = [self.words(p) for p in pieces]
        distinct = list(dict.fromkeys(w for words in cut for w in words))
        ids = dict(zip(distinct, self.apply_ranks(distinct)))
        return [b"".join(map(ids.__getitem__, words)) if len(words) != 1 else ids[words[0]] for words in cut]

    # -- texts -----------------------------------------------------------
    def decode(self, ids) -> str:
        return " ".join([self.token[i] for i in ids if i in self.token])

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Ids (unsigned 32-bit, little endian) and the text decoded from them, of every text."""
        for lo in range(0, len(texts), self.texts):
            part, split, marks = texts[lo : lo + self.texts], [], []
            for t in part:
                segments = self.added_at.split(t) if self.added_at and any(a in t for a in self.added) else [t]
                split.append([p for s in segments[::2] for p in self.split(s)] if len(segments) > 1 else self.split(t))
                marks.append(segments if len(segments) > 1 else None)
            for values, m in zip(self.pieces.values_of(split), marks):
                if m:  # the added tokens between the segments
                    rest, values = iter(values), []
                    for k, s in enumerate(m):
                        if k % 2:
                            values.append(np.uint32(self.added[s]).tobytes())
                        else:
                            values.extend(next(rest) for _ in self.split(s))
                data = b"".join(values)
                yield data, self.decode(np.frombuffer(data, "<u4").tolist())


_CODERS: dict[str, PairIndexBPE] = {}


def coder(path: str, kept_pieces: int = KEPT_PIECES, texts: int = TEXTS) -> PairIndexBPE:
    if path not in _CODERS:
        _CODERS[path] = PairIndexBPE(path)
        give_back()
    _CODERS[path].pieces.limit, _CODERS[path].texts = kept_pieces, texts
    return _CODERS[path]


def encoded(docs: DataFrame, tokenizer_path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, ids, decoded of every text; one pass, no shuffle."""

    def run(batches):
        c = coder(tokenizer_path)
        for b in batches:
            ids, shown = [], []
            for data, text in c.encode([t or "" for t in b.column(1).to_pylist()]):
                ids.append(np.frombuffer(data, "<u4").astype(np.int64))
                shown.append(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int64())), pa.array(shown, pa.string())],
                ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(run, "doc_id long, ids array<long>, decoded string")


def encoding_digests(docs: DataFrame, tokenizer_path: str, id_col="doc_id", text_col="text",
                     kept_pieces: int = KEPT_PIECES, texts: int = TEXTS, forget: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text; repeated rows give a row each.

    ``kept_pieces``: of which a worker keeps the ids; ``texts``: whose new pieces it learns together. Both are
    for speed alone and take memory. ``forget``: a task drops
    vocabulary and pieces at its end, and the next one reads them again: for sessions that go on to other work.
    """

    def run(batches):
        give_back()
        try:
            yield from digests(batches)
        finally:
            if forget:
                _CODERS.clear()
                give_back()

    def digests(batches):
        c = coder(tokenizer_path, kept_pieces, texts)
        for b in batches:
            rows = [(len(data) // 4, hashlib.sha256(data).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
                    for data, text in c.encode([t or "" for t in b.column(1).to_pylist()])]
            n, x, y = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(x, pa.string()), pa.array(y, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
