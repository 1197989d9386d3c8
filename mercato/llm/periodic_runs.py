"""Runs of repeated words in texts, found online by dyadic square catchers.

A run is a maximal stretch of consecutive words with smallest period q (words q
apart are equal) that holds its period at least ``min_exponent`` (two or more)
times and at least ``min_length`` words.

:class:`SquareCatchers` reads a stream of words in appended blocks of any size,
down to one word. Every completed block of b = 2^k words, at a place divisible
by b, is a catcher for the periods 2b - 1 to 4b - 2: any square of such a period
has a whole such block in its first half, and the block's words stand again one
period later. So each new suffix of b words is compared with just two completed
blocks of each size, by fingerprints: that is the logarithmic work per appended
word. A suffix that matches its catcher gives a period and a place; comparing
suffixes to both sides (binary search over fingerprints) tells how far the
period holds, squares of one period that touch merge into one run, and a run
that reaches the last word stays open and grows with the next block. All words
of an appended block advance together in array operations.

Fingerprints are polynomials modulo the prime 2^61 - 1. Equal words have equal
fingerprints, so no run is missed for them; the words of every run found are
compared one by one in the end, and a stream in which two different stretches
shared a fingerprint is read again with another base.

On Spark this is one pass without a shuffle: a task reads its documents as one
stream in which a word of its own parts each text from the next, so no run
crosses texts. Streams are cut at text boundaries to about ``STREAM_WORDS``
words; only a longer single text makes a longer stream (about 100 bytes a word).

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text, or one of white space, has no
words and no runs. Rows that repeat give a row each, a null id stays null.
Other columns of the table, whatever their names, are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import mix, raw

STREAM_WORDS = 1 << 18
PRIME = (1 << 61) - 1
BASES = (0x1D8AF5C3B27E9641, 0x0B4F17D92C6E83A5, 0x15C93E70A86B2D4F, 0x03E8D1B6F7429CA7)
U = np.uint64
_P, _31, _30, _61 = U(PRIME), U(31), U(30), U(61)
_M31, _M30 = U((1 << 31) - 1), U((1 << 30) - 1)


def _mod(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it."""
    ah, al, bh, bl = a >> _31, a & _M31, b >> _31, b & _M31
    cross = al * bh + ah * bl
    return _mod((ah * bh << U(1)) + (cross >> _30) + ((cross & _M30) << _31) + al * bl)


def _minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(a >= b, a - b, a + (_P - b))


def _powers(base: int, first: int, n: int) -> np.ndarray:
    """base^first, base^(first + 1), ... modulo the prime."""
    out = np.array([pow(base, first, PRIME)], U)
    while len(out) < n:
        out = np.concatenate([out, _times(out, np.full(len(out), pow(base, len(out), PRIME), U))])
    return out[:n]


def _sums(terms: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Running sums modulo the prime, ``before`` added to each (fewer than 2^30 terms)."""
    high, low = np.cumsum(terms >> _31, dtype=U), np.cumsum(terms & _M31, dtype=U)
    return _mod(_mod(_times(_mod(high), np.full(len(high), 1 << 31, U)) + _mod(low)) + before)


class SquareCatchers:
    """Runs of a stream of words (as non-negative numbers), block after block.

    ``reach(b)``, where more is known of the stream than its length, says how
    many of its first words can hold runs of the level of block size b.
    """

    def __init__(self, min_exponent: int = 2, min_length: int = 2, reach: Callable[[int], int] | None = None,
                 base: int = BASES[0]):
        if min_exponent < 2:
            raise ValueError("a run holds its period twice at least")
        self.min_exponent, self.min_length, self.reach = min_exponent, min_length, reach
        self.base, self.inverse = base, pow(base, -1, PRIME)
        self.words = np.zeros(0, np.int64)
        self.sums = np.zeros(1, U)  # of word values times powers of the base
        self.back = np.ones(1, U)  # powers of the base's inverse
        self.seen: list[int] = []  # by level: the suffixes before it have met their catchers
        self.start, self.end, self.period = (np.zeros(0, np.int64) for _ in range(3))

    # -- fingerprints ----------------------------------------------------
    def _prints(self, i: np.ndarray | slice, j: np.ndarray | slice) -> np.ndarray:
        """Fingerprints of the words from i to before j."""
        return _times(_minus(self.sums[j], self.sums[i]), self.back[i])

    def _longest(self, most: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """By binary search, for each of the stretches the greatest length up to ``most`` that is the same."""
        low, high = np.zeros_like(most), most.copy()
        while (left := np.flatnonzero(low < high)).size:
            mid = (low[left] + high[left] + 1) >> 1
            ok = same(left, mid)
            low[left] = np.where(ok, mid, low[left])
            high[left] = np.where(ok, high[left], mid - 1)
        return low

    def _ahead(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How many words from ``at`` on equal those one period before."""
        def same(k, n):
            i, j = at[k], at[k] - period[k]
            return self._prints(i, i + n) == self._prints(j, j + n)

        return self._longest(len(self.words) - at, same)

    def _behind(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How many words before ``at`` equal those one period before."""
        def same(k, n):
            i, j = at[k], at[k] - period[k]
            return self._prints(i - n, i) == self._prints(j - n, j)

        return self._longest(at - period, same)

    # -- the stream ------------------------------------------------------
    def append(self, words: np.ndarray) -> None:
        old = len(self.words)
        if not len(words):
            return
        self.words = np.concatenate([self.words, np.asarray(words, np.int64)])
        n = len(self.words)
        values = _mod(mix(self.words[old:].astype(U) + U(1)))
        terms = _times(values, _powers(self.base, old, n - old))
        self.sums = np.concatenate([self.sums, _sums(terms, self.sums[-1])])
        self.back = np.concatenate([self.back, _powers(self.inverse, old + 1, n - old)])
        at, period = self._caught(n)
        grows = self.end == old  # open runs are compared anew from their last word
        self._merge(np.concatenate([at, self.end[grows] - 1]), np.concatenate([period, self.period[grows]]), ~grows)

    def _caught(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and periods at which new suffixes equal one of their two catchers' blocks."""
        places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for level in count():
            b = 1 << level
            limit = n if self.reach is None else min(n, self.reach(b))
            if self.min_exponent * (2 * b - 1) > limit:  # the level's least period does not fit often enough
                break
            if level == len(self.seen):
                self.seen.append(2 * b - 1)
            lo, hi = self.seen[level], limit - b + 1
            if hi <= lo:
                continue
            self.seen[level] = hi
            prints = self._prints(slice(lo, hi), slice(lo + b, hi + b))
            oldest = max((lo - (4 * b - 2)) >> level, 0)
            blocks = np.arange(oldest, (hi - 2 * b) // b + 1) * b
            caught = self._prints(blocks, blocks + b)
            newest = (np.arange(lo, hi) - (2 * b - 1)) >> level  # the last block 2b - 1 words before, or more
            for which in (newest, newest - 1):
                found = np.flatnonzero(prints == caught[np.maximum(which - oldest, 0)])
                found = found[which[found] >= 0]
                if found.size:
                    a, p = found + lo, found + lo - which[found] * b
                    order = np.lexsort((a, p))
                    a, p = a[order], p[order]
                    # touching matches of one period are one stretch: the first stands for it
                    lead = np.ones(len(a), bool)
                    lead[1:] = (p[1:] != p[:-1]) | (a[1:] - a[:-1] > b)
                    places.append(a[lead])
                    periods.append(p[lead])
        return np.concatenate(places), np.concatenate(periods)

    def _merge(self, at: np.ndarray, period: np.ndarray, closed: np.ndarray) -> None:
        """The stretches around the caught places, each once, join the closed runs."""
        start, end = at - self._behind(at, period) - period, at + self._ahead(at, period)
        # what holds no square yet stays only while it reaches the last word
        keep = (end - start >= 2 * period) | (end == len(self.words))
        new = np.stack([start[keep], end[keep], period[keep]])
        runs = np.unique(np.concatenate([new, np.stack([self.start, self.end, self.period])[:, closed]], axis=1), axis=1)
        start, end, period = runs
        # of one stretch the multiples of its least period tell nothing new
        first = np.ones(len(start), bool)
        first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        least = period[np.maximum.accumulate(np.where(first, np.arange(len(start)), 0))] if len(start) else period
        again = ~first & (period % np.maximum(least, 1) == 0) & (end - start >= 2 * least)
        self.start, self.end, self.period = start[~again], end[~again], period[~again]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """start, length, period of the runs so far, by start, then period."""
        length = self.end - self.start
        fits = length >= np.maximum(self.min_exponent * self.period, self.min_length)
        start, length, period = self.start[fits], length[fits], self.period[fits]
        # a stretch's least period comes first
        first = np.ones(len(start), bool)
        first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        start, length, period = start[first], length[first], period[first]
        for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()):
            if not np.array_equal(self.words[s + q : s + n], self.words[s : s + n - q]):
                raise ArithmeticError("two different stretches share a fingerprint")
        order = np.lexsort((period, start))
        return start[order], length[order], period[order]


def runs_of(texts: list[np.ndarray], min_exponent: int, min_length: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, the texts read as one stream."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))  # long ones first: fewer words to the high levels
    sizes = np.array([len(texts[k]) for k in order], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    top = max((int(t.max()) for t in texts if len(t)), default=0)
    stream = np.concatenate([x for j, k in enumerate(order) for x in (texts[k], [top + 1 + j])] or [np.zeros(0, np.int64)])

    def reach(b: int) -> int:
        long = int(np.searchsorted(-sizes, -min_exponent * (2 * b - 1), "right"))
        return int((sizes[:long] + 1).sum())

    for base in BASES:
        catchers = SquareCatchers(min_exponent, min_length, reach, base)
        catchers.append(stream)
        try:
            start, length, period = catchers.runs()
            break
        except ArithmeticError:
            if base == BASES[-1]:
                raise
    of = np.searchsorted(begin, start, "right") - 1
    for j, s, n, q in zip(of.tolist(), (start - begin[of]).tolist(), length.tolist(), period.tolist()):
        out[order[j]].append((s, n, q))
    return out


def streams(texts: list[bytes]) -> Iterator[tuple[list[list[bytes]], list[np.ndarray]]]:
    """Texts' words, and the same as numbers, some texts at a time."""
    part: list[list[bytes]] = []
    held = 0
    for k, t in enumerate(texts):
        part.append(t.split())  # bytes: at ASCII white space
        held += len(part[-1])
        if held >= STREAM_WORDS or k == len(texts) - 1:
            number = defaultdict(count().__next__)
            yield part, [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in part]
            part, held = [], 0


RESULT = "doc_id long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def periodic_runs(docs: DataFrame, min_exponent: int = 4, min_length: int = 6, id_col: str | Column = "doc_id",
                  text_col: str | Column = "text") -> DataFrame:
    """doc_id, runs (by start, then period) and the collapsed text of every row.

    The collapsed text drops each word that a run holds after the run's first
    period, the words left joined by one space.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            found, kept = [], []
            for words, numbers in streams(raw(batch.column(1))):
                for w, runs in zip(words, runs_of(numbers, min_exponent, min_length)):
                    if runs:
                        stays = np.ones(len(w), bool)
                        for start, length, period in runs:
                            stays[start + period : start + length] = False
                        w = compress(w, stays.tolist())
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    kept.append(b" ".join(w))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, kind), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "runs", "collapsed"])

    id_col, text_col = (F.col(c) if isinstance(c, str) else c for c in (id_col, text_col))
    return docs.select(id_col.cast("long").alias("doc_id"), text_col.alias("text")).mapInArrow(run, RESULT)


def run_digests(found: DataFrame) -> DataFrame:
    """Of a :func:`periodic_runs` result: the number of runs, the longest one, and digests of all runs and the text.

    The longest run is the one of greatest length, then smallest start, then period; no run gives four nulls.
    """
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.col3")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text: of the rows whose id has a checksum divisible by ten, the end of the text is made periodic.

    With h the CRC-32 of the decimal id, g = h / 10 and n words, each word from a = g % n on becomes the word
    a + (i - a) % p, where p = 1 + (n - a) / (3 + g % 8), whole quotients; the words are then joined by one space.
    Other rows, and those with a null id or without words, keep their text.
    """
    key = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(key / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))), " ")

    # as a lambda's variable the words are made once
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.when(key % 10 == 0, F.coalesce(text, F.col(text_col))).otherwise(F.col(text_col)).alias("text"))
