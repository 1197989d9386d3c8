"""Benchmark decontamination by a prefix-filtered containment join.

Words are runs of ``[0-9a-z]`` and characters beyond ASCII, A-Z in lower case.
A window is ``width`` consecutive words of an item (a shorter item is one
window). A window occurs in a document only if all of its shingles (its words)
do, so for containment 1 the necessary prefix is its first shingle in a global
order: the one that is rarest over all documents. Documents join windows on that
one token; the position it has in the window gives the only place where the
window can stand, which must lie inside the document (positional and length
bounds); the words there are then compared one by one.

Two passes over the documents, no shuffle of texts: counts of the items' words
(combined before their shuffle), then the join. Items are held in blocks of
bounded size; a benchmark beyond one block is joined block by block, each
pass adding to the table the one before has written.

A null or empty text has no words and no hits; items without words have no
window; a null item_id is listed as the empty string. Repeated documents give a
row each, repeated items count once by their id.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import hand_out, raw, stored

WIDTH = 10
#: Bytes of item texts held at once.
BLOCK_BYTES = 16 << 20

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Lower-cases A-Z; what is in no word becomes a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))

_COLUMNS = "doc_id long, text string, n_words long, spans array<long>, items array<string>"


def item_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _windows(rows, width: int) -> dict[tuple, set[str]]:
    """Window -> ids of the items that hold it."""
    out: dict[tuple, set[str]] = {}
    for r in rows:
        w = item_words((r["text"] or "").encode())
        for i in range(max(1, len(w) - width + 1) if w else 0):
            out.setdefault(tuple(w[i : i + width]), set()).add("" if r["item_id"] is None else str(r["item_id"]))
    return out


def _word_counts(docs: DataFrame, text_col: str, words: set[bytes]) -> dict[bytes, int]:
    """How often each of a bounded set of words occurs in all documents."""
    held = hand_out(docs.sparkSession, frozenset(words))

    def count(batches):
        known = held.value.__contains__
        c: Counter = Counter()
        for b in batches:
            for t in raw(b.column(0)):
                c.update(filter(known, item_words(t)))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(c), pa.binary()), "n": pa.array(list(c.values()), pa.int64())})

    part = docs.select(text_col).mapInArrow(count, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in part.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _index(rarity: dict[bytes, int], windows: dict[tuple, set[str]]) -> dict[bytes, list]:
    """Prefix word -> (its place in the window, the window's words, ids of the items)."""
    index: dict[bytes, list] = {}
    for w, items in windows.items():
        if all(x in rarity for x in w):  # else some word is in no document
            at = min(range(len(w)), key=lambda i: (rarity[w[i]], w[i], i))
            index.setdefault(w[at], []).append((at, list(w), sorted(items)))
    return index


def matches(words: list[bytes], prefix: dict[bytes, list]):
    """(first, end, item ids) of every window that occurs."""
    n = len(words)
    for p in [i for i, w in enumerate(words) if w in prefix]:
        for at, window, ids in prefix[words[p]]:
            lo = p - at
            hi = lo + len(window)
            if lo >= 0 and hi <= n and words[lo:hi] == window:
                yield lo, hi, ids


def _blocks(docs: DataFrame, benchmark: DataFrame, width: int, block_bytes: int, text_col: str):
    """The prefix index of each block of items, handed to all tasks."""
    bench = benchmark.select("item_id", "text")
    size = bench.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        windows = _windows(part.collect(), width)  # one block of bounded size
        rarity = _word_counts(docs, text_col, {x for w in windows for x in w})
        yield k + 1 == blocks, hand_out(docs.sparkSession, _index(rarity, windows))


def _join_block(rows: DataFrame, held) -> DataFrame:
    """Add one block's hits to (doc_id, text, n_words, spans, items)."""

    def join(batches):
        for b in batches:
            n_words, all_spans, all_items = [], [], []
            for t, spans, items in zip(raw(b.column(1)), b.column(3).to_pylist(), b.column(4).to_pylist()):
                words = item_words(t)
                items, spans = set(items), set(zip(spans[::2], spans[1::2]))
                for lo, hi, ids in matches(words, held.value):
                    spans.add((lo, hi))
                    items.update(ids)
                n_words.append(len(words))
                all_spans.append([x for s in sorted(spans) for x in s])
                all_items.append(sorted(items))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(all_spans, pa.list_(pa.int64())),
                 pa.array(all_items, pa.list_(pa.string()))], ["doc_id", "text", "n_words", "spans", "items"])

    return rows.mapInArrow(join, _COLUMNS)


def occurrences(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
                id_col="doc_id", text_col="text") -> DataFrame:
    """Per document: doc_id, text, n_words, spans (flat list of first, end word) and items of windows that occur."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("spans"),
                       F.array().cast("array<string>").alias("items"))
    for last, held in _blocks(docs, benchmark, width, block_bytes, text_col):
        rows = _join_block(rows, held)
        if not last:
            rows = stored(rows, "decontam")
    return rows


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
                         text_col="text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no window occurs."""
    out = docs
    for _, held in _blocks(docs, benchmark, width, block_bytes, text_col):
        out = out.where(_clean(held)(F.col(text_col)))
    return out


def _clean(held):
    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([next(matches(item_words(t), held.value), None) is None for t in raw(texts)], pa.bool_())

    return clean


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, **kw) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""

    def digest(batches):
        for b in batches:
            hits, shas, sizes = [], [], []
            for spans, items in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                hits.append(len({i for lo, hi in zip(spans[::2], spans[1::2]) for i in range(lo, hi)}))
                sizes.append(len(items))
                shas.append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(hits, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"])

    found = occurrences(docs, benchmark, width, **kw).select("doc_id", "n_words", "spans", "items")
    out = found.mapInArrow(digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string")
    return out.withColumn("contaminated", F.col("n_hit") > 0)
