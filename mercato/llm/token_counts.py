"""Token counts by prefix dynamic programming (sentencepiece BPE).

The tokenizer merges the adjacent pair whose join has the best score, leftmost
first. For such merges the last token of every prefix is unique: it is the one
vocabulary token ``t`` ending there that the merges leave whole right after
the last token ``s`` of the prefix before it (``s + t`` encodes to ``[s, t]``).
So one pass gives ``count[i] = count[i - len(t)] + cost(t)``, the exact count of
*every* prefix, and truncation or budget questions need no further encoding.

No piece of the vocabulary goes on past a letter into a space mark, so
merges never cross from one unit (a run of space marks and what follows) to
the next, and a text's table is its units' tables, one on top of the other.
Units recur; each is worked out once a worker (a bounded cache).

A character outside the vocabulary counts its UTF-8 bytes (byte fallback). A
null text is an empty text (0 tokens); strings that look like control
tokens are ordinary text, as the library has it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import PieceCache

SPACE = "▁"  # fixed value: the space mark of the vocabulary
LIMIT = 4096
KEPT_UNITS = 700_000  # whose counts a worker keeps, about 160 bytes each, in two generations


class PrefixCounter:
    """Exact token counts of all prefixes of a text."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in ids}
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("a piece goes on from a letter into a space mark: units can't be told apart")
        import ahocorasick

        pieces = ahocorasick.Automaton()
        for p in self.rank:
            pieces.add_word(p, p)
        pieces.make_automaton()
        self.pieces_in = pieces.iter  # by their ends, of one end the longest first
        self.pairs: dict[tuple[str, str], bool] = {}
        self.counts = PieceCache(lambda units: [self.table(u)[-1] for u in units], KEPT_UNITS)
        self.units = re.compile(f"{SPACE}*[^{SPACE}]*").findall

    def merged(self, text: str) -> list[str]:
        """The tokens of a short string by merging, best score first and leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, s: str, t: str) -> bool:
        """Do the merges leave ``t`` whole right after ``s`` (after nothing, if ``s`` is empty)?"""
        if len(self.pairs) > 400_000:
            self.pairs.clear()
        got = self.pairs[s, t] = self.merged(s + t) == ([s, t] if s else [t])
        return got

    def table(self, unit: str) -> list[int]:
        """``table[i]``: tokens of ``unit[:i]``, for every i.

        One token ends each prefix, the one that the merges leave whole after the
        last token of what stands before it; it is looked for among the pieces
        that end there, longest first.
        """
        n, pairs = len(unit), self.pairs.get
        count, last = [0] + [-1] * n, [""] * (n + 1)
        at = 1
        for end, t in self.pieces_in(unit):
            i = end + 1
            if count[i] >= 0:
                continue
            while at < i:
                if count[at] < 0:
                    self.spell(unit, count, last, at)
                at += 1
            j = i - len(t)
            ok = pairs((last[j], t))
            if ok is None:
                ok = self.follows(last[j], t)
            if ok:
                count[i], last[i] = count[j] + 1, t
        for i in range(at, n + 1):
            if count[i] < 0:
                self.spell(unit, count, last, i)
        return count

    def spell(self, unit: str, count: list[int], last: list[str], i: int) -> None:
        """The prefix of i characters, which no piece ends: its last character is as many tokens as bytes."""
        count[i], last[i] = count[i - 1] + len(unit[i - 1].encode()), unit[i - 1]

    def split(self, text: str) -> list[str]:
        """The units of a text as the library sees it: a mark before it, each space a mark."""
        if not text:
            return []
        if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            units = text.split(" ")
            return [SPACE + u for u in units]
        return [u for u in self.units(SPACE + text.replace(" ", SPACE)) if u]

    def totals(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        for lo in range(0, len(texts), 512):
            units = [self.split(t) for t in texts[lo : lo + 512]]
            out.extend(map(sum, self.counts.values_of(units)))
        return out

    def prefix_table(self, text: str) -> np.ndarray:
        """``table[i]``: tokens of ``text[:i]``, for every i from 0 to its length."""
        out, total = [0], 0
        for unit in self.split(text):
            t = self.table(unit)
            out.extend(total + c for c in t[1:])
            total += t[-1]
        # out counts the mark put before the text too
        return np.array([0, *out[2:]] if text else [0], np.int64)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model: str) -> PrefixCounter:
    if model not in _COUNTERS:
        _COUNTERS[model] = PrefixCounter(model)
    return _COUNTERS[model]


def longest_prefix(table: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens (counts may fall as a prefix grows)."""
    fit = np.flatnonzero(table <= budget)
    return int(fit[-1]) if len(fit) else 0


def prefix_tables(docs: DataFrame, model: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, counts: the exact token count of every prefix of every text (index: characters)."""

    def run(batches):
        c = counter(model)
        for b in batches:
            tables = [c.prefix_table(t or "").tolist() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(tables, pa.list_(pa.int64()))],
                                             ["doc_id", "counts"])

    rows = docs.select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(run, "doc_id long, counts array<long>")


def truncated(docs: DataFrame, model: str, budget: int, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, text, n_tokens: each text cut to its longest prefix of at most ``budget`` tokens."""

    def run(batches):
        c = counter(model)
        for b in batches:
            texts, counts = [], []
            for t in b.column(1).to_pylist():
                table = c.prefix_table(t or "")
                k = longest_prefix(table, budget)
                texts.append(None if t is None else t[:k])
                counts.append(int(table[k]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                ["doc_id", "text", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(run, "doc_id long, text string, n_tokens long")


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text: the last entry of its prefix table.

    One pass without a shuffle; repeated rows and rows without an id give a row each.
    """

    def run(batches):
        c = counter(model)
        for b in batches:
            counts = c.totals([t or "" for t in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"), text_col)
    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
