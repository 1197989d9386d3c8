"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The units are characters in n-grams of four, one model per language. Capitals count together,
and so do digits and kinds of white space, of every script; every other character
stands for itself. An n-gram is a number of four symbols of six bits and a text: a language's ``OWN``
commonest characters, counted over its trusted text, have a symbol each (0 stands before
the text), and a rarer one has the symbol ``OTHER`` and is named in the n-gram's
text ``rare``, in order. n-grams of own characters alone (``rare`` empty) are at most 64**4 in a
language and are looked up in tables handed to the tasks; those with a rarer character
are as many as there are, and beyond a bounded number are joined with the documents.

1. Training counts: the n-grams of all trusted documents (labelled quality 1),
   counted per task and summed. Lower orders count the different symbols that precede (continuation
   counts); three discounts per order and language come from the counts of
   counts.
2. Sharded count joins: the distinct n-grams of *all* documents, dealt by
   (language, n-gram), are joined with the four orders' counts and their contexts'
   statistics. This gives log10 p for every n-gram that occurs.
3. Those of own characters are handed to all tasks by blocks of languages within
   ``TABLE_ROWS``, and so are the ``KNOWN`` commonest with rarer characters. The rest, if
   there are any, are counted per different text and joined with
   their probabilities by a shuffle. The mean of all gives a document's
   perplexity, over its whole text. The model's documents are those it scores.
4. A document is kept if its perplexity is at most its language's threshold, set
   from quantiles of the perplexities of every fifth trusted document (by hash),
   which are left out of the counts (of a language with several trusted documents
   at least one is: the first by hash): ``SLACK`` times the ``TAIL`` quantile, but at
   most ``median + SPREAD * (upper quartile - median)``. A short text says
   little, so for thresholds and decisions its mean log probability counts
   together with ``PRIOR`` symbols of the median.

Null or empty texts, and texts in a language without trusted documents, have no
perplexity (null) and are kept. A null lang is a language of its own.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import drop_path, give_back, hand_out, scratch_path, small, stored, stored_at, strings

ORDER = 4
TAIL, SLACK, SPREAD = 0.995, 1.1, 80.0
PRIOR = 60
TABLE_ROWS = 1 << 22  # n-grams of a block of languages that are handed out at once
PLACES = 1 << 16  # what a language's index of contexts takes besides, counted as n-grams
OWN = 62  # characters of a language with a symbol of their own
OTHER = OWN + 1  # the symbol of the rarer ones, which an n-gram names besides
KNOWN = 1 << 19  # n-grams with rarer characters whose probabilities are handed out, 24 bytes each
NAMED = 200_000  # n-grams with rarer characters that a task holds before it hands them on
LOG_UNIT = 1e8  # their logarithms are summed as integers of this unit: exact in any order
PLANE = 1 << 16  # characters beyond it have the places of the surrogates, which no text holds, and no symbol
SURROGATES, OUTSIDE = 0xD800, 0x800


def _stands_for() -> np.ndarray:
    """The character that each of the first plane counts as."""
    out = np.arange(PLANE)
    for i in range(PLANE):
        kind = unicodedata.category(chr(i))
        if kind in ("Lu", "Lt"):
            out[i] = ord("A")
        elif kind == "Nd":
            out[i] = ord("0")
        elif kind in ("Zs", "Zl", "Zp", "Cc"):
            out[i] = ord("\n") if chr(i) in "\n\r" else ord(" ")
    return out


STANDS_FOR = _stands_for()
UTF32 = f"utf-32-{sys.byteorder[0]}e"


def points_of(text: str) -> np.ndarray:
    """Characters as numbers below ``PLANE``."""
    points = np.frombuffer(text.encode(UTF32), np.uint32)
    return np.where(points < PLANE, points, SURROGATES + points % OUTSIDE)


def characters_of(text: str) -> np.ndarray:
    """Characters as the numbers of those that they count as."""
    points = np.frombuffer(text.encode(UTF32), np.uint32)
    return np.where(points < PLANE, STANDS_FOR[np.minimum(points, PLANE - 1)], points).astype(np.uint32)


class Letters:
    """The symbols of a language: its commonest characters, then ``OTHER``. 0 stands before the text."""

    def __init__(self, own: list[int]):
        symbols = np.full(PLANE, OTHER, np.uint8)
        symbols[own] = np.arange(1, len(own) + 1)
        self.symbols = symbols[STANDS_FOR]
        self.ascii = self.symbols[:256].tobytes()

    def codes_of(self, text: str) -> np.ndarray:
        """One 24-bit number per character of the text: its n-gram."""
        own = text.encode().translate(self.ascii) if text.isascii() else self.symbols[points_of(text)].tobytes()
        s = np.frombuffer(b"\0" * (ORDER - 1) + own, np.uint8).astype(np.int32)
        n = len(s) - ORDER + 1
        out = np.zeros(n, np.int32)
        for j in range(ORDER):
            out = (out << 6) | s[j : j + n]
        return out

    def ngrams_of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The codes of the n-grams of own characters, and a row for each of the others: its code and,
        in its four places, the rarer characters (0 where there is none)."""
        codes = self.codes_of(text)
        other = (codes & 63) == OTHER
        if not other.any():
            return codes, np.zeros((0, ORDER + 1), np.uint32)
        named = np.pad(np.where(other, characters_of(text), 0), (ORDER - 1, 0))
        named = np.lib.stride_tricks.sliding_window_view(named, ORDER)
        held = named.any(axis=1)  # no character counts as number 0
        return codes[~held], np.column_stack([codes[held].astype(np.uint32), named[held].astype(np.uint32)])


def _whole(rows: np.ndarray) -> np.ndarray:
    """Each row of :meth:`Letters.ngrams_of` as one value."""
    return np.ascontiguousarray(rows, np.uint32).view(f"V{4 * (ORDER + 1)}").ravel()


def different(rows: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """code, rare and number of the different rows of :meth:`Letters.ngrams_of`."""
    whole, n = np.unique(_whole(rows), return_counts=True)
    rows = whole.view(np.uint32).reshape(-1, ORDER + 1)
    text = rows[:, 1:].tobytes().decode(UTF32)
    return rows[:, 0].astype(np.int32), [text[i : i + ORDER].replace("\0", "") for i in range(0, len(text), ORDER)], n


def _by_lang(b: pa.RecordBatch) -> dict:
    groups: dict = {}
    for lang, t in zip(b.column(0).to_pylist(), strings(b.column(1))):
        groups.setdefault(lang, []).append(t)
    return groups


def alphabets(docs: DataFrame) -> dict:
    """The :class:`Letters` of each language of ``docs`` (lang, text). The driver gets ``OWN`` numbers per language.

    The rarer characters are no part of it: an n-gram names them (see :meth:`Letters.ngrams_of`).
    """

    def run(batches):
        for b in batches:
            for lang, texts in _by_lang(b).items():
                n = sum(np.bincount(STANDS_FOR[points_of(t)], minlength=PLANE) for t in texts)
                point = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(point), pa.string()), pa.array(point, pa.int32()), pa.array(n[point], pa.int64())],
                    ["lang", "point", "n"])

    n = docs.select("lang", "text").mapInArrow(run, "lang string, point int, n long").groupBy("lang", "point").agg(F.sum("n").alias("n"))
    many = F.col("point").between(SURROGATES, SURROGATES + OUTSIDE - 1)  # several characters in one place: no symbol
    first = Window.partitionBy("lang").orderBy(many, F.desc("n"), "point")  # at most PLANE rows a language
    own: dict = {}
    for r in n.select("lang", "point", many.alias("many"), F.row_number().over(first).alias("at")).where(F.col("at") <= OWN).orderBy("at").collect():
        own.setdefault(r["lang"], []).extend([] if r["many"] else [r["point"]])
    return {lang: Letters(points) for lang, points in own.items()}


def ngram_counts(docs: DataFrame, letters) -> DataFrame:
    """lang, code, rare, n over ``docs`` (lang, text): counted per task, then summed. ``letters``: alphabets, broadcast."""

    def run(batches):
        of = letters.value
        for b in batches:
            for lang, texts in _by_lang(b).items():
                if lang in of:
                    own, rows = zip(*map(of[lang].ngrams_of, texts))
                    code, n = np.unique(np.concatenate(own), return_counts=True)
                    yield _ngrams(lang, code, [""] * len(code), n)
                    yield _ngrams(lang, *different(np.concatenate(rows)))
        give_back()

    part = docs.select("lang", "text").mapInArrow(run, "lang string, code int, rare string, n long")
    return part.groupBy("lang", "code", "rare").agg(F.sum("n").alias("n"))


def _ngrams(lang, code: np.ndarray, rare: list[str], n: np.ndarray | None = None) -> pa.RecordBatch:
    columns = {"lang": pa.array([lang] * len(code), pa.string()), "code": pa.array(code, pa.int32()), "rare": pa.array(rare, pa.string())}
    return pa.RecordBatch.from_pydict(columns if n is None else columns | {"n": pa.array(n, pa.int64())})


def distinct_ngrams(docs: DataFrame, letters) -> DataFrame:
    """lang, code, rare of every n-gram that occurs in the languages of ``letters`` (alphabets, broadcast), and
    ``held``: how often a task met it, once in a batch (with rarer characters) or once in all."""

    def run(batches):
        of, seen = letters.value, {}
        for b in batches:
            for lang, texts in _by_lang(b).items():
                if lang not in of:
                    continue
                if lang not in seen:
                    if len(seen) >= 6:  # bound the marks held
                        yield from flush(seen)
                    seen[lang] = np.zeros(1 << (6 * ORDER), bool)
                others = []
                for t in texts:
                    own, rows = of[lang].ngrams_of(t)
                    seen[lang][own] = True
                    others.append(rows)
                code, rare, _ = different(np.concatenate(others))
                yield _ngrams(lang, code, rare)
        yield from flush(seen)

    def flush(seen):
        for lang, marks in seen.items():
            code = np.flatnonzero(marks).astype(np.int32)
            yield _ngrams(lang, code, [""] * len(code))
        seen.clear()
        give_back()

    met = docs.select("lang", "text").mapInArrow(run, "lang string, code int, rare string")
    return met.groupBy("lang", "code", "rare").agg(F.count("*").alias("held"))


def _same(left: str, right: str, *names: str) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return out


def _last(n: int, k: int) -> tuple[Column, Column]:
    """code and rare of the last ``k`` symbols of an n-gram of ``n``."""
    code, rare = F.col("code"), F.col("rare")
    before = sum((F.shiftright(code, 6 * j).bitwiseAND(63) == OTHER).cast("int") for j in range(k, n)) if k < n else F.lit(0)
    return code.bitwiseAND((1 << (6 * k)) - 1), F.when(rare == "", rare).otherwise(F.substring(rare, before + 1, F.lit(ORDER)))


def _head(code: Column, rare: Column) -> tuple[Column, Column]:
    """code and rare of an n-gram without its last symbol."""
    shorter = F.substring(rare, F.lit(1), F.length(rare) - 1)
    return F.shiftright(code, 6), F.when(code.bitwiseAND(63) == OTHER, shorter).otherwise(rare)


def in_turn(spark, name: str):
    """A writer of tables of which each replaces the one before: written from it, it is all that is read."""
    paths: list[str] = []

    def write(df: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, name))
        out = stored_at(df, paths[-1])
        for path in paths[-2:-1]:
            drop_path(spark, path)
        return out

    return write


def kneser_ney(counts: DataFrame, wanted: DataFrame, write=lambda df: df) -> DataFrame:
    """lang, code, rare, p and the further columns of every wanted n-gram in a language that has counts.

    Below the single characters stands an even share of each: of 64 symbols, or of the start, the language's
    characters and an unknown one where these are more. Characters that were not learnt are the unknown one.
    ``write`` takes each order's probabilities before the next one's joins: with :func:`in_turn`, a plan holds the joins of one order.
    """
    # each order is read several times: written once, its counts are no part of the plan of the joins
    levels = {ORDER: stored(counts, "ngram-counts")}
    for k in range(ORDER - 1, 0, -1):
        # how many different symbols stand before the shorter n-gram
        code, rare = _last(k + 1, k)
        low = levels[k + 1].select("lang", code.alias("code"), rare.alias("rare"))
        levels[k] = stored(low.groupBy("lang", "code", "rare").agg(F.count("*").alias("n")), "ngram-counts")

    sizes = levels[1].groupBy("lang").agg((1.0 / F.greatest(F.lit(64), F.count("*") + 2)).alias("p"))
    kept = [c for c in wanted.columns if c not in ("lang", "code", "rare")]
    of_q = ["q.lang", "q.code", "q.rare", *(f"q.{c}" for c in kept)]
    out = wanted.alias("q").join(F.broadcast(sizes).alias("t"), _same("q", "t", "lang")).select(*of_q, "t.p")
    for k in range(1, ORDER + 1):
        of = levels[k]
        c = [F.count(F.when(F.col("n") == j, 1)).alias(f"n{j}") for j in (1, 2, 3, 4)]
        d = of.groupBy("lang").agg(*c).select("lang", "n1", "n2", "n3", "n4", F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")).alias("y"))
        known = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
        disc = [F.when(known, F.greatest(F.lit(0.05), F.least(F.lit(j - 0.05), j - (j + 1) * F.col("y") * F.col(f"n{j + 1}") / F.col(f"n{j}"))))
                .otherwise(0.5 * j).alias(f"d{j}") for j in (1, 2, 3)]
        d = d.select("lang", *disc)
        of = of.alias("c").join(F.broadcast(d).alias("d"), _same("c", "d", "lang")).select(
            "c.lang", "c.code", "c.rare", "n", F.expr("CASE WHEN n = 1 THEN d1 WHEN n = 2 THEN d2 ELSE d3 END").alias("cut"))
        head, head_rare = _head(F.col("code"), F.col("rare"))
        ctx = of.groupBy("lang", head.alias("head"), head_rare.alias("head_rare")).agg(
            F.sum("n").alias("all"), F.sum("cut").alias("freed"))
        own, own_rare = _last(ORDER, k)
        q = out.select("lang", "code", "rare", *kept, "p", own.alias("own"), own_rare.alias("own_rare"))
        head, head_rare = _head(F.col("own"), F.col("own_rare"))
        q = q.withColumns({"head": head, "head_rare": head_rare})
        q = q.alias("q").join(ctx.alias("x"), _same("q", "x", "lang", "head", "head_rare"), "left").select(
            *of_q, "q.p", "q.own", "q.own_rare", "x.all", "x.freed")
        of = of.withColumnsRenamed({"code": "own", "rare": "own_rare"})
        q = q.alias("q").join(of.alias("c"), _same("q", "c", "lang", "own", "own_rare"), "left").select(
            *of_q, "q.p", "q.all", "q.freed", "c.n", "c.cut")
        out = write(q.select("lang", "code", "rare", *kept, F.when(F.col("all").isNull(), F.col("p")).otherwise(
            (F.coalesce(F.col("n") - F.col("cut"), F.lit(0.0)) + F.col("freed") * F.col("p")) / F.col("all")).alias("p")))
    return out


class Known:
    """log10 p of the commonest n-grams with rarer characters. ``rows``: lang, code, rare, log10 p in ``LOG_UNIT``."""

    def __init__(self, rows: pa.Table):
        code = rows["code"].to_numpy()
        places = (code[:, None] >> np.arange(6 * (ORDER - 1), -1, -6)) & 63
        named = np.zeros((len(code), ORDER + 1), np.uint32)
        named[:, 0] = code
        named[:, 1:][places == OTHER] = np.frombuffer("".join(rows["rare"].to_pylist()).encode(UTF32), np.uint32)
        langs = rows["lang"].combine_chunks().dictionary_encode(null_encoding="encode")
        which, whole, logs = langs.indices.to_numpy(), _whole(named), rows["log"].to_numpy()
        self.tables = {}
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            at = np.flatnonzero(which == i)
            at = at[np.argsort(whole[at])]
            self.tables[lang] = whole[at], (logs[at] / LOG_UNIT).astype(np.float32)

    def split(self, lang, rows: np.ndarray) -> tuple[float, np.ndarray]:
        """The sum over those of ``rows`` (:meth:`Letters.ngrams_of`) that are known, and the other rows."""
        if lang not in self.tables:
            return 0.0, rows
        whole, logs = self.tables[lang]
        wanted = _whole(rows)
        at = np.minimum(np.searchsorted(whole, wanted), len(whole) - 1)
        found = whole[at] == wanted
        return float(logs[at[found]].sum(dtype=np.float64)), rows[~found]


class Perplexity:
    """log10 p of n-grams of own characters in ``langs``, as rows of 64 symbols per context. ``rows``: lang, code, log10 p."""

    def __init__(self, rows: pa.Table, langs: list, letters: dict):
        rows = rows.combine_chunks()
        found = rows["lang"].combine_chunks().dictionary_encode(null_encoding="encode")
        code, logs, which = rows["code"].to_numpy(), rows["p"].to_numpy(), found.indices.to_numpy()
        place_of = {lang: i for i, lang in enumerate(found.dictionary.to_pylist())}
        self.tables = {}
        for lang in langs:
            i = place_of.get(lang, -1)  # a language may have n-grams with rarer characters alone
            mine = code[which == i]
            head, at = np.unique(mine >> 6, return_inverse=True)
            place = np.full(1 << (6 * (ORDER - 1)), len(head), np.int32)
            place[head] = np.arange(len(head))
            table = np.full((len(head) + 1) * 64, np.nan, np.float32)
            table[at * 64 + (mine & 63)] = logs[which == i]
            self.tables[lang] = letters[lang], place, table

    def of(self, lang, text: str, known: Known) -> float | None:
        """The sum over the text's n-grams of own characters and the ``known`` ones."""
        if lang not in self.tables or not text:
            return None
        letters, place, table = self.tables[lang]
        code, rows = letters.ngrams_of(text)
        own = float(table[place[code >> 6].astype(np.int64) * 64 + (code & 63)].sum(dtype=np.float64))
        return own + known.split(lang, rows)[0] if len(rows) else own


class QualityModel:
    """The probabilities, those of own characters in blocks of languages of bounded size, and the thresholds.

    ``docs`` hold every text that is scored later.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, tail: float = TAIL, slack: float = SLACK,
                 spread: float = SPREAD, block_rows: int = TABLE_ROWS, known_rows: int = KNOWN):
        spark = docs.sparkSession
        ok = (labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
              .where("quality = 1").select("doc_id"))
        ok = stored(ok, "trusted")
        trusted = docs.where("text <> ''").select("doc_id", "lang", "text").join(small(ok, ok.count(), 16), "doc_id", "left_semi")
        place = F.xxhash64("doc_id", F.lit(5))
        fifth = F.pmod(place, F.lit(5)) == 0
        # languages of several trusted documents without one in the fifth: their first by hash stands apart
        few = (trusted.groupBy("lang").agg(F.max(fifth).alias("some"), F.min(place).alias("least"), F.max(place).alias("most"))
               .where("NOT some AND least < most").collect())
        apart = fifth | F.coalesce(place == self._of({r["lang"]: r["least"] for r in few}, F.col("lang"), "long"), F.lit(False))
        learnt = trusted.where(~apart)
        letters = alphabets(learnt)
        self.letters = hand_out(spark, letters)
        table = kneser_ney(ngram_counts(learnt, self.letters), distinct_ngrams(docs, self.letters), in_turn(spark, "ngram-p"))
        own = F.count(F.when(F.col("rare") == "", 1))
        sizes = [(r["lang"], r["n"]) for r in table.groupBy("lang").agg(own.alias("n")).orderBy("lang").collect()]
        rare = table.where("rare <> ''").select(
            "lang", "code", "rare", F.round(F.log10("p") * LOG_UNIT).cast("long").alias("log"), F.least("held", F.lit(10_000)).alias("held"))
        least, room = 10_001, known_rows  # handed out from this number of meetings on
        for r in rare.groupBy("held").agg(F.count("*").alias("n")).orderBy(F.desc("held")).collect():
            room -= r["n"]
            if room < 0:
                break
            least = r["held"]
        self.known = hand_out(spark, Known(rare.where(F.col("held") >= least).toArrow()))
        self.rare = rare.where(F.col("held") < least)
        self.rare_langs = [r["lang"] for r in self.rare.select("lang").distinct().collect()]
        blocks, room = [], 0
        for lang, n in sizes:
            if not blocks or n > room:
                blocks.append([])
                room = block_rows
            blocks[-1].append(lang)
            room -= n + PLACES
        self.blocks = []
        for langs in blocks:
            rows = table.where(_one_of(F.col("lang"), langs)).where("rare = ''").select("lang", "code", F.log10("p").cast("float").alias("p"))
            self.blocks.append((langs, hand_out(spark, Perplexity(rows.toArrow(), langs, letters))))
        lang = F.col("lang")
        held, x = self.scored(trusted.where(apart).select("lang", "text"))
        held = stored(held.select("lang", F.length("text").alias("n"), x.alias("x")).where("x IS NOT NULL"), "held-out")
        self.medians = {r["lang"]: r["q"] for r in held.groupBy("lang").agg(F.percentile("x", 0.5).alias("q")).collect()}
        shrunk = held.select("lang", self._shrunk(lang, F.col("n"), F.col("x")).alias("x"))
        cuts = F.percentile("x", F.array(F.lit(0.5), F.lit(0.75), F.lit(tail)))
        self.thresholds = {}
        for r in shrunk.groupBy("lang").agg(cuts.alias("q")).collect():  # a row per trusted language
            half, upper, last = r["q"]
            self.thresholds[r["lang"]] = max(upper, min(slack * last, half + spread * (upper - half)))

    def scored(self, docs: DataFrame) -> tuple[DataFrame, Column]:
        """``docs`` (lang, text and any other columns), and the perplexity as a column over the frame returned,
        which may have two columns more. Take those of ``docs`` from it by name or as ``docs[name]``."""
        lang, text = docs["lang"], docs["text"]
        logs = F.lit(None).cast("double")
        for langs, held in self.blocks:
            mine = _log_udf(held, self.known)(lang, text)
            logs = F.when(_one_of(lang, langs), mine).otherwise(logs) if len(self.blocks) > 1 else mine
        if self.rare_langs:
            rest = stored(self._rare_logs(docs), "rare-logs")
            key, rest = rest["_quality_text"], small(rest, rest.count(), 100)
            docs = docs.join(rest, _text_key(lang, text) == key, "left")
            logs = logs + F.coalesce(F.col("_quality_log").cast("double") / LOG_UNIT, F.lit(0.0))
        return docs, F.pow(F.lit(10.0), -logs / F.length(text))

    def _rare_logs(self, docs: DataFrame) -> DataFrame:
        """``_quality_text`` (key), ``_quality_log``: the sum over the n-grams that are not handed out, of each different text that holds any."""
        letters, known = self.letters, self.known

        def together(parts):
            if parts:
                t = pa.Table.from_batches([part for _, part in parts])
                keys = pa.array([key for key, part in parts for _ in range(len(part))], pa.binary())
                yield from t.append_column("key", keys).combine_chunks().to_batches()

        def run(batches):
            of = letters.value
            for b in batches:
                parts, held = [], 0
                for key, lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strings(b.column(2))):
                    rows = of[lang].ngrams_of(text)[1] if lang in of else ()
                    rows = known.value.split(lang, rows)[1] if len(rows) else rows
                    if len(rows):
                        parts.append((key, _ngrams(lang, *different(rows))))
                        held += len(parts[-1][1])
                    if held > NAMED:
                        yield from together(parts)
                        parts, held = [], 0
                yield from together(parts)
            give_back()

        texts = docs.where((docs["text"] != "") & _one_of(docs["lang"], self.rare_langs))
        each = texts.select(_text_key(docs["lang"], docs["text"]), docs["lang"], docs["text"]).mapInArrow(
            run, "lang string, code int, rare string, n long, key binary")
        each = each.groupBy("key", "lang", "code", "rare").agg(F.max("n").alias("n"))  # copies of a text have the same
        each = each.alias("q").join(self.rare.alias("p"), _same("q", "p", "lang", "code", "rare"))
        return each.groupBy(F.col("q.key").alias("_quality_text")).agg(
            F.sum(F.col("q.n") * F.col("p.log")).alias("_quality_log"))

    @staticmethod
    def _of(values: dict, lang: Column, kind: str = "double") -> Column:
        out = F.lit(None).cast(kind)
        for x, v in values.items():
            out = F.when(lang.isNull() if x is None else lang == x, F.lit(v)).otherwise(out)
        return out

    def threshold(self, lang: Column) -> Column:
        return self._of(self.thresholds, lang)

    def _shrunk(self, lang: Column, n: Column, perplexity: Column) -> Column:
        prior = F.log10(self._of(self.medians, lang))
        return F.pow(F.lit(10.0), (n * F.log10(perplexity) + PRIOR * prior) / (n + PRIOR))

    def keeps(self, lang: Column, text: Column, perplexity: Column) -> Column:
        """The decision; texts without a perplexity or a threshold are kept."""
        return F.coalesce(self._shrunk(lang, F.length(text), perplexity) <= self.threshold(lang), F.lit(True))


def _one_of(lang: Column, langs: list) -> Column:
    some = [x for x in langs if x is not None]
    return F.coalesce(lang.isin(some), F.lit(False)) | (lang.isNull() if None in langs else F.lit(False))


def _text_key(lang: Column, text: Column) -> Column:
    """A language and a text as one digest of 128 bits; null without a text."""
    name = F.coalesce(F.concat(F.length(lang).cast("string"), F.lit(":"), lang), F.lit("-"))  # apart for any language
    return F.unhex(F.substring(F.sha2(F.concat(name, text), 256), 1, 32))


def _log_udf(held, known):
    @F.arrow_udf("double")
    def logs(langs: pa.Array, texts: pa.Array) -> pa.Array:
        p, rare = held.value, known.value
        return pa.array([p.of(lang, t, rare) for lang, t in zip(langs.to_pylist(), strings(texts))], pa.float64())

    return logs


def quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, perplexity, threshold, kept of every document."""
    lang, text = F.col("lang"), F.col("text")
    out, x = model.scored(docs.select("doc_id", "lang", "text"))
    out = out.select("doc_id", "lang", "text", x.alias("perplexity"))
    return out.select("doc_id", "perplexity", model.threshold(lang).alias("threshold"),
                      model.keeps(lang, text, F.col("perplexity")).alias("kept"))


def without_low_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept."""
    out, x = model.scored(docs)
    return out.where(model.keeps(docs["lang"], docs["text"], x)).drop("_quality_text", "_quality_log")
