"""Phrase collocations, counted over a prefix-free parse of the texts.

The parse cuts a text's words wherever the hash of two neighbouring words is
divisible by ``PERIOD``. That depends on the words alone, so copied passages are cut
into the same chunks wherever they stand. Each chunk goes on over the two words
that close it, and the next begins with them: no chunk is a proper prefix of
another, and every phrase of up to three words lies whole in the chunk in which
it starts. The distinct chunks are the dictionary, with their numbers of
occurrences as parse frequencies (combined per task before the shuffle). Phrases are
then counted once in each distinct chunk, weighted with its frequency; those that
start in the two closing words are left to the next chunk, so an overlap is counted
once. A text ends with two separators, which close its last chunk.

Counting: tasks sort the phrases of a block of chunks as packed word numbers and
send each phrase and its sum once, packed by hash bucket of the whole phrase (with its language);
a bucket adds up its phrases and keeps those with ``min_count`` occurrences at least (a
phrase has no more occurrences than any part of it). A frequent phrase is one row
a block, so none is hot. Buckets grow in number with the text. What is left
goes through joins on phrases and through an exact ranking in a range-partitioned
sort (:func:`~mercato.operators.ranking.numbered`).

Texts are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at spaces and tabs into
words, A-Z lower-cased; phrases lie within pieces. All is per language; a null
language counts as ``und``. A null or empty text has no words. Rows that repeat
count each time. Ids and other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import give_back, mix, raw, small, stored
from mercato.operators.ranking import numbered

PERIOD = 16  # words a chunk has on average before it closes
WORDS = 3  # of the longest phrase
OVERLAP = WORDS - 1
BLOCK_TOKENS = 1 << 20  # whose phrases are combined at once; below 2**21, so that three word numbers fit 63 bits
BATCH_PHRASES = 1 << 17  # that are written out as text at once
TEXT_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20  # of text for a bucket
LEAST_BUCKETS = 64
SEPARATORS = b".,;:!?\n\x0b\x0c\r"  # fixed values
LOWER = bytes(ord(".") if b in SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
WEIGHTS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def word_numbers(texts: pa.Array, split=lambda t: pc.split_pattern(t, " ")) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where the words of each text begin among all, and all words as numbers of the distinct words."""
    lists = split(texts)
    coded = lists.flatten().dictionary_encode()
    begin = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return begin, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def hashes_of(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_numpy(zero_copy_only=False)), np.uint64, len(words))


def chunks_of(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """The chunks of the texts' parses, and the number of the text that each one is of."""
    closed = [(t.translate(LOWER).replace(b".", b" . ") + OVERLAP * b" .").strip() for t in texts]
    closed = pa.array(closed, pa.binary()).cast(pa.string())
    begin, ids, words = word_numbers(closed, pc.ascii_split_whitespace)
    h = hashes_of(words)[ids]
    cut = np.zeros(len(ids) + 1, bool)
    cut[: len(ids) - 1] = mix(h[:-1] * WEIGHTS[0] + h[1:]) % np.uint64(PERIOD) == 0
    for back in range(1, OVERLAP + 1):  # nothing starts in the closing separators
        cut[begin[1:] - back] = False
    cut[begin] = True  # the last is the end of all
    starts = np.flatnonzero(cut)
    starts, until = starts[:-1], starts[1:]
    ends = np.where(np.isin(until, begin), until, until + OVERLAP)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    places = np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.take(pa.array(ids[places])))
    return np.searchsorted(begin, starts, "right") - 1, pc.binary_join(lists, " ")


def dictionary(docs: DataFrame, lang: str | Column = "lang", text: str | Column = "text") -> DataFrame:
    """lang, chunk, n: the distinct chunks and their parse frequencies."""

    def run(batches):
        for batch in batches:
            langs, texts = batch.column(0), raw(batch.column(1))
            size = np.cumsum([0, *map(len, texts)])
            first = 0
            while first < len(texts):  # some texts, or one long one, at a time
                stop = max(first + 1, int(np.searchsorted(size, size[first] + TEXT_BYTES)))
                of, chunks = chunks_of(texts[first:stop])
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(of + first)), chunks], ["lang", "chunk"])
                first = stop
        give_back()

    lang, text = (F.col(c) if isinstance(c, str) else c for c in (lang, text))
    rows = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), text.alias("text")).where("text <> ''")
    return rows.mapInArrow(run, "lang string, chunk string").groupBy("lang", "chunk").agg(F.count("*").alias("n"))


def phrases_in(lang: str, chunks: pa.Array, times: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Each phrase of a block of distinct chunks once with its occurrences: a row (lang, bucket, phrases, times) a bucket.

    The phrases are numbers until their batch of about ``BATCH_PHRASES`` is made.
    """
    begin, ids, words = word_numbers(chunks)
    if len(words) >= 1 << 21:
        raise ValueError("too many words in a block")
    by_word = pc.array_sort_indices(words).to_numpy()  # neighbours in this order share their beginnings
    place = np.empty(len(words), np.int64)
    place[by_word] = np.arange(len(words))
    ids, words = place[ids], words.take(pa.array(by_word))
    del place, by_word
    word = ids != pc.index(words, ".").as_py()
    weight = np.repeat(times, np.diff(begin))
    starts = word.copy()
    for back in range(1, OVERLAP + 1):  # what starts in the closing words belongs to the next chunk
        starts[begin[1:] - back] = False
    h = hashes_of(words)
    found = []  # by size of the phrases: buckets in order, the phrases as numbers, and their occurrences
    for size in range(1, WORDS + 1):
        if size > 1:
            starts = starts[:-1] & word[size - 1 :]
        at = np.flatnonzero(starts)
        key = np.zeros(len(at), np.int64)
        for k in range(size):
            key <<= 21
            key |= ids[at + k]
        order = np.argsort(key)
        key, n = key[order], weight[at[order]]
        del at, order
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key, n = key[first], np.add.reduceat(n, first) if len(first) else n
        del first
        bucket = np.full(len(key), xxhash.xxh3_64_intdigest(lang), np.uint64)
        for k in range(size):
            bucket = mix(bucket + h[_word_of(key, size, k)] * WEIGHTS[k])
        bucket = (bucket % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        found.append((bucket[order], key[order], n[order]))
        del bucket, key, n, order
    del ids, word, weight, starts, h
    some = np.unique(np.concatenate([np.unique(b) for b, _, _ in found]))
    until = [np.r_[0, np.searchsorted(b, some, "right")] for b, _, _ in found]
    cut = sum(until)
    x = 0
    while x < len(some):  # some buckets, or a large one, at a time
        y = max(x + 1, int(np.searchsorted(cut, cut[x] + BATCH_PHRASES, "right")) - 1)
        parts = [tuple(column[u[x] : u[y]] for column in of_size) for u, of_size in zip(until, found)]
        order = np.argsort(np.concatenate([b for b, _, _ in parts]), kind="stable")
        texts = pa.concat_arrays([
            pc.binary_join_element_wise(*(words.take(pa.array(_word_of(key, size, k))) for k in range(size)), " ")
            for size, (_, key, _) in enumerate(parts, 1)])
        n = np.concatenate([n for _, _, n in parts])[order].astype("<i8")
        ends = cut[x : y + 1] - cut[x]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), texts.take(pa.array(order)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (y - x), pa.string()), pa.array(some[x:y], pa.int64()), pc.binary_join(lists, "\n"),
             pa.array([n[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary())],
            ["lang", "bucket", "phrases", "times"])
        x = y


def _word_of(key: np.ndarray, size: int, k: int) -> np.ndarray:
    """The number of word ``k`` of phrases of ``size`` words."""
    return key >> 21 * (size - 1 - k) & ((1 << 21) - 1)


def phrase_counts(chunks: DataFrame, buckets: int, min_count: int) -> DataFrame:
    """lang, phrase, n of every phrase of 1 to 3 words that occurs often enough; with a null phrase, words per language.

    A language has a row with a null phrase for each bucket, to be added up.
    """

    def packed(batches):
        held: dict[str, list[tuple[pa.Array, np.ndarray]]] = defaultdict(list)
        size: dict[str, int] = defaultdict(int)

        def rows(lang):
            del size[lang]
            texts, times = zip(*held.pop(lang))
            yield from phrases_in(lang, pa.concat_arrays(texts), np.concatenate(times), buckets)
            give_back()

        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.take(pc.sort_indices(batch.column(0)))
            cut = np.flatnonzero(np.diff(batch.column(0).dictionary_encode().indices.to_numpy(), prepend=-1)).tolist()
            for a, b in zip(cut, [*cut[1:], batch.num_rows]):
                lang, texts = batch.column(0)[a].as_py(), batch.column(1).slice(a, b - a)
                many = pc.sum(pc.count_substring(texts, " ")).as_py() + b - a
                if size[lang] + many > BLOCK_TOKENS and held[lang]:
                    yield from rows(lang)
                held[lang].append((texts, batch.column(2).slice(a, b - a).to_numpy()))
                size[lang] += many
            while sum(size.values()) > 2 * BLOCK_TOKENS:
                yield from rows(max(size, key=size.get))
        for lang in list(held):
            yield from rows(lang)

    def added(table):
        table = table.combine_chunks()
        lists = pc.split_pattern(table.column("phrases"), "\n").combine_chunks()
        n = np.concatenate([np.frombuffer(t, "<i8") for t in table.column("times").to_pylist()])
        lang = table.column("lang").combine_chunks().take(pc.list_parent_indices(lists))
        sums = pa.table({"lang": lang, "phrase": lists.flatten(), "n": n}).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        sums = sums.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"])
        single = sums.filter(pc.invert(pc.match_substring(sums.column("phrase"), " ")))
        words = single.group_by("lang").aggregate([("n", "sum")])
        none = pa.nulls(words.num_rows, pa.string())
        words = pa.table({"lang": words.column("lang"), "phrase": none, "n": words.column("n_sum")})
        give_back()
        return pa.concat_tables([sums.filter(pc.greater_equal(sums.column("n"), min_count)), words])

    rows = chunks.select("lang", "chunk", "n").mapInArrow(packed, "lang string, bucket long, phrases string, times binary")
    return rows.groupBy("bucket").applyInArrow(added, "lang string, phrase string, n long")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer candidate covers, by their lowest-scoring cut."""
    words = F.split("phrase", " ", -1)
    known = counts.where("phrase IS NOT NULL")
    candidates = known.withColumn("w", words).where(F.size("w") > 1).withColumnRenamed("n", "a")
    long = candidates.where(F.size("w") == WORDS).select("lang", "a", "w")
    inside = long.select("lang", "a", F.explode(F.array(*(F.array_join(F.slice("w", k, WORDS - 1), " ") for k in (1, 2)))).alias("phrase"))
    covered = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = candidates.join(covered, ["lang", "phrase"], "left").where("most IS NULL OR 100 * most < 50 * a").drop("most")
    cuts = kept.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("right"))
    of = {side: known.select("lang", F.col("phrase").alias(side), F.col("n").alias(side[0])) for side in ("left", "right")}
    cuts = cuts.join(of["left"], ["lang", "left"]).join(of["right"], ["lang", "right"])
    # whole numbers of up to 38 digits: exact while a phrase occurs fewer than 10**16 times
    score = F.expr("(CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0)) * 1000000) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, min_count: int = 10, top: int = 2_000, lang: str | Column = "lang",
                 text: str | Column = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases by score, then a, then phrase."""
    column = F.col(text) if isinstance(text, str) else text
    size = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    counts = stored(phrase_counts(dictionary(docs, lang, text), buckets, min_count), "phrases")
    words = counts.where("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    placed = numbered(scored(counts), F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    first = placed.groupBy("lang").agg(F.min("position").alias("first"))
    per_lang = stored(words.join(first, "lang"), "languages")
    ranked = placed.join(small(per_lang, per_lang.count(), 64), "lang").withColumn("rank", F.col("position") - F.col("first") + 1)
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
