"""Collocations against a direct count of all phrases; the parse's properties."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mercato.llm import collocations
from mercato.llm.collocations import OVERLAP, chunks_of


def phrases(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split("[.,;:!?\x0a-\x0d]", text):
        words = re.findall("[^\x20\x09]+", piece)
        for k in range(len(words)):
            for m in range(1, min(3, len(words) - k) + 1):
                yield tuple(words[k : k + m])


def expected(rows, least, top):
    counts = defaultdict(Counter)
    for lang, text in rows:
        counts["und" if lang is None else lang].update(phrases(text))
    out = []
    for lang, f in counts.items():
        n, often, scored = sum(v for p, v in f.items() if len(p) == 1), {p: v for p, v in f.items() if v >= least and len(p) > 1}, []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * v >= 50 * a and any(q[k : k + len(p)] == p for k in range(2)) for q, v in often.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def sample():
    rnd = random.Random(2)
    words = ["a", "B", "the", "The", "é", "日本", "x\x1fy", "\xa0", "of", "zz"]
    line = "one Two three, four five six seven eight nine ten"
    rows = []
    for _ in range(250):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", ": "]) for _ in range(rnd.randint(0, 60)))
        rows.append((rnd.choice(["en", "en", "en", "fr", None, ""]), text + (line if rnd.random() < 0.2 else "")))
    return rows + [("en", None), (None, ""), ("de", " ..,; "), ("de", "nur selten"), ("en", "the of " * 5_000), ("fr", rows[0][1]), ("fr", rows[0][1])]


def test_against_a_direct_count(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS n", "'x' AS phrase", "2 AS rank").repartition(3)
    for least, top in ((10, 2_000), (3, 7)):
        got = collocations.collocations(docs, least, top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = expected(rows, least, top)
        assert len(want) > 20 and sorted(map(tuple, got.collect())) == want


def test_counts_are_those_of_all_phrases(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_TOKENS", 300)  # many blocks a task
    monkeypatch.setattr(collocations, "TEXT_BYTES", 500)
    rows = sample()
    counts = defaultdict(Counter)
    for lang, text in rows:
        counts["und" if lang is None else lang].update(" ".join(p) for p in phrases(text))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    got = collocations.phrase_counts(collocations.dictionary(docs), 5, 1).where("phrase IS NOT NULL").collect()
    assert sorted(map(tuple, got)) == sorted((lang, p, n) for lang, c in counts.items() for p, n in c.items())


def test_chunks_overlap_by_their_closing_words():
    texts = [t.encode() for _, t in sample() if t]
    of, chunks = chunks_of(texts)
    for k, t in enumerate(texts):
        own = [c.split(" ") for c, i in zip(chunks.to_pylist(), of.tolist()) if i == k]
        assert all(a[-OVERLAP:] == b[:OVERLAP] for a, b in zip(own, own[1:]))
        joined = own[0] + [w for c in own[1:] for w in c[OVERLAP:]]
        assert joined == [w.decode() for w in t.translate(collocations.LOWER).replace(b".", b" . ").split()] + ["."] * OVERLAP


def test_copied_passages_share_their_chunks():
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    passage = " ".join(rnd.choice(words) for _ in range(400))
    _, alone = chunks_of([passage.encode()])
    _, inside = chunks_of([(" ".join(rnd.choice(words) for _ in range(50)) + " " + passage + " end").encode()])
    assert len(set(alone.to_pylist()) & set(inside.to_pylist())) >= len(alone) - 2 > 10


def test_large_numbers_stay_exact(spark):
    big = 3_000_000_019
    rows = [("en", "a", 4 * big), ("en", "b", 7 * big + 1), ("en", "a b", 2 * big + 3), ("en", None, 20 * big)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, n long")).collect()
    assert [r["score"] for r in got] == [1_000_000 * (2 * big + 3) ** 2 // (4 * big * (7 * big + 1))]


def test_empty_tables(spark):
    for docs in (spark.createDataFrame([], "lang string, text string"),
                 spark.createDataFrame([("en", None)], "lang string, text string")):
        assert collocations.collocations(docs).collect() == []
    docs = spark.createDataFrame([(k, "en", "a b c. " * 4) for k in range(3)], "id long, tongue string, body string")
    got = collocations.collocations(docs.withColumn("text", F.lit(1)), lang="tongue", text="body").collect()
    assert [r["phrase"] for r in got] == ["a b c"]


def test_phrases_of_a_block_leave_in_batches_of_bounded_size(monkeypatch):
    monkeypatch.setattr(collocations, "BATCH_PHRASES", 60, raising=False)
    _, chunks = chunks_of([t.encode() for _, t in sample() if t][:40])
    got, sizes = Counter(), []
    for rows in list(collocations.phrases_in("en", chunks, np.ones(len(chunks), np.int64), 50)):
        found = [p.split("\n") for p in rows.column("phrases").to_pylist()]
        times = [np.frombuffer(t, "<i8").tolist() for t in rows.column("times").to_pylist()]
        assert list(map(len, found)) == list(map(len, times)) and set(rows.column("lang").to_pylist()) == {"en"}
        sizes.append((sum(map(len, found)), len(found), rows.column("bucket").to_pylist()))
        got.update({p: n for ps, ns in zip(found, times) for p, n in zip(ps, ns)})
    assert len(sizes) > 3 and all(n <= 60 or buckets == 1 for n, buckets, _ in sizes)
    buckets = [b for _, _, of in sizes for b in of]
    assert len(buckets) == len(set(buckets))  # a row for each bucket and block
    assert got == Counter(" ".join(p) for _, t in [r for r in sample() if r[1]][:40] for p in phrases(t))
    assert not list(collocations.phrases_in("en", pa.array([". ."]), np.ones(1, np.int64), 50))
