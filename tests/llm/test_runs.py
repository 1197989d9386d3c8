"""Periodic runs against a brute-force search; online blocks against the whole; the query against its contract."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from mercato.llm import periodic_runs
from mercato.llm.periodic_runs import SquareCatchers, runs_of

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(t, exponent, least):
    """Every maximal stretch of each period; of equal stretches the least period."""
    n, found = len(t), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            j = i
            while j < n and t[j] == t[j - q]:
                j += 1
            if j - i + q >= max(least, exponent * q) and j > i:
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n_, q) for (s, n_), q in found.items())


def text_numbers(rnd):
    n, kinds = rnd.randint(0, 120), rnd.choice([1, 2, 2, 3, 5, 50])
    t = [rnd.randrange(kinds) for _ in range(n)]
    for _ in range(rnd.randint(0, 3)):
        if n > 4:
            a = rnd.randrange(n)
            p, e = rnd.randint(1, max(1, (n - a) // 3)), rnd.randint(a, n)
            for i in range(a, e):
                t[i] = t[a + (i - a) % p]
    return t


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_blocks_of_any_size_find_all_runs(block):
    rnd = random.Random(block)
    for _ in range(150):
        t, exponent, least = text_numbers(rnd), rnd.choice([2, 3, 4]), rnd.choice([2, 6])
        catchers, at = SquareCatchers(exponent, least), 0
        while at < len(t):
            k = rnd.randint(1, block)
            catchers.append(np.array(t[at : at + k]))
            at += k
        assert sorted(zip(*(x.tolist() for x in catchers.runs()))) == brute(t, exponent, least)


def test_runs_are_known_as_soon_as_their_square_stands():
    t = [9, 8, *[1, 2, 3] * 3, 7]
    catchers, known = SquareCatchers(2, 2), []
    for w in t:
        catchers.append(np.array([w]))
        known.append(sorted(zip(*(x.tolist() for x in catchers.runs()))))
    assert known[6] == [] and known[7] == [(2, 6, 3)] and known[10] == known[11] == [(2, 9, 3)]


def test_many_texts_as_one_stream():
    rnd = random.Random(5)
    for _ in range(40):
        texts = [text_numbers(rnd) for _ in range(rnd.randint(0, 30))]
        assert runs_of([np.array(t, np.int64) for t in texts], 4, 6) == [brute(t, 4, 6) for t in texts]


def test_long_texts():
    assert runs_of([np.zeros(300_000, np.int64)], 4, 6) == [[(0, 300_000, 1)]]
    sequence = [bin(i).count("1") & 1 for i in range(2048)]  # its halves defeat sums modulo powers of two
    assert runs_of([np.array(sequence)], 2, 2) == [brute(sequence, 2, 2)]
    assert runs_of([np.array(sequence * 5)], 4, 6)[0] == [(0, 5 * 2048, 2048)]


def test_shared_fingerprints_are_noticed(monkeypatch):
    monkeypatch.setattr(periodic_runs, "mix", lambda x: np.ones_like(x))  # all words alike
    with pytest.raises(ArithmeticError):
        runs_of([np.arange(50)], 4, 6)


def expected(doc_id, text):
    words = WORD.findall((text or "").encode())
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words, 4, 6)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_against_brute_force(spark):
    rnd = random.Random(11)
    texts = [" ".join(rnd.choice(["a", "A", "bé", "c", "日本", "x,y"]) for _ in range(rnd.randint(0, 90))) for _ in range(400)]
    texts += [None, "", " \t\n", "one", "a a a a a", "a a a a a a", " \x0b a\x1fb  a\x1fb\xa0" * 9, "ab " * 1_500, "x" * 50_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b " * 20), (3, "z z z z z z z"), (3, "z z z z z z z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' AS runs", "1 AS n_runs").repartition(3)
    got = periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.with_repeats(docs)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    want = [expected(*r) for r in rows]
    assert sum(w[1] > 0 for w in want) > 20
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.with_repeats(docs))).collect() == []
