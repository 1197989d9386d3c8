"""Joins and searches against brute force: shingle join, embeddings, decontamination, components."""

import glob
import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import decontam, embedding_dedup, ngram_jaccard
from mercato.llm.common import SHUFFLES_END, components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_components(pairs, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_az(text))
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def corpus(seed, n=160):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["The", "of", "and"] * 20
    passage = [rnd.choice(words) for _ in range(30)]
    texts = []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.35 and texts:  # a near copy, some just over and some just under the threshold
            w = rnd.choice(texts).split()
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                if w:
                    w[rnd.randrange(len(w))] = rnd.choice(words)
            texts.append(" ".join(w))
        elif kind < 0.5:
            texts.append(" ".join([*(rnd.choice(words) for _ in range(rnd.randint(5, 30))), *passage]))
        elif kind < 0.6:
            texts.append(" ".join(rnd.choice(words[:6]) for _ in range(rnd.randint(0, 6))))
        else:
            texts.append("\n".join(" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 40))) for _ in range(3)))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {}), (3, {"max_hot": 4}), (4, {"max_bits": 1 << 13}), (5, {"max_hot": 4, "max_bits": 1 << 12})])
def test_jaccard_components(spark, seed, kw):
    rows = corpus(seed) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one  TWO")]
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = brute_components(pairs, ids)
    assert len(pairs) > 20
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("sig", F.lit(1))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_jaccard.jaccard_components(df.repartition(3), **kw).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in ids}


def test_jaccard_group_of_near_copies_is_not_squared(spark):
    rnd = random.Random(0)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        w[rnd.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = ngram_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0}


def test_jaccard_empty_repeated_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_jaccard.jaccard_components(empty).collect() == []
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "A b c d e f"), (7, "z")]
    got = sorted(ngram_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=str)
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == [("5", 2, 5), ("5", 2, 5), ("7", 1, 7), ("None", 2, 5)]


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + k) for k in range(1, 50)] + [(5000, 300), (300, 4000)]
    random.Random(3).shuffle(links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {x for p in links for x in p}
    assert got == brute_components(links, ids)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_vectors(rows, threshold):
    good = {}
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[k] = np.array(v, np.float32).astype(np.float64)
    pairs = [(a, b) for a in good for b in good if a < b and rows[a][2] == rows[b][2] and len(good[a]) == len(good[b])
             and good[a] @ good[b] / (np.linalg.norm(good[a]) * np.linalg.norm(good[b])) >= threshold]
    roots = brute_components(pairs, range(len(rows)))
    n = [sum(k in p for p in pairs) for k in range(len(rows))]
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[roots[k]] = min(least.get(roots[k], i), i)
    return sorted((i, n[k], least[roots[k]], i == least[roots[k]]) for k, (i, _, _) in enumerate(rows))


@pytest.mark.parametrize("tile", [8, 2_048])
def test_embeddings(spark, tile):
    rng = np.random.default_rng(4)
    rows, base = [], rng.normal(size=(12, 16))
    for i in range(160):
        b = base[i % 12]
        noise = rng.normal(size=16) * rng.choice([0, 0.05, 0.12, 0.2, 1.0])
        rows.append((i, [float(np.float32(x)) for x in b + noise], int(rng.integers(0, 3))))
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] + [1.0] * 15, 1), (203, [None] + [1.0] * 15, 1),
             (204, rows[0][1], None), (205, [float("inf")] * 16, 2), (206, [], 2), (207, [1.0, 2.0], 0), (208, [2.0, 4.0], 0),
             (209, [1e-30, 2e-30], 0), (210, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1))
    got = embedding_dedup.near_duplicates(df.repartition(4), tile=tile).collect()
    assert sorted(map(tuple, got)) == brute_vectors(rows, 0.98)


def test_embeddings_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(df).collect() == []


def test_int8_bound_holds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, n, e = embedding_dedup.quantised(x)
    near = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
    assert (np.abs(near - x @ x.T) <= n[:, None] * e[None, :] + e[:, None] + 1e-12).all()


def brute_contamination(docs, items, width=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_az(t))
    windows = []
    for i, t in items:
        w = cut(t)
        windows += [(str("" if i is None else i), w[k : k + width]) for k in range(max(1, len(w) - width + 1) if w else 0)]
    out = []
    for d, t in docs:
        w, hit, found = cut(t), set(), set()
        for i, x in windows:
            for k in range(len(w) - len(x) + 1):
                if w[k : k + len(x)] == x:
                    hit.update(range(k, k + len(x)))
                    found.add(i)
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination(spark, block_bytes):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(30)] + ["é", "The", "the"]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 25)))) for i in range(25)]
    items += [(100, "Solo"), (101, "two Words"), (None, "null id here"), (102, None), (3, items[3][1])]
    docs = []
    for i in range(60):
        t = [rnd.choice(words) for _ in range(rnd.randint(0, 60))]
        if i % 3 == 0:
            src = (rnd.choice(items)[1] or "").split()
            k = rnd.randint(0, max(0, len(src) - 3))
            t[10:10] = src[k : k + rnd.randint(3, 14)]
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(t).upper() if i % 2 else " ".join(t)))
    docs += [(70, None), (71, ""), (72, "solo! TWO-words null id here"), (72, "solo")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit(0))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(df.repartition(3), bench, block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == brute_contamination(docs, items)
    left = decontam.without_contaminated(df, bench, block_bytes=block_bytes)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r[0] for r in brute_contamination(docs, items) if not r[-1])


def test_decontamination_empty_tables(spark):
    none, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontam.contamination(none, bench).collect() == []
    assert [tuple(r)[:4] for r in decontam.contamination(some, bench).collect()] == [(1, 2, 0, 0)]


def test_shuffled_shingles_do_not_stay(spark):
    """Each step's shuffle files go when it is written, and so does the table that holds the sets of all documents."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: {n for n in files.getAllFiles().mkString(" ").split() if "/shuffle_" in n}
    tables = lambda: {n for n in glob.glob(spark.sparkContext.getCheckpointDir().removeprefix("file:") + "/shingle-*")}
    docs = spark.createDataFrame(corpus(7), "doc_id long, text string")
    was, stood, setting = shuffles(), tables(), spark.conf.get(SHUFFLES_END, None)
    out = ngram_jaccard.stored_components(docs)
    assert spark.conf.get(SHUFFLES_END, None) == setting
    for _ in range(50):  # the files go in the background; two small counts are read outside of a write
        left = {re.search(r"shuffle_\d+", n)[0] for n in shuffles() - was}
        if len(left) < 8:
            break
        time.sleep(0.2)
    assert len(left) < 8
    assert not [n for n in tables() - stood if "shingle-sets" in n] and out.count() == 160
