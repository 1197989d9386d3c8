"""Fitted models: held-out accuracy, sums of probabilities, counts against brute force; tool calls; the pipeline."""

import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import chat, pitman_yor, quality, toxicity

SF = "/root/testdata/sf0.01"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# -- Pitman-Yor -------------------------------------------------------------
def small_corpus(n=300):
    rnd = random.Random(2)
    vocab = [f"v{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    rows = [(i, " ".join(rnd.choices(vocab, weights, k=rnd.randint(0, 40))) + (f" rare{i}" if i % 4 == 0 else "")) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (None, "v1 V2")]


def test_scores_against_counts(spark):
    rows = small_corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("train", F.lit("clash")).withColumn("shard", F.lit(0))
    got = {r["doc_id"]: r for r in pitman_yor.scores(df.repartition(4), contexts=6, shard_docs=70).collect()}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    tokens = {i: [*words_of(t), "<end>"] for i, t in rows}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, size = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(w in counts for w in ws), total)
        base = sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in ws)
        assert r["base_score"] == pytest.approx(base, abs=1e-9)
        assert r["score"] < 0
    again = {r["doc_id"]: r["score"] for r in pitman_yor.scores(df.repartition(2), contexts=6, shard_docs=70).collect()}
    assert again == {i: r["score"] for i, r in got.items()}


def test_held_out_documents_are_likelier_than_under_counts_alone(spark):
    out = pitman_yor.scores(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out").collect()
    assert len(out) > 100 and sum(r["score"] for r in out) > 0.97 * sum(r["base_score"] for r in out)
    assert sum(r["score"] > r["base_score"] for r in out) > 0.9 * len(out)


def test_predictive_probabilities_add_up_to_one():
    """Over buckets with discounts of their own, for every context: seen words, unseen words and the unknown class."""
    rng = np.random.default_rng(1)
    contexts, scale = 3, 2
    buckets, mass_r, disc_r, cust, droot, vocab = [], np.zeros(contexts), np.zeros(contexts), 0.0, 0.0, 0
    for b in range(scale):
        pairs = sorted({(int(w), int(r)) for w, r in zip(rng.integers(0, 40, 90), rng.integers(0, contexts, 90))})
        ws = {w: k for k, w in enumerate(sorted({w for w, _ in pairs}))}
        word, ctx = np.array([ws[w] for w, _ in pairs]), np.array([r for _, r in pairs])
        c = rng.geometric(0.3, len(pairs)) * np.where(rng.random(len(pairs)) < 0.1, 200, 1)
        d, dr, t, cu, k = pitman_yor.sample_tables(np.random.default_rng(b), word, ctx, c, contexts, scale, 6, 2)
        assert (t >= 1).all() and (t <= c).all() and (k >= 1 - 1e-9).all() and (k <= cu + 1e-9).all()
        buckets.append((word, ctx, c - d * t, cu - dr * k, len(ws)))
        mass_r += np.bincount(ctx, c, contexts)
        disc_r += d * np.bincount(ctx, t, contexts)
        cust, droot, vocab = cust + cu.sum(), droot + dr * k.sum(), vocab + len(ws)
    base = (pitman_yor.THETA_ROOT + droot) / (vocab + 1) / (pitman_yor.THETA_ROOT + cust)
    for r in range(contexts):
        lam = (pitman_yor.THETA + disc_r[r]) / (pitman_yor.THETA + mass_r[r])
        total = lam * base  # the unknown class
        for word, ctx, seen, root, n in buckets:
            total += lam * (root / (pitman_yor.THETA_ROOT + cust) + base).sum()
            total += seen[ctx == r].sum() / (pitman_yor.THETA + mass_r[r])
        assert total == pytest.approx(1, abs=1e-9)


def test_scores_of_an_empty_table(spark):
    assert pitman_yor.scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# -- toxicity ---------------------------------------------------------------
def test_toxicity_on_documents_left_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    model = toxicity.train(docs, labels.where(~fold))
    out = toxicity.toxicity(docs, model).join(labels.where(fold).select("doc_id", F.col("toxic").alias("y")), "doc_id").collect()
    right = sum(r["toxic"] == (r["y"] == 1) for r in out) / len(out)
    false = sum(r["toxic"] and not r["y"] for r in out) / sum(not r["y"] for r in out)
    assert right > 0.93 and false < 0.02
    worse = [r["expected_severity"] for r in out if r["toxic"]]
    assert np.mean(worse) > 1 and all(0 <= r["expected_severity"] <= 3 for r in out)
    assert model.thresholds == sorted(model.thresholds)


def test_severity_grows_with_the_words():
    rnd = random.Random(1)
    bad = ["vile", "nasty", "awful", "rotten", "foul", "base"]
    docs, y = [], []
    for i in range(400):
        k = rnd.choice([0, 0, 0, 1, 3, 6])
        docs.append({w.encode() for w in rnd.sample(bad, k)} | {f"w{rnd.randrange(50)}".encode() for _ in range(20)})
        y.append(k > 0)
    model = toxicity.fit(docs, np.array(y))
    s = [sum(model.scores(" ".join(bad[:k]).encode())) for k in (0, 1, 3, 6)]
    assert s == sorted(s) and s[0] < 0.3 and s[3] > 2


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 100_000), (3, "vile"), (None, "vile")], "doc_id long, text string")
    for labels in ([], [(1, 0, 0)], [(3, 1, 1), (3, 0, 0), (2, 1, 0), (1, None, None)]):
        lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        got = toxicity.toxicity(docs, toxicity.train(docs, lab)).collect()
        assert len(got) == 5 and not any(r["toxic"] for r in got if r["doc_id"] in (1, 2))
    assert toxicity.toxicity(docs.limit(0), toxicity.OrdinalModel({}, [1.0, 2.0, 3.0])).collect() == []


# -- quality ----------------------------------------------------------------
def brute_kneser_ney(codes):
    """p(code) by the textbook recursion over dicts."""
    levels = {4: Counter(codes)}
    for k in (3, 2, 1):
        levels[k] = Counter(c & ((1 << 6 * k) - 1) for c in levels[k + 1])

    def p(code, k):
        if k == 0:
            return 1 / 64
        of = levels[k]
        code &= (1 << 6 * k) - 1
        n = Counter(of.values())
        if all(n[j] for j in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            d = [max(0.05, min(j - 0.05, j - (j + 1) * y * n[j + 1] / n[j])) for j in (1, 2, 3)]
        else:
            d = [0.5, 1.0, 1.5]
        cut = lambda c: d[min(c, 3) - 1]
        ctx = [(w, c) for w, c in of.items() if w >> 6 == code >> 6]
        low = p(code, k - 1)
        if not ctx:
            return low
        total = sum(c for _, c in ctx)
        own = of[code] - cut(of[code]) if code in of else 0
        return (own + sum(cut(c) for _, c in ctx) * low) / total

    return p


def test_kneser_ney_joins(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "Zebra 42!", "thé"]
    docs = spark.createDataFrame([("en", t) for t in texts] + [(None, "xx xy"), ("fr", "un")], "lang string, text string")
    train = docs.where("lang IS NULL OR lang = 'en'")
    letters = quality.alphabets(train)
    held = spark.sparkContext.broadcast(letters)
    wanted = quality.kneser_ney(quality.ngram_counts(train, held), quality.distinct_ngrams(docs, held))
    got = {(r["lang"], r["code"]): r["p"] for r in wanted.collect()}
    p = brute_kneser_ney([int(c) for t in texts for c in letters["en"].codes_of(t)])
    mine = {c: v for (lang, c), v in got.items() if lang == "en"}
    assert len(mine) > 40 and {lang for lang, _ in got} == {"en", None}
    for code, v in mine.items():
        assert v == pytest.approx(p(code, 4), rel=1e-9)
    # over all 64 symbols after a context the model adds up to one
    ctx = letters["en"].codes_of("the ")[-1] & ((1 << 18) - 1)
    assert sum(p((int(ctx) << 6) | w, 4) for w in range(64)) == pytest.approx(1)


def test_quality_separates_junk_and_keeps_clean(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    for rows in (quality.TABLE_ROWS, 1):  # all languages in one block; a block each
        model = quality.QualityModel(docs, labels, block_rows=rows)
        out = quality.quality(docs, model).join(labels.select("doc_id", F.col("quality").alias("y")), "doc_id").collect()
        clean = [r["kept"] for r in out if r["y"] == 1]
        junk = [r["kept"] for r in out if r["y"] == 0]
        assert sum(clean) / len(clean) > 0.97 and sum(junk) / len(junk) < 0.5
    left = quality.without_low_quality(docs.withColumn("perplexity", F.lit("clash")), model)
    assert left.columns[-1] == "perplexity" and left.count() == quality.quality(docs, model).where("kept").count()


def test_quality_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "good text here", "en"), (4, "good text", None), (5, "x", "zz"), (None, "abc", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame([(i, 1, 0) for i in range(1, 5)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.quality(docs, quality.QualityModel(docs, lab)).collect()}
    assert len(got) == 6 and all(got[i]["perplexity"] is None and got[i]["kept"] for i in (1, 2, 5))
    none = quality.QualityModel(docs, lab.limit(0))
    assert all(r["kept"] for r in quality.quality(docs, none).collect())
    assert quality.quality(docs.limit(0), none).collect() == []


# -- tool calls ---------------------------------------------------------------
TOOLS = [("add", '{"type":"object","required":["a","b"],"properties":{"a":{"type":"number"},"b":{"type":"integer","maximum":9}},"additionalProperties":false}'),
         ("say", '{"type":"object","properties":{"mode":{"enum":["x","y"]},"tags":{"type":"array","items":{"type":"string","minLength":2}}}}')]


def test_calls_and_results(spark):
    calls = [("c", "1", 0, "add", '{"b": 2, "a": 1.5}', None), ("c", "2", 2, "add", '{"a": 1, "b": 10, "z": 0}', "1"),
             ("c", "3", 4, "say", '{"tags": ["ok", "n"], "mode": "q"}', "2"), ("c", "4", 5, "say", "{broken", "nowhere"),
             ("c", "5", 6, "gone", "[]", "3"), ("c", "1", 7, "add", "{}", None), (None, "9", 0, "say", None, None),
             ("d", "1", 0, "say", '{"é": "ü", "a": NaN}', None), ("d", "p", 1, "say", "{}", "q"), ("d", "q", 2, "say", "{}", "p"),
             ("d", "r", 3, "say", "{}", "q")]
    results = [("c", "1", 1, "3.5"), ("c", "1", 9, "late"), ("c", "3", 5, None), ("c", "8", 6, "lost"), ("d", "1", 1, "x"), ("d", None, 1, "y")]
    df = chat.linked_calls(spark.createDataFrame(calls, "conv_id string, call_id string, turn long, name string, arguments string, after string"),
                           spark.createDataFrame(results, "conv_id string, call_id string, turn long, content string").withColumn("status", F.lit(1)),
                           spark.createDataFrame(TOOLS, "name string, schema string"))
    rows = df.collect()
    got = {(r["conv_id"], r["call_id"], r["turn"]): r for r in rows if r["name"]}
    assert {k: (r["status"], r["level"]) for k, r in got.items()} == {
        ("c", "1", 0): ("linked", 0), ("c", "2", 2): ("unanswered", 1), ("c", "3", 4): ("linked", 2), ("c", "4", 5): ("unanswered", 0),
        ("c", "5", 6): ("unanswered", 3), ("c", "1", 7): ("repeated", None), (None, "9", 0): ("unanswered", 0), ("d", "1", 0): ("linked", 0),
        ("d", "p", 1): ("cycle", None), ("d", "q", 2): ("cycle", None), ("d", "r", 3): ("cycle", None)}
    assert {k: (r["valid"], r["errors"]) for k, r in got.items() if k[0] != "d"} == {
        ("c", "1", 0): (True, ""), ("c", "2", 2): (False, "$.b: range; $.z: unknown"),
        ("c", "3", 4): (False, "$.mode: not in enum; $.tags[1]: length"), ("c", "4", 5): (False, "arguments: not JSON"),
        ("c", "5", 6): (False, "tool: unknown"), ("c", "1", 7): (False, "$.a: missing; $.b: missing"), (None, "9", 0): (False, "arguments: missing")}
    first = got["c", "1", 0]["record"]
    assert first == ('{"after":null,"arguments":{"a":1.5,"b":2},"call_id":"1","conv_id":"c","level":0,"name":"add","result":"3.5","status":"linked"}')
    for r in rows:
        assert r["record"] == chat.canonical(json.loads(r["record"]))
    assert sorted(((r["status"], r["call_id"]) for r in rows if not r["name"]), key=str) == sorted(
        [("orphan", "8"), ("orphan", None), ("repeated result", "1")], key=str)


def test_levels_of_a_long_chain(spark):
    rows = [("c", str(i), str(i - 1) if i else None) for i in range(300)]
    random.Random(1).shuffle(rows)
    got = {r["call_id"]: r["level"] for r in chat.levels(spark.createDataFrame(rows, "conv_id string, call_id string, after string")).collect()}
    assert got == {str(i): i for i in range(300)}


def test_calls_of_the_conversations(spark):
    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = chat.linked_calls(*chat.calls_of_turns(conv)).collect()
    turns = defaultdict(dict)
    for r in conv.collect():
        turns[str(r["conv_id"])][r["turn"]] = r
    n = sum(r["role"] != "assistant" for t in turns.values() for r in t.values())
    assert sum(r["name"] is not None for r in rows) == n
    for r in rows:
        if r["name"]:
            after = turns[r["conv_id"]].get(r["turn"] + 1)
            assert (r["status"] == "linked") == (after is not None and after["role"] == "assistant")
    empty = conv.limit(0)
    assert chat.linked_calls(*chat.calls_of_turns(empty)).collect() == []


def test_turns_of_any_role_have_a_row(spark):
    conv = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "tool", "found"), (1, 3, None, "odd"), (None, 4, "judge", None)],
                                 "conv_id long, turn long, role string, text string")
    rows = chat.linked_calls(*chat.calls_of_turns(conv)).collect()
    assert sorted(((r["turn"], r["status"]) for r in rows)) == [(0, "linked"), (2, "orphan"), (3, "orphan"), (4, "orphan")]
    assert json.loads(next(r["record"] for r in rows if r["turn"] == 2))["result"] == "found"


def test_any_number_of_tools(spark):
    schema = '{"type":"object","required":["a"],"title":"%s"}' % ("x" * 20_000)
    tools = spark.range(1_000).selectExpr("concat('t', id) AS name", f"'{schema}' AS schema")  # 20 MB
    tools = tools.unionByName(spark.createDataFrame([("t3", '{"type":"array"}'), ("none", None), (None, "{}")], "name string, schema string"))
    calls = spark.createDataFrame([("c", "1", 0, "t999", '{"a":1}', None), ("c", "2", 1, "t5", "{}", None), ("c", "3", 2, "none", "{}", None),
                                   ("c", "4", 3, None, "{}", None)], "conv_id string, call_id string, turn long, name string, arguments string, after string")
    results = spark.createDataFrame([], "conv_id string, call_id string, turn long, content string")
    got = {r["call_id"]: r["errors"] for r in chat.linked_calls(calls, results, tools).collect()}
    assert got == {"1": "", "2": "$.a: missing", "3": "tool: unknown", "4": "tool: unknown"}
