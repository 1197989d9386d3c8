"""Every trusted document counts, whatever other languages have; every script has letters."""

import glob
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import quality


def test_a_rare_language_keeps_its_model(spark):
    """Forty trusted documents of a language beside 24,000 of another; none of them falls into the held-out fifth."""
    rnd = random.Random(7)
    words = "bon jour le monde est grand et la mer est bleue sous un ciel clair".split()
    prose = lambda n: " ".join(rnd.choices(words, k=n))
    ids = spark.range(100_000, 100_400).selectExpr("id", "pmod(xxhash64(id, 5), 5) = 0 AS apart").where("NOT apart").collect()
    rare = [r["id"] for r in ids[:40]]
    rows = [(i, prose(12), "en") for i in range(24_000)] + [(i, prose(60), "fr") for i in rare]
    rows.append((200_000, "".join(rnd.choices("qxzwkj#%&", k=400)), "fr"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in [*range(24_000), *rare]], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.quality(docs, quality.QualityModel(docs, labels)).where("doc_id >= 100000").collect()}
    assert all(r["perplexity"] is not None and r["threshold"] is not None for r in out.values())
    assert not out[200_000]["kept"]


SCRIPTS = {
    "ru": "мама мыла раму а папа читал газету у окна и ждал когда придёт весна в наш город".split(),
    "el": "η θάλασσα είναι ήρεμη και ο ήλιος λάμπει πάνω από το μικρό χωριό της νήσου".split(),
    "zh": "我们 今天 去 学校 学习 中文 老师 说 大家 都 很 好 明天 再 来".split(),
}


@pytest.mark.parametrize("lang", SCRIPTS)
def test_letters_of_other_scripts_count(spark, lang):
    """The same texts with other letters of the script in their places are poor, and real ones that were not learnt stay."""
    rnd = random.Random(3)
    words = SCRIPTS[lang]
    letters = sorted(set("".join(words)))
    other = letters[:]
    rnd.shuffle(other)
    prose = lambda: " ".join(rnd.choices(words, k=60))
    rows = [(i, prose(), lang) for i in range(300)]
    new = [(1_000 + i, prose(), lang) for i in range(40)]
    junk = [(2_000 + i, prose().translate(str.maketrans("".join(letters), "".join(other))), lang) for i in range(40)]
    docs = spark.createDataFrame(rows + new + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality.quality(docs, quality.QualityModel(docs, labels)).where("kept").collect()}
    assert kept >= {i for i, _, _ in rows + new} and not kept & {i for i, _, _ in junk}


def test_alphabet():
    own = quality.Letters([ord(c) for c in "e 0Aжя"])
    codes = own.codes_of("eE0٣ Жж\u3000😀")
    last = codes & 63
    assert len(codes) == 9 and last[0] == 1 and last[1] == last[5] == 4  # capitals together
    assert last[2] == last[3] == 3 and last[4] == last[7] == 2 and last[6] == 5  # digits, spaces, a letter of its own
    assert last[8] > quality.OWN and codes[0] == 1 and codes[3] == (1 << 18 | 4 << 12 | 3 << 6 | 3)
    assert list(own.codes_of("")) == [] and np.array_equal(own.codes_of("ab é")[:3], own.codes_of("ab "))


def test_alphabets_are_the_commonest_characters(spark):
    text = "".join(chr(0x4E00 + i) * (100 - i) for i in range(90))
    docs = spark.createDataFrame([("zh", text), (None, "aab"), ("no", None), ("no", "")], "lang string, text string")
    got = quality.alphabets(docs)
    assert set(got) == {"zh", None} and list(got[None].codes_of("ab") & 63) == [1, 2]
    last = got["zh"].codes_of("".join(chr(0x4E00 + i) for i in range(90))) & 63
    assert list(last[: quality.OWN]) == list(range(1, quality.OWN + 1)) and min(last[quality.OWN :]) > quality.OWN


def brute_logs(train: list[str], text: str) -> float:
    """log10 p of the text by the recursion over tuples of characters, none of them folded."""
    grams = lambda t: [tuple("\0\0\0" + t)[i : i + 4] for i in range(len(t))]
    levels = {4: Counter(g for t in train for g in grams(t))}
    for k in (3, 2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    cuts = {}
    for k, of in levels.items():
        n = Counter(of.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        cuts[k] = ([max(0.05, min(j - 0.05, j - (j + 1) * y * n[j + 1] / n[j])) for j in (1, 2, 3)]
                   if all(n[j] for j in (1, 2, 3, 4)) else [0.5, 1.0, 1.5])

    def p(g, k):
        if k == 0:
            return 1 / max(64, len(levels[1]) + 2)
        g, of, cut = g[4 - k :] if len(g) > k else g, levels[k], lambda c: cuts[k][min(c, 3) - 1]
        after = [c for h, c in of.items() if h[:-1] == g[:-1]]
        if not after:
            return p(g[1:], k - 1)
        own = of[g] - cut(of[g]) if g in of else 0
        return (own + sum(map(cut, after)) * p(g[1:], k - 1)) / sum(after)

    return sum(math.log10(p(g, 4)) for g in grams(text))


def test_rarer_characters_stay_apart(spark):
    """Two hundred characters, some beyond the first plane, in languages of their own: each counts as itself, in copies too."""
    rnd = random.Random(11)
    signs = {"zh": [chr(0x4E00 + i) for i in range(170)] + [chr(0x20000 + i) for i in range(30)], None: [chr(0x10330 + i) for i in range(20)]}
    prose = lambda lang: "".join(rnd.choices(signs[lang], [1 / (i + 1) for i in range(len(signs[lang]))], k=40))
    rows = [(i, prose(lang), lang) for lang, ids in (("zh", range(60)), (None, range(100, 140))) for i in ids]
    rows += [(1_000, rows[0][1], "zh"), (1_001, rows[0][1], "zh"), (1_002, "新" + prose("zh")[:9], "zh"), (1_003, rows[0][1], None),
             (1_004, prose("zh").translate({0x4E00 + 150 + i: 0x4E00 + 169 - i for i in range(20)}), "zh"), (1_005, "", "zh")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in rows if i < 1_000], "doc_id long, quality int, toxic int")
    apart = {r["id"] for r in spark.range(1_000).where("pmod(xxhash64(id, 5), 5) = 0").collect()}
    train = {x: [t for i, t, lang in rows if lang == x and i < 1_000 and i not in apart] for x in signs}
    # all n-grams handed out; the commoner ones; none, each text on its own
    for known, limit in ((quality.KNOWN, quality.NAMED), (2_000, quality.NAMED), (0, 1)):
        quality.NAMED = limit
        model = quality.QualityModel(docs, labels, known_rows=known)
        assert bool(model.rare_langs) == (known < quality.KNOWN)
        got = {r["doc_id"]: r["perplexity"] for r in quality.quality(docs, model).collect()}
        assert len(got) == len(rows) and got.pop(1_005) is None and got[0] == got[1_000] == got[1_001]
        for i, text, lang in rows:
            if text:
                assert -math.log10(got[i]) * len(text) == pytest.approx(brute_logs(train[lang], text), rel=1e-5)
    quality.NAMED = 200_000
    left = quality.without_low_quality(docs.withColumn("key", F.lit(1)), model)
    assert left.columns == ["doc_id", "text", "lang", "key"]
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r["doc_id"] for r in quality.quality(docs, model).where("kept").collect())


def test_the_joins_do_not_count_again(spark):
    """Every order's counts are read in three places: what counts them is no part of the plan, which the driver plans again after each shuffle."""
    rnd = random.Random(5)
    rows = [("en", "".join(rnd.choices("abcd é", k=30))) for _ in range(20)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    letters = spark.sparkContext.broadcast(quality.alphabets(docs))
    p = quality.kneser_ney(quality.ngram_counts(docs, letters), quality.distinct_ngrams(docs, letters))
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # of the n-grams wanted
    assert plan.count("Exchange") <= 40


def test_each_order_is_joined_in_a_plan_of_its_own(spark):
    """The same probabilities, with one order's joins in a plan and one table of them left."""
    rnd = random.Random(6)
    rows = [(rnd.choice(["en", None]), "".join(rnd.choices("abcd é", k=30))) for _ in range(20)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    letters = spark.sparkContext.broadcast(quality.alphabets(docs))
    counts, wanted = quality.ngram_counts(docs, letters), quality.distinct_ngrams(docs, letters)
    plans, write = [], quality.in_turn(spark, "in-turn")

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    probabilities = lambda df: {(r["lang"], r["code"], r["rare"], r["held"]): r["p"] for r in df.collect()}
    whole, turns = quality.kneser_ney(counts, wanted), quality.kneser_ney(counts, wanted, kept)
    got = probabilities(turns)
    assert len(got) > 100 and got == pytest.approx(probabilities(whole), rel=1e-12)
    joins = lambda plan: len(re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join", plan))
    assert len(plans) == quality.ORDER and max(map(joins, plans)) <= 5 < joins(whole._jdf.queryExecution().executedPlan().toString())
    assert len(glob.glob(spark.sparkContext.getCheckpointDir().removeprefix("file:") + "/in-turn-*")) == 1
