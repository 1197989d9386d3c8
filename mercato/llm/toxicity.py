"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

The labels say toxic or not; the grades are made from them: 0 is not toxic, and
toxic documents are graded 1 to 3 by the terciles of how many different words
typical of toxic documents they hold. Features are the presence of words
(``[0-9a-z]`` and characters beyond ASCII, A-Z in lower case) chosen by how far
their rate among toxic documents is from the overall one. One weight vector is
shared by all thresholds:

    P(grade > k) = sigmoid(w . x - theta_k),  theta_1 < theta_2 < theta_3

and the expected severity is the sum of the three probabilities. A document is
toxic if P(grade > 0) reaches ``cut``.

The model is fitted on at most ``SAMPLE_DOCS`` labelled documents (the first by
a hash of their id); every document is scored over its whole text, without a
shuffle. Null or empty texts have no features; they get the severity of the
intercepts alone and are never toxic. Repeated labels of a document count as
toxic if one is. Without labels of both kinds, nothing is toxic.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import hand_out, raw, stored
from mercato.llm.decontam import item_words

SAMPLE_DOCS = 12_000
FEATURES = 400
GRADES = 3
CUT = 0.5


@dataclass
class OrdinalModel:
    weights: dict[bytes, float]
    thresholds: list[float]

    def scores(self, text: bytes) -> list[float]:
        """P(grade > k) for k = 0, 1, 2."""
        x = sum(map(self.weights.__getitem__, self.weights.keys() & item_words(text)))
        return [float(1 / (1 + np.exp(min(700.0, max(-700.0, t - x))))) for t in self.thresholds]


def features_of(docs: list[set[bytes]], toxic: np.ndarray, n_features: int) -> tuple[list[bytes], list[bytes]]:
    """The most telling words, and those typical of toxic documents."""
    total, bad = Counter(), Counter()
    for words, y in zip(docs, toxic):
        total.update(words)
        if y:
            bad.update(words)
    p = toxic.mean()
    words = sorted(w for w, n in total.items() if n >= 3)
    n = np.array([total[w] for w in words], float)
    t = np.array([bad[w] for w in words], float)
    z = (t - n * p) / np.sqrt(n * p * (1 - p)) if len(words) else np.zeros(0)
    order = np.argsort(-np.abs(z), kind="stable")[:n_features]
    typical = [words[i] for i in order if z[i] > 4 and t[i] > 0.7 * n[i]]
    return [words[i] for i in order], typical


def grades_of(docs: list[set[bytes]], toxic: np.ndarray, typical: list[bytes]) -> np.ndarray:
    held = np.array([len(words.intersection(typical)) for words in docs], float)
    own = held[toxic]
    cuts = np.quantile(own, [1 / 3, 2 / 3]) if len(own) else [0, 0]
    return np.where(toxic, 1 + (held > cuts[0]).astype(int) + (held > cuts[1]), 0)


def fit(docs: list[set[bytes]], toxic: np.ndarray, n_features: int = FEATURES, rounds: int = 250, ridge: float = 0.3) -> OrdinalModel:
    """Penalised maximum likelihood by Adam over all rows; thresholds stay in order as sums of positive steps."""
    if not len(docs) or toxic.all() or not toxic.any():
        return OrdinalModel({}, [700.0] * GRADES)
    words, typical = features_of(docs, toxic, n_features)
    grade = grades_of(docs, toxic, typical)
    index = {w: i for i, w in enumerate(words)}
    hits = [[index[w] for w in d if w in index] for d in docs]
    row = np.repeat(np.arange(len(docs)), [len(h) for h in hits])
    col = np.array([c for h in hits for c in h], np.int64)
    par = np.zeros(len(words) + GRADES)
    par[-GRADES:] = [-np.log(max(1e-6, toxic.mean())), 0.0, 0.0]
    m, v = np.zeros_like(par), np.zeros_like(par)
    n = len(docs)
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))
    for it in range(1, rounds + 1):
        w, theta = par[:-GRADES], np.cumsum(np.r_[par[-GRADES], np.exp(par[-GRADES + 1:])])
        x = np.bincount(row, w[col], n)
        # above[k] = P(grade > k - 1): 1, s_1, s_2, s_3, 0
        s = sig(x[:, None] - theta)
        above = np.c_[np.ones(n), s, np.zeros(n)]
        slope = np.c_[np.zeros(n), s * (1 - s), np.zeros(n)]
        i = np.arange(n)
        p = np.maximum(above[i, grade] - above[i, grade + 1], 1e-12)
        gx = -(slope[i, grade] - slope[i, grade + 1]) / p
        gt = np.zeros((n, GRADES + 2))
        gt[i, grade] += slope[i, grade] / p
        gt[i, grade + 1] -= slope[i, grade + 1] / p
        gt = gt[:, 1:-1].sum(axis=0)
        g = np.r_[np.bincount(col, gx[row], len(words)) + ridge * w, gt.sum(), np.cumsum(gt[::-1])[::-1][1:] * np.exp(par[-GRADES + 1:])]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        par -= 0.1 * (m / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-9)
    theta = np.cumsum(np.r_[par[-GRADES], np.exp(par[-GRADES + 1:])])
    return OrdinalModel({w: float(x) for w, x in zip(words, par)}, [float(t) for t in theta])


def labelled_words(docs: DataFrame, labels: DataFrame, sample_docs: int, n_features: int = FEATURES) -> tuple[list[set[bytes]], np.ndarray]:
    """The telling words that each document of a bounded sample holds, and its label.

    Words are counted on the executors; the driver gets ``n_features`` of them and,
    per sampled document, which of those it holds. Copies count once.
    """
    y = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)  # at most sample_docs rows
    rows = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id")
    rows = rows.groupBy(F.xxhash64("text").alias("same"), F.length("text").alias("n")).agg(
        F.min(F.struct("doc_id", "toxic", "text")).alias("d")).select("d.*")

    def words(batches):
        for b in batches:
            sets = [sorted(set(item_words(t))) for t in raw(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sets, pa.list_(pa.binary()))], ["doc_id", "toxic", "words"])

    rows = rows.select(F.col("doc_id").cast("long"), (F.col("toxic") > 0).cast("int").alias("toxic"), "text")
    sample = stored(rows.mapInArrow(words, "doc_id long, toxic int, words array<binary>"), "toxic-sample")
    size, bad = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < bad < size:
        return [set()] * size, np.full(size, bool(bad))
    p = bad / size
    counts = sample.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("t")).where("n >= 3")
    z = F.abs(F.col("t") - F.col("n") * p) / F.sqrt(F.col("n") * (p * (1 - p)))
    telling = {bytes(r["word"]) for r in counts.orderBy(z.desc(), "word").select("word").limit(n_features).collect()}

    def held(batches):
        for b in batches:
            sets = [[w for w in words if w in telling] for words in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sets, pa.list_(pa.binary()))], ["doc_id", "toxic", "words"])

    got = sample.mapInArrow(held, "doc_id long, toxic int, words array<binary>").collect()
    got = sorted((r["doc_id"], r["toxic"], sorted(map(bytes, r["words"]))) for r in got)
    return [set(r[2]) for r in got], np.array([r[1] > 0 for r in got], bool)


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> OrdinalModel:
    return fit(*labelled_words(docs, labels, sample_docs))


def severity(docs: DataFrame, model: OrdinalModel, text: Column) -> Column:
    """Column of structs (expected_severity, p_toxic)."""
    held = hand_out(docs.sparkSession, model)  # a bounded number of weights
    kind = T.StructType([T.StructField("expected_severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType())])

    @F.arrow_udf(kind)
    def score(texts: pa.Array) -> pa.Array:
        p = [held.value.scores(t) if t else None for t in raw(texts)]
        empty = held.value.scores(b"")
        return pa.StructArray.from_arrays(
            [pa.array([sum(x or empty) for x in p], pa.float64()), pa.array([x[0] if x else 0.0 for x in p], pa.float64())],
            names=["expected_severity", "p_toxic"])

    return score(text)


def toxicity(docs: DataFrame, model: OrdinalModel, cut: float = CUT) -> DataFrame:
    """doc_id, expected_severity, p_toxic, toxic of every document."""
    out = docs.select("doc_id", severity(docs, model, F.col("text")).alias("s"))
    return out.select("doc_id", "s.expected_severity", "s.p_toxic", (F.col("s.p_toxic") >= cut).alias("toxic"))


def without_toxic(docs: DataFrame, model: OrdinalModel, cut: float = CUT) -> DataFrame:
    """The rows of ``docs``, all columns, that are not toxic."""
    return docs.where(severity(docs, model, F.col("text"))["p_toxic"] < cut)
