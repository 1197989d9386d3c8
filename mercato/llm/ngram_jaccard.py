"""N-gram Jaccard join by multiple-global-order prefix filtering.

A document's set holds its distinct shingles of five words (64-bit hashes); a
document of fewer words has its whole word sequence as its one shingle. Two
documents link when ``100 * |intersection| >= 75 * |union|``.

For any one total order of all shingles, two sets that link share a shingle among
the first ``n - ceil(0.75 n) + 1`` of each. Three orders are used. All begin with
how common a shingle is (in one document only, in several, in many), and break
ties by a different hash each, so a pair must share prefix shingles under three
independent orders before it is verified.

1. Count shingles: each task sends every shingle it saw once, with its count, to
   a bucket by hash. Buckets give a sketch of fixed size: a bit map of shingles
   that occur in several documents, and the counts of the commonest (at most
   ``MAX_HOT`` by choice of the least count). A shingle's class (from the sketch)
   is a function of the shingle alone, so the orders are total orders whatever
   the sketch errs on; errors cost time, never links.
2. Read the documents again. Most sets have more shingles of their own than
   their prefix is long, so nothing can link them; the others keep their
   shingles and prefixes.
3. Equal sets are one node. Nodes meet on shingles of the first order's
   prefix. First each node is compared with the least node of each of its
   shingles only, so a group of near copies costs its size, not its square.
   Then pairs that share a prefix shingle and are not yet in one component are
   compared, all of them; a pair within a component could not change it.
4. A pair is verified if the lengths allow it and the prefixes of the second and
   third order intersect too; verification counts the intersection.

Null or empty texts have no shingles and link with nothing. Repeated rows are
equal sets. A null doc_id takes part; components name the smallest non-null id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import (
    components, drop_path, give_back, hand_out, mix, raw, scratch_path, stored, stored_at, word_hashes, words_of,
)

WORDS = 5
#: Shingles whose count is known; 12 bytes each.
MAX_HOT = 1 << 20
#: Bits of the largest sketch, and shingles of a bucket.
MAX_BITS, BUCKET = 1 << 29, 1_000_000
ORDER_SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
PRIME = np.uint64(0x100000001B3)


def shingle_sets(texts: list[bytes], k: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    for lo in range(0, len(texts), 256):
        split = [words_of(t) for t in texts[lo : lo + 256]]
        sizes = [len(w) for w in split]
        h = word_hashes((w for words in split for w in words), sum(sizes))
        s = h.copy()
        if len(h) >= k:
            body = np.zeros(len(h) - k + 1, np.uint64)
            for j in range(k):
                body = body * PRIME + h[j : len(h) - k + 1 + j]
            s[: len(body)] = mix(body)
        at = 0
        for n in sizes:
            if n >= k:
                out.append(np.unique(s[at : at + n - k + 1]))
            elif n:
                v = np.array([n], np.uint64)
                for j in range(at, at + n):
                    v = mix(v * PRIME + h[j : j + 1])
                out.append(v)
            else:
                out.append(np.zeros(0, np.uint64))
            at += n
    return out


def prefix_length(n: int) -> int:
    """n - ceil(0.75 n) + 1"""
    return n - (3 * n + 3) // 4 + 1


def links_by_size(common: int, n: int, m: int) -> bool:
    return 100 * common >= 75 * (n + m - common)


# -- the sketch ------------------------------------------------------------
def _keys(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket, and 32 bits that tell shingles of a bucket apart."""
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _send(buckets: int):
    def run(batches):
        for b in batches:
            sets = shingle_sets(raw(b.column(0)))
            if not sets or not sum(map(len, sets)):
                continue
            h, n = np.unique(np.concatenate(sets), return_counts=True)
            bucket, low = _keys(h, buckets)
            order = np.argsort(bucket, kind="stable")
            bucket, low, n = bucket[order], low[order], n[order]
            found, at = np.unique(bucket, return_index=True)
            ones, many, counts = [], [], []
            for lo, hi in zip(at, [*at[1:], len(bucket)]):
                one = n[lo:hi] == 1
                ones.append(low[lo:hi][one].tobytes())
                many.append(low[lo:hi][~one].tobytes())
                counts.append(n[lo:hi][~one].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), *(pa.array(x, pa.binary()) for x in (ones, many, counts))],
                ["bucket", "ones", "many", "counts"])
        give_back()

    return run


def _gather(bits: int, least: int):
    def run(key, group):
        cut = lambda name: [np.frombuffer(x, np.uint32) for x in group[name].to_pylist()]
        ones, many, counts = cut("ones"), cut("many"), cut("counts")
        low = np.concatenate([*ones, *many])
        n = np.concatenate([np.ones(sum(map(len, ones)), np.uint32), *counts])
        del ones, many, counts
        order = np.argsort(low, kind="stable")
        low, n = low[order], n[order].astype(np.uint64)
        del order
        at = np.flatnonzero(np.r_[True, low[1:] != low[:-1]]) if len(low) else np.zeros(0, np.int64)
        total = np.add.reduceat(n, at) if len(at) else n
        low = low[at]
        seen = low[total >= 2]
        segment = np.zeros(bits, bool)
        segment[seen & np.uint32(bits - 1)] = True
        hot = total >= least
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()),
                         "bits": pa.array([np.packbits(segment).tobytes()], pa.binary()),
                         "hot": pa.array([low[hot].tobytes()], pa.binary()),
                         "hot_n": pa.array([np.minimum(total[hot], np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()], pa.binary())})

    return run


class Sketch:
    """How common a shingle is: 0 in one document at most, 1 in several, from 2 on by the logarithm of its count."""

    def __init__(self, buckets: int, bits: int, rows):
        self.buckets, self.bits = buckets, bits
        self.map = np.zeros(buckets * bits // 8, np.uint8)
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for r in rows:
            at = r["bucket"] * bits // 8
            self.map[at : at + bits // 8] = np.frombuffer(r["bits"], np.uint8)
            keys.append(np.uint64(r["bucket"] << 32) | np.frombuffer(r["hot"], np.uint32).astype(np.uint64))
            counts.append(np.frombuffer(r["hot_n"], np.uint32))
        key, n = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key)
        self.hot, self.hot_class = key[order], (2 + np.log2(np.maximum(n[order], 1))).astype(np.uint8)

    def classes(self, h: np.ndarray) -> np.ndarray:
        bucket, low = _keys(h, self.buckets)
        at = bucket * self.bits + (low & np.uint32(self.bits - 1)).astype(np.int64)
        out = (self.map[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        if len(self.hot):
            some = np.flatnonzero(out)
            key = (bucket[some].astype(np.uint64) << np.uint64(32)) | low[some].astype(np.uint64)
            spot = np.minimum(np.searchsorted(self.hot, key), len(self.hot) - 1)
            known = self.hot[spot] == key
            out[some[known]] = self.hot_class[spot[known]]
        return out


def build_sketch(texts: DataFrame, max_hot: int = MAX_HOT, max_bits: int = MAX_BITS) -> Sketch:
    """``texts``: one column. Within the two parameters up to about 3 TB of text; beyond, it grows with the number of buckets."""
    size = texts.agg(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0
    shingles = max(1, size // 6)
    buckets = max(8, -(-shingles // BUCKET))
    bits = 1 << 10
    while bits * 2 * buckets <= max_bits and bits * buckets < 2 * shingles:
        bits *= 2
    least = max(8, -(-shingles // max_hot))  # at most shingles / least of them occur so often
    sent = texts.mapInArrow(_send(buckets), "bucket int, ones binary, many binary, counts binary")
    rows = sent.groupBy("bucket").applyInArrow(_gather(bits, least), "bucket int, bits binary, hot binary, hot_n binary")
    # written first: the shuffled counts go before the next step
    return Sketch(buckets, bits, stored(rows, "shingle-sketch").toLocalIterator())


# -- sets and prefixes --------------------------------------------------------
def _prefixes(tokens: np.ndarray, classes: np.ndarray) -> list[np.ndarray] | None:
    """The indices of the prefix shingles that another set may hold, by order; None if there are none."""
    n = len(tokens)
    shared = np.flatnonzero(classes)
    take = prefix_length(n) - (n - len(shared))
    if take <= 0:
        return None
    out = []
    for salt in ORDER_SALTS:
        order = np.lexsort((mix(tokens[shared] ^ np.uint64(salt)), classes[shared]))
        out.append(shared[order[:take]])
    return out


def _sets(held):
    def run(batches):
        sketch = held.value
        for b in batches:
            sets = shingle_sets(raw(b.column(1)))
            n, sig, sig2, blobs, firsts = [], [], [], [], []
            flat = np.concatenate([np.zeros(0, np.uint64), *sets])
            classes, one, two = sketch.classes(flat), mix(flat), mix(flat ^ np.uint64(ORDER_SALTS[1]))
            at = 0
            for s in sets:
                part = slice(at, at + len(s))
                at += len(s)
                n.append(len(s))
                sig.append(int(one[part].sum().view(np.int64)) if len(s) else 0)
                sig2.append(int(two[part].sum().view(np.int64)) if len(s) else 0)
                pre = _prefixes(s, classes[part]) if len(s) else None
                if pre is None:
                    blobs.append(None)
                    firsts.append(None)
                else:
                    firsts.append(s[pre[0]].view(np.int64))
                    blobs.append(s.tobytes() + pre[1].astype("<u4").tobytes() + pre[2].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(sig2, pa.int64()),
                 pa.array(firsts, pa.list_(pa.int64())), pa.array(blobs, pa.binary())],
                ["doc_id", "n", "sig", "sig2", "first", "data"])
        give_back()

    return run


def _verify(batches):
    def parts(n, blob):
        k = (len(blob) - 8 * n) // 8
        s = np.frombuffer(blob, "<u8", n)
        return s, s[np.frombuffer(blob, "<u4", k, 8 * n)], s[np.frombuffer(blob, "<u4", k, 8 * n + 4 * k)]

    for b in batches:
        ok = []
        for n, x, m, y in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5))):
            (s, s2, s3), (t, t2, t3) = parts(n, x), parts(m, y)
            ok.append(bool(len(np.intersect1d(s2, t2, True)) and len(np.intersect1d(s3, t3, True))
                           and links_by_size(len(np.intersect1d(s, t, True)), n, m)))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])
    give_back()


def _linked(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    side = lambda c, n, d: nodes.select(F.col("node").alias(c), F.col("n").alias(n), F.col("data").alias(d))
    both = pairs.join(side("a", "n", "x"), "a").join(side("b", "m", "y"), "b").select("a", "b", "n", "x", "m", "y")
    return both.mapInArrow(_verify, "a long, b long")


#: Of sets of n and m shingles that first meet where ``rest`` and ``rest2`` shingles are left of their orders: may they link?
#: (intersection >= 3/7 of the sizes' sum; shingles before the meeting are not in the other set)
FITS = "4 * least(n, m) >= 3 * greatest(n, m) AND 7 * least(rest, rest2) >= 3 * (n + m)"


def _joined(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links that connect all linked nodes (a, b), and their components (node, root)."""
    # a node's shingles before its prefix's shared ones are its own, so they are not left for anyone
    left = F.ceil(F.col("n") * 0.75) - 1 + F.size("first")
    posts = nodes.select("node", "n", "least", left.alias("left"), F.posexplode("first").alias("at", "tok"))
    posts = posts.select("node", "n", "least", "tok", (F.col("left") - F.col("at")).alias("rest"))

    # each node with the least node of each of its prefix shingles
    pivot = posts.groupBy("tok").agg(F.min(F.struct("least", "node", "n", "rest")).alias("p"), F.count("*").alias("c")).where("c > 1")
    star = (posts.join(pivot.select("tok", "p"), "tok")
            .select(F.col("node").alias("a"), F.col("p.node").alias("b"), "n", "rest", F.col("p.n").alias("m"), F.col("p.rest").alias("rest2"))
            .where(f"a <> b AND {FITS}").select("a", "b").distinct())
    links = stored(_linked(stored(star, "shingle-pairs"), nodes), "shingle-links")
    parts = components(links)

    # what shares a prefix shingle across components
    placed = (posts.drop("least").join(parts, "node", "left")
              .select("tok", "node", "n", "rest", F.coalesce("root", "node").alias("part")))
    several = placed.groupBy("tok").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    shared = stored(placed.join(several.select("tok"), "tok", "left_semi"), "shingle-posts")
    # shingles held by the same nodes (those of one passage) count once, at their earliest place
    alike = shared.groupBy("tok").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("h1"),
                                      F.bit_xor(F.xxhash64("node", F.lit(1))).alias("h2"))
    name = alike.select("tok", F.xxhash64("c", "h1", "h2").alias("post"))
    shared = stored(shared.join(name, "tok").groupBy("post", "node", "n", "part").agg(F.max("rest").alias("rest")), "shingle-posts")
    # components that may hold a pair, before any pair is made
    in_part = shared.groupBy("post", "part").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("rest").alias("rest"),
                                                 F.max(F.col("rest") / F.col("n")).alias("best"))
    other = in_part.toDF("post", "p2", "lo2", "hi2", "rest2", "best2")
    across = in_part.withColumnRenamed("part", "p1").join(other, "post").where(
        "p1 < p2 AND 4 * hi >= 3 * lo2 AND 4 * hi2 >= 3 * lo AND 7 * least(rest, rest2) >= 3 * (lo + lo2) "
        "AND greatest(best, best2) >= 0.857").select("post", "p1", "p2", "lo2", "hi2", "rest2")
    side = lambda p, node, n, rest: shared.select(
        "post", F.col("part").alias(p), F.col("node").alias(node), F.col("n").alias(n), F.col("rest").alias(rest))
    # a node goes on only to components whose bounds leave it a partner
    may = "4 * n >= 3 * lo2 AND 4 * hi2 >= 3 * n AND 7 * least(rest, rest2) >= 3 * (n + greatest(lo2, ceil(0.75 * n)))"
    near = across.join(side("p1", "a", "n", "rest"), ["post", "p1"]).where(may).select("post", "p2", "a", "n", "rest")
    pairs = (near.join(side("p2", "b", "m", "rest2"), ["post", "p2"])
             .where(FITS).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    more = stored(_linked(stored(pairs, "shingle-pairs"), nodes), "shingle-links")
    if more.isEmpty():
        return links, parts
    known = parts.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return links.unionByName(more), components(known.unionByName(more))  # the components found so far are stars already


def jaccard_components(docs: DataFrame, id_col="doc_id", text_col="text", max_hot: int = MAX_HOT,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    sketch = hand_out(spark, build_sketch(rows.select("text"), max_hot, max_bits))
    path = scratch_path(spark, "shingle-sets")
    sets = stored_at(rows.mapInArrow(
        _sets(sketch), "doc_id long, n long, sig long, sig2 long, first array<long>, data binary"), path)

    # equal sets are one node
    nodes = stored(
        sets.where("data IS NOT NULL").groupBy(F.col("sig").alias("node"), "sig2")
        .agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("first").alias("first"), F.first("data").alias("data"))
        .drop("sig2"), "shingle-nodes")
    sets = stored(sets.select("doc_id", "n", "sig"), "shingle-sizes")
    drop_path(spark, path)  # from here on the nodes alone hold shingles
    links, parts = _joined(nodes)

    # the smallest id of each component's documents
    least = (sets.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
             .join(parts.withColumnRenamed("node", "sig"), "sig", "left")
             .select("sig", "least", F.coalesce("root", "sig").alias("root")))
    named = least.groupBy("root").agg(F.min("least").alias("component_id"))
    of_set = least.join(named, "root").select("sig", "component_id")
    out = sets.select("doc_id", "n", "sig").where("n > 0").join(of_set, "sig")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(empty)


def stored_components(docs: DataFrame, **kw) -> DataFrame:
    """:func:`jaccard_components`, written to the shared folder, for results that are read more than once."""
    return stored(jaccard_components(docs, **kw), "components")
