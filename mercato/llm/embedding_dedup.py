"""Near duplicates among embeddings by int8 tile products with error bounds.

Vectors are compared only within a label (and dimension). Equal vectors are one
class, so a group of copies is one row from here on. A label's classes are dealt
into tiles by a hash; each pair of tiles is one task with two tiles at most, so a
label that holds a third of all rows is many tasks.

In a task each unit vector ``x`` becomes ``s * q`` with ``q`` in int8 and the
rest ``e = x - s * q``. From ``x.y = (s q).(t r) + (s q).e_y + e_x.y`` and
``|y| = 1`` the error of the int8 product is at most ``|s q| |e_y| + |e_x|``. Only
pairs whose product plus that bound reaches the threshold are computed again in
double precision; no pair at or above it is missed.

A task returns one row per vector (how many vectors it links, and the smallest
vector of its links' component within the task), never all pairs. The rows'
links are then joined into components over all tasks.

Vectors that are null, empty, zero or hold null or non-finite components, and
rows without a label, link with nothing: n_links 0, component_id their own id,
kept. Repeated rows count as vectors of their own. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import components, small, stored

THRESHOLD = 0.98
TILE = 2_048
CHUNK = 256  # rows of a tile multiplied at once
VERIFY = 50_000  # pairs computed again at once


def quantised(x: np.ndarray):
    """int8 codes, scales, norms of what the codes stand for, and norms of the rest, of unit vectors."""
    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None])
    back = q * scale[:, None]
    return q.astype(np.int8), scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


def tile_links(x: np.ndarray, y: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (of x and y, or i < j of x alone) with a cosine of at least ``threshold``."""
    # a power of two as divisor keeps every bit and the squares within range
    shrink = lambda v: v / np.exp2(np.floor(np.log2(np.abs(v).max(axis=1, keepdims=True))))
    x = shrink(x)
    same = y is None
    y = x if same else shrink(y)
    ux, uy = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    qx, sx, nx, ex = quantised(ux)
    qy, sy, _, ey = (qx, sx, nx, ex) if same else quantised(uy)
    # products of int8 codes are whole numbers below 2**24 up to 1,040 dimensions: float32 is exact there
    kind = np.float32 if x.shape[1] <= 1_040 else np.float64
    right = np.ascontiguousarray(qy.astype(kind).T)
    left, far = [], []
    for lo in range(0, len(x), CHUNK):
        part = slice(lo, lo + CHUNK)
        near = (qx[part].astype(kind) @ right).astype(np.float64) * sx[part, None] * sy[None, :]
        bound = nx[part, None] * ey[None, :] + ex[part, None]
        i, j = np.nonzero(near + bound >= threshold - 1e-9)
        i += lo
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), VERIFY):
            a, b = i[at : at + VERIFY], j[at : at + VERIFY]
            ok = _cosines(x[a], y[b]) >= threshold
            left.append(a[ok])
            far.append(b[ok])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *far])


def _local_roots(n: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id of each node's component."""
    root = ids.copy()
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == root).all():
            return root
        root = new


def _task(threshold: float):
    def run(key, group):
        t1 = key[2].as_py()
        tile = group["tile"].to_numpy()
        rep = group["rep"].to_numpy()
        size = group["size"].to_numpy()
        flat = group["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        vec = flat.reshape(len(rep), -1)
        order = np.argsort(rep, kind="stable")
        tile, rep, size, vec = tile[order], rep[order], size[order], vec[order]
        if key[2].as_py() == key[3].as_py():
            a, b = tile_links(vec, None, threshold)
        else:
            x, y = np.flatnonzero(tile == t1), np.flatnonzero(tile != t1)
            if not len(x) or not len(y):
                a = b = np.zeros(0, np.int64)
            else:
                a, b = tile_links(vec[x], vec[y], threshold)
                a, b = x[a], y[b]
        n = np.bincount(a, size[b], len(rep)) + np.bincount(b, size[a], len(rep))
        some = n > 0
        roots = _local_roots(len(rep), a, b, rep)
        return pa.table({"rep": rep[some], "root": roots[some], "n": n[some].astype(np.int64)})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, id_col="vec_id",
                    vec_col="embedding", label_col="label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).alias("embedding"))
    v = F.col("embedding")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    usable = (F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite
              & F.exists(v, lambda c: c != 0))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.where("usable").withColumn("hash", F.xxhash64("embedding"))

    # copies of a vector are one class, represented by its smallest id
    classes = stored(
        good.groupBy("label", "hash", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
        .withColumn("rep", F.coalesce("least", F.xxhash64("label", "embedding")))
        .withColumn("dim", F.size("embedding")), "vector-classes")
    per = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    per = small(per, per.count(), 64)
    dealt = classes.join(per, ["label", "dim"]).withColumn("tile", F.pmod(F.col("hash"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    tasks = dealt.select("label", "dim", "tile", "rep", "size", "embedding", other).select(
        "label", "dim", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"),
        "tile", "rep", "size", "embedding")
    found = stored(tasks.groupBy("label", "dim", "t1", "t2").applyInArrow(
        _task(threshold), "rep long, root long, n long"), "vector-links")
    links = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    degree = found.groupBy("rep").agg(F.sum("n").alias("n"))
    of_class = (classes.join(degree, "rep", "left").join(links.withColumnRenamed("node", "rep"), "rep", "left")
                .select("label", "hash", "embedding", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                        F.coalesce("root", "least").alias("component_id")))
    out = good.join(of_class, ["label", "hash", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
