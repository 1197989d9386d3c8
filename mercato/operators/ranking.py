"""Global order statistics without a single-partition window.

``PERCENT_RANK() OVER (ORDER BY v)``, ``SUM(v) OVER (ORDER BY v DESC)`` and
``ROW_NUMBER() OVER (ORDER BY ...)`` have no ``PARTITION BY``; Spark plans them by
moving every row to one task. Here they are prefix scans: rows are dealt by ranges
of their value, each range is worked on by itself, and a small frame carries what
stands before it.

* :func:`percent_ranks`, :func:`running_share` (integers and floating point):
  buckets cut at quantiles, one exchange of the rows per key, a window inside the
  bucket plus the bucket's offset. Rows are kept; nothing is joined back. See
  :func:`_scans`.
* :func:`numbered`: a stored range-partitioned sort and a count per partition.
* :func:`ordered_prefixes` (any key, decimals too): aggregates to distinct values
  (``count``, ``sum``), combined map-side, then a window by bucket over those; the
  caller joins the result back to its rows on the value. Distinct values make ROWS equal
  RANGE: ties share the result.

Buckets are a pure, monotone function of the value (binary search over the
boundaries), so equal values share a bucket and recomputation after a lost
executor gives the same bucket. NaN (greatest) and NULL (ordered last, either
direction) get buckets of their own. The driver receives quantiles and bucket
totals: a few numbers per shuffle partition and key. The input is read once per
job, so pass a checkpointed (or cheap) frame; the public helpers checkpoint it
unless told it already is.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.session import ensure_checkpoint_dir

log = logging.getLogger("mercato")

N = "_n"  # rows holding the value
N_BEFORE = "_n_before"  # rows strictly before the value
N_UPTO = "_n_upto"  # rows before or tied with the value
_BUCKET = "_bucket"
_KEYD = "_key_d"
_SPEC = "_spec"


@dataclass(frozen=True)
class Spec:
    """One ordering: by ``key`` (ascending unless ``descending``), summing ``sums``."""

    key: str
    sums: tuple[str, ...] = ()
    descending: bool = False


@dataclass(frozen=True)
class Prefix:
    """Per distinct key: ``key, _n, _n_before, _n_upto`` and ``<s>, <s>_upto`` per sum."""

    frame: DataFrame
    total_rows: int
    totals: dict  # summed column -> total over all rows (exact for decimals), None if no value


def default_buckets(df: DataFrame) -> int:
    """One bucket per shuffle partition, so the window's tasks stay as small as any other shuffle's."""
    value = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        return max(1, int(value))
    except ValueError:
        log.warning("spark.sql.shuffle.partitions is %r; ranking with 200 buckets", value)
        return 200


def _accuracy(buckets: int) -> int:
    """Of the quantile boundaries: well below one bucket's share of the rows."""
    return max(10_000, 4 * buckets)


def reliable(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` into the shared checkpoint folder (eagerly)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def numbered(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """``df`` plus the place of each row, from 1 on, in a total ``order``: ``ROW_NUMBER() OVER (ORDER BY ...)``.

    A range-partitioned sort, stored, then a prefix scan over its partitions:
    the driver gets one count per partition and hands each its offset, and a
    row's place inside its partition comes from its generated id. No row moves
    after the sort, and no task holds more than its range. ``order`` must leave
    no ties, or tied rows are numbered as they happen to come.
    """
    placed = reliable(df.orderBy(*order))
    generated = F.monotonically_increasing_id()  # partition << 33 | place: fixed, as the frame is stored
    rows = placed.select("*", F.shiftright(generated, 33).cast("int").alias("_part"),
                         generated.bitwiseAND((1 << 33) - 1).alias("_place"))
    held = {r["_part"]: r[N] for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias(N)).collect()}
    run, before = 1, []
    for part in sorted(held):
        before.append((part, run))
        run += held[part]
    offsets = df.sparkSession.createDataFrame(before, "_part int, _off long")
    return rows.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_off") + F.col("_place")).alias(name))


def _order(col: Column, descending: bool) -> Column:
    return col.desc_nulls_last() if descending else col.asc_nulls_last()


def _distinct(df: DataFrame, spec: Spec) -> DataFrame:
    return df.groupBy(spec.key).agg(F.count(F.lit(1)).alias(N), *[F.sum(s).alias(s) for s in spec.sums])


def _parse(text: str | None, dtype: str):
    if text is None:
        return None
    if dtype.startswith("decimal"):
        return Decimal(text)
    if dtype in ("double", "float"):
        return float(text)
    return int(text)


def _lit(value, dtype: str) -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    return F.lit(str(value)).cast(dtype)


def _add_nullable(offset: Column, running: Column) -> Column:
    # SUM ignores NULLs: a NULL offset (nothing summed yet) adds nothing
    return F.when(offset.isNull(), running).when(running.isNull(), offset).otherwise(offset + running)


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _bucketize(frame: DataFrame, key: str, bounds: list[float], null_bucket: int) -> DataFrame:
    """``frame`` plus ``_bucket``: index of the boundary interval holding ``key``
    (binary search, JVM-side), ``null_bucket`` for NULL keys."""
    with_keyd = frame.select("*", F.coalesce(F.col(key).cast("double"), F.lit(0.0)).alias(_KEYD))
    if bounds:
        splits = [float("-inf")] + bounds + [float("inf")]
        with_keyd = Bucketizer(splits=splits, inputCol=_KEYD, outputCol=_BUCKET, handleInvalid="keep").transform(
            with_keyd
        )
    else:
        with_keyd = with_keyd.withColumn(_BUCKET, F.lit(0.0))
    bucket = F.when(F.col(key).isNull(), F.lit(null_bucket)).otherwise(F.col(_BUCKET).cast("int"))
    return with_keyd.withColumn(_BUCKET, bucket).drop(_KEYD)


def ordered_prefixes(
    df: DataFrame, specs: list[Spec], buckets: int | None = None, plain: bool = False
) -> list[Prefix]:
    """One :class:`Prefix` per spec, from two small jobs in total.

    Both jobs aggregate the rows of ``df`` directly (partial aggregation, no
    shuffle of rows): job 1 gives row and sum totals and the quantile
    boundaries of every key in one pass; job 2 counts rows and sums per
    bucket. Only the final plan aggregates to distinct values for the window.
    ``plain=True`` uses one global window per spec instead (a single task;
    for tests that check the bucketed path against it).
    """
    distinct = [_distinct(df, s) for s in specs]
    types = [dict(d.dtypes) for d in distinct]
    nb = buckets or default_buckets(df)
    probs = [i / nb for i in range(1, nb)]

    # job 1: one pass over the rows for totals and boundaries of every key
    stat_cols = [F.count(F.lit(1)).alias("rows")]
    for i, spec in enumerate(specs):
        stat_cols += [F.sum(s).cast("string").alias(f"_t{i}_{s}") for s in spec.sums]
        if probs and not plain:
            stat_cols.append(F.percentile_approx(F.col(spec.key).cast("double"), probs, _accuracy(nb)).alias(f"_b{i}"))
    stats = df.agg(*stat_cols).first()
    total_rows = int(stats["rows"] or 0)
    prefixes = [
        Prefix(d, total_rows, {s: _parse(stats[f"_t{i}_{s}"], types[i][s]) for s in spec.sums})
        for i, (spec, d) in enumerate(zip(specs, distinct))
    ]

    if plain:
        out = []
        for spec, p in zip(specs, prefixes):
            w = Window.orderBy(_order(F.col(spec.key), spec.descending)).rowsBetween(Window.unboundedPreceding, 0)
            frame = p.frame.select(
                spec.key, N, *spec.sums,
                F.sum(N).over(w).alias(N_UPTO),
                *[F.sum(s).over(w).alias(f"{s}_upto") for s in spec.sums],
            ).withColumn(N_BEFORE, F.col(N_UPTO) - F.col(N))
            out.append(Prefix(frame, p.total_rows, p.totals))
        return out

    bounds = [
        sorted({b for b in (stats[f"_b{i}"] or []) if b is not None}) if probs else [] for i in range(len(specs))
    ]
    # Bucketizer keeps NaN in index len(bounds) + 1, above every number (NaN
    # sorts greatest); NULL gets its own index after it and is ordered last
    null_buckets = [len(b) + 2 for b in bounds]

    # job 2: rows and sums per bucket of every key (at most one row per bucket and key)
    totals_parts = [
        _bucketize(df.select(spec.key, *spec.sums), spec.key, bounds[i], null_buckets[i])
        .groupBy(_BUCKET)
        .agg(
            F.lit(i).alias(_SPEC),
            F.count(F.lit(1)).alias(N),
            F.array(*[F.sum(s).cast("string") for s in spec.sums] or [F.lit(None).cast("string")]).alias("sums"),
        )
        for i, spec in enumerate(specs)
    ]
    per_bucket: dict[int, dict[int, tuple]] = {i: {} for i in range(len(specs))}
    for r in _union_all(totals_parts).collect():
        per_bucket[r[_SPEC]][r[_BUCKET]] = (r[N], r["sums"])

    out = []
    for i, (spec, d, p) in enumerate(zip(specs, distinct, prefixes)):
        null_bucket = null_buckets[i]
        finite = sorted((k for k in per_bucket[i] if k != null_bucket), reverse=spec.descending)
        order = finite + ([null_bucket] if null_bucket in per_bucket[i] else [])
        off_n: dict[int, int] = {}
        off_s: dict[str, dict[int, object]] = {s: {} for s in spec.sums}
        run_n, run_s = 0, {s: None for s in spec.sums}
        for k in order:
            n_k, sums_k = per_bucket[i][k]
            off_n[k] = run_n
            run_n += int(n_k)
            for j, s in enumerate(spec.sums):
                off_s[s][k] = run_s[s]
                v = _parse(sums_k[j], types[i][s])
                if v is not None:
                    run_s[s] = v if run_s[s] is None else run_s[s] + v

        # offsets travel as a tiny frame (at most one row per bucket: a proven
        # bound), broadcast to the bucketed distinct values
        off_fields = [T.StructField(_BUCKET, T.IntegerType(), False), T.StructField("_off_n", T.LongType(), False)]
        off_fields += [T.StructField(f"_off_{s}", d.schema[s].dataType, True) for s in spec.sums]
        offsets = df.sparkSession.createDataFrame(
            [tuple([k, off_n[k]] + [off_s[s][k] for s in spec.sums]) for k in order], T.StructType(off_fields)
        )
        w = Window.partitionBy(_BUCKET).orderBy(_order(F.col(spec.key), spec.descending)).rowsBetween(
            Window.unboundedPreceding, 0
        )
        frame = (
            _bucketize(d, spec.key, bounds[i], null_bucket)
            .join(F.broadcast(offsets), _BUCKET)
            .select(
                spec.key, N, *spec.sums,
                (F.col("_off_n") + F.sum(N).over(w)).alias(N_UPTO),
                *[_add_nullable(F.col(f"_off_{s}"), F.sum(s).over(w)).alias(f"{s}_upto") for s in spec.sums],
            )
            .withColumn(N_BEFORE, F.col(N_UPTO) - F.col(N))
        )
        out.append(Prefix(frame, p.total_rows, p.totals))
    return out


def ordered_prefix(df: DataFrame, key: str, sums: tuple[str, ...] = (), descending: bool = False,
                   buckets: int | None = None, plain: bool = False) -> Prefix:
    return ordered_prefixes(df, [Spec(key, tuple(sums), descending)], buckets=buckets, plain=plain)[0]


@dataclass(frozen=True)
class _Scan:
    """What carries a key's prefix scan from bucket to bucket."""

    bucket: str  # the rows' column
    offsets: DataFrame  # per bucket: _off (rows, or sum, before it), _upto (with it), _hot (one value on more rows than a bucket's share)

    def carried(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their bucket's offsets (at most two rows per shuffle partition: a proven bound) and ``_part``,
        which deals a hot bucket's rows out as they lie in the frame."""
        rows = rows.join(F.broadcast(self.offsets), self.bucket)
        return rows.withColumn("_part", F.when(F.col("_hot"), F.spark_partition_id()).otherwise(-1))

    def window(self, order: Column):
        return Window.partitionBy(self.bucket, "_part").orderBy(order)


def _scans(df: DataFrame, keys: list[str], buckets: int, descending: bool = False, sums: bool = False
           ) -> tuple[DataFrame, list[_Scan], int, int | None]:
    """The rows of the stored ``df`` with a bucket for each key (integers or doubles), the keys' prefix scans,
    the number of rows and the last key's total; two small jobs for all keys.

    Buckets are cut at quantiles, and each quantile is a bucket of its own. A
    value on more rows than a bucket's share is a quantile, so it stands alone; its rows all
    share one result and need not meet in one task. Null and NaN have buckets of
    their own too. ``sums`` carries sums of the key (integers) instead of numbers of rows.
    """
    whole = [isinstance(df.schema[k].dataType, T.IntegralType) for k in keys]
    values, places = [f"_v{i}" for i in range(len(keys))], [f"_b{i}" for i in range(len(keys))]
    probs = [i / buckets for i in range(1, buckets)]
    cols = [F.count(F.lit(1)).alias("rows")]
    if probs:
        cols += [F.percentile_approx(F.col(k).cast("double"), probs, _accuracy(buckets)).alias(f"_q{i}") for i, k in enumerate(keys)]
    stats = df.agg(*cols).first()
    n = int(stats["rows"] or 0)

    splits, alone = [], []
    for i in range(len(keys)):
        quantiles = {b + 0.0 for b in (stats[f"_q{i}"] or []) if b is not None and math.isfinite(b)} if probs else set()
        # [b, the next number) holds b alone
        cuts = sorted((quantiles | {math.nextafter(b, math.inf) for b in quantiles}) - {math.inf}) or [0.0]
        splits.append([-math.inf, *cuts, math.inf])
        one_value = not whole[i] or all(abs(b) < 2**53 for b in quantiles)  # greater integers may share a double
        alone.append({j for j, x in enumerate(splits[i]) if one_value and x in quantiles} | {len(splits[i]) - 1, len(splits[i])})
    rows = df.select("*", *[F.coalesce(F.col(k).cast("double") + F.lit(0.0), F.lit(0.0)).alias(v) for k, v in zip(keys, values)])
    rows = Bucketizer(splitsArray=splits, inputCols=values, outputCols=places, handleInvalid="keep").transform(rows)
    rows = rows.select(*df.columns, *[F.when(F.col(k).isNull(), F.lit(len(x))).otherwise(F.col(b).cast("int")).alias(b)
                                      for k, b, x in zip(keys, places, splits)])
    value = [F.col(k).cast("long") if sums else F.lit(1).cast("long") for k in keys]
    measures = [F.struct(F.lit(i).alias("m"), F.col(b).alias("b"), v.alias("v")) for i, (b, v) in enumerate(zip(places, value))]
    held: list[dict[int, tuple[int, int | None]]] = [{} for _ in keys]
    per_bucket = rows.select(F.inline(F.array(*measures))).groupBy("m", "b").agg(F.count(F.lit(1)).alias(N), F.sum("v").alias("v"))
    for r in per_bucket.collect():  # at most one row per key and bucket
        held[r["m"]][r["b"]] = (r[N], r["v"])

    scans, run = [], None
    for i, b in enumerate(places):
        null = len(splits[i])
        order = sorted((x for x in held[i] if x != null), reverse=descending) + [x for x in held[i] if x == null]
        run, carried = None if sums else 0, []
        for x in order:
            count, v = held[i][x]
            upto = run if v is None else (run or 0) + v
            carried.append((x, run, upto, x in alone[i] and count > n // buckets))
            run = upto
        scans.append(_Scan(b, df.sparkSession.createDataFrame(carried, f"{b} int, _off long, _upto long, _hot boolean")))
    return rows, scans, n, run


def percent_ranks(
    df: DataFrame,
    columns: dict[str, str],
    buckets: int | None = None,
    plain: bool = False,
    checkpointed: bool = False,
) -> DataFrame:
    """``df`` plus, per ``key -> out``, ``PERCENT_RANK() OVER (ORDER BY key)``.

    (rank - 1) / (n - 1), ties share the lowest rank, 0 when n = 1. Each key
    (integers or floating point) costs one exchange of the rows, by bucket:
    the rank inside the bucket plus the rows before the bucket. Rows are kept,
    so nothing is joined back.
    """
    if not (plain or checkpointed):
        df = reliable(df)
    kinds = [df.schema[k].dataType for k in columns]
    if plain or not all(isinstance(k, (T.IntegralType, T.DoubleType, T.FloatType)) for k in kinds):
        return _percent_ranks_apart(df, columns, buckets, plain)
    rows, scans, n, _ = _scans(df, list(columns), buckets or default_buckets(df))
    for (key, name), scan in zip(columns.items(), scans):
        before = F.col("_off") + F.rank().over(scan.window(F.col(key).asc_nulls_last())) - 1
        share = before.cast("double") / F.lit(float(n - 1)) if n > 1 else F.lit(0.0)
        rows = scan.carried(rows).withColumn(name, share).drop("_off", "_upto", "_hot", "_part", scan.bucket)
    return rows


def _percent_ranks_apart(df: DataFrame, columns: dict[str, str], buckets: int | None, plain: bool) -> DataFrame:
    """Each key ranked on its own and joined back (decimals, and the plain window of the tests)."""
    specs = [Spec(k) for k in columns]
    out = df
    for (key, name), p in zip(columns.items(), ordered_prefixes(df, specs, buckets=buckets, plain=plain)):
        n = p.total_rows
        pr = (F.col(N_BEFORE).cast("double") / F.lit(float(n - 1))) if n > 1 else F.lit(0.0)
        ranks = p.frame.select(F.col(key).alias("_rank_key"), pr.alias(name))
        out = out.join(ranks, out[key].eqNullSafe(ranks["_rank_key"])).drop("_rank_key")
    return out


def percent_rank_of(df: DataFrame, key: str, out: str, buckets: int | None = None, plain: bool = False,
                    checkpointed: bool = False) -> DataFrame:
    return percent_ranks(df, {key: out}, buckets=buckets, plain=plain, checkpointed=checkpointed)


def running_share(
    df: DataFrame,
    key: str,
    cumulative: str,
    share: str | None = None,
    buckets: int | None = None,
    plain: bool = False,
    checkpointed: bool = False,
    to_double=lambda c: c.cast("double"),
) -> DataFrame:
    """``df`` plus ``SUM(key) OVER (ORDER BY key DESC) / SUM(key)`` (RANGE frame: ties share).

    Also ``share`` = key / total when given. Both are doubles, dividing
    ``to_double`` of the exact sums; NULL when the total is 0 or NULL.
    """
    if not (plain or checkpointed):
        df = reliable(df)
    if plain or not isinstance(df.schema[key].dataType, T.IntegralType):
        return _running_share_joined(df, key, cumulative, share, buckets, plain, to_double)
    rows, (scan,), _, total = _scans(df, [key], buckets or default_buckets(df), descending=True, sums=True)
    whole = to_double(_lit(total or None, "bigint"))
    inside = F.sum(F.col(key).cast("long")).over(scan.window(F.col(key).desc_nulls_last()))  # RANGE: ties share
    upto = F.when(F.col("_hot"), F.col("_upto")).otherwise(_add_nullable(F.col("_off"), inside))
    out = scan.carried(rows).withColumn(cumulative, to_double(upto) / whole)
    out = out.drop("_off", "_upto", "_hot", "_part", scan.bucket)
    return out.withColumn(share, to_double(F.col(key)) / whole) if share else out


def _running_share_joined(df, key, cumulative, share, buckets, plain, to_double) -> DataFrame:
    """By distinct values, joined back (decimals, and the plain window of the tests)."""
    p = ordered_prefix(df.select(key, F.col(key).alias("_v")), key, sums=("_v",), descending=True,
                       buckets=buckets, plain=plain)
    total = p.totals["_v"]
    tot_lit = to_double(_lit(total if total is not None and total != 0 else None, dict(df.dtypes)[key]))
    cum = p.frame.select(F.col(key).alias("_share_key"), (to_double(F.col("_v_upto")) / tot_lit).alias(cumulative))
    out = df.join(cum, df[key].eqNullSafe(cum["_share_key"])).drop("_share_key")
    if share:
        out = out.withColumn(share, to_double(F.col(key)) / tot_lit)
    return out
