"""Language-model scoring by a hierarchical Pitman-Yor model of words.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` (A-Z in lower case) and one end per
document. The context of a token is the word directly before it in its document
(or the document's start): each context has a restaurant, so restaurants grow
with the corpus, and all of them share the root restaurant as parent, whose own
base is uniform over the training vocabulary and one class of unknown words.
Every count, seating and table covers all training documents. A context without
training tokens backs off to the root.

Seating. In restaurant r a customer of word w joins a table of n customers with weight
``n - d`` or opens one with weight ``q = (theta + D_r) * p_parent(w)`` (``D_r``: the
discounts of all tables); each table sends a customer to the parent. Gibbs sampling:
a sweep takes out all customers of each (r, w) in turn and draws their seating from
its conditional given all other restaurants, then the root's. Given q, the number of
tables t of c customers has probability proportional to ``q^t S_d(c, t)`` (``S_d``:
generalised Stirling numbers). Up to ``STIRLING`` customers it is drawn from these
weights directly; beyond, by Metropolis steps that leave the same law unchanged: all
tables but the first customer's are a Poisson process of sizes, of which a part is
drawn anew at a time (:func:`seat_many`). ``q`` is held while one seating is drawn,
and the buckets of a sweep see each other's totals of the sweep before.

Words are dealt into buckets by hash. Between sweeps the restaurants' totals are
summed over all buckets: a bucket sends the tables of its contexts to the contexts'
groups, dealt by hash, which return the sums to every bucket that holds the context;
the root's totals and the counts behind the two discounts are a few numbers in all. (A
pair with one customer has one table in every sweep, so sweeps send only what other
pairs opened beyond their first.) The sums are of whole numbers: scores depend on
the number of buckets by their random numbers alone. The sweeps after ``BURN_IN``
are averaged into predictive probabilities:

    p(w | r) = (c - d t) / (theta + c_r) + (theta + D_r) / (theta + c_r) * p_root(w)

with sums over all buckets, so that p( . | r) adds up to one.

Flow. Documents are dealt into shards by hash. A shard sends its distinct
(word, context) pairs with their training counts to the words' buckets; buckets
seat their words and answer each shard; shards score their documents. Texts are
shuffled twice, pairs once each way; a word that holds a third of all tokens is
one row per shard and context. The pairs are written once, bucketed as the sweeps
group them, so a sweep reads them in place and shuffles only seatings and sums.
Seatings are written to the shared folder after every sweep and dropped when the
next ones are there; the result is written, and all tables behind it dropped.

Null or empty texts are one end token. A null doc_id belongs to the training
part. Repeated rows count and are scored row by row.
"""

from __future__ import annotations

import math
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import drop_path, raw, scratch_path, stored_at, word_hashes, words_of

SHARD_DOCS = 5_000
SWEEPS, BURN_IN = 8, 3
THETA, THETA_ROOT = 5.0, 5.0
STIRLING = 512  # customers of a (restaurant, word) up to which the table count is drawn from its weights
STEPS = 30  # Metropolis steps beyond, times the part of the tables that a step draws anew
MAX_PARTS = 8_192  # files that the buckets' pairs are written to
END_WORD = b" end"  # no word holds a space
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
START = xxhash.xxh3_64_intdigest(b" start")

#: Rows between buckets, groups of contexts and shards: what they are, whose they are, from where, and arrays.
ROWS = "kind int, bucket int, other int, a binary, b binary, c binary, n array<long>"
TABLE = [c.split()[0] for c in ROWS.split(", ")]
STATE, ASKED, TO_GROUP, SUMS, TOTALS, EXCESS, SEATED, ANSWER = range(8)


def pack(x: np.ndarray, kind: str = "<u8") -> bytes:
    flat = x.astype(kind).tobytes()
    return len(flat).to_bytes(8, "little") + pa.compress(flat, "zstd", asbytes=True)


def unpack(x: bytes, kind: str = "<u8") -> np.ndarray:
    return np.frombuffer(pa.decompress(memoryview(x)[8:], int.from_bytes(x[:8], "little"), "zstd"), kind)


def split_doubles(x: np.ndarray) -> tuple[bytes, bytes]:
    """The lower six bytes of each double as they are, and the upper two, which have few values, compressed."""
    x = x.astype("<f8").view("<u2").reshape(-1, 4)
    return x[:, :3].tobytes(), pack(x[:, 3], "<u2")


def join_doubles(low: bytes, high: bytes) -> np.ndarray:
    high = unpack(high, "<u2")
    return np.concatenate([np.frombuffer(low, "<u2").reshape(-1, 3), high[:, None]], axis=1).view("<f8").ravel()


def _table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
    columns = zip(*rows) if rows else [[]] * len(TABLE)
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(TABLE, columns, kinds)})


def distinct(x: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with the inverse, of whole numbers below ``2 ** bits``: by one plain sort of their upper bits and places."""
    room = len(x).bit_length()
    x = x.astype(np.uint64) << np.uint64(64 - bits)
    at = np.sort(x >> np.uint64(room) << np.uint64(room) | np.arange(len(x), dtype=np.uint64))
    at &= np.uint64((1 << room) - 1)
    found = x[at]
    new = np.ones(len(x), bool)
    new[1:] = found[1:] != found[:-1]
    values = found[new]
    if (values[1:] <= values[:-1]).any():  # values of the same upper bits
        values, where = np.unique(x, return_inverse=True)
    else:
        where = np.empty(len(x), np.int64)
        where[at] = np.cumsum(new) - 1
    return values >> np.uint64(64 - bits), where


def token_pairs(texts: list[bytes]):
    """Word and context of the distinct pairs in ascending order, the pair of each token, and tokens per text."""
    hashes = [np.array([START], np.uint64)]
    for t in texts:
        words = words_of(t)
        words.append(END_WORD)
        hashes.append(word_hashes(words, len(words)))
    sizes = np.fromiter(map(len, hashes[1:]), np.int64, len(texts))
    hashes = np.concatenate(hashes)
    names, at = distinct(hashes)
    del hashes
    before = at[:-1].copy()
    before[np.cumsum(sizes) - sizes] = at[0]
    pairs, where = distinct(at[1:] * len(names) + before, 2 * len(names).bit_length())
    return names[pairs // len(names)], names[pairs % len(names)], where, sizes


def _runs(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values of ``x`` begins."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)


def _ask(log_buckets: int):
    def run(key, group):
        word, context, where, sizes = token_pairs(raw(group["text"].combine_chunks()))
        train = np.repeat(group["train"].to_numpy(zero_copy_only=False), sizes)
        n = np.bincount(where[train], minlength=len(word))
        bucket = (word >> np.uint64(64 - log_buckets)).astype(np.int64) if log_buckets else np.zeros(len(word), np.int64)
        cuts = [*_runs(bucket), len(word)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            first = _runs(word[a:b])
            size = np.diff(np.r_[first, b - a])
            words = word[a:b][first].tobytes() + size.astype("<u4").tobytes()
            out.append((ASKED, int(bucket[a]), key[0].as_py(), words, context[a:b].tobytes(), pack(n[a:b], "<u4"), None))
        return _table(out)

    return run


def discount(counts: np.ndarray) -> float:
    """From how many things were seen once and twice."""
    return discount_of(int((counts == 1).sum()), int((counts == 2).sum()))


def discount_of(one: int, two: int) -> float:
    return min(0.95, max(0.05, (one + 0.5) / (one + 2 * two + 1)))


@lru_cache(4)
def log_stirling(d: float) -> np.ndarray:
    """log S_d(c, t): the summed weights of all seatings of c customers at t tables, without those of opening tables."""
    out = np.full((STIRLING + 1, STIRLING + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(STIRLING + 1)
    for c in range(1, STIRLING):
        stay = np.log(np.maximum(c - d * t[1 : c + 1], 1e-300))
        out[c + 1, 1 : c + 1] = np.logaddexp(out[c, :c], out[c, 1 : c + 1] + stay)
        out[c + 1, c + 1] = out[c, c]
    return out


def _sibuya(rng, d: float, z: float, n: int) -> np.ndarray:
    """n table sizes k with weight ``(1-d)(2-d)...(k-1-d) / k! * z^k``: a mixture of geometric sizes, thinned by z^k."""
    out, log_z = np.zeros(0), math.log(z)
    while len(out) < n:
        p = np.maximum(rng.beta(d, 1 - d, max(16, 2 * (n - len(out)))), 1e-300)
        k = np.log(1.0 - rng.random(len(p)))
        k /= np.log1p(np.negative(p, p), p)
        np.maximum(1.0, np.ceil(k, k), k)
        k = k[rng.random(len(k)) < np.exp(k * log_z)]
        out = np.concatenate([out, k]) if len(out) else k
    return out[:n]


def seat_many(rng, c: int, d: float, weight: float) -> int:
    """The tables of c customers: a draw with probabilities proportional to ``weight^t S_d(c, t)``.

    The seating is that of the first customer's table, of m customers, and of the other tables' sizes k. Its
    weight is that of a Poisson process of rate ``weight / d`` and Sibuya sizes, times ``Gamma(m-d) / Gamma(m)``. A
    step keeps each other table with probability 1 - part, adds as many as the process has in that part, and is
    accepted by the ratio of the last factor (never if m would be below one). Sizes are tilted by z^k, and the
    factor by z^m, so that the process fits into c customers.
    """
    rate = weight / d

    def mean(z: float) -> float:
        return rate * d * z * (1 - z) ** (d - 1)

    low, z = 0.0, 1 - 1 / c
    if mean(z) > c:
        for _ in range(60):
            mid = (low + z) / 2
            low, z = (mid, z) if mean(mid) < c else (low, mid)
    window = 1 / (1 - z)
    part = min(1.0, window**2 / (c * (1 + (1 - d) * z * window)))
    fresh = part * rate * (1 - (1 - z) ** d)

    def factor(m: float) -> float:
        return math.lgamma(m - d) - math.lgamma(m) + m * math.log(z)

    sizes, now = np.zeros(0), factor(c)
    with np.errstate(divide="ignore"):  # of _sibuya; here and np.concatenate, as this loop is most of a sweep
        for _ in range(math.ceil(STEPS / part)):
            new = sizes[rng.random(len(sizes)) >= part] if len(sizes) else sizes
            more = rng.poisson(fresh)
            if more:
                more = _sibuya(rng, d, z, more)
                new = np.concatenate([new, more]) if len(new) else more
            m = c - float(np.add.reduce(new))
            if m >= 1:
                then = factor(m)
                if then >= now or rng.random() < math.exp(then - now):
                    sizes, now = new, then
    return len(sizes) + 1


def seat(rng, counts: np.ndarray, d: float, weight: np.ndarray) -> np.ndarray:
    """Tables of ``counts`` customers of a dish each, given all else; ``weight``: (theta + D_r) * p_parent(w)."""
    t = np.minimum(counts, 1).astype(np.float64)
    order = np.argsort(counts, kind="stable")
    some = counts[order]
    log_s, log_w = log_stirling(d), np.log(weight)
    for c in np.unique(some[(some > 1) & (some <= STIRLING)]).astype(np.int64):
        mine = order[np.searchsorted(some, c) : np.searchsorted(some, c, "right")]
        tables = np.arange(1, c + 1)
        for block in np.array_split(mine, -(-len(mine) * int(c) // (1 << 20))):
            p = log_w[block, None] * tables
            p += log_s[c, 1 : c + 1]
            p -= np.maximum.reduce(p, 1, keepdims=True)
            p = np.add.accumulate(np.exp(p, p), 1)
            t[block] = 1 + (p[:, :-1] <= rng.random(len(block))[:, None] * p[:, -1:]).sum(1)
    for i in order[np.searchsorted(some, STIRLING, "right") :]:
        t[i] = seat_many(rng, int(counts[i]), d, float(weight[i]))
    return t


def sweep_tables(rng, word: np.ndarray, counts: np.ndarray, t: np.ndarray, open_mass: np.ndarray, customers: np.ndarray,
                 k: np.ndarray, d: float, d_root: float, root_customers: float, root_tables: float, vocabulary: int):
    """One sweep over (context, word) pairs of a bucket and over its words in the root: tables, customers, root tables.

    ``open_mass``: theta + D_r of each pair's context; it, ``root_customers``, ``root_tables`` and
    ``vocabulary`` are those of all buckets.
    """
    base = 1.0 / (vocabulary + 1)
    new_root = THETA_ROOT + d_root * root_tables
    # the parent without the pair's own tables
    rest = np.maximum(customers[word] - t - d_root * k[word], 0.0)
    new = seat(rng, counts, d, open_mass * (rest + new_root * base) / (THETA_ROOT + root_customers))
    customers = customers + np.bincount(word, new - t, len(customers))
    return new, customers, seat(rng, customers, d_root, np.full(len(customers), new_root * base))


def sample_tables(rng, word: np.ndarray, context: np.ndarray, counts: np.ndarray, contexts: int, scale: int,
                  sweeps: int, burn_in: int):
    """Averaged seatings of pairs by themselves, in memory, as one of ``scale`` like parts; the query shares totals instead.

    ``word``: index of each (context, word) pair's word.
    Returns d, d_root, tables per pair, customers and tables of the root per word.
    """
    n_words = int(word.max()) + 1
    d = discount(counts)
    t = np.ones(len(counts))
    customers = np.bincount(word, t, n_words)
    d_root = discount(customers)
    k = np.ones(n_words)
    mean_t, mean_c, mean_k = np.zeros(len(t)), np.zeros(n_words), np.zeros(n_words)
    for sweep in range(sweeps):
        open_mass = THETA + d * np.bincount(context, t, contexts) * scale
        t, customers, k = sweep_tables(rng, word, counts, t, open_mass[context], customers, k, d, d_root,
                                       customers.sum() * scale, k.sum() * scale, n_words * scale)
        if sweep >= burn_in:
            mean_t += t
            mean_c += customers
            mean_k += k
    kept = max(1, sweeps - burn_in)
    return d, d_root, mean_t / kept, mean_c / kept, mean_k / kept


def _send(bucket: int, names: np.ndarray, values: list[np.ndarray], groups: int) -> list[tuple]:
    """Messages of a bucket to the groups of its (ascending) contexts."""
    group = ((names >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
    cuts = [*_runs(group), len(names)]
    return [(TO_GROUP, bucket, int(group[a]), names[a:b].tobytes(), pack(np.concatenate([v[a:b] for v in values])), None, None)
            for a, b in zip(cuts, cuts[1:])]


def _sum_groups(kind: int):
    """Sums per context over all buckets, sent back to each in the order it asked in."""
    def run(key, group):
        names = [np.frombuffer(x, np.uint64) for x in group["a"].to_pylist()]
        values = [unpack(x).reshape(-1, len(n)) for x, n in zip(group["b"].to_pylist(), names)]
        _, where = np.unique(np.concatenate(names), return_inverse=True)
        both = np.concatenate(values, axis=1)
        total = [np.zeros(where.max() + 1, np.uint64) for _ in both]
        for t, v in zip(total, both):
            np.add.at(t, where, v)
        out, at = [], 0
        for bucket, n in zip(group["bucket"].to_pylist(), names):
            mine = where[at : at + len(n)]
            at += len(n)
            out.append((kind, bucket, key[0].as_py(), pack(np.concatenate([t[mine] for t in total])), None, None, [len(n)]))
        return _table(out)

    return run


def _returned(rows: list[dict], kind: int, columns: int) -> list[np.ndarray]:
    mine = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["other"])
    parts = [unpack(r["a"]).reshape(columns, -1).astype(np.float64) for r in mine]
    return list(np.concatenate(parts, axis=1)) if parts else [np.zeros(0)] * columns


def _gather(groups: int):
    """The distinct pairs of a bucket with their counts, and where those of each shard are."""
    def run(key, group):
        bucket = key[0].as_py()
        shards, words, sizes, contexts, counts = group["other"].to_pylist(), [], [], [], []
        for a, b, c in zip(group["a"].to_pylist(), group["b"].to_pylist(), group["c"].to_pylist()):
            n = len(a) // 12
            words.append(np.frombuffer(a, np.uint64, n))
            sizes.append(np.frombuffer(a, "<u4", n, 8 * n))
            contexts.append(np.frombuffer(b, np.uint64))
            counts.append(unpack(c, "<u4"))
        asked = list(map(len, contexts))
        # arrays of all that was asked, in 8 bytes each: as few as possible at a time
        contexts = np.concatenate(contexts)
        names, pair = distinct(contexts)
        del contexts
        word = np.repeat(np.unique(np.concatenate(words), return_inverse=True)[1], np.concatenate(sizes))
        n_words = int(word.max()) + 1
        word *= len(names)
        pair += word
        del words, sizes, word
        pairs, where = distinct(pair, (n_words * len(names)).bit_length())
        del pair
        pairs = pairs.astype(np.int64)
        c = np.bincount(where, np.concatenate(counts), len(pairs)).astype(np.int64)
        word, ctx = pairs // len(names), pairs % len(names)
        out = [(STATE, bucket, -1, names.tobytes(), pack(np.diff(word, prepend=0), "<u1"), pack(ctx, "<u4"), None),
               (STATE, bucket, -2, pack(c), None, None, None)]
        at = 0
        for shard, n in zip(shards, asked):
            out.append((ASKED, bucket, shard, pack(np.diff(where[at : at + n], prepend=0), "<u4"), None, None, None))
            at += n
        c_word = np.bincount(word, c)
        customers = np.bincount(word, c > 0)
        of = [(c_word > 0).sum(), c.sum(), (c > 0).sum(), (c == 1).sum(), (c == 2).sum(), (customers == 1).sum(), (customers == 2).sum()]
        out.append((SUMS, bucket, -1, None, None, None, [int(x) for x in of]))
        out += _send(bucket, names, [np.bincount(ctx, c, len(names)), np.bincount(ctx, c > 0, len(names))], groups)
        return _table(out)

    return run


class Bucket:
    """What a bucket holds, from its rows: all pairs, and the live ones, those with more than one customer."""

    def __init__(self, rows: list[dict]):
        one = next(r for r in rows if r["kind"] == STATE and r["other"] == -1)
        self.names = np.frombuffer(one["a"], np.uint64)
        self.word = np.cumsum(unpack(one["b"], "<u1").astype(np.int64))
        self.ctx = unpack(one["c"], "<u4").astype(np.int64)
        self.counts = unpack(next(r for r in rows if r["kind"] == STATE and r["other"] == -2)["a"]).astype(np.int64)
        self.n_words = int(self.word[-1]) + 1
        self.first = np.bincount(self.word, self.counts > 0, self.n_words)  # root customers if each pair has one table
        self.live = np.flatnonzero(self.counts > 1)
        self.live_ctx, self.live_at = np.unique(self.ctx[self.live], return_inverse=True)
        self.c_r, self.n_r = _returned(rows, TOTALS, 2)  # in the first sweep and for the answers
        seated = next((r for r in rows if r["kind"] == SEATED), None)
        if seated is None:
            self.t, self.k = np.ones(len(self.live)), (self.first > 0).astype(np.float64)
            self.sum_t, self.sum_k = np.zeros(len(self.live)), np.zeros(self.n_words)
            self.n_live = self.n_r[self.live_ctx]
        else:
            self.n_live = unpack(seated["c"]).astype(np.float64)
            self.t, self.sum_t = unpack(seated["a"]).reshape(2, -1).astype(np.float64)
            self.k, self.sum_k = unpack(seated["b"]).reshape(2, -1).astype(np.float64)

    def customers(self, excess: np.ndarray) -> np.ndarray:
        return self.first + np.bincount(self.word[self.live], excess, self.n_words)


def _sweep(sweep: int, groups: int, keep: bool, last: bool, d: float, d_root: float, root_customers: float, root_tables: float,
           vocabulary: int):
    def run(key, pairs, moving):
        bucket, rows = key[0].as_py(), pairs.to_pylist() + moving.to_pylist()
        b = Bucket(rows)
        excess = _returned(rows, EXCESS, 1)[0] if sweep else np.zeros(len(b.live_ctx))
        known = np.flatnonzero(b.first)
        index = np.zeros(b.n_words, np.int64)
        index[known] = np.arange(len(known))
        open_mass = (THETA + d * (b.n_live + excess))[b.live_at]
        # the seating depends on the buckets' counts alone, so a task run again gives the same
        t, customers, k = sweep_tables(
            np.random.default_rng([bucket, sweep]), index[b.word[b.live]], b.counts[b.live], b.t, open_mass,
            b.customers(b.t - 1)[known], b.k[known], d, d_root, root_customers, root_tables, vocabulary)
        b.k[known] = k
        if keep:
            b.sum_t = b.sum_t + t - 1
            b.sum_k = b.sum_k + b.k
        out = [(SEATED, bucket, -1, pack(np.concatenate([t, b.sum_t])), pack(np.concatenate([b.k, b.sum_k])), pack(b.n_live), None),
               (SUMS, bucket, -1, None, None, None, [int(x) for x in (customers.sum(), k.sum(), b.sum_t.sum(), b.sum_k.sum())])]
        if last:  # every context asked for, with what the kept sweeps sum to
            out += _send(bucket, b.names, [np.bincount(b.ctx[b.live], b.sum_t, len(b.names))], groups)
        else:
            out += _send(bucket, b.names[b.live_ctx], [np.bincount(b.live_at, t - 1, len(b.live_ctx))], groups)
        return _table(out)

    return run


def _answer(kept: int, d: float, d_root: float, root_customers: float, root_tables: float, vocabulary: int):
    """log10 p of each shard's pairs and the training counts of its words."""
    def run(key, pairs, moving):
        rows = pairs.to_pylist() + moving.to_pylist()
        b = Bucket(rows)
        d_r = d * (b.n_r + _returned(rows, EXCESS, 1)[0] / kept)
        t = (b.counts > 0).astype(np.float64)
        t[b.live] += b.sum_t / kept
        root = b.customers(b.sum_t / kept) - d_root * b.sum_k / kept
        p_root = (root + (THETA_ROOT + d_root * root_tables) / (vocabulary + 1)) / (THETA_ROOT + root_customers)
        p = (b.counts - d * t + (THETA + d_r)[b.ctx] * p_root[b.word]) / (THETA + b.c_r[b.ctx])
        log_p, c_word = np.log10(p), np.bincount(b.word, b.counts, b.n_words)
        out = []
        for r in rows:
            if r["kind"] == ASKED:
                mine = np.cumsum(unpack(r["a"], "<u4").astype(np.int64))
                w = b.word[mine]
                low, high = split_doubles(log_p[mine])
                out.append((ANSWER, key[0].as_py(), r["other"], low, pack(c_word[w[_runs(w)]]), high, None))
        return _table(out)

    return run


def _score(total: int, vocabulary: int):
    def run(key, docs, answers):
        texts = raw(docs["text"].combine_chunks()) if docs.num_rows else []
        if not texts:
            return SCORES.empty_table()
        word, _, where, sizes = token_pairs(texts)
        answers = answers.sort_by("bucket")
        model = np.concatenate([join_doubles(x, y) for x, y in zip(answers["a"].to_pylist(), answers["c"].to_pylist())])
        c_word = np.concatenate([unpack(x) for x in answers["b"].to_pylist()]).astype(np.float64)
        first = _runs(word)
        if len(model) != len(word) or len(c_word) != len(first):
            raise ValueError("the answers are not those of this shard")
        c_word = np.repeat(c_word, np.diff(np.r_[first, len(word)]))
        base = np.log10((c_word + 1) / (total + vocabulary + 1))
        at = np.r_[0, np.cumsum(sizes)[:-1]]
        add = lambda v: np.add.reduceat(v[where], at)
        return pa.table([
            docs["doc_id"].combine_chunks(), pa.array(~docs["train"].to_numpy(zero_copy_only=False)), pa.array(sizes),
            pa.array(add((c_word > 0).astype(np.int64))), pa.array(np.full(len(sizes), int(total))),
            pa.array(add(base)), pa.array(add(model))], schema=SCORES)

    return run


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


class _Tables:
    """The tables of one run in the shared folder; shuffle files behind one, which nothing reads again, go when it is written."""

    def __init__(self, spark):
        self.spark, self.paths, self.names = spark, {}, []

    def _write(self, name: str, write):
        path = self.paths[name] = scratch_path(self.spark, name)
        conf, before = self.spark.conf, self.spark.conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")
        try:
            return write(path)
        finally:
            conf.set(CLEANUP, before)

    def store(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        return self._write(name, lambda path: stored_at(df, path, *by))

    def store_bucketed(self, df: DataFrame, name: str, parts: int) -> DataFrame:
        """By kind, and in files by bucket: what groups one kind by bucket reads it without a shuffle."""
        self.names.append(f"pitman_yor_{uuid.uuid4().hex}")
        return self._write(name, lambda path: df.write.partitionBy("kind").bucketBy(parts, "bucket").option("path", path)
                           .saveAsTable(self.names[-1]) or self.spark.table(self.names[-1]))

    def drop(self, *names: str) -> None:
        for name in names:
            drop_path(self.spark, self.paths.pop(name))

    def drop_all(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []
        self.drop(*list(self.paths))


def _sums(rows: DataFrame, n: int) -> list[int]:
    """The few numbers of the whole table: those of all buckets added up."""
    found = rows.where(F.col("kind") == SUMS).agg(*[F.sum(F.col("n")[i]).alias(f"x{i}") for i in range(n)]).first()
    return [int(x or 0) for x in found]


def scores(docs: DataFrame, contexts: int | None = None, shard_docs: int = SHARD_DOCS, sweeps: int = SWEEPS,
           burn_in: int = BURN_IN, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every document.

    ``contexts``: in how many groups the contexts' totals are summed (as many as buckets by default); no
    context is left out.
    """
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (~held_out).alias("train"))
    n = rows.count()
    shards = max(1, -(-n // shard_docs))
    log_buckets = max(0, (shards - 1).bit_length())
    groups = contexts or 1 << log_buckets
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))
    asked = dealt.groupBy("shard").applyInArrow(_ask(log_buckets), ROWS)
    kept = _Tables(docs.sparkSession)
    try:
        parts = min(1 << log_buckets, MAX_PARTS)
        held = kept.store_bucketed(asked.groupBy("bucket").applyInArrow(_gather(groups), ROWS), "pairs", parts)
        answers, total, vocabulary = _sampled(kept, held, groups, sweeps, burn_in)
        mine = answers.select(F.col("other").alias("shard"), "bucket", "a", "b", "c")
        out = kept.store(dealt.groupBy("shard").cogroup(mine.groupBy("shard")).applyInArrow(
            _score(total, vocabulary),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "scores")
        kept.paths.pop("scores")
        return out
    finally:
        kept.drop_all()


def _sampled(kept: _Tables, held: DataFrame, groups: int, sweeps: int, burn_in: int) -> tuple[DataFrame, int, int]:
    """All sweeps over the buckets' pairs: the answers to the shards, training tokens and vocabulary."""
    vocabulary, total, pairs, *seen = _sums(held, 7)
    d, d_root = discount_of(*seen[:2]), discount_of(*seen[2:])
    of_kind = lambda df, *kinds: df.where(F.col("kind").isin(*kinds)).select(*TABLE)
    summed = lambda df, kind: of_kind(df, TO_GROUP).groupBy("other").applyInArrow(_sum_groups(kind), ROWS)

    def with_pairs(moving: DataFrame, run, *kinds: int) -> DataFrame:
        return of_kind(held, *kinds).groupBy("bucket").cogroup(moving.groupBy("bucket")).applyInArrow(run, ROWS)

    moving = totals = kept.store(summed(held, TOTALS), "totals")
    root_customers, root_tables = pairs, vocabulary  # a table for each pair and one in the root for each word
    for sweep in range(sweeps):
        run = _sweep(sweep, groups, sweep >= burn_in, sweep == sweeps - 1, d, d_root, root_customers, root_tables, vocabulary)
        now = kept.store(with_pairs(moving, run, STATE), f"seatings-{sweep}", "kind")
        if sweep:
            kept.drop(f"seatings-{sweep - 1}")
        root_customers, root_tables, sum_t, sum_k = _sums(now, 4)
        moving = of_kind(now, SEATED).unionByName(summed(now, EXCESS))
    n = max(1, sweeps - burn_in)
    run = _answer(n, d, d_root, pairs + sum_t / n, sum_k / n, vocabulary)
    answers = kept.store(with_pairs(moving.unionByName(totals), run, STATE, ASKED), "answers")
    kept.drop("pairs", "totals", f"seatings-{sweeps - 1}")
    return answers, total, vocabulary
