"""Importance resampling towards a target text (operator 2).

Texts are bags of hashed word unigrams and bigrams.  Two generative models,
the bucket frequencies of the target texts and of all raw texts, give each
document the log importance weight ``sum over its n-grams of log p_target -
log p_raw``; sampling without replacement in proportion to the weights is
the top k of ``log weight + Gumbel noise``, the noise seeded by doc_id.

Both models are fitted on all their texts: the target's are found by a
sort-merge join with the target's ids, so no side has to fit one machine.
Counts are added up per bucket by Spark (partial sums per task, sent as
sparse pairs).  The k-th largest key is found exactly
by counting keys in ever finer bins, so no sort and no row limit is needed.

Defined cases: a null or empty text has no n-gram and weight 0; without
target texts all weights are 0 and the sample is uniform; ties of the key go
to the smaller doc_id; of rows that repeat, each is sampled by itself but
with equal noise, in the order of the text's hash; an empty table gives no
row.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, WordTable, map_batches, map_stream, mix64, per_worker, text_col, write_work
from .tokens import groups_of

BUCKETS, FRACTION, SMOOTHING, SEED, BINS = 1 << 16, 0.85, 1.0, 4_711, 4096


def _hash_words(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), U64, len(words))


def buckets_of(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every uni- and bigram of the texts, and the number of them per text."""
    table = per_worker("resample-words", lambda: WordTable(_hash_words))
    split = [t.split() for t in texts]
    lens = np.fromiter(map(len, split), np.int64, len(split))
    if not lens.sum():
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    one = table.values([w for s in split for w in s])
    doc = np.repeat(np.arange(len(texts)), lens)
    with np.errstate(over="ignore"):
        two = mix64(one[:-1] * U64(0x9E3779B97F4A7C15) + one[1:])[doc[1:] == doc[:-1]]
    doc = np.concatenate([doc, doc[1:][doc[1:] == doc[:-1]]])
    all_ = np.concatenate([mix64(one), two]) % U64(buckets)
    order = np.argsort(doc, kind="stable")
    return all_[order].astype(np.int64), np.bincount(doc, minlength=len(texts))


def models(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """log p_target - log p_raw per bucket, from all rows of ``raw`` and ``target`` (t)."""

    def run(batches):
        sums = np.zeros(buckets, np.int64)
        for b in batches:
            texts = b.column(0).to_pylist()
            for lo, hi in groups_of([len(t) for t in texts], 2_000_000):
                at, _ = buckets_of(texts[lo:hi], buckets)
                sums += np.bincount(at, minlength=buckets)
        used = np.flatnonzero(sums)
        yield {"bucket": used, "n": sums[used]}

    def counted(docs, raw_n, target_n):
        return map_stream(docs.select("t"), run, "bucket int, n long").select(
            "bucket", target_n.cast("long").alias("target"), raw_n.cast("long").alias("raw"))

    none, n = F.lit(0), F.col("n")
    parts = counted(raw, n, none).unionByName(counted(target, none, n))
    total = parts.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).collect()
    count = np.zeros((2, buckets))                       # one row per bucket at most
    for r in total:
        count[:, r.bucket] = r.target, r.raw
    if not count[0].any():
        return np.zeros(buckets)
    log_p = np.log(count + SMOOTHING) - np.log(count.sum(axis=1, keepdims=True) + SMOOTHING * buckets)
    return log_p[0] - log_p[1]


def gumbel(col, seed: int = SEED):
    """Standard Gumbel noise from a hash of ``col``: -log(-log(u)), 0 < u < 1."""
    h = F.xxhash64(F.lit(seed), col)
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) * F.lit(2.0 ** -53)
    return -F.log(-F.log(u))


def kth_largest(keys: DataFrame, key: str, k: int) -> float:
    """The k-th largest value, exactly: counts per bin, then the bins of the bin that holds it."""
    lo, hi, n = keys.agg(F.min(key), F.max(key), F.count(key)).first()
    if k >= n:
        return lo
    above = 0     # keys over hi
    while lo < hi:
        step = (hi - lo) / BINS
        if step == 0 or lo + step == lo:
            break
        bin_ = F.least(F.floor((F.col(key) - lo) / step), F.lit(BINS - 1))
        rows = (keys.filter(F.col(key).between(lo, hi)).groupBy(bin_.alias("bin"))
                .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("a"), F.max(key).alias("z")).collect())
        for r in sorted(rows, key=lambda r: -r.bin):
            if above + r.n >= k:
                break
            above += r.n
        lo, hi = r.a, r.z
    return hi


def weighted(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text",
             buckets: int = BUCKETS) -> DataFrame:
    """doc_id, th (hash of the text), n_grams, log_weight; ``target``: the doc_ids of target texts."""
    ids = F.col("doc_id").cast("long").alias("doc_id")
    marks = target.select(ids).filter("doc_id is not null").distinct()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col(text).alias("t"))
    # merge: the same plan for a small and a large target, whose ids need not fit a broadcast
    log_ratio = models(rows, rows.join(marks.hint("merge"), "doc_id", "left_semi"), buckets)
    shared = docs.sparkSession.sparkContext.broadcast(log_ratio)     # 8 bytes a bucket

    def run(b):
        texts = b.column(1).to_pylist()
        weight, size = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for lo, hi in groups_of([len(t) for t in texts], 2_000_000):
            at, n = buckets_of(texts[lo:hi], buckets)
            size[lo:hi] = n
            if len(at):
                sums = np.concatenate(([0.0], np.cumsum(shared.value[at])))
                ends = np.cumsum(n)
                weight[lo:hi] = sums[ends] - sums[ends - n]
        return {"doc_id": b.column(0), "th": b.column(2), "n_grams": size, "log_weight": weight}

    return map_batches(rows.withColumn("th", F.xxhash64("t")), run,
                       "doc_id long, th long, n_grams long, log_weight double", 1000)


def resample(docs: DataFrame, target: DataFrame, fraction: float = FRACTION, k: int | None = None,
             id_col: str = "doc_id", text: str = "text", buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """The sample: doc_id, n_grams, log_weight, sample_key; ``k`` rows, or ``fraction`` of all."""
    keys, _ = write_work(weighted(docs, target, id_col, text, buckets)
                         .withColumn("sample_key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)),
                         "resample-keys")
    if k is None:
        k = math.ceil(fraction * keys.count())
    if k <= 0:
        return keys.filter("false").drop("th")
    edge = kth_largest(keys, "sample_key", k)
    if edge is None:
        return keys.drop("th")
    over = keys.filter(F.col("sample_key") > edge)
    # Ties at the edge: rows of one doc_id as a rule; the smallest (doc_id, text hash) first.
    ties = (keys.filter(F.col("sample_key") == edge).orderBy("doc_id", "th").limit(max(0, k - over.count())))
    return over.unionByName(ties).drop("th")
