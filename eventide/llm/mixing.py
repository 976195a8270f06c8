"""Mixing sources to target weights by Poisson replication (operator 8).

A source's mean repetition rate is ``target share * output size / source
size``.  Each document draws its number of copies by inverting the Poisson
distribution of that mean at a uniform value hashed from (seed, doc_id), is
exploded by it, and all copies are dealt out globally by a hashed order.

The cumulative distribution is kept per source as an array over the values
within 12 standard deviations of the mean; what lies outside is below 2 ** -60.
So the inversion is a count of array entries, and the array grows with the
square root of the rate only.  A document of many copies is exploded in steps,
so that no row holds a list of them all.

Defined cases: a null source is a source of its own; a null text stays null;
a source without a target has rate 0 (no copies) if targets are given; rows
that repeat draw the same number; very long texts are copied whole; an empty
table gives no row.  All input columns stay; the new ones get a prefix that no
input column begins with (:func:`free_prefix`).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, partitions, write_work

SEED = 9_973
BROADCAST_VALUES = 1 << 20      # distribution values of all sources that may be broadcast (8 MB)
STEP = 4096                     # copies per step of an explosion


def poisson_cdf(mean: float) -> tuple[int, list[float]]:
    """k0 and P(X <= k0), P(X <= k0 + 1), ...; the rest on either side is below 2 ** -60."""
    reach = 12 * math.sqrt(mean) + 30
    k = first = max(0, math.floor(mean - reach))
    out, total = [], 0.0
    while k <= mean + reach:
        total += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) if mean > 0 else float(k == 0)
        out.append(min(1.0, total))
        k += 1
    return first, out


def free_prefix(docs: DataFrame, prefix: str = "_mix_") -> str:
    """``prefix``, lengthened until no column of ``docs`` begins with it."""
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return prefix


def uniform(*cols, seed: int = SEED):
    """(0, 1), 52 bits of a SHA-256: the same value in any SQL engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return (F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") + 0.5) * F.lit(2.0 ** -52)


def rates(docs: DataFrame, targets: dict | None, size: float, source: str = "source") -> DataFrame:
    """Per source: s, rate (mean copies per document), first and cdf (as poisson_cdf); without targets all sources weigh the same.

    Only the totals over all sources reach the driver.
    """
    counts = docs.groupBy(F.col(source).cast("string").alias("s")).agg(F.count(F.lit(1)).alias("n"))

    def weight(s) -> float:
        return 1.0 if targets is None else targets.get(s, 0.0)

    def weigh(b):
        s = b.column(0).to_pylist()
        return {"s": s, "n": b.column(1), "w": [weight(x) for x in s]}

    weighed, _ = write_work(map_batches(counts, weigh, "s string, n long, w double"), "mix-sources")
    got = weighed.agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
    total, whole = got.n or 0, got.w or 1.0

    def rate(b):
        m = [w / whole * size * total / n for w, n in zip(b.column(2).to_pylist(), b.column(1).to_pylist())]
        first, cdf = zip(*map(poisson_cdf, m)) if m else ((), ())
        return {"s": b.column(0), "rate": m, "first": list(first), "cdf": list(cdf)}

    return map_batches(weighed, rate, "s string, rate double, first long, cdf array<double>", 64)


def replicate(docs: DataFrame, targets: dict | None = None, size: float = 1.0, id_col: str = "doc_id",
              source: str = "source", seed: int = SEED, prefix: str | None = None) -> DataFrame:
    """The documents' rows, copied and shuffled: all columns and ``<prefix>rate``, ``copies``, ``copy``, ``order``.

    ``size``: expected output rows as a multiple of the input.  The rows come
    range-partitioned and sorted by ``order``, a hash of (seed, doc_id, copy).
    """
    spark, columns = docs.sparkSession, docs.columns
    prefix = prefix or free_prefix(docs)
    new = {c: f"{prefix}{c}" for c in ("s", "rate", "first", "cdf", "u", "copies", "step", "copy", "order")}
    plan, _ = write_work(rates(docs, targets, size, source).toDF(*[new[c] for c in ("s", "rate", "first", "cdf")]),
                         "mix-rates")
    on = docs[source].cast("string").eqNullSafe(plan[new["s"]])
    # broadcast only below a checked size, else Spark's own choice
    values = plan.agg(F.sum(F.size(new["cdf"]) + 4)).first()[0] or 0
    joined = docs.join(F.broadcast(plan) if values <= BROADCAST_VALUES else plan, on, "left")
    copies = F.col(new["first"]) + F.size(F.filter(new["cdf"], lambda p: p <= F.col(new["u"])))
    n, step = F.col(new["copies"]), F.col(new["step"])
    drawn = (joined.withColumn(new["u"], uniform(F.col(id_col), seed=seed)).withColumn(new["copies"], copies)
             .select(*columns, new["rate"], new["copies"]).filter(n > 0)
             .withColumn(new["step"], F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / STEP))))
             .withColumn(new["copy"], F.explode(F.sequence(step * STEP + 1, F.least(step * STEP + STEP, n))))
             .drop(new["step"]))
    order = uniform(F.col(id_col), F.col(new["copy"]), seed=seed + 1)
    return (drawn.withColumn(new["order"], order)
            .repartitionByRange(partitions(spark), new["order"]).sortWithinPartitions(new["order"], id_col))
