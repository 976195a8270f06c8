"""Pair work in bounded blocks, and connected components, for near-duplicate operators.

A bucket with many rows is cut into blocks by a hash of the row id; a task
gets one pair of blocks, so no bucket meets in one task and no pair becomes
a row: tasks return sums per row and a spanning forest of the links found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_work, map_stream, partitions, write_work


def in_block_pairs(rows: DataFrame, keys: list[str], row_id: str, block: int) -> DataFrame:
    """Rows of buckets with two rows or more, once per pair of blocks they take part in.

    Adds ``_b`` (the row's block), ``_i``, ``_j`` (the pair, ``_i <= _j``).
    Rows come hash-partitioned and sorted by (keys, _i, _j).
    """
    count = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    n = partitions(rows.sparkSession)
    blocks = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    dealt = (rows.join(count, keys)
             .withColumn("_nb", blocks)
             .withColumn("_b", F.pmod(F.xxhash64(row_id), F.col("_nb")).cast("int"))
             .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
             .withColumn("_i", F.least("_b", "_o")).withColumn("_j", F.greatest("_b", "_o"))
             .drop("_n", "_nb", "_o"))
    return (dealt.repartition(n, *keys, "_i", "_j")
            .sortWithinPartitions(*keys, "_i", "_j", row_id))


def groups(batches: Iterator, n_keys: int, convert: Callable) -> Iterator[tuple[dict, int, int]]:
    """Consecutive rows with equal first ``n_keys`` columns: (columns, lo, hi).

    ``convert(batch)`` gives a dict of numpy arrays; a group that goes on in
    the next batch is held back, so memory is one group and one batch.
    """
    held: dict | None = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = [np.asarray(b.column(i).to_numpy(zero_copy_only=False)) for i in range(n_keys)]
        cols = convert(b) | {f"_k{i}": k for i, k in enumerate(keys)}
        if held:
            cols = {c: np.concatenate([held[c], v]) for c, v in cols.items()}
        size = len(cols["_k0"])
        new = np.zeros(size, bool)
        new[0] = True
        for i in range(n_keys):
            k = cols[f"_k{i}"]
            new[1:] |= k[1:] != k[:-1]
        first = np.flatnonzero(new)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            yield cols, lo, hi
        held = {c: v[first[-1]:] for c, v in cols.items()}
    if held:
        yield held, 0, len(held["_k0"])


def forest(ids: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, smallest id reachable) of a symmetric boolean matrix, one for each other row."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    label = rank.copy()
    while True:
        best = np.where(links, label[None, :], n).min(axis=1, initial=n)
        new = np.minimum(label, best)
        new = np.minimum(new, new[order[new]])   # label of the label
        if (new == label).all():
            break
        label = new
    moved = label != rank
    return ids[moved], ids[order[label[moved]]]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component): the smallest id reachable, for all ids of ``edges`` (a, b).

    Alternating large-star and small-star steps: every step hooks a vertex's
    neighbours to the smallest of them, so the number of rounds grows with
    the logarithm of the largest component.  Edges stay distributed and are
    written to the shared folder after every round.
    """
    spark = edges.sparkSession
    now, path = write_work(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                           .filter("a <> b").distinct(), name)
    mark = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").filter("b > a").select(F.col("m").alias("a"), "b")
                 .filter("a <> b").distinct())
        # every vertex with its smaller neighbours
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(low, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .union(low.select(F.col("m").alias("a"), "b")).filter("a <> b").distinct())
        small = small.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        nxt, nxt_path = write_work(small, name)
        seen = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_work(spark, path)
        now, path = nxt, nxt_path
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("b").alias("id"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())


__all__ = ["components", "drop_work", "forest", "groups", "in_block_pairs", "map_stream"]
