"""Embedding near-duplicates by randomised-rotation binary codes (operator 6).

A unit vector o is rotated by a seeded random orthogonal matrix and kept as
its signs: code = sign(R o) / sqrt(D).  With the stored correction factor
f = <code, R o>, the estimate <code, R q> / f of <o, q> is unbiased over the
rotation, and its error stays within ``eps * sqrt((1 - f^2) / f^2 / (D - 1))``
with a probability that ``eps`` sets.

1. Valid vectors (not null, finite, not zero, with a label) are grouped:
   equal vectors of a label are one class, so copies cost nothing.
2. Candidates share a bucket: ``tables`` keys of ``bits`` signs each, within
   (label, dimension).  Every sign has a random hyperplane of its own (the code
   bits are too few to give all tables unlike keys), so tables are independent
   for any pair.  ``bits`` grows with the largest label and ``tables`` follows
   from ``bits``, so that a pair at the threshold meets with probability
   ``recall`` or more; closer pairs meet more often.
3. Buckets are worked in blocks.  The estimate's upper confidence bound drops
   a pair, all others are recomputed exactly in double precision.  A pair
   that shares several tables counts in the first of them.
4. Links become counts per vector and a spanning forest; components follow.

Defined cases: a vector that is null, zero, or holds a null or non-finite
component, and a row with a null label, links with nothing and is its own
component; vectors of unlike lengths are never compared; rows that repeat a
vec_id are rows of their own (their component id is that vec_id); an empty
table gives no row.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_work, map_batches, map_stream, per_worker, write_work
from .pairs import components, forest, groups, in_block_pairs

THRESHOLD, RECALL, EPS, SEED, BLOCK = 0.93, 0.99, 3.0, 61, 512


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix (QR of a Gaussian matrix, signs fixed)."""
    def build():
        q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
        return q * np.sign(np.diag(r))
    return per_worker(("rotation", dim, seed), build)


def encode(unit: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rotated vectors, code bits, correction factors) of unit row vectors."""
    turned = unit @ rotation(unit.shape[1], seed).T
    return turned, turned >= 0, np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])


def estimate(bits: np.ndarray, factor: np.ndarray, turned: np.ndarray, eps: float = EPS) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of <o, q> and the half-width of their bounds: rows are coded o, columns rotated q."""
    d = turned.shape[1]
    code = np.where(bits, 1.0, -1.0) / math.sqrt(d)
    est = (code @ turned.T) / factor[:, None]
    half = eps * np.sqrt(np.maximum(0.0, 1 - factor ** 2) / factor ** 2 / max(1, d - 1))
    return est, half[:, None]


def plan(largest: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits per key, number of tables) for a label of ``largest`` vectors."""
    same = 1 - math.acos(threshold) / math.pi
    bits = int(min(24, max(8, math.ceil(math.log2(max(1, largest) / 8)))))
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same ** bits))


def table_keys(unit: np.ndarray, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """Bucket keys (rows x tables) of unit row vectors: signs on fresh Gaussian hyperplanes for every table."""
    dim = unit.shape[1]
    planes = per_worker(("planes", dim, bits, tables, seed), lambda: np.random.default_rng(
        [seed, dim, bits, tables]).standard_normal((dim, tables * bits)))
    signs = (unit @ planes >= 0).reshape(len(unit), tables, bits)
    return signs @ (np.int64(1) << np.arange(bits))


def classes_of(vectors: DataFrame, id_col: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their class, one row per class): equal vectors of a label are a class."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.col(label).alias("label"))
    fine = (F.col("v").isNotNull() & F.col("label").isNotNull()
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
            & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("ok", F.coalesce(fine, F.lit(False)))
    whole = F.transform("v", lambda x: x + F.lit(0.0))   # -0.0 and 0.0 are equal
    return rows, (rows.filter("ok").groupBy("label", whole.alias("v"))
                  .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                  .withColumn("cid", F.xxhash64("label", "v")))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD, recall: float = RECALL, eps: float = EPS,
                 block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    rows, classes = classes_of(vectors, id_col, vector, label)
    classes, classes_path = write_work(classes, "codes-classes")
    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
    bits, tables = plan(sizes[0] or 1, threshold, recall)

    def bucket(b):
        cid, copies, label_h = (b.column(i).to_numpy() for i in range(3))
        vs = b.column(3).to_pylist()
        by_dim: dict[int, list[int]] = {}
        for i, v in enumerate(vs):
            by_dim.setdefault(len(v), []).append(i)
        for dim, at in by_dim.items():
            at = np.array(at)
            x = np.array([vs[i] for i in at])
            x /= np.abs(x).max(axis=1, keepdims=True)    # no overflow in the norm
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            keys = table_keys(x, bits, tables)
            n = len(at)
            raw = [r.tobytes() for r in x]
            all_keys = [r.tobytes() for r in keys.astype("<i4")]
            for t in range(tables):
                yield {"space": label_h[at], "dim": np.full(n, dim), "tab": np.full(n, t), "key": keys[:, t],
                       "cid": cid[at], "copies": copies[at], "unit": raw, "keys": all_keys}

    spread = map_batches(classes.select("cid", "copies", F.xxhash64("label").alias("l"), "v"), bucket,
                         "space long, dim int, tab int, key long, cid long, copies long, unit binary, keys binary",
                         1000)

    def convert(b):
        cols = {"cid": b.column(6).to_numpy(), "blk": b.column(7).to_numpy(), "copies": b.column(8).to_numpy()}
        for i, name in ((9, "unit"), (10, "keys")):
            cols[name] = np.empty(b.num_rows, object)
            cols[name][:] = b.column(i).to_pylist()
        return cols

    def run(batches):
        out, held = [], 0
        for c, lo, hi in groups(batches, 6, convert):
            cid, blk, copies = c["cid"][lo:hi], c["blk"][lo:hi], c["copies"][lo:hi]
            x = np.frombuffer(b"".join(c["unit"][lo:hi]), "<f8").reshape(hi - lo, -1)
            keys = np.frombuffer(b"".join(c["keys"][lo:hi]), "<i4").reshape(hi - lo, -1)
            turned, code, factor = encode(x)
            est, half = estimate(code, factor, turned, eps)
            # Either vector can be the coded one: a pair is dropped if one of the two bounds says so.
            maybe = (est + half >= threshold) & (est + half >= threshold).T
            maybe = np.triu(maybe, 1)
            if c["_k4"][lo] != c["_k5"][lo]:
                maybe &= blk[:, None] != blk[None, :]
            i, j = np.nonzero(maybe)
            t = int(c["_k2"][lo])
            if t:
                fresh = ~(keys[i, :t] == keys[j, :t]).any(axis=1)
                i, j = i[fresh], j[fresh]
            good = np.zeros(len(i), bool)
            for a in range(0, len(i), 65_536):
                good[a:a + 65_536] = np.einsum("nd,nd->n", x[i[a:a + 65_536]], x[j[a:a + 65_536]]) >= threshold
            i, j = i[good], j[good]
            if not len(i):
                continue
            count = np.zeros(hi - lo, np.int64)
            np.add.at(count, i, copies[j])
            np.add.at(count, j, copies[i])
            links = np.zeros((hi - lo, hi - lo), bool)
            links[i, j] = links[j, i] = True
            a, b = forest(cid, links)
            some = count > 0
            out.append((np.concatenate([cid[some], a]), np.concatenate([count[some], np.zeros(len(a), np.int64)]),
                        np.concatenate([cid[some], b])))
            held += len(out[-1][0])
            if held > 10_000:
                yield dict(zip(("cid", "links", "edge"), map(np.concatenate, zip(*out))))
                out, held = [], 0
        if held:
            yield dict(zip(("cid", "links", "edge"), map(np.concatenate, zip(*out))))

    paired = in_block_pairs(spread, ["space", "dim", "tab", "key"], "cid", block)
    checked, checked_path = write_work(
        map_stream(paired.select("space", "dim", "tab", "key", "_i", "_j", "cid", "_b", "copies", "unit", "keys"),
                   run, "cid long, links long, edge long"), "codes-links")
    found = components(checked.select(F.col("cid").alias("a"), F.col("edge").alias("b")), "codes-groups")
    links = checked.groupBy("cid").agg(F.sum("links").alias("links"))
    per_class = (classes.select("cid", "rep", "copies").join(links, "cid", "left")
                 .join(found.withColumnRenamed("id", "cid"), "cid", "left")
                 .select("cid", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                         F.coalesce("component", "cid").alias("component")))
    first = per_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    per_class = per_class.join(first, "component").select(
        "cid", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    mine = F.xxhash64("label", F.transform("v", lambda x: x + F.lit(0.0)))
    keyed = rows.select("vec_id", "ok", F.when(F.col("ok"), mine).alias("cid"))
    alone = keyed.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    result, _ = write_work(keyed.filter("ok").join(per_class, "cid").select("vec_id", "n_links", "component_id")
                           .unionByName(alone).withColumn("kept", F.expr("vec_id <=> component_id")), "codes-result")
    drop_work(spark, classes_path, checked_path)
    return result
