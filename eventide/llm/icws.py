"""Near-duplicates by weighted Jaccard over TF-IDF shingles (operator 10).

Words are lower-cased and stripped of punctuation; a shingle is five words
in a row (a text of one to four words is one shingle).  A shingle's weight
is ``tf * idf`` with ``idf = 1 + log((N + 1) / (df + 1)) / log(N + 1)``, df
counted over all documents.  Two documents are linked if their weighted
Jaccard similarity, sum of minima over sum of maxima, is 0.8 or more.

1. Documents are dealt into batches by a hash.  A batch sends its distinct
   shingle hashes (52 bits), sorted, counted and packed, to the ranges of
   the hash space; a range adds up the document frequencies and answers each
   batch in the order it was asked.  So about 4 bytes a shingle are moved.
2. With exact weights, a document whose shared shingles (df >= 2) weigh less
   than 0.8 of its whole weight cannot have a partner and is left alone: an
   exact bound.  The others get ``bands * rows`` improved consistent weighted
   samples.
3. Exact copies (same words) form one class.  Classes that agree in a band
   meet in blocks; where half of the samples agree they become candidates,
   and candidates' components are found.
4. Inside a component all pairs are verified in blocks by exact weighted
   Jaccard similarity, one matrix product per pair of blocks.  Links become
   counts per class and a spanning forest, never rows per pair.

Defined cases: a null text is empty; a text without words links with
nothing; repeated rows are copies of each other, also with the same doc_id;
a null doc_id is kept as null and sorts last in its group; very long texts
are handled whole; other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

import math
import string
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (U64, WordTable, drop_work, map_stream, mix64, per_worker, release, ship,
                     spans_index, text_col, write_work)
from .pairs import components, forest, groups, in_block_pairs
from .tokens import groups_of

WORDS, THRESHOLD, BANDS, ROWS, SEED = 5, 0.8, 10, 3, 20_240
HASH_BITS = 52
CHARS_PER_BATCH, MAX_FINE_BATCHES, CHARS_PER_LARGE_BATCH = 8_000_000, 4096, 64_000_000
_STRIP = string.punctuation + "«»“”„‘’–—…¡¿"


def _word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of normalised words; 0 for a word of punctuation alone."""
    out = np.zeros(len(words), U64)
    for i, w in enumerate(words):
        if w := w.lower().strip(_STRIP):
            out[i] = xxhash.xxh3_64_intdigest(w) or 1
    return out


def shingles(texts: list[str], k: int = WORDS) -> tuple[list[np.ndarray], list[bytes | None]]:
    """Per text: the sorted hashes of its shingles with repeats, and a key of its word sequence."""
    words = per_worker("shingle-words", lambda: WordTable(_word_hashes))
    split = [t.split() for t in texts]
    lens = np.fromiter(map(len, split), np.int64, len(split))
    flat = words.values([w for s in split for w in s]) if lens.sum() else np.zeros(0, U64)
    out: list[np.ndarray] = []
    keys: list[bytes | None] = []
    at = 0
    base = U64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for n in lens.tolist():
            v = flat[at:at + n]
            at += n
            if len(v) and not v.all():
                v = v[v != 0]
            if not len(v):
                out.append(np.zeros(0, U64))
                keys.append(None)
                continue
            keys.append(xxhash.xxh3_128_digest(v.tobytes()))
            size = min(k, len(v))
            h = np.full(len(v) - size + 1, U64(size), U64)
            for j in range(size):
                h = h * base + v[j:len(v) - size + 1 + j]
            h = mix64(h) >> U64(64 - HASH_BITS)
            h.sort()
            out.append(h)
    return out, keys


def counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, and how often each occurs."""
    if not len(h):
        return h, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    return h[new], np.diff(np.append(new, len(h)))


def pack_sorted(h: np.ndarray) -> bytes:
    """Sorted hashes as differences: their low four bytes, then the (few, mostly zero) high ones deflated."""
    d = np.diff(h, prepend=U64(0)).astype("<u8")
    planes = d.view(np.uint8).reshape(-1, 8)
    low = np.ascontiguousarray(planes[:, :4])
    return len(h).to_bytes(4, "little") + low.tobytes() + zlib.compress(np.ascontiguousarray(planes[:, 4:7].T).tobytes(), 1)


def unpack_sorted(buf: bytes) -> np.ndarray:
    n = int.from_bytes(buf[:4], "little")
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :4] = np.frombuffer(buf, np.uint8, 4 * n, 4).reshape(n, 4)
    planes[:, 4:7] = np.frombuffer(zlib.decompress(memoryview(buf)[4 + 4 * n:]), np.uint8).reshape(3, n).T
    return np.cumsum(planes.view("<u8").reshape(-1), dtype=U64)


def pack_counts(c: np.ndarray) -> bytes:
    """Counts in the least whole width; all ones as nothing."""
    top = int(c.max())
    if top == 1:
        return b""
    w = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([w]) + c.astype(f"<u{w}").tobytes()


def unpack_counts(buf: bytes, n: int) -> np.ndarray:
    return np.frombuffer(buf, f"<u{buf[0]}", n, 1).astype(np.int64) if buf else np.ones(n, np.int64)


def icws(h: np.ndarray, weight: np.ndarray, lens: np.ndarray, samples: int, seed: int = SEED) -> np.ndarray:
    """Improved consistent weighted samples: one row of ``samples`` 32-bit tokens per set.

    ``h``, ``weight``: the sets' elements one after the other, ``lens`` each
    at least 1.  For an element of weight w and sample k: r, c ~ Gamma(2, 1),
    b ~ U(0, 1), t = floor(log w / r + b), log a = log c - r (t - b) - r; the
    element with the least a is the sample, its token hashes (element, t).
    """
    starts = np.cumsum(lens) - lens
    out = np.empty((len(lens), samples), np.uint32)
    log_w = np.log(weight)
    half, unit = U64(0xFFFFFFFF), 2.0 ** -32
    for k in range(samples):
        salt = [U64((seed + 7919 * k + i) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) for i in range(3)]
        m = [mix64(h ^ s) for s in salt]
        u = [((x & half).astype(np.float64) + 0.5) * unit for x in m] + [((x >> U64(32)).astype(np.float64) + 0.5) * unit
                                                                         for x in m[:2]]
        r = -np.log(u[0] * u[3])
        c = -np.log(u[1] * u[4])
        t = np.floor(log_w / r + u[2])
        a = np.log(c) - r * (t - u[2]) - r
        low = np.repeat(np.minimum.reduceat(a, starts), lens)
        hit = np.flatnonzero(a == low)
        owner = np.searchsorted(starts, hit, side="right") - 1
        first = hit[np.concatenate(([True], owner[1:] != owner[:-1]))]
        token = mix64(h[first] ^ mix64(t[first].astype(np.int64).astype(U64) ^ salt[0]))
        out[:, k] = (token >> U64(32)).astype(np.uint32)
    return out


def _slices(texts: list[str], most: int = 2_000_000):
    return groups_of([len(t) for t in texts], most)


def _batch(table: pa.Table) -> tuple[list[np.ndarray], list[bytes | None]]:
    """Shingle arrays and keys of a batch's documents."""
    texts = table.column("t").to_pylist()
    sh, keys = [], []
    for lo, hi in _slices(texts):
        a, b = shingles(texts[lo:hi])
        sh += a
        keys += b
    return sh, keys


def _asked(sh: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a batch and the number of its documents that hold each."""
    docs = [counted(h)[0] for h in sh]
    return counted(np.sort(np.concatenate(docs))) if docs else (np.zeros(0, U64), np.zeros(0, np.int64))


def idf_of(df: np.ndarray, n_docs: int) -> np.ndarray:
    return 1 + np.log((n_docs + 1) / (df + 1)) / math.log(n_docs + 1)


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """Range of the hash space, ascending with the hash."""
    return ((h >> U64(HASH_BITS - 32)) * U64(ranges) >> U64(32)).astype(np.int64)


def _binary(rows: list) -> pa.Array:
    return pa.array(rows, pa.binary())


def weighted_documents(docs: DataFrame, n_docs: int, n_chars: int, id_col: str, text: str,
                       threshold: float, samples: int) -> DataFrame:
    """Every document: d, th (hash of the text), key, cid, total (weight), sig, h, tf, df.

    ``sig`` and what follows are null for a document that cannot have a
    partner.  ``h``, ``tf``, ``df`` hold the shingles with df >= 2; ``total``
    counts all.
    """
    ship(docs.sparkSession)
    fine = min(n_chars // CHARS_PER_BATCH, MAX_FINE_BATCHES)
    n = int(max(8, fine, n_chars // CHARS_PER_LARGE_BATCH))
    rows = (docs.select(F.col(id_col).cast("long").alias("d"), text_col(text).alias("t"))
            .withColumn("th", F.xxhash64("t"))
            .withColumn("b", F.pmod(F.xxhash64("d", "th"), F.lit(n)).cast("int")).repartition(n, "b"))

    def ask(table: pa.Table) -> pa.Table:
        h, c = _asked(_batch(table)[0])
        part = _range_of(h, n)
        p, size = counted(part)
        cut = np.concatenate(([0], np.cumsum(size))).tolist()
        return pa.table({"p": pa.array(p, pa.int32()), "b": pa.array([table.column("b")[0].as_py()] * len(p), pa.int32()),
                         "hashes": _binary([pack_sorted(h[a:z]) for a, z in zip(cut, cut[1:])]),
                         "counts": _binary([pack_counts(c[a:z]) for a, z in zip(cut, cut[1:])])})

    def answer(table: pa.Table) -> pa.Table:
        blobs = [unpack_sorted(x) for x in table.column("hashes").to_pylist()]
        lens = [len(x) for x in blobs]
        c = np.concatenate([unpack_counts(x, k) for x, k in zip(table.column("counts").to_pylist(), lens)])
        h = np.concatenate(blobs)
        order = np.argsort(h, kind="stable")
        hs = h[order]
        new = np.concatenate(([True], hs[1:] != hs[:-1]))
        sums = np.add.reduceat(c[order], np.flatnonzero(new))
        df = np.empty(len(h), np.int64)
        df[order] = sums[np.cumsum(new) - 1]
        cut = np.concatenate(([0], np.cumsum(lens))).tolist()
        return pa.table({"b": table.column("b"), "p": table.column("p"),
                         "df": _binary([pack_counts(df[a:z]) for a, z in zip(cut, cut[1:])]),
                         "n": pa.array(lens, pa.int64())})

    asked = rows.groupBy("b").applyInArrow(ask, "p int, b int, hashes binary, counts binary")
    answered = (asked.repartition(n, "p").groupBy("p")
                .applyInArrow(answer, "b int, p int, df binary, n long").repartition(n, "b"))

    def weigh(table: pa.Table, replies: pa.Table) -> pa.Table:
        size = table.num_rows
        out: dict[str, list] = {k: [None] * size for k in ("key", "total", "sig", "h", "tf", "df")}
        if size and replies.num_rows:
            sh, out["key"] = _batch(table)
            h, _ = _asked(sh)
            by = sorted(zip(replies.column("p").to_pylist(), replies.column("df").to_pylist(),
                            replies.column("n").to_pylist()))
            df = np.concatenate([unpack_counts(x, k) for _, x, k in by])
            idf = idf_of(df, n_docs)
            held = []
            for i, s in enumerate(sh):
                if not len(s):
                    continue
                u, tf = counted(s)
                at = np.searchsorted(h, u)
                w = tf * idf[at]
                total, shared = w.sum(), df[at] >= 2
                if w[shared].sum() >= threshold * total * (1 - 1e-9):
                    held.append((i, u, w, total, shared, tf, df[at]))
            for lo, hi in groups_of([len(x[1]) for x in held], 200_000):
                part = held[lo:hi]
                lens = np.fromiter((len(x[1]) for x in part), np.int64, len(part))
                sig = icws(np.concatenate([x[1] for x in part]), np.concatenate([x[2] for x in part]), lens, samples)
                for row, (i, u, w, total, shared, tf, d) in zip(sig, part):
                    out["total"][i], out["sig"][i] = total, row.tobytes()
                    out["h"][i] = pack_sorted(u[shared])
                    out["tf"][i], out["df"][i] = pack_counts(tf[shared]), pack_counts(d[shared])
        return pa.table({"d": table.column("d").cast(pa.int64()), "th": table.column("th").cast(pa.int64()),
                         "key": pa.array(out["key"], pa.binary()), "total": pa.array(out["total"], pa.float64()),
                         **{k: _binary(out[k]) for k in ("sig", "h", "tf", "df")}})

    return (rows.groupBy("b").cogroup(answered.groupBy("b"))
            .applyInArrow(weigh, "d long, th long, key binary, total double, sig binary, h binary, tf binary, df binary")
            .withColumn("cid", F.xxhash64("key")))


def candidates(classes: DataFrame, bands: int, rows: int, agree: float, block: int = 1024) -> DataFrame:
    """Forest edges (a, b) between classes that share a band and ``agree`` of their samples."""
    k = bands * rows
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("sig").substr(1 + 4 * rows * i, 4 * rows)) for i in range(bands)])
    banded = classes.select("cid", "sig", F.posexplode(keys).alias("band", "bucket"))

    def convert(b):
        return {"cid": b.column(4).to_numpy(), "blk": b.column(5).to_numpy(),
                "sig": np.frombuffer(b"".join(b.column(6).to_pylist()), "<u4").reshape(-1, k)}

    def run(batches):
        a_out, b_out, held = [], [], 0
        for cols, lo, hi in groups(batches, 4, convert):
            cid, sig, blk = cols["cid"][lo:hi], cols["sig"][lo:hi], cols["blk"][lo:hi]
            links = np.zeros((hi - lo, hi - lo), np.uint8)
            for s in range(k):
                links += sig[:, s, None] == sig[None, :, s]
            links = links >= agree * k
            if cols["_k2"][lo] != cols["_k3"][lo]:
                links &= blk[:, None] != blk[None, :]
            a, b = forest(cid, links)
            a_out.append(a)
            b_out.append(b)
            held += len(a)
            if held > 10_000:
                yield {"a": np.concatenate(a_out), "b": np.concatenate(b_out)}
                a_out, b_out, held = [], [], 0
        if held:
            yield {"a": np.concatenate(a_out), "b": np.concatenate(b_out)}

    paired = in_block_pairs(banded, ["band", "bucket"], "cid", block)
    return map_stream(paired.select("band", "bucket", "_i", "_j", "cid", "_b", "sig"), run, "a long, b long")


def jaccard_blocks(sets: list[tuple], step: int = 4096) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs; a set is (hashes, tf, idf, total weight)."""
    lens = np.fromiter((len(s[0]) for s in sets), np.int64, len(sets))
    h = np.concatenate([s[0] for s in sets])
    tf = np.concatenate([s[1] for s in sets]).astype(np.int64)
    idf = np.concatenate([s[2] for s in sets])
    total = np.array([s[3] for s in sets])
    row = np.repeat(np.arange(len(sets)), lens)
    # min(tf) = number of levels both reach: one column per (shingle, level).
    level = spans_index(tf)
    h, row, idf = np.repeat(h, tf), np.repeat(row, tf), np.repeat(idf, tf)
    order = np.lexsort((level, h))
    h, level, row, idf = h[order], level[order], row[order], idf[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (level[1:] != level[:-1])
    col = np.cumsum(new) - 1
    shared = np.bincount(col) >= 2 if len(col) else np.zeros(0, bool)
    keep = shared[col] if len(col) else np.zeros(0, bool)
    col = (np.cumsum(shared) - 1)[col[keep]] if keep.any() else np.zeros(0, np.int64)
    row, idf = row[keep], idf[keep]
    both = np.zeros((len(sets), len(sets)))
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, step):
        a, z = np.searchsorted(col, [lo, lo + step])
        x = np.zeros((len(sets), step))
        x[row[a:z], col[a:z] - lo] = np.sqrt(idf[a:z])
        both += x @ x.T
    return both / (total[:, None] + total[None, :] - both)


def unpacked(h: bytes, tf: bytes, df: bytes, total: float, n_docs: int) -> tuple:
    """(hashes, tf, idf, total weight) of a document's shared shingles."""
    h = unpack_sorted(h)
    return h, unpack_counts(tf, len(h)), idf_of(unpack_counts(df, len(h)), n_docs), total


def verified(members: DataFrame, n_docs: int, threshold: float, block: int = 256) -> DataFrame:
    """Per class and block: cid, links (rows of linked classes), edge (a linked class, null if none)."""

    def convert(b):
        cols = {"cid": b.column(3).to_numpy(), "blk": b.column(4).to_numpy(),
                "copies": b.column(5).to_numpy(), "total": b.column(6).to_numpy()}
        for i, name in ((7, "h"), (8, "tf"), (9, "df")):
            v = np.empty(b.num_rows, object)
            v[:] = b.column(i).to_pylist()
            cols[name] = v
        return cols

    def run(batches):
        out, held = [], 0
        for c, lo, hi in groups(batches, 3, convert):
            cid, blk, copies = c["cid"][lo:hi], c["blk"][lo:hi], c["copies"][lo:hi]
            sets = [unpacked(*x, n_docs) for x in zip(*(c[k][lo:hi] for k in ("h", "tf", "df", "total")))]
            links = jaccard_blocks(sets) >= threshold - 1e-9
            np.fill_diagonal(links, False)
            if c["_k1"][lo] != c["_k2"][lo]:
                links &= blk[:, None] != blk[None, :]
            count = links @ copies
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

    paired = in_block_pairs(members, ["comp"], "cid", block)
    return map_stream(paired.select("comp", "_i", "_j", "cid", "_b", "copies", "total", "h", "tf", "df"), run,
                      "cid long, links long, edge long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    bands: int = BANDS, rows: int = ROWS, agree: float = 0.5) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its group), n_links (other documents
    linked directly), n_group (rows of its group), text_hash, winner_hash.

    The row of the group's first (doc_id, text_hash), null ids last, has ``doc_id = class_id``
    and ``text_hash = winner_hash``.
    """
    spark = docs.sparkSession
    n_docs, n_chars = docs.select(F.count(F.lit(1)), F.coalesce(F.sum(F.length(text_col(text))), F.lit(0))).first()
    every, every_path = write_work(weighted_documents(docs, n_docs, n_chars, id_col, text, threshold,
                                                      bands * rows), "icws-documents")
    release(spark)
    shared = every.filter("sig is not null")
    classes, classes_path = write_work(
        shared.groupBy("cid").agg(F.min(F.struct(F.col("d").isNull().alias("no_id"), "d", "th")).alias("rep"), F.count(F.lit(1)).alias("copies"),
                                  F.min("sig").alias("sig")), "icws-classes")
    near = components(candidates(classes, bands, rows, agree), "icws-candidates")
    # One row of each class in a component carries the shingles; equal rows of a class are alike.
    one = (shared.select("cid", "d", "th", "total", "h", "tf", "df")
           .join(classes.select("cid", "copies", "rep")
                 .join(near.select(F.col("id").alias("cid"), F.col("component").alias("comp")), "cid"), "cid")
           .filter("d <=> rep.d and th <=> rep.th").dropDuplicates(["cid"])
           .select("comp", "cid", "copies", "total", "h", "tf", "df"))
    checked, checked_path = write_work(verified(one, n_docs, threshold), "icws-links")
    found = components(checked.select(F.col("cid").alias("a"), F.col("edge").alias("b")), "icws-groups")
    links = checked.groupBy("cid").agg(F.sum("links").alias("links"))
    per_class = (classes.select("cid", "rep", "copies").join(links, "cid", "left")
                 .join(found.withColumnRenamed("id", "cid"), "cid", "left")
                 .select("cid", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                         F.coalesce("component", "cid").alias("component")))
    whole = per_class.groupBy("component").agg(F.min("rep").alias("first"), F.sum("copies").alias("n_group"))
    per_class = per_class.join(whole, "component").select(
        "cid", "first", "n_group", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    # Documents that cannot have a partner need no class: they stay out of the join by its null key.
    alone = every.select("d", "th", F.when(F.col("sig").isNotNull(), F.col("cid")).alias("cid"))
    result, _ = write_work(
        alone.filter("cid is not null").join(per_class, "cid")
        .select("d", "th", "first.d", "first.th", "n_links", "n_group")
        .toDF("doc_id", "text_hash", "class_id", "winner_hash", "n_links", "n_group")
        .unionByName(alone.filter("cid is null")
                     .select(F.col("d").alias("doc_id"), F.col("th").alias("text_hash"), F.col("d").alias("class_id"),
                             F.col("th").alias("winner_hash"), F.lit(0).cast("long").alias("n_links"),
                             F.lit(1).cast("long").alias("n_group"))), "icws-result")
    drop_work(spark, every_path, classes_path, checked_path)
    return result


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with the columns of ``docs``."""
    names = docs.columns
    first = (near_duplicates(docs, id_col, text).filter("doc_id <=> class_id and text_hash = winner_hash")
             .select(F.col("doc_id").alias("_near_id"), F.col("text_hash").alias("_near_hash")).distinct())
    release(docs.sparkSession)
    keyed = docs.withColumn("_near_text", F.xxhash64(text_col(text)))
    on = keyed[id_col].cast("long").eqNullSafe(first["_near_id"]) & (keyed["_near_text"] == first["_near_hash"])
    kept = keyed.join(first, on, "left_semi")
    return kept.dropDuplicates([id_col, "_near_text"]).select(*names)
