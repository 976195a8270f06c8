"""Conversation prefix trie (operator 12): count-min screening, then exact grouping.

A node of depth d is a distinct sequence of d first turns; its members are the
conversations that start with it.  Every prefix gets a 128-bit digest by
chaining the digests of its turns; equal digests are equal prefixes.

* **Screening.**  All prefix digests go into a count-min sketch whose counters
  stop at two.  An estimate of one proves that a prefix has one member, and so
  have all that extend it: this tail of nodes is known from its own
  conversation and is emitted there.  An estimate of two or more proves
  nothing, such prefixes are *possibly shared*.  The sketch has a fixed largest
  size (``ROWS * MAX_WIDTH`` bytes); fuller sketches prove less, and the result
  stays the same.
* **Exact grouping.**  Only possibly shared prefixes are shuffled: one partial
  aggregate by digest finds the smallest member and the greatest length.  The
  smallest members come back to the conversations; prefixes that hold a
  thousandth of all rows or more, of which there are a thousand at most, come
  back by a broadcast, so no hot prefix meets in one task.
* **Subtrees without levels.**  If c is the smallest member of its node at
  depth k, it is that of all its deeper nodes too.  So one number r(c), the
  first such depth, tells which nodes c stands for.  A node's children and
  leaves are counted through the members that stand for them, and
  ``saved_tokens``, the sum of (members - 1) * words over a subtree, is the sum
  over its members c of the words of the turns k <= j < r(c).  Every statistic
  is thus a plain sum over members, with a partial aggregate.
* **End lists.**  The ids that end at a node are sorted over ranges, joined to
  segments, and the segments of a node run through SHA-256 one after the
  other; no list is ever held whole.

A conversation is one record of about 40 bytes a turn; texts only pass the
shuffle that orders the turns.

Defined cases: rows with a null conversation id name no conversation and are
left out; null role or text is empty; turns with equal numbers are ordered by
role, then text (null numbers first); repeated rows are turns of their own;
very long texts are only digested; an empty table has no node; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_work, map_batches, map_stream, partitions, write_work

ROWS, MAX_WIDTH, SLICE = 3, 1 << 23, 1 << 16
HOT_SHARE = 1000      # a prefix with 1/HOT_SHARE of all rows comes back by broadcast
SEGMENT = 1 << 18     # characters of an end list's segment
_WORDS = r"[^\x20\x09-\x0D]+"


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """Turns in order: conv_id, place (1, 2, ...), key (128-bit digest of role and text), words."""
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("t"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("r"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("x"))
    order = Window.partitionBy("conv_id").orderBy(F.col("t").asc_nulls_first(), "r", "x")
    key = F.unhex(F.md5(F.concat(F.length("r").cast("string"), F.lit(":"), F.col("r"), F.col("x")).cast("binary")))
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("place"), key.alias("key"),
                       F.regexp_count("x", F.lit(_WORDS)).cast("long").alias("words"))


def chains(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, n, chain (16 bytes a prefix), total (words of the first 0 .. n turns).

    ``ids`` may add conversations without turns.
    """
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "key", "words"))).alias("t"))
    if ids is not None:
        lists = ids.select("conv_id").distinct().join(lists, "conv_id", "left")
    none = F.array().cast("array<binary>")
    rows = lists.select("conv_id", F.coalesce(F.col("t.key"), none).alias("keys"),
                        F.coalesce(F.col("t.words"), F.array().cast("array<long>")).alias("words"))

    def run(b):
        conv, keys, words = (b.column(i).to_pylist() for i in range(3))
        chain, total = [], []
        for ks, ws in zip(keys, words):
            d, parts = b"", []
            for k in ks:
                d = hashlib.blake2b(d + k, digest_size=16).digest()
                parts.append(d)
            chain.append(b"".join(parts))
            total.append([0, *np.cumsum(np.asarray(ws, np.int64)).tolist()])
        return {"conv_id": conv, "n": [len(k) for k in keys], "chain": chain, "total": total}

    return map_batches(rows, run, "conv_id long, n int, chain binary, total array<long>")


def cells(chain: bytes, width: int) -> np.ndarray:
    """The sketch cells of every prefix: ``ROWS`` columns (digests are uniform already)."""
    part = np.frombuffer(chain, "<u4").reshape(-1, 4)[:, :ROWS].astype(np.int64)
    return part % width + np.arange(ROWS) * width


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """Count-min sketch of all prefixes, counters 0, 1 and 2 (two or more).

    Tasks send their own sketches in compressed slices; a slice is added up in
    one streaming pass.  The result has ``ROWS * width`` bytes.
    """
    def own(batches):
        counts = np.zeros(ROWS * width, np.uint8)
        for b in batches:
            for chain in b.column(0).to_pylist():
                at = cells(chain, width).reshape(-1)
                np.add.at(counts, at, 1)
                np.minimum.at(counts, at, 2)
        for k in range(0, len(counts), SLICE):
            part = counts[k:k + SLICE]
            if part.any():
                yield {"slice": [k // SLICE], "counts": [zlib.compress(part.tobytes(), 1)]}

    def add(batches):
        number, held = None, None
        for b in batches:
            for k, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(raw), np.uint8)
                if k == number:
                    held = np.minimum(held + part, 2)
                    continue
                if number is not None:
                    yield {"slice": [number], "counts": [zlib.compress(held.tobytes(), 1)]}
                number, held = k, part
        if number is not None:
            yield {"slice": [number], "counts": [zlib.compress(held.tobytes(), 1)]}

    schema = "slice int, counts binary"
    parts = map_stream(rows.select("chain"), own, schema)
    merged = map_stream(parts.repartition(partitions(rows.sparkSession), "slice").sortWithinPartitions("slice"),
                        add, schema)
    out = np.zeros(ROWS * width, np.uint8)
    for r in merged.collect():       # at most ROWS * MAX_WIDTH bytes in all
        part = np.frombuffer(zlib.decompress(r.counts), np.uint8)
        out[r.slice * SLICE:r.slice * SLICE + len(part)] = part
    return out


def screened(rows: DataFrame, width: int) -> DataFrame:
    """Adds s (prefixes 1 .. s are possibly shared, deeper ones proven single) and their digests."""
    sc = rows.sparkSession.sparkContext
    counts = sc.broadcast(sketch(rows, width))

    def run(b):
        conv, n, chain, total = (b.column(i).to_pylist() for i in range(4))
        shared = []
        for c in chain:
            single = (counts.value[cells(c, width)] == 1).any(axis=1)
            s = int(single.argmax()) if single.any() else len(single)
            shared.append([c[16 * k:16 * k + 16] for k in range(s)])
        return {"conv_id": conv, "n": n, "s": [len(x) for x in shared], "shared": shared, "total": total}

    return map_batches(rows, run, "conv_id long, n int, s int, shared array<binary>, total array<long>")


def smallest_members(rows: DataFrame) -> DataFrame:
    """conv_id, firsts: per possibly shared prefix its smallest member and greatest length."""
    member = rows.select("conv_id", "n", F.posexplode("shared").alias("k", "g"))
    found, path = write_work(member.groupBy("g").agg(F.min("conv_id").alias("first"), F.max("n").alias("longest"),
                                                     F.count("*").alias("m")), "trie-groups")
    total = found.agg(F.sum("m")).first()[0] or 0
    hot = F.broadcast(found.filter(F.col("m") * HOT_SHARE >= total).drop("m"))    # HOT_SHARE rows at most
    cold = member.join(hot.select("g"), "g", "left_anti").join(found.drop("m"), "g")
    both = member.join(hot, "g").select("conv_id", "k", "first", "longest").unionByName(
        cold.select("conv_id", "k", "first", "longest"))
    return both.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("k", "first", "longest"))).alias("firsts")), path


def end_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids (ascending, comma-joined) per (node, depth) of rows (node, depth, conv_id)."""
    n = partitions(ends.sparkSession)

    def segments(batches):
        key, first, held, size = None, 0, [], 0
        for b in batches:
            for node, depth, c in zip(*(b.column(i).to_pylist() for i in range(3))):
                if key != (node, depth) or size > SEGMENT:
                    if held:
                        yield {"node": [key[0]], "depth": [key[1]], "first": [first], "ids": [",".join(held)]}
                    key, first, held, size = (node, depth), c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
        if held:
            yield {"node": [key[0]], "depth": [key[1]], "first": [first], "ids": [",".join(held)]}

    def digests(batches):
        key, state = None, None
        for b in batches:
            for node, depth, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 3))):
                if key == (node, depth):
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    yield {"node": [key[0]], "depth": [key[1]], "ends_sha256": [state.hexdigest()]}
                key, state = (node, depth), hashlib.sha256(ids.encode())
        if key is not None:
            yield {"node": [key[0]], "depth": [key[1]], "ends_sha256": [state.hexdigest()]}

    by_range = ends.repartitionByRange(n, "node", "depth", "conv_id").sortWithinPartitions("node", "depth", "conv_id")
    parts = map_stream(by_range, segments, "node long, depth int, first long, ids string")
    by_node = parts.repartition(n, "node", "depth").sortWithinPartitions("node", "depth", "first")
    return map_stream(by_node, digests, "node long, depth int, ends_sha256 string")


def _at(array: Column, k: Column) -> Column:
    """Element k (from 0)."""
    return F.get(array, k)


def prefix_trie(turns: DataFrame, ids: DataFrame | None = None, width: int | None = None) -> DataFrame:
    """The trie of ``turns`` (as by :func:`turns_of`): one row per node.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.  ``ids`` may add conversations without
    turns; ``width`` sets the sketch's counters per row.
    """
    spark = turns.sparkSession
    rows, chain_path = write_work(chains(turns, ids), "trie-chains")
    top = rows.agg(F.min("conv_id").alias("c"), F.max("n").alias("n"), F.sum("n").alias("prefixes")).first()
    if width is None:
        width = min(MAX_WIDTH, 1 << max(16, int(8 * (top.prefixes or 1) - 1).bit_length()))
    convs, conv_path = write_work(screened(rows, width), "trie-screened")
    drop_work(spark, chain_path)
    firsts, group_path = smallest_members(convs)

    # first[k], longest[k] for k = 0 (the root) .. s
    root = F.struct(F.lit(-1).alias("k"), F.lit(top.c).cast("long").alias("first"),
                    F.lit(top.n).cast("int").alias("longest"))
    own = convs.join(firsts, "conv_id", "left").select(
        "conv_id", "n", "s", "total",
        F.concat(F.array(root), F.coalesce("firsts", F.array().cast("array<struct<k:int,first:long,longest:int>>"))
                 ).alias("f"))
    c, n, s = F.col("conv_id"), F.col("n"), F.col("s")
    mine = F.array_position(F.col("f.first"), c).cast("int")
    own = own.select("conv_id", "n", "s", "total", "f",
                     F.when(mine > 0, mine - 1).when(s < n, s + 1).otherwise(n + 1).alias("r"))
    own, own_path = write_work(own, "trie-members")
    r = F.col("r")
    leaf = (r <= n) & ((s < n) | (_at(F.col("f.longest"), s) == n))

    def share(k: Column) -> Column:
        spared = F.when(r > k, _at(F.col("total"), r - 1) - _at(F.col("total"), F.greatest(k, F.lit(1)) - 1))
        return F.struct(
            _at(F.col("f.first"), k).alias("node"), k.alias("depth"),
            F.when((r <= k) & (k > 0), _at(F.col("f.first"), k - 1)).alias("parent"),
            ((k < n) & (r <= k + 1)).cast("long").alias("child"), leaf.cast("long").alias("leaf"),
            F.coalesce(spared, F.lit(0)).cast("long").alias("saved"))

    members = own.select(F.inline(F.transform(F.sequence(F.lit(0), s), share)))
    nodes = members.groupBy("node", "depth").agg(
        F.max("parent").alias("parent_conv_id"), F.count("*").alias("n_convs"), F.sum("child").alias("n_children"),
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = own.filter("n = s").select(_at(F.col("f.first"), n).alias("node"), n.alias("depth"), "conv_id")
    nothing = hashlib.sha256(b"").hexdigest()
    shared = nodes.join(end_hashes(ends), ["node", "depth"], "left").select(
        F.col("node").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
        "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
    tails = (own.filter("s < n").select("conv_id", "n", "s", "f", F.explode(F.sequence(s + 1, n)).alias("d"))
             .select("conv_id", F.col("d").cast("long").alias("depth"),
                     F.when(F.col("d") == s + 1, _at(F.col("f.first"), s)).otherwise(c).alias("parent_conv_id"),
                     F.lit(1).cast("long").alias("n_convs"), (F.col("d") < n).cast("long").alias("n_children"),
                     F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
                     F.when(F.col("d") == n, F.sha2(c.cast("string").cast("binary"), 256))
                     .otherwise(nothing).alias("ends_sha256")))
    out, _ = write_work(shared.unionByName(tails), "trie-nodes")
    drop_work(spark, conv_path, group_path, own_path)
    return out
