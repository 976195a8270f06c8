"""Mixture-controlled packing (operator 4): deficit round-robin over source queues.

Every source is a queue of tokens (documents in the order of doc_id, each
followed by the end id).  A round adds to every source a quantum in
proportion to its target share; while a source's deficit holds a grain of
``grain`` tokens, the grain is served into the running window.  What is left
of a deficit is carried to the next round, and so across windows.

The schedule needs no sequential pass.  After r rounds source s has served
``floor(r * q[s] / grain)`` grains (at most its own), so the place of grain j
of source s follows from integers alone: it is served in round
``ceil((j + 1) * grain / q[s])``, after all that rounds before it and the
sources before it in that round served.  Every task thus knows the deficits
that reach its first row.  An empty queue leaves its share to the others.
The last, partial grain of each source follows after all full ones.

Tokens before the window boundary fill it exactly, so only the last window
can be short of ``window`` tokens; padding is under one window in all.

Defined cases: null text is empty (one end id); a null source is a queue of
its own; rows that repeat are documents of their own; an empty table gives
no piece; columns beside the three named ones play no part.  Very long texts
are encoded in windows, the ids of one document are held whole in a task.

A mixture has up to ``MAX_SOURCES`` queues.  With more sources, those with the
most documents have a queue each and all others share one more, in the order
of (source, doc_id), with their targets added up: nothing is left out.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, map_stream, partitions, spans_index, text_col, write_work
from .tokenbin import pack_bits, unpack_bits, width
from .tokens import default_tokenizer, encoder, load, text_slices

WINDOW, GRAIN, MAX_SOURCES = 2048, 256, 10_000
UNIT = 1 << 10   # quanta are whole numbers of 1/UNIT tokens


@dataclass
class Schedule:
    """Deficit round-robin over queues of ``tokens`` tokens with quanta ``q`` (1/UNIT tokens a round)."""

    tokens: np.ndarray
    q: np.ndarray
    grain: int = GRAIN

    @classmethod
    def of(cls, tokens, shares, window: int = WINDOW, grain: int = GRAIN) -> Schedule:
        tokens = np.asarray(tokens, np.int64)
        shares = np.asarray(shares, float)
        total = shares.sum()
        shares = shares / total if total > 0 else np.full(len(tokens), 1 / max(1, len(tokens)))
        q = np.maximum(1, np.rint(shares * window * UNIT)).astype(np.int64)
        return cls(tokens, q, grain)

    def __post_init__(self):
        self.full = self.tokens // self.grain
        tails = self.tokens % self.grain
        self.tail_at = self.full.sum() * self.grain + np.cumsum(tails) - tails

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Grains each source has served after the given rounds: one row per round."""
        return np.minimum(self.full, rounds[:, None] * self.q // (self.grain * UNIT))

    def place(self, source: np.ndarray, grain_no: np.ndarray, cells: int = 1 << 22) -> np.ndarray:
        """Token position of the start of grains (the tail counts as grain number ``full``)."""
        out = np.empty(len(source), np.int64)
        step = max(1, cells // max(1, len(self.q)))      # grains times sources at once
        for lo in range(0, len(source), step):
            s, j = source[lo:lo + step], grain_no[lo:lo + step]
            need = self.grain * UNIT
            r = -((j + 1) * -need // self.q[s])
            now, before = self.served(r), self.served(r - 1)
            earlier = np.arange(len(self.q))[None, :] < s[:, None]
            rank = np.where(earlier, now, before)
            rank[np.arange(len(s)), s] = j
            out[lo:lo + step] = np.where(j < self.full[s], rank.sum(axis=1) * self.grain,
                                         self.tail_at[s])
        return out


def own_queues(docs: DataFrame, source: str) -> list[str | None] | None:
    """The sources with queues of their own; None if every source has one."""
    s = F.col(source).cast("string").alias("s")
    top = (docs.groupBy(s).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.col("s").asc_nulls_first()).limit(MAX_SOURCES + 1).collect())
    return None if len(top) <= MAX_SOURCES else [r.s for r in top[:MAX_SOURCES - 1]]


def queue_table(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text: str,
                source: str) -> tuple[DataFrame, list[str | None] | None]:
    """Token queues, written once: part, rest (in the shared queue), source, doc_id, pos (tokens before it in
    its part's share of the queue), n, ids (bit-packed); and the sources with queues of their own."""
    bits = width(max(load(tokenizer).get_vocab_size(), end_id + 1))
    rows = docs.select(F.col(source).cast("string").alias("s"), F.col(id_col).cast("long").alias("d"),
                       text_col(text).alias("t"))
    own = own_queues(docs, source)
    if own is None:
        rows = rows.withColumn("rest", F.lit(False))
    else:
        names = docs.sparkSession.createDataFrame([(x,) for x in own], "own string").withColumn("found", F.lit(True))
        rows = (rows.join(names, F.col("s").eqNullSafe(F.col("own")), "left")
                .select("s", "d", "t", F.col("found").isNull().alias("rest")))
    rows = (rows.repartitionByRange(partitions(docs.sparkSession), "rest", "s", "d")
            .sortWithinPartitions("rest", "s", "d", "t"))

    def run(batches):
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        end = np.uint32(end_id).tobytes()
        at: dict = {}
        for b in batches:
            for rows_ in text_slices(b, 2):
                s, d, t, rest = (rows_.column(i).to_pylist() for i in range(4))
                raw = [r + end for r in enc.encode(t)]
                pos = []
                for key, r in zip(map(queue_of, rest, s), raw):
                    pos.append(at.get(key, 0))
                    at[key] = pos[-1] + len(r) // 4
                yield {"part": [part] * len(s), "rest": rest, "source": s, "doc_id": d, "pos": pos,
                       "n": [len(r) // 4 for r in raw], "bits": [bits] * len(s),
                       "ids": [pack_bits(np.frombuffer(r, "<u4"), bits) for r in raw]}

    table = map_stream(rows, run, "part int, rest boolean, source string, doc_id long, pos long, n long, bits int, ids binary")
    return write_work(table, "pack-queues", "none")[0], own


def queue_of(rest: bool, source: str | None) -> tuple[bool, str | None]:
    """A row's queue: the shared one, or its source's."""
    return rest, None if rest else source


def pack(docs: DataFrame, targets: dict[str, float] | None = None, tokenizer: str | None = None,
         end_id: int = 1, window: int = WINDOW, grain: int = GRAIN, id_col: str = "doc_id",
         text: str = "text", source: str = "source") -> DataFrame:
    """Pieces: doc_id, source, start, length, ids (little-endian u32), ids_crc32, doc_tokens,
    sequence_id, offset.

    ``targets``: token share per source; by default each source's share of
    all tokens, so that every queue lasts to the end.  A source without a
    target is served after the others (share 0 counts as the least quantum).
    """
    if window % grain:
        raise ValueError("window must be a multiple of grain")
    queues, own = queue_table(docs, tokenizer or default_tokenizer(), end_id, id_col, text, source)
    # One row per part and queue; parts are ranges of (rest, source, doc_id), so about parts + queues rows.
    sizes = (queues.groupBy("part", "rest", F.expr("if(rest, null, source)").alias("source")).agg(F.sum("n").alias("n"))
             .orderBy("part", "rest", F.col("source").asc_nulls_first()).collect())
    names = sorted({(r.rest, r.source) for r in sizes}, key=lambda k: (k[0], k[1] is not None, k[1] or ""))
    index = {k: i for i, k in enumerate(names)}
    tokens, base = np.zeros(len(names), np.int64), {}
    for r in sizes:
        key = (r.rest, r.source)
        base[r.part, key] = int(tokens[index[key]])
        tokens[index[key]] += r.n
    shares = tokens
    if targets is not None:
        others = sum(w for s, w in targets.items() if own is not None and s not in set(own))
        shares = [others if rest else targets.get(s, 0.0) for rest, s in names]
    plan = Schedule.of(tokens, shares, window, grain)

    def cut(b):
        part, rest, src, doc, pos, n, bits, packed = (b.column(i).to_pylist() for i in range(8))
        keys = list(map(queue_of, rest, src))
        s = np.fromiter((index[x] for x in keys), np.int64, len(src))
        lo = np.fromiter((base[p, x] for p, x in zip(part, keys)), np.int64, len(src)) + np.asarray(pos, np.int64)
        n = np.asarray(n, np.int64)
        j0, j1 = lo // grain, (lo + n - 1) // grain
        per = j1 - j0 + 1
        row = np.repeat(np.arange(len(n)), per)
        j = j0[row] + spans_index(per)
        a = np.maximum(lo[row], j * grain)
        z = np.minimum((lo + n)[row], (j + 1) * grain)
        at = plan.place(s[row], j) + a - j * grain
        size = z - a
        # Tails lie end to end and may cross a window: cut there.
        over = np.maximum(0, at % window + size - window)
        if over.any():
            k = np.flatnonzero(over)
            row, a, at, size = (np.concatenate([row, row[k]]), np.concatenate([a, z[k] - over[k]]),
                                np.concatenate([at, at[k] + size[k] - over[k]]),
                                np.concatenate([size - over, over[k]]))
        order = np.lexsort((a, row))
        row, a, at, size = row[order], a[order], at[order], size[order]
        # Pieces of a document that follow each other in a window are one piece.
        new = np.ones(len(row), bool)
        new[1:] = ((row[1:] != row[:-1]) | (at[1:] != at[:-1] + size[:-1]) | (at[1:] % window == 0))
        first = np.flatnonzero(new)
        size = np.add.reduceat(size, first) if len(first) else size
        row, a, at = row[first], a[first], at[first]
        start = a - lo[row]
        flat = [unpack_bits(p, k, w).astype("<u4").tobytes() for p, k, w in zip(packed, n.tolist(), bits)]
        ids = [flat[r][4 * x:4 * (x + k)] for r, x, k in zip(row.tolist(), start.tolist(), size.tolist())]
        return {"doc_id": pa.array([doc[r] for r in row.tolist()], pa.int64()), "source": [src[r] for r in row.tolist()],
                "start": start, "length": size, "ids": ids, "ids_crc32": [zlib.crc32(x) for x in ids],
                "doc_tokens": n[row], "sequence_id": at // window, "offset": at % window}

    return map_batches(queues, cut, "doc_id long, source string, start long, length long, ids binary, "
                       "ids_crc32 long, doc_tokens long, sequence_id long, offset long", 500)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The padded sequences: sequence_id, n_tokens, ids (little-endian u32).

    A sequence whose length is a power of two stays as it is.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    got = (pieces.groupBy("sequence_id")
           .agg(F.sum("length").alias("n_tokens"), parts.alias("p"))
           .withColumn("ids", F.aggregate("p", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))))
    pad = F.when(F.expr("bit_count(n_tokens) = 1"), F.lit(0)).otherwise(window - F.col("n_tokens"))
    fill = F.unhex(F.repeat(F.lit(np.uint32(pad_id).tobytes().hex()), pad.cast("int")))
    return got.select("sequence_id", "n_tokens", F.concat("ids", fill).alias("ids"))
