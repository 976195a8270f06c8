"""Helpers shared by the training-data operators.

Work tables go to the folder named in ``spark.checkpoint.dir`` through
Spark's own writers, so any executor can read them back after a loss.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventide.session import scratch_path

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_work(df: DataFrame, name: str, compression: str = "zstd") -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared folder; returns the table read back and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    # small row groups: a writer holds one of them in memory
    df.write.option("compression", compression).option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_work(spark: SparkSession, *paths: str) -> None:
    """Delete work tables that no later step reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files whose DataFrames are gone."""
    gc.collect()
    spark._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_col(name: str = "text"):
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{root.name}.zip"   # the driver serves it from here
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._llm_shipped = True


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | Iterator[dict]], schema: str,
                rows: int = 2000) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows.

    ``fn`` gets a record batch and returns one dict of columns, or yields several.
    """
    ship(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, rows):
                got = fn(b.slice(lo, rows))
                for cols in ([got] if isinstance(got, dict) else got):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[f.name], type=f.type) if not isinstance(cols[f.name], pa.Array)
                         else cols[f.name].cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def map_stream(df: DataFrame, gen: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` with a generator over all batches of a task that yields dicts of columns."""
    ship(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for cols in gen(batches):
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in arrow],
                                             schema=arrow)

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), on uint64 arrays."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> U64(29))) * U64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> U64(32))


def spans_index(lens: np.ndarray) -> np.ndarray:
    """0..len-1 for every length, concatenated."""
    total = int(lens.sum())
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) - np.repeat(ends - lens, lens)


class WordTable:
    """Word -> row number, filled as words appear; starts anew beyond ``limit`` words.

    ``make(words)`` gives an array with one row per new word.  Kept for the
    life of a Python worker; its size is bounded, its content only saves time.
    """

    def __init__(self, make: Callable[[list[str]], np.ndarray], limit: int = 500_000):
        self.make, self.limit = make, limit
        self.rows: dict[str, int] = {}
        self.data: np.ndarray | None = None

    def look_up(self, words: list[str]) -> np.ndarray:
        """Row numbers into ``data`` for ``words`` (valid until the next call)."""
        if len(self.rows) > self.limit:
            self.rows, self.data = {}, None
        got = list(map(self.rows.get, words))
        if None in got:
            new = [w for w in dict.fromkeys(w for w, r in zip(words, got) if r is None)]
            made = self.make(new)
            base = len(self.rows)
            need = base + len(new)
            if self.data is None or need > len(self.data):
                grown = np.zeros((max(need, 2 * (len(self.data) if self.data is not None else 4096)),
                                  *made.shape[1:]), made.dtype)
                if self.data is not None:
                    grown[:base] = self.data[:base]
                self.data = grown
            self.data[base:need] = made
            self.rows.update(zip(new, range(base, need)))
            look = self.rows
            got = [look[w] if r is None else r for w, r in zip(words, got)]
        return np.fromiter(got, np.int64, len(got))

    def values(self, words: list[str]) -> np.ndarray:
        rows = self.look_up(words)
        if self.data is None:
            return self.make([])
        return self.data[rows]


_PER_WORKER: dict = {}


def per_worker(key, build: Callable):
    """The worker's object for ``key``, built on first use.

    A worker keeps one such object: workers outlive queries, and the caches
    of operators that ran before must not add up.
    """
    if key not in _PER_WORKER:
        _PER_WORKER.clear()
        _PER_WORKER[key] = build()
    return _PER_WORKER[key]


def forget() -> None:
    """Give back the worker's cached object and the memory it took."""
    if not _PER_WORKER:
        return
    _PER_WORKER.clear()
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # only the GNU C library has it
        pass
