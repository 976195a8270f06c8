"""A compacted keyed table (S7): copy-on-write by buckets of keys.

A batch touches some buckets of the key's hash.  Their current rows are read,
rows whose key the batch brings are replaced, and the buckets are written anew
as version ``batch_id``; the others stay where they are.  One small pointer
row per bucket says which version is current.  Pointers are files of their own
per batch, written after the data, so a reader sees a batch whole or not at
all, and a read opens current versions only, however many batches there were.

A replayed batch starts from the pointers of the batches before it and
replaces its own version and pointers: it changes nothing.  Batches of one
table are written one after the other (as ``foreachBatch`` does).

``keys`` are unique within a batch, as update-mode aggregates give them; a key
that comes twice keeps both rows until a later batch brings it again.  Null
keys are keys.  The driver holds one number per bucket (``buckets``, fixed when
the table is made).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import path_kind

POINTERS = "bucket_no int, version long"


class UpsertTable:
    """``path`` holds ``data/version=<batch>/bucket_no=<b>`` and ``pointers/<batch>``."""

    def __init__(self, path: str, keys: Sequence[str], schema: T.StructType, buckets: int = 32):
        self.path, self.keys, self.schema, self.buckets = path, list(keys), schema, buckets

    def _batches(self, spark: SparkSession) -> list[int]:
        """Batches that wrote pointers, in order."""
        root = f"{self.path}/pointers"
        if path_kind(spark, root) is None:
            return []
        p = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdigit())

    def pointers(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """Bucket -> current version (after the batches below ``before``)."""
        root = f"{self.path}/pointers"
        for n in reversed(self._batches(spark)):
            # a batch whose pointers were not finished does not count
            if (before is None or n < before) and path_kind(spark, f"{root}/{n}/_SUCCESS") is not None:
                rows = spark.read.schema(POINTERS).parquet(f"{root}/{n}").collect()
                return {r.bucket_no: r.version for r in rows}
        return {}

    def _rows(self, spark: SparkSession, at: dict[int, int]) -> DataFrame:
        if not at:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(
            *[f"{self.path}/data/version={v}/bucket_no={b}" for b, v in sorted(at.items())])

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row of every key."""
        return self._rows(spark, self.pointers(spark))

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one batch; for ``foreachBatch``."""
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        names = [f.name for f in self.schema.fields]
        new = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        new = new.withColumn("bucket_no", bucket).persist()
        try:
            touched = [r.bucket_no for r in new.select("bucket_no").distinct().collect()]
            if not touched:
                return
            at = self.pointers(spark, batch_id)
            old = self._rows(spark, {b: at[b] for b in touched if b in at}).withColumn("bucket_no", bucket)
            same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys]
            kept = old.alias("o").join(new.select("bucket_no", *self.keys).alias("n"),
                                       [F.col("o.bucket_no") == F.col("n.bucket_no"), *same], "left_anti")
            (kept.select(*names, "bucket_no").unionByName(new).repartition("bucket_no")
             .write.mode("overwrite").partitionBy("bucket_no").parquet(f"{self.path}/data/version={batch_id}"))
        finally:
            new.unpersist()
        current = at | dict.fromkeys(touched, batch_id)
        (spark.createDataFrame(sorted(current.items()), POINTERS).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/pointers/{batch_id}"))

    def vacuum(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete versions that none of the last ``keep`` batches' pointers name; returns how many buckets went.

        Not to be run while a DataFrame of an older ``read`` is still in use.
        """
        done = self._batches(spark)
        last = done[-max(keep, 1):]
        wanted = {(v, b) for n in last for b, v in self.pointers(spark, n + 1).items()}
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        gone = 0
        for n in done:
            root = path(f"{self.path}/data/version={n}")
            for s in fs.listStatus(root) if fs.exists(root) else []:
                name = s.getPath().getName()
                if name.startswith("bucket_no=") and (n, int(name.split("=")[1])) not in wanted:
                    fs.delete(s.getPath(), True)
                    gone += 1
            if n not in last:
                fs.delete(path(f"{self.path}/pointers/{n}"), True)
        return gone
