"""Sinks (S5, S6).

* S5 console: ``writeStream.format('console')`` named after the reference's
  print label; in batch ``show``.
* S6 side outputs: the reference routes tagged rows of one operator to
  separate sinks.  On a stream this is one ``foreachBatch`` that persists the
  micro-batch once and writes one filtered output per tag, keyed by the
  batch id so a replayed batch overwrites itself (exactly-once files).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def console(df: DataFrame, label: str | None = None, output_mode: str = "append",
            truncate: bool = False) -> StreamingQuery | None:
    """Print a stream (or show a batch) under an optional label."""
    if not df.isStreaming:
        if label:
            print(label)
        df.show(truncate=truncate)
        return None
    w = df.writeStream.format("console").outputMode(output_mode).option("truncate", str(truncate))
    if label:
        w = w.queryName(label)
    return w.start()


def side_output_writer(tag_col: str, outputs: dict[str, str], fmt: str = "parquet"
                       ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each tag to its own path.

    ``outputs`` maps tag value -> output path.  Each output is partitioned by
    ``batch_id`` and overwritten dynamically, so re-running a batch after a
    failure replaces its own files instead of duplicating them.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for tag, path in outputs.items():
                (batch.filter(F.col(tag_col) == tag).drop(tag_col)
                 .withColumn("batch_id", F.lit(batch_id).cast("long"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_id").format(fmt).save(path))
        finally:
            batch.unpersist()
    return write


def write_side_outputs(tagged: DataFrame, tag_col: str, outputs: dict[str, str],
                       fmt: str = "parquet") -> None:
    """S6 for batch DataFrames: one filtered write per tag."""
    for tag, path in outputs.items():
        tagged.filter(F.col(tag_col) == tag).drop(tag_col).write.mode("overwrite") \
            .format(fmt).save(path)
