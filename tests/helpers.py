import datetime as dt

from pyspark.sql import types as T

EPOCH = dt.datetime(1970, 1, 1)

EVENT_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
    T.StructField("kind", T.StringType()),
])


def ts(sec: float) -> dt.datetime:
    return EPOCH + dt.timedelta(seconds=sec)


def events(spark, rows):
    """rows: (user_id, epoch seconds, seq, kind)"""
    return spark.createDataFrame([(u, ts(s), q, k) for u, s, q, k in rows], EVENT_SCHEMA)


def rowset(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
