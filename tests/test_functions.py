import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.hashing import bitmap_capacity, poly_hash
from eventide.functions.time import millis_to_text, next_midnight
from eventide.sources.files import parse_delimited, parse_weblog
from eventide.sources.kafka import kafka_sink_options, kafka_source_options


def test_poly_hash_fixture_value(spark):
    # hash("937166") with seed 97 into 2^29 bits, as the fixture notes give it
    df = spark.createDataFrame([("937166",), ("",)], "s string")
    got = [r[0] for r in df.select(poly_hash("s")).collect()]
    assert got == [122812288, 0]


def test_poly_hash_long_ids_do_not_overflow(spark):
    df = spark.createDataFrame([(9_223_372_036_854_775_807,)], "u long")
    h = df.select(poly_hash("u").alias("h")).first()["h"]
    acc = 0
    for ch in str(9_223_372_036_854_775_807):
        acc = (acc * 97 + ord(ch)) % (1 << 64)
    assert h == acc & ((1 << 29) - 1)


def test_capacity_rule():
    assert bitmap_capacity(0) == 1 << 27
    assert bitmap_capacity(1 << 29) == 1 << 29
    with pytest.raises(ValueError):
        bitmap_capacity(1000)


def test_time_helpers(spark):
    df = spark.createDataFrame([(1511661701000,)], "ms long")
    df = df.withColumn("ts", F.timestamp_millis("ms"))
    row = df.select(millis_to_text("ms").alias("t"),
                    next_midnight(df, "ts").cast("string").alias("m")).first()
    assert row["t"] == "2017-11-26 02:01:41.0"
    assert row["m"] == "2017-11-27 00:00:00"


SCHEMA = T.StructType([T.StructField("order_id", T.LongType()),
                       T.StructField("kind", T.StringType()),
                       T.StructField("tx", T.StringType()),
                       T.StructField("ts", T.LongType())])


def test_parse_delimited_keeps_empty_cell_and_trims(spark):
    lines = spark.createDataFrame([("34729,create,,1558430842",),
                                   (" 34729 , pay , sd76f87d6 , 1558430844 ",)], "value string")
    rows = parse_delimited(lines, SCHEMA).collect()
    assert [tuple(r) for r in rows] == [(34729, "create", "", 1558430842),
                                        (34729, "pay", "sd76f87d6", 1558430844)]


def test_parse_delimited_bad_rows(spark):
    lines = spark.createDataFrame([("1,create,,x",), ("2,pay,a,5",)], "value string")
    assert parse_delimited(lines, SCHEMA, bad_rows="drop").count() == 1
    with pytest.raises(Exception):
        parse_delimited(lines, SCHEMA, bad_rows="fail").collect()


def test_parse_weblog(spark):
    lines = spark.createDataFrame(
        [("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash",),
         ("1.2.3.4 - - not-a-time +0000 GET /x",)], "value string")
    with pytest.raises(Exception, match="bad line"):
        parse_weblog(lines).collect()
    rows = parse_weblog(lines, bad_rows="null").collect()
    assert rows[0]["ip"] == "83.149.9.216" and rows[0]["method"] == "GET"
    assert str(rows[0]["event_time"]) == "2015-05-17 10:05:03"
    assert rows[0]["url"] == "/presentations/logstash"
    assert rows[1]["event_time"] is None


def test_kafka_option_maps():
    assert kafka_source_options("hotitems", "h:9092", "g") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "hotitems",
        "startingOffsets": "latest", "kafka.group.id": "g"}
    assert kafka_sink_options("t", "h:9092") == {
        "kafka.bootstrap.servers": "h:9092", "topic": "t", "kafka.acks": "1"}


def test_scale_conf():
    from eventide.session import scale_conf
    c = scale_conf(100 * (1 << 40), 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    assert scale_conf(1 << 20, 16)["spark.sql.shuffle.partitions"] == "32"


def test_text_sources_batch_and_stream(spark, tmp_path):
    from eventide.sources.files import read_lines
    from eventide.streaming.jobs import run_to_files
    d = tmp_path / "orders"
    d.mkdir()
    (d / "a.csv").write_text("34729,create,,1558430842\n34730,create,,1558430845\n")
    (d / "b.csv").write_text("34729,pay,sd76f87d6,1558430844\n")
    batch = parse_delimited(read_lines(spark, str(d)), SCHEMA)
    assert sorted(tuple(r) for r in batch.collect()) == [
        (34729, "create", "", 1558430842), (34729, "pay", "sd76f87d6", 1558430844),
        (34730, "create", "", 1558430845)]
    stream = parse_delimited(read_lines(spark, str(d), stream=True, max_files_per_trigger=1),
                             SCHEMA)
    got = run_to_files(stream, "t_text")
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in batch.collect())
