from pyspark.sql import functions as F

from logbrook import fixtures
from logbrook.functions import long_from_wire, long_to_wire, parse_long, unwrap_json, wrap_json
from logbrook.sources import from_broker, parse_keyed_lines, printed, to_broker

# Texts and the numbers they are.
NUMBERS = {
    "5": 5,
    "+5": 5,
    "-0": 0,
    "9223372036854775807": 2**63 - 1,
    "-9223372036854775808": -(2**63),
    " 5": None,
    "5 ": None,
    "5\n": None,
    "5.0": None,
    "": None,
    "+": None,
    "abc": None,
    "9223372036854775808": None,
}


def test_parse_long(spark):
    frame = spark.createDataFrame([(text,) for text in NUMBERS], "text string")
    found = {row.text: row.number for row in frame.select("text", parse_long(F.col("text")).alias("number")).collect()}
    assert found == NUMBERS


def test_wire_form(spark):
    frame = spark.createDataFrame([(258,), (0,), (2**63 - 1,), (-1,)], "n bigint")
    wired = frame.withColumn("wire", long_to_wire(F.col("n"))).withColumn("back", long_from_wire(F.col("wire")))
    found = {row.n: (bytes(row.wire), row.back) for row in wired.collect()}
    assert found == {n: (n.to_bytes(8, "big", signed=True), n) for n in (258, 0, 2**63 - 1, -1)}


def test_envelope_round_trip_on_whole_texts(spark):
    texts = fixtures.text_lines(spark, "/root/testdata/sf0.001").select("value")
    back = texts.select("value", unwrap_json(wrap_json(F.col("value"))).alias("back"))
    assert back.where(~F.col("value").eqNullSafe(F.col("back"))).isEmpty()


def test_envelope_form(spark):
    frame = spark.createDataFrame([("a", 7, None)], "s string, n bigint, nothing string").select(
        wrap_json(F.col("s")), wrap_json(F.col("n"), "bigint"), wrap_json(F.col("nothing"), optional=True)
    )
    assert tuple(frame.first()) == (
        '{"schema":{"type":"string","optional":false},"payload":"a"}',
        '{"schema":{"type":"int64","optional":false},"payload":7}',
        '{"schema":{"type":"string","optional":true},"payload":null}',
    )


def test_keyed_lines(spark):
    frame = spark.createDataFrame([("a,b,c",), ("a,",), (",b",), ("abc",), ("",)], "line string")
    assert {tuple(row) for row in parse_keyed_lines(frame).collect()} == {
        ("a", "b,c", False),
        ("a", "", False),
        ("", "b", False),
        (None, "abc", True),
        (None, "", True),
    }


def test_printing_shows_missing_parts(spark):
    frame = spark.createDataFrame([("k", "v"), (None, "v"), ("k", None)], "key string, value string")
    shown = frame.select(printed(F.col("key"), F.col("value")).alias("line"))
    assert {row.line for row in shown.collect()} == {"k,v", "null,v", "k,null"}


def test_broker_rows(spark):
    raw = spark.createDataFrame(
        [("t", 0, 5, bytearray(b"k"), bytearray((258).to_bytes(8, "big")))],
        "topic string, partition int, offset bigint, key binary, value binary",
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    decoded = from_broker(raw, "bigint")
    assert decoded.select("seq", "key", "value").first() == (5, "k", 258)
    assert to_broker(decoded).columns == ["key", "value"]


def test_null_payloads_are_optional_by_themselves(spark):
    frame = spark.createDataFrame([("k",), (None,)], "s string")
    texts = [row[0] for row in frame.select(wrap_json(F.col("s"))).collect()]
    assert texts == [
        '{"schema":{"type":"string","optional":false},"payload":"k"}',
        '{"schema":{"type":"string","optional":true},"payload":null}',
    ]
    back = frame.select("s", unwrap_json(wrap_json(F.col("s"))).alias("back")).collect()
    assert all(row["s"] == row["back"] for row in back)


def test_broker_times_are_utc_whatever_the_session(spark):
    from logbrook.sources.topics import RECORD, from_broker

    raw = spark.sql("SELECT 't' AS topic, 0 AS partition, 5L AS offset, timestamp_micros(1711843200000001) AS timestamp, X'61' AS key, X'62' AS value")
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found = from_broker(raw)
            assert [field.dataType for field in found.schema] == [field.dataType for field in RECORD]
            assert str(found.first()["timestamp"]) == "2024-03-31 00:00:00.000001"
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
