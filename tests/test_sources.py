"""Feed options, routing, product selection, JDBC options. No broker or database is started."""

from conftest import utc
from pyspark.sql import functions as F

from marketstream.schemas import KAFKA_ROW, PRODUCTS
from marketstream.sources.feed import Feed, Tls, filter_products, replay_range, route_feed
from marketstream.sources.jdbc import jdbc_options

TLS = Tls("key.p12", "kp", "trust.jks", "tp")


def test_stream_options():
    options = Feed("broker:9092", ["a.ticker", "a.candles"], TLS).stream_options()
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "a.ticker,a.candles",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "kafka.security.protocol": "SSL",
        "kafka.ssl.truststore.location": "trust.jks",
        "kafka.ssl.truststore.password": "tp",
        "kafka.ssl.keystore.location": "key.p12",
        "kafka.ssl.keystore.password": "kp",
        "kafka.ssl.keystore.type": "PKCS12",
        "kafka.ssl.key.password": "kp",
    }


def test_range_options():
    feed = Feed("broker:9092", ["a.ticker"])
    options = feed.range_options(utc("2024-01-01T00:00:00"), utc("2024-01-01T00:01:00.5"))
    assert options["startingTimestamp"] == "1704067200000"
    assert options["endingTimestamp"] == "1704067260500"
    assert "kafka.security.protocol" not in options


def test_no_cap_and_split_partitions():
    options = Feed("b", ["t"], max_offsets_per_trigger=None, min_partitions=64).stream_options()
    assert "maxOffsetsPerTrigger" not in options
    assert options["minPartitions"] == "64"


def test_replay_keeps_start_and_leaves_out_end(spark):
    rows = [
        (b"k", b"v", topic, 0, n, utc(f"2024-01-01T00:0{n}:00"))
        for n, topic in enumerate(["t", "t", "other", "t"])
    ]
    archive = spark.createDataFrame(rows, KAFKA_ROW)
    got = replay_range(archive, "t", utc("2024-01-01T00:01:00"), utc("2024-01-01T00:03:00"))
    assert [(r["key"], r["value"], r["offset"]) for r in got.collect()] == [("k", "v", 1)]


def routed(spark, *messages):
    raw = spark.createDataFrame([("BTC-USD", m) for m in messages], "product_id STRING, message STRING")
    now = F.lit("2030-01-01").cast("timestamp")
    rows = route_feed(raw, "ns", now).withColumn("ms", F.unix_millis("timestamp")).collect()
    return [(row["key"], row["topic"], row["ms"]) for row in rows]


def test_routing(spark):
    now = int(utc("2030-01-01T00:00:00").timestamp() * 1000)
    assert routed(
        spark,
        '{"channel":"Market-Trades","timestamp":"2024-01-01T00:00:00.1239Z"}',
        '{"timestamp":"2024-01-01T00:00:00Z"}',
        '{"channel":"ticker"}',
        '{"channel":"ticker","timestamp":"soon"}',
        '{"channel":"ticker","timestamp":"2024-01-01T05:30:00+05:30"}',
    ) == [
        ("BTC-USD", "ns.market_trades", 1704067200123),
        ("BTC-USD", "ns.unknown", 1704067200000),
        ("BTC-USD", "ns.ticker", now),
        ("BTC-USD", "ns.ticker", now),
        ("BTC-USD", "ns.ticker", 1704067200000),
    ]


def test_only_enabled_products(spark):
    products = spark.createDataFrame([("a", "A", True), ("b", "B", False)], PRODUCTS)
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "product_id STRING")
    assert [row[0] for row in filter_products(df, products).collect()] == ["A"]


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "s.t", 6, 500, {"user": "u"}) == {
        "url": "jdbc:x",
        "dbtable": "s.t",
        "numPartitions": "6",
        "batchsize": "500",
        "user": "u",
    }
