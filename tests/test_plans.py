"""Physical plans: what must and must not appear."""

import re

import pytest
from conftest import utc

from marketstream import harness
from marketstream.harness import feed as f
from marketstream.operators import (
    cumulative_vwap,
    dedup_trades,
    distinct_on,
    first_update_event,
    insert_new,
    minute_trade_agg,
    parse_envelope,
    prepare_trades,
)
from marketstream.operators.latest import latest_ticker_minutes
from marketstream.plans import dashboards
from marketstream.schemas import TICKER_MINUTES, TRADE_MINUTES
from marketstream.sources.shared import shared_database
from marketstream.sources.tables import HourlyTable

# These run a stream or write tables when called; the others only build a plan.
ACTING = {
    name
    for name in harness.queries()
    if name.startswith("stream_")
    or name.startswith("one_product_")
    or name
    in (
        "feed_source",
        "feed_contents",
        "fanout_counts",
        "fanout_contents",
        "replay_new_checkpoint",
        "replay_idempotent",
        "trim_after_failure",
        "reopened_tables",
        "dead_letters",
        "newest_rows",
        "stored_vwap",
        "hourly_partition_counts",
        "retention_partitions",
    )
}
# A single task sees one row per input task (a maximum), one row per hour or second (trim counts),
# or the rows of a top-n (trim victims).
ONE_TASK = {"trim_victims", "trim_survivors"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(harness.queries()) - ACTING))
def test_no_python_no_cross_join_no_single_task(spark, sf_dir, name):
    plan = plan_of(harness.queries()[name](spark, sf_dir))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    main = re.split(r"\bSubquery\b", plan)[0] if name not in ONE_TASK else ""
    assert "SinglePartition" not in main


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = plan_of(f.feed(spark, sf_dir).groupBy("product_id").count())
    assert re.search(r"ReadSchema: struct<user_id:bigint>", plan)


def test_json_is_parsed_once_per_message(spark, sf_dir):
    wire = f.wire_rows(f.feed(spark, sf_dir), ("market_trades",))
    plan = plan_of(prepare_trades(first_update_event(parse_envelope(wire))))
    assert plan.count("from_json(") == 1


def test_latest_per_minute_hashes_before_its_only_shuffle(spark, sf_dir):
    plan = plan_of(latest_ticker_minutes(f.as_tickers(f.feed(spark, sf_dir))))
    assert "SortAggregate" not in plan
    assert plan.count("HashAggregate") == 2
    assert plan.count("Exchange") == 1
    assert "partial_max_by" in plan


def test_minute_totals_are_summed_before_the_shuffle(spark, sf_dir):
    plan = plan_of(minute_trade_agg(f.as_trades(f.feed(spark, sf_dir))))
    assert "partial_sum" in plan
    assert plan.count("Exchange") == 1


def test_copies_are_reduced_before_the_shuffle(spark, sf_dir):
    plan = plan_of(dedup_trades(f.as_trades(f.feed(spark, sf_dir))))
    assert "partial_first" in plan
    assert plan.count("Exchange") == 1


def test_distinct_on_limits_groups_before_the_shuffle(spark, sf_dir):
    feed_df = f.feed(spark, sf_dir)
    plan = plan_of(distinct_on(feed_df, ["product_id"], [feed_df["offset"].desc()]))
    assert plan.count("WindowGroupLimit") == 2


def test_insert_new_does_not_shuffle_the_target_for_a_small_batch(spark):
    name = f"{shared_database(spark, 'plan')}.raw"
    columns = "trade_id STRING, at TIMESTAMP"
    table = HourlyTable(spark, name, columns, "at", ("trade_id",)).create()
    batch = spark.createDataFrame([("a", utc("2024-01-01T00:00:00"))], columns)
    table.append(batch)
    fresh = insert_new(table.read(), batch, ["trade_id"])
    fresh.collect()
    plan = plan_of(fresh).split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    database = shared_database(spark, "plan")
    feed_df = f.feed(spark, sf_dir)
    minutes = HourlyTable(spark, f"{database}.minutes", TRADE_MINUTES, "trade_time_utc").create()
    tickers = HourlyTable(spark, f"{database}.tickers", TICKER_MINUTES, "ticker_ts_utc").create()
    minutes.append(f.trade_minutes(feed_df))
    tickers.append(f.ticker_minutes(feed_df))
    return minutes.read(), tickers.read()


def test_recent_questions_prune_hours_and_columns(stored):
    minutes, _ = stored
    now = utc("2024-01-01T10:10:00")
    plan = plan_of(dashboards.buy_volume_30m(minutes, "BTC-USD", now))
    assert "event_hour#" in plan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert "EqualTo(product_id,BTC-USD)" in plan
    assert "GreaterThanOrEqual(trade_time_utc" in plan
    read = plan.split("ReadSchema:")[1]
    assert "buy_volume" in read
    assert "sell_volume" not in read


def test_latest_value_of_one_product_is_a_top_one(stored):
    _, tickers = stored
    plan = plan_of(dashboards.current_price(tickers, "BTC-USD"))
    assert "TakeOrderedAndProject(limit=1" in plan
    assert "EqualTo(product_id,BTC-USD)" in plan


def test_latest_value_of_all_products_sends_one_row_per_product_and_task(stored):
    _, tickers = stored
    plan = plan_of(dashboards.current_price(tickers))
    assert "partial_max_by" in plan
    assert "SortAggregate" not in plan


def test_full_history_vwap_reads_its_input_once(spark, sf_dir):
    result = cumulative_vwap(f.trade_minutes(f.feed(spark, sf_dir)))
    result.collect()
    assert "ReusedExchange" in plan_of(result)
