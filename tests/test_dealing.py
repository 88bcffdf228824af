"""Messages are made and parsed by every core, however few files and row groups the table has."""

from marketstream.harness import feed as f
from marketstream.sources import folders
from marketstream.streaming.runner import drain


def test_table_of_one_row_group_is_dealt_over_the_cores(spark, sf_dir, tmp_path, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    dealt = f.wire_source(spark, sf_dir)
    assert dealt.rdd.getNumPartitions() >= cores > f.feed(spark, sf_dir).rdd.getNumPartitions()
    assert sorted(dealt.collect()) == sorted(f.feed(spark, sf_dir).collect())
    monkeypatch.setattr(f, "DEALT_BYTES", folders.size(spark, f"{sf_dir}/events.parquet") // (3 * cores))
    assert f.wire_source(spark, sf_dir).rdd.getNumPartitions() >= 3 * cores


def test_each_batch_is_dealt_over_the_cores(spark, sf_dir, tmp_path):
    log, cores = f"{tmp_path}/log", spark.sparkContext.defaultParallelism
    f.write_hours(spark, sf_dir, log, range(2))
    parts = []
    drain(f.hourly_stream(spark, sf_dir, log), lambda df, _: parts.append(df.rdd.getNumPartitions()), f"{tmp_path}/hours")
    assert len(parts) == 2 and min(parts) >= cores
    parts.clear()
    drain(f.feed_stream(spark, sf_dir), lambda df, _: parts.append(df.rdd.getNumPartitions()), f"{tmp_path}/whole")
    assert len(parts) == 1 and min(parts) >= cores
