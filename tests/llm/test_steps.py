import time

from pyspark.sql import functions as F

from marketstream.llm.common import stored


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files) if f.getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_step(spark):
    """A step that is written leaves no shuffle files, and the session's setting stays as it was."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffle_files(spark), spark.conf.get(setting, None)
    rows = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    ends = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < ends:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(setting, None) == was
    assert sorted(map(tuple, rows.collect())) == [(k, 143 if k < 6 else 142) for k in range(7)]
