import os
import time

from pyspark.sql import functions as F

from gatewright import session


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and not n.endswith(".index")}


def test_shuffle_files_go_with_the_table_they_served(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, before = spark.conf.get(key, None), shuffle_files(spark)
    # a key from the range itself, so that nothing is known to be sorted by it
    rows = spark.range(50_000).groupBy((F.col("id") % 1013).alias("x")).agg(F.max("id").alias("y"))
    out = session.stored(rows, "trial")
    assert spark.conf.get(key, None) == own
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert out.count() == 1013 and rows.count() == 1013
    folder = os.path.dirname(out.inputFiles()[0]).removeprefix("file://")
    session.release(spark, [f for f in session._folders if f.endswith(os.path.basename(folder))])
    assert not os.path.exists(folder)
