"""Running totals under skew: equal to the plain window, without another exchange of rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataflow.operators.running import running_totals
from strataflow.sources.tables import input_bytes


def skewed(spark, n=5000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 9 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 2).alias("k2"),
        (F.col("id") * 7919 % n).alias("o"), F.col("id"), F.when(F.col("id") % 5 != 0, F.col("id") % 11).alias("v"))


@pytest.mark.parametrize("keys", [["k"], ["k", "k2"]])
def test_matches_the_plain_window_with_null_keys(spark, keys):
    df = skewed(spark)
    w = Window.partitionBy(*keys).orderBy("o", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("id", *keys, F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"), F.count("v").over(w).alias("c"))
    got = running_totals(df, keys, ["o", "id"], {"s": "v"}, {"c": "v"}, num_chunks=9).select("id", *keys, "s", "c")
    assert got.count() == 5000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_kept_column_and_no_exchange_of_rows(spark):
    df = skewed(spark, 120_000).withColumn("text", F.concat(F.lit("t"), "id"))
    out = running_totals(df, ["k"], ["o", "id"], {"s": "v"}, num_chunks=8)
    assert out.select("text", "id").filter("text <> concat('t', id)").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    # the offsets' window and their broadcast; the rows themselves are read by bucket
    assert not [line for line in exchanges if "_chunk" in line and "hashpartitioning" in line], plan
    assert sum("hashpartitioning" in line for line in exchanges) == 1, plan
    assert spark.catalog.listTables() == [] or not any(t.name.startswith("running_") for t in spark.catalog.listTables())


def test_empty_input(spark):
    assert running_totals(skewed(spark, 10).limit(0), ["k"], ["o", "id"], {"s": "v"}).count() == 0


def test_input_bytes_counts_the_files_that_are_read(spark, tmp_dir):
    import glob
    import os
    df = skewed(spark)
    df.write.partitionBy("k2").parquet(tmp_dir + "/a")
    df.write.parquet(tmp_dir + "/b")
    size = lambda p: sum(os.path.getsize(f) for f in glob.glob(p + "/**/*.parquet", recursive=True))
    assert input_bytes(spark.read.parquet(tmp_dir + "/a")) == size(tmp_dir + "/a")
    assert input_bytes(spark.read.parquet(tmp_dir + "/a").filter("k2 = 1")) in (size(tmp_dir + "/a"), size(tmp_dir + "/a/k2=1"))
    assert input_bytes(spark.range(5).toDF("x")) == 0
