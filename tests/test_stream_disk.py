"""Streams over large inputs: what they keep on disk while they run."""

import datetime as dt
import os
import time

import pytest

from strataflow.operators import upsert as U
from strataflow.session import SHUFFLE_CLEANUP, shuffles_dropped
from strataflow.streaming import streams as ST
from tests.test_streaming import _benchmark_rows


@pytest.mark.parametrize("name", ["stream_three_topics", "stream_upsert"])
def test_landing_files_are_compressed_and_nothing_else_stays(spark, tmp_dir, monkeypatch, name):
    from strataflow.plans import catalog, catalog_runs
    _benchmark_rows(spark, tmp_dir + "/in")
    for module in (catalog, catalog_runs):
        monkeypatch.setattr(module, "scratch_path", lambda *_: tmp_dir + "/run")
    assert catalog.QUERIES[name](spark, tmp_dir + "/in").count()
    files = [f for _, _, fs in os.walk(tmp_dir + "/run/landing") for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert not os.path.exists(tmp_dir + "/run/batch")


def _shuffles(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = [blocks.apply(i).name() for i in range(blocks.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_an_upserted_batch_leaves_no_shuffle_files(spark, tmp_dir):
    rows = [(i, i % 3, dt.date(2024, 1, 1 + i % 4)) for i in range(200)]
    batch, before = spark.createDataFrame(rows, "k long, p int, day date"), spark.conf.get(SHUFFLE_CLEANUP, None)
    there = _shuffles(spark)
    handle = ST.upsert_batches(tmp_dir + "/t", ["k"], ["p"], None, ["day"], "latest", buckets=2)
    for n in range(2):
        handle(batch, n)
    end = time.time() + 20          # files go in the background
    while _shuffles(spark) - there and time.time() < end:
        time.sleep(0.2)
    assert not _shuffles(spark) - there
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    assert sorted(r.k for r in U.read_keyed(spark, tmp_dir + "/t").collect()) == list(range(200))


def test_the_shuffle_setting_is_put_back(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    with pytest.raises(KeyError), shuffles_dropped(spark):
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise KeyError
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def test_a_staged_batch_is_routed_as_a_kept_one(spark, tmp_dir):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([StructField("k", StringType()), StructField("v", LongType())])
    rows = [("a", '{"k": "x", "v": 1}'), ("a", '{"k": "x", "v": 1}'), ("a", '{"k": "y", "v": "no"}'), ("b", '{"k": "x", "v": 2}'), ("c", "{}"),
            (None, "t"), ("", "u"), ("b", None), ("b", "{cut"), ("0", "v")]
    batch, got = spark.createDataFrame(rows, "topic string, value string"), []
    for staging in (None, tmp_dir + "/batch"):
        seen, cached, at = [], [], f"{tmp_dir}/{bool(staging)}"

        def sink(name):
            return lambda df, epoch: (seen.extend((name, epoch, *r) for r in df.collect()), cached.append(spark.sparkContext._jsc.getPersistentRDDs().size()))
        handle = ST.route_topics({t: ST.Topic(schema, [sink(t), sink(t)]) for t in ("a", "b", "none")}, at + "/q", staging=staging)
        kept = spark.sparkContext._jsc.getPersistentRDDs().size()
        if staging:     # a run that was stopped in the middle left its files
            spark.createDataFrame([("a", '{"k": "old", "v": 9}', 2)], "topic string, value string, place int").write.partitionBy("place").parquet(staging)
        for _ in range(2):
            handle(batch, 7)
        assert bool(staging) == (set(cached) == {kept})
        quarantined = spark.read.parquet(at + "/q").select("topic", "value", "batch").collect()
        got.append((sorted(seen), sorted(map(str, quarantined))))
        assert not os.path.exists(tmp_dir + "/batch")
    assert got[0] == got[1]
    assert got[0][0].count(("a", 7, "x", 1)) == 8 and len(got[0][1]) == 7


def test_keys_are_not_met_where_every_stored_partition_is_read_anyway(spark, tmp_dir, monkeypatch):
    met, real = [], U._keys_met
    monkeypatch.setattr(U, "_keys_met", lambda *a: met.append(1) or real(*a))

    def load(rows, path, buckets):
        U.upsert(spark, spark.createDataFrame(rows, "k string, day int, p string, v int"), path, ["k"], ["p"], ["day"], resolve="latest", buckets=buckets)
    for buckets in (None, 2):
        path, calls = f"{tmp_dir}/{buckets}", len(met)
        keys = [f"k{i}" for i in range(40)]
        load([(k, 1, p, 1) for k, p in zip(keys, ["a", "b", None, "x=/"] * 10)], path, buckets)
        load([(k, 2, p, 2) for k, p in zip(keys[:32], ["b", None, "x=/", "a"] * 8)], path, buckets)     # every partition, every key elsewhere
        load([(k, 0, p, 3) for k, p in zip(keys[:32], ["a", "b", None, "x=/"] * 8)], path, buckets)     # too old
        assert len(met) == calls
        load([("k0", 3, "a", 4), ("new", 1, "y", 5)], path, buckets)        # k0 leaves a partition that does not arrive
        assert len(met) == calls + 1
        got = {r.k: (r.p, r.v) for r in U.read_keyed(spark, path).collect()}
        assert U.read_keyed(spark, path).count() == len(got) == 41
        assert got["k0"] == ("a", 4) and got["new"] == ("y", 5) and got["k39"] == ("x=/", 1)
        assert all(got[k] == (p, 2) for k, p in list(zip(keys[:32], ["b", None, "x=/", "a"] * 8))[1:])
