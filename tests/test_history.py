"""SCD2 versions and point-in-time joins."""

import datetime as dt
import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from strataflow.operators.history import as_of_join, scd2_apply

T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
SCHEMA = "id string, name string, score int"


def test_scd2_cases(spark):
    s1 = spark.createDataFrame([("same", "a", 1), ("chg", "b", 1), ("gone", "c", 1), ("ren", "d", 1)], SCHEMA)
    s2 = spark.createDataFrame([("same", "a", 1), ("chg", "b", 2), ("new", "e", 1), ("ren", "D", 1)], SCHEMA)
    h1 = scd2_apply(None, s1, "id", ["score"], T1)
    h2 = scd2_apply(h1, s2, "id", ["score"], T2)
    rows = h2.collect()
    per = {}
    for r in rows:
        per.setdefault(r.id, []).append(r)
    assert {k: len(v) for k, v in per.items()} == {"same": 1, "chg": 2, "gone": 1, "new": 1, "ren": 1}
    assert all(sum(r.is_current for r in v) == 1 for v in per.values())
    old = [r for r in per["chg"] if not r.is_current][0]
    new = [r for r in per["chg"] if r.is_current][0]
    assert old.valid_to == new.valid_from == dt.datetime(2024, 2, 1)
    assert new.score == 2 and new.valid_to is None
    assert per["ren"][0].name == "d"         # untracked change opens no version
    # same snapshot again at the same time: no change
    h3 = scd2_apply(h2, s2, "id", ["score"], T2)
    assert sorted(map(tuple, h3.collect())) == sorted(map(tuple, rows))


def test_as_of_join(spark):
    s1 = spark.createDataFrame([("u", "a", 1)], SCHEMA)
    s2 = spark.createDataFrame([("u", "a", 2)], SCHEMA)
    h = scd2_apply(scd2_apply(None, s1, "id", ["score"], T1), s2, "id", ["score"], T2)
    facts = spark.createDataFrame([("f0", "u", dt.datetime(2023, 12, 1)), ("f1", "u", dt.datetime(2024, 1, 15)),
                                   ("f2", "u", dt.datetime(2024, 3, 1)), ("f3", "u", dt.datetime(2024, 2, 1))],
                                  "fid string, id string, ts timestamp")
    got = {r.fid: r.score for r in as_of_join(facts, h, "id", "ts", ["score"]).collect()}
    assert got == {"f0": None, "f1": 1, "f2": 2, "f3": 2}


def test_scd2_store_rewrites_only_current_and_new_closed(spark, tmp_dir):
    import os
    from strataflow.operators.history import read_history, scd2_store
    path = tmp_dir + "/h"
    s1 = spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], SCHEMA)
    s2 = spark.createDataFrame([("a", "x", 2), ("b", "y", 1)], SCHEMA)
    s3 = spark.createDataFrame([("a", "x", 3), ("b", "y", 1)], SCHEMA)
    scd2_store(spark, path, s1, "id", ["score"], T1)
    scd2_store(spark, path, s2, "id", ["score"], T2)
    parts = sorted(p for p in os.listdir(path) if p.startswith("closed_run="))
    assert parts == ["closed_run=__HIVE_DEFAULT_PARTITION__", "closed_run=r20240201000000000000"]
    before = os.listdir(os.path.join(path, "closed_run=r20240201000000000000"))
    scd2_store(spark, path, s3, "id", ["score"], "2024-03-01 00:00:00")
    assert os.listdir(os.path.join(path, "closed_run=r20240201000000000000")) == before   # untouched
    scd2_store(spark, path, s3, "id", ["score"], "2024-03-01 00:00:00")             # re-run: no-op
    h = read_history(spark, path)
    assert h.count() == 4 and h.filter("is_current").count() == 2
    assert sorted(r.score for r in h.filter("id = 'a'").collect()) == [1, 2, 3]


def canonical(observations, tracked=("score",)):
    """Versions from (time, rows) statements: the definition, key by key."""
    out = set()
    by_key = {}
    for t, rows in sorted(observations, key=lambda x: x[0]):
        for r in rows:
            by_key.setdefault(r[0], []).append((t, r[2]))
    for k, seen in by_key.items():
        starts = [x for i, x in enumerate(seen) if i == 0 or seen[i - 1][1] != x[1]]
        for i, (t, v) in enumerate(starts):
            out.add((k, v, t, starts[i + 1][0] if i + 1 < len(starts) else None))
    return out


def stored_versions(spark, path):
    from strataflow.operators.history import read_history
    rows = read_history(spark, path).collect()
    got = {(r.id, r.score, str(r.valid_from), str(r.valid_to) if r.valid_to else None) for r in rows}
    assert len(got) == len(rows) and all(r.valid_to is None or r.valid_from < r.valid_to for r in rows)     # no empty interval
    assert all(r.is_current == (r.valid_to is None) for r in rows)
    return got


THREE = {"2024-01-01 00:00:00": [("same", "", 1), ("back", "", 1), ("gone", "", 1), ("gap", "", 4), (None, "", 1), ("mid", "", 2)],
         "2024-02-01 00:00:00": [("same", "", 1), ("back", "", 2), ("new", "", 5), (None, "", 2), ("mid", "", 3), ("gone2", "", 9)],
         "2024-03-01 00:00:00": [("same", "", 1), ("back", "", 1), ("new", "", 5), ("gap", "", 4), (None, "", 2), ("mid", "", 4), ("last", "", 0)]}


@pytest.mark.parametrize("order", list(itertools.permutations(THREE)))
def test_snapshots_in_any_order_give_one_table(spark, tmp_dir, order):
    from strataflow.operators.history import scd2_store
    for t in order:
        scd2_store(spark, tmp_dir + "/h", spark.createDataFrame(THREE[t], SCHEMA), "id", ["score"], t)
    assert stored_versions(spark, tmp_dir + "/h") == canonical(THREE.items())


def test_random_runs_late_and_repeated(spark, tmp_dir):
    """Many runs in random order, some repeated with another snapshot: always the table of the last statements."""
    from strataflow.operators.history import scd2_store
    r = random.Random(4)
    days = [f"2024-01-{d:02d} 00:00:00" for d in range(1, 9)]
    said = {}
    for t in r.sample(days, 8) + r.choices(days, k=4):
        said[t] = [(k, "", r.randint(0, 1)) for k in "abcdefghij" if r.random() < 0.7] or [("z", "", 1)]
        scd2_store(spark, tmp_dir + "/h", spark.createDataFrame(said[t], SCHEMA), "id", ["score"], t)
        assert stored_versions(spark, tmp_dir + "/h") == canonical(said.items())


def test_a_late_run_leaves_older_partitions_alone(spark, tmp_dir):
    from strataflow.operators.history import scd2_store
    path = tmp_dir + "/h"
    for day, score in ((1, 1), (5, 2), (9, 3)):
        scd2_store(spark, path, spark.createDataFrame([("a", "", score)], SCHEMA), "id", ["score"], f"2024-01-{day:02d} 00:00:00")
    old = path + "/closed_run=r20240105000000000000"
    before = os.listdir(old)
    scd2_store(spark, path, spark.createDataFrame([("a", "", 7)], SCHEMA), "id", ["score"], "2024-01-07 00:00:00")
    assert os.listdir(old) == before
    assert stored_versions(spark, path) == {("a", 1, "2024-01-01 00:00:00", "2024-01-05 00:00:00"), ("a", 2, "2024-01-05 00:00:00", "2024-01-07 00:00:00"),
                                            ("a", 7, "2024-01-07 00:00:00", "2024-01-09 00:00:00"), ("a", 3, "2024-01-09 00:00:00", None)}


def test_as_of_join_of_a_hot_key_is_linear_and_equals_the_range_join(spark):
    """One key with 10,000 versions and 20,000 facts: no join of the two sides, and the same rows."""
    start = "timestamp'2020-01-01'"
    hist = spark.range(10_000).selectExpr("'hot' as id", f"timestampadd(HOUR, id, {start}) as valid_from",
                                          f"case when id < 9999 then timestampadd(MINUTE, id * 60 + 45 + id % 16, {start}) end as valid_to", "id as score")
    hist = hist.unionByName(spark.sql(f"select 'k' id, {start} valid_from, cast(null as timestamp) valid_to, 1L score union all select null, {start}, null, 2L"))
    facts = (spark.range(20_000).selectExpr("id as fid", f"timestampadd(SECOND, id * 1801 - 500, {start}) as ts",
                                            "case when id % 50 = 0 then 'k' when id % 77 = 0 then null when id % 91 = 0 then 'none' else 'hot' end as id")
             .unionByName(spark.sql("select -1L fid, cast(null as timestamp) ts, 'hot' id")))
    got = as_of_join(facts, hist, "id", "ts", ["score"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") <= 2, plan
    f, h = facts.alias("f"), hist.alias("h")
    want = f.join(h, F.expr("f.id = h.id and h.valid_from <= f.ts and (h.valid_to is null or f.ts < h.valid_to)"), "left") \
            .selectExpr("f.fid", "f.ts", "f.id", "h.valid_from", "h.valid_to", "h.score")
    got = got.select("fid", "ts", "id", "valid_from", "valid_to", "score")
    assert got.count() == 20_001 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    inner = as_of_join(facts, hist, "id", "ts", ["score"], "inner")
    assert inner.count() == want.filter("score is not null").count() < 20_000
