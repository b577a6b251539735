"""JSON ingestion: quarantine, drift classes, idempotent partition writes."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from strataflow.schemas import CHECKINS_SCHEMA
from strataflow.sources import bronze as B
from strataflow.sources import json_source as J
from strataflow.sources.tables import SchemaMismatch, check_schema, read_as_of

RUN = dt.datetime(2024, 1, 2, 6, 0)


def write_lines(d, name, lines):
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return d


def test_quarantine(spark, tmp_dir):
    src = write_lines(tmp_dir + "/land", "c.json", [
        json.dumps({"business_id": "a", "date": "2020-01-01 00:00:00"}),
        '{"business_id": "b", "date": "2020-01-01',            # truncated
        json.dumps({"business_id": "c", "date": 5}),           # number where text declared: coerced by JSON reader
    ])
    parsed = J.read_json_entity(spark, src, CHECKINS_SCHEMA)
    p = J.split_corrupt(parsed)
    good, bad = p.good, p.bad
    assert (p.n_good, p.n_bad) == (2, 1)
    assert bad.count() == 1
    assert sorted(r.business_id for r in good.collect()) == ["a", "c"]


def test_wrong_type_is_quarantined(spark, tmp_dir):
    from strataflow.schemas import TIPS_SCHEMA
    src = write_lines(tmp_dir + "/land", "t.json", [
        json.dumps({"business_id": "a", "user_id": "u", "date": "x", "compliment_count": 3}),
        json.dumps({"business_id": "b", "user_id": "u", "date": "x", "compliment_count": "three"}),
    ])
    p = J.split_corrupt(J.read_json_entity(spark, src, TIPS_SCHEMA))
    good, bad = p.good, p.bad
    assert [r.business_id for r in good.collect()] == ["a"] and bad.count() == 1


def test_drift_classes(spark, tmp_dir):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    declared = StructType([StructField("id", StringType()), StructField("n", LongType()),
                           StructField("gone", StringType()), StructField("obj", StringType())])
    src = write_lines(tmp_dir + "/d", "x.json", [json.dumps({"id": "a", "n": 1, "extra": True, "obj": {"k": 1}})])
    rep = J.detect_drift(declared, J.infer_source_schema(spark, src))
    assert rep.new == [("extra", "boolean")] and rep.missing == [("gone", "string")] and rep.changed == []
    src2 = write_lines(tmp_dir + "/e", "x.json", [json.dumps({"id": "a", "n": "one", "gone": "g", "obj": "t"})])
    rep2 = J.detect_drift(declared, J.infer_source_schema(spark, src2))
    assert rep2.changed == [("n", "bigint", "string")]


def test_ingest_idempotent_and_drift_halt(spark, tmp_dir):
    lines = [json.dumps({"business_id": f"b{i}", "date": "2020-01-01 00:00:00, 2020-01-02 00:00:00"}) for i in range(5)]
    src = write_lines(tmp_dir + "/land", "checkin.json", lines + ["{broken"])
    out = tmp_dir + "/bronze"
    kw = dict(audit_path=tmp_dir + "/audit", quarantine_path=tmp_dir + "/q", min_rows=1)
    r1 = B.ingest_entity(spark, "checkins", src, out, dt.date(2024, 1, 2), RUN, **kw)
    r2 = B.ingest_entity(spark, "checkins", src, out, dt.date(2024, 1, 2), RUN, **kw)
    assert r1.rows_written == r2.rows_written == 5 and r1.quarantined == 1
    assert spark.read.parquet(out).count() == 5
    B.ingest_entity(spark, "checkins", src, out, dt.date(2024, 1, 3), RUN, **kw)
    assert spark.read.parquet(out).count() == 10
    assert read_as_of(spark, out, dt.date(2024, 1, 2)).count() == 5
    assert spark.read.parquet(tmp_dir + "/audit").filter("status = 'SUCCESS'").count() == 3
    with pytest.raises(B.RowFloorError):
        B.ingest_entity(spark, "checkins", src, out, dt.date(2024, 1, 4), RUN, min_rows=100)
    bad = write_lines(tmp_dir + "/bad", "c.json", [json.dumps({"business_id": 1.5, "date": "x"})])
    with pytest.raises(J.SchemaDriftError):
        B.ingest_entity(spark, "checkins", bad, out, dt.date(2024, 1, 5), RUN, drift_path=tmp_dir + "/drift", min_rows=0)
    assert spark.read.parquet(tmp_dir + "/drift").filter("change_kind = 'type_change'").count() == 1


def test_schema_guard(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    check_schema(a, a.schema)
    with pytest.raises(SchemaMismatch):
        check_schema(a, spark.createDataFrame([(1, 2)], "a int, b int").schema)


def test_good_plus_quarantine_equals_input(spark, tmp_dir):
    lines = [json.dumps({"business_id": f"b{i}", "date": "2020-01-01 00:00:00"}) for i in range(40)]
    lines[7] = lines[7][:-5]
    lines[21] = "not json at all"
    src = write_lines(tmp_dir + "/land", "c.json", lines)
    p = J.split_corrupt(J.read_json_entity(spark, src, CHECKINS_SCHEMA))
    good, bad = p.good, p.bad
    assert good.count() + bad.count() == len(lines) and bad.count() == 2


def test_new_column_is_kept_and_quarantine_is_replaced(spark, tmp_dir):
    from strataflow.sources.tables import load_table
    tip = {"business_id": "a", "user_id": "u", "date": "2024-01-01 00:00:00", "compliment_count": 1}
    day1 = write_lines(tmp_dir + "/1", "t.json", [json.dumps(tip), "{broken"])
    day2 = write_lines(tmp_dir + "/2", "t.json", [json.dumps({**tip, "client": "app"})])
    kw = dict(quarantine_path=tmp_dir + "/q", audit_path=tmp_dir + "/audit", min_rows=0)
    r1 = B.ingest_entity(spark, "tips", day1, tmp_dir + "/b", dt.date(2024, 1, 1), RUN, **kw)
    r2 = B.ingest_entity(spark, "tips", day2, tmp_dir + "/b", dt.date(2024, 1, 2), RUN, **kw)
    assert (r1.new_columns, r2.new_columns, r1.stale) == ([], ["client"], True)
    got = sorted((str(r.ingestion_date), r.client) for r in load_table(spark, tmp_dir + "/b").collect())
    assert got == [("2024-01-01", None), ("2024-01-02", "app")]
    # the first day again, now clean: its quarantine goes, the table keeps the new column
    fixed = write_lines(tmp_dir + "/1b", "t.json", [json.dumps(tip)])
    B.ingest_entity(spark, "tips", fixed, tmp_dir + "/b", dt.date(2024, 1, 1), RUN, **kw)
    assert not os.path.exists(tmp_dir + "/q/ingestion_date=2024-01-01")
    assert sorted((str(r.ingestion_date), r.client) for r in load_table(spark, tmp_dir + "/b").collect()) == got
    bad = write_lines(tmp_dir + "/3", "t.json", [json.dumps({**tip, "client": 5})])
    with pytest.raises(SchemaMismatch):
        B.ingest_entity(spark, "tips", bad, tmp_dir + "/b", dt.date(2024, 1, 3), RUN, **kw)


# ── one parse ──────────────────────────────────────────────────────────────

def test_source_is_read_once(spark, tmp_dir, monkeypatch):
    """Drift, typed columns and quarantine come from the copy: the source may be gone after the parse."""
    import shutil
    tip = {"business_id": "a", "user_id": "u", "date": "2024-01-01 00:00:00", "compliment_count": 1}
    src = write_lines(tmp_dir + "/land", "t.json", [json.dumps({**tip, "client": {"os": "x"}}), json.dumps({**tip, "text": "hi"}), "{cut", "", "  "])
    real = J.parse_once

    def then_gone(*a, **kw):
        out = real(*a, **kw)
        shutil.rmtree(src)
        return out
    monkeypatch.setattr(J, "parse_once", then_gone)
    got = B.ingest_entity(spark, "tips", src, tmp_dir + "/b", dt.date(2024, 1, 1), RUN, quarantine_path=tmp_dir + "/q",
                          drift_path=tmp_dir + "/drift", audit_path=tmp_dir + "/audit", min_rows=0)
    assert (got.rows_written, got.quarantined, got.new_columns) == (2, 1, [])
    rows = {r.text: r.client for r in spark.read.parquet(tmp_dir + "/b").collect()}
    assert rows == {None: '{"os":"x"}', "hi": None}
    assert [r[0] for r in spark.read.parquet(tmp_dir + "/q").select("_corrupt_record").collect()] == ["{cut"]
    assert spark.read.parquet(tmp_dir + "/drift").filter("change_kind = 'new' and column_name = 'client'").count() == 1


def test_parse_reads_lines_as_the_contract_says(spark, tmp_dir):
    from strataflow.schemas import BUSINESS_SCHEMA
    lines = [
        json.dumps({"business_id": "a", "stars": 4, "review_count": 3, "is_open": 1, "hours": {"Mo": "9-5"}, "latitude": 1.25, "postal_code": 123}),
        json.dumps({"business_id": "b", "stars": None, "is_open": None, "hours": ["x", 1]}),
        json.dumps({"business_id": "c", "is_open": 1 << 40}),             # no int
        '{"business_id": "d", "business_id": "e"}', '"text"', "[1]", "17", "null",
    ]
    p = J.parse_once(spark, write_lines(tmp_dir + "/l", "b.json", lines), BUSINESS_SCHEMA)
    assert (p.n_good, p.n_bad, p.corrupt().count()) == (2, 6, 6)
    rows = {r.business_id: r for r in p.typed(BUSINESS_SCHEMA).collect()}
    assert (rows["a"].stars, rows["a"].review_count, rows["a"].is_open, rows["a"].hours, rows["a"].latitude, rows["a"].postal_code) == \
        (4.0, 3, 1, '{"Mo":"9-5"}', 1.25, "123")
    assert rows["b"].stars is None and rows["b"].hours == '["x",1]'
    # the same rows as the schema-enforced read, where both read a line
    plain = J.read_json_entity(spark, write_lines(tmp_dir + "/m", "b.json", [x.replace('": ', '":').replace(", ", ",") for x in lines[:2]]), BUSINESS_SCHEMA).drop("_corrupt_record")
    typed = J.parse_once(spark, tmp_dir + "/m", BUSINESS_SCHEMA).typed(BUSINESS_SCHEMA)
    assert sorted(map(str, plain.collect())) == sorted(map(str, typed.collect()))


def test_implied_schema_is_that_of_json_inference(spark, tmp_dir):
    rows = [{"i": 1, "f": 1.5, "mix": 1, "part": 1, "s": "x", "b": True, "n": None, "o": {"k": 1}, "l": [1], "odd name's": 2},
            {"i": 2, "f": 2, "mix": "x", "part": 2.5, "s": None, "b": False, "n": None, "o": {"j": "t"}, "l": []}]
    src = write_lines(tmp_dir + "/l", "x.json", [json.dumps(r) for r in rows])
    from pyspark.sql.types import StructType
    got, want = J.parse_once(spark, src, StructType([])).inferred, J.infer_source_schema(spark, src)
    assert {f.name: J.type_class(f.dataType) for f in got.fields} | {"n": "string"} == \
        {f.name: J.type_class(f.dataType) for f in want.fields} | {"n": "string"}
    assert J.implied_schema("VOID").fields == []


def test_empty_source_and_halts_are_audited(spark, tmp_dir):
    tip = {"business_id": "a", "user_id": "u", "date": "2024-01-01 00:00:00", "compliment_count": 1, "client": "app"}
    kw = dict(audit_path=tmp_dir + "/audit", drift_path=tmp_dir + "/drift")
    empty = write_lines(tmp_dir + "/0", "t.json", [""])
    got = B.ingest_entity(spark, "tips", empty, tmp_dir + "/b", dt.date(2024, 1, 1), RUN, min_rows=0, **kw)
    assert (got.rows_written, got.quarantined) == (0, 0)
    B.ingest_entity(spark, "tips", write_lines(tmp_dir + "/1", "t.json", [json.dumps(tip)]), tmp_dir + "/b", dt.date(2024, 1, 2), RUN, min_rows=0, **kw)
    # a column that only the table knows changes its type: event and audit record, then halt
    other = write_lines(tmp_dir + "/2", "t.json", [json.dumps({**tip, "client": 7})])
    with pytest.raises(J.SchemaDriftError):
        B.ingest_entity(spark, "tips", other, tmp_dir + "/b", dt.date(2024, 1, 3), RUN, min_rows=0, **kw)
    with pytest.raises(B.RowFloorError):
        B.ingest_entity(spark, "tips", other, tmp_dir + "/new", dt.date(2024, 1, 4), RUN, min_rows=5, **kw)
    log = {str(r.run_date): (r.status, r.error.split(":")[0], r.row_count) for r in spark.read.parquet(tmp_dir + "/audit").collect()}
    assert log["2024-01-03"] == ("FAILED", "SchemaDriftError", None) and log["2024-01-04"] == ("FAILED", "RowFloorError", 1)
    assert log["2024-01-02"][0] == "SUCCESS"
    assert spark.read.parquet(tmp_dir + "/drift").filter("change_kind = 'type_change' and column_name = 'client'").count() == 1


def test_ingest_writes_a_day_in_the_tasks_it_was_parsed_in(spark, tmp_dir):
    line = '{"review_id": "r%d", "business_id": "b", "user_id": "u", "stars": 3, "date": "2024-01-01 00:00:00"}'
    spark.range(400).select(F.format_string(line, "id").alias("value")).repartition(6).write.text(tmp_dir + "/in", compression="gzip")
    got = B.ingest_entity(spark, "reviews", tmp_dir + "/in", tmp_dir + "/bronze", dt.date(2024, 1, 2), RUN, min_rows=0)
    # a shuffle of all rows would make one file of so few
    assert len([f for f in os.listdir(tmp_dir + "/bronze/ingestion_date=2024-01-02") if f.endswith(".parquet")]) > 1
    assert got.rows_written == 400 and spark.read.parquet(tmp_dir + "/bronze").select("review_id").distinct().count() == 400
