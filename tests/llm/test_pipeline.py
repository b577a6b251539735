"""The pipeline keeps clean documents and drops planted ones; the entry works without this part."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from strataflow.llm import queries

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_stages_keep_columns_and_drop_planted_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first()
    clean = docs.where("doc_id = 1").first()
    junk = "\n".join(["BUY!! NOW!! $$$ ###"] * 30)
    planted = [(9001, junk), (9002, "123 456 !!!"), (9003, clean.text + " "), (9004, f"Some words before it. {item.text} Some words after."), (9005, None)]
    extra = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in planted], docs.schema)
    gone, now = {}, docs.unionByName(extra)
    for name, stage in C.STAGES[:-1]:
        kept = stage(spark, now, SF)
        assert kept.columns == docs.columns
        kept.write.parquet(f"file://{tmp_path}/{name}")
        kept = spark.read.parquet(f"file://{tmp_path}/{name}")
        left = {r.doc_id for r in kept.select("doc_id").collect()}
        gone[name] = {r.doc_id for r in now.select("doc_id").collect()} - left
        now = kept
    assert 9001 in gone["quality"]
    assert 9002 in gone["quality"] | gone["language"] and 9005 in gone["quality"] | gone["language"]
    assert 9003 in gone["simhash"] and 1 not in gone["simhash"]
    assert 9004 in gone["decontamination"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert not [i for i in gone["quality"] if labels.get(i) == 1]
    packed = C.STAGES[-1][1](spark, now, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in now.select("doc_id").collect()}


def test_stages_return_every_column_and_handle_edge_rows(spark):
    """Clashing names, a null id, repeated rows, null, empty and very long texts, and an empty table, in every stage."""
    own = spark.read.parquet(f"{SF}/documents.parquet")
    more = [(None, "A row without an id, in plain words."), (None, None), (8001, ""), (8002, None), (8003, "⅔ ² Ⅻ ①"),
            (8005, "word " * 40_000), (8006, own.first().text), (8006, own.first().text)]
    docs = own.unionByName(spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in more], own.schema))
    clash = ["_quality", "_lang", "_lang_score", "_language", "row", "score", "found", "id", "fp", "lang_pred"]
    docs = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in clash])
    for name, stage in C.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.dtypes == docs.dtypes, name
        rows = kept.collect()
        for r in rows:
            assert all(r[c] == f"{c}:{'-' if r.doc_id is None else r.doc_id}" for c in clash), name
        n = {i: sum(r.doc_id == i for r in rows) for i in (8001, 8002, 8003, 8005, 8006)}
        if name == "language":
            assert (n[8001], n[8002], n[8003], n[8006]) == (0, 0, 0, 2)         # numbers are no letters
            assert sum(r.doc_id is not None and r.doc_id < 8000 for r in rows) == own.count()
        if name == "decontamination":
            assert n[8001] == n[8002] == 1
        if name == "simhash":
            assert n[8001] + n[8002] <= 1
        assert stage(spark, docs.limit(0), SF).count() == 0
    packed = C.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert C.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


#: A sentence in languages that the tables do not teach (fixed test texts).
UNLEARNED = [
    "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ",
    "tutti gli esseri umani nascono liberi ed eguali in dignità e diritti essi sono dotati di ragione e di coscienza ",
    "alle mensen worden vrij en gelijk in waardigheid en rechten geboren zij zijn begiftigd met verstand en geweten ",
    "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem ",
    "все люди рождаются свободными и равными в своём достоинстве и правах они наделены разумом и совестью ",
    "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待 ",
]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_language_stage_rejects_languages_that_were_not_learned(spark, sf):
    """Long texts in other languages go; given documents, mixtures of them in every number of languages, and short texts stay."""
    own = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    parts = [r.t for r in own.where("lang is not null and length(text) between 300 and 3000").groupBy("lang")
             .agg(F.min_by("text", "doc_id").alias("t")).orderBy("lang").collect()]
    words = [t.split() for t in parts]
    mixed = ["\n".join(parts[:2]), "\n".join(parts[:3]), "\n".join(parts), " ".join(w for ws in zip(*words) for w in ws)]
    more = [(900_001 + i, t * 8) for i, t in enumerate(UNLEARNED)] + [(900_101 + i, t) for i, t in enumerate(mixed)] + [(900_201, UNLEARNED[0][:60])]
    docs = own.unionByName(spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in more], own.schema))
    kept = C.language_stage(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.where("doc_id > 900000").collect()) == [*range(900_101, 900_101 + len(mixed)), 900_201]
    assert kept.where("doc_id < 900000").count() == own.count()


def test_run_equals_its_stages(spark):
    n = C.run(spark, SF).count()
    assert n > 0


def test_every_operator_has_one_query():
    names = sorted(queries.QUERIES, key=lambda q: int(q[2:].split("_")[0]))
    assert [int(q[2:].split("_")[0]) for q in names] == list(range(1, 14))


def test_entry_works_without_the_corpus_part():
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('strataflow.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert 'pipeline' not in e.queries() and 'rising_stars' in e.queries() and len(e.oracle_sql()) >= 50\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
