"""The corpus pipeline: quality, language, near-duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared scratch folder and reads it back as the next
stage's ``docs``. All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import decontaminate, language, packing, quality, simhash
from strataflow.llm.common import ship, stored, table
from strataflow.llm.queries import vocabulary_file

#: Documents with a lower quality score go.
MIN_QUALITY = 0.3
#: Documents go of whose n-grams a smaller share is known, if their score, counted for that share alone, is lower too
#: (0.5: the best language's classifier is undecided) and they have so many letters to judge by. The least share of a given
#: document that scores so low is 0.94; the largest of six test texts in other languages is 0.84.
MIN_LANGUAGE, MIN_KNOWN, LANGUAGE_LETTERS = 0.5, 0.9, 200


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF, learned from the labels, scores at least ``MIN_QUALITY``.

    Null and empty texts have the score of a text without lines and are judged by it; rows that repeat are judged
    each, alike; without labels every score is 0.5 and nothing goes; an empty table stays empty; all columns of
    ``docs`` are returned as they were, whatever their names.
    """
    ship(spark)
    crf = quality.train(docs, table(spark, sf_dir, "labels"))
    return _rows(quality.score(_packed(docs), crf, out="score").where(f"score >= {MIN_QUALITY}"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that ``docs`` itself teaches.

    Documents without a letter (``und``; null and empty texts too) go, and those of at least ``LANGUAGE_LETTERS`` letters
    of whose n-grams the sample knows fewer than ``MIN_KNOWN`` and whose score times that share is below ``MIN_LANGUAGE``. A text
    that mixes learned languages has known n-grams and stays. Rows that repeat
    are judged each, alike; a table that teaches no language is ``und`` throughout; all columns of ``docs`` are
    returned as they were, whatever their names.
    """
    ship(spark)
    found = language.predict(_packed(docs), language.train(docs), lang_out="lang", score_out="score", known_out="known")
    few = F.length(F.regexp_replace("text", r"\P{L}", "")) < LANGUAGE_LETTERS
    learned = (F.col("known") >= MIN_KNOWN) | (F.col("score") * F.col("known") >= MIN_LANGUAGE)
    return _rows(found.where((F.col("lang") != language.UND) & (learned | few)))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within 3 bits: the one with the smallest id.

    Null, empty and other wordless texts have fingerprint zero and are one group, of which one stays; see
    ``simhash.keep_one`` for null ids and repeated rows. All columns of ``docs`` are returned.
    """
    ship(spark)
    return simhash.keep_one(docs, width=3, k=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window of 10 words.

    Null, empty and wordless texts have no window and stay; rows that repeat are judged each, alike; an empty
    benchmark removes nothing. All columns of ``docs`` are returned.
    """
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), mode="documents", width=10)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in training sequences of at most 2048 tokens.

    A null or empty text is a piece of its end token alone; rows that repeat are packed each; an empty table
    gives no pieces. Returns the pieces (see ``packing.pack``), not the columns of ``docs``.
    """
    ship(spark)
    return packing.pack(packing.cut_pieces(docs, vocabulary_file(), end_id=0, capacity=2048), capacity=2048)


def _packed(docs: DataFrame) -> DataFrame:
    """The whole row as one column beside its text, so that a stage's own columns meet no others."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))


def _rows(packed: DataFrame) -> DataFrame:
    return packed.select("row.*")


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Four of the five stages are models, hashes or tokenizers that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
