"""Newline-JSON sources: one parse of the lines, a quarantine for malformed
rows, and schema drift detection against the declared contract.

``parse_once`` reads a source a single time: each line becomes a ``VARIANT``
that is written to the shared scratch folder, and the schema that the lines
imply is aggregated on the way (``schema_of_variant_agg``). Drift, typed columns
and the quarantine all come from that copy. ``read_json_entity`` is the plain
schema-enforced read (streams and small reads).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DecimalType, DoubleType,
                               FloatType, IntegerType, LongType, MapType, NullType,
                               ShortType, ByteType, StringType, StructField, StructType, VariantType)

from strataflow.schemas import DRIFT_EVENT_SCHEMA
from strataflow.session import checkpoint_root, scratch_path
from strataflow.sources.tables import SchemaMismatch

CORRUPT_COL = "_corrupt_record"


class SchemaDriftError(SchemaMismatch):
    """A column of the contract or of the table changed its type class in the source: halt."""


def with_corrupt_column(schema: StructType) -> StructType:
    if CORRUPT_COL in schema.fieldNames():
        return schema
    return StructType(list(schema.fields) + [StructField(CORRUPT_COL, StringType(), True)])


def read_json_entity(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parse with a declared schema in PERMISSIVE mode; a row that does not
    fit (truncated line, wrong type) keeps its text in ``_corrupt_record``."""
    return (spark.read.schema(with_corrupt_column(schema))
                 .option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", CORRUPT_COL)
                 .json(path))


@dataclass
class Parsed:
    """One materialised parse: good rows, quarantined rows, and what was observed while writing it."""
    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int
    latest: object = None


def split_corrupt(parsed: DataFrame, freshness_col: str | None = None, freshness_format: str | None = None) -> Parsed:
    """Good rows (without the corrupt column) and quarantined rows.

    Which rows count as corrupt depends on the columns a query asks the JSON
    reader for, so the full parse is materialised once (reliable checkpoint in
    the shared checkpoint folder) and both outputs are cut from that copy. The
    counts and the latest freshness time are observed during that one pass.
    """
    checkpoint_root(parsed.sparkSession)
    seen = Observation("parsed")
    ok = F.col(CORRUPT_COL).isNull()
    latest = F.lit(None).cast("timestamp")
    if freshness_col and freshness_col in parsed.columns:
        text = F.col(freshness_col)
        latest = F.try_to_timestamp(text, F.lit(freshness_format)) if freshness_format else text.cast("timestamp")
    full = parsed.observe(seen, F.count_if(ok).alias("good"), F.count_if(~ok).alias("bad"),
                          F.max(F.when(ok, F.unix_micros(latest.cast("timestamp")))).alias("latest")).checkpoint(eager=True)
    got = seen.get
    return Parsed(full.filter(ok).drop(CORRUPT_COL), full.filter(~ok).select(CORRUPT_COL),
                  int(got["good"]), int(got["bad"]), got["latest"])


# ── one parse ──────────────────────────────────────────────────────────────

DOC, LINE = "doc", "line"


@dataclass
class ParsedLines:
    """The stored copy of a source: a variant per line, the text of lines that do not fit, and what was seen on the way."""
    copy: DataFrame
    inferred: StructType
    n_good: int
    n_bad: int
    latest: int | None = None

    def typed(self, schema: StructType) -> DataFrame:
        """Good rows under ``schema`` (a column the source lacks is null)."""
        good = self.copy.filter(F.col(LINE).isNull())
        return good.select(*[_value(f.name, f.dataType).alias(f.name) for f in schema.fields])

    def corrupt(self) -> DataFrame:
        return self.copy.filter(F.col(LINE).isNotNull()).select(F.col(LINE).alias(CORRUPT_COL))


def _path(name: str) -> str:
    return f"$['{name}']" if "'" not in name else f'$["{name}"]'


def _value(name: str, t: DataType) -> Column:
    """A field of the line as the declared type. Where text is declared, objects and arrays are JSON text
    (without white space, an object's names in order)."""
    return F.try_variant_get(DOC, _path(name), t.simpleString())


def parse_once(spark: SparkSession, path: str, declared: StructType, freshness_col: str | None = None,
               freshness_format: str | None = None, rebalance: bool = True) -> ParsedLines:
    """Read the lines of ``path`` once and keep them as variants.

    A line does not fit if it is no JSON object (truncated, other text, a key
    named twice) or if the value of a declared column cannot be of its type; its text goes
    to the quarantine. Blank lines are no rows. The counts, the latest freshness time and the schema
    that all objects imply are observed while the copy is written.
    ``rebalance``: spread the lines over the cluster before they are parsed when the source could
    not be split into enough read tasks.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    if rebalance and lines.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        lines = lines.repartition(spark.sparkContext.defaultParallelism)
    parsed = lines.select("value", F.try_parse_json("value").alias(DOC))
    is_object = F.schema_of_variant(DOC).startswith("OBJECT")
    fits = is_object
    for f in declared.fields:
        if not isinstance(f.dataType, StringType):
            given = F.try_variant_get(DOC, _path(f.name), "variant")
            fits &= given.isNull() | F.is_variant_null(given) | _value(f.name, f.dataType).isNotNull()
    ok = F.coalesce(fits, F.lit(False))
    rows = parsed.select(F.when(is_object, F.col(DOC)).alias(DOC), F.when(~ok, F.col("value")).alias(LINE))
    latest = F.lit(None).cast("timestamp")
    if freshness_col and freshness_col in declared.fieldNames():
        text = _value(freshness_col, StringType())
        latest = F.try_to_timestamp(text, F.lit(freshness_format)) if freshness_format else text.cast("timestamp")
    seen, at = Observation("parsed_lines"), scratch_path(spark, "parsed_lines")
    good = F.col(LINE).isNull()
    (rows.observe(seen, F.schema_of_variant_agg(DOC).alias("schema"), F.count_if(good).alias("good"), F.count_if(~good).alias("bad"),
                  F.max(F.when(good, F.unix_micros(latest.cast("timestamp")))).alias("latest"))
     .write.parquet(at))
    got = seen.get
    return ParsedLines(spark.read.schema(rows.schema).parquet(at), implied_schema(got["schema"]), int(got["good"]), int(got["bad"]), got["latest"])


def implied_schema(text: str) -> StructType:
    """The columns of an aggregated variant schema ("OBJECT<a: BIGINT, ...>"), typed as JSON inference types
    them: fractions are double, values of several classes text."""
    found = DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", text)) if text.startswith("OBJECT<") else StructType([])

    def plain(t: DataType) -> DataType:
        if isinstance(t, VariantType):
            return StringType()
        return DoubleType() if isinstance(t, (DecimalType, FloatType)) else t
    return StructType([StructField(f.name, plain(f.dataType), True) for f in found.fields])


# ── drift ──────────────────────────────────────────────────────────────────

def type_class(t: DataType) -> str:
    if isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
        return "integral"
    if isinstance(t, (FloatType, DoubleType, DecimalType)):
        return "fractional"
    if isinstance(t, StringType):
        return "string"
    if isinstance(t, BooleanType):
        return "boolean"
    if isinstance(t, (StructType, ArrayType, MapType)):
        return "nested"
    if isinstance(t, NullType):
        return "null"
    return t.simpleString()


def compatible(expected: DataType, actual: DataType) -> bool:
    """Does inferred ``actual`` fit declared ``expected``?

    JSON inference widens every integer to bigint, reads objects as structs
    and all-null fields as null, so the comparison is by type class: integers
    fit integral and fractional columns, objects/arrays fit string columns
    (kept as JSON text), null is no evidence. Anything else is a break.
    """
    e, a = type_class(expected), type_class(actual)
    if a == "null" or e == a:
        return True
    if e == "fractional" and a == "integral":
        return True
    if e == "string" and a == "nested":
        return True
    return False


@dataclass
class DriftReport:
    new: list[tuple[str, str]] = field(default_factory=list)        # (column, inferred type)
    missing: list[tuple[str, str]] = field(default_factory=list)    # (column, declared type)
    changed: list[tuple[str, str, str]] = field(default_factory=list)  # (column, declared, inferred)

    @property
    def drifted(self) -> bool:
        return bool(self.new or self.missing or self.changed)

    def rows(self) -> list[tuple[str, str | None, str | None, str]]:
        """(change_kind, expected_type, actual_type, column_name) per finding."""
        out = [("new", None, t, c) for c, t in self.new]
        out += [("missing", t, None, c) for c, t in self.missing]
        out += [("type_change", e, a, c) for c, e, a in self.changed]
        return out


def infer_source_schema(spark: SparkSession, path: str) -> StructType:
    """Schema the JSON itself implies, from all rows (a sample would miss new columns and type changes)."""
    inferred = spark.read.json(path).schema
    return StructType([f for f in inferred.fields if f.name != CORRUPT_COL])


def detect_drift(expected: StructType, actual: StructType, ignore: tuple = ("ingestion_date",),
                 stored: StructType | None = None) -> DriftReport:
    """What ``actual`` has that the contract does not, lacks, or types otherwise. Columns beside the contract
    that the table has by now (``stored``) may not change their type either."""
    exp = {f.name: f.dataType for f in expected.fields if f.name not in ignore}
    act = {f.name: f.dataType for f in actual.fields if f.name not in ignore}
    rep = DriftReport()
    rep.new = sorted((c, act[c].simpleString()) for c in set(act) - set(exp))
    rep.missing = sorted((c, exp[c].simpleString()) for c in set(exp) - set(act))
    kept = {f.name: f.dataType for f in (stored.fields if stored else []) if f.name not in exp and f.name not in ignore}
    rep.changed = sorted((c, t.simpleString(), act[c].simpleString())
                         for c, t in (exp | kept).items() if c in act and not compatible(t, act[c]))
    return rep


def read_schema_for(expected: StructType, report: DriftReport, actual: StructType, stored: StructType | None = None) -> StructType:
    """Declared schema plus the new columns (as the table has them, else as inferred; nested ones as text)."""
    extra = []
    act = {f.name: f.dataType for f in actual.fields} | {f.name: f.dataType for f in (stored.fields if stored else [])}
    for c, _ in report.new:
        t = act[c]
        extra.append(StructField(c, StringType() if type_class(t) in ("nested", "null") else t, True))
    return StructType(list(expected.fields) + extra)


def drift_events(spark: SparkSession, entity: str, report: DriftReport, run_date, run_ts) -> DataFrame:
    """Drift findings as event rows (for the append-only drift log)."""
    rows = [(entity, "bronze", "schema_drift", kind, col, e, a) for kind, e, a, col in report.rows()]
    df = spark.createDataFrame(rows, "entity string, layer string, event_type string, change_kind string, "
                                     "column_name string, expected_type string, actual_type string")
    return (df.withColumn("run_date", F.lit(run_date).cast("date"))
              .withColumn("run_timestamp", F.lit(str(run_ts)).cast("timestamp"))
              .select(*[f.name for f in DRIFT_EVENT_SCHEMA.fields]))
