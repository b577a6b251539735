"""Slowly changing history (type 2) and point-in-time joins.

A history table holds versions of each key with ``valid_from``,
``valid_to`` (null while current), ``is_current`` and ``record_hash`` (md5 of
the tracked attributes). A snapshot states what each of its keys looked like at
its run time; consecutive statements with one hash are one version. Snapshots
may be applied in any order: a late one is placed between the versions that are
there, its neighbours are cut or merged, and a run that is repeated with another
snapshot replaces what it stated before.

For that a version keeps the run times that stated it, as ranges of the table's
runs (``seen``): one range, unless the key was absent from a run in between.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.columns import record_hash, ts_lit
from strataflow.operators.running import running_totals

META = ["valid_from", "valid_to", "is_current"]
SEEN = "seen"

# Tracked attributes of the two history tables.
BUSINESS_TRACKED = ["name", "city", "state", "stars", "review_count", "is_open", "primary_category"]
USER_TRACKED = ["is_elite", "elite_years_count", "review_count", "average_stars", "fan_count"]


def with_hash(snapshot: DataFrame, tracked: Sequence[str]) -> DataFrame:
    return snapshot.withColumn("record_hash", record_hash(*tracked))


def _moment(value) -> dt.datetime:
    """A run time on the driver (UTC, without zone), from a datetime or text."""
    value = value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))
    return value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def _neighbours(run_ts, runs: Sequence) -> tuple[Column, Column]:
    """The last run before and the first run after ``run_ts`` (null: none)."""
    at, known = _moment(run_ts), [_moment(r) for r in runs]
    before, after = max((r for r in known if r < at), default=None), min((r for r in known if r > at), default=None)
    return tuple(ts_lit(x) if x else F.lit(None).cast("timestamp") for x in (before, after))


def scd2_apply(history: DataFrame | None, snapshot: DataFrame, key: str, tracked: Sequence[str], run_ts,
               runs: Sequence = ()) -> DataFrame:
    """New history after ``snapshot`` says what its keys were at ``run_ts``.

    * new key -> one open version;
    * tracked attributes changed -> the version that covers ``run_ts`` ends there
      and a new one begins (untracked columns such as a name do not open
      versions; a version holds their values of its first statement, and both
      parts of a version that is cut do);
    * unchanged -> stays; key absent from the snapshot -> stays as it is;
    * ``run_ts`` before stored versions -> placed between them: a version that
      was stated before and after is cut in three, versions that become
      neighbours with one hash are merged;
    * ``run_ts`` seen before -> its old statements go first.

    ``history`` needs to hold the versions that were current at ``run_ts`` or
    later; ``runs`` are the times of the table's runs. One shuffle by key; a
    key's versions meet in one array (no more than it has versions since then).
    Keys of a snapshot are unique; of two rows at one time the first by hash counts.
    """
    snap = with_hash(snapshot, tracked)
    cols = snap.columns
    at = ts_lit(run_ts)
    before, after = _neighbours(run_ts, runs)

    def piece(seen: Column) -> Column:
        return F.struct(F.get(seen, F.lit(0))["a"].alias("start"), F.col("record_hash").alias("hash"), seen.alias(SEEN), F.struct(*cols).alias("row"))

    stated = F.array(F.struct(at.alias("a"), at.alias("b")))
    pieces = snap.select(F.col(key).alias("_key"), piece(stated).alias("piece"))
    if history is not None:
        # what other runs stated, on both sides of this one
        earlier = F.transform(F.filter(SEEN, lambda r: r["a"] < at),
                              lambda r: F.struct(r["a"].alias("a"), F.when(r["b"] < at, r["b"]).otherwise(F.greatest(r["a"], before)).alias("b")))
        later = F.transform(F.filter(SEEN, lambda r: r["b"] > at),
                            lambda r: F.struct(F.when(r["a"] > at, r["a"]).otherwise(F.least(r["b"], after)).alias("a"), r["b"].alias("b")))
        known = history.select(F.col(key).alias("_key"), F.explode(F.filter(F.array(piece(earlier), piece(later)), lambda x: F.size(x[SEEN]) > 0))
                               .alias("piece"))
        pieces = known.unionByName(pieces)

    def joined(x: Column, y: Column) -> Column:
        """Ranges of two neighbours; ranges with no run between them become one."""
        end, begin = F.try_element_at(x, F.lit(-1)), F.get(y, F.lit(0))
        touch = ((end["b"] == before) & (begin["a"] == at)) | ((end["b"] == at) & (begin["a"] == after))
        one = F.array(F.struct(end["a"].alias("a"), begin["b"].alias("b")))
        return F.when(F.coalesce(touch, F.lit(False)),
                      F.concat(F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0))), one, F.slice(y, 2, F.greatest(F.size(y) - 1, F.lit(0))))).otherwise(F.concat(x, y))

    def fold(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        rest = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        longer = F.struct(last["start"].alias("start"), last["hash"].alias("hash"), joined(last[SEEN], x[SEEN]).alias(SEEN), last["row"].alias("row"))
        return (F.when(F.size(done) == 0, F.array(x)).when(last["start"] == x["start"], done)
                 .when(last["hash"] == x["hash"], F.concat(rest, F.array(longer))).otherwise(F.concat(done, F.array(x))))

    in_order = pieces.groupBy("_key").agg(F.array_sort(F.collect_list("piece")).alias("_p"))
    merged = in_order.select(F.aggregate("_p", F.filter("_p", lambda x: F.lit(False)), fold).alias("_v"))
    each = merged.select("_v", F.posexplode("_v").alias("_i", "_x"))
    end = F.get("_v", F.col("_i") + 1)["start"]
    return each.select("_x.row.*", F.col("_x.start").alias("valid_from"), end.alias("valid_to"), end.isNull().alias("is_current"), f"_x.{SEEN}")


def as_of_join(facts: DataFrame, history: DataFrame, key: str, ts_col: str,
               attrs: Sequence[str], how: str = "left") -> DataFrame:
    """Attach the history version valid at each fact's timestamp:
    ``valid_from <= ts < coalesce(valid_to, +inf)``.

    Facts and versions are put in one order by (key, time); a fact's version is
    the last one before it, a running value. So the work grows with facts plus
    versions, never with their product, and a key that holds a large share of
    either is cut over several tasks (``running_totals``). Versions of a key must not overlap. A fact with a
    null key or time has no version. ``how``: ``left`` or ``inner``.
    """
    names = ["valid_from", "valid_to", *[a for a in attrs if a not in ("valid_from", "valid_to")]]
    versions = history.filter(F.col(key).isNotNull() & F.col("valid_from").isNotNull())
    rows = facts.select(F.col(key).alias("_key"), F.col(ts_col).cast("timestamp").alias("_at"), F.lit(1).alias("_kind"), F.struct("*").alias("_fact"))
    changes = versions.select(F.col(key).cast(facts.schema[key].dataType).alias("_key"), F.col("valid_from").cast("timestamp").alias("_at"),
                              F.lit(0).alias("_kind"), F.struct(*names).alias("_version"))
    both = rows.unionByName(changes, allowMissingColumns=True)
    found = running_totals(both, ["_key"], ["_at", "_kind"], lasts={"_valid": "_version"}).filter("_kind = 1")
    until = F.col("_valid.valid_to")
    valid = F.when(F.col("_key").isNotNull() & F.col("_at").isNotNull() & (until.isNull() | (F.col("_at") < until)), F.col("_valid"))
    out = found.withColumn("_valid", valid)
    if how == "inner":
        out = out.filter(F.col("_valid").isNotNull())
    elif how != "left":
        raise ValueError(f"as_of_join: how={how}")
    return out.select("_fact.*", *[F.col("_valid")[n].alias(n) for n in names])


CLOSED_RUN = "closed_run"


RUNS_FILE = "_runs.json"


def scd2_store(spark, path: str, snapshot: DataFrame, key: str, tracked: Sequence[str], run_ts,
               fmt: str = "parquet") -> int:
    """Apply a snapshot to a stored history table without rewriting it whole.

    The table is partitioned by ``closed_run`` (the run that closed a version;
    null for current versions). The newest run reads only the current partition,
    and one dynamic-overwrite write replaces that partition and creates the
    partition of the versions closed by this run; both become visible at the
    same commit. A late run also reads and rewrites the partitions of versions
    that were closed since its time, no older ones. Re-running a ``run_ts``
    replaces what it stated (idempotent). The times of the runs are recorded beside the table
    after the commit; a run that stops in between is completed by running it again.
    """
    from strataflow.sources.tables import (check_schema, delete_path, partition_dir, partition_values, path_exists, read_json_file,
                                           write_json_file, write_partitions_observed)
    runs_file = path.rstrip("/") + "/" + RUNS_FILE
    runs = (read_json_file(spark, runs_file) or {"runs": []})["runs"]
    touched: list = []
    if not path_exists(spark, path):
        out = scd2_apply(None, snapshot, key, tracked, run_ts)
    else:
        stored = spark.read.format(fmt).load(path)
        tag = "r" + _moment(run_ts).strftime("%Y%m%d%H%M%S%f")
        touched = [v for v in partition_values(spark, path, CLOSED_RUN) if v is None or v >= tag]
        since = stored.filter(F.col(CLOSED_RUN).isNull() | (F.col(CLOSED_RUN) >= tag)).drop(CLOSED_RUN)
        out = scd2_apply(since, snapshot, key, tracked, run_ts, runs)
        check_schema(out, stored.schema, ignore=[CLOSED_RUN])
    # the current and this run's partition: all tasks have rows of both, and each writes its own
    n, present = write_partitions_observed(out.withColumn(CLOSED_RUN, _run_tag(F.col("valid_to"))), path, [CLOSED_RUN], fmt,
                                           rebalance=len(touched) > 2)
    for v in touched:
        if (v,) not in present:
            delete_path(spark, partition_dir(path, {CLOSED_RUN: v}))
    write_json_file(spark, runs_file, {"runs": sorted({*runs, _moment(run_ts).isoformat(sep=" ")})})
    return n


def _run_tag(ts) -> F.Column:
    """Partition value of a run, to the microsecond."""
    return F.concat(F.lit("r"), F.date_format(ts, "yyyyMMddHHmmssSSSSSS"))


def read_history(spark, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path).drop(CLOSED_RUN, SEEN)
