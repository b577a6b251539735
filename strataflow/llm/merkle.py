"""Merkle manifest of a dataset: a hash tree over all rows, and a proof for every row.

Rows are leaves. Per group (``lang``) the leaves stand in id order and every
``FAN`` neighbours become the hash of their concatenation, level by level, up
to the group's subroot; the subroots, in order of the group's value, become the
root in the same way. The built levels are stored as rows that name their
parent. A recursive SQL query then climbs from every leaf: each step appends a
row with the siblings it passes and folds the (possibly tampered) digest into
the parent's. A leaf's rows, in the order of their steps, are its proof; what
climbs is only the place and the folded digest, as Spark moves the rows of every
step.

All rows of the tree's top have the same few ancestors. So that no join key is
hot, leaves are numbered in blocks of ``BLOCK`` neighbours and an inner node is
stored once for each block below it: a join key meets at most ``BLOCK`` rows.
Digests travel as 32 bytes and become hex text only where they are hashed.

Defined cases: null fields are hashed as ``-``, so null and empty text differ;
a null id sorts first and counts as empty text in the tampering rule; rows that
repeat an id stand in the order of their digests and each is a leaf; a single
leaf is its own subroot, and a single subroot the root, with an empty proof; an
empty table has no tree and gives no rows. Columns beside the named fields are
not read. Ids are cast to long.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataflow.llm.common import partitions, release, remainder, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
#: Leaves that meet one copy of an inner node; a power of FAN.
BLOCK = FAN ** 3
DIGEST = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field_text(value: Column) -> Column:
    """A field as it is hashed: ``-`` for null, else its UTF-8 length, a colon and the value."""
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field_text(v) for v in values]), 256))


def _hash_of(children: Column) -> Column:
    """Digest of a run of digests, each as hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(children)), 256))


def hashed_leaves(docs: DataFrame, fields=FIELDS, group: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, grp, leaf, tampered) of every row; ``tampered`` is null where the tampering rule leaves the row alone."""
    col = lambda c: F.col(f"`{c}`")
    other = F.translate(col(text_col), UPPER, LOWER)
    return docs.select(col(id_col).cast("long").alias("id"), col(group).cast("string").alias("grp"),
                       leaf_digest(*[col(c) for c in fields]).alias("leaf"),
                       F.when(remainder(f"`{id_col}`", 3) == 0, leaf_digest(*[other if c == text_col else col(c) for c in fields])).alias("tampered"))


def numbered_leaves(hashed: DataFrame, made: list[DataFrame] | None = None) -> DataFrame:
    """The leaves, each with its group's number ``g`` (in order of its value), its place ``idx`` in the group and the group's size ``n``.

    One range shuffle; numbers come from the rows' places in the sorted, stored
    files and from prefix sums over (partition, group) counts, so neither a hot
    group nor many groups meet in one task. ``made`` collects the tables stored on the way.
    """
    hashed = stored(hashed.withColumn("row", F.monotonically_increasing_id()), "merkle_hashed")
    keys = ["grp", "id", "leaf", "row"]
    placed = stored(hashed.repartitionByRange(partitions(hashed.sparkSession), *keys).sortWithinPartitions(*keys).drop("row")
                    .withColumn("at", F.monotonically_increasing_id()), "merkle_placed")
    part = F.shiftright("at", 33)       # the number's upper bits are the partition's
    runs = stored(placed.groupBy(part.alias("part"), "grp").agg(F.min("at").alias("first"), F.count("*").alias("rows")), "merkle_runs")
    if made is not None:
        made += [hashed, placed, runs]
    in_group = W.partitionBy("grp").orderBy("part")
    runs = (runs.withColumn("before", F.coalesce(F.sum("rows").over(in_group.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("n", F.sum("rows").over(W.partitionBy("grp")))
            .withColumn("opens", (F.col("before") == 0).cast("long")))
    # a group's number: groups that open in earlier partitions, and those before it in its own
    opened = (runs.groupBy("part").agg(F.sum("opens").alias("opened"))
              .withColumn("earlier", F.coalesce(F.sum("opened").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))))
    here = F.sum("opens").over(W.partitionBy("part").orderBy("grp").rowsBetween(W.unboundedPreceding, W.currentRow))
    starts = (runs.withColumn("here", here).join(opened, "part")
              .select("part", F.col("grp").alias("of"), "first", "before", "n", (F.col("earlier") + F.col("here") - 1).alias("g")))
    return (placed.withColumn("part", part).join(starts, ["part"]).where(F.col("grp").eqNullSafe(F.col("of")))
            .select("id", "leaf", "tampered", "g", "n", (F.col("at") - F.col("first") + F.col("before")).alias("idx")))


NODE = ["g", "level", "idx", "n", "hash"]


def _levels(base: DataFrame, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """(runs, nodes) by level over the stored nodes ``base``: a run of up to FAN children and the node it makes.

    ``n`` counts a group's nodes on a level; where it is 1 the group is done.
    As many rounds as the largest group has levels.
    """
    most = base.agg(F.max("n")).first()[0] or 0
    level, nodes, runs = base, [base], []
    while most > 1:
        kids = F.sort_array(F.collect_list(F.struct("idx", "hash")))        # at most FAN rows a group
        made = (level.where("n > 1").groupBy("g", "level", "n", F.expr(f"idx div {FAN}").alias("up"))
                .agg(F.aggregate(kids, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["hash"])).alias("children"))
                .select("g", (F.col("level") + 1).alias("level"), F.col("up").alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
                        "children", _hash_of(F.col("children")).alias("hash")))
        run = stored(made, name)
        runs.append(run)
        level = run.select(*NODE)
        nodes.append(level)
        most = -(-most // FAN)
    return runs, nodes


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


#: Levels from here on are over the subroots.
TOP = 1000


def tree(leaves: DataFrame, made: list[DataFrame] | None = None) -> DataFrame | None:
    """Inner nodes as parent-linked rows (g, block, level, idx, up_level, up_idx, slot, children, hash, is_subroot), one for each block below a node.

    A node is named by its level and its place there, its parent by ``up_level`` and ``up_idx``; levels above
    the subroots go on from ``TOP``. The root has no parent. ``leaves``: (g, idx, n, leaf), stored.
    None where a single leaf is the root. ``made`` collects the tables stored on the way.
    """
    base = leaves.select("g", F.lit(0).alias("level"), "idx", "n", F.col("leaf").alias("hash"))
    runs, nodes = _levels(base, "merkle_level")
    subroots = stored(_union(nodes).where("n = 1").select("g", "hash"), "merkle_subroots")
    n_groups = subroots.count()
    top_runs, _ = _levels(subroots.select(F.lit(0).cast("long").alias("g"), F.lit(0).alias("level"), F.col("g").alias("idx"),
                                          F.lit(n_groups).cast("long").alias("n"), "hash"), "merkle_top")
    if made is not None:
        made += [*runs, subroots, *top_runs]
    sizes = leaves.select("g", "n").distinct()
    blocks = sizes.select("g", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {BLOCK}"))).alias("block"))
    rows = []
    for level, run in enumerate(runs, 1):
        wide = FAN ** level
        below = run.join(sizes.withColumnRenamed("n", "leaves"), "g") if wide > BLOCK else run
        first = F.expr(f"idx * {max(1, wide // BLOCK)} div {max(1, BLOCK // wide)}")
        copies = (F.sequence(first, F.least(first + (wide // BLOCK - 1), F.expr(f"(leaves - 1) div {BLOCK}"))) if wide > BLOCK else F.array(first))
        rows.append(below.select("g", F.explode(copies).alias("block"), "level", "idx", *_link(n_groups), "children", "hash",
                                 (F.col("n") == 1).alias("is_subroot")))
    # above the subroots: every block of a group passes the group's ancestors
    ancestor, up = blocks.withColumn("up", F.col("g")), []
    for run in top_runs:
        ancestor = ancestor.withColumn("up", F.expr(f"up div {FAN}"))
        link = [F.when(F.col("n") > 1, F.col("level") + TOP + 1).alias("up_level"), F.when(F.col("n") > 1, F.expr(f"idx div {FAN}")).alias("up_idx"),
                F.expr(f"idx % {FAN}").cast("int").alias("slot")]
        above = run.select(F.col("idx").alias("up"), (F.col("level") + TOP).alias("level"), "idx", *link, "children", "hash")
        up.append(ancestor.join(above, "up").select("g", "block", *above.columns[1:], F.lit(False).alias("is_subroot")))
    return _union(rows + up) if rows + up else None


def _link(n_groups: int) -> list[Column]:
    """Parent and slot of a node; a group's last node hangs below the first level over the subroots, if there is one."""
    inside, slot = [F.col("level") + 1, F.expr(f"idx div {FAN}")], F.expr(f"idx % {FAN}")
    if n_groups > 1:
        last = [F.lit(TOP + 1), F.expr(f"g div {FAN}")]
        up = [F.when(F.col("n") > 1, i).otherwise(x) for i, x in zip(inside, last)]
        slot = F.expr(f"if(n > 1, idx, g) % {FAN}")
    else:
        up = [F.when(F.col("n") > 1, i) for i in inside]
    return [up[0].cast("int").alias("up_level"), up[1].cast("long").alias("up_idx"), slot.cast("int").alias("slot")]


CLIMB = """
with recursive climb (g, block, place, step, up_level, up_idx, slot, folded, siblings, subroot, root, id, leaf) as (
  select g, block, idx, 0, up_level, up_idx, slot, coalesce(tampered, leaf), cast('' as binary), if(n = 1, leaf, cast(null as binary)),
         if(up_level is null, leaf, cast(null as binary)), id, leaf
  from {leaves}
  union all
  select c.g, c.block, c.place, c.step + 1, u.up_level, u.up_idx, u.slot,
         unhex(sha2(lower(hex(concat(substring(u.children, 1, {d} * c.slot), c.folded, substring(u.children, {d} * (c.slot + 1) + 1)))), 256)),
         concat(substring(u.children, 1, {d} * c.slot), substring(u.children, {d} * (c.slot + 1) + 1)),
         if(u.is_subroot, u.hash, cast(null as binary)), if(u.up_level is null, u.hash, cast(null as binary)),
         cast(null as bigint), cast(null as binary)
  from climb c join {nodes} u on c.g = u.g and c.block = u.block and c.up_level = u.level and c.up_idx = u.idx
)
select max(id) as id, max(leaf) as leaf, max(subroot) as subroot, max(root) as root,
       sha2(lower(hex(aggregate(array_sort(collect_list(named_struct('step', step, 'siblings', siblings))), cast('' as binary), (a, x) -> concat(a, x.siblings)))), 256) as proof,
       max(if(root is null, cast(null as binary), folded)) as folded
from climb group by g, place
"""


@contextmanager
def _any_number_of_rows(spark: SparkSession):
    """Spark stops a recursive query at a million rows unless told otherwise; the climb ends at the root by itself."""
    name = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def _drop(spark: SparkSession, made: list[DataFrame]) -> None:
    """Give back the disk of tables and shuffles that are done with, before the next step takes its own."""
    release(spark, *made)
    made.clear()


def manifest(docs: DataFrame, fields=FIELDS, group: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is what the proof makes of the row as it is found (here:
    under the tampering rule); ``verified`` says that it is the stored root.
    """
    spark = docs.sparkSession
    made: list[DataFrame] = []
    all_leaves = stored(numbered_leaves(hashed_leaves(docs, fields, group, id_col, text_col), made), "merkle_leaves")
    _drop(spark, made)
    nodes = tree(all_leaves, made)
    n_groups = all_leaves.select("g").distinct().count()
    leaves = (all_leaves.withColumn("level", F.lit(0)).withColumn("block", F.expr(f"idx div {BLOCK}"))
              .select("id", "leaf", "tampered", "g", "idx", "n", "block", *_link(n_groups)))
    if nodes is None:       # at most one leaf: it is the root
        climbed = leaves.select("id", "leaf", F.col("leaf").alias("subroot"), F.col("leaf").alias("root"), F.sha2(F.lit(""), 256).alias("proof"),
                                F.coalesce("tampered", "leaf").alias("folded"))
    else:
        nodes = stored(nodes, "merkle_nodes")
        _drop(spark, made)
        with _any_number_of_rows(spark):
            climbed = stored(spark.sql(CLIMB, leaves=leaves, nodes=nodes, d=DIGEST), "merkle_climbed")
        _drop(spark, [all_leaves, nodes])
    text = lambda c: F.lower(F.hex(c))
    return climbed.select(F.col("id").alias("doc_id"), text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
                          F.col("proof").alias("proof_sha256"), text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
