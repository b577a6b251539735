"""Benchmark decontamination with SQL functions only.

Benchmark items are normalised to words and cut into windows of ``width`` words
(an item of fewer words, but not none, is one window). The distinct windows form
a hash set that is broadcast once its measured size is under a bound, and joined
by shuffle beyond it. Documents are scanned in blocks of half a window: every
window holds one of them whole. Around each block that the benchmark also has,
all windows are looked up; the join compares the whole window text, so each hit
is verified and none is missed. Hits become word spans
that are reported, cut out, or used to drop documents.

Defined cases: null text or an item without words has no words and no windows;
benchmark rows with a null id still hit but are not listed; repeated document
rows are each returned; an empty benchmark leaves every document clean; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Word characters once A-Z are lower case: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for text as it stands, each word with what precedes it.
UNIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _windows(column: Column, width: Column | int, first: Column | int = 1) -> Column:
    """(at, window) of every run of ``width`` words; ``at`` counts from ``first``."""
    n = F.size(column)
    starts = F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct((i + first - 1).alias("at"), F.array_join(F.slice(column, i, width), " ").alias("window")))


def _blocks(column: str, width: int) -> Column:
    """(at, words, block, around) of every ``half``-th run of ``half`` words, with the words of all windows that hold it.

    ``half`` is half of ``width``, rounded up: every window of ``width`` words
    holds one of these blocks whole, so only windows around a block that also
    occurs in the benchmark need a look.
    """
    w, half = F.col(column), (width + 1) // 2
    n = F.size(w)
    starts = F.when(n >= width, F.sequence(F.lit(1), n - (half - 1), F.lit(half))).otherwise(F.array().cast("array<int>"))

    def block(p: Column) -> Column:
        first = F.greatest(p - (width - half), F.lit(1))
        return F.struct(first.alias("at"), F.lit(width).alias("words"), F.array_join(F.slice(w, p, half), " ").alias("block"),
                        F.slice(w, first, p + width - first).alias("around"))
    return F.transform(starts, block)


def benchmark_windows(items: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: window, words (its length), items (ids as strings)."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    long_ = w.where(F.size("w") >= width).select("item", F.lit(width).alias("words"), F.explode(_windows(F.col("w"), width)).alias("x"))
    short = w.where(F.size("w") < width).select("item", F.size("w").alias("words"), F.array_join("w", " ").alias("window"))
    return (long_.select("item", "words", F.col("x.window").alias("window")).unionByName(short)
            .groupBy("window", "words").agg(F.collect_set("item").alias("items")))


def find_hits(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document row: id, text_hash, n_words, spans (at, words), items (sorted strings).

    Exact repeats of a row meet in one group and are expanded again at the end.
    """
    windows = benchmark_windows(items, width, item_col, item_text)
    # two bounded facts for the plan: which short lengths occur (under `width`), and the size of the set
    facts = windows.agg(F.collect_set(F.when(F.col("words") < width, F.col("words"))).alias("short"),
                      F.sum(F.octet_length("window") + 40 * F.size("items") + 64).alias("bytes")).first()
    small = (facts["bytes"] or 0) <= broadcast_bytes
    scan = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
                       words(F.col(text_col)).alias("w"))
    lengths = sorted({width, *facts["short"]})
    blocks = (windows.select("words", F.split("window", " ").alias("w"))
              .select("words", F.explode(_windows(F.col("w"), F.floor((F.col("words") + 1) / 2).cast("int"))).alias("x"))
              .select("words", F.col("x.window").alias("block")).distinct().withColumn("known", F.lit(True)))
    if small:
        windows, blocks = F.broadcast(windows), F.broadcast(blocks)
    # every document also sends one row that matches nothing and carries its word count; its key, which no words
    # make, spreads these rows where the joins are shuffled
    apart = F.concat(F.lit("\0"), F.pmod(F.xxhash64("id", "text_hash"), F.lit(1 << 20)).cast("string"))
    nothing = F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("words"), apart.alias("block"), F.array().cast("array<string>").alias("around")))
    rows = scan.select("id", "text_hash", F.size("w").alias("n"), F.explode(F.concat(nothing, *(_blocks("w", m) for m in lengths))).alias("x"))
    near = (rows.select("id", "text_hash", "n", "x.*").join(blocks, ["words", "block"], "left")
            .where(F.col("known") | (F.col("at") == 0)))
    looked = near.select("id", "text_hash", "n", F.explode(
        F.when(F.col("at") == 0, F.array(F.struct(F.lit(0).alias("at"), F.col("block").alias("window"))))
        .otherwise(_windows(F.col("around"), F.col("words"), F.col("at")))).alias("x"))
    found = (looked.select("id", "text_hash", "n", "x.at", "x.window").join(windows, "window", "left")
             .where(F.col("words").isNotNull() | (F.col("at") == 0)))
    grouped = found.groupBy("id", "text_hash").agg(
        F.max("n").alias("n_words"), F.count(F.when(F.col("at") == 0, 1)).alias("copies"),
        F.collect_set(F.when(F.col("at") > 0, F.struct("at", "words"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return (grouped.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("id", "text_hash", "n_words", "spans", "items"))


def hit_positions() -> Column:
    """Distinct word positions (from 1) inside the spans."""
    return F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["words"] - 1))))


def remove_contaminated(docs: DataFrame, items: DataFrame, mode: str = "documents", width: int = 10,
                        id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                        item_text: str = "text") -> DataFrame:
    """``documents``: rows without a hit. ``spans``: every row, its hit words and what precedes them cut out.

    All columns of ``docs`` stay, also those whose names the operator uses inside.
    """
    hits = find_hits(docs, items, width, id_col, text_col, item_col, item_text).where(F.size("spans") > 0)
    hits = hits.select("id", "text_hash", hit_positions().alias("cut")).dropDuplicates(["id", "text_hash"])
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                      F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    same = own["id"].eqNullSafe(hits["id"]) & (own["text_hash"] == hits["text_hash"])
    if mode == "documents":
        return own.join(hits, same, "left_anti").select("row.*")
    text = F.col(f"row.`{text_col}`")
    units = F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))
    rest = F.substring(text, F.length(F.array_join(units, "")) + 1, F.length(text))
    kept = F.array_join(F.filter(units, lambda u, i: ~F.array_contains("cut", i + 1)), "")
    clean = F.when(F.col("cut").isNull(), text).otherwise(F.concat(kept, rest)).alias(text_col)
    return (own.join(hits, same, "left")
            .select(*[clean if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
