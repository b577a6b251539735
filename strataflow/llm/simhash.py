"""SimHash near-duplicates with deletion-variant signatures.

A fingerprint takes, for each of 64 bits, the majority over the XXH64 hashes of
all word shingles. Two fingerprints within ``k`` bits agree up to one bit in at
least one of ceil((k + 1) / 2) segments, so each segment is indexed once per
wildcard bit (that bit deleted): equal keys are found by an ordinary hash
shuffle and every candidate is verified on all 64 bits.

Only distinct fingerprints are indexed, so exact copies cost nothing. A key
shared by more than ``CAP`` fingerprints is not processed in one go: its members
are dealt out again by one-wildcard variants of the remaining bits. Each group
passes on a spanning forest of its links, never all its pairs.

Defined cases: null or empty text has fingerprint zero and is linked like any
other; a text of fewer words than a shingle is one shingle; repeated rows are
kept; a null id has a fingerprint but never names a component (a component of
null ids only is named null); an empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import TextBytes, connected, partitions, stored

SEED = 42
CAP = 2048


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of the lower-cased text's word shingles, as a signed 64-bit integer."""
    import xxhash
    words = text.lower().split()
    if not words:
        return 0
    shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width))))) if len(words) >= width else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, SEED) for s in shingles), "<u8", len(shingles))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 15):
        bits = np.unpackbits(h[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def _named_fingerprints(docs: DataFrame, name: Column, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, name, fp) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, width) for t in TextBytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["doc_id", "name", "fp"])

    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), name.cast("string").alias("name"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, name string, fp long"))


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row."""
    return _named_fingerprints(docs, F.lit(None), width, id_col, text_col).drop("name")


def _variants(value: Column, bits: int, start: int) -> list[Column]:
    """Keys of one segment: the wildcard's number above, the segment without that bit below."""
    return [F.lit((start + j) << 32).bitwiseOR(value.bitwiseAND(F.lit(((1 << bits) - 1) ^ (1 << j)))) for j in range(bits)]


def _segments(k: int) -> list[tuple[int, int]]:
    """(shift, bits) of ceil((k + 1) / 2) segments of at most 32 bits."""
    n = max(2, -(-(k + 1) // 2))
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def close_pairs(f: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a spanning forest of the links (at most ``k`` bits apart) among sorted distinct ``f``."""
    u = f.view(np.uint64)
    if len(u) <= CAP:
        near = np.bitwise_count(u[:, None] ^ u[None, :]) <= k
        left, a, b = np.ones(len(u), bool), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in range(len(u)):
            front = [i] if left[i] else []
            left[i] = False
            while front:
                j = front.pop()
                new = np.flatnonzero(near[j] & left)
                left[new] = False
                front += new.tolist()
                a.append(np.full(len(new), j))
                b.append(new)
        return np.concatenate(a), np.concatenate(b)
    # a larger group differs in few bits: try every flip of up to k of them
    order = np.argsort(u)
    s = u[order]
    varying = int(np.bitwise_or.reduce(s ^ s[0]))
    bits = [1 << i for i in range(64) if varying >> i & 1]
    flips = [np.uint64(sum(c)) for r in range(1, k + 1) for c in combinations(bits, r)]
    label = np.arange(len(s))
    while True:
        before = label.copy()
        for flip in flips:
            at = np.minimum(np.searchsorted(s, s ^ flip), len(s) - 1)
            hit = np.flatnonzero(s[at] == s ^ flip)
            np.minimum.at(label, hit, label[at[hit]])
        label = label[label]
        if (label == before).all():
            break
    other = np.flatnonzero(label != np.arange(len(s)))
    return order[other], order[label[other]]


def _linker(k: int, cap: int | None):
    """Over rows sorted by key: links (a, b), and members of keys beyond ``cap`` as (a, null, key)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_f, spilled = np.empty(0, np.int64), np.empty(0, np.int64), None

        def emit(keys: np.ndarray, f: np.ndarray):
            nonlocal spilled
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
            sizes = np.diff(np.append(starts, len(keys)))
            a, b, hot = [], [], []
            two = starts[(sizes == 2) & (keys[starts] != (spilled if spilled is not None else -1))]
            near = two[np.bitwise_count((f[two] ^ f[two + 1]).view(np.uint64)) <= k]
            a.append(f[near])
            b.append(f[near + 1])
            for s, n in zip(starts.tolist(), sizes.tolist()):
                if n > 2 or keys[s] == spilled:
                    if keys[s] == spilled or (cap and n > cap):
                        spilled = keys[s]
                        hot.append((f[s:s + n], keys[s]))
                    else:
                        x, y = close_pairs(f[s:s + n], k)
                        a.append(f[s + x])
                        b.append(f[s + y])
            a, b = np.concatenate(a), np.concatenate(b)
            out = [pa.array(np.concatenate([a, *(m for m, _ in hot)])),
                   pa.concat_arrays([pa.array(b), pa.nulls(sum(len(m) for m, _ in hot), pa.int64())]),
                   pa.concat_arrays([pa.nulls(len(a), pa.int64()),
                                     pa.array(np.concatenate([np.full(len(m), x) for m, x in hot]) if hot else np.empty(0, np.int64))])]
            return pa.RecordBatch.from_arrays(out, names=["a", "b", "key"])

        for batch in batches:
            keys = np.concatenate([rest_k, batch.column(0).to_numpy(zero_copy_only=False)])
            f = np.concatenate([rest_f, batch.column(1).to_numpy(zero_copy_only=False)])
            if not len(keys):
                continue
            last = np.searchsorted(keys, keys[-1])     # the last key may go on in the next batch
            if cap and len(keys) - last > cap:
                last = len(keys)                       # already beyond the cap: all its rows are passed on
            yield emit(keys[:last], f[:last])
            rest_k, rest_f = keys[last:], f[last:]
        yield emit(rest_k, rest_f)
    return run


def links(distinct: DataFrame, k: int = 3, cap: int = CAP) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all that are within ``k`` bits."""
    spark, fp = distinct.sparkSession, F.col("fp")
    schema, parts = "a long, b long, key long", partitions(distinct.sparkSession)
    segments = _segments(k)
    keys = [v for n, (at, bits) in enumerate(segments)
            for v in _variants(F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << bits) - 1)), bits, 32 * n)]
    dealt = distinct.select(F.explode(F.array(*keys)).alias("key"), "fp").repartition(parts, "key").sortWithinPartitions("key", "fp")
    first = stored(dealt.mapInArrow(_linker(k, cap), schema), "simhash_links")
    found = first.where("b is not null").select("a", "b")
    hot = first.where("b is null").select("key", F.col("a").alias("fp"))
    # members of a hot key agree in its segment: within k bits of the rest, one part differs by one bit at most
    again, n_parts = [], max(2, -(-(k + 1) // 2))
    for n, (at, bits) in enumerate(segments):
        outside = [(a, b) for a, b in segments if a != at]
        cuts = [(a + b * i // n_parts, b * (i + 1) // n_parts - b * i // n_parts) for a, b in outside for i in range(n_parts)]
        subs = [v for m, (a, b) in enumerate(cuts)
                for v in _variants(F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << b) - 1)), b, 32 * m)]
        mine = hot.where(F.floor(F.shiftright("key", 32) / 32) == n)
        again.append(mine.select(F.explode(F.transform(F.array(*subs), lambda v: F.xxhash64(F.col("key"), v))).alias("key"), "fp"))
    refined = again[0]
    for x in again[1:]:
        refined = refined.unionAll(x)
    second = (refined.distinct().repartition(parts, "key").sortWithinPartitions("key", "fp")
              .mapInArrow(_linker(k, None), schema).select("a", "b"))
    return found.unionAll(second)


def grouped(fps: DataFrame, k: int) -> DataFrame:
    """(fp, root) of every distinct fingerprint of ``fps``; root is one fingerprint of its group."""
    distinct = fps.select("fp").distinct()
    roots = connected(links(distinct, k), "simhash_components")
    return (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, width: int = 3, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fp (signed), component_id (smallest id reachable over links of at most ``k`` bits)."""
    fps = stored(fingerprints(docs, width, id_col, text_col), "fingerprints")
    rooted = stored(grouped(fps, k), "simhash_roots")
    # the smallest id of each fingerprint first (map-side), then of each group
    named = (fps.groupBy("fp").agg(F.min("doc_id").alias("rep")).join(rooted, "fp")
             .groupBy("root").agg(F.min("rep").alias("component_id")))
    return (fps.join(rooted.join(named, "root").drop("root"), "fp")
            .select("doc_id", "fp", "component_id"))


def keep_one(docs: DataFrame, width: int = 3, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group: that with the smallest id (null last), then the smallest text hash.

    All columns of ``docs`` stay; of exact repeats of that row, one stays.
    """
    text = F.col(f"`{text_col}`").cast("string")
    name = F.concat_ws("-", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")),
                       F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit("second"), text)))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name.alias("name"))
    fps = stored(_named_fingerprints(docs, name, width, id_col, text_col), "fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "name")).alias("best")
    kept = (fps.groupBy("fp").agg(best).join(grouped(fps, k), "fp")
            .groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.name").alias("name")))
    return own.join(kept, "name", "left_semi").groupBy("name").agg(F.first("row").alias("row")).select("row.*")
