"""Embedding near-duplicates by an inverted file with product quantisation.

Fitted on a bounded sample (``sample`` vectors, those with the smallest hash of
their id): coarse centroids (one per ``per_list`` vectors, ``most_lists`` at
most) and, on the residuals, a codebook for each subspace. Every vector is
indexed: its nearest list, its residual's subspace codes and the length of what
the codes leave out. Every vector probes each list that can hold a partner
(and its ``probes`` nearest lists in any case): a partner is within the limit of
the vector, within its list's radius of that list's centroid, and on that
centroid's side of the plane between it and the vector's own centroid; a list
that meets neither bound together with the limit has none. Inside a list,
asymmetric distances come from per-query lookup tables. A vector can only be
within the limit if its table distance is within the limit plus its own code
error, so neither the lists nor the tables lose a link; survivors are verified
by the exact cosine in double precision. Where vectors lie so wide apart that
the bounds exclude few lists, this compares nearly all pairs.

Exact copies are one class from the start. Neighbouring lists are joined into
cells, a large list is cut into several, and pairs of cells are the groups that
tasks work on, so all tasks are bounded; a group returns counts of links and one
edge a member, never its pairs. A vector asks its own and later cells only, so
each pair is found once and counts for both sides.

Defined cases: vectors that are null, zero, or hold null or non-finite
components link with nothing and are their own component; vectors of different
lengths never link; repeated rows count as links of each other; a null id has
links and a component (the smallest id that is not null, null if none) and is
not kept; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import connected, release, roots, stored

#: Rows of a cell: at most about BLOCK, fewer where the table would have under CELLS cells, but not under LEAST for that.
BLOCK, CELLS, LEAST = 4000, 16, 256
#: Slack of the bounds for 32-bit rounding, of distances and of squared distances.
SLACK, SLACK_2 = 1e-3, 1e-4


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Centroids of the rows of ``x``; an empty one restarts at a random row."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, c, 1)[:, 0]
        size = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], x[rng.integers(len(x), size=k)]).astype(x.dtype)
    return c


def nearest(x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the ``n`` nearest centroids of each row, nearest first."""
    n, out = min(n, len(c)), []
    half = 0.5 * (c * c).sum(axis=1)
    for i in range(0, len(x), 1024):
        d = half - x[i:i + 1024] @ c.T
        part = np.argpartition(d, n - 1, axis=1)[:, :n] if n < len(c) else np.tile(np.arange(len(c)), (len(d), 1))
        out.append(np.take_along_axis(part, np.argsort(np.take_along_axis(d, part, axis=1), axis=1), axis=1))
    return np.concatenate(out) if out else np.empty((0, n), np.int64)


class Quantiser:
    """Coarse centroids and residual codebooks of unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int, codes: int = 256) -> None:
        sample = sample.astype(np.float32)
        self.centroids = k_means(sample, lists)
        residual = sample - self.centroids[nearest(sample, self.centroids, 1)[:, 0]]
        edges = [sample.shape[1] * i // parts for i in range(parts + 1)]
        self.cuts = [slice(a, b) for a, b in zip(edges, edges[1:]) if a < b]
        self.books = [k_means(np.ascontiguousarray(residual[:, s]), codes) for s in self.cuts]

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subspace codes of each row's residual to its list, and the length of the remaining error."""
        residual = x.astype(np.float32) - self.centroids[lists]
        codes = np.stack([nearest(np.ascontiguousarray(residual[:, s]), b, 1)[:, 0] for s, b in zip(self.cuts, self.books)], axis=1)
        left = sum(((residual[:, s] - b[codes[:, i]]) ** 2).sum(axis=1) for i, (s, b) in enumerate(zip(self.cuts, self.books)))
        return codes.astype(np.uint8), np.sqrt(left)

    def products(self, x: np.ndarray, numbers: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Per coded member (its list and codes) and row of ``x``: their inner product, by table lookup."""
        x = x.astype(np.float32).T
        near, at = np.unique(numbers, return_inverse=True)
        out = (self.centroids[near] @ x)[at]
        for i, (s, b) in enumerate(zip(self.cuts, self.books)):
            out += (b @ x[s])[codes[:, i]]
        return out

    def lengths(self, numbers: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared length of each coded member."""
        y = self.centroids[numbers].copy()
        for i, (s, b) in enumerate(zip(self.cuts, self.books)):
            y[:, s] += b[codes[:, i]]
        return (y * y).sum(axis=1)

    def reachable(self, x: np.ndarray, home: np.ndarray, radius: np.ndarray, reach: float, least: int) -> np.ndarray:
        """Per row and list: can the list hold a vector within ``reach`` of the row? The ``least`` nearest count, too."""
        c = self.centroids
        length, x = (c * c).sum(axis=1), x.astype(np.float32)
        d = (x * x).sum(axis=1)[:, None] + length - 2 * (x @ c.T)
        gap = np.sqrt(np.maximum(length[home][:, None] + length - 2 * (c[home] @ c.T), 0) + SLACK_2 ** 2)
        own = d[np.arange(len(x)), home][:, None]
        ok = (d <= (reach + radius + SLACK) ** 2 + SLACK_2) & (d - own <= 2 * gap * (reach + SLACK) + SLACK_2)
        np.put_along_axis(ok, nearest(x, c, least), True, axis=1)
        ok[np.arange(len(x)), home] = True
        return ok & (radius >= 0)


def path(c: np.ndarray) -> np.ndarray:
    """The rows of ``c`` in an order that keeps near ones together: halved, again and again, along the widest direction."""
    def halves(i: np.ndarray) -> list[np.ndarray]:
        if len(i) < 3:
            return [i]
        x = c[i] - c[i].mean(axis=0)
        far = x[(x * x).sum(axis=1).argmax()]
        i = i[np.argsort(x @ far, kind="stable")]
        return halves(i[:len(i) // 2]) + halves(i[len(i) // 2:])
    return np.concatenate(halves(np.arange(len(c))))


def cells(order: np.ndarray, size: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First cell and number of cells of each list: runs of lists of about ``most`` rows, and parts of larger lists."""
    first, parts = np.zeros(len(size), np.int64), np.ones(len(size), np.int64)
    cell, held = 0, 0
    for k in order:
        if held and held + size[k] > most:
            cell, held = cell + 1, 0
        first[k], parts[k] = cell, max(1, -(-size[k] // most))
        held += size[k]
        if parts[k] > 1:
            cell, held = cell + parts[k], 0
    return first, parts


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)           # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _links(classes: DataFrame, width: int, limit: float, sample: int, per_list: int, most_lists: int,
           probes: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """Of classes (node, copies, v) with vectors of one length: (node, n) link counts and (a, b) connecting links."""
    spark = classes.sparkSession
    n = classes.count()
    picked = classes.orderBy(F.xxhash64("node"), "node").limit(sample).select("v").toArrow()
    model = Quantiser(_unit(_matrix(picked["v"], width)), max(1, min(most_lists, n // per_list)), min(parts, width))
    shared = spark.sparkContext.broadcast(model)              # bounded by most_lists and the sample
    reach = float(np.sqrt(2 - 2 * limit))

    kind = classes.schema["v"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            x = _unit(_matrix(batch.column(2), width))
            near = nearest(x.astype(np.float32), q.centroids, 1)[:, 0]
            codes, error = q.encode(x, near)
            away = np.sqrt(((x - q.centroids[near]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(error.astype(np.float32)), pa.array(away), batch.column(0)],
                names=["node", "copies", "v", "list", "codes", "error", "away", "part"])

    own = f"node long, copies long, v {kind}, list int, codes binary, error float"
    indexed = stored(classes.select("node", "copies", "v").mapInArrow(index, f"{own}, away double, part long")
                     .withColumn("part", F.xxhash64("part")), "vector_index")
    size, radius = np.zeros(len(model.centroids), np.int64), np.full(len(model.centroids), -1.0)
    for k, held, far in indexed.groupBy("list").agg(F.count("*"), F.max("away")).collect():      # at most most_lists rows
        size[k], radius[k] = held, far
    first, parts_of = cells(path(model.centroids), size, max(1, min(BLOCK, max(LEAST, n // CELLS))))
    layout = spark.sparkContext.broadcast((first, parts_of, radius))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, (first, count, radius) = shared.value, layout.value
        last = int((first + count).max())
        for whole in batches:
            for i in range(0, len(whole), 1024):
                batch = whole.slice(i, 1024)
                home = batch.column(3).to_numpy()
                cell = first[home] + batch.column(7).to_numpy() % count[home]
                ok = q.reachable(_unit(_matrix(batch.column(2), width)), home, radius, reach, probes)
                asks = np.zeros((len(batch), last + 1), np.int32)    # +1 where a list's cells begin, -1 after them
                row, k = np.nonzero(ok)
                np.add.at(asks, (row, first[k]), 1)
                np.add.at(asks, (row, first[k] + count[k]), -1)
                asks = (asks.cumsum(axis=1) > 0) & (np.arange(last + 1) >= cell[:, None])
                to = pa.ListArray.from_arrays(np.append(0, asks.sum(axis=1).cumsum()).astype(np.int32),
                                              pa.array(np.nonzero(asks)[1].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(cell.astype(np.int32)), to],
                                                 names=["node", "copies", "v", "list", "codes", "error", "cell", "asks"])

    dealt = stored(indexed.mapInArrow(deal, f"{own}, cell int, asks array<int>"), "vector_cells")
    release(spark, indexed)
    ask = (dealt.select(F.col("cell").alias("q"), F.explode("asks").alias("m"), F.lit(0).alias("side"), "node", "copies", "v",
                        F.lit(None).cast("int").alias("list"), F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("float").alias("error")))
    # members go to the cells that ask for theirs
    asked = dealt.select(F.col("cell").alias("q"), F.explode("asks").alias("m")).distinct()
    have = (dealt.drop("asks").join(asked, F.col("cell") == F.col("m"))
            .select("q", "m", F.lit(1).alias("side"), "node", "copies", "v", "list", "codes", "error"))

    def compare(group: pa.Table) -> pa.Table:
        side = group["side"].to_numpy()
        ask, have = group.filter(pa.array(side == 0)), group.filter(pa.array(side == 1))
        if not len(ask) or not len(have):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        q, same = shared.value, group["q"][0].as_py() == group["m"][0].as_py()
        x, y = _unit(_matrix(ask["v"], width)), _unit(_matrix(have["v"], width))
        xc, yc = ask["copies"].to_numpy(), have["copies"].to_numpy()
        nodes, at = np.unique(np.concatenate([ask["node"].to_numpy(), have["node"].to_numpy()]), return_inverse=True)
        xi, yi = at[:len(x)], at[len(x):]
        codes, numbers = np.frombuffer(b"".join(have["codes"].to_pylist()), np.uint8).reshape(len(have), -1), have["list"].to_numpy()
        # the squared table distance is 1 + length - 2 product
        least = (1 + q.lengths(numbers, codes) - (reach + have["error"].to_numpy() + SLACK) ** 2) / 2
        n, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        for i in range(0, len(x), 256):
            b, a = np.nonzero(q.products(x[i:i + 256], numbers, codes) >= least[:, None])
            a += i
            if same:                                       # both sides are the same rows: each pair once
                a, b = a[xi[a] < yi[b]], b[xi[a] < yi[b]]
            ok = [np.einsum("ij,ij->i", x[a[j:j + (1 << 15)]], y[b[j:j + (1 << 15)]]) >= limit for j in range(0, len(a), 1 << 15)]
            if not ok:
                continue
            ok = np.concatenate(ok)
            a, b = a[ok], b[ok]
            n += np.bincount(xi[a], yc[b], len(nodes)).astype(np.int64) + np.bincount(yi[b], xc[a], len(nodes)).astype(np.int64)
            label = roots(np.concatenate([xi[a], np.arange(len(nodes))]), np.concatenate([yi[b], label]), len(nodes))
        other, counted = np.flatnonzero(label != np.arange(len(nodes))), np.flatnonzero(n)
        return pa.table({"a": np.concatenate([nodes[other], nodes[counted]]),
                         "b": pa.concat_arrays([pa.array(nodes[label[other]]), pa.nulls(len(counted), pa.int64())]),
                         "n": pa.concat_arrays([pa.nulls(len(other), pa.int64()), pa.array(n[counted])])})

    found = stored(ask.unionByName(have).groupBy("q", "m").applyInArrow(compare, "a long, b long, n long"), "vector_links")
    return (found.where("n is not null").select(F.col("a").alias("node"), "n"), found.where("n is null").select("a", "b"))


def near_duplicates(vectors: DataFrame, limit: float = 0.9, sample: int = 16_384, per_list: int = 64, most_lists: int = 4096,
                    probes: int = 16, parts: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    kind = vectors.schema[vector_col].dataType.simpleString()
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast(kind if kind in ("array<float>", "array<double>") else "array<double>").alias("v"))
    good = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0),
                      F.lit(False))
    # a class is all rows with the same components; 128 bits of hash are its key
    keyed = rows.select("vec_id", F.when(good, v).alias("v")).withColumn("k", F.when(
        F.col("v").isNotNull(), F.concat_ws("-", F.hex(F.xxhash64("v")), F.hex(F.xxhash64(F.lit("second"), "v")))))
    classes = stored(keyed.where("k is not null").groupBy("k").agg(
        F.first("v").alias("v"), F.count("*").alias("copies"), F.min("vec_id").alias("rep"))
        # a class without any id gets a negative stand-in
        .withColumn("node", F.coalesce("rep", -1 - F.pmod(F.xxhash64("k"), F.lit(1 << 62)))), "vector_classes")
    counts = edges = None
    for (width,) in classes.select(F.size("v")).distinct().orderBy(F.size("v")).collect():     # the lengths that occur
        c, e = _links(classes.where(F.size("v") == width), width, limit, sample, per_list, most_lists, probes, parts)
        counts, edges = (c, e) if counts is None else (counts.unionAll(c), edges.unionAll(e))
    if counts is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    roots = connected(edges, "vector_components")
    totals = counts.groupBy("node").agg(F.sum("n").alias("n"))
    known = (classes.select("k", "node", "rep", "copies").join(totals, "node", "left").join(roots, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    named = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    known = stored(known.join(named, "root").select("k", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"),
                   "vector_result")
    alone = keyed.where("k is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (keyed.where("k is not null").join(known, "k").select("vec_id", "n_links", "component_id").unionAll(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
