"""Fingerprints and components against brute force; hot keys; the filter."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from strataflow.llm import simhash
from tests.llm.conftest import EDGE


def brute_fp(text, width):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    s = [" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(fps, k):
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in ids:
        for b in ids:
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= k:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_edge_cases(spark, edge_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == len(EDGE)
    want = {(i, signed(brute_fp(t, 3))) for i, t in EDGE}
    assert {(r.doc_id, r.fp) for r in rows} == want
    by = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by[1] == by[7] == 1 and by[2] == by[3] == by[4] == 2          # no words: fingerprint zero, linked
    assert simhash.near_duplicates(edge_docs.limit(0)).count() == 0


def test_components_equal_brute_force(spark):
    rnd = random.Random(2)
    base = [" ".join(rnd.choice("abcdefghij") + str(rnd.randrange(50)) for _ in range(120)) for _ in range(12)]
    texts = []
    for i in range(150):
        w = rnd.choice(base).split()
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(len(w))] = f"new{rnd.randrange(99)}"
        texts.append((i, " ".join(w)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert got == components({i: brute_fp(t, 3) for i, t in texts}, 3)


def test_hot_keys_are_refined_exactly(spark):
    """Many distinct fingerprints around a few centres, with a cap of 8: first keys overflow, nothing is lost."""
    rnd = random.Random(4)
    fps = set()
    for _ in range(3):
        centre = rnd.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(5))))
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = simhash.links(df, 3, cap=8).collect()
    parent = {signed(f): signed(f) for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for e in edges:
        assert bin((e.a ^ e.b) & (1 << 64) - 1).count("1") <= 3
        parent[find(e.a)] = find(e.b)
    want = components({i: f for i, f in enumerate(fps)}, 3)
    got = {}
    assert all(got.setdefault(want[i], find(signed(f))) == find(signed(f)) for i, f in enumerate(fps))
    assert len(set(got.values())) == len(got)


def test_large_group_by_flips_equals_all_pairs(monkeypatch):
    rnd = np.random.default_rng(1)
    f = np.unique(rnd.integers(0, 1 << 14, 3000)).astype(np.int64)
    a, b = simhash.close_pairs(f, 2)
    monkeypatch.setattr(simhash, "CAP", 10_000)
    c, d = simhash.close_pairs(f, 2)

    def groups(x, y):
        label = np.arange(len(f))
        while True:
            m = np.minimum(label[x], label[y])
            new = label.copy()
            np.minimum.at(new, x, m)
            np.minimum.at(new, y, m)
            if (new == label).all():
                return label
            label = new
    assert (groups(a, b) == groups(c, d)).all()


def test_keep_one(spark, edge_docs):
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 7 not in ids and 2 in ids and 3 not in ids
    assert sorted(x for x in ids if x is not None) == sorted({1, 2, 5, 6, 8, 9, 10})
    assert kept.filter(F.col("doc_id").isNull()).count() == 1               # the text with no id; the empty one joins 2
