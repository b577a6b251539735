"""Exact duplicates against a plain grouping of the texts, and the cutting itself."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from strataflow.llm import exact_dedup as X


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    rank = lambda i: -(1 << 63) if i is None else i
    out, left = Counter(), {t: max(ids, key=rank) for t, ids in groups.items()}
    done = set()
    for i, t in rows:
        t = t or ""
        first = i == left[t] and t not in done
        if first:
            done.add(t)
        out[i, left[t], len(groups[t]), first, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def result(df):
    return Counter(tuple(r) for r in df.collect())


def test_edge_rows(spark, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = result(X.exact_duplicates(edge_docs))
    assert got == expected(rows)
    assert edge_docs.limit(0).count() == 0 and X.exact_duplicates(edge_docs.limit(0)).count() == 0


def test_long_copies_and_almost_copies(spark):
    r = random.Random(5)
    long = "".join(r.choice("abcdefgh é漢\n") for _ in range(60_000))
    texts = [long, long[:-1], long[1:], long[:30_000] + "#" + long[30_001:], long, "x" * 20_000, "x" * 20_000, "x" * 20_001, "", "short", "short"]
    rows = [(i, t) for i, t in enumerate(texts * 3)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(X.exact_duplicates(df)) == expected(rows)


def test_a_third_in_one_group(spark):
    rows = [(i, "the same text again " * 40 if i % 3 == 0 else f"text {i} " * 30) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(X.exact_duplicates(df)) == expected(rows)
    # one task sends a chunk of the hot group once, however many of its rows hold it
    named = X.recipes(df)
    shared, some = X._shared_marks(spark, named)
    sent = df.select("text").mapInArrow(X._send_chunks(0, X.digest128, shared), "name binary, data binary")
    assert some and sent.count() <= 7 * len(list(X.cut(np.frombuffer(rows[0][1].encode(), np.uint8), np.array([0]), np.array([800])))[0])


def test_a_name_of_two_contents_is_found(spark):
    rows = [(i, f"text number {i}") for i in range(50)] + [(99, "text number 7")]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def weak_first(chunk, seed):
        d = X.digest128(chunk, seed)
        return d if seed else bytes([d[0] & 3]) + bytes(15)
    assert result(X.exact_duplicates(df, digest=weak_first)) == expected(rows)
    with pytest.raises(X.UnverifiedChunks):
        X.recipes(df, digest=lambda chunk, seed: bytes(16))


def test_a_name_of_two_contents_is_found_within_a_task(spark):
    rows = [(i, f"text {i % 2}") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def one_name_first(chunk, seed):
        return X.digest128(chunk, seed) if seed else bytes(16)
    assert result(X.exact_duplicates(df, digest=one_name_first)) == expected(rows)
    with pytest.raises(X.UnverifiedChunks):
        X.recipes(df, digest=lambda chunk, seed: bytes(16))
    # also where a task can remember next to nothing
    old, X.REMEMBERED = X.REMEMBERED, 1
    try:
        assert result(X.exact_duplicates(df, digest=one_name_first)) == expected(rows)
    finally:
        X.REMEMBERED = old


def test_cuts_depend_on_the_text_alone_and_survive_an_insertion():
    r = np.random.default_rng(3)
    a, b = r.integers(0, 256, 200_000, np.uint8), r.integers(0, 256, 5_000, np.uint8)

    def chunks(*texts):
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        data = np.concatenate(texts)
        return [[data[x:y].tobytes() for x, y in zip([s, *c], c)] for s, c in zip(starts.tolist(), X.cut(data, starts, ends))]
    alone = chunks(a)[0]
    assert chunks(b, a, b)[1] == alone and b"".join(alone) == a.tobytes()
    assert all(X.SHORTEST <= len(c) <= X.LONGEST for c in alone[:-1])
    inserted = chunks(np.insert(a, 100_000, 7))[0]
    assert len(set(alone) - set(inserted)) <= 3
    old, X.WINDOW = X.WINDOW, 1000
    try:
        assert chunks(b, a, b)[1] == alone       # windows of the hash do not show
    finally:
        X.WINDOW = old

