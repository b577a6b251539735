"""Spelling variants against a reading of the rules word by word."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from strataflow.llm import spelling as S


def counted(rows, least=6, count=5, divisor=199):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % divisor == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= count}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(words, ratio=5):
    near = {a: [b for b in words if is_near(a, b)] for a in words}
    form = {}
    for a in words:
        best = min(near[a], key=lambda b: (-words[b], b), default=None)
        form[a] = best if best and words[best] >= ratio * words[a] else None

    def root(a):
        while form[a]:
            a = form[a]
        return a
    return {a: (form[a], root(a), words[a], len(near[a]), words[form[a]] if form[a] else None) for a in words}


def result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows) and df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return out


def close_words(r, n, length=(6, 9), letters="abé×"):
    return sorted({"".join(r.choice(letters) for _ in range(r.randint(*length))) for _ in range(n)})


@pytest.mark.parametrize("first_half", [True, False])
def test_index_finds_each_pair_in_one_half(first_half):
    r = random.Random(1)
    words = close_words(r, 900, letters="ab")
    for length in (6, 7):
        asked = [w.encode("latin-1") for w in words if len(w) == length]
        for other in (length, length + 1):
            index = [w.encode("latin-1") for w in words if len(w) == other]
            q, w = S.BitSlices(S._matrix(index)).near(S._matrix(asked), length // 2, first_half)
            got = list(zip(q.tolist(), w.tolist()))
            want = {(i, j) for i, a in enumerate(asked) for j, b in enumerate(index)
                    if is_near(a.decode(), b.decode()) and (a[:length // 2] == b[:length // 2]) == first_half}
            assert len(got) == len(set(got)) and set(got) == want


def test_counting_matches_the_rules(spark):
    r = random.Random(2)
    words = close_words(r, 300) + ["x" * 50, "Straße", "ÀÉÎõüÿ", "naïveté", "short"]
    rows = [(i, " ".join(r.choice(["", "-", "1"]) + r.choice(words).title() for _ in range(200)) + " 漢字漢字漢字") for i in range(60)]
    rows += [(None, "nullid nullid nullid nullid nullid nullid"), (5, None), (6, ""), (6, "repeated " * 9), (6, "repeated " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r.n for r in S.vocabulary(df, divisor=7).collect()}
    assert got == counted(rows, divisor=7) and len(got) > 100


def test_pieces_of_a_long_text(monkeypatch):
    text = ("some words longer than seven " * 50 + "y" * 700 + " é " + "Mixed Ünicode " * 40).encode()
    whole = Counter()
    for w, n in S.words_of("1", text, 6, 3):
        whole[w] += n
    monkeypatch.setattr(S, "PIECE", 64)
    cut = Counter()
    for w, n in S.words_of("1", text, 6, 3):
        cut[w] += n
    assert cut == whole and any(len(w) >= 699 for w in whole)


@pytest.mark.parametrize("bucket_rows,hot,block", [(1 << 17, 1 << 16, 1 << 14), (64, 5, 7)])
def test_whole_operator(spark, monkeypatch, bucket_rows, hot, block):
    """Also with many buckets, halves that are cut, and blocks of a few words."""
    r = random.Random(3)
    words = close_words(r, 500) + ["abab" + w for w in close_words(r, 150, (4, 5), "abcdef")]      # a third begins alike
    rows = [(i, " ".join(r.choices(words, [5 ** r.randint(0, 4) for _ in words], k=600))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    real = S.near_words
    monkeypatch.setattr(S, "near_words", lambda w: real(w, bucket_rows, hot, block))
    got = result(S.variants(df))
    want = expected(counted(rows))
    assert got == want
    assert sum(v[0] is not None for v in want.values()) > 5


def test_chain_of_forms_and_ties(spark):
    counts = {"aaaaaa": 3125, "aaaaab": 625, "aaaabb": 125, "aaabbb": 25, "aabbbb": 5, "aaaaac": 5, "zzzzzz": 30, "zzzzzy": 6, "zzzzzx": 30}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    got = result(S.variants(spark.createDataFrame(rows, "doc_id long, text string"), divisor=1 << 40))
    assert got == expected(counts) and got["aabbbb"][1] == "aaaaaa" and got["zzzzzy"][0] == "zzzzzx"


def test_edge_rows_and_long_words(spark, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert result(S.variants(edge_docs, least_count=1)) == expected(counted(rows, count=1))
    assert S.variants(edge_docs.limit(0)).count() == 0
    long = ["q" * 3000, "q" * 2999 + "r", "q" * 3001, "q" * 2999]
    rows = [(i, " ".join([w] * (5 + 30 * (i == 0)))) for i, w in enumerate(long)]
    assert result(S.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(counted(rows))
