"""The manifest against a tree built leaf by leaf in plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from strataflow.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, parent string"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def climb(all_levels, idx, value):
    proof = []
    for level in all_levels[:-1]:
        start, slot = idx // 8 * 8, idx % 8
        run = list(level[start:start + 8])
        proof += run[:slot] + run[slot + 1:]
        run[slot] = value
        idx, value = idx // 8, h(run)
    return proof, value


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        bad = text
        if text is not None and zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 3 == 0:
            bad = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        leaf, tampered = (h(map(field, (doc_id, source, lang, n_chars, t))) for t in (text, bad))
        groups[lang].append((-(1 << 63) if doc_id is None else doc_id, leaf, tampered, doc_id))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda x: x[:2])
        trees.append(levels([x[1] for x in groups[name]]))
    top = levels([t[-1][0] for t in trees])
    out = Counter()
    for k, name in enumerate(names):
        for i, (_, leaf, tampered, doc_id) in enumerate(groups[name]):
            proof, value = climb(trees[k], i, tampered)
            more, value = climb(top, k, value)
            out[doc_id, leaf, trees[k][-1][0], top[-1][0], h(proof + more), value, value == top[-1][0]] += 1
    return out


def result(df):
    return Counter(tuple(r) for r in df.collect())


def rows_of(sizes, first=0):
    rows, i = [], first
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i * 7 % 1009 + i // 1009 * 1009, f"Text {i} ÄÖ Some Words", lang, "s" if i % 5 else None, i if i % 4 else None, "x", "y"))
            i += 1
    return rows


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9}, {"en": 1, "de": 1}, {"en": 600, None: 1, "é": 65, "z": 8, "": 3}])
def test_small_trees(spark, sizes):
    rows = rows_of(sizes)
    assert result(M.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3))) == expected(rows)


def test_blocks_of_leaves_and_many_groups(spark, monkeypatch):
    """Copies of inner nodes for each block, in the group's tree and above it."""
    monkeypatch.setattr(M, "BLOCK", 64)
    rows = rows_of({f"l{k:02d}": 3 + k for k in range(75)} | {"hot": 2000})
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(M.manifest(df)) == expected(rows)
    leaves = M.stored(M.numbered_leaves(M.hashed_leaves(df)), "test_leaves")
    keys = leaves.groupBy("g", (leaves.idx / 64).cast("long").alias("block")).count()
    assert keys.agg({"count": "max"}).first()[0] <= 64
    assert M.tree(leaves).groupBy("g", "block", "level", "idx").count().agg({"count": "max"}).first()[0] == 1


def test_edge_rows(spark, edge_docs):
    df = edge_docs.selectExpr("doc_id", "text", "lang", "source", "length(text) + 0L n_chars", "cast(id as string) g", "row parent")
    rows = [tuple(r) for r in df.collect()]
    assert result(M.manifest(df)) == expected(rows)


def test_empty_table(spark):
    got = M.manifest(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and got.count() == 0


def test_row_limit_of_the_session_is_left_as_it_was(spark):
    old = spark.conf.get("spark.sql.cteRecursionRowLimit")
    assert M.manifest(spark.createDataFrame(rows_of({"en": 20}), SCHEMA)).where("verified").count() > 0
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == old
