"""Links and components against all pairs."""

import numpy as np
import pytest

from strataflow.llm import embeddings

NAN = float("nan")


def brute(rows, limit):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a in ok:
        for b in ok:
            if a != b and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= limit:
                    links[a].add(b)
    out = []
    for i, (name, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        names = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((str(name), len(links[i]), str(min(names) if names else None)))
    return sorted(out)


def run(spark, rows, kind="float", **kw):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in rows],
                               f"vec_id long, embedding array<{kind}>, node string, copies int")
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in embeddings.near_duplicates(df, **kw).collect())


@pytest.mark.parametrize("kind", ["float", "double"])
def test_edge_cases(spark, kind):
    rows = [(1, [1, 0, 0]), (2, [1, 0, 0]), (2, [1, 0, 0]), (3, [2, 0, 0]), (4, [1, 0.1, 0]), (5, [0, 0, 0]), (6, None), (7, [1, None, 0]),
            (8, [NAN, 1, 0]), (9, [float("inf"), 1, 0]), (10, [1, 0]), (11, [0.9, 0.1]), (12, []), (None, [0, 0, 1]), (None, [0, 0, 1]),
            (None, [1, 0, 0.01]), (0, [0, 1, 0])]
    assert run(spark, rows, kind) == brute(rows, 0.9)
    assert run(spark, [(1, None), (2, [0.0])], kind) == [("1", 0, "1"), ("2", 0, "2")]
    assert run(spark, [], kind) == []


def test_clusters_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 50)         # lists are cut into blocks
    rnd = np.random.default_rng(5)
    rows, centre = [], rnd.normal(size=(12, 16))
    for i in range(700):
        v = centre[rnd.integers(12)] * rnd.choice([1, 3]) + rnd.normal(size=16) * rnd.choice([0, 0.1, 0.3]) if i % 3 else rnd.normal(size=16)
        rows.append((i, np.float32(v).tolist()))
    assert run(spark, rows, per_list=30, probes=8, sample=300, parts=4) == brute(rows, 0.9)


@pytest.mark.parametrize("near", [0.02, 0.08])
def test_large_group_of_near_copies_keeps_all_links(spark, monkeypatch, near):
    monkeypatch.setattr(embeddings, "BLOCK", 60)
    rnd = np.random.default_rng(3)
    centre = rnd.normal(size=16)
    rows = [(i, np.float32(centre / np.sqrt(centre @ centre) + rnd.normal(size=16) * near if i % 3 == 0 else rnd.normal(size=16)).tolist())
            for i in range(480)]
    assert run(spark, rows, per_list=5, probes=4, sample=400, parts=4) == brute(rows, 0.9)
