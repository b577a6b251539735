"""Window hits against brute force, in both join forms; spans cut from texts."""

import re

import pytest

from strataflow.llm import decontaminate
from tests.llm.conftest import EDGE


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, width):
    wins = {}
    for i, t in items:
        w = words(t)
        m = min(len(w), width)
        for k in range(len(w) - m + 1 if w else 0):
            wins.setdefault(tuple(w[k:k + m]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for win, ids in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found |= ids
        out.append((i, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return sorted(out, key=str)


DOCS = [(i, t if t is None or len(t) < 1000 else t[:2000]) for i, t in EDGE] + [
    (20, "Start. The quick brown fox, jumps OVER the lazy dog today! End of it."), (21, "nothing to see"),
    (22, "a b c a b c a b c a b"), (22, "a b c a b c a b c a b"), (23, "tiny item"), (24, "so tiny; ITEM here, tiny item")]
ITEMS = [(1, "the quick brown fox jumps over the lazy dog today"), (2, "Tiny item!"), (3, None), (4, "..."),
         (None, "a b c a b"), (5, "c a b c a"), (5, "c a b c a"), (6, "quick brown fox jumps over the lazy")]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_hits_equal_brute_force(spark, limit):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in DOCS], "doc_id long, text string, id string, words int")
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, window string")
    hits = decontaminate.find_hits(docs, items, width=5, broadcast_bytes=limit)
    got = hits.select("id", "n_words", decontaminate.hit_positions().alias("p"), "items").collect()
    assert sorted([(r.id, r.n_words, len(r.p), tuple(r["items"])) for r in got], key=str) == brute(DOCS, ITEMS, 5)


def test_plan_is_native(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = decontaminate.find_hits(docs, items, width=5)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan


def test_remove_documents_and_spans(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in DOCS], "doc_id long, text string, id string, cut int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.remove_contaminated(docs, items, "documents", width=5)
    assert kept.columns == docs.columns
    want = sorted(str(i) for i, t in DOCS if not brute([(i, t)], ITEMS, 5)[0][2])
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    clean = {r.doc_id: r.text for r in decontaminate.remove_contaminated(docs, items, "spans", width=5).collect()}
    assert (clean[20], clean[21], clean[24], clean[2]) == ("Start! End of it.", "nothing to see", "so here", None)


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.find_hits(docs.limit(0), items).count() == 0
    none = decontaminate.find_hits(docs, items.limit(0)).collect()
    assert len(none) == len(DOCS) and not any(r.spans for r in none)


def test_marker_rows_spread_over_the_shuffle(spark):
    """Each document's row that matches nothing has a key of its own, so shuffled joins have no hot key."""
    docs = spark.createDataFrame([(i, f"plain words of text {i}") for i in range(2000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some benchmark item of a few words")], "item_id long, text string")
    hits = decontaminate.find_hits(docs, items, width=5, broadcast_bytes=0)
    assert hits.count() == 2000 and hits.where("size(spans) > 0").count() == 0
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(xxhash64" in plan
