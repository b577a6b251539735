"""Quality and language: forward-backward against enumeration, edge cases, held-out accuracy."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import language, quality
from strataflow.llm.common import remainder
from tests.llm.conftest import EDGE

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rnd = np.random.default_rng(3)
    crf = quality.LineCrf(rnd.normal(size=4), rnd.normal(size=(2, 2)))
    x, bounds = rnd.normal(size=(9, 4)), np.array([0, 1, 5, 9])
    got = crf.marginals(x, bounds)
    for a, b in zip(bounds, bounds[1:]):
        p, total = np.zeros(b - a), 0.0
        for y in itertools.product((0, 1), repeat=int(b - a)):
            w = np.exp(sum(y[i] * (x[a + i] @ crf.weights) for i in range(b - a)) + sum(crf.steps[i, j] for i, j in zip(y, y[1:])))
            total += w
            p += w * np.array(y)
        assert got[a:b] == pytest.approx(p / total)


def test_line_features_see_neighbours_only_inside_a_text():
    texts = [b"Plain line here.\nSHOUT!! SHOUT!!\n", b"", b"a | b | c"]
    x, lengths, bounds = quality.line_features(texts)
    assert bounds.tolist() == [0, 3, 4, 5] and lengths.tolist() == [16, 15, 0, 0, 9]
    n = quality.N_OWN
    assert (x[0, 2 * n:3 * n] == x[1, :n]).all() and (x[0, n:2 * n] == 0).all() and (x[3, n:3 * n] == 0).all()
    assert x[1, 0] == 1 and x[4, 6] == 1 and x[1, 5] == 0.5


def test_quality_edge_cases(spark, edge_docs):
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, 0), (6, None), (None, 1), (99, 1)], "doc_id long, quality int")
    crf = quality.train(edge_docs, labels)
    got = quality.score(edge_docs.withColumnRenamed("row", "score_"), crf)
    rows = got.collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    assert got.columns == [*edge_docs.withColumnRenamed("row", "score_").columns, "score"]
    blank = quality.train(edge_docs, labels.limit(0))
    assert {r.score for r in quality.score(edge_docs, blank).collect()} == {0.5}
    assert quality.score(edge_docs.limit(0), crf).count() == 0


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    crf = quality.train(docs, labels)
    rows = (quality.score(docs.select("doc_id", "text"), crf).where(remainder("doc_id", 5) == 0).join(labels, "doc_id")
            .select("score", "quality").collect())
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([s >= 0.3 for s in good]) > 0.97 and np.mean([s < 0.3 for s in bad]) > 0.7
    assert np.mean([a > b for a in good for b in bad]) > 0.97


def test_kernel_classifier_equals_the_formula():
    """predict() is K(x, L) K(L, L)^(-1/2) w, with set intersections taken literally."""
    texts = ["the cat and the dog", "der hund und die katze", "the dog and a cat", "die katze und der hund", "a dog", "ein hund"]
    langs = ["en", "de", "en", "de", "en", "de"]
    sets = [language.gram_set(language.letters(t)) for t in texts]
    m = language.KernelClassifier(sets, langs, 2, 1e-4)

    def kernel(a, b):
        return len(set(a.tolist()) & set(b.tolist())) / np.sqrt(len(a) * len(b))
    probe = ["the cats", "Und die Katze?!", "xyzzy"]
    marks = [sets[i] for i in (1, 3, 0, 2)]
    for t, s in zip(probe, m.predict(probe, m.lookup())[1]):
        g = language.gram_set(language.letters(t))
        value = np.array([kernel(g, x) for x in marks]) @ m.alpha + m.bias
        assert s == pytest.approx((np.clip(value.max(), -1, 1) + 1) / 2, rel=1e-4)
    assert m.predict(probe, m.lookup())[0][:2] == ["en", "de"]


def test_language_edge_cases(spark, edge_docs):
    found = language.predict(edge_docs, language.train(edge_docs, held_out=9))
    rows = found.collect()
    assert len(rows) == len(EDGE) and found.columns == [*edge_docs.columns, "lang_pred", "lang_score"]
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert r.lang_pred == ("en" if letters else "und") and 0 <= r.lang_score <= 1
    none = language.train(edge_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.predict(edge_docs, none).collect()} == {"und"}
    assert language.predict(edge_docs.limit(0), language.train(edge_docs)).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.predict(docs, language.train(docs)).where((remainder("doc_id", 4) == 2) & (F.length("text") > 40))
    rows = found.select("lang", "lang_pred").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def test_letters_are_unicode_letters_only():
    import unicodedata
    for text in ("²³", "½ ⅔", "①②", "Ⅳ ⅻ", "٣ 5 _", "!?", "", None):
        assert language.letters(text) is None, text
    for c in "aÉßİ漢ªʰאあ":
        assert unicodedata.category(c).startswith("L") and language.letters(c) is not None
    assert language.letters("x² is ⅔y") == b" x is y "


def test_samples_are_bounded_in_rows_and_lines(spark, monkeypatch):
    """A sampled id that holds most rows, and very long documents, give one bounded record each."""
    text = "A line of words.\n" * 3000
    rows = [(1, text, "en")] * 500 + [(i, f"short text {i}\nand a line", "en" if i % 2 else "de") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    sizes, real = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: sizes.append(real(self)) or sizes[-1])
    quality.train(docs, labels, held_out=9, max_lines=50)
    language.train(docs, held_out=9)
    sample, grams = sizes
    assert len(sample) == 39 and max(r.n for r in sample) == 50 and all(len(r.x) == 4 * (3 * quality.N_OWN + 1) * r.n for r in sample)
    assert len(grams) == len({r.id for r in grams}) <= 39


def test_scoring_takes_little_memory_however_many_texts_come():
    import tracemalloc

    import pyarrow as pa

    from strataflow.llm.common import TextBytes
    texts = TextBytes(pa.array(["A line of words.\nAnother LINE | of 12 words\n" * 20] * 8000))
    crf = quality.LineCrf(np.ones(3 * quality.N_OWN + 1), np.zeros((2, 2)))
    crf.scores(texts[:600])                       # tables that stay are made
    tracemalloc.start()
    scores = [crf.scores(texts[s]) for s in texts.slices(quality.BATCH_BYTES)]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, scores)) == 8000 and most < 80 << 20
    model = language.KernelClassifier([language.gram_set(b" one two "), language.gram_set(b" eins zwei ")], ["en", "de"], 1, 1e-4)
    table = model.lookup()
    assert table.nbytes <= 2 * language.CODES and (table[model.grams] == np.arange(len(model.grams))).all()
