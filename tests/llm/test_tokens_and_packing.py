"""Token ids against the library itself; packing against its definition."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import packing, token_files
from strataflow.llm.tokens import WordEncoder
from tests.llm.conftest import EDGE


def plain(vocabulary):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_word_encoder_equals_the_library(vocabulary):
    rnd, enc, ids = random.Random(3), WordEncoder(vocabulary), plain(vocabulary)
    letters = "aAbÉéßİıΣςǅK'’…·.,!?*#$%&|;:<>-_ 0123٣½ \t\n\x0b\x1c\x85\xa0́̈한ᄒ中文😀"
    for _ in range(300):
        texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(40))) for _ in range(4)]
        texts.append(texts[0] + " <|endoftext|>'S'T'RE")
        for t, got in zip(texts, enc.encode([t.encode() for t in texts])):
            assert np.frombuffer(got, enc.width).tolist() == ids(t), t


def test_a_worker_forgets_words_but_not_the_latest(vocabulary, monkeypatch):
    """What a worker holds does not grow with its texts; words that come again soon are not learned again."""
    def word(i):
        return "".join("abcdefghijklmnopqrstuvwxyz"[i // 26 ** k % 26] for k in range(5)).encode()

    enc, step = WordEncoder(vocabulary), 100_000
    for i in range(0, 11 * step, step):
        enc.encode([b" ".join(map(word, range(i, i + step)))])
        assert sum(len(d) for d in vars(enc).values() if isinstance(d, dict)) <= 1_000_000
    monkeypatch.setattr("strataflow.llm.tokens.WORDS_KEPT", 40)
    enc, ids, learned = WordEncoder(vocabulary), plain(vocabulary), []
    learn = enc._learn
    monkeypatch.setattr(enc, "_learn", lambda words: (learned.extend(words), learn(words)))
    for i in range(30):
        text = " ".join(word(k).decode() for k in range(10 * i, 10 * i + 10)) + " often often, Often. never-alone!"
        assert np.frombuffer(enc.encode([text.encode()])[0], enc.width).tolist() == ids(text)
    assert learned.count(b"often") == learned.count(b"never-alone") == 1
    assert len(enc.known) + len(enc.older) <= 120


def test_other_vocabularies_get_whole_texts():
    from strataflow.llm.queries import vocabulary_file
    path = vocabulary_file("byte_bpe_50k.json")
    enc, ids = WordEncoder(path), plain(path)
    texts = ["Two  words, and\na line", "", "x" * 300]
    assert [np.frombuffer(b, enc.width).tolist() for b in enc.encode([t.encode() for t in texts])] == [ids(t) for t in texts]


def test_token_files_round_trip(spark, tmp_path, edge_docs, vocabulary):
    folder = f"file://{tmp_path}/tokens"
    shards = token_files.write_token_files(edge_docs, folder, vocabulary, end_id=1, shards=3)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32)
                  for r in token_files.read_token_files(spark, folder).collect()), key=lambda r: r[2])
    ids, start, want = plain(vocabulary), 0, []
    for i, t in sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        own = ids(t) + [1]
        want.append((i is not None, i or 0, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert got == want
    assert shards.agg(F.sum("n_tokens")).first()[0] == start
    # a second run of the same job leaves the same files
    token_files.write_token_files(edge_docs, folder, vocabulary, end_id=1, shards=3)
    assert token_files.read_token_files(spark, folder).count() == len(EDGE)


def test_a_third_of_all_rows_under_one_id(spark, tmp_path, vocabulary):
    """Even shards: an id is cut by its texts, and a text that repeats under it by row."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, "the same words" if i % 2 else f"some text {i}") for i in range(1800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    shards = token_files.write_token_files(df, f"file://{tmp_path}/hot", vocabulary, end_id=1, shards=9).collect()
    assert sum(r.n_docs for r in shards) == 1800 and max(r.n_docs for r in shards) < 2 * 1800 / 9
    got = token_files.read_token_files(spark, f"file://{tmp_path}/hot").orderBy("start").collect()
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids) and len(ids) == 1800
    assert not list((tmp_path / "hot").glob("*.tmp"))


def test_token_files_of_an_empty_table(spark, tmp_path, edge_docs, vocabulary):
    folder = f"file://{tmp_path}/none"
    assert token_files.write_token_files(edge_docs.limit(0), folder, vocabulary, end_id=1).count() == 0
    assert token_files.read_token_files(spark, folder).count() == 0


def check_packed(rows, capacity, max_docs=None, max_cost=None):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity and len(items) <= (max_docs or capacity)
        assert sum(n * n for _, n in items) <= (max_cost or capacity ** 2)
    return len(by)


def test_pieces_and_packing(spark, edge_docs, vocabulary):
    pieces = packing.cut_pieces(edge_docs, vocabulary, end_id=0, capacity=64, keep_ids=True)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32, tuple(np.array(r.ids, "i4").tolist()))
                  for r in pieces.collect()))
    ids, want = plain(vocabulary), []
    for i, t in EDGE:
        own = ids(t) + [0]
        for k, a in enumerate(range(0, len(own), 64)):
            p = own[a:a + 64]
            want.append((i is None, i or 0, k, a, len(p), zlib.crc32(np.array(p, "<u4").tobytes()), tuple(p)))
    assert got == sorted(want)
    rows = packing.pack(pieces.drop("ids"), capacity=64).collect()
    assert len(rows) == len(want)
    total = sum(r.length for r in rows)
    assert check_packed(rows, 64) <= -(-total // 64) + 1
    assert packing.pack(packing.cut_pieces(edge_docs.limit(0), vocabulary, 0, 64), 64).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_limit_holds_and_a_hot_length_is_many_tasks(spark, rule):
    rnd = random.Random(5)
    lengths = [rnd.choice([7, rnd.randrange(1, 75), rnd.randrange(1, 75)]) for _ in range(6000)]      # a third are 7
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    rows = packing.pack(df, 100, max_docs=6, max_cost=5500 if rule == "norm" else 10_000, rule=rule).collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    n = check_packed(rows, 100, 6, 5500 if rule == "norm" else 10_000)
    assert n < 1.25 * max(sum(lengths) / 100, len(lengths) / 6)


def test_grouped_best_fit_equals_one_by_one():
    """The histogram form makes as many sequences as best-fit decreasing, piece by piece."""
    rnd = random.Random(11)
    for _ in range(30):
        lengths = [rnd.randrange(1, 51) for _ in range(rnd.randrange(1, 200))]
        bins = []
        for n in sorted(lengths, reverse=True):
            fits = [i for i, left in enumerate(bins) if left >= n]
            if fits:
                best = min(fits, key=lambda i: bins[i])
                bins[best] -= n
            else:
                bins.append(50 - n)
        hist = [(n, lengths.count(n)) for n in set(lengths)]
        runs = packing.best_fit_runs(hist, 50, 50, 2500, weights=(1.0, 0.0, 0.0))
        used = max(first + -(-(hi - lo) // per) for _, lo, hi, first, per, _ in runs)
        assert used == len(bins)
