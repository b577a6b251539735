"""Spelling variants of a corpus's words, found with a bit-sliced position index.

Words are counted over all texts. Two words are near if one inserted, deleted or
replaced code point turns one into the other. The index holds, for a block of
the vocabulary and each (position, letter), a bitset of the words that have the
letter there. A query word walks its letters through it: one set of words holds
those that agree so far, another those with exactly one error, 64 words a
machine operation; a longer word is met by reading the bitsets shifted by one
position from the skipped letter on.

A word need not meet the whole vocabulary: with one error, either the first or
the second half of the shorter word is whole in the other. Words are dealt to
buckets by each half, and a pair counts in the bucket of its first half if that
is whole, else in the bucket of its second, so exactly once. Buckets hold some
``BUCKET_ROWS`` rows whatever the vocabulary's size. A half that more than ``HOT``
words share is cut: its queries are dealt to parts, its index goes to each part.
Within a bucket the index is read in blocks, so memory does not follow a bucket's
size.

Words go by code points U+0041..U+005A, U+0061..U+007A and U+00C0..U+00FF alone,
hence one byte (Latin-1) a letter inside the tasks.

Defined cases: null or empty text has no words; a null id counts as empty text
in the deletion rule; rows that repeat are counted again; a deletion may leave
a shorter word, which counts if it is long enough; an empty table gives no rows.
Other columns are not read. Very long texts are read in pieces cut between words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import TextBytes, partitions, stored

BUCKET_ROWS = 1 << 17
HOT = 1 << 16
BLOCK_WORDS, BLOCK_LETTERS = 1 << 14, 1 << 22
STATE_WORDS = 1 << 16               # 64-bit words of one state of a round of queries
KEPT_COUNTS = 1 << 19
PIECE = 1 << 20

_lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_gap = re.compile(rb"[^a-z\xc0-\xff]")


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > PIECE:
        cut = _gap.search(text, at + PIECE)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def words_of(doc: str, text: bytes, least: int, divisor: int) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) in a UTF-8 text; words are Latin-1 bytes of at least ``least`` letters."""
    run = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least)
    start = zlib.crc32(f"{doc}:".encode())
    low = (text if text.isascii() else text.decode().encode("latin-1", "replace")).translate(_lower)
    for piece in _pieces(low):
        for w, n in Counter(run.findall(piece)).items():
            h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
            if h % divisor == 0:
                h %= len(w)
                w = w[:h] + w[h + 1:]
                if len(w) < least:
                    continue
            yield w, n


def _count(least: int, divisor: int):
    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                           pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), TextBytes(batch.column(1))):
                for w, n in words_of(doc, text, least, divisor):
                    counts[w] = counts.get(w, 0) + n
                if len(counts) > KEPT_COUNTS:
                    yield batch_of(counts)
                    counts = {}
        if counts:
            yield batch_of(counts)
    return run


def vocabulary(docs: DataFrame, least_length: int = 6, least_count: int = 5, divisor: int = 199, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(word, n): distinct words of all texts. Where ``divisor`` divides crc32("<id>:<word>"), the word lost a letter."""
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return (rows.mapInArrow(_count(least_length, divisor), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


# ── the index ──────────────────────────────────────────────────────────────

class BitSlices:
    """Bitsets per (position, letter) over words of one length, given as a matrix of letters."""

    def __init__(self, words: np.ndarray) -> None:
        n, self.length = words.shape
        self.width = -(-n // 64)
        self.slot = np.zeros((self.length, 256), np.int32)      # 0: no word has the letter there
        rows = [np.zeros((1, self.width), np.uint64)]
        at = 1
        for j in range(self.length):
            letters, which = np.unique(words[:, j], return_inverse=True)
            bits = np.zeros((len(letters), self.width * 64), np.uint8)
            bits[which, np.arange(n)] = 1
            rows.append(np.packbits(bits, axis=1, bitorder="little").view(np.uint64))
            self.slot[j, letters] = np.arange(at, at + len(letters))
            at += len(letters)
        self.rows = np.concatenate(rows)
        whole = np.zeros(self.width * 64, np.uint8)
        whole[:n] = 1
        self.whole = np.packbits(whole, bitorder="little").view(np.uint64)

    def having(self, position: int, letters: np.ndarray) -> np.ndarray:
        """Per query, the words with its letter at the position."""
        return self.rows[self.slot[position, letters]]

    def near(self, queries: np.ndarray, half: int, first_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of the pairs with exactly one error, the word being as long as the query or one longer.

        ``first_half``: of these, the pairs whose first ``half`` letters agree; else the others.
        """
        n, length = queries.shape
        agree = np.repeat(self.whole[None, :], n, axis=0)
        longer = self.length == length + 1
        one = agree.copy() if longer else np.zeros_like(agree)     # the skipped letter may be the first
        start = None
        for j in range(length):
            here = self.having(j, queries[:, j])
            if longer:
                agree &= here
                one &= self.having(j + 1, queries[:, j])
                one |= agree                                        # skip the letter after this one
            else:
                one &= here
                one |= agree & ~here
                agree &= here
            if j == half - 1:
                start = agree.copy()
        one &= start if first_half else ~start
        q, w = np.nonzero(one)
        pair, bit = np.nonzero(np.unpackbits(one[q, w][:, None].view(np.uint8), axis=1, bitorder="little"))
        return q[pair], w[pair] * 64 + bit


def _matrix(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


class _Best:
    """Per word: its near words' number and the best of them (largest count, then smallest word)."""

    def __init__(self) -> None:
        self.found: dict[bytes, list] = {}

    def add(self, word: bytes, other: bytes, n: int) -> None:
        f = self.found.get(word)
        if f is None:
            self.found[word] = [1, n, other]
            return
        f[0] += 1
        if (n, f[2]) > (f[1], other):
            f[1], f[2] = n, other

    def rows(self) -> pa.RecordBatch:
        v = self.found.values()
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in self.found], pa.string()), pa.array([f[0] for f in v], pa.int64()),
             pa.array([f[1] for f in v], pa.int64()), pa.array([f[2].decode("latin-1") for f in v], pa.string())],
            names=["word", "n_near", "best_n", "best"])


NEAR = "word string, n_near long, best_n long, best string"
QUERY, SAME, LONGER = 0, 1, 2


def _search(block_words: int):
    """Rows (bucket, first_half, part, kind, length, word, n), sorted by the first five: queries come before the index they meet,
    which is that of their own part: a cut half may have several parts in one bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: dict[int, tuple[list, list]] = {}
        block: tuple[list, list] = ([], [])
        best, now, last = _Best(), None, None

        def meet(bucket, first_half, part, kind, length) -> None:
            """All queries of the length against the block of index words."""
            words, counts = block
            if not words or length not in queries:
                return
            index, (asked, asked_n) = BitSlices(_matrix(words)), queries[length]
            step = max(1, min(STATE_WORDS // index.width, BLOCK_LETTERS // length))
            for i in range(0, len(asked), step):
                q, w = index.near(_matrix(asked[i:i + step]), length // 2, first_half)
                for a, b in zip((q + i).tolist(), w.tolist()):
                    best.add(asked[a], words[b], counts[b])
                    if kind == LONGER:          # pairs of one length are met from both sides
                        best.add(words[b], asked[a], asked_n[a])

        for batch in batches:
            cols = [batch.column(i) for i in range(5)]
            keys = np.stack([c.cast(pa.int64()).to_numpy() for c in cols], axis=1)
            edges = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))).tolist() + [len(keys)] if len(keys) else [0]
            for a, b in zip(edges, edges[1:]):
                key = tuple(keys[a].tolist())
                words = [w.encode("latin-1") for w in batch.column(5).slice(a, b - a).to_pylist()]
                counts = batch.column(6).slice(a, b - a).to_pylist()
                if key != last:
                    if last and last[3] != QUERY:
                        meet(*last)
                    block, last = ([], []), key
                if key[:3] != now:
                    if best.found:
                        yield best.rows()
                    best, now, queries = _Best(), key[:3], {}
                if key[3] == QUERY:
                    have = queries.setdefault(key[4], ([], []))
                    have[0].extend(words)
                    have[1].extend(counts)
                    continue
                most = max(1, min(block_words, BLOCK_LETTERS // len(words[0])))
                for i in range(0, len(words), most):
                    block[0].extend(words[i:i + most])
                    block[1].extend(counts[i:i + most])
                    if len(block[0]) >= most:
                        meet(*key)
                        block = ([], [])
        if last and last[3] != QUERY:
            meet(*last)
        if best.found:
            yield best.rows()
    return run


def _dealt(words: DataFrame, buckets: int, hot: int) -> DataFrame:
    """Every word as a query and as an index word of its own length and of one less, for both halves, with its bucket."""
    size = F.length("word")
    half = lambda n: F.expr(f"({n}) div 2").cast("int")

    def role(kind: int, first: bool, length, part):
        return F.struct(F.lit(kind).alias("kind"), F.lit(first).alias("first_half"), length.cast("long").alias("length"), part.alias("half"))

    own, less = "length(word)", "length(word) - 1"
    roles = [role(kind, True, size, F.substring("word", F.lit(1), half(own))) for kind in (QUERY, SAME)]
    roles += [role(kind, False, size, F.substring("word", half(own) + 1, size)) for kind in (QUERY, SAME)]
    roles += [role(LONGER, True, size - 1, F.substring("word", F.lit(1), half(less))),
              role(LONGER, False, size - 1, F.substring("word", half(less) + 2, size))]
    dealt = words.select("word", "n", F.inline(F.array(*roles)))
    shares = ["first_half", "length", "half"]
    # at most 2 x vocabulary / hot rows: safe to broadcast at any size of the vocabulary that fits a cluster
    crowded = dealt.where(F.col("kind") == QUERY).groupBy(*shares).count().where(F.col("count") > hot)
    parts = F.coalesce(F.ceil(F.col("count") / hot), F.lit(1)).cast("long")
    dealt = dealt.join(F.broadcast(crowded), shares, "left").withColumn("parts", parts)
    own_part = F.array(F.pmod(F.xxhash64("word"), "parts"))
    dealt = dealt.withColumn("part", F.explode(F.when(F.col("kind") == QUERY, own_part).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))))
    return dealt.select(F.pmod(F.xxhash64(*shares, "part"), F.lit(buckets)).alias("bucket"), F.col("first_half").cast("int").alias("first_half"),
                        "part", "kind", "length", "word", "n")


def near_words(words: DataFrame, bucket_rows: int = BUCKET_ROWS, hot: int = HOT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of every word (word, n; stored) that has near words."""
    buckets = max(partitions(words.sparkSession), -(-6 * words.count() // bucket_rows))
    found = (_dealt(words, buckets, hot).repartition(buckets, "bucket").sortWithinPartitions("bucket", "first_half", "part", "kind", "length")
             .mapInArrow(_search(block_words), NEAR))
    top = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top"))
            .select("word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.word").alias("best")))


def _ends(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of forms from a word ends. Each round doubles the steps that are covered;
    counts grow along a chain by the ratio, so its length is bounded by their logarithm."""
    ends = forms
    while True:
        ahead = ends.select(F.col("word").alias("at"), F.col("root").alias("next"))
        longer = stored(ends.join(ahead, ends["root"] == ahead["at"], "left")
                        .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling_roots")
        ends = longer.select("word", "root")
        if not longer.where("moved").limit(1).count():
            return ends


def variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, ratio: int = 5, divisor: int = 199,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    ``form`` is the near word of largest count (ties: the smallest) if that is at
    least ``ratio`` times the word's; ``root`` follows forms to the last.
    """
    words = stored(vocabulary(docs, least_length, least_count, divisor, id_col, text_col), "spelling_words")
    near = near_words(words)
    is_form = F.col("best_n") >= ratio * F.col("n")
    named = stored(words.join(near, "word", "left")
                   .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
                           F.when(is_form, F.col("best_n")).alias("form_n")), "spelling_forms")
    ends = _ends(named.where("form is not null").select("word", F.col("form").alias("root")))
    return (named.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
