"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's score is linear in its own features and
those of the lines before and after it; a 2 x 2 matrix scores neighbouring
labels. Forward-backward gives each line's probability of being good; the
length-weighted mean over the lines is the document's score.

Training has document labels only: each line of a labelled document takes that
label, and the model is fitted by full-batch gradient ascent on the conditional
log-likelihood of a bounded sample (``max_docs`` labelled documents, those with
the smallest hash of their id). Only line features travel to the driver.

Defined cases: null text is empty; an empty text is one line of length 0 (lines
of total length 0 count equally); a null id counts as held out; a document with
several labels takes their mean, rounded up; without any usable label every
score is 0.5; repeated rows are each scored; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import TextBytes, hash_words, remainder

#: Texts whose features a worker makes at once; the arrays on the way take some 70 times as much memory.
BATCH_BYTES = 512 << 10
OTHER, SPACE, LOWER, UPPER, DIGIT, PUNCT, SYMBOL = range(7)
_CLASS = np.full(256, LOWER, np.uint8)
_CLASS[:128] = OTHER
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = LOWER, UPPER, DIGIT
_CLASS[list(b".,;:?'\"()-")] = PUNCT
_CLASS[list(b"!*#&$%|@^~<>{}[]=+_\\/`")] = SYMBOL
N_OWN = 10


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x features, length of each line in bytes, first line of each text plus the end)."""
    a = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(a == 10)
    starts = np.append(0, ends[:-1] + 1)
    lengths = ends - starts
    bounds = np.append(0, np.cumsum([t.count(b"\n") + 1 for t in texts]))
    code = _CLASS[a]
    accent = np.flatnonzero((a[:-1] == 0xC3) & (a[1:] >= 0x80) & (a[1:] <= 0x9E)) + 1    # upper-case Latin-1 letters
    code[accent] = UPPER
    line = np.repeat(np.arange(len(starts)), lengths + 1)
    n = np.bincount(line * 8 + code, minlength=8 * len(starts)).reshape(-1, 8).astype(np.float32)
    ws, we, h = hash_words(a)
    at = line[ws]
    words = np.bincount(at, minlength=len(starts)).astype(np.float32)
    # a word that equals the one or the two before it, in the same line
    again = np.zeros(len(h), bool)
    again[1:] |= (h[1:] == h[:-1]) & (at[1:] == at[:-1])
    again[2:] |= (h[2:] == h[:-2]) & (at[2:] == at[:-2])
    size, w = np.maximum(lengths, 1).astype(np.float32), np.maximum(words, 1)
    letters = np.maximum(n[:, LOWER] + n[:, UPPER], 1)
    last = a[np.maximum(ends - 1, 0)]
    own = np.stack([n[:, UPPER] / letters, n[:, SYMBOL] / size, n[:, DIGIT] / size, n[:, PUNCT] / size, n[:, OTHER] / size,
                    np.bincount(at, again, minlength=len(starts)) / w,
                    np.bincount(at, (we - ws) == 1, minlength=len(starts)) / w,
                    np.minimum(n[:, LOWER] + n[:, UPPER], 20 * w) / w / 10, np.log1p(lengths) / 8,
                    ((last == 46) | (last == 63)) & (lengths > 0)], axis=1).astype(np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[bounds[:-1]] = 0
    after[bounds[1:] - 1] = 0
    return np.hstack([own, before, after, np.ones((len(own), 1), np.float32)]), lengths, bounds


@dataclass
class LineCrf:
    """weights: feature scores of "good" (bad is 0); steps[i, j]: score of label i followed by j (1 is good)."""

    weights: np.ndarray
    steps: np.ndarray

    def marginals(self, x: np.ndarray, bounds: np.ndarray, pairs: bool = False):
        """P(good) of each line, by forward-backward over all texts at once, a line position at a time."""
        emit = np.stack([np.zeros(len(x)), x @ self.weights], axis=1)
        emit = np.exp(emit - emit.max(axis=1, keepdims=True))
        move = np.exp(self.steps - self.steps.max())
        n = np.diff(bounds)
        order = np.argsort(-n, kind="stable")
        first, n = bounds[:-1][order], n[order]
        fore, back = np.empty_like(emit), np.ones_like(emit)
        alive = [int(np.searchsorted(-n, -t, "left")) for t in range(int(n[0]) if len(n) else 0)]   # texts with over t lines
        for t, k in enumerate(alive):
            i = first[:k] + t
            f = emit[i] if t == 0 else (fore[i - 1] @ move) * emit[i]
            fore[i] = f / f.sum(axis=1, keepdims=True)
        for t in range(len(alive) - 1, 0, -1):
            i = first[:alive[t]] + t
            b = (back[i] * emit[i]) @ move.T
            back[i - 1] = b / b.sum(axis=1, keepdims=True)
        p = fore * back
        p /= p.sum(axis=1, keepdims=True)
        if not pairs:
            return p[:, 1]
        inner = np.ones(len(x), bool)
        inner[bounds[:-1]] = False
        i = np.flatnonzero(inner)
        joint = fore[i - 1][:, :, None] * move * (emit[i] * back[i])[:, None, :]
        return p[:, 1], i, joint / joint.sum(axis=(1, 2), keepdims=True)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x, lengths, bounds = line_features(texts)
        p = self.marginals(x, bounds)
        total = np.add.reduceat(lengths, bounds[:-1])
        weight = np.where(np.repeat(total, np.diff(bounds)) > 0, lengths, 1).astype(float)
        return np.clip(np.add.reduceat(p * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1]), 0.0, 1.0)


def fit(x: np.ndarray, bounds: np.ndarray, label: np.ndarray, rounds: int = 500, l2: float = 1e-5) -> LineCrf:
    """Maximum conditional likelihood by Adam; ``label`` per line, each text counting once."""
    crf = LineCrf(np.zeros(x.shape[1]), np.zeros((2, 2)))
    if not len(bounds) - 1:
        return crf
    n = np.diff(bounds)
    each = np.repeat(1.0 / n, n) / len(n)
    m, v = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
    for r in range(1, rounds + 1):
        p, i, joint = crf.marginals(x, bounds, pairs=True)
        g = x.T @ (each * (label - p)) - l2 * crf.weights
        seen = np.zeros((len(i), 2, 2))
        seen[np.arange(len(i)), label[i - 1].astype(int), label[i].astype(int)] = 1
        gs = ((seen - joint) * each[i][:, None, None]).sum(axis=0) - l2 * crf.steps
        g = np.append(g, gs.ravel())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.999 ** r)) + 1e-9)
        crf.weights += step[:-4]
        crf.steps += step[-4:].reshape(2, 2)
    return crf


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 4000, folds: int = 5, held_out: int = 0,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_lines: int = 512) -> LineCrf:
    """Fit on at most ``max_docs`` labelled documents whose fold is not ``held_out``.

    A sampled id gives one row (of rows that repeat it, the smallest text). Of a longer document the fit
    takes ``max_lines`` consecutive lines from a place that its id chooses. So what comes to the driver is
    at most ``max_docs`` x ``max_lines`` lines of 124 bytes (254 MB; the given tables have some 20 lines a document).
    """
    known = (labels.where((remainder(id_col, folds) != held_out) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.avg(F.col(label_col)).alias("label"))
             .where("label is not null").orderBy(F.xxhash64("id"), "id").limit(max_docs))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, places = TextBytes(batch.column(1)), batch.column(2).to_pylist()
            for s in texts.slices(BATCH_BYTES):
                x, _, bounds = line_features(texts[s])
                n = np.minimum(np.diff(bounds), max_lines)
                starts = [a + place % (b - a - k + 1) for a, b, k, place in zip(bounds[:-1].tolist(), bounds[1:].tolist(), n.tolist(), places[s])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[s], pa.array(n, pa.int64()), pa.array([x[a:a + k].tobytes() for a, k in zip(starts, n.tolist())])],
                    names=["label", "n", "x"])

    sample = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
              # broadcast: at most max_docs (id, label) rows; repeats of an id shrink to one row before the exchange
              .join(F.broadcast(known), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
              .select("label", "text", F.pmod(F.xxhash64("id", "label"), F.lit(1 << 40)).alias("place"))
              .mapInArrow(features, "label double, n long, x binary"))
    rows = sorted(map(tuple, sample.collect()))
    x = np.frombuffer(b"".join(bytes(r[2]) for r in rows), np.float32).reshape(-1, 3 * N_OWN + 1).astype(float)
    n = np.array([r[1] for r in rows], np.int64)
    label = np.repeat(np.array([r[0] >= 0.5 for r in rows], float), n)
    return fit(x, np.append(0, np.cumsum(n)), label)


def score(docs: DataFrame, crf: LineCrf, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score column; every other column stays, whatever its name (one named ``out`` is replaced).

    Only the text goes to Python; the other columns wait in the JVM.
    """
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            texts = TextBytes(column)
            yield pa.array(np.concatenate([np.empty(0), *(crf.scores(texts[s]) for s in texts.slices(BATCH_BYTES))]))

    # evaluated once a row: a filter on the score does not make a second call of it
    scored = F.arrow_udf(run, "double").asNondeterministic()
    return docs.withColumn(out, scored(F.col(f"`{text_col}`").cast("string")))
