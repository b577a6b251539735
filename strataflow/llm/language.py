"""Language identification by a string kernel.

A text is the set of its byte n-grams of 1 to 3 bytes (blended spectrum) after
lower-casing and reducing everything that is no letter to one space. The kernel
of two texts is the number of shared n-grams over the geometric mean of their
numbers. Nystroem: a few landmark texts L give the feature map
z(x) = K(x, L) K(L, L)^(-1/2); one-versus-rest ridge regression on z gives a
value per language. Texts are scored in batches by matrix products.

The sample is bounded: at most ``per_language`` documents of each language, one
from each of that many hash buckets, of which ``landmarks`` per language serve
as landmarks. Only their sets of n-grams reach the driver. Scoring reads whole
texts. Beside the score, the share of a text's n-grams that the sample knows tells
a mixture of learned languages (no single one scores high, all is known) from a
language that was not learned.

Defined cases: null text, or text without a letter, is ``und`` with score 0; a
null language is no label; a null id counts as empty text for the fold;
without any labelled text every prediction is ``und``; repeated rows are each
scored; ties go to the alphabetically first language; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import remainder

UND = "und"
#: Characters that are numbers but no decimal digits (superscripts, fractions, circled and Roman numerals).
NUMBERS = {ord(c): " " for c in map(chr, range(0x20000)) if c.isalnum() and not c.isalpha() and not c.isdecimal()}
#: A quick look for them, which also stops at any character beyond the basic plane.
MAYBE_NUMBERS = re.compile("[" + "".join(chr(c) for c in NUMBERS if c < 0x10000) + "\U00010000-\U0010FFFF]")
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: n-gram codes: 1 byte, 2 bytes, 3 bytes, one after another.
SHIFT = (0, 1 << 8, (1 << 8) + (1 << 16))
CODES = SHIFT[2] + (1 << 24)
BATCH_ROWS = 256


def letters(text: str | None) -> bytes | None:
    """Lower-case words of letters, single spaces around each; None without a letter."""
    text = text or ""
    if not text.isascii() and MAYBE_NUMBERS.search(text):        # rare, and slow as a part of the other pattern
        text = text.translate(NUMBERS)
    words = NOT_LETTERS.sub(" ", text).strip()
    return f" {words.lower()} ".encode() if words else None


def gram_codes(text: bytes) -> list[np.ndarray]:
    a = np.frombuffer(text, np.uint8).astype(np.int32)
    two = (a[:-1] << 8) | a[1:]
    return [a, two + SHIFT[1], ((two[:-1] << 8) | a[2:]) + SHIFT[2]]


def gram_set(text: bytes) -> np.ndarray:
    return np.unique(np.concatenate(gram_codes(text)))


class KernelClassifier:
    """Ridge regression on Nystroem features of the presence kernel."""

    def __init__(self, sets: list[np.ndarray], languages: list[str], landmarks: int, ridge: float) -> None:
        self.languages = sorted(set(languages))
        self.grams = np.unique(np.concatenate(sets)) if sets else np.empty(0, np.int32)
        if not self.languages:
            return
        chosen = [i for lang in self.languages for i in [j for j, x in enumerate(languages) if x == lang][:landmarks]]
        self.marks = self._presence([sets[i] for i in chosen]).T                  # grams x landmarks
        self.mark_size = np.array([len(sets[i]) for i in chosen], np.float32)
        k_ll = (self.marks.T @ self.marks) / np.sqrt(np.outer(self.mark_size, self.mark_size))
        value, vector = np.linalg.eigh(k_ll.astype(float))
        keep = value > 1e-6 * value.max()
        root = vector[:, keep] / np.sqrt(value[keep])                             # K(L, L)^(-1/2)
        z = np.concatenate([self._kernel(self._presence(sets[i:i + BATCH_ROWS]), np.array(list(map(len, sets[i:i + BATCH_ROWS]))))
                            for i in range(0, len(sets), BATCH_ROWS)]) @ root
        z = np.hstack([z, np.ones((len(z), 1))])
        target = np.where(np.array(languages)[:, None] == np.array(self.languages), 1.0, -1.0)
        weight = 1 / np.array([languages.count(x) for x in languages])            # each language counts alike
        zw = z * weight[:, None]
        solved = np.linalg.solve(zw.T @ z + ridge * np.eye(z.shape[1]), zw.T @ target)
        self.alpha, self.bias = (root @ solved[:-1]).astype(np.float32), solved[-1]

    def _presence(self, sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), len(self.grams)), np.float32)
        for row, s in zip(out, sets):
            at = np.searchsorted(self.grams, s)
            at = at[at < len(self.grams)]
            row[at[self.grams[at] == s[:len(at)]]] = 1
        return out

    def _kernel(self, presence: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return (presence @ self.marks) / np.sqrt(np.outer(np.maximum(sizes, 1), self.mark_size))

    def lookup(self) -> np.ndarray:
        """Position of every possible n-gram code among the known ones, -1 elsewhere; 16 bits each where they suffice."""
        table = np.full(CODES, -1, np.int16 if len(self.grams) <= 1 << 15 else np.int32)
        table[self.grams] = np.arange(len(self.grams))
        return table

    def predict(self, texts: list[str | None], table: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (0.5: the best language's classifier is undecided) and share of known n-grams of each text."""
        presence = np.zeros((len(texts), len(self.grams)), np.float32)
        sizes, has = np.zeros(len(texts)), np.zeros(len(texts), bool)
        for i, text in enumerate(texts):
            own = letters(text)
            if own is None:
                continue
            has[i] = True
            for codes in gram_codes(own):
                at = table[codes]
                new = codes[at < 0]
                presence[i, at[at >= 0]] = 1
                sizes[i] += len(np.unique(new))
        known = presence.sum(axis=1)
        sizes += known
        value = self._kernel(presence, sizes) @ self.alpha + self.bias
        best = value.argmax(axis=1)
        score = (np.clip(value[np.arange(len(texts)), best], -1, 1) + 1) / 2
        return [self.languages[b] if h else UND for b, h in zip(best, has)], np.where(has, score, 0.0), known / np.maximum(sizes, 1)


def train(docs: DataFrame, per_language: int = 300, landmarks: int = 24, ridge: float = 1e-4, folds: int = 4, held_out: int = 2,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> KernelClassifier:
    """Fit on at most ``per_language`` documents of each language whose fold is not ``held_out``.

    A sampled id gives one row (of rows that repeat it in a language, the smallest text), so the sample that
    comes to the driver is bounded by ids and rows alike; of a text, only its set of n-grams comes.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                      F.col(text_col).cast("string").alias("text"))
    known = own.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & (remainder("id", folds) != held_out))
    order = F.xxhash64("id")
    # at most per_language ids of each language, by partial aggregates over (language, hash bucket)
    ids = (known.groupBy("lang", F.pmod(order, F.lit(per_language)).alias("bucket"))
           .agg(F.min_by("id", F.struct(order, "id")).alias("id")).select("lang", "id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, lang, letters(t)) for i, lang, t in zip(*(batch.column(k).to_pylist() for k in range(3)))]
            rows = [(i, lang, gram_set(t).astype("<i4").tobytes()) for i, lang, t in rows if t is not None]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                                              pa.array([r[2] for r in rows], pa.binary())], names=["id", "lang", "grams"])

    # broadcast: per_language rows a language; repeats of an id shrink to one row before the exchange
    sample = (known.join(F.broadcast(ids), ["lang", "id"]).groupBy("id", "lang").agg(F.min("text").alias("text"))
              .select("id", "lang", "text").mapInArrow(sets, "id long, lang string, grams binary"))
    rows = sorted((r[0], r[1], bytes(r[2])) for r in sample.collect())
    return KernelClassifier([np.frombuffer(r[2], "<i4") for r in rows], [r[1] for r in rows], landmarks, ridge)


def predict(docs: DataFrame, model: KernelClassifier, text_col: str = "text",
            lang_out: str = "lang_pred", score_out: str = "lang_score", known_out: str | None = None) -> DataFrame:
    """``docs`` with predicted language and score, and the share of known n-grams (0 without a letter) if ``known_out``
    names a column for it; every other column stays in the JVM, whatever its name (a column that has an output's name is
    replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # bounded by the sample

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m, table = shared.value, None
        for column in columns:
            langs, scores, shares = [], [np.empty(0)], [np.empty(0)]
            if not m.languages:
                langs, scores, shares = [UND] * len(column), [np.zeros(len(column))], [np.zeros(len(column))]
            else:
                table = m.lookup() if table is None else table
                for i in range(0, len(column), BATCH_ROWS):
                    a, b, c = m.predict(column[i:i + BATCH_ROWS].to_pylist(), table)
                    langs += a
                    scores.append(b)
                    shares.append(c)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(scores)), pa.array(np.concatenate(shares))],
                                             names=["lang", "score", "known"])

    found = F.arrow_udf(run, "lang string, score double, known double").asNondeterministic()
    outs = [(lang_out, "lang"), (score_out, "score"), *([(known_out, "known")] if known_out else [])]
    rest = [F.col(f"row.`{c}`") for c in docs.columns if c not in dict(outs)]
    return (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), found(F.col(f"`{text_col}`").cast("string")).alias("found"))
            .select(*rest, *[F.col(f"found.{field}").alias(out) for out, field in outs]))
