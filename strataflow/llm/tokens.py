"""Token ids of whole texts with a public ``tokenizers`` vocabulary file."""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np

#: Words after which a Python worker starts to forget those that it has not met since as many words ago; it remembers
#: twice as many at most, besides those of the texts at hand.
WORDS_KEPT = 400_000
#: Marks that often follow a word; between a letter and a mark the pre-tokenizer always cuts.
MARKS = b".,!?:;*#$%&|"
END_OF_WORD = "</w>"


class WordEncoder:
    """``Tokenizer.encode(text, add_special_tokens=False)`` for many texts.

    The vocabulary's pre-tokenizer drops white space, never joins text across
    it, and ignores case, so a text's ids are those of its space-separated,
    lower-cased words in order. Each distinct word goes through the library once
    while the worker remembers it: words of letters only in one long call (each is one piece, whose
    last token is marked as a word's end), all others one by one. Vocabularies
    of another kind get whole texts. Texts that
    may hold a special token's name, or marks that combine with a letter
    (U+0300 to U+037F), go through the library whole.
    Ids are little-endian unsigned integers of ``width``: 16 bits where the
    vocabulary allows, else 32.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        # words are apart only if white space is dropped and each word ends with a mark of its own
        self.by_word = spec["model"].get("end_of_word_suffix") == END_OF_WORD and steps[0].get("behavior") == "Removed"
        # lower-case ASCII letters are their own normal form and one piece: white space is all there is to cut at
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}                      # words met before those in `known`
        self.width = "<u2" if self.vocabulary <= 65536 else "<u4"
        self.ends = np.zeros(self.vocabulary, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items() if t.endswith(END_OF_WORD)]] = True

    def _each(self, words: list[str], tokenizer=None) -> list[bytes]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, self.width).tobytes() for e in found]

    def _learn(self, words: list[bytes]) -> None:
        ascii_, plain, odd = [], [], []
        for w in words:
            (ascii_ if w.isalpha() else plain if w.decode().isalpha() else odd).append(w)
        for tokenizer, group in ((self.letters, ascii_), (self.tokenizer, plain)):
            for i in range(0, len(group), 5_000):
                part = group[i:i + 5_000]
                ids = np.frombuffer(self._each([b" ".join(part).decode()], tokenizer)[0], self.width)
                stops = np.flatnonzero(self.ends[ids]) + 1
                if len(stops) == len(part) and stops[-1] == len(ids):
                    flat, at = ids.tobytes(), (ids.itemsize * stops).tolist()
                    self.known.update(zip(part, [flat[a:b] for a, b in zip([0, *at], at)]))
                else:
                    odd += part
        self.known.update(zip(odd, self._each([w.decode() for w in odd])))

    def _forgotten(self, words: set[bytes]) -> set[bytes]:
        """Those of ``words`` that have to be learned; the older ones among them are remembered on."""
        older = self.older
        met = list(filter(older.__contains__, words))
        self.known.update(zip(met, map(older.__getitem__, met)))
        return words.difference(met)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._each([t.decode() for t in texts])
        apart = [b"<|" in t or b"\xcc" in t or b"\xcd" in t for t in texts]
        words = [[] if x else t.lower().split() for t, x in zip(texts, apart)]
        known = self.known
        new = self._forgotten(set(chain.from_iterable(filterfalse(known.__contains__, w) for w in words)))
        marked = []
        for w in new:
            stem = w.rstrip(MARKS)
            if stem and len(stem) < len(w) and stem.decode()[-1].lower().isalpha():
                marked.append((w, stem, w[len(stem):]))
        new.difference_update([w for w, _, _ in marked])
        parts = {x for _, stem, marks in marked for x in (stem, marks) if x not in known}
        self._learn(list(new | self._forgotten(parts)))
        known.update((w, known[stem] + known[marks]) for w, stem, marks in marked)
        whole = iter(self._each([t.decode() for t, x in zip(texts, apart) if x]))
        out = [next(whole) if x else b"".join(map(known.__getitem__, w)) for w, x in zip(words, apart)]
        if len(known) > WORDS_KEPT:
            self.known, self.older = {}, known
        return out

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
