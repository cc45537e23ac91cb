"""Token ids of whole texts by the tokenizers library, with each word encoded once.

Both kinds of tokenizers used here cut a text before every single space, so the ids of a
text are those of its parts between spaces. A worker keeps the ids of the parts it has
seen, up to a fixed number; a text with white space that such a cut would change goes to
the library whole.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np

# Parts that a worker keeps; beyond it the store starts anew.
KEPT_PARTS = 800_000
# New words that are encoded as one text.
TOGETHER = 48
# A space inside a run of white space that is not before a word.
_INSIDE_RUN = re.compile(r"\s (?=\s|$)")
_WORD = re.compile(r"\S+")
# Letters and marks of ASCII, without the apostrophe, which may belong to a contraction.
_TAILED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-^`{-~]+)")
_LOADED: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of a vocabulary file, one per worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.mark = self._find_mark()
        probe = [" Word,", " é!", " a...", " Word", " é", " a", ",", "!", "...", " word"]
        x = [ids.tolist() for ids in self._whole(probe)]
        self.splits = all(x[k] == x[k + 3] + x[k + 6] for k in range(3))
        self.folds = x[3] == x[9]
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str | tuple[str], int] = {}
        self._tokens, self._starts, self._lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _find_mark(self) -> tuple[str, int] | None:
        """A text that keeps words apart when many are encoded as one text, and its id: a
        line feed where that is a token of its own, or a character between spaces."""
        probe = ["word", "don't", "x,", "(1990)", "日本", "é!", "..."]
        apart = [x.tolist() for x in self._whole([" " + w for w in probe])]
        for mark in ("\n", " \x1f"):
            ids = self._whole([mark.strip(" ")])[0].tolist()
            if len(ids) == 1:
                joined = self._whole([mark.join(" " + w for w in probe)])[0]
                cut = np.split(joined, np.flatnonzero(joined == ids[0]))
                if [x.tolist()[k > 0:] for k, x in enumerate(cut)] == apart:
                    return mark, ids[0]
        return None

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words after a space each, and the number of ids of each."""
        if self.mark and words:
            text, mark = self.mark
            # The library is fastest on texts of some hundred characters.
            found = self._whole([text.join(" " + w for w in words[i:i + TOGETHER]) for i in range(0, len(words), TOGETHER)])
            ids = np.concatenate([part for x in found for part in (x, np.array([mark], np.uint32))])
            at = np.flatnonzero(ids == mark)
            if len(at) == len(words):
                return np.delete(ids, at), np.diff(np.concatenate([[-1], at])) - 1
        return self._gathered(self._whole([" " + w for w in words]))

    @staticmethod
    def _gathered(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.array([len(x) for x in parts], np.int64)

    def _add(self, keys: list[str | tuple[str]], tokens: list[np.ndarray], lengths: np.ndarray) -> None:
        self._known.update(zip(keys, range(len(self._lengths), len(self._lengths) + len(keys))))
        self._starts = np.concatenate([self._starts, len(self._tokens) + np.cumsum(lengths) - lengths])
        self._lengths = np.concatenate([self._lengths, lengths])
        self._tokens = np.concatenate([self._tokens, *tokens])

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known parts in a row, and the number of ids of each."""
        lengths = self._lengths[codes]
        ends = np.cumsum(lengths)
        return self._tokens[np.repeat(self._starts[codes] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))], lengths

    def _learn(self, keys: list[str | tuple[str]]) -> None:
        """Encode parts not seen before; a part in a tuple has no space before it. Letters
        with marks at their end are the ids of the letters and those of the marks."""
        taken, pairs, folds = set(), [], self.folds
        for k in keys:
            if type(k) is not str:
                continue
            if k.isalpha():
                taken.add(k)
            elif self.splits and (tailed := _TAILED.fullmatch(k)) and tailed[1].isalpha():
                letters = tailed[1]
                pairs.append((k, letters.lower() if folds and letters.isascii() else letters, (tailed[2],)))
            elif _WORD.fullmatch(k):
                taken.add(k)
        split = {k for k, _, _ in pairs}
        known = self._known
        words = [*taken, *dict.fromkeys(c for _, c, _ in pairs if c not in known and c not in taken)]
        others = dict.fromkeys([*(k for k in keys if k not in taken and k not in split), *(t for _, _, t in pairs if t not in known)])
        found = [self._words(words[i:i + 2_000]) for i in range(0, len(words), 2_000)]
        found.append(self._gathered(self._whole([" " + k if type(k) is str else k[0] for k in others])))
        self._add([*words, *others], [x for x, _ in found], np.concatenate([n for _, n in found]))
        if pairs:
            codes = np.array([(known[c], known[t]) for _, c, t in pairs], np.int64)
            tokens, lengths = self._gather(codes.ravel())
            self._add([k for k, _, _ in pairs], [tokens], lengths.reshape(-1, 2).sum(axis=1))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        if len(self._known) > KEPT_PARTS:
            self._forget()
        flat: list[str | tuple[str]] = []
        sizes = []
        for t in texts:
            parts = [t] if _INSIDE_RUN.search(t) else t.split(" ")
            parts[0] = (parts[0],)
            flat += parts
            sizes.append(len(parts))
        known = self._known
        codes = np.fromiter(map(known.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            keys = [flat[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(keys)))
            codes[missing] = np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))
        ids, per_part = self._gather(codes)
        heads = np.cumsum(sizes, dtype=np.int64) - sizes if texts else np.zeros(0, np.int64)
        return ids, np.add.reduceat(per_part, heads) if texts else heads

    def with_end(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` after each text."""
        ids, counts = self.encode(texts)
        return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1
