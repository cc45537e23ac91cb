"""SentencePiece encoding and decoding with an Aho-Corasick automaton over the pieces.

One pass over a text finds, at each position, all pieces that end there (the automaton's
output links), and relaxes the best way to reach it. For a unigram model the best way has
the highest sum of scores. For a BPE model a piece may only follow one with which the
merge rules would leave the two apart; then one way is left at each position, and it is
the model's own encoding. White space starts a piece, so words are encoded one by one and
a worker keeps the ids of those it has seen.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decreta.llm.batches import column, map_batches, raw

SPACE = "▁"
KEPT_WORDS, KEPT_PAIRS = 800_000, 1 << 20
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_LOADED: dict[tuple[str, bool], "Pieces"] = {}


def pieces(path: str, merges: bool = True) -> "Pieces":
    """The pieces of a model file, one automaton per worker."""
    if (path, merges) not in _LOADED:
        _LOADED[path, merges] = Pieces(path, merges)
    return _LOADED[path, merges]


class Pieces:
    def __init__(self, path: str, merges: bool):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.merges, self.normalize = merges, sp.normalize
        self.names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(len(self.names))]
        self.scores = {p: sp.get_score(i) for i, p in enumerate(self.names) if not special[i]}
        self.ids = {p: i for i, p in enumerate(self.names) if not special[i]}
        self.unknown = sp.unk_id()
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.names) if sp.is_byte(i)}
        self.data = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else p.replace(SPACE, " ").encode()
                     for i, p in enumerate(self.names)]
        self.lengths = [len(p) for p in self.names]
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.characters = frozenset(p for p in self.ids if len(p) == 1)
        self._forget()
        self.pairs: dict[int, bool] = {}

    def apart(self, a: int, b: int) -> bool:
        """Whether merging the characters of two pieces by rank ends with just the two."""
        key = a << 32 | b
        if key in self.pairs:
            return self.pairs[key]
        if len(self.pairs) > KEPT_PAIRS:
            self.pairs.clear()
        scores, parts = self.scores, list(self.names[a] + self.names[b])
        ranks = [scores.get(x + y) for x, y in zip(parts, parts[1:])]
        while True:
            best = max((r for r in ranks if r is not None), default=None)
            if best is None:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = scores.get(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = scores.get(parts[at] + parts[at + 1])
        self.pairs[key] = out = parts == [self.names[a], self.names[b]]
        return out

    def _merged(self, text: str) -> list[int]:
        """The one way through a stretch of known characters that the merge rules leave.
        The longest piece that ends at a position comes first, and at most one fits."""
        last = [-1] * len(text)
        found, lengths, apart = -1, self.lengths, self.apart
        for at, piece in self.automaton.iter(text):
            if at != found:
                before = at - lengths[piece]
                if before < 0 or (last[before] >= 0 and apart(last[before], piece)):
                    last[at] = piece
                    found = at
        return self._back(last)

    def _best(self, text: str) -> list[int]:
        """The way through a stretch of known characters with the highest sum of scores."""
        last, best = [-1] * len(text), [-float("inf")] * len(text)
        for at, piece in self.automaton.iter(text):
            before = at - self.lengths[piece]
            score = self.scores[self.names[piece]] + (best[before] if before >= 0 else 0.0)
            if score > best[at]:
                best[at], last[at] = score, piece
        return self._back(last)

    def _back(self, last: list[int]) -> list[int]:
        ids, at = [], len(last) - 1
        while at >= 0:
            ids.append(last[at])
            at -= self.lengths[last[at]]
        return ids[::-1]

    def word(self, text: str) -> list[int]:
        """Ids of a stretch of normalised text; a character without a piece by its bytes."""
        way = self._merged if self.merges else self._best
        if self.characters.issuperset(text):
            return way(text)
        ids, known = [], ""
        for c in (*text, ""):
            if c in self.characters:
                known += c
                continue
            if known:
                ids += way(known)
                known = ""
            if c:
                ids += [self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown]
        return ids

    def normal(self, text: str) -> str:
        """Normalised by the model's rules. Its library stops at a null character, so a
        character that is not in the text stands in for it."""
        if "\0" not in text:
            return self.normalize(text)
        mark = next(chr(c) for c in range(0xE000, 0x10FFFF) if chr(c) not in text)
        return self.normalize(text.replace("\0", mark)).replace(mark, "\0")

    def _learn(self, words: list[str]) -> None:
        """Encode words not seen before and keep their ids side by side."""
        found = [self.word(w) for w in words]
        lengths = np.array([len(x) for x in found], np.int64)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.tokens) + np.cumsum(lengths) - lengths])
        self.counts = np.concatenate([self.counts, lengths])
        self.tokens = np.concatenate([self.tokens, np.array([i for x in found for i in x], np.uint32)])

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.counts, self.tokens = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        if len(self.known) > KEPT_WORDS:
            self._forget()
        flat, sizes = [], []
        for t in texts:
            words = _WORD.findall(self.normal(t))
            flat += words
            sizes.append(len(words))
        codes = np.fromiter(map(self.known.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            words = [flat[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(words)))
            codes[missing] = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        per_word = self.counts[codes]
        ends = np.cumsum(per_word)
        ids = self.tokens[np.repeat(self.starts[codes] - (ends - per_word), per_word) + np.arange(int(per_word.sum()))]
        total, last = np.concatenate([[0], ends]), np.cumsum(sizes, dtype=np.int64) if sizes else np.zeros(0, np.int64)
        return ids, total[last] - total[last - np.array(sizes, np.int64)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids, without the space that encoding puts first."""
        text = b"".join([self.data[i] for i in ids.tolist()]).decode(errors="replace")
        return text[1:] if text[:1] == " " else text


def encode_pieces(docs: DataFrame, model: str, merges: bool = True, ids: bool = False) -> DataFrame:
    """Encode every whole text of ``docs`` (``doc_id, text``; null: empty) and decode it.

    Returns ``doc_id, n_pieces, ids_crc32`` (unsigned, of little-endian unsigned 32-bit
    ids), ``decoded_sha256`` (of the text decoded from the ids), ``lossless`` (whether it
    is the text) and, on request, ``ids``. The model's own normalisation applies; a
    literal U+2581 counts as a space, as in the format itself.
    """
    schema = "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean" + (", ids array<int>" if ids else "")

    def fn(batch):
        p, texts = pieces(model, merges), [t.decode() for t in raw(batch)]
        tokens, counts = p.encode(texts)
        parts = np.split(tokens.astype("<u4"), np.cumsum(counts)[:-1])
        decoded = [p.decode(x) for x in parts]
        out = {"doc_id": column(batch, "doc_id"), "n_pieces": counts, "ids_crc32": [zlib.crc32(x) for x in parts],
               "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in decoded], "lossless": [a == b for a, b in zip(texts, decoded)]}
        if ids:
            out["ids"] = [x.astype(np.int32) for x in parts]
        return out

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fn, schema)
