"""Token ids of whole texts by a tokenizer file, as little-endian 32-bit bytes.

The tokenizer ``word_bpe_49k`` drops white space and never lets a token reach
across it: its normaliser and its merges work inside a run of other characters.
So the ids of a text are the ids of its words in order, and the ids of a word
are kept by each worker in two dictionaries of bounded size, the newer and the older. A word that ends in a run of common
punctuation after a letter is the word and its tail, which that tokenizer also
splits. Words of Latin letters alone need no patterns: lower-cased and spelt in the byte
alphabet, they are encoded many at a time by the same model, split at blanks, and
their ids are parted at the tokens that end a word. Texts with the four separators U+001C to U+001F, which are space to
Python but not to the tokenizer, or with ``<|``, which may begin the string of a
special token, are encoded as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np

WORDS_HELD = 400_000
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")  # letters that neither composing nor lower-casing turns into others' marks
_TAIL = "!#$%&*,.:;?"
_ODD = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
_GROUP = 2_000_000  # characters of the texts whose new words are learnt together
_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """One per worker and file, so that its words serve all tasks of the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str, words_held: int = WORDS_HELD):
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = Sequence([])
        self.bare.pre_tokenizer = WhitespaceSplit()
        spelling = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(i) for i in range(256) if _LETTERS.fullmatch(chr(i))]
        self.spelt = str.maketrans({c: spelling.pre_tokenize_str(c.lower())[0][0] for c in letters})
        self.words_held = words_held
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _bulk(self, words: list[str]) -> list[bytes]:
        """Words of letters alone, encoded as one text."""
        text = " ".join(words)
        text = text.lower() if text.isascii() else text.translate(self.spelt)
        ids = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            return self._plain(words)
        data, starts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(starts, starts[1:])]

    def _learn(self, words: list[str]) -> None:
        """Ids of new words. Most end in a tail or are letters alone; heads are encoded
        many at a time, whichever words they come from."""
        known, heads = self.known, list(map(str.rstrip, words, repeat(_TAIL)))
        spelt = [(h.isalpha() if h.isascii() else _LETTERS.fullmatch(h) is not None) for h in heads]
        plain = {w for w, ok in zip(words, spelt) if not ok}
        letters = set(compress(heads, spelt))
        ascii_only = {h for h in letters if h.isascii()}  # spelt faster when no other letters are among them
        tails = {w[len(h) :] for w, h, ok in zip(words, heads, spelt) if ok and len(w) > len(h)}
        for wanted, how in ((plain | tails, self._plain), (ascii_only, self._bulk), (letters - ascii_only, self._bulk)):
            new = [w for w in wanted if w not in known]
            for start in range(0, len(new), 2000):
                piece = new[start : start + 2000]
                known.update(zip(piece, how(piece)))
        for word, head, ok in zip(words, heads, spelt):
            if ok and len(word) > len(head):
                known[word] = known[head] + known[word[len(head) :]]

    def _held(self) -> dict[str, bytes]:
        """The words in use. When there are too many, those of the older half that have
        not been met since go; the others stay."""
        if len(self.known) > self.words_held:
            self.older, self.known = self.known, {}
        return self.known

    def encode(self, texts: list[str | None], end: int | None = None) -> list[bytes]:
        """Ids of each text; null as empty; ``end`` is appended to each."""
        last = b"" if end is None else np.array([end], dtype="<u4").tobytes()
        out: list[bytes] = []
        for rows in _grouped(texts):
            known = self._held()
            words = [None if any(map(t.__contains__, _ODD)) else (t.lower() if t.isascii() else t).split() for t in rows]
            new = set().union(*(w for w in words if w)).difference(known)
            if new and self.older:
                back = new.intersection(self.older)
                known.update(zip(back, map(self.older.__getitem__, back)))
                new -= back
            if new:
                self._learn(list(new))
            find = known.__getitem__
            for text, row in zip(rows, words):
                ids = self._plain([text])[0] if row is None else b"".join(map(find, row))
                out.append(ids + last)
        return out


def _grouped(texts: list[str | None]) -> Iterator[list[str]]:
    """Texts in order, as many at a time as have so many characters together."""
    rows: list[str] = []
    size = 0
    for text in texts:
        rows.append(text or "")
        size += len(rows[-1])
        if size >= _GROUP:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows
