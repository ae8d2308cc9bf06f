"""Byte-level BPE texts as words: splitting, word cache, decoding.

The vocabulary file (JSON of the tokenizers library) is a parameter. Texts are
cut into the words of the byte-level pattern by vectorised tests on the code
points' classes; each distinct word is encoded once by an encoder given by the caller,
and ids of whole chunks are gathered from the cache of words.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from tokenizers import pre_tokenizers

from recsmith.llm import textscan as ts

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 0, 1, 2, 3, 255
# The endings that the byte-level pattern keeps with an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Words a cache holds before it starts anew.
CACHE_WORDS = 300_000


_classes = np.full(0x110000, UNKNOWN, dtype=np.uint8)
_pattern = pre_tokenizers.ByteLevel(add_prefix_space=False)


def char_classes(codes: np.ndarray) -> np.ndarray:
    """Class of each code point. The library's own pattern is asked once for
    each code point that occurs (its Unicode version counts): a character is
    of the class of the letter, digit or sign that it forms one word with."""
    kind = _classes[codes]
    unknown = kind == UNKNOWN
    if unknown.any():
        for c in np.unique(codes[unknown]).tolist():
            one_word = (k for k, sign in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(_pattern.pre_tokenize_str(sign + chr(c))) == 1)
            _classes[c] = next(one_word, SPACE)
        kind = _classes[codes]
    return kind


def split(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Start positions of the words; `bounds` part texts."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = char_classes(codes)
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    run = edge[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    # the last white space before a word starts a token; a blank joins the word
    lead = np.flatnonzero(run[1:] & ~edge[1:n] & (kind[:-1] == SPACE))
    start[lead] = True
    start[lead[codes[lead] == 0x20] + 1] = False
    # contractions
    quote = np.flatnonzero((codes[:-1] == 0x27) & start[:-1] & run[1:] & ~edge[1:n] & (kind[1:] == LETTER))
    if len(quote):
        second = np.append(codes, [0, 0])[quote + 2]
        inside = ~np.append(run, [True, True])[quote + 2]  # the second letter is of the same run
        for ending in CONTRACTIONS:
            fits = codes[quote + 1] == ord(ending[0])
            if len(ending) == 2:
                fits &= inside & (second == ord(ending[1]))
            at = quote[fits]
            start[at + 1] = False
            after = at + 1 + len(ending)
            start[after[after < n]] = True
    return np.flatnonzero(start)


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in the vocabulary: printable Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        back = {c: b for b, c in byte_letters().items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        vocab = data["model"]["vocab"]
        self.ids = {bytes(back[c] for c in text): i for text, i in vocab.items() if text not in self.special}
        self.bytes: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, i in self.ids.items():
            self.bytes[i] = text
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in
                       (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])]
        self._size = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self._at = np.cumsum(self._size) - self._size
        self._flat = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the ids, end of each id in them)."""
        size = self._size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.repeat(self._at[ids] - (ends - size), size) + np.arange(total)], ends


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class WordCache:
    """Ids of distinct words, looked up by the words' hashes.

    Hashes have 64 bits; `Encoder.encode` compares the decoded ids with the
    text, so two words of one hash cannot go unnoticed."""

    def __init__(self, encode_words: Callable[[list[str]], list[list[int]]]):
        self.encode_words = encode_words
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def add(self, hashes: np.ndarray, found: list[list[int]]) -> None:
        """`hashes` sorted and not yet known."""
        size = np.array([len(x) for x in found], dtype=np.int64)
        at = self.used + np.cumsum(size) - size
        total = int(size.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + total] = [i for x in found for i in x]
        self.used += total
        where = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, where, hashes)
        self.at = np.insert(self.at, where, at)
        self.size = np.insert(self.size, where, size)

    def lookup(self, hashes: np.ndarray, word: Callable[[int], str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each word)."""
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_WORDS:
            self.clear()
        where = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = where < len(self.known)
        new[inside] = self.known[where[inside]] != distinct[inside]
        if new.any():
            self.add(distinct[new], self.encode_words([word(int(i)) for i in first[new]]))
            where = np.searchsorted(self.known, distinct)
        size = self.size[where][back]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.at[where][back] - (ends - size), size) + np.arange(total)], size


class Encoder:
    """Encodes chunks of texts; `encode_words` gives the ids of words."""

    def __init__(self, vocab: Vocabulary, encode_words: Callable[[list[str]], list[list[int]]]):
        self.vocab, self.encode_words = vocab, encode_words
        self.cache = WordCache(encode_words)

    def _specials(self, chunk: ts.Chunk, text: str) -> list[tuple[int, int, int]]:
        out = []
        for token, i in self.vocab.special.items():
            at = text.find(token)
            while at >= 0:
                if chunk.doc_of(np.array([at]))[0] == chunk.doc_of(np.array([at + len(token) - 1]))[0]:
                    out.append((at, at + len(token), i))
                at = text.find(token, at + 1)
        return sorted(out)

    def encode(self, chunk: ts.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, n + 1 bounds of the texts in them, decoded bytes, n + 1
        bounds of the texts in those)."""
        codes, bounds = chunk.codes, chunk.bounds
        text = codes.tobytes().decode("utf-32-le")
        special = self._specials(chunk, text)
        cuts = bounds if not special else np.unique(np.concatenate([bounds, *[s[:2] for s in special]]))
        start = split(codes, cuts)
        end = np.append(start[1:], len(codes))
        if special:  # a special token is one word of its own
            inside = np.zeros(len(codes) + 1, dtype=bool)
            for lo, hi, _ in special:
                inside[lo + 1:hi] = True
            keep = ~inside[start]
            start = start[keep]
            end = np.append(start[1:], len(codes))
        hashes = ts.span_hash(ts.char_values(codes), start, end)
        ids, size = self.cache.lookup(hashes, lambda k: text[start[k]:end[k]])
        word_ends = np.concatenate([[0], np.cumsum(size)])
        if special:  # the pattern gives their text other ids
            which = np.searchsorted(start, [s[0] for s in special])
            parts, at = [], 0
            for k, (_, _, i) in zip(which, special, strict=True):
                parts += [ids[at:word_ends[k]], np.array([i], dtype=np.int32)]
                at = word_ends[k + 1]
            ids = np.concatenate([*parts, ids[at:]])
            size = size.copy()
            size[which] = 1
            word_ends = np.concatenate([[0], np.cumsum(size)])
        ends = word_ends[np.searchsorted(start, bounds)]
        data, byte_ends = self.vocab.decode(ids)
        byte_bounds = np.concatenate([[0], byte_ends])[ends]
        if data.tobytes() != text.encode("utf-8"):  # two words of one hash: encode without the cache
            found = [self.encode_words([text[s:e]])[0] for s, e in zip(start, end, strict=True)]
            for s in special:
                found[int(np.searchsorted(start, s[0]))] = [s[2]]
            size = np.array([len(f) for f in found], dtype=np.int64)
            ids = np.array([i for f in found for i in f], dtype=np.int32)
            ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, bounds)]
            data, byte_ends = self.vocab.decode(ids)
            byte_bounds = np.concatenate([[0], byte_ends])[ends]
        return ids, ends, data, byte_bounds
