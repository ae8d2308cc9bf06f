"""BPE encoding and decoding by prefix-sharing trie traversal (operator 6).

The distinct words of a chunk, sorted, are a trie in depth-first order: two
neighbours share the path of their common prefix. A path node carries the last
token of its prefix's encoding. A token t can end the encoding of a prefix if
t is a suffix of it and stays apart from the last token of the rest, that is,
if merging never crosses the border of the two; exactly one suffix fits. So a
node's state follows from its ancestors' states, shared prefixes are encoded
once, and a word's ids are read back along the last tokens.

Whole texts go through Spark in Arrow batches, with no shuffle; every text is
decoded again and compared.

Defined results: null counts as an empty text (no ids); repeated rows are
encoded each; output columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.llm import textscan as ts
from recsmith.llm.common import by_place
from recsmith.llm.pretokens import Encoder, Vocabulary, vocabulary

_NEVER = 1 << 60
#: Entries that each memo of a worker's encoder may hold.
MEMO = 400_000


class TrieEncoder:
    """Encodes sets of words; needs the merges of a byte-level vocabulary."""

    def __init__(self, vocab: Vocabulary):
        self.rank = [-1] * len(vocab.bytes)  # of the merge that makes a token
        self.left = list(range(len(vocab.bytes)))
        self.right = list(range(len(vocab.bytes)))
        self.merge: dict[int, int] = {}
        for r, (a, b, ab) in enumerate(vocab.merges):
            self.merge[a << 20 | b] = r
            if self.rank[ab] < 0:
                self.rank[ab], self.left[ab], self.right[ab] = r, a, b
        self.apart: dict[int, bool] = {}
        self._suffixes(vocab)

    def _suffixes(self, vocab: Vocabulary) -> None:
        """Automaton over the tokens: ends[state] are the tokens that are
        suffixes of what was read, the longest first."""
        self.next: list[dict[int, int]] = [{}]
        own = [-1]
        for text, i in vocab.ids.items():
            state = 0
            for byte in text:
                to = self.next[state].get(byte)
                if to is None:
                    to = self.next[state][byte] = len(self.next)
                    self.next.append({})
                    own.append(i)
                    own[to] = -1
                state = to
            own[state] = i
        size = [len(b) for b in vocab.bytes]
        self.fail = [0] * len(self.next)
        self.ends: list[tuple] = [()] * len(self.next)
        level = [0]
        while level:
            below = []
            for state in level:
                for byte, to in self.next[state].items():
                    if state:
                        back = self.fail[state]
                        while back and byte not in self.next[back]:
                            back = self.fail[back]
                        self.fail[to] = self.next[back].get(byte, 0)
                    self.ends[to] = (((own[to], size[own[to]]),) if own[to] >= 0 else ()) + self.ends[self.fail[to]]
                    below.append(to)
            level = below
        self.step: dict[int, int] = {}

    def _stays_apart(self, p: int, q: int) -> bool:
        """Whether encoding the bytes of tokens p and q gives p, q. Walks back
        through the pieces that met at the border; until a piece is merged
        into its parent, the two could have merged instead. Of merges with
        one rank the left one comes first."""
        parent_p = parent_q = _NEVER
        merge, rank = self.merge, self.rank
        while True:
            r = merge.get(p << 20 | q, _NEVER)
            if r < parent_p and r <= parent_q:
                return False
            if rank[p] < 0 and rank[q] < 0:
                return True
            if rank[p] > rank[q]:
                parent_p, p = rank[p], self.right[p]
            else:
                parent_q, q = rank[q], self.left[q]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word (not empty), by one depth-first traversal."""
        order = sorted(range(len(words)), key=words.__getitem__)
        out: list = [None] * len(words)
        last, width, state = [-1], [0], [0]  # along the path
        before = b""
        step, ends, apart = self.step, self.ends, self.apart
        for k in order:
            word = words[k]
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:], width[shared + 1:], state[shared + 1:]
            now = state[shared]
            for at in range(shared, len(word)):
                key = now << 8 | word[at]
                now = step.get(key, -1)
                if now < 0:
                    if len(step) > MEMO:
                        step.clear()
                    now = step[key] = self._goto(key >> 8, word[at])
                for token, size in ends[now]:
                    rest = last[at + 1 - size]
                    if rest < 0:
                        break  # the whole prefix is one token
                    pair = rest << 20 | token
                    fits = apart.get(pair)
                    if fits is None:
                        if len(apart) > MEMO:
                            apart.clear()
                        fits = apart[pair] = self._stays_apart(rest, token)
                    if fits:
                        break
                last.append(token)
                width.append(size)
                state.append(now)
            at, ids = len(word), []
            while at:
                ids.append(last[at])
                at -= width[at]
            ids.reverse()
            out[k] = ids
            before = word
        return out

    def _goto(self, state: int, byte: int) -> int:
        while state and byte not in self.next[state]:
            state = self.fail[state]
        return self.next[state].get(byte, 0)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker and vocabulary file."""
    vocab = vocabulary(path)
    trie = TrieEncoder(vocab)
    return Encoder(vocab, lambda words: trie.encode([w.encode("utf-8") for w in words]))


def encode_decode(docs: DataFrame, path: str, keep: list[str], with_ids: bool = True) -> DataFrame:
    """Columns `keep` and: ids (array<int>, if `with_ids`), n_tokens,
    ids_sha256 (of little-endian 32-bit ids), decoded_sha256 (of the text that
    the ids decode to)."""
    extra = ["ids"] * with_ids + ["n_tokens", "ids_sha256", "decoded_sha256"]
    keep = [c for c in keep if c not in extra]
    source = by_place(docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text")))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    for c in extra:
        schema = schema.add(c, {"ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType()}.get(c, T.StringType()))

    def scan(batches):
        enc = encoder(path)
        for batch in batches:
            for chunk in ts.chunks(batch.column(len(keep))):
                ids, ends, data, byte_ends = enc.encode(chunk)
                raw, text = ids.astype("<u4").tobytes(), data.tobytes()
                columns = [batch.column(i).slice(chunk.row, chunk.n) for i in range(len(keep))]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))))
                columns.append(pa.array(np.diff(ends), pa.int64()))
                columns.append(pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string()))
                columns.append(pa.array([hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(byte_ends[:-1], byte_ends[1:], strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=keep + extra)

    return source.mapInArrow(scan, schema)
