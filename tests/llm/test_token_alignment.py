"""Operator 13 against both libraries and a plain search for shared ends."""

import collections
import random
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from recsmith.llm import token_alignment  # noqa: E402
from recsmith.llm.pretokens import Vocabulary  # noqa: E402

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def plain(rows):
    """Rows of COLUMNS, text by text."""
    a, b = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    a.encode_special_tokens = True
    part_a = Vocabulary(PATH_A).bytes

    def part_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    out, counts = [], collections.Counter()
    for doc, text in rows:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        want = (" " + (text or "")).encode()
        if not text or b"".join(part_a[i] for i in ids_a) != want or b"".join(part_b(i) for i in ids_b) != want:
            out.append((doc, [], [], [], []))
            continue
        end_a, end_b = np.cumsum([len(part_a[i]) for i in ids_a]).tolist(), np.cumsum([len(part_b(i)) for i in ids_b]).tolist()
        at_b = {e: k for k, e in enumerate(end_b)}
        links = [(k, at_b[e]) for k, e in enumerate(end_a) if e in at_b]
        groups, x, y = [], 0, 0
        for k, m in links:
            groups.append(",".join(map(str, ids_a[x:k + 1])) + "|" + ",".join(map(str, ids_b[y:m + 1])))
            x, y = k + 1, m + 1
        pairs = [(ids_a[k], ids_b[m]) for k, m in links]
        counts.update(pairs)
        out.append((doc, ids_a, ids_b, pairs, groups))
    best = collections.Counter()
    for (_, y), c in counts.items():
        best[y] = max(best[y], c)
    return [(doc, len(ia), len(ib), len(groups), len(pairs), sum(counts[p] == best[p[1]] for p in pairs),
             sum(counts[p] for p in pairs), ";".join(groups)) for doc, ia, ib, pairs, groups in out]


AWKWARD = [None, "", " ", "  ", "\n", "a", " a", "a ", "a  b   c ", "<|endoftext|>", "<s>x</s><unk>", "▁x", "x ▁ y", "<0x41>",
           "٣² 12ab漢字 é　x\x85y z", " wide", "👩‍👩‍👧‍👦 family", "tab\t\tend  ", "'s it's '", "é é ﬁ", "null\u0000byte",
           "漢" * 300, "a" * 3000, " " * 200, "x" + " " * 37 + "y"]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(13)
    letters = "abstre lvmdST'  \n\t12²é漢!?#$ñß"
    words = ["the", "tokenizer", "straße", "niño", "1984", "漢字", "don't", "Zürich,", "www.example.org/x", "ing", "\n", "—"]
    texts = AWKWARD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 90))) for _ in range(200)]
    texts += [" ".join(rnd.choices(words, k=rnd.randint(1, 60))) for _ in range(100)]
    texts.append(" ".join(rnd.choices(words, k=40_000)))  # a very long text
    return [(k, t) for k, t in enumerate(texts)] + [(3, "repeats an id"), (3, "repeats an id"), (None, "no id"), (None, "no id")]


@pytest.mark.parametrize("block_links", [token_alignment.BLOCK_LINKS, 300])
def test_groups_and_counts(make_docs, rows, block_links):
    got = token_alignment.align(make_docs(rows), PATH_A, PATH_B, block_links=block_links)
    assert sorted(map(repr, (tuple(r) for r in got.select(*COLUMNS).collect()))) == sorted(map(repr, plain(rows)))


def test_query_columns(spark, make_docs, rows):
    full = token_alignment.align(make_docs(rows), PATH_A, PATH_B).collect()
    short = token_alignment.align(make_docs(rows).repartition(5), PATH_A, PATH_B, with_groups=False).collect()
    assert sorted((str(r.doc_id), r.n_best, r.count_sum, brute.sha(r.groups.encode()) if r.groups else "") for r in full) == sorted(
        (str(r.doc_id), r.n_best, r.count_sum, r.groups_sha256) for r in short)
    assert token_alignment.align(make_docs([]), PATH_A, PATH_B).collect() == []


def test_cuts_at_every_kind_of_place():
    """Intervals whose only cuts are at one end, and without any."""
    rnd = random.Random(7)
    for _ in range(300):
        total = rnd.randint(1, 120)
        a = sorted({*rnd.sample(range(1, total + 1), rnd.randint(0, total)), total})
        b = sorted({*rnd.sample(range(1, total + 1), rnd.randint(0, total)), total})
        if rnd.random() < 0.4:
            cut = rnd.randint(1, total)
            b = sorted({x for x in b if x <= cut or x not in a} | {total})
        got = token_alignment.shared_cuts(np.array(a), np.array(b), np.array([0]), np.array([len(a) - 1]))
        assert [a[k] for k in got] == sorted(set(a) & set(b))
