"""What op8_suffix_dedup removes is set by bytes, 400 of them, not by words."""

import hashlib
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from recsmith.llm import queries  # noqa: E402


def words(rnd, n_words, n_bytes):
    """`n_words` random words that take `n_bytes` bytes with the blanks between them."""
    sizes = [(n_bytes - n_words + 1) // n_words] * n_words
    sizes[-1] += n_bytes - n_words + 1 - sum(sizes)
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(k)) for k in sizes)


@pytest.mark.parametrize("n_words, n_bytes, gone", [(52, 322, 0), (60, 399, 0), (60, 400, 400), (90, 450, 450), (40, 400, 400)])
def test_a_passage_goes_from_400_bytes_on(spark, make_docs, tmp_path, n_words, n_bytes, gone):
    rnd = random.Random(n_bytes + n_words)
    passage = words(rnd, n_words, n_bytes)
    assert len(passage.split()) == n_words and len(passage.encode()) == n_bytes
    own = [words(rnd, 30, 200) for _ in range(6)]
    rows = [(1, f"{own[0]} A{passage}B {own[1]}"), (2, f"{own[2]} C{passage}D"),  # shared by two documents
            (3, f"{own[3]} {own[4]}"), (4, None), (5, "")]
    inside = words(rnd, n_words, n_bytes)
    rows.append((6, f"E{inside}F {own[5]} G{inside}H"))  # twice in one document, nowhere else
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_suffix_dedup(spark, str(tmp_path)).collect()}
    assert {k: (r.n_removed, r.n_spans) for k, r in got.items()} == {
        **{k: (gone, int(gone > 0)) for k in (1, 2)}, **{k: (0, 0) for k in (3, 4, 5)}, 6: (2 * gone, 2 * int(gone > 0))}
    for (k, text), kept in zip(rows, brute.kept_bytes([t for _, t in rows], 400), strict=True):
        assert (got[k].n_bytes, got[k].kept_sha256) == (len((text or "").encode()), hashlib.sha256(kept).hexdigest())
