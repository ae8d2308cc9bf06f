"""Strings of a regular build, and rows that repeat a doc_id or have none."""

import collections
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from recsmith.llm import ngram_join, quality_rules, substring_dedup, suffix_dedup  # noqa: E402
from recsmith.llm import textscan as ts  # noqa: E402


def thue_morse(bits, a="a", b="b"):
    """The pattern of 2**bits letters and its mirror: equal polynomials modulo 2**64."""
    word = "".join(a if bin(k).count("1") % 2 == 0 else b for k in range(1 << bits))
    return word, word.translate(str.maketrans(a + b, b + a))


@pytest.mark.parametrize("bits", [10, 12])
def test_regular_strings_have_different_hashes(bits):
    codes = np.array([[ord(c) for c in w] for w in thue_morse(bits)], dtype=np.uint32).ravel()
    n = 1 << bits
    values = ts.char_values(codes)
    at = (np.array([0, n]), np.array([n, 2 * n]))
    plain, strong = ts.span_hash(values, *at), ts.strong_hash(values, *at)
    assert plain[0] == plain[1] and strong[0] != strong[1]
    again = ts.strong_hash(np.concatenate([values[:5], values]), at[0] + 5, at[1] + 5)
    assert again.tolist() == strong.tolist()  # wherever it stands


def test_strong_hash_of_random_spans():
    rng = np.random.default_rng(1)
    values = ts.char_values(rng.integers(97, 100, 4000).astype(np.uint32))
    starts = rng.integers(0, 3900, 3000)
    ends = starts + rng.integers(0, 12, 3000)
    seen = {}
    for h, s, e in zip(ts.strong_hash(values, starts, ends).tolist(), starts.tolist(), ends.tolist(), strict=True):
        assert seen.setdefault(h, values[s:e].tolist()) == values[s:e].tolist()
    assert len(seen) == len({tuple(v) for v in seen.values()})


@pytest.mark.parametrize("bits", [10, 12])
def test_regular_words_lines_and_texts(make_docs, bits):
    one, other = thue_morse(bits)
    rows = [(1, "\n".join([one, other, one])), (2, f"{one} w1 w2 w3"), (3, f"{other} w1 w2 w3"), (4, one), (5, other), (6, one)]
    spaced = [" ".join(w) for w in thue_morse(bits)]  # one letter a word: equal texts of words for a weak hash
    rows += [(7, spaced[0]), (8, spaced[1])]
    docs = make_docs(rows)
    got = {r.doc_id: tuple(r[c] for c in quality_rules.COUNTS) for r in quality_rules.text_counts(docs.drop("n_words"), keep=["doc_id"]).collect()}
    assert got == {k: brute.counts(t) for k, t in rows}
    assert got[1][3] == 1
    want = {k: v for (k, _), v in zip(rows, brute.components(rows), strict=True)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs).collect()} == want
    assert want[4][1] == want[6][1] == 4 and want[5][1] == 5
    kept = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(docs, 400).collect()}
    assert [kept[k] for k, _ in rows] == brute.kept_bytes([t for _, t in rows], 400)
    lines = make_docs([(1, one + " a b c d e f g h"), (2, other + " a b c d e f g h"), (3, one + " a b c d e f g h")])
    assert {r.doc_id: r.n_removed for r in substring_dedup.dedup_units(lines, "line").collect()} == {1: 0, 2: 0, 3: 1}


def rows_that_stay(rows):
    """The rows that drop_near_duplicates keeps, as a counter of (doc_id, text)."""
    sets = [brute.shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups, out = collections.defaultdict(list), []
    for k, s in enumerate(sets):
        if s:
            groups[find(k)].append(k)
        else:
            out.append(rows[k])
    for members in groups.values():
        least = min((rows[k][0] is None, rows[k][0] or 0) for k in members)
        out.append([(None if least[0] else least[1]), {rows[k][1] for k in members if (rows[k][0] is None, rows[k][0] or 0) == least}])
    return out


A, Z = "one two three four five six seven eight nine ten", "red green blue black white grey pink brown teal gold"


@pytest.mark.parametrize("rows", [
    [(3, A), (5, A), (5, Z)],
    [(5, A), (5, A), (5, Z), (5, Z), (6, Z)],
    [(None, A), (None, A), (None, Z), (7, Z), (None, None), (None, ""), (8, " ")],
    [(1, A), (2, A + " x"), (2, Z + " y"), (None, A), (3, Z), (3, None), (3, None)],
    [(1, A), (1, A.replace(" ", "  ")), (1, A.upper())],
])
def test_no_row_is_lost_with_a_repeated_or_missing_id(make_docs, rows):
    got = [(r.doc_id, r.text) for r in ngram_join.drop_near_duplicates(make_docs(rows)).collect()]
    want = rows_that_stay(rows)
    assert len(got) == len(want)
    left = list(got)
    for w in want:
        fits = [g for g in left if (g == w if isinstance(w, tuple) else g[0] == w[0] and g[1] in w[1])]
        assert fits, w
        left.remove(fits[0])


def test_many_equal_rows_and_other_columns(spark):
    """A third of the rows alike; clashing and dotted columns come back as they were."""
    rows = [(9, A, k) for k in range(300)] + [(k, f"{Z} {k} a{k} b{k} c{k} d{k}", k) for k in range(10, 40)] + [(12, A + " and", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_c0.x` long").withColumn("cls", docs_literal()).withColumn("n", docs_literal())
    left = ngram_join.drop_near_duplicates(docs.repartition(6))
    assert left.columns == docs.columns
    got = left.collect()
    assert sum(r.doc_id == 9 for r in got) == 1 and sorted(r.doc_id for r in got if r.doc_id != 9) == list(range(10, 40))


def docs_literal():
    from pyspark.sql import functions as F
    return F.lit("clash")
