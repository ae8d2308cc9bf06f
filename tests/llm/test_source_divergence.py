"""Operator 11 against plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from recsmith.llm import source_divergence as sd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_docs, top):
    """{(lang, source, part, item, value, rank)} of (text, lang, source) rows."""
    docs, count, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source, terms = lang or "", source or "", TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        docs.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
    out = set()
    for lang in {x for x, _ in groups}:
        kept = sorted(t for (x, t), n in docs.items() if x == lang and n >= min_docs)
        sources = sorted(s for x, s in groups if x == lang)

        def shares(amounts, v=len(kept)):
            total = sum(amounts)
            return [1 + 10 ** 9 * (c + 5) // (total + 5 * v) for c in amounts]

        own = {s: [count[lang, s, t] for t in kept] for s in sources}
        p = {s: shares(own[s]) for s in sources}
        q = shares([sum(own[s][k] for s in sources) for k in range(len(kept))])
        for s in sources:
            pairs = [(sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True)), o) for o in sources if o != s]
            terms = [(p[s][k] - q[k], t) for k, t in enumerate(kept) if own[s][k] and p[s][k] > q[k]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:top if part == "term" else None], 1)}
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    words = ["The", "the,", "(the)", "don't", "x-the-y", "Ünï", "ünï", "Ünï!", "12ab34", "—dash—", " wide　", "漢字", "𝔘x", "a1a2a", "77", "..."]
    out = []
    for k in range(400):
        lang, source = rnd.choice(["en", "de", None, ""]), rnd.choice(["a", "b", "c", "", None, "Z"])
        bag = words[:rnd.randint(3, len(words))] if source != "b" else words[5:]
        text = "".join(rnd.choice(bag) + rnd.choice([" ", "\n", "\t ", "\x0b", "\x0c\r"]) for _ in range(rnd.randint(0, 25)))
        out.append((rnd.choice(["", " "]) + text, lang, source))
    out += [(None, "en", "only null"), ("", "de", "only empty"), ("lonely words", "xx", "p"), ("", "xx", "q"), (None, None, None)]
    out += [("same row the the", "en", "a")] * 40
    out.append((" ".join(rnd.choices(words, k=30_000)), "en", "long"))
    return out


def made(spark, rows):
    return spark.createDataFrame([(k % 7, *r, "clash", "clash") for k, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, term string, block string")


@pytest.mark.parametrize("term_block,source_block,sizes", [(4096, 128, {}), (3, 2, {"block_words": 60, "bucket_bytes": 20_000, "fan_in": 4})])
def test_audit(spark, rows, term_block, source_block, sizes):
    docs = made(spark, rows).repartition(3)
    got = sd.audit(docs, 12, 4, term_block, source_block, **sizes).collect()
    want = plain(rows, 12, 4)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(r.part == "term" for r in got)


def test_nothing_kept_and_empty_table(spark, rows):
    got = {tuple(r) for r in sd.audit(made(spark, rows), min_docs=10_000).collect()}
    assert got == plain(rows, 10_000, 50) and all(r[4] == 0 for r in got)
    assert sd.audit(made(spark, [])).collect() == []


def test_large_counts_stay_exact(spark):
    df = spark.createDataFrame([(9_000_000_000_000, 10 ** 15, 10 ** 6)], "c long, n long, v long")
    got = df.select(sd._share(df.c, df.n, df.v).alias("p")).first().p
    assert got == 1 + 10 ** 9 * (9_000_000_000_000 + 5) // (10 ** 15 + 5 * 10 ** 6)


def test_packed_numbers():
    values = np.array([0, 1, 255, 256, 70_000, 2**32 - 1])
    assert sd._numbers(sd._planes(values)).tolist() == values.tolist()
    one = sd._packed(pa.array(["x"]), pa.array(["y"]), pa.array(["t", "u"]), np.array([0, 1]), np.array([0, 0]), np.array([2**40, 3]), np.array([5, 2**33]), 7, 1)
    *_, term, group, docs, count = sd._merged(pa.concat_tables([one, one]))
    assert docs.tolist() == [2**41, 6] and count.tolist() == [10, 2**34] and group.tolist() == [0, 0]


def test_chunks_are_counted_per_document():
    doc, code, times, chunks = sd._chunk_counts(pa.array([" a b a\n", "", "b"]))
    assert sorted((d, chunks[c].as_py(), n) for d, c, n in zip(doc.tolist(), code.tolist(), times.tolist(), strict=True)) == [(0, "a", 2), (0, "b", 1), (2, "b", 1)]
