"""Operators 4, 5, 7, 8 and 9 against plain Python on awkward tables."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from recsmith.llm import decontaminate, ngram_join, quality_rules, substring_dedup, suffix_dedup  # noqa: E402

EDGE = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two three"), (6, "ONE two\x0bthree"), (None, "no id here at all ok"),
        (None, "no id here at all ok"), (7, "tie tie tie tie tie tie"), (7, "tie tie tie tie tie tie"), (8, "ünï çödé 漢字 тест ünï çödé 漢字 тест")]


def _words(rnd, n, vocabulary=4000):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def _family(rnd, first, count, size, edits):
    """Documents edited from one base, up to `edits` words each."""
    base = _words(rnd, size)
    rows = []
    for k in range(count):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(size)] = f"x{rnd.randrange(40)}"
        rows.append((first + k, " ".join(w)))
    return rows


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(4)
    rows = list(EDGE)
    rows += _family(rnd, 100, 60, 80, 6)          # a large group of near copies
    rows += _family(rnd, 300, 12, 30, 2)
    line = " ".join(_words(rnd, 12))
    rows += [(400 + k, line + "\n" + " ".join(_words(rnd, rnd.randint(5, 60)))) for k in range(30)]  # a common line
    copy = " ".join(_words(rnd, 50))
    rows += [(500 + k, copy) for k in range(25)]  # exact copies
    rows.append((600, " ".join(_words(rnd, 30_000))))  # a very long text
    return rows


def test_counts(make_docs, corpus):
    got = {(r.doc_id, r._text): tuple(r[c] for c in quality_rules.COUNTS)
           for r in quality_rules.text_counts(make_docs(corpus).withColumn("_text", F.col("text")), keep=["doc_id", "_text"]).collect()}
    assert got == {(i, t): brute.counts(t) for i, t in corpus}


def test_bucket_bounds(spark):
    df = spark.range(0, 70_000, 7).select(F.col("id"), quality_rules.bucket(F.col("id")).alias("b"))
    df = df.withColumn("low", quality_rules.bucket_low(F.col("b"))).withColumn("high", quality_rules.bucket_low(F.col("b") + 1))
    assert df.filter("id < low or id >= high or high - low > greatest(1, low / 32)").count() == 0


def test_sketches_merge(make_docs, corpus):
    counts = quality_rules.text_counts(make_docs(corpus), keep=["doc_id", "lang", "source"])
    whole = quality_rules.sketches(counts)
    parts = quality_rules.sketches(counts.filter("doc_id % 2 = 0")).union(
        quality_rules.sketches(counts.filter("doc_id is null or doc_id % 2 != 0")))
    merged = parts.groupBy("lang", "source", "metric", "bucket").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))


def test_rules_reject_outliers_and_keep_null_groups(spark, make_docs):
    rnd = random.Random(1)
    fine = [(k, " ".join(_words(rnd, 80))) for k in range(300)]
    odd = [(1000 + k, " ".join(w + "###$$$" for w in _words(rnd, 80))) for k in range(5)]
    docs = make_docs(fine + odd).withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise("s").cast("string"))
    judged = {r.doc_id: r.kept for r in quality_rules.quality_counts(docs).collect()}
    assert all(judged[i] for i, _ in fine) and not any(judged[i] for i, _ in odd)
    kept = quality_rules.quality_filter(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in fine}
    assert {r.n_words for r in kept.collect()} == {"clash"}


def test_components(make_docs, corpus):
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id or -1) for r in
                 ngram_join.ngram_components(make_docs(corpus)).collect())
    want = sorted((i is None, i, n, c or -1) for (i, _), (n, c) in zip(corpus, brute.components(corpus), strict=True))
    assert [g[1:] for g in got if not g[0]] == [w[1:] for w in want if not w[0]]
    assert [g[2:] for g in got if g[0]] == [w[2:] for w in want if w[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_families(make_docs, seed):
    rnd = random.Random(seed)
    rows = []
    for k in range(12):
        rows += _family(rnd, 1000 * k, rnd.randint(2, 40), rnd.randint(6, 70), rnd.randint(1, 8))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(make_docs(rows)).collect()}
    assert got == {i: x for (i, _), x in zip(rows, brute.components(rows), strict=True)}


def test_near_duplicates_drop_to_one(make_docs, corpus):
    docs = make_docs(corpus)
    left = ngram_join.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert [i for i in ids if i is not None and 500 <= i < 600] == [500] and ids.count(None) == 1  # one group of rows without an id


def test_empty_tables(make_docs):
    empty = make_docs([(1, "x")]).filter("doc_id > 5")
    assert ngram_join.ngram_components(empty).count() == 0
    assert quality_rules.quality_counts(empty).count() == 0
    assert quality_rules.quality_filter(empty).count() == 0


ITEMS = [(1, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "only three words"), (3, None), (4, "  ... "),
         (None, "nameless item of five words"), (10, "alpha BETA gamma delta epsilon zeta eta theta iota kappa")]


@pytest.fixture(scope="module")
def leaked():
    return [*EDGE, (50, "x " * 30 + ITEMS[0][1].upper() + " y" * 5), (51, "so only -- three\nwords it is, only three wordsx"),
            (52, "alpha beta gamma delta epsilon zeta eta theta iota KAPPA"), (53, "nameless item of five words"),
            (54, "alpha beta gamma delta epsilon zeta eta theta iota")]


@pytest.mark.parametrize("block", [200_000, 2])
def test_leaks(spark, make_docs, leaked, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit, list(r["items"])) for r in
                 decontaminate.leak_report(make_docs(leaked), bench, block=block).collect())
    want = sorted((i or -1, n, len(hit), names) for i, t in leaked for n, hit, names in [brute.leaks(t, ITEMS)])
    assert got == want


def test_decontaminate_spans_and_documents(spark, make_docs, leaked):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make_docs(leaked)
    whole = decontaminate.decontaminate(docs, bench)
    assert whole.columns == docs.columns and not {50, 51, 52, 53} & {r.doc_id for r in whole.collect()}
    cut = {r.doc_id: r for r in decontaminate.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[53].text == "" and cut[54].text == leaked[-1][1] and cut[50].n_chars == len(cut[50].text)
    assert brute.leaks(cut[50].text, ITEMS)[1] == set()
    none = bench.filter("item_id > 99")
    assert decontaminate.leak_report(docs, none).filter("n_hit > 0").count() == 0


@pytest.mark.parametrize("split", [4096, 2])
def test_suffix_dedup(make_docs, split):
    rnd = random.Random(split)
    passage = "".join(rnd.choice("abcdé ") for _ in range(200))
    rows = list(EDGE)
    for k in range(40):
        a = rnd.randrange(100)
        rows.append((100 + k, "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(0, 120))) + passage[a:a + rnd.randint(0, 100)]
                     + "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 40)))))
    rows += [(200, "a" * 300), (201, rows[-1][1])]
    got = sorted((r.doc_id or -1, bytes(r.kept), r.n_bytes) for r in
                 suffix_dedup.remove_repeats(make_docs(rows), length=40, split=split).collect())
    want = sorted((i or -1, k, len((t or "").encode())) for (i, t), k in zip(rows, brute.kept_bytes([t for _, t in rows], 40), strict=True))
    assert got == want


def test_line_dedup(make_docs):
    line = "This very line of ten words stands in three documents."
    rows = [(3, f"Own words of document three stand here first.\n{line}"), (1, f"{line}\nSome more words of document number one, not short."),
            (2, f"Short. {line.upper()}  Tail sentence of document two that is its own."), (5, line), (5, line), (None, line), (6, None), (7, "")]
    docs = make_docs(rows)
    for unit in ("line", "piece"):
        out = substring_dedup.dedup_units(docs, unit=unit).collect()
        text = {r.doc_id: r.text for r in out}
        assert text[1] == rows[1][1] and line not in text[3] and text[None] == "" and text[6] is None and text[7] == ""
        for r in out:
            source = dict(rows).get(r.doc_id)
            if source:
                assert "".join(c for k, c in enumerate(source) if not any(a <= k < b for a, b in r.removed)) == r.text
    assert line.upper() in substring_dedup.dedup_units(docs, unit="line").filter("doc_id = 2").first().text
    left = substring_dedup.dedup_filter(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {1, 2, 3, 6, 7}
    assert all(r.n_chars == len(r.text) for r in left.filter("doc_id in (1, 2, 3)").collect())
    assert substring_dedup.dedup_filter(docs.filter("doc_id > 99")).count() == 0
    assert suffix_dedup.remove_repeats(docs.filter("doc_id > 99")).count() == 0


def test_op9_passages_inside_longer_lines(make_docs):
    """Repeated passages of 50 words go but for a few words at their ends, in
    mid-sentence, without punctuation, in short sentences and without spaces;
    every word stays somewhere."""
    rnd = random.Random(12)
    plain = [" ".join(_words(rnd, 50, 10 ** 6)) for _ in range(40)]
    short = [". ".join(" ".join(_words(rnd, 3, 10 ** 6)) for _ in range(17)) + ".\u201d" for _ in range(20)]
    unspaced = ["".join(chr(rnd.randrange(0x4E00, 0x9F00)) for _ in range(50)) + "\u3002" for _ in range(20)]
    passages, rows = plain + short + unspaced, []
    for copy in range(3):
        for k, p in enumerate(passages):
            glue = "" if k >= 60 else " "
            around = [glue.join(_words(rnd, 10 + rnd.randrange(20), 10 ** 6)) for _ in range(2)]
            rows.append((1000 * copy + k, glue.join([around[0], p, around[1]])))
    rows.append((9000, "la di da " * 2000 + "end"))
    out = {r.doc_id: r for r in substring_dedup.dedup_units(make_docs(rows)).collect()}
    for i, text in rows:
        gone = "".join(text[a:b] for a, b in out[i].removed)
        if i < 1000:
            assert out[i].text == text
        elif i < 9000:
            passage = passages[i % 1000]
            assert gone.strip() in passage and 2 * len(gone) > len(passage)
    assert 0 < len(out[9000].text) < 1000
