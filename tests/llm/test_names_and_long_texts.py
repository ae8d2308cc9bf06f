"""Extra columns whose names clash or have dots, and very long texts."""

import random

import pytest
from pyspark.sql import functions as F

from recsmith.llm import decontaminate, language_id, ngram_join, quality_rules, source_divergence, toxicity, token_alignment, url_filter
from recsmith.llm.common import pick

ODD = ["_path", "_host", "_segments", "_listed", "Host", "a.b", "_text", "_suffix", "_domain", "_logp", "_declared_sums", "_found", "Text", "cls", "_c0", "_salt"]


def odd(df, but=()):
    return df.select("*", *[F.lit("clash").alias(c) for c in ODD if c not in but])


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://h{k % 3}.net/{'es' if k % 2 else 'xx'}/{k}/", f"<html lang='en'>the page {k} and the other") for k in range(40)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_pages(spark, pages, make_docs):
    docs = make_docs([(1, "the page and the other"), (2, "la casa y el perro")]).withColumn("lang", F.when(F.col("doc_id") == 1, "en").otherwise("es"))
    for plain, found in ((url_filter.judge_urls(pages), url_filter.judge_urls(odd(pages, ("Text",)))),
                         (language_id.identify(pages, docs), language_id.identify(odd(pages), odd(docs)))):
        names = [c for c in plain.columns]
        assert "a.b" in found.columns and "Host" not in found.columns
        assert sorted(map(tuple, plain.collect())) == sorted(tuple(r) for r in found.select(*[F.col(f"`{c}`") for c in names]).collect())
    none = pages.limit(0)
    assert url_filter.judge_urls(none).collect() == [] and language_id.identify(none, docs).collect() == []


def test_documents(spark, make_docs):
    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randint(60, 90))) for _ in range(30)]
    docs = make_docs(list(enumerate(texts)) + [(99, texts[3])]).drop("n_words")
    bench = spark.createDataFrame([(1, " ".join(texts[5].split()[10:24]))], "item_id long, text string")
    wide = odd(docs)
    for run in (lambda d: quality_rules.quality_filter(d), ngram_join.drop_near_duplicates,
                lambda d: decontaminate.decontaminate(d, odd(bench)), lambda d: decontaminate.decontaminate(d, bench, "spans")):
        out = run(wide)
        assert out.columns == wide.columns
        assert sorted(r.doc_id for r in run(docs).collect()) == sorted(r.doc_id for r in out.collect())
    labels = spark.createDataFrame([(k, 1, k % 2, "x") for k in range(30)], "doc_id long, quality int, toxic int, TOXIC string")
    for run in (lambda d: quality_rules.quality_counts(d), lambda d: ngram_join.ngram_components(d), lambda d: decontaminate.leak_report(d, bench),
                lambda d: toxicity.score_toxicity(d, labels), lambda d: source_divergence.audit(d, 5)):
        assert sorted(map(str, run(docs).collect())) == sorted(map(str, run(wide).collect()))


def test_pick_takes_the_very_name_first(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Text long, text long, `a.b` long")
    assert [tuple(r) for r in pick(df, "text", "a.b").collect()] == [(2, 3)]
    alone = spark.createDataFrame([(1,)], "Text long")  # df.select("Text") is ambiguous to Spark itself
    assert [tuple(r) for r in pick(alone, "text").collect()] == [(1,)]
    with pytest.raises(ValueError):
        pick(df, "nothing")


def test_blocks_of_a_benchmark_have_one_set_at_a_time(spark, make_docs, monkeypatch):
    rnd = random.Random(9)
    items = [(k, " ".join(f"v{rnd.randrange(10**6)}" for _ in range(14))) for k in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs([(k, "x " * 20 + items[k % 9][1] + " y") for k in range(27)] + [(50, "clean text")])
    made = []
    plain = decontaminate.written
    monkeypatch.setattr(decontaminate, "written", lambda df, *a: (made.append(df.columns), plain(df, *a))[1])
    one = sorted(map(str, decontaminate.leak_report(docs, bench).collect()))
    before = len(made)
    three = sorted(map(str, decontaminate.leak_report(docs, bench, block=16).collect()))
    assert one == three and sum("_found" in c for c in made[before:]) >= 2 and before == 1
    assert decontaminate.decontaminate(docs, bench, block=16).count() == 1


def test_very_long_texts(spark, make_docs):
    """One text of 200,000 words beside its near copy, in the scans that take whole texts."""
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(50_000)}" for _ in range(200_000)]
    near = list(words)
    near[100] = "changed"
    docs = make_docs([(1, " ".join(words)), (2, " ".join(near)), (3, "short text of its own")])
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert sorted(r.doc_id for r in ngram_join.drop_near_duplicates(docs).collect()) == [1, 3]
    counts = {r.doc_id: r.n_words for r in quality_rules.quality_counts(docs).collect()}
    assert counts == {1: 200_000, 2: 200_000, 3: 5}
    bench = spark.createDataFrame([(7, " ".join(words[150_000:150_012]))], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.leak_report(docs, bench).collect()} == {1: 12, 2: 12, 3: 0}
    page = spark.createDataFrame([(1, "http://a.de/x", "<p>" + " ".join(words)), (2, "http://a.de/" + "s/" * 300, None)], "page_id long, url string, html string")
    assert language_id.identify(page, docs).count() == 2 and url_filter.judge_urls(page).count() == 2


def test_ties_of_languages(spark, make_docs):
    docs = make_docs([(1, "same words here"), (2, "same words here")]).withColumn("lang", F.when(F.col("doc_id") == 1, "zz").otherwise("aa"))
    page = spark.createDataFrame([(1, None, "same words here")], "page_id long, url string, html string")
    assert [r.lang for r in language_id.identify(page, docs).collect()] == ["aa"]
