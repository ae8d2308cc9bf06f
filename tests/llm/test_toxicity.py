"""Operator 12: folding, matching, what the lexicon learns, held-out labels."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from recsmith.llm import textscan as ts  # noqa: E402
from recsmith.llm import toxicity as tx  # noqa: E402

CALM = "stone river light garden window bread paper music winter market letter bridge silver number story".split()
MEAN = ["vilebrute", "grubworm"]


@pytest.mark.parametrize("text,words", [
    ("Idiot!", ["idiot"]), ("1d10t", ["idiot"]), ("іdіоt", ["idiot"]), ("ＩＤＩＯＴ", ["idiot"]), ("i​d­iot", ["idiot"]), ("ídïôt", ["idiot"]),
    ("$tup1d a$$ @larm", ["stupid", "ass", "aiarm"]), ("id!ot wow!", ["idiot", "wow"]), ("1984 7 2nd $5 $$", ["znd"]), ("", []), (" ... ", []),
    ("loser L0SER", ["ioser", "ioser"]), ("漢字 Straße", ["漢字", "strase"]), ("x+y a|b", ["xty", "aib"]), ("𝐢𝐝𝐢𝐨𝐭", ["idiot"]),
])
def test_folding(text, words):
    assert tx.folded_words(text).split() == words


def test_folding_keeps_documents_apart():
    texts = ["a1", None, "", "$b", "c$", "!", "d" * 5000]
    (chunk,) = ts.chunks(pa.array(texts))
    words = tx.fold(chunk.codes, chunk.bounds)
    assert [words.text(k) for k in range(chunk.n)] == [" ai ", "", "", " sb ", " cs ", "", " " + "d" * 5000 + " "]


def plain_hits(model, text):
    words = text.split()
    out = []
    for k, word in enumerate(words):
        fits = [e for e, _, _ in model.weights if (" " + word).startswith(e)]
        around = [f" {' '.join(words[k + a:k + b])} " for a, b in ((-1, 1), (0, 2)) if k + a >= 0 and k + b <= len(words)]
        if fits and not any(p in model.exceptions for p in around):
            out += fits
    return out


def test_matching_against_plain_search():
    rnd = random.Random(12)
    model = tx.Model(((" vieb", 3.0, 1.0), (" viex", 2.0, 0.5), (" grub", 1.5, 0.0)), (" grub hub ", " the viexy ", " hub vieb ", " grub grub "))
    words = ["viexy", "viebrute", "vieb", "grub", "grubs", "hub", "the", "x"]
    for _ in range(500):
        text = "".join(f" {rnd.choice(words)}" for _ in range(rnd.randint(0, 12))) + " "
        assert [e for _, e in tx.hits(model, text)] == plain_hits(model, text)


def test_measures():
    model = tx.Model(((" bad", 2.0, 1.0), (" worse", 3.0, 0.5)))
    (chunk,) = ts.chunks(pa.array(["bad day", "bad bad badly worse x y z u v w", "fine", None]))
    measures, n, entries = tx.scan_texts(model, chunk)
    assert measures.tolist() == [[2.0, 1.0], [6.0, 0.7], [0.0, 0.0], [0.0, 0.0]]
    assert n.tolist() == [2, 10, 1, 0] and entries[1] == [" bad", " bad", " bad", " worse"]


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text, toxic): insults of two stems, written in several ways, in
    toxic documents; clean ones use one of them in a harmless phrase."""
    rnd = random.Random(5)
    rows = []
    for k in range(1600):
        words = rnd.choices(CALM, k=rnd.randint(5, 60))
        toxic = int(k % 5 == 2)
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                words.insert(rnd.randint(0, len(words)), rnd.choice(MEAN) + rnd.choice(["", "s", "ly", "x"]))
        elif k % 40 == 1:
            words.insert(rnd.randint(0, len(words)), "hungry grubworm")
        rows.append((k, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def tables(spark, corpus):
    docs = spark.createDataFrame([(k, t, "en", "s", len(t), "clash") for k, t, _ in corpus],
                                 "doc_id long, text string, lang string, source string, n_chars long, score string")
    return docs, spark.createDataFrame([(k, 1, t) for k, _, t in corpus], "doc_id long, quality int, toxic int")


def test_lexicon_exceptions_and_scores(spark, tables, corpus):
    docs, labels = tables
    model = tx.fit(tx.written(tx.labelled(docs, labels)))
    entries = {e for e, _, _ in model.weights}
    assert entries == {" " + tx.folded_words(m).strip()[:tx.LONGEST] for m in MEAN}
    assert model.exceptions == (tx.folded_words("hungry grubworm"),)
    got = {r.doc_id: r for r in tx.score_toxicity(docs, labels).collect()}
    assert len(got) == len(corpus) and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    assert all(got[k].predicted == t for k, _, t in corpus)
    extra = docs.sparkSession.createDataFrame(
        [(None, "V1LEBRUT3 paper", "x"), (1, "a hungrу grubwоrm", "x"), (1, "grübwörm", "x"), (2, None, "x"), (3, "", "x"), (4, "stone vilebrute " * 30_000, "x"),
         (4, "vilebrute " + "stone " * 20_000, "x")], "doc_id long, text string, hits string")
    rows = [(r.doc_id, r.predicted, len(r.hits)) for r in tx.score(extra, model).selectExpr("*", "cast(score >= 0.5 as int) predicted").collect()]
    assert rows[:6] == [(None, 1, 1), (1, 0, 0), (1, 1, 1), (2, 0, 0), (3, 0, 0), (4, 1, 30_000)]
    assert rows[6][2] == 1  # one insult in a very long text is found; its weight is shared by the length


def test_held_out_labels_are_not_read(tables):
    docs, labels = tables
    spoilt = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) toxic")
    a, b = (sorted(tuple(r) for r in tx.score_toxicity(docs, x).select("doc_id", "score").collect()) for x in (labels, spoilt))
    assert a == b


def test_scores_do_not_depend_on_partitions(tables):
    docs, labels = tables
    a, b = (sorted(tuple(r) for r in tx.score_toxicity(d, labels).select("doc_id", "score").collect()) for d in (docs, docs.repartition(7)))
    assert a == b


def test_labels_of_one_kind_none_and_ties(spark, tables):
    docs, labels = tables
    none = tx.score_toxicity(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    clean = [r.score for r in tx.score_toxicity(docs, labels.selectExpr("doc_id", "quality", "0 toxic")).select("score").distinct().collect()]
    assert len(clean) == 1 and clean[0] < 0.01
    assert tx.score_toxicity(docs.limit(0), labels).collect() == []
    twice = labels.union(labels.selectExpr("doc_id", "quality", "1 - toxic")).filter("doc_id = 0 or doc_id = 1")
    assert {r.toxic for r in tx.labelled(docs, twice).collect()} <= {1}


def test_entries_are_no_continuations_of_each_other():
    counts = [(" bad", 90, 2), (" badg", 40, 0), (" ba", 95, 60), (" badger", 2, 50), (" bad ", 30, 0), (" the", 100, 900), (" worse", 60, 0),
              (" often", 50, 90), (" often\t", 45, 1), (" ofte", 50, 95), (" bad\t", 60, 0)]
    found = {e: (one, more) for e, one, more in tx.choose_entries(counts, 100, 100, 1000)}
    assert set(found) == {" bad", " worse", " often"} and all(one > 0 for one, _ in found.values())
    assert found[" worse"][1] == 0 and found[" often"][1] > found[" often"][0] > 0


def test_curve_falls_back_gently():
    assert np.allclose(tx.fit_curve(np.zeros((10, 2)), np.array([0, 1] * 5)), 0, atol=1e-6)
    measures = np.array([[0.0, 0.0]] * 50 + [[3.0, 0.2]] * 50)
    low, held, density = tx.fit_curve(measures, np.array([0] * 50 + [1] * 50))
    assert low < -2 and held >= 0 and density >= 0 and held + density > 2
    assert tx.fit_curve(measures, np.array([1] * 50 + [0] * 50))[1:] == (0.0, 0.0)
