"""Operators 1, 2, 3, 6 and 10: round trips, brute force, planted signals."""

import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from recsmith.llm import bpe, language_id, pretokens, quality_classifier, token_files, url_filter  # noqa: E402
from recsmith.llm import textscan as ts  # noqa: E402
from recsmith.llm.common import scratch  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = ["", None, " ", "\n", "  \n x  ", "it's we'll I'd 'special ''s !'s '", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "a" * 3000,
           "٣² 12ab漢字 é\u3000x\x85y\u00a0z", "tab\t\tend  ", "!!!???...", "Ω≈ç√∫˜µ≤≥÷", "👩‍👩‍👧‍👦 family", "x" + " " * 500 + "y"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(6)
    letters = "abstre lvmdST' \n\t12²é漢!?#$\u3000"
    return AWKWARD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(600)]


@pytest.mark.parametrize("make", [bpe.encoder, token_files.library_encoder])
def test_encoders_equal_the_library(library, texts, make):
    enc, got, back = make(PATH), [], []
    for chunk in ts.chunks(pa.array(texts), limit=700):
        ids, ends, data, byte_ends = enc.encode(chunk)
        got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        back += [data[a:b].tobytes().decode() for a, b in zip(byte_ends[:-1], byte_ends[1:], strict=True)]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert got == want
    assert back == [library.decode(i, skip_special_tokens=False) for i in want] == [t or "" for t in texts]


def test_every_character_class(library):
    """One text with every character between a letter and a digit."""
    text = "".join(f"a{chr(c)}1 " for c in [*range(0x20, 0x3000, 3), *range(0xA000, 0xAC00, 5)] if c not in (0x3C, 0x7C))
    (chunk,) = ts.chunks(pa.array([text]))
    start = pretokens.split(chunk.codes, chunk.bounds)
    words = [text[a:b] for a, b in zip(start, [*start[1:], len(text)], strict=True)]
    want = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
    assert words == want


def test_equal_hashes_are_noticed(library):
    """A cache that takes two words for one must not change the result."""
    enc = pretokens.Encoder(pretokens.vocabulary(PATH), bpe.encoder(PATH).encode_words)
    (first,) = ts.chunks(pa.array(["alpha beta"]))
    enc.encode(first)
    (other,) = ts.chunks(pa.array(["gamma beta", "alpha"]))
    start = pretokens.split(other.codes, other.bounds)
    wrong = ts.span_hash(ts.char_values(other.codes), start, np.append(start[1:], len(other.codes)))
    enc.cache.clear()
    order = np.argsort(wrong)
    enc.cache.add(wrong[order], [[1]] * len(wrong))
    ids, ends, _, _ = enc.encode(other)
    assert ids[ends[0]:ends[1]].tolist() == library.encode("gamma beta").ids


def test_op6_digests(make_docs, library, texts):
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "no id"), (0, "repeats an id")]
    out = bpe.encode_decode(make_docs(rows), PATH, ["doc_id", "n_words"]).collect()
    want = {(i, brute.sha((t or "").encode())) for i, t in rows}
    assert {(r.doc_id, r.decoded_sha256) for r in out} == want and len(out) == len(rows)
    for r in out:
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == brute.sha(np.array(r.ids, dtype="<u4").tobytes())
    assert bpe.encode_decode(make_docs(rows).filter("doc_id > 9999"), PATH, ["doc_id"]).count() == 0


def test_op10_files(spark, make_docs, library, texts):
    rows = [(3 * k, t) for k, t in enumerate(texts)] + [(None, "no id"), (30, "repeats an id")]
    folder = scratch(spark)
    index = token_files.write_token_files(make_docs(rows).repartition(3), folder, PATH, length=64)
    out = sorted(token_files.read_documents(index).collect(), key=lambda r: r.start)
    assert [r.doc_id or -1 for r in out] == sorted(-1 if i is None else i for i, _ in rows) or out[0].doc_id is None
    at, known = 0, {}
    for i, t in rows:
        known.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [0])
    for r in out:
        crcs = {(len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for x in known[r.doc_id]}
        assert r.start == at and (r.n_tokens, r.ids_crc32) in crcs
        at += r.n_tokens
    for file in {r.file for r in index.collect()}:
        reader = token_files.SequenceReader(file)
        n = sum(reader.file.get_batch(b).num_rows for b in range(reader.file.num_record_batches))
        real = sum(sum(reader.sequence(k)[1].to_pylist()) for k in range(n))
        assert real == index.filter(F.col("file") == file).agg(F.sum("n_tokens")).first()[0]
        tokens, mask = reader.sequence(0)
        assert len(tokens) == len(mask) == 64 and not tokens.flags.owndata  # a view of the map
    empty = token_files.write_token_files(make_docs(rows).filter("doc_id > 99999"), scratch(spark), PATH)
    assert empty.count() == 0


URLS = ["https://a.b.Example.COM/en/1?q#f", "http://www.example.com/en/x.html", "http://x.net/es/", "http://net/fr/1", "http://x.net/e", "x.com/en/",
        None, "", "://", "http://com", "http://com/", "http://COM?x/y", "http://telecom/en/", "a://b://com/c", "http://x.net/en/#/fr/", "http://é.com/ü"]


def test_op1_contract_and_templates(spark):
    rows = [(k, u, "<p>") for k, u in enumerate(URLS)] + [(None, URLS[0], None)]
    rows += [(100 + k, f"http://bad.example.net/fr/{k}", "") for k in range(40)]           # labelled: blocked
    rows += [(200 + k, f"http://bad.example.net/blog/{k}.html", "") for k in range(40)]    # no labels of its own
    rows += [(300 + 100 * s + k, f"http://mixed.org/{'ab'[s]}/{k}", "") for k in range(40) for s in (0, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    out = url_filter.judge_urls(pages).collect()
    assert len(out) == len(rows)
    by_id = {}
    for r in out:
        by_id.setdefault(r.page_id, r)
    for i, u, _ in rows:
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host):]).group()
            host = host.translate(brute.LOWER)
        best = None
        for verdict, rule in url_filter.RULES:
            h, _, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
                best = (verdict, rule)
        r = by_id[i]
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        assert r.verdict == best[0] if best else r.verdict in ("allow", "block")
    assert by_id[100].template == "/fr/#" and by_id[100].purity > 0.8
    assert by_id[200].verdict == "allow" and by_id[200].template == "/blog/#.html"
    # another rule list: templates under mixed.org follow their labels, unlisted ones next to them too
    rules = (("block", "mixed.org/a/1"), ("block", "mixed.org/a/2"), ("block", "mixed.org/a/3"), ("allow", "mixed.org/b/"))
    judged = {r.url: r for r in url_filter.judge_urls(pages.drop("host"), rules).collect()}
    assert judged["http://mixed.org/a/4"].verdict == "block" and judged["http://mixed.org/b/4"].verdict == "allow"
    assert url_filter.judge_urls(pages.filter("page_id > 9999")).count() == 0


def test_op1_sections_do_not_hang_on_the_size_of_the_host(spark):
    """A section is judged alike on a small and on a large host, and unlisted
    sections never for the labels of others."""
    urls = [f"http://{h}.net/{s}/{k}" for h in ("small", "large") for s in ("es", "fr", "news") for k in range(12)]
    urls += [f"http://large.net/s{chr(97 + j // 26)}{chr(97 + j % 26)}/{k}" for j in range(120) for k in range(10)]
    urls += [f"http://tiny.net/{s}/{k}" for s in ("es", "fr") for k in range(7)] + ["http://tiny.net/blog/1"]  # all rare
    urls += [f"http://ok.com/{k}" for k in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r.url: r for r in url_filter.judge_urls(pages).collect()}
    for h in ("small", "large"):
        assert out[f"http://{h}.net/fr/1"].template == out[f"http://{h}.net/es/1"].template == "/+/#"
        assert out[f"http://{h}.net/news/1"].template == "/news/#"
    assert out["http://large.net/sab/1"].template == "/sab/#"
    assert all((r.verdict == "block") == ("/es/" in u or "/fr/" in u) for u, r in out.items())
    # a wildcard over many directories with labels still speaks for one without
    urls = [f"http://u.org/{chr(97 + j // 26)}{chr(97 + j % 26)}/x/{k}" for j in range(100) for k in range(2)]
    rules = [("block", f"u.org/{chr(97 + j // 26)}{chr(97 + j % 26)}/") for j in range(97)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert {r.verdict for r in url_filter.judge_urls(pages, rules).collect()} == {"block"}


def test_op1_paths_of_any_depth(spark):
    """Templates part where the labels do, below the fourth segment too."""
    urls = [f"http://deep.org/a/b/c/d/{s}/e/{k}" for s in ("bad", "good") for k in range(30)]
    rules = [("block", f"deep.org/a/b/c/d/bad/e/{k}") for k in range(1, 6)] + [("allow", "deep.org/a/b/c/d/good/")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = url_filter.judge_urls(pages, rules).collect()
    assert {r.template for r in out} == {"/a/b/c/d/bad/e/#", "/a/b/c/d/good/e/#"}
    assert all((r.verdict == "block") == ("/bad/" in r.url) for r in out)


def _labelled(rnd, n):
    good, bad = [f"g{k}" for k in range(300)], [f"b{k}$$" for k in range(300)]
    rows, labels = [], []
    for k in range(n):
        q = int(rnd.random() < 0.6)
        rows.append((k, " ".join(rnd.choice(good if q else bad) for _ in range(rnd.randint(20, 60)))))
        labels.append((k, q, 0))
    return rows, labels


def test_op2_recovers_a_planted_signal(spark, make_docs):
    rows, labels = _labelled(random.Random(2), 900)
    rows += [(5000, None), (5001, ""), (None, "g1 g2 g3 g4"), (5002, "g1 " * 20_000)]
    docs = make_docs(rows)
    lab = spark.createDataFrame([*labels, (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality_classifier.score_quality(docs, lab).collect()}
    assert len(out) == len(rows)
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in out.items() if r.held_out and i is not None and i < 5000} == set(held)
    assert np.mean([out[i].predicted == dict((a, b) for a, b, _ in labels)[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    # scores do not depend on held-out labels, lang or source, nor on the partitioning
    other = lab.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality_classifier.score_quality(
        docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string")).repartition(5), other).collect()}
    assert max(abs(again[i] - r.score) for i, r in out.items()) < 1e-9


def test_op2_without_labels(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality_classifier.score_quality(docs, lab).collect()] == [0.5, 0.5]
    assert quality_classifier.score_quality(docs.filter("doc_id > 5"), lab).count() == 0


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = (rng.random(3000) < 1 / (1 + np.exp(-3 * x[:, 0]))).astype(int)
    net = quality_classifier.fit(x, y)
    p = net.score(x)
    assert abs(p.mean() - y.mean()) < 0.05 and ((p > 0.5) == y).mean() > 0.8


def test_op3_fuses_evidence(spark, make_docs):
    rnd = random.Random(3)
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["und", "nicht", "straße"]}

    def text(lang, n=30):
        return " ".join(rnd.choice(words[lang]) for _ in range(n))

    docs = make_docs([(k, text("aa")) for k in range(30)], "aa").union(make_docs([(99 + k, text("bb")) for k in range(30)], "bb"))
    page = '<html lang="{}"><script>und nicht und</script><p>{}</p></html>'
    rows = [(k, f"http://x.site{k % 3}.aa/p", page.format("aa", text("aa"))) for k in range(40)]
    rows += [(100 + k, f"http://y.site{k % 3}.bb/p", page.format("bb", text("bb"))) for k in range(40)]
    rows += [(200, "http://y.site1.bb/q", page.format("bb", "")), (201, "http://y.site1.bb/q", None), (202, None, None),
             (203, None, page.format("aa", text("bb"))), (None, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lang", F.lit("clash"))
    out = {r.page_id: r for r in language_id.identify(pages, docs).collect()}
    assert len(out) == len(rows)
    assert all(out[k].lang == "aa" for k in range(40)) and all(out[100 + k].lang == "bb" for k in range(40))
    assert out[200].lang == out[201].lang == "bb" and out[201].text_lang is None  # host and suffix decide
    assert out[203].lang == "bb"  # the text outweighs the markup
    assert out[202].lang in ("aa", "bb") and out[202].confidence < 0.7
    assert language_id.identify(pages, docs.filter("doc_id > 999")).filter("lang is not null").count() == 0
    assert language_id.identify(pages.filter("page_id > 999"), docs).count() == 0
