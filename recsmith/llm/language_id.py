"""Language identification by Bayesian evidence fusion (operator 3).

A page's language is the one of greatest posterior given four kinds of
evidence, taken as independent given the language:

* the text: likelihood of its character trigrams under a model of each
  language, counted over all labelled documents, tempered because neighbouring
  trigrams depend on each other;
* the language that the markup declares;
* the address suffix (last label of the host);
* the host: a prior smoothed by its domain (last two labels), which is smoothed
  by the corpus.

The last three are estimated from the corpus itself: the posteriors by text
alone are added up by grouped aggregation over (language, declared), (language,
suffix), host and domain. A page's own share is taken out of its host and
domain before they speak for it. Posteriors are added as integers (millionths),
so the sums do not depend on the partitioning.

Defined results: null or empty html or url is missing evidence and leaves the
rest to decide; without any evidence the corpus' commonest language is given;
without labelled documents lang is null; null page_ids and repeated rows are
judged one by one; of languages with equal posteriors the first in the alphabet
is given; a very long page is scanned on its own; an empty table gives no rows;
output columns replace input columns of the same name, whatever its case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.llm import textscan as ts
from recsmith.llm.blocks import as_blocks, summed
from recsmith.llm.common import by_place, lookup_join, pick, place_of, written

#: Trigram hash values; smoothing of their counts; weight of a trigram.
GRAMS, SMOOTH, TEMPER = 1 << 14, 0.5, 0.25
#: Pages that a host's domain, and a domain's corpus, weigh.
HOST_WEIGHT, DOMAIN_WEIGHT = 5.0, 20.0
ONE = 1_000_000

_TAGS = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-zA-Z#0-9]+;"
_DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)"


def grams(chunk: ts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(position, trigram) of the trigrams that lie in one text."""
    codes = ts.lower_ascii(chunk.codes).astype(np.int64)
    codes[(codes < 65) | ((codes > 90) & (codes < 97)) | ((codes > 122) & (codes < 192))] = 32  # no letters
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = ((codes[:-2] * 8191 + codes[1:-1]) * 8191 + codes[2:]) * 0x9E3779B1 >> 13
    last = np.repeat(chunk.bounds[1:], np.diff(chunk.bounds))[:len(gram)] - 2
    at = np.arange(len(gram))
    keep = (at < last) & (codes[1:-1] != 32)
    return at[keep], gram[keep] % GRAMS


def gram_counts(docs: DataFrame, languages: list[str]) -> np.ndarray:
    """(language x trigram) counts over all documents with a language."""
    place = {l: i for i, l in enumerate(languages)}

    def count(batches):
        total = np.zeros(len(languages) * GRAMS, dtype=np.int64)
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for chunk in ts.chunks(batch.column(0)):
                at, gram = grams(chunk)
                row = np.array([place[l] for l in langs[chunk.row:chunk.row + chunk.n]], dtype=np.int64)
                total += np.bincount(row[chunk.doc_of(at)] * GRAMS + gram, minlength=len(total))
        yield as_blocks(total)

    parts = docs.filter("lang is not null").select("text", "lang").mapInArrow(count, "block int, data binary")
    return summed(parts, len(languages) * GRAMS, 1).reshape(len(languages), GRAMS)


def _text_posteriors(pages: DataFrame, keep: list[str], logs: np.ndarray) -> DataFrame:
    """`keep` and logp: the tempered log likelihood for each language."""
    shared = pages.sparkSession.sparkContext.broadcast(logs)  # languages x GRAMS
    schema = T.StructType([*pages.select(*[F.col(f"`{c}`") for c in keep]).schema, T.StructField("_logp", T.ArrayType(T.DoubleType()))])

    def score(batches):
        table = shared.value
        for batch in batches:
            for chunk in ts.chunks(batch.column(len(keep))):
                at, gram = grams(chunk)
                first = np.searchsorted(at, chunk.bounds)
                out = np.zeros((chunk.n, len(table)))
                for l, row in enumerate(table):
                    total = np.concatenate([[0.0], np.cumsum(row[gram])])
                    out[:, l] = TEMPER * (total[first[1:]] - total[first[:-1]])
                offsets = pa.array(np.arange(chunk.n + 1, dtype=np.int32) * len(table))
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(chunk.row, chunk.n) for i in range(len(keep))],
                                                  pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], names=schema.names)

    return pages.select(*[F.col(f"`{c}`") for c in keep], "_text").mapInArrow(score, schema)


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda s, y: s + y))


def _sums(pages: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Shares (millionths) of each language added up over `keys`."""
    return pages.groupBy(*keys).agg(F.array(*[F.sum(F.col("_share")[i]) for i in range(n)]).alias("sums"))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """`pages` (its columns but html) with host, declared, text_lang, lang and
    confidence."""
    docs = pick(docs, "text", "lang")
    languages = sorted(r.lang for r in docs.select("lang").filter("lang is not null").distinct().collect())
    added = ("host", "declared", "text_lang", "lang", "confidence")
    places = [i for i, c in enumerate(pages.columns) if c.lower() not in (*added, "html")]
    side, names = by_place(pages), pages.columns  # inside, the input's names clash with nothing
    keep = [f"_c{i}" for i in places]
    url, html = (F.col(f"_c{place_of(pages, c)}") for c in ("url", "html"))
    shown = [F.col(f"_c{i}").alias(names[i]) for i in places]
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://([^/?#:]*)", 1))
    base = side.select(*keep, host.alias("host"),
                        F.substring_index(host, ".", -1).alias("_suffix"), F.substring_index(host, ".", -2).alias("_domain"),
                        F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), _DECLARED, 1)).alias("declared"),
                        F.regexp_replace(F.coalesce(html, F.lit("")), _TAGS, " ").alias("_text"))
    n = len(languages)
    if n == 0:
        return base.select(*shown, "host", "declared", *[F.lit(None).cast(t).alias(c) for c, t in
                                                        (("text_lang", "string"), ("lang", "string"), ("confidence", "double"))])
    counts = gram_counts(docs, languages).astype(np.float64) + SMOOTH
    logs = np.log(counts / counts.sum(axis=1, keepdims=True))
    texts = _text_posteriors(base, [c for c in base.columns if c != "_text"], logs - logs.mean(axis=0))
    texts = written(texts.withColumn("_share", F.transform(_softmax(F.col("_logp")), lambda x: F.round(x * ONE).cast("long"))))

    # evidence from the whole corpus
    whole = _sums(texts, [], n).first()
    total = [float(x or 0) / ONE for x in (whole.sums if whole.sums is not None else [0] * n)]
    corpus = [(t + 1) / (sum(total) + n) for t in total]
    declared = written(_sums(texts.filter("declared != ''"), ["declared"], n).withColumnRenamed("sums", "_declared_sums"))
    suffix = written(_sums(texts.filter("_suffix != ''"), ["_suffix"], n).withColumnRenamed("sums", "_suffix_sums"))
    hosts = written(_sums(texts, ["host"], n).withColumnRenamed("sums", "_host_sums"))
    domains = written(_sums(texts, ["_domain"], n).withColumnRenamed("sums", "_domain_sums"))
    kinds = {"declared": declared.count(), "_suffix": suffix.count()}
    joined = texts
    for part, key in ((declared, "declared"), (suffix, "_suffix"), (hosts, "host"), (domains, "_domain")):
        joined = lookup_join(joined, part, [key], F.xxhash64(url))

    def others(column: str, i: int) -> Column:
        """Pages of language i behind a key, without the page itself."""
        return F.coalesce(F.col(column)[i] - F.col("_share")[i], F.lit(0)) / ONE

    def all_others(column: str) -> Column:
        return sum((others(column, i) for i in range(1, n)), others(column, 0))

    fused = []
    for i in range(n):
        domain = (others("_domain_sums", i) + DOMAIN_WEIGHT * corpus[i]) / (all_others("_domain_sums") + DOMAIN_WEIGHT)
        prior = (others("_host_sums", i) + HOST_WEIGHT * domain) / (all_others("_host_sums") + HOST_WEIGHT)
        value = F.col("_logp")[i] + F.log(prior)
        for column, key in (("_declared_sums", "declared"), ("_suffix_sums", "_suffix")):
            seen = (others(column, i) + 0.5) / (total[i] + 0.5 * (kinds[key] + 1))
            value = value + F.when(F.col(key) != "", F.log(seen)).otherwise(F.lit(0.0))
        fused.append(value)
    tongues = F.array(*[F.lit(l) for l in languages])

    def best(column: Column) -> Column:
        return F.element_at(tongues, F.array_position(column, F.array_max(column)).cast("int"))

    out = joined.withColumn("_post", _softmax(F.array(*fused)))
    return out.select(*shown, "host", "declared",
                      F.when(F.array_max("_logp") > F.array_min("_logp"), best(F.col("_logp"))).alias("text_lang"),
                      best(F.col("_post")).alias("lang"), F.round(F.array_max("_post"), 6).alias("confidence"))


