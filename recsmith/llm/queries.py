"""Queries of the text operators: one for each operator, over whole tables,
with the DuckDB SQL for the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm import bpe, decontaminate, language_id, ngram_join, quality_classifier, quality_rules, source_divergence, substring_dedup, suffix_dedup, token_alignment, token_files, toxicity, url_filter
from recsmith.llm.common import scratch, table

QueryFn = Callable[[SparkSession, str], DataFrame]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "template", "purity", "verdict")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
    return found.select("page_id", "host", "declared", "text_lang", "lang", "confidence")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_counts(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def _op4_sql() -> str:
    def bucket(v: str) -> str:
        shift = f"greatest(0, length(bin({v})) - 6)"
        return f"({shift} * 32 + (({v}) >> {shift}))"

    def low(b: str) -> str:
        shift = f"greatest(0, (({b}) // 32) - 1)"
        return f"((({b}) - {shift} * 32)::BIGINT << {shift})"

    metrics = quality_rules.METRICS
    rates = ", ".join(f"({v[2]} * {v[0]}) // nullif({v[1]}, 0) AS {m}" for m, v in metrics.items())
    sketch = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS metric, {bucket(m)} AS b FROM rates WHERE NOT base_failed" for m in metrics)
    k, least_group = quality_rules.FENCE, quality_rules.MIN_GROUP

    def level(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""
    {name}r AS (SELECT {by}metric, b, count(*) AS c FROM sketch GROUP BY {by}metric, b),
    {name}w AS (SELECT *, sum(c) OVER (PARTITION BY {by}metric) AS total,
                       sum(c) OVER (PARTITION BY {by}metric ORDER BY b) AS upto FROM {name}r),
    {name} AS (SELECT {by}metric, any_value(total) AS total, {low('min(b) FILTER (4 * upto >= total)')} AS lo,
                      {low('min(b) FILTER (4 * upto >= 3 * total) + 1')} - 1 AS hi FROM {name}w GROUP BY {by}metric)"""

    def pick(x: str) -> str:
        return f"CASE WHEN o.total >= {least_group} THEN o.{x} WHEN l.total >= {least_group} THEN l.{x} ELSE c.{x} END"

    fits = " AND ".join(
        f"r.{m} BETWEEN max(CASE WHEN t.metric = '{m}' THEN {f't.lo - greatest({k} * (t.hi - t.lo), {v[3]})' if v[4] else '0'} END)"
        f" AND max(CASE WHEN t.metric = '{m}' THEN t.hi + greatest({k} * (t.hi - t.lo), {v[3]}) END)"
        for m, v in metrics.items())
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
    win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
    keyed AS (SELECT doc_id, i, list_slice(w, i, i + 2) AS k FROM win),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM keyed) WHERE c > 1),
    hit AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) v(o) GROUP BY doc_id),
    counts AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words,
                      coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                      (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
                      coalesce(hit.n, 0)::BIGINT AS n_repeat_words
               FROM d JOIN lines USING (doc_id) LEFT JOIN hit USING (doc_id)),
    rates AS (SELECT *, (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words) AS base_failed,
                     {rates} FROM counts),
    sketch AS ({sketch}), {level('own', 'lang, source')}, {level('lng', 'lang')}, {level('crp', '')},
    limits AS (SELECT o.lang, o.source, o.metric, {pick('lo')} AS lo, {pick('hi')} AS hi
               FROM own o JOIN lng l ON o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric
               JOIN crp c ON o.metric = c.metric),
    fit AS (SELECT r.doc_id, {fits} AS fits
            FROM rates r JOIN limits t ON r.lang IS NOT DISTINCT FROM t.lang AND r.source IS NOT DISTINCT FROM t.source
            WHERE NOT r.base_failed GROUP BY r.doc_id, {', '.join('r.' + m for m in metrics)})
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN base_failed THEN FALSE ELSE fits END AS kept
FROM rates r LEFT JOIN fit USING (doc_id)"""


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


OP5_SQL = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: list_slice(w, i, i + 3))
                                          WHEN len(w) > 0 THEN [w] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(min(r.b), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach r ON r.a = w.doc_id GROUP BY w.doc_id"""


def op6_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_decode(table(spark, sf_dir, "documents"), path, ["doc_id"], with_ids=False)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontaminate.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                         (F.col("n_hit") > 0).alias("contaminated"))


_OP7_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_OP7_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_OP7_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), {decontaminate.WINDOW}) AS size,
              unnest(list_transform(range(1, len(w) - least(len(w), {decontaminate.WINDOW}) + 2),
                                    lambda i: list_slice(w, i, i + least(len(w), {decontaminate.WINDOW}) - 1))) AS win FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM d, sizes WHERE len(w) >= size),
hits AS (SELECT doc_id, dw.size, i, item FROM dw JOIN bw ON list_slice(w, i, i + dw.size - 1) = win),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM hits),
np AS (SELECT doc_id, count(*) AS n FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(np.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(np.n, 0) > 0 AS contaminated
FROM d LEFT JOIN np USING (doc_id) LEFT JOIN it USING (doc_id)"""


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])
    return found.select("doc_id", "n_bytes", size.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"), "removed")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_units(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_units", "n_removed", "removed")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    index = token_files.write_token_files(table(spark, sf_dir, "documents"), scratch(spark), path)
    return token_files.read_documents(index)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


_SHARE = f"1 + ({source_divergence.SCALE}::HUGEINT * (c + {source_divergence.PRIOR})) // (n + {source_divergence.PRIOR} * v)"
OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{source_divergence.TERM}') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {source_divergence.MIN_DOCS}),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, {_SHARE.replace('(c +', '(coalesce(c.c, 0) +').replace('(n +', '(coalesce(n.n, 0) +')} AS p
         FROM g JOIN kept k USING (lang) JOIN sizes USING (lang)
         LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
         LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
whole AS (SELECT lang, term, {_SHARE} AS q
          FROM (SELECT lang, term, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY lang) AS n FROM c GROUP BY lang, term) JOIN sizes USING (lang)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM grid JOIN whole USING (lang, term) WHERE c > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
               FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= {source_divergence.TOP}"""


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return token_alignment.align(table(spark, sf_dir, "documents"), *paths, with_groups=False)


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_url_filter, op2_quality_classifier, op3_language_id, op4_quality_rules, op5_ngram_jaccard_join, op6_bpe_trie, op7_decontaminate, op8_suffix_dedup, op9_substring_dedup, op10_token_files,
    op11_source_divergence, op12_toxicity, op13_token_alignment,
)}
ORACLES: dict[str, str] = {"op4_quality_rules": _op4_sql(), "op5_ngram_jaccard_join": OP5_SQL, "op7_decontaminate": OP7_SQL,
                           "op11_source_divergence": OP11_SQL}
