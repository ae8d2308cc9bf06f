"""URL filter by a path-template tree (operator 1).

Listed rules (host and path prefix, allow or block) decide the urls they fit;
the urls they judge are the labels from which the rest is judged:

1. Tree: the path segments of each host, level by level, as deep as the paths
   go. A segment value stays literal under its node if LITERAL_URLS urls repeat
   it there, on small and large hosts alike; every other value becomes a
   wildcard, `#` in place of digits or `*`.
2. Merging: from the deepest level up, the literal branches of a node whose
   labelled share of blocked paths does not differ from that of all its branches
   by more than Z standard errors become one branch, `+`; a branch without
   labelled paths is similar to none.
3. Purity: the blocked share of the distinct paths of a template. Paths without
   a label, and WEIGHT more, count with the overall share (one half at most), so
   that a template needs many labels of its own to be rejected.
4. Branches: a path under a template of high purity is rejected if the labels of
   its own directory (the path without its last segment) say so. Without labels
   there, as in an unlisted section among the rare ones that share a `*`, the
   blocked share of the template's directories must be as high. All other paths
   are allowed.

Urls are aggregated to (host, segments) first; levels, merges and purities are
grouped sums that combine before the shuffle, and every join back is between
plain tables, so a host with a third of all urls is split by adaptive execution.

Defined results: a null url, or one without `://`, has an empty host and path
and is judged like any other host; null page_ids and repeated rows are judged
one by one, and count as many times in the tree; equal shares of two branches
merge; a very long path has as many levels as segments; an empty table gives no
rows; output columns replace input columns of the same name, whatever its case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.llm.common import by_place, place_of, written

# Fixed values of the contract: verdict and rule.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Urls that keep a value literal.
LITERAL_URLS = 8
#: Standard errors within which branches count as similar.
Z = 1.96
#: Weight of the overall share in the smoothing, and the purity that rejects.
WEIGHT = 5.0
REJECT = 0.8


def parse(url: Column) -> tuple[Column, Column]:
    """(host, path) by the contract's cuts."""
    known = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (F.when(known, F.translate(host, upper, lower)).otherwise(F.lit("")),
            F.when(known, path).otherwise(F.lit("")))


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        rule_host, _, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _wildcard(segment: Column) -> Column:
    return (F.when(segment == "", F.lit(""))
            .when(segment.rlike("[0-9]"), F.regexp_replace(F.regexp_replace(segment, "[0-9]+", "#"), "[^#.]+(?=.*#)", "*"))
            .otherwise(F.lit("*")))


def _tail(column: str, i: int) -> Column:
    """Entries i.. (from 1) of an array."""
    return F.slice(column, i, F.greatest(F.size(column) - (i - 1), F.lit(0)))


def templates(paths: DataFrame) -> DataFrame:
    """`paths` (host, segments, urls, labelled, blocked) with `t`: the template,
    literal values marked by `=`. Ends when no node has enough urls left for a
    literal value below it."""
    current, i = paths.withColumn("t", F.array().cast("array<string>")), 0
    while True:
        i += 1
        value = F.get("segments", F.lit(i - 1))
        deep = F.size("segments") >= i
        values = written(current.filter(deep).groupBy("host", "t", value.alias("value")).agg(F.sum("urls").alias("n")))
        if values.groupBy("host", "t").agg(F.sum("n").alias("n")).filter(F.col("n") >= LITERAL_URLS).isEmpty():
            return written(current.withColumn("t", F.concat("t", F.transform(_tail("segments", i), _wildcard))))
        literal = values.filter(F.col("n") >= LITERAL_URLS).select("host", "t", "value", F.lit(True).alias("literal"))
        one = F.when(F.col("literal"), F.concat(F.lit("="), "value")).otherwise(_wildcard(F.col("value")))
        current = written(current.withColumn("value", value).join(literal, ["host", "t", "value"], "left")
                          .withColumn("t", F.when(deep, F.concat("t", F.array(one))).otherwise(F.col("t"))).drop("value", "literal"))


def merge_branches(stats: DataFrame) -> DataFrame:
    """`stats` (host, t, labelled, blocked; one row for each template) with `m`:
    the template after similar branches have merged."""
    current = stats.withColumn("m", F.col("t"))
    last = F.transform("t", lambda x, k: F.when(x.startswith("="), k + 1).otherwise(0))
    deepest = stats.agg(F.max(F.array_max(last))).first()[0] or 0
    for i in range(deepest, 0, -1):
        # deeper levels must be wildcards by now
        open_ = (F.coalesce(F.get("m", F.lit(i - 1)).startswith("="), F.lit(False))
                 & ~F.exists(_tail("m", i + 1), lambda x: x.startswith("=")))
        to = F.concat(F.slice("m", 1, i - 1), F.array(F.lit("+")), _tail("m", i + 1))
        branches = written(current.filter(open_).groupBy("host", "m").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
                           .withColumn("to", to))
        nodes = written(branches.groupBy("host", "to").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b")))
        n, b, all_n, all_b = (F.col(c) for c in ("n", "b", "all_n", "all_b"))
        share = (all_b + 0.5) / (all_n + 1.0)
        error = F.sqrt(n * share * (1 - share) * F.greatest(1 - n / F.greatest(all_n, F.lit(1)), F.lit(0.0)))
        similar = (n > 0) & (all_n > n) & (F.abs(b - n * share) <= Z * error + 0.5)
        merged = written(branches.join(nodes, ["host", "to"]).filter(similar).select("host", "m", "to"))
        current = written(current.join(merged, ["host", "m"], "left").withColumn("m", F.coalesce("to", "m")).drop("to"))
    return current


def _purity(blocked: Column, labelled: Column, size: Column, overall: Column) -> Column:
    prior = F.least(overall, F.lit(0.5))
    return (blocked + (size - labelled + WEIGHT) * prior) / (size + WEIGHT)


def judge_paths(shaped: DataFrame) -> DataFrame:
    """(host, segments, template, purity, rejected) of `shaped`, the paths with
    their templates."""
    stats = written(shaped.groupBy("host", "t").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))
    merged = written(merge_branches(stats).select("host", "t", "m"))
    paths = written(shaped.join(merged, ["host", "t"]).select(
        "host", "segments", "m", F.slice("segments", 1, F.greatest(F.size("segments") - 1, F.lit(0))).alias("branch"), "labelled", "blocked"))
    sums = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    branches = written(paths.groupBy("host", "m", "branch").agg(*sums, F.count("*").alias("size")))
    listed_ = F.col("labelled") > 0
    bad = 2 * F.col("blocked") > F.col("labelled")
    whole = written(branches.agg(((F.sum("blocked") + 0.5 * WEIGHT) / (F.sum("labelled") + WEIGHT)).alias("overall")))
    judged = (branches.groupBy("host", "m").agg(*sums, F.sum("size").alias("size"), F.count("*").alias("n_branches"),
                                               F.count_if(listed_).alias("n_labelled"), F.count_if(bad).alias("n_blocked"))
              .crossJoin(F.broadcast(whole)))  # one row
    purity = F.round(_purity(F.col("blocked"), F.col("labelled"), F.col("size"), F.col("overall")), 9)
    among = _purity(F.col("n_blocked"), F.col("n_labelled"), F.col("n_branches"), F.col("overall"))
    shown = F.concat(F.lit("/"), F.array_join(F.transform("m", lambda x: F.regexp_replace(x, "^=", "")), "/"))
    judged = written(judged.select("host", "m", shown.alias("template"), purity.alias("purity"),
                                   (listed_ & (purity >= REJECT)).alias("_pure"), (among >= REJECT).alias("_spread")))
    rejected = F.col("_pure") & F.when(listed_, bad).otherwise(F.col("_spread"))
    branches = written(branches.join(judged, ["host", "m"]).select("host", "m", "branch", "template", "purity", rejected.alias("rejected")))
    return written(paths.select("host", "segments", "m", "branch").join(branches, ["host", "m", "branch"])
                   .select("host", "segments", "template", "purity", "rejected"))


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """`pages` (its columns but html and text) with host, path, rule, template,
    purity and verdict."""
    added = ("host", "path", "rule", "template", "purity", "verdict")
    keep = [i for i, c in enumerate(pages.columns) if c.lower() not in (*added, "html", "text")]
    side = by_place(pages)  # inside, the input's names clash with nothing
    host, path = parse(F.col(f"_c{place_of(pages, 'url')}"))
    base = side.select(*[f"_c{i}" for i in keep], host.alias("host"), path.alias("path"))
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    base = base.select("*", rule.alias("rule"), verdict.alias("_listed"), parts.alias("_segments"))
    n, blocked = F.count("_listed"), F.count_if(F.col("_listed") == "block")
    paths = written(base.groupBy("host", F.col("_segments").alias("segments")).agg(
        F.count("*").alias("urls"), (n > 0).cast("long").alias("labelled"), (2 * blocked > n).cast("long").alias("blocked")))
    verdicts = judge_paths(templates(paths)).withColumnsRenamed({"host": "_host", "segments": "_path"})
    return base.join(verdicts, (F.col("host") == F.col("_host")) & (F.col("_segments") == F.col("_path")), "left").select(
        *[F.col(f"_c{i}").alias(pages.columns[i]) for i in keep], "host", "path", "rule", "template", "purity",
        F.coalesce("_listed", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
