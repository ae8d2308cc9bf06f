"""N-gram Jaccard join with adaptive multi-match prefixes (operator 5).

Two documents link when 100 * |A & B| >= 85 * |A | B| over their sets of
4-word shingles. Documents with equal sets form one class and the join runs
on classes, so copies cost nothing.

Prefixes. In one global order of shingles, two linked sets share at least L
shingles among their first n - ceil(0.85 n) + L ones, for every L up to
ceil(0.85 n); with a different L on each side they share the smaller one.

1. Screening, over all documents: the order is by hash, so a prefix needs no
   statistics. A class passes if L of its first n - ceil(0.85 n) + L shingles
   occur in another document as well. Every class with a partner passes.
2. Join, over the classes that passed: whole sets, exact document frequencies
   and the order (frequency, shingle), which puts shared boilerplate last.
   Each class picks its L by estimated cost (postings to merge, plus
   verifications of the partners that L matches would let through) and so
   lengthens its prefix; pairs need min(L) shared prefix shingles.
3. Groups of near copies: each prefix shingle first links its classes to one
   pivot (the class with fewest shingles of its own). After the components
   of the verified links are known, pairs are formed only between different
   components, so a group of thousands costs thousands of checks, not millions.
   Nothing is dropped: all pairs that share min(L) prefix shingles are checked
   or already connected.

Sizes, and the number of shingles that occur in another class, bound the
possible overlap of a pair before its sets are compared.

Defined results: null, empty and blank texts have no shingles and link with
nothing (component_id is their own doc_id); a text of fewer than 4 words is one
shingle; rows without doc_id take part, and a component of such rows only has a
null component_id; rows that repeat a doc_id are separate documents; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.llm import textscan as ts
from recsmith.llm.common import by_place, pick, place_of, written
from recsmith.llm.components import connected_components

WIDTH = 4
#: Similarity in percent.
PERCENT = 85
#: Matches tried when a class picks its prefix.
MATCHES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)


def chunk_shingles(chunk: ts.Chunk, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle) sorted and distinct, over a chunk."""
    codes = ts.lower_ascii(chunk.codes)
    found = ts.words(chunk, ~ts.is_blank(codes))
    hashes = ts.strong_hash(ts.char_values(codes), found.starts, found.ends)
    at, doc = ts.windows(found.first, width)
    sh = ts.strong_hash(hashes, at, at + width)
    size = np.diff(found.first)
    short = np.flatnonzero((size > 0) & (size < width))
    if len(short):
        sh = np.concatenate([sh, ts.strong_hash(hashes, found.first[short], found.first[short + 1])])
        doc = np.concatenate([doc, short])
    sh = sh.view(np.int64)
    order = np.lexsort((sh, doc))
    sh, doc = sh[order], doc[order]
    if len(sh):
        keep = np.concatenate([[True], (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])])
        sh, doc = sh[keep], doc[keep]
    return doc, sh


def _digests(sh: np.ndarray, first: np.ndarray) -> pa.Array:
    """128-bit digest of each set: two sums of mixed shingles."""
    out = np.empty((len(first) - 1, 2), dtype=np.uint64)
    for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47)):
        total = np.zeros(len(sh) + 1, dtype=np.uint64)
        np.cumsum(ts.mix(sh.view(np.uint64) ^ np.uint64(salt)), dtype=np.uint64, out=total[1:])
        out[:, k] = total[first[1:]] - total[first[:-1]]
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(out), [None, pa.py_buffer(out.tobytes())])
    return fixed.cast(pa.binary())


def _least(n: np.ndarray, percent: int) -> np.ndarray:
    """ceil(percent * n / 100): overlap that any partner needs."""
    return -(-n * percent // 100)


def signatures(docs: DataFrame, percent: int, whole: bool) -> DataFrame:
    """(doc_id, cls, n, need, toks): the set digest, the set size, and the
    first shingles by hash (`whole`: all of them) of which `need` must be
    shared."""
    schema = docs.select("doc_id").schema.add("cls", "binary").add("n", "integer").add("need", "integer").add("toks", T.ArrayType(T.LongType()))

    def scan(batches):
        for batch in batches:
            for chunk in ts.chunks(batch.column(1)):
                doc, sh = chunk_shingles(chunk)
                first = np.searchsorted(doc, np.arange(chunk.n + 1))
                n = np.diff(first)
                need = (n - _least(n, percent)) // 2 + 1
                take = n if whole else np.minimum(n - _least(n, percent) + need, n)
                rank = np.arange(len(sh)) - np.repeat(first[:-1], n)
                toks = sh[rank < np.repeat(take, n)]
                offsets = np.concatenate([[0], np.cumsum(take)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(chunk.row, chunk.n), _digests(sh, first),
                    pa.array(n.astype(np.int32)), pa.array(need.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(toks)),
                ], names=["doc_id", "cls", "n", "need", "toks"])

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def _suspects(sig: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, rep) of the classes whose screening prefix is shared enough."""
    tokens = sig.filter("n > 0").select("cls", "need", F.explode("toks").alias("tok"))
    shared = written(tokens.groupBy("tok").agg(F.count("*").alias("df")).filter("df > 1").select("tok"))
    hits = tokens.join(shared, "tok").groupBy("cls", "need").agg(F.count("*").alias("hits"))
    return hits.join(classes, "cls").filter("hits >= need * copies").select("cls", "rep")


def _whole_sets(docs: DataFrame, suspects: DataFrame, percent: int) -> DataFrame:
    """(cls, n, toks) with all shingles, one row for each suspect class."""
    rows = docs.select("doc_id", "text")
    reps = suspects.filter("rep is not null").select(F.col("rep").alias("doc_id")).distinct()
    chosen = rows.join(reps, "doc_id", "left_semi").union(rows.filter("doc_id is null"))
    full = signatures(chosen, percent, whole=True).filter("n > 0").select("cls", "n", "toks")
    return written(full.join(suspects.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]))


def _may_link(n1: str, e1: str, n2: str, e2: str, percent: int) -> Column:
    """Whether sizes and shared shingles leave room for the similarity."""
    return F.expr(f"{100 + percent} * least({e1}, {e2}) >= {percent} * ({n1} + {n2})")


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """(df, tok, cls, n, e, need, q, last): the prefix of each class that can
    have a partner; e counts its shingles that another class has too, q those
    in the prefix, whose last one is `last`."""
    tokens = sets.select("cls", "n", F.explode("toks").alias("tok"))
    shared = written(tokens.groupBy("tok").agg(F.count("*").alias("df")).filter("df > 1"))
    lists = (tokens.join(shared, "tok").groupBy("cls", "n")
             .agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("toks"))
             .withColumn("e", F.size("toks"))
             .withColumn("least", F.expr(f"cast((n * {percent} + 99) div 100 as int)"))
             .filter("e >= least"))
    # postings to merge, and n for each partner that `need` matches let through
    cost = F.array(*[F.struct(
        F.when(F.col("least") >= m, F.expr(
            f"aggregate(slice(toks, 1, greatest(0, e - least + {m})), 0D, (s, x) -> s + x.df - 1) * (1 + n / (4D * {m})) + {m}"))
        .otherwise(F.lit(float("inf"))).alias("cost"), F.lit(m).alias("need")) for m in MATCHES])
    return (lists.withColumn("need", F.array_min(cost)["need"])
            .withColumn("prefix", F.expr("slice(toks, 1, greatest(0, e - least + need))"))
            .select("cls", "n", "e", "need", F.size("prefix").alias("q"), F.element_at("prefix", -1).alias("last"),
                    F.explode("prefix").alias("t"))
            .select("t.df", "t.tok", "cls", "n", "e", "need", "q", "last"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("toks").alias("ta"))
    right = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("toks").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return (pairs.join(left, "a").join(right, "b")
            .filter((100 + percent) * both >= percent * (F.col("na") + F.col("nb"))).select(*pairs.columns))


def class_components(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signature rows: doc_id, cls, n; classes: cls, rep, copies; cls, root
    for the classes that have a link)."""
    docs = pick(docs, "doc_id", "text")
    sig = written(signatures(docs, percent, whole=False))
    classes = written(sig.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    suspects = written(_suspects(sig, classes))
    sets = _whole_sets(docs, suspects, percent)
    postings = written(_postings(sets, percent))

    # every prefix shingle links its classes to one pivot
    pivots = written(postings.groupBy("tok").agg(F.min(F.struct(F.expr("n - e").alias("own"), F.col("cls").alias("p"),
                                                                F.col("n").alias("pn"), F.col("e").alias("pe"))).alias("x"))
                     .select("tok", "x.p", "x.pn", "x.pe"))
    spokes = written(postings.join(pivots, "tok").filter("cls != p").filter(_may_link("n", "e", "pn", "pe", percent))
                     .select(F.col("cls").alias("a"), F.col("p").alias("b")).distinct())
    roots = written(connected_components(_verified(spokes, sets, percent)))

    # pairs between different components that share enough prefix shingles
    placed = written(postings.join(roots, postings.cls == roots.node, "left")
                     .select(*postings.columns, F.coalesce("root", "cls").alias("root")))
    # a list inside one component has no pair to give
    mixed = written(placed.groupBy("tok").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
                    .filter("r0 != r1").select("tok"))
    lists = written(placed.join(mixed, "tok", "left_semi"))
    prefixes = written(lists.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("prefix"))
                       .select("cls", F.col("prefix.tok").alias("prefix")))
    lists = written(lists.join(prefixes, "cls"))
    # each pair comes once, at its first shared shingle, if the shared ones are
    # enough: `need` of them, and so many that with the shingles behind the
    # prefix that ends first the similarity can still be reached
    common = "array_intersect(x.prefix, y.prefix)"
    behind = "if(x.last < y.last, x.e - x.q, y.e - y.q)"
    pairs = lists.alias("x").join(lists.alias("y"), F.expr(
        f"x.tok = y.tok and x.cls < y.cls and x.root != y.root"
        f" and {100 + percent} * least(x.e, y.e) >= {percent} * (x.n + y.n)"
        f" and size({common}) >= least(x.need, y.need) and element_at({common}, 1) = x.tok"
        f" and {100 + percent} * (size({common}) + {behind}) >= {percent} * (x.n + y.n)")).select(
        F.col("x.cls").alias("a"), F.col("y.cls").alias("b"), F.col("x.root").alias("ra"), F.col("y.root").alias("rb"))
    tried = spokes.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    across = written(_verified(pairs.join(tried, ["a", "b"], "left_anti"), sets, percent)
                     .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    if across.isEmpty():
        return sig.select("doc_id", "cls", "n"), classes, roots
    # links between components: the components of components
    upper = written(connected_components(across).withColumnsRenamed({"node": "old", "root": "new"}))
    merged = roots.join(upper, roots.root == upper.old, "left").select("node", F.coalesce("new", "root").alias("root"))
    alone = upper.join(roots, upper.old == roots.node, "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
    return sig.select("doc_id", "cls", "n"), classes, written(merged.union(alone))


def ngram_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links)."""
    rows, classes, roots = class_components(docs, percent)
    linked = written(classes.join(roots, F.col("cls") == F.col("node")).select("cls", "rep", "root"))
    least = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    placed = written(classes.join(linked.join(least, "root").select("cls", "component_id"), "cls", "left")
                     .select("cls", F.coalesce("component_id", "rep").alias("component_id")))
    return (rows.join(placed, "cls", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def _with_class(docs: DataFrame) -> DataFrame:
    """`docs` under names that clash with nothing (by_place), and the set digest
    of each row as `cls`, null without words."""
    side = by_place(docs)
    at, names = place_of(docs, "text"), [*side.columns, "cls"]

    def scan(batches):
        for batch in batches:
            for chunk in ts.chunks(batch.column(at)):
                doc, sh = chunk_shingles(chunk)
                first = np.searchsorted(doc, np.arange(chunk.n + 1))
                words = pa.array(np.diff(first) > 0)
                yield pa.RecordBatch.from_arrays([*[c.slice(chunk.row, chunk.n) for c in batch.columns],
                                                  pc.if_else(words, _digests(sh, first), pa.scalar(None, pa.binary()))], names=names)

    return side.mapInArrow(scan, T.StructType([*side.schema, T.StructField("cls", T.BinaryType())]))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near copies stays: of the least doc_id (null
    ids last), then of the least set digest, then of the least text. Rows are
    judged one by one, so a row that repeats a doc_id with another text stays;
    of rows with one doc_id and one shingle set a single one stays. Texts
    without words all stay."""
    rows, _, roots = class_components(docs, percent)
    worded = rows.filter("n > 0")
    # nearly all doc_ids stand in one row: their rows go by doc_id alone
    often = written(rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select("doc_id"))
    keys = written(worded.groupBy("doc_id", "cls").agg(F.count("*").alias("n"))
                   .join(roots, F.col("cls") == F.col("node"), "left").select("doc_id", "cls", F.coalesce("root", "cls").alias("root")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "cls"))
    stays = keys.groupBy("root").agg(first.alias("k")).select(F.col("k.doc_id").alias("_id"), F.col("k.cls").alias("_cls"))
    stays = written(stays)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("cls") == F.col("_cls"))
    gone = written(keys.join(stays, same, "left_anti").join(often, keys.doc_id.eqNullSafe(often.doc_id), "left_anti").select(F.col("doc_id").alias("_gone")))
    names, side = docs.columns, by_place(docs)
    doc_id, text = (f"_c{place_of(docs, c)}" for c in ("doc_id", "text"))
    if often.isEmpty():
        return side.join(gone, F.col(doc_id) == F.col("_gone"), "left_anti").toDF(*names)
    often = often.withColumnRenamed("doc_id", "_often")
    plain = (side.join(often, F.col(doc_id).eqNullSafe(F.col("_often")), "left_anti")
             .join(gone, F.col(doc_id) == F.col("_gone"), "left_anti"))
    judged = written(_with_class(side.join(often, F.col(doc_id).eqNullSafe(F.col("_often")), "left_semi").toDF(*names)))
    chosen = judged.join(stays, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("cls") == F.col("_cls")), "left_semi")
    # equal rows are combined in each task before one of them is chosen
    one = chosen.groupBy(doc_id, "cls").agg(F.min_by(F.struct(*side.columns), text).alias("r")).select("r.*")
    return plain.unionByName(one).unionByName(judged.filter("cls is null").drop("cls")).toDF(*names)
