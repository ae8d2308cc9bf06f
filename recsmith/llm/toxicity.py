"""Toxicity by a weighted lexicon and an Aho-Corasick automaton (operator 12).

Texts are folded: letters to lower case without marks, letters that look like
Latin ones to those, digits and signs inside words to the letters they stand
for, invisible characters away (l, i and 1 are one letter: nobody can say which
one a 1 stands for). The lexicon is learned from labelled documents: of the
beginnings of words, those whose documents (with one or, apart, with several of
them) are labelled toxic far beyond chance, none of them the beginning of
another. An entry has two weights, the log odds of documents with it and with
several of it. Phrases of two words around an entry that clean documents use
become exceptions beside any that are given; an entry inside an exception does
not count. All entries and exceptions are matched in one pass by an Aho-Corasick
automaton. A text has two measures: the weights of the entries it has, and the
weights of all its hits normalised by its number of words. A logistic curve over
the logarithms of both, fitted on the same documents, is the score.

Labels, lang, source and doc_id are no inputs of a score. Rows with
crc32(doc_id as text) mod 5 = 0 are held out: their labels are never read. The
fit reads at most SAMPLE labelled documents, those of the least hashed doc_ids;
all documents are scored, over their whole texts.

Defined results: null and empty texts have no words and get the least score;
null doc_ids are not held out and never trained on; a document with several
labels counts by their majority (ties: toxic); without labels of both kinds
every score is the share of toxic labels, or 0.5; entries of equal evidence are
taken the longer first, then by their letters; repeated rows are scored one by one; a very long text is
scanned on its own, so memory follows the longest text; an empty table gives no
rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.llm import textscan as ts
from recsmith.llm.common import pick, written

#: Labelled documents that lexicon, exceptions and curve are fitted on, at most.
SAMPLE = 20_000
#: Letters of a lexicon entry.
SHORTEST, LONGEST = 3, 12
#: Toxic documents that an entry needs, and the toxic share of its documents.
MIN_DOCS, MIN_SHARE = 3, 0.5
#: Entries (and exceptions) expected to pass by chance.
BY_CHANCE = 1.0
#: Clean share of the documents of an exception.
EXCEPTION_SHARE = 0.9
#: Rows of a task's counts that are added up at once.
HELD_ROWS = 1 << 21

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o",
    "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "з": "e",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ŧ": "t",
}
# Digits and signs written for letters.
DIGITS = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "€": "e"}  # in a word with a letter
INNER_SIGNS = {"!": "i", "|": "i", "+": "t", "*": "*"}  # between letters
# Fixed value: letters that one substitute stands for alike.
ALIKE = {"l": "i"}

_NONE, _LETTER, _DIGIT, _SIGN, _INNER, _GONE, _UNKNOWN = 0, 1, 2, 3, 4, 5, 255
_kinds = np.full(0x110000, _UNKNOWN, dtype=np.uint8)
_folded = np.zeros(0x110000, dtype=np.uint32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _fold_character(c: str) -> tuple[int, str]:
    """(kind, folded character)."""
    if unicodedata.category(c) in ("Cf", "Mn", "Me"):
        return _GONE, " "
    for kind, table in ((_SIGN, SIGNS), (_INNER, INNER_SIGNS)):
        if c in table:
            return kind, table[c]
    plain = [x for x in unicodedata.normalize("NFKD", c).casefold() if not unicodedata.combining(x)]
    one = LOOK_ALIKES.get(c.lower()[:1], LOOK_ALIKES.get(plain[0], plain[0])) if plain else " "
    if one in DIGITS:
        return _DIGIT, ALIKE.get(DIGITS[one], DIGITS[one])
    return (_LETTER, ALIKE.get(one, one)) if one.isalpha() else (_NONE, " ")


def _learn_characters(codes: np.ndarray) -> np.ndarray:
    kind = _kinds[codes]
    if (kind == _UNKNOWN).any():
        for c in np.unique(codes[kind == _UNKNOWN]).tolist():
            _kinds[c], folded = _fold_character(chr(c))
            _folded[c] = ord(folded)
        kind = _kinds[codes]
    return kind


@dataclass
class Folded:
    """The words of a chunk, each behind one blank: letters, place of each
    word's blank, index of the first word of each document (n + 1 entries)."""

    codes: np.ndarray
    at: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, k: int) -> str:
        """Document k: its words, with a blank around each."""
        lo, hi = self.first[k], self.first[k + 1]
        if lo == hi:
            return ""
        stop = self.at[hi] if hi < len(self.at) else len(self.codes)
        return self.codes[self.at[lo]:stop].tobytes().decode("utf-32-le") + " "


def fold(codes: np.ndarray, bounds: np.ndarray) -> Folded:
    kind = _learn_characters(codes)
    seen = kind != _GONE
    bounds = np.concatenate([[0], np.cumsum(seen)])[bounds]
    codes, kind = codes[seen], kind[seen]
    n = len(codes)
    solid = (kind == _LETTER) | (kind == _DIGIT) | (kind == _SIGN)
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    before[1:] = solid[:-1] & ~edge[1:n]
    after[:-1] = solid[1:] & ~edge[1:n]
    mask = solid | ((kind == _INNER) & before & after)
    starts, ends = ts.spans(mask, bounds)
    letters = np.concatenate([[0], np.cumsum(kind == _LETTER)])
    word = letters[ends] > letters[starts]  # numbers and prices are no words
    starts, ends = starts[word], ends[word]
    size = ends - starts + 1
    at = np.cumsum(size) - size
    out = np.full(int(size.sum()), 0x20, dtype=np.uint32)
    inside = np.repeat(at + 1 - np.concatenate([[0], np.cumsum(size - 1)])[:-1], size - 1) + np.arange(int((size - 1).sum()))
    source = np.repeat(starts - np.concatenate([[0], np.cumsum(size - 1)])[:-1], size - 1) + np.arange(int((size - 1).sum()))
    out[inside] = _folded[codes[source]]
    return Folded(out, at, np.searchsorted(starts, bounds))


def folded_words(text: str) -> str:
    """One text folded, a blank around each word."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return fold(codes, np.array([0, len(codes)])).text(0)


@dataclass(frozen=True)
class Model:
    """Entries (a blank, then the first letters of a word) with the weights of
    one and of several, exception phrases, and the curve: an intercept and the
    slopes of both measures."""

    weights: tuple[tuple[str, float, float], ...] = ()
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def score(self, measures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_columns(measures) @ np.array(self.curve), -40, 40)))


def _columns(measures: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(measures)), np.log1p(measures[:, 0]), np.log1p(100 * measures[:, 1])], axis=1)


@lru_cache(maxsize=4)
def automaton(model: Model) -> ahocorasick.Automaton:
    """One for each Python worker and model. Values: (length, entry), the
    entry None for an exception."""
    found = ahocorasick.Automaton()
    for entry, _, _ in model.weights:
        found.add_word(entry, (len(entry), entry))
    for phrase in model.exceptions:
        found.add_word(phrase, (len(phrase), None))
    found.make_automaton()
    return found


def hits(model: Model, text: str) -> list[tuple[int, str]]:
    """(place of the word's blank, entry) of every word of a folded text that an
    entry begins (one at most: none begins another), unless an exception covers it."""
    if not model.weights or not text:
        return []
    found: list[tuple[int, int, str]] = []
    covered: list[tuple[int, int]] = []
    for end, (size, entry) in automaton(model).iter(text):
        if entry is None:
            covered.append((end + 1 - size, end))
        else:
            found.append((end + 1 - size, end, entry))
    if not covered:
        return [(start, entry) for start, _, entry in found]
    starts, reach = [a for a, _ in sorted(covered)], []
    for _, end in sorted(covered):
        reach.append(max(end, reach[-1] if reach else -1))

    def free(start: int, end: int) -> bool:
        before = bisect_right(starts, start)
        return before == 0 or reach[before - 1] < end

    return [(start, entry) for start, end, entry in found if free(start, end)]


def scan_texts(model: Model, chunk: ts.Chunk) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """(measures, words, entries hit) of each text of a chunk."""
    words = fold(chunk.codes, chunk.bounds)
    n = np.diff(words.first)
    weight = {e: (one, more) for e, one, more in model.weights}
    measures, entries = np.zeros((chunk.n, 2)), []
    for k in range(chunk.n):
        entries.append([e for _, e in hits(model, words.text(k))])
        for entry, times in sorted(Counter(entries[-1]).items()):
            one, more = weight[entry]
            measures[k, 0] += one + more * (times > 1)
            measures[k, 1] += (one + more * (times - 1)) / n[k]
    return measures, n, entries


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most `sample` labelled doc_ids that are not held out."""
    known = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((2 * F.sum(F.col("toxic").cast("int")) >= F.count("*")).cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    return docs.select("doc_id", "text").join(F.broadcast(written(known)), "doc_id").select("text", "toxic")


def _counted(rows: DataFrame, find) -> DataFrame:
    """(key, toxic, clean): documents of each kind that have a key; `find`
    gives (document, key) pairs of a chunk, repeated ones included."""

    def count(batches):
        held: list[pa.Table] = []
        size = 0

        def add_up():
            total = pa.concat_tables(held).group_by("key").aggregate([("toxic", "sum"), ("clean", "sum")])
            return total.rename_columns(["key", "toxic", "clean"]).combine_chunks().to_batches()

        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for chunk in ts.chunks(batch.column(0)):
                doc, keys = find(chunk)
                if len(doc) == 0:
                    continue
                mark = toxic[chunk.row + doc].astype(np.int64)
                held.append(pa.table([keys, pa.array(mark), pa.array(1 - mark)], names=["key", "toxic", "clean"]))
                size += len(doc)
                if size > HELD_ROWS:
                    part = add_up()
                    yield from part
                    held.clear()
                    size = 0
        if held:
            yield from add_up()

    return (rows.mapInArrow(count, "key string, toxic long, clean long")
            .groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def word_beginnings(chunk: ts.Chunk) -> tuple[np.ndarray, pa.Array]:
    """(document, beginning) pairs: the first SHORTEST to LONGEST letters of
    its words, each once a document, behind a blank; those of several words
    once more, with a tab at the end."""
    words = fold(chunk.codes, chunk.bounds)
    if len(words.at) == 0:
        return np.zeros(0, np.int64), pa.array([], pa.string())
    values, doc = words.codes.astype(np.uint64), words.doc
    size = np.diff(words.at, append=len(words.codes))
    text = words.codes.tobytes().decode("utf-32-le")
    docs, keys = [], []
    for n in range(SHORTEST + 1, LONGEST + 2):
        some = np.flatnonzero(size >= n)
        start = words.at[some]
        same = ts.mix(ts.span_hash(values, start, start + n) ^ ts.mix(doc[some].astype(np.uint64)))
        _, first, times = np.unique(same, return_index=True, return_counts=True)
        several = first[times > 1]
        docs += [doc[some][first], doc[some][several]]
        keys += [text[s:s + n] for s in start[first].tolist()]
        keys += [text[s:s + n] + "\t" for s in start[several].tolist()]
    return np.concatenate(docs), pa.array(keys, pa.string())


def evidence(toxic: float, clean: float, base: float) -> float:
    """Log-likelihood ratio of a share above `base` (0 if it is not)."""
    n, share = toxic + clean, toxic / (toxic + clean)
    if share <= base:
        return 0.0
    return n * (share * math.log(share / base) + (1 - share) * math.log(max(1 - share, 1e-300) / (1 - base)) * (share < 1))


def choose_entries(counts: list[tuple[str, int, int]], tried: int, toxic: int, clean: int) -> list[tuple[str, float, float]]:
    """Lexicon from (beginning, toxic, clean) documents, a tab behind it for
    those with several: the strongest evidence first, leaving out beginnings
    and continuations of what is chosen. By Chernoff's bound, exp(-evidence) is
    at least the chance of such a share."""
    base = toxic / (toxic + clean)
    least = math.log(max(tried, 1) / BY_CHANCE)
    known = {k: (a, b) for k, a, b in counts}
    rated: dict[str, float] = {}
    for key, a, b in counts:
        if a >= MIN_SHARE * (a + b):
            entry = key.rstrip("\t")
            rated[entry] = max(rated.get(entry, 0.0), round(evidence(a, b, base), 9))

    def weight(key: str) -> float:
        a, b = known.get(key, (0, 0))
        return max(0.0, math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))) if a else 0.0

    chosen: list[tuple[str, float, float]] = []
    taken: set[str] = set()
    begun: set[str] = set()
    for entry, found in sorted(rated.items(), key=lambda x: (-x[1], -len(x[0]), x[0])):
        if found < least:
            break
        parts = {entry[:n] for n in range(2, len(entry) + 1)}
        if entry in begun or parts & taken:
            continue
        chosen.append((entry, weight(entry), weight(entry + "\t")))
        taken.add(entry)
        begun |= parts
    return chosen


def phrases_around(model: Model, chunk: ts.Chunk) -> tuple[np.ndarray, pa.Array]:
    """(document, entry, tab, phrase): the words hit with the word before or after."""
    words = fold(chunk.codes, chunk.bounds)
    docs, keys = [], []
    for k in range(chunk.n):
        text = words.text(k)
        found = set()
        for start, entry in hits(model, text):
            end = text.index(" ", start + 1)
            before = text.rfind(" ", 0, start) if start else -1
            after = text.find(" ", end + 1)
            found |= {f"{entry}\t{entry}\t"}
            if before >= 0:
                found.add(f"{entry}\t{text[before:end + 1]}")
            if after >= 0:
                found.add(f"{entry}\t{text[start:after + 1]}")
        docs += [k] * len(found)
        keys += sorted(found)
    return np.array(docs, dtype=np.int64), pa.array(keys, pa.string())


def choose_exceptions(counts: list[tuple[str, int, int]]) -> tuple[str, ...]:
    """Phrases that clean documents use far more often than their entry."""
    whole = {k.split("\t")[0]: (a, b) for k, a, b in counts if k.endswith("\t")}
    out = set()
    for key, a, b in counts:
        entry, phrase = key.split("\t")[:2]
        if key.endswith("\t") or b < MIN_DOCS or b < EXCEPTION_SHARE * (a + b):
            continue
        toxic, clean = whole[entry]
        if evidence(b, a, clean / (toxic + clean)) >= math.log(max(len(counts), 1) / BY_CHANCE):
            out.add(phrase)
    return tuple(sorted(out))


def fit_curve(measures: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, the coefficients drawn towards 0 a
    little so that clean cuts stay finite; no slope is negative."""
    x = _columns(measures)
    free = np.array([True, True, True])
    while True:
        w = np.zeros(3)
        for _ in range(80):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
            gradient = (x.T @ (p - toxic) + 1e-3 * w)[free]
            curvature = ((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3))[np.ix_(free, free)]
            step = np.linalg.solve(curvature, gradient)
            step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
            w[free] -= step
            if np.abs(step).max() < 1e-8:
                break
        low = [k for k in (1, 2) if w[k] < 0]
        if not low:
            return float(w[0]), float(w[1]), float(w[2])
        free[min(low, key=lambda k: w[k])] = False


def fit(rows: DataFrame, exceptions: tuple[str, ...] = ()) -> Model:
    """Model of written (text, toxic) rows; what reaches the driver is bounded by
    their number."""
    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        share = (toxic + 0.5) / (toxic + clean + 1)
        return Model(curve=(math.log(share / (1 - share)), 0.0, 0.0))
    given = tuple(sorted({folded_words(e) for e in exceptions} - {""}))
    counts = written(_counted(rows, word_beginnings).filter(F.col("toxic") >= MIN_DOCS))
    tried = counts.count()
    strong = counts.filter(F.col("toxic") >= MIN_SHARE * (F.col("toxic") + F.col("clean"))).select(F.rtrim("key", F.lit("\t")).alias("entry")).distinct()
    both = counts.join(strong, F.rtrim("key", F.lit("\t")) == F.col("entry"), "left_semi")
    lexicon = choose_entries([tuple(r) for r in both.collect()], tried, toxic, clean)
    found = Model(tuple(sorted(lexicon)), given)
    around = _counted(rows, lambda chunk: phrases_around(found, chunk)).filter((F.col("clean") >= MIN_DOCS) | F.col("key").endswith("\t"))
    found = Model(found.weights, tuple(sorted({*given, *choose_exceptions([tuple(r) for r in around.collect()])})))

    def measure(batches):
        for batch in batches:
            for chunk in ts.chunks(batch.column(0)):
                value, _, _ = scan_texts(found, chunk)
                yield pa.RecordBatch.from_arrays([pa.array(value[:, 0]), pa.array(value[:, 1]), batch.column(1).slice(chunk.row, chunk.n)], names=names)

    names = ["held", "density", "toxic"]
    # sorted, so that sums do not depend on the partitioning
    known = rows.mapInArrow(measure, "held double, density double, toxic int").toArrow().sort_by([(c, "ascending") for c in names])
    measures = np.stack([known.column(c).to_numpy() for c in names[:2]], axis=1)
    return Model(found.weights, found.exceptions, fit_curve(measures, known.column("toxic").to_numpy()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_words, hits (entries, one for each word hit) of every document."""
    schema = (T.StructType([docs.schema["doc_id"]]).add("score", T.DoubleType()).add("n_words", T.LongType())
              .add("hits", T.ArrayType(T.StringType())))

    def scan(batches):
        for batch in batches:
            for chunk in ts.chunks(batch.column(1)):
                measures, n, entries = scan_texts(model, chunk)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.row, chunk.n), pa.array(model.score(measures)), pa.array(n, pa.int64()),
                                                  pa.array([[e.strip() for e in x] for x in entries], pa.list_(pa.string()))], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = (), sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, n_words, hits of every document."""
    docs, labels = pick(docs, "doc_id", "text"), pick(labels, "doc_id", "toxic")
    model = fit(written(labelled(docs, labels, sample)), exceptions)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_words", "hits")
