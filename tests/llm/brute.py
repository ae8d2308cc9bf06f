"""Plain Python versions of the operators, for small tables."""

import collections
import hashlib
import re

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def counts(text):
    text = text or ""
    w = BLANK.findall(text)
    three = list(zip(w, w[1:], w[2:], strict=False))
    often = collections.Counter(three)
    hit = {k + o for k, x in enumerate(three) if often[x] > 1 for o in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def shingles(text):
    w = BLANK.findall((text or "").translate(LOWER))
    if len(w) < 4:
        return {tuple(w)} if w else set()
    return {tuple(w[k:k + 4]) for k in range(len(w) - 3)}


def components(rows, percent=85):
    """{row number: (n, least doc_id reachable)}"""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = find(i)
            least[r] = min(doc, least.get(r, doc))
    return [(len(sets[i]), least.get(find(i)) if sets[i] else rows[i][0]) for i in range(len(rows))]


def leaks(text, items, window=10):
    """(n_words, hit word positions, item ids)"""
    w = ALNUM.findall((text or "").translate(LOWER))
    hit, names = set(), set()
    for item, t in items:
        v = ALNUM.findall((t or "").translate(LOWER))
        if not v:
            continue
        size = min(window, len(v))
        known = {tuple(v[k:k + size]) for k in range(len(v) - size + 1)}
        for k in range(len(w) - size + 1):
            if tuple(w[k:k + size]) in known:
                hit.update(range(k, k + size))
                names.add("" if item is None else str(item))
    return len(w), hit, sorted(names)


def kept_bytes(texts, length):
    raw = [(t or "").encode() for t in texts]
    often = collections.Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        end, keep = 0, bytearray()
        for i in range(len(t)):
            if i + length <= len(t) and often[t[i:i + length]] > 1:
                end = i + length
            if i >= end:
                keep.append(t[i])
        out.append(bytes(keep))
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()
