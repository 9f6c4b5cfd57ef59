"""Plain Python versions of what the operators compute, for small tables."""

import itertools
import re
from collections import defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=SPACE):
    return pattern.findall((text or "").translate(LOWER))


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components(links, vertices):
    parent = {v: v for v in vertices}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {v: find(v) for v in vertices}


def jaccard_components(docs, percent=80):
    """{id: (set size, component)} of (id, text) with unique ids."""
    sets = {k: shingles(t) for k, t in docs}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    found = components(links, sorted(sets))
    return {k: (len(sets[k]), found[k]) for k in sets}


def contamination(text, items, window=13):
    """Words, hit words, items found."""
    w = words(text, ALNUM)
    hit, found = set(), set()
    for key, item in items:
        x = words(item, ALNUM)
        n = min(window, len(x))
        grams = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(str(key))
    return len(w), len(hit), sorted(found)


def quality(text):
    """The base measures."""
    t = text or ""
    w = SPACE.findall(t)
    where = defaultdict(list)
    for i in range(len(w) - 4):
        where[tuple(w[i : i + 5])].append(i)
    repeated = {i + j for v in where.values() if len(v) > 1 for i in v for j in range(5)}
    lines = [x for x in t.split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated)


def repeats(docs, n=51):
    """Ids that share ``n`` consecutive words with another."""
    held = defaultdict(set)
    for k, t in docs:
        w = words(t)
        for i in range(len(w) - n + 1):
            held[tuple(w[i : i + n])].add(k)
    return set().union(*(v for v in held.values() if len(v) > 1))
