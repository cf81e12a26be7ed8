import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, size=5):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def least_reachable(ids, links):
    at = {i: i for i in ids}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        at[b] = a
    return {i: root(i) for i in ids}


def jaccard_links(sets, percent=80):
    inverted = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            inverted[g].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in inverted[g] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                yield i, j
