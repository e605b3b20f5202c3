"""Plain Python counterparts of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

ASCII_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern=SPACED):
    return pattern.findall((text or "").translate(ASCII_LOWER))


def shingles(text, n):
    found = words(text)
    if len(found) < n:
        return {tuple(found)} if found else set()
    return set(zip(*[found[j:] for j in range(n)]))


def components(texts, n, num, den):
    """{place: smallest place reachable} over all pairs."""
    sets = [shingles(t, n) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))], sets


def contamination(text, items):
    """(n_words, n_hit, item ids) of one text by looking at every place."""
    doc = words(text, ALNUM)
    hit, found = set(), set()
    places = defaultdict(list)
    for i, w in enumerate(doc):
        places[w].append(i)
    for item_id, item_text in items:
        item = words(item_text, ALNUM)
        if not item:
            continue
        width = min(13, len(item))
        for s in range(len(item) - width + 1):
            window = item[s:s + width]
            for p in places.get(window[0], ()):
                if doc[p:p + width] == window:
                    hit.update(range(p, p + width))
                    found.add(str(item_id))
    return len(doc), len(hit), sorted(found)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text):
    return zlib.crc32((text or "").encode())
