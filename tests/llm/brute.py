"""Plain versions of what the operators compute, for small inputs."""

import re
from collections import defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {i: find(i) for i in ids}


def shingles(text, width):
    words = SPACE.findall((text or "").translate(SMALL))
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_duplicates(docs, width, threshold=80):
    """docs: (id, text). {id: (set size, component)}; pairs that share a shingle are all compared."""
    sets = {i: shingles(t, width) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = defaultdict(int)
    for ids in holders.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1 :]:
                common[a, b] += 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= threshold * (len(sets[a]) + len(sets[b]) - n)]
    group = components(sets, links)
    return {i: (len(s), group[i]) for i, s in sets.items()}
