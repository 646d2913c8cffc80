"""Plain Python versions of the operators, for small tables."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def roots(nodes, links):
    """The least member of each node's component."""
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def shingles(text, width=5):
    own = words((text or "").translate(LOWER))
    if len(own) < width:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}


def near(rows, percent=85):
    """{id: (set size, component)} of (id, text) with unique ids."""
    sets = {key: shingles(text) for key, text in rows}
    keys = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(keys)
        for b in keys[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    found = roots(keys, links)
    return {key: (len(sets[key]), found[key]) for key in keys}


def passages(rows, width=35):
    """[(id, words, removed, kept text)] of (id, text)."""
    split = [words(text) for _, text in rows]
    seen = {}
    for own in split:
        for i in range(len(own) - width + 1):
            seen[tuple(own[i : i + width])] = seen.get(tuple(own[i : i + width]), 0) + 1
    out = []
    for (key, _), own in zip(rows, split):
        gone = set()
        for i in range(len(own) - width + 1):
            if seen[tuple(own[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = [word for i, word in enumerate(own) if i not in gone]
        out.append((key, len(own), len(gone), " ".join(kept)))
    return out
