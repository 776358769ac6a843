"""Plain Python versions of what several tests compare with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_list(text):
    return WORD.findall(text or "")


def groups(edges):
    """The smallest name reachable of every name in an edge."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}
