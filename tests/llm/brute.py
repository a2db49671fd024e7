"""Plain statements of what the operators compute."""

import re
from collections import defaultdict
from itertools import combinations

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    words = WORD.findall((text or "").encode().translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = top(a), top(b)
        parent[max(p, q)] = min(p, q)
    return {n: top(n) for n in nodes}


def near_duplicates(rows):
    """rows: (doc_id, text) of different ids; to doc_id: (set size, component)."""
    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    met = {p for own in holders.values() for p in combinations(sorted(own), 2)}
    links = [(a, b) for a, b in met if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = roots(sets, links)
    return {i: (len(s), root[i]) for i, s in sets.items()}


def distance(a, b, most):
    """Edit distance by the whole table, or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y))
    return min(row[-1], most + 1)


def shares_run(a, b, run, shift):
    """Whether a run of so many characters is in both, at places that differ by `shift` at most."""
    return any(a[i : i + run] == b[j : j + run] for i in range(len(a) - run + 1) for j in range(max(0, i - shift), min(len(b) - run, i + shift) + 1))


def lines_linked(a, b):
    """Two edits at most below 60 characters; from there on 5 % of the shorter line, and a run of a third of what they leave."""
    size = min(len(a), len(b))
    most = 2 if size < 60 else size // 20
    return distance(a, b, most) <= most and (size < 60 or shares_run(a, b, -(-(size - most) // 3), most))


def line_links(texts, least):
    """Lines of `least` characters or more, and the links between those of 24 or more."""
    lines = sorted({x for t in texts if t is not None for x in t.split("\n") if len(x) >= least}, key=len)
    parts = [{x[i : i + 19] for i in range(len(x) - 18)} for x in lines]  # a shared run has at least so many
    out = []
    for i, x in enumerate(lines):
        for j in range(i + 1, len(lines) if len(x) >= 24 else 0):
            if len(lines[j]) - len(x) > max(2, len(x) // 20):
                break
            if (len(x) < 60 or not parts[i].isdisjoint(parts[j])) and lines_linked(x, lines[j]):
                out.append((x, lines[j]))
    return lines, out
