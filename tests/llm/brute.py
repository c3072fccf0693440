"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def overlap(text, items, size=13):
    """(words, hit words, found items) of a text."""
    own, hit, found = words(text), set(), set()
    for item_id, other in items:
        item = words(other)
        for start in range(max(1, len(item) - size + 1) if item else 0):
            window = item[start : start + size]
            for at in range(len(own) - len(window) + 1):
                if own[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(item_id)
    return len(own), len(hit), found


def near_duplicates(rows, size=5, similarity=0.8):
    """{row number: (class id, links)} for (doc_id, text) rows."""
    sets = []
    for _, text in rows:
        own = words(text)
        sets.append(frozenset(tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))) if own else frozenset())
    links, group = Counter(), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            common = len(sets[i] & sets[j])
            if common >= similarity * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    lowest = defaultdict(list)
    for i, g in enumerate(group):
        if rows[i][0] is not None:
            lowest[g].append(rows[i][0])
    return {i: (min(lowest[g]) if rows[i][0] is not None else None, links[i]) for i, g in enumerate(group)}


def base_spans(text):
    assign = re.compile(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def targets(sizes, weights=(5, 2, 1), repeats=3):
    """{source: target} by sharing out again and again what stopped sources leave."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > repeats * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = repeats * sizes[s]
        left -= sum(out[s] for s in over)
        free -= set(over)
    return out
