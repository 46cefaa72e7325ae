"""Plain versions of the operators, for comparison."""

import re

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, n=5):
    words = [w for w in re.split(f"[{SPACE}]+", lower(text or "")) if w]
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < n else [tuple(words[i : i + n]) for i in range(len(words) - n + 1)])


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_classes(rows):
    """{id: smallest id} over links of at least 75 %."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    edges = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[k + 1 :]
        if a != b and x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    return components({i for i, _ in sets}, edges)


def drop_lines(rows, least_chars=20, least_docs=3):
    """[(id, lines, dropped, text)] in the order of the rows."""
    key = lambda line: lower(line.strip(SPACE))
    held = {}
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= least_chars:
                    held.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines if i is None or len(held.get(key(x), ())) < least_docs or max(held[key(x)]) == i
        ]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def leaks(docs, items, overlap=0.5):
    """Pairs whose question and answer trigrams both occur in the document."""
    words = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower())
    grams = lambda w: {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
    found = set()
    for item, text in items:
        w = words(text)
        sides = grams(w[: (len(w) + 1) // 2]), grams(w[(len(w) + 1) // 2 :])
        for doc, body in docs:
            own = grams(words(body))
            if len(w) >= 5 and all(s and len(s & own) >= overlap * len(s) for s in sides):
                found.add((doc, item))
    return found
