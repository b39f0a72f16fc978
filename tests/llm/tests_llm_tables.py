"""Brute force for the tests of this folder."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(rows, size=3):
    seen, out = {}, {}
    for i, t in sorted((i, t) for i, t in rows if t is not None):
        lines = t.split("\n")
        gone = set()
        for p in range(len(lines) - size + 1):
            w = tuple(lines[p : p + size])
            if not "".join(w).strip(" "):
                continue
            if w in seen:
                gone.update(range(p, p + size))
            seen.setdefault(w, (i, p))
        out[i] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}
