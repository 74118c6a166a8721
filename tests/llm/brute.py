"""Plain Python versions of the operators, for small inputs."""

import collections
import hashlib
import math
import zlib


class Groups:
    def __init__(self, members):
        self.up = {m: m for m in members}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y):
        a, b = self.find(x), self.find(y)
        self.up[max(a, b)] = min(a, b)


def words(text):
    return (text or "").encode().split()


def held_out(key, modulus):
    return key is not None and zlib.crc32(str(key).encode()) % modulus == 2


def windows_removed(rows, width=13):
    """(id, n_words, n_removed, digest) per row; a null id is larger than all."""
    order = lambda i: math.inf if i is None else i
    least = {}
    for i, text in rows:
        w = words(text)
        for p in range(len(w) - width + 1):
            k = tuple(w[p:p + width])
            least[k] = min(least.get(k, math.inf), order(i))
    out = []
    for i, text in rows:
        w = words(text)
        gone = set()
        for p in range(len(w) - width + 1):
            if least[tuple(w[p:p + width])] < order(i):
                gone.update(range(p, p + width))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def shingle_set(text, width):
    w = [x.lower() for x in words(text)]
    n = min(width, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def jaccard_groups(sets, percent=80):
    groups, ids = Groups(sets), [k for k, s in sets.items() if s]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    groups.join(a, b)
    return groups


def near_duplicates(rows, width, percent=80):
    sets = {i: shingle_set(t, width) for i, t in rows}
    groups = jaccard_groups(sets, percent)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


def fold(line):
    return " ".join(line.lower().split())


def line_dedup(rows, width=8, percent=80):
    """{id: (n_lines, n_removed, text)} for rows with distinct ids; a null id comes last."""
    nodes = sorted({fold(x) for _, t in rows for x in (t or "").split("\n")} - {""})
    sets = {n: {n[i:i + width] for i in range(len(n) - width + 1)} if len(n) >= width else {n} for n in nodes}
    groups, seen, out = jaccard_groups(sets, percent), set(), {}
    for i, text in sorted(rows, key=lambda r: math.inf if r[0] is None else r[0]):
        kept, n, lost = [], 0, 0
        for line in (text or "").split("\n"):
            if node := fold(line):
                n += 1
                if groups.find(node) in seen:
                    lost += 1
                    continue
                seen.add(groups.find(node))
            kept.append(line)
        out[i] = (n, lost, "\n".join(kept))
    return out


def unigram_base(rows, folds=7):
    counts, tokens = collections.Counter(), []
    for i, text in rows:
        w = [x.lower() for x in words(text)] + [None]
        tokens.append((i, w))
        if not held_out(i, folds):
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, held_out(i, folds), len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w))
        for i, w in tokens
    ]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
