"""Plain Python versions of what the operators compute, for small inputs."""

import re
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern=WORDS):
    return pattern.findall((text or "").translate(LOWER))


def shingles(w, width):
    return frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def groups(keys, linked):
    """Smallest key reachable from each, by links."""
    up = {k: k for k in keys}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {k: root(k) for k in keys}


def jaccard_links(sets, share=80):
    """All pairs of keys with 100 * intersection >= share * union, by an inverted list."""
    seen, out = defaultdict(list), []
    for k, s in sets.items():
        common = Counter(j for g in s for j in seen[g])
        out += [(j, k) for j, n in common.items() if 100 * n >= share * (len(s) + len(sets[j]) - n)]
        for g in s:
            seen[g].append(k)
    return out


def clashing(df):
    """Extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    for name in ("id", "tid", "rid", "node", "component", "size", "key", "vector", "n_words", "spans", "score", "weight"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df
