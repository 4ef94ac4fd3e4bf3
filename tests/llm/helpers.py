"""Small tables and plain restatements that the tests hold the operators against."""

from __future__ import annotations

import hashlib
import os

import xxhash

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None, sources=None, langs=None):
    rows = [(i if ids is None else ids[i], t, langs[i] if langs else "en", sources[i] if sources else "s",
             None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def write(df, folder, name):
    df.coalesce(1).write.parquet(os.path.join(folder, f"{name}.parquet"))


def simhash(text, shingle):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(items, linked):
    """Component of each position of ``items``: the smallest position reachable."""
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def word_count(text):
    return len((text or "").encode().split())


def id_hash(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)


def water(sizes, weights, budget, most):
    """Targets of sources in order: shares by weight, capped, the excess reshared until none is above."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    left, free, target = budget * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        level = left / sum(w[i] for i in free)
        full = {i for i in free if level * w[i] >= most * sizes[i]}
        if not full:
            for i in free:
                target[i] = level * w[i]
            break
        for i in full:
            target[i] = most * sizes[i]
            left -= target[i]
        free -= full
    return target


def mixed(rows, weights, budget, most, fills):
    """taken by position for rows of (doc_id, text, source)."""
    by = {}
    for i, (_, _, source) in enumerate(rows):
        by.setdefault(source, []).append(i)
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    size = [word_count(t) for _, t, _ in rows]
    total = [sum(size[i] for i in by[s]) for s in order]
    goal = water(total, weights, budget, most)
    taken = [0] * len(rows)
    for s, all_words, target in zip(order, total, goal, strict=True):
        copies = int(target // max(all_words, 1))
        room = target - copies * all_words
        left = sorted((id_hash(rows[i][0]), i) for i in by[s] if size[i])
        chosen = set()
        for step in range(1 + fills):
            fits = [(h, i) for h, i in left if not step or size[i] <= room]
            used, rest = 0, None
            for h in sorted({h for h, _ in fits}):
                words = sum(size[i] for g, i in fits if g == h)
                if used + words > room:
                    rest = h
                    break
                used += words
                chosen |= {i for g, i in fits if g == h}
            room -= used
            left = [(h, i) for h, i in fits if rest is not None and h >= rest]
        for i in by[s]:
            taken[i] = size[i] * (copies + (i in chosen))
    return taken, {s: t for s, t in zip(order, goal, strict=True)}
