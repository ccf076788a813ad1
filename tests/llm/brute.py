"""Plain Python versions of the contracts, written apart from the operators."""

from __future__ import annotations

import itertools
import re
import zlib

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text, pattern=r"[^\x20\x09-\x0D]+", lower=True):
    text = text or ""
    return re.findall(pattern, text.translate(LOWER) if lower else text)


def tokens(text):
    return words(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, k):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def components(docs, k, percent):
    """docs: [(doc_id, text)] with distinct ids; {doc_id: component}."""
    sets = {i: shingles(t, k) for i, t in docs}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    common = {}
    for ids in index.values():
        for a, b in itertools.combinations(ids, 2):
            common[a, b] = common.get((a, b), 0) + 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {i: top(i) for i in sets}


def crc_of_ids(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
