"""Plain versions of the operators' results, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def remainder(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def fingerprint(text):
    words = space_words(text)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else (
        [" ".join(words)] if words else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += (h >> b) & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def linked(values, max_bits=3):
    """Representative index of each value's component."""
    f = np.array(values, np.uint64)
    parent = list(range(len(f)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= max_bits):
            parent[find(int(j))] = find(i)
    return [find(i) for i in range(len(f))]


def smallest_ids(ids, roots):
    least = {}
    for i, r in zip(ids, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [least.get(r) for r in roots]


def repeats(texts, length):
    """(bytes, removed, spans, sha256 of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p:p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        covered = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                covered[p:p + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if covered[i] and (i == 0 or not covered[i - 1]))
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out.append((len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def contaminated(texts, items, window=13):
    """(n_words, n_hit, item ids) of each text; items are (id, text)."""
    where = collections.defaultdict(set)
    for item, text in items:
        w = plain_words(text)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            where[tuple(w[s:s + window])].add(item)
    sizes = {len(k) for k in where}
    out = []
    for text in texts:
        w, hit, ids = plain_words(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                found = where.get(tuple(w[s:s + n]))
                if found:
                    hit |= set(range(s, s + n))
                    ids |= {str(i) for i in found if i is not None}
        out.append((len(w), len(hit), sorted(ids)))
    return out


def base_scores(rows):
    """{row number: (n_tokens, n_known, base score)} and N; rows are (id, text)."""
    tokens = [[*space_words(t), None] for _, t in rows]
    counts = collections.Counter()
    for (i, _), t in zip(rows, tokens):
        if remainder(i, 7) not in (2, None):
            counts.update(t)
    total, distinct = sum(counts.values()), len(counts)
    scores = [(len(t), sum(counts[x] > 0 for x in t),
               sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in t))
              for t in tokens]
    return scores, total
