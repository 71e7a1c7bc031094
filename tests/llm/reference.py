"""Brute-force versions of the operators, in plain Python, for small tables."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = re.compile(r"[\x20\x09-\x0D]")


def words(text):
    return WORD.findall(text or "")


def mix_targets(sizes: dict, weights=(5, 2, 1), most=3):
    """Share and reshare until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        above = [s for s in free if share[s] >= most * sizes[s]]
        if not above:
            return share | capped
        capped |= {s: most * sizes[s] for s in above}
        if len(capped) == len(names):
            return capped


def exact_classes(rows):
    """(doc_id, text) -> {doc_id: (keep_id, group_size, sha)}; doc_ids are distinct."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(WHITE.sub("", text or ""), []).append((doc_id, text or ""))
    out = {}
    for content, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        for doc_id, _ in members:
            out[doc_id] = (keep, len(members), hashlib.sha256(content.encode()).hexdigest())
    return out


def simhash(text, k=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    shingles = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(prints: dict, most=2):
    """{doc_id: fingerprint} -> {doc_id: smallest reachable doc_id}."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], dtype=np.uint64)
    seen, out = set(), {}
    for i, doc_id in enumerate(ids):
        if i in seen:
            continue
        todo, seen = [i], seen | {i}
        while todo:
            j = todo.pop()
            out[ids[j]] = doc_id
            for n in np.flatnonzero(np.bitwise_count(values ^ values[j]) <= most).tolist():
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
    return out


def kept_words(rows, k=20):
    """(doc_id, text) -> {doc_id: (n_words, n_removed, sha)} for repeated windows of k words."""
    first, covered = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            window = tuple(w[i : i + k])
            if window in first:
                gone[i : i + k] = [True] * k
            first.add(window)
        kept = [x for x, g in zip(w, gone) if not g]
        covered[doc_id] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return covered


BASE = (
    ("assign", re.compile(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def base_spans(text):
    out = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            if len(m[group]) >= least:
                out.append((m.start(), order, m.end(), kind))
    return [(k, s, e) for s, _, e, k in sorted(out)]


def crc(text):
    return zlib.crc32((text or "").encode())
