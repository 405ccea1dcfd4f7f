"""Plain versions of the operators, for small tables only."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def simhash_components(texts, radius=4):
    """{doc_id: text} to {doc_id: (fingerprint, component)}."""
    prints = {i: fingerprint(t) for i, t in texts.items()}
    by_print = defaultdict(list)
    for i, p in prints.items():
        by_print[p].append(i)
    root = {p: p for p in by_print}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    distinct = list(by_print)
    for k, p in enumerate(distinct):
        for q in distinct[:k]:
            if (p ^ q).bit_count() <= radius:
                root[find(p)] = find(q)
    low = {}
    for i, p in prints.items():
        low[find(p)] = min(low.get(find(p), i), i)
    return {i: (f"{p:016x}", low[find(p)]) for i, p in prints.items()}


def repeated_strings(texts, length=50):
    """{doc_id: text} to {doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}."""
    data = {i: (t or "").encode() for i, t in texts.items()}
    first = {}
    for i in sorted(data):
        for s in range(len(data[i]) - length + 1):
            first.setdefault(data[i][s : s + length], i)
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < i:
                gone[s : s + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: size} to {source: target}, by handing out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total = sum(sizes.values())
    full = set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        share = sum(weight[s] for s in open_)
        target = {s: rest * weight[s] / share for s in open_}
        over = {s for s in open_ if target[s] > cap * sizes[s]}
        if not over:
            return target | {s: float(cap * sizes[s]) for s in full}
        full |= over
