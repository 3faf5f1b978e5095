"""Plain Python forms of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def substrings(rows, length):
    """Byte counts, removed bytes, runs and digest by row, strings of ``length`` bytes repeated."""
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        rank = (i is None, i or 0)
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            first[w] = min(first.get(w, (rank, p)), (rank, p))
    out = []
    for i, text in rows:
        data, rank = (text or "").encode(), (i is None, i or 0)
        gone, own = bytearray(len(data)), set()
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if first[w][0] < rank or w in own:
                gone[p : p + length] = b"\1" * length
            own.add(w)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), len(data) - len(kept), spans, sha(kept)))
    return out


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_pii(doc_id, text) -> tuple:
    spans = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(number) <= 19 and luhn(number)):
                continue
            if kind == "phone" and not 8 <= len(number) <= 15:
                continue
            spans.append((kind, m.start(), m.end()))
    counts = [sum(s[0] == kind for s in spans) for kind in KINDS]
    return (doc_id, *counts, sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()))


def fingerprint(text) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lowered)
    if not w:
        return 0
    parts = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(items, linked):
    """Smallest-index root of each item under a symmetric relation."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(items)):
        for b in range(a):
            if linked(items[a], items[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(items))]


def simhash(rows):
    """Row to hex fingerprint and smallest id reachable."""
    prints = [fingerprint(text) for _, text in rows]
    distinct = sorted(set(prints))
    roots = dict(zip(distinct, components(distinct, lambda a, b: (a ^ b).bit_count() <= 3)))
    least = defaultdict(list)
    for (i, _), f in zip(rows, prints):
        if i is not None:
            least[roots[f]].append(i)
    return [(i, f"{f:016x}", min(least[roots[f]], default=None)) for (i, _), f in zip(rows, prints)]


def line_dedup(rows):
    """Texts without the lines of pairs that an earlier document or place of the text has."""

    def pairs(text):
        lines = (text or "").split("\n")
        both = [(k, (lines[k], lines[k + 1])) for k in range(len(lines) - 1)]
        return [(k, pair) for k, pair in both if any(line.strip(" \t\n\r\x0b\x0c") for line in pair)]

    first = {}
    for i, text in rows:
        rank = (i is None, i or 0)
        for _, pair in pairs(text):
            first[pair] = min(first.get(pair, rank), rank)
    out = []
    for i, text in rows:
        own, gone = set(), set()
        for k, pair in pairs(text):
            if first[pair] < (i is None, i or 0) or pair in own:
                gone |= {k, k + 1}
            own.add(pair)
        lines = [line for k, line in enumerate((text or "").split("\n")) if k not in gone]
        out.append((i, None if text is None else "\n".join(lines)))
    return out


def quality(doc_id, text) -> tuple:
    t, w = text or "", words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    repeated = {k + d for k, g in enumerate(zip(w, w[1:], w[2:])) if windows[g] > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return (
        doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
        len(repeated), failed,
    )


def warc(pages):
    """Record facts by page row."""
    rows = []
    for i, html in pages:
        data = (html or "").encode()
        rows.append((i, len(data), sha(data)))
    ids = defaultdict(list)
    for i, size, digest in rows:
        if size >= 100 and i is not None:
            ids[digest].append(i)
    out = []
    for i, size, digest in rows:
        first = min(ids[digest], default=None) if size >= 100 else None
        again = first is not None and i != first
        out.append((i, size, digest, "revisit" if again else "response", first if again else None))
    return out


def near_passages(rows, words_least, limit):
    """Class of each document: passages of ``words_least`` words whose 5-word shingles are similar."""
    cut = [(text or "").lower().split() for _, text in rows]

    def passages(w):
        s = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        return [frozenset(s[k : k + words_least - 4]) for k in range(len(w) - words_least + 1)]

    sets = [passages(w) for w in cut]

    def linked(a, b):
        return any(len(p & q) >= limit * len(p | q) for p in sets[a] for q in sets[b])

    return components(range(len(rows)), linked)
