"""What the operators must return, worked out the plain way."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def sha256(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else bytes(data)).hexdigest()


def components(nodes, links) -> dict:
    """Each node with the smallest of its component."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def repeated_bytes(texts: list[bytes], length: int) -> list[tuple[int, int, int, bytes]]:
    """Bytes, removed bytes, removed runs and bytes left of each text."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def shingle_set(text: str, words: int = 5) -> frozenset:
    parts = re.findall(r"[^ \t\n\x0b\x0c\r]+", text.lower())
    return frozenset(tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))) if parts else frozenset()


def jaccard_links(texts: dict) -> list[tuple]:
    """Pairs of ids whose shingle sets are at least 0.8 similar."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for shingle in s or [()]:
            holders[shingle].append(i)
    pairs = {(a, b) for ids in holders.values() for k, b in enumerate(ids) for a in ids[:k]}
    similar = lambda a, b: a == b or 10 * len(a & b) >= 8 * len(a | b)
    return [(a, b) for a, b in pairs if similar(sets[a], sets[b])]


ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base_secrets(text: str) -> list[tuple[int, int, str, int]]:
    """``start, rank, kind, end`` of base matches."""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def edit_distance_within(pattern: str, text: str) -> int:
    """Least edit distance of the pattern to any piece of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != t))
    return min(row)


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Smallest capacity that contiguous shards of whole groups need."""

    def enough(capacity: int) -> bool:
        used, level = 1, 0
        for size in sizes:
            if size > capacity:
                return False
            if level + size > capacity:
                used, level = used + 1, 0
            level += size
        return used <= shards

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if enough(middle) else (middle + 1, high)
    return low


def line_key(line: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(upper, upper.lower()))


def lines_kept(texts: dict) -> dict:
    """Per id the text without lines that a smaller id holds."""
    first = {}
    for i, text in texts.items():
        for line in text.split("\n"):
            key = line_key(line)
            first[key] = min(i, first.get(key, i))
    kept = {}
    for i, text in texts.items():
        stays = [line for line in text.split("\n") if len(line_key(line)) < 10 or first[line_key(line)] == i]
        kept[i] = "\n".join(stays)
    return kept
