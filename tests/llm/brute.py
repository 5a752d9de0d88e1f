"""Plain Python versions of what the operators compute, for small tables."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def roots(nodes, linked) -> dict:
    """Smallest reachable node of each node; ``linked(a, b)`` for all pairs."""
    nodes = sorted(nodes)
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def simhash(text: str) -> int:
    words = WORD.findall(ascii_lower(text))
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def spots(text: str, anchors: set[str], chain: int) -> set:
    words = re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")
    content = [w for w in words if w not in anchors]
    found, n = set(), 0
    for p, w in enumerate(words):
        if w in anchors:
            if p - n + chain <= len(content):
                found.add((w, *content[p - n : p - n + chain]))
            n += 1
    return found or {tuple(words)}


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b)


def repeated_words(words: list[str]) -> int:
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(triples)
    return len({i + k for i, t in enumerate(triples) if seen[t] > 1 for k in range(3)})


def repeated_runs(rows: list[tuple[int, str]], sentences, run: int, least: int) -> dict[int, set[int]]:
    """Of each text (by doc_id) the sentences that a run found before covers."""
    seen, gone = set(), {}
    for doc_id, text in sorted(rows):
        places, _, counts = sentences(text)
        words = [tuple(text[s:e].lower().split()) for s, e in places]
        gone[doc_id] = set()
        for at in range(len(words)):
            end = at + run
            while end <= len(words) and sum(counts[at:end]) < least:
                end += 1
            if end > len(words):
                break
            key = tuple(words[at:end])
            if key in seen:
                gone[doc_id] |= set(range(at, end))
            seen.add(key)
    return gone
