"""Plain versions of the operators, one row at a time, for comparison."""

from __future__ import annotations

import hashlib
import math
import re

from batchlake.llm import secrets as sc

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")


def bits(window: str) -> float:
    return -sum(n / len(window) * math.log2(n / len(window)) for n in (window.count(c) for c in set(window)))


def secret_spans(text: str | None) -> tuple[list, list]:
    """Spans of the three patterns, and those of the entropy windows, as (start, rank, end)."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    added = []
    for m in CANDIDATE.finditer(text):
        s = m[0]
        hexes = re.search(sc.HEX_ONLY, s)
        if len(s) < sc.WINDOW or not (hexes or re.search(sc.MIXED, s)) or re.search(sc.ALLOWED, s):
            continue
        need = sc.HEX_BITS if hexes else sc.WIDE_BITS
        runs: list[list[int]] = []
        for i in range(len(s) - sc.WINDOW + 1):
            if bits(s[i : i + sc.WINDOW]) >= need - 1e-6:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + sc.WINDOW
                else:
                    runs.append([i, i + sc.WINDOW])
        added += [(m.start() + a, 3, m.start() + b) for a, b in runs]
    added = [w for w in added if not any(b[0] <= w[0] and w[2] <= b[2] for b in base)]
    return sorted(base), added


def listed(spans: list) -> str:
    return ",".join(f"{sc.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def secret_row(text: str | None) -> tuple:
    base, added = secret_spans(text)
    kinds = [k for _, k, _ in base]
    digest = hashlib.sha256(listed(base).encode()).hexdigest()
    return kinds.count(0), kinds.count(1), kinds.count(2), len(added), digest, listed(base + added)


def shingles(text: str | None, n: int) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def components(n: int, links) -> list[int]:
    """For each of n places the least place it reaches."""
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        a, b = top(i), top(j)
        root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def jaccard_links(texts: list, n: int, percent: int) -> list[tuple[int, int]]:
    sets = [shingles(t, n) for t in texts]
    return [
        (i, j)
        for i in range(len(sets))
        for j in range(i + 1, len(sets))
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
