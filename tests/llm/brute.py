"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
SECRETS = (
    ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]+"),
)


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def valid(kind: str, match: re.Match) -> bool:
    digits = re.sub("[^0-9]", "", match.group())
    if kind == "ip":
        return all(int(part) <= 255 for part in match.group().split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "assign":
        return len(match.group(2)) >= 6
    if kind == "access":
        return len(match.group()) >= 20
    return kind != "hex" or len(match.group()) >= 24


def spans(text: str | None, kinds) -> tuple:
    """Counts per kind, the digest and the spans as text."""
    found = sorted(
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern) in enumerate(kinds)
        for m in re.finditer(pattern, text or "", re.A | (re.I if kind == "assign" else 0))
        if valid(kind, m)
    )
    joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found)
    counts = tuple(sum(f[2] == kind for f in found) for kind, _ in kinds)
    return (*counts, hashlib.sha256(joined.encode()).hexdigest(), joined)


def shingles(text: str | None, size: int) -> frozenset:
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_copies(rows: list[tuple], size: int, percent: int) -> list[tuple]:
    """(doc_id, shingles, smallest doc_id reachable) for rows (doc_id, text)."""
    sets = [shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[root(i)].append(doc)
    return sorted((doc, len(sets[i]), min(least[root(i)])) for i, (doc, _) in enumerate(rows))


def code_length(train: list[bytes], text: bytes, symbols: int, order: int = 3) -> float:
    """Bits of a text under prediction by partial matching with the counts of ``train``."""
    counts: dict[bytes, Counter] = defaultdict(Counter)
    for own in train:
        padded = b" " * order + own
        for i in range(order, len(padded)):
            for n in range(order + 1):
                counts[padded[i - n : i]][padded[i]] += 1
    bits, padded = 0.0, b" " * order + text
    for i in range(order, len(padded)):
        for n in range(order, -1, -1):
            seen = counts.get(padded[i - n : i])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if padded[i] in seen:
                bits -= math.log2(seen[padded[i]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
        else:
            bits += math.log2(symbols)
    return bits


def local_score(a: list, b: list, match: int = 2, mismatch: int = -1, gap: int = -1) -> int:
    """Smith-Waterman score."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            step = match if x == y else mismatch
            table[i][j] = max(0, table[i - 1][j - 1] + step, table[i - 1][j] + gap, table[i][j - 1] + gap)
            best = max(best, table[i][j])
    return best
