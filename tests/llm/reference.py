"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def quality(text: str | None, limits) -> dict:
    text = text or ""
    words = WORD.findall(text)

    def covered(n: int) -> list[int]:
        count = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
        return sorted({j for i in range(len(words) - n + 1) if count[tuple(words[i:i + n])] > 1 for j in range(i, i + n)})

    seen, dup_lines, line_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup_lines += 1
                line_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
           "n_dup_lines": dup_lines, "n_repeat_words": len(covered(3))}
    out["base_failed"] = out["n_words"] < limits.min_words or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    shares = [(sum(len(words[i]) for i in covered(n)), share) for n, share in limits.ngrams] + [(line_chars, limits.lines)]
    out["kept"] = not (out["base_failed"] or any(c > share * out["word_chars"] for c, share in shares) or out["n_symbols"] > limits.symbols * out["n_words"])
    return out


def suffix_dedup(docs: list[tuple[int, str | None]], length: int) -> dict[int, tuple[int, int, int, bytes]]:
    """doc_id -> (n_bytes, n_removed, n_spans, kept); ids are unique."""
    seen, out = set(), {}
    for key, text in sorted(docs):
        data = (text or "").encode()
        windows = [data[i:i + length] for i in range(len(data) - length + 1)]
        gone = [False] * len(data)
        for i, w in enumerate(windows):
            if w in seen:
                gone[i:i + length] = [True] * length
        seen.update(windows)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g))
    return out


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, a):
        self.parent.setdefault(a, a)
        while self.parent[a] != a:
            a = self.parent[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def shingles(text: str | None, n: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def jaccard_components(docs: list[tuple[int, str | None]], words: int, percent: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id)."""
    sets, union = {k: shingles(t, words) for k, t in docs}, Union()
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                union.join(a, b)
    return {k: (len(sets[k]), union.find(k)) for k in keys}


def cosine_components(rows: list[tuple[int, list | None]], threshold: float) -> dict[int, tuple[int, int]]:
    """vec_id -> (n_links, component_id)."""
    import math

    union, n = Union(), defaultdict(int)

    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if good(x) and good(y) and len(x) == len(y):
                c = sum(p * q for p, q in zip(x, y)) / math.sqrt(sum(p * p for p in x) * sum(q * q for q in y))
                if c >= threshold:
                    union.join(a, b)
                    n[a] += 1
                    n[b] += 1
    return {k: (n[k], union.find(k)) for k, _ in rows}
