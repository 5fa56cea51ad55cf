"""Plain reference versions of the operators for small inputs."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated_runs(texts: list[str | None], length: int = 200) -> list[tuple[int, list[tuple[int, int]], bytes]]:
    """Per text: bytes, maximal removed runs, bytes left."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        runs: list[tuple[int, int]] = []
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1] = (runs[-1][0], i + length)
                else:
                    runs.append((i, i + length))
        left, at = b"", 0
        for a, b in runs:
            left, at = left + d[at:a], b
        out.append((len(d), runs, left + d[at:]))
    return out


def shingles(text: str | None) -> set:
    w = WORD.findall(text or "")
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def near_classes(texts: list[str | None], least: float = 0.8) -> list[int]:
    """Index of the first member of each text's class."""
    sets, up = [shingles(t) for t in texts], list(range(len(texts)))

    def top(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            b = sets[j]
            linked = (texts[i] or "") == (texts[j] or "") or (a and b and len(a & b) >= least * len(a | b))
            if linked:
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return [top(i) for i in range(len(texts))]


def quality_counts(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
            "base_failed": len(words) < 10 or 100 * len(inside) > 20 * len(words)}


def best_of(vectors: dict[int, list[int]], query: int, k: int) -> list[tuple[int, int]]:
    scores = [(sum(a * b for a, b in zip(vectors[query], v)), i) for i, v in vectors.items() if i != query]
    return [(i, s) for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]]
