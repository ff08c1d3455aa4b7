"""Plain single-process versions of the corpus queries, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import combinations

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def components(nodes: list, links: set[tuple]) -> dict:
    """node -> smallest node reachable."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def shingles(text: str | None) -> frozenset[tuple[str, ...]]:
    words = WORD.findall((text or "").translate(FOLD))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def ngram_components(docs: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id)."""
    sets = {k: shingles(v) for k, v in docs.items()}
    links = set()
    for a, b in combinations(sorted(docs), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            links.add((a, b))
    groups = components(sorted(docs), links)
    return {k: (len(sets[k]), groups[k]) for k in docs}


def contamination(docs: dict[int, str | None], items: dict[int, str | None]) -> dict[int, tuple]:
    """doc_id -> (n_words, n_hit, n_items, sha256, contaminated)."""
    windows: dict[tuple[str, ...], set[int]] = defaultdict(set)
    for item, text in items.items():
        words = TERM.findall((text or "").translate(FOLD))
        for i in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[i : i + 13])].add(item)
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs.items():
        words = TERM.findall((text or "").translate(FOLD))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (key := tuple(words[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[key]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def base_secrets(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) of the base spans."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found)


def all_secrets(text: str | None, rules, allow, candidate: str) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) of base and entropy spans."""
    base = base_secrets(text)
    out = list(base)
    for m in re.finditer(candidate, text or ""):
        if any(a < m.end() and m.start() < e for a, _, _, e in base) or any(re.search(p, m[0]) for p in allow):
            continue
        for i, rule in enumerate(rules):
            if re.search(rule.shape, m[0]):
                if window_entropy(m[0], rule.window) >= rule.threshold:
                    out.append((m.start(), 3 + i, rule.kind, m.end()))
                break
    return sorted(out)


def window_entropy(text: str, window: int) -> float:
    best = 0.0
    for i in range(len(text) - window + 1):
        counts = Counter(text[i : i + window]).values()
        best = max(best, -sum(c / window * math.log2(c / window) for c in counts))
    return best


def base_lm(docs: list[tuple[int, str | None, bool]]) -> tuple[int, list[tuple[int, int, float]]]:
    """(N, [(n_tokens, n_known, base_score)]) of (id, text, learned) rows."""
    tokens = [WORD.findall((t or "").translate(FOLD)) + ["\x00end"] for _, t, _ in docs]
    counts = Counter(w for words, (_, _, learned) in zip(tokens, docs, strict=True) if learned for w in words)
    n, v = sum(counts.values()), len(counts)
    scored = [
        (len(words), sum(counts[w] > 0 for w in words), sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
        for words in tokens
    ]
    return n, scored


def cosine_components(vectors: dict[int, tuple[int | None, list | None]], threshold: float) -> dict[int, tuple[int, int]]:
    """vec_id -> (n_links, component_id)."""
    usable = {
        k: v for k, (label, v) in vectors.items()
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    links, n = set(), Counter()
    for a, b in combinations(sorted(usable), 2):
        x, y = usable[a], usable[b]
        if vectors[a][0] == vectors[b][0] and len(x) == len(y):
            dot = sum(p * q for p, q in zip(x, y, strict=True))
            if dot / math.sqrt(sum(p * p for p in x) * sum(q * q for q in y)) >= threshold:
                links.add((a, b))
                n.update((a, b))
    groups = components(sorted(vectors), links)
    return {k: (n[k], groups[k]) for k in vectors}
