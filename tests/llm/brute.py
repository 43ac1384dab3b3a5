"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import collections
import re

import xxhash


def words(text):
    return (text or "").encode().split()


def fingerprint(text):
    w = words((text or "").encode().lower().decode())
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius=2):
    """id -> smallest id reachable; fps: list of (id, fingerprint)."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(fps):
        low[find(i)] = min(low.get(find(i), k), k)
    return [low[find(i)] for i in range(len(fps))]


def removed_words(texts, length=50):
    """[(n_words, n_removed, kept)] of [(id, text)]."""
    first = {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        w = words(t)
        for j in range(len(w) - length + 1):
            first.setdefault(tuple(w[j : j + length]), i)
    out = []
    for i, t in texts:
        w = words(t)
        keep = [True] * len(w)
        for j in range(len(w) - length + 1):
            if first[tuple(w[j : j + length])] < i:
                keep[j : j + length] = [False] * length
        out.append((len(w), keep.count(False), b" ".join(x for x, k in zip(w, keep, strict=True) if k).decode()))
    return out


def kept_lines(texts, similarity=0.8):
    """[(n_lines, n_removed, text)] of [(id, text)], ids ascending and distinct."""
    seen, out = [], []
    for _, t in texts:
        kept = []
        lines = t.split("\n") if t is not None else []
        for line in lines:
            s = frozenset(words(line))
            if s and any(len(s & o) >= similarity * len(s | o) - 1e-9 for o in seen):
                seen.append(s)
                continue
            if s:
                seen.append(s)
            kept.append(line)
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept) if t is not None else None))
    return out


def leaks(texts, items, similarity=0.8):
    """{(doc, item): similarity of the best window}."""
    found = {}
    for i, t in texts:
        w = words((t or "").lower())
        for j, x in items:
            b = words((x or "").lower())
            if not b:
                continue
            k = min(5, len(b))
            want = collections.Counter(tuple(b[p : p + k]) for p in range(len(b) - k + 1))
            have = [tuple(w[p : p + k]) for p in range(len(w) - k + 1)]
            m = sum(want.values())
            for s in range(max(0, len(have) - m) + 1 if have else 0):
                got = collections.Counter(have[s : s + m])
                o = sum((got & want).values())
                sim = o / (m + sum(got.values()) - o)
                if sim >= similarity - 1e-9:
                    found[i, j] = max(found.get((i, j), 0), sim)
    return found


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum((int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "card" and 13 <= len(d) <= 19 and luhn or kind == "phone" and 9 <= len(d) <= 15:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t = text or ""
    w = [x.decode() for x in words(t)]
    grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {p + k for p in range(len(w) - 2) if grams[w[p], w[p + 1], w[p + 2]] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)
