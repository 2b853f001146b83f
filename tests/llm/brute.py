"""Brute-force versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WS_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def fingerprint(text: str | None) -> int:
    w = WS_WORD.findall(lower(text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0


def components(fps: dict) -> dict:
    """key -> smallest key reachable over at most three differing bits."""
    keys = sorted(fps)
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                ra, rb = sorted((find(a), find(b)))
                parent[rb] = ra
    return {k: find(k) for k in keys}


def lpf(docs: list[tuple[int, str | None]], length: int = 50) -> dict:
    """doc_id -> (n_bytes, n_removed, n_spans, sha) for distinct ids."""
    first: dict[bytes, int] = {}
    for i, t in docs:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < i:
                for k in range(s, s + length):
                    gone[k] = True
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(text: str | None, items: list[tuple[str, str | None]]):
    words = BENCH_WORD.findall(lower(text or ""))
    hit, found = [False] * len(words), set()
    where = defaultdict(list)
    for i, w in enumerate(words):
        where[w].append(i)
    for item, t in items:
        iw = BENCH_WORD.findall(lower(t or ""))
        if not iw:
            continue
        for s in range(max(1, len(iw) - 12)):
            win = iw[s : s + 13]
            for p in where.get(win[0], ()):
                if words[p : p + len(win)] == win:
                    found.add(item)
                    for k in range(p, p + len(win)):
                        hit[k] = True
    n = sum(hit)
    return len(words), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and 20 * n >= len(words)


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secrets(text: str | None):
    t = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    spans.sort()
    n = Counter(s[2] for s in spans)
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(joined.encode()).hexdigest(), joined


def quality(text: str | None):
    t = text or ""
    w = WS_WORD.findall(t)
    lines = [x for x in t.split("\n") if WS_WORD.search(x)]
    dup = len(lines) - len(set(lines))
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    in_rep = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i : i + 8])] >= 2:
            in_rep.update(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(in_rep) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(in_rep), failed


def jump(key: int, n: int) -> int:
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def host_path(url: str | None):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    m = re.match(r"[^/?#]*", rest)
    return lower(m[0]), re.match(r"[^?#]*", rest[m.end() :])[0]


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url_rule(host: str, path: str):
    fit = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[0])) if fit else (None, None)


def targets(sizes: dict, weights=(3, 1, 2), budget=1.5, cap=2.0) -> dict:
    """source -> target by repeated sharing; None sorts last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, live, out = budget * sum(sizes.values()), list(order), {}
    while live:
        level = left / sum(w[s] for s in live)
        full = [s for s in live if cap * sizes[s] <= level * w[s]]
        if not full:
            out |= {s: level * w[s] for s in live}
            break
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
            live.remove(s)
    return out
