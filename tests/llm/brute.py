"""Plain single-machine versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import zlib
from itertools import combinations

import numpy as np
import xxhash


def union(nodes, pairs):
    """node -> smallest node of its component."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def bpe_rows(docs, path):
    from tokenizers import Tokenizer

    tok, out = Tokenizer.from_file(path), []
    for i, text in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        out.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out)


def record_rows(docs, path):
    from tokenizers import Tokenizer

    tok, out, start = Tokenizer.from_file(path), [], 0
    for i, text in sorted(docs, key=lambda d: d[0]):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def simhash(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    votes, shingles = [0] * 64, [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def simhash_rows(docs, k, radius):
    found = [(i, simhash(t, k)) for i, t in docs]
    by = {}
    for i, f in found:
        by.setdefault(f, []).append(i)
    fps = np.array(sorted(by), np.uint64)
    pairs = []
    for n, f in enumerate(fps):
        for m in np.flatnonzero(np.bitwise_count(fps[n + 1 :] ^ f) <= radius):
            pairs.append((int(f), int(fps[n + 1 + m])))
    root = union([int(f) for f in fps], pairs)
    least = {}
    for f, ids in by.items():
        least[root[f]] = min(least.get(root[f], min(ids)), min(ids))
    return sorted((i, f"{f:016x}", least[root[f]]) for i, f in found)


def vector_rows(rows, threshold=0.9):
    good = {
        i: np.array(v, np.float64)
        for i, v in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    }
    ids = sorted(good)
    x = np.array([good[i] / np.linalg.norm(good[i]) for i in ids]).reshape(len(ids), -1)
    close = x @ x.T >= threshold if ids else np.zeros((0, 0), bool)
    pairs = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(close, 1)))]
    root = union([i for i, _ in rows], pairs)
    n = dict.fromkeys(root, 0)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    return sorted((i, n[i], root[i], root[i] == i) for i, _ in rows)


def repeats(docs, size=100):
    """Rows of the exact-substring contract."""
    data = sorted((i, (t or "").encode()) for i, t in docs)
    seen, out = set(), []
    for i, raw in data:
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - size + 1):
            piece = raw[at : at + size]
            if piece in seen:
                gone[at : at + size] = True
            seen.add(piece)
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if raw else b""
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def line_rows(docs, threshold=0.8):
    """(id, kept text): later lines with Jaccard >= threshold to an earlier one go."""
    seen, out = [], []
    for i, text in sorted(docs, key=lambda d: d[0]):
        kept = []
        for line in (text or "").split("\n"):
            words = frozenset(line.lower().split())
            if not words:
                kept.append(line)
                continue
            n = len(words)
            hit = any(
                threshold * max(n, len(o)) <= min(n, len(o)) + 1e-9 and len(words & o) >= threshold * len(words | o) - 1e-9
                for o in seen
            )
            seen.append(words)
            if not hit:
                kept.append(line)
        out.append((i, "\n".join(kept)))
    return out


def shingles(text, k=5):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({" ".join(w)} if w else set())


def leaks(docs, items, threshold=0.8, k=5):
    """(doc, item) with at least ``threshold`` of the item's shingles in the document."""
    own = [(j, shingles(t, k)) for j, t in items]
    out = set()
    for i, t in docs:
        s = shingles(t, k)
        for j, q in own:
            if q and len(q & s) >= threshold * len(q) - 1e-9:
                out.add((i, j))
    return out


def secret_rows(docs):
    import math
    import re

    from quorumlens.llm import secrets

    out = []
    allowed = re.compile("|".join(f"(?:{a})" for a in secrets.ALLOWED))
    for i, text in docs:
        text, base, more = text or "", [], []
        for order, (kind, pattern, group, least) in enumerate(secrets.FORMS):
            for m in re.finditer(pattern, text):
                if len(m.group(group)) >= least:
                    base.append((m.start(), order, m.end(), kind))
        for order, c in enumerate(secrets.CLASSES, len(secrets.FORMS)):
            for m in re.finditer(c.pattern, text):
                if allowed.fullmatch(m.group()):
                    continue
                spans = []
                for at in range(len(m.group()) - c.window + 1):
                    part = m.group()[at : at + c.window]
                    h = -sum(part.count(x) / c.window * math.log2(part.count(x) / c.window) for x in set(part))
                    if h >= c.bits - 1e-9:
                        lo, hi = m.start() + at, m.start() + at + c.window
                        if spans and lo <= spans[-1][1]:
                            spans[-1][1] = hi
                        else:
                            spans.append([lo, hi])
                more += [(a, order, b, c.kind) for a, b in spans]
        join = lambda v: ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(v))
        n = [sum(s[1] == k for s in base) for k in range(3)]
        out.append((i, *n, hashlib.sha256(join(base).encode()).hexdigest(), join(base + more)))
    return sorted(out)
