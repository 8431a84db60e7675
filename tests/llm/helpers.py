"""Brute-force versions that the operators are held against."""

import base64
import hashlib
import math
import re
import zlib

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def warc(pages):
    first = {}
    for p, _, h in pages:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    out = []
    for p, _, h in pages:
        b, f = (h or "").encode(), first.get(h or "")
        revisit = f is not None and p != f
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=repr)


def simhash(text):
    import xxhash
    w = words((text or "").translate(LOWER))
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if sum(x >> k & 1 for x in h) * 2 > len(h))


def components(prints, radius=2):
    """Index -> smallest index reachable over pairs within the radius."""
    n = len(prints)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def water_fill(sizes, weights, cap=3):
    """Targets by repeated clamping."""
    total, clamped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in clamped)
        w = sum(weights[s] for s in sizes if s not in clamped)
        more = {s for s in sizes if s not in clamped and w and weights[s] * left > cap * sizes[s] * w}
        if not more:
            return {s: float(cap * sizes[s]) if s in clamped else weights[s] * left / w if w else 0.0 for s in sizes}
        clamped |= more


def top_k(vectors, k=5, every=50):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors
          if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i is not None and i % every == 0}):
        qv = min(v for i, v in ok if i == q)
        scored = sorted(((-sum(a * b for a, b in zip(qv, v, strict=False)), i is None, i or 0, i) for i, v in ok if i != q))
        out += [(q, r + 1, i, -s) for r, (s, _, _, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def spotsigs(docs, signatures, to_string):
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0)))
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    out = []
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + n[:half]
        a, b, c = signatures(t), signatures(e), signatures(n)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), to_string(a), to_string(b), like(a, b), like(a, c), len(a)))
    return sorted(out, key=repr)


# --- conversations ---------------------------------------------------------

def by_turn(rows):
    """Conversation id -> its rows (turn, role, text) in order; ``rows`` without nulls but in the turn."""
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t, r, x))
    return out


def rebuilt(rows):
    """Conversation id -> list of (role, text), first turns grafted."""
    own = by_turn((c, t, r or "", x or "") for c, t, r, x in rows if c is not None)
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda m: (m[0] is not None, m[0] or 0, m[1], hashlib.sha256(
        f"{len(m[1])}:{m[1]}{m[2]}".encode()).hexdigest()))] for c, v in own.items()}
    first = lambda c: zlib.crc32(str(c).encode()) % 6
    source = lambda c: c - int(math.fmod(c, 100))
    return {c: own.get(source(c), [])[:first(c)] + v[first(c):] for c, v in own.items()}


def trie(convs):
    """Rows of the prefix trie by plain recursion over whole prefixes."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {}
    for p in members:
        if p:
            below.setdefault(p[:-1], []).append(p)
    out = []
    for p, m in members.items():
        under = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in m if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below.get(p, [])), sum(q not in below for q in under),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in under if q), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def damaged(rows):
    """Every conversation id -> rows (turn, role, text) after damage, in order."""
    out = {c: [] for c, *_ in rows}
    name = lambda v: " " if v is None else str(v)
    for c, t, r, x in rows:
        fault, r, x = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20, name(r), name(x)
        if fault == 1:
            x = ""
        elif fault == 2:
            x = re.sub("[.!?]", "", x)
        elif fault == 4:
            r = "user"
        out[c] += [(t, r, x)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {c: sorted(v, key=lambda m: (m[0] is not None, m[0] or 0, m[1].encode(), m[2].encode())) for c, v in out.items()}


def repaired(rows):
    """Counts, cost, audit and digest of one conversation by dynamic
    programming over whole edit strings, state by state."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    kinds, seen = [], set()
    for _, r, x in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", x)
        kinds.append("blank" if not solid else "duplicate" if (r, x) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((r, x))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    good = re.compile(r"s?(ua)*u?")                # prefixes of what is accepted
    best = {"": (0, "", ())}                       # last two letters given -> cheapest (cost, audit, lines)

    def key(given):
        return given if len(given) < 2 else "*" + given[-1]

    def inserted(best):
        grown = True
        while grown:
            grown = False
            for g, (c, a, lines) in list(best.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    if not good.fullmatch(("su" if g == "*u" else "sua" if g == "*a" else g) + letter):
                        continue
                    k, new = key(("xx" if g.startswith("*") else "") + g[-1:] + letter if g else letter), (c + 2, a + "I", (*lines, f"{role}:"))
                    if k not in best or new[:2] < best[k][:2]:
                        best[k], grown = new, True
        return best

    for (_, r, x), kind in zip(rows, kinds, strict=True):
        best, after = inserted(best), {}
        for g, (c, a, lines) in best.items():
            options = [(3, "D", None)]
            if kind not in ("blank", "duplicate"):
                extra = int(kind == "truncated")
                options += [(extra, "K", r), (2 + extra, "R", "user"), (2 + extra, "R", "assistant")]
            for cost, edit, role in options:
                k, new = g, (c + cost, a + edit, lines if role is None else (*lines, f"{role}:{x}"))
                if role is not None:
                    if role[:1] not in ("s", "u", "a") or not good.fullmatch(("su" if g == "*u" else "sua" if g == "*a" else g) + role[:1]):
                        continue
                    k = key(("xx" if g.startswith("*") else "") + g[-1:] + role[:1] if g else role[:1])
                if k not in after or new[:2] < after[k][:2]:
                    after[k] = new
        best = after
    best = inserted(best)
    cost, audit, lines = min(v for g, v in best.items() if g in ("", "*a"))
    return (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


# --- secrets ---------------------------------------------------------------

def base_spans(text):
    """Base spans as (kind, start, end), by position-by-position scans."""
    text, out = text or "", []
    for n, (kind, pattern, flags, group, least) in enumerate((
            ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 12),
            ("access", "AKIA[A-Z0-9]+", 0, 0, 18), ("hex", "[0-9a-f]+", 0, 0, 16))):
        at, find = 0, re.compile(pattern, flags)
        while m := find.search(text, at):
            if len(m.group(group)) >= least:
                out.append((m.start(), n, kind, m.end()))
            at = m.end()
    return [(k, a, z) for a, _, k, z in sorted(out)]
