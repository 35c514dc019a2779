"""Plain, slow versions of the operators' contracts, for comparison."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingle_set(text: str | None, width: int) -> set:
    w = WORD.findall(lower(text or ""))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(width))))


def contained(docs, items, width=5, percent=80):
    wanted = [(i, shingle_set(t, width)) for i, t in items]
    out = []
    for d, text in docs:
        have = shingle_set(text, width)
        for i, s in wanted:
            if s and 100 * len(s & have) >= percent * len(s):
                out.append((d, i, len(s), len(s & have)))
    return sorted(out, key=str)


def near_components(docs, width, percent):
    """doc_id -> (set size, component); distinct ids."""
    sets = {d: shingle_set(t, width) for d, t in docs}
    df = Counter(x for s in sets.values() for x in s)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    seen = defaultdict(list)
    for d, s in sets.items():
        # Sets that reach the threshold share one of their rarest items (prefix filter).
        rare = sorted(s, key=lambda x: (df[x], x))[:len(s) * (100 - percent) // 100 + 1]
        for e in {e for x in rare for e in seen[x]}:
            shared = len(s & sets[e])
            if 100 * shared >= percent * (len(s) + len(sets[e]) - shared):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
        for x in rare:
            seen[x].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeats(docs, length):
    """Per row: bytes, removed bytes, runs, checksum of the rest."""
    texts = [(t or "").encode() for _, t in docs]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def private_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    )
    return [(k, *m.span()) for k, p, good in kinds for m in re.finditer(p, text) if good(m.group())]


def secret_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    assign = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def written(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def checksum(spans) -> str:
    return hashlib.sha256(written(spans).encode()).hexdigest()


def counts(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    triples = list(zip(w, w[1:], w[2:]))
    often = Counter(triples)
    covered = {i + j for i, t in enumerate(triples) if often[t] > 1 for j in range(3)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def token_pieces(text: str | None, tokenizer, capacity: int):
    import numpy as np

    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    first = len(ids) % capacity
    cuts = [0, *range(first or capacity, len(ids), capacity), len(ids)]
    return [(n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def captures(pages, least=0):
    payloads = [(p, (h or "").encode()) for p, _, h in pages]
    first: dict = {}
    for p, x in payloads:
        if p is not None and len(x) >= least:
            first[x] = min(p, first.get(x, p))
    out = []
    for p, x in payloads:
        r = first.get(x) if len(x) >= least else None
        again = r is not None and r != p
        out.append((p, len(x), base64.b32encode(hashlib.sha1(x).digest()).decode(), "revisit" if again else "response",
                    r if again else None))
    return sorted(out, key=str)


def _sum(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(rows, changed):
    """rows: (key, group, leaf); changed(i): the tampered leaf of row i or None. Per row as the manifest gives it."""
    order = lambda name: (name is not None, (name or "").encode())
    groups = defaultdict(list)
    for i, (key, group, leaf) in enumerate(rows):
        groups[group].append((key is not None, key or 0, leaf, changed(i) or "", i))

    def climb(row):
        """Levels of digests up to one, and the siblings of each place from the bottom up."""
        levels = [row]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([_sum(*below[i:i + 2]) for i in range(0, len(below), 2)])
        return levels

    def beside(levels, place):
        out = []
        for row in levels[:-1]:
            out.append((place % 2, row[place ^ 1]) if place ^ 1 < len(row) else (0, ""))
            place //= 2
        return out

    names = sorted(groups, key=order)
    trees = {g: climb([leaf for _, _, leaf, *_ in sorted(groups[g])]) for g in names}
    top = climb([trees[g][-1][0] for g in names])
    root, out = top[-1][0], {}
    for at, g in enumerate(names):
        for place, (_, _, leaf, _, i) in enumerate(sorted(groups[g])):
            way = beside(trees[g], place) + beside(top, at)
            end = changed(i) or leaf
            for left, other in way:
                end = _sum(other, end) if left else _sum(end, other)
            out[i] = (rows[i][0], leaf, trees[g][-1][0], root, _sum(*(o for _, o in way)), end, end == root)
    return [out[i] for i in range(len(rows))]


def leaf(*values) -> str:
    return _sum(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def runs(w) -> list[tuple[int, int, int]]:
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i + q - s
            smaller = (d for d in range(1, q) if all(w[x] == w[x + d] for x in range(s, s + size - d)))
            if size >= max(6, 4 * q) and next(smaller, None) is None:
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found) -> str:
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def run_digest(w) -> tuple:
    found = runs(w)
    best = min(((-size, s, q) for s, size, q in found), default=None)
    longest = (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4
    return (len(found), *longest, _sum(*(f"{s},{size},{q}\n" for s, size, q in found)), _sum(collapsed(w, found)))
