"""Plain versions of the operators, row by row, straight from their definitions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

SPACES = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def base_statistics(text):
    text = text or ""
    words = re.findall(SPACES, text)
    lines = [x for x in text.split("\n") if re.search(SPACES, x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {p for i, w in enumerate(windows) if count[w] > 1 for p in (i, i + 1, i + 2)}
    n, repeat = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat,
            n < 50 or 100 * repeat > 50 * n)


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def fingerprint(text, shingle=4):
    words = re.findall(SPACES, lower(text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + shingle]).encode(), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows, max_bits=4):
    """[(doc_id, fingerprint, component_id)] of (doc_id, text) rows with doc_ids."""
    marks = [(i, fingerprint(t)) for i, t in rows]
    values = sorted({f for _, f in marks})
    parent = {f: f for f in values}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for k, a in enumerate(values):
        for b in values[k + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                parent[root(a)] = root(b)
    least = {}
    for i, f in marks:
        least[root(f)] = min(least.get(root(f), i), i)
    return [(i, f"{f:016x}", least[root(f)]) for i, f in marks]


def contamination(rows, items, window=10):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    of = lambda t: word.findall(lower(t or ""))
    found = {}
    for item, text in items:
        w = of(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            found.setdefault(tuple(w[s:s + n]), set()).add(str(item))
    sizes = {len(k) for k in found}
    out = []
    for doc, text in rows:
        w, hit, names = of(text), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in found:
                    hit.update(range(p, p + n))
                    names |= found[tuple(w[p:p + n])]
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def dedup_lines(rows, min_words=50):
    """{(doc_id, text): (text left, lines deleted)} of (doc_id, text) rows; equal rows are one document.  Every pair of
    equal lines, the earlier and the later, lies on a diagonal; its unbroken stretches are the repeated runs."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, _signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42))))
    places, out = {}, {}
    for d, doc in enumerate(order):
        lines = (doc[1] or "").split("\n")
        own = [(k, tuple(re.findall(SPACES, x))) for k, x in enumerate(lines)]
        own = [x for x in own if x[1]]
        open_runs, drop = {}, set()

        def close(run):
            if run[1] >= min_words:
                drop.update(range(own[run[0]][0], own[run[2]][0] + 1))

        for i, (_, words) in enumerate(own):
            going = {}
            for e, k in places.get(words, ()):
                first, size, _ = open_runs.pop((e, k - i), (i, 0, i))
                going[e, k - i] = (first, size + len(words), i)
            for run in open_runs.values():
                close(run)
            open_runs = going
            places.setdefault(words, []).append((d, i))
        for run in open_runs.values():
            close(run)
        left = None if doc[1] is None else "\n".join(x for k, x in enumerate(lines) if k not in drop)
        out[doc] = (left, len(drop))
    return out


def _signed(h):
    return h - 2**64 if h >= 2**63 else h
