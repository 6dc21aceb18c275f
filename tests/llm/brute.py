"""Plain Python versions of the queries' contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EMPTY = hashlib.sha256(b"").hexdigest()


def low(text):
    return (text or "").translate(LOWER)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc_mod(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c)
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def pii(text):
    """Base spans by kind."""
    text = text or ""
    out = {}
    out["email"] = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
                 if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out["card"] = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
                   if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return out


def contamination(texts, items, size=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    windows = []
    for item, text in items:
        w = split(text)
        windows += [(item, w[i:i + size]) for i in range(max(1, len(w) - size + 1) if w else 0)]
    out = []
    for text in texts:
        w, hit, named = split(text), set(), set()
        joined = " " + " ".join(w) + " "
        for item, window in windows:
            if " " + " ".join(window) + " " not in joined:
                continue
            for i in range(len(w) - len(window) + 1):
                if w[i:i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
            if item is not None:
                named.add(str(item))
        out.append((len(w), len(hit), len(named), sha(",".join(sorted(named))), bool(hit)))
    return out


def shingles(text):
    w = words(low(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def near_duplicates(docs):
    """(doc_id, n_shingles, component, kept) of (doc_id, text) rows; ids are unique."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    holders = {}
    for d in ids:
        common = Counter(o for s in sets[d] for o in holders.get(s, ()))
        for o, n in common.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[o]) - n):
                a, b = sorted((root(d), root(o)))
                parent[b] = a
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    return [(d, len(sets[d]), root(d), root(d) == d) for d in ids]


def substrings(docs, size=35):
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text) rows."""
    seen = Counter()
    texts = [(d, words(t)) for d, t in docs]
    for _, w in texts:
        seen.update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w, text = words(text), text or ""
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i:i + 3])] > 1:
            again.update((i, i + 1, i + 2))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again),
            len(w) < 50 or 100 * len(again) > 50 * len(w))


def mix_targets(sizes, weights=(5, 2, 1), most=3):
    """Target of each source, resharing the excess until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        level = left / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if weight[s] * level > most * sizes[s]]
        if not above:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: float(most * sizes[s]) for s in above}


def uniform(doc_id, seed="mix"):
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    return (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
