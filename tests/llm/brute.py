"""Plain versions of the operators, for small inputs."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def substrings(rows):
    """op8: {key: (words, removed, digest)}"""
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(first.get(tuple(w[k : k + 13]), i), i)
    out = {}
    for i, w in split:
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode()))
    return out


def suffixes(rows):
    """op3: {key: (bytes, removed, spans, digest)}"""
    texts = sorted((i, (t or "").encode()) for i, t in rows)
    first = {}
    for i, b in texts:
        for k in range(len(b) - 99):
            first.setdefault(b[k : k + 100], (i, k))
    out = {}
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if first[b[k : k + 100]] < (i, k):
                gone[k : k + 100] = b"\1" * 100
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def quality(text):
    """op6's base: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    cover = {j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(k, k + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for x in w for c in x), len(lines) - len(set(lines)), len(cover)


def shingles(text, n):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))] if w else []


def fingerprint(text):
    import xxhash

    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, 3)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(keys, linked):
    """Least key of each key's class."""
    least = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least
