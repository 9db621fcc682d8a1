"""Plain Python versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re
import zlib

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=SPACE_WORD):
    return pattern.findall((text or "").translate(_LOWER))


def fold(key, n):
    return zlib.crc32(("" if key is None else str(key)).encode()) % n


def shingles(text, size=5):
    own = words(text)
    if len(own) < size:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def jaccard_components(texts, percent=75):
    """Component number of every row, rows with similar sets linked."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(sets)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, left in enumerate(sets):
        for j in range(i):
            shared = len(left & sets[j])
            union = len(left) + len(sets[j]) - shared
            if left and sets[j] and 100 * shared >= percent * union:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(sets))]


def contamination(texts, items, window=13):
    phrases = {}
    for item, text in items:
        own = words(text, ALNUM_WORD)
        for start in range(max(1, len(own) - window + 1) if own else 0):
            phrases.setdefault(tuple(own[start : start + window]), set()).add(item)
    out = []
    for text in texts:
        own = words(text, ALNUM_WORD)
        hit, found = [0] * len(own), set()
        for phrase, names in phrases.items():
            n = len(phrase)
            for start in range(len(own) - n + 1):
                if tuple(own[start : start + n]) == phrase:
                    hit[start : start + n] = [1] * n
                    found |= names
        listed = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
        n_hit = sum(hit)
        bad = n_hit > 0 and 20 * n_hit >= len(own)
        out.append((len(own), n_hit, len(listed), digest, bad))
    return out


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii_spans(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
