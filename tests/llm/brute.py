"""Plain versions of the operators, to hold their results against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

LOWER = {i: i + 32 for i in range(65, 91)}


def ascii_lower(text):
    return (text or "").translate(LOWER)


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def contamination(docs, items, window=13):
    wins = {}
    for name, text in items:
        words = alnum_words(text)
        span = min(window, len(words))
        for i in range(len(words) - span + 1 if words else 0):
            wins.setdefault(tuple(words[i : i + span]), set()).add(str(name))
    out = []
    for key, text in docs:
        words = alnum_words(text)
        hit, names = set(), set()
        for span in {len(w) for w in wins}:
            for i in range(len(words) - span + 1):
                if (found := wins.get(tuple(words[i : i + span]))) is not None:
                    hit |= set(range(i, i + span))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        bad = bool(hit) and 20 * len(hit) >= len(words)
        out.append((key, len(words), len(hit), len(names), digest, bad))
    return out


def simhash(text, shingle=3):
    words = [w.encode() for w in space_words(ascii_lower(text))]
    rows = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    if words and not rows:
        rows = [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(keys, linked):
    """The smallest key reachable from each position; ``linked(i, j)`` for i > j."""
    parent = list(range(len(keys)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if linked(i, j):
                parent[root(i)] = root(j)
    least = {}
    for i, key in enumerate(keys):
        least[root(i)] = min(key, least.get(root(i), key))
    return [least[root(i)] for i in range(len(keys))]


def substring_dedup(docs, window=35):
    where = Counter()
    for _, text in docs:
        words = space_words(text)
        where.update(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    out = []
    for key, text in docs:
        words, gone = space_words(text), set()
        for i in range(len(words) - window + 1):
            if where[tuple(words[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    out = {}
    for kind, pattern in PII.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out[kind].append(m.span())
    return out


def exact_groups(docs):
    """``key, keep, size, digest`` of each row; of rows equal in length and key any may stay."""
    groups = {}
    for key, text in docs:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(bare, []).append((-len(text or ""), key is None, key or 0, key))
    out = []
    for bare, rows in groups.items():
        keep = min(rows)[3]
        digest = hashlib.sha256(bare.encode()).hexdigest()
        out += [(row[3], keep, len(rows), digest) for row in rows]
    return out


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes one of the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling(counts):
    """``word, form, root, n, n_near, form_n`` of each word."""
    forms, rows = {}, []
    for word, n in counts.items():
        close = [w for w in counts if near(word, w)]
        best = min(close, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= 2 * n else None
        rows.append((word, n, len(close)))
    out = []
    for word, n, n_near in rows:
        root = word
        while forms[root] is not None:
            root = forms[root]
        out.append((word, forms[word], root, n, n_near, counts.get(forms[word])))
    return out


def features(text):
    words = alnum_words(text)
    return words + [" ".join(words[i : i + 2]) for i in range(len(words) - 1)]


def resampled(docs, target, percent=25, least=20):
    """``key, n_features, weight, score, rank`` of each row; the ranks of equal rows are exchangeable."""

    def counted(texts):
        return Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in features(t))

    s, t = counted([x[1] for x in docs]), counted(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for key, text in docs:
        found = features(text)
        total = 0
        for f in found:
            b = zlib.crc32(f.encode()) % 10_000
            ratio = (t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))
            total += math.floor(1000 * math.log(ratio))
        weight = total // len(found) if found else 0
        named = f"7:{'' if key is None else key}"
        h = int(hashlib.sha256(named.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((key, len(found), weight, score, len(alnum_words(text)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(able) * percent // 100
    out = [(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(able)]
    return out + [(*r[:4], None) for r in rows if not r[4]]
