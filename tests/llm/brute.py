"""Plain Python versions of the corpus operators, for small tables."""

import hashlib
import math
import re
import struct

import xxhash

LEAST = -(2**63)


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def rank(doc):
    return LEAST if doc is None else doc


def kept_lines(rows):
    """(doc_id, n_lines, n_dropped, kept text) of (doc_id, text) rows."""
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(rank(doc))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == rank(doc)
        ]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def simhash(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", low(text)) if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def shingles(text, size):
    """The distinct runs of ``size`` words; all words if there are fewer."""
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").lower()) if x]
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def components(n, linked):
    """Least index reachable from each index."""
    top = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j) and top[i] != top[j]:
                a, b = top[i], top[j]
                top = [min(a, b) if t in (a, b) else t for t in top]
    return top


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def contamination(rows, items, window=10):
    """(doc_id, n_words, n_hit, sorted item ids as strings)."""
    wins = {}
    for item, text in items:
        w = words(text)
        size = min(len(w), window)
        for i in range(len(w) - size + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in wins}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in wins:
                    hit.update(range(i, i + size))
                    found |= wins[tuple(w[i : i + size])]
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def without_repeats(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha of the rest)."""
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            string = data[p : p + length]
            first[string] = min(first.get(string, rank(doc)), rank(doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < rank(doc):
                gone[p : p + length] = b"\x01" * length
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(data)))
        rest = bytes(x for x, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, sha(rest)))
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(*values):
    """Spark's xxhash64 of strings, longs (q) and ints (i), given as (kind, value)."""
    seed = 42
    for kind, value in values:
        data = value.encode() if kind == "s" else struct.pack(f"<{kind}", value)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return signed(seed)


def min_hash(text, size=5, bins=256, draws=None):
    """One-permutation MinHash with four bits a bin, as hexadecimal digits."""
    w = [spark_hash(("s", x)) for x in re.split("[\x20\x09-\x0d]+", (text or "").lower()) if x]
    if not w:
        return "-"
    runs = [w[i : i + size] for i in range(len(w) - size + 1)] or [w]
    least = {}
    for run in runs:
        x = spark_hash(*[("q", v) for v in run])
        place = (x >> 56) + 128
        least[place] = min(least.get(place, x), x)
    digits = ""
    for b in range(bins):
        places = [b] + [spark_hash(("i", b), ("i", t)) % bins for t in range(draws)]
        found = [least[p] for p in places if p in least]
        if not found:
            found = [min((spark_hash(("i", b), ("i", j)), v) for j, v in least.items())[1]]
        digits += f"{found[0] & 15:x}"
    return digits


def toxicity(text, weights, curve, fold):
    """The score by trying every pattern at every word start."""
    folded = fold(text or "")
    n_words, total = len(folded.split()), 0.0
    for at in (i for i, c in enumerate(folded) if c == " "):
        fitting = [p for p in weights if folded.startswith(p, at)]
        if fitting:
            total += weights[max(fitting, key=len)]
    bias, strength, rate = curve
    sum_ = bias + strength * math.log1p(total) + rate * math.log1p(100 * total / max(n_words, 1))
    return 1 / (1 + math.exp(-sum_))
