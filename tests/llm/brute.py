"""Plain versions of the corpus operators for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^ \t-\r]+")


def words(text):
    return WORD.findall(text or "")


def repeats(rows, window=200):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of rows (doc_id, text)."""
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


def substrings(rows, window=20):
    """(doc_id, n_words, n_removed, kept text) of rows (doc_id, text)."""
    split = [words(text) for _, text in rows]
    seen, out = set(), {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)):
        gone = [False] * len(split[i])
        for j in range(len(split[i]) - window + 1):
            gram = tuple(split[i][j:j + window])
            if gram in seen:
                gone[j:j + window] = [True] * window
            seen.add(gram)
        out[i] = (rows[i][0], len(gone), sum(gone), " ".join(w for w, g in zip(split[i], gone) if not g))
    return [out[i] for i in range(len(rows))]


def groups(rows, k=5):
    """(doc_id, n_shingles, component_id) of rows (doc_id, text)."""
    sets = []
    for _, text in rows:
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    holders = defaultdict(list)
    for i, grams in enumerate(sets):
        for g in grams:
            holders[g].append(i)
    up = list(range(len(rows)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, grams in enumerate(sets):
        for j, both in Counter(j for g in grams for j in holders[g] if j < i).items():
            if 4 * both >= 3 * (len(grams) + len(sets[j]) - both):
                up[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        root = find(i)
        low[root] = min([d for d in (low.get(root), doc) if d is not None], default=None)
    return [(doc, len(sets[i]), low[find(i)]) for i, (doc, _) in enumerate(rows)]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def linked(rows, prints, near):
    """Smallest id per row of the groups of prints that ``near`` links, ids being None last."""
    up = {p: p for p in prints}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    different = sorted(up)
    for i, a in enumerate(different):
        for b in different[:i]:
            if near(a, b):
                up[find(a)] = find(b)
    low = {}
    for (doc, _), p in zip(rows, prints):
        low[find(p)] = min([d for d in (low.get(find(p)), doc) if d is not None], default=None)
    return [low[find(p)] for p in prints]


def simhash(text, k=3):
    """64 bits, one at a time."""
    w = words(lowered(text))
    terms = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(t.encode(), 42) for t in terms]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def resampled(rows, target, most=1, buckets=10_000, seed=2024, least=20, percent=10):
    """(doc_id, n_features, weight, score, rank) of rows (doc_id, text)."""
    def features(text):
        w = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", lowered(text))
        runs = [" ".join(w[i:i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(run.encode()) % buckets for run in runs]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)]
    out = []
    for doc, text in rows:
        n_words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((n_words >= least, (doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))))
    able = sorted((r for ok, r in out if ok), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1:3]))
    draws = percent * len(able) // 100
    return [(*r, i + 1 if i < draws else None) for i, r in enumerate(able)] + [(*r, None) for ok, r in out if not ok]


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))
