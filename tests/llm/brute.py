"""Brute-force twins in plain Python, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality_base(text):
    text = text or ""
    found = words(text)
    grams = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    repeated = {j for i in range(len(found) - 4) if grams[tuple(found[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(found)
    return {
        "n_words": n,
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "base_failed": n < 10 or 100 * len(repeated) > 20 * n,
    }


def norm(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line.translate(FOLD)).strip(" ")


def quality_kept(docs, least=10, share=0.1, few=5):
    """docs: (source, text) rows; the verdict of each."""
    texts, counts = defaultdict(set), defaultdict(set)
    for source, text in docs:
        texts[source].add(text)
        for line in (text or "").split("\n"):
            if WORD.search(line):
                counts[source, norm(line)].add(text)
    out = []
    for source, text in docs:
        base = quality_base(text)
        lost = 0
        for line in (text or "").split("\n"):
            n = len(counts.get((source, norm(line)), ()))
            if WORD.search(line) and (n > least or (n > few and n > len(texts[source]) * share)):
                lost += len(words(line))
        left = base["n_words"] - lost
        out.append(not base["base_failed"] and left >= 10 and 100 * left >= 30 * base["n_words"])
    return out


def repeats(texts, window=35):
    """(n_words, n_removed, kept words joined) of each text."""
    all_words = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for w in all_words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def shingle_set(text):
    w = words((text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def near_groups(docs):
    """docs: (key, text) rows; {row index: (n_shingles, component's row indexes)}."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    pairs = Counter((a, b) for h in holders.values() for x, a in enumerate(h) for b in h[x + 1 :])
    for (a, b), both in pairs.items():
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(b)] = find(a)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(i)
    return {i: (len(sets[i]), groups[find(i)]) for i in range(len(docs))}


def contamination(texts, items, window=13):
    """items: (id, text); (n_words, hit word numbers, sorted item ids, contaminated) of each text."""
    found = defaultdict(set)
    for item, text in items:
        w = BENCH_WORD.findall((text or "").translate(FOLD))
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            found[tuple(w[i : i + k])].add(str(item))
    out = []
    for text in texts:
        w = BENCH_WORD.findall((text or "").translate(FOLD))
        hit, ids = set(), set()
        for k in {len(f) for f in found}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in found:
                    hit.update(range(i, i + k))
                    ids |= found[tuple(w[i : i + k])]
        out.append((len(w), hit, sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return out
