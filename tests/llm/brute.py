"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
UPPER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered, lines, dup = set(), set(), 0
    for i in range(len(words) - 2):
        if windows[tuple(words[i: i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i: i + size]) for i in range(len(words) - size + 1))


def near_duplicates(rows, size, threshold=80):
    """{id: (n_shingles, component, kept)} by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = sorted((top(a), top(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def patterns(text):
    text, digits = text or "", lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def contamination(docs, items, window=13):
    """{id: (n_words, n_hit, n_items, digest, contaminated)}."""
    words = lambda t: UPPER_WORD.findall((t or "").translate(LOWER))
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            grams[tuple(w[a: a + window])].add(str(i))
    out = {}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k in {len(g) for g in grams}:
            for a in range(len(w) - k + 1):
                if tuple(w[a: a + k]) in grams:
                    hit |= set(range(a, a + k))
                    found |= grams[tuple(w[a: a + k])]
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def kneser_ney(texts, order=4):
    """A scoring function (text -> log-likelihood, characters) of an interpolated modified Kneser-Ney model."""
    norm = lambda t: "\x02" * (order - 1) + re.sub(r"[ \t-\r]", " ", re.sub("[0-9]", "0", t))
    counts = {order: Counter()}
    for t in texts:
        s = norm(t)
        counts[order].update(s[i: i + order] for i in range(len(s) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    tables = {}
    for n, c in counts.items():
        of = Counter(c.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0.5
        cut = {k: min(max(k - (k + 1) * y * of[k + 1] / of[k] if of[k] and of[k + 1] else 0.5, 0.1), k - 0.05) for k in (1, 2, 3)}
        total, taken = Counter(), Counter()
        for g, x in c.items():
            total[g[:-1]] += x
            taken[g[:-1]] += cut[min(x, 3)]
        tables[n] = (c, cut, total, taken)

    def p(g):
        if not g:
            return 1 / (len(counts[1]) + 1)
        c, cut, total, taken = tables[len(g)]
        low = p(g[1:])
        h = g[:-1]
        if not total[h]:
            return low
        return (c[g] - cut[min(c[g], 3)] if c[g] else 0) / total[h] + taken[h] / total[h] * low

    import math

    def score(t):
        s = norm(t)
        return sum(math.log(p(s[i: i + order])) for i in range(len(s) - order + 1)), len(t)

    return score
