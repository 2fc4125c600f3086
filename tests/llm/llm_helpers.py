"""Plain definitions that tests compare with."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, n=5):
    w = words_of(lower(text))
    if len(w) >= n:
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    return {tuple(w)} if w else set()


def without_repeats(rows, window=35):
    """(id, n_words, n_removed, kept_sha256) per (id, text)."""
    seen = Counter()
    for _, text in rows:
        w = words_of(text)
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def classes(sets, percent=80):
    """Smallest reachable key by links of sets."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, s in sets.items():
        common = Counter(j for x in s for j in index[x])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for x in s:
            index[x].append(i)
    return {i: find(i) for i in sets}


def tree_scores(rows, depth=4):
    """{id: (held_out, n_tokens, n_known, train_tokens, base, score)} by the textbook recursion."""
    tokens = {i: [*words_of(lower(t)), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    counts = Counter(w for i in tokens if not held[i] for w in tokens[i])
    total, distinct = sum(counts.values()), len(counts)
    text = {i: b"\n" * depth + " ".join(t[:-1]).encode() + b"\n" for i, t in tokens.items()}
    nodes, children = {}, defaultdict(list)

    def steps(s, p):
        for k in range(8):
            yield (1 << k) | (s[p] >> (8 - k)), (s[p] >> (7 - k)) & 1

    for i, s in text.items():
        if not held[i]:
            for p in range(depth, len(s)):
                for prefix, bit in steps(s, p):
                    for d in range(depth + 1):
                        nodes.setdefault((s[p - d : p], prefix), [0, 0])[bit] += 1
    for context, prefix in nodes:
        if context:
            children[context[1:], prefix].append((context, prefix))
    kt = lambda z, o: math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)
    weighted, share = {}, {}
    for node in sorted(nodes, key=lambda n: -len(n[0])):
        own = kt(*nodes[node])
        if len(node[0]) == depth:
            weighted[node], share[node] = own, 1.0
        else:
            below = sum(weighted[c] for c in children[node])
            top = max(own, below)
            weighted[node] = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(below - top))
            share[node] = 1 / (1 + math.exp(min(700, below - own)))
    out = {}
    for i, s in text.items():
        score = 0.0
        for p in range(depth, len(s)):
            for prefix, bit in steps(s, p):
                one = None
                for d in range(depth, -1, -1):
                    node = (s[p - d : p], prefix)
                    z, o = nodes.get(node, (0, 0))
                    mine = (o + 0.5) / (z + o + 1)
                    w = share.get(node, 0.5)
                    one = mine if one is None else w * mine + (1 - w) * one
                score += math.log10(one if bit else 1 - one)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens[i])
        out[i] = (held[i], len(tokens[i]), sum(counts[w] > 0 for w in tokens[i]), total, base, score)
    return out
