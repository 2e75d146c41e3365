"""Plain versions of operators that several tests compare with."""

import re
from itertools import combinations

from test_secrets import PATTERNS
from test_tiling import greedy

WORD = re.compile(r"[^\W_]+")


def base_spans(text):
    kinds = ["assign", "access", "hex"]
    return sorted((m.start(), n, kinds[n], m.end()) for n, (p, g, least) in enumerate(PATTERNS) for m in p.finditer(text) if len(m[g]) >= least)


def components_of(texts, width, percent):
    """n_shingles and smallest linked id, by comparing all pairs that share a shingle."""
    sets, lists = {}, {}
    for i, t in texts.items():
        words = t.encode().lower().split()
        sets[i] = {tuple(words[n : n + width]) for n in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
        for s in sets[i]:
            lists.setdefault(s, set()).add(i)
    pairs = {p for own in lists.values() if len(own) > 1 for p in combinations(sorted(own), 2)}
    least = {i: i for i in texts}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            least[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def plain_tiles(texts, items, least, share):
    """Coverage of each passage in each document by plain greedy search, where it reaches the share."""
    words = {i: WORD.findall(t.casefold()) for i, t in texts.items()}
    found = {}
    for item, passage in items.items():
        own = WORD.findall(passage.casefold())
        seeds = {tuple(own[n : n + least]) for n in range(len(own) - least + 1)}
        for i, w in words.items():
            shared = [n for n in range(len(w) - least + 1) if tuple(w[n : n + least]) in seeds]
            if shared:
                near = sorted({k for n in shared for k in range(n, n + least)})
                parts, last = [], None
                for k in near:  # only shared runs matter; a gap keeps them apart
                    if last is not None and k != last + 1:
                        parts.append(None)
                    parts.append(w[k])
                    last = k
                covered = greedy(parts, own, least)
                if own and covered >= share * len(own):
                    found[i, item] = covered / len(own)
    return found
