"""Plain versions of the operators' rules, for small tables."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def components(nodes, links):
    """Smallest reachable node of every node."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for node in sorted(nodes):
        if node not in out:
            queue = [node]
            while queue:
                one = queue.pop()
                if one not in out:
                    out[one] = node
                    queue += near[one]
    return out


def near_duplicates(docs, percent=75):
    sets = {i: shingles(t) for i, t in docs.items()}
    ids = sorted(docs)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in components(ids, links).items()}
