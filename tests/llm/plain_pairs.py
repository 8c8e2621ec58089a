"""What several tests of the operators compare with."""

from credit_marts.llm import minhash
from credit_marts.llm.components import UnionFind


def all_pairs(docs, size, percent):
    """(n_shingles, component) by id, from every pair."""
    sets = {i: minhash.shingle_set(t or "", size) for i, t in docs}
    groups = UnionFind()
    ids = sorted(sets)
    for n, a in enumerate(ids):
        groups.find(a)
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                groups.union(a, b)
    return {i: (len(sets[i]), groups.find(i)) for i in ids}
