"""Brute-force helpers that several tests share."""


def group(links):
    """Smallest member that each member reaches, by a plain union of sets."""
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {a: find(a) for a in parent}
