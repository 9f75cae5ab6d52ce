"""Plain versions of what the operators compute, written without looking at how they do it."""


def grouped(nodes, linked):
    """The least node each node reaches, by union and find over all linked pairs."""
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}
