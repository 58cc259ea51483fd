"""Plain versions of what the corpus operators compute, for small inputs."""

import collections
import re

BLANK = "\x20\x09-\x0d"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(f"[^{BLANK}]+", lower(text))


def shingles(text, k):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(rows, k, percent):
    """(id, set size, component, kept) of (id, text) rows; rows without an id stand alone."""
    sets = [shingles(t, k) for _, t in rows]
    holders = collections.defaultdict(list)
    for j, s in enumerate(sets):
        if rows[j][0] is not None:
            for h in s:
                holders[h].append(j)
    links = set()
    for held in holders.values():
        for x in range(len(held)):
            for y in range(x):
                a, b = sets[held[x]], sets[held[y]]
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    links.add((rows[held[x]][0], rows[held[y]][0]))
    part = components({i for i, _ in rows if i is not None}, links)
    out = []
    for (i, _), s in zip(rows, sets, strict=True):
        out.append((i, len(s), part.get(i) if s else i, i is None or not s or part[i] == i))
    return out


def lines(rows, least=10):
    """(id, lines, dropped, kept text) of (id, text) rows."""
    holders = collections.defaultdict(set)
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= least:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        keep = [x for x in own if i is None or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out.append((i, len(own), len(own) - len(keep), "\n".join(keep)))
    return out


def sainte_lague(votes, seats):
    """Seats by highest quotients; ties go to the first name."""
    quota = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(sorted(v for v in votes if votes[v] > 0), key=lambda v: votes[v] / (2 * quota[v] + 1))
        quota[best] += 1
    return quota


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip":
                good = all(int(p) <= 255 for p in m.group().split("."))
            elif kind == "card":
                good = 12 <= len(digits) <= 19 and luhn(digits)
            else:
                good = kind == "email" or 9 <= len(digits) <= 15
            if good:
                found.append((m.start(), order, kind, m.end()))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


def repeated(rows, size):
    """Ids that share a run of ``size`` words with another id, and the pairs."""
    holders = collections.defaultdict(set)
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - size + 1):
            holders[tuple(w[k : k + size])].add(i)
    pairs = {tuple(sorted(s)[:2]) for s in holders.values() if len(s) > 1}
    return {i for s in holders.values() if len(s) > 1 for i in s}, pairs
