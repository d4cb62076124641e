"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def join(parent, x, y):
    x, y = find(parent, x), find(parent, y)
    parent[max(x, y)] = min(x, y)


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])


def substring(rows, window=35):
    texts = [(i, WORD.findall(text or "")) for i, text in rows]
    seen = collections.Counter(tuple(w[j:j + window]) for _, w in texts for j in range(len(w) - window + 1))
    out = []
    for i, w in texts:
        gone = set()
        for j in range(len(w) - window + 1):
            if seen[tuple(w[j:j + window])] > 1:
                gone.update(range(j, j + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return in_order(out)


def near(rows, percent=85, width=3):
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text))
        sets.append({tuple(w[j:j + width]) for j in range(max(len(w) - width + 1, min(1, len(w))))})
    parent = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                join(parent, a, b)
    best = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            best[find(parent, k)] = min(best.get(find(parent, k), i), i)
    return in_order((i, len(sets[k]), best.get(find(parent, k)), i == best.get(find(parent, k))) for k, (i, _) in enumerate(rows))


def vectors(rows, threshold=0.93):
    def usable(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    parent, links = list(range(len(rows))), [0] * len(rows)
    groups = collections.defaultdict(list)
    for k, (_, v, label) in enumerate(rows):
        if label is not None and usable(v):
            groups[label, len(v)].append(k)
    for members in groups.values():
        unit = np.array([rows[k][1] for k in members], float)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        for a, b in np.argwhere(np.triu(unit @ unit.T >= threshold, 1)).tolist():
            a, b = members[a], members[b]
            links[a] += 1
            links[b] += 1
            join(parent, a, b)
    best = {}
    for k, (i, _, _) in enumerate(rows):
        best[find(parent, k)] = min(best.get(find(parent, k), i), i)
    return in_order((i, links[k], best[find(parent, k)], best[find(parent, k)] == i) for k, (i, _, _) in enumerate(rows))


def exact(rows):
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[lower(text)].append(i)
    out = []
    for i, text in rows:
        group = groups[lower(text)]
        keep = max((x for x in group if x is not None), default=None)
        out.append((i, keep, len(group), i == keep, sha(lower(text))))
    return in_order(out)


def periodic(w, least=24, power=3):
    """(start, length, period) of all runs, by comparing the words with themselves one period on."""
    found = {}
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, power * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def spelling(rows, least_count=3, slip=None):
    total = collections.Counter()
    for key, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lower(text)):
            check = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if slip and check % slip == 0:
                run = run[:check % len(run)] + run[check % len(run) + 1:]
            total[run] += 1
    total = {w: n for w, n in total.items() if len(w) >= 5 and n >= least_count}
    near = {w: [o for o in total if one_edit(w, o)] for w in total}
    best = {w: min(near[w], key=lambda o: (-total[o], o)) for w in total if near[w]}
    form = {w: o for w, o in best.items() if total[o] >= 2 * total[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return in_order((w, form.get(w), root(w), n, len(near[w]), total[form[w]] if w in form else None) for w, n in total.items())


def ftrl(examples, bits, alpha, beta, l1, l2, epochs):
    """Bias and non-zero weights, coordinate by coordinate, from (label, buckets)."""
    z, n, bias = collections.Counter(), collections.Counter(), 1 << bits

    def weight(i):
        limit = 0.0 if i == bias else l1
        if abs(z[i]) <= limit:
            return 0.0
        return -(z[i] - math.copysign(limit, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for label, buckets in examples:
            w = {i: weight(i) for i in [*map(int, buckets), bias]}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - label
            for i, wi in w.items():
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * wi
                n[i] += g * g
    return weight(bias), {i: weight(i) for i in z if i != bias and weight(i)}


def hidden_markov(tokens, symbol, inner, start, move, emit):
    """log10 probability of a token sequence: symbols by scaled forward steps, tokens within their symbols."""
    states, total = range(len(start)), 0.0
    now = None
    for token in tokens:
        s = symbol(token)
        if now is None:
            now = [start[k] * emit[s][k] for k in states]
        else:
            now = [sum(now[j] * move[j][k] for j in states) * emit[s][k] for k in states]
        scale = sum(now)
        now = [x / scale for x in now]
        total += math.log10(scale) + math.log10(inner(token))
    return total
