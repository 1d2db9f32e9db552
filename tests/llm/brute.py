"""Plain-Python counterparts of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0D]+")
LETTERS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern):
    return pattern.findall((text or "").translate(LOWER))


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def near_duplicates(texts, k, num, den=100):
    """{id: (set size, component)} of {id: text}."""
    sets = {}
    for i, t in texts.items():
        w = words(t, SPACED)
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    holders, links = defaultdict(list), []
    for i in sorted(sets):
        both = Counter(j for e in sets[i] for j in holders[e])
        links += [(j, i) for j, n in both.items() if den * n >= num * (len(sets[i]) + len(sets[j]) - n)]
        for e in sets[i]:
            holders[e].append(i)
    comp = components(sets, links)
    return {i: (len(sets[i]), comp[i]) for i in sets}


def repeated_spans(raws, length):
    """Maximal removed byte runs of each of a list of byte strings."""
    seen = Counter(r[j:j + length] for r in raws for j in range(len(r) - length + 1))
    out = []
    for r in raws:
        runs = []
        for j in range(len(r) - length + 1):
            if seen[r[j:j + length]] > 1:
                if runs and j <= runs[-1][1]:
                    runs[-1][1] = j + length
                else:
                    runs.append([j, j + length])
        out.append(runs)
    return out


def cut(raw, runs):
    at = [0, *(x for r in runs for x in r), len(raw)]
    return b"".join(raw[at[i]:at[i + 1]] for i in range(0, len(at), 2))


def contamination(texts, items, window=13):
    """[(n_words, n_hit, item names, contaminated)] of a list of texts."""
    windows = defaultdict(set)
    for name, t in items:
        w = words(t, LETTERS)
        if w:
            k = min(window, len(w))
            for j in range(len(w) - k + 1):
                windows[tuple(w[j:j + k])].add(name)
    out = []
    for t in texts:
        w, hit, names = words(t, LETTERS), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in windows:
                    hit.update(range(j, j + k))
                    names |= windows[tuple(w[j:j + k])]
        out.append((len(w), len(hit), sorted(x for x in names if x is not None),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def license_chains(words, templates, min_match, max_gap, min_cover):
    """(template, covered, first, end): every chain of every piece, tried one by one."""
    def places(run):
        return [(t, k + len(run)) for t, w in enumerate(templates) for k in range(len(w)) if w[k:k + len(run)] == run]

    vocab = {x for w in templates for x in w}
    longest = []  # at each word, the words of the longest run of a template that ends there
    for i in range(len(words)):
        longest.append(next((n for n in range(i + 1, 0, -1) if places(words[i + 1 - n:i + 1])), 0))
    pieces = []
    for i, n in enumerate(longest):
        lone = n == 1 and not (i and words[i - 1] in vocab) and not (i + 1 < len(words) and words[i + 1] in vocab)
        if n >= min_match and not lone and (i + 1 == len(words) or longest[i + 1] != n + 1):
            pieces.append((i + 1 - n, i + 1, places(words[i + 1 - n:i + 1])))
    out = []
    for t, template in enumerate(templates):
        mine = [(a, b, p) for a, b, at in pieces for u, p in at if u == t]
        best = []
        for a, b, p in mine:
            n, options = b - a, [(b - a, a)]
            options += [(c + min(n, p - q, b - max(a, e)), s) for (_, e, q), (c, s) in zip(mine, best)  # noqa: B905
                        if e < b and q < p and a - e <= max_gap]
            best.append(max(options))
        taken = []
        for c, a, b in sorted(((c, s, b) for (_, b, _), (c, s) in zip(mine, best, strict=True)),
                              key=lambda x: (-x[0], x[1], x[2])):
            if taken and c < min_cover * len(template):
                break
            if all(b <= x or y <= a for _, x, y in taken):
                taken.append((c, a, b))
        out += [(t, c, a, b) for c, a, b in taken]
    return out


def shape_classes(raw):
    """(kind, class) of a document's bytes, in plain Python."""
    low = raw.lower()
    symbol = [not (48 <= c <= 57 or 97 <= c <= 122 or c >= 128 or c == 32 or 9 <= c <= 13) for c in low]
    w = words(raw.decode(), LETTERS)
    n, edges = len(w), [0.001, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.5, 0.7, 0.85]

    def share(part, whole):
        return sum(part / max(whole, 1) >= e for e in edges)

    return list(enumerate([
        share(sum(symbol), len(raw)), share(sum(a and b for a, b in zip(symbol, symbol[1:])), len(raw)),  # noqa: B905
        share(sum(65 <= c <= 90 for c in raw), len(raw)), share(sum(48 <= c <= 57 for c in raw), len(raw)),
        share(raw.count(b"\n"), len(raw)), share(raw.count(b"|"), len(raw)),
        share(sum(a == b for a, b in zip(w, w[1:])), n), share(len(set(w)), n),  # noqa: B905
        min(len(raw) // max(n, 1), 20), min(max(n, 1).bit_length() - 1, 12)]))


def quality(docs, labels, min_g, l2):
    """docs: (id, text, host, path), ids once each; labels: id -> (quality, toxic).
    Returns id -> (quality, toxic, site_quality, site_toxic, kept)."""
    feats = {i: set(words(t, LETTERS)) | set(shape_classes((t or "").encode())) for i, t, _, _ in docs}
    taught = [i for i, *_ in docs if i in labels]
    n, chosen = len(taught), set()
    for k in (0, 1):
        n1 = sum(labels[i][k] for i in taught)
        for f in set().union(*(feats[i] for i in taught)):
            a = sum(labels[i][k] for i in taught if f in feats[i])
            b = sum(1 - labels[i][k] for i in taught if f in feats[i])
            mid = (a + b + 1) / (n + 2)
            g = 2 * (a * math.log((a + 0.5) / (n1 + 1) / mid) + b * math.log((b + 0.5) / (n - n1 + 1) / mid))
            if g > min_g:
                chosen.add(f)
    chosen = sorted(chosen, key=str)
    row = {i: np.array([f in feats[i] for f in chosen] + [True], float) for i in feats}
    odds, rates = {i: [] for i in feats}, {i: [] for i in feats}
    for k in (0, 1):
        x, y = np.array([row[i] for i in taught]), np.array([labels[i][k] for i in taught], float)
        ridge, w = np.full(x.shape[1], l2 * n), np.zeros(x.shape[1])
        ridge[-1] = 1e-6
        for _ in range(60):
            p = 1 / (1 + np.exp(-x @ w))
            w = w - np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        mean = (y.sum() + 1) / (n + 2)
        site = {i: (h, q) for i, _, h, q in docs}

        def groups(key):
            out = {}
            for i in taught:
                m, c = out.get(key(i), (0, 0))
                out[key(i)] = (m + 1, c + labels[i][k])  # noqa: B023
            return out

        def strength(cells):  # (n, successes, centre)
            m, total = len(cells), sum(c[0] for c in cells)
            if m < 2:
                return 1e6
            q = sum(c[0] * (c[1] / c[0] - c[2]) ** 2 for c in cells)
            var = mean * (1 - mean)  # noqa: B023
            between = (q - (m - 1) * var) / max(total - sum(c[0] ** 2 for c in cells) / total, 1)
            return min(1e6, max(1.0, var / between - 1)) if between > 0 else 1e6

        hosts, paths = groups(lambda i: site[i][0]), groups(lambda i: site[i])  # noqa: B023
        kh = strength([(m, c, mean) for m, c in hosts.values()])
        of_host = {h: (c + kh * mean) / (m + kh) for h, (m, c) in hosts.items()}
        kp = strength([(m, c, of_host[s[0]]) for s, (m, c) in paths.items()])
        of_path = {s: (c + kp * of_host[s[0]]) / (m + kp) for s, (m, c) in paths.items()}
        for i in feats:
            rate = of_path.get(site[i], of_host.get(site[i][0], mean))
            z = row[i] @ w + math.log(rate / (1 - rate)) - math.log(mean / (1 - mean))
            odds[i].append(1 / (1 + math.exp(-z)))
            rates[i].append(rate)
    return {i: (*odds[i], *rates[i], odds[i][0] >= 0.5 and odds[i][1] < 0.5) for i in feats}
