"""The quality rules in plain numpy, one document after the other."""

import collections
import re

import numpy as np

from barlake.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times, covered = collections.Counter(triples), set()
    for i, t in enumerate(triples):
        if times[t] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def failed(c):
    return c[0] < 50 or 100 * c[4] > 50 * c[0]


def vector(c):
    n = max(c[0], 1)
    values = [np.log(1 + c[1] / n), np.sqrt(c[2] / max(c[1], 1)), np.sqrt(c[3] / n), np.sqrt(c[4] / n)]
    return [int(np.floor(v * rules.UNIT + 0.5)) for v in values]


FLOOR = np.array([rules.FLOORS[f] * rules.UNIT for f in rules.FEATURES])


def at_share(values, share):
    ordered = np.sort(values)
    return ordered[int(np.ceil(share * len(ordered) - 1e-9)) - 1]


def distances(x, mean, cov):
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def estimate(x):
    """Location and covariance by concentration steps from medians and quartiles."""
    x = x.astype(float)
    mean = np.array([at_share(c, 0.5) for c in x.T])
    spread = np.array([(at_share(c, 0.75) - at_share(c, 0.25)) / 1.349 for c in x.T])
    cov = np.diag(np.maximum(spread, FLOOR) ** 2)
    for _ in range(rules.STEPS):
        step = np.floor(np.log2(1 + distances(x, mean, cov)) * 64)
        near = x[step <= at_share(step, rules.SHARE)]
        mean = near.mean(axis=0)
        cov = rules.CONSISTENCY * np.cov(near.T, bias=True) + np.diag(FLOOR**2)
    return mean, cov, len(near)


def verdicts(docs):
    """Per position of (text, lang, source): kept or not."""
    all_counts = [counts(t) for t, _, _ in docs]
    groups = collections.defaultdict(list)
    for i, (_, lang, source) in enumerate(docs):
        if not failed(all_counts[i]):
            groups[(0, lang or "", source or "")].append(i)
            groups[(1, lang or "", "")].append(i)
    fitted = {}
    for key, members in groups.items():
        mean, cov, n = estimate(np.array([vector(all_counts[i]) for i in members]))
        if n >= rules.SHARE * rules.LEAST:
            fitted[key] = mean, cov
    out = []
    for i, (_, lang, source) in enumerate(docs):
        own = fitted.get((0, lang or "", source or "")) or fitted.get((1, lang or "", ""))
        near = own is None or distances(np.array([vector(all_counts[i])], float), *own)[0] <= rules.CUTOFF
        out.append(not failed(all_counts[i]) and bool(near))
    return out
