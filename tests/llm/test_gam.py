"""The additive model against plain versions: features, trees, fit and score."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest

from flowtable.llm import arrow_text, quality_gam

TEXTS = ["", "one two two three THREE!", "a b c d e f a b c d e f", "line one\nline one\n\nLast | line: 12, 34;", "é ö ß über\tstraße\x0b x",
         "#*$ %& <>|", "   \n ", "word " * 500, "Aa1! " * 7 + "\n" + "Aa1! " * 3]


def plain_features(text):
    raw = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    n, size, some = len(words), max(1, len(raw)), max(1, len(words))
    share = lambda pattern: len(re.findall(pattern, raw)) / size
    fives = [tuple(words[i:i + 5]) for i in range(n - 4)]
    lines = [x for x in raw.split(b"\n") if x]
    return [math.log1p(n), sum(map(len, words)) / some, share(rb"[#*$%&|<>]"), share(rb"[A-Z]"), share(rb"[0-9]"), share(rb"[!?]"),
            share(rb"\|"), share(rb"[\x80-\xff]"), share(rb"[.,;:]"), sum(len(w) <= 3 for w in words) / some,
            len(set(words)) / n if n else 0, sum(a == b for a, b in zip(words, words[1:])) / some,
            1 - len(set(fives)) / len(fives) if n >= 6 else 0, math.log1p(n / (raw.count(b"\n") + 1)),
            1 - len(set(lines)) / len(lines) if lines else 0]


def test_features():
    (_, _, offsets, data), = arrow_text.slices(pa.array(TEXTS))
    got = quality_gam.features(offsets, data)
    assert got == pytest.approx(np.array([plain_features(t) for t in TEXTS]), abs=1e-12)


def test_tree_is_the_best_cut():
    rng = np.random.RandomState(5)
    for _ in range(200):
        grad, hess = rng.normal(size=rng.randint(2, 12)), rng.rand(12)
        hess = hess[:len(grad)]
        gain = lambda a, b: grad[a:b].sum() ** 2 / (hess[a:b].sum() + 1)
        worth = {c: gain(0, c) + gain(c, len(grad)) for c in range(1, len(grad))}
        tree = quality_gam._tree(grad, hess, leaves=2)
        if max(worth.values()) - gain(0, len(grad)) <= 1e-9:
            assert len(set(tree.tolist())) == 1
            continue
        cut = max(worth, key=worth.get)
        want = [grad[a:b].sum() / (hess[a:b].sum() + 1) for a, b in ((0, cut), (cut, len(grad)))]
        assert tree == pytest.approx([want[i >= cut] for i in range(len(grad))])


def plain_fit(x, y, rounds, rate, bins):
    """Cyclic boosting of one-feature trees, value by value."""
    n, d = x.shape
    edges = [sorted(set(np.quantile(x[:, f], [i / bins for i in range(1, bins)]).tolist())) for f in range(d)]
    bin_of = lambda f, v: sum(v >= e for e in edges[f])
    tables = [[0.0] * (len(e) + 1) for e in edges]
    bias = math.log(y.mean() / (1 - y.mean()))
    z = [bias] * n
    for _ in range(rounds):
        for f in range(d):
            grad, hess = np.zeros(len(tables[f])), np.zeros(len(tables[f]))
            for i in range(n):
                p = 1 / (1 + math.exp(-z[i]))
                grad[bin_of(f, x[i, f])] += y[i] - p
                hess[bin_of(f, x[i, f])] += p * (1 - p)
            step = rate * quality_gam._tree(grad, hess)
            tables[f] = [t + s for t, s in zip(tables[f], step)]
            z = [z[i] + step[bin_of(f, x[i, f])] for i in range(n)]
    return edges, tables, z


def test_fit_is_cyclic_boosting(monkeypatch):
    rng = np.random.RandomState(2)
    x = np.round(rng.rand(40, 3), 2)
    y = (x[:, 0] + 0.3 * rng.rand(40) > 0.6).astype(float)
    monkeypatch.setattr(quality_gam, "ROUNDS", 5)
    monkeypatch.setattr(quality_gam, "PAIRS", 0)
    model = quality_gam.fit(x, y)
    edges, tables, z = plain_fit(x, y, 5, quality_gam.RATE, quality_gam.BINS)
    for f in range(3):
        assert model.edges[f] == pytest.approx(edges[f]) and model.tables[f] == pytest.approx(tables[f])
    assert model.score(x) == pytest.approx(1 / (1 + np.exp(-np.array(z))))


def test_score_adds_bins_and_pairs():
    rng = np.random.RandomState(3)
    x = rng.rand(200, 4)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # only the pair tells
    model = quality_gam.fit(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) >= 0.5) == y).mean() > 0.9
    for row in x[:20]:
        z = model.bias + sum(t[sum(row[f] >= e for e in model.edges[f])] for f, t in enumerate(model.tables))
        z += sum(t[sum(row[f] >= e for e in model.coarse[f]), sum(row[g] >= e for e in model.coarse[g])]
                 for (f, g), t in zip(model.pairs, model.pair_tables))
        assert model.score(row[None])[0] == pytest.approx(1 / (1 + math.exp(-z)))
