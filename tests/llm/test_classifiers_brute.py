"""The classifiers' vector code against plain loops over the same models."""

import itertools
import math
import random

import numpy as np


def sample(n=600, seed=4):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, 5)).round(1)
    x[:, 3] = rnd.integers(0, 3, n)                 # many ties
    x[:, 4] = 7.0                                   # no information
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] == 1)).astype(float)
    return x, y


def test_flattened_trees_match_a_recursive_walk():
    from threadmill.llm.quality import fit
    x, y = sample()
    model = fit(x, y, trees=12, depth=4)

    def walk(node, row):
        f = model.feature[node]
        if f < 0:
            return model.value[node]
        bin_ = sum(1 for e in model.edges[f] if e < row[f])
        return walk(model.left[node] + (bin_ > model.cut[node]), row)

    unseen = np.vstack([x, np.random.default_rng(1).normal(size=(50, 5)) * 100])
    want = [1 / (1 + math.exp(-(model.base + sum(walk(r, row) for r in model.roots)))) for row in unseen]
    assert np.allclose(model.score(unseen), want)
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.95


def test_first_split_is_the_best_of_a_full_scan():
    from threadmill.llm.quality import fit
    for seed in range(4):
        x, y = sample(seed=seed)
        l2 = 1.0
        model = fit(x, y, trees=1, depth=1, l2=l2)
        p = 1 / (1 + math.exp(-model.base))
        g, h = y - p, np.full(len(y), p * (1 - p))
        part = lambda m: g[m].sum() ** 2 / (h[m].sum() + l2)
        bins = model.bins(x)
        gains = {(f, c): part(bins[:, f] <= c) + part(bins[:, f] > c) for f in range(5) for c in range(int(bins[:, f].max()))}
        root = int(model.roots[0])
        assert model.feature[root] >= 0
        assert math.isclose(gains[int(model.feature[root]), int(model.cut[root])], max(gains.values()), rel_tol=1e-6)


def test_factorization_machine_matches_the_double_loop():
    from threadmill.llm.toxicity import Machine
    rnd = np.random.default_rng(2)
    known = np.sort(rnd.integers(0, 1 << 40, 30))
    model = Machine(known, 0.3, rnd.normal(size=30), rnd.normal(size=(30, 4)))
    pick = random.Random(3)
    sets = [np.array(sorted(pick.sample([*known.tolist(), 1, 2, 3], k)), known.dtype) for k in (0, 1, 2, 7, 20, 30)]
    want = []
    for s in sets:
        at = [int(np.flatnonzero(known == t)[0]) for t in s if t in known]
        scale = 1 / math.sqrt(max(1, len(at)))
        pairs = sum(float(model.factor[i] @ model.factor[j]) for i, j in itertools.combinations(at, 2)) * scale ** 2
        want.append((model.bias, sum(model.weight[i] for i in at), pairs))
    raw, _, _ = model.raw(*model.rows(sets), len(sets))
    assert np.allclose(raw, [sum(w) for w in want])
    assert np.allclose(model.score(sets), [1 / (1 + math.exp(-sum(w))) for w in want])
    # the pair term is what a sum of weights misses
    assert any(abs(w[2]) > 0.05 for w in want)
