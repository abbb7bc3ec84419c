"""The similarity self-join against every pair."""

import itertools
import random

import pytest

from threadmill.operators.prefix_join import similar_pairs


def shingles(t, k):
    w = (t or "").lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, num, den, k):
    sets = {}
    for i, t in rows:
        s = shingles(t, k)
        if s and i is not None:
            sets.setdefault(s, set()).add(i)
    pairs = []
    for x, y in itertools.combinations(sets, 2):
        both, total = len(x & y), len(x | y)
        if both * den >= total * num:
            a, b = sorted((min(sets[x]), min(sets[y])))
            pairs.append((a, b, both, total))
    return sorted(pairs), sorted((i, min(ids)) for s, ids in sets.items() for i in ids)


def rows_of(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(14)]
    rows = [(None, "a b c d"), (900, None), (901, " \t"), (902, "one"), (903, "ONE"), (904, "two words"), (905, "x " * 3000), (906, "x " * 2000 + "y")]
    base = [[rnd.choice(vocab) for _ in range(rnd.randint(3, 40))] for _ in range(12)]
    for i in range(90):
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        rows.append((i, rnd.choice([" ", "  ", "\n"]).join(w)))
    hot = [f"h{i}" for i in range(60)]
    for i in range(100, 140):                 # near copies of one text, and exact ones
        w = list(hot)
        if i % 2:
            w[rnd.randrange(60)] = f"e{i}"
        rows.append((i, " ".join(w)))
    return rows + [(5, rows[20][1]), (5, "another text of the same id here")]


@pytest.mark.parametrize("threshold,ratio,k,seed", [(0.85, (17, 20), 3, 1), (0.5, (1, 2), 2, 2), (0.6, (3, 5), 1, 3), (1.0, (1, 1), 3, 4)])
def test_similar_pairs(spark, threshold, ratio, k, seed):
    rows = rows_of(seed)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, rep int, h int")
    pairs, members = similar_pairs(df, "doc_id", "text", threshold, k)
    want, classes = brute(rows, *ratio, k)
    assert sorted(map(tuple, pairs.collect())) == want
    assert sorted(map(tuple, members.distinct().collect())) == sorted(set(classes))


def test_similar_pairs_of_nothing(spark):
    pairs, members = similar_pairs(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text")
    assert pairs.count() == 0 and members.count() == 0


def test_prefix_and_bitmap_bounds(spark):
    """A class takes n - ceil(t n) + 1 shingles to the join, in one order for all; bitmaps never differ in more bits than sets in elements."""
    import numpy as np
    from threadmill.operators.near_dedup import parity
    from threadmill.operators.prefix_join import shingle_classes
    df = spark.createDataFrame([r for r in rows_of(7) if r[0] is not None], "doc_id long, text string")
    _, classes, sets = shingle_classes(df, "doc_id", "text", 0.85)
    got = classes.join(sets.dropDuplicates(["fp"]), "fp").collect()
    place = {}
    for r in got:
        assert r.n == len(r._sh) and len(r.pre) == r.n - -(-17 * r.n // 20) + 1 and set(r.pre) <= set(r._sh)
        for a, b in zip(r.pre, r.pre[1:]):
            place.setdefault(a, set()).add(b)
    assert not any(a in place.get(b, ()) for a in place for b in place[a])
    for x, y in itertools.combinations(got[:60], 2):
        bits = sum(int(a ^ b).bit_count() for a, b in zip(parity(np.array(x._sh)).view(np.uint64), parity(np.array(y._sh)).view(np.uint64)))
        assert bits <= len(set(x._sh) ^ set(y._sh)) and list(parity(np.array(x._sh))) == x.bits


def test_classes_go_by_their_number(spark):
    """Prefixes and meetings carry a class's number (a long), no longer its 16-byte key; an id with several texts is in several classes."""
    from threadmill.operators.prefix_join import shingle_classes
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    df = spark.createDataFrame([(1, text), (1, text + " end"), (2, text.upper()), (1, "another text"), (3, text + " end")], "doc_id long, text string")
    _, classes, _ = shingle_classes(df, "doc_id", "text")
    got = classes.collect()
    assert len(got) == 3 == len({r.no for r in got}) and {r.rep for r in got} == {1}
    pairs, _ = similar_pairs(df, "doc_id", "text")
    assert sorted(map(tuple, pairs.collect())) == [(1, 1, 24, 25)]
