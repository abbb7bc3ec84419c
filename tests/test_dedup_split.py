"""Dedup, ranking and split operators against brute force (D1, D2, W1-W3, W8 building blocks)."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from threadmill.operators.dedup import flag_first_seen, keep_first_seen
from threadmill.operators.near_dedup import exact_jaccard_pairs, near_dedup, resolve_drops
from threadmill.operators.ranking import flag_first_k, md5_order_key
from threadmill.operators.splits import first_n_per_group, md5_mod20_is_zero, stratified_split

from conftest import SF_SMALL


def test_first_seen_with_hot_key(spark):
    data = [(i, "hot" if i % 3 == 0 else f"k{i % 7}") for i in range(300)]
    df = spark.createDataFrame(data, "id long, k string")
    got = {r.id for r in keep_first_seen(df, F.col("k"), ["id"]).collect()}
    first = {}
    for i, k in data:
        first.setdefault(k, i)
    assert got == set(first.values())
    flagged = flag_first_seen(df, F.col("k"), ["id"], eligible=F.col("id") % 2 == 0).collect()
    seen, want = set(), {}
    for i, k in data:
        if i % 2:
            want[i] = None
        else:
            want[i] = k not in seen
            seen.add(k)
    assert {r.id: r.is_first for r in flagged} == want


def test_md5_mod20(spark):
    keys = [f"key{i}" for i in range(400)] + ["", "C:abc"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(md5_mod20_is_zero("k")).collect()]
    assert got == [int(hashlib.md5(k.encode()).hexdigest(), 16) % 20 == 0 for k in keys]




def test_first_k_per_group_exact(spark):
    data = [(i, "big" if i % 2 else f"g{i % 5}") for i in range(2000)]
    df = spark.createDataFrame(data, "id long, g string").withColumn("key", md5_order_key(7, "id"))
    got = flag_first_k(df, "key", ["g"], lambda n: F.floor(n * 0.1) + 1, "in").where("in").collect()
    groups = {}
    for i, g in data:
        groups.setdefault(g, []).append((hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
    want = set()
    for g, items in groups.items():
        items.sort()
        want |= {i for _, i in items[: int(len(items) * 0.1) + 1]}
    assert {r.id for r in got} == want
    glob = flag_first_k(df, "key", [], lambda n: F.ceil(n * 0.05), "in").where("in").collect()
    allk = sorted((hashlib.md5(f"7:{i}".encode()).hexdigest(), i) for i, _ in data)
    assert {r.id for r in glob} == {i for _, i in allk[:100]}


def test_stratified_split_partition(spark):
    data = [(i, ["a", "b", "c"][i % 3]) for i in range(600)]
    df = spark.createDataFrame(data, "id long, d string")
    s = stratified_split(df, "d", "id").collect()
    assert len(s) == 600
    test = [r for r in s if r.split == "test"]
    assert len(test) == 3 * 10  # floor(200 * 0.05) per stratum
    tiny = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "id long, d string")
    t = stratified_split(tiny, "d", "id").collect()  # a stratum of 1 -> random split of all
    assert sum(r.split == "test" for r in t) == 1


def test_first_n_per_group(spark):
    data = [(i, "hot" if i % 4 else f"s{i % 3}") for i in range(1000)]
    df = spark.createDataFrame(data, "id long, g string")
    got = first_n_per_group(df, "g", "id", 7, salt_buckets=4).collect()
    want = {}
    for i, g in sorted(data):
        want.setdefault(g, [])
        if len(want[g]) < 7:
            want[g].append(i)
    assert sorted((r.g, r.rn, r.id) for r in got) == sorted((g, n + 1, i) for g, ids in want.items()
                                                            for n, i in enumerate(ids))


def simulate(n, th, nbrs):
    """Sequential loop: rows in order; each row meets its earlier, not-yet-dropped
    neighbours; the richer one stays, on a tie the earlier one goes."""
    dropped = set()
    for i in range(n):
        for j in sorted(nbrs[i]):
            if j >= i or j in dropped:
                continue
            if th[j] > th[i]:
                dropped.add(i)
            else:
                dropped.add(j)
    return dropped


def test_resolve_drops_matches_loop(spark):
    rng = random.Random(3)
    for trial in range(3):
        n = 25
        th = [rng.randint(0, 4) for _ in range(n)]
        nbrs = {i: set() for i in range(n)}
        pairs = []
        for a in range(n):
            for b in range(a + 1, n):
                if rng.random() < 0.15:
                    nbrs[a].add(b)
                    nbrs[b].add(a)
                    pairs.append((a, b))
        rows = spark.createDataFrame([(i, th[i]) for i in range(n)], "id long, th long")
        p = spark.createDataFrame(pairs or [(0, 1)][:0], "a long, b long")
        got = {r.id for r in resolve_drops(rows, p, "id", "th").collect() if r.dropped}
        assert got == simulate(n, th, nbrs), f"trial {trial}"


def test_near_dedup_recall(spark):
    from threadmill.functions.text import word_count
    from threadmill.sources.tables import table
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").where(word_count("text") <= 400)
    rows = docs.withColumn("thinking", F.lit(None).cast("string"))
    out = near_dedup(rows, "doc_id", "text", "thinking")
    exact = exact_jaccard_pairs(rows, "doc_id", "text").collect()
    dropped = {r.doc_id for r in out.where("near_dup").collect()}
    # LSH is probabilistic: nearly every true pair must lose a member
    hit = sum(1 for r in exact if r.a in dropped or r.b in dropped)
    assert exact and hit / len(exact) >= 0.9


def test_oversized_buckets_exact(spark):
    """The prefix-filter candidates give the same verified pairs as expanding all bucket pairs."""
    from threadmill.functions.text import word_count
    from threadmill.operators.near_dedup import (candidate_pairs, minhash, shingle_hashes, shingle_words,
                                                 verified_pairs)
    from threadmill.sources.tables import table
    d = table(spark, SF_SMALL, "documents").select("doc_id", "text").where(word_count("text").between(20, 400))
    s = (d.withColumn("_w", shingle_words(F.col("text"))).withColumn("_sh", shingle_hashes(F.col("_w")))
         .withColumn("sig", minhash(F.col("_sh"))).drop("_w", "text"))
    s = s.checkpoint()
    from threadmill.operators.near_dedup import BANDS, ROWS
    b = s.select("doc_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                                                    lambda j: F.xxhash64(F.slice("sig", j * ROWS + 1, ROWS)))).alias("band", "bh"))
    mates = (b.withColumnRenamed("doc_id", "a").join(b.withColumnRenamed("doc_id", "b"), ["band", "bh"]).where("a < b").select("a", "b").distinct())
    full = {tuple(r) for r in verified_pairs(s, mates, "doc_id").collect()}
    pref = {tuple(r) for r in verified_pairs(s, candidate_pairs(s, "doc_id"), "doc_id").collect()}
    assert full and full == pref


def test_rank_without_global_window(spark):
    from threadmill.operators.history import ranked
    vals = [(i, float((i * 37) % 11) if i % 13 else None) for i in range(300)]
    df = spark.createDataFrame(vals, "id long, v double")
    got = {r.id: r.rank for r in ranked(df, "v").collect()}
    nn = [v for _, v in vals if v is not None]
    want = {i: (1 + sum(1 for x in nn if x > v)) if v is not None else len(nn) + 1 for i, v in vals}
    assert got == want


def test_first_k_edges(spark):
    df = spark.createDataFrame([(i, "a" if i < 5 else "b") for i in range(8)], "id long, g string") \
        .withColumn("key", md5_order_key(1, "id"))
    none = flag_first_k(df, "key", ["g"], lambda n: F.lit(0), "in")
    assert none.where("in").count() == 0
    allr = flag_first_k(df, "key", ["g"], lambda n: n + 10, "in")
    assert allr.where("in").count() == 8


def test_first_seen_tuple_order(spark):
    data = [(r, i, f"k{(r + i) % 3}") for r in range(3) for i in range(10)]
    df = spark.createDataFrame(data, "rank int, id long, k string")
    got = {(x.rank, x.id) for x in keep_first_seen(df, F.col("k"), ["rank", "id"]).collect()}
    first = {}
    for r, i, k in sorted(data):
        first.setdefault(k, (r, i))
    assert got == set(first.values())


def test_long_chain_resolves_like_the_loop(spark):
    """100 versions whose strength falls: every second one drops, however long the chain."""
    from threadmill.operators.near_dedup import resolve_drops
    n = 100
    rows = spark.createDataFrame([(i, n - i) for i in range(n)], "id long, th long")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "a long, b long")
    got = {r.id for r in resolve_drops(rows, pairs, "id", "th").where("dropped").collect()}
    assert got == set(range(1, n, 2))


def test_null_groups_are_groups(spark):
    from threadmill.operators.splits import first_n_per_group, stratified_split
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "ab"[i % 2]) for i in range(100)], "id long, g string")
    out = stratified_split(df, "g", "id", test_size=0.2)
    assert out.count() == 100 and out.where("g is null and split = 'test'").count() == 5
    assert sorted(r.id for r in first_n_per_group(df, "g", "id", 2).where("g is null").collect()) == [0, 4]


def test_reward_delta_against_plain_lists(spark):
    import random
    from threadmill.operators.history import backfill, reward_delta
    rng = random.Random(3)
    logs = [(run, step, rng.random() if rng.random() > 0.1 else None) for run, n in (("a", 300), ("b", 4), (None, 20), ("c", 5)) for step in range(n)]
    got = {r.run: (r.n_logs, r.initial, r.final) for r in reward_delta(spark.createDataFrame(logs, "run string, step long, reward double"), "run", "step", "reward", slices=4).collect()}
    for run in ("a", "b", None, "c"):
        x = [v for name, _, v in logs if name == run and v is not None]
        n, first, last = got[run]
        assert n == len(x)
        if n < 5:
            assert first is None and last is None
        else:
            assert abs(first - sum(x[:5]) / 5) < 1e-12 and abs(last - sum(x[-5:]) / 5) < 1e-12
    reg = spark.createDataFrame([(1, None), (2, 1)], "id long, outcome int")
    facts = spark.createDataFrame([(3, 0)], "id long, quality int")
    assert backfill(reg, facts, "id", "outcome", "quality").where("outcome is null").count() == 1
    with pytest.raises(Exception, match="no quality for id 1"):
        backfill(reg, facts, "id", "outcome", "quality", strict=True).collect()


def test_source_audit_reads_whole_sources(spark):
    """A source that turns bad after its first 2,000 ids, and a long raw row."""
    import json

    from threadmill.operators.stats import AUDIT_CHARS, AUDIT_SAMPLE, source_audit
    good = [("late", i, json.dumps({"response": f"{i} " + "word " * 200})) for i in range(2000)]
    bad = [("late", i, json.dumps({"response": "same junk"})) for i in range(2000, 6000)]
    raw = [("raw", i, f"{i} " + "x" * 5000) for i in range(4)]
    df = spark.createDataFrame(good + bad + raw, "s string, id long, j string")
    got = {r.s: r for r in source_audit(df, "s", "id", "j").collect()}
    assert (got["late"].m, got["late"].uniq, got["late"].verdict) == (6000, round(2001 / 6000, 6), "DROP")
    assert (got["late"].pfx_top, got["late"].mlen, got["raw"].mlen) == (round(4000 / 6000, 6), 9, 5002)
    ref = {r.s: r for r in source_audit(df, "s", "id", "j", AUDIT_SAMPLE, AUDIT_CHARS).collect()}
    assert (ref["late"].m, ref["late"].verdict, ref["raw"].mlen) == (2000, "DROP(non-agentic)", 4000)


def test_signature_of_whole_texts(spark):
    """Rows that agree in the reference's prefixes and differ later are no copies."""
    import json

    from threadmill.operators.dedup import signature_key
    from threadmill.plans.traces import TRACE_PREFIX, clean_traces

    def trace(tail):
        return json.dumps({"messages": [{"role": "system", "content": "s" * 1200}, {"role": "user", "content": "q" + tail},
                                        {"role": "assistant", "content": "a" * 600 + tail}]})
    df = spark.createDataFrame([(i, "x", trace(t)) for i, t in enumerate(["1", "2", "1"])],
                               "id long, first_source_dataset string, row_json string")

    def dups(prefix):
        return [r.id for r in clean_traces(df, "id", ["x"], None, prefix).where("drop_reason = 'dup'").orderBy("id").collect()]
    assert (dups(None), dups(TRACE_PREFIX)) == ([2], [1, 2])
    pairs = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "a string, b string")
    assert pairs.select(signature_key("a", "b")).distinct().count() == 2


def test_corpus_rows_are_source_and_id(spark, monkeypatch):
    """Ids that met a row of another source in source_rank * 2**40 + id: both sources keep theirs."""
    from threadmill.plans import corpus
    kept = []
    split = corpus.stratified_split

    def spy(u, *a):
        kept.extend((r.source, r._user) for r in u.select("source", "_user").collect())
        return split(u, *a)
    monkeypatch.setattr(corpus, "stratified_split", spy)
    big = 1 << 40
    answer = "A long enough answer that passes the quality filter of the corpus build, word by word."

    def source(rows):
        return spark.createDataFrame([(i, u, answer) for i, u in rows], "_rid long, problem string, solution string")
    first = source([(big + 5, "one"), (big - 1, "two"), (1, "three")])
    second = source([(5, "three"), (-1, "four"), (7, "five")])
    corpus.build_corpus(spark, [(first, "a", "m"), (second, "b", "m")]).collect()
    assert sorted(kept) == [("a", "one"), ("a", "three"), ("a", "two"), ("b", "five"), ("b", "four")]


def test_class_drops_match_loop(spark):
    """Members of a class, or of two linked ones, are neighbours; a copy needs no pair of its own."""
    from threadmill.operators.near_dedup import class_drops
    rng = random.Random(5)
    n = 60
    th, cls = [rng.randint(0, 5) for _ in range(n)], [rng.randint(0, 11) for _ in range(n)]
    links = [(a, b) for a in range(6) for b in range(a + 1, 6) if rng.random() < 0.4]     # classes 6 to 11 are only copies
    linked = set(links) | {(b, a) for a, b in links}
    nbrs = {i: {j for j in range(n) if j != i and (cls[i] == cls[j] or (cls[i], cls[j]) in linked)} for i in range(n)}
    members = spark.createDataFrame([(i, th[i], cls[i]) for i in range(n)], "_id long, _th long, fp long")
    got = [r[0] for r in class_drops(members, spark.createDataFrame(links, "a long, b long")).collect()]
    assert len(got) == len(set(got)) and set(got) == simulate(n, th, nbrs)


def test_candidates_of_copies_are_one_row(spark):
    """Rows of one key and set meet as one: 40 copies of each of two near texts give one candidate."""
    from threadmill.operators.near_dedup import candidate_pairs, minhash, verified_pairs
    sets = {"p": list(range(1000, 1200)), "q": list(range(1000, 1199)), "far": list(range(5000, 5200))}
    rows = spark.createDataFrame([(k, s) for k, s in sets.items() for _ in range(40)], "fp string, _sh array<long>")
    rows = rows.withColumn("sig", minhash(F.col("_sh"))).checkpoint()
    pairs = candidate_pairs(rows, "fp")
    assert [tuple(r) for r in pairs.collect()] == [("p", "q")]
    assert [tuple(r) for r in verified_pairs(rows, pairs, "fp").collect()] == [("p", "q")]


def test_minhash_is_the_minimum_of_xxhash64(spark):
    """The values of Spark's own hash; computed in columns, a signature took a call per shingle and permutation."""
    from pyspark.sql import functions as F

    from threadmill.operators import near_dedup as N
    sets = [[0], [-1, 5, 2**62], [-2**63, 2**63 - 1], list(range(1, 200)), [], None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "i int, h array<long>")
    want = F.transform(F.sequence(F.lit(0), F.lit(127)), lambda p: F.array_min(F.transform("h", lambda x: F.xxhash64(x, p))))
    for size in (N.HASHES, 3):
        N.HASHES, before = size, N.HASHES
        got = df.select(N.minhash(F.col("h")).alias("got"), want.alias("want")).collect()
        N.HASHES = before
        assert all(r.got == r.want if r.want else r.got == [None] * 128 for r in got)
    assert "python" in df.select(N.minhash(F.col("h")))._jdf.queryExecution().executedPlan().toString().lower()


def test_strip_takes_the_characters_of_the_pattern(spark):
    from pyspark.sql import functions as F

    from threadmill.functions.text import WS, strip
    rows = [(chr(c) + "a" + chr(c) + " b" + chr(c),) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and c != 0]
    rows += [(None,), ("",), (" \n\t",), ("a",), (" 　\x85a \n b\r\n",), ("\U0001F600 x \U0001F600 ",)]
    df = spark.createDataFrame(rows, "t string").select("t", strip("t").alias("got"), F.regexp_replace("t", f"^{WS}+|{WS}+$", "").alias("want"))
    assert df.where(~F.col("got").eqNullSafe(F.col("want"))).count() == 0


def test_split_moves_no_whole_rows(spark):
    """A stratum's rows were shuffled by the stratum, with all their columns, to one task."""
    df = spark.createDataFrame([(i, "ab"[i % 2], "text") for i in range(100)], "id long, d string, t string")
    plan = stratified_split(df, "d", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2


def test_corpus_rows_are_normalised_once(spark, monkeypatch):
    """No filter reaches below the messages: their texts are not normalised for it anew."""
    from threadmill.plans import corpus
    plans, write = [], corpus.materialize

    def spy(df, name):
        if name == "corpus_build_rows":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)
    monkeypatch.setattr(corpus, "materialize", spy)
    answer = "A long enough answer that passes the quality filter of the corpus build, word by word."
    rows = [(1, "one", answer), (2, "two", "short"), (3, "", answer), (4, None, answer), (5, "five", "<think>" + answer), (6, "six", f" <think>x</think>{answer} "),
            (7, "one", answer), (None, "eight", answer)]
    got = corpus.build_corpus(spark, [(spark.createDataFrame(rows, "_rid long, problem string, solution string"), "a", "m")]).collect()
    assert sum(r.n for r in got if r.config == "sft") == 3 and "Filter" not in plans[0]
