"""Operators of threadmill.llm against brute-force versions, with nulls, ties, repeats and empty tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, body string, n string, rep int, code int, kept int, key int"


def table(spark, rows):
    """documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, s, None, 1, "b", "n", 2, 3, 0, 9) for i, t, s in rows], SCHEMA)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    vocab = [a + b for a in "abcdefgh" for b in ["", "x", "é", "Q."]]
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 120))) for _ in range(25)]
    out = [None, "", " \t\n", "one", "a b c", "b" * 5000, "x " * 3000]
    for t in base:
        out += [t] * rnd.randint(1, 3)
        w = t.split()
        for _ in range(rnd.randint(0, 4)):
            v = list(w)
            for _ in range(rnd.randint(1, 3)):
                v[rnd.randrange(len(v))] = rnd.choice(vocab)
            cut = rnd.randint(0, len(v))
            out.append("  ".join(v[:cut]) + "\n" + " ".join(v[cut:]))
    rnd.shuffle(out)
    return out


def numbered(spark, texts, source=lambda i: f"s{i % 4}" if i % 9 else None):
    return table(spark, [(i, t, source(i)) for i, t in enumerate(texts)])


def test_exact_dedup(spark, texts):
    from threadmill.llm.exact_dedup import exact_dedup
    rows = [*enumerate(texts), (None, "zz z"), (None, "z zz"), (0, texts[0]), (7000, "z  zz")]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append((-len(t or ""), i is None, i or 0, i))
    want = sorted(((i, min(groups[norm(t)])[3], len(groups[norm(t)]), min(groups[norm(t)])[3] == i, hashlib.sha256(norm(t).encode()).hexdigest())
                   for i, t in rows), key=repr)
    df = table(spark, [(i, t, "s") for i, t in rows])
    for budget in (48 << 20, 2000):           # the small budget spills subtrees all the time
        assert sorted(map(tuple, exact_dedup(df, budget).drop("code_points", "version").collect()), key=repr) == want
    assert exact_dedup(table(spark, [])).count() == 0


def test_patricia_trie():
    from threadmill.llm.exact_dedup import PatriciaOwners
    keys = [b"", b"a", b"ab", b"abc", b"abd", b"b" * 999 + b"x", b"b" * 999 + b"y", b"abc"]
    trie = PatriciaOwners()
    for i, k in enumerate(keys):
        trie.insert(k, (i,))
    assert sorted(trie.drain()) == sorted({k: (k, (keys.index(k),), keys.count(k)) for k in keys}.values())


@pytest.mark.parametrize("window,seed", [(6, 2), (9, 4)])
def test_substring_dedup(spark, texts, window, seed):
    from threadmill.llm.substring_dedup import substring_dedup
    rows = [*enumerate(texts), (2, texts[2]), (None, max((t or "" for t in texts), key=len))]
    starts = defaultdict(set)
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - window + 1):
            if i is not None:
                starts[tuple(w[p:p + window])].add(i)
    want = []
    for i, t in rows:
        w = words(t)
        gone = {p + j for p in range(len(w) - window + 1) for j in range(window) if i is not None and min(starts[tuple(w[p:p + window])]) < i}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    got = substring_dedup(table(spark, [(i, t, "s") for i, t in rows]), window, seed, texts=True)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert any(x[2] for x in want)
    assert substring_dedup(table(spark, []), window, seed).count() == 0


def test_substring_dedup_versions_of_one_id(spark):
    """Rows of one id with different texts: each loses its own copied words only."""
    from threadmill.llm.substring_dedup import substring_dedup
    window = 6
    passage = [f"p{i}" for i in range(30)]
    long = [f"l{i}" for i in range(200)] + passage + ["end"]
    short, other = ["s1", "s2"] + passage[:10] + ["s3"], [f"o{i}" for i in range(9)]
    docs = [(1, passage), (2, long), (2, short), (2, other), (3, short)]
    want = [(1, " ".join(passage)), (2, " ".join(long[:200] + ["end"])), (2, "s1 s2 s3"), (2, " ".join(other)), (3, "")]
    got = substring_dedup(table(spark, [(i, " ".join(w), "s") for i, w in docs]), window, 2, texts=True).collect()
    assert sorted((r.doc_id, r.kept_text) for r in got) == sorted(want)


def brute_components(rows, percent=75):
    sets = {}
    for i, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return [(i, len(sets[i]), find(i), find(i) == i) for i, _ in rows]


def test_minhash_dedup(spark, texts):
    from threadmill.llm.minhash_dedup import minhash_dedup
    rnd = random.Random(8)
    base = [f"w{j}" for j in range(90)]
    hot = []
    for _ in range(120):                      # near copies at and around the threshold, many not linked with each other
        v = list(base)
        for _ in range(rnd.randint(0, 4)):
            v[rnd.randrange(90)] = f"e{rnd.randrange(40)}"
        hot.append(" ".join(v))
    rows = list(enumerate([*texts, *hot]))
    got = sorted(map(tuple, minhash_dedup(table(spark, [(i, t, "s") for i, t in rows])).drop("version", "group").collect()))
    assert got == sorted(brute_components(rows))
    extra = minhash_dedup(table(spark, [(None, "a b", "s"), (4, "q r s", "s"), (4, "q r s", "s"), (9, "Q  r s", "s")])).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in extra), key=repr) == sorted([(None, None, True), (4, 4, True), (4, 4, True), (9, 4, False)], key=repr)
    assert minhash_dedup(table(spark, [])).count() == 0


def test_minhash_dedup_of_an_id_with_two_texts(spark):
    from threadmill.llm.minhash_dedup import minhash_dedup
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, "w x y z v u"), (4, "a b c d e f g"), (4, "")]
    got = minhash_dedup(table(spark, [(i, t, "s") for i, t in rows])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [
        (1, 56, 1, True), (1, 56, 1, True), (2, 57, 1, False), (3, 57, 1, False), (4, 0, 4, True), (4, 2, 4, True), (4, 3, 4, True)]
    # the smallest id of a component names it, also where one id has a text in each of two components
    rows = [(7, a), (5, a + " n"), (7, b), (9, b + " n")]
    got = minhash_dedup(table(spark, [(i, t, "s") for i, t in rows])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(5, 5, True), (7, 5, False), (7, 7, True), (9, 7, False)]


def test_byte_slices():
    import pyarrow as pa

    from threadmill.llm.common import byte_slices
    sizes = [0, 3, 5, 100, 0, 0, 2, 2, 2, 2, 1]
    b = pa.RecordBatch.from_arrays([pa.array(range(11)), pa.array([b"x" * n for n in sizes], pa.binary())], names=["i", "x"])
    for limit in (1, 4, 8, 1000):
        parts = list(byte_slices(b, [1], limit))
        assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(11))
        assert all(p.num_rows == 1 or sum(map(len, p.column(1).to_pylist())) <= limit for p in parts)


def test_sketch_estimates_similarity():
    from threadmill.llm.minhash_dedup import sketch
    rnd = np.random.default_rng(1)
    pool = rnd.integers(1, 2**63, 4000).astype(np.uint64)
    for n, shared in ((1000, 900), (10, 8), (1, 1)):
        got = sketch([pool[:n], pool[n - shared:2 * n - shared]], 256)
        assert got.all() and abs((got[0] == got[1]).mean() - shared / (2 * n - shared)) < 0.12


def test_mixing(spark, texts):
    from threadmill.llm.mixing import mix, mixed_documents
    df = numbered(spark, texts).union(numbered(spark, texts[:1]))
    got = mix(df, range_rows=7).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix(df, range_rows=10**6).collect()), key=repr)
    size, took, aim = Counter(), Counter(), {}
    for r in got:
        size[r.source] += r.size
        took[r.source] += r.taken
        aim[r.source] = r.target
        assert r.size == len(words(texts[r.doc_id])) and 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    # targets by resharing until no source is above its cap
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight, want, open_ = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, {}, set(names)
    while True:
        level = (1.5 * sum(size.values()) - sum(want.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * size[s]]
        if not over:
            break
        for s in over:
            want[s] = 2 * size[s]
            open_.discard(s)
    want.update({s: level * weight[s] for s in open_})
    assert all(abs(aim[s] - want[s]) < 1e-6 for s in names)
    longest = max(r.size for r in got)
    assert all(abs(took[s] - aim[s]) <= longest for s in names) and sum(took.values()) <= sum(aim.values()) + 1e-6
    assert mix(table(spark, [])).count() == 0
    assert [r.taken for r in mix(table(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]
    # one id on very many rows, and rows without an id: no range holds them all, every row counts by itself
    many = [(4, f"w{i % 7} x", "a") for i in range(3000)] + [(None, "one two three", "b")] * 2000 + [(None, f"t{i} u", "c") for i in range(2000)]
    hot = mix(table(spark, many), range_rows=50).collect()
    assert len(hot) == len(many) and all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in hot)
    for s in "abc":
        assert abs(sum(r.taken for r in hot if r.source == s) - next(r.target for r in hot if r.source == s)) <= 6
    # rows that repeat an id keep their own copies: each text is taken as often as its row
    rows = [(1, "w " * 100, "s"), (1, "w", "s"), (1, "w", "s"), (2, "v v", "s"), (None, "n " * 9, "z"), (None, "n " * 9, "z"), (3, None, "z")]
    clash = table(spark, rows).withColumnRenamed("rep", "_number").withColumnRenamed("code", "_copies")
    plan = Counter()
    for r in mix(clash).collect():
        plan[r.doc_id, r.size] += r.copies
    taken = Counter((r.doc_id, len(words(r.text))) for r in mixed_documents(clash).collect())
    assert taken == Counter({k: n for k, n in plan.items() if n}) and mixed_documents(clash).columns == clash.columns
    out = mixed_documents(numbered(spark, texts))
    assert out.columns == df.columns and out.count() == sum(r.copies for r in mix(numbered(spark, texts)).collect())


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    from threadmill.llm.packing import pack, vocabulary
    odd = ["a  b", " lead", "trail ", "x\n\ny", "<|endoftext|> z", "it's we'll don 't 12  3", "\t", "a \n b", "tab\tsep é ß 漢字 🙂", "w　 w"]
    rows = [*enumerate([*texts, *odd]), (None, "n"), (1, texts[1])]
    tok = Tokenizer.from_file(vocabulary())
    ids = [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows]
    got = pack(table(spark, [(i, t, "s") for i, t in rows]), seq_len=64, group_pieces=50).collect()
    want = Counter()
    for (i, _), x in zip(rows, ids):
        for a in range(0, len(x), 64):
            want[i, a, len(x[a:a + 64]), zlib.crc32(np.array(x[a:a + 64], "<u4").tobytes()), len(x)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    assert pack(table(spark, [])).count() == 0


def test_first_fit_decreasing_matches_plain_scan():
    from threadmill.llm.packing import first_fit_decreasing
    rnd = np.random.default_rng(2)
    for n in (1, 2, 7, 300):
        lengths = rnd.integers(1, 101, n)
        bins, offsets = first_fit_decreasing(lengths, 100)
        free = []
        for i in np.argsort(-lengths, kind="stable"):
            b = next((j for j, f in enumerate(free) if f >= lengths[i]), len(free))
            free.extend([100] * (b == len(free)))
            assert (bins[i], offsets[i]) == (b, 100 - free[b])
            free[b] -= lengths[i]


def test_lattice_sums_all_segmentations():
    from threadmill.llm.lm_score import Lattice
    pieces = sorted({b" ", b"a", b"b", b"c", b"ab", b" a", b"bc", b"abc", b" ab"})
    p = np.random.default_rng(4).dirichlet(np.ones(len(pieces)))
    prob = dict(zip(pieces, p))

    def total(s):
        return 1.0 if not s else sum(prob[x] * total(s[len(x):]) for x in pieces if s.startswith(x))

    names = [b"a", b"abcab", b"cabcabc", b"b", b"bb"]
    got = Lattice(pieces, np.log(p)).log10(names)
    assert np.allclose(got, [math.log10(total(b" " + w)) for w in names])
    counts = Lattice(pieces, np.log(p)).expected(names, np.ones(len(names)))
    assert np.isclose((counts * np.array([len(x) for x in pieces])).sum(), sum(len(w) + 1 for w in names))


def test_lm_score(spark, texts):
    from threadmill.llm.lm_score import lm_score
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    low = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(t)]
    count = Counter(w for i, t in enumerate(texts) if not held(i) for w in [*low(t), None])
    n, v = sum(count.values()), len(count)
    df = numbered(spark, texts)
    by_head = [sorted(map(tuple, lm_score(df, head_words=h).collect())) for h in (5, 150_000)]
    for got in by_head:
        for (i, out, tokens, known, train, base, score), t in zip(got, texts):
            toks = [*low(t), None]
            assert (out, tokens, known, train) == (held(i), len(toks), sum(count[w] > 0 for w in toks), n)
            assert math.isclose(base, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in toks), rel_tol=1e-9) and score < 0
    assert np.allclose([r[6] for r in by_head[0]], [r[6] for r in by_head[1]])
    # the scores of all words together stay below one
    assert lm_score(table(spark, [])).count() == 0
    only_held = next(i for i in range(100) if held(i))
    r = lm_score(table(spark, [(only_held, "a b", "s")])).first()
    assert (r.n_known, r.train_tokens) == (0, 0) and math.isclose(r.base_score, 0.0, abs_tol=1e-12) and r.score < 0


def test_top_k(spark):
    from threadmill.llm.top_k import exact_top_k
    rnd = np.random.default_rng(6)
    vecs = {i: rnd.integers(-2, 3, 8) / 7 for i in range(90)}
    vecs |= {200: vecs[3], 201: vecs[3], 220: np.zeros(8)}
    rows = [(i, [float(x) for x in v]) for i, v in vecs.items()]
    bad = [(300, None), (301, [None] * 8), (302, [math.nan] * 8), (303, [math.inf] + [0.0] * 7), (340, [math.nan] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows + bad], "vec_id long, embedding array<float>, label int, x int")
    ints = {i: np.floor(64 * np.float32(v).astype(np.float64)).astype(int) for i, v in vecs.items()}
    want = []
    for q in sorted(i for i in vecs if i % 20 == 0):
        best = sorted((-int(ints[q] @ x), i) for i, x in ints.items() if i != q)[:20]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    for b in (16, 8192):
        assert sorted(map(tuple, exact_top_k(df, block_rows=b, block_queries=2).collect())) == want
    assert exact_top_k(df.limit(0)).count() == 0
    assert exact_top_k(df.where("vec_id in (0, 1, 2)")).count() == 2
    # components beyond 32 bits are scored as they are; beyond 64 bits the job fails
    big = lambda rows: exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1)
    assert [tuple(r) for r in big([(20, [1.0]), (1, [2e9]), (2, [4e9])]).orderBy("rank").collect()] == [(20, 1, 2, 4 * 10**9), (20, 2, 1, 2 * 10**9)]
    for rows in ([(20, [4e9]), (1, [4e9])], [(20, [1.0]), (1, [1e30])]):
        with pytest.raises(Exception, match="64 bits"):
            big(rows).collect()


def test_quality_and_toxicity_on_held_out_rows(spark):
    from threadmill.llm.quality import score_quality
    from threadmill.llm.toxicity import score_toxicity
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    for score, label, least, wrong in ((score_quality, "quality", 0.98, 0.02), (score_toxicity, "toxic", 0.75, 0.005)):
        got = score(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", label, "doc_id", "score").collect()
        one = [r.predicted for r in got if r[label] == 1]
        zero = [r.predicted for r in got if r[label] == 0]
        assert sum(one) / len(one) >= least and sum(zero) / len(zero) <= wrong
        assert all(0 <= r.score <= 1 for r in got)


def test_classifiers_without_labels(spark, texts):
    from threadmill.llm.quality import keep_quality, score_quality
    from threadmill.llm.toxicity import score_toxicity
    df = numbered(spark, texts)
    labels = spark.createDataFrame([(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    for score in (score_quality, score_toxicity):
        got = score(df, labels).collect()
        assert len(got) == len(texts) and all(r.score == 0.5 for r in got)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
        assert score(table(spark, []), labels).count() == 0
    assert keep_quality(df, labels).columns == df.columns


def test_html_keeps_what_only_sounds_like_a_menu():
    from threadmill.llm.html_text import main_text
    text = "Words of an article, long enough to be found as the main text of this page."
    for start in ('<h2 id="related-work">', '<h2 id="search-engines">', '<section id="form-and-function">',
                  '<div class="social-sciences">', '<p class="share-price">', '<p class="notice">'):
        end = f"</{re.match('<([a-z0-9]+)', start)[1]}>"
        assert main_text(f"<article><p>{text}</p>{start}Inner words{end}<p>{text}</p></article>") == f"{text}\nInner words\n{text}"
    for start in ('<div class="page-with-sidebar">', '<div class="content-sidebar">', '<div class="sidebar">', '<form action="x.aspx">'):
        end = f"</{re.match('<([a-z0-9]+)', start)[1]}>"
        for inner in (f"<p>{text}</p>", f"<main><p>{text}</p></main>"):
            assert main_text(f'<body>{start}<nav><a href="/">Home</a></nav>{inner}{end}</body>') == text
    side = '<div class="share-buttons">Share it</div><aside><article>Teaser</article></aside><div class="comments"><p>Long comment. ' + text * 3 + "</p></div>"
    assert main_text(f"<body><article><p>{text}</p></article>{side}</body>") == text


def test_html(spark):
    from threadmill.llm.html_text import extract_main_text, main_text
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="page-has-sidebar">
      <nav><a href="/x">menu</a></nav><!-- <p>no</p> --><div class="ad-slot">buy now this is a long advert text that is dense</div>
      <article><header><h1>Title &amp; more</h1></header><p><b>First   para<br>line&nbsp;two<p>Second <a href=x>link</a> &eacute;.
      <ul><li>one<li>two</ul><form><input>mail</form><div id="comments"><p>reader says</p></div></article>
      <aside>side</aside><div class="cookie-notice">We use cookies</div><footer>&copy; foot</footer>"""
    assert main_text(page) == "Title & more\nFirst para line two\nSecond link é.\none\ntwo"
    assert main_text("<div class=post><h2>H</h2><p>Some words of text here.</p><section><p>More words, a longer one of them.</p></section></div>"
                     "<div class=sidebar>other things</div>") == "H\nSome words of text here.\nMore words, a longer one of them."
    assert main_text("plain &lt;text&gt; only") == "plain <text> only"
    assert main_text("<article><p>cut off here <b>and <scr") == "cut off here and"
    rows = [(1, "u", None, 5), (2, None, "", 5), (2, "u", page, 5), (None, "v", "<p>x</p>", 5), (7, "w", "<p>" + "long " * 50_000, 5)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert [(r.text, r.n_chars) for r in got[:2]] == [("", 0)] * 2 and got[3].text == "x" and got[4].n_chars == 249_999
    assert all(r.n_chars == len(r.text) for r in got)


def test_pipeline(spark, tmp_path, texts):
    import corpus_pipeline as P
    rows = [(i, t, "l", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    one = {n: f for n, f in P.STAGES}
    kept = one["exact_dedup"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    best = {}
    for i, t in enumerate(texts):
        best[norm(t)] = min(best.get(norm(t), (1, 0)), (-len(t or ""), i))
    after = sorted(r.doc_id for r in kept.collect())
    assert after == sorted(i for _, i in best.values())
    near = one["minhash_dedup"](spark, kept, str(tmp_path))
    left = sorted(r.doc_id for r in near.collect())
    assert left == sorted(i for i, _, _, k in brute_components([(i, texts[i]) for i in after]) if k)
    assert one["quality"](spark, docs, str(tmp_path)).count() == len(texts)
    out = P.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} <= set(left)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_pipeline_keeps_rows_by_their_own_verdict(spark):
    from corpus_pipeline import _only

    from threadmill.llm.common import text_version
    schema = "doc_id long, text string, _id int, n int"

    def left(rows):
        """rows: id, text, team, rank, kept."""
        docs = spark.createDataFrame([(i, t, n, 0) for n, (i, t, *_) in enumerate(rows)], schema)
        verdicts = spark.createDataFrame(rows, "doc_id long, text string, team string, rank long, kept boolean").withColumn("version", text_version())
        out = _only(docs, verdicts)
        assert out.columns == docs.columns
        return sorted(((r.doc_id, r.text, r._id) for r in out.collect()), key=str)

    rows = [(4, "a", "g", 0, True), (4, "b", "h", 0, False), (5, "c", "i", 0, True), (6, "c", "i", 0, False), (None, "d", None, 0, True), (None, "e", "j", 0, False)]
    want = [(4, "a", 0), (5, "c", 2), (None, "d", 4)]
    assert left(rows) == want
    # another id kept twice changes nothing for id 4; equal rows become one, the smallest by all columns
    assert left([*rows, (8, "x", "k", 0, True), (8, "x", "k", 0, True)]) == sorted([*want, (8, "x", 6)], key=str)
    # of two kept rows of one team the smaller rank stays, whatever the ids of the rows
    assert left([*rows, (8, "x y", "k", -3, True), (8, "xy", "k", -2, True)]) == sorted([*want, (8, "x y", 6)], key=str)
    # different teams, same id: both stay
    assert left([(8, "p", "k", 0, True), (8, "q", "l", 0, True)]) == [(8, "p", 0), (8, "q", 1)]
    assert left([(None, "p", None, 0, True), (None, "q", None, 0, True)]) == [(None, "p", 0), (None, "q", 1)]
    assert left([(1, None, "k", 0, True), (2, "", "k", 0, False)]) == [(1, None, 0)]


def test_pipeline_stages_with_repeated_ids(spark, tmp_path):
    import corpus_pipeline as P
    one = {n: f for n, f in P.STAGES}
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "a b"), (1, "a  b"), (1, "a  b"), (1, "other"), (None, "a b"), (2, long), (2, "unlike " * 9), (3, long + " x"), (None, long), (None, None), (None, None)]
    docs = table(spark, [(i, t, "s") for i, t in rows])
    kept = sorted(((r.doc_id, r.text) for r in one["exact_dedup"](spark, docs, str(tmp_path)).collect()), key=str)
    assert kept == sorted([(1, "a  b"), (1, "other"), (2, long), (2, "unlike " * 9), (3, long + " x"), (None, None)], key=str)
    near = sorted(((r.doc_id, r.text) for r in one["minhash_dedup"](spark, docs, str(tmp_path)).collect()), key=str)
    # the two rows of id 1 are one component with one row left; rows without an id stay, equal ones as one
    assert [x for x in near if x[0] != 1] == sorted([(2, long), (2, "unlike " * 9), (None, "a b"), (None, long), (None, None)], key=str)
    assert len([x for x in near if x[0] == 1]) == 2 and (1, "other") in near


def test_sql_forms_match(spark):
    import os

    import duckdb

    from threadmill.llm.queries import ORACLE, QUERIES
    con, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for name in ("documents", "embeddings", "pages"):
        path = f"{sf}/{name}.parquet"
        con.execute(f"create view {name} as select * from '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, sf)
        cols = sorted(got.columns)
        rel = con.sql(f"select {', '.join(cols)} from ({sql})")
        assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(rel.fetchall(), key=repr), name
