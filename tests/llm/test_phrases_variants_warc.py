"""Collocations, spelling variants and WARC round trips against brute force; Bloom filters and multikey quicksort."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest



DOCS = "doc_id long, text string, lang string, f long, word string, w int, phrase string, key binary, near string, weight int"


def docs(spark, rows):
    """documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, 1, "x", 2, "y", b"z", "n", 3) for i, t, lang in rows], DOCS)


def brute_collocations(rows, minimum, top):
    f, n = Counter(), Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = []
    for lang in n:
        cand = {g: a for (x, g), a in f.items() if x == lang and len(g) > 1 and a >= minimum}
        rank = []
        for g, a in cand.items():
            if any(100 * b >= 80 * a for h, b in cand.items() if len(h) > len(g) and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))):
                continue
            score, _, lo, r = min((2000000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
            rank.append((-score, -a, " ".join(g).encode(), lo, r))
        for i, (s, a, p, lo, r) in enumerate(sorted(rank)[:top], 1):
            out.append((lang, i, p.decode(), -a, lo, r, n[lang], -s))
    return sorted(out)


def phrase_rows():
    rnd = random.Random(5)
    vocab = ["New", "york", "city", "hall", "é", "x y", "a", "b", "c"]
    rows = [(None, None, None), (1, "", "en"), (1, " \t,;\n", "en"), (2, "a " * 400, "hot"), (3, "new york city hall. " * 50, None), (4, "und piece new york", "und")]
    for i in range(60):
        t = ""
        for _ in range(rnd.randint(0, 80)):
            t += rnd.choice(["new york city", "new york", rnd.choice(vocab)]) + rnd.choice([" ", " ", "\t", ", ", "\n", "."])
        rows += [(i % 7, t, rnd.choice(["en", "de", None]))] * rnd.randint(1, 2)
    return rows


@pytest.mark.parametrize("options", [{}, {"chunk_words": 50, "part_rows": 40, "hot_rows": 10}, {"chunk_words": 200, "max_bits": 256}, {"hot_rows": 0}])
def test_collocations(spark, options):
    from threadmill.llm.collocations import mine_collocations
    rows = phrase_rows()
    got = mine_collocations(docs(spark, rows), minimum=6, top=25, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 6, 25)


def test_collocations_empty(spark):
    from threadmill.llm.collocations import mine_collocations
    assert mine_collocations(docs(spark, [])).count() == 0
    assert mine_collocations(docs(spark, [(1, None, None), (2, "one", "en")])).count() == 0


def test_collocation_scores_stay_exact(spark):
    """Products over 64 bits: counts of 6e12 from weighted rows."""
    big = 6_000_000_000_007
    e = spark.sql(f"select (cast(2000000 as decimal(19,0)) * cast({big} as decimal(19,0))) div (cast({big} as decimal(19,0)) + cast({big + 1} as decimal(19,0))) as s")
    assert e.head()[0] == 2000000 * big // (2 * big + 1)


@pytest.mark.parametrize("seed", range(6))
def test_multikey_counts(seed):
    from threadmill.llm.collocations import multikey_counts
    rnd = random.Random(seed)
    depth, minimum, free = rnd.randint(1, 4), rnd.randint(1, 12), rnd.randint(0, 3)
    rows = [[rnd.randint(1, 1 + seed * 2) for _ in range(rnd.randint(1, 5))][:depth] for _ in range(rnd.randint(1, 400))]
    weight = [rnd.randint(1, 4) for _ in rows]
    tok = np.zeros((len(rows), depth + 1), np.int64)
    for i, r in enumerate(rows):
        tok[i, :len(r)] = r
    tok = tok.ravel()
    got = {}
    for at, d, count in multikey_counts(tok, np.arange(0, len(tok), depth + 1), np.array(weight), depth, minimum, free):
        for p, c in zip(at, count):
            key = tuple(tok[p:p + d])
            assert key not in got
            got[key] = c
    want = Counter()
    for r, w in zip(rows, weight):
        for d in range(1, len(r) + 1):
            want[tuple(r[:d])] += w
    assert {k: v for k, v in got.items() if v >= minimum} == {k: v for k, v in want.items() if v >= minimum}
    assert all(got[k] == want[k] for k in got) and all(k in got for k in want if len(k) <= free)


def test_bloom_never_loses_a_key(spark):
    from threadmill.llm import bloom
    draw = lambda seed, n: np.random.default_rng(seed).integers(-(1 << 63), (1 << 63) - 1, n)
    h = draw(2, 5000).view(np.uint64)
    df = spark.createDataFrame([(int(x),) for x in h.view(np.int64)], "h long")
    blocks = bloom.blocks_for(len(h))

    def placed(b):
        x = b.column(0).to_numpy().view(np.uint64)
        return x, bloom.place(x, blocks)

    words = bloom.build(df, placed, blocks)
    assert len(bloom.contains(words, h, bloom.place(h, blocks))) == len(h)
    other = draw(3, 20000).view(np.uint64)
    assert len(bloom.contains(words, other, bloom.place(other, blocks))) < 200
    assert bloom.blocks_for(10 ** 12) * 256 == bloom.MAX_BITS


def brute_variants(rows, modulus=97):
    n = Counter()
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % modulus == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    group = {w: [x for x in n if x != w and near(w, x)] for w in n}
    form = {}
    for w, g in group.items():
        best = min(g, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(group[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: r[0])


def variant_rows():
    rnd = random.Random(9)
    base = ["garden", "GardeN", "élève", "straße", "hello×", "aaaaaa", "bookkeeper", "Éclair", "abcde", "abcdef", "x" * 60, "y" * 59 + "z"]
    rows = [(None, None, None), (1, "", None), (2, "Āſ 123 \n", None)]
    for i in range(80):
        out = []
        for _ in range(rnd.randint(1, 40)):
            w = list(rnd.choice(base))
            if rnd.random() < 0.4:
                k = rnd.randrange(len(w))
                w[k:k + 1] = rnd.choice([[], ["a"], [w[k], "e"], ["ÿ"]])
            out.append("".join(w))
        rows.append((None if i % 11 == 0 else i % 50, rnd.choice([" ", "-", "_1"]).join(out), None))
    return rows


@pytest.mark.parametrize("options", [{}, {"max_bits": 256, "probes": 300}])
def test_spelling_variants(spark, options):
    from threadmill.llm.spelling import group_variants
    rows = variant_rows()
    for modulus in (97, 3):
        got = group_variants(docs(spark, rows), modulus=modulus, **options).collect()
        assert sorted(map(tuple, got), key=lambda r: r[0]) == brute_variants(rows, modulus)
    assert group_variants(docs(spark, [])).count() == 0
    assert group_variants(docs(spark, rows[:3])).count() == 0


def test_roots_of_long_chains(spark):
    from threadmill.llm.common import Scratch
    from threadmill.llm.spelling import roots
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("side", "w30")]
    got = dict(map(tuple, roots(spark.createDataFrame(chain, "word string, form string"), Scratch(spark, "t")).collect()))
    assert got == {w: "w37" for w, _ in chain}


PAGES = "page_id long, url string, html string, key binary, file string, digest string, body int, revisit boolean"


def page_rows():
    rnd = random.Random(4)
    same, small = "<p>" + "copy é " * 30, "tiny"
    rows = [(None, None, None), (None, "u", same), (3, "http://A.example.com:80/x?y=1#z", same), (1, "https://b.example.org", same), (1, "https://b.example.org", same),
            (7, "not a url\r\nX: y", small), (8, "http://h/" + "p" * 300, small), (9, "http://h/" + "p" * 300 + "q", "z" * 300_000), (10, "", ""), (11, "http://é.example/ü", "\r\n\r\nWARC/1.1\r\n" * 20)]
    for i in range(20, 120):
        rows.append((i, f"http://{rnd.choice('abc')}.example.net/{i % 13}", rnd.choice([same, small, "<html>" + "w" * rnd.randint(80, 130), None])))
    return rows


def brute_records(rows):
    first = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        to = first.get(h)
        again = to is not None and to != i
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows", [3000, 4, 1])
def test_warc_round_trip(spark, block_rows):
    from threadmill.llm.warc import archive_round_trip
    rows = page_rows()
    df = spark.createDataFrame([(*r, b"k", "f", "d", 1, True) for r in rows], PAGES).repartition(3)
    got = archive_round_trip(df, block_rows=block_rows, payloads=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute_records(rows)
    held = Counter(bytes(r.payload) for r in got if r.record_type == "response")
    assert set(held) == {(h or "").encode() for _, _, h in rows}
    assert archive_round_trip(df.limit(0)).count() == 0


def test_warc_files_are_whole(spark, tmp_path):
    """The archives are gzip members of WARC records that any reader can walk, and the index holds each once."""
    import glob
    import gzip

    from threadmill.llm.common import Scratch
    from threadmill.llm.warc import build_index, capture_key, look_up, parse, surt, write_archives
    rows = page_rows()
    df = spark.createDataFrame([(*r, b"k", "f", "d", 1, True) for r in rows], PAGES)
    caps = write_archives(df, Scratch(spark, "t"), str(tmp_path / "a"), file_bytes=2000)
    found = caps.collect()
    files = glob.glob(f"{tmp_path}/a/*.warc.gz")
    assert len(files) > 3 and len(found) == len(rows)
    for f in files:
        raw = gzip.open(f).read()
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    for c in found:
        data = open(f"{tmp_path}/a/{c.file}", "rb").read()[c.at:c.at + c.size]
        assert parse(gzip.decompress(data))["record_type"] in ("response", "revisit")
    index = build_index(caps, Scratch(spark, "t"), str(tmp_path / "i"), block_rows=3)
    assert index.first == sorted(index.first) and len(index.first) >= len(rows) // 3
    ask = [capture_key("https://b.example.org", 1), capture_key("https://b.example.org", 2), capture_key("zzz", 1), b""]
    hits = look_up(spark.createDataFrame([(k,) for k in ask * 2], "k binary"), index).collect()
    assert [bytes(h.key) for h in hits] == [ask[0]] * 2          # two rows repeat the page
    assert surt("http://A.example.com:80/x?y=1#z") == "com,example,a)/x?y=1" and surt(None) == "" and surt("https://b.org:8443") == "org,b:8443)/"
    bad = bytearray(open(files[0], "rb").read())
    with pytest.raises(ValueError):
        parse(b"WARC/1.0\r\n\r\n" + bytes(bad))


def test_capture_keys_sort_by_page_id():
    from threadmill.llm.warc import capture_key
    ids = [-(1 << 63), -1, 0, 5, (1 << 63) - 1, None]
    keys = [capture_key("http://h/", i) for i in ids]
    assert keys == sorted(keys) and len(set(keys)) == len(ids)
