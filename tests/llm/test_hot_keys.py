"""Equal rows and frequent words at volume: groups, broadcasts and samples stay bounded, results whole."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, source string"


def test_packing_spreads_equal_rows(spark):
    from threadmill.llm.packing import pack
    rows = spark.range(0, 10_000, 1, 4).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b").alias("text"))
    got = pack(rows, seq_len=64, group_pieces=500).select(F.expr("sequence_id div (1L << 32)").alias("g")).groupBy("g").count().collect()
    assert sum(r["count"] for r in got) == 10_000
    assert len(got) == 20 and max(r["count"] for r in got) < 700


@pytest.mark.parametrize("limit", [0, 1, 5, 40, 41, 1000])
def test_head_of_frequent_words(spark, limit):
    from threadmill.llm.lm_score import HEAD_BYTES, _head
    counts = [(f"w{i}".encode(), max(1, 1000 // (i + 1)), 1, 0.0) for i in range(40)] + [(b"x" * (HEAD_BYTES + 1), 10 ** 6, 1, 0.0)]
    got = {bytes(r.word): r.k for r in _head(spark.createDataFrame(counts, "word binary, k long, c long, lp double"), limit).collect()}
    short = [k for w, k, _, _ in counts if len(w) <= HEAD_BYTES]
    assert len(got) <= limit and (len(got) == 40 or limit < 40)
    assert Counter(got.values()) == Counter(sorted(short, reverse=True)[:len(got)])


def test_scores_do_not_depend_on_the_head(spark):
    from threadmill.llm.lm_score import lm_score
    docs = spark.createDataFrame([(i, " ".join(f"w{j % (i + 2)}" for j in range(30)) if i % 5 else None, "s") for i in range(40)], DOCS)
    one, two = ({r.doc_id: r for r in lm_score(docs, rounds=1, head_words=n).collect()} for n in (3, 1000))
    assert one.keys() == two.keys()
    for i, r in one.items():
        assert (r.n_tokens, r.n_known) == (two[i].n_tokens, two[i].n_known)
        assert (r.base_score, r.score) == pytest.approx((two[i].base_score, two[i].score))


def test_labelled_sample_takes_the_smallest_hashes(spark):
    from threadmill.llm.quality import labelled_sample
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    docs = ids.select("doc_id", F.col("doc_id").cast("string").alias("text"))
    labels = ids.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    open_rows = "crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1"
    want = [str(r.doc_id) for r in ids.where(open_rows).orderBy(F.xxhash64("doc_id"), "doc_id").limit(100).collect()]
    got = [bytes(r.body).decode() for r in labelled_sample(docs, labels, "quality", 100).collect()]
    assert sorted(got) == sorted(want)
    assert labelled_sample(docs, labels, "quality", 5000).count() == ids.where(open_rows).count()


def test_bitmap_keeps_every_wanted_row_and_few_others(spark):
    from threadmill.llm.minhash_dedup import among
    src = spark.range(20_000).select(F.xxhash64("id").alias("version"), "id")
    wanted = src.where("id % 40 = 0").select(F.col("version").alias("_v"))
    got = {r.id for r in among(src, wanted, "_v").select("id").collect()}
    assert set(range(0, 20_000, 40)) <= got and len(got) < 3_000
    assert among(src, wanted.where("false"), "_v").count() == 0
